"""License scans: exact phrases, and a fuzzy search for short notices.

Both look at the normalised text, its words joined by single spaces. A notice of L letters may
be found with up to k edits. Cut into k + 1 pieces, at least one of them must occur unchanged
(pigeonhole), so one pass with an Aho-Corasick automaton over all pieces finds every place where a
notice can be. There, and only there, the regex library's bounded-error matching decides
and gives the span and its edits.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from bazaarlake.llm.shared import DOUBLE, INT, LONG, TEXT, alnum_words, as_bytes, small_batches, struct

# Phrase and label.
BASE = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Notices of the fuzzy search: words, label, edits allowed.
NOTICES = (
    ("mit license", "mit", 1),
    ("permission is hereby granted free of charge to any person", "mit", 6),
    ("apache license", "apache", 2),
    ("licensed under the apache license version 2 0", "apache", 4),
    ("general public license", "gpl", 3),
    ("this program is free software you can redistribute it", "gpl", 5),
    ("lesser general public license", "lgpl", 3),
    ("affero general public license", "agpl", 3),
    ("redistribution and use in source and binary forms", "bsd", 5),
    ("bsd 3 clause license", "bsd", 1),
    ("mozilla public license", "mpl", 3),
    ("eclipse public license", "epl", 3),
    ("boost software license", "boost", 3),
    ("creative commons attribution", "cc", 3),
    ("licensed under cc by", "cc", 2),
    ("released into the public domain", "public-domain", 3),
    ("all rights reserved", "reserved", 2),
)


def _pieces(phrase: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece): edits + 1 pieces that cover the phrase."""
    cuts = [len(phrase) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, phrase[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


class NoticeSearch:
    """The automaton and the patterns of some notices; built once per worker."""

    def __init__(self, notices=NOTICES):
        self.notices = notices
        self.seeds = ahocorasick.Automaton()
        by_piece: dict[str, list] = {}
        for number, (phrase, _, edits) in enumerate(notices):
            for offset, piece in _pieces(phrase, edits):
                by_piece.setdefault(piece, []).append((number, offset))
        for piece, where in by_piece.items():
            self.seeds.add_word(piece, (len(piece), where))
        self.seeds.make_automaton()
        # Whole words only; a match is improved at its place, not exchanged for a better one behind it.
        self.patterns = [
            regex.compile(f"(?e)(?<![^ ])(?:{regex.escape(phrase)}){{e<={edits}}}(?![^ ])")
            for phrase, _, edits in notices
        ]

    def find(self, line: str) -> list[tuple[str, int, int, int, int]]:
        """(label, start, end, edits, length of the notice) in characters of the line."""
        windows: dict[int, list[list[int]]] = {}
        for last, (size, where) in self.seeds.iter(line):
            start = last - size + 1
            for number, offset in where:
                phrase, _, edits = self.notices[number]
                lo = max(0, start - offset - edits)
                hi = start - offset + len(phrase) + edits
                spans = windows.setdefault(number, [])
                if spans and lo <= spans[-1][1]:
                    # Pieces of one place, or places side by side: one window over all of them.
                    spans[-1][0] = min(lo, spans[-1][0])
                    spans[-1][1] = max(hi, spans[-1][1])
                else:
                    spans.append([lo, hi])
        found = set()
        for number, spans in windows.items():
            phrase, label, _ = self.notices[number]
            for lo, hi in spans:
                # Whole words at the borders of the window.
                lo = line.rfind(" ", 0, lo) + 1
                hi = line.find(" ", hi)
                for m in self.patterns[number].finditer(line, lo, len(line) if hi < 0 else hi):
                    if m.end() > m.start():
                        found.add((label, m.start(), m.end(), sum(m.fuzzy_counts), len(phrase)))
        return sorted(found, key=lambda f: (f[1], f[2], f[0], f[3]))


def _exact(line: bytes) -> list[tuple[int, str]]:
    """(first word, label) of every place of a base phrase, overlaps included."""
    padded = b" " + line + b" "
    places = []
    for phrase, label in BASE:
        needle = f" {phrase} ".encode()
        at = padded.find(needle)
        while at >= 0:
            places.append((padded.count(b" ", 0, at), label))
            at = padded.find(needle, at + 1)
    return sorted(places)


_SEARCH: list[NoticeSearch] = []

SPAN = struct(label=TEXT, first_word=LONG, last_word=LONG, edits=INT)
SCAN = struct(
    n_words=LONG,
    n_base=LONG,
    first_word=LONG,
    last_word=LONG,
    base_labels=TEXT,
    labels=TEXT,
    score=DOUBLE,
    spans=T.ArrayType(SPAN),
)


@F.arrow_udf(SCAN)
def _scan(texts: pa.Array) -> pa.Array:
    if not _SEARCH:
        _SEARCH.append(NoticeSearch())
    out = []
    for text in as_bytes(texts):
        words = alnum_words(text)
        line = b" ".join(words)
        base = _exact(line)
        # Bytes that are not UTF-8 cannot be part of a notice.
        chars = line.decode("utf-8", "replace")
        spans, best = [], 1.0 if base else 0.0
        for label, start, end, edits, length in _SEARCH[0].find(chars):
            first = chars.count(" ", 0, start)
            spans.append((label, first, first + chars.count(" ", start, end), edits))
            best = max(best, 1 - edits / length)
        out.append(
            {
                "n_words": len(words),
                "n_base": len(base),
                "first_word": base[0][0] if base else None,
                "last_word": base[-1][0] if base else None,
                "base_labels": ",".join(sorted({label for _, label in base})),
                "labels": ",".join(sorted({label for _, label in base} | {s[0] for s in spans})),
                "score": best,
                "spans": [dict(zip(("label", "first_word", "last_word", "edits"), s)) for s in spans],
            }
        )
    return pa.array(out, to_arrow_type(SCAN))


def license_scan(docs: DataFrame, text_col: str = "text", out: str = "license") -> DataFrame:
    """docs with a struct column `out`: n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans.

    n_base counts the places where the words of a base phrase stand consecutively; first_word and
    last_word are their smallest and largest start. spans lists the notices found within
    their edits, by word; labels are those of both. score is 1 for a base phrase or an unchanged
    notice, less by the share of edited letters for a changed one, 0 without any. A null, empty
    or wordless text has no words, no labels ('') and score 0. Rows that repeat get equal results;
    all rows and columns stay, one named like `out` is replaced. No rows give no rows.
    """
    rows = small_batches(docs).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _scan(F.col(text_col)).alias("scan"))
    columns = [F.col("row")[c].alias(c) for c in docs.columns if c != out]
    return rows.select(*columns, F.col("scan").alias(out))
