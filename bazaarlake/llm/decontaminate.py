"""Benchmark decontamination with suffix arrays over the training documents.

Each task cuts its documents into shards of a bounded size and sorts the suffixes of a shard by
their words (prefix doubling, as deep as a window: two suffixes that agree that far need no
order). Every suffix of every benchmark item is then looked up by binary search, one word at a
time: the suffixes that share its first k words are an interval, and the next word narrows it.
The interval after ten words holds all places of that window; from each of them, the words are
compared further for the longest verbatim match there.

The benchmark is the stated query set. It goes to the tasks in blocks of BLOCK_BYTES,
one pass over the documents per block; documents are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.shared import LONG, TEXT, alnum_words, as_bytes, free_name, small_batches, struct

WINDOW = 10
SHARD_WORDS = 1 << 19
# Places of matches that are compared at a time.
PLACES = 1 << 20
BLOCK_BYTES = 32 << 20


class Benchmark:
    """A block of items: words, and for every suffix the window that starts it."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.window = window
        self.items: list = []
        self.words: list[bytes] = []
        start, length, owner, offset = [], [], [], []
        for item, text in items:
            words = alnum_words(text)
            at = len(self.words)
            self.words += words
            for i in range(len(words)):
                start.append(at + i)
                length.append(len(words) - i)
                owner.append(len(self.items))
                offset.append(i)
            if words:
                self.items.append(item)
        self.start = np.array(start, np.int64)
        self.length = np.array(length, np.int64)
        self.owner = np.array(owner, np.int64)
        self.offset = np.array(offset, np.int64)
        # A suffix starts a window of ten words; the whole of a shorter item is one.
        self.need = np.where(
            self.length >= window, window, np.where(self.offset == 0, self.length, 0)
        )
        self.deepest = int(self.need.max(initial=0))


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, ordered by their first `depth` words at least."""
    n = len(ids)
    rank = ids.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    known = 1
    while known < depth:
        after = np.zeros(n, np.int64)
        after[: n - known] = rank[known:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        known *= 2
        if len(new) and new[-1] == n - 1:
            break
    return order


def _bound(column: np.ndarray, sa: np.ndarray, k: int, lo, hi, word, right: bool) -> np.ndarray:
    """Per query, the first place of [lo, hi) whose k-th word is not below (right: is above) word."""
    lo, hi = lo.copy(), hi.copy()
    last = len(column) - 1
    open_ = np.flatnonzero(lo < hi)
    while len(open_):
        mid = (lo[open_] + hi[open_]) >> 1
        value = column[np.minimum(sa[mid] + k, last)]
        below = value <= word[open_] if right else value < word[open_]
        lo[open_] = np.where(below, mid + 1, lo[open_])
        hi[open_] = np.where(below, hi[open_], mid)
        open_ = open_[lo[open_] < hi[open_]]
    return lo


class Shard:
    """The words of some documents, a separator after each, and their suffix array."""

    def __init__(self, texts: list[list[bytes]], depth: int):
        number: dict[bytes, int] = {}
        ids: list[int] = []
        starts = []
        for words in texts:
            starts.append(len(ids))
            ids += [number.setdefault(w, len(number) + 1) for w in words]
            ids.append(0)  # no word of a query is 0: no match reaches across documents
        self.number = number
        self.ids = np.array(ids, np.int64)
        self.starts = np.array(starts, np.int64)
        self.sa = suffix_array(self.ids, depth)

    def numbers(self, bench: Benchmark) -> np.ndarray:
        """The words of the items as the shard numbers them; -1 for those it does not have."""
        return np.array([self.number.get(w, -1) for w in bench.words], np.int64)

    def search(self, bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
        """Per suffix the interval of its window (empty if it has none or none occurs)."""
        words = self.numbers(bench)
        m = len(bench.start)
        lo, hi = np.zeros(m, np.int64), np.full(m, len(self.sa), np.int64)
        window_lo, window_hi = np.zeros(m, np.int64), np.zeros(m, np.int64)
        live = np.arange(m)
        k = 0
        while len(live):
            live = live[bench.need[live] > k]
            word = words[bench.start[live] + k]
            live, word = live[word > 0], word[word > 0]
            left = _bound(self.ids, self.sa, k, lo[live], hi[live], word, False)
            right = _bound(self.ids, self.sa, k, left, hi[live], word, True)
            on = left < right
            live, left, right = live[on], left[on], right[on]
            k += 1
            lo[live], hi[live] = left, right
            full = live[bench.need[live] == k]
            window_lo[full], window_hi[full] = lo[full], hi[full]
        return window_lo, window_hi

    def maximal(self, bench: Benchmark) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(suffixes, places, lengths) of all matches of bench.window words at least that go on
        neither to the left nor to the right."""
        words = self.numbers(bench)
        lo, hi = self.search(bench)
        some = np.flatnonzero((lo < hi) & (bench.length >= bench.window))
        part = np.cumsum(hi[some] - lo[some]) // PLACES
        for chunk in np.split(some, np.flatnonzero(np.diff(part)) + 1) if len(some) else []:
            places, owner = _places(self.sa, lo[chunk], hi[chunk])
            suffix = chunk[owner]
            # In front of the first place stands the last word, which is a separator.
            left = (bench.offset[suffix] > 0) & (self.ids[places - 1] == words[bench.start[suffix] - 1])
            suffix, places = suffix[~left], places[~left]
            length = np.full(len(suffix), bench.window, np.int64)
            live = np.arange(len(suffix))
            while len(live):
                live = live[length[live] < bench.length[suffix[live]]]
                n = length[live]
                live = live[self.ids[places[live] + n] == words[bench.start[suffix[live]] + n]]
                length[live] += 1
            yield suffix, places, length

    def document_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, side="right") - 1


def _shards(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    group: list[list[bytes]] = []
    size = 0
    for text in texts:
        words = alnum_words(text)
        if group and size + len(words) > SHARD_WORDS:
            yield group
            group, size = [], 0
        group.append(words)
        size += len(words)
    if group:
        yield group


def _places(sa: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of some intervals, and the interval each belongs to."""
    count = hi - lo
    owner = np.repeat(np.arange(len(lo)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return sa[np.repeat(lo, count) + inside], owner


def _hits(texts: list[bytes | None], bench: Benchmark) -> Iterator[tuple[int, np.ndarray, list]]:
    """Per document: number of words, places hit (one flag a word), items with occurring windows."""
    for words in _shards(texts):
        shard = Shard(words, bench.deepest)
        mark = np.zeros(len(shard.ids) + 1, np.int64)
        found: list[set] = [set() for _ in words]
        if bench.deepest:
            lo, hi = shard.search(bench)
            some = np.flatnonzero(lo < hi)
            # Equal windows of several suffixes share one interval; their places are walked once. A shorter
            # window may start at the same place of the suffix array, so its length counts as well.
            window = lo[some] * (bench.window + 1) + bench.need[some]
            distinct, group = np.unique(window, return_inverse=True)
            first = np.zeros(len(distinct), np.int64)
            first[group] = some
            places, owner = _places(shard.sa, lo[first], hi[first])
            np.add.at(mark, places, 1)
            np.add.at(mark, places + bench.need[first][owner], -1)
            items: list[set] = [set() for _ in distinct]
            for g, suffix in zip(group.tolist(), some.tolist()):
                items[g].add(bench.owner[suffix])
            docs = shard.document_of(places)
            for doc, g in set(zip(docs.tolist(), owner.tolist())):
                found[doc] |= items[g]
        hit = np.cumsum(mark) > 0
        for i, doc in enumerate(words):
            start = shard.starts[i]
            yield len(doc), hit[start : start + len(doc)], [bench.items[j] for j in found[i]]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The benchmark in blocks of a bounded size; usually one."""
    items = benchmark.select(
        F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text")
    ).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = int(total // BLOCK_BYTES) + 1
    block = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    for b in range(count):
        yield [(r["item"], bytes(r["text"] or b"")) for r in items.where(block == b).collect()]


def _hit_udf(bench: Benchmark):
    @F.arrow_udf("struct<n_words: bigint, spans: array<int>, items: array<string>>")
    def hits(texts: pa.Array) -> pa.Array:
        counts, spans, items = [], [], []
        for n, hit, found in _hits(as_bytes(texts), bench):
            counts.append(n)
            # Borders of the runs of hit words: start, end, start, end, …
            spans.append(np.flatnonzero(np.diff(hit, prepend=False, append=False)).astype(np.int32))
            items.append(sorted({"" if i is None else i for i in found}))
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
            names=["n_words", "spans", "items"],
        )

    return hits


@F.arrow_udf(struct(n_hit=LONG, n_items=LONG, items_sha256=TEXT))
def _digest(spans: pa.Array, items: pa.Array) -> pa.Array:
    n_hit, n_items, sha = [], [], []
    for blocks, lists in zip(spans.to_pylist(), items.to_pylist()):
        runs = sorted((b[i], b[i + 1]) for b in blocks for i in range(0, len(b), 2))
        hit, end = 0, 0
        for start, stop in runs:
            hit += max(0, stop - max(start, end))
            end = max(end, stop)
        names = sorted({i for found in lists for i in found})
        n_hit.append(hit)
        n_items.append(len(names))
        sha.append(hashlib.sha256(",".join(names).encode()).hexdigest())
    return pa.StructArray.from_arrays(
        [pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(sha)],
        names=["n_hit", "n_items", "items_sha256"],
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    out: str = "contamination",
) -> DataFrame:
    """docs with a struct column `out`: n_words, n_hit, n_items, items_sha256, contaminated.

    A window is ten consecutive words of an item, or all of a shorter one. n_hit counts the
    words inside any occurrence of a window, n_items the items with an occurring window.
    A null, empty or wordless text has no words and is clean; items without words have no
    window; items that repeat count once by id, and an item without id counts as ''. With an
    empty benchmark all is clean. All columns and rows of docs stay; one named like `out` is replaced.
    """
    blocks = [Benchmark(items) for items in _blocks(benchmark, item_col, item_text_col)]
    hits = F.array(*[_hit_udf(b)(F.col(text_col)) for b in blocks])
    rows = small_batches(docs).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), hits.alias("hits"))
    digest = _digest(F.col("hits.spans"), F.col("hits.items"))
    rows = rows.withColumn("d", digest)
    result = F.struct(
        F.col("hits")[0]["n_words"].alias("n_words"),
        F.col("d.n_hit").alias("n_hit"),
        F.col("d.n_items").alias("n_items"),
        F.col("d.items_sha256").alias("items_sha256"),
        (F.col("d.n_hit") > 0).alias("contaminated"),
    )
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c != out]
    return rows.select(*kept, result.alias(out))


def longest_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    at_least: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(item_id, item_start, doc_id, doc_start, n_words): every verbatim match of at_least words that
    can be extended neither to the left nor to the right, so that no row depends on other
    documents. Starts count words from 0. Nulls and empty texts match nothing; repeated rows
    match each.
    """
    plain = small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = plain.schema["doc_id"].dataType.simpleString()
    found = None
    for items in _blocks(benchmark, item_col, item_text_col):
        bench = Benchmark(items, max(1, at_least))

        def matches(batches: Iterator[pa.RecordBatch], bench: Benchmark = bench) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                done = 0
                for words in _shards(as_bytes(batch.column(1))):
                    shard = Shard(words, bench.deepest)
                    for suffix, places, length in shard.maximal(bench):
                        docs_ = shard.document_of(places)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([bench.items[i] for i in bench.owner[suffix]], pa.string()),
                                pa.array(bench.offset[suffix]),
                                batch.column(0).take(pa.array(docs_ + done)),
                                pa.array(places - shard.starts[docs_]),
                                pa.array(length),
                            ],
                            names=["item_id", "item_start", "doc_id", "doc_start", "n_words"],
                        )
                    done += len(words)

        part = plain.mapInArrow(
            matches,
            f"item_id string, item_start bigint, doc_id {id_type}, doc_start bigint, n_words bigint",
        )
        found = part if found is None else found.unionByName(part)
    return found


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without any hit, with their columns; nulls, empty texts and repeated rows as in
    contamination. An empty benchmark keeps all."""
    mark = free_name(docs, "_contamination")
    marked = contamination(docs, benchmark, out=mark)
    return marked.where(~F.col(mark)["contaminated"]).select(*[F.col(f"`{c}`") for c in docs.columns])
