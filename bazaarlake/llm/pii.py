"""Personal data by weak supervision, in DataFrame operations only.

Four kinds have a rule of their own (email, ip, card, phone) and are always reported. Beside them any
coded token, a run of letters, digits and joining signs with a digit in it, may be a
secret or an account number. Labelers vote on each such token without knowing the truth: the format, a
gazetteer of words in front of it, the signs around it, its mix of characters and its
length. Expectation-maximisation over all tokens of the corpus estimates how reliable each
labeler's votes are and how likely each pattern of votes is to be personal; a logistic span
classifier is trained on these soft labels and decides.

Patterns of votes are few (3 per labeler, and length classes), so tokens are counted per pattern on
the executors, and the folds that fit both models run over one row of pattern counts.

Positions come from the text between matches: the lengths of the pieces add up. The regular expressions
use possessive groups, which Java matches without recursion, so a long text cannot
overflow the stack, and never try again inside a run that has failed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.shared import checkpointed

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"

_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    # From the start of a run or the end of the match before: elsewhere a run fails as at its start.
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Runs of 13 to 19 digits as a whole; shorter and longer runs fail as a whole.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){12,18}+(?![ -]?[0-9])",
    # 9 to 15 digits, to the last digit of the run.
    "phone": r"\+[0-9](?:[ ().-]*+[0-9]){8,14}+(?![ ().-]*+[0-9])",
}
# A coded token: a run of 8 signs at least, as a whole, with a digit.
_CODE = "[A-Za-z0-9_/+-]"
_DIGITLESS = "[A-Za-z_/+-]"
TOKEN = rf"(?<!{_CODE})(?={_DIGITLESS}*+[0-9]){_CODE}{{8,}}+"

# Words that announce a secret or an account, looked up in front of a token.
GAZETTEER = (
    "account", "apikey", "auth", "bearer", "credential", "iban", "key", "login", "passcode",
    "passport", "passwd", "password", "pin", "pwd", "secret", "ssn", "token",
)

LABELERS = ("format", "gazetteer", "context", "mix", "length")
NO, NONE, YES = 0, 1, 2
VOTES = 3
LENGTHS = 8
CELLS = len(LABELERS) * VOTES
EM_ROUNDS, FIT_ROUNDS, FIT_STEP = 30, 150, 2.0
CONTEXT = 24


SPANS = "array<struct<start: int, end: int, value: string, before: string>>"
# Spans are folded in runs of this many, as an array is copied whenever one is added.
RUN = 256


def _match(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _gaps(text: Column, matches: Column, pattern: str) -> Column:
    """The text between the matches; not looked for where there is none."""
    return F.when(F.size(matches) > 0, F.split(text, pattern, -1))


def _placed(matches: Column, gaps: Column) -> Column:
    """Matches as (start, end, value, before): code points, and the end of the text in front. Both
    arguments must be plain columns, as they are read at every step."""
    empty = F.array().cast(SPANS)

    def add(state: Column, i: Column) -> Column:
        start = state["at"] + F.length(F.get(gaps, i))
        end = start + F.length(F.get(matches, i))
        found = F.struct(
            start.alias("start"),
            end.alias("end"),
            F.get(matches, i).alias("value"),
            F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"),
        )
        return F.struct(end.alias("at"), F.array_append(state["out"], found).alias("out"))

    def add_run(state: Column, run: Column) -> Column:
        last = F.least(F.size(matches), run * RUN + RUN) - 1
        start = F.struct(state["at"].alias("at"), empty.alias("out"))
        one = F.array(F.aggregate(F.sequence(run * RUN, last), start, add))
        # transform over one element names the run, so that it is folded once.
        return F.get(
            F.transform(
                one, lambda r: F.struct(r["at"].alias("at"), F.array_append(state["out"], r["out"]).alias("out"))
            ),
            F.lit(0),
        )

    folded = F.aggregate(
        F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / RUN).cast("int")),
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("out")),
        add_run,
        lambda state: F.flatten(state["out"]),
    )
    return F.when(F.size(matches) > 0, folded).otherwise(empty)


def _small_parts(ip: Column) -> Column:
    return F.forall(F.split(ip, r"\."), lambda p: F.coalesce(p.try_cast("bigint"), F.lit(256)) <= 255)


def _luhn(card: Column) -> Column:
    digits = F.reverse(F.regexp_replace(card, "[ -]", ""))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def with_base_spans(rows: DataFrame) -> DataFrame:
    """rows, which have a column `text`, with a column per kind: the spans that its rule accepts."""
    text = F.col("text")
    # A text without the sign that a kind needs is not searched at all.
    sign = {"email": "@", "phone": "+", "ip": "."}
    found = {k: _match(text, PATTERNS[k]) for k in KINDS}
    for kind, needed in sign.items():
        found[kind] = F.when(F.contains(text, F.lit(needed)), found[kind]).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumns({f"match_{k}": v for k, v in found.items()})
    rows = rows.withColumns({f"gaps_{k}": _gaps(text, F.col(f"match_{k}"), PATTERNS[k]) for k in KINDS})
    spans = {k: _placed(F.col(f"match_{k}"), F.col(f"gaps_{k}")) for k in KINDS}
    spans["ip"] = F.filter(spans["ip"], lambda s: _small_parts(s["value"]))
    spans["card"] = F.filter(spans["card"], lambda s: _luhn(s["value"]))
    return rows.withColumns(spans).drop(*[f"{p}_{k}" for p in ("match", "gaps") for k in KINDS])


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, YES).when(no, NO).otherwise(NONE)


def _votes(span: Column) -> Column:
    """One vote per labeler, in their order."""
    value, before = span["value"], span["before"]
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    size = F.length(value)
    plain = value.rlike("^[0-9]++(?:[/-][0-9]++)*+$")
    word = F.lower(F.regexp_extract(before, r"([A-Za-z]+)[^A-Za-z]{0,4}$", 1))
    known = value.rlike(
        r"^(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9-]{16,}|[0-9a-f]{32,}"
        r"|[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30})$"
    )
    upper, lower = value.rlike("[A-Z]"), value.rlike("[a-z]")
    return F.array(
        _vote(known, plain & (size < 9)),
        _vote(word.isin(*GAZETTEER), before.rlike(r"[a-z]{3,} $") & ~word.isin(*GAZETTEER) & plain),
        _vote(before.rlike(r"[=:]\s?[\"']?$"), before.rlike(r"[#/]$")),
        _vote((digits * 5 >= size) & (upper | lower) & ~(upper & lower & (digits < 3)), plain | (digits < 3)),
        _vote(size >= 16, size < 10),
    )


def with_candidates(rows: DataFrame) -> DataFrame:
    """rows with a column `candidates`: coded tokens that overlap no base span, as start, end,
    votes, length class."""
    rows = rows.withColumn("match", _match(F.col("text"), TOKEN))
    rows = rows.withColumn("gaps", _gaps(F.col("text"), F.col("match"), TOKEN))
    rows = rows.withColumn("base", F.concat(*KINDS))
    free = F.filter(
        _placed(F.col("match"), F.col("gaps")),
        lambda t: ~F.exists("base", lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"])),
    )
    tokens = F.transform(
        free,
        lambda t: F.struct(
            t["start"].alias("start"),
            t["end"].alias("end"),
            _votes(t).alias("votes"),
            F.least(F.lit(LENGTHS - 1), F.floor(F.length(t["value"]) / 8).cast("int")).alias("size"),
        ),
    )
    return rows.withColumn("candidates", tokens).drop("match", "gaps", "base")


def _em(patterns: str) -> str:
    """SQL of the reliabilities (class x labeler x vote, flat) and the posterior of each pattern."""
    labelers = len(LABELERS)
    log_like = (
        "aggregate(sequence(0, {n}), ln(if({c} = 1, m.prior, 1 - m.prior)),"
        " (a, l) -> a + ln(m.theta[{c} * {cells} + l * {v} + x.votes[l]]))"
    )
    like = [log_like.format(n=labelers - 1, c=c, cells=CELLS, v=VOTES) for c in (0, 1)]
    posterior = f"transform({patterns}, x -> 1 / (1 + exp({like[0]} - {like[1]})))"
    # Votes start out as what they say: YES four times as likely on personal tokens.
    start = ",".join(
        str({(0, NO): 0.45, (0, NONE): 0.4, (0, YES): 0.15, (1, NO): 0.1, (1, NONE): 0.3, (1, YES): 0.6}[c, v]) + "D"
        for c in (0, 1)
        for _ in range(labelers)
        for v in range(VOTES)
    )
    weight = "if(i div {cells} = 1, q[k], 1 - q[k]) * {p}[k].n".format(cells=CELLS, p=patterns)
    part = f"""
        transform(sequence(0, {2 * CELLS - 1}), i ->
            (0.5D + aggregate(sequence(0, size({patterns}) - 1), 0D, (a, k) -> a +
                if({patterns}[k].votes[(i % {CELLS}) div {VOTES}] = i % {VOTES}, {weight}, 0D)))
            / (1.5D + aggregate(sequence(0, size({patterns}) - 1), 0D, (a, k) -> a + {weight})))
    """
    prior = f"""
        (1D + aggregate(sequence(0, size({patterns}) - 1), 0D, (a, k) -> a + q[k] * {patterns}[k].n))
        / (2D + aggregate({patterns}, 0D, (a, x) -> a + x.n))
    """
    rounds = f"""
        aggregate(sequence(1, {EM_ROUNDS}),
            named_struct('prior', 0.5D, 'theta', array({start})),
            (m, r) -> transform(array({posterior}), q -> named_struct('prior', {prior}, 'theta', {part}))[0])
    """
    return f"transform(array({rounds}), m -> named_struct('prior', m.prior, 'theta', m.theta, 'q', {posterior}))[0]"


def _logistic(patterns: str) -> str:
    """SQL of the classifier's weights: votes one by one, length classes, and the constant last."""
    size = CELLS + LENGTHS + 1
    z = (
        f"aggregate(sequence(0, {len(LABELERS) - 1}), w[{CELLS} + x.size] + w[{size - 1}],"
        f" (a, l) -> a + w[l * {VOTES} + x.votes[l]])"
    )
    active = (
        f"if(i < {CELLS}, {patterns}[k].votes[least(i, {CELLS - 1}) div {VOTES}] = i % {VOTES},"
        f" i = {size - 1} or {patterns}[k].size = i - {CELLS})"
    )
    errors = f"transform({patterns}, (x, k) -> (x.q - 1 / (1 + exp(-({z})))) * x.n / total)"
    return f"""
        aggregate(sequence(1, {FIT_ROUNDS}), array_repeat(0D, {size}),
            (w, r) -> transform(array({errors}), e -> transform(w, (v, i) -> v + {FIT_STEP}D * (
                aggregate(sequence(0, size({patterns}) - 1), 0D, (a, k) -> a + if({active}, e[k], 0D))
                - 0.001D * v)))[0])
    """


def fit(rows: DataFrame) -> tuple[dict, list[float]]:
    """(reliabilities, weights) from a column `candidates`. Without any token the weights are
    those of no evidence, and nothing is reported."""
    tokens = rows.select(F.explode("candidates").alias("t")).select("t.votes", "t.size")
    counted = checkpointed(tokens.groupBy("votes", "size").agg(F.count("*").cast("double").alias("n")))
    one = counted.agg(F.sort_array(F.collect_list(F.struct("votes", "size", "n"))).alias("p")).where("size(p) > 0")
    em = one.withColumn("m", F.expr(_em("p")))
    labelled = em.select(
        "m", F.expr("transform(p, (x, k) -> named_struct('votes', x.votes, 'size', x.size, 'n', x.n, 'q', m.q[k]))").alias("p"),
        F.expr("aggregate(p, 0D, (a, x) -> a + x.n)").alias("total"),
    )
    fitted = labelled.select("m.prior", "m.theta", F.expr(_logistic("p")).alias("w")).first()
    if fitted is None:
        return {}, [0.0] * (CELLS + LENGTHS) + [-1.0]
    theta = fitted["theta"]
    reliability = {
        name: {"yes_if_personal": theta[CELLS + i * VOTES + YES], "yes_if_not": theta[i * VOTES + YES]}
        for i, name in enumerate(LABELERS)
    }
    return {"prior": fitted["prior"], **reliability}, list(fitted["w"])


def _probability(token: Column, weights: list[float]) -> Column:
    w = F.array(*[F.lit(float(x)) for x in weights])
    z = F.get(w, token["size"] + CELLS) + F.lit(float(weights[-1]))
    for i in range(len(LABELERS)):
        z = z + F.get(w, F.get(token["votes"], F.lit(i)) + i * VOTES)
    return F.lit(1.0) / (1 + F.exp(-z))


def personal_data(docs: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """docs with a struct column `out`: per kind the spans (start, end), in code points, end exclusive;
    `secret` holds those of the span classifier, with their probability.

    A null or empty text has no spans. Matches of a kind do not overlap; kinds may. Tokens that
    overlap a span of the four kinds are no candidates. Rows that repeat count each when the models are
    fitted, and get equal results. All rows and columns stay; one named like `out` is replaced. No rows
    give no rows.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    rows = with_candidates(with_base_spans(rows))
    _, weights = fit(rows)

    def place(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))

    scored = F.transform(
        F.col("candidates"),
        lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), _probability(t, weights).alias("probability")),
    )
    found = F.struct(
        *[place(F.col(k)).alias(k) for k in KINDS],
        F.filter(scored, lambda s: s["probability"] >= 0.5).alias(SECRET),
    )
    columns = [F.col("row")[c].alias(c) for c in docs.columns if c != out]
    return rows.select(*columns, found.alias(out))


def span_text(pii: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans, by kind in the order given, then start, comma-joined."""

    def named(kind: str) -> Column:
        return F.transform(
            pii[kind], lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))
        )

    parts = [named(kind) for kind in kinds]
    return F.concat_ws(",", F.concat(*parts))
