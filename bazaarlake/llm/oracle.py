"""SQL of the queries that SQL can express, for DuckDB over the same tables, from their definitions."""

from __future__ import annotations

# A-Z lower-cased; letters beyond ASCII stay as they are.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"
_ALNUM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

def _mix_sql(quotas: str) -> str:
    """quotas is SQL from c (source, n) to (source, quota). The schedule of a round is found slot by
    slot: of the lanes whose next block is released, the earliest deadline. Of a shared lane only rows
    within the quota of their own source are in the mix; what no lane takes is numbered together."""
    return f"""
        WITH RECURSIVE c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        q AS ({quotas}),
        m AS (SELECT CAST(sum(quota) AS BIGINT) AS size FROM q),
        own AS (SELECT source, row_number() OVER (ORDER BY quota DESC, source NULLS FIRST) AS lane
                FROM q, m WHERE quota * 1024 >= size),
        named AS (SELECT q.source, quota, CASE WHEN quota > 0 THEN coalesce(lane, 0) ELSE -1 END AS lane
                  FROM q LEFT JOIN own ON q.source IS NOT DISTINCT FROM own.source),
        l AS (SELECT lane, CAST(sum(quota) AS BIGINT) AS quota FROM named WHERE quota > 0 GROUP BY lane),
        l1 AS (SELECT lane, quota, quota * 1024 / size AS exact, greatest(1, CAST(floor(quota * 1024 / size) AS BIGINT)) AS low FROM l, m),
        l2 AS (SELECT *, 1024 - sum(low) OVER () AS missing, row_number() OVER (ORDER BY exact - low DESC, lane) AS turn FROM l1),
        lanes AS (SELECT lane, quota, low + CASE WHEN turn <= missing THEN 1 ELSE 0 END AS c FROM l2),
        one AS (SELECT list(lane ORDER BY lane) AS lane, list(c ORDER BY lane) AS c FROM lanes),
        edf(t, done, pick) AS (
          SELECT 0, list_transform(c, lambda x: CAST(0 AS BIGINT)), CAST(NULL AS BIGINT) FROM one
          UNION ALL
          SELECT t + 1, list_transform(done, lambda x, i: CASE WHEN i = p THEN x + 1 ELSE x END), p
          FROM (SELECT t, done, list_min(list_transform(range(1, len(c) + 1), lambda i:
                  CASE WHEN done[i] < c[i] AND done[i] * 1024 // c[i] <= t
                       THEN CAST(ceil((done[i] + 1) * 1024 / c[i]) AS BIGINT) * 4096 + i END)) % 4096 AS p
                FROM edf, one WHERE t < 1024)),
        s AS (SELECT lane[pick] AS lane, t - 1 AS slot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS j
              FROM edf, one WHERE pick IS NOT NULL),
        o AS (SELECT doc_id, d.source, lane, quota, md5(CAST(doc_id AS VARCHAR)) AS h,
                     row_number() OVER (PARTITION BY d.source ORDER BY md5(CAST(doc_id AS VARCHAR))) AS own
              FROM documents d JOIN named ON d.source IS NOT DISTINCT FROM named.source),
        k AS (SELECT doc_id, source, h, CASE WHEN lane = 0 AND own > quota THEN -1 ELSE lane END AS lane FROM o),
        d AS (SELECT doc_id, source, lane, row_number() OVER (PARTITION BY lane ORDER BY h) - 1 AS position FROM k),
        b AS (SELECT doc_id, source, d.lane, position, position < coalesce(quota, 0) AS in_mix, c,
                     CASE WHEN position < quota
                          THEN position * greatest(1, CAST(ceil(size / 65536) AS BIGINT)) * c // quota END AS block
              FROM d JOIN m ON true LEFT JOIN lanes ON d.lane = lanes.lane)
        SELECT doc_id, source, position, in_mix, block,
               block // c * 1024 + block % c * 1024 // c AS "release",
               block // c * 1024 + CAST(ceil((block % c + 1) * 1024 / c) AS BIGINT) AS deadline,
               block // c * 1024 + slot AS slot
        FROM b LEFT JOIN s ON b.lane = s.lane AND block % c = s.j"""


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Every part against every entry, round by round; a mean is the sum without its remainder, divided."""
    usable = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    steps = [
        f"""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS HUGEINT)) AS v
            FROM embeddings WHERE {usable}),
        x AS (SELECT vec_id, label, i AS part, v[i * (len(v) // {parts}) + 1:(i + 1) * (len(v) // {parts})] AS x
              FROM v, range({parts}) AS t(i)),
        o AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v QUALIFY entry < {entries}),
        b0 AS (SELECT part, entry, x AS e FROM x JOIN o USING (vec_id))"""
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""d{r} AS (SELECT vec_id, label, x.part, entry, x,
                   list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - e[i]) * (x[i] - e[i]))) AS d
                 FROM x JOIN b{r} ON x.part = b{r}.part),
            a{r} AS (SELECT * FROM d{r} QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1)"""
        )
        if r < rounds:
            steps.append(
                f"""s{r} AS (SELECT part, entry, pos, sum(y) AS s, count(*) AS n
                     FROM (SELECT part, entry, unnest(range(1, len(x) + 1)) AS pos, unnest(x) AS y FROM a{r}) GROUP BY ALL),
                u{r} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS e FROM s{r} GROUP BY ALL),
                b{r + 1} AS (SELECT part, entry, coalesce(u{r}.e, b{r}.e) AS e FROM b{r} LEFT JOIN u{r} USING (part, entry))"""
            )
    steps.append(
        f"""c AS (SELECT vec_id, any_value(label) AS label, CAST(sum(d) AS BIGINT) AS error,
                   string_agg(lower(printf('%02x', CAST(entry AS INT))), '' ORDER BY part) AS code FROM a{rounds} GROUP BY vec_id),
        h AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM c, h"""
    )
    return ",\n".join(steps[:-1]) + ",\n" + steps[-1]


ORACLE: dict[str, str] = {
    "op11_codes": _codes_sql(),
    "op13_phrases": rf"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
        w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
        g AS (SELECT lang, w[i:i + k - 1] AS g, count(*) AS a
              FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 4) AS t(k)) GROUP BY ALL),
        n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM g WHERE len(g) = 1 GROUP BY lang),
        c AS (SELECT * FROM g WHERE len(g) > 1 AND a >= 10),
        cut AS (SELECT c.lang, c.g, c.a, k, x.a AS l, y.a AS r,
                       CAST(1000000 * c.a::HUGEINT * c.a // (x.a::HUGEINT * y.a) AS BIGINT) AS score
                FROM (SELECT *, unnest(range(1, len(g))) AS k FROM c) c
                JOIN g x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN g y ON y.lang = c.lang AND y.g = c.g[k + 1:]),
        low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
        longer AS (SELECT lang, g, max(a) AS a FROM (SELECT lang, unnest([g[1:2], g[2:3]]) AS g, a FROM c WHERE len(g) = 3) GROUP BY ALL),
        kept AS (SELECT low.* FROM low LEFT JOIN longer s ON s.lang = low.lang AND s.g = low.g
                 WHERE s.a IS NULL OR 100 * s.a < 50 * low.a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS "rank", phrase, a, l, r, n, score
        FROM (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM kept) JOIN n USING (lang)
        QUALIFY "rank" <= 2000""",
    # Every shared shingle links two documents; classes by following all links.
    "op1_minhash": f"""
        WITH RECURSIVE w AS (SELECT doc_id, {_SPACE_WORDS} AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(
                CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                     ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g)
              WHERE x.doc_id < y.doc_id GROUP BY 1, 2),
        e AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
              WHERE 100 * c >= 75 * (x.n + y.n - c)),
        both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
        r(doc_id, reached) AS (SELECT doc_id, doc_id FROM documents
              UNION SELECT r.doc_id, b FROM r JOIN both_ways ON r.reached = a),
        m AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY 1)
        SELECT m.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, m.doc_id = component_id AS kept
        FROM m LEFT JOIN n USING (doc_id)""",
    "op2_decontaminate": f"""
        WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM_WORDS} AS w FROM benchmark),
        win AS (SELECT DISTINCT item, unnest(
                  CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [w]
                       ELSE list_transform(range(1, len(w) - 8), lambda k: w[k:k + 9]) END) AS g FROM i),
        sizes AS (SELECT DISTINCT len(g) AS size FROM win),
        d AS (SELECT doc_id, {_ALNUM_WORDS} AS w FROM documents),
        spot AS (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS k, w FROM d, sizes),
        hit AS (SELECT doc_id, size, k, item FROM spot JOIN win ON w[k:k + size - 1] = g),
        places AS (SELECT DISTINCT doc_id, unnest(range(k, k + size)) AS place FROM hit),
        n AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY 1),
        f AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN f USING (doc_id)""",
    # Base 32: 32 letters of five bits, read from four numbers of ten hex digits.
    "op3_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        f AS (SELECT html, min(page_id) AS holder FROM p GROUP BY html),
        h AS (SELECT page_id, holder, html, sha1(html) AS h FROM p JOIN f USING (html))
        SELECT page_id, octet_length(encode(html)) AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST((CAST('0x' || substr(h, 1 + 10 * (j // 8), 10) AS BIGINT) >> CAST(35 - 5 * (j % 8) AS BIGINT)) & 31 AS BIGINT) + 1, 1)), '')
                 AS payload_digest,
               CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> holder THEN holder END AS refers_to
        FROM h""",
    "op4_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v FROM embeddings
                   WHERE embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.v, v.v) AS BIGINT) AS score
              FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS "rank",
               vec_id, score FROM s
        QUALIFY "rank" <= 5""",
    "op5_mix": _mix_sql("SELECT source, n AS quota FROM c"),
    # The largest mix in which every source has a share like the root of its rows.
    "op5_mix_weighted": _mix_sql("""SELECT source, CAST(least(n, round(sqrt(n) * u)) AS BIGINT) AS quota
            FROM c, (SELECT min(n / sqrt(n)) AS u FROM c)"""),
}
