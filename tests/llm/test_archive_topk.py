"""WARC round trip and exact top-k against plain Python."""

import base64
import hashlib

import numpy as np
import pytest

from bazaarlake.llm import topk
from bazaarlake.llm.topk import top_k
from bazaarlake.llm.warc import page_records, read_archive, write_archive


def pages_frame(spark, data):
    return spark.createDataFrame(data, "page_id long, url string, html string").selectExpr("*", "'c' AS record_type")


def test_page_records(spark, rows):
    long = "<p>\n" * 50_000
    data = [(3, "u", "<a>"), (1, "u\r\nX: y", "<a>"), (2, None, "<a>"), (7, "u", None), (6, "u", ""), (9, "u", "é\0"), (4, "u", long)]
    data += [(9, "v", "é\0"), (None, "u", "<a>"), (None, "u", "only")]
    first = {"<a>": 1, "": 6, "é\0": 9, long: 4, "only": None}
    want = []
    for page, _, html in data:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        holder = first[html or ""]
        response = page == holder
        want.append((page, len(raw), digest, "response" if response else "revisit", None if response else holder))
    got = rows(page_records(pages_frame(spark, data)))
    assert got == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))
    assert page_records(pages_frame(spark, data).limit(0)).count() == 0


def test_records_come_back_byte_for_byte(spark, tmp_path):
    data = [(1, "http://a/", "<b>é</b>"), (2, "http://b/", "<b>é</b>"), (3, None, "tiny")]
    write_archive(pages_frame(spark, data), str(tmp_path / "w"), at_least=5)
    records = {r["id"]: r for r in read_archive(spark, str(tmp_path / "w")).collect()}
    one = bytes(records["1"]["record"])
    assert one.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and one.endswith("<b>é</b>\r\n\r\n".encode())
    assert b"Content-Length: 9\r\n" in one
    two = bytes(records["2"]["record"])
    assert b"WARC-Type: revisit" in two and b"Content-Length: 0" in two and two.endswith(b"\r\n\r\n\r\n\r\n")
    assert bytes(records["2"]["payload"]) == "<b>é</b>".encode() and records["2"]["refers_to"] == "1"
    assert records["3"]["record_type"] == "response" and records["3"]["url"] is None
    assert spark.read.parquet(str(tmp_path / "w" / "payloads")).count() == 2


def test_values_cannot_forge_header_lines(spark, tmp_path, rows):
    ends = ("\u2028", "\u2029", "\u0085", "\r\n", "\n", "\r", "\x0b", "\x0c")
    data = [(i, f"http://b{end}WARC-Page-ID: 99x{end}WARC-Type: revisit", "same" if i % 2 else f"p{i}") for i, end in enumerate(ends)]
    frame = pages_frame(spark, data)
    got = rows(page_records(frame), "page_id", "record_type", "refers_to")
    assert got == [(i, "revisit" if i in (3, 5, 7) else "response", 1 if i in (3, 5, 7) else None) for i in range(len(ends))]
    write_archive(frame, str(tmp_path / "w"))
    records = {r["id"]: r for r in read_archive(spark, str(tmp_path / "w")).collect()}
    for i, url, _ in data:
        r = records[str(i)]
        assert r["url"] == url and len(bytes(r["record"]).split(b"\r\n\r\n")[0].split(b"\r\n")) in (9, 11)
    texts = spark.createDataFrame([("a\nb", "u", "x"), ("a\u2028b", "u", "x"), ("a b", "u", "x")], "page_id string, url string, html string")
    assert rows(page_records(texts), "page_id", "refers_to") == [("a\nb", None), ("a b", "a\nb"), ("a\u2028b", "a\nb")]


def test_changed_payload_fails(spark, tmp_path):
    write_archive(pages_frame(spark, [(1, "u", "abc")]), str(tmp_path / "w"))
    spark.read.parquet(str(tmp_path / "w" / "payloads")).selectExpr("digest", "encode('abd', 'utf-8') AS payload").write.parquet(
        str(tmp_path / "x" / "payloads")
    )
    spark.read.parquet(str(tmp_path / "w" / "headers")).write.parquet(str(tmp_path / "x" / "headers"))
    with pytest.raises(Exception, match="differs"):
        read_archive(spark, str(tmp_path / "x")).collect()


def shuffled(spark):
    """Bytes of every shuffle file there is now, by name."""
    files = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles())
    return {f.getName(): f.length() for f in files if f.getName().endswith(".data")}


def test_the_read_shuffles_shared_payloads_alone(spark, tmp_path):
    """without copies no payload is shuffled when the archive is read; with copies, each once."""
    rng = np.random.default_rng(3)
    pages = [(i, f"u{i}", rng.bytes(10_000).hex()) for i in range(200)]
    copies = [(1000 + i, "c", pages[i % 20][2]) for i in range(100)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, data, most in (("single", pages, 300_000), ("copies", pages + copies, 900_000)):
            write_archive(pages_frame(spark, data).repartition(3), str(tmp_path / name))
            before = shuffled(spark)
            records = read_archive(spark, str(tmp_path / name))
            records.write.format("noop").mode("overwrite").save()
            assert 0 < sum(size for file, size in shuffled(spark).items() if file not in before) < most
            got = {int(r["id"]): (bytes(r["payload"]).decode(), r["refers_to"]) for r in records.collect()}
            assert got == {i: (html, str((i - 1000) % 20) if i >= 1000 else None) for i, _, html in data}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_repeated_rows_and_lost_payloads(spark, tmp_path, rows):
    data = [(1, "u", "a")] * 3 + [(1, "v", "a"), (1, None, "a"), (2, "u", "a"), (2, "u", "a"), (None, "u", "a"), (3, "w", "b")]
    data += [(None, None, "c")] * 2 + [(None, "x", "c")]
    write_archive(pages_frame(spark, data), str(tmp_path / "w"))
    got = rows(read_archive(spark, str(tmp_path / "w")).selectExpr("cast(id as long)", "url", "cast(payload as string)", "record_type", "refers_to"))
    want = [(*row, "revisit" if row[0] == 2 or row == (None, "u", "a") else "response") for row in data]
    want = [(*row, "1" if row[3] == "revisit" else None) for row in want]
    assert got == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))
    headers = spark.read.parquet(str(tmp_path / "w" / "headers"))
    assert headers.count() == len(data)
    headers.write.parquet(str(tmp_path / "x" / "headers"))
    spark.read.parquet(str(tmp_path / "w" / "payloads")).where("id = 1 OR id IS NULL").write.parquet(str(tmp_path / "x" / "payloads"))
    with pytest.raises(Exception, match="no payload"):
        read_archive(spark, str(tmp_path / "x")).collect()


def brute(vectors, queries, k):
    out = []
    whole = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole.setdefault(i, set()).add(tuple(int(np.floor(np.float64(x) * 256)) for x in v))
    for q in sorted(set(queries) & set(whole)):
        for qv in whole[q]:
            found = sorted({(-sum(a * b for a, b in zip(qv, v)), i) for i, vs in whole.items() if i != q for v in vs})
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return out


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_top_k(spark, rows, monkeypatch, scale):
    monkeypatch.setattr(topk, "QUERY_BLOCK_BYTES", 600)
    rng = np.random.default_rng(6)
    data = [(i, (rng.normal(size=10) * scale).round(2).tolist()) for i in range(120)]
    data += [(200 + i, data[i][1]) for i in range(20)] + [(3, data[3][1]), (300, None), (301, [None] * 10), (None, [1.0] * 10)]
    data += [(302, [float("nan")] * 10), (303, [float("inf")] * 10), (304, [0.0] * 10), (305, [])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score")
    got = rows(top_k(df, df.where("vec_id % 50 = 0")), "query_id", "rank", "vec_id", "score")
    want = brute(data, [i for i, _ in data if i is not None and i % 50 == 0], 5)
    assert got == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_top_k_of_few(spark, rows):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])], "vec_id long, embedding array<double>")
    assert rows(top_k(df, df.where("vec_id = 0"))) == [(0, 1, 1, 131072), (0, 2, 2, 131072)]
    assert top_k(df, df.limit(0)).count() == 0 and top_k(df.limit(0), df.limit(0)).count() == 0
    assert top_k(df.where("vec_id = 0"), df.where("vec_id = 0")).count() == 0
