"""Queries that SQL can express, against their SQL on the sample tables."""

import os

import pytest

from bazaarlake.llm.queries import ORACLE, QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="sample tables not present")


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    duck = pytest.importorskip("duckdb").connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    result = duck.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    key = lambda r: tuple((v is None, str(v)) for v in r)
    want = sorted((tuple(r) for r in result.fetchall()), key=key)
    df = QUERIES[name](spark, DIR)
    assert sorted(df.columns) == sorted(columns)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=key) == want


@pytest.mark.parametrize("name", ["op5_mix", "op5_mix_weighted"])
def test_mix_of_unequal_sources(spark, name, tmp_path):
    duck = pytest.importorskip("duckdb").connect()
    sizes = {"large": 3000, "a": 1200, "b": 700, None: 90, "": 5, "one": 1}
    data = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    spark.createDataFrame(data, "doc_id long, source string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = duck.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    key = lambda r: tuple((v is None, str(v)) for v in r)
    got = [tuple(r) for r in QUERIES[name](spark, str(tmp_path)).select(*columns).collect()]
    assert sorted(got, key=key) == sorted((tuple(r) for r in result.fetchall()), key=key)
    kept = sum(r[columns.index("in_mix")] for r in got)
    assert kept == len(data) if name == "op5_mix" else 0 < kept < len(data)


def test_other_queries_return_a_row_per_document(spark):
    documents = spark.read.parquet(f"{DIR}/documents.parquet").count()
    for name in set(QUERIES) - set(ORACLE) - {"op12_pack"}:  # a row per piece
        assert QUERIES[name](spark, DIR).count() == documents, name
