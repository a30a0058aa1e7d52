import math
import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from bazaarlake.plans.catalog import QUERIES
from bazaarlake.plans.oracle import ORACLE

DIR = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
SAMPLE = (
    "dim_user_zip_update", "dwd_order_info", "dws_sku_stats", "dws_page_view_day", "ads_gmv_day",
    "ads_sku_sales_rank", "ads_sku_repurchase_analysis", "ads_dashboard", "log_clean_repair",
    "common_trigrams", "order_amount_summary",
)
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="sample tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return connection


def normal(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda t: tuple((v is None, str(v)) for v in t)
    clean = [tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in data]
    return sorted(columns), sorted(clean, key=key)


def test_every_query_has_its_sql():
    """All of the warehouse; of other queries those that SQL can express."""
    assert set(QUERIES) == set(ORACLE) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, DIR)
    result = duck.execute(oracle_sql()[name])
    expected = normal([d[0] for d in result.description], result.fetchall())
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == expected
