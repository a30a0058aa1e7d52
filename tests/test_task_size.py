"""What one task holds does not grow with the order lines: the number of shuffle partitions does."""

import math
from contextlib import contextmanager

import pytest

from bazaarlake import session
from bazaarlake.plans.catalog import QUERIES

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

NAMED = (
    "dws_sku_day", "dws_sku_stats", "dws_user_action_order_stats", "dws_activity_day", "dws_category3_day",
    "ads_sku_repurchase_analysis", "dws_category_stats", "dws_trademark_day", "dws_trademark_stats",
)


@contextmanager
def settings(spark, **given):
    try:
        for key, value in given.items():
            spark.conf.set({"initial": INITIAL, "advisory": ADVISORY}[key], value)
        yield lambda: (spark.conf.get(INITIAL, None), spark.conf.get(ADVISORY))
    finally:
        spark.conf.unset(INITIAL)
        spark.conf.unset(ADVISORY)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    tables = {
        "customer": ("id AS c_custkey, 'n' AS c_name, 1 AS c_nationkey, 0D AS c_acctbal, 'm' AS c_mktsegment", 5),
        "part": ("id AS p_partkey, 'p' AS p_name, concat('b', id % 3) AS p_brand, 't' AS p_type, cast(id AS int) AS p_size, 1D AS p_retailprice", 20),
        "orders": ("id AS o_orderkey, id % 5 AS o_custkey, 'F' AS o_orderstatus, 1D AS o_totalprice, timestamp_ntz'2000-12-01 00:00:00' AS o_orderdate, '1-URGENT' AS o_orderpriority", 30),
        "lineitem": (
            "id div 4 AS l_orderkey, id % 20 AS l_partkey, 1L AS l_suppkey, cast(id % 4 AS int) AS l_linenumber, 2D AS l_quantity, 10D AS l_extendedprice,"
            " 0.05D AS l_discount, 0.01D AS l_tax, if(id % 3 = 0, 'R', 'N') AS l_returnflag, 'F' AS l_linestatus, timestamp_ntz'2000-12-09 00:00:00' AS l_shipdate",
            120,
        ),
        "events": ("""id AS event_id, timestamp_ntz'2024-01-02 00:00:00' AS ts, id % 5 AS user_id, 'view' AS event_type, 1D AS value, '{"k": 3}' AS props""", 10),
    }
    for name, (columns, n) in tables.items():
        spark.sql(f"SELECT {columns} FROM range({n})").write.parquet(f"{path}/{name}.parquet")
    return path


def test_partitions_follow_the_rows(spark):
    with settings(spark) as now:
        before = now()
        session.bound_tasks(spark, session.TASK_ROWS)
        assert now() == before
        session.bound_tasks(spark, 40 * session.TASK_ROWS + 1)
        assert now() == ("41", str(session.TASK_BYTES))
        session.bound_tasks(spark, 2 * session.TASK_ROWS)
        assert now()[0] == "41"
    for given, bytes_ in (("1m", "1m"), ("512KB", "512KB"), ("64MB", str(session.TASK_BYTES)), ("1g", str(session.TASK_BYTES))):
        with settings(spark, initial="300", advisory=given) as now:
            session.bound_tasks(spark, 100 * session.TASK_ROWS)
            assert now() == ("300", bytes_)


@pytest.mark.parametrize("name", NAMED)
def test_queries_over_order_lines(spark, sf_dir, rows, name, monkeypatch):
    with settings(spark) as now:
        want = rows(QUERIES[name](spark, sf_dir))
        assert now()[0] is None
        monkeypatch.setattr(session, "TASK_ROWS", 10)
        got = QUERIES[name](spark, sf_dir)
        assert now()[0] == str(math.ceil(120 / 10))
        assert want and rows(got) == want
