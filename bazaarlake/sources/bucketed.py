"""Tables bucketed by a key, one per day, that join by the key without being shuffled.

Spark keeps bucket specs in its catalog only. So that any session can read the files, the number of
buckets is in the folder's name, and a table is put into the session's catalog when it is needed,
under a name made of its folder. Dropping such a table leaves its files alone.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession


def _name(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"


def _folder(table_path: str, dt: str, buckets: int) -> str:
    return f"{table_path}/dt={dt}/buckets={buckets}"


def stored_buckets(spark: SparkSession, table_path: str, dt: str) -> int | None:
    """The number of buckets of a day's table, None if there is no such day. Lists one folder."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{table_path}/dt={dt}/buckets=*/_SUCCESS")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = [s.getPath().getParent().getName() for s in pattern.getFileSystem(conf).globStatus(pattern) or []]
    return int(found[0].split("=", 1)[1]) if found else None


def write_bucketed(df: DataFrame, table_path: str, dt: str, key: str, buckets: int, append: bool = False) -> None:
    """Write a day's table, or add to it. Rows that already are partitioned by the key into as many
    partitions, as after a join with such a table, are not shuffled; others are, by Spark's bucketing
    hash, so that a bucket is one file."""
    path = _folder(table_path, dt, buckets)
    name = _name(path)
    spark = df.sparkSession
    if append:
        _attach(spark, path, key, buckets)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.write.mode("append" if append else "overwrite").format("orc").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def _attach(spark: SparkSession, path: str, key: str, buckets: int) -> str:
    name = _name(path)
    if not spark.catalog.tableExists(name):
        fields = spark.read.orc(path).schema.fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING orc CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return name


def read_bucketed(spark: SparkSession, table_path: str, dt: str, key: str) -> DataFrame | None:
    """A day's table, None if there is no such day."""
    buckets = stored_buckets(spark, table_path, dt)
    if buckets is None:
        return None
    name = _attach(spark, _folder(table_path, dt, buckets), key, buckets)
    spark.catalog.refreshTable(name)
    return spark.table(name)
