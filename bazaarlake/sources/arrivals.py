"""The arrival ledger: which rows of an event feed have been delivered, and on which day.

A feed may be an increment, a full export that repeats every earlier row, or anything between, and a
row may come days after its event. So a row is new if its key has not arrived before, whatever its
date says. The ledger keeps each row once, under seen=<day of arrival>/dt=<day of the event>, and
beside it a digest per arrival and event day: the number of keys and two sums over their hashes.

A feed is compared day by day with the digests first. An event day whose digest is that of all
earlier arrivals holds nothing new: neither its rows nor its part of the ledger are looked at again,
which is nearly every day of a full export. Only the other days are joined with the ledger, by key.
A feed that repeats rows has another digest; its days are joined, and the join finds nothing new.

Rerunning a day replaces that day's arrivals and no others.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.functions.common import latest_per_key

KEY = "event_key"


def event_day(time: str) -> Column:
    """The yyyy-MM-dd day of a text time; NULL if it is none."""
    return F.date_format(F.col(time).try_cast("date"), "yyyy-MM-dd")


def keyed(feed: DataFrame) -> DataFrame:
    """The feed with its key: the id, or for rows that have none a digest of the whole row."""
    row = F.md5(F.to_json(F.struct(*[F.col(c) for c in feed.columns])))
    if "id" not in feed.columns:
        return feed.withColumn(KEY, row)
    return feed.withColumn(KEY, F.when(F.col("id") != "", F.col("id")).otherwise(row))


def _digest(rows: DataFrame) -> DataFrame:
    """Per event day the number of keys and sums over their hashes, in which the order of rows and
    the day of their arrival do not matter."""
    return rows.groupBy("dt").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64(KEY)).alias("folded"),
        F.sum(F.pmod(F.xxhash64(F.lit("sum"), F.col(KEY)), F.lit(1 << 31))).alias("summed"),
    )


class Ledger:
    """The arrivals of one feed under a folder."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark = spark
        self.path = path
        self.schema = schema

    def _read(self, path: str, schema: T.StructType) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).orc(path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def rows(self) -> DataFrame:
        """Every row that has arrived, with its key, event day dt and day of arrival seen."""
        fields = [*self.schema.fields, T.StructField(KEY, T.StringType())]
        days = [T.StructField("seen", T.StringType()), T.StructField("dt", T.StringType())]
        schema = T.StructType([*fields, *days])
        stored = self._read(self.path, schema)
        return self.spark.createDataFrame([], schema) if stored is None else stored

    def _digests(self, arrivals: Column) -> DataFrame | None:
        """Digests of some arrivals, None before the first."""
        schema = T.StructType.fromDDL("dt string, n long, folded long, summed long, seen string")
        stored = self._read(f"{self.path}_digest", schema)
        return None if stored is None else stored.where(arrivals)

    def started(self) -> bool:
        """Whether anything has arrived yet."""
        return self._digests(F.lit(True)) is not None

    def days_of(self, seen: str) -> set[str]:
        """The event days of the rows that arrived on a day."""
        stored = self._digests(F.col("seen") == seen)
        return set() if stored is None else {r["dt"] for r in stored.select("dt").collect()}

    def open_days(self, feed: DataFrame, seen: str) -> tuple[list[str], int]:
        """Event days on which a feed of keyed rows with dt may hold something new: their digest is not
        that of all arrivals on other days; and the number of rows without a day. One row per day comes
        to the driver."""
        before = {}
        stored = self._digests(F.col("seen") != seen)
        if stored is not None:
            known = stored.groupBy("dt").agg(
                F.sum("n").alias("n"), F.bit_xor("folded").alias("folded"), F.sum("summed").alias("summed")
            )
            before = {r["dt"]: (r["n"], r["folded"], r["summed"]) for r in known.collect()}
        now = {r["dt"]: (r["n"], r["folded"], r["summed"]) for r in _digest(feed).collect()}
        undated = now.pop(None, (0,))[0]
        return sorted(day for day, digest in now.items() if before.get(day) != digest), undated

    def _known(self, seen: str, days: Collection[str]) -> DataFrame:
        return self.rows().where((F.col("seen") != seen) & F.col("dt").isin(*days)).select("dt", KEY)

    def unseen(self, feed: DataFrame, seen: str, time: str) -> tuple[DataFrame, list[str], int]:
        """Rows of the feed that did not arrive on another day, one per id, with key and dt; the event
        days looked at; and the number of rows that have no day. Of rows without an id as many are new as
        the feed has more than the ledger."""
        dated = keyed(feed).withColumn("dt", event_day(time))
        days, undated = self.open_days(dated, seen)
        rows = dated.where(F.col("dt").isin(*days))
        if "id" in feed.columns:
            order = [c for c in ("operate_time", time) if c in feed.columns]
            newest = latest_per_key(rows, [KEY, "dt"], order)
            return newest.join(self._known(seen, days), ["dt", KEY], "left_anti").select(rows.columns), days, undated
        # Equal rows are told apart by their number.
        counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
        arrived = self._known(seen, days).groupBy("dt", KEY).agg(F.count(F.lit(1)).alias("arrived"))
        more = F.col("copies") - F.coalesce("arrived", F.lit(0))
        left = counted.join(arrived, ["dt", KEY], "left").withColumn("more", more).where("more > 0")
        return left.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "more"))).select(rows.columns), days, undated

    def record(self, feed: DataFrame, seen: str, time: str) -> list[str]:
        """Take the feed's new rows as arrivals of a day, in place of any earlier take of that day.
        Rows without a readable time have no day; they are kept apart, with the reason. Returns the event
        days whose arrivals of that day may have changed."""
        replaced = self.days_of(seen)
        new, days, undated = self.unseen(feed, seen, time)
        if undated or replaced:
            rejected = feed.where(event_day(time).isNull()).withColumn("reason", F.lit(f"{time} is no day"))
            rejected.write.mode("overwrite").orc(f"{self.path}_rejected/seen={seen}")
        if not days and not replaced:
            return []
        salt = F.pmod(F.xxhash64(KEY), F.lit(32))
        # Static: event days that the new take does not have go as well.
        writer = new.repartition("dt", salt).write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy("dt").orc(f"{self.path}/seen={seen}")
        stored = self.rows().where(F.col("seen") == seen)
        _digest(stored).coalesce(1).write.mode("overwrite").orc(f"{self.path}_digest/seen={seen}")
        return sorted(replaced | self.days_of(seen))
