"""The shared folder, cut lineage, and the word rules several operators have in common."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes that are no part of a word `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` become a space, A-Z a-z.
# Every byte of a character outside ASCII is above 0x7F and stays, so bytes do as well as characters.
ALNUM = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)

# Types of UDF results. DDL strings would need a session when the module is imported.
LONG, INT, DOUBLE, TEXT, BOOL = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# What a Python worker is handed at a time; Spark's defaults are 10,000 rows and 64 MB.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def small_batches(df: DataFrame) -> DataFrame:
    """The frame; its session hands texts to Python in batches whose memory is bounded. A worker
    holds several copies of a batch, and two workers and the JVM share an executor."""
    for key, value in BATCH.items():
        df.sparkSession.conf.set(key, value)
    return df


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or where it is unset (as in
    tests) a folder of the warehouse, which is shared as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame, computed and written once to the shared folder: lost executors cannot take
    it along. Spark removes the files of dropped frames under
    spark.cleaner.referenceTracking.cleanCheckpoints."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def as_bytes(texts: pa.Array) -> list[bytes | None]:
    """The UTF-8 of every text, without decoding."""
    return texts.cast(pa.binary()).to_pylist()


def space_words(text: bytes | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased."""
    return text.lower().split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`, A-Z lower-cased."""
    return text.translate(ALNUM).split() if text else []


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; rows without id are in fold 0 of nothing: null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def free_name(df: DataFrame, wanted: str) -> str:
    """wanted, with underscores in front until no column of df has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
