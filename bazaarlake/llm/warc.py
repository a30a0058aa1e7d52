"""Content-addressed WARC archive.

write_archive keeps two tables in one folder: `payloads`, the bytes of every distinct payload once,
under its SHA-256 and beside the record that keeps it, and `headers`, the exact header bytes of every
record with the digest of its payload, and the ids and the URL as they were given. read_archive verifies
each stored payload against its digest, rebuilds the records and parses type and digest from their bytes.

All payload bytes are shuffled once, by record and not by digest, so a payload that a third of
all pages share is no hot key: which record keeps it is settled on (digest, id, url) alone. The read
takes a keeping record from the row of its payload; only payloads that several records share
are shuffled again, once each, to the headers of the others.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.llm.shared import BOOL, shared_folder, struct

# Digits of conv() in base 32, and the letters of RFC 4648 that stand for them.
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: 160 bits are four groups of 40, eight letters each."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), DIGITS, LETTERS)


def _line(name: str, value: Column) -> Column:
    """A header line, left out where the value is null. Carriage returns and line feeds within a
    value, which would end the line, are percent-encoded."""
    clean = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)), F.lit(""))


def _record_id(record: Column, digest: Column) -> Column:
    """A urn:uuid made of the record's id and payload, so that a rerun writes the same record."""
    h = F.md5(F.concat_ws("/", record.cast("string"), digest).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(response: Column, record: Column, holder: Column, digest: Column, payload: tuple[Column, Column], date: str) -> Column:
    """The header bytes of a record (id and url); payload is the size and the SHA-1 of its payload."""
    size, sha1 = payload
    lines = [
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(response, "response").otherwise("revisit")),
        _line("WARC-Record-ID", _record_id(record["id"], digest)),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", record["url"]),
        _line("WARC-Page-ID", record["id"]),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1)),
        _line("WARC-Refers-To", F.when(~response, _record_id(holder, digest))),
        _line("WARC-Refers-To-Page-ID", F.when(~response, holder)),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.when(response, size).otherwise(F.lit(0))),
        F.lit(CRLF),
    ]
    return F.concat(*lines).cast("binary")


def write_archive(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    at_least: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write one WARC record per row of pages into folder.

    The payload is the text in UTF-8; null is an empty payload. Of records with equal
    payloads of at_least bytes or more the one with the smallest id is a response and the others
    revisit it; smaller payloads are all responses. Rows that repeat both id and payload have the
    same type. A null id is larger than any other; where a payload has no other id, its
    records are responses. A null url leaves its header line out; ids and urls come back as they were,
    whatever they hold. Other columns are not read;
    without rows both tables are empty.
    """
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    # Null ids come last. Structs are equal where their nulls are.
    record = F.struct(F.col("id").isNull().alias("last"), "id", "url").alias("record")
    size, sha1 = F.octet_length("payload").cast("bigint"), base32_sha1(F.col("payload"))
    # Decided on narrow rows; repeated payloads are combined before they are shuffled.
    holders = rows.groupBy("digest").agg(F.min(record).alias("keeper"), F.count("*").alias("records"))
    narrow = rows.select(record, "digest", size.alias("size"), sha1.alias("sha1"))
    holder = F.col("keeper.id")
    response = F.col("record.id").eqNullSafe(holder) | (F.col("size") < at_least)
    header = _header(response, F.col("record"), holder, F.col("digest"), (F.col("size"), F.col("sha1")), date)
    narrow.join(holders, "digest").select(
        "record.id",
        "record.url",
        F.when(~response, holder).alias("refers_to"),
        "digest",
        (F.col("record") == F.col("keeper")).alias("kept"),
        header.alias("header"),
    ).write.mode("overwrite").parquet(f"{folder}/headers")
    # The record that keeps a payload: joined by digest, id and url, which no group of copies shares. Rows
    # that repeat all three are combined where the join has put them.
    once = (
        rows.select("digest", record, "payload")
        .join(holders.withColumnRenamed("keeper", "record"), ["digest", "record"])
        .groupBy("digest", "record")
        .agg(F.first("payload").alias("payload"), F.first("records").alias("records"), F.count("*").alias("copies"))
    )
    header = _header(F.lit(True), F.col("record"), F.lit(None), F.col("digest"), (size, sha1), date)
    once.select(
        "digest",
        "record.id",
        "record.url",
        header.alias("header"),
        "payload",
        (F.col("copies") > 1).alias("repeated"),
        (F.col("records") > 1).alias("shared"),
    ).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/payloads")


def _field(name: str) -> Column:
    """The value of a header line, null where there is none. (?d): only a line feed ends a line."""
    value = F.regexp_extract(F.col("head"), f"(?md)^{name}: ([^\r\n]*)", 1)
    return F.when(F.col("head").rlike(f"(?md)^{name}: "), value)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record as it was written: id, record (bytes), payload (full, for revisits as well),
    record_type, url, payload_digest, refers_to. A payload that does not have its digest fails the read."""
    headers = spark.read.parquet(f"{folder}/headers")
    beside = [headers.schema[name] for name in ("digest", "id", "url", "header")]
    extra = struct(payload=T.BinaryType(), repeated=BOOL, shared=BOOL)
    payloads = spark.read.schema(T.StructType(beside + extra.fields)).parquet(f"{folder}/payloads")
    verified = payloads.withColumn(
        "payload",
        F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
            F.raise_error(F.concat(F.lit("payload differs from its digest "), F.col("digest"))).cast("binary")
        ),
    )
    refers = headers.schema["refers_to"].dataType
    # The keeping records, from the rows of their payloads, but for those whose very row is repeated.
    single = ~F.coalesce("repeated", F.lit(False))
    kept = verified.where(single).withColumn("refers_to", F.lit(None).cast(refers))
    # The headers of all other records, joined to the payloads these share. A left join: a header whose
    # payload is gone fails as well, instead of dropping its record, also that of a keeping record.
    stored = verified.select(
        "digest", single.alias("single"), F.when(F.col("shared"), F.col("payload")).alias("payload")
    )
    others = (
        headers.join(stored, "digest", "left")
        .where(~(F.col("kept") & F.coalesce("single", F.lit(False))))
        .withColumn(
            "payload",
            F.coalesce("payload", F.raise_error(F.concat(F.lit("no payload "), F.col("digest"))).cast("binary")),
        )
    )
    columns = ["id", "url", "refers_to", "header", "payload"]
    joined = kept.select(*columns).union(others.select(*columns))
    parsed = joined.withColumn("head", F.col("header").cast("string"))
    body = F.when(_field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return parsed.select(
        F.col("id").cast("string").alias("id"),
        F.concat("header", body, F.lit(f"{CRLF}{CRLF}".encode())).alias("record"),
        "payload",
        _field("WARC-Type").alias("record_type"),
        "url",
        F.substring_index(_field("WARC-Payload-Digest"), "sha1:", -1).alias("payload_digest"),
        F.col("refers_to").cast("string").alias("refers_to"),
    )


def page_records(pages: DataFrame) -> DataFrame:
    """pages, archived in the shared folder and read back: page_id, payload_bytes,
    payload_digest, record_type, refers_to. The digest is taken anew from the joined payload."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(pages, folder)
    kind = pages.schema["page_id"].dataType
    return read_archive(spark, folder).select(
        F.col("id").cast(kind).alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
