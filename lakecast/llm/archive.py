"""Content-addressed WARC archive.

Payload bytes are stored once per SHA-256 digest, compressed; record headers are stored apart,
byte for byte; a join on the digest gives the original records back. Every payload is checked
against its digests whenever it is read, and two payloads under one digest stop the write.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecast.llm.common import kept

LEVEL = 3

# The digits of base 32 as `conv` writes them and as RFC 4648 does.
_CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_RFC_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@dataclass(frozen=True)
class Archive:
    """Where the two tables are, and the least payload size that revisits are made for."""

    path: str
    least_bytes: int = 0

    @property
    def payloads(self) -> str:
        return f"{self.path}/payloads"

    @property
    def headers(self) -> str:
        return f"{self.path}/headers"


def sha1_base32(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: 160 bits are four times ten hexadecimal digits, or eight of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), _CONV_DIGITS, _RFC_DIGITS)


def payload_of(html: Column) -> Column:
    """The page's UTF-8 bytes; a null page has an empty payload."""
    return F.coalesce(html.cast("string"), F.lit("")).cast("binary")


def write(pages: DataFrame, archive: Archive, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Writes a WARC record per row of ``pages``.

    Of the rows with equal payloads of at least ``least_bytes``, the one with the smallest key
    is the response, the others revisit it; all others are responses. A payload travels once to
    the task that stores it, compressed; copies are dropped by each task before the shuffle.

    Nulls: a null page is an empty payload, a null URL an empty target. Null keys come after all
    others and make records without an id of their own. Rows that repeat the smallest key are
    responses alike. Other columns are ignored. An empty table gives an empty archive.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"), payload_of(F.col(html)).alias("payload")
    )
    digests = (F.sha2("payload", 256).alias("digest"), F.length("payload").cast("long").alias("payload_bytes"), sha1_base32(F.col("payload")).alias("sha1"))
    known = kept(rows.select("page_id", "url", *digests))

    # A strong digest is trusted after its length and a second digest agree for all its rows.
    first = kept(
        known.groupBy("digest").agg(
            F.min("page_id").alias("first_id"),
            F.count(F.lit(1)).alias("rows"),
            F.min("payload_bytes").alias("low"), F.max("payload_bytes").alias("high"),
            F.min("sha1").alias("sha1_low"), F.max("sha1").alias("sha1_high"),
        )
    )
    if not first.where("low <> high OR sha1_low <> sha1_high").isEmpty():
        raise ValueError("two payloads share a SHA-256 digest")

    _store_payloads(rows.select(digests[0], "payload"), archive)

    revisits = (F.col("payload_bytes") >= archive.least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    records = known.join(first.select("digest", "first_id"), "digest").withColumn("revisit", revisits)
    records.select(
        "page_id", "digest", _header().cast("binary").alias("header")
    ).write.mode("overwrite").option("compression", "zstd").parquet(archive.headers)
    spark.catalog.refreshByPath(archive.path)


def _store_payloads(rows: DataFrame, archive: Archive) -> None:
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, seen = zstandard.ZstdCompressor(level=LEVEL), set()
        for batch in batches:
            new = []
            for i, digest in enumerate(batch.column(0).to_pylist()):
                # The set only spares the shuffle; it starts over to stay small.
                if digest not in seen:
                    seen = set() if len(seen) > 200_000 else seen
                    seen.add(digest)
                    new.append(i)
            digests, payloads = batch.column(0).take(pa.array(new, pa.int64())), batch.column(1)
            yield pa.RecordBatch.from_arrays(
                [digests, pa.array([press.compress(payloads[i].as_buffer()) for i in new], pa.binary())],
                names=["digest", "packed"],
            )

    once = rows.mapInArrow(packed, "digest string, packed binary").dropDuplicates(["digest"])
    # Already compressed.
    once.write.mode("overwrite").option("compression", "none").parquet(archive.payloads)


def _header() -> Column:
    """The record's exact header: block length 0 for revisits, whose payload is not repeated."""
    record_id = F.format_string("<urn:page:%s>", F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), record_id,
        F.lit("\r\nWARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", " "),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("sha1"),
        F.when(F.col("revisit"), F.format_string("\r\nWARC-Refers-To: <urn:page:%s>", F.col("first_id").cast("string"))).otherwise(""),
        F.lit("\r\nContent-Length: "), F.when(F.col("revisit"), "0").otherwise(F.col("payload_bytes").cast("string")),
        F.lit("\r\n\r\n"),
    )


def payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """``digest, payload, payload_bytes, sha1`` of the stored payloads, each checked against its digest."""

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            # A batch holds compressed bytes; unpacked ones leave in small pieces.
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                whole = [press.decompress(p.as_py()) for p in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(whole, pa.binary())], names=["digest", "payload"])

    stored = spark.read.schema("digest string, packed binary").parquet(archive.payloads).mapInArrow(unpacked, "digest string, payload binary")
    checked = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("digest")).otherwise(F.raise_error(F.lit("a stored payload does not match its digest")))
    return stored.select(checked.alias("digest"), "payload", F.length("payload").cast("long").alias("payload_bytes"), sha1_base32(F.col("payload")).alias("sha1"))


def _field(name: str) -> Column:
    found = F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def read(spark: SparkSession, archive: Archive) -> DataFrame:
    """The archive's records: fields of the header, the header and block bytes, the full payload.

    ``record`` is the original record: header, block, two line ends; ``payload`` is
    also there for revisits. Columns that are not selected do not travel through the join. A
    digest shared by very many records is split by the adaptive skew join.
    """
    headers = spark.read.schema("page_id long, digest string, header binary").parquet(archive.headers)
    fields = headers.select(
        "page_id",
        "digest",
        "header",
        _field("WARC-Type").alias("record_type"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("stated_digest"),
        F.regexp_extract(_field("WARC-Refers-To"), r"^<urn:page:(-?\d+)>$", 1).cast("long").alias("refers_to"),
    )
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    agrees = F.when(F.col("stated_digest") == F.col("sha1"), F.col("sha1")).otherwise(F.raise_error(F.lit("a record's digest does not match its payload")))
    return fields.join(payloads(spark, archive), "digest").select(
        "page_id",
        "record_type",
        "refers_to",
        "payload_bytes",
        agrees.alias("payload_digest"),
        "header",
        "payload",
        F.concat("header", block, F.lit(b"\r\n\r\n")).alias("record"),
    )
