"""The operators as queries over the driver's tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecast.llm import archive, jaccard, languages, lexical, minhash, mixing, negatives, neighbours, outliers, packing, sharding, templates, topk
from lakecast.llm import sql
from lakecast.llm.blocks import quantised
from lakecast.llm.common import table
from lakecast.session import scratch_path


def _remainder(column: str, modulus: int) -> Column:
    """CRC-32 of a key as text, modulo a number; a null key counts as empty."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def op1_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = outliers.judge(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.repetitions(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = archive.Archive(scratch_path(spark, "warc"), least_bytes=0)
    archive.write(table(spark, sf_dir, "pages"), store)
    return archive.read(spark, store).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = _remainder("doc_id", 4) == 2
    model = languages.train(docs.where(~held_out))
    return languages.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score")
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return templates.drop_recurring(docs).select("doc_id", "text", "lines_dropped", "emptied")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    held_out = _remainder("doc_id", 3) == 1
    model = neighbours.fit(docs, labels.where(~held_out))
    return neighbours.scored(docs, model).select(
        "doc_id", held_out.alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted")
    )


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.linked(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumnRenamed("component", "component_id")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return sharding.interleave(rows, shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = quantised(table(spark, sf_dir, "embeddings"), 256.0, label=label)
    return negatives.hard_negatives(vectors, vectors.where("vec_id % 100 = 0"), positives=5, negatives=5, low=80)


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumnRenamed("component", "component_id")


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return lexical.search(docs, items, lexical.Ranking(k=50))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_outliers": op1_outliers,
    "op2_topk": op2_topk,
    "op3_packing": op3_packing,
    "op4_mixing": op4_mixing,
    "op5_warc": op5_warc,
    "op6_languages": op6_languages,
    "op7_line_dedup": op7_line_dedup,
    "op8_neighbours": op8_neighbours,
    "op9_jaccard": op9_jaccard,
    "op10_sharding": op10_sharding,
    "op11_negatives": op11_negatives,
    "op12_minhash": op12_minhash,
    "op13_lexical": op13_lexical,
}

ORACLES: dict[str, str] = {
    "op2_topk": sql.OP2,
    "op4_mixing": sql.OP4,
    "op5_warc": sql.OP5,
    "op10_sharding": sql.OP10,
    "op11_negatives": sql.OP11,
    "op12_minhash": sql.OP12,
    "op13_lexical": sql.OP13,
}
