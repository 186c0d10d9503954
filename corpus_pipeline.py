"""The corpus pipeline: language ID, line dedup, near-duplicate removal, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run`` writes as Parquet and reads
again as the next stage's input. All but the last return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecast.llm import jaccard, languages, mixing, packing, templates
from lakecast.llm.common import prepare
from lakecast.session import scratch_path
from lakecast.sources.tables import delete_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near duplicates share four fifths of their shingles of five words.
NEAR = jaccard.Join(words=5, percent=80)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those that none of the languages known, nor any mixture of them, explains.

    The model learns from the documents' own text and language. If no row has a language, nothing can
    be judged and all rows stay.
    """
    model = languages.train(docs)
    return languages.without_unidentified(docs, model) if model.names else docs


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines of templates that recur across documents, but for the first, and documents left without words."""
    cut = templates.drop_recurring(docs)
    return cut.where(~F.col(cut.columns[-1])).select(*(F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that links of near duplicates hold together."""
    return jaccard.one_of_each(docs, NEAR)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and samples documents until every source has its share of the mix."""
    return mixing.mixed(docs)


def token_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the mix into sequences of power-of-two lengths; ``ids`` are packed 32-bit numbers.

    Workers remember fewer words than they would alone: their executors still hold what the
    stages before left in memory.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), words_kept=100_000)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("token_packing", token_packing),
]

#: Language ID and packing have no form in SQL; the tests replay the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again in the shared folder.

    A stage's folder is deleted once the next one is written; the last one's is what the result reads.
    """
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            delete_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
