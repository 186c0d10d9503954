"""Code tables: labels to ordinal codes and back.

One long table ``(column, label, code)`` holds the codes of every label column. Codes
are dense ranks of the distinct labels, null first. Keep the table with the model and extend
it: codes rebuilt from other data differ.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecast.session import cut_lineage, is_small

CODE_SCHEMA = "column string, label string, code bigint"

def distinct_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct ``(column, label)`` of all label columns from one scan.

    Labels are reduced inside each map task first, so a label that fills a third of the
    table costs one row per task.
    """
    pairs = F.array(
        *(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("label")) for c in columns)
    )
    return df.select(F.inline(pairs)).distinct()


def rank_labels_by_range(labels: DataFrame, partitions: int) -> DataFrame:
    """Dense rank per column, null first, however many labels there are.

    Distinct labels are range-partitioned, ranked inside each range, and shifted by the
    number of labels in the ranges before. The partitioned rows are checkpointed, so both
    uses see the same ranges.
    """
    ranged = cut_lineage(
        labels.repartitionByRange(partitions, "column", F.col("label").asc_nulls_first())
        .withColumn("range", F.spark_partition_id())
    )
    sizes = ranged.groupBy("column", "range").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("column").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        "column", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("column", "range").orderBy(F.col("label").asc_nulls_first())
    ranked = ranged.withColumn("rank", F.row_number().over(inside))
    code = (F.col("offset") + F.col("rank")).cast("bigint").alias("code")
    return ranked.join(offsets, ["column", "range"]).select("column", "label", code)


def build_code_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Codes of all ``columns``, computed once and checkpointed."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(rank_labels_by_range(distinct_labels(df, columns), ranges))


def extend_code_table(code_table: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``code_table`` with the labels of ``df`` that it lacks, numbered after each column's largest code.

    Codes that are there never change, so a saved model still reads the same series under them.
    """
    same = F.col("n.column").eqNullSafe(F.col("o.column")) & F.col("n.label").eqNullSafe(F.col("o.label"))
    new = distinct_labels(df, columns).alias("n").join(code_table.alias("o"), same, "left_anti")
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    largest = code_table.groupBy("column").agg(F.max("code").alias("largest"))
    numbered = rank_labels_by_range(new, ranges).join(largest, "column", "left")
    code = (F.col("code") + F.coalesce("largest", F.lit(0))).alias("code")
    return cut_lineage(code_table.select("column", "label", "code").unionByName(numbered.select("column", "label", code)))


def codes_of(code_table: DataFrame, column: str) -> DataFrame:
    """``column`` and ``<column>_index`` of one label column."""
    return code_table.where(F.col("column") == column).select(
        F.col("label").alias(column), F.col("code").alias(f"{column}_index")
    )


def codes_from_maps(spark, maps: Mapping[str, Mapping[int, str]]) -> DataFrame:
    """Code table from published code-to-label maps."""
    rows = [(c, label, code) for c, codes in maps.items() for code, label in codes.items()]
    return spark.createDataFrame(rows, CODE_SCHEMA)


def codes_from_table(df: DataFrame, column: str, label: str, index: str) -> DataFrame:
    """Code table from a two-column code file, to be unioned with others."""
    return df.select(
        F.lit(column).alias("column"), F.col(label).alias("label"), F.col(index).cast("bigint").alias("code")
    )


def encode(
    df: DataFrame, code_table: DataFrame, columns: Sequence[str], keep_labels: bool = True
) -> DataFrame:
    """Adds ``<column>_index`` for each label column; a null label finds the null label's code."""
    out, small = df, is_small(code_table)
    for column in columns:
        codes = codes_of(code_table, column).withColumnRenamed(column, "_label")
        same = F.col(column).cast("string").eqNullSafe(F.col("_label"))
        out = out.join(F.broadcast(codes) if small else codes, same, "left").drop("_label")
    return out if keep_labels else out.drop(*columns)


def decode_labels(
    df: DataFrame, code_table: DataFrame, columns: Sequence[str], keep_codes: bool = False
) -> DataFrame:
    """Adds the label of ``<column>_index``; an unknown code gives null."""
    out, small = df, is_small(code_table)
    for column in columns:
        index = f"{column}_index"
        codes = codes_of(code_table, column).withColumnRenamed(index, "_code")
        same = F.col(index) == F.col("_code")
        out = out.join(F.broadcast(codes) if small else codes, same, "left").drop("_code")
    return out if keep_codes else out.drop(*(f"{c}_index" for c in columns))


def decode_with_maps(
    df: DataFrame, maps: Mapping[str, Mapping[int, str]]
) -> DataFrame:
    """Adds labels by literal maps, for code sets of a few entries; no join at all."""
    labels = {}
    for column, codes in maps.items():
        pairs = [F.lit(x) for pair in codes.items() for x in pair]
        labels[column] = F.create_map(*pairs)[F.col(f"{column}_index").cast(T.IntegerType())]
    return df.withColumns(labels)


def code_listing(code_table: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Label and code of one column in code order."""
    listed = codes_of(code_table, column).orderBy(f"{column}_index")
    return listed if limit is None else listed.limit(limit)
