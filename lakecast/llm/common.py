"""What several corpus operators share: words, whole texts as bytes, kept tables, components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecast.session import cut_lineage, scratch_path

#: A word is a run of anything but ASCII white space; ``bytes.split()`` finds the same words in UTF-8.
WORD = r"[^\x20\x09-\x0D]+"

ARROW_BATCH_BYTES = 4 * 1024 * 1024


def prepare(spark: SparkSession) -> SparkSession:
    """Bounds an Arrow batch by bytes too, so that very long texts do not fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded(seed: int, *parts: Column) -> Column:
    """60 even bits from the parts' text forms, the same in every run; nulls count as empty."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *texts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def kept(df: DataFrame) -> DataFrame:
    """A small table computed once, in the shared folder (a reliable checkpoint)."""
    return cut_lineage(df)


def stored(df: DataFrame, name: str) -> DataFrame:
    """A large table computed once, as Parquet in the shared folder: columns and filters are pruned when it is read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    # Lets Spark drop the shuffle files that only the finished write needed.
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a ``stored`` table that nothing reads any more."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def byte_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def batches_of(rows: Iterator[tuple], schema: pa.Schema, n: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of at most ``n``."""
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) == n:
            yield _batch(block, schema)
            block = []
    if block:
        yield _batch(block, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of ``edges``: root is the smallest node reachable.

    Large-star and small-star rounds: each hangs neighbours on their smallest neighbour, so a
    component ends as a star after about the logarithm of its size in rounds. A round is joins
    and aggregates over the edges; a node with very many neighbours is split by the skew join.
    """
    edges = kept(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u <> v")
        .distinct()
    )
    before = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before or not state[0]:
            break
        before = state
        edges = kept(_small_star(_large_star(edges)))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select("v", "v").distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("low"))
    least = least.select("u", F.least("u", "low").alias("low"))
    return (
        both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("low"))
    moved = edges.join(least, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(least.select("u", F.col("low").alias("v"))).where("u <> v").distinct()
