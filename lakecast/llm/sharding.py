"""Proportional stratified interleaving: shards that each hold the whole table's mixture.

Rows of a source are put in seeded order; a row's place in it, as a fraction, is its place in
the interleaved order, which is cut into shards of equal counts. Ranks within a source come from counts of
cells of its order, ranks in the whole order from counts of ranges of it, so neither a hot source nor very many
small ones, which all have the same places, nor the whole table is ever sorted in one task.
All expressions are built-in; only narrow rows are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakecast.llm.common import fresh, kept, seeded

CELLS = 4096
#: Rows of a range of the whole order, about.
RANGE_ROWS = 1 << 17
_HASH_BITS = 60
#: Bits of the number that ``monotonically_increasing_id`` gives a row within its partition.
_ROW_BITS = 33


def interleave(
    rows: DataFrame, shards: int, seed: int = 7, source: str = "source", key: str = "doc_id", cells: int = CELLS, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1), ``slot`` (gapless from 0) and ``draw``.

    ``rows`` should be narrow: all its columns travel through two shuffles. Counts of any two shards
    differ by one row at most. The rows of a source lie at even distances along the order, so that shards hold the mixture as long as
    sources have many rows; those of a single row all have their place in the middle.

    Nulls: a null source is a source of its own, a null key counts as empty. Ties in the draw are
    broken by the key, then by all other columns that can be ordered; rows alike in all of them
    are interchangeable. An empty table gives an empty result. Columns of ``rows`` named ``shard``, ``slot`` or ``draw``
    are replaced; all others stay, whatever their names.
    """
    rows = rows.drop("shard", "slot", "draw")
    cell, nth, place, row = (fresh(rows, name) for name in ("cell_", "nth_", "place_", "row_"))
    ties = [F.col(f"`{c}`") for c, kind in rows.dtypes if not kind.startswith(("map", "variant"))]
    shift = _HASH_BITS - cells.bit_length() + 1
    drawn = rows.withColumn("draw", seeded(seed, F.col(key), F.col(source)))
    placed = kept(drawn.withColumn(cell, F.shiftright("draw", shift)))

    # At most `cells` rows a source.
    counts = placed.groupBy(F.col(source).alias("of"), F.col(cell).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    per_source = Window.partitionBy("of")
    before = F.sum("n").over(per_source.orderBy("at")) - F.col("n")
    counts = counts.select("of", "at", before.alias("before"), F.sum("n").over(per_source).alias("total"))
    within = Window.partitionBy(source, cell).orderBy("draw", *ties)
    numbered = placed.withColumn(nth, F.row_number().over(within)).alias("r")
    ranked = numbered.join(
        counts.alias("c"), F.col(f"r.{source}").eqNullSafe(F.col("c.of")) & (F.col(f"r.{cell}") == F.col("c.at"))
    ).select("r.*", ((2 * (F.col("c.before") + F.col(f"r.{nth}")) - 1) / (2 * F.col("c.total"))).alias(place))
    ranked = ranked.drop(cell, nth)

    n = placed.count()
    order = [F.col(place), F.col(source).asc_nulls_last(), F.col("draw"), *ties]
    ranges = ranked.repartitionByRange(max(1, -(-n // range_rows)), *order).sortWithinPartitions(*order)
    ranges = kept(ranges.withColumn(row, F.monotonically_increasing_id()))
    # A row for each range.
    sizes = ranges.groupBy(F.shiftright(row, _ROW_BITS).alias("range")).agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("range", (F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("range")) - F.col("n")).alias("before"))
    at = F.col("o.before") + F.col(f"r.{row}").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    shard = F.expr(f"int(({shards} * {nth}) div {max(1, n)})")
    return (
        ranges.alias("r")
        .join(F.broadcast(offsets).alias("o"), F.shiftright(f"r.{row}", _ROW_BITS) == F.col("o.range"))
        .select("r.*", at.alias(nth))
        .withColumn("shard", shard)
        .withColumn("slot", F.expr(f"{nth} - (shard * {n} + {shards} - 1) div {shards}"))
        .drop(nth, place, row)
    )
