"""Mixing sources to target weights: capped water-filling and seeded repetitions.

All expressions are built-in. Only per-source and per-cell totals are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecast.llm.common import fresh, kept, seeded, word_count
from lakecast.session import broadcast_if_small

#: Seeded order of a source is cut into this many cells; only the cell at the cut is sorted.
CELLS = 4096
_HASH_BITS = 60


@dataclass(frozen=True)
class Mix:
    """``weights`` repeat over the sources in code-point order, null last; the mix is ``share`` of
    all sizes; no source is taken more than ``epochs`` times; ``runs`` of seeded sampling fill the last fraction."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    epochs: float = 2.0
    seed: int = 7
    runs: int = 3


def ordered_sources(sizes: DataFrame) -> DataFrame:
    """``source, source_size, place`` (from 0, by code point, null last), ranked by ranges:
    no task sees all sources."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranged = kept(
        totals.withColumn("last", F.col("source").isNull().cast("int"))
        .repartitionByRange("last", "source")
        .withColumn("part", F.spark_partition_id())
    )
    inner = Window.partitionBy("part").orderBy("last", "source")
    ranked = ranged.withColumn("nth", F.row_number().over(inner))
    # One row per range, so a single ordered window over them is small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("skip"))
    )
    return ranked.join(F.broadcast(offsets), "part").select(
        "source", "source_size", (F.col("skip") + F.col("nth") - 1).alias("place")
    )


def water_fill(sources: DataFrame, mix: Mix) -> DataFrame:
    """``source, source_size, target``: clamp what exceeds its cap, share the rest by weight, repeat.

    A round is one aggregate of two numbers over the open sources. ``sources`` is
    ``ordered_sources``; a table without words has targets of 0.
    """
    weight = F.element_at(F.array(*map(F.lit, mix.weights)), (F.col("place") % len(mix.weights) + 1).cast("int"))
    open_ = kept(sources.select("source", "source_size", weight.alias("weight")))
    cap = F.col("source_size") * F.lit(float(mix.epochs))
    total = open_.agg(F.sum("source_size")).first()[0] or 0
    want, level = mix.share * total, None
    while True:
        # Sources clamped so far are those whose cap lies below the level.
        clamped = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        full, weights = open_.agg(F.sum(F.when(clamped, cap)), F.sum(F.when(~clamped, F.col("weight")))).first()
        if not weights:
            break
        higher = (want - (full or 0.0)) / weights
        if higher == level:
            break
        level = higher
    target = F.least(cap, F.col("weight") * F.lit(float(level or 0.0)))
    return open_.select("source", "source_size", target.alias("target"))


def repetitions(docs: DataFrame, mix: Mix = Mix(), text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``times``: how often the mix takes the row.

    A source's rows are taken ``floor(target / size)`` times as a whole. The fraction left is
    sampled in seeded order: a run of rows as long as their words fit, then a run over the later
    rows that still fit, and so on for ``mix.runs``; the last run ends where it comes nearest to
    the target. So a long row at the end of a run does not leave a source far off.

    Nulls: a null text has size 0, a null source is a source of its own, a null key counts as
    empty. Rows alike in key and text are taken alike. Very long texts are rows like others. An
    empty table gives an empty result. A source of size 0 has target 0. Added columns get a
    trailing underscore where ``docs`` uses the name.
    """
    names = {n: fresh(docs, n) for n in ("size", "source_size", "target", "times")}
    draw, group = fresh(docs, "draw_"), fresh(docs, "group_")
    sized = docs.withColumns(
        {
            names["size"]: word_count(F.col(text)),
            draw: seeded(mix.seed, F.col(key), F.col(text)),
            group: _null_safe(source),
        }
    )
    narrow = kept(sized.select(F.col(source).alias("source"), F.col(names["size"]).alias("size"), F.col(draw).alias("draw")))
    plan = _runs(narrow, kept(water_fill(ordered_sources(narrow), mix)), mix.runs).select(
        _null_safe("source").alias("group_p"), "source_size", "target", "whole", "runs"
    )
    size, place = F.col(f"d.{names['size']}"), F.col(f"d.{draw}")
    in_run = F.exists("p.runs", lambda r: (place > r["after"]) & (place <= r["upto"]) & (size <= r["fits"]))
    return (
        sized.alias("d")
        .join(broadcast_if_small(kept(plan)).alias("p"), F.col(f"d.{group}") == F.col("p.group_p"))
        .select(
            *(F.col(f"d.`{c}`") for c in docs.columns),
            size,
            F.col("p.source_size").alias(names["source_size"]),
            F.col("p.target").alias(names["target"]),
            (F.col("p.whole") + in_run.cast("long")).alias(names["times"]),
        )
    )


def _null_safe(source: str) -> Column:
    name = F.col(f"`{source}`")
    return F.struct(name.isNull().alias("none"), F.coalesce(name.cast("string"), F.lit("")).alias("name"))


def _cell(draw: Column) -> Column:
    return F.shiftright(draw, _HASH_BITS - CELLS.bit_length() + 1)


def _runs(rows: DataFrame, targets: DataFrame, n: int) -> DataFrame:
    """``whole`` passes per source, and ``runs``: rows with a draw after ``after``, up to ``upto``
    and of at most ``fits`` words are taken once more.

    Cells of the seeded order are totalled first; only the cell where a run ends is sorted, one
    of 4096 of the source.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = targets.select(
        "source",
        "source_size",
        "target",
        whole.alias("whole"),
        (F.col("target") - whole * F.col("source_size")).alias("rest"),
        F.lit(-1).cast("long").alias("after"),
        F.expr("array_repeat(named_struct('after', 0L, 'upto', 0L, 'fits', 0D), 0)").alias("runs"),
    )
    for k in range(n):
        state = kept(_next_run(rows, state, last=k == n - 1))
    return state


def _next_run(rows: DataFrame, state: DataFrame, last: bool) -> DataFrame:
    first = F.size("runs") == 0
    fits = F.when(first, F.lit(float("inf"))).otherwise(F.col("rest"))
    open_ = state.select(F.col("source").alias("s"), "rest", "after", fits.alias("fits")).where("rest > 0")
    left = rows.join(
        broadcast_if_small(open_), F.col("source").eqNullSafe(F.col("s")) & (F.col("draw") > F.col("after")) & (F.col("size") <= F.col("fits"))
    )
    cells = left.groupBy("source", _cell(F.col("draw")).alias("cell"), "rest").agg(F.sum("size").alias("words"))
    # At most CELLS rows a source.
    upto = Window.partitionBy("source").orderBy("cell")
    cells = kept(cells.withColumn("before", F.sum("words").over(upto) - F.col("words")))
    edge = cells.where("before <= rest AND before + words > rest").select(
        F.col("source").alias("e"), F.col("cell").alias("at"), "before"
    )
    inside = Window.partitionBy("source").orderBy("draw")
    sums = (
        left.join(broadcast_if_small(edge), F.col("source").eqNullSafe(F.col("e")) & (_cell(F.col("draw")) == F.col("at")))
        .groupBy("source", "draw", "rest", "before")
        .agg(F.sum("size").alias("words"))
        .withColumn("upto", F.col("before") + F.sum("words").over(inside))
    )
    inner = F.col("upto") - F.col("words") / 2 if last else F.col("upto")
    ends = sums.where(inner <= F.col("rest")).groupBy("source").agg(F.max("draw").alias("end"), F.max("upto").alias("taken"))
    cell_start = F.shiftleft(F.col("at").cast("long"), _HASH_BITS - CELLS.bit_length() + 1) - 1
    ends = edge.join(ends, F.col("e").eqNullSafe(F.col("source")), "left").select(
        "e", F.coalesce("end", cell_start).alias("end"), F.coalesce("taken", "before").alias("taken")
    )
    totals = cells.groupBy("source").agg(F.sum("words").alias("all_words")).withColumnRenamed("source", "a")
    found = state.join(ends, F.col("source").eqNullSafe(F.col("e")), "left").join(
        totals, F.col("source").eqNullSafe(F.col("a")), "left"
    )
    # No edge: every row left fits. Nothing wanted: an empty run.
    end = F.when(F.col("rest") <= 0, F.col("after")).otherwise(F.greatest("after", F.coalesce("end", F.lit(1 << _HASH_BITS))))
    taken = F.when(F.col("rest") <= 0, 0).otherwise(F.coalesce("taken", "all_words", F.lit(0)))
    run = F.struct(F.col("after").alias("after"), end.cast("long").alias("upto"), fits.alias("fits"))
    return found.select(
        "source", "source_size", "target", "whole", (F.col("rest") - taken).alias("rest"), end.cast("long").alias("after"),
        F.concat("runs", F.array(run)).alias("runs"),
    )


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    found = repetitions(docs, mix)
    times = found.columns[-1]
    copies = F.explode(F.sequence(F.lit(1), F.col(times).cast("int"))).alias(fresh(found, "copy_"))
    return found.where(F.col(times) > 0).select(*(F.col(f"`{c}`") for c in docs.columns), copies).select(
        *(F.col(f"`{c}`") for c in docs.columns)
    )
