"""Hard negatives by slots: the limits of an anchor's positives cut its scores into disjoint slots.

An anchor's positives are its best rows of the same label, and each sets a window of scores that
reaches down from its own. The windows overlap, but their upper limits cut the scores into slots that do
not: a candidate belongs to the slot below the smallest limit that it does not exceed. Tasks keep the best rows of
each slot, a ranking merges what the tasks kept, and a window's answer is the head of its own slot and
all lower ones, in that order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakecast.llm.blocks import CANDIDATES, NONE, QUERIES, Best, Block, packed, products, walked
from lakecast.llm.common import kept, stored


def _least(score: np.ndarray, percent: int) -> np.ndarray:
    """The smallest whole number of at least ``percent`` per cent of ``score``, without leaving 64 bits."""
    hundreds, rest = np.divmod(score, 100)
    return percent * hundreds - (-percent * rest // 100)


def _batch(query: Block, found: tuple[np.ndarray, np.ndarray, np.ndarray], slot: int) -> pa.RecordBatch:
    at, ids, scores = found
    columns = [query.ids[at], np.full(len(at), slot), ids, scores]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["anchor_id", "slot", "vec_id", "score"])


_FOUND = "anchor_id long, slot int, vec_id long, score long"


def _best_of_label(k: int):
    def work(query: Block, candidates: Iterator[Block]) -> Iterator[pa.RecordBatch]:
        best = Best(len(query.ids), k)
        labels = query.extra[:, 0]
        for block in candidates:
            # Rows are sorted by label, so those of one label lie together.
            for label in np.unique(labels):
                at = np.flatnonzero(labels == label)
                part = slice(*np.searchsorted(block.extra[:, 0], [label, label + 1]))
                ids = block.ids[part]
                scores = products(query.parts[at], block.parts[part])
                scores[query.ids[at][:, None] == ids] = NONE
                best.add(at, ids, scores)
        yield _batch(query, best.found(), 0)

    return work


def _best_of_slots(k: int, low: int):
    def work(query: Block, candidates: Iterator[Block]) -> Iterator[pa.RecordBatch]:
        labels, limits = query.extra[:, :1], query.extra[:, 1:]
        # A window below zero is empty: its lower end lies above its upper one.
        least = np.where(limits >= 0, _least(np.maximum(limits, 0), low), 1 << 62).min(axis=1)[:, None]
        lower = np.concatenate([limits[:, 1:], np.full((len(limits), 1), NONE)], axis=1)
        slots, all_ = [Best(len(query.ids), k) for _ in limits.T], np.arange(len(query.ids))
        for block in candidates:
            scores = products(query.parts, block.parts)
            open_ = (labels != block.extra[:, 0]) & (scores >= least) & (query.ids[:, None] != block.ids)
            for j, slot in enumerate(slots):
                inside = open_ & (scores <= limits[:, j : j + 1]) & (scores > lower[:, j : j + 1])
                slot.add(all_, block.ids, np.where(inside, scores, NONE))
        for j, slot in enumerate(slots):
            yield _batch(query, slot.found(), j)

    return work


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each anchor's slot, of those that tasks kept."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, candidates: int = CANDIDATES, per_block: int = QUERIES
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: the best rows of other labels in each positive's window.

    Both sides come from ``quantised`` with a whole-number ``label``. An anchor's positives are its ``positives`` best rows of
    the same label; a window holds scores from ``low`` per cent of the positive's score up to that score. Higher
    scores come first, ties by smaller key. A positive without negatives in its window has no row, and a positive below
    zero has no window.

    Nulls: rows without key or label take no part. Rows that repeat a key are candidates each, never for an anchor of their own
    key; of anchors that repeat a key, that with the smallest label, then vector, is asked. Vectors meet those of their own
    length only. Empty tables give no rows. Other columns are ignored.
    """
    lists = packed(
        vectors.where("vec_id IS NOT NULL AND label IS NOT NULL").select("vec_id", "parts", F.array(F.col("label").cast("long")).alias("extra")), candidates
    )
    lists = stored(lists, "negative-candidates")
    asked = (
        anchors.where("vec_id IS NOT NULL AND label IS NOT NULL")
        .groupBy("vec_id")
        .agg(F.min(F.struct(F.col("label").cast("long").alias("label"), "parts")).alias("a"))
        .select("vec_id", "a.label", "a.parts")
    )
    asked = stored(asked, "negative-anchors")
    own = stored(packed(asked.select("vec_id", "parts", F.array("label").alias("extra")), per_block), "anchor-blocks")
    same = kept(_merged(walked(own, lists, _best_of_label(positives), _FOUND), positives))

    # Distinct upper limits, highest first; a shorter list is filled with what no score reaches.
    limits = same.groupBy("anchor_id").agg(F.sort_array(F.collect_set("score"), asc=False).alias("limits"))
    filled = F.concat("limits", F.array_repeat(F.lit(NONE), F.lit(positives) - F.size("limits")))
    limited = asked.join(limits, asked["vec_id"] == limits["anchor_id"]).select(
        "vec_id", "parts", F.concat(F.array("label"), filled).alias("extra")
    )
    limited = stored(packed(limited, per_block), "limited-anchors")
    slots = _merged(walked(limited, lists, _best_of_slots(negatives, low), _FOUND), negatives)

    best = slots.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("slot", "place", "vec_id", "score"))).alias("best"))
    windows = same.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).join(limits, "anchor_id")
    windows = windows.select(
        "anchor_id", "positive_id", "positive_score", (F.array_position("limits", F.col("positive_score")) - 1).cast("int").alias("first")
    )
    head = F.slice(F.filter("best", lambda x: x["slot"] >= F.col("first")), 1, negatives)
    wide = "decimal(38,0)"
    fits = F.filter(head, lambda x: x["score"].cast(wide) * 100 >= F.col("positive_score").cast(wide) * low)
    return (
        windows.join(best, "anchor_id")
        .select("anchor_id", "positive_id", "positive_score", F.posexplode(fits).alias("place", "negative"))
        .select(
            "anchor_id",
            "positive_id",
            (F.col("place") + 1).cast("int").alias("rank"),
            F.col("negative.vec_id").alias("negative_id"),
            "positive_score",
            F.col("negative.score").alias("negative_score"),
        )
    )
