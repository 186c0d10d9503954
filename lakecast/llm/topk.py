"""Exact top-k search by inner product: the threshold algorithm over sorted per-dimension lists.

Candidates are cut into blocks. For each block and dimension there is a list of the
candidates sorted by that component. The queries of a block read these lists in step from their ends: a look
goes down to a depth, scores what it meets by one exact product, and a query stops once the best score that an unseen
candidate could still have is below its k-th result. Results are carried from candidate block to
candidate block, so that later ones end the sooner; a ranking merges what the tasks found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakecast.llm.blocks import CANDIDATES, LIMIT, NONE, QUERIES, Best, Block, packed, products, quantised, walked
from lakecast.llm.common import kept, stored

__all__ = ["Lists", "quantised", "top_k"]

#: Depth of the lists at the first look at the threshold; it doubles from look to look.
FIRST_DEPTH = 16


class Lists:
    """A block's candidates with their sorted lists."""

    def __init__(self, ids: np.ndarray, parts: np.ndarray):
        self.ids, self.parts = ids, parts
        # Ascending by component in each dimension; read from either end.
        self._order = np.argsort(parts, axis=0, kind="stable").T.copy()
        self._sorted = np.take_along_axis(parts, self._order.T, axis=0).T.copy()

    def _scores(self, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
        return products(queries, self.parts[rows])

    def _bounds(self, queries: np.ndarray, depth: int) -> np.ndarray:
        """The best score that a candidate beyond ``depth`` in every list could have, for each query."""
        n, last = len(self.ids), max(depth, 1)
        high, low = self._sorted[:, n - last], self._sorted[:, last - 1]
        rising, falling = np.minimum(queries, 0), np.maximum(queries, 0)
        if int(np.abs(queries).max(initial=0)) * int(np.abs(self._sorted[:, [0, -1]]).max(initial=0)) * queries.shape[1] <= LIMIT:
            return falling @ high + rising @ low
        exact = falling.astype(object) @ high.astype(object) + rising.astype(object) @ low.astype(object)
        return np.array([min(max(b, -LIMIT), LIMIT) for b in exact], np.int64)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and scores of one query's ``k`` best candidates besides ``own``."""
        best = Best(1, k)
        self.search_all(query[None, :], np.array([own]), best)
        return best.found()[1:]

    def search_all(self, queries: np.ndarray, own: np.ndarray, best: Best) -> None:
        """Adds what this block holds of each query's best candidates besides those of its ``own`` key."""
        n, depth = len(self.ids), 0
        unseen, active = np.ones(n, bool), np.arange(len(queries))
        while True:
            active = active[(best.last[active] == NONE) | (best.last[active] <= self._bounds(queries[active], depth))]
            if depth == n or not len(active):
                return
            upto = min(n, max(FIRST_DEPTH, 2 * depth))
            met = np.zeros(n, bool)
            if 2 * upto >= n:
                upto, met[:] = n, True
            else:
                falling, rising = (queries[active] > 0).any(axis=0), (queries[active] < 0).any(axis=0)
                met[self._order[falling, n - upto : n - depth]] = True
                met[self._order[rising, depth:upto]] = True
            new = np.flatnonzero(met & unseen)
            unseen[new] = False
            scores = self._scores(new, queries[active])
            scores[own[active][:, None] == self.ids[new]] = NONE
            best.add(active, self.ids[new], scores)
            depth = upto


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, candidates: int = CANDIDATES, per_block: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest inner products, ties to smaller ids.

    Both sides come from ``quantised``. A query is compared with vectors of its own length and never with rows of its own
    key. The work is queries times candidates at worst, in blocks; neither side is broadcast. Rows that
    repeat a key are candidates each; of queries that repeat a key, that with the smallest vector is asked. Fewer than k
    candidates give fewer rows, empty tables none. Scores beyond 2^62 count as 2^62.
    """
    none = F.array().cast("array<bigint>").alias("extra")
    once = queries.groupBy("vec_id").agg(F.min("parts").alias("parts"))
    asked = kept(packed(once.select("vec_id", "parts", none), per_block))
    lists = stored(packed(vectors.select("vec_id", "parts", none), candidates), "candidate-blocks")

    def search(query: Block, blocks: Iterator[Block]) -> Iterator[pa.RecordBatch]:
        best = Best(len(query.ids), k)
        for block in blocks:
            Lists(block.ids, block.parts).search_all(query.parts, query.ids, best)
        at, ids, scores = best.found()
        yield pa.RecordBatch.from_arrays([pa.array(query.ids[at]), pa.array(ids), pa.array(scores)], names=["query_id", "vec_id", "score"])

    found = walked(asked, lists, search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
