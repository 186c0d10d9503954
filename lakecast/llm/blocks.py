"""Whole-number vectors in packed blocks: query blocks that walk candidate blocks, and their running best scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecast.llm.common import kept

CANDIDATES = 8192
QUERIES = 512
#: Candidate blocks that a task walks with one query block.
WALK = 8
#: Components and scores beyond are clamped.
LIMIT = 1 << 62
#: Score of a place that is not taken.
NONE = -(1 << 63)


def quantised(vectors: DataFrame, scale: float = 64.0, key: str = "vec_id", vector: str = "embedding", **others: Column) -> DataFrame:
    """``vec_id, parts`` and ``others``: floor(scale * x) of every component as 64-bit numbers.

    Vectors that are null, empty or hold a null or non-finite component are left out, and so
    are rows without a key. Numbers beyond 2^62 are clamped to it, and so are scores made of them.
    """
    x = F.col(vector).cast("array<double>")
    sound = F.forall("x_", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    most = F.lit(float(LIMIT))
    return (
        vectors.select(F.col(key).cast("long").alias("vec_id"), x.alias("x_"), *(c.alias(n) for n, c in others.items()))
        .where(F.col("vec_id").isNotNull() & F.col("x_").isNotNull() & (F.size("x_") > 0))
        .where(sound)
        .select(
            "vec_id",
            F.transform("x_", lambda v: F.floor(F.greatest(-most, F.least(most, v * scale))).cast("long")).alias("parts"),
            *others,
        )
    )


def _narrow(values: np.ndarray) -> tuple[int, bytes]:
    """Bytes a number, and the numbers in as few as hold all of them."""
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    width = next(w for w in (2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
    return width, values.astype(f"<i{width}").tobytes()


def packed(vectors: DataFrame, rows: int) -> DataFrame:
    """``dims, block, ids, extra, width, parts``: about ``rows`` vectors of one length a block, as little-endian numbers.

    ``vectors`` holds ``vec_id, parts, extra``, ``extra`` an array of as many numbers in every row. Blocks are
    even parts of the keys' hashes, so their number grows with the table and their size does not. Rows
    are sorted by ``extra``, then by key.
    """
    n = vectors.count()
    block = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-n // rows))))
    placed = vectors.select(F.size("parts").alias("dims"), block.alias("block"), "vec_id", "extra", "parts")

    def pack(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        ids = group.column("vec_id").to_numpy()
        extra, parts = (
            group.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1) for c in ("extra", "parts")
        )
        order = np.lexsort((ids, *extra.T[::-1]))
        width, data = _narrow(parts[order])
        return pa.table(
            {
                "dims": pa.array([key[0].as_py()], pa.int32()),
                "block": pa.array([key[1].as_py()], pa.int64()),
                "ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
                "extra": pa.array([extra[order].astype("<i8").tobytes()], pa.binary()),
                "width": pa.array([width], pa.int32()),
                "parts": pa.array([data], pa.binary()),
            }
        )

    return placed.groupBy("dims", "block").applyInArrow(
        pack, "dims int, block long, ids binary, extra binary, width int, parts binary"
    )


@dataclass
class Block:
    """An unpacked block: keys, further numbers and vectors, a row each."""

    ids: np.ndarray
    extra: np.ndarray
    parts: np.ndarray

    @classmethod
    def of(cls, dims: int, ids: bytes, extra: bytes, width: int, parts: bytes) -> Block:
        keys = np.frombuffer(ids, "<i8")
        return cls(
            keys,
            np.frombuffer(extra, "<i8").reshape(len(keys), -1),
            np.frombuffer(parts, f"<i{width}").reshape(-1, dims).astype(np.int64),
        )


def _most(values: np.ndarray) -> int:
    return max(abs(int(values.min(initial=0))), abs(int(values.max(initial=0))))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``left`` with all of ``right``, clamped at 2^62."""
    most = _most(left) * _most(right) * left.shape[1]
    if most < 1 << 53:
        # Every partial sum is a whole number that a double holds.
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    if most <= LIMIT:
        return left @ right.T
    wide = right.T.astype(object)
    return np.array([np.clip(row.astype(object) @ wide, -LIMIT, LIMIT) for row in left], np.int64).reshape(len(left), len(right))


class Best:
    """The ``k`` highest scores of each query so far, ties to smaller keys."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, k), NONE, np.int64)
        self.ids = np.zeros((queries, k), np.int64)

    @property
    def last(self) -> np.ndarray:
        """The k-th score of each query; ``NONE`` while there are fewer."""
        return self.scores[:, -1]

    def add(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Scores of the queries ``at`` (rows) with the candidates ``ids`` (columns); ``NONE`` where there is none."""
        # Equal scores may win by their key, so they count as well.
        alive = np.flatnonzero((scores.max(axis=1, initial=NONE) >= self.last[at]) & (scores.max(axis=1, initial=NONE) > NONE))
        if not len(alive):
            return
        at, scores = at[alive], scores[alive]
        least = self.last[at]
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        row, column = np.nonzero((scores >= least[:, None]) & (scores > NONE))
        kept_row, kept_place = np.nonzero(self.scores[at] > NONE)
        row = np.concatenate([row, kept_row])
        value = np.concatenate([scores[row[: len(column)], column], self.scores[at[kept_row], kept_place]])
        key = np.concatenate([ids[column], self.ids[at[kept_row], kept_place]])
        order = np.lexsort((key, -value, row))
        row, value, key = row[order], value[order], key[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        fits = place < self.k
        self.scores[at], self.ids[at] = NONE, 0
        self.scores[at[row[fits]], place[fits]] = value[fits]
        self.ids[at[row[fits]], place[fits]] = key[fits]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query numbers, keys and scores of all places that are taken."""
        query, place = np.nonzero(self.scores > NONE)
        return query, self.ids[query, place], self.scores[query, place]


def walked(
    asked: DataFrame, lists: DataFrame, work: Callable[[Block, Iterator[Block]], Iterator[pa.RecordBatch]], schema: str, walk: int = WALK
) -> DataFrame:
    """``work`` over each query block and ``walk`` candidate blocks of its vectors' length at a time.

    Both sides are ``packed``; ``lists`` is read twice, so pass a stored table. Query blocks are copied to every stripe of candidate blocks and
    meet these one by one in a task, which keeps one candidate block and what ``work`` remembers. Neither
    side is broadcast; a lost task reads its blocks again.
    """
    stripes = kept(lists.select("dims", "block").distinct()).withColumn("stripe", F.floor(F.col("block") / walk))
    names = ("ids", "extra", "width", "parts")
    one = asked.select("dims", F.col("block").alias("query_block"), *(F.col(c).alias(f"query_{c}") for c in names))
    tasks = max(1, asked.select("dims", "block").join(stripes.select("dims", "stripe").distinct(), "dims").count())
    pairs = (
        one.join(stripes, "dims")
        .join(lists, ["dims", "block"])
        .select("dims", "query_block", "stripe", *(f"query_{c}" for c in names), *names)
        .repartition(2 * tasks, "dims", "query_block", "stripe")
        .sortWithinPartitions("dims", "query_block", "stripe")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (tuple(c[i].as_py() for c in batch.columns) for batch in batches for i in range(batch.num_rows))
        ahead = next(rows, None)
        while ahead is not None:
            place, dims = ahead[:3], ahead[0]
            query = Block.of(dims, *ahead[3:7])

            def candidates() -> Iterator[Block]:
                nonlocal ahead
                while ahead is not None and ahead[:3] == place:
                    block = Block.of(dims, *ahead[7:])
                    ahead = next(rows, None)
                    yield block

            yield from work(query, candidates())

    return pairs.mapInArrow(run, schema)
