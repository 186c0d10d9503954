"""MinHash near-duplicates: minima of universal hashes, bands, signature check, exact check, components by stars.

A document is the set of its word shingles. Its signature holds the minima of many universal hashes over the
set; equal bands of the signature bring documents together. Equal sets are one node from the start.
In each bucket all nodes are compared with a hub first; what does not yet hang together is compared in full: pairs in
small buckets, blocks in large ones. A pair's signatures are compared before its whole sets,
and only whole sets decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecast.llm.common import byte_texts, components, discard, kept, stored
from lakecast.llm.jaccard import Join, _whole_sets, holding_links, shingles

#: Tokens that are hashed together; their 32-bit numbers stay in a core's cache.
_TOKENS = 1 << 15


@dataclass(frozen=True)
class MinHash:
    """Sets of shingles of ``words`` words link at ``percent`` per cent Jaccard similarity or more.

    ``bands`` bands of ``rows`` minima: a pair at 80 % shares none of 50 bands of five with probability 2e-9, and
    more similar pairs still more rarely. Signatures of a pair must agree in all but ``deviations`` standard deviations of
    the places that a pair just similar enough agrees in. Buckets of more than ``small`` nodes are compared in blocks of about
    ``block``, after ``hubs`` rounds of hubs.
    """

    words: int = 2
    percent: int = 80
    bands: int = 50
    rows: int = 5
    seed: int = 7
    deviations: float = 7.0
    hubs: int = 2
    small: int = 16
    block: int = 256

    @property
    def least_equal(self) -> int:
        """Equal places below which a pair of signatures is no candidate."""
        places, share = self.bands * self.rows, self.percent / 100
        return max(0, int(places * share - self.deviations * (places * share * (1 - share)) ** 0.5))


@lru_cache
def _family(rule: MinHash) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of the multiply-shift hashes."""
    rng = np.random.default_rng(rule.seed)
    factors, offsets = rng.integers(0, 1 << 32, (2, rule.bands * rule.rows), np.uint32)
    return factors | np.uint32(1), offsets


def minima(sets: list[np.ndarray], rule: MinHash) -> np.ndarray:
    """The signature of each set (64-bit tokens, none of them empty), a row each."""
    factors, offsets = _family(rule)
    out = np.empty((len(sets), len(factors)), np.uint32)
    first = 0
    while first < len(sets):
        last, tokens = first, 0
        while last < len(sets) and (last == first or tokens + len(sets[last]) <= _TOKENS):
            tokens += len(sets[last])
            last += 1
        part = sets[first:last]
        starts = np.concatenate([[0], np.cumsum([len(s) for s in part])[:-1]])
        # A very long set goes in pieces, the minimum of which is kept.
        flat = (np.concatenate(part) >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(flat), _TOKENS):
            piece = flat[at : at + _TOKENS]
            hashed = np.empty_like(piece)
            for i, (a, b) in enumerate(zip(factors, offsets, strict=True)):
                np.multiply(piece, a, out=hashed)
                np.add(hashed, b, out=hashed)
                low = np.minimum.reduceat(hashed, starts if len(part) > 1 else [0])
                out[first:last, i] = low if not at else np.minimum(out[first:last, i], low)
        first = last
    return out


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return values ^ (values >> np.uint64(33))


def bands_of(signatures: np.ndarray, rule: MinHash) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    parts = signatures.reshape(len(signatures), rule.bands, rule.rows).astype(np.uint64)
    keys = np.broadcast_to(_mixed(np.arange(1, rule.bands + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for i in range(rule.rows):
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys.view(np.int64)


def signed(docs: DataFrame, rule: MinHash, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, hash`` of the text, ``n`` shingles, a 128-bit ``digest`` of the set, its ``bands`` and a byte for each minimum."""
    kind = docs.schema[key].dataType.simpleString()
    whole = F.col(text).cast("string")
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(whole).alias("hash"), whole.alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, rule.words) for t in byte_texts(batch.column(2))]
            has = np.array([len(s) > 0 for s in sets], bool)
            signatures = minima([s for s in sets if len(s)], rule)
            bands = bands_of(signatures, rule)
            offsets = np.concatenate([[0], np.cumsum(np.where(has, rule.bands, 0))])
            places = iter((_mixed(signatures.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(bands.ravel())),
                    pa.array([next(places).tobytes() if h else None for h in has], pa.binary()),
                ],
                names=["id", "hash", "n", "digest", "bands", "signature"],
            )

    return rows.mapInArrow(sign, f"id {kind}, hash long, n long, digest binary, bands array<long>, signature binary")


def _buckets(nodes: DataFrame) -> DataFrame:
    """``key, node``: buckets of more than one node; of buckets with the same nodes, one."""
    index = nodes.select(F.explode("bands").alias("key"), "node")
    members = index.groupBy("key").agg(
        F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("node")).alias("one"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two")
    )
    several = members.where("m > 1").groupBy("m", "one", "two").agg(F.min("key").alias("key")).select("key")
    return index.join(several, "key").select("key", "node")


def _candidates(pairs: DataFrame, nodes: DataFrame, rule: MinHash) -> DataFrame:
    """The pairs ``a, b`` whose sizes and signatures allow a link."""
    side = [nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("signature").alias(f"s_{c}")) for c in "ab"]
    fitting = 100 * F.least("n_a", "n_b") >= rule.percent * F.greatest("n_a", "n_b")
    both = pairs.join(side[0], "a").join(side[1], "b").where(fitting).select("a", "b", "s_a", "s_b")

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in (2, 3))
            alike = (left == right).sum(axis=1) >= rule.least_equal
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(alike)) for c in batch.columns[:2]], names=["a", "b"])

    return both.mapInArrow(agree, "a long, b long")


def _links(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, rule: MinHash, key: str, text: str) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar."""
    pairs = kept(_candidates(pairs, nodes, rule))
    wanted = kept(nodes.select("node", "id", "hash").join(pairs.select("a").union(pairs.select("b")).toDF("node").distinct(), "node"))
    sets = stored(_whole_sets(docs, wanted, Join(words=rule.words), key, text), "near-sets")
    left, right = (sets.select(F.col("node").alias(c), F.col("tokens").alias(f"t_{c}")) for c in "ab")
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "t_a", "t_b")

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (t.values.to_numpy().view(np.uint64) for t in (x, y))
                shared = len(x) + len(y) - len(np.union1d(x, y))
                linked.append(100 * shared >= rule.percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(linked, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    links = kept(both.mapInArrow(similar, "a long, b long"))
    discard(sets)
    return links


def _open(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """``key, node, root`` of the buckets whose nodes do not all hang together yet."""
    placed = buckets.select("key", "node").join(roots.withColumnRenamed("root", "r"), "node", "left")
    placed = placed.select("key", "node", F.coalesce("r", "node").alias("root"))
    split = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return placed.join(split.select("key"), "key")


def _with_hubs(members: DataFrame) -> DataFrame:
    """``key, node, root, hub, hub_root``: the hub of a bucket is the same in all buckets that hold it, if any way possible."""
    first = members.groupBy("key").agg(F.min(F.struct(F.xxhash64("node").alias("draw"), "node", "root")).alias("h"))
    return members.join(first.select("key", F.col("h.node").alias("hub"), F.col("h.root").alias("hub_root")), "key")


def _block_links(members: DataFrame, docs: DataFrame, nodes: DataFrame, rule: MinHash, key: str, text: str) -> DataFrame:
    """Links ``a, b`` in large buckets, enough to hold together all that are linked; blocks meet within their bucket.

    Nodes of a bucket's most frequent root hang together already: they have blocks of their own, which only meet the blocks of other nodes.
    """
    wanted = kept(nodes.select("node", "id", "hash").join(members.select("node").distinct(), "node"))
    sets = stored(_whole_sets(docs, wanted, Join(words=rule.words), key, text), "near-sets")
    most = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("of_root")).groupBy("key").agg(F.max(F.struct("of_root", "root")).alias("most"))
    ours = F.col("root") == F.col("most.root")
    rows = F.when(ours, F.col("most.of_root")).otherwise(F.col("m") - F.col("most.of_root"))
    part = F.pmod(F.xxhash64("node"), F.ceil(rows / rule.block)).cast("long")
    # Numbers below zero are blocks of the most frequent root.
    part = F.when(ours, -1 - part).otherwise(part)
    placed = members.join(most, "key").select("key", "node", "root", part.alias("part")).join(sets, "node").select("key", "part", "node", "root", "tokens")

    def pack(group_key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        nodes_, roots = (group.column(c).to_pylist() for c in ("node", "root"))
        first = {n: (r, t.values.to_numpy()) for n, r, t in zip(nodes_, roots, group.column("tokens"), strict=True)}
        tokens = [t for _, t in first.values()]
        return pa.table(
            {
                "key": pa.array([group_key[0].as_py()], pa.int64()),
                "part": pa.array([group_key[1].as_py()], pa.int64()),
                "nodes": pa.array([list(first)], pa.list_(pa.int64())),
                "roots": pa.array([[r for r, _ in first.values()]], pa.list_(pa.int64())),
                "lengths": pa.array([[len(t) for t in tokens]], pa.list_(pa.int64())),
                "tokens": pa.array([np.concatenate(tokens).astype("<i8").tobytes()], pa.binary()),
            }
        )

    fields = ("part", "nodes", "roots", "lengths", "tokens")
    kinds = "key long, part long, nodes array<long>, roots array<long>, lengths array<long>, tokens binary"
    blocks = stored(placed.groupBy("key", "part").applyInArrow(pack, kinds), "near-blocks")
    one, two = (blocks.select("key", *(F.col(c).alias(f"{c}{k}") for c in fields)) for k in (1, 2))
    units = one.select("key", "part1").join(two.select("key", "part2"), "key").where("part1 >= 0 AND part2 <= part1")
    units = units.join(one, ["key", "part1"]).join(two, ["key", "part2"])
    units = units.select(*(f"{c}{k}" for k in (1, 2) for c in fields))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sides = [np.split(np.frombuffer(row[f"tokens{k}"], "<i8"), np.cumsum(row[f"lengths{k}"])[:-1]) for k in (1, 2)]
                within = row["part1"] == row["part2"]
                names, roots = (row[f"{c}1"] + ([] if within else row[f"{c}2"]) for c in ("nodes", "roots"))
                found = holding_links(sides[0], None if within else sides[1], rule.percent)
                found = [(i, j) for i, j in found if roots[i] != roots[j]]
                yield pa.RecordBatch.from_arrays([pa.array([names[x[i]] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    links = kept(units.mapInArrow(compare, "a long, b long"))
    discard(sets)
    discard(blocks)
    return links


def node_components(docs: DataFrame, nodes: DataFrame, rule: MinHash, key: str, text: str) -> DataFrame:
    """``node, root`` of all nodes that have a link to a different one."""
    buckets = stored(_buckets(nodes), "near-buckets")
    none = nodes.select(F.col("node"), F.col("node").alias("root")).limit(0)
    roots, members = none, buckets.select("key", "node", F.col("node").alias("root"))

    def joined(links: DataFrame) -> DataFrame:
        return kept(components(links.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))))

    for _ in range(rule.hubs):
        hubs = kept(_with_hubs(members))
        pairs = hubs.where("root <> hub_root").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
        roots = joined(_links(pairs, docs, nodes, rule, key, text))
        # A hub has met all others of its bucket.
        members = kept(_open(hubs.where("node <> hub"), roots))
        if members.isEmpty():
            return roots
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    members = kept(members.join(sizes, "key"))
    few = members.where(F.col("m") <= rule.small)
    left = few.select("key", F.col("node").alias("a"), F.col("root").alias("r"))
    pairs = left.join(few, "key").where("a < node AND r <> root").select("a", F.col("node").alias("b")).distinct()
    links = _links(pairs, docs, nodes, rule, key, text)
    many = members.where(F.col("m") > rule.small)
    if not many.isEmpty():
        links = links.union(_block_links(many, docs, nodes, rule, key, text))
    return joined(links)


def near_duplicates(docs: DataFrame, rule: MinHash = MinHash(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component, kept``: the smallest key that links lead to from each row, and whether it is the row's own.

    Every link is confirmed on whole sets; a pair is missed only if no band agrees (see ``MinHash``). Nothing is capped.

    Nulls: null and empty texts and texts without words have no shingles, link with nothing, are
    their own component and are kept. Null keys sort last: a component has a null key only if all its keys are null.
    Rows that repeat a key are documents each, and all those with the kept key are kept. An
    empty table gives an empty result. Other columns are ignored.
    """
    wide = stored(signed(docs, rule, key, text), "signed-documents")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "hash")
    nodes = (
        wide.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.min(place).alias("place"), *(F.first(c).alias(c) for c in ("n", "bands", "signature")))
        .select(F.monotonically_increasing_id().alias("node"), "digest", "n", "place.id", "place.hash", "bands", "signature")
    )
    nodes = stored(nodes, "near-nodes")
    rows = stored(wide.select("id", "n", "digest"), "near-rows")
    discard(wide)
    roots = node_components(docs, nodes, rule, key, text)
    own = nodes.select("node", "digest", F.struct(F.col("id").isNull().alias("last"), "id").alias("first"))
    least = roots.join(own, "node").groupBy("root").agg(F.min("first").alias("least"))
    moved = roots.join(least, "root").select("node", "least")
    ends = own.join(moved, "node", "left").select("digest", F.coalesce("least", "first")["id"].alias("end"))
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("end"))
    return rows.join(ends, "digest", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component"), F.col("id").eqNullSafe(component).alias("kept")
    )
