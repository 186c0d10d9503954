"""Exact n-gram Jaccard join with token-combination prefixes.

A document is the set of its word shingles (tokens). Two similar sets differ in few tokens, so a
prefix of each set, in one order of all tokens, already has to share some. Rare
tokens are indexed singly. Frequent tokens are put into classes, prefixes are extended until similar
sets must share two tokens of one class, and combinations of two are indexed. Documents that
meet in the index are compared by their whole sets.

Equal sets are one node from the start, and index buckets with the same members are one bucket. Small
buckets give pairs of nodes. Large buckets are parted first by sketches of whole sets, which tell in how many
tokens two sets differ at least: members that share no more than common tokens go, and what may hang
together stays a bucket. Members of parts that are still large are compared in blocks: nodes are gathered
in families around the largest buckets, and blocks of families that share a bucket meet; a pair of
blocks returns only the links that hold its members together.
"""

from __future__ import annotations

import math
import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecast.llm.common import byte_texts, components, discard, kept, stored
from lakecast.session import broadcast_if_small

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Join:
    """Sets of shingles of ``words`` words link at ``percent`` per cent Jaccard similarity or more.

    A token in more than ``rare`` sets is frequent. ``indexed``: share of the token space that is
    indexed, times the share of tokens in which similar sets may differ; documents with too few tokens there index all.
    Buckets of more than ``small`` members are parted by sketches, and what is still larger is compared in blocks of
    about ``block``. These settings change the work, not the result.
    """

    words: int = 3
    percent: int = 90
    rare: int = 256
    indexed: float = 1.6
    small: int = 16
    block: int = 256

    def may_miss(self, n: int) -> int:
        """Tokens of a set of ``n`` that a similar set may lack."""
        return n - -(-n * self.percent // 100)

    def apart(self, sizes):
        """Tokens that stand in only one of two similar sets, at most, whose ``sizes`` add up to this."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def sketch_bits(self, n: int) -> int:
        """Bits that tell a set of ``n`` from one it shares little with: about half of them would differ."""
        return max(512, 1 << (4 * self.apart(2 * n)).bit_length())

    @property
    def step(self) -> float:
        """Width of a size step, on the scale of logarithms: sizes of similar sets lie in one step or in two neighbouring ones."""
        return math.log(100 / self.percent) + 1e-4

    @property
    def low(self) -> int:
        """Tokens below this (unsigned) are indexed by all documents."""
        return min(1 << 64, int(self.indexed * (1 - self.percent / 100) * (1 << 64)))

    def bands(self, n: int) -> range:
        """Size bands in which a set of ``n`` can meet a similar one: logarithms of the sizes it may have."""
        return range((-(-n * self.percent // 100)).bit_length(), (n * 100 // self.percent).bit_length() + 1)

    def classes(self, band: int) -> int:
        """Classes of frequent tokens in a size band: about four prefix tokens in each."""
        return max(1, int(0.3 * (1 - self.percent / 100) * (1 << band - 1)))

    def has_partner(self, n: int) -> bool:
        """Can a set of ``n`` be similar to a different one at all? At best one token is missing."""
        return 100 * n >= self.percent * (n + 1) or self.may_miss(n) > 0


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text; with fewer words, of the whole sequence."""
    found = text.translate(_LOWER).split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = max(1, len(hashes) - words + 1)
    width = min(words, len(hashes))
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total = (total ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(32)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(total ^ (total >> np.uint64(31)))


def sketch(tokens: np.ndarray, join: Join) -> np.ndarray:
    """Parity of the tokens that fall on each bit, as 64-bit numbers: two sets differ in as many tokens as bits differ, or more."""
    bits = join.sketch_bits(len(tokens))
    at = (tokens >> np.uint64(20)) & np.uint64(bits - 1)
    odd = np.bincount(at.astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view("<i8")


def _folded(one: np.ndarray, words: int) -> np.ndarray:
    """The sketch of the same set in fewer numbers, unsigned, as bits are counted."""
    return np.bitwise_xor.reduce(one.view(np.uint64).reshape(-1, words))


def _indexed(tokens: np.ndarray, join: Join) -> np.ndarray:
    """The tokens a document indexes: those of the low space, or all if they are too few to make a prefix."""
    n = len(tokens)
    if not n or not join.has_partner(n):
        return tokens[:0]
    low = tokens[: np.searchsorted(tokens, np.uint64(min(join.low, (1 << 64) - 1)))]
    most = max(join.classes(b) for b in join.bands(n))
    return low if len(low) >= join.may_miss(n) + 1 + most else tokens


def sets_of(docs: DataFrame, join: Join, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, hash`` of the text, ``n`` tokens, a 128-bit ``digest`` of the set, its ``sketch`` and the tokens that are ``indexed``."""
    kind = docs.schema[key].dataType.simpleString()
    whole = F.col(text).cast("string")
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(whole).alias("hash"), whole.alias("text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t, join.words) for t in byte_texts(batch.column(2))]
            tokens = [_indexed(s, join).view(np.int64) for s in found]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
            sketches = [sketch(s, join) for s in found]
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sketches])])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in found], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in found], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *sketches]))),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *tokens]))),
                ],
                names=["id", "hash", "n", "digest", "sketch", "indexed"],
            )

    return rows.mapInArrow(digest, f"id {kind}, hash long, n long, digest binary, sketch array<long>, indexed array<long>")


def signatures(n: int, n_low: int, n_high: int, tokens: list[int], sets: list[int], join: Join) -> list[int]:
    """Index keys of a set of ``n``: of its prefix, single rare tokens and combinations of frequent ones.

    ``tokens`` are its indexed tokens that other sets index too, ``sets`` in how many; ``n_low`` and ``n_high``
    count all its indexed tokens. The order of all tokens is: the low space first, then by the
    number of sets, then by value. The prefix ends as soon as a similar set must share a
    rare token or two frequent tokens of one class.
    """
    rest = join.may_miss(n) + 1
    low = [(count, token) for token, count in zip(tokens, sets, strict=True) if token % (1 << 64) < join.low]
    high = [(count, token) for token, count in zip(tokens, sets, strict=True) if token % (1 << 64) >= join.low]
    order: list[tuple[int, int]] = []
    singles: list[int] = []
    # Tokens that no other set has need no key, but count as rare.
    for part, alone in ((sorted(low), n_low - len(low)), (sorted(high), n_high - len(high))):
        order += [(1, 0)] * alone + part
    out: list[int] = []
    for band in join.bands(n):
        left, classes, held = rest, join.classes(band), Counter()
        members: dict[int, list[int]] = {}
        for count, token in order:
            if left <= 0:
                break
            if count <= join.rare:
                left -= 1
                if count > 1:
                    singles.append(_key(0, token))
            else:
                own = token % (1 << 64) % classes
                members.setdefault(own, []).append(token)
                held[own] += 1
                left -= held[own] > 1
        for own in members.values():
            out += [_key(band, *pair) for pair in combinations(sorted(own), 2)]
    return sorted({*singles, *out})


def _key(band: int, *tokens: int) -> int:
    # Keys that collide by chance only bring more candidates.
    return xxhash.xxh3_64_intdigest(struct.pack(f"<{1 + len(tokens)}q", band, *tokens))


def _index(nodes: DataFrame, join: Join) -> DataFrame:
    """``key, node``: the index over nodes that share tokens."""
    tokens = nodes.select("node", F.explode("indexed").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    have = tokens.join(shared, "token").groupBy("node").agg(F.collect_list(F.struct("token", "sets")).alias("shared"))
    # Signed numbers: the low space is 0 to `low`, or all of them and the negatives up to it.
    wide = join.low >= 1 << 63
    low = F.lit(join.low - (1 << 64) if wide else join.low).cast("long")
    is_low = (lambda t: (t >= 0) | (t < low)) if wide else (lambda t: (t >= 0) & (t < low))
    counts = nodes.select("node", "n", F.size("indexed").alias("all"), F.size(F.filter("indexed", is_low)).alias("low"))
    rows = have.join(counts, "node").select("node", "n", "low", (F.col("all") - F.col("low")).alias("high"), "shared.token", "shared.sets")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signatures(*row[1:], join) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            nodes_ = np.repeat(batch.column(0).to_numpy(), [len(f) for f in found])
            flat = np.fromiter(chain.from_iterable(found), np.uint64, len(nodes_)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(nodes_, pa.int64())], names=["key", "node"])

    return rows.mapInArrow(keys, "key long, node long")


def _buckets(index: DataFrame) -> DataFrame:
    """``key, node, m``: index buckets of ``m`` > 1 members, one of those with the same members."""
    members = index.groupBy("key").agg(
        F.count(F.lit(1)).alias("m"),
        F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
    )
    kept_keys = members.where("m > 1").groupBy("m", "one", "two").agg(F.min("key").alias("key")).select("key", "m")
    return index.join(kept_keys, "key").select("key", "node", "m")


def hanging_together(sizes: np.ndarray, sketches: np.ndarray, join: Join) -> np.ndarray:
    """For each set the number of one that it may hang together with, over links that the sketches (a row each) allow."""
    at = np.argsort(sizes, kind="stable")
    sizes, sketches, out = sizes[at], sketches[at], np.empty(len(sizes), np.int64)
    # What is not placed yet stays sorted by size, so that a set looks only at those of fitting sizes.
    while len(at):
        first, front = at[0], (sizes[:1], sketches[:1])
        out[first] = first
        at, sizes, sketches = at[1:], sizes[1:], sketches[1:]
        while len(front[0]) and len(at):
            near, start = np.zeros(len(at), bool), 0
            while start < len(front[0]):
                low = np.searchsorted(sizes, front[0][start] * join.percent // 100)
                high = np.searchsorted(sizes, -(-front[0][start] * 100 // join.percent), "right")
                # The front is sorted as well: the first of a few has the smallest sizes, the last the largest.
                stop = min(len(front[0]), start + max(1, (1 << 18) // max(1, (high - low) * sketches.shape[1])))
                high = np.searchsorted(sizes, -(-front[0][stop - 1] * 100 // join.percent), "right")
                differ = np.bitwise_count(front[1][start:stop, None] ^ sketches[None, low:high]).sum(axis=2, dtype=np.int64)
                both = front[0][start:stop, None] + sizes[None, low:high]
                near[low:high] |= (np.maximum(differ, np.abs(2 * sizes[None, low:high] - both)) <= join.apart(both)).any(axis=0)
                start = stop
            if not near.any():
                break
            out[at[near]] = first
            front = (sizes[near], sketches[near])
            at, sizes, sketches = at[~near], sizes[~near], sketches[~near]
    return out


def _parted(large: DataFrame, nodes: DataFrame, join: Join) -> DataFrame:
    """``key, node``: the parts of ``large`` buckets that may hang together, by sizes and sketches.

    A bucket is cut by size steps. A node is in its own step and in the next, so nodes of fitting sizes share one;
    parts that lie wholly below their step are whole in the step before.
    """
    own = F.floor(F.log(F.col("n").cast("double")) / F.lit(join.step)).alias("own")
    rows = large.select("key", "node").join(nodes.select("node", "n", own, "sketch"), "node")
    rows = rows.select("key", F.explode(F.array("own", F.col("own") + 1)).alias("step"), "node", "n", "own", "sketch")

    def part(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        node, n, own_ = (group.column(c).to_numpy() for c in ("node", "n", "own"))
        found = [s.values.to_numpy() for s in group.column("sketch")]
        words = min(map(len, found))
        root = hanging_together(n, np.array([_folded(s, words) for s in found]), join)
        here, count = np.zeros(len(n), bool), np.bincount(root, minlength=len(n))
        here[root[own_ == key[1].as_py()]] = True
        stays = here[root] & (count[root] > 1)
        names = {"key": key[0].as_py(), "step": key[1].as_py()}
        return pa.table(
            {k: pa.array(np.full(stays.sum(), v), pa.int64()) for k, v in names.items()}
            | {"root": pa.array(node[root[stays]], pa.int64()), "node": pa.array(node[stays], pa.int64())}
        )

    parts = rows.groupBy("key", "step").applyInArrow(part, "key long, step long, root long, node long")
    # Keys that collide by chance only bring more candidates.
    return parts.select(F.xxhash64("key", "step", "root").alias("key"), "node")


def _whole_sets(docs: DataFrame, nodes: DataFrame, join: Join, key: str, text: str) -> DataFrame:
    """``node, tokens`` of the given nodes, from a text of each (from all, if its row is repeated)."""
    whole = F.col(text).cast("string")
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(whole).alias("hash"), whole.alias("text"))
    wanted = nodes.select(F.col("id").alias("i"), F.col("hash").alias("h"), "node")
    texts = rows.join(broadcast_if_small(wanted), F.col("id").eqNullSafe(F.col("i")) & (F.col("hash") == F.col("h"))).select("node", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [shingles(t, join.words).view(np.int64) for t in byte_texts(batch.column(1))]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
            values = pa.array(np.concatenate([np.empty(0, np.int64), *tokens]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)], names=["node", "tokens"]
            )

    return texts.mapInArrow(read, "node long, tokens array<long>")


def _pairs(buckets: DataFrame, nodes: DataFrame, join: Join) -> DataFrame:
    """Pairs ``a < b`` of members of small buckets, of fitting sizes, whose sketches and indexed tokens allow a link."""
    members = buckets.where(F.col("m") <= join.small).join(nodes.select("node", "n", "sketch"), "node").select("key", "node", "n", "sketch")
    left = members.select("key", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    bits = F.zip_with("s_a", "sketch", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("long"))
    differ = F.aggregate(bits, F.lit(0).cast("long"), lambda total, x: total + x)
    alike = (F.size("s_a") != F.size("sketch")) | (differ * (100 + join.percent) <= (F.col("n") + F.col("n_a")) * (100 - join.percent))
    fitting = (100 * F.least("n", "n_a") >= join.percent * F.greatest("n", "n_a")) & alike
    pairs = left.join(members, "key").where((F.col("a") < F.col("node")) & fitting).select("a", F.col("node").alias("b")).distinct()
    # Of the tokens that a set indexes, a similar set lacks no more than of all of them; but tokens of the
    # high space are no evidence against a set that does not index it.
    side = [nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("indexed").alias(f"i_{c}")) for c in "ab"]
    both = F.size(F.array_intersect("i_a", "i_b"))

    def allows(own: str, other: str):
        may_miss = F.expr(f"n_{own} - (n_{own} * {join.percent} + 99) div 100")
        blind = (F.size(f"i_{own}") == F.col(f"n_{own}")) & (F.size(f"i_{other}") < F.col(f"n_{other}"))
        return blind | (both >= F.size(f"i_{own}") - may_miss)

    return pairs.join(side[1], "b").join(side[0], "a").where(allows("a", "b") & allows("b", "a")).select("a", "b")


def _links(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    either = F.size("left") + F.size("right") - both
    return pairs.join(right, "b").join(left, "a").where(100 * both >= join.percent * either).select("a", "b")


def holding_links(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> list[tuple[int, int]]:
    """Links between the sets of two blocks (or within one) that hold together what all links do.

    Numbers count through ``left``, then ``right``. Intersections are products of the
    blocks' incidence matrices, a few thousand tokens at a time; tokens of a single set have no part in them.
    """
    sets = left + (right or [])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[token] > 1
    owner, token = owner[shared], np.unique(token[shared], return_inverse=True)[1]
    n = len(left)
    both = np.zeros((n, len(sets) - n if right is not None else n), np.float32)
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    for first in range(0, int(token[-1]) + 1 if len(token) else 0, 4096):
        part = slice(*np.searchsorted(token, [first, first + 4096]))
        matrix = np.zeros((len(sets), 4096), np.float32)
        matrix[owner[part], token[part] - first] = 1
        both += matrix[:n] @ (matrix[n:] if right is not None else matrix[:n]).T
    sizes = np.array([len(s) for s in sets])
    columns = sizes[n:] if right is not None else sizes[:n]
    both = np.rint(both).astype(np.int64)
    linked = 100 * both >= percent * (sizes[:n, None] + columns - both)
    shift = n if right is not None else 0
    label, out = np.arange(len(sets)), []
    for i in range(n):
        others = np.flatnonzero(linked[i]) + shift
        # One link to each group that is not yet held together with this set.
        roots, at = np.unique(label[others], return_index=True)
        for root, j in zip(roots, others[at], strict=True):
            if root != label[i]:
                out.append((i, int(j)))
        label[np.isin(label, roots)] = label[i]
    return out


def _families(large: DataFrame) -> DataFrame:
    """``node, family``: the largest bucket that a node, or a bucket of its hub's members, reaches.

    A node's hub is its largest bucket. Hubs that meet in a bucket follow the largest of
    them, so a group of near copies becomes one family, though edits scatter its members over
    many buckets. Any such naming is right: families that share a bucket are compared.
    """
    hubs = kept(large.groupBy("node").agg(F.max(F.struct("m", "key")).alias("hub")))
    seen = large.select("key", "node").join(hubs, "node").select("key", "hub").distinct()
    best = seen.groupBy("key").agg(F.max("hub").alias("best"))
    leads = seen.join(best, "key").groupBy("hub").agg(F.max("best").alias("best"))
    return hubs.join(leads, "hub").select("node", F.col("best.key").alias("family"))


def _block_links(buckets: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Links ``a, b`` among the members of large buckets, enough to hold together all that are linked."""
    large = buckets.where(F.col("m") > join.small)
    families = kept(_families(large))
    seen = large.join(families, "node").select("key", "family").distinct()
    # Families that share a bucket: whoever shares a large bucket is in two of these.
    meet = (
        seen.select("key", F.col("family").alias("f1"))
        .join(seen.select("key", F.col("family").alias("f2")), "key")
        .where("f1 <= f2")
        .select("f1", "f2")
        .distinct()
    )
    sizes = families.groupBy("family").agg(F.count(F.lit(1)).alias("rows"))
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("rows") / join.block)).cast("long")
    placed = families.join(sizes, "family").select("node", "family", part.alias("part")).join(sets, "node")
    placed = placed.select("family", "part", "node", "tokens")

    def pack(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        first = dict(zip(group.column("node").to_pylist(), group.column("tokens"), strict=True))
        tokens = [t.values.to_numpy() for t in first.values()]
        return pa.table(
            {
                "family": pa.array([key[0].as_py()], pa.int64()),
                "part": pa.array([key[1].as_py()], pa.int64()),
                "nodes": pa.array([list(first)], pa.list_(pa.int64())),
                "lengths": pa.array([[len(t) for t in tokens]], pa.list_(pa.int64())),
                "tokens": pa.array([np.concatenate(tokens).astype("<i8").tobytes()], pa.binary()),
            }
        )

    fields = ("family", "part", "nodes", "lengths", "tokens")
    blocks = placed.groupBy("family", "part").applyInArrow(pack, "family long, part long, nodes array<long>, lengths array<long>, tokens binary")
    blocks = stored(blocks, "blocks")
    one, two = (blocks.select(*(F.col(c).alias(f"{c}{k}") for c in fields)) for k in (1, 2))
    # Pairs of blocks are found by their numbers, so each block travels only to the pairs it is in.
    units = (
        meet.join(one.select("family1", "part1"), F.col("f1") == F.col("family1"))
        .join(two.select("family2", "part2"), F.col("f2") == F.col("family2"))
        .where("f1 < f2 OR part1 <= part2")
        .select("family1", "part1", "family2", "part2")
    )
    units = units.join(one, ["family1", "part1"]).join(two, ["family2", "part2"])
    units = units.select(*(f"{c}{k}" for k in (1, 2) for c in fields))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes, sides = [], []
                for k in (1, 2):
                    ends = np.cumsum(row[f"lengths{k}"])[:-1]
                    sides.append(np.split(np.frombuffer(row[f"tokens{k}"], "<i8"), ends))
                    nodes += row[f"nodes{k}"]
                within = (row["family1"], row["part1"]) == (row["family2"], row["part2"])
                found = holding_links(sides[0], None if within else sides[1], join.percent)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([nodes[i] for i, _ in found], pa.int64()), pa.array([nodes[j] for _, j in found], pa.int64())], names=["a", "b"]
                )

    return units.mapInArrow(compare, "a long, b long")


def node_components(docs: DataFrame, nodes: DataFrame, join: Join, key: str, text: str) -> DataFrame:
    """``node, root`` of all nodes that have a link to a different one.

    ``nodes`` holds ``node, n, id, hash, sketch, indexed``, one row per set.
    """
    index = stored(_index(nodes, join), "index")
    whole = stored(_buckets(index), "buckets")
    discard(index)
    parts = stored(_parted(whole.where(F.col("m") > join.small), nodes, join), "parts")
    buckets = stored(whole.where(F.col("m") <= join.small).unionByName(_buckets(parts)), "parted-buckets")
    discard(whole)
    discard(parts)
    pairs = stored(_pairs(buckets, nodes, join), "pairs")
    large = buckets.where(F.col("m") > join.small).select("node")
    involved = pairs.select("a").union(pairs.select("b")).union(large).toDF("node").distinct()
    wanted = kept(nodes.select("node", "id", "hash").join(involved, "node"))
    sets = stored(_whole_sets(docs, wanted, join, key, text), "sets")
    return kept(components(_links(pairs, sets, join).union(_block_links(buckets, sets, join))))


def linked(docs: DataFrame, join: Join = Join(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component``: for each row the smallest key that links lead to from it.

    Links are exact: no partner, candidate or bucket is capped, and whole texts count. Tokens are 64-bit
    hashes. Equal sets are linked whatever their number.

    Nulls: null and empty texts and texts without words have no shingles, link with nothing and are
    their own component. Null keys sort last: a component has a null key only if all its keys are null.
    Repeated rows are linked like any equal texts. An empty table gives an empty result. Other columns are ignored.
    """
    wide = stored(sets_of(docs, join, key, text), "sets-of-documents")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "hash")
    nodes = (
        wide.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.min(place).alias("first"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("indexed").alias("indexed"))
        .select(F.monotonically_increasing_id().alias("node"), "digest", "n", "first.id", "first.hash", "sketch", "indexed")
    )
    nodes = stored(nodes, "nodes")
    rows = stored(wide.select("id", "n", "digest"), "documents")
    discard(wide)
    roots = node_components(docs, nodes, join, key, text)
    firsts = nodes.select("node", "digest", F.struct(F.col("id").isNull().alias("last"), "id").alias("first"))
    # The smallest key among the nodes of a component, for all of them.
    least = roots.join(firsts, "node").groupBy("root").agg(F.min("first").alias("least"))
    moved = roots.join(least, "root").select("node", "least")
    firsts = firsts.join(moved, "node", "left").select("digest", F.coalesce("least", "first").alias("first"))
    found = rows.join(firsts, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("first.id"))
    return found.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component"))


def one_of_each(docs: DataFrame, join: Join = Join(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each component: that with the smallest key. All columns stay.

    Rows without shingles all stay. Keys name documents: of rows that repeat a kept key, one stays; of rows without
    a key, all stay whose component has no key, as nothing tells them apart.
    """
    found = kept(linked(docs, join, key, text))
    survivors = found.where(F.col(key).eqNullSafe(F.col("component")))
    repeated = survivors.groupBy(key).count().where(F.col("count") > 1).where(F.col(key).isNotNull())
    rows = docs.alias("d").join(
        survivors.select(F.col(key).alias("kept_")).distinct().alias("s"), F.col(f"d.`{key}`").eqNullSafe(F.col("s.kept_")), "left_semi"
    )
    if repeated.isEmpty():
        return rows
    return rows.where(F.col(key).isNotNull()).dropDuplicates([key]).union(rows.where(F.col(key).isNull()))
