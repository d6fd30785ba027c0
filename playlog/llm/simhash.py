"""Near-duplicates by SimHash fingerprints, searched by vantage-point trees.

Distinct fingerprints are dealt to shards by a vantage-point tree: a node holds a vantage fingerprint and a radius,
the median Hamming distance. A fingerprint within the radius goes left, all others go right; one on the right whose
distance is within the radius plus the link distance is also copied to the left, as the triangle inequality allows
it a partner there and none otherwise. So each pair within the link distance meets in a shard. The upper levels grow
on the driver from a bounded sample; a shard with more than ``MOST`` points grows levels of its own on the executors,
and one that spheres don't part, a dense cluster, is dealt out as tiles of two bounded chunks each, so that every
pair meets in a tile. Within a shard the same rule goes on down to small blocks, where all distances are taken. A
shard returns each fingerprint's smallest partner by its own connected components, never pairs, and the shards'
components are then joined over all shards.

Defined results: letters other than A-Z are not lowered; a null or blank text has fingerprint 0, linked like any
other; equal fingerprints (ties, repeated rows) are one point; a very long text is hashed whole, by itself; an empty
table gives no rows; further columns are not read. A null doc_id is never the smallest of a group unless all are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import map_arrow, stage, text_bytes, unused, with_row_id
from .components import components

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Fingerprints of a shard, of the sample that the tree's upper levels are built from, and of a block without inner nodes.
SHARD, SAMPLE, BLOCK = 2048, 32768, 1024
#: A node whose halves, borders included, hold more than this multiple of its points is a dense cluster, which spheres don't part.
OVERLAP = 1.6
#: Points that a task searches at once, levels below the driver's tree, and numbers that a block's distances take at once.
MOST, LEVELS, CELLS = 1 << 16, 11, 1 << 22


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the 64-bit hashes; 0 without any."""
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[a : a + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority bits of the XXH64 hashes of the text's word shingles, repeats included."""
    words = text.lower().split()  # bytes: only A-Z are lowered, and only ASCII white space splits
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    return majority(np.fromiter(map(xxh64_intdigest, parts, repeat(seed)), np.uint64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep..., fp): the fingerprint of each text as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in text_bytes(batch, "text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(fps, pa.int64())], [*keep, "fp"])

    kinds = dict(docs.dtypes)
    return map_arrow(docs.select(*keep, "text"), run, ", ".join([*(f"{c} {kinds[c]}" for c in keep), "fp long"]))


def distance(points: np.ndarray, to: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ to)


def _vantage(points: np.ndarray) -> tuple[np.uint64, int]:
    """The point, of some spread over the block, whose distances vary most, and their median."""
    some = points[:: max(1, len(points) // 8)][:8]
    probe = points[:: max(1, len(points) // 512)]
    best = max(some, key=lambda v: distance(probe, v).std())
    return best, int(np.median(distance(points, best)))


def build_tree(sample: np.ndarray, depth: int, within: int = RADIUS) -> list[tuple[int, int] | None]:
    """The upper levels as a heap: node k has children 2k+1 (within the radius) and 2k+2; all points of a node without vantage go to the first."""
    tree: list[tuple[int, int] | None] = [None] * (2**depth - 1)
    held = {0: np.unique(sample)}
    for k in range(len(tree)):
        own = held.pop(k)
        if len(own) < 8:
            held[2 * k + 1], held[2 * k + 2] = own, own[:0]
            continue
        point, radius = _vantage(own)
        d = distance(own, point)
        if (d <= radius + within).sum() + (d > radius).sum() > OVERLAP * len(own):
            held[2 * k + 1], held[2 * k + 2] = own, own[:0]
            continue
        tree[k] = (int(point), radius)
        near = d <= radius
        held[2 * k + 1], held[2 * k + 2] = own[near], own[~near]
    return tree


def route(points: np.ndarray, tree: list[tuple[int, int] | None], within: int) -> list[tuple[int, np.ndarray]]:
    """(leaf, positions) for each leaf that a point belongs to or may have a partner in."""
    out, held = [], {0: np.arange(len(points))}
    for k in range(2 * len(tree) + 1):
        own = held.pop(k, None)
        if own is None or not len(own):
            continue
        if k >= len(tree):
            out.append((k, own))
        elif tree[k] is None:
            held[2 * k + 1] = own
        else:
            d = distance(points[own], np.uint64(tree[k][0]))
            held[2 * k + 1], held[2 * k + 2] = own[d <= tree[k][1] + within], own[d > tree[k][1]]
    return out


class _Union:
    def __init__(self, n: int):
        self.root = list(range(n))

    def find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.root[max(a, b)] = min(a, b)


def _flood(points: np.ndarray, index: np.ndarray, union: _Union, within: int) -> None:
    """Components of a dense block: each point is compared once with those not reached yet."""
    left = index
    while len(left):
        wave, left = left[:1], left[1:]
        while len(wave) and len(left):
            reached = np.zeros(len(left), bool)
            for k in wave:
                near = distance(points[left], points[k]) <= within
                for x in left[near & ~reached]:
                    union.join(int(k), int(x))
                reached |= near
            wave, left = left[reached], left[~reached]


def _every(points: np.ndarray, index: np.ndarray, union: _Union, within: int) -> None:
    """All distances of a block, some rows at a time; many links show a dense block."""
    p, found, total = points[index], [], 0
    rows = max(1, min(512, CELLS // max(1, len(p))))
    for a in range(0, len(p), rows):
        at = np.flatnonzero((np.bitwise_count(p[a : a + rows, None] ^ p[None, a:]) <= within).ravel())
        x, y = np.divmod(at, len(p) - a)
        x, y = x[x < y], y[x < y]
        total += len(x)
        if total > 20 * len(p):
            _flood(points, index, union, within)
            return
        found.append((index[a + x], index[a + y]))
    for x, y in found:
        for i, j in zip(x.tolist(), y.tolist(), strict=True):
            union.join(i, j)


def _blocks(points: np.ndarray, index: np.ndarray, union: _Union, within: int) -> None:
    """Inner levels of a shard's tree, down to blocks where every distance is taken."""
    todo = [index]
    while todo:
        own = todo.pop()
        if len(own) <= BLOCK:
            _every(points, own, union, within)
            continue
        point, radius = _vantage(points[own])
        d = distance(points[own], point)
        near, far = own[d <= radius + within], own[d > radius]
        if len(near) ** 2 + len(far) ** 2 > 0.97 * len(own) ** 2:  # parting would cost as much as taking every distance
            _every(points, own, union, within)
        else:
            todo += [near, far]


def shard_links(fps: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints that have a partner, and the smallest fingerprint (signed) of each one's component."""
    points = np.unique(fps.view(np.uint64).view(np.int64)).view(np.uint64)
    union = _Union(len(points))
    _blocks(points, np.arange(len(points)), union, within)
    root = np.array([union.find(k) for k in range(len(points))], np.int64)
    linked = root != np.arange(len(points))
    return points[linked].view(np.int64), points[root[linked]].view(np.int64)


def _routed(fps: DataFrame, trees: dict[int, list[tuple[int, int] | None]], within: int) -> DataFrame:
    """(leaf, sub, fp) rows dealt anew: those of a leaf that has a tree to its shards, numbered as ``sub``; all others as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, subs, points = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "sub", "fp"))
            for leaf in np.unique(leaves).tolist():
                own = points[leaves == leaf].view(np.uint64)
                parts = route(own, trees[leaf], within) if leaf in trees else [(None, slice(None))]
                for sub, at in parts:
                    some = own[at]
                    held = subs[leaves == leaf] if sub is None else np.full(len(some), sub, np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), leaf, np.int32)), pa.array(held), pa.array(some.view(np.int64))], ["leaf", "sub", "fp"])

    return map_arrow(fps.select("leaf", "sub", "fp"), run, "leaf int, sub int, fp long")


def _levels_below(dealt: DataFrame, over: dict[int, int], shard: int, within: int) -> dict[int, list[tuple[int, int] | None]]:
    """Trees of over-full leaves, each grown on an executor from at most about SAMPLE of the leaf's points.

    The driver gets a vantage point and a radius for each node, at most 2**LEVELS of them for each of the upper
    tree's leaves: 40 MB in all.
    """
    depth = {leaf: max(1, min(LEVELS, int(np.ceil(np.log2(n / shard))))) for leaf, n in over.items()}
    rows = dealt.sparkSession.createDataFrame([(leaf, min(1.0, 16 * 2 ** depth[leaf] / n)) for leaf, n in over.items()], "leaf int, share double")  # as many rows as leaves
    drawn = dealt.select("leaf", "fp").join(F.broadcast(rows), "leaf").filter(F.xxhash64("fp", F.lit(9)).bitwiseAND(F.lit(0xFFFFFFFF)) < F.col("share") * 2**32)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        leaf = int(pdf["leaf"].iloc[0])
        nodes = build_tree(np.sort(pdf["fp"].to_numpy()).view(np.uint64), depth[leaf], within)
        kept = [(leaf, k, np.uint64(v[0]).astype(np.int64), v[1]) for k, v in enumerate(nodes) if v is not None]
        return pd.DataFrame(kept, columns=["leaf", "node", "point", "radius"]).astype({"leaf": "int32", "node": "int32", "point": "int64", "radius": "int32"})

    trees: dict[int, list[tuple[int, int] | None]] = {leaf: [None] * (2**d - 1) for leaf, d in depth.items()}
    for r in drawn.select("leaf", "fp").groupBy("leaf").applyInPandas(grow, "leaf int, node int, point long, radius int").collect():
        trees[r["leaf"]][r["node"]] = (r["point"] & (2**64 - 1), r["radius"])
    return {leaf: t for leaf, t in trees.items() if any(t)}


def _tiled(dealt: DataFrame, most: int) -> DataFrame:
    """(leaf, sub, i, j, fp): shards of over ``most`` points as tiles of two chunks of about half as many, all others as the tile (0, 0)."""
    counts = dealt.groupBy("leaf", "sub").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    sizes = stage(counts.select("leaf", "sub", F.ceil(F.col("n") * 2 / most).cast("int").alias("chunks")), "simhash-tiles")
    if not sizes.limit(1).count():
        return dealt.select("leaf", "sub", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp")
    own = F.pmod(F.xxhash64("fp", F.lit(13)), F.col("chunks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda x: x != own)
    homes = F.transform(others, lambda x: F.struct(F.least(own, x).alias("i"), F.greatest(own, x).alias("j")))
    one = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    joined = dealt.join(sizes, ["leaf", "sub"], "left").select("leaf", "sub", "fp", F.explode(F.when(F.col("chunks").isNull(), one).otherwise(homes)).alias("home"))
    return joined.select("leaf", "sub", "home.i", "home.j", "fp")


def fingerprint_links(fps: DataFrame, within: int = RADIUS, shard: int = SHARD, most: int = MOST) -> DataFrame:
    """(a, b) links of fingerprints that join all and only those within reach of steps of ``within`` bits; ``fps`` has distinct longs."""
    n = fps.count()
    depth = max(0, min(int(np.ceil(np.log2(max(n, 1) / shard))), LEVELS))
    share = min(1.0, 0.9 * min(SAMPLE, 64 * 2**depth) / max(n, 1))
    sample: list[int] = []
    if depth:
        cut = int(share * 2**32)
        sample = [r[0] for r in fps.filter((F.xxhash64("fp", F.lit(7)).bitwiseAND(F.lit(0xFFFFFFFF))) < cut).limit(SAMPLE).collect()]
    upper = build_tree(np.sort(np.array(sample, np.int64)).view(np.uint64), depth, within)
    first = _routed(fps.select(F.lit(0).alias("leaf"), F.lit(0).alias("sub"), "fp"), {0: upper}, within).select(F.col("sub").alias("leaf"), F.lit(0).alias("sub"), "fp")
    dealt = stage(first, "simhash-dealt")
    leaves = dealt.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["leaf"]: r["n"] for r in leaves.collect()}  # a row for each leaf of the upper tree
    over = {leaf: n for leaf, n in sizes.items() if n > most}
    trees = _levels_below(dealt, over, shard, within) if over else {}
    if trees:
        dealt = stage(_routed(dealt, trees, within), "simhash-dealt")
    if over:
        dealt = _tiled(dealt, most)
    else:
        dealt = dealt.withColumns({"i": F.lit(0), "j": F.lit(0)})

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = shard_links(pdf["fp"].to_numpy(), within)
        return pd.DataFrame({"a": a, "b": b})

    # the stage is short of bytes and long of work, so it keeps a partition for each shard of usual size
    parts = max(2**depth, min(100_000, sum(sizes.values()) // shard))
    keys = ["leaf", "sub", "i", "j"]
    return dealt.repartition(parts, *keys).groupBy(*keys).applyInPandas(search, "a long, b long")


def near_duplicates(docs: DataFrame, within: int = RADIUS, shingle: int = SHINGLE, by: str = "doc_id") -> DataFrame:
    """(by, fingerprint, component_id): the smallest ``by`` of each text's component of linked fingerprints.

    Documents cross shuffles only as an id and a fingerprint; equal fingerprints are one point with its
    smallest id, counted before the shuffle, and hot fingerprints meet their component in a join that adaptive
    execution can split.
    """
    marked = stage(fingerprints(docs, shingle, (by,)), "simhash")
    points = stage(marked.groupBy("fp").agg(F.min(by).alias("least")), "simhash-points")
    roots = components(fingerprint_links(points.select("fp"), within))
    linked = points.join(roots, points["fp"] == roots["a"]).select(F.col("fp").alias("point"), "root", "least")
    # written, so that both sides of the next join are dealt for it alone and a hot component can be split
    firsts = stage(linked.groupBy("root").agg(F.min("least").alias("first")), "simhash-firsts").withColumnRenamed("root", "__root")
    moved = linked.join(firsts, linked["root"] == firsts["__root"]).select("point", "first")
    classes = stage(points.join(moved, points["fp"] == moved["point"], "left").select(F.col("fp").alias("point"), F.coalesce("first", "least").alias("component_id")), "simhash-classes")
    joined = marked.join(classes, marked["fp"] == classes["point"])
    return joined.select(by, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
