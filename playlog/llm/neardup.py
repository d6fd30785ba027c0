"""Near-duplicates among texts: SimHash fingerprints propose, whole shingle sets decide, and MinHash keys find the rest.

A link is a Jaccard similarity of 0.8 or more between two texts' sets of five-word shingles, taken over the whole
sets. Texts of equal sets are one point. Links are sought in two steps.

1. The fingerprints of the sets go through the operator of ``simhash``: vantage-point trees give the components of
   fingerprints within ``simhash.RADIUS`` bits. Each point is compared with the smallest point of its component.
2. At a similarity of 0.8, fingerprints lie about 10 of 64 bits apart, where spheres prune nothing. So each point
   has BANDS keys too, each of ROWS minima of hash functions; two points of similarity s share a key with probability
   1 - (1 - s^ROWS)^BANDS, 0.999997 at s = 0.8. Each point is compared with the smallest point that it shares a key
   with. Keys whose points the links so far have all joined are done. Of the others, every pair of points that isn't
   joined yet is looked at, in tiles of bounded size: first by the minima's last bytes, then by the whole sets.

Pairs whose sets' sizes differ too much, or that agree in under LIKELY of BANDS x ROWS last bytes, aren't compared: at
a similarity of 0.8 the latter has a probability of 0.0000005. So only ids, keys and last bytes travel for pairs that
merely resemble each other. A tile of so many likely pairs that they outgrow its points is a dense one: its sets are
brought together once, and flooded, where each point is compared once with those not reached yet.

Defined results: words are as in ``simhash.fingerprint``; fewer than ``SHINGLE`` words are one shingle; null and blank
texts have no shingles and equal one another only; a null doc_id is never the smallest unless all are null; of equal
ids any one row stays; a very long text is one set, held once in a task at a time; an empty table gives no rows;
further columns are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import map_arrow, stage, text_bytes, unused, with_row_id
from .components import components
from .simhash import fingerprint_links, majority

SHINGLE, SEED = 5, 42
#: Similarity of a link, as a ratio of integers.
NEAR = (4, 5)
BANDS, ROWS = 24, 4
#: Points of a key that one task compares, about; pairs for each point, beyond which a tile is dense; least share of last bytes in common.
TILE, PAIRS, LIKELY = 512, 4, 0.6
_RNG = np.random.default_rng(SEED)
_A, _C = _RNG.integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1), _RNG.integers(0, 2**64, BANDS * ROWS, np.uint64)


def shingles(text: bytes) -> np.ndarray:
    """Distinct hashes of the text's word shingles, sorted."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    parts = [b" ".join(words)] if len(words) < SHINGLE else map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
    return np.unique(np.fromiter(map(xxh64_intdigest, parts, repeat(SEED)), np.uint64))


def band_keys(own: np.ndarray) -> tuple[list[int], bytes]:
    """The signed keys of a shingle set, none for the empty set, and the last bytes of its minima."""
    if not len(own):
        return [], bytes(BANDS * ROWS)
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, len(own), 1024):
        least = np.minimum(least, (own[at : at + 1024, None] * _A + _C).min(axis=0))
    keys = [xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist(), (least >> np.uint64(8)).astype(np.uint8).tobytes()


def _likely(marks: np.ndarray, sizes: np.ndarray, mark: np.ndarray, size: int | np.ndarray) -> np.ndarray:
    """Whether sets with these last bytes and sizes may be near one another."""
    fits = (np.minimum(sizes, size) * NEAR[1] >= np.maximum(sizes, size) * NEAR[0]) & (sizes > 0)
    return fits & ((marks == mark).sum(1) >= LIKELY * BANDS * ROWS)


def _near(shared: np.ndarray, a: np.ndarray, b: int) -> np.ndarray:
    return shared * NEAR[1] >= (a + b - shared) * NEAR[0]


def near_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links of positions that join all and only those within reach of steps of similarity NEAR or more; no set is empty."""
    sizes = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    codes = np.split(codes, np.cumsum(sizes)[:-1])
    mark = np.zeros(max(int(c.max()) for c in codes) + 1, np.int64)
    links, left = [], np.arange(len(sets))
    while len(left) > 1:
        wave, left = left[:1], left[1:]
        while len(wave) and len(left):
            flat, starts = np.concatenate([codes[k] for k in left]), np.concatenate([[0], np.cumsum(sizes[left])[:-1]])
            reached = np.zeros(len(left), bool)
            for k in wave:
                mark[codes[k]] = 1
                near = _near(np.add.reduceat(mark[flat], starts), sizes[left], sizes[k]) & ~reached
                mark[codes[k]] = 0
                links += [(int(k), int(x)) for x in left[near]]
                reached |= near
                if reached.all():
                    break
            wave, left = left[reached], left[~reached]
    return links


def _keyed(rows: DataFrame, name: str) -> DataFrame:
    """(id, same, size, fp, keys, marks): the row's order, a digest of its shingle set, the set's size and fingerprint, its band keys and last bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingles(t) for t in text_bytes(batch, "text")]
            same = pa.array([blake2b(s.tobytes(), digest_size=16).digest() for s in own], pa.binary())
            fps = pa.array(np.array([majority(s) for s in own], np.uint64).view(np.int64))
            sizes = pa.array([len(s) for s in own], pa.int64())
            keys = [band_keys(s) for s in own]
            cols = [same, sizes, fps, pa.array([k for k, _ in keys], pa.list_(pa.int64())), pa.array([m for _, m in keys], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *cols], ["id", "same", "size", "fp", "keys", "marks"])

    # a struct orders by doc_id, then row
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").cast("long").alias("doc"), F.col(name).alias("row"))
    return map_arrow(rows.select(order.alias("id"), "text"), run, "id struct<n: boolean, doc: long, row: long>, same binary, size long, fp long, keys array<long>, marks binary")


def _sets(rows: DataFrame) -> DataFrame:
    """(point, own): the shingle set of each (point, text), as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array([shingles(t).tobytes() for t in text_bytes(batch, "text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("point"), own], ["point", "own"])

    return map_arrow(rows.select("point", "text"), run, "point long, own binary", 1 << 20)


def _tile_links(tiles: DataFrame) -> DataFrame:
    """(a, b) links of the points of each tile (key, i, j); rows (key, i, j, point, own)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links() -> pa.RecordBatch:
            found = near_links([np.frombuffer(s, np.uint64) for s in own])
            return pa.RecordBatch.from_arrays([pa.array([points[k] for k, _ in found], pa.int64()), pa.array([points[k] for _, k in found], pa.int64())], ["a", "b"])

        at, points, own = None, [], []
        for batch in batches:
            for *tile, point, one in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if tile != at:
                    if len(points) > 1:
                        yield links()
                    at, points, own = tile, [], []
                points.append(point)
                own.append(one)
        if len(points) > 1:
            yield links()

    dealt = tiles.select("key", "i", "j", "point", "own").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "point")
    return map_arrow(dealt, run, "a long, b long", 1 << 20)


def _compared(pairs: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., ok): whether two sets are near; rows (keep..., own, other)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b in zip(batch.column("own").to_pylist(), batch.column("other").to_pylist(), strict=True):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                ok.append(bool(_near(np.intersect1d(a, b, assume_unique=True).size, len(a), len(b))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(ok, pa.bool_())], [*keep, "ok"])

    return map_arrow(pairs.select(*keep, "own", "other"), run, ", ".join([*(f"{c} long" for c in keep), "ok boolean"]), 1 << 20)


def _marks(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)


def _likely_pairs(pairs: DataFrame) -> DataFrame:
    """(point, leader) of the pairs that may be near; rows (point, leader, size, marks, size2, marks2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, others = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("size", "size2"))
            ok = _likely(_marks(batch, "marks"), sizes, _marks(batch, "marks2"), others)
            yield batch.select(["point", "leader"]).filter(pa.array(ok, pa.bool_()))

    return map_arrow(pairs.select("point", "leader", "size", "marks", "size2", "marks2"), run, "point long, leader long")


def _tiles(rest: DataFrame, tile: int) -> DataFrame:
    """(key, i, j, point, root) tiles in which all points of a key that aren't joined yet meet; ``rest``: (key, point, root).

    Points of a key's largest class are joined already, so their chunks meet the others' chunks only.
    """
    classes = stage(rest.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n")), "dedup-classes")
    chunks = lambda c: F.ceil(c / tile).cast("int")
    most = classes.groupBy("key").agg(F.sum("n").alias("all"), F.max(F.struct("n", "root")).alias("most"))
    sizes = stage(most.select("key", F.col("most.root").alias("main"), (F.col("all") <= tile).alias("small"), chunks(F.col("most.n")).alias("near"), chunks(F.col("all") - F.col("most.n")).alias("far")), "dedup-counts")
    own = lambda n: F.pmod(F.xxhash64("point"), F.col(n)).cast("int")

    def pair(i: Column, j: Column) -> Column:
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))

    upto = lambda n, f: F.transform(F.sequence(F.lit(0), F.col(n) - 1), f)
    far = F.concat(upto("near", lambda r: pair(r, own("far"))), upto("far", lambda v: pair(-1 - F.least(v, own("far")), F.greatest(v, own("far")))))
    large = F.when(F.col("root") == F.col("main"), upto("far", lambda v: pair(own("near"), v))).otherwise(far)
    homes = F.when(F.col("small"), F.array(pair(F.lit(0), F.lit(0)))).otherwise(large)
    return rest.join(sizes.hint("merge"), "key").select("key", "point", "root", F.explode(homes).alias("home")).select("key", "home.i", "home.j", "point", "root")


def _tile_pairs(tiles: DataFrame) -> DataFrame:
    """Likely pairs of unjoined points in each tile as (key null, i, j, a, b), and the points of dense tiles as (key, i, j, a, b null).

    Rows of ``tiles``: (key, i, j, point, root, size, marks).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> pa.RecordBatch | None:
            points, roots, sizes = (np.array([r[k] for r in held], np.int64) for k in (0, 1, 2))
            marks = np.frombuffer(b"".join(r[3] for r in held), np.uint8).reshape(-1, BANDS * ROWS)
            out: list[np.ndarray] = []
            n = 0
            for k in range(len(points) - 1):
                ok = np.flatnonzero(_likely(marks[k + 1 :], sizes[k + 1 :], marks[k], sizes[k]) & (roots[k + 1 :] != roots[k]))
                n += len(ok)
                if n > PAIRS * len(points):
                    blank = pa.nulls(len(points), pa.int64())
                    return pa.RecordBatch.from_arrays([*(pa.array([v] * len(points), t) for v, t in zip(at, (pa.int64(), pa.int32(), pa.int32()), strict=True)), pa.array(points), blank], names)
                if len(ok):
                    out.append(np.stack([np.full(len(ok), points[k]), points[k + 1 :][ok]]))
            if not n:
                return None
            pairs = np.concatenate(out, axis=1)
            return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.array(pairs.min(0)), pa.array(pairs.max(0))], names)

        names = ["key", "i", "j", "a", "b"]
        at, held = None, []
        for batch in batches:
            for *tile, point, root, size, marks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if tile != at:
                    if len(held) > 1 and (rows := found()) is not None:
                        yield rows
                    at, held = tile, []
                held.append((point, root, size, marks))
        if len(held) > 1 and (rows := found()) is not None:
            yield rows

    dealt = tiles.select("key", "i", "j", "point", "root", "size", "marks").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "point")
    return map_arrow(dealt, run, "key long, i int, j int, a long, b long", 1 << 20)


def shared_keys(points: DataFrame) -> DataFrame:
    """(key, point, members) for keys of several points; of keys with the same points only one."""
    held = stage(points.select("point", F.explode("keys").alias("key")), "dedup-keys")
    mark = lambda k: F.bit_xor(F.xxhash64("point", F.lit(k)))
    sizes = held.groupBy("key").agg(F.count(F.lit(1)).alias("members"), mark(1).alias("x"), mark(2).alias("y")).filter("members > 1")
    sizes = stage(sizes.groupBy("members", "x", "y").agg(F.min("key").alias("key")).select("key", "members"), "dedup-sizes")
    return stage(held.join(sizes.hint("merge"), "key").select("key", "point", "members"), "dedup-members")


def proposed(points: DataFrame, members: DataFrame) -> DataFrame:
    """(point, leader): the smallest point of each point's fingerprint component, and the smallest that it shares a key with, where they may be near."""
    roots = components(fingerprint_links(points.select("fp").distinct()))
    classes = stage(points.join(roots, points["fp"] == roots["a"], "left").select("point", F.coalesce("root", "fp").alias("class")), "dedup-classes")
    # counted before the joins and written, so that both sides of each are dealt for it alone and a hot class or key can be split
    first = stage(classes.groupBy("class").agg(F.min("point").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("class", "leader"), "dedup-leaders")
    by_class = classes.join(first.hint("merge"), "class").select("point", "leader")
    smallest = stage(members.groupBy("key").agg(F.min("point").alias("leader")), "dedup-leaders")
    by_key = members.join(smallest.hint("merge"), "key").groupBy("point").agg(F.min("leader").alias("leader"))
    pairs = by_class.unionByName(by_key).filter("point != leader").distinct()
    seen = points.select("point", "size", "marks").hint("merge")
    others = seen.withColumnsRenamed({"point": "leader", "size": "size2", "marks": "marks2"})
    return stage(_likely_pairs(pairs.join(seen, "point").join(others, "leader")), "dedup-proposed")


def undone(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, point, root) of the keys whose points ``roots`` (a, root) doesn't all join."""
    known = roots.select(F.col("a").alias("point"), "root").hint("merge")
    placed = stage(members.join(known, "point", "left").select("key", "point", F.coalesce("root", "point").alias("root")), "dedup-placed")
    open_ = stage(placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x != y").select("key"), "dedup-open")
    return stage(placed.join(open_.hint("merge"), "key"), "dedup-rest")


def near_roots(rows: DataFrame, name: str, points: DataFrame, tile: int = TILE) -> DataFrame:
    """(a, root) of linked points; ``points``: (point, size, fp, keys, marks), a point being the ``name`` of one of ``rows``."""
    members = shared_keys(points)
    pairs = proposed(points, members)
    wanted = stage(members.select("point").unionByName(pairs.select("point")).unionByName(pairs.select(F.col("leader").alias("point"))).distinct(), "dedup-wanted")
    # merge joins at every size: a broadcast that ends at some size would make shuffles look as if they outgrew the input
    sets = stage(_sets(rows.select(F.col(name).alias("point"), "text").join(wanted.hint("merge"), "point")), "dedup-sets").hint("merge")

    def linked(some: DataFrame) -> DataFrame:
        one, two = sets.alias("one"), sets.alias("two")  # the same columns, so that the sets are shuffled once for both
        held = some.alias("p").join(one, F.col("p.point") == F.col("one.point"))
        near = _compared(held.join(two, F.col("p.leader") == F.col("two.point")).select("p.point", "p.leader", F.col("one.own").alias("own"), F.col("two.own").alias("other")), ["point", "leader"])
        return near.filter("ok").select(F.col("point").alias("a"), F.col("leader").alias("b"))

    roots = stage(components(linked(pairs)), "dedup-roots")
    known = roots.filter("a != root").select("a", F.col("root").alias("b"))
    seen = points.select("point", "size", "marks").hint("merge")
    looked = stage(_tile_pairs(_tiles(undone(members, roots), tile).join(seen, "point")), "dedup-looked")
    more = looked.filter("key is null").select(F.col("b").alias("point"), F.col("a").alias("leader")).distinct()
    links = linked(more).unionByName(known)
    dense = looked.filter("key is not null").select("key", "i", "j", F.col("a").alias("point"))
    if dense.limit(1).count():
        links = links.unionByName(_tile_links(dense.join(sets, "point")))
    return components(links)


def deduplicated(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """``docs`` with one row of each component, that with the smallest doc_id (of equal ids any one)."""
    name = unused(docs, "__row")
    rows = stage(with_row_id(docs, name), "dedup-rows")
    keyed = stage(_keyed(rows, name), "dedup-keyed")
    points = stage(keyed.groupBy("same").agg(F.min(F.struct("id", "size", "fp", "keys", "marks")).alias("m")).select("m.id", F.col("m.id.row").alias("point"), "m.size", "m.fp", "m.keys", "m.marks"), "dedup-points")
    roots = near_roots(rows, name, points.select("point", "size", "fp", "keys", "marks"), tile)
    joined = points.select("id", "point").join(roots, points["point"] == roots["a"], "left")
    kept = stage(joined.groupBy(F.coalesce("root", "point").alias("root")).agg(F.min("id").alias("id")).select(F.col("id.row").alias("__kept")), "dedup-kept")
    # a merge join at every size, as above
    return rows.join(kept.hint("merge"), rows[name] == kept["__kept"], "left_semi").select(*docs.columns)
