"""Balanced shards by label propagation, with DataFrame functions only.

Links are given as groups of documents: two documents are linked if they share a group. Documents start spread
evenly; in each round every linked document votes for the shard that holds most of its neighbours, and moves
there as far as the shard's quota lasts. Documents with most neighbours there come first, those of a group in a
row. A document that finds no room waits and votes again among the shards with room left. At last any that
still wait fill the free places, those of a group in a row and large groups in the emptiest shards, then documents
without links, so that the shards' counts differ by one at most and a group is cut only where a shard is full.

Votes are counted by (group, shard) before the shuffle, and quotas are shared out by counts over buckets, so
neither a hot group nor a full shard meets in one task. Each round is written to the shared folder.

Defined results: a null text has no bytes; documents with a null group have no links; repeated rows are
documents of their own; ties go by a hash; a very long text is read once, for its size and digest; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ranked, stage

SHARDS, ROUNDS = 24, 4
#: Rows that a bucket of a distributed rank holds, about.
BUCKET_ROWS = 512


def _spread(n: int, *cols: str | Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(max(1, -(-n // BUCKET_ROWS)))).cast("int")


def _capacity(n: int, shards: int) -> Column:
    """Places of column ``shard``: n dealt out evenly, the first shards one more."""
    return F.lit(n // shards) + (F.col("shard") < n % shards).cast("long")


def _admitted(wishes: DataFrame, room: DataFrame, n: int) -> DataFrame:
    """Column ``ok`` for each wish (row, wish, gain, anchor, members): within the room of the wished shard, higher gains first.

    The rows of an anchor group follow one another, so that a quota cuts one group of those with equal gains; a
    bucket holds about BUCKET_ROWS rows, as larger groups are spread over several.
    """
    parts = F.ceil(F.col("members") / BUCKET_ROWS).cast("int")
    bucket = F.struct((-F.col("gain")).alias("g"), _spread(n, "anchor").alias("b"), F.pmod(F.xxhash64("row"), parts).cast("int").alias("c"))
    ordered = ranked(wishes, ["wish"], F.struct("anchor", "row"), bucket, "place")
    return ordered.join(F.broadcast(room), ordered["wish"] == room["shard"]).withColumn("ok", F.col("place") < F.col("free")).drop("free", "shard", "place")


def propagate(docs: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(row, shard) for each ``row`` of ``docs``; ``links``: (row, group) memberships, groups of one document allowed."""
    n = docs.count()
    pairs = stage(links.filter("row is not null and `group` is not null").select("row", "group").distinct(), "shard-links")
    # counts are written before a join on the same key, so that both sides are dealt for it alone and a hot group can be split
    sizes = stage(pairs.groupBy("group").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "shard-sizes")
    pairs = stage(pairs.join(sizes, "group").select("row", "group", "members"), "shard-links")
    linked = pairs.select("row").distinct()
    # an even start; the first votes break even by a hash of the group, so that its members agree on one shard
    state = stage(linked.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")), "shard-state")
    all_shards = docs.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))  # as many rows as shards
    for k in range(rounds):
        settled = state.filter("shard is not null")
        held = settled.groupBy("shard").agg(F.count(F.lit(1)).alias("held"))
        room = all_shards.join(held, "shard", "left").select("shard", (_capacity(n, shards) - F.coalesce("held", F.lit(0))).alias("free"))
        votes = pairs.join(state, "row").groupBy("group").agg(*(F.count(F.when(F.col("shard") == s, 1)).alias(f"v{s}") for s in range(shards)))
        votes = stage(votes, "shard-votes")
        known = pairs.join(votes, "group").groupBy("row").agg(F.min("group").alias("anchor"), F.max("members").alias("members"), *(F.sum(f"v{s}").alias(f"v{s}") for s in range(shards)))
        known = known.join(state, "row")
        full = [r["shard"] for r in room.filter("free <= 0").collect()] if k else []  # shard numbers
        best = F.array_max(
            F.array(*(F.struct((F.col(f"v{s}") - (F.lit(s).isin(full) & ~F.col("shard").eqNullSafe(s)).cast("long") * n).alias("n"), F.xxhash64("anchor", F.lit(s)).alias("tie"), F.lit(s).alias("s")) for s in range(shards)))
        )
        gain = F.floor(F.log2(F.greatest(F.col("best.n"), F.lit(1)))).cast("int")
        # written, since ranks read it twice
        wishes = stage(known.withColumn("best", best).select("row", "anchor", "members", "shard", F.col("best.s").alias("wish"), gain.alias("gain")), "shard-wishes")
        if k and not wishes.filter(~F.col("wish").eqNullSafe(F.col("shard"))).limit(1).count():
            break  # nobody waits or wants to move
        capacity = all_shards.select("shard", _capacity(n, shards).alias("free"))
        state = stage(_admitted(wishes.drop("shard"), capacity, n).select("row", F.when(F.col("ok"), F.col("wish")).alias("shard")), "shard-state")
    anchors = pairs.groupBy("row").agg(F.max(F.struct("members", "group")).alias("most")).select("row", "most.members", F.col("most.group").alias("anchor"))
    return _filled(docs, state, anchors, all_shards, n, shards)


def _filled(docs: DataFrame, state: DataFrame, anchors: DataFrame, all_shards: DataFrame, n: int, shards: int) -> DataFrame:
    """``state`` with every other row in the places left: their ranks run through the shards' free places, emptiest first.

    Linked rows come before others, larger groups first and the rows of a group in a row; ``anchors``: (row, members,
    anchor), the largest group of each linked row.
    """
    from pyspark.sql import Window

    settled = state.filter("shard is not null")
    held = settled.groupBy("shard").agg(F.count(F.lit(1)).alias("held"))
    free = all_shards.join(held, "shard", "left").select("shard", (_capacity(n, shards) - F.coalesce("held", F.lit(0))).alias("free"))
    before = Window.orderBy(-F.col("free"), "shard").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as shards
    free = free.withColumn("first", F.coalesce(F.sum("free").over(before), F.lit(0))).filter("free > 0")
    others = docs.select("row").join(settled, "row", "left_anti").join(anchors, "row", "left")
    size = -F.coalesce(F.floor(F.log2("members")).cast("int"), F.lit(0))
    parts = F.ceil(F.coalesce("members", F.lit(1)) / BUCKET_ROWS).cast("int")
    spread = F.when(F.col("anchor").isNull(), _spread(n, "row", F.lit(5))).otherwise(_spread(n, "anchor"))
    bucket = F.struct(size.alias("g"), spread.alias("b"), F.pmod(F.xxhash64("row"), parts).cast("int").alias("c"))
    others = ranked(others, [], F.struct("anchor", "row"), bucket, "place")
    inside = (F.col("place") >= F.col("first")) & (F.col("place") < F.col("first") + F.col("free"))
    return settled.select("row", "shard").unionByName(others.join(F.broadcast(free), inside).select("row", "shard"))


def cut_links(placed: DataFrame, links: DataFrame) -> DataFrame:
    """One row: members of groups, and those outside their group's largest part."""
    parts = links.join(placed, "row").groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n")).groupBy("group").agg(F.sum("n").alias("all"), F.max("n").alias("most"))
    return parts.agg(F.sum("all").alias("members"), F.sum(F.col("all") - F.col("most")).alias("apart"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) with equal texts as the links; law ``rows``.

    The texts are read once, for their size and digest; all else works on a narrow table.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.unhex(F.sha2(raw, 256)).alias("group"), F.monotonically_increasing_id().alias("row"))
    narrow = stage(narrow, "shard-docs")
    placed = stage(propagate(narrow, narrow.select("row", "group"), shards, rounds), "shard-placed")
    n = narrow.count()
    slots = ranked(placed, ["shard"], F.col("row"), _spread(n // shards, "row", F.lit(9)), "slot")
    out = narrow.join(slots, "row")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
