"""A copy group of a third of all rows, most of it still waiting after the rounds, is cut only where shards are full."""

from playlog.llm import sharding as H


def test_hot_group_stays_in_few_shards(spark):
    n, hot, shards = 480, 160, 24
    links = [(3 * k, "hot") for k in range(hot)] + [(3 * k + 1, f"p{k // 2}") for k in range(hot)]
    docs = spark.range(n).select("id").withColumnRenamed("id", "row")
    placed = H.propagate(docs, spark.createDataFrame(links, "row long, group string"), shards, rounds=1).collect()
    homes, counts = {}, {}
    for r in placed:
        counts[r.shard] = counts.get(r.shard, 0) + 1
        if r.row % 3 == 0:
            homes[r.shard] = homes.get(r.shard, 0) + 1
    assert len(placed) == n and set(counts.values()) == {n // shards} and len(counts) == shards
    assert len(homes) <= 12, homes  # 8 full shards hold the group
