import pytest

from drayline.llm.sharding import read_shards, write_shards


@pytest.mark.parametrize("rows,shards", [(1000, 8), (17, 8), (8, 8), (3, 8), (50, 1)])
def test_shards_are_equal_gapless_and_complete(spark, run, rows, shards):
    docs = spark.range(0, rows, 1, 5).selectExpr("id AS doc_id", "repeat('x', int(id % 50)) AS text", "id AS slot")
    write_shards(docs, f"{run.path}/shards", shards, bucket_bytes=2000)
    got = read_shards(spark, f"{run.path}/shards", docs.schema).collect()
    assert sorted(r.doc_id for r in got) == list(range(rows))
    by_shard = {k: sorted(r.slot for r in got if r.shard == k) for k in range(shards)}
    assert all(v == list(range(len(v))) for v in by_shard.values())
    sizes = [len(v) for v in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == rows


def test_order_is_random_and_repeatable(spark, run):
    docs = spark.range(0, 2000, 1, 4).selectExpr("id AS doc_id", "'same text' AS text")
    orders = []
    for name, seed in (("a", 1), ("b", 1), ("c", 2)):
        write_shards(docs, f"{run.path}/{name}", 4, seed=seed, bucket_bytes=3000)
        got = read_shards(spark, f"{run.path}/{name}", docs.schema).collect()
        orders.append([r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))])
    assert orders[0] == orders[1] != orders[2]
    shard_of = {d: i // 500 for i, d in enumerate(orders[0])}
    for quarter in range(4):  # each quarter of the input spreads over all shards
        counts = [sum(shard_of[d] == s for d in range(500 * quarter, 500 * quarter + 500)) for s in range(4)]
        assert min(counts) > 80


def test_messy_and_empty(messy, nothing, run, spark):
    write_shards(messy, f"{run.path}/m", 3)
    got = read_shards(spark, f"{run.path}/m", messy.schema)
    assert got.select(messy.columns).exceptAll(messy).count() == 0 and got.count() == 10
    write_shards(nothing, f"{run.path}/n", 3)
    assert read_shards(spark, f"{run.path}/n", nothing.schema).collect() == []
    with pytest.raises(ValueError):
        write_shards(messy, f"{run.path}/z", 0)
