import pytest

from folioframe.llm.sharding import CommitConflict, Shard, ShardStore, ingest


def rows(df):
    return sorted(map(str, df.collect()))


def test_compaction_keeps_rows(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    store = ShardStore(spark, f"file://{tmp_path}/s", target_bytes=200_000, fanout=3, least_bytes=2_000)
    for i in range(4):
        store.append(docs.where(f"doc_id % 4 = {i}").repartition(3))
    before = store.manifest()
    store.compact()
    after = store.manifest()
    assert rows(store.read()) == rows(docs) == rows(store.read(before["version"]))
    assert len(after["shards"]) < len(before["shards"]) and not store.runs(after["shards"])
    assert after["version"] > before["version"] == 4
    assert store.vacuum() == 0 and store.vacuum(keep_versions=1) == 0 and rows(store.read(before["version"])) == rows(docs)
    assert store.vacuum(keep_versions=1, older_than_s=0) > 0 and rows(store.read()) == rows(docs)


def test_two_writers_and_vacuum(spark, small, tmp_path):
    """A writer's shards that aren't committed yet outlast another's vacuum, and its commit goes on top of the other's."""
    region = spark.read.parquet(f"{small}/region.parquet")
    one, two = (ShardStore(spark, f"file://{tmp_path}/s") for _ in range(2))
    one.append(region)
    base, written = two.manifest(), two._write(region)
    one.append(region)
    assert one.vacuum() == 0
    with pytest.raises(CommitConflict):
        two._commit(base, base["shards"] + written, base["schema"])
    real, calls = two.manifest, []

    def late(version=None):
        calls.append(version)
        return base if len(calls) == 1 else real(version)

    two.manifest = late
    two.append(region)
    two.manifest = real
    assert two.version() == 3 and two.read().count() == 3 * region.count()


def test_commits_conflict(spark, small, tmp_path):
    store = ShardStore(spark, f"file://{tmp_path}/s")
    region = spark.read.parquet(f"{small}/region.parquet")
    base = store.manifest()
    store.append(region)
    with pytest.raises(CommitConflict):
        store._commit(base, [], None)
    assert store.version() == 1 and store.read().count() == region.count()
    with pytest.raises(ValueError):
        store.append(region.withColumnRenamed("r_name", "other"))


def test_tiers_and_runs(spark, tmp_path):
    store = ShardStore(spark, f"file://{tmp_path}/s", target_bytes=1000, fanout=4, least_bytes=10)
    s = [Shard(f"a{i}", 20, store.tier_of(20)) for i in range(4)] + [Shard("big", 900, store.tier_of(900)), Shard("mid", 100, store.tier_of(100))]
    assert [[x.path for x in run] for run in store.runs(s)] == [["a0", "a1", "a2", "a3"]]
    assert store.tier_of(20) < store.tier_of(100) < store.tier_of(900)
    assert store.runs(s[:3]) == []


def test_odd_rows(spark, tmp_path):
    df = spark.createDataFrame([(None, None), (1, "x" * 300_000), (1, "a"), (1, "a"), (2, "")], "doc_id long, text string").selectExpr("*", "1 AS version")
    store = ingest([df, df.limit(0)], f"file://{tmp_path}/s", fanout=2)
    assert rows(store.read()) == rows(df)
    empty = ingest([df.limit(0)], f"file://{tmp_path}/e")
    assert empty.read().count() == 0
    with pytest.raises(ValueError):
        ShardStore(spark, f"file://{tmp_path}/none").read()
