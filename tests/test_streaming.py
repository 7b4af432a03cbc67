from pyspark.sql import functions as F

from chartloom.session import new_workspace
from chartloom.streaming import flows


def write(spark, folder, n, rows, schema):
    # One file per call, named alike so that the stream's pattern takes them all.
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


EVENTS = "user_id bigint, event_type string, n bigint"


def test_upsert_across_batches_and_restarts(spark):
    folder, root = new_workspace(spark, "in"), new_workspace(spark, "out")
    seen = []

    def run():
        stream = flows.file_stream(spark, folder, "*.parquet", files_per_batch=1)
        flows.changes_to(stream, root, ["user_id"], order="n", on_batch=lambda df, b: seen.append((b, df.count())))

    write(spark, folder, 0, [(1, "a", 1), (1, "b", 2), (2, "a", 3)], EVENTS)
    write(spark, folder, 1, [(1, "c", 4)], EVENTS)
    run()
    write(spark, folder, 2, [(2, "z", 5), (3, "y", 6)], EVENTS)
    run()
    run()
    got = {r.user_id: r.event_type for r in flows.read_changes(spark, root, ["user_id"]).collect()}
    assert got == {1: "c", 2: "z", 3: "y"}
    assert [b for b, _ in seen] == [0, 1, 2] and sorted(n for _, n in seen) == [1, 2, 2]
    flows.compact(spark, root, ["user_id"], f"{root}/published")
    from chartloom.sources.tables import read_published

    assert read_published(spark, f"{root}/published", "user_id bigint").count() == 3


def test_stage_state(spark):
    folder, root = new_workspace(spark, "in"), new_workspace(spark, "out")
    stages = ["audio", "links", "awards"]

    def run():
        stream = flows.file_stream(spark, folder, "*.parquet", files_per_batch=1)
        flows.changes_to(flows.stage_state(stream, "user_id", "event_type", stages), root, ["user_id"], mode="update")
        return {r.user_id: (r.stages, r.done) for r in flows.read_changes(spark, root, ["user_id"]).collect()}

    write(spark, folder, 0, [(1, "links", 1), (1, "links", 2), (2, "other", 3)], EVENTS)
    assert run() == {1: (["links"], False), 2: ([], False)}
    write(spark, folder, 1, [(1, "audio", 4), (1, "awards", 5)], EVENTS)
    assert run()[1] == (["audio", "links", "awards"], True)


def test_once_per_key(spark):
    folder, root = new_workspace(spark, "in"), new_workspace(spark, "out")

    def run():
        stream = flows.file_stream(spark, folder, "*.parquet").select(F.col("user_id").alias("track_key"))
        flows.once_per_key(stream, root, "track_key")
        return sorted(r.track_key for r in flows.read_once(spark, root).collect())

    write(spark, folder, 0, [(1, "a", 1), (1, "b", 2)], EVENTS)
    assert run() == [1]
    write(spark, folder, 1, [(1, "c", 3), (2, "a", 4)], EVENTS)
    assert run() == [1, 2]


def test_newest_row_wins_over_batches_out_of_order(spark):
    folder, root = new_workspace(spark, "in"), new_workspace(spark, "out")
    for batch, row in enumerate([(1, "new", 9), (1, "old", 3)]):
        write(spark, folder, batch, [row], EVENTS)
        flows.changes_to(flows.file_stream(spark, folder, "*.parquet"), root, ["user_id"], order="n")
    assert [r.n for r in flows.read_changes(spark, root, ["user_id"], order="n").collect()] == [9]


def test_once_per_key_reads_only_the_buckets_it_needs(spark):
    """Several files out of order, NULL keys, restarts; a batch reads no other bucket."""
    folder, root = new_workspace(spark, "in"), new_workspace(spark, "out")
    shape = "k string, n int"

    def run():
        flows.once_per_key(flows.file_stream(spark, folder, "*.parquet", files_per_batch=1), root, "k", buckets=8)
        return sorted(((r.k, r.n) for r in flows.read_once(spark, root).collect()), key=str)

    write(spark, folder, 0, [(f"k{i}", i) for i in range(40)] + [(None, -1), (None, -1)], shape)
    first = run()
    assert len(first) == 41 and first.count((None, -1)) == 1
    for n in (100, 200):
        write(spark, folder, n, [("k3", n), (None, n), ("k3", n)], shape)
    write(spark, folder, 300, [("new", 300)], shape)
    assert run() == sorted([*first, ("new", 300)], key=str)
    assert run() == sorted([*first, ("new", 300)], key=str)
    rows = spark.createDataFrame([("k3", 1)], shape)
    touched = [r[0] for r in rows.selectExpr("CAST(pmod(xxhash64(k), 8) AS INT)").collect()]
    before = flows.keys_before(rows, root, "k", 9, touched)
    text = before._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "bucket#" in text.split("PartitionFilters")[1]
    assert {r["__key"] for r in before.collect()} < {f"k{i}" for i in range(40)} | {None, "new"}
