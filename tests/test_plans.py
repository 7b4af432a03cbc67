"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from chartloom.operators import changes, keyed, lookups
from chartloom.catalog.joins import assembled

SF = "/root/testdata/sf0.001"
STREAMS = {"stream_enrich", "stream_stage_state", "stream_dedup", "stream_upsert"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def shuffled(spark):
    """No broadcast: the plans as they are for large sides."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - STREAMS))
def test_no_pairwise_join(shuffled, name):
    text = plan(entry.queries()[name](shuffled, SF))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_flagship_shuffles_base_three_times(shuffled):
    """By id for two lookups, by track key for three, by video id for one."""
    text = plan(assembled(shuffled, SF))
    spine = re.findall(r"Exchange hashpartitioning\((__by_id|__by_key|__lk)#", text)
    assert sorted(spine) == ["__by_id", "__by_key", "__lk"]
    assert "BroadcastExchange" not in text


def test_top_n_cuts_before_the_exchange(shuffled):
    text = plan(keyed.top_n(shuffled.range(100).withColumn("k", F.col("id") % 3), "k", "id", 2))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_columns_and_filters_reach_the_scan(shuffled):
    text = plan(entry.queries()["top_n_per_key"](shuffled, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int>" in text
    text = plan(entry.queries()["slice_rows"](shuffled, SF))
    assert "GreaterThanOrEqual(p_partkey,20)" in text and "LessThan(p_partkey,120)" in text


def test_delete_is_two_equi_joins(shuffled):
    df = shuffled.createDataFrame([("a", "b")], "id string, key string")
    text = plan(changes.delete_matching(df, df, ["id", "key"]))
    assert text.count("LeftAnti") == 2


@pytest.mark.parametrize("n", [1, 5])
def test_result_does_not_depend_on_partitions(spark, n):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey")
    order = ["l_orderkey", "l_linenumber", "l_suppkey"]
    base = sorted(tuple(r) for r in keyed.last_wins(df, "l_partkey", order).collect())
    assert sorted(tuple(r) for r in keyed.last_wins(df.repartition(n, F.rand(3)), "l_partkey", order).collect()) == base


def test_hot_base_key_is_split(spark):
    """A third of the base on one key: AQE splits its partition in both of two
    lookups on the same probe, and the result is whole."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "12",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string")))
        base = spark.range(0, 60_000, 1, 8).select("id", key.alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        probed = lookups.with_probe(base, F.col("key"), "__probe", ["id"])
        out = probed
        for name in ("n", "m"):
            side = base.groupBy("key").agg(F.count(F.lit(1)).alias(name)).withColumnRenamed("key", "k")
            out = lookups.left_lookup(out, side, "__probe", "k", ["id"])
        rows = out.collect()
        assert len(rows) == 60_000 and {(r.n, r.m) for r in rows if r.key == "hot"} == {(20_000, 20_000)}
        assert plan(out).split("Initial Plan")[0].count("skew=true") == 2, plan(out)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
