"""A key holding most rows: partial aggregation and adaptive skew join."""

from pyspark.sql import functions as F

from destrank.operators.enrich import dedup_first, first_per_key, lookup_first, lookup_join

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_key_lookup_is_exact_and_split(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        # Key 0 holds 20,000 of 20,400 left rows.
        left = spark.range(20_400).select(
            F.col("id").alias("row_id"), F.when(F.col("id") < 20_000, 0).otherwise(F.col("id") % 40 + 1).alias("k")
        )
        lookup = spark.range(400).select((F.col("id") % 41).alias("k"), F.col("id").alias("rank_hint"), F.col("id").cast("string").alias("name"))
        # Small lookup side: broadcast, the hot side is never shuffled.
        small = lookup_first(left, lookup, "k", ["rank_hint"], ["name"])
        # Forced large-side path: hot key 0 is salted over 10 tasks.
        first = first_per_key(lookup, ["k"], ["rank_hint"], ["name"])
        salted = lookup_join(left, first, ["k"], "left", broadcast_max_rows=0, hot_key_rows=2_000)
        for out in (small, salted):
            rows = out.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("name")).collect()
            got = {r.k: (r.n, r.name) for r in rows}
            assert got[0] == (20_000, "0")
            assert sum(n for n, _ in got.values()) == 20_400
            assert out.select("row_id").distinct().count() == 20_400
        per_task = salted.where("k = 0").groupBy(F.spark_partition_id()).count().collect()
        assert len(per_task) >= 5  # the hot key is joined by several tasks
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_dedup(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("url"), F.col("id"))
    out = {r.url: r.id for r in dedup_first(df, ["url"], ["id"]).collect()}
    assert out["hot"] == 0 and len(out) == 20_001


def test_lookup_broadcast_respects_byte_bound(spark):
    left = spark.range(100).select(F.col("id"), (F.col("id") % 10).alias("k"))
    right = spark.range(10).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("payload"))
    auto = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in auto}
    for k, v in auto.items():
        spark.conf.set(k, v)
    try:
        plans = {}
        for limit in (5_000, 1_000_000):  # payload is about 10 kB
            out = lookup_join(left, right, ["k"], "left", broadcast_max_bytes=limit)
            assert sorted(r.id for r in out.where("payload IS NOT NULL").collect()) == list(range(100))
            plans[limit] = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plans[5_000] and "SortMergeJoin" in plans[5_000]
        assert "BroadcastHashJoin" in plans[1_000_000]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_equal_rows_of_a_hot_key_are_split(spark):
    left = spark.range(20_000).select(F.lit(0).alias("k"), F.lit("same").alias("v"))
    right = spark.createDataFrame([(0, "x"), (1, "y")], "k int, name string")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = lookup_join(left, right, ["k"], "left", broadcast_max_rows=0, hot_key_rows=1_000)
        tasks = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(tasks) == 20_000 and len(tasks) >= 5 and max(tasks) <= 10_000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
