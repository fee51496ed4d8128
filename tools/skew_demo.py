"""Skew evidence on the given tables: rows handled by the largest join task.

A key is made hot on lineitem (every row with l_linenumber <= 2 gets key
0, about a third of the table) and joined to a one-row-per-key lookup
built from orders. A plain shuffle join sends the hot key to one task;
``lookup_join`` salts it over several. Broadcasting is disabled so both
go through a shuffle.

Usage: python tools/skew_demo.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from destrank.operators.enrich import lookup_join  # noqa: E402
from destrank.session import get_session  # noqa: E402


def largest_task(df) -> tuple[int, int]:
    per_task = df.groupBy(F.spark_partition_id().alias("task")).count()
    row = per_task.agg(F.max("count").alias("m"), F.sum("count").alias("t")).first()
    return int(row["m"]), int(row["t"])


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session(
        "local[8]",
        shuffle_partitions=16,
        extra_conf={
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            # Keep the hash partitions as they are, so task sizes show the key spread.
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    left = li.select("l_orderkey", "l_linenumber",
                     F.when(F.col("l_linenumber") <= 2, F.lit(0)).otherwise(F.col("l_orderkey") + 1).alias("k"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    right = orders.select((F.col("o_orderkey") + 1).alias("k"), "o_orderstatus").unionByName(
        spark.createDataFrame([(0, "hot")], "k long, o_orderstatus string"))
    hot_rows = left.where("k = 0").count()
    total = left.count()
    plain = left.join(right, "k", "left")
    salted = lookup_join(left, right, ["k"], "left", broadcast_max_rows=0, hot_key_rows=max(1, hot_rows // 16))
    p_max, p_total = largest_task(plain)
    s_max, s_total = largest_task(salted)
    print(json.dumps({
        "rows": total, "hot_key_rows": hot_rows,
        "plain_join": {"largest_task_rows": p_max, "rows_out": p_total},
        "salted_lookup_join": {"largest_task_rows": s_max, "rows_out": s_total},
    }))


if __name__ == "__main__":
    main()
