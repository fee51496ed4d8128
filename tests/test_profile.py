"""Column profiles from merged sketches against exact counts."""

import pytest
from pyspark.sql import functions as F

from destrank.operators.profile import DISTINCT_ERROR, QUANTILES, SHOWN_CHARS, TRACKED, column_sketches, merged, profile

SF = "/root/testdata/sf0.001"


def rows(df):
    return {r.column_name: r for r in df.collect()}


def test_missing_values_and_kinds(spark):
    df = spark.createDataFrame(
        [(1, "é", float("nan"), [1], b"ab", None, "x"), (None, None, None, None, None, None, "x"), (1, "", 2.0, [1], b"", None, "y" * 900)],
        "i long, `a.b` string, f double, l array<int>, b binary, n string, place string",
    )
    got = rows(profile(column_sketches(df)))
    assert list(got) == df.columns and {r.n_rows for r in got.values()} == {3}
    assert [r.n_missing for r in got.values()] == [1, 1, 2, 1, 1, 3, 0]
    assert [r.n_distinct for r in got.values()] == [1, 2, 1, 1, 2, 0, 2]
    assert [tuple(x) for x in got["i"].top_values] == [("1", 2)] and [tuple(x) for x in got["l"].top_values] == [("[1]", 2)]
    assert got["a.b"].lengths == [0, 0, 0, 2, 2] and got["n"].lengths is None and got["i"].lengths is None
    assert got["n"].top_values == [] and got["place"].top_values[0].n == 2
    assert all(len(x.value) < SHOWN_CHARS for x in got["place"].top_values)
    assert rows(profile(column_sketches(df.limit(0))))["f"].n_rows == 0
    assert list(rows(profile(column_sketches(df, ["f"])))) == ["f"]
    with pytest.raises(ValueError):
        column_sketches(df, ["other"])


def test_parts_merge_to_the_whole(spark):
    items = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_quantity", "l_returnflag")
    parts = [column_sketches(items.where(F.pmod("l_orderkey", F.lit(3)) == k)) for k in range(3)]
    got, whole = rows(profile(merged(parts))), rows(profile(column_sketches(items)))
    for c in items.columns:
        exact = items.select(c).distinct().count()
        for r in (got[c], whole[c]):
            assert r.n_rows == items.count() and r.n_missing == 0
            assert abs(r.n_distinct - exact) <= max(1, DISTINCT_ERROR * exact)
        best = items.groupBy(F.col(c).cast("string").alias("v")).count().orderBy(F.desc("count"), "v").limit(10).collect()
        if exact < TRACKED * 3 // 4:
            assert [tuple(x) for x in got[c].top_values] == [tuple(x) for x in whole[c].top_values] == [tuple(x) for x in best]


def test_errors_of_large_columns(spark):
    df = spark.range(200_000).selectExpr(
        "cast(id as string) AS unique", "CASE WHEN id % 50 = 0 THEN 'hot' ELSE cast(id as string) END AS hot", "repeat('x', cast(id % 1001 as int)) AS text"
    )
    got = rows(profile(column_sketches(df)))
    assert abs(got["unique"].n_distinct - 200_000) <= DISTINCT_ERROR * 200_000
    assert got["hot"].top_values[0].value == "hot" and abs(got["hot"].top_values[0].n - 4000) <= 4 * 200_000 / TRACKED
    for q, length in zip(QUANTILES, got["text"].lengths):
        assert abs(length - 1000 * q) <= 0.015 * 1001
    assert got["text"].lengths[0] == 0 and got["text"].lengths[-1] == 1000
