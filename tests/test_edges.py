"""Empty and all-NULL inputs through the operators that run eager jobs."""

from destrank.operators.enrich import join_group_texts, lookup_join
from destrank.operators.ranking import RankSpec, average_ranks, weighted_score
from destrank.operators.rollup import daily_rollup

READINGS = "city string, date string, ts string, temp double, humidity bigint, pop double, description string"


def test_ranks_all_null_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, v double")
    for kw in ({}, {"checkpoint_input": True}, {"rows_per_bucket": 1}):
        got = average_ranks(df, [RankSpec("v", "r")], **kw).collect()
        assert sorted((r.id, r.r) for r in got) == [(1, None), (2, None)]
    empty = spark.createDataFrame([], "id long, v double")
    assert average_ranks(empty, [RankSpec("v", "r")]).count() == 0
    means = spark.createDataFrame([], "city string, avg_temp_max double, avg_humidity double, avg_pop double")
    assert weighted_score(means).count() == 0


def test_lookup_join_empty_sides(spark):
    left = spark.createDataFrame([(1, "a")], "id long, k string")
    right = spark.createDataFrame([], "k string, v string")
    assert [(r.id, r.v) for r in lookup_join(left, right, ["k"]).collect()] == [(1, None)]
    assert lookup_join(left.limit(0), right, ["k"]).count() == 0


def test_rollup_and_text_join_empty(spark):
    assert daily_rollup(spark.createDataFrame([], READINGS)).count() == 0
    texts = spark.createDataFrame([], "g long, o long, s string")
    assert join_group_texts(texts, ["g"], "o", "s").count() == 0
