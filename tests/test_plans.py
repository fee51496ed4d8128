"""Physical-plan checks: the plans we want, not just the right rows."""

from destrank.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(QUERIES["top_places"](spark, SF))


def test_top_hotels_semi_join_broadcast(spark):
    plan = _plan(QUERIES["top_hotels"](spark, SF))
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan


def test_filter_pushed_and_columns_pruned(spark):
    df = QUERIES["url_strip"](spark, SF)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(url)" in plan
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan  # html is never read


def test_ranking_never_single_partition(spark):
    for name in ("rank_sum", "average_rank", "zip_positions"):
        df = QUERIES[name](spark, SF)
        df.collect()
        assert "SinglePartition" not in _plan(df), name


def test_rollup_is_partial_aggregate(spark):
    plan = _plan(QUERIES["daily_rollup"](spark, SF))
    assert "partial_min_by" in plan and "partial_avg" in plan


def test_small_lookup_side_is_broadcast_big_side_not_shuffled(spark):
    df = QUERIES["geocode_left"](spark, SF)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final
    assert "Exchange hashpartitioning" not in final  # customers are never shuffled


def test_recommendations_from_means_equal(spark):
    from destrank.plans import composite, standins
    from destrank.operators.rollup import place_means

    t = lambda n: standins.table(spark, SF, n)
    weather = standins.nation_weather(t("orders"), t("customer"))
    hotels = standins.supplier_hotels(t("supplier"))
    direct = composite.recommendations(weather, hotels).collect()
    reused = composite.recommendations_from_means(place_means(weather), hotels).collect()
    assert direct == reused
