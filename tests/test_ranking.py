"""Property tests of the bucketed average rank against pandas."""

import random
from decimal import Decimal

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from destrank.operators.ranking import RankSpec, average_rank, average_ranks, positions

values = st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float)), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=values, per_bucket=st.sampled_from([1, 2, 3, 1000]))
def test_matches_pandas_rank(spark, vals, per_bucket):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    got = average_ranks(df, [RankSpec("v", "up", True), RankSpec("v", "down", False)], rows_per_bucket=per_bucket)
    got = got.toPandas().sort_values("id")
    s = pd.Series(vals, dtype="float64")
    assert got["up"].fillna(-1).tolist() == s.rank().fillna(-1).tolist()
    assert got["down"].fillna(-1).tolist() == s.rank(ascending=False).fillna(-1).tolist()
    n = s.notna().sum()
    assert got["up"].sum() == n * (n + 1) / 2
    both = (got["up"] + got["down"]).dropna()
    assert (both == n + 1).all()


def test_partitioned_positions_hot_group(spark):
    # One group holds most rows; positions must still be 1..n per group.
    rows = [(0, t) for t in range(300)] + [(g, t) for g in range(1, 6) for t in range(4)]
    df = spark.createDataFrame(rows, "g long, t long")
    got = positions(df, ["g"], "t", rows_per_bucket=16).toPandas()
    for g, grp in got.groupby("g"):
        assert sorted(grp["pos"]) == list(range(1, len(grp) + 1))
        assert (grp.sort_values("t")["pos"].tolist()) == list(range(1, len(grp) + 1))


def test_hot_value_single_histogram_row(spark):
    # A value held by a third of all rows is one histogram row.
    rows = [(i, 7.0) for i in range(200)] + [(200 + i, float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, v double")
    got = average_ranks(df, [RankSpec("v", "r")], rows_per_bucket=50).toPandas().sort_values("id")
    expected = pd.Series([r[1] for r in rows]).rank()
    assert got["r"].tolist() == expected.tolist()


def test_multi_bucket_matches_duckdb_on_lineitem(spark):
    import duckdb

    from destrank.plans.oracle import ORACLE
    from destrank.plans.standins import table

    sf = "/root/testdata/sf0.001"
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    # 50 distinct quantities, 4 per bucket: 13 range buckets with offsets.
    got = average_ranks(li, [RankSpec("l_quantity", "rank_qty")], rows_per_bucket=4)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{sf}/lineitem.parquet')")
    want = sorted(con.execute(ORACLE["average_rank"]).fetchall())
    assert sorted(tuple(r) for r in got.collect()) == want


def test_multi_bucket_scores_and_positions_match_oracle_sf001(spark):
    import duckdb

    from destrank.operators.enrich import zip_positions
    from destrank.operators.ranking import weighted_score
    from destrank.plans import catalog
    from destrank.plans.oracle import ORACLE
    from destrank.plans.standins import table

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("events", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")

    # 150 user means, 10 per bucket: 15 range buckets per criterion.
    scores = weighted_score(catalog._user_means(spark, sf), (5, 5, 5), rows_per_bucket=10)
    want = con.execute(ORACLE["weighted_score"])
    cols = [d[0] for d in want.description]
    assert sorted(tuple(r[c] for c in cols) for r in scores.collect()) == sorted(want.fetchall())

    conv = table(spark, sf, "conversations")
    users = conv.where("role = 'user'").selectExpr("conv_id", "turn", "turn AS user_turn")
    assistants = conv.where("role = 'assistant'").selectExpr("conv_id", "turn", "turn AS assistant_turn")
    # 279 user turns over ~20 turn values: several buckets per side, offsets per conversation.
    zipped = zip_positions(
        users, assistants, ["conv_id"], "turn", "turn", ["user_turn"], ["assistant_turn"], rows_per_bucket=16
    )
    key = lambda r: tuple(-1 if v is None else v for v in r)
    got = sorted((tuple(r[c] for c in ("conv_id", "pos", "user_turn", "assistant_turn")) for r in zipped.collect()), key=key)
    want = con.execute(f"SELECT conv_id, pos, user_turn, assistant_turn FROM ({ORACLE['zip_positions']})").fetchall()
    assert got == sorted(want, key=key)


def test_ranks_of_many_sizes_equal_bisect(spark):
    """As many values as buckets, one more and one less: a rank is a place in the sorted values."""
    import bisect

    rnd = random.Random(7)
    for n in (1, 31, 32, 33, 64, 1023):
        vals = [round(rnd.uniform(-110, 110), 1) for _ in range(n)] + [-1e9, 1e9]
        df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
        got = {r.id: r.r for r in average_rank(df, "v", "r", rows_per_bucket=32).collect()}
        low = sorted(vals)
        assert [got[i] for i in range(n + 2)] == [
            (bisect.bisect_left(low, v) + 1 + bisect.bisect_right(low, v)) / 2 for v in vals
        ]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(st.tuples(st.sampled_from([1, 2, 3]), st.one_of(st.none(), st.integers(0, 4).map(float))), min_size=1, max_size=40),
    per_bucket=st.sampled_from([1, 2, 1000]),
)
def test_grouped_ranks_match_pandas(spark, rows, per_bucket):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id long, g long, v double")
    got = average_ranks(
        df, [RankSpec("v", "up", True), RankSpec("v", "down", False)], partition_by=["g"], rows_per_bucket=per_bucket
    ).toPandas().sort_values("id")
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    up = pdf.groupby("g")["v"].rank()
    down = pdf.groupby("g")["v"].rank(ascending=False)
    assert got["up"].fillna(-1).tolist() == up.fillna(-1).tolist()
    assert got["down"].fillna(-1).tolist() == down.fillna(-1).tolist()


def test_infinities_rank_at_the_ends(spark):
    from destrank.operators.ranking import average_rank

    rows = [(1, float("-inf")), (2, 1.0), (3, float("inf")), (4, float("nan")), (5, None)]
    for size in (2_000_000, 1):
        got = average_rank(spark.createDataFrame(rows, "id int, v double"), "v", "r", rows_per_bucket=size)
        assert {r.id: r.r for r in got.collect()} == {1: 1.0, 2: 2.0, 3: 3.0, 4: None, 5: None}


def test_many_buckets_and_partitions(spark):
    from pyspark.sql import functions as F

    from destrank.operators.ranking import average_rank

    df = spark.range(20_000, numPartitions=256).select("id", (F.col("id") % 7000).cast("double").alias("v"))
    got = average_rank(df, "v", "r", rows_per_bucket=4)
    w = df.toPandas()
    want = dict(zip(w["id"], w["v"].rank()))
    assert all(want[r.id] == r.r for r in got.collect())


def test_positions_and_ranks_use_exact_keys(spark):
    from decimal import Decimal

    from destrank.operators.ranking import average_rank, positions

    big = 2**53
    df = spark.createDataFrame([(1, big + 1), (2, big), (3, big + 2)], "id int, k long")
    for rows_per_bucket in (1, 100):
        got = {r.id: r.pos for r in positions(df.withColumn("g", F.lit(0)), ["g"], "k", rows_per_bucket=rows_per_bucket).collect()}
        assert got == {2: 1, 1: 2, 3: 3}
    lows = spark.createDataFrame([(1, -(2**63)), (2, 2**63 - 1), (3, 0)], "id int, k long")
    assert {r.id: r.r for r in average_rank(lows, "k", "r", ascending=False).collect()} == {2: 1.0, 3: 2.0, 1: 3.0}
    tiny = spark.createDataFrame([(1, Decimal("9007199254740993.1")), (2, Decimal("9007199254740993.0"))], "id int, k decimal(30,1)")
    assert {r.id: r.r for r in average_rank(tiny, "k", "r").collect()} == {2: 1.0, 1: 2.0}
    times = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP '2024-01-01 00:00:00.000002'), (2, TIMESTAMP '2024-01-01 00:00:00.000001'), (3, NULL) t(id, k)")
    assert {r.id: r.r for r in average_rank(times, "k", "r").collect()} == {2: 1.0, 1: 2.0, 3: None}


@pytest.mark.parametrize("ascending", [True, False])
def test_many_buckets_of_any_type(spark, ascending):
    """Ranks over hundreds of buckets equal pandas' ranks: ties, infinities, decimals beyond a double's digits."""
    rng = random.Random(11)
    floats = [rng.choice([float("inf"), float("-inf"), float("nan"), None, -0.0, 0.0, float(rng.randint(0, 300)) / 7]) for _ in range(1200)]
    digits = [Decimal(10) ** 20 + Decimal(rng.randint(0, 400)) / 1000 for _ in range(1200)]
    df = spark.createDataFrame([(i, f, d) for i, (f, d) in enumerate(zip(floats, digits))], "id long, f double, d decimal(30,3)")
    for source, values in (("f", [None if v is None or v != v else v + 0.0 for v in floats]), ("d", [int(d * 1000 - 10**23) for d in digits])):
        got = {r.id: r.r for r in average_rank(df, source, "r", ascending, rows_per_bucket=3, broadcast_max_rows=10).collect()}
        want = pd.Series(values, dtype=float).rank(ascending=ascending)
        assert [got[i] for i in range(1200)] == [None if v != v else v for v in want]


def test_plan_does_not_grow_with_the_buckets(spark):
    df = spark.range(3000).selectExpr("id % 997 AS v", "id")

    def plan(rows):
        return average_rank(df, "v", "r", rows_per_bucket=rows)._jdf.queryExecution().optimizedPlan().toString()

    assert abs(len(plan(10)) - len(plan(500))) < 50
