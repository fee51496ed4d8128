"""Golden cases of FIXTURES.md part B (expected values computed by pandas)."""

import math

from pyspark.sql import functions as F

from destrank.functions.html import map_coordinate, LONGITUDE_VAR
from destrank.functions.numeric import coerce_numeric
from destrank.operators.ranking import weighted_score
from destrank.operators.rollup import daily_rollup, place_means
from destrank.plans.composite import recommendations
from destrank.sources.files import salvage_lines
from destrank.sources.landing import flatten_forecasts, responses_from_bodies
from destrank.operators.pages import zip_lists

READINGS = "city string, date string, ts string, temp double, humidity bigint, pop double, description string"


def test_b1_daily_rollup(spark):
    rows = [
        ("A", "2026-06-03", "2026-06-03 00:00:00", 15.0, 60, 0.1, None),
        ("A", "2026-06-03", "2026-06-03 03:00:00", 20.0, 50, 0.3, "rain"),
        ("A", "2026-06-03", "2026-06-03 06:00:00", 18.0, 40, 0.2, "sun"),
        ("A", "2026-06-04", "2026-06-04 00:00:00", 10.0, 90, 1.0, "fog"),
    ]
    # Shuffle the input: "first" must follow ts, not physical order.
    df = spark.createDataFrame(list(reversed(rows)), READINGS).repartition(3)
    out = {r["date"]: r for r in daily_rollup(df).collect()}
    a = out["2026-06-03"]
    assert (a.temp_min, a.temp_max, a.humidity, a.pop, a.description) == (15.0, 20.0, 50.0, 0.3, "rain")
    b = out["2026-06-04"]
    assert (b.temp_min, b.temp_max, b.humidity, b.pop, b.description) == (10.0, 10.0, 90.0, 1.0, "fog")


WEATHER_B2 = [("A", 20.0, 60.0, 0.1), ("A", 22.0, 70.0, 0.3), ("B", 25.0, 50.0, 0.0), ("B", 27.0, 50.0, 0.4),
              ("C", 21.0, 80.0, 0.9), ("D", 26.0, None, 0.2), ("E", 18.0, 40.0, 0.0)]


def _b2(spark, weights, **kw):
    w = spark.createDataFrame(WEATHER_B2, "city string, temp_max double, humidity double, pop double")
    means = place_means(w).select("city", *[F.round(c, 6).alias(c) for c in ("avg_temp_max", "avg_humidity", "avg_pop")])
    return {r["city"]: r for r in weighted_score(means, weights, **kw).collect()}


def test_b2_weighted_ranking(spark):
    expected_ranks = {"A": (2.5, 3.0, 2.0), "B": (4.5, 3.0, 3.0), "C": (2.5, 1.0, 1.0), "D": (4.5, 3.0, None), "E": (1.0, 5.0, 4.0)}
    expected = {
        (1, 1, 1): {"A": 7.5, "B": 10.5, "C": 4.5, "D": None, "E": 10.0},
        (5, 5, 5): {"A": 37.5, "B": 52.5, "C": 22.5, "D": None, "E": 50.0},
        (10, 0, 3): {"A": 31.0, "B": 54.0, "C": 28.0, "D": None, "E": 22.0},
    }
    for weights, scores in expected.items():
        got = _b2(spark, weights)
        for city, (rt, rr, rh) in expected_ranks.items():
            assert (got[city].rank_temp, got[city].rank_rain, got[city].rank_humidity) == (rt, rr, rh)
            assert got[city].score == scores[city]


def test_b2_same_with_many_buckets(spark):
    # Force the multi-bucket path: one histogram row per bucket at most.
    assert {c: r.score for c, r in _b2(spark, (5, 5, 5), rows_per_bucket=1).items()} == \
        {c: r.score for c, r in _b2(spark, (5, 5, 5)).items()}


def test_b2_order(spark):
    from destrank.operators.ranking import top_k

    w = spark.createDataFrame(WEATHER_B2, "city string, temp_max double, humidity double, pop double")
    scores = weighted_score(place_means(w), (5, 5, 5))
    assert [r.city for r in top_k(scores, 5).collect()] == ["B", "E", "A", "C", "D"]


def test_b3_recommendations(spark):
    w = spark.createDataFrame(WEATHER_B2, "city string, temp_max double, humidity double, pop double")
    hotels = spark.createDataFrame(
        [("A", "8.0"), ("A", "9.0"), ("B", "abc"), ("B", "7.0"), ("C", None), ("F", "9.9")], "city string, score string"
    )
    out = [(r.city, r.score) for r in recommendations(w, hotels).collect()]
    assert [c for c, _ in out] == ["B", "A", "C"]
    assert math.isclose(out[0][1], 31.0) and math.isclose(out[1][1], 27.5) and out[2][1] is None


def test_b4_numeric_coercion(spark):
    cases = {"8.2": 8.2, " 8.2 ": 8.2, "1e3": 1000.0, "-1.5": -1.5, ".5": 0.5, "5.": 5.0,
             "8,2": None, "": None, "abc": None, "0x10": None, "1d": None, "1.5f": None, "1_000": None,
             "True": None, None: None, "inf": None, "nan": None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.v for r in df.select("s", coerce_numeric("s").alias("v")).collect()}
    assert got == cases


def test_b5_coordinate_capture(spark):
    df = spark.createDataFrame(
        [("x; b_map_center_longitude = 2.33; y",), ("b_map_center_longitude = -2.02;",), ("nothing here",)], "html string"
    )
    got = [r.v for r in df.select(map_coordinate("html", LONGITUDE_VAR).alias("v")).collect()]
    assert got == [2.33, -2.02, None]


def test_b6_feed_salvage(spark):
    text = '[\n{"a":1},\n{"a":"x{y}"}\n][\n{"a":2}\n]'
    lines = spark.createDataFrame([(line,) for line in text.split("\n")], "value string")
    objs = salvage_lines(lines, "a string").collect()
    assert sorted((r.a, r._valid) for r in objs if r._valid) == [("1", True), ("2", True)]
    assert sum(1 for r in objs if not r._valid) == 1


def test_b7_forecast_flattening(spark):
    good = '{"list":[{"dt_txt":"2026-06-03 09:00:00","main":{"temp":12.5,"humidity":70},"pop":0.2,"weather":[]}]}'
    error = '{"cod":"401","message":"bad key"}'
    bodies = spark.createDataFrame([("A", good), ("B", error)], "city string, body string")
    rows = flatten_forecasts(responses_from_bodies(bodies)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.city, r.date, r.temp, r.humidity, r.pop, r.description) == ("A", "2026-06-03", 12.5, 70, 0.2, None)


def test_b8_positional_zip(spark):
    df = spark.createDataFrame([(["a", "b", "c"], ["1"], ["u1", "u2", "u3"])], "n array<string>, s array<string>, u array<string>")
    got = df.select(F.inline(zip_lists(F.col("n"), F.col("s"), F.col("u")))).collect()
    assert [(r.name, r.score, r.url) for r in got] == [("a", "1", "u1"), ("b", None, "u2"), ("c", None, "u3")]


def test_b9_null_handling(spark):
    df = spark.createDataFrame(
        [(None, "d", "t1", 1.0, 1, 0.1, "x"), ("A", "d", "t1", float("nan"), 2, 0.2, None), ("A", "d", "t2", 5.0, 4, 0.1, "late")],
        READINGS,
    )
    out = daily_rollup(df).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.city, r.temp_min, r.temp_max, r.humidity, r.description) == ("A", 5.0, 5.0, 3.0, "late")


def test_join_group_texts_runs(spark):
    from destrank.operators.enrich import join_group_texts

    rows = [(1, t, None if t == 5 else f"w{t}") for t in range(40)] + [(2, 0, None), (3, 3, "b"), (3, 1, "a")]
    df = spark.createDataFrame(rows, "g long, o long, s string").repartition(4)
    got = {r.g: r.text for r in join_group_texts(df, ["g"], "o", "s", run_length=8).collect()}
    assert got[1] == " ".join(f"w{t}" for t in range(40) if t != 5)
    assert got[2] == "" and got[3] == "a b"


def test_rank_once_rescore_many(spark):
    from destrank.operators.ranking import criterion_ranks, score_from_ranks

    w = spark.createDataFrame(WEATHER_B2, "city string, temp_max double, humidity double, pop double")
    ranks = criterion_ranks(place_means(w)).checkpoint()
    for weights, expected in {(1, 1, 1): 7.5, (5, 5, 5): 37.5, (10, 0, 3): 31.0}.items():
        got = {r.city: r.score for r in score_from_ranks(ranks, weights).collect()}
        assert got["A"] == expected and got["D"] is None
