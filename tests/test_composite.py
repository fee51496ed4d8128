"""Landing readers and the end-to-end batch."""

import json

from destrank import schemas
from destrank.plans.catalog import QUERIES
from destrank.plans.composite import forecast_collection, run_batch
from destrank.plans import standins
from destrank.session import scratch_dir
from destrank.sources.landing import cities_from_geocodes, read_forecasts, read_geocodes

SF = "/root/testdata/sf0.001"


def test_geocode_first_hit_and_miss(spark):
    path = scratch_dir(spark, "geo")
    rows = [
        {"city": "Paris", "hits": [{"lat": "48.85", "lon": "2.35"}, {"lat": "1", "lon": "1"}]},
        {"city": "Nowhere", "hits": []},
        {"city": "Biarritz", "hits": [{"lat": "43.48", "lon": "-1.56"}]},
    ]
    spark.createDataFrame([(json.dumps(r),) for r in rows], "value string").coalesce(1).write.text(path)
    got = {r.city: (r.latitude, r.longitude) for r in cities_from_geocodes(read_geocodes(spark, path)).collect()}
    assert got == {"Paris": (48.85, 2.35), "Nowhere": (None, None), "Biarritz": (43.48, -1.56)}


def test_forecast_collection_skips_unlocated_places(spark):
    path = scratch_dir(spark, "fc")
    resp = lambda c: {"city": c, "list": [{"dt_txt": "2026-06-03 00:00:00", "main": {"temp": 1.0, "humidity": 10},
                                           "pop": 0.5, "weather": [{"description": "x"}]}]}
    spark.createDataFrame([(json.dumps(resp(c)),) for c in ("A", "B")], "value string").coalesce(1).write.text(path)
    places = spark.createDataFrame([("A", 1.0, 2.0), ("B", None, None)], schemas.CITIES)
    rows = forecast_collection(places, read_forecasts(spark, path)).collect()
    assert [(r.city, r.date, r.temp_max, r.description) for r in rows] == [("A", "2026-06-03", 1.0, "x")]


def test_run_batch_writes_tables_with_counts(spark):
    t = lambda n: standins.table(spark, SF, n)
    weather = standins.nation_weather(t("orders"), t("customer"))
    hotels = standins.supplier_hotels(t("supplier"))
    cities = standins.nation_cities(t("nation"))
    out = scratch_dir(spark, "pipe")
    result = run_batch(spark, weather, hotels, cities, out_dir=out)
    assert result.counts["top_map"] == 5
    assert result.counts["top_hotels"] == result.top_hotels.count() <= 20
    assert result.counts["recommendations"] == QUERIES["recommendations"](spark, SF).count()
    back = spark.read.schema("city string, latitude double, longitude double, score double") \
        .option("header", True).csv(f"{out}/top_map")
    assert back.count() == 5


def test_cli_rank_and_recommend(spark):
    from destrank.__main__ import main
    from destrank.sources import files as F_

    w = spark.createDataFrame(
        [("A", "d1", 1.0, 20.0, 60.0, 0.1, "x"), ("B", "d1", 1.0, 25.0, 50.0, 0.0, "y"), ("C", "d1", 1.0, 21.0, 80.0, 0.9, "z")],
        schemas.WEATHER,
    )
    h = spark.createDataFrame([("A", "h1", "8.0", "u1", None, 1.0, 2.0), ("B", "h2", "7.0", "u2", None, 3.0, 4.0)], schemas.HOTELS)
    c = spark.createDataFrame([("A", 1.0, 2.0), ("B", 3.0, 4.0), ("C", 5.0, 6.0)], schemas.CITIES)
    base = scratch_dir(spark, "cli")
    for name, df in (("w", w), ("h", h), ("c", c)):
        F_.write_csv(df, f"{base}/{name}")
    main(["rank", "--format", "csv", "--weather", f"{base}/w", "--hotels", f"{base}/h", "--cities", f"{base}/c",
          "--out", f"{base}/out", "--weights", "10", "0", "3"])
    top = F_.read_csv(spark, f"{base}/out/top_places", "city string, latitude double, longitude double, score double")
    assert top.count() == 3
    main(["rank", "--format", "csv", "--weather", f"{base}/w", "--hotels", f"{base}/h", "--cities", f"{base}/c",
          "--out", f"{base}/multi", "--weights", "10", "0", "3", "--weights", "1", "1", "1"])
    schema = "city string, latitude double, longitude double, score double"
    one = {r.city: r.score for r in F_.read_csv(spark, f"{base}/multi/top_places_10_0_3", schema).collect()}
    assert one == {r.city: r.score for r in top.collect()}
    assert F_.read_csv(spark, f"{base}/multi/top_places_1_1_1", schema).count() == 3
    main(["recommend", "--format", "csv", "--weather", f"{base}/w", "--hotels", f"{base}/h", "--out", f"{base}/rec"])
    rec = F_.read_csv(spark, f"{base}/rec/city_recommendations", schemas.RECOMMENDATIONS)
    assert sorted(r.city for r in rec.collect()) == ["A", "B"]


def test_cli_collection_side(spark, capsys):
    from destrank.__main__ import main
    from destrank.sources import files as F_
    from test_pages import DETAIL_ONE, LISTING

    base = scratch_dir(spark, "cli-collect")
    geo = [{"city": "Paris", "hits": [{"lat": "48.85", "lon": "2.35"}]}, {"city": "Nowhere", "hits": []}]
    fc = [{"city": c, "list": [{"dt_txt": "2026-06-03 09:00:00", "main": {"temp": 20.0, "humidity": 50},
                                "pop": 0.1, "weather": [{"description": "sun"}]}]} for c in ("Paris", "Nowhere")]
    fc.append({"city": "Paris", "cod": "401"})  # an error body: no forecast list
    for name, rows in (("geo", geo), ("fc", fc)):
        spark.createDataFrame([(json.dumps(r),) for r in rows], "value string").coalesce(1).write.text(f"{base}/{name}")
    main(["weather", "--geocodes", f"{base}/geo", "--forecasts", f"{base}/fc", "--out", f"{base}/out"])
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts == {"cities": 2, "responses": 3, "rejected": 1, "weather": 1}
    weather = spark.read.parquet(f"{base}/out/weather").collect()
    assert [(r.city, r.date, r.temp_max) for r in weather] == [("Paris", "2026-06-03", 20.0)]  # unlocated place skipped
    assert spark.read.parquet(f"{base}/out/cities").count() == 2

    spark.createDataFrame([("Paris", "https://s.example/search", LISTING)], "city string, url string, html string") \
        .write.parquet(f"{base}/search")
    spark.createDataFrame([("https://x.example/h/one.html?x=1", DETAIL_ONE)], "url string, html string") \
        .write.parquet(f"{base}/detail")
    main(["hotels", "--search-pages", f"{base}/search", "--detail-pages", f"{base}/detail", "--out", f"{base}/h",
          "--format", "csv"])
    hotels = {r.name: r for r in F_.read_csv(spark, f"{base}/h/hotels", schemas.HOTELS).collect()}
    assert hotels["Hotel One"].latitude == 48.87 and hotels["Hotel One"].score == "8.2"
    assert hotels["Hotel & Two"].description is None
