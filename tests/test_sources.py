"""Sources and sinks: CSV with multi-line quoted text, JSON lines,
seed tables, row counts, JDBC options."""

import pytest

from destrank import schemas
from destrank.operators.quality import null_audit, observed, row_counts
from destrank.sources import files
from destrank.sources.jdbc import jdbc_read_options, jdbc_write_options
from destrank.sources.seed import seed_table


def test_csv_roundtrip_multiline(spark, tmp_out):
    rows = [("Paris", "H1", "8.1", "u1", 'line one\nline "two"', 48.8, 2.3), ("Lille", "H2", None, "u2", "", None, None)]
    df = spark.createDataFrame(rows, schemas.HOTELS)
    files.write_csv(df, tmp_out)
    back = files.read_csv(spark, tmp_out, schemas.HOTELS)
    got = sorted(back.collect(), key=lambda r: r.city)
    assert len(got) == 2
    assert got[1].description == 'line one\nline "two"'


def test_json_lines_roundtrip(spark, tmp_out):
    df = spark.createDataFrame([("A", 1.5, 2.5)], schemas.CITIES)
    files.write_json_lines(df, tmp_out)
    assert files.read_json_lines(spark, tmp_out, schemas.CITIES).collect() == df.collect()


def test_salvaged_feed_file(spark, tmp_out):
    path = tmp_out + ".json"
    spark.createDataFrame([('[{"city":"A","name":"n1"},',), ('{"city":"B","name":"n{2}"}]',), ('[{"city":"C"}]',)], "value string") \
        .coalesce(1).write.text(path)
    got = files.read_salvaged_feed(spark, path, "city string, name string")
    assert sorted(r.city for r in got.collect() if r.city) == ["A", "C"]


def test_seed_and_counts(spark):
    seed = seed_table(spark, ["Paris", "Lille"])
    counts = {r.table_name: r.n_rows for r in row_counts({"seed": seed}).collect()}
    assert counts == {"seed": 2}
    watched, obs = observed(seed, "seed")
    watched.collect()
    assert obs.get["rows"] == 2


def test_null_audit_counts_nan(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), "x")], "a double, b string")
    got = {r.column_name: r.null_count for r in null_audit(df).collect()}
    assert got == {"a": 1, "b": 1}


def test_jdbc_options():
    opts = jdbc_read_options("jdbc:postgresql://db/x", table="weather", partition_column="id",
                             lower_bound=0, upper_bound=100, num_partitions=4)
    assert opts["numPartitions"] == "4" and opts["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        jdbc_read_options("jdbc:x", table="t", partition_column="id")
    w = jdbc_write_options("jdbc:x", "city_recommendations", truncate=True)
    assert w["truncate"] == "true" and w["dbtable"] == "city_recommendations"


def test_salvaged_feed_pretty_printed(spark, tmp_out):
    path = tmp_out + ".json"
    text = '[\n  {\n    "city": "A",\n    "name": "n1"\n  },\n  {\n    "city": "B"\n  }\n][\n  {"city": "C"}\n]'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    found = files.read_salvaged_feed(spark, path, "city string, name string")
    assert sorted(r.city for r in found.collect()) == ["A", "B", "C"]


def test_salvaged_feed_keeps_odd_records(spark, tmp_out):
    path = tmp_out + ".json"
    text = '[{"city":"A","city":"A2"},\n{"city":"B","x":NaN},{"city":"x{y}"},{"city":7}][{"city":"C"},{"city":"D"'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    got = files.read_salvaged_feed(spark, path, "city string")
    assert sorted(r.city[0] for r in got.collect()) == ["7", "A", "B", "C"]  # {y} is no JSON, D is cut off


def test_csv_columns_by_name_and_exact_text(spark, tmp_out):
    rows = [(" lead", 1.0, "text \n trailing  ", ""), (None, None, '"q" , x', None)]
    df = spark.createDataFrame(rows, "b string, a double, c string, d string")
    files.write_csv(df, tmp_out)
    back = files.read_csv(spark, tmp_out, "a double, d string, b string, c string")
    assert back.columns == ["a", "d", "b", "c"]
    assert sorted(map(str, back.select("b", "a", "c", "d").collect())) == sorted(map(str, df.collect()))
    assert files.read_csv(spark, tmp_out, "d string", empty_is_null=True).where("d IS NULL").count() == 2
    with pytest.raises(ValueError):
        files.read_csv(spark, tmp_out, "a double, missing string")


def test_seed_of_original_places(spark):
    from destrank.fixed import PLACES
    from destrank.functions.text import lookup_key, search_url

    seed = seed_table(spark, PLACES)
    rows = seed.select("city", lookup_key("city").alias("q"), search_url("city").alias("u")).collect()
    assert len(rows) == 35 and rows[0].q == "Mont Saint Michel, France"
    assert rows[0].u == "https://www.booking.com/searchresults.html?ss=Mont%20Saint%20Michel&lang=en-gb"


def test_modulo_predicates_cover_every_row():
    from destrank.sources.jdbc import modulo_predicates

    preds = modulo_predicates("abs(hashtext(city))", 4)
    assert len(preds) == 4 and preds[3] == "mod(abs(hashtext(city)), 4) = 3"
    assert "IS NULL" in preds[0]
    with pytest.raises(ValueError):
        modulo_predicates("x", 0)


def test_key_ranges_cover_every_row_once(spark):
    """Predicates of found bounds, tried on a table: each row in one range, ranges of like size."""
    from destrank.sources.jdbc import key_cuts, range_predicates

    df = spark.range(4000).selectExpr(
        "id", "CASE WHEN id % 9 = 0 THEN NULL ELSE concat(\"o'\", cast((id * 7919) % 4001 AS string)) END AS name",
        "cast(id % 3 AS decimal(5,2)) AS few", "date_add(date'2024-01-01', cast(id % 100 AS int)) AS day",
    )
    for column, parts in (("id", 8), ("name", 8), ("few", 8), ("day", 5), ("id", 1)):
        cuts = key_cuts(df, column, parts)
        clauses = range_predicates(column, cuts)
        assert cuts == sorted(set(cuts)) and len(clauses) == len(cuts) + 1 <= parts
        sizes = [df.where(c).count() for c in clauses]
        assert sum(sizes) == 4000 and df.where(" + ".join(f"int(coalesce({c}, false))" for c in clauses) + " <> 1").count() == 0
        if column in ("id", "day"):
            assert max(sizes) <= 2 * 4000 / len(clauses)
        else:
            assert min(sizes) > 0
    assert key_cuts(df.limit(0), "id", 4) == [] and range_predicates("id", []) == ["1 = 1"]
    with pytest.raises(ValueError):
        range_predicates("x", [b"bytes"])
    with pytest.raises(ValueError):
        key_cuts(df, "id", 0)
