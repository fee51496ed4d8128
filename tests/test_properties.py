"""Property tests of rollups and unions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from destrank.operators.ranking import RankSpec, average_ranks
from destrank.operators.rollup import daily_rollup, union_rollups

READINGS = "city string, date string, ts string, temp double, humidity bigint, pop double, description string"

reading = st.tuples(
    st.sampled_from(["A", "B", "C"]),
    st.sampled_from(["2026-06-03", "2026-06-04"]),
    st.integers(0, 23).map(lambda h: f"{h:02d}:00"),
    st.floats(-20, 40, allow_nan=False),
    st.integers(0, 100),
    st.floats(0, 1, allow_nan=False),
    st.sampled_from([None, "rain", "sun"]),
)
SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(rows=st.lists(reading, min_size=1, max_size=30))
def test_rollup_bounds_and_additivity(spark, rows):
    df = spark.createDataFrame(rows, READINGS)
    daily = daily_rollup(df).collect()
    for r in daily:
        assert r.temp_min <= r.temp_max
        assert 0 <= r.humidity <= 100
    assert len(daily) == len({(c, d) for c, d, *_ in rows})
    half = len(rows) // 2
    a = daily_rollup(spark.createDataFrame(rows[:half] or rows[:0], READINGS))
    b = daily_rollup(spark.createDataFrame(rows[half:], READINGS)).select(
        "date", "temp_min", "temp_max", "humidity", "pop", "description", "city"
    )
    assert union_rollups(a, b).count() == a.count() + b.count()


@SETTINGS
@given(vals=st.lists(st.integers(0, 6).map(float), min_size=2, max_size=30), seed=st.integers(0, 1000))
def test_rank_invariant_under_row_order(spark, vals, seed):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    base = {r.id: r.r for r in average_ranks(df, [RankSpec("v", "r")], rows_per_bucket=2).collect()}
    shuffled = df.orderBy(F.rand(seed)).repartition(3)
    again = {r.id: r.r for r in average_ranks(shuffled, [RankSpec("v", "r")], rows_per_bucket=2).collect()}
    assert base == again


numberish = st.builds(
    lambda lead, sign, body, exp, tail: f"{lead}{sign}{body}{exp}{tail}",
    st.sampled_from(["", " ", "  "]),
    st.sampled_from(["", "+", "-"]),
    st.one_of(
        st.from_regex(r"\d{1,6}(\.\d{0,4})?", fullmatch=True),
        st.from_regex(r"\.\d{1,4}", fullmatch=True),
        st.sampled_from(["", ".", "1,5", "1_000", "0x1F", "abc", "1d", "2.5f", "inf", "nan", "1e", "--1"]),
    ),
    st.sampled_from(["", "e3", "E-2", "e+1"]),
    st.sampled_from(["", " ", "x"]),
)


@SETTINGS
@given(texts=st.lists(numberish, min_size=1, max_size=40))
def test_coerce_numeric_matches_pandas(spark, texts):
    import math

    import pandas as pd

    from destrank.functions.numeric import coerce_numeric

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, s string")
    got = {r.i: r.v for r in df.select("i", coerce_numeric("s").alias("v")).collect()}
    want = pd.to_numeric(pd.Series(texts, dtype="object"), errors="coerce")
    for i, w in enumerate(want):
        w = None if (w is None or (isinstance(w, float) and (math.isnan(w) or math.isinf(w)))) else float(w)
        assert got[i] == w, (texts[i], got[i], w)


@SETTINGS
@given(
    rows=st.lists(
        st.tuples(st.integers(0, 3), st.one_of(st.none(), st.sampled_from(["a", "b", "c d", ""]))), min_size=0, max_size=40
    ),
    run_length=st.sampled_from([1, 2, 3, 1024]),
)
def test_join_group_texts_matches_python(spark, rows, run_length):
    from destrank.operators.enrich import join_group_texts

    data = [(g, i, t) for i, (g, t) in enumerate(rows)]  # i is a unique order
    df = spark.createDataFrame(data, "g long, o long, s string")
    got = {r.g: r.text for r in join_group_texts(df, ["g"], "o", "s", run_length=run_length).collect()}
    want = {}
    for g, _, t in data:
        want.setdefault(g, [])
        if t is not None:
            want[g].append(t)
    assert got == {g: " ".join(ts) for g, ts in want.items()}


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["k1", "k2", None]), st.integers(0, 50), st.text(max_size=3)), max_size=40))
def test_first_per_key_matches_python(spark, rows):
    from destrank.operators.enrich import first_per_key

    data = [(k, o, i, v) for i, (k, o, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, o long, i long, v string")
    got = {r.k: (r.o, r.i, r.v) for r in first_per_key(df, ["k"], ["o", "i"], ["o", "i", "v"]).collect()}
    want = {}
    for k, o, i, v in sorted(data, key=lambda r: (r[1], r[2])):
        if k is not None and k not in want:
            want[k] = (o, i, v)
    assert got == want


@SETTINGS
@given(
    keys=st.lists(st.sampled_from(["hot", "hot", "hot", "a", "b", None]), min_size=1, max_size=60),
    lookup_keys=st.sets(st.sampled_from(["hot", "a", "c"])),
    how=st.sampled_from(["left", "inner"]),
)
def test_salted_lookup_join_equals_plain_join(spark, keys, lookup_keys, how):
    from destrank.operators.enrich import lookup_join

    left = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k string")
    right = spark.createDataFrame([(k, f"v-{k}") for k in sorted(lookup_keys)], "k string, v string")
    # Force the shuffle path and salt any key with more than 2 rows.
    out = lookup_join(left, right, ["k"], how, broadcast_max_rows=0, hot_key_rows=2, max_salts=4)
    got = sorted((r.id, r.v) for r in out.collect())
    table = {k: f"v-{k}" for k in lookup_keys}
    want = sorted((i, table.get(k)) for i, k in enumerate(keys) if how == "left" or k in table)
    assert got == want
