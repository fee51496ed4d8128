"""Resumable stages, tables replaced together, the batch from landed files."""

import json
import os
import threading

import pytest

from destrank import schemas
from destrank.operators.numbering import with_row_numbers
from destrank.plans.composite import landed_stages, run_landed_batch
from destrank.plans.stages import Stage, run_stages
from destrank.session import scratch_dir
from destrank.sources import commits
from destrank.sources.versions import CommitConflict, VersionedTables, write_table


@pytest.mark.parametrize("name", [None, commits._rename])
def test_publish_once(spark, tmp_out, monkeypatch, name):
    if name:  # the way of other file systems
        monkeypatch.setattr(commits, "_link", name)
    path = f"{tmp_out}/a b/x.json"
    assert not commits.exists(spark, path) and commits.children(spark, f"{tmp_out}/a b") == []
    assert commits.publish(spark, path, '{"é": 1}')
    assert not commits.publish(spark, path, "other")
    assert commits.read_text(spark, path) == '{"é": 1}'
    assert commits.children(spark, f"{tmp_out}/a b") == ["x.json"]  # nothing left beside it


def test_one_of_many_writers_wins(spark, tmp_out):
    won, path = [], f"{tmp_out}/one"
    writers = [
        threading.Thread(target=lambda i=i: won.append(i) if commits.publish(spark, path, str(i)) else None) for i in range(8)
    ]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert len(won) == 1 and commits.read_text(spark, path) == str(won[0])


def numbers(spark, n):
    return spark.range(n).withColumnRenamed("id", "x")


def test_reader_during_a_failed_load_sees_the_old_tables(spark, tmp_out):
    tables = VersionedTables(spark, tmp_out)
    assert tables.snapshot().version == 0 and tables.versions() == []
    old = tables.replace({n: numbers(spark, 3) for n in ("cities", "weather", "hotels")})
    seen = {}

    def broken():
        seen.update({n: tables.snapshot().read(spark, n).count() for n in old.tables})  # while the load runs
        return numbers(spark, 9).selectExpr("raise_error('lost') AS x")

    with pytest.raises(Exception, match="lost"):
        tables.replace({"cities": numbers(spark, 5), "weather": broken(), "hotels": numbers(spark, 5)})
    assert seen == {"cities": 3, "weather": 3, "hotels": 3}
    assert tables.snapshot() == old and {n: old.read(spark, n).count() for n in old.tables} == seen
    new = tables.replace({"weather": numbers(spark, 7)})
    assert {n: t.rows for n, t in new.tables.items()} == {"cities": 3, "weather": 7, "hotels": 3}
    assert old.read(spark, "weather").count() == 3  # a reader of the old version goes on


def test_two_loads_one_wins(spark, tmp_out):
    tables = VersionedTables(spark, tmp_out)
    base = tables.replace({"cities": numbers(spark, 1)})
    won = tables.replace({"cities": numbers(spark, 2)}, base)
    with pytest.raises(CommitConflict):
        tables.replace({"cities": numbers(spark, 3)}, base)
    assert tables.snapshot() == won and won.read(spark, "cities").count() == 2
    again = tables.replace({"cities": numbers(spark, 3)})  # from the current version it goes through
    assert (again.version, tables.versions()) == (3, [1, 2, 3])
    with pytest.raises(KeyError):
        again.read(spark, "weather")


def test_expire(spark, tmp_out):
    tables = VersionedTables(spark, tmp_out)
    kept = tables.replace({"a": numbers(spark, 1), "b": numbers(spark, 1)}).tables["b"].folder
    gone = tables.replace({"a": numbers(spark, 2)}).tables["a"].folder
    for n in (3, 4):
        tables.replace({"a": numbers(spark, n)})
    assert tables.expire(2) == 2 and tables.versions() == [3, 4]
    assert commits.exists(spark, kept) and not commits.exists(spark, gone)
    assert {n: tables.snapshot().read(spark, n).count() for n in "ab"} == {"a": 4, "b": 1}
    with pytest.raises(ValueError):
        tables.expire(0)


def test_rerun_resumes_at_the_failed_stage(spark, tmp_out):
    calls, broken = [], [True]

    def stage(name, needs=()):
        def build(spark, t):
            calls.append(name)
            if name == "three" and broken[0]:
                raise RuntimeError("executor lost")
            return numbers(spark, 2 + sum(df.count() for df in t.values()))

        return Stage(name, build, needs)

    stages = [stage("one"), stage("two", ["one"]), stage("three", ["one", "two"]), stage("four", ["three"])]
    with pytest.raises(RuntimeError):
        run_stages(spark, stages, tmp_out)
    assert calls == ["one", "two", "three"]
    broken[0] = False
    run = run_stages(spark, stages, tmp_out)
    assert calls == ["one", "two", "three", "three", "four"] and run.computed == ["three", "four"]
    assert run.counts == {"one": 2, "two": 4, "three": 8, "four": 10}
    assert run_stages(spark, stages, tmp_out).computed == []
    changed = [stages[0], Stage("two", stages[1].build, ["one"], params=1), *stages[2:]]
    assert run_stages(spark, changed, tmp_out).computed == ["two", "three", "four"]
    with pytest.raises(ValueError):
        run_stages(spark, [stages[1]], tmp_out)
    with pytest.raises(ValueError):
        run_stages(spark, [stages[0], stages[0]], tmp_out)


def test_keys_follow_the_landed_files(spark, tmp_out):
    def run():
        return run_stages(spark, [Stage("read", lambda s, t: s.read.text(f"{tmp_out}/in"), inputs=[f"{tmp_out}/in"])], tmp_out)

    with pytest.raises(FileNotFoundError):
        run()
    spark.createDataFrame([("a",)], "value string").write.text(f"{tmp_out}/in")
    assert run().computed == ["read"] and run().computed == []
    spark.createDataFrame([("b",)], "value string").write.mode("append").text(f"{tmp_out}/in")
    assert run().computed == ["read"] and run().counts == {"read": 2}


def land(spark, folder, rows):
    spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in rows], "value string").coalesce(1).write.text(folder)


def slices(city, temps):
    entries = [
        {"dt_txt": f"2026-06-03 {3 * i:02d}:00:00", "main": {"temp": t, "humidity": 50 + i}, "pop": 0.1, "weather": []}
        for i, t in enumerate(temps)
    ]
    return {"city": city, "list": entries}


def test_landed_batch(spark, tmp_out):
    land(spark, f"{tmp_out}/geo", [
        {"city": "A", "hits": [{"lat": "1.5", "lon": "2"}]}, {"city": "B", "hits": [{"lat": "3", "lon": "-4"}]}, {"city": "C", "hits": []},
    ])
    land(spark, f"{tmp_out}/fc", [slices("A", [20.0, 25.0]), slices("B", [10.0]), slices("C", [40.0]), {"city": "A", "cod": "401"}])
    hotel = {"city": "A", "name": "h1", "score": "8.0", "url": "u1"}
    land(spark, f"{tmp_out}/feed", ["[", json.dumps(hotel), "][", json.dumps({**hotel, "city": "B", "url": "u2", "score": "x"}), "]"])
    paths = [f"{tmp_out}/{n}" for n in ("geo", "fc", "feed")]
    first, run = run_landed_batch(spark, *paths, f"{tmp_out}/out")
    assert first.version == 1 and len(run.computed) == len(landed_stages(*paths))
    got = [(r["rank"], r["city"], r["score"]) for r in first.read(spark, "city_recommendations").orderBy("rank").collect()]
    assert got == [(1, "A", 25.0 - 1.0 + 8.0), (2, "B", None)]
    assert {r.city for r in first.read(spark, "top_map").collect()} == {"A", "B"}
    again, run = run_landed_batch(spark, *paths, f"{tmp_out}/out")
    assert again == first and run.computed == []
    other, run = run_landed_batch(spark, *paths, f"{tmp_out}/out", weights=(10, 0, 3))
    assert other.version == 2 and "weather" not in run.computed and "scores" in run.computed
    land(spark, f"{tmp_out}/more", [slices("B", [30.0])])
    _, run = run_landed_batch(spark, paths[0], f"{tmp_out}/more", paths[2], f"{tmp_out}/out")
    assert run.computed[0] == "weather" and "hotels" not in run.computed


def test_landed_command(spark, tmp_out, capsys):
    from destrank.__main__ import main

    land(spark, f"{tmp_out}/geo", [{"city": "A", "hits": [{"lat": "1.5", "lon": "2"}]}])
    land(spark, f"{tmp_out}/fc", [slices("A", [20.0])])
    land(spark, f"{tmp_out}/feed", ['[{"city": "A", "name": "h", "score": "8", "url": "u"}]'])
    main(["landed", "--geocodes", f"{tmp_out}/geo", "--forecasts", f"{tmp_out}/fc", "--feed", f"{tmp_out}/feed", "--out", f"{tmp_out}/o"])
    told = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert told["version"] == 1 and told["cities"] == told["hotels"] == told["city_recommendations"] == 1


def test_landed_batch_of_nothing(spark, tmp_out):
    for name in ("geo", "fc", "feed"):
        spark.createDataFrame([], "value string").write.text(f"{tmp_out}/{name}")
    done, _ = run_landed_batch(spark, *[f"{tmp_out}/{n}" for n in ("geo", "fc", "feed")], f"{tmp_out}/out")
    assert {t.rows for t in done.tables.values()} == {0}
    assert done.read(spark, "cities").columns == schemas.CITIES.names


def test_row_numbers(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("(id * 37) % 1000 AS x", "id % 3 AS rank", "cast(null as string) AS _part")
    got = with_row_numbers(df, ["x"], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 1001)) and [r.x for r in got] == list(range(1000))
    assert with_row_numbers(df, [df["rank"].desc(), "x"], "n", start=0).where("n = 0").first().x == df.where("rank = 2").agg({"x": "min"}).first()[0]
    assert with_row_numbers(df.limit(0), ["x"], "n").count() == 0


def test_write_table_counts(spark, tmp_out):
    t = write_table(numbers(spark, 12), f"{tmp_out}/t")
    assert t.rows == 12 and t.read(spark).count() == 12
    assert not os.path.exists(f"{tmp_out}/x") and scratch_dir(spark, "x") != scratch_dir(spark, "x")
