"""The newest forecast of each place and slice over several landings."""

import json
import os
from urllib.parse import urlparse

import pytest

from destrank import schemas
from destrank.operators.rollup import daily_rollup
from destrank.streaming import NewestForecasts, keep_newest_forecasts
from destrank.streaming.newest import landed_readings, newest


def response(city, temps, day="2026-06-03"):
    entries = [
        {"dt_txt": f"{day} {3 * i:02d}:00:00", "main": {"temp": t, "humidity": 50}, "pop": 0.1, "weather": [{"description": "d"}]}
        for i, t in enumerate(temps)
    ]
    return {"city": city, "list": entries}


def land(path, name, responses, time):
    folder = urlparse(path).path
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.write("".join(json.dumps(r) + "\n" for r in responses))
    os.utime(f"{folder}/{name}.json", (time, time))


def temps(state):
    return {(r.city, r.ts[11:13]): r.temp for r in state.readings().collect()}


def test_newer_landings_replace_older_ones(spark, tmp_out):
    landing, seen = f"{tmp_out}/in", f"{tmp_out}/seen"
    state = NewestForecasts(spark, f"{tmp_out}/state", buckets=8)
    assert state.readings().count() == 0
    land(landing, "a", [response("A", [1.0, 2.0]), response("B", [3.0]), {"city": "C", "cod": 401}], 1000)
    keep_newest_forecasts(spark, landing, state, seen).awaitTermination()
    assert temps(state) == {("A", "00"): 1.0, ("A", "03"): 2.0, ("B", "00"): 3.0}
    before = state.tables.snapshot()
    land(landing, "b", [response("A", [1.5]), response(None, [9.0])], 2000)
    keep_newest_forecasts(spark, landing, state, seen).awaitTermination()
    assert temps(state) == {("A", "00"): 1.5, ("A", "03"): 2.0, ("B", "00"): 3.0}
    after = state.tables.snapshot()
    changed = {n for n in after.tables if after.tables[n] != before.tables.get(n)}
    assert after.version == before.version + 1 and len(changed) == after.note["touched"] == 1  # B's bucket is as it was
    assert {(r.city, r.temp_max) for r in daily_rollup(state.readings()).collect()} == {("A", 2.0), ("B", 3.0)}
    land(landing, "c", [response("B", [2.5])], 1500)  # landed before what is known of A, after what is known of B
    land(landing, "d", [response("A", [0.5])], 1500)
    keep_newest_forecasts(spark, landing, state, seen, max_files_per_trigger=1).awaitTermination()
    assert temps(state) == {("A", "00"): 1.5, ("A", "03"): 2.0, ("B", "00"): 2.5}


def test_replays_change_nothing(spark, tmp_out):
    landing = f"{tmp_out}/in"
    state = NewestForecasts(spark, f"{tmp_out}/state", buckets=4)
    land(landing, "a", [response("A", [1.0, 2.0])], 1000)
    land(landing, "b", [response("A", [5.0])], 2000)
    keep_newest_forecasts(spark, landing, state, f"{tmp_out}/one").awaitTermination()
    want, version = temps(state), state.tables.snapshot().version
    keep_newest_forecasts(spark, landing, state, f"{tmp_out}/two").awaitTermination()  # the same batch number again
    assert temps(state) == want and state.tables.snapshot().version == version
    keep_newest_forecasts(spark, landing, state, f"{tmp_out}/three", name="other").awaitTermination()
    assert temps(state) == want == {("A", "00"): 5.0, ("A", "03"): 2.0}
    rows = landed_readings(spark.read.schema(schemas.FORECAST_RESPONSE).json(landing))
    assert state.merge(rows.limit(0)).note["buckets"] == 4 and temps(state) == want
    with pytest.raises(ValueError, match="buckets"):
        NewestForecasts(spark, f"{tmp_out}/state", buckets=5)


def test_ties_by_file_then_values(spark):
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.READINGS) + ", landed timestamp, file string"
    row = ("A", "2026-06-03", "t", 1.0, 5, 0.1, "x")
    rows = [(*row, None, "z"), (*row[:3], 2.0, *row[4:], None, "a"), (*row[:2], "u", 3.0, 5, 0.1, None, None, "f"), (*row[:2], "u", 4.0, 5, 0.1, None, None, "f")]
    got = {r.ts: r.temp for r in newest(spark.createDataFrame(rows, ddl)).collect()}
    assert got == {"t": 1.0, "u": 4.0}
