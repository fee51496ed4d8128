"""CSV records and JSON objects across the cuts of a file, against plain readers."""

import csv
import io
import json
import random
from pathlib import Path
from urllib.parse import urlparse

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from destrank.sources import blocks, files
from destrank.sources.blocks import BalancedObjects, QuotedLines

SCHEMA = "a string, b string, n long"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture()
def small_blocks(spark):
    """Files are cut every few dozen bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": "61", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def put(spark, path, text):
    """``text`` as one file, byte for byte."""
    folder = Path(urlparse(path).path)
    folder.mkdir(parents=True)
    (folder / "part-0.txt").write_bytes(text.encode())
    return path


def plain_split(machine, lines):
    """All records of a file without any cut."""
    out, parts, state = [], [], 0
    for line in lines:
        segments, state = machine.split(line, state)
        for text, closed in segments:
            parts.append(text)
            if closed:
                out.append("\n".join(parts))
                parts = []
    return out + ["\n".join(parts)] * bool(parts)


pieces = st.lists(st.sampled_from(['"', '""', ",", "a", "\n", "{", "}", "\\", '"x"', ",\"", "\r\n", "é"]), max_size=40)


@settings(max_examples=300, deadline=None)
@given(pieces, st.lists(st.integers(1, 6), max_size=20))
@pytest.mark.parametrize("machine", [QuotedLines(), BalancedObjects()])
def test_states_of_blocks(machine, found, cuts):
    lines = "".join(found).split("\n")
    want, got, state, at, owner, open_parts = plain_split(machine, lines), [], 0, 0, None, {}
    rows = []
    for size in [*cuts, len(lines)]:
        block = lines[at : at + size]
        if block:
            rows.append((0, at, block))
        at += size
    begins = []
    for _, block, own in rows:
        told = machine.nothing()
        for line in own:
            machine.add(told, line)
        begins.append((state, owner if state else None))
        if machine.closes(told, state):
            owner = block
        state = machine.after(told, state)
    for (s, began), (_, block, own) in zip(begins, rows):
        parts, start = [], began
        for line in own:
            segments, s = machine.split(line, s)
            for text, closed in segments:
                parts.append(text)
                if closed:
                    got.append((block if start is None else start, "\n".join([*open_parts.pop(start, []), *parts])))
                    parts, start = [], None
        if parts:
            open_parts.setdefault(block if start is None else start, []).extend(parts)
    got += [(k, "\n".join(v)) for k, v in open_parts.items()]
    assert sorted(t for _, t in got) == sorted(want)


def test_csv_lines():
    step = QuotedLines().step
    assert [step(x, 0) for x in ("a,b", 'a,"b', 'a,"b""c', 'a,"b"', 'a,"b",5"', '"', '""', '"""', 'a "b,c', '"a"x,"')] == [0, 1, 1, 0, 0, 1, 0, 1, 0, 1]
    assert [step(x, 1) for x in ("a,b", 'a"', 'a"",b', 'a",b', 'a","', '"', '""')] == [1, 0, 1, 0, 1, 0, 1]


def csv_rows(seed, n):
    rng = random.Random(seed)
    bits = ['"', "\n", ",", "é", "word", " ", "\r\n", '",', "\n\n", "漢"]
    return [("".join(rng.choice(bits) for _ in range(rng.randint(0, 12))), rng.choice(bits), i) for i in range(n)]


@pytest.mark.parametrize("broadcast", [blocks.BROADCAST_BLOCKS, 0])
def test_csv_with_breaks_across_every_cut(spark, tmp_out, small_blocks, monkeypatch, broadcast):
    monkeypatch.setattr(blocks.records, "__defaults__", (broadcast,))
    rows = csv_rows(7, 60) + [("x" * 500 + "\n" * 30 + '"' * 7, "long", 60), ("", "", 61)]
    text = io.StringIO()
    writer = csv.writer(text, lineterminator="\n", quoting=csv.QUOTE_MINIMAL)
    writer.writerow(["b", "other\nname", "n", "a"])
    for a, b, n in rows:
        writer.writerow([b, "z", n, a])
    path = put(spark, f"{tmp_out}/csv", text.getvalue())
    found = blocks.file_lines(spark, path)
    assert found.select("block").distinct().count() > 20 and found.rdd.getNumPartitions() > 20
    got = sorted(map(tuple, files.read_csv_blocks(spark, path, SCHEMA).collect()), key=lambda r: r[2])
    assert got == sorted(map(tuple, files.read_csv(spark, path, SCHEMA).collect()), key=lambda r: r[2])
    assert [(a or "", b or "", n) for a, b, n in got] == rows


def test_csv_of_documents(spark, tmp_out, small_blocks):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    files.write_csv(docs.limit(40).coalesce(1), f"{tmp_out}/docs")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    want = files.read_csv(spark, f"{tmp_out}/docs", DOCS).collect()
    got = files.read_csv_blocks(spark, f"{tmp_out}/docs", DOCS).collect()
    assert sorted(got) == sorted(want) and len(got) == 40
    assert blocks.file_lines(spark, f"{tmp_out}/docs").rdd.getNumPartitions() > 5


def test_csv_edges(spark, tmp_out, small_blocks):
    header_only = put(spark, f"{tmp_out}/none", "a,b,n\n")
    assert files.read_csv_blocks(spark, header_only, SCHEMA).count() == 0
    odd = put(spark, f"{tmp_out}/odd", 'a,b,n\r\n5" pipe,"x\r\ny",1\r\n\r\n,"",2\r\n\\N,q,3')
    got = sorted(map(tuple, files.read_csv_blocks(spark, odd, SCHEMA).collect()), key=lambda r: r[2])
    assert got == [('5" pipe', "x\r\ny", 1), (None, "", 2), (None, "q", 3)]
    same = files.read_csv(spark, odd, SCHEMA).orderBy("n").collect()
    assert [(a, b.replace("\r\n", "\n"), n) for a, b, n in got] == [tuple(r) for r in same]
    with pytest.raises(ValueError, match="no column"):
        files.read_csv_blocks(spark, odd, "missing string")
    files.write_csv(spark.range(200).selectExpr("cast(id as string) a", "'u\nv' b", "id n").repartition(3), f"{tmp_out}/three")
    assert files.read_csv_blocks(spark, f"{tmp_out}/three", SCHEMA).count() == 200  # a header in each file


@pytest.mark.parametrize("broadcast", [blocks.BROADCAST_BLOCKS, 0])
def test_feed_objects_across_cuts(spark, tmp_out, small_blocks, monkeypatch, broadcast):
    monkeypatch.setattr(blocks.records, "__defaults__", (broadcast,))
    rng = random.Random(4)
    rows = [
        {"k": i, "note": rng.choice(["{error}", "}{", 'a "quoted" {x', "back\\", "line\nbreak", "é", ""]), "in": {"d": [{"e": "}"}]}}
        for i in range(80)
    ]
    text = "".join(
        "[" + ",\n".join(json.dumps(r, indent=rng.choice([None, 1]), ensure_ascii=False) for r in rows[i : i + 4]) + "]"
        for i in range(0, 80, 4)
    )
    broken = '[{"k": 900, "note": "cut off\n[{"k": 901, "note": "next"}]\n[{"k": 902, "in": {"d": [\n'
    path = put(spark, f"{tmp_out}/feed", text + "\n" + broken)
    found = files.feed_objects(spark, path, "k long, note string").collect()
    assert {(r.k, r.note) for r in found if r._valid} == {(r["k"], r["note"]) for r in rows} | {(901, "next")}
    assert sum(not r._valid for r in found) == 2  # the one cut off and the truncated tail
    kept = files.read_feed(spark, path, "k long, note string")
    assert kept.columns == ["k", "note"] and kept.count() == 81
    by_pattern = files.read_salvaged_feed(spark, path, "k long, note string")
    assert by_pattern.count() < 81  # the original's way loses those with braces inside


def test_feed_of_nothing(spark, tmp_out):
    for name, text in (("empty", ""), ("blank", "\n\n"), ("loose", '"{" }} ] , x\n')):
        assert files.feed_objects(spark, put(spark, f"{tmp_out}/{name}", text), "k long").count() == 0
