"""Periodic runs of words, found by tiles of every period octave.

A run is a stretch of words with smallest period q, at least ``MIN_WORDS`` and
``MIN_REPEATS`` periods long, that no neighbouring word extends. Its words
agree with those q later over an interval that holds whole blocks.

1. Every text is exploded into overlapping tiles, once per octave of periods
   (S to 2S - 1; the octaves below ``SHARED`` share their tiles). A tile is the
   words of its core, S before it and 4S after it, as numbers; the tiles of a
   long text are dealt out over the cluster.
2. A tile is solved on its own. At each of its boundaries (every S words), the
   shifts whose next S words agree are told by rolling hashes; for boundaries
   that have any, the Z-functions of the words after and before it say exactly
   how far each shift agrees in both directions. A shift whose words are
   themselves a repetition is left to its smaller period.
3. The agreeing intervals are shuffled by text and period, those that touch
   are stitched, and those long enough are runs.

``collapse`` keeps the first period of every run and drops its other words.

Hashes only point at shifts; the Z-functions decide. Work is about n log n for
n words, a task holds one batch of tiles, and only intervals that may be part
of a run are shuffled, never texts, while the runs are small (counted) enough
to be broadcast; beyond that the texts are joined to them by shuffle.

Defined cases: null and empty texts and texts of few words have no runs;
rows with equal id and text are solved once and returned each; a null id is an
id like others; other columns are passed on; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, fresh_name, saved, table, text_key

MIN_WORDS = 24
MIN_REPEATS = 3
#: Shortest block; shorter periods need 24 words too, so their runs hold one.
LEAST_BLOCK = 8
#: Octaves up to this block share tiles of CORE words; larger ones have cores of 8 blocks.
SHARED, CORE = 256, 4096
#: Texts of more characters have their tiles dealt out.
LONG_CHARS = 1 << 16
WORDS_AT_ONCE = 1 << 20
#: Runs of at most so many bytes are broadcast to the texts.
BROADCAST_BYTES = 64 << 20
KEY_BYTES, RUN_BYTES = 64, 32

TILES = "key string, tile int, blocks array<int>, core_start int, core_end int, start int, words binary"
INTERVALS = "key string, period int, start int, end int"

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def blocks_of(n: int) -> list[int]:
    """The block of every octave that a text of ``n`` words can have runs in."""
    out = [LEAST_BLOCK] if n >= MIN_WORDS else []
    while out and MIN_REPEATS * 2 * out[-1] <= n:
        out.append(2 * out[-1])
    return out


def tiles_of(n: int) -> Iterator[tuple[list[int], int, int, int, int]]:
    """(blocks, core start, core end, start, end) of the tiles of ``n`` words."""
    blocks = blocks_of(n)
    together = [[b for b in blocks if b <= SHARED], *[[b] for b in blocks if b > SHARED]]
    for group in filter(None, together):
        most = group[-1]
        core = CORE if most <= SHARED else 8 * most
        for at in range(0, n, core):
            yield group, at, min(at + core, n), max(at - most, 0), min(at + core + 4 * most, n)


def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text) rows -> tiles, their words as numbers."""
    for batch in batches:
        rows: list[tuple] = []
        held = 0
        for key, text in zip(batch.column(0), batch.column(1)):
            words = (text.as_py() or "").encode().split()  # ASCII white space only
            number: dict[bytes, int] = {}
            codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words))
            for k, (blocks, core_start, core_end, start, end) in enumerate(tiles_of(len(words))):
                rows.append((key.as_py(), k, blocks, core_start, core_end, start, codes[start:end].tobytes()))
                held += end - start
                if held >= WORDS_AT_ONCE:
                    yield _tile_batch(rows)
                    rows, held = [], 0
        yield _tile_batch(rows)


def _tile_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    names = [c.split()[0] for c in TILES.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def z_function(s: list) -> list[int]:
    """For every place, how far the sequence from there agrees with its start."""
    n = len(s)
    z = [0] * n
    z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def prime_factors(n: int) -> tuple[int, ...]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return (*out, n) if n > 1 else tuple(out)


def least_interval(period: int) -> int:
    """Agreeing words that a run of this period has at least."""
    return max(MIN_WORDS - period, (MIN_REPEATS - 1) * period)


def boundary_intervals(words: list[int], at: int, block: int, shifts: list[int]) -> Iterator[tuple[int, int, int]]:
    """(shift, start, end) around the boundary ``at``: the words of the interval
    agree with those a shift later. Only shifts whose next block agrees and
    whose words are no repetition; looks a block back and two blocks on."""
    after = z_function(words[at : at + 4 * block])
    back = words[max(at - block, 0) : at][::-1]
    ahead = words[max(at - block, 0) : at + 2 * block][::-1]
    before = z_function([*back, None, *ahead])
    for q in shifts:
        if q >= len(after) or after[q] < block:
            continue  # the hashes agree by chance
        if any(after[q // p] >= q - q // p for p in prime_factors(q)):
            continue
        place = len(ahead) - len(back) - q  # of the word before at + q, from the end
        yield q, at - min(before[len(back) + 1 + place], len(back)), at + min(after[q], 2 * block)


def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles -> intervals that may belong to runs."""
    for batch in batches:
        tiles = batch.to_pylist()
        words = [np.frombuffer(t["words"], np.int32) for t in tiles]
        offsets = np.cumsum([0, *map(len, words)])
        hashes = (np.concatenate([*words, np.zeros(0, np.int32)]).astype(np.uint64) + np.uint64(1)) * _FACTOR
        hashes ^= hashes >> np.uint64(29)
        factor, size = _FACTOR, 1
        rows: list[tuple] = []
        for block in sorted({b for t in tiles for b in t["blocks"]}):
            while size < block:  # of windows twice as long
                hashes[: len(hashes) - size] = hashes[: len(hashes) - size] * factor + hashes[size:]
                factor, size = np.uint64(int(factor) ** 2 % (1 << 64)), 2 * size
            shifts = np.arange(1 if block == LEAST_BLOCK else block, 2 * block)
            for k, tile in enumerate(tiles):
                if block in tile["blocks"]:
                    rows += _tile_intervals(tile, words[k], hashes[offsets[k] : offsets[k + 1]], block, shifts)
        columns = list(zip(*rows)) or [()] * 4
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "period", "start", "end"]
        )


def _tile_intervals(
    tile: dict, codes: np.ndarray, hashes: np.ndarray, block: int, shifts: np.ndarray
) -> list[tuple[str, int, int, int]]:
    first = tile["core_start"] - tile["start"]
    whole = len(codes) - block  # the last place of a whole window
    at = np.arange(first, min(tile["core_end"] - tile["start"], whole + 1), block)
    if not len(at):
        return []
    there = at[:, None] + shifts
    agree = hashes[np.minimum(there, whole)] == hashes[at][:, None]
    agree &= there <= whole
    hit_rows = np.flatnonzero(agree.any(axis=1))
    if not len(hit_rows):
        return []
    found: dict[int, list[list[int]]] = {}
    listed = codes.tolist()
    for r in hit_rows.tolist():
        for q, start, end in boundary_intervals(listed, int(at[r]), block, shifts[agree[r]].tolist()):
            own = found.setdefault(q, [])
            if own and start <= own[-1][1]:
                own[-1][1] = max(own[-1][1], end)
            else:
                own.append([start, end])
    core_end = tile["core_end"] - tile["start"]
    return [
        (tile["key"], q, start + tile["start"], end + tile["start"])
        for q, own in found.items()
        for start, end in own
        if end - start >= least_interval(q) or start <= first or end >= core_end
    ]


def _tile_key(docs: DataFrame, row_id: str, text: str) -> Column:
    return text_key(F.col(f"`{row_id}`").cast("string"), F.col(f"`{text}`"))


def find_runs(docs: DataFrame, row_id: str = "doc_id", text: str = "text", long_chars: int = LONG_CHARS) -> DataFrame:
    """(key, runs) of the texts that have any; runs are (start, length,
    period), in words, by start and period. ``key`` is that of ``collapse``."""
    rows = docs.select(_tile_key(docs, row_id, text).alias("key"), F.col(f"`{text}`").alias("text"))
    n_chars = F.coalesce(F.length("text"), F.lit(0))
    short, long = rows.where(n_chars <= long_chars), rows.where(n_chars > long_chars)
    intervals = short.mapInArrow(lambda batches: solved(exploded(batches)), INTERVALS).unionByName(
        long.mapInArrow(exploded, TILES).repartition("key", "tile").mapInArrow(solved, INTERVALS)
    )
    return stitched(intervals)


def stitched(intervals: DataFrame) -> DataFrame:
    """Intervals of one text and period that touch, put together; the runs
    that they make, gathered per text."""
    in_order = Window.partitionBy("key", "period").orderBy("start", "end")
    reach = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begun = F.sum(F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)).over(in_order)
    whole = (
        intervals.distinct()  # rows with equal id and text told the same
        .withColumn("reach", reach)
        .withColumn("piece", begun)
        .groupBy("key", "period", "piece")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    agreeing = F.col("end") - F.col("start")
    enough = agreeing >= F.greatest(MIN_WORDS - F.col("period"), (MIN_REPEATS - 1) * F.col("period"))
    run = F.struct(
        F.col("start").cast("long").alias("start"),
        (agreeing + F.col("period")).cast("long").alias("length"),
        F.col("period").cast("long").alias("period"),
    )
    by_place = F.array_sort(
        F.transform(F.collect_list(run), lambda r: F.struct(r["start"], r["period"], r["length"])),
    )
    ordered = F.transform(by_place, lambda r: F.struct(r["start"], r["length"], r["period"]))
    return whole.where(enough).groupBy("key").agg(ordered.alias("runs"))


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last two columns, text and runs, -> the collapsed text."""
    for batch in batches:
        out = []
        texts, runs = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
        for text, own in zip(texts, runs):
            words = (text.as_py() or "").encode().split()
            if own.as_py():
                edge = np.zeros(len(words) + 1, np.int64)
                for run in own.as_py():
                    edge[run["start"] + run["period"]] += 1
                    edge[run["start"] + run["length"]] -= 1
                words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
            out.append(b" ".join(words).decode())
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], pa.array(out, pa.string()), runs], names=[*names[:-2], "text", names[-1]]
        )


def collapse(
    docs: DataFrame, row_id: str = "doc_id", text: str = "text", runs: str = "runs", long_chars: int = LONG_CHARS
) -> DataFrame:
    """``docs`` with the text's words joined by single spaces, without those
    that a run contains after its first period, and a column of the runs."""
    others = [c for c in docs.columns if c.lower() not in (text.lower(), runs.lower())]
    found = saved(find_runs(docs, row_id, text, long_chars), "runs")
    size = found.agg(F.sum(KEY_BYTES + RUN_BYTES * F.size("runs"))).first()[0] or 0
    key = fresh_name(docs, "_key")
    keyed = docs.withColumn(key, _tile_key(docs, row_id, text))
    joined = keyed.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, keyed[key] == found["key"], "left")
    places = [f"c{i}" for i in range(len(others))]
    rows = joined.select(*[keyed[c].alias(p) for c, p in zip(others, places)], keyed[text].alias("text"), found["runs"])
    kinds = [f"{p} {rows.schema[p].dataType.simpleString()}" for p in [*places, "text", "runs"]]
    out = rows.mapInArrow(_collapsed, ", ".join(kinds))
    own = F.coalesce("runs", F.array().cast(rows.schema["runs"].dataType))
    return out.select(*[F.col(p).alias(c) for c, p in zip(others, places)], F.col("text").alias(text), own.alias(runs))


def planted(doc_id: Column, text: Column) -> Column:
    """The query's texts: every tenth id by checksum has its words from one
    place on replaced by repetitions of the words that begin there."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        start = F.pmod(g, n).cast("int")
        period = (1 + F.floor((n - start) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        again = F.flatten(F.array_repeat(F.slice(words, start + 1, period), F.ceil((n - start) / period).cast("int")))
        whole = F.concat(F.slice(words, F.lit(1), start), F.slice(again, F.lit(1), n - start))
        return F.when(n > 0, F.array_join(whole, " ")).otherwise("")

    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.when(F.pmod(h, F.lit(10)) == 0, F.get(F.transform(F.array(words), repeated), F.lit(0))).otherwise(text)


def strongest_run(runs: Column) -> Column:
    """The run of greatest length over period, compared exactly; the first of
    equals in the order of the array; null without runs."""

    def better(best: Column, run: Column) -> Column:
        wins = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(wins, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, the strongest one, and digests of all runs and
    of the collapsed text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = collapse(docs).withColumn("best", strongest_run(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise("")
    best = F.col("best")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )
