"""Records that span lines, read from one file by many tasks.

Spark cuts a file into blocks of whole lines, but a line may begin inside a
record: within a quoted CSV field, or within a JSON object. What a block does
to the state that it begins in is a small function; the functions of a file's
blocks, put one after the other, give every block the state that it begins in.

1. Each task sums its blocks up to their functions (``summaries``).
2. One small row a block is run through in file order (``states``): the state
   at its start, and the block in which the record open there began.
3. Each task splits its blocks from the known state (``split``). Records that
   lie in one block are whole; the parts of the others (at most two a block)
   are gathered by the block where the record begins.

The text is read three times where it lies and never shuffled, but for the
parts of records that cross a cut.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from destrank.session import checkpoint_counted

# Task code is shipped by value: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Block states are broadcast to the lines up to so many blocks (24 bytes each).
BROADCAST_BLOCKS = 1 << 20
FAR = 1 << 40

SUMMARIES = "file long, block long, told array<long>"
STATES = "file long, block long, state long, owner long"
RECORDS = "file long, owner long, piece long, first boolean, text string"


@dataclass(frozen=True)
class QuotedLines:
    """CSV records. State 1 is inside a quoted field at the end of a line. A
    quote opens a field only at its start; doubled, it stands for itself; what
    follows a closing quote up to the delimiter belongs to the field."""

    delimiter: str = ","
    quote: str = '"'

    def step(self, line: str, state: int) -> int:
        quote, opening, at = self.quote, self.delimiter + self.quote, 0
        if quote not in line:
            return state
        if not state:
            if not line.startswith(quote):
                at = line.find(opening) + 1
                if not at:
                    return 0
            at += 1
        while True:  # ``at`` is inside a quoted field
            close = line.find(quote, at)
            if close < 0:
                return 1
            if line.startswith(quote, close + 1):
                at = close + 2
                continue
            at = line.find(opening, close + 1)
            if at < 0:
                return 0
            at += 2

    def nothing(self) -> list[int]:
        return [0, 1, 0]

    def add(self, told: list[int], line: str) -> None:
        """``told``: the state after the lines from either start, and whether a
        record ended in them that was open at the start."""
        after = [self.step(line, 0), self.step(line, 1)]
        told[0], told[1] = after[told[0]], after[told[1]]
        told[2] |= not told[1]

    def after(self, told: list[int], state: int) -> int:
        return told[state]

    def closes(self, told: list[int], state: int) -> bool:
        return bool(told[2]) if state else True

    def split(self, line: str, state: int) -> tuple[list[tuple[str, bool]], int]:
        state = self.step(line, state)
        return [(line if state else line.removesuffix("\r"), not state)], state


@dataclass(frozen=True)
class BalancedObjects:
    """JSON objects, whatever stands between them. The state is the number of
    open braces at the end of a line. Braces in strings do not count; a string
    cannot hold a line break, so one that is open at the end of its line breaks
    the object off there."""

    token = re.compile(r'[{}]|"(?:[^"\\]|\\.)*(?:"|\\?$)')

    def _tokens(self, line: str) -> Iterator[tuple[str, int]]:
        """Braces with their places; '"' for a string that does not end."""
        for found in self.token.finditer(line):
            text = found[0]
            if text in "{}":
                yield text, found.start()
            elif len(text) < 2 or text[-1] != '"' or (len(text) - len(text[:-1].rstrip("\\")) - 1) % 2:
                yield '"', found.start()
                return

    def nothing(self) -> list[int]:
        return [0, 0, 0]

    def add(self, told: list[int], line: str) -> None:
        """``told``: the depth after the lines is max(depth + told[0], told[1]);
        the least that the depth came to, against the start, is told[2]."""
        if "{" not in line and "}" not in line and '"' not in line:
            return
        net, least = told[0], told[2]
        for token, _ in self._tokens(line):
            if token == '"':
                told[:] = [-FAR, 0, -FAR]
                return
            up = 1 if token == "{" else -1
            net, told[1] = net + up, max(told[1] + up, 0)
            least = min(least, net)
        told[0], told[2] = max(net, -FAR), least

    def after(self, told: list[int], state: int) -> int:
        return max(state + told[0], told[1])

    def closes(self, told: list[int], state: int) -> bool:
        return state + told[2] <= 0

    def split(self, line: str, state: int) -> tuple[list[tuple[str, bool]], int]:
        out, begun = [], 0 if state else -1
        for token, at in self._tokens(line):
            if token == '"':
                return (out + [(line[begun:], True)] if begun >= 0 else out), 0
            if token == "{":
                begun = at if not state else begun
                state += 1
            elif state:
                state -= 1
                if not state:
                    out.append((line[begun : at + 1], True))
                    begun = -1
        return (out + [(line[begun:], False)] if state else out), state


Machine = QuotedLines | BalancedObjects


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the lines of every file, told by file and block,
    those of a block in order and together."""
    meta = F.col("_metadata")
    file = F.xxhash64(meta["file_path"], meta["file_size"], meta["file_modification_time"])
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(file.alias("file"), meta["file_block_start"].alias("block"), "value")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def summaries(machine: Machine) -> Callable:
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, told = None, machine.nothing()
        for batch in batches:
            done = []
            for file, block, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, block) != at:
                    if at:
                        done.append((*at, told))
                    at, told = (file, block), machine.nothing()
                machine.add(told, line)
            yield _batch(done, SUMMARIES)
        if at:
            yield _batch([(*at, told)], SUMMARIES)

    return summed


def states(machine: Machine) -> Callable:
    """Summaries by file and block -> the state that each block begins in."""

    def told_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, owner = None, 0, None
        for batch in batches:
            rows = []
            for file, block, told in zip(*(c.to_pylist() for c in batch.columns)):
                if file != current:
                    current, state, owner = file, 0, None
                rows.append((file, block, state, owner if state else None))
                if machine.closes(told, state):
                    owner = block
                state = machine.after(told, state)
            yield _batch(rows, STATES)

    return told_states


def split(machine: Machine, whole: bool) -> Callable:
    """Lines with the state of their block -> whole records, or the parts of
    the others (``owner``: where the record begins, ``piece``: the part's block)."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, owner, first, parts = None, 0, None, False, []

        def part() -> tuple:
            return (*at[:1], at[1] if owner is None else owner, at[1], first, "\n".join(parts))

        for batch in batches:
            rows: list[tuple] = []
            for file, block, begins, began, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, block) != at:
                    if parts and not whole:
                        rows.append(part())
                    at, state, owner, first, parts = (file, block), begins, began, block == 0, []
                segments, state = machine.split(line, state)
                for text, closed in segments:
                    parts.append(text)
                    if closed:
                        if whole and owner is None:
                            rows.append((file, None, block, first, "\n".join(parts)))
                        elif not whole and owner is not None:
                            rows.append(part())
                        owner, first, parts = None, False, []
            yield _batch(rows, RECORDS)
        if parts and not whole:
            yield _batch([part()], RECORDS)

    return records


def records(spark: SparkSession, path: str, machine: Machine, broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """(first, text): every record of the files under ``path``; ``first`` marks
    each file's first one. A record that is open at a file's end is one too."""
    lines = file_lines(spark, path)
    told = lines.mapInArrow(summaries(machine), SUMMARIES).repartition("file").sortWithinPartitions("file", "block")
    begins, blocks = checkpoint_counted(told.mapInArrow(states(machine), STATES))
    if blocks <= broadcast_blocks:
        known = lines.join(F.broadcast(begins), ["file", "block"])  # keeps the order of the lines
    else:
        known = lines.withColumn("line", F.monotonically_increasing_id()).join(begins, ["file", "block"])
        known = known.repartition("file", "block").sortWithinPartitions("file", "block", "line")
    known = known.select("file", "block", "state", "owner", "value")
    parts = known.mapInArrow(split(machine, whole=False), RECORDS).groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("piece", "text"))).alias("parts"),
        F.max(F.col("first") & (F.col("piece") == F.col("owner"))).alias("first"),
    )
    joined = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    return known.mapInArrow(split(machine, whole=True), RECORDS).select("first", "text").unionByName(
        parts.select("first", joined.alias("text"))
    )
