"""Byte-level BPE encoding and decoding.

Only the distinct words of the corpus are encoded: Spark higher-order
functions fold the ranked merges over each word's bytes, looking ranks up in a
literal map and keeping the neighbours' ranks, of which a merge changes two.
(Spark searches a map from its start, so the literal is an array of small
maps, addressed by checksum.) Words of more than ``FOLD_BYTES`` bytes go
through a heap instead, whose work does not grow with the square of the
length. Bytes are written as hexadecimal pairs while they are merged.

1. Tasks cut documents into blocks of about ``BLOCK_WORDS`` different words (at
   least one document) and write each document as its words' numbers in the
   block: texts are read once.
2. Spark groups the blocks' words by word, so that each is folded once, with
   the places (block, number) that ask for it. A word asks once a block; a word
   of very many blocks is split by blocks (``PLACES``).
3. The ids go back to their blocks, packed, and documents are put together
   there (``encode``). ``decode`` concatenates the ids' binary pieces.

Nothing but the vocabulary is broadcast and only a count reaches the driver.

Words are found by the pattern, in pieces of text cut at single spaces, where
the pattern always cuts too. Defined cases: null and empty texts have no
tokens; repeated rows are encoded each; null ids are kept; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, give_back, saved, table

FOLD_BYTES = 64
RANK_MAPS = 1 << 14
#: A block ends with the document that brings it to so many different words, or words.
BLOCK_WORDS = 400_000
BLOCK_TOKENS = 4_000_000
#: Blocks that ask for a word in one row.
PLACES = 50_000
#: Places packed at once in a task.
PACKED_PLACES = 500_000
#: Words of a block that are looked up at once.
ASSEMBLED_WORDS = 500_000
#: Texts given to a task at once.
TEXTS_AT_ONCE = 500
#: A place is a long: task, block of the task, number in the block.
BLOCK_BITS, NUMBER_BITS = 15, 28
_SPACES = "\t\n\x0b\x0c\r\x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def pieces_of(text: str) -> list[str]:
    """``text`` cut before single spaces between other characters; the pattern
    gives the same words for the pieces as for the whole."""
    parts = text.split(" ")
    parts[1:] = [" " + p for p in parts[1:]]
    if "  " in text or any(s + " " in text for s in _SPACES):
        joined: list[str] = []
        for p in parts:
            if joined and joined[-1][-1:].isspace():
                joined[-1] += p
            else:
                joined.append(p)
        parts = joined
    return parts if parts[0] else parts[1:]


def rank_literal(ranks: dict[bytes, int], maps: int = RANK_MAPS) -> Column:
    """The ranks by hexadecimal token as a constant array of maps."""
    cells: list[dict[str, int]] = [{} for _ in range(maps)]
    for token, rank in ranks.items():
        name = token.hex()
        cells[zlib.crc32(name.encode()) % maps][name] = rank
    return F.from_json(F.lit(json.dumps(cells)), "array<map<string,int>>")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row."""
    return F.aggregate(F.array(F.lit(0)), value, lambda v, _: v, use)


def fold_merges(word: Column, ranks: Column, maps: int = RANK_MAPS) -> Column:
    """Token ids of one non-empty word: merges the neighbours of least rank,
    leftmost first, until no neighbours have a rank."""

    def rank(token: Column) -> Column:
        cell = F.get(ranks, (F.crc32(token.cast("binary")) % F.lit(maps)).cast("int"))
        return F.try_element_at(cell, token)

    def apply(state: Column, at: Column) -> Column:  # at, from 1: the left one's place
        parts, known = state["parts"], state["ranks"]
        merged = F.concat(F.get(parts, at - 1), F.get(parts, at))
        beside = F.array(found(F.concat(F.get(parts, at - 2), merged)), found(F.concat(merged, F.get(parts, at + 1))))
        return F.struct(
            F.concat(F.slice(parts, 1, at - 1), F.array(merged), F.slice(parts, at + 2, F.size(parts))).alias("parts"),
            F.concat(F.slice(known, 1, at - 2), beside, F.slice(known, at + 2, F.size(known))).alias("ranks"),
        )

    def found(token: Column) -> Column:
        return F.coalesce(rank(token), F.lit(none))

    def merge(state: Column, _: Column) -> Column:
        at = F.array_position(state["ranks"], F.array_min(state["ranks"])).cast("int")
        return F.when(F.array_min(state["ranks"]) == none, state).otherwise(_bound(at, lambda i: apply(state, i)))

    none, end = 2**31 - 1, F.array(F.lit("-"))  # no token has the end mark
    octets = F.concat(end, F.regexp_extract_all(F.lower(F.hex(word)), F.lit("(..)"), 1), end)

    def start(parts: Column) -> Column:
        pairs = F.sequence(F.lit(0), F.size(parts) - 2)
        ranked = F.transform(pairs, lambda i: found(F.concat(F.get(parts, i), F.get(parts, i + 1))))
        return F.struct(parts.alias("parts"), ranked.alias("ranks"))

    rounds = F.sequence(F.lit(1), F.greatest(F.octet_length(word), F.lit(1)))
    folded = F.aggregate(rounds, _bound(octets, start), merge)["parts"]
    whole = rank(F.lower(F.hex(word)))
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(F.slice(folded, 2, F.size(folded) - 2), rank))


def heap_merges(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for very long words: neighbours in a heap, parts in a list."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or end[after[i]] != stop:
            continue
        j = after[i]
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[i] < n:
            before[after[i]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] < n:
                token = word[a : end[after[a]]]
                if token in ranks:
                    heapq.heappush(heap, (ranks[token], a, end[after[a]]))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


class _Numbers(dict):
    """Pieces of text -> their words' numbers in the block, as 32-bit words."""

    def __init__(self, find: Callable[[str], list[str]]) -> None:
        self.find, self.words = find, {}

    def __missing__(self, piece: str) -> bytes:
        words = self.words
        value = self[piece] = array("I", [words.setdefault(w, len(words)) for w in self.find(piece)]).tobytes()
        return value


def _packed(values: np.ndarray, most: int) -> bytes:
    return zlib.compress(values.astype("<u2" if most <= 1 << 16 else "<u4").tobytes(), 1)


def _unpacked(data: bytes, most: int) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<u2" if most <= 1 << 16 else "<u4")


def _block_schema(id_type: pa.DataType) -> pa.Schema:
    kinds = {"block": pa.int64(), "ids": pa.list_(id_type), "sizes": pa.list_(pa.int64()), "numbers": pa.binary(), "n_words": pa.int64(), "words": pa.list_(pa.string())}
    return pa.schema([*kinds.items(), ("at", pa.list_(pa.int32())), ("heaped", pa.list_(pa.binary()))])


def _block_rows(pattern: str, ranks: Broadcast, block_words: int) -> Callable:
    """A row per block: its documents' ids, sizes in words and word numbers, and
    its words by number; null for long ones, whose token ids are given."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(pattern).findall
        block = TaskContext.get().partitionId() << BLOCK_BITS
        known, ids, found, size = _Numbers(find), [], [], 0

        def written() -> pa.RecordBatch:
            words, at, heaped = list(known.words), [], []
            for i, word in enumerate(words):
                if 4 * len(word) > FOLD_BYTES and len(octets := word.encode()) > FOLD_BYTES:
                    words[i] = None
                    at.append(i)
                    heaped.append(np.array(heap_merges(octets, ranks.value), "<u4").tobytes())
            numbers = _packed(np.frombuffer(b"".join(found), "<u4"), len(words))
            of_docs = pa.concat_arrays(ids)
            lists = pa.ListArray.from_arrays(pa.array([0, len(of_docs)], pa.int32()), of_docs)
            sizes = [len(f) // 4 for f in found]
            schema = _block_schema(of_docs.type)
            columns = [[block], lists, [sizes], [numbers], [len(words)], [words], [at], [heaped]]
            return pa.RecordBatch.from_arrays([c if c is lists else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            start = 0
            for i, text in enumerate(batch.column(1).to_pylist()):
                found.append(b"".join(map(known.__getitem__, pieces_of(text or ""))))
                size += len(found[-1])
                if len(known.words) >= block_words or size >= 4 * BLOCK_TOKENS:
                    ids.append(batch.column(0).slice(start, i + 1 - start))
                    yield written()
                    block, start = block + 1, i + 1
                    known, ids, found, size = _Numbers(find), [], [], 0
            if start < len(batch):
                ids.append(batch.column(0).slice(start))
        if found:
            yield written()
        del known, ids, found
        give_back()

    return rows


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of the stretches (start, size), one stretch after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values, pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)


_PACKED = "block long, at binary, sizes binary, ids binary"


def _packed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of words (places, ids), packed by block."""

    def written(held: list[tuple]) -> pa.RecordBatch:
        places, words, sizes, ids = [], [], [], []
        n = 0
        for place, of_word, tokens, of_ids in held:
            places.append(place)
            words.append(np.repeat(np.arange(n, n + len(of_word)), of_word))
            sizes.append(of_ids)
            ids.append(tokens)
            n += len(of_word)
        place, word, size, token = (np.concatenate(c) for c in (places, words, sizes, ids))
        start = np.cumsum(size) - size
        order = np.argsort(place)
        place, word = place[order], word[order]
        block = place >> NUMBER_BITS
        cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
        out = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            some = word[a:b]
            at = (place[a:b] & ((1 << NUMBER_BITS) - 1)).astype("<u4")
            got = token[_spread(start[some], size[some])].astype("<u4")
            out.append((int(block[a]), at.tobytes(), size[some].astype("<u4").tobytes(), got.tobytes()))
        columns = [pa.array(c, pa.binary() if i else pa.int64()) for i, c in enumerate(zip(*out))]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _PACKED.split(", ")])

    held, n = [], 0
    for batch in batches:
        if len(batch):
            held.append((*_lists(batch.column(0)), *_lists(batch.column(1))))
            n += len(held[-1][0])
        if n >= PACKED_PLACES:
            yield written(held)
            held, n = [], 0
    if held:
        yield written(held)
    del held
    give_back()


def _assembled(id_name: str) -> Callable:
    """(id, ids) of a block's documents from its packed words and its row."""

    def rows(packed: pa.Table, block: pa.Table) -> pa.Table:
        row = {c: block.column(c).combine_chunks() for c in block.column_names}
        n = row["n_words"][0].as_py()
        heaped = row["heaped"][0].as_py()
        at, sizes, ids = (np.frombuffer(b"".join(packed.column(c).to_pylist()), "<u4") for c in ("at", "sizes", "ids"))
        at = np.concatenate([at, np.array(row["at"][0].as_py(), "<u4")])
        sizes = np.concatenate([sizes, np.array([len(h) // 4 for h in heaped], "<u4")]).astype(np.int64)
        ids = np.concatenate([ids, np.frombuffer(b"".join(heaped), "<u4")])
        start, size = np.zeros(n, np.int64), np.zeros(n, np.int64)
        start[at], size[at] = np.cumsum(sizes) - sizes, sizes
        numbers = _unpacked(row["numbers"][0].as_py(), n)
        ends = np.cumsum(row["sizes"].flatten().to_numpy())
        before = np.zeros(len(ends) + 1, np.int64)  # ids before each document, and in all
        out, n_ids = bytearray(), 0
        for k in range(0, len(numbers), ASSEMBLED_WORDS):
            some = numbers[k : k + ASSEMBLED_WORDS]
            counts = size[some]
            a, b = np.searchsorted(ends, [k + 1, k + len(some) + 1])  # documents that end among these words
            total = np.cumsum(counts)
            before[a + 1 : b + 1] = n_ids + total[ends[a:b] - k - 1]
            before[b + 1 :] = n_ids = n_ids + int(total[-1])
            out += ids[_spread(start[some], counts)].tobytes()
        octets = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer((4 * before).astype(np.int32).tobytes()), pa.py_buffer(out)])
        del numbers, start, size, at, sizes, ids
        give_back()
        return pa.table([row["ids"].flatten(), octets], names=[id_name, "ids"])

    return rows


def encode(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text: str = "text", block_words: int = BLOCK_WORDS, places: int = PLACES
) -> DataFrame:
    """(id, ids) of every document: its token ids as little-endian 32-bit words."""
    ranks = read_ranks(vocabulary)
    source = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    id_type = source.schema[0].dataType.simpleString()
    kinds = f"block long, ids array<{id_type}>, sizes array<long>, numbers binary, n_words long, words array<string>, at array<int>, heaped array<binary>"
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # the vocabulary: a fixed size
    with arrow_rows(docs.sparkSession, TEXTS_AT_ONCE):
        blocks = saved(source.mapInArrow(_block_rows(pattern, shared, block_words), kinds), "blocks")
    split = F.pmod(F.xxhash64("block"), F.lit(blocks.count() // places + 1)).alias("split")
    words = blocks.select("block", F.posexplode("words").alias("number", "word")).filter("word IS NOT NULL")
    place = F.shiftleft("block", NUMBER_BITS).bitwiseOR(F.col("number").cast("long")).alias("place")
    # Spread before grouping: a word comes once a block, so there is little to combine earlier.
    words = words.select("word", split, place).repartition("word", "split").groupBy("word", "split").agg(F.collect_list("place").alias("places"))
    folded = words.select("places", fold_merges(F.col("word"), rank_literal(ranks)).alias("ids"))
    packed = folded.mapInArrow(_packed_rows, _PACKED)
    return packed.groupBy("block").cogroup(blocks.drop("words").groupBy("block")).applyInArrow(_assembled(id_col), f"`{id_col}` {id_type}, ids binary")


def decode(spark: SparkSession, ids: Column, vocabulary: str) -> Column:
    """The bytes of each id sequence that ``encode`` gives: its ids' binary pieces, concatenated."""
    ranks = read_ranks(vocabulary)
    pieces: list[bytes] = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    tokens = spark.sparkContext.broadcast(pieces)  # the vocabulary: a fixed size

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        piece = tokens.value.__getitem__
        for rows in batches:
            yield rows.map(lambda x: b"".join(map(piece, np.frombuffer(x, "<u4").tolist())))

    return decoded(ids)


def encode_documents(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text: str = "text", block_words: int = BLOCK_WORDS, places: int = PLACES
) -> DataFrame:
    """(id, ids, n_tokens, ids_sha256, decoded_sha256) of every document."""
    got = encode(docs, vocabulary, pattern, id_col, text, block_words, places)
    decoded = decode(docs.sparkSession, F.col("ids"), vocabulary)
    return got.select(
        F.col(id_col), "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(decoded, 256).alias("decoded_sha256"),
    )


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by the 50k byte-level ranks, and decoded again, as digests."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    found = encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).drop("ids")
    with arrow_rows(spark, TEXTS_AT_ONCE):  # a batch of ids or bytes is held by both sides
        return saved(found, "digests")
