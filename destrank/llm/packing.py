"""Best-fit packing planned on the histogram of piece lengths.

1. Tasks tokenise the documents and cut only those longer than a sequence.
   Every piece gets its rank among the task's pieces of the same length.
2. The counts per length (at most ``capacity`` numbers) go to the driver,
   which plans best-fit decreasing over counts: pieces of one length are laid
   into all sequences with the same free space at once. The plan says, for
   each length and interval of ranks, the first sequence and the offset.
3. A piece's rank within its length is its task's base (a running sum of
   counts per task) plus its rank in the task; a join on length and rank
   gives it its place beside its token ids; ``sequences`` lays the ids of
   each sequence together.

The plan has a few rows per length whatever the number of documents. No
document moves in step 1, and while plan and bases have at most ``PLAN_ROWS``
rows, no piece moves later either; ``sequences`` shuffles the ids once.

Defined cases: null and empty texts have the single closing id; the strings of
special tokens get their ids, as the library gives them, unless asked for as text; repeated rows
are packed each; null ids are kept; equal lengths are ranked in any order;
an empty table gives an empty result; very long texts are tokenised in
segments cut at white space.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter, deque
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_rows, give_back, kept_in_worker, saved, table
from .token_counts import byte_letters

CAPACITY = 2048
CLOSING = (0).to_bytes(4, "little")
SEGMENT_BYTES = 1 << 20
CACHED_WORDS = 700_000
CACHED_PIECES = 350_000
#: The same for lean tasks, which also forget all at their end.
LEAN_WORDS, LEAN_PIECES = 200_000, 150_000
PIECES_AT_ONCE = 2000
TEXTS_AT_ONCE = 500
MARK, LINE_WORDS = b"\0", 256
#: Letters, digits and signs of ASCII, and the letters of Latin-1, which are
#: alike in every version and normal form of Unicode, are plain.
PLAIN = re.compile("(?!.*<)[!-~À-ÖØ-öø-ÿ]+").fullmatch
PIECES_OF = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+").findall
END_OF_PIECE = "</w>"
#: Normalizer, pre-tokenizer, kind, suffix and options of a vocabulary that cuts words as ``PIECES_OF`` does.
KNOWN_RULES = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
    "BPE", END_OF_PIECE, None, False,
)
#: The letters that stand for bytes in a byte-level vocabulary; the blank between pieces stays.
BYTE_LETTERS = {octet: letter for letter, octet in byte_letters().items() if octet != 32}
#: A plan, or table of bases, of at most so many rows is broadcast.
PLAN_ROWS = 1_000_000

#: ``ids``: the token ids as little-endian 32-bit words.
PIECES = "piece int, start long, length long, ids binary, task int, task_rank long"


def op3_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Token ids of a text as little-endian 32-bit words. The vocabulary drops
    white space, so words are encoded apart and remembered; at most
    ``cached_words`` of them, of which those not met again go first. With
    ``special_as_text`` the strings of special tokens are ordinary text.

    Where the vocabulary is known to lower-case and to cut words into letters,
    digits and signs (``KNOWN_RULES``), so are the ``plain`` words here, and
    only their different pieces go through the merges, without the library's
    Unicode steps; all other words go through it whole."""

    def __init__(self, vocabulary: str, special_as_text: bool = False, cached_words: int = CACHED_WORDS, cached_pieces: int = CACHED_PIECES) -> None:
        self.cached_words, self.cached_pieces = cached_words, cached_pieces
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = special_as_text
        self.known: dict[bytes, bytes] = {}
        self.earlier: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        mark = self.tokenizer.encode(MARK.decode(), add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.merges = None
        told = json.loads(self.tokenizer.to_str())
        model = told["model"]
        rules = (told["normalizer"], told["pre_tokenizer"], model["type"], model["end_of_word_suffix"], model["dropout"], model["ignore_merges"])
        if rules == KNOWN_RULES and all(t["special"] and "<" in t["content"] for t in told["added_tokens"]):
            self.merges = Tokenizer(self.tokenizer.model)
            self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.ends[[i for t, i in model["vocab"].items() if t.endswith(END_OF_PIECE)]] = True

    def forget(self) -> None:
        """Drops all words and pieces; the vocabulary stays."""
        self.known, self.earlier, self.pieces = {}, {}, {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text; the unknown words of all are encoded at once."""
        parts = [t.split() if len(t) <= SEGMENT_BYTES else list(chain.from_iterable(map(bytes.split, _segments(t)))) for t in texts]  # ASCII white space only
        words = set().union(*parts)
        missing = words.difference(self.known)
        if len(self.known) + len(missing) > self.cached_words // 2:
            self.earlier, self.known, missing = self.known, {}, words
        if self.earlier:
            again = {w: self.earlier[w] for w in missing if w in self.earlier}
            self.known.update(again)
            missing = missing.difference(again)
        if self.merges is not None:
            missing = self._learn_plain(missing)
        self._learn([w for w in missing if MARK not in w], LINE_WORDS if self.mark is not None else 1)
        self._learn([w for w in missing if MARK in w], 1)
        return [b"".join(map(self.known.__getitem__, words)) for words in parts]

    def _learn_plain(self, words: set[bytes]) -> list[bytes]:
        """Encodes the plain words by their pieces; returns the other words."""
        rest, plain, cut = [], [], []
        for word in words:
            text = word.decode()
            if PLAIN(text):
                plain.append(word)
                cut.append(PIECES_OF(text.lower()))
            else:
                rest.append(word)
        unknown = list(set().union(*cut).difference(self.pieces))
        if len(self.pieces) + len(unknown) > self.cached_pieces:
            self.pieces, unknown = {}, list(set().union(*cut))
        for k in range(0, len(unknown), PIECES_AT_ONCE):
            some = unknown[k : k + PIECES_AT_ONCE]
            line = " ".join(some).encode().decode("latin-1").translate(BYTE_LETTERS)
            ids = np.array(self.merges.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            octets = ids.tobytes()
            self.pieces.update(zip(some, [octets[a:b] for a, b in zip([0, *ends], ends)], strict=True))
        ids_of = self.pieces.__getitem__
        self.known.update(zip(plain, [ids_of(c[0]) if len(c) == 1 else b"".join(map(ids_of, c)) for c in cut]))
        return rest

    def _learn(self, words: list[bytes], together: int) -> None:
        """Encodes ``together`` words in one call, a marker word between them:
        no word here holds the marker, so its id can only come from it."""
        lines = [words[i : i + together] for i in range(0, len(words), together)]
        texts = [f" {MARK.decode()} ".join(map(bytes.decode, line)) for line in lines]
        for line, got in zip(lines, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(got.ids, "<u4")
            ends = np.flatnonzero(ids == self.mark).tolist() if together > 1 else []
            octets = ids.tobytes()
            for word, start, end in zip(line, [0, *[e + 1 for e in ends]], [*ends, len(ids)]):
                self.known[word] = octets[4 * start : 4 * end]


def encoder_of(vocabulary: str, special_as_text: bool = False, cached_words: int = CACHED_WORDS, cached_pieces: int = CACHED_PIECES) -> WordEncoder:
    """The encoder of this worker process, kept for its next task."""
    made_of = (vocabulary, special_as_text, cached_words, cached_pieces)
    return kept_in_worker("word encoder", made_of, lambda: WordEncoder(*made_of))


def _segments(text: bytes) -> Iterator[bytes]:
    """Slices of about SEGMENT_BYTES, cut at white space."""
    at = 0
    while at < len(text):
        cut = re.compile(rb"[\x20\x09-\x0D]").search(text, at + SEGMENT_BYTES)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def pieces_of(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(piece, start, length, ids) of the cut id sequence."""
    step = 4 * capacity
    for k, at in enumerate(range(0, len(ids), step)):
        part = ids[at : at + step]
        yield k, at // 4, len(part) // 4, part


def _piece_rows(vocabulary: str, special_as_text: bool, capacity: int, id_name: str, lean: bool = False) -> Callable:
    made_of = (vocabulary, special_as_text, *((LEAN_WORDS, LEAN_PIECES) if lean else (CACHED_WORDS, CACHED_PIECES)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ranks = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            encoder = encoder_of(*made_of)
            for at in range(0, len(batch), TEXTS_AT_ONCE):
                texts = [t or b"" for t in batch.column(1).slice(at, TEXTS_AT_ONCE).cast(pa.binary()).to_pylist()]
                index, out = [], []
                for i, ids in enumerate(encoder.encode(texts), at):
                    for piece in pieces_of(ids + CLOSING, capacity):
                        index.append(i)
                        out.append((*piece, task, ranks[piece[2]]))
                        ranks[piece[2]] += 1
                columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()))]
                names = [id_name, *[c.split()[0] for c in PIECES.split(", ")]]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(index)), *columns], names=names)
        if lean:
            encoder_of(*made_of).forget()
            give_back()

    return rows


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over a length histogram: rows (length, first rank,
    end rank, first sequence, offset); rank r goes to sequence first + r - first rank."""
    plan: list[tuple[int, int, int, int, int]] = []
    free: list[deque[tuple[int, int]]] = [deque() for _ in range(capacity + 1)]  # by free space: ranges of sequences
    sequences = 0
    for length in sorted(counts, reverse=True):
        left, rank, room = counts[length], 0, length
        while left:
            while room <= capacity and not free[room]:
                room += 1
            if room > capacity:
                room, need = capacity, -(-left // (capacity // length))
                free[capacity].append((sequences, sequences + need))
                sequences += need
            first, end = free[room].popleft()
            each = min(room // length, left)  # in every sequence of the range that is used
            used = min(end - first, left // each)
            for j in range(each):
                plan.append((length, rank, rank + used, first, capacity - room + j * length))
                rank += used
            left -= used * each
            free[room - each * length].append((first, first + used))
            if first + used < end:
                free[room].appendleft((first + used, end))
            room = length  # the sequences just used may have the least room that fits
    return plan


def pack(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, special_as_text: bool = False,
    lean: bool = False,
) -> DataFrame:
    """One row per piece of every document, with its token ids, sequence and offset.
    ``lean`` tasks cost more time and keep no words for the next ones: for a job
    whose earlier steps have left each executor with more idle workers than cores."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col), F.col(text).cast("string").alias("_text"))
    id_type = source.schema[0].dataType.simpleString()
    with arrow_rows(spark, TEXTS_AT_ONCE):
        pieces = saved(source.mapInArrow(_piece_rows(vocabulary, special_as_text, capacity, id_col, lean), f"`{id_col}` {id_type}, {PIECES}"), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    per_length = per_task.groupBy("length").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("tasks")).collect()  # capacity rows at most
    counts = {r["length"]: r["n"] for r in per_length}
    plan = plan_best_fit(counts, capacity)
    schema = "length long, first_rank long, end_rank long, first_sequence long, offset long"
    places = spark.createDataFrame(plan, schema)
    if len(plan) <= PLAN_ROWS:
        places = F.broadcast(places)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if sum(r["tasks"] for r in per_length) <= PLAN_ROWS:
        bases = F.broadcast(bases)
    ranked = pieces.join(bases, ["length", "task"]).withColumn("rank", F.col("base") + F.col("task_rank"))
    on = (ranked["length"] == places["length"]) & ranked["rank"].between(places["first_rank"], places["end_rank"] - 1)
    return ranked.join(places, on).select(
        id_col, "piece", "start", ranked["length"], "ids", F.crc32("ids").alias("ids_crc32"),
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset",
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of the pieces that ``pack`` placed, each piece at its offset."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens; ids as checksums."""
    return pack(table(spark, sf_dir, "documents"), op3_vocabulary()).drop("ids")
