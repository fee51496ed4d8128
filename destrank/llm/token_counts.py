"""Token counts of every prefix of a text, by dynamic programming.

Byte-level BPE has this property: a sequence of tokens is the encoding of its
bytes just when each two neighbours are the encoding of theirs. So the last
token of every prefix of a word is found from the left: among the tokens that
end there, exactly one stands well behind the last token of the prefix before
it, and the count is that prefix's count plus one. The tokens that end at each
byte come from one automaton; the answers for pairs of tokens are remembered.

A text's counts are its words' counts added up, so that ``counts[i]`` is the
number of tokens of the first ``i`` characters, exactly as if they had been
encoded alone. Three prefixes split differently from the whole text and are
set apart: one that ends with a run of white space (the run is one word then),
one that ends inside a contraction, and one that ends inside a special string.
``tokens_of_prefix``, ``longest_prefix`` and ``truncated`` answer questions of
length and budget from the counts alone.

Texts are counted where they lie, without a shuffle; a task holds about
``COUNTS_AT_ONCE`` counts and a bounded number of remembered words and pairs.

Defined cases: null and empty texts have the counts [0]; special strings count
as one token when complete; repeated rows are counted each; null ids and other
columns are passed on; a column with the result's name is replaced; an empty
table gives an empty table. Very long texts are counted in segments cut before
white space, where words end too.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_name, kept_in_worker, table

#: Tokens a document of the query may have before it is over the limit.
TOKEN_LIMIT = 1024
COUNTS_AT_ONCE = 1 << 20
SEGMENT_CHARS = 1 << 20
REMEMBERED_WORDS = 300_000
REMEMBERED_PAIRS = 1_000_000


def op12_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable
    ones for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Tokens, their ranked merges, and which tokens may stand side by side."""

    def __init__(self, model: dict) -> None:
        octet = byte_letters()

        def octets(token: str) -> bytes:
            return bytes(map(octet.__getitem__, token))

        self.ids = {octets(t): i for t, i in model["vocab"].items()}
        self.octets = {i: t for t, i in self.ids.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(self.ids[octets(a)], self.ids[octets(b)]): rank for rank, (a, b) in enumerate(pairs)}
        self.neighbours: dict[int, bool] = {}

    def encode(self, word: bytes) -> list[int]:
        """The merges carried out, least rank and leftmost first."""
        parts = [self.ids[word[i : i + 1]] for i in range(len(word))]
        while len(parts) > 1:
            least = min(pairwise(parts), key=lambda pair: self.ranks.get(pair, len(self.ranks)))
            if least not in self.ranks:
                break
            merged, i = [], 0
            token = self.ids[self.octets[least[0]] + self.octets[least[1]]]
            while i < len(parts):
                hit = i + 1 < len(parts) and (parts[i], parts[i + 1]) == least
                merged.append(token if hit else parts[i])
                i += 1 + hit
            parts = merged
        return parts

    def adjoin(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` encode the bytes of both; with -1 as
        ``left``, whether ``right`` encodes its own."""
        key = left + 1 << 32 | right
        known = self.neighbours.get(key)
        if known is None:
            if len(self.neighbours) >= REMEMBERED_PAIRS:
                self.neighbours.clear()
            before = self.octets[left] if left >= 0 else b""
            known = self.encode(before + self.octets[right]) == ([left] if left >= 0 else []) + [right]
            self.neighbours[key] = known
        return known


class WordCounts(dict):
    """Word -> its characters' counts as 32-bit integers, remembered."""

    def __init__(self, merges: Merges) -> None:
        import ahocorasick

        self.merges = merges
        self.endings = ahocorasick.Automaton()
        for token, i in merges.ids.items():
            self.endings.add_word(token.decode("latin-1"), (i, len(token)))
        self.endings.make_automaton()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        counts = self.of_bytes(word.encode())
        if not word.isascii():
            at = np.cumsum([len(c.encode()) for c in word])
            counts = [counts[i] for i in at.tolist()]
        else:
            counts = counts[1:]
        if word in ("'re", "'ve", "'ll"):  # cut short, it is no contraction but a sign and a letter
            counts[1] = 2
        found = self[word] = array("i", counts).tobytes()
        return found

    def of_bytes(self, octets: bytes) -> list[int]:
        """Counts of all prefixes of one word, from the left."""
        adjoin, known = self.merges.adjoin, self.merges.neighbours
        last, counts, done = [-1] * (len(octets) + 1), [0] * (len(octets) + 1), 0
        for end, (token, size) in self.endings.iter(octets.decode("latin-1")):
            if end >= done:  # the tokens that end here are told one after the other; one fits
                left = last[end + 1 - size]
                fits = known.get(left + 1 << 32 | token)
                if fits if fits is not None else adjoin(left, token):
                    done = end + 1
                    last[done], counts[done] = token, counts[done - size] + 1
        return counts


class PrefixCounter:
    """Counts for whole texts."""

    def __init__(self, vocabulary: str) -> None:
        import regex
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        with open(vocabulary, encoding="utf-8") as file:
            told = json.load(file)
        self.special = [t["content"] for t in told["added_tokens"]]
        self.pretokenizer = Tokenizer.from_file(vocabulary).pre_tokenizer
        self.find = regex.compile(PATTERN).findall
        self.special_at = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)").finditer
        self.spaces = regex.compile(r"\s{2,}").finditer
        self.cut = regex.compile(r"(?<=\S)\s").search
        self.words = WordCounts(Merges(told["model"]))
        self.alike, self.unlike = set(map(chr, range(128))), set()

    def split(self, text: str) -> list[str]:
        """The words; by the vocabulary's own library where it has other
        character classes (those of another Unicode version) than the pattern."""
        if not text.isascii():
            for c in set(text).difference(self.alike, self.unlike):
                probe = f"a{c}a1{c}1!{c}! {c}  {c}x'{c}"
                (self.alike if self.find(probe) == self._by_library(probe) else self.unlike).add(c)
            if self.unlike and not self.unlike.isdisjoint(text):
                return self._by_library(text)
        return self.find(text)

    def _by_library(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.pretokenizer.pre_tokenize_str(text)]

    def _segment(self, text: str) -> np.ndarray:
        words = self.split(text)
        counts = np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.int32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        totals = counts[np.cumsum(sizes) - 1]
        counts = counts + np.repeat(np.cumsum(totals) - totals, sizes).astype(np.int32)
        for run in self.spaces(text):  # a prefix that ends with the run has it as one word
            before = counts[run.start() - 1] if run.start() else 0
            counts[run.end() - 1] = before + int.from_bytes(self.words[run[0]][-4:], "little")
        return counts

    def _ordinary(self, text: str) -> np.ndarray:
        """Counts of the prefixes of a text without complete special strings."""
        parts, at, base = [], 0, 0
        while at < len(text):
            hit = self.cut(text, at + SEGMENT_CHARS) if len(text) - at > SEGMENT_CHARS else None
            end = hit.start() if hit else len(text)
            parts.append(self._segment(text[at:end]) + np.int32(base))
            at, base = end, int(parts[-1][-1])
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def counts(self, text: str) -> np.ndarray:
        """The number of tokens of the first 0, 1, 2, ... characters."""
        parts, at, base = [np.zeros(1, np.int32)], 0, 0
        for special in self.special_at(text):
            # Up to its last character but one, the special string is ordinary text.
            found = self._ordinary(text[at : special.end() - 1])
            ahead = special.start() - at
            base, plain = base + (int(found[ahead - 1]) if ahead else 0) + 1, base
            parts += [found + np.int32(plain), np.array([base], np.int32)]
            at = special.end()
        return np.concatenate([*parts, self._ordinary(text[at:]) + np.int32(base)])


def counter_of(vocabulary: str) -> PrefixCounter:
    """The counter of this worker process, kept for its next task."""
    return kept_in_worker("token counter", (vocabulary,), lambda: PrefixCounter(vocabulary))


def _counting(vocabulary: str, text: str, columns: list[str]) -> Callable:
    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(vocabulary)
        for batch in batches:
            begun, held, size = 0, [], 0
            texts, kept = batch.column(text), batch.select(columns)
            for i in range(batch.num_rows):
                held.append(counter.counts(texts[i].as_py() or ""))
                size += len(held[-1])
                if size >= COUNTS_AT_ONCE or i + 1 == batch.num_rows:
                    ends = np.cumsum([0, *map(len, held)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(held)))
                    yield pa.RecordBatch.from_arrays(
                        [*kept.slice(begun, len(held)).columns, lists], names=[*columns, "counts"]
                    )
                    begun, held, size = i + 1, [], 0

    return counting


def prefix_counts(
    docs: DataFrame, vocabulary: str, text: str = "text", counts: str = "token_counts", keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) and the counts of
    every prefix of the text, one more than it has characters."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != counts.lower()]
    places = [f"c{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(keep, places)], F.col(f"`{text}`").alias("text"))
    kinds = [f"{p} {rows.schema[p].dataType.simpleString()}" for p in places]
    out = rows.mapInArrow(_counting(vocabulary, "text", places), ", ".join([*kinds, "counts array<int>"]))
    return out.select(*[F.col(p).alias(c) for c, p in zip(keep, places)], F.col("counts").alias(counts))


def tokens_of_prefix(counts: Column, chars: Column | int) -> Column:
    """Tokens of the first ``chars`` characters; of the whole text if it has fewer."""
    at = F.least(F.lit(chars) if isinstance(chars, int) else chars, F.size(counts) - 1)
    return F.get(counts, F.greatest(at, F.lit(0)))


def longest_prefix(counts: Column, budget: Column | int) -> Column:
    """Characters of the longest prefix that has at most ``budget`` tokens."""
    most = F.lit(budget) if isinstance(budget, int) else budget
    fits = F.filter(F.transform(counts, lambda n, i: F.when(n <= most, i)), lambda i: i.isNotNull())
    return F.array_max(fits)


def truncated(text: Column, counts: Column, budget: Column | int) -> Column:
    """The longest prefix of the text that has at most ``budget`` tokens."""
    return F.substring(text, F.lit(1), F.coalesce(longest_prefix(counts, budget), F.lit(0)))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it is over the limit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    size = fresh_name(docs, "n_bytes")
    docs = docs.withColumn(size, F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counted = prefix_counts(docs, op12_vocabulary(), keep=["doc_id", size])
    n_tokens = F.element_at("token_counts", -1).cast("long")
    return counted.select(
        "doc_id", F.col(size).alias("n_bytes"), n_tokens.alias("n_tokens"), (n_tokens > TOKEN_LIMIT).alias("over_limit")
    )
