"""Periodic runs, prefix token counts and the prefix trie against plain versions."""

import hashlib
import os
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

pytest.importorskip("destrank.llm")
pytest.importorskip("public_tokenizers")

from destrank.llm import periodic_runs, prefix_trie, token_counts  # noqa: E402


def written(df, path, name):
    df.write.parquet(f"{path}/{name}.parquet")
    return path


# periodic runs


def plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(24, 3 * q):
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted((start, q, length) for (start, length), q in found.items())


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for start, q, length in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
    best = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    told = "".join(f"{start},{length},{q}\n" for start, q, length in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return doc_id, len(runs), *best, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def run_texts():
    rng = random.Random(5)

    def some(n, letters):
        return [rng.choice("abcdefgh"[:letters]) for _ in range(n)]

    rows = []
    for i in range(300):
        unit = some(rng.randint(1, 40), 3)
        nested = some(rng.randint(1, 6), 2) * rng.randint(1, 9) + some(rng.randint(1, 4), 2)
        words = [
            some(rng.randint(0, 300), 1 + i % 3),
            some(rng.randint(0, 30), 3) + unit * rng.randint(2, 12) + unit[: rng.randint(0, len(unit))] + some(20, 3),
            nested * rng.randint(1, 9) + some(9, 3),
            [w for _ in range(5) for w in some(rng.randint(1, 9), 8) * rng.randint(1, 20)],
        ][i % 4]
        rows.append((i, " ".join(words)))
    long_period = [str(i) for i in range(700)] * 7 + ["x"]
    return [
        *rows, (1000, " ".join(long_period)), (1001, "é " * 6000), (None, "a\t" * 50), (1002, None), (1003, ""),
        (1004, " \n"), (3, rows[3][1]), (3, rows[3][1]), (3, "a b"),
    ]


@pytest.mark.parametrize("long_chars,broadcast", [(periodic_runs.LONG_CHARS, periodic_runs.BROADCAST_BYTES), (300, 0)])
def test_runs(spark, tmp_out, monkeypatch, long_chars, broadcast):
    rows = run_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = docs.select("doc_id", periodic_runs.planted(F.col("doc_id"), F.col("text")).alias("text"))
    monkeypatch.setattr(periodic_runs, "BROADCAST_BYTES", broadcast)
    out = periodic_runs.collapse(texts, long_chars=long_chars).collect()
    got = sorted(((r.doc_id, [(x.start, x.period, x.length) for x in r.runs], r.text) for r in out), key=str)
    want = []
    for doc_id, text in rows:
        row = plain_row(doc_id, text)
        want.append((doc_id, row[1], row[-1]))
    assert sorted(((d, len(r), hashlib.sha256(t.encode()).hexdigest()) for d, r, t in got), key=str) == sorted(want, key=str)


def test_run_query(spark, tmp_out):
    rows = run_texts()
    path = written(spark.createDataFrame(rows, "doc_id long, text string"), tmp_out, "documents")
    got = periodic_runs.op11_periodic_runs(spark, path).collect()
    assert sorted(map(tuple, got), key=str) == sorted((plain_row(*r) for r in rows), key=str)


def test_run_edges(spark):
    rows = spark.createDataFrame([(1, "a " * 30, 7, "k")], "doc_id long, text string, runs int, _key string")
    out = periodic_runs.collapse(rows)
    assert out.columns == ["doc_id", "_key", "text", "runs"] and out.first().text == "a"
    assert periodic_runs.collapse(rows.limit(0)).count() == 0
    assert [periodic_runs.blocks_of(n) for n in (0, 23, 24, 47, 48, 96)] == [[], [], [8], [8], [8, 16], [8, 16, 32]]
    assert periodic_runs.z_function(list("aabaab")) == [6, 1, 0, 3, 1, 0]


# token counts

BITS = [
    "'re", "'ve", "'ll", "'s", "'", "r", " ", "  ", "\n", " \n", "\t", "Zoë", "ab the", "<|endoftext|>", "<|endof", "|>",
    "12", "!", "漢字", "\U0001f600", "՘", "　", "\x85", "ing", "-----", "́", "\x00",
]


def test_counts_of_every_prefix(monkeypatch):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(token_counts.op12_vocabulary())
    rng = random.Random(3)
    monkeypatch.setattr(token_counts, "SEGMENT_CHARS", 12)
    monkeypatch.setattr(token_counts, "REMEMBERED_WORDS", 50)
    monkeypatch.setattr(token_counts, "REMEMBERED_PAIRS", 50)
    counter = token_counts.PrefixCounter(token_counts.op12_vocabulary())
    for _ in range(400):
        text = "".join(rng.choice(BITS) for _ in range(rng.randint(0, 12)))
        want = [len(plain.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert counter.counts(text).tolist() == want, text


def test_counts_columns(spark, monkeypatch):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(token_counts.op12_vocabulary())
    texts = [None, "", "One two, three's four", "x" * 5000, "the same", "the same", " \n\n  a"]
    docs = spark.createDataFrame([(i or None, t, [i]) for i, t in enumerate(texts)], "doc_id long, text string, c0 array<int>")
    out = token_counts.prefix_counts(docs, token_counts.op12_vocabulary())
    assert out.columns == [*docs.columns, "token_counts"]
    counts = F.col("token_counts")
    got = out.select(
        "text", F.element_at(counts, -1).alias("n"), token_counts.tokens_of_prefix(counts, 5).alias("five"),
        token_counts.tokens_of_prefix(counts, 99).alias("whole"), token_counts.truncated(F.col("text"), counts, 3).alias("cut"),
    ).collect()
    assert len(got) == len(texts)
    for r in got:
        size = [len(plain.encode((r.text or "")[:i], add_special_tokens=False).ids) for i in range(len(r.text or "") + 1)]
        assert r.n == size[-1] and r.five == size[min(5, len(size) - 1)] and r.whole == size[min(99, len(size) - 1)]
        assert r.cut == (r.text and r.text[: max(i for i, n in enumerate(size) if n <= 3)])
    assert token_counts.prefix_counts(docs.limit(0), token_counts.op12_vocabulary()).count() == 0


def test_counts_query(spark):
    from tokenizers import Tokenizer

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    plain = Tokenizer.from_file(token_counts.op12_vocabulary())
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {(r.doc_id, len((r.text or "").encode()), len(plain.encode(r.text or "", add_special_tokens=False).ids)) for r in docs}
    got = token_counts.op12_token_counts(spark, sf).collect()
    assert {(r.doc_id, r.n_bytes, r.n_tokens) for r in got} == want and len(got) == len(docs)
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)


# prefix trie


def plain_trie(rows, rebuild=True):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[conv].append((turn is not None, turn or 0, digest, (role, text)))
    seqs = {c: [t[3] for t in sorted(own)] for c, own in convs.items()}
    if rebuild:
        lead = {c: zlib.crc32(str(c).encode()) % 9 for c in seqs}
        seqs = {c: seqs.get(c - c % 5, [])[: lead[c]] + own[lead[c] :] for c, own in seqs.items()}
    members = defaultdict(list)
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    out = []
    for node, own in members.items():
        below = [v for v in members if v[: len(node)] == node]
        parents = {v[:-1] for v in members if v}
        ends = ",".join(str(c) for c in sorted(own) if len(seqs[c]) == len(node))
        out.append((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own),
            sum(len(v) == len(node) + 1 for v in below), sum(v not in parents for v in below),
            sum((len(members[v]) - 1) * len(v[-1][1].encode()) for v in below if v), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def trie_turns():
    rng, rows = random.Random(2), []
    for c in range(40):
        for t in range(rng.choice([0, 1, 2, 5, 9, 12])):
            role = rng.choice(["user", "assistant", None])
            rows.append((c, t if rng.random() < 0.9 else None, role, rng.choice(["a", "b", "é", None, ""])))
    rows += [(3, 1, "user", "a")] * 3 + [(None, 1, "user", "x")]
    return rows + [(c, i, "u", "z") for c, n in ((100, 50), (101, 50), (102, 47)) for i in range(n)]


@pytest.mark.parametrize("block,part", [(prefix_trie.BLOCK, prefix_trie.PART), (4, 2)])
def test_trie(spark, tmp_out, monkeypatch, block, part):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "PART", part)
    rows = trie_turns()
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    path = written(turns.withColumn("digest", F.lit("x")), tmp_out, "conversations")
    got = prefix_trie.op13_prefix_trie(spark, path).collect()
    assert sorted(map(tuple, got), key=str) == plain_trie(rows)


def test_trie_of_any_conversations(spark):
    rows = trie_turns()
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    nodes, ends = prefix_trie.prefix_trie(prefix_trie.placed(prefix_trie.light_turns(turns)))
    kept = nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((r[:-1] for r in plain_trie(rows, False)), key=str)
    assert ends.agg(F.sum(F.size("ids"))).first()[0] == len({r[0] for r in rows} - {None})
    empty, _ = prefix_trie.prefix_trie(prefix_trie.placed(prefix_trie.light_turns(turns.limit(0))))
    assert empty.count() == 0


def test_tasks_need_no_package(spark):
    """Task code is shipped by value: what it refers to must not be looked up in the package by name."""
    from pyspark import cloudpickle

    from destrank.llm import packing

    shipped = [
        periodic_runs.exploded, periodic_runs.solved, periodic_runs._collapsed, prefix_trie.summaries, prefix_trie.running,
        prefix_trie.prefixes, prefix_trie.end_parts, prefix_trie.joined_digests, token_counts._counting("v", "text", []),
        packing._piece_rows("v", False, 64, "id"),
    ]
    code = "import sys, pickle\nfor b in pickle.load(sys.stdin.buffer): pickle.loads(b)\nassert 'destrank' not in sys.modules"
    import pickle
    import subprocess
    import sys

    told = pickle.dumps([cloudpickle.dumps(f) for f in shipped])
    done = subprocess.run([sys.executable, "-c", code], input=told, capture_output=True, cwd="/")
    assert done.returncode == 0, done.stderr.decode()
