"""Each operator against a plain version, on small tables with the hard cases."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("destrank.llm")
P = pytest.importorskip("public_tokenizers")

from destrank.llm import byte_bpe, kneser_ney, language_mixture, license_digest, packing  # noqa: E402
from destrank.llm import partenum_join, pii_surrogates, pivot_search, repetition, reply_trees  # noqa: E402
from destrank.llm.common import arrow_rows  # noqa: E402
from destrank.llm.components import connected_components  # noqa: E402

LONG = " ".join(f"word{i % 997} of the" for i in range(3000))
TEXTS = [None, "", " \n\t", "one", "One TWO\nthree", "é ß 漢字 \U0001f600", LONG, LONG, "a b c d e f a b c d e f\nline\nline\n"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 0) for i, t in enumerate(TEXTS)] + [(None, "null id", None, None), (3, "one", "x", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, _measures string, sequence_id long")


def empty(docs):
    return docs.filter("false")


def test_repetition_counts(spark, docs):
    def plain(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(hit)

    for text in [*TEXTS, "# * | x", "x y x y x y x y", "q\n\n q\nq"]:
        n, chars, _, dup, words, *_ = repetition.measure(text)
        assert (n, chars, dup, words) == plain(text)
    kept = repetition.quality_rules(docs)
    assert kept.columns == docs.columns and kept.count() == 0
    assert repetition.quality_rules(empty(docs)).count() == 0


def test_repetition_verdict(spark):
    """Repeats that the base rule keeps: a passage or a few lines said again in a text of some length."""
    rng = np.random.default_rng(2)

    def prose(n):
        return " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n))

    passage, lines = prose(120), [prose(9) for _ in range(12)]
    texts = {
        "clean": prose(400),
        "one line again": f"{lines[0]}\n{prose(60)}\n{lines[0]}",
        "short quote": f"{prose(300)}\n{lines[1]}\n{prose(100)}\n{lines[1]}",
        "passage again": f"{passage} {prose(300)} {passage}",
        "lines again": "\n".join([*lines, prose(250), *lines]),
    }
    df = spark.createDataFrame(list(texts.items()), "name string, text string")
    m = F.col("m")
    got = df.select("name", repetition.repetition_measures(F.col("text")).alias("m")).select(
        "name", repetition.base_failed(m).alias("base"), repetition.kept_by_coverage(m).alias("kept"), m["n_symbols"].alias("s"),
        m["dup_line_chars"].alias("lines"),
    )
    rows = {r.name: r for r in got.collect()}
    assert not any(r.base for r in rows.values())
    assert {n for n, r in rows.items() if r.kept} == {"clean", "one line again", "short quote"}
    assert rows["lines again"].lines == sum(len(x.replace(" ", "")) for x in lines) and rows["clean"].lines == 0
    assert {r.name for r in repetition.quality_rules(df).collect()} == {"clean", "one line again", "short quote"}


def test_rolling_coverage_is_exact():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in rng.integers(0, 6, 300)]
    *_, found = repetition.measure(" ".join(words))
    for k, got in zip(repetition.NGRAM_LIMITS, found):
        seen, hit = set(), set()
        for i in range(len(words) - k + 1):
            g = tuple(words[i : i + k])
            hit |= set(range(i, i + k)) if g in seen else set()
            seen.add(g)
        assert got == sum(len(words[i]) for i in hit)


def test_licences(spark):
    mit = license_digest.KNOWN[0][1]
    rows = [(1, "Copyright (c) 2020 Someone\n\n" + mit.upper()), (2, mit.replace("sublicense", "sub-licence")), (3, "x\nReleased under the MIT Licence"), (4, None), (5, "")]
    found = license_digest.scan_licences(spark.createDataFrame(rows, "doc_id long, text string"), license_digest.known_licences(spark))
    got = {(r.doc_id, r.unit): r.license_id for r in found.collect()}
    assert got == {(1, "text"): "MIT", (2, "text"): "MIT", (3, "text"): None, (3, "line"): "MIT", (4, "text"): None, (5, "text"): None}


def test_packing(spark, docs):
    vocabulary = P.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary)
    out = packing.pack(docs, vocabulary, capacity=64).toPandas()
    for r in out.itertuples():
        text = None if np.isnan(r.doc_id) else TEXTS[int(r.doc_id)]
        text = "null id" if np.isnan(r.doc_id) else text
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        part = ids[r.start : r.start + r.length]
        assert r.start == 64 * r.piece and len(part) == min(64, len(ids) - r.start) and zlib.crc32(part.tobytes()) == r.ids_crc32
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert list(s.offset) == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= 64
    assert packing.pack(empty(docs), vocabulary).count() == 0


def test_packing_gives_the_sequences(spark, docs):
    vocabulary = P.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary)
    out = packing.pack(docs, vocabulary, capacity=64)
    texts = {r.doc_id: r.text for r in docs.collect()}
    laid = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.sequences(out).collect()}
    rows = out.collect()
    assert set(laid) == {r.sequence_id for r in rows} and sum(map(len, laid.values())) == sum(r.length for r in rows)
    for r in rows:
        want = [*plain.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0][r.start : r.start + r.length]
        assert np.frombuffer(r.ids, "<u4").tolist() == want == laid[r.sequence_id][r.offset : r.offset + r.length].tolist()


@pytest.mark.parametrize("as_text", [False, True])
def test_special_strings_and_segments(monkeypatch, as_text):
    vocabulary = P.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary)
    plain.encode_special_tokens = as_text
    monkeypatch.setattr(packing, "SEGMENT_BYTES", 40)
    texts = ["a<|endoftext|>b", " é,.<|endoftext|>", "<|startoftext|> x <|ENDOFTEXT|>", "<|endoftext", "y" * 500, LONG[:5000], "\x00 z\x00", "", "one\ntwo " * 30]
    encoder = packing.WordEncoder(vocabulary, as_text)
    for _ in range(2):  # new words, then known ones
        for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_plain_words_share_the_ids_of_their_pieces():
    vocabulary = P.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    plain, encoder = Tokenizer.from_file(vocabulary), packing.WordEncoder(vocabulary)
    rng = np.random.default_rng(5)
    letters = list("aAbBsStTrReEvVmMlLdD'''019<|>/w,.-~!ÀßéÉÖ×÷ªºµÿ\u0301’\x85\x1c\x00İſKŸ中 \t\n")
    texts = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(3000)]
    texts += ["Straße straße, STRASSE. straße! straße-Straße", "it's IT'S we'll'd 2nd </w> a</w>"]
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text
    again = packing.WordEncoder(vocabulary)
    again.encode(["Straße straße, STRASSE. straße! straße-Straße".encode()])
    assert set(again.pieces) == {"straße", "strasse", ",", ".", "!", "-"}


def test_texts_come_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], names=["n"])

    rows = spark.range(0, 2500, 1, 1).mapInArrow(sizes, "n long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with arrow_rows(spark, 1000):
        assert [r.n for r in rows.collect()] == [1000, 1000, 500]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_packing_beside_columns_of_its_names(spark):
    rows = spark.createDataFrame([(7, "<|endoftext|>", 1, 2), (7, None, 1, 2), (None, "x", 1, 2)], "piece long, text string, length int, task int")
    out = packing.pack(rows.withColumnRenamed("piece", "doc"), P.path("word_bpe_49k.json"), id_col="doc")
    assert {(r.doc, r.length) for r in out.collect()} == {(7, 2), (7, 1), (None, 2)}


def test_best_fit_plan_matches_item_by_item():
    rng = np.random.default_rng(0)
    for _ in range(50):
        counts = Counter(rng.integers(1, 33, 200).tolist())
        bins: list[int] = []
        for n in sorted(counts.elements(), reverse=True):
            fit = [i for i, free in enumerate(bins) if free >= n]
            i = min(fit, key=lambda i: bins[i], default=None)
            if i is None:
                bins.append(32 - n)
            else:
                bins[i] -= n
        used = {s + k for _, a, b, s, _ in packing.plan_best_fit(dict(counts), 32) for k in range(b - a)}
        assert len(used) == len(bins)


def test_byte_bpe_both_ways(spark, docs):
    import tiktoken

    ranks = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    more = spark.createDataFrame([(100, "x" * 70 + "ab" * 40 + "  \n  end ")], "doc_id long, text string")
    table = docs.select("doc_id", "text").unionByName(more)
    for words, places in ((byte_bpe.BLOCK_WORDS, byte_bpe.PLACES), (300, 2)):
        got = byte_bpe.encode_documents(table, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, block_words=words, places=places).collect()
        texts = {r.doc_id: r.text or "" for r in table.collect()}
        assert len(got) == table.count()
        for r in got:
            ids = np.array(plain.encode_ordinary(texts[r.doc_id]), "<u4")
            assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    word = "theanin" * 40
    assert byte_bpe.heap_merges(word.encode(), ranks) == plain.encode_ordinary(word)


def test_byte_bpe_of_nothing_nulls_and_repeats(spark, docs):
    vocabulary = P.path("byte_bpe_50k.tiktoken")
    schema = "block string, ids int, doc_id long, text string"
    assert byte_bpe.encode_documents(empty(docs), vocabulary, P.PATTERN).count() == 0
    rows = [("x", 1, None, "a b"), ("x", 1, None, "a b"), (None, None, 2, None), (None, None, 3, "")]
    got = byte_bpe.encode(spark.createDataFrame(rows, schema), vocabulary, P.PATTERN).collect()
    assert sorted((r.doc_id or 0, len(r.ids)) for r in got) == [(0, 8), (0, 8), (2, 0), (3, 0)]


def test_byte_bpe_blocks_are_assembled_in_little_memory(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    monkeypatch.setattr(byte_bpe, "ASSEMBLED_WORDS", 50_000)
    n, sizes = 1000, [0, 49_999, 0, 1, 0, 700_000, 1_250_000, 0]
    numbers = np.arange(sum(sizes)) % n
    columns = {"block": [7], "ids": [list(range(len(sizes)))], "sizes": [sizes], "numbers": [byte_bpe._packed(numbers, n)], "n_words": [n], "at": [[]], "heaped": [[]]}
    schema = byte_bpe._block_schema(pa.int64())
    block = pa.table([pa.array(v, schema.field(c).type) for c, v in columns.items()], names=list(columns))
    lengths = np.arange(n) % 2 + 1
    packed = [np.arange(n), lengths, np.repeat(np.arange(n), lengths)]
    packed = pa.table({c: [v.astype("<u4").tobytes()] for c, v in zip(("at", "sizes", "ids"), packed)})
    tracemalloc.start()
    got = byte_bpe._assembled("doc_id")(packed, block)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    ends = np.cumsum(sizes)
    want = [np.repeat(numbers[e - s : e], lengths[numbers[e - s : e]]).astype("<u4").tobytes() for e, s in zip(ends, sizes)]
    assert got.column("ids").to_pylist() == want
    assert peak < 20 * len(numbers)  # 12 of them: the numbers and ids


def test_byte_bpe_gives_ids_and_decodes_them(spark, docs):
    import tiktoken

    vocabulary = P.path("byte_bpe_50k.tiktoken")
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(vocabulary), special_tokens={})
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for words, places in ((byte_bpe.BLOCK_WORDS, byte_bpe.PLACES), (300, 2)):
        got = byte_bpe.encode(docs, vocabulary, P.PATTERN, block_words=words, places=places)
        rows = got.withColumn("decoded", byte_bpe.decode(spark, F.col("ids"), vocabulary)).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert np.frombuffer(r.ids, "<u4").tolist() == plain.encode_ordinary(texts[r.doc_id])
            assert r.decoded.decode() == texts[r.doc_id]


def brute_components(rows):
    hashes = partenum_join.WordHashes()
    sets = {d: set(partenum_join.shingle_set((t or "").encode(), hashes).tolist()) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize("group", [32, 3])
def test_jaccard_components(spark, group):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(2000)]

    def some(n):
        return [words[i] for i in rng.integers(0, 2000, n)]

    base, passage, texts = some(80), some(60), list(TEXTS)
    for changes in (0, 1, 1, 2, 2, 3, 4, 5):
        x = list(base)
        for i in rng.integers(0, 80, changes):
            x[i] = "changed"
        texts.append(" ".join(x))
    texts += [" ".join(some(k) + passage) for k in (5, 20, 60)] + ["a b c d e f g h", "a b c d e f g h i"]
    rows = list(enumerate(texts))
    got = partenum_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), group=group)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(rows)


def test_few_pairs_of_copies_and_of_texts_with_a_common_passage(spark, monkeypatch):
    rng, compared = np.random.default_rng(8), []
    base, passage = ([f"{kind}{i}" for i in range(n)] for kind, n in (("b", 200), ("p", 25)))
    texts = []
    for i in range(60):
        copy = list(base)
        for k in rng.integers(0, 200, 1):
            copy[k] = f"c{i}"
        texts += [" ".join(copy), " ".join([f"t{i}x{k}" for k in range(65)] + passage)]
    plain = partenum_join.verified

    def counted(pairs, sets, sizes):
        compared.append(pairs.count())
        return plain(pairs, sets, sizes)

    monkeypatch.setattr(partenum_join, "verified", counted)
    rows = list(enumerate(texts))
    got = partenum_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), group=3)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(rows)
    assert sum(compared) <= len(texts), compared


def test_signatures_lose_no_link():
    rng, ends = np.random.default_rng(0), partenum_join.bands()
    for _ in range(1500):
        size = int(rng.integers(3, 12) if rng.random() < 0.5 else rng.integers(3, 300))
        a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        drop = int(rng.integers(0, size // 4 + 1))
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, int(rng.integers(0, size // 4 + 1)), dtype=np.uint64)]))
        if len(b) and not np.array_equal(a, b) and partenum_join.linked_sets(a.tobytes(), b.tobytes()):
            x, y = ({s for _, f, _ in partenum_join.signatures(v, ends) for s in f.tolist()} for v in (a, b))
            assert x & y


def test_one_of_each_group(spark, docs):
    kept = partenum_join.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, i) for i in (0, 1, 2, 3, 4, 5, 6, 8)] + [(True, None)]
    assert partenum_join.one_of_each_group(empty(docs)).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (5, 5), (10, 4), (None, 3)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {1: 1, 2: 1, 3: 1, 4: 1, 10: 1, 8: 8, 9: 8}


def test_surrogates(spark):
    rows = [
        (1, "Mail a.b1@mail.example.com now, Mr. John Smith; Mrs. Smith and card 4785 3805 9239 1139, +1 (743) 555-3824."),
        (2, "card 4785380592391139 and A.B1@mail.example.com ip 227.5.221.1"), (3, None), (4, ""),
        (5, "no 4785380592391138 entity 1.2.3.4.5"), (6, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" Госпожа Анна Иванова'),
    ]
    table = spark.createDataFrame(rows + rows[:1], "doc_id long, text string").withColumn("_key", F.lit(1))
    out = pii_surrogates.with_surrogates(table, "n")
    got = {r.doc_id: r.text for r in out.collect()}
    assert out.count() == 7 and out.columns == [*table.columns, "n"]
    assert [got[i] for i in (3, 4, 5)] == [None, "", rows[4][1]]
    for real in ("a.b1@", "John", "Smith", "4785", "743", "555-3824", "227.5.221.1", "24be64", "Анна", "Иванова"):
        assert not any(real in (t or "") for i, t in got.items() if i != 5)
    first = re.search(r"Mr\. (\S+) (\S+); Mrs\. (\S+) and card ([\d ]{19}),", got[1])
    assert first[2] == first[3] and first[4].replace(" ", "") in got[2]
    digits = [int(d) for d in reversed(first[4].replace(" ", ""))]
    assert sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0
    assert re.search(r"Госпожа [а-яА-Я]+а [а-яА-Я]+ов$", got[6])
    assert pii_surrogates.with_surrogates(empty(table), "n").count() == 0


def test_cards_and_phones_beside_other_numbers(spark):
    card = "4785380592391139"
    texts = [f"{card} 12/27", f"{card} 123", f"order 12 {card}", "2024 4785 3805 9239 1139", f"{card} {card}",
             f"{card} 12.a@mail.example.com", f"{card} 227.5.221.1", f"555-123-4567 {card}", f"{card} 123-45-6789",
             f"password: {card}", f"+1 555-123-4567 {card}"]
    texts += ["555-123-4567 555-987-6543", "4785380592391138", "47853805923911391234567"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n) for r in pii_surrogates.with_surrogates(table, "n").collect()}
    for i, text in enumerate(texts[:-2]):
        assert not re.search("4785 ?3805 ?9239 ?1139|555-123|555-987|mail|227.5|123-45", got[i][0]), (text, got[i])
    assert [got[i][1] for i in range(len(texts))] == [1, 1, 1, 1, 2, 2, 2, 2, 2, 1, 2, 2, 0, 0]
    assert got[0][0].endswith(" 12/27") and got[1][0].endswith(" 123") and got[2][0].startswith("order 12 ")
    assert [got[i][0] for i in (12, 13)] == texts[-2:]


def test_more_phones_addresses_and_untitled_names(spark):
    phones = ["+15551234567", "+44 2071234567", "+49 30 1234567", "(555)123-4567", "+33 1 42 68 53 00", "+44 (0)20 7123 4567", "+1 (555) 123-4567"]
    ips = ["2001:db8:85a3:0:0:8a2e:370:7334", "fe80::1ff:fe23:4567:890a", "::1"]
    texts = [f"call {x} now" for x in phones + ips]
    texts += ["at 12:30:45 std::vector a::b 3:2", "Mr. John Smith came. Smith left, John Smith stayed; Smithson and John not.", "Smith and John Smith"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n) for r in pii_surrogates.with_surrogates(table, "n").collect()}
    for i, x in enumerate(phones):
        assert got[i][1] == 1 and x not in got[i][0] and re.sub("[0-9]", "0", got[i][0]) == re.sub("[0-9]", "0", texts[i]), got[i]
    digits = [re.sub("[^0-9]", "", got[i][0]) for i in (0, 6)]
    assert digits[0] == digits[1]  # one number in two forms
    for i, x in enumerate(ips, len(phones)):
        assert got[i][1] == 1 and x not in got[i][0] and re.fullmatch("call 2001:db8(:[0-9a-f]{4}){6} now", got[i][0]), got[i]
    assert got[len(phones + ips)] == (texts[-3], 0) and got[len(texts) - 1] == (texts[-1], 0)
    text, n = got[len(texts) - 2]
    found = re.fullmatch(r"Mr\. (\w+) (\w+) came\. (\w+) left, (\w+) (\w+) stayed; Smithson and John not\.", text)
    assert found and n == 5 and found[1] == found[4] != "John" and found[2] == found[3] == found[5] != "Smith"


def test_top_k(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(i, vectors[0].tolist()) for i in range(300, 340)]
    rows += [(400, None), (401, [1.0] * 7 + [float("nan")]), (402, [None] * 8), (450, [0.5, 0.5]), (None, [1.0] * 8), (0, rows[0][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = pivot_search.top_k(table.select("vec_id", pivot_search.scaled(F.col("embedding")).alias("v")), F.col("vec_id") % 50 == 0)
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    ints = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows[:340]}
    for q in range(0, 340, 50):
        best = sorted((-int(ints[q] @ x), i) for i, x in ints.items() if i != q)[:5]
        assert found.pop(q) == {k + 1: (i, -s) for k, (s, i) in enumerate(best)}
    assert not found


def test_reply_trees(spark):
    schema = "conv_id long, msg_id long, parent_id long, score double, role string, text string"
    rows = [(1, 1, None, 0.5, "user", "a"), (1, 2, 1, 0.1, "assistant", "b<#\\l"), (1, 3, 1, 0.9, "assistant", "c"),
            (1, 4, 3, 0.1, "us:er", None), (2, 9, 8, None, None, "x"), (3, 1, 2, 0.0, "u", "c"), (3, 2, 1, 0.0, "u", "c")]
    messages = spark.createDataFrame(rows, schema)
    out = reply_trees.format_paths(reply_trees.root_to_leaf_paths(messages))
    read = out.select("conv_id", "branch_rank", reply_trees.parse_turns(F.col("formatted")).alias("t"),
                      reply_trees.masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    got = {(r.conv_id, r.branch_rank): ([tuple(t) for t in r.t], r.loss) for r in read.collect()}
    assert got == {
        (1, 1): ([("user", "a"), ("assistant", "c"), ("us:er", "")], "c"),
        (1, 2): ([("user", "a"), ("assistant", "b<#\\l")], "b<#\\l"), (2, 1): ([("", "x")], ""),
    }
    assert reply_trees.root_to_leaf_paths(messages, branches=1).select("leaf").distinct().count() == 2
    assert reply_trees.root_to_leaf_paths(empty(messages)).count() == 0


def test_language_mixture(spark):
    english, german = "the thing of and then other ", "der die und ein nicht schreiben "
    rows = [(english * 20, "en"), (german * 20, "de"), (None, "en"), ("x", None)]
    langs, model = language_mixture.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert langs == ["de", "en"]
    letters = language_mixture.letter_table()
    assert set(language_mixture.infer(english * 3, model, letters)) == {1}
    mixed = language_mixture.infer(english * 60 + german * 20, model, letters)
    assert set(mixed) == {0, 1} and mixed[1] > mixed[0]
    assert language_mixture.infer("12 ...", model, letters) == {} == language_mixture.infer(None, model, letters)
    none, nothing = language_mixture.fit(spark.createDataFrame([], "text string, lang string"))
    assert none == [] and language_mixture.infer("text", nothing, letters) == {}


def test_kneser_ney_sums_to_one_and_shards_agree(spark):
    rows = [(i, t, "x", True) for i, t in enumerate(["abab abba", "abba baba ab", "baab", ""])]
    rows += [(9, "zzzz", "x", False), (10, None, "x", False), (11, "abab", None, False), (12, "12 ab", "x", False)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, t boolean")
    one = {r.doc_id: r.s for r in kneser_ney.with_perplexity(table, "t", "s").collect()}
    many = {r.doc_id: r.s for r in kneser_ney.with_perplexity(table, "t", "s", shard_rows=7).collect()}
    assert one.keys() == many.keys()
    for k in one:
        assert (one[k] is None) == (many[k] is None)
        assert one[k] is None or (one[k].symbols == many[k].symbols and abs(one[k].nll - many[k].nll) < 1e-5)
    assert one[10] is None and one[11] is None and one[9].nll > one[0].nll
    # Over all symbols after one history, seen or not, the probabilities sum to at most one, and nearly to one for seen ones.
    symbols = [ord("a"), ord("b"), kneser_ney.SPACE, kneser_ney.END]
    history = 0
    for s in (0, 0, ord("a"), ord("b")):
        history = history << kneser_ney.SYMBOL_BITS | s
    codes = [(history << kneser_ney.SYMBOL_BITS) | s for s in symbols]
    seen = Counter(g for r in rows[:4] for g in kneser_ney.grams(r[1]).tolist())
    totals = [("x", g, seen.get(g, 0)) for g in set(seen) | set(codes)]
    found = kneser_ney.corpus_log_probabilities(spark.createDataFrame(totals, "lang string, g long, c long"))
    p = [np.exp(r.logp) for r in found.collect() if r.g in codes]
    assert len(p) == 4 and 0.8 < sum(p) <= 1 + 1e-9


def test_quality_filter_keeps_columns(spark, docs):
    labels = spark.createDataFrame([(6, 1, 0), (6, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    table = docs.withColumn("lang", F.lit("x"))
    out = kneser_ney.quality_filter(table, labels)
    assert out.columns == table.columns and {6, 7} <= {r.doc_id for r in out.collect()}
    assert kneser_ney.quality_filter(empty(table), labels).count() == 0
