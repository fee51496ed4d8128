"""N-gram Jaccard join with PartEnum signatures.

Sets of distinct five-word shingles a and b link when their Jaccard
similarity is at least 3/4; then they differ in at most (|a| + |b|) / 7
shingles. Size sums are cut into bands; for a band that allows K differences
the shingle domain is split into n > K parts, so at least n - K parts of two
linked sets are equal, and each equal, non-empty part gives both one shared
signature. A set emits the signatures of the one or two bands that its
partners' sizes can reach.

A set whose empty parts could be all the equal ones ("short of parts", rare)
also emits one signature common to all such sets of the band: two linked sets
without a shared non-empty part are both short of parts, so none is lost.

1. Tasks compute the sets' digests (a class is a set; copies share it) and
   packed signatures, which Spark shuffles by signature bucket.
2. A link ensures not one but several shared signatures; classes that share
   fewer with others, all together, drop out. In a group of equal signatures
   one class is the hub, the one that shares most (in a family of copies, the
   original). Each class is compared first with the hub that it meets most
   often; components of the links follow, on whole sets as everywhere.
3. What remains are pairs of different components in a group that was not
   linked through. A class that n such groups and a bound of s shared ones are
   left with keeps the n - s + 1 smallest: with those, two linked classes still
   meet in one, their first in the order of all groups. Hubs come first again;
   then groups of up to ``GROUP`` classes give their pairs. Larger ones are
   matched in rounds: a few members from outside the group's largest
   component with all members of other components, until each such member had
   its turn or the group is one component. So no group is expanded into all its
   pairs, and no link between components is lost.

A class is told by a 64-bit digest of its shingle set, a shingle by a 64-bit
hash: N classes coincide with probability N * N / 2**65.

Defined cases: texts without words and null texts have an empty set and are
their own component; fewer than five words are one shingle; repeated rows and
equal texts share a class; null ids are carried and never the least; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_rows, fresh_name, give_back, saved, table
from .components import connected_components

WORDS = 5
#: Links: 100 * intersection >= 75 * union, so 7 * difference <= size sum.
NUMERATOR, DENOMINATOR, DIFFERENCE = 75, 100, 7
FIRST_SUM, BAND_RATIO = 6, 1.6
SPARE_SHARE, SPARE_PARTS = 0.15, 6
GROUP = 32
#: Members of a large open group that are matched in the first round; later rounds double it.
CENTRES = 4
BUCKET_SIGNATURES = 1_500_000
LEAST_BUCKETS = 64
#: Texts whose signatures are made and packed together.
TEXTS_AT_ONCE = 4000
HASHED_WORDS = 400_000
#: Class digests of at most so many classes are broadcast to pick their sets.
PICKED_CLASSES = 8_000_000

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= HASHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a UTF-8 text."""
    words = (text or b"").lower().split()  # ASCII letters and white space only
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    k = min(n, WORDS)
    out = np.full(n - k + 1, np.uint64(k))
    for i in range(k):
        out = out * _M1 + w[i : n - k + 1 + i]
    return np.unique(mixed(out))


def class_of(shingles: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def bands() -> list[int]:
    """Ascending size sums that end the bands, for any set size."""
    out = [FIRST_SUM]
    while out[-1] < 1 << 40:
        out.append(int(out[-1] * BAND_RATIO) + 1)
    return out


def signatures(shingles: np.ndarray, ends: list[int]) -> list[tuple[int, np.ndarray, int]]:
    """Per band that a partner's size can reach: (band, signatures, spare),
    spare being the number of shared non-empty parts that a link ensures."""
    s = len(shingles)
    low, high = s + -(-s * NUMERATOR // DENOMINATOR), s + s * DENOMINATOR // NUMERATOR
    out = []
    for band in range(np.searchsorted(ends, low), np.searchsorted(ends, high) + 1):
        allowed = ends[band] // DIFFERENCE
        if not allowed:  # equal sets only, which are one class
            continue
        parts = allowed + 1 + int(allowed * SPARE_SHARE) + SPARE_PARTS
        keyed = mixed(shingles + np.uint64(band * int(_M1) % (1 << 64)))
        part = ((keyed >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        order = np.argsort(part, kind="stable")
        part = part[order]
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        sums = np.add.reduceat(mixed(keyed[order] ^ _M3), first)
        tag = part[first] * _M2 + np.uint64(band + 1)
        found = mixed(sums + mixed(tag))
        spare = len(first) - min(allowed, high // DIFFERENCE)
        if spare <= 0:
            found = np.append(found, mixed(np.array([band + 1], np.uint64) * _M3))
        out.append((band, found, spare))
    return out


def _binary_texts(batch: pa.RecordBatch, column: int) -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def _class_rows(id_name: str) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, hashes) for t in _binary_texts(batch, 1)]
            columns = [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_of(s) for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_name, "n_shingles", "cls"])
        del hashes
        give_back()

    return rows


PACKED = "bucket int, classes binary, bands binary, spares binary, counts binary, signatures binary"


def _signature_rows(buckets: int) -> Callable:
    """Packed rows of a batch's texts: a bucket's (class, band) entries, and
    the signatures of each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ends = WordHashes(), bands()
        for batch in batches:
            told: set[int] = set()
            entries, found = [], []
            for text in _binary_texts(batch, 0):
                shingles = shingle_set(text, hashes)
                cls = class_of(shingles)
                if len(shingles) and cls not in told:
                    told.add(cls)
                    for band, sigs, spare in signatures(shingles, ends):
                        entries.append((cls, band, spare))
                        found.append(sigs)
            if not found:
                continue
            classes, band, spare = (np.array(c) for c in zip(*entries))
            entry, sig = np.repeat(np.arange(len(found)), list(map(len, found))), np.concatenate(found)
            bucket = ((sig >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            order = np.argsort(bucket, kind="stable")  # an entry's signatures stay together
            entry, sig, bucket = entry[order], sig[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
            out = []
            for k in range(buckets):
                e, s = entry[cuts[k] : cuts[k + 1]], sig[cuts[k] : cuts[k + 1]]
                if len(e):
                    at = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]]))
                    counts, e = np.diff(np.append(at, len(e))), e[at]
                    columns = (classes[e].astype(np.int64), band[e].astype(np.uint8), spare[e].astype(np.int32), counts.astype(np.uint32), s)
                    out.append((k, *[c.tobytes() for c in columns]))
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in PACKED.split(", ")]).astype({"bucket": "int32"})
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)
        del hashes
        give_back()

    return rows


def _shared_members(pdf: pd.DataFrame) -> pd.DataFrame:
    """(sig, cls, band, spare) of the signatures that several classes have."""
    kinds = {"classes": np.int64, "bands": np.uint8, "spares": np.int32, "counts": np.uint32, "signatures": np.uint64}
    cls, band, spare, counts, sig = (np.frombuffer(b"".join(pdf[c]), k) for c, k in kinds.items())
    entry = np.repeat(np.arange(len(cls)), counts)
    order = np.argsort(sig, kind="stable")
    entry, sig = entry[order], sig[order]
    edge = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1], [True]]))
    entry, sig = (x[np.repeat(np.diff(edge) > 1, np.diff(edge))] for x in (entry, sig))
    members = pd.DataFrame({"sig": sig.view(np.int64), "cls": cls[entry], "band": band[entry].astype(np.int32), "spare": spare[entry]})
    members = members.drop_duplicates(["sig", "cls"])  # copies in several batches
    return members[members.duplicated("sig", keep=False)]


def _pruned(members: DataFrame) -> DataFrame:
    """``members`` without the classes that share fewer signatures in a band
    than a link there ensures, and without signatures left with one class;
    with the group's size and the class's weight, the sum of its groups' sizes."""
    enough = members.groupBy("cls", "band").agg(F.count(F.lit(1)).alias("n"), F.min("spare").alias("least"))
    enough = enough.filter(F.col("n") >= F.col("least")).select("cls", "band")
    members = members.join(enough, ["cls", "band"], "left_semi")
    several = members.groupBy("sig").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = saved(members.join(several, "sig"), "members")
    weights = members.groupBy("cls").agg(F.sum("size").alias("weight"))
    return members.join(weights, "cls")


def _picked_sets(wanted) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, told = WordHashes(), set()
        classes = wanted.value if wanted is not None else None
        for batch in batches:
            out = []
            for text in _binary_texts(batch, 0):
                shingles = shingle_set(text, hashes)
                cls = class_of(shingles)
                at = 0 if classes is None else min(np.searchsorted(classes, cls), len(classes) - 1)
                if len(shingles) and (classes is None or (len(classes) and classes[at] == cls)) and cls not in told:
                    told.add(cls)
                    out.append((cls, shingles.tobytes()))
            columns = [pa.array([c for c, _ in out], pa.int64()), pa.array([s for _, s in out], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["cls", "shingles"])
        del hashes, told
        give_back()

    return rows


def linked_sets(a: bytes, b: bytes) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if DENOMINATOR * min(len(x), len(y)) < NUMERATOR * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return DENOMINATOR * common >= NUMERATOR * (len(both) - common)


def _linked(a: str, b: str) -> Column:
    @F.pandas_udf("boolean")
    def linked(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            yield pd.Series([linked_sets(x, y) for x, y in zip(left, right)], dtype=bool)

    return linked(a, b)


def verified(pairs: DataFrame, sets: DataFrame, sizes: DataFrame) -> DataFrame:
    """(a, b, linked) of the pairs, compared on their whole sets; sizes that
    cannot reach the similarity need no comparison."""
    for side in ("a", "b"):
        pairs = pairs.join(sizes.select(F.col("cls").alias(side), F.col("n_shingles").alias(f"n_{side}")), side)
    near = F.least("n_a", "n_b") * DENOMINATOR >= F.greatest("n_a", "n_b") * NUMERATOR
    compared = pairs.filter(near).select("a", "b")
    for side in ("a", "b"):
        compared = compared.join(sets.select(F.col("cls").alias(side), F.col("shingles").alias(f"set_{side}")), side)
    compared = compared.select("a", "b", _linked("set_a", "set_b").alias("linked"))
    return compared.unionByName(pairs.filter(~near).select("a", "b", F.lit(False).alias("linked")))


def _picked(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, shingles) of the given (cls, least id) classes, one row each; only
    texts with such an id, or without one, are read again."""
    spark = texts.sparkSession
    if classes.count() <= PICKED_CLASSES:
        wanted = classes.select("cls").toArrow().to_pandas()["cls"].to_numpy(np.int64)
        ids = classes.select(F.col("least").alias("id")).distinct()
        some = texts.join(F.broadcast(ids), "id", "left_semi").select("text").unionByName(texts.filter("id IS NULL").select("text"))
        found = some.mapInArrow(_picked_sets(spark.sparkContext.broadcast(np.sort(wanted))), "cls long, shingles binary")
        return found.dropDuplicates(["cls"])
    found = texts.select("text").mapInArrow(_picked_sets(None), "cls long, shingles binary")
    return found.join(classes, "cls", "left_semi").dropDuplicates(["cls"])


def class_components(texts: DataFrame, sizes: DataFrame, group: int = GROUP) -> DataFrame:
    """(node, root) of the classes that have a link; ``texts`` (id, text),
    ``sizes`` (cls, n_shingles, least id) of all classes with words."""
    total = sizes.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).head()[0]
    buckets = max(LEAST_BUCKETS, total // BUCKET_SIGNATURES + 1)
    packed = texts.select("text").mapInArrow(_signature_rows(buckets), PACKED)
    members = packed.groupBy("bucket").applyInPandas(_shared_members, "sig long, cls long, band int, spare int")
    with arrow_rows(texts.sparkSession, TEXTS_AT_ONCE):
        members = saved(members, "shared")
    members = saved(_pruned(members), "weighted")
    sets = saved(_picked(texts, sizes.join(members.select("cls").distinct(), "cls")), "sets")
    stars = _stars(members).groupBy("cls", "hub").agg(F.count(F.lit(1)).alias("n"))
    nearest = stars.groupBy("cls").agg(F.max(F.struct("n", "hub"))["hub"].alias("hub"))
    done = saved(verified(_ordered(nearest, "cls", "hub"), sets, sizes), "verified")
    roots = saved(connected_components(done.filter("linked").select("a", "b")), "roots")
    open_members = saved(_fewest(_open(members, roots)), "open")
    stars = _ordered(_stars(open_members).filter("root <> hub_root"), "cls", "hub")
    more = saved(verified(stars.join(done.select("a", "b"), ["a", "b"], "left_anti"), sets, sizes), "verified")
    done, roots = done.unionByName(more), _joined(roots, more)
    open_members = saved(_open(open_members, roots), "open")
    pairs = _small_group_pairs(open_members.filter(F.col("size") <= group))
    large = open_members.filter(F.col("size") > group).select("sig", "cls")
    large = large if large.head(1) else None
    past, centres = None, CENTRES
    while True:
        fresh = pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")
        more = saved(verified(fresh, sets, sizes), "verified")
        roots = _joined(roots, more)
        if large is None:
            return roots
        done = saved(done.unionByName(more), "verified")
        now, pairs = _round_pairs(large, roots, past, centres)
        if not now.head(1):
            return roots
        past = now if past is None else saved(past.unionByName(now), "centres")
        centres *= 2


def _stars(members: DataFrame) -> DataFrame:
    """The members of groups beside their group's hub, the class of the largest weight."""
    others = [c for c in ("root",) if c in members.columns]
    hubs = members.groupBy("sig").agg(F.max(F.struct("weight", "cls", *others)).alias("h"))
    hubs = hubs.select("sig", F.col("h.cls").alias("hub"), *[F.col(f"h.{c}").alias(f"hub_{c}") for c in others])
    return members.join(hubs, "sig").filter("cls <> hub")


def _ordered(pairs: DataFrame, left: str, right: str) -> DataFrame:
    return pairs.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b")).distinct()


def _joined(roots: DataFrame, more: DataFrame) -> DataFrame:
    """The components with further links. Earlier links are kept as their
    components: as good, and no longer than the classes."""
    new = more.filter("linked").select("a", "b")
    if not new.head(1):
        return roots
    known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return saved(connected_components(known.unionByName(new)), "roots")


def _fewest(members: DataFrame) -> DataFrame:
    """The members of open groups that can still find every link. Two linked
    classes of different components share only open groups, at least ``spare``
    in a band. So a class with n open groups there needs the n - spare + 1 that
    come first in an order of all groups: the first one that both share is
    among them for both. Smallest groups come first. ``size`` is of what is left."""
    own = Window.partitionBy("cls", "band")
    needed = F.count(F.lit(1)).over(own) - F.greatest(F.min("spare").over(own), F.lit(1)) + 1
    members = members.withColumn("_needed", needed).withColumn("_place", F.row_number().over(own.orderBy("size", "sig")))
    members = saved(members.filter("_place <= _needed").drop("_needed", "_place", "size"), "fewest")
    left = members.groupBy("sig").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    return members.join(left.filter("lo <> hi").select("sig", "size"), "sig")


def _with_roots(members: DataFrame, roots: DataFrame) -> DataFrame:
    known = members.drop("root").join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left")
    return known.withColumn("root", F.coalesce("root", F.col("cls")))


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The members, with their roots, of groups that hold several components."""
    known = _with_roots(members, roots)
    several = known.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("sig")
    return known.join(several, "sig", "left_semi")


def _small_group_pairs(members: DataFrame) -> DataFrame:
    """Pairs of classes of different components in groups of a bounded size."""
    left = members.select("sig", F.col("cls").alias("a"), F.col("root").alias("root_a"))
    right = members.select("sig", F.col("cls").alias("b"), F.col("root").alias("root_b"))
    return left.join(right, "sig").filter("a < b AND root_a <> root_b").select("a", "b").distinct()


def _round_pairs(members: DataFrame, roots: DataFrame, past: DataFrame | None, centres: int) -> tuple[DataFrame, DataFrame]:
    """The next centres (sig, cls) of each large group that still has several
    components, at most ``centres`` a group and none from the group's largest
    component, and their pairs with the members of other components. When all
    members outside the largest component were centres, the group is done."""
    known = saved(_with_roots(members, roots), "members")
    parts = known.groupBy("sig", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = parts.groupBy("sig").agg(F.max(F.struct("n", "root"))["root"].alias("main"))
    outside = known.join(largest, "sig").filter("root <> main").drop("main")
    if past is not None:
        outside = outside.join(past, ["sig", "cls"], "left_anti")
    # The least ``centres`` classes of each group, as slots: no group is sorted in one task.
    slot = F.pmod(F.xxhash64("cls"), F.lit(centres))
    chosen = outside.groupBy("sig", slot.alias("slot")).agg(F.min(F.struct("cls", "root")).alias("c")).select("sig", "c.*")
    chosen = saved(chosen, "centres")
    ends = chosen.select("sig", F.col("cls").alias("centre"), F.col("root").alias("centre_root"))
    pairs = known.join(ends, "sig").filter("root <> centre_root")
    pairs = pairs.select(F.least("cls", "centre").alias("a"), F.greatest("cls", "centre").alias("b")).distinct()
    return chosen.select("sig", "cls"), pairs


def _class_roots(docs: DataFrame, id_col: str, text: str, group: int) -> DataFrame:
    """(id, n_shingles, cls, root, least) of every row: its class, the least
    class of its component and the least id of the component; the last two
    null without words."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    id_type = source.schema[0].dataType.simpleString()
    rows = source.mapInArrow(_class_rows("id"), f"id {id_type}, n_shingles long, cls long")
    rows = saved(rows, "classes")
    classes = rows.filter("n_shingles > 0").groupBy("cls").agg(F.min("n_shingles").alias("n_shingles"), F.min("id").alias("least"))
    classes = saved(classes, "class-ids")
    roots = class_components(source, classes, group)
    keyed = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", F.col("cls")))
    least = keyed.groupBy("root").agg(F.min("least").alias("least"))
    by_class = keyed.select("cls", "root").join(least, "root")
    linked = rows.filter("n_shingles > 0").join(by_class, "cls").select("id", "n_shingles", "cls", "root", "least")
    none = [F.lit(None).cast("long").alias("root"), F.lit(None).cast(id_type).alias("least")]
    return linked.unionByName(rows.filter("n_shingles = 0").select("id", "n_shingles", "cls", *none))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``."""
    found = _class_roots(docs, id_col, text, group)
    component = F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("least"))
    return found.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"))


def _class_column(text: Column) -> Column:
    @F.pandas_udf("long")
    def classes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = WordHashes()
        for texts in batches:
            yield texts.map(lambda t: class_of(shingle_set((t or "").encode(), hashes))).astype("int64")

    return classes(text)


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked or equal texts, one with
    the least id; rows without words all stay."""
    rows = saved(_class_roots(docs, id_col, text, GROUP), "groups").filter("n_shingles > 0")
    same = rows.groupBy("root", "id", "cls").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("cls"), F.col("n")))
    leaders = saved(same.groupBy("root").agg(first.alias("f")).select("f.id", "f.cls", "f.n"), "leaders")
    few = leaders.count() <= PICKED_CLASSES
    mark = fresh_name(docs, "_class")
    marked = docs.withColumn(mark, _class_column(F.col(text).cast("string")))

    def among(chosen: DataFrame) -> DataFrame:
        chosen = F.broadcast(chosen) if few else chosen
        return marked.join(chosen, docs[id_col].eqNullSafe(chosen["id"]) & (marked[mark] == chosen["cls"]), "left_semi")

    kept = marked.filter(F.col(mark) == class_of(np.zeros(0, np.uint64))).unionByName(among(leaders.filter("n = 1")))
    repeated = leaders.filter("n > 1")  # rows that share id and text: one of them
    if repeated.head(1):
        kept = kept.unionByName(among(repeated).dropDuplicates([id_col, mark]))
    return kept.drop(mark)


def op9_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return jaccard_components(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+', ' ', 'g'), ' '), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), grams AS (
  SELECT doc_id, unnest(s) AS g FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT c.a, c.b FROM common c JOIN sets x ON x.doc_id = c.a JOIN sets y ON y.doc_id = c.b
  WHERE 100 * c.n >= 75 * (len(x.s) + len(y.s) - c.n)
), edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reach r USING (doc_id) GROUP BY s.doc_id, len(s.s)
"""
