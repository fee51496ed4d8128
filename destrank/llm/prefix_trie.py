"""Trie of conversation prefixes, by collapsing whole sequences.

1. A turn is told by the digest of its role and text; no text is shuffled.
   Turns get their places in a conversation by a range partitioning on
   (conversation, turn): the place in the partition plus the rows that the
   conversation has in earlier partitions.
2. Turns are gathered in blocks of ``BLOCK`` per conversation. A prefix is
   named by a polynomial of its turns' digests modulo a prime of 127 bits: the
   value of a block can be put behind that of any prefix, so the blocks are
   worked out independently and a running pass over one small row a block adds
   what stands before each.
3. Identical conversations are grouped into weighted sequences by depth and
   name, with their end lists. Sequences that are proper prefixes of others
   are dropped by an anti-join: the rest are the leaves.
4. The prefixes of every distinct sequence, weighted, are aggregated to nodes.
   A node belongs to the sequence of its smallest member, and a sequence owns
   the end of its path from some depth on; so a sum over a subtree is a sum
   over the sequences through its top, and no node is paired with its
   ancestors.

A conversation of any length is spread over blocks, a node shared by many is
summed before the shuffle, and end lists are kept in parts of ``PART`` ids.

Defined cases: rows without a conversation take no part; null roles and texts
are empty; null turns come first; equal turn numbers are ordered by digest;
repeated rows are turns each; other columns are ignored; a table without
conversations gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, table

BLOCK = 1024
PART = 256
PRIME = (1 << 127) - 1
FACTOR = 0x5851F42D4C957F2D14057B7EF767814F % PRIME
ROOT = (1).to_bytes(16, "big")
#: The place of the row that every conversation has besides its turns.
MARK = -1

SUMMARIES = "conv_id long, block long, turns long, hash binary, bytes long"
RUNNING = SUMMARIES.replace("turns", "turns_before").replace("hash", "hash_before").replace("bytes", "bytes_before")
ENDS = "depth long, node binary, total long"
PREFIXES = "conv_id long, weight long, depth long, node binary, parent binary, size long, rest long"
PARTS = "depth long, node binary, first_id long, ids array<long>"


def light_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, size): what the trie needs of each turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(F.unhex(F.sha2(told.cast("binary"), 256)), 1, 16).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )


def placed(turns: DataFrame) -> DataFrame:
    """Light turns with their place (from 0) in their conversation. A
    conversation of any size is numbered partition by partition."""
    ranged = turns.repartitionByRange("conv_id", "turn", "digest").withColumn("part", F.spark_partition_id())
    ranged = saved(ranged, "trie-turns")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("turn", "digest")) - 1
    numbered = ranged.withColumn("within", within)
    return numbered.join(before, ["conv_id", "part"]).select(
        "conv_id", (F.col("before") + F.col("within")).alias("place"), "digest", "size"
    )


def blocks_of(turns: DataFrame) -> DataFrame:
    """(conv_id, block, turns): placed turns and marks, BLOCK places a row."""
    turn = F.struct("place", "digest", "size")
    block = F.floor((F.col("place") + 1) / BLOCK).alias("block")
    return turns.groupBy("conv_id", block).agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def _turn_columns(turns: pa.ListArray) -> tuple[list[int], list[int], list[bytes], list[int]]:
    """Offsets of the lists, then places, digests and sizes of all turns."""
    flat = turns.flatten()
    ends = np.cumsum([0, *turns.value_lengths().to_pylist()]).tolist()
    return ends, *(flat.field(c).to_pylist() for c in ("place", "digest", "size"))


def _then(name: int, digest: bytes) -> int:
    return (name * FACTOR + int.from_bytes(digest, "big") + 1) % PRIME


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks -> how many turns each has, the value of their digests, their bytes."""
    for batch in batches:
        ends, places, digests, sizes = _turn_columns(batch.column("turns"))
        counts, names, octets = [], [], []
        for a, b in zip(ends, ends[1:]):
            a += a < b and places[a] == MARK
            name = 0
            for digest in digests[a:b]:
                name = _then(name, digest)
            counts.append(b - a)
            names.append(name.to_bytes(16, "big"))
            octets.append(sum(sizes[a:b]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("block"), pa.array(counts, pa.int64()), pa.array(names, pa.binary()),
             pa.array(octets, pa.int64())],
            names=[c.split()[0] for c in SUMMARIES.split(", ")],
        )


def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summaries by conversation and block -> what stands before each block;
    in a conversation's last block also its depth, name and bytes (else null)."""
    names = [c.split()[0] for c in f"{RUNNING}, {ENDS}".split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    conv, turns, name, octets = None, 0, 0, 0
    held: list | None = None
    for batch in batches:
        rows = []
        for conv_id, block, m, value, size in zip(*(c.to_pylist() for c in batch.columns)):
            if conv_id != conv:
                if held:
                    rows.append((*held, turns, name.to_bytes(16, "big"), octets))
                conv, turns, name, octets = conv_id, 0, int.from_bytes(ROOT, "big"), 0
            elif held:
                rows.append((*held, None, None, None))
            held = [conv_id, block, turns, name.to_bytes(16, "big"), octets]
            name = (name * pow(FACTOR, m, PRIME) + int.from_bytes(value, "big")) % PRIME
            turns, octets = turns + m, octets + size
        yield _batch(rows, kinds, names)
    if held:
        yield _batch([(*held, turns, name.to_bytes(16, "big"), octets)], kinds, names)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of distinct sequences -> one row for every prefix that ends in
    them; ``rest`` is the bytes of its last turn and all later ones."""
    names = [c.split()[0] for c in PREFIXES.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    for batch in batches:
        ends, places, digests, sizes = _turn_columns(batch.column("turns"))
        told = ("conv_id", "weight", "total", "turns_before", "hash_before", "bytes_before")
        rows: list[tuple] = []
        for k, (conv_id, weight, total, depth, start, before) in enumerate(
            zip(*(batch.column(c).to_pylist() for c in told))
        ):
            name, a, b = start, ends[k], ends[k + 1]
            if a < b and places[a] == MARK:
                rows.append((conv_id, weight, 0, name, None, 0, total))
                a += 1
            value = int.from_bytes(name, "big")
            for digest, size in zip(digests[a:b], sizes[a:b]):
                value, depth, parent = _then(value, digest), depth + 1, name
                name = value.to_bytes(16, "big")
                rows.append((conv_id, weight, depth, name, parent, size, total - before))
                before += size
        for at in range(0, len(rows), 10_000):
            yield _batch(rows[at : at + 10_000], kinds, names)


def end_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ends by depth, node and conversation -> lists of at most PART ids."""
    names = [c.split()[0] for c in PARTS.split(", ")]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())]
    key, ids = None, []
    for batch in batches:
        rows = []
        for depth, node, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
            if (depth, node) != key or len(ids) >= PART:
                if ids:
                    rows.append((*key, ids[0], ids))
                key, ids = (depth, node), []
            ids.append(conv_id)
        yield _batch(rows, kinds, names)
    if ids:
        yield _batch([(*key, ids[0], ids)], kinds, names)


def joined_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts by depth, node and first id -> SHA-256 of each node's ids, joined
    by commas; the digest is carried from part to part."""
    names, kinds = ["depth", "node", "ends_sha256"], [pa.int64(), pa.binary(), pa.string()]
    key, digest = None, hashlib.sha256()
    for batch in batches:
        rows = []
        for depth, node, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (depth, node) != key:
                if key:
                    rows.append((*key, digest.hexdigest()))
                key, digest = (depth, node), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(",".join(map(str, ids)).encode())
        yield _batch(rows, kinds, names)
    if key:
        yield _batch([(*key, digest.hexdigest())], kinds, names)


def _in_order(df: DataFrame, function: Callable, schema: str, together: list[str], then: str) -> DataFrame:
    return df.repartition(*together).sortWithinPartitions(*together, then).mapInArrow(function, schema)


def prefix_trie(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes and the end lists of the conversations of ``placed`` turns.

    Nodes: depth, node (its name), parent, conv_id (smallest member),
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens. End lists:
    depth, node, first_id, ids; the parts of a node follow by first id."""
    marks = turns.select("conv_id").distinct().select(
        "conv_id", F.lit(MARK).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"),
        F.lit(0).cast("long").alias("size"),
    )
    return _trie(turns.unionByName(marks))


def _trie(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``turns`` with a mark row for every conversation."""
    blocks = saved(blocks_of(turns), "trie-blocks")
    before = saved(
        _in_order(blocks.mapInArrow(summaries, SUMMARIES), running, f"{RUNNING}, {ENDS}", ["conv_id"], "block"),
        "trie-running",
    )
    ends = before.where("depth is not null").select("conv_id", "depth", "node", "total")
    parts = saved(
        ends.select("depth", "node", "conv_id")
        .repartitionByRange("depth", "node", "conv_id")
        .sortWithinPartitions("depth", "node", "conv_id")
        .mapInArrow(end_parts, PARTS),
        "trie-ends",
    )
    sequences = saved(
        ends.groupBy("depth", "node", "total").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight")),
        "trie-sequences",
    )
    paths = (
        blocks.join(before.drop("depth", "node", "total"), ["conv_id", "block"])
        .join(sequences.select("conv_id", "weight", "total", F.col("depth").alias("length")), "conv_id")
        .select("conv_id", "weight", "total", "turns_before", "hash_before", "bytes_before", "turns")
        .mapInArrow(prefixes, PREFIXES)
    )
    paths = saved(paths, "trie-prefixes")
    nodes = saved(
        paths.groupBy("depth", "node", "parent", "size").agg(
            F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs")
        ),
        "trie-nodes",
    )
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node"))
    children = saved(children.agg(F.count(F.lit(1)).alias("n_children")), "trie-children")
    # A sequence is a proper prefix of another just if its last node has children.
    leaves = sequences.join(children, ["depth", "node"], "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("from_depth"), F.sum("size").alias("owned_bytes"))
    of_sequence = saved(
        sequences.select("conv_id").join(leaves, "conv_id", "left").join(owned, "conv_id", "left"), "trie-owners"
    )
    own = F.when(F.col("depth") >= F.col("from_depth"), F.col("rest")).otherwise(F.col("owned_bytes"))
    sums = (
        paths.join(of_sequence, "conv_id")
        .select(
            "depth", "node", F.coalesce("leaf", F.lit(0)).alias("leaf"),
            (F.col("weight") * F.col("rest") - F.coalesce(own, F.lit(0))).alias("saved"),
        )
        .groupBy("depth", "node")
        .agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    named = nodes.drop("size").join(parents, ["depth", "parent"], "left")
    whole = named.join(children, ["depth", "node"], "left").join(sums, ["depth", "node"])
    return whole.withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), parts


def lead_of(conv_id: Column) -> Column:
    """How many of a conversation's first turns the query takes from another."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(9))


def rebuilt(turns: DataFrame) -> DataFrame:
    """The query's conversations, of placed turns: the first turns of the
    conversation whose id is the next lower multiple of five, then the own ones
    after as many. Each has a mark row too, also where it has no turn left."""
    conv_id = F.col("conv_id")
    own = turns.where(F.col("place") >= lead_of(conv_id))
    convs = saved(turns.select("conv_id").distinct(), "trie-conversations")
    members = convs.select(
        "conv_id", (conv_id - F.pmod(conv_id, F.lit(5))).alias("base"), lead_of(conv_id).alias("lead")
    )
    heads = turns.where((F.pmod(conv_id, F.lit(5)) == 0) & (F.col("place") < 8)).withColumnRenamed("conv_id", "base")
    led = members.join(heads, "base").where(F.col("place") < F.col("lead"))
    marks = convs.select(
        "conv_id", F.lit(MARK).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"),
        F.lit(0).cast("long").alias("size"),
    )
    return own.unionByName(led.select(*own.columns)).unionByName(marks)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prefix of the rebuilt conversations with its subtree's sums."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    nodes, parts = _trie(rebuilt(saved(placed(light_turns(turns)), "trie-placed")))
    digests = _in_order(parts, joined_digests, "depth long, node binary, ends_sha256 string", ["depth", "node"], "first_id")
    none = hashlib.sha256().hexdigest()
    return nodes.join(digests, ["depth", "node"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


#: The checksum of a conversation's id, byte by byte and bit by bit.
CRC_SQL = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
  string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""

#: The same by whole lists of turns: a node is a list, told by its turns' digests.
OP13_SQL = f"""
WITH light AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS size,
         sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
  SELECT conv_id, digest, size,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS place
  FROM light),
ids AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {CRC_SQL} % 9 AS lead FROM (SELECT DISTINCT conv_id FROM placed)),
parts AS (
  SELECT i.conv_id, p.place, p.digest, p.size FROM ids i JOIN placed p ON p.conv_id = i.conv_id AND p.place >= i.lead
  UNION ALL
  SELECT i.conv_id, p.place, p.digest, p.size FROM ids i JOIN placed p ON p.conv_id = i.base AND p.place < i.lead),
whole AS (
  SELECT i.conv_id, coalesce(list(p.digest ORDER BY p.place) FILTER (p.digest IS NOT NULL), []) AS seq,
         coalesce(list(p.size ORDER BY p.place) FILTER (p.digest IS NOT NULL), []) AS sizes
  FROM ids i LEFT JOIN parts p USING (conv_id) GROUP BY i.conv_id),
cut AS (
  SELECT conv_id, d AS depth, len(seq) = d AS ends, array_to_string(list_slice(seq, 1, d), ' ') AS node,
         CASE WHEN d > 0 THEN array_to_string(list_slice(seq, 1, d - 1), ' ') END AS parent,
         CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size
  FROM whole, LATERAL (SELECT unnest(range(0, len(seq) + 1)) AS d)),
nodes AS (
  SELECT depth, node, parent, size, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM cut GROUP BY ALL),
kids AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
path AS (SELECT DISTINCT a.depth, a.node, b.depth AS below, b.node AS deeper
  FROM cut a JOIN cut b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
sums AS (
  SELECT p.depth, p.node, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS n_leaves,
         sum((n.n_convs - 1) * n.size) AS saved_tokens
  FROM path p JOIN nodes n ON n.depth = p.below AND n.node = p.deeper
  LEFT JOIN kids k ON k.depth = p.below AND k.node = p.deeper GROUP BY ALL)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (depth, node) LEFT JOIN kids k USING (depth, node)
LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.node = n.parent
"""
