"""Exact top-k inner-product search over a pivot-distance index.

Index: every vector is keyed by its nearest pivot and by its distance to it,
cut into rings (annuli); a ring with many rows is split into several blocks.
A block knows its least and greatest distance to the pivot and its greatest
norm. For a query q and a vector x of a block, the triangle inequality gives
``|q - x| >= |d(q, p) - d(x, p)|``, and the inner product is
``(|q|^2 + |x|^2 - |q - x|^2) / 2``: each block has an upper bound.

Search: each query is first matched with its most promising block, which gives
a k-th best score; then with every further block whose bound reaches that
score, and no other, so the result is exact. Queries travel in packs, blocks
in packed form, and a pair of packs is one matrix product.

The pivots are a documented sample (``PIVOTS`` vectors with the least hash of
their id, and the origin); every vector is indexed. The block table and the
pivots go to the driver: at most (PIVOTS + 1) x (RINGS + 1) ring rows a dimension.

Defined cases: vectors that are null, empty, or hold null or non-finite
components, and rows with a null id, take no part; repeated (id, vector) rows
count once; vectors of other dimensions than the query's are no candidates;
a query with fewer than k candidates returns all; ties go to the smaller id;
extra columns are ignored; empty tables give an empty result. Components must
fit 64-bit integers after scaling, scores likewise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, table

PIVOTS = 32
RINGS = 24
BLOCK_ROWS = 2048
PACK_QUERIES = 512
#: Bounds are floating-point; they are widened by this share before use.
SLACK = 1e-9


def scaled(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, or null for a vector that takes no part."""
    bad = vector.isNull() | (F.size(vector) == 0) | F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | F.abs(x.cast("double")).eqNullSafe(F.lit(float("inf")))
    )
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _keys(pivots: dict[int, np.ndarray]) -> Callable:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch["v"].map(len)):
                x = np.stack(part["v"].to_numpy()).astype(float)
                p = pivots.get(dim, np.zeros((1, dim)))
                norm2 = (x * x).sum(axis=1)
                gap = np.maximum(norm2[:, None] + (p * p).sum(axis=1) - 2 * x @ p.T, 0)
                near = gap.argmin(axis=1)
                dist = np.sqrt(((x - p[near]) ** 2).sum(axis=1))
                yield pd.DataFrame({"vec_id": part["vec_id"], "v": part["v"], "dim": dim, "pivot": near, "dist": dist, "norm2": norm2})

    return rows


def _pack(rows: pd.DataFrame) -> tuple[bytes, bytes]:
    return rows["vec_id"].to_numpy(np.int64).tobytes(), np.stack(rows["v"].to_numpy()).astype(np.int64).tobytes()


def _unpack(ids: bytes, vectors: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors, np.int64).reshape(-1, dim)


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products, as a float product where that is exact."""
    reach = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if reach < 2**53:
        return (q.astype(float) @ x.T.astype(float)).astype(np.int64)
    return q @ x.T


def _matched(k: int) -> Callable:
    """(query pack, block) rows -> each query's k best of that block."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                q_ids, q = _unpack(r.q_ids, r.q_vectors, r.dim)
                wanted = np.frombuffer(r.wanted, np.int32)
                q_ids, q = q_ids[wanted], q[wanted]
                ids, x = _unpack(r.ids, r.vectors, r.dim)
                order = np.argsort(ids, kind="stable")
                ids, x = ids[order], x[order]
                score = _products(q, x)
                own = q_ids[:, None] == ids[None, :]
                for i in range(len(q_ids)):
                    at = np.flatnonzero(~own[i])
                    s = score[i][at]
                    if len(s) > k:  # keep every tie of the k-th; the least ids stand first
                        cut = np.partition(s, len(s) - k)[len(s) - k]
                        at, s = at[s >= cut], s[s >= cut]
                    best = np.argsort(-s, kind="stable")[:k]
                    yield pd.DataFrame({"query_row": r.pack * PACK_LIMIT + wanted[i], "query_id": q_ids[i], "vec_id": ids[at[best]], "score": s[best]})

    return rows


PACK_LIMIT = 1 << 20  # query_row = pack * PACK_LIMIT + place in the pack


def _top(matches: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return matches.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) of (vec_id, v) rows with integer
    vectors; ``is_query`` marks the query rows."""
    spark = vectors.sparkSession
    rows = vectors.filter("vec_id IS NOT NULL AND v IS NOT NULL").select(F.col("vec_id").cast("long"), "v").distinct()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).toArrow().to_pandas()
    pivots = {}
    for dim, part in sample.groupby(sample["v"].map(len)) if len(sample) else ():
        pivots[dim] = np.vstack([np.zeros(dim), np.unique(np.stack(part["v"].to_numpy()).astype(float), axis=0)])
    keyed = rows.mapInPandas(_keys(pivots), "vec_id long, v array<long>, dim int, pivot int, dist double, norm2 double")
    keyed = saved(keyed, "pivots")
    spread = keyed.agg(F.max("dist")).head()[0] or 1.0
    ring = F.floor(F.col("dist") / F.lit(spread) * RINGS).cast("int")
    keyed = keyed.withColumn("ring", ring)
    place = ["dim", "pivot", "ring"]
    rings = keyed.groupBy(place).agg(
        F.count(F.lit(1)).alias("n"), F.min("dist").alias("lo"), F.max("dist").alias("hi"), F.max("norm2").alias("norm2")
    )
    known = rings.toArrow().to_pandas().sort_values(place).reset_index(drop=True)  # bounded by pivots x rings
    known["parts"] = -(-known["n"] // BLOCK_ROWS)
    known["block"] = known["parts"].cumsum() - known["parts"]  # first block number of the ring

    starts = spark.createDataFrame(known[[*place, "parts", "block"]], "dim int, pivot int, ring int, parts long, block long")
    part = F.pmod(F.xxhash64("vec_id", "v"), F.col("parts"))
    blocks = keyed.join(starts, place).select("dim", (F.col("block") + part).alias("block"), "vec_id", "v")

    def block_row(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *_pack(pdf))], columns=["block", "ids", "vectors"])

    blocks = saved(blocks.groupBy("block").applyInPandas(block_row, "block long, ids binary, vectors binary"), "blocks")

    # Queries in packs of neighbours: same dimension, pivot and ring.
    asked = keyed.filter(is_query)
    per_ring = asked.groupBy(place).agg(F.count(F.lit(1)).alias("n")).toArrow().to_pandas().sort_values(place)
    per_ring["packs"] = -(-per_ring["n"] // PACK_QUERIES)
    per_ring["pack"] = per_ring["packs"].cumsum() - per_ring["packs"]
    firsts = spark.createDataFrame(per_ring[[*place, "packs", "pack"]], "dim int, pivot int, ring int, packs long, pack long")
    pack = F.col("pack") + F.pmod(F.xxhash64("vec_id", "v"), F.col("packs"))

    def pack_row(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(key[0], int(pdf["dim"].iloc[0]), *_pack(pdf))], columns=["pack", "dim", "q_ids", "q_vectors"])

    packs = asked.join(firsts, place).select(pack.alias("pack"), "dim", "vec_id", "v")
    packs = saved(packs.groupBy("pack").applyInPandas(pack_row, "pack long, dim int, q_ids binary, q_vectors binary"), "packs")

    def bounds(dim: int, q: np.ndarray) -> tuple[pd.DataFrame, np.ndarray]:
        """The rings of the dimension and the queries' upper bounds [query, ring]."""
        here = known[known["dim"] == dim]
        x = q.astype(float)
        p = pivots.get(dim, np.zeros((1, dim)))
        norm2 = (x * x).sum(axis=1)
        gap = np.sqrt(((x[:, None, :] - p[None, :, :]) ** 2).sum(axis=2))[:, here["pivot"].to_numpy()]
        apart = np.maximum(np.maximum(here["lo"].to_numpy() - gap, gap - here["hi"].to_numpy()), 0)
        top = (norm2[:, None] + here["norm2"].to_numpy() - apart**2) / 2
        return here, top + SLACK * (np.abs(top) + norm2[:, None] + 1)

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """(pack, block) pairs still to be matched, with the queries that want them."""
        for batch in batches:
            for r in batch.itertuples():
                _, q = _unpack(r.q_ids, r.q_vectors, r.dim)
                here, top = bounds(r.dim, q)
                first = top.argmax(axis=1)
                if r.reached is None:
                    want = np.arange(len(here))[None, :] == first[:, None]
                else:
                    reached = np.full(len(q), -np.inf)
                    seen = np.asarray(r.reached, float).reshape(-1, 2)
                    reached[seen[:, 0].astype(int)] = seen[:, 1]
                    want = (top >= reached[:, None]) & (np.arange(len(here))[None, :] != first[:, None])
                out = []
                for j, ring_row in enumerate(here.itertuples()):
                    at = np.flatnonzero(want[:, j]).astype(np.int32)
                    if len(at):
                        out += [(r.pack, r.dim, ring_row.block + i, at.tobytes()) for i in range(ring_row.parts)]
                yield pd.DataFrame(out, columns=["pack", "dim", "block", "wanted"])

    def matched(asks: DataFrame) -> DataFrame:
        pairs = asks.mapInPandas(expand, "pack long, dim int, block long, wanted binary")
        pairs = pairs.join(packs.drop("dim"), "pack").join(blocks, "block")
        return pairs.mapInPandas(_matched(k), "query_row long, query_id long, vec_id long, score long")

    none = F.lit(None).cast("array<double>")
    near = saved(_top(matched(packs.withColumn("reached", none)), k).drop("rank"), "nearest")
    row_of = F.col("query_row") % PACK_LIMIT
    kth = near.groupBy("query_row").agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    reached = kth.groupBy(F.floor(F.col("query_row") / PACK_LIMIT).alias("pack")).agg(
        F.flatten(F.collect_list(F.array(row_of.cast("double"), F.col("s").cast("double")))).alias("reached")
    )
    asks = packs.join(reached, "pack", "left")
    asks = asks.withColumn("reached", F.coalesce("reached", F.array().cast("array<double>")))
    return _top(near.unionByName(matched(asks)), k).select("query_id", "rank", "vec_id", "score")


def op6_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best-scored vectors for every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", scaled(F.col("embedding")).alias("v"))
    return top_k(vectors, F.col("vec_id") % 50 == 0, 5)


OP6_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
