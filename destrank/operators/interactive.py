"""Top places for changing weights, from the heads of sorted lists.

The ranks do not depend on the weights. They are written once as one list per
criterion, best rank first, each row with all its ranks. A setting of the
weights reads the heads of the lists that have a weight: whatever comes later
in all of them scores at most the weighted sum of the ranks where the heads
end. Once the k-th best row seen is above that bound, no other row can be among
the best k (the threshold algorithm). Heads already read are kept for the next
setting. A setting whose bound does not close within ``MAX_DEPTH`` rows a list
(or that has no weight at all) is answered by the whole list, on the executors.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from destrank.operators.numbering import with_row_numbers
from destrank.operators.ranking import score_from_ranks, top_k
from destrank.session import ensure_checkpoint_dir

CRITERIA = ("rank_temp", "rank_rain", "rank_humidity")
FIRST_DEPTH = 64
MAX_DEPTH = 1 << 16
POSITION, ROW = "position", "row_number"


def write_ranked_lists(ranks: DataFrame, folder: str, key: str = "city") -> None:
    """The lists of ``ranks`` (``criterion_ranks``) below ``folder``, each cut
    into files by position, so that a head is found from the files' statistics.
    Rows without some rank have no score; they make up a list of their own."""
    ensure_checkpoint_dir(ranks.sparkSession)
    ranks = ranks.checkpoint().withColumn(ROW, F.monotonically_increasing_id())  # one number in all lists
    scored = F.lit(True)
    for c in CRITERIA:
        scored = scored & F.col(c).isNotNull()
    for c in CRITERIA:
        _write(ranks.where(scored), [F.col(c).desc(), F.col(key).asc_nulls_last()], f"{folder}/{c}")
    _write(ranks.where(~scored), [F.col(key).asc_nulls_last()], f"{folder}/unscored")


def _write(rows: DataFrame, order: list, path: str) -> None:
    numbered = with_row_numbers(rows, order, POSITION)
    numbered.repartitionByRange(POSITION).sortWithinPartitions(POSITION).write.parquet(path)


class RankedLists:
    """The lists written to ``folder`` and the heads read of them so far."""

    def __init__(self, spark: SparkSession, folder: str, key: str = "city") -> None:
        self.spark, self.key = spark, key
        self.lists = {c: spark.read.parquet(f"{folder}/{c}") for c in (*CRITERIA, "unscored")}
        self.heads: dict[str, list[Row]] = {c: [] for c in self.lists}
        self.ended: set[str] = set()
        self.rows_read = 0
        self.whole_lists_read = 0

    def _head(self, name: str, depth: int) -> list[Row]:
        """The first ``depth`` rows; only those not read before are read."""
        known = self.heads[name]
        if len(known) < depth and name not in self.ended:
            at = F.col(POSITION)
            new = self.lists[name].where((at > len(known)) & (at <= depth)).collect()  # depth is at most MAX_DEPTH
            known += sorted(new, key=lambda r: r[POSITION])
            self.rows_read += len(new)
            if len(known) < depth:
                self.ended.add(name)
        return known[:depth]

    def top(self, weights: Sequence[int], k: int) -> DataFrame:
        """What ``top_k(score_from_ranks(ranks, weights), k)`` gives."""
        one = self.lists[CRITERIA[0]]
        scored = score_from_ranks(one, weights).drop(POSITION, ROW)  # also checks the weights
        used = [(c, w) for c, w in zip(CRITERIA, weights) if w]
        rows = self._best(used, weights, k) if used and k <= MAX_DEPTH else None
        if rows is None:
            self.whole_lists_read += 1
            return top_k(scored.unionByName(score_from_ranks(self.lists["unscored"], weights).drop(POSITION, ROW)), k, tie_break=(self.key,))
        rows += [(r, None) for r in self._head("unscored", k - len(rows))] if len(rows) < k else []
        columns = [c for c in one.columns if c not in (POSITION, ROW)]
        return self.spark.createDataFrame([(*[r[c] for c in columns], score) for r, score in rows], scored.schema)

    def _best(self, used: list[tuple[str, int]], weights: Sequence[int], k: int) -> list[tuple[Row, float]] | None:
        def place(r: Row) -> tuple:
            return -sum(r[c] * w for c, w in zip(CRITERIA, weights)), r[self.key] is None, r[self.key] or ""

        depth = max(k, FIRST_DEPTH)
        while depth <= MAX_DEPTH:
            seen = {r[ROW]: r for c, _ in used for r in self._head(c, depth)}
            best = heapq.nsmallest(k, seen.values(), key=place)
            all_seen = any(c in self.ended and depth >= len(self.heads[c]) for c, _ in used)
            bound = sum(self._head(c, depth)[-1][c] * w for c, w in used) if not all_seen else 0
            if all_seen or len(best) == k and -place(best[-1])[0] > bound:
                return [(r, -place(r)[0]) for r in best]
            depth *= 2
        return None
