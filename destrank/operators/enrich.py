"""Joins and lookups: first-match lookup, detail merge, semi filter,
positional zip, de-duplication and ordered text assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from destrank.operators.ranking import BROADCAST_MAX_ROWS, positions
from destrank.session import checkpoint_counted, checkpoint_measured, ensure_checkpoint_dir

# A key is "hot" when the big side holds more rows for it than one task
# should join; such keys are spread over as many tasks as they need.
HOT_KEY_ROWS = 2_000_000
# A lookup side is broadcast only below both bounds.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the row that comes first by ``order``.

    ``min_by`` over a struct is a partial aggregate, so a key shared by
    a large share of the rows is reduced map-side instead of being
    buffered whole by a window in one task.
    """
    keys = list(keys)
    cols = list(columns) if columns is not None else [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*cols), F.struct(*order)).alias("_first")
    rows = df
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    return rows.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in cols])


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    hot_key_rows: int = HOT_KEY_ROWS,
    max_salts: int | None = None,
) -> DataFrame:
    """Join ``left`` to ``right``, which holds at most one row per key.

    ``right`` is checkpointed first, its rows and approximate bytes
    observed on the same job. Within ``broadcast_max_rows`` and
    ``broadcast_max_bytes`` it is broadcast (a proven bound), and ``left``
    is never shuffled. A larger ``right`` is shuffle-joined. Keys holding
    more than ``hot_key_rows`` left rows are salted: their left rows are
    spread over ``ceil(rows / hot_key_rows)`` salts (at most ``max_salts``, if
    given), and their single right row is repeated once per salt. The salt is
    the row's number in its partition, so equal rows spread too. Other keys
    keep salt 0. Finding the hot keys costs one
    extra pass over ``left``'s key columns (a partial count), paid only
    on this large-lookup path. Salting is needed because the adaptive
    skew split does not apply when ``right`` comes straight from an
    aggregation on the join key.
    """
    on = list(on)
    ensure_checkpoint_dir(left.sparkSession)
    right, n_right, right_bytes = checkpoint_measured(right)
    if n_right <= broadcast_max_rows and right_bytes <= broadcast_max_bytes:
        return left.join(F.broadcast(right), on, how)

    # A NULL key matches nothing: those rows need no join and no shuffle.
    no_key = F.greatest(*[F.col(c).isNull() for c in on], F.lit(False))
    unmatched = left.where(no_key) if how == "left" else None
    left = left.where(~no_key)

    def whole(joined: DataFrame) -> DataFrame:
        return joined if unmatched is None else joined.unionByName(unmatched, allowMissingColumns=True)

    salts = F.ceil(F.col("_rows") / F.lit(hot_key_rows))
    salts = salts if max_salts is None else F.least(F.lit(max_salts), salts)
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    hot, n_hot = checkpoint_counted(
        counts.where(F.col("_rows") > hot_key_rows).select(
            *on, salts.cast("int").alias("_k")
        )
    )
    if n_hot == 0:
        return whole(left.join(right, on, how))
    # At most (left rows / hot_key_rows) keys by construction; broadcast
    # only below the same observed row bound as any other side.
    if n_hot <= broadcast_max_rows:
        hot = F.broadcast(hot)
    salted_left = left.join(hot, on, "left").withColumn(
        "_salt",
        F.when(F.col("_k").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.col("_k"))).otherwise(F.lit(0)),
    ).drop("_k")
    salted_right = right.join(hot, on, "left").withColumn(
        "_salt",
        F.explode(F.when(F.col("_k").isNotNull(), F.sequence(F.lit(0), F.col("_k") - 1)).otherwise(F.array(F.lit(0)))),
    ).drop("_k")
    return whole(salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt"))


def lookup_first(
    left: DataFrame,
    lookup: DataFrame,
    on: str,
    order: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """Left lookup keeping only the first match per key, NULLs on a miss.

    Replaces "ask the geocoder with limit=1, store None when empty":
    the lookup side is reduced to one row per key first, so the join can
    never multiply left rows.
    """
    return lookup_join(left, first_per_key(lookup, [on], order, columns), [on], "left")


def semi_filter(df: DataFrame, keys: DataFrame, on: str | Sequence[str], bounded: bool = False) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys`` (``isin`` as a join).

    ``bounded`` states that ``keys`` has a fixed small size (a top-k),
    which makes broadcasting it safe; otherwise the planner decides.
    """
    cols = [on] if isinstance(on, str) else list(on)
    side = keys.select(*cols)
    return df.join(F.broadcast(side) if bounded else side, on=cols, how="left_semi")


def detail_merge(
    listing: DataFrame,
    details: DataFrame,
    on: str = "url",
    order: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Attach per-URL details to listing rows (left join on the URL).

    Details are first reduced to one row per URL (the first by ``order``),
    so duplicate detail pages cannot multiply the listing. Listing rows
    without a matching URL keep NULL details.
    """
    order = list(order or [])
    cols = list(columns) if columns is not None else [c for c in details.columns if c != on and c not in order]
    usable = details.where(F.col(on).isNotNull() & (F.col(on) != ""))
    once = first_per_key(usable, [on], order or cols, cols)
    return lookup_join(listing, once, [on], "left")


def dedup_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One output row per key (the first by ``order``), all columns kept."""
    return first_per_key(df, key, order).select(*df.columns)


def zip_positions(
    left: DataFrame,
    right: DataFrame,
    group: Sequence[str],
    left_order: str,
    right_order: str,
    left_cols: Sequence[str],
    right_cols: Sequence[str],
    **rank_options,
) -> DataFrame:
    """Pair the i-th row of ``left`` with the i-th row of ``right`` per group.

    The shorter side is padded with NULLs (like zipping two lists with a
    None default). Positions come from the bucketed rank, and pairing is
    a full outer join on (group, position) whose keys are unique per side.
    """
    group = list(group)
    lp = positions(left.select(*group, left_order, *left_cols), group, left_order, "pos", **rank_options).drop(left_order)
    rp = positions(right.select(*group, right_order, *right_cols), group, right_order, "pos", **rank_options).drop(right_order)
    return lp.join(rp, on=[*group, "pos"], how="full_outer")


def join_group_texts(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    text: str,
    sep: str = " ",
    output: str = "text",
    run_length: int = 1024,
) -> DataFrame:
    """One row per group: the texts joined by ``sep`` in ``order``.

    Two levels, so a huge group is not gathered and sorted by one task:
    pieces are first joined within runs of ``run_length`` consecutive
    order values (``floor(order / run_length)``, order-preserving for a
    numeric ``order``), then the few run strings of a group are joined.
    The final row holds the group's whole text, which is the output.
    NULL pieces are skipped; a group without any text gives ''.
    """
    group = list(group)

    def ordered_join(pairs):
        return F.array_join(F.transform(F.array_sort(pairs), lambda p: p["t"]), sep)

    run = F.floor(F.col(order) / F.lit(run_length)).alias("_run")
    runs = df.groupBy(*group, run).agg(
        F.min(order).alias("_first"),
        F.when(
            F.count(text) > 0,
            ordered_join(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))),
        ).alias("_piece"),
    )
    return runs.groupBy(*group).agg(
        F.coalesce(
            ordered_join(F.collect_list(F.struct(F.col("_first").alias("o"), F.col("_piece").alias("t")))),
            F.lit(""),
        ).alias(output)
    )
