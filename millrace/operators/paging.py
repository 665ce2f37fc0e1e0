"""Early stop, priorities and batches over ordered entries.

The stops are defined row by row ("this row and all later ones are cut").  Here each
is the place of one row per page or section, found by an aggregation-like top-n that
Spark limits map-side, and a comparison with that place: no running window over a
whole section.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.dedup import dedup_first
from millrace.operators.skew import precedes, hot_keys, lookup_join, orders, sort_columns, with_position

NEXT_PAGE_PRIORITY = -1  # fixed value: list pages wait for all entries


def _place(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(o.name) for o in orders(order)])


def _attach(df: DataFrame, places: DataFrame, keys: Sequence[str], name: str, hot: list[Row] | None = None) -> DataFrame:
    """Add the one place per key (or the only one) to every row."""
    if keys:
        return lookup_join(df, places.select(*keys, name), keys, "left", hot=hot)
    return df.withColumn(name, places.select(name).scalar())


def cut_from(
    df: DataFrame, flagged: DataFrame, keys: Sequence[str], order: Sequence[str], hot: list[Row] | None = None
) -> DataFrame:
    """Rows before the first flagged row of their key."""
    first = dedup_first(flagged, keys, order).withColumn("_cut", _place(order))
    marked = _attach(df, first, keys, "_cut", hot)
    return marked.filter(F.col("_cut").isNull() | precedes(orders(order), _place(order), F.col("_cut"))).drop("_cut")


def stop_at_date(df: DataFrame, order: Sequence[str], ts: str, stop: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Cut from the first row whose time is not after `stop`."""
    return cut_from(df, df.filter(F.col(ts) <= stop), keys, order)


def stop_after_unchanged(
    df: DataFrame, n: int, keys: Sequence[str], order: Sequence[str], recent: Column | None = None
) -> DataFrame:
    """Stop a page once more than `n` unchanged rows were seen on it.

    Without `recent` the count is tested right after an unchanged row, which is cut.
    With it the test comes before the next row, and rows that are `recent` pass it.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*sort_columns(order)))
    limit = df.filter("unchanged").withColumn("_rank", rank).filter(F.col("_rank") <= n + 1)
    limit = limit.filter(F.col("_rank") == n + 1).drop("_rank")
    if recent is None:
        return cut_from(df, limit, keys, order)
    hot = hot_keys(df, keys) if keys else None
    after = _attach(df, limit.withColumn("_seen", _place(order)), keys, "_seen", hot)
    late = F.col("_seen").isNotNull() & precedes(orders(order), F.col("_seen"), _place(order))
    return cut_from(df, after.filter(late & ~recent).drop("_seen"), keys, order, hot)


def stop_at_unchanged(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Cut a section from its first unchanged entry that is not pinned; unchanged
    pinned entries are left out without stopping."""
    kept = cut_from(df, df.filter("unchanged AND NOT sticky"), keys, order)
    return kept.filter("NOT (unchanged AND sticky)")


def fetch_priority(
    entries: DataFrame, kept: DataFrame, page: str, order: Sequence[str], mode: str = "qa"
) -> DataFrame:
    """Priority of the kept entries of a page, starting from the number of all its
    entries: n * 20 falling by 10 (`qa`), or n falling by 1 (`forum`)."""
    factor, step = {"qa": (20, 10), "forum": (1, 1)}[mode]
    sizes = entries.groupBy(page).agg(F.count(F.lit(1)).alias("_n"))
    hot = hot_keys(entries, [page])
    placed = with_position(kept, [page], order, "_k", hot=hot)
    value = (F.col("_n") * factor - (F.col("_k") - 1) * step).cast("long")
    return lookup_join(placed, sizes, [page], "inner", hot=hot).withColumn("priority", value).drop("_n", "_k")


def next_batch(df: DataFrame, order: Sequence[str], n: int = 1000) -> DataFrame:
    """The first `n` rows, for a caller that works in batches."""
    return df.orderBy(*sort_columns(order)).limit(n)


def batch_numbers(df: DataFrame, order: Sequence[str], n: int = 1000, name: str = "batch") -> DataFrame:
    """Batch number of every row, all batches in one job."""
    placed = with_position(df, [], order, "_place")
    return placed.withColumn(name, F.ceil(F.col("_place") / n).cast("long")).drop("_place")


def top_n(df: DataFrame, n: int, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """First `n` rows in order, per `by` group if given."""
    if not by:
        return df.orderBy(*sort_columns(order)).limit(n)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*sort_columns(order)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def section_progress(state: DataFrame, sections: Sequence[str], section: str = "section") -> DataFrame:
    """Place of each section in the walk, the section after it, and whether it is the last."""
    walk = F.array(*[F.lit(s) for s in sections])
    at = F.nullif(F.array_position(walk, F.col(section)), F.lit(0))
    return state.withColumns({
        "index": (at - 1).cast("long"),
        "next_section": F.get(walk, at.cast("int")),
        "all_finished": at == F.lit(len(sections)),
    })
