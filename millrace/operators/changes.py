"""Comparing a crawl with what is stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.dedup import dedup_first
from millrace.operators.skew import lookup_join

CHANGE = "change"


def classify_changes(
    new: DataFrame, stored: DataFrame, key: str, ts: str, carry: Sequence[str] = ()
) -> DataFrame:
    """Mark each incoming row `new`, `updated` or `unchanged` against the stored time of its key.

    `stored` has one row per key; its `carry` columns come along as ``stored_<name>``.
    """
    known = stored.select(key, *[F.col(c).alias(f"stored_{c}") for c in dict.fromkeys([ts, *carry])])
    before = F.col(f"stored_{ts}")
    kind = F.when(before.isNull(), "new").when(before < F.col(ts), "updated").otherwise("unchanged")
    return lookup_join(new, known, [key], "left").withColumn(CHANGE, kind)


def need_fetch(new: DataFrame, stored: DataFrame, key: str, ts: str, force: bool = False) -> DataFrame:
    """Rows whose details must be loaded: new or updated ones, or all with `force`."""
    if force:
        return new
    marked = classify_changes(new, stored, key, ts)
    return marked.filter(F.col(CHANGE) != "unchanged").select(*new.columns)


def drop_recent(
    df: DataFrame, stored: DataFrame, key: Sequence[str], order: Sequence[str], pubdate: str, now: Column, days: int = 30
) -> DataFrame:
    """Rows to store: the first of each key in this run, unless the key was stored
    with a date within `days` before `now`."""
    recent = stored.filter(F.col(pubdate) >= now - F.make_dt_interval(days=F.lit(days)))
    return dedup_first(df, key, order).join(recent.select(*key), list(key), "left_anti")


def summary_patches(marked: DataFrame, fix: bool = False) -> DataFrame:
    """Patches for unchanged questions whose view count moved.

    `marked` comes from `classify_changes` with `view_count` carried along.  The patch
    always resets the published flag; `fix` adds section and version columns.
    """
    columns = {"ViewCount": F.col("view_count").cast("string"), "Score": F.col("score").cast("string")}
    if fix:
        columns |= {"Section": F.col("section"), "SectionLink": F.col("section_link"), "Version": F.col("version")}
    columns["Imported"] = F.lit("False")
    entries = [part for name, value in columns.items() for part in (F.lit(name), value)]
    moved = (F.col(CHANGE) == "unchanged") & (F.col("stored_view_count") != F.col("view_count"))
    return marked.filter(moved).withColumn("patch", F.create_map(*entries))
