"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.skew import orders, sort_columns


def dedup_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in `order`.

    Spark limits each map task to one row per key before the shuffle, so a hot key
    sends at most one row per task.
    """
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*sort_columns(order)))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def dedup_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key in `order`: the last write wins."""
    return dedup_first(df, key, [o.name if o.descending else f"-{o.name}" for o in orders(order)])


def drop_unchanged(df: DataFrame, stored: DataFrame, key: Sequence[str], ts: str) -> DataFrame:
    """Drop records whose key and time equal the stored pair."""
    return df.join(stored.select(*key, ts), [*key, ts], "left_anti")


def drop_seen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Drop rows whose key is in the seen set."""
    return df.join(seen.select(key), key, "left_anti")
