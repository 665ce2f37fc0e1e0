"""Counts, marks and data quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import START_DATE
from millrace.functions.values import is_accepted
from millrace.operators.joins import explode_ids


def pending_count(df: DataFrame, incremental: bool = True) -> DataFrame:
    """Number of rows to publish: the unpublished ones, or all."""
    return df.agg((F.count_if(~F.col("imported")) if incremental else F.count(F.lit(1))).alias("n"))


def high_watermark(df: DataFrame, source: str, ts: str, default: str = START_DATE) -> DataFrame:
    """Latest time per source: the lower bound of its next run."""
    mark = F.coalesce(F.max(ts), F.lit(default).cast("timestamp_ntz"))
    return df.groupBy(source).agg(mark.alias("last_update"))


def unchanged_per_page(df: DataFrame, page: str) -> DataFrame:
    return df.groupBy(page).agg(F.count_if("unchanged").alias("unchanged"), F.count(F.lit(1)).alias("entries"))


def orphans(child: DataFrame, parent: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Child rows whose parent is missing; `keys` maps child to parent columns.
    A null reference is no orphan."""
    known = parent.select(*[F.col(p).alias(c) for c, p in keys.items()])
    return child.dropna(subset=list(keys)).join(known, list(keys), "left_anti")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are null or occur more than once, with their row count."""
    missing = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | missing)


def missing_lookups(df: DataFrame, ids: str, target: DataFrame, target_id: str) -> DataFrame:
    """Entries of an id list with no row in `target`."""
    listed = explode_ids(df, ids, "_id", "pos")
    known = target.select(F.col(target_id).cast("string").alias("_id"))
    return listed.join(known, "_id", "left_anti").withColumnRenamed("_id", "missing_id")


def accept_mismatch(posts: DataFrame) -> DataFrame:
    """Questions that name an accepted answer but are not flagged accepted."""
    named = is_accepted(F.col("accept_id").cast("string"))
    return posts.filter(named & ~F.coalesce(F.col("is_accepted"), F.lit(False)))


def count_mismatch(questions: DataFrame, posts: DataFrame, count: str = "answer_count") -> DataFrame:
    """Questions whose stored count differs from the number of their answers."""
    real = posts.groupBy(F.col("parent_id").alias("question_id")).agg(F.count(F.lit(1)).alias("found"))
    counted = questions.join(real, "question_id", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return counted.filter(F.coalesce(F.col(count) != F.col("found"), F.lit(True)))


def suspect_values(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Number of suspect rows per reason."""
    counts = df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(reason) for reason, bad in rules.items()])
    pairs = F.array(*[F.struct(F.lit(reason).alias("reason"), F.col(reason).alias("n")) for reason in rules])
    return counts.select(F.inline(pairs))
