"""Keyed tables: a base in key buckets, appended deltas, and a pointer that names what is valid.

Layout of a table under its path::

    _batch=<n>/_bucket=<b>/            delta of batch n, one row per key
    _base/_version=<v>/_bucket=<b>/    folded rows of a bucket
    _pointers/<v>/                     one file: which version each bucket has, and the last batch folded into it

Reading folds the base with the deltas behind the last folded batch.  Compaction rewrites only the buckets that open
deltas touch and then writes the pointer, a single file that appears when Spark commits it: until then readers see the
old state, and a compaction that broke off is done again under the same version.  Folding a key writes the columns of
the policy from its last write and all others from the first, so it does not matter how writes are grouped.

Old versions and folded deltas are not removed; leave that to the retention of the folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.upserts import fold_writes

BATCH, BUCKET, VERSION = "_batch", "_bucket", "_version"
_POINTER = "bucket int, version long, folded long"


def _folder(spark: SparkSession, path: str):
    """The file system and path object of a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, none where it does not exist."""
    fs, folder = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


@dataclass(frozen=True)
class Pointer:
    """What is valid: the version of each bucket with a base, and the last batch folded into it."""

    version: int
    folded: int
    buckets: dict[int, int]


@dataclass(frozen=True)
class KeyedTable:
    """One row per `key` under `path`; repeated writes change the columns `update_cols` only.

    `buckets` is fixed for the life of a table; choose it so that one bucket is rewritten in reasonable time.
    """

    spark: SparkSession
    path: str
    key: tuple[str, ...]
    update_cols: tuple[str, ...] = ()
    buckets: int = 16

    def bucket(self) -> Column:
        return F.pmod(F.hash(*self.key), F.lit(self.buckets)).alias(BUCKET)

    def pointer(self) -> Pointer:
        done = [int(n) for n in names_in(self.spark, f"{self.path}/_pointers") if "_SUCCESS" in names_in(self.spark, f"{self.path}/_pointers/{n}")]
        if not done:
            return Pointer(0, -1, {})
        rows = self.spark.read.schema(_POINTER).json(f"{self.path}/_pointers/{max(done)}").collect()  # one row per bucket
        return Pointer(max(done), rows[0]["folded"], {r["bucket"]: r["version"] for r in rows if r["version"] is not None})

    def append(self, df: DataFrame, batch_id: int, order: Sequence[str]) -> None:
        """Writes a batch as a delta.  A replay overwrites its own delta, or nothing where that is folded already."""
        if batch_id <= self.pointer().folded:
            return
        folded = fold_writes(df, self.key, order, self.update_cols).withColumn(BUCKET, self.bucket())
        folded.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/{BATCH}={batch_id}")

    def _deltas(self, pointer: Pointer, before: int | None, only: Sequence[int] | None) -> DataFrame | None:
        batches = [int(n.split("=")[1]) for n in names_in(self.spark, self.path) if n.startswith(f"{BATCH}=")]
        wanted = [b for b in batches if b > pointer.folded and (before is None or b < before)]
        paths = [f"{self.path}/{BATCH}={b}" for b in wanted if any(n.startswith(BUCKET) for n in names_in(self.spark, f"{self.path}/{BATCH}={b}"))]
        if not paths:
            return None
        rows = self.spark.read.option("basePath", self.path).parquet(*paths)
        return rows if only is None else rows.where(F.col(BUCKET).isin(list(only)))

    def _base(self, pointer: Pointer, only: Sequence[int] | None) -> DataFrame | None:
        paths = [f"{self.path}/_base/{VERSION}={v}/{BUCKET}={b}" for b, v in pointer.buckets.items() if only is None or b in only]
        if not paths:
            return None
        return self.spark.read.option("basePath", f"{self.path}/_base").parquet(*paths).drop(VERSION).withColumn(BATCH, F.lit(-1))

    def rows(self, before: int | None = None, only: Sequence[int] | None = None) -> DataFrame | None:
        """The current rows, or those before a batch, or those of some buckets; None where nothing was written yet.

        Rows of the base whose key no open delta has pass without a fold.
        """
        pointer = self.pointer()
        base, deltas = self._base(pointer, only), self._deltas(pointer, before, only)
        if base is None or deltas is None:
            found = base if deltas is None else deltas
            return None if found is None else self._fold(found)
        written = deltas.select(*self.key).distinct()
        same = [a.eqNullSafe(b) for a, b in ((base[k], written[k]) for k in self.key)]
        kept, again = base.join(written, same, "left_anti"), base.join(written, same, "left_semi")
        return kept.drop(BATCH, BUCKET).unionByName(self._fold(again.unionByName(deltas)))

    def _fold(self, rows: DataFrame) -> DataFrame:
        return fold_writes(rows.drop(BUCKET), self.key, [BATCH], (*self.update_cols, BATCH)).drop(BATCH)

    def lookup(self, keys: DataFrame, before: int | None = None) -> DataFrame | None:
        """The rows of some keys, read from the buckets of those keys only."""
        touched = [r[0] for r in keys.select(self.bucket()).distinct().collect()]  # at most `buckets` numbers
        found = self.rows(before, touched)
        return None if found is None else found.join(keys.select(*self.key).distinct(), list(self.key), "left_semi")

    def compact(self) -> list[int]:
        """Folds the open deltas into new files of the buckets they touch; returns those buckets."""
        pointer = self.pointer()
        deltas = self._deltas(pointer, None, None)
        if deltas is None:
            return []
        seen = deltas.groupBy(BUCKET).agg(F.max(BATCH).alias(BATCH)).collect()  # at most `buckets` rows
        touched, last, version = sorted(r[BUCKET] for r in seen), max(r[BATCH] for r in seen), pointer.version + 1
        base = self._base(pointer, touched)
        rows = self._fold(deltas if base is None else base.unionByName(deltas)).withColumn(BUCKET, self.bucket())
        rows.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/_base/{VERSION}={version}")
        self._point(Pointer(version, last, pointer.buckets | {b: version for b in touched}))
        return touched

    def _point(self, new: Pointer) -> None:
        rows = [(b, v, new.folded) for b, v in sorted(new.buckets.items())]
        self.spark.createDataFrame(rows, _POINTER).coalesce(1).write.mode("overwrite").json(f"{self.path}/_pointers/{new.version}")
