"""The incremental operators as Structured Streaming jobs.

Jobs run with `availableNow`: they take what arrived since the last run, from their
checkpoint, and stop.  What a job has to remember of a key is in a keyed table, read by
bucket, or in Spark's state store; no batch reads the whole history.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

from millrace.operators.dedup import dedup_first, dedup_last
from millrace.operators.filters import REASON, drop_early
from millrace.operators.upserts import fold_writes
from millrace.streaming.keyed import BATCH, KeyedTable, names_in

COMPACT_EVERY = 16  # batches between two compactions of a keyed table


def read_files(spark: SparkSession, path: str, schema: StructType, name: str = "*.parquet", per_batch: int = 1000) -> DataFrame:
    """Files of a folder as a stream."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", name).option("maxFilesPerTrigger", per_batch)
        .parquet(path)
    )


def _run(writer: DataStreamWriter) -> StreamingQuery:
    """Takes all that has arrived and ends.  State is kept in Spark's RocksDB store, which arbitrary state needs."""
    spark, name = SparkSession.active(), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(name, before)
    return query


def run_available(sdf: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append everything that has arrived to a Parquet table, exactly once."""
    writer = sdf.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _run(writer.outputMode("append"))


def run_batches(sdf: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Hand every micro-batch to `handle(df, batch_id)`; a replayed batch has the same id."""
    return _run(sdf.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint))


def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch of a log; a replay overwrites its own folder and nothing else."""
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def stream_dedup(
    sdf: DataFrame, path: str, checkpoint: str, key: Sequence[str], order: Sequence[str], compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """The first record of each key over the whole life of the stream, as a keyed table.

    Copies within a batch are combined map-side to the first by `order`; one row per key then meets the rows of the
    same buckets in the table.
    """
    table = KeyedTable(sdf.sparkSession, path, tuple(key))

    def handle(df: DataFrame, batch_id: int) -> None:
        first = dedup_first(df, key, order)
        known = table.lookup(first, batch_id)
        fresh = first if known is None else first.join(known.select(*key), list(key), "left_anti")
        table.append(fresh, batch_id, order)
        compact_after(table, batch_id, compact_every)

    return run_batches(sdf, checkpoint, handle)


def stream_dedup_within(sdf: DataFrame, key: Sequence[str], ts: str, days: int = 30, late_days: int = 30) -> DataFrame:
    """A record per key that no kept record of the last `days` calendar days has, the earliest of its day.

    The day of the kept record is per-key state with a timer that drops it when it can matter no more: `days` behind a
    watermark of `late_days`; records later than that are dropped by Spark.  Before they meet, the records of a task are
    combined to the earliest of each key and day, so that a very frequent key is a few rows per task.
    """
    key, schema = list(key), sdf.withColumn(ts, F.col(ts).cast("timestamp")).schema
    timed = sdf.withColumn(ts, F.col(ts).cast("timestamp"))
    combined = timed.mapInPandas(lambda batches: _first_of_days(batches, key, ts), schema).withWatermark(ts, f"{late_days} days")
    return combined.groupBy(*key).transformWithStateInPandas(_KeepOnce(ts, days), schema, "Append", "EventTime")


def stream_late_drop(sdf: DataFrame, ts: str, now: Column, days: int = 365) -> DataFrame:
    """Reason column for records that are too old by the clock `now`; not a watermark."""
    return drop_early(sdf, ts, now, days).withColumn("kept", F.col(REASON).isNull())


def compact_after(table: KeyedTable, batch_id: int, every: int) -> None:
    if (batch_id + 1) % every == 0:
        table.compact()


def stream_upsert(
    sdf: DataFrame, log: str, checkpoint: str, key: Sequence[str], update_cols: Sequence[str], order: Sequence[str],
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Write the upserts of a stream to a keyed table, repeated writes of a batch folded.

    A folded row holds the policy columns of the last and all others of the first write,
    so folding the batches again (`current_rows`) gives the same as folding all writes.
    """
    table = KeyedTable(sdf.sparkSession, log, tuple(key), tuple(update_cols))

    def handle(df: DataFrame, batch_id: int) -> None:
        table.append(df, batch_id, order)
        compact_after(table, batch_id, compact_every)

    return run_batches(sdf, checkpoint, handle)


def current_rows(spark: SparkSession, log: str, key: Sequence[str], update_cols: Sequence[str], base: DataFrame | None = None) -> DataFrame:
    """The rows of a keyed table, on top of the rows of `base`."""
    rows = KeyedTable(spark, log, tuple(key), tuple(update_cols)).rows()
    if base is None:
        return rows
    writes = base.withColumn(BATCH, F.lit(-1)).unionByName(rows.withColumn(BATCH, F.lit(0)), allowMissingColumns=True)
    return fold_writes(writes, key, [BATCH], update_cols).drop(BATCH)


def stream_changes(
    sdf: DataFrame, stored: DataFrame, log: str, checkpoint: str, key: str, ts: str, order: Sequence[str]
) -> StreamingQuery:
    """Mark the newest record of each key in a batch as new, updated or unchanged
    against the latest time known before the batch, from `stored` and earlier batches.

    The latest time of a key is state, begun from `stored` in the first run; a batch costs what it brings, however
    long the history.  Records of a task are combined to the newest of each key before they meet.
    """
    out = StructType([*sdf.schema.fields, StructField(f"stored_{ts}", sdf.schema[ts].dataType), StructField("change", StringType())])
    newest = sdf.mapInPandas(lambda batches: _newest(batches, key, list(order)), sdf.schema)
    known = stored.where(F.col(ts).isNotNull()).groupBy(key).agg(F.max(ts).alias(ts))
    processor = _MarkChanges(ts, list(order), sdf.schema[ts].dataType.simpleString())
    marked = newest.groupBy(key).transformWithStateInPandas(processor, out, "Append", "None", known.groupBy(key))
    return run_batches(marked, checkpoint, lambda df, batch_id: append_batch(df, log, batch_id))


def stream_publish(
    sdf: DataFrame, log: str, checkpoint: str, key: str, order: Sequence[str], published: DataFrame | None = None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Write documents not yet published to the keyed index: neither in `published` nor, in this or a newer version (`order`), by an earlier batch.

    A batch reads the versions of its own keys, from their buckets of the index.  Delivery is at least once; the index
    is keyed by id, so that a document published twice is there once.
    """
    columns = tuple(c for c in sdf.columns if c != key)
    table = KeyedTable(sdf.sparkSession, log, (key,), columns)

    def handle(df: DataFrame, batch_id: int) -> None:
        fresh = dedup_last(df, [key], order)
        if published is not None:
            fresh = fresh.join(published.select(key), key, "left_anti")
        known = table.lookup(fresh, batch_id)
        if known is not None:
            version = known.select(key, F.struct(*order).alias("_known"))
            fresh = fresh.join(version, key, "left").where(F.col("_known").isNull() | (F.col("_known") < F.struct(*order))).drop("_known")
        table.append(fresh, batch_id, order)
        compact_after(table, batch_id, compact_every)

    return run_batches(sdf, checkpoint, handle)


def high_mark(spark: SparkSession, target: str, ts: str) -> Column | None:
    """The greatest time written to a target so far, from the marks committed with its batches; None where it is empty."""
    marks = f"{target}/_marks"
    if not names_in(spark, marks):
        return None
    mark = spark.read.parquet(f"{marks}/*").agg(F.max("mark").alias("mark")).first()["mark"]
    return None if mark is None else F.lit(mark)


def run_once(spark: SparkSession, source: str, schema: StructType, name: str, ts: str, target: str, checkpoint: str) -> StreamingQuery:
    """A scheduled incremental run: what has arrived since the last run and is newer than the high mark goes to the target.

    The mark is read from the target when the run begins: all rows are new to an empty one.  Each batch writes its rows
    and then its own mark, so that a mark never stands without its rows; a replayed batch overwrites both.
    """
    mark = high_mark(spark, target, ts)
    arrived = read_files(spark, source, schema, name)

    def handle(df: DataFrame, batch_id: int) -> None:
        append_batch(df if mark is None else df.where(F.col(ts) > mark), target, batch_id)
        written = spark.read.parquet(f"{target}/{BATCH}={batch_id}").agg(F.max(F.col(ts).cast("timestamp_ntz")).alias("mark"))
        written.coalesce(1).write.mode("overwrite").parquet(f"{target}/_marks/{batch_id}")

    return run_batches(arrived, checkpoint, handle)


def _newest(batches: Iterable[pd.DataFrame], key: str, order: list[str]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.sort_values(order, kind="stable", na_position="first").drop_duplicates(key, keep="last")


def _first_of_days(batches: Iterable[pd.DataFrame], key: list[str], ts: str) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ordered = batch.sort_values(ts, kind="stable")
        yield ordered[~ordered.assign(_day=ordered[ts].dt.floor("D")).duplicated([*key, "_day"])]


class _MarkChanges(StatefulProcessor):
    """State: the latest time of a key."""

    def __init__(self, ts: str, order: list[str], kind: str):
        self.ts, self.order, self.kind = ts, order, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", f"ts {self.kind}")

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.latest.update((initialState[self.ts].iloc[0].to_pydatetime(),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        newest = pd.concat(list(rows)).sort_values(self.order, kind="stable", na_position="first").tail(1)
        before = self.latest.get()[0] if self.latest.exists() else None
        now = newest[self.ts].iloc[0]
        change = "new" if before is None else "updated" if pd.notna(now) and before < now else "unchanged"
        if pd.notna(now) and change != "unchanged":
            self.latest.update((now.to_pydatetime(),))
        yield newest.assign(**{f"stored_{self.ts}": pd.Series([before], index=newest.index, dtype="datetime64[us]"), "change": change})

    def close(self) -> None:
        pass


class _KeepOnce(StatefulProcessor):
    """State: the day of the last kept record of a key, with a timer at the end of its time."""

    def __init__(self, ts: str, days: int):
        self.ts, self.days = ts, days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.kept = handle, handle.getValueState("kept", "day int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        found = pd.concat(list(rows)).sort_values(self.ts, kind="stable")
        kept = self.kept.get()[0] if self.kept.exists() else None
        take = []
        for day in found[self.ts].astype("datetime64[s]").astype("int64") // 86_400:
            take.append(kept is None or day > kept + self.days)
            kept = int(day) if take[-1] else kept
        if any(take):
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.kept.update((kept,))
            self.handle.registerTimer((kept + self.days + 2) * 86_400_000)  # in any time zone not before the time is over
        yield found[take]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.kept.clear()
        return iter(())

    def close(self) -> None:
        pass
