"""Streams over several files and runs equal the batch operators."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.changes import classify_changes
from millrace.operators.dedup import dedup_first
from millrace.operators.upserts import fold_writes
from millrace.session import scratch_path
from millrace.streaming import jobs
from millrace.streaming.keyed import KeyedTable, names_in

SCHEMA = "id long, t timestamp_ntz, title string, views long, seq long"


@pytest.fixture()
def source(spark):
    """Five files of writes in arrival order, a third of them for one id."""
    rng = random.Random(9)
    path, frames, seq = scratch_path(spark, "source"), [], 0
    for _ in range(5):
        data = []
        for _ in range(60):
            seq += 1
            key = 1 if rng.random() < 0.35 else rng.randrange(2, 30)
            data.append((key, f"2020-01-{1 + seq // 20:02d} 00:00:{seq % 60:02d}", f"t{seq}", rng.randrange(100), seq))
        df = spark.createDataFrame(data, "id long, t string, title string, views long, seq long")
        df = df.withColumn("t", F.col("t").cast("timestamp_ntz")).coalesce(1)
        df.write.mode("append").parquet(path)
        frames.append(df)
    return path, frames


def read(spark, path):
    return jobs.read_files(spark, path, spark.read.parquet(path).schema, per_batch=1)


def folders(spark):
    return scratch_path(spark, "out"), scratch_path(spark, "checkpoint")


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("every", [2, 100])
def test_dedup_keeps_the_first_record_across_batches_and_runs(spark, source, every):
    path, frames = source
    out, checkpoint = folders(spark)
    table = KeyedTable(spark, out, ("id",))
    for _ in range(2):
        jobs.stream_dedup(read(spark, path), out, checkpoint, ["id"], ["seq"], every)
    want = dedup_first(spark.read.parquet(path), ["id"], ["seq"])
    assert rows(table.rows().select(*want.columns)) == rows(want)
    frames[0].withColumn("id", F.col("id") + 1000).write.mode("append").parquet(path)
    frames[0].withColumn("seq", F.lit(-1).cast("long")).write.mode("append").parquet(path)  # known keys, though earlier in order
    jobs.stream_dedup(read(spark, path), out, checkpoint, ["id"], ["seq"], every)
    assert table.rows().count() == spark.read.parquet(path).select("id").distinct().count()
    assert table.rows().where("seq < 0").isEmpty()


def test_dedup_within_days_takes_a_key_again_later(spark):
    days = [(1, 1, 9), (1, 5, 8), (1, 31, 7), (2, 3, 6), (1, 32, 5), (1, 32, 4), (1, 40, 3), (1, 62, 2), (1, 63, 1), (None, 2, 0), (None, 30, 0)]
    path, (out, checkpoint) = scratch_path(spark, "days"), folders(spark)
    for part in (days[:3], days[3:8], days[8:9], days[9:]):
        data = [(k, f"2020-01-01 {h:02d}:00:00", d) for k, d, h in part]
        df = spark.createDataFrame(data, "id long, t string, d int").select("id", (F.col("t").cast("timestamp_ntz") + F.make_dt_interval(F.col("d") - 1)).alias("t"))
        df.coalesce(1).write.mode("append").parquet(path)
        jobs.run_available(jobs.stream_dedup_within(read(spark, path), ["id"], "t", 30, 100), out, checkpoint)
    got = [(r["id"], r["t"].timetuple().tm_yday, r["t"].hour) for r in spark.read.parquet(out).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, 9), (1, 32, 4), (1, 63, 1), (2, 3, 6), (None, 2, 0)], key=str)


def test_state_of_a_key_is_dropped_behind_the_watermark(spark):
    path, (out, checkpoint) = scratch_path(spark, "days"), folders(spark)
    for day in ("2020-01-01", "2020-06-01", "2020-06-02"):
        spark.createDataFrame([(int(day[6]), day)], "id long, t string").select("id", F.col("t").cast("timestamp_ntz").alias("t")).write.mode("append").parquet(path)
        jobs.run_available(jobs.stream_dedup_within(read(spark, path), ["id"], "t", 30, 1), out, checkpoint)
    state = spark.read.format("statestore").option("stateVarName", "kept").load(checkpoint)
    assert [r["key"]["id"] for r in state.collect()] == [6]


def test_upsert_stream_equals_batch(spark, source):
    path, _ = source
    log, checkpoint = folders(spark)
    policy = ["views", "t"]
    for _ in range(2):
        jobs.stream_upsert(read(spark, path), log, checkpoint, ["id"], policy, ["seq"])
    got = jobs.current_rows(spark, log, ["id"], policy)
    assert len([n for n in names_in(spark, log) if n.startswith("_batch=")]) == 5
    want = fold_writes(spark.read.parquet(path), ["id"], ["seq"], policy)
    assert rows(got.select("id", "views", "t", "title")) == rows(want.select("id", "views", "t", "title"))


def test_replayed_batch_changes_nothing(spark, source):
    path, frames = source
    log, _ = folders(spark)
    table = KeyedTable(spark, log, ("id",), ("views",))
    both = frames[0].unionByName(frames[1])
    want = fold_writes(both, ["id"], ["seq"], ["views"])
    for compact in (False, True):
        for batch, df in [(0, frames[0]), (1, frames[1]), (1, frames[1])]:
            table.append(df, batch, ["seq"])
        assert rows(table.rows().select("id", "views", "title")) == rows(want.select("id", "views", "title"))
        table.compact()


def test_compaction_rewrites_touched_buckets_only(spark, source):
    _, frames = source
    log, _ = folders(spark)
    table = KeyedTable(spark, log, ("id",), ("views",), buckets=8)
    assert table.rows() is None and table.compact() == []
    table.append(frames[0], 0, ["seq"])
    first = table.compact()
    assert first == sorted(r[0] for r in frames[0].select(table.bucket()).distinct().collect())
    one = frames[1].where("id = 1")
    table.append(one, 1, ["seq"])
    assert table.compact() == [r[0] for r in one.select(table.bucket()).distinct().collect()]
    pointer = table.pointer()
    assert pointer.folded == 1 and sorted(set(pointer.buckets.values())) == [1, 2] and list(pointer.buckets.values()).count(2) == 1
    files = {f.split("/_base/")[1].split("/part")[0] for f in table.rows().inputFiles()}
    assert files == {f"_version={v}/_bucket={b}" for b, v in pointer.buckets.items()}
    want = fold_writes(frames[0].unionByName(one), ["id"], ["seq"], ["views"])
    assert rows(table.rows().select(*want.columns)) == rows(want)
    keys = spark.createDataFrame([(1,), (99,)], "id long")
    assert [r["id"] for r in table.lookup(keys).collect()] == [1]
    buckets = {r[0] for r in keys.select(table.bucket()).collect()}
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in table.lookup(keys).inputFiles()} <= buckets


def test_a_compaction_that_breaks_off_loses_nothing(spark, source, monkeypatch):
    _, frames = source
    log, _ = folders(spark)
    table = KeyedTable(spark, log, ("id",), ("views", "t"))
    table.append(frames[0], 0, ["seq"])
    table.compact()
    table.append(frames[1], 1, ["seq"])
    want = rows(table.rows().select("id", "views", "t", "title", "seq"))
    with monkeypatch.context() as broken:
        broken.setattr(KeyedTable, "_point", lambda self, new: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.compact()
    assert table.pointer().version == 1 and rows(table.rows().select("id", "views", "t", "title", "seq")) == want
    table.compact()
    assert table.pointer().version == 2 and rows(table.rows().select("id", "views", "t", "title", "seq")) == want
    table.append(frames[2], 1, ["seq"])  # a replay of a folded batch
    assert rows(table.rows().select("id", "views", "t", "title", "seq")) == want


def test_changes_follow_earlier_batches(spark, source):
    path, frames = source
    log, checkpoint = folders(spark)
    stored = frames[0].groupBy("id").agg(F.max("t").alias("t")).filter("id < 10")
    jobs.stream_changes(read(spark, path), stored, log, checkpoint, "id", "t", ["seq"])
    got = spark.read.parquet(log)
    known = stored
    for batch in range(5):
        mine = got.filter(F.col("_batch") == batch)
        again = classify_changes(mine.select("id", "t"), known, "id", "t").select("id", "change")
        assert rows(mine.select("id", "change")) == rows(again)
        known = known.unionByName(mine.select("id", "t")).groupBy("id").agg(F.max("t").alias("t"))


def test_publish_skips_what_is_published(spark, source):
    path, _ = source
    log, checkpoint = folders(spark)
    published = spark.createDataFrame([(1,), (2,)], "id long")
    jobs.stream_publish(read(spark, path), log, checkpoint, "id", ["seq"], published)
    docs = jobs.current_rows(spark, log, ["id"], ["title", "views", "t", "seq"])
    want = spark.read.parquet(path).filter("id > 2").groupBy("id").agg(F.max("seq").alias("seq"))
    assert rows(docs.select("id", "seq")) == rows(want)


def test_late_records_go_to_the_reject_side(spark, source):
    path, _ = source
    out, checkpoint = folders(spark)
    now = F.lit("2020-01-20 00:00:00").cast("timestamp_ntz")
    jobs.run_available(jobs.stream_late_drop(read(spark, path), "t", now, 9), out, checkpoint, ["kept"])
    got = spark.read.parquet(out)
    assert got.count() == spark.read.parquet(path).count()
    assert got.filter("kept = 'true'").count() == spark.read.parquet(path).filter("t > timestamp_ntz'2020-01-10 00:00:00'").count()


def test_changes_cost_what_a_batch_brings(spark, source):
    """The plan of a batch reads the batch and the state, and the stored table in the first batch only."""
    path, frames = source
    log, checkpoint = folders(spark)
    stored = spark.createDataFrame([(1, "2019-01-01 00:00:00")], "id long, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    for _ in range(2):
        jobs.stream_changes(read(spark, path), stored, log, checkpoint, "id", "t", ["seq"])
    assert spark.read.parquet(log).where("id = 1 AND change = 'new'").isEmpty()
    before = spark.read.parquet(log).count()
    frames[0].withColumn("t", F.lit("2021-01-01").cast("timestamp_ntz")).write.mode("append").parquet(path)
    jobs.stream_changes(read(spark, path), stored.limit(0), log, checkpoint, "id", "t", ["seq"])
    more = spark.read.parquet(log).where("t > timestamp_ntz'2020-12-31 00:00:00'")
    assert spark.read.parquet(log).count() - before == more.count() == frames[0].select("id").distinct().count()
    assert more.where("change <> 'updated'").isEmpty()


def test_newer_versions_are_published_again(spark, source):
    path, frames = source
    log, checkpoint = folders(spark)
    run = lambda: jobs.stream_publish(read(spark, path), log, checkpoint, "id", ["seq"], compact_every=3)
    run()
    batches = lambda: {n for n in names_in(spark, log) if n.startswith("_batch=")}
    frames[0].write.mode("append").parquet(path)  # old versions
    old = batches()
    run()
    assert all(names_in(spark, f"{log}/{n}") == ["_SUCCESS"] for n in batches() - old)
    frames[0].withColumn("seq", F.col("seq") + 1000).withColumn("title", F.lit("again")).write.mode("append").parquet(path)
    run()
    docs = jobs.current_rows(spark, log, ["id"], ["title", "views", "t", "seq"])
    assert docs.where("title = 'again'").count() == frames[0].select("id").distinct().count()
    assert docs.count() == spark.read.parquet(path).select("id").distinct().count()


def test_scheduled_run_starts_from_the_mark_of_the_target(spark, source):
    path, frames = source
    out, checkpoint = folders(spark)
    schema = spark.read.parquet(path).schema
    run = lambda: jobs.run_once(spark, path, schema, "*.parquet", "t", out, checkpoint)
    assert jobs.high_mark(spark, out, "t") is None
    run(), run()
    assert spark.read.parquet(out).count() == 300
    frames[4].write.mode("append").parquet(path)  # nothing newer than what is there
    run()
    assert spark.read.parquet(out).count() == 300
    frames[4].withColumn("t", F.col("t") + F.expr("INTERVAL 1 DAY")).write.mode("append").parquet(path)
    newest = frames[4].agg(F.max("t")).first()[0]
    run()
    assert spark.read.parquet(out).count() == 300 + frames[4].where((F.col("t") + F.expr("INTERVAL 1 DAY")) > F.lit(newest)).count()
