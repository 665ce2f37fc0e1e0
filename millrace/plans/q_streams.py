"""Streaming jobs over the given tables, run until all input is taken.

Each writes to fresh folders in the shared folder and returns the resulting table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import format_ts
from millrace.plans.catalog import query
from millrace.plans.roles import NOW_EVENTS, Roles, ts
from millrace.session import scratch_path
from millrace.streaming import jobs
from millrace.streaming.keyed import KeyedTable


RUNS = 3


def arrivals(r: Roles, rows: DataFrame, part: Column, job: Callable[[DataFrame], object]) -> None:
    """Lets the rows of parts 0, 1, 2 arrive in a folder one after the other; the job runs on the stream after each."""
    source = scratch_path(r.spark, "arrivals")
    for k in range(RUNS):
        rows.where(part == k).write.mode("append").parquet(source)
        job(jobs.read_files(r.spark, source, rows.schema))


def folders(r: Roles, name: str) -> tuple[str, str]:
    return scratch_path(r.spark, name), scratch_path(r.spark, f"{name}-checkpoint")


def third(column: str) -> Column:
    return F.pmod(column, F.lit(RUNS))


@query("stream_dedup", """
SELECT user_id, event_type, arg_min(event_id, (event_id % 3, event_id)) AS event_id FROM events GROUP BY ALL""")
def stream_dedup(r: Roles):
    out, checkpoint = folders(r, "dedup")
    key = ["user_id", "event_type"]
    events = r.table("events").select(*key, "event_id")
    arrivals(r, events, third("event_id"), lambda s: jobs.stream_dedup(s, out, checkpoint, key, ["event_id"], compact_every=2))
    return KeyedTable(r.spark, out, tuple(key)).rows()


@query("stream_dedup_30d", """
WITH d AS (SELECT user_id, ts::DATE AS day, min(ts) AS ts FROM events GROUP BY ALL),
kept AS (SELECT user_id, min(day) AS day FROM d GROUP BY 1
         UNION ALL SELECT user_id, n FROM (SELECT kept.user_id, (SELECT min(day) FROM d WHERE d.user_id = kept.user_id AND d.day > kept.day + 7) AS n FROM kept)
         WHERE n IS NOT NULL)
SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM kept JOIN d USING (user_id, day)""", recursive=True)
def stream_dedup_30d(r: Roles):
    out, checkpoint = folders(r, "dedup30")
    events = r.table("events").select("user_id", "ts")
    part = F.floor(F.dayofmonth("ts") / 11)
    arrivals(r, events, part, lambda s: jobs.run_available(jobs.stream_dedup_within(s, ["user_id"], "ts", 7), out, checkpoint))
    return r.spark.read.parquet(out).select("user_id", format_ts("ts").alias("ts"))


@query("stream_upsert", """
SELECT item_id, arg_min(process_type, (event_id % 3, update_time, event_id)) AS process_type,
       arg_max(view_count, (event_id % 3, update_time, event_id)) AS view_count,
       strftime(arg_max(update_time, (event_id % 3, update_time, event_id)), '%Y-%m-%d %H:%M:%S') AS update_time FROM items GROUP BY 1""", "items")
def stream_upsert(r: Roles):
    log, checkpoint = folders(r, "upsert")
    policy = ["update_time", "view_count", "event_id"]
    order = ["update_time", "event_id"]
    arrivals(r, r.items, third("event_id"), lambda s: jobs.stream_upsert(s, log, checkpoint, ["item_id"], policy, order, compact_every=2))
    rows = jobs.current_rows(r.spark, log, ["item_id"], policy)
    return rows.select("item_id", "process_type", "view_count", format_ts("update_time").alias("update_time"))


@query("stream_changes", """
SELECT item_id, event_id, CASE WHEN known IS NULL THEN 'new' WHEN known < update_time THEN 'updated' ELSE 'unchanged' END AS change
FROM (SELECT i.*, greatest(s.update_time, max(i.update_time) OVER (PARTITION BY item_id ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS known
      FROM (SELECT *, event_id % 3 AS part, row_number() OVER (PARTITION BY item_id, event_id % 3 ORDER BY update_time DESC, event_id DESC) AS rn FROM items) AS i
      LEFT JOIN stored_items s USING (item_id) WHERE rn = 1)""", "items stored_items")
def stream_changes(r: Roles):
    log, checkpoint = folders(r, "changes")
    items, order = r.items.select("item_id", "update_time", "event_id"), ["update_time", "event_id"]
    arrivals(r, items, third("event_id"), lambda s: jobs.stream_changes(s, r.stored_items, log, checkpoint, "item_id", "update_time", order))
    return r.spark.read.parquet(log).select("item_id", "event_id", "change")


@query("stream_publish", """
SELECT question_id, title FROM questions WHERE question_id NOT IN (SELECT id FROM stored_posts WHERE view_count > 100000)""",
       "questions stored_posts")
def stream_publish(r: Roles):
    log, checkpoint = folders(r, "publish")
    docs = r.questions.select("question_id", "title", "update_time")
    published = r.stored_posts.filter("view_count > 100000").select(F.col("id").alias("question_id"))
    arrivals(r, docs, third("question_id"), lambda s: jobs.stream_publish(s, log, checkpoint, "question_id", ["update_time"], published, compact_every=2))
    return jobs.current_rows(r.spark, log, ["question_id"], ["title", "update_time"]).select("question_id", "title")


@query("stream_late_drop", f"""
SELECT event_id, ts > TIMESTAMP '{NOW_EVENTS}' - INTERVAL 21 DAY AS kept,
       CASE WHEN ts <= TIMESTAMP '{NOW_EVENTS}' - INTERVAL 21 DAY THEN 'too_old' END AS reject_reason FROM events""")
def stream_late_drop(r: Roles):
    out, checkpoint = folders(r, "late")
    events, now = r.table("events").select("event_id", "ts"), ts(NOW_EVENTS)
    arrivals(r, events, third("event_id"), lambda s: jobs.run_available(jobs.stream_late_drop(s, "ts", now, 20), out, checkpoint, ["kept"]))
    return r.spark.read.parquet(out).select("event_id", F.col("kept").cast("boolean").alias("kept"), "reject_reason")


@query("scheduled_run", "SELECT event_id, user_id FROM events")
def scheduled_run(r: Roles):
    """The first run gets the older half of the time, the second one everything again, the third nothing."""
    source = scratch_path(r.spark, "scheduled-source")
    out, checkpoint = folders(r, "scheduled")
    events = r.table("events").select("event_id", "user_id", "ts")
    half = events.agg((F.min("ts") + (F.max("ts") - F.min("ts")) / 2).alias("t")).scalar()
    for rows in (events.where(F.col("ts") <= half), events, events.limit(0)):
        rows.write.mode("append").parquet(source)
        jobs.run_once(r.spark, source, events.schema, "*.parquet", "ts", out, checkpoint)
    return r.spark.read.parquet(out).select("event_id", "user_id")
