"""Deduplication, early stops, priorities and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import dedup as D
from millrace.operators import paging as W
from millrace.plans.catalog import query
from millrace.plans.roles import STOP_DATE, SUMMARY_STOP, Roles, ts
from millrace.session import cut_lineage


@query("dedup_first", """
SELECT body_md5, doc_id FROM (SELECT md5(body) AS body_md5, doc_id, row_number() OVER
  (PARTITION BY md5(body) ORDER BY pubdate, doc_id) AS rn FROM articles) WHERE rn = 1""", "articles")
def dedup_first(r: Roles):
    rows = r.articles.select(F.md5("body").alias("body_md5"), "doc_id", "pubdate")
    return D.dedup_first(rows, ["body_md5"], ["pubdate", "doc_id"]).select("body_md5", "doc_id")


@query("dedup_last", """
SELECT item_id, event_id, process_type FROM (SELECT *, row_number() OVER
  (PARTITION BY item_id ORDER BY update_time DESC, event_id DESC) AS rn FROM items) WHERE rn = 1""", "items")
def dedup_last(r: Roles):
    return D.dedup_last(r.items, ["item_id"], ["update_time", "event_id"]).select("item_id", "event_id", "process_type")


@query("early_stop", f"""
SELECT question_id, place FROM list_pages WHERE place < (SELECT coalesce(min(place), 1e18) FROM list_pages
  WHERE update_time <= TIMESTAMP '{STOP_DATE}')""", "list_pages")
def early_stop(r: Roles):
    entries = r.list_pages()
    return W.stop_at_date(entries, ["place"], "update_time", ts(STOP_DATE)).select("question_id", "place")


@query("early_stop_count", f"""
WITH a AS (SELECT *, sum(unchanged::INT) OVER (PARTITION BY page ORDER BY pos) AS seen FROM list_pages),
b AS (SELECT *, coalesce(sum(unchanged::INT) OVER (PARTITION BY page100 ORDER BY pos100
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 25 AND update_time < TIMESTAMP '{SUMMARY_STOP}'
        AS stop FROM list_pages),
c AS (SELECT *, max(stop::INT) OVER (PARTITION BY page100 ORDER BY pos100) AS stopped FROM b)
SELECT 'after' AS mode, question_id, page, pos FROM a WHERE seen <= 15
UNION ALL SELECT 'before', question_id, page100, pos100 FROM c WHERE stopped = 0""", "list_pages")
def early_stop_count(r: Roles):
    columns = ["mode", "question_id", "page", "pos"]
    ranked = cut_lineage(r.ranked_list())  # read for both kinds of pages
    after = W.stop_after_unchanged(r.list_pages(ranked=ranked), 15, ["page"], ["pos"])
    recent = F.col("update_time") >= ts(SUMMARY_STOP)
    before = W.stop_after_unchanged(r.list_pages(100, ranked), 25, ["page"], ["pos"], recent)
    return after.withColumn("mode", F.lit("after")).select(*columns).unionByName(
        before.withColumn("mode", F.lit("before")).select(*columns)
    )


@query("first_unchanged_stop", """
WITH s AS (SELECT question_id, section, update_time, NOT imported AND view_count < 200000 AS unchanged,
                  view_count < 100000 AS sticky FROM questions),
r AS (SELECT *, max((unchanged AND NOT sticky)::INT) OVER (PARTITION BY section ORDER BY update_time, question_id)
      AS stopped FROM s)
SELECT question_id, section FROM r WHERE stopped = 0 AND NOT (unchanged AND sticky)""", "questions")
def first_unchanged_stop(r: Roles):
    rows = r.questions.select(
        "question_id", "section", "update_time",
        (~F.col("imported") & (F.col("view_count") < 200_000)).alias("unchanged"),
        (F.col("view_count") < 100_000).alias("sticky"),
    )
    return W.stop_at_unchanged(rows, ["section"], ["update_time", "question_id"]).select("question_id", "section")


@query("fetch_priority", """
WITH n AS (SELECT page, count(*) AS n FROM list_pages GROUP BY 1),
k AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY pos) AS k FROM list_pages WHERE NOT unchanged)
SELECT page, question_id, n * 20 - 10 * (k - 1) AS qa, n - (k - 1) AS forum FROM k JOIN n USING (page)
UNION ALL SELECT page, NULL, -1, -1 FROM n""", "list_pages")
def fetch_priority(r: Roles):
    entries = cut_lineage(r.list_pages())
    kept = entries.filter("NOT unchanged").select("page", "pos", "question_id")
    qa = W.fetch_priority(entries, kept, "page", ["pos"], "qa").withColumnRenamed("priority", "qa")
    both = W.fetch_priority(entries, qa, "page", ["pos"], "forum").withColumnRenamed("priority", "forum")
    last = F.lit(W.NEXT_PAGE_PRIORITY).cast("long")
    pages = entries.select("page").distinct().select(
        "page", F.lit(None).cast("long").alias("question_id"), last.alias("qa"), last.alias("forum")
    )
    return both.select("page", "question_id", "qa", "forum").unionByName(pages)


@query("batch_drain", """
SELECT question_id, ((row_number() OVER (ORDER BY question_id) - 1) // 1000 + 1)::BIGINT AS batch FROM questions
WHERE NOT imported""", "questions")
def batch_drain(r: Roles):
    return W.batch_numbers(r.questions.filter("NOT imported").select("question_id"), ["question_id"])


@query("latest_n", """
SELECT source_site, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source_site ORDER BY pubdate DESC, doc_id)
  AS rn FROM articles) WHERE rn <= 6
UNION ALL SELECT 'all', doc_id FROM (SELECT doc_id FROM articles ORDER BY pubdate DESC, doc_id LIMIT 6)""", "articles")
def latest_n(r: Roles):
    rows = r.articles.select("source_site", "doc_id", "pubdate")
    overall = W.top_n(rows, 6, ["-pubdate", "doc_id"]).withColumn("source_site", F.lit("all"))
    return W.top_n(rows, 6, ["-pubdate", "doc_id"], ["source_site"]).unionByName(overall).select("source_site", "doc_id")


SECTIONS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


@query("section_progress", """
SELECT section, questions, CASE WHEN section < '5' THEN substr(section, 1, 1)::BIGINT - 1 END AS index,
       CASE section WHEN '1-URGENT' THEN '2-HIGH' WHEN '2-HIGH' THEN '3-MEDIUM' WHEN '3-MEDIUM' THEN '4-NOT SPECIFIED'
       END AS next_section, CASE WHEN section < '5' THEN section = '4-NOT SPECIFIED' END AS all_finished
FROM (SELECT section, count(*) AS questions FROM questions GROUP BY 1)""", "questions")
def section_progress(r: Roles):
    state = r.questions.groupBy("section").agg(F.count(F.lit(1)).alias("questions"))
    return W.section_progress(state, SECTIONS)
