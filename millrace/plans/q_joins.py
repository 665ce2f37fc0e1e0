"""Joins over the role tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.dates import format_ts
from millrace.operators import changes as C
from millrace.operators import joins as J
from millrace.operators.dedup import drop_seen, drop_unchanged
from millrace.operators.documents import CHUNK, concat_children
from millrace.plans.catalog import query
from millrace.plans.roles import NOW_EVENTS, Roles, ts


@query("list_detail_join", """
SELECT question_id, page, pos, link, title, score FROM list_pages JOIN questions USING (question_id)""",
       "questions list_pages")
def list_detail_join(r: Roles):
    link = F.concat(F.lit("/questions/"), "question_id", F.lit("/q.html"))
    entries = r.list_pages().select("question_id", "page", "pos", link.alias("link"))
    return J.join_detail(entries, r.questions.select("link", "title", "score"))


CHANGE_SQL = """SELECT i.*, CASE WHEN s.update_time IS NULL THEN 'new' WHEN s.update_time < i.update_time
    THEN 'updated' ELSE 'unchanged' END AS change FROM incoming_items i LEFT JOIN stored_items s USING (item_id)"""


@query("change_class", f"SELECT event_id, item_id, change FROM ({CHANGE_SQL})", "incoming_items stored_items")
def change_class(r: Roles):
    return C.classify_changes(r.incoming_items, r.stored_items, "item_id", "update_time").select(
        "event_id", "item_id", "change"
    )


@query("need_fetch", f"""
SELECT event_id, item_id, false AS forced FROM ({CHANGE_SQL}) WHERE change <> 'unchanged'
UNION ALL SELECT event_id, item_id, true FROM incoming_items""", "incoming_items stored_items")
def need_fetch(r: Roles):
    runs = [
        C.need_fetch(r.incoming_items, r.stored_items, "item_id", "update_time", force)
        .select("event_id", "item_id", F.lit(force).alias("forced"))
        for force in (False, True)
    ]
    return runs[0].unionByName(runs[1])


@query("seen_anti", """
SELECT doc_id, url FROM articles WHERE doc_id NOT IN (SELECT doc_id FROM labels)""", "articles")
def seen_anti(r: Roles):
    seen = r.table("labels").select(F.concat(F.lit("/article/"), "doc_id", F.lit(".html")).alias("url"))
    return drop_seen(r.articles.select("doc_id", "url"), seen, "url")


@query("recent_anti", f"""
SELECT event_id, crawlkey, link FROM (
  SELECT event_id, process_type AS crawlkey, 'item/' || item_id AS link, update_time,
         row_number() OVER (PARTITION BY process_type, item_id ORDER BY update_time, event_id) AS rn
  FROM incoming_items) AS i
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM items s WHERE s.update_time < TIMESTAMP '2024-01-11'
  AND s.update_time >= TIMESTAMP '{NOW_EVENTS}' - INTERVAL 25 DAY
  AND s.process_type = i.crawlkey AND 'item/' || s.item_id = i.link)""", "items incoming_items")
def recent_anti(r: Roles):
    as_news = lambda df: df.select(
        "event_id", F.col("process_type").alias("crawlkey"), F.concat(F.lit("item/"), "item_id").alias("link"),
        F.col("update_time").alias("pubdate"),
    )
    stored = as_news(r.items.filter(F.col("update_time") < ts("2024-01-11 00:00:00")))
    fresh = C.drop_recent(
        as_news(r.incoming_items), stored, ["crawlkey", "link"], ["pubdate", "event_id"], "pubdate", ts(NOW_EVENTS), 25
    )
    return fresh.select("event_id", "crawlkey", "link")


@query("rule_page_join", "SELECT page_id, url, name, source_site FROM matched", "matched")
def rule_page_join(r: Roles):
    return J.match_rules(r.pages.select("page_id", "url"), r.rules).select("page_id", "url", "name", "source_site")


@query("accepted_answer", """
SELECT question_id, accept_id, a.body AS accepted_body, a.score AS accepted_score
FROM qa LEFT JOIN answers a ON accept_id = answer_id""", "qa")
def accepted_answer(r: Roles):
    questions = r.accepts.select("question_id", "accept_id")
    return J.join_accepted(questions, r.qa_posts)


@query("answers_by_id_list", """
SELECT question_id, (rn - 1)::BIGINT AS pos, post_id, body FROM (
  SELECT parent_id AS question_id, answer_id::VARCHAR AS post_id, body,
         row_number() OVER (PARTITION BY parent_id ORDER BY post_number) AS rn FROM answers)""", "answers")
def answers_by_id_list(r: Roles):
    lists = concat_children(r.stored_answers, ["parent_id"], "answer_id", ["post_number"], "ids", numbered=True)
    questions = lists.select(
        F.col("parent_id").alias("question_id"), "part",  # an id without a row ends each list
        F.concat("ids", F.when(F.size(F.split("ids", ",")) < CHUNK, ",-1").otherwise("")).alias("answer_ids"),
    )
    return J.join_id_list(questions, r.qa_posts).select(
        "question_id", F.col("pos").cast("long").alias("pos"), F.col("post_id").cast("string").alias("post_id"), "body"
    )


@query("comments_join", """
SELECT post_id, (rn - 1)::BIGINT AS pos, comment_id::VARCHAR AS comment_id, body,
       strftime(creation_time, '%Y-%m-%d %H:%M:%S') AS creation_time
FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY comment_id) AS rn FROM comments)""", "comments")
def comments_join(r: Roles):
    lists = concat_children(r.comments, ["post_id"], "comment_id", ["comment_id"], "comment_ids")
    joined = J.join_comments(lists, r.comments)
    return joined.select(
        "post_id", F.col("pos").cast("long").alias("pos"), F.col("comment_id").cast("string").alias("comment_id"), "body",
        format_ts("creation_time").alias("creation_time"),
    )


@query("tag_bridge", "SELECT post_id, tag_id FROM post_tags", "post_tags")
def tag_bridge(r: Roles):
    lines = r.table("lineitem").select(F.col("l_orderkey").alias("post_id"), "l_partkey", "l_returnflag")
    brands = r.table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("tag_id"))
    pairs = lines.join(brands, "l_partkey").select("post_id", "tag_id", "l_returnflag")
    existing = pairs.filter("l_returnflag = 'A'").select("post_id", "tag_id").distinct()
    return J.insert_pairs(existing, pairs)


@query("id_conflict", """
SELECT answer_id, parent_id FROM answers WHERE answer_id IN (SELECT question_id FROM questions)""",
       "questions answers")
def id_conflict(r: Roles):
    return J.id_conflicts(r.answers, r.questions).select("answer_id", "parent_id")


@query("drop_unchanged", """
SELECT question_id FROM questions WHERE (question_id, update_time) NOT IN (SELECT id, update_time FROM stored_posts)""",
       "questions stored_posts")
def unchanged(r: Roles):
    stored = r.stored_posts.withColumnRenamed("id", "question_id")
    return drop_unchanged(r.questions, stored, ["question_id"], "update_time").select("question_id")
