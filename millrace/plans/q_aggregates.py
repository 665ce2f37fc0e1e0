"""Aggregations and nested documents; arrays are flattened to text for comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.dates import START_DATE, format_ts
from millrace.operators import documents as A
from millrace.operators import reports as R
from millrace.plans.catalog import query
from millrace.plans.roles import Roles


def flat(array: str, *fields: str):
    """An array of structs as text."""
    text = lambda x: F.concat_ws(":", *[x[f].cast("string") for f in fields])
    return F.array_join(F.transform(array, text), "|")


@query("group_concat", """
SELECT parent_id, ((post_number - 1) // 1000)::BIGINT AS part, string_agg(answer_id::VARCHAR, ',' ORDER BY post_number) AS answer_ids
FROM answers GROUP BY 1, 2""", "answers")
def group_concat(r: Roles):
    return A.concat_children(r.answers, ["parent_id"], "answer_id", ["post_number"], "answer_ids", numbered=True)


@query("nest_children", """
SELECT item_id, ((rn - 1) // 1000)::BIGINT AS part, count(*) AS n,
       string_agg(event_id || ':' || process_type, '|' ORDER BY rn) AS children
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY update_time, event_id) AS rn FROM items)
GROUP BY 1, 2""", "items")
def nest_children(r: Roles):
    value = F.struct("event_id", "process_type")
    nested = A.nest(r.items, ["item_id"], value, ["update_time", "event_id"], "children")
    return nested.select(
        "item_id", "part", F.size("children").cast("long").alias("n"),
        flat("children", "event_id", "process_type").alias("children"),
    )


@query("qa_document", """
WITH talk AS (SELECT post_id, ((rn - 1) // 1000)::BIGINT AS comment_part, string_agg(body, '+' ORDER BY rn) AS said
              FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY creation_time, comment_id) AS rn FROM comments)
              GROUP BY 1, 2),
placed AS (SELECT question_id, answer_id, a.body, a.score, coalesce(accept_id = answer_id, false) AS accepted,
                  row_number() OVER (PARTITION BY question_id ORDER BY coalesce(accept_id <> answer_id, true), post_number) - 1 AS pos
           FROM qa q JOIN answers a ON question_id = parent_id),
flat_answers AS (SELECT question_id, (pos // 1000)::BIGINT AS part, coalesce(comment_part, 0) AS comment_part,
                        string_agg(body || ':' || score || ':' || accepted || ':' || coalesce(said, ''), '|' ORDER BY pos) AS answers
                 FROM placed LEFT JOIN talk ON answer_id = post_id GROUP BY 1, 2, 3)
SELECT question_id, coalesce(part, 0) AS part, coalesce(flat_answers.comment_part, 0) AS comment_part, accept_id IS NOT NULL AS is_accepted,
       CASE WHEN answer_ids IS NULL THEN 0 ELSE len(string_split(answer_ids, ',')) END::BIGINT AS answer_count,
       view_count, 'u3danswers' AS source, coalesce(tags, '') AS tags, coalesce(answers, '') AS answers, title, score, link,
       strftime(update_time, '%Y-%m-%d %H:%M:%S') AS update_time, coalesce(asked.said, '') AS comments
FROM qa LEFT JOIN flat_answers USING (question_id)
LEFT JOIN talk asked ON asked.post_id = question_id AND asked.comment_part = coalesce(flat_answers.comment_part, 0) AND coalesce(part, 0) = 0
WHERE NOT imported""", "qa comments")
def qa_document(r: Roles):
    docs = A.build_qa_docs(r.qa.filter("NOT imported"), r.qa_posts, r.comments)
    said = lambda comments: F.array_join(F.transform(comments, lambda c: c["body"]), "+")
    answers = F.transform(
        "answers",
        lambda a: F.concat_ws(":", a["body"], a["score"].cast("string"), a["is_accepted"].cast("string"), said(a["comments"])),
    )
    return docs.select(
        "question_id", "part", "comment_part", "is_accepted", "answer_count", "view_count", "source",
        F.array_join("tags", ",").alias("tags"), F.array_join(answers, "|").alias("answers"), "title", "score", "link",
        format_ts("update_time").alias("update_time"), said(F.col("comments")).alias("comments"),
    )


@query("forum_document", """
WITH p AS (SELECT *, ((row_number() OVER (PARTITION BY discussion_id ORDER BY post_number) - 1) // 1000)::BIGINT AS part FROM posts),
d AS (SELECT discussion_id, min(post_number) AS first, arg_max(body, post_number) AS last_body,
             arg_min(body, post_number) AS first_body, min(post_id) AS first_id FROM posts GROUP BY 1),
n AS (SELECT discussion_id, part, string_agg(post_number || ':' || is_staff || ':' || md5(body), '|' ORDER BY post_number) AS posts,
             string_agg((post_number + 1) || ':' || is_staff || ':' || md5(body), '|' ORDER BY post_number) AS later_posts
      FROM p GROUP BY 1, 2)
SELECT discussion_id, part, 'forum,' || first_id AS tags, posts, CASE WHEN first = 1 THEN first_body ELSE last_body END AS body
FROM n JOIN d USING (discussion_id)
UNION ALL SELECT discussion_id + 1000000, part, 'forum,' || (first_id + 100000000), later_posts, last_body
FROM n JOIN d USING (discussion_id)""", "posts")
def forum_document(r: Roles):
    # Every thread once as it is, and once without a post number 1.
    shifted = r.posts.select(
        (F.col("discussion_id") + 1_000_000).alias("discussion_id"), (F.col("post_id") + 100_000_000).alias("post_id"),
        (F.col("post_number") + 1).alias("post_number"), "body", "is_staff",
    )
    posts = r.posts.unionByName(shifted)
    ids = A.concat_children(posts, ["discussion_id"], "post_id", ["post_number"], "post_ids", numbered=True)
    tags = F.when(F.col("part") == 0, F.concat(F.lit("forum,"), F.element_at(F.split("post_ids", ","), 1)))
    docs = A.build_forum_docs(ids.select("discussion_id", "post_ids", tags.alias("tags"), F.col("part").alias("list_part")), posts)
    posts_text = F.array_join(
        F.transform("posts", lambda p: F.concat_ws(":", p["post_number"].cast("string"), p["is_staff"].cast("string"),
                                                   F.md5(p["body"]))), "|")
    return docs.select("discussion_id", "part", F.array_join("tags", ",").alias("tags"), posts_text.alias("posts"), "body")


@query("thread_pages_merge", """
SELECT thread_id, ((rn - 1) // 1000)::BIGINT AS part, string_agg(post_id || ':' || kind, '|' ORDER BY rn) AS posts
FROM (SELECT discussion_id AS thread_id, post_id, CASE WHEN post_number = 1 THEN 'question' ELSE 'answer' END AS kind,
             row_number() OVER (PARTITION BY discussion_id ORDER BY post_number) AS rn FROM posts)
GROUP BY 1, 2""", "posts")
def thread_pages_merge(r: Roles):
    number = F.col("post_number")
    page = F.floor((number - 1) / 3).cast("long") + 1
    kind = F.when(number == 1, "question").otherwise("answer")
    shown = r.posts.select(
        F.col("discussion_id").alias("thread_id"), page.alias("page"), number.alias("pos"), kind.alias("post_type"),
        "post_id", "body",
    )
    # The site repeats the question on top of every further page.
    heads = r.posts.filter("post_number = 1").select(
        F.col("discussion_id").alias("thread_id"), F.col("post_id"), F.lit("question").alias("post_type"), "body"
    )
    repeated = shown.filter("page > 1").select("thread_id", "page").distinct().join(heads, "thread_id")
    merged = A.merge_thread_pages(shown.unionByName(repeated.withColumn("pos", F.lit(0).cast("long"))))
    return merged.select("thread_id", "part", flat("posts", "post_id", "post_type").alias("posts"))


@query("accept_id", """
SELECT parent_id, arg_max(answer_id, post_number) FILTER (is_accepted) AS accept_id FROM answers GROUP BY 1""",
       "answers")
def accept_id(r: Roles):
    return A.accepted_id(r.answers)


@query("pending_count", """
SELECT false AS incremental, count(*) AS n FROM questions
UNION ALL SELECT true, count(*) FILTER (NOT imported) FROM questions""", "questions")
def pending_count(r: Roles):
    counts = [R.pending_count(r.questions, inc).select(F.lit(inc).alias("incremental"), "n") for inc in (False, True)]
    return counts[0].unionByName(counts[1])


@query("last_update", f"""
SELECT section, strftime(coalesce(max(update_time) FILTER (state = 'Accepted' AND section <> '5-LOW'),
       TIMESTAMP '{START_DATE}'), '%Y-%m-%d %H:%M:%S') AS last_update FROM questions GROUP BY 1""", "questions")
def last_update(r: Roles):
    done = F.when((F.col("state") == "Accepted") & (F.col("section") != "5-LOW"), F.col("update_time"))
    marks = R.high_watermark(r.questions.withColumn("update_time", done), "section", "update_time")
    return marks.select("section", format_ts("last_update").alias("last_update"))


@query("run_manifest", """
SELECT run, ((rn - 1) // 1000)::BIGINT AS part, string_agg(item_id::VARCHAR, ',' ORDER BY rn) AS ids FROM (
  SELECT run, item_id, row_number() OVER (PARTITION BY run ORDER BY item_id) AS rn
  FROM (SELECT DISTINCT strftime(update_time, '%Y%m%d') AS run, item_id FROM items)) GROUP BY 1, 2""", "items")
def run_manifest(r: Roles):
    touched = r.items.withColumn("run", F.date_format("update_time", "yyyyMMdd"))
    ids = A.run_manifest(touched, "run", "item_id")
    return ids.select("run", "part", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


@query("unchanged_per_page", """
SELECT page, count(*) FILTER (unchanged) AS unchanged, count(*) AS entries FROM list_pages GROUP BY 1""", "list_pages")
def unchanged_per_page(r: Roles):
    return R.unchanged_per_page(r.list_pages(), "page")
