"""Unions, keyed writes and the normalised thread tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.dates import format_ts
from millrace.operators import documents as A
from millrace.operators import upserts as U
from millrace.operators.changes import classify_changes, summary_patches
from millrace.plans.catalog import query
from millrace.plans.roles import Roles
from millrace.session import cut_lineage


@query("union_sources", """
WITH placed AS (SELECT question_id, a.answer_id, a.body, a.score, coalesce(accept_id = answer_id, false) AS accepted, state, imported,
                  row_number() OVER (PARTITION BY question_id ORDER BY coalesce(accept_id <> answer_id, true), post_number) - 1 AS pos
           FROM qa q JOIN answers a ON question_id = parent_id),
said AS (SELECT post_id, count(*) AS n FROM comments GROUP BY 1),
a AS (SELECT question_id, string_agg(body || ':' || accepted || ':' || score || ':' || coalesce(n, 0), '|' ORDER BY pos) AS full_answers,
             string_agg(body || ':' || accepted || ':' || score || ':0', '|' ORDER BY pos) AS plain_answers,
             string_agg(body || ':' || accepted || ':-:0', '|' ORDER BY pos) AS short_answers
      FROM placed LEFT JOIN said ON post_id = answer_id GROUP BY 1),
q AS (SELECT * FROM qa LEFT JOIN a USING (question_id) LEFT JOIN said ON post_id = question_id)
SELECT question_id AS id, 'u3danswers' AS source, score AS favorite_count, NULL AS section, full_answers AS answers, n AS n_comments, NULL AS posts FROM q WHERE state = 'Accepted'
UNION ALL SELECT question_id, 'u3dstack', view_count, NULL, plain_answers, NULL, NULL FROM q WHERE imported
UNION ALL SELECT question_id, 'ueanswers', score, section, short_answers, NULL, NULL FROM q WHERE NOT imported
UNION ALL SELECT discussion_id, 'u3dforum', NULL, NULL, NULL, NULL, string_agg(post_number || ':' || is_staff || ':' || md5(body), '|' ORDER BY post_number) FROM posts GROUP BY 1""",
       "qa comments posts")
def union_sources(r: Roles):
    """Whole documents of four sources; their answers differ in what they hold."""
    picks = {"u3danswers": "state = 'Accepted'", "u3dstack": "imported", "ueanswers": "NOT imported"}
    docs, questions = [], cut_lineage(r.qa)
    for source, condition in picks.items():
        favorite = F.col("view_count" if source == "u3dstack" else "score")
        chosen = questions.filter(condition).withColumn(A.SOURCES[source]["favorite"], favorite)
        built = A.build_qa_docs(chosen, r.qa_posts, r.comments if source == "u3danswers" else None, source, stored=True)
        if source == "ueanswers":
            built = built.withColumn("answers", F.transform("answers", lambda a: a.dropFields("score", "comments")))
        docs.append(built.withColumnRenamed("question_id", "id"))
    ids = A.concat_children(r.posts, ["discussion_id"], "post_id", ["post_number"], "post_ids", numbered=True)
    lists = ids.select("discussion_id", "post_ids", F.when(F.col("part") == 0, "forum").alias("tags"), F.col("part").alias("list_part"))
    docs.append(A.build_forum_docs(lists, r.posts).withColumnRenamed("discussion_id", "id"))
    answer = lambda a: F.concat_ws(":", a["body"], a["is_accepted"].cast("string"), F.coalesce(a["score"].cast("string"), F.lit("-")),
                                   F.coalesce(F.size(a["comments"]), F.lit(0)).cast("string"))
    post = lambda p: F.concat_ws(":", p["post_number"].cast("string"), p["is_staff"].cast("string"), F.md5(p["body"]))
    whole = lambda c, text: F.when(F.size(c) > 0, F.array_join(F.transform(c, text), "|"))
    return A.union_docs(*docs).select(
        "id", "source", "favorite_count", "section", whole("answers", answer).alias("answers"),
        F.when(F.size("comments") > 0, F.size("comments").cast("long")).alias("n_comments"), whole("posts", post).alias("posts"))


POST_COLUMNS = """id, link, title, strftime(creation_time, '%Y-%m-%d') AS creation_time,
    strftime(update_time, '%Y-%m-%d') AS update_time, reply_count, view_count, imported"""


def shown(df, *more: str):
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return df.select(
        "id", "link", "title", day("creation_time"), day("update_time"), "reply_count", "view_count", "imported",
        *more,
    )


def repeated_writes(r: Roles):
    """Incoming posts, the open ones written a second time later in the run."""
    first = r.incoming_posts.withColumn("seq", F.lit(1))
    again = r.incoming_posts.filter("view_count > 250000").withColumns(
        {"seq": F.lit(2), "reply_count": F.lit(9).cast("long"), "link": F.concat(F.lit("/again/"), "id")}
    )
    return first.unionByName(again)


@query("upsert_columns", f"""
SELECT {POST_COLUMNS} FROM (
  SELECT coalesce(s.id, i.id) AS id, coalesce(s.link, i.link) AS link,
         CASE WHEN i.id IS NULL THEN s.title ELSE i.title END AS title,
         coalesce(s.creation_time, i.creation_time) AS creation_time,
         coalesce(i.update_time, s.update_time) AS update_time,
         CASE WHEN i.view_count > 250000 THEN 9 ELSE coalesce(i.reply_count, s.reply_count) END::BIGINT AS reply_count,
         coalesce(i.view_count, s.view_count) AS view_count, coalesce(s.imported, i.imported) AS imported
  FROM stored_posts s FULL JOIN incoming_posts i ON s.id = i.id)""", "stored_posts incoming_posts")
def upsert_columns(r: Roles):
    writes = repeated_writes(r)
    return shown(U.upsert(r.stored_posts, writes, ["id"], U.POLICIES["u3dforum_discussion"], ["seq"]))


REPLACE_SQL = f"""
SELECT {POST_COLUMNS} FROM (
  SELECT * FROM stored_posts WHERE id NOT IN (SELECT id FROM incoming_posts)
  UNION ALL SELECT * REPLACE (CASE WHEN view_count > 250000 THEN '/again/' || id ELSE link END AS link,
                              CASE WHEN view_count > 250000 THEN 9 ELSE reply_count END::BIGINT AS reply_count)
  FROM incoming_posts)"""


@query("upsert_replace", REPLACE_SQL, "stored_posts incoming_posts")
def upsert_replace(r: Roles):
    return shown(U.replace_rows(r.stored_posts, repeated_writes(r), ["id"], ["seq"]))


@query("sparse_patch", f"""
SELECT {POST_COLUMNS}, CASE WHEN touched THEN '2002-01-01' END AS scrapy_time FROM (
  SELECT s.* REPLACE (coalesce(i.view_count, s.view_count) AS view_count,
                      CASE WHEN i.view_count > 250000 THEN 'Popular' ELSE s.title END AS title,
                      CASE WHEN i.id IS NOT NULL THEN false ELSE s.imported END AS imported),
         i.id IS NOT NULL AS touched
  FROM stored_posts s LEFT JOIN incoming_posts i ON s.id = i.id)""", "stored_posts incoming_posts")
def sparse_patch(r: Roles):
    views = F.create_map(F.lit("ViewCount"), F.col("view_count").cast("string"), F.lit("Imported"), F.lit("False"))
    early = r.incoming_posts.select("id", F.lit(1).alias("seq"), F.create_map(F.lit("ViewCount"), F.lit("1"),
                                    F.lit("Imported"), F.lit("True")).alias("patch"))
    late = r.incoming_posts.select("id", F.lit(2).alias("seq"), views.alias("patch"))
    titles = r.incoming_posts.filter("view_count > 250000").select(
        "id", F.lit(3).alias("seq"), F.create_map(F.lit("Title"), F.lit("Popular")).alias("patch")
    )
    patches = early.unionByName(late).unionByName(titles)
    stored = r.stored_posts.withColumn("scrapy_time", F.lit(None).cast("string"))
    columns = {"ViewCount": "view_count", "Title": "title", "Imported": "imported"}
    out = U.apply_patch(stored, patches, "id", columns, ["seq"], ("scrapy_time", F.lit("2002-01-01")))
    return shown(out, "scrapy_time")


@query("summary_refresh", """
SELECT q.question_id, q.view_count::VARCHAR AS view_count, q.score::VARCHAR AS score, 'False' AS imported,
       NULL AS section, false AS fix FROM questions q JOIN stored_posts s ON q.question_id = s.id
WHERE s.update_time >= q.update_time AND s.view_count <> q.view_count
UNION ALL SELECT q.question_id, q.view_count::VARCHAR, q.score::VARCHAR, 'False', section, true
FROM questions q JOIN stored_posts s ON q.question_id = s.id
WHERE s.update_time >= q.update_time AND s.view_count <> q.view_count""", "questions stored_posts")
def summary_refresh(r: Roles):
    new = r.questions.withColumns({"section_link": F.concat(F.lit("/s/"), "section"), "version": F.lit("4.16")})
    stored = r.stored_posts.withColumnRenamed("id", "question_id")
    marked = classify_changes(new, stored, "question_id", "update_time", carry=["view_count"])
    value = lambda name: F.try_element_at("patch", F.lit(name))
    out = [
        summary_patches(marked, fix).select(
            "question_id", value("ViewCount").alias("view_count"), value("Score").alias("score"),
            value("Imported").alias("imported"), value("Section").alias("section"), F.lit(fix).alias("fix"),
        )
        for fix in (False, True)
    ]
    return out[0].unionByName(out[1])


@query("partial_update", """
SELECT question_id AS id, 'question' AS kind, NULL AS parent_id, state = 'Accepted' AS is_accepted, accept_id,
       coalesce(n, 0) AS answer_count FROM qa
LEFT JOIN (SELECT parent_id AS question_id, count(*) AS n FROM answers GROUP BY 1) USING (question_id)
UNION ALL SELECT answer_id + 1000000000, 'answer', parent_id, is_accepted, NULL, 0 FROM answers""", "qa")
def partial_update(r: Roles):
    null = F.lit(None)
    asked = r.questions.select(
        F.col("question_id").alias("id"), F.lit("question").alias("kind"), null.cast("long").alias("parent_id"),
        null.cast("boolean").alias("is_accepted"), null.cast("long").alias("accept_id"),
        F.lit(0).cast("long").alias("answer_count"),
    )
    replies = r.stored_answers.select((F.col("answer_id") + 1_000_000_000).alias("id")).withColumns({
        "kind": F.lit("answer"), "parent_id": null.cast("long"), "is_accepted": null.cast("boolean"),
        "accept_id": null.cast("long"), "answer_count": F.lit(0).cast("long"),
    })
    counts = r.stored_answers.groupBy(F.col("parent_id").alias("id")).agg(F.count(F.lit(1)).alias("answer_count"))
    chosen = A.accepted_id(r.stored_answers).withColumnRenamed("parent_id", "id")
    flags = r.questions.select(F.col("question_id").alias("id"), (F.col("state") == "Accepted").alias("is_accepted"))
    of_questions = flags.join(counts, "id", "left").join(chosen, "id", "left")
    of_answers = r.stored_answers.select((F.col("answer_id") + 1_000_000_000).alias("id"), "parent_id", "is_accepted")
    return U.update_columns(asked, of_questions, "id").unionByName(U.update_columns(replies, of_answers, "id"))


@query("mark_published", """
SELECT question_id, CASE WHEN question_id IN (SELECT id FROM incoming_posts WHERE view_count > 400000) THEN false
       WHEN section = '1-URGENT' THEN true ELSE imported END AS imported FROM questions""", "questions incoming_posts")
def mark_published(r: Roles):
    published = r.questions.filter("section = '1-URGENT'").select("question_id")
    changed = r.incoming_posts.filter("view_count > 400000").select(F.col("id").alias("question_id"))
    return U.mark_published(r.questions.select("question_id", "imported"), published, "question_id", changed)


@query("state_by_section", """
WITH s AS (SELECT section, max(view_count) AS last_discussion_id FROM questions WHERE section > '2' GROUP BY 1),
w AS (SELECT section, 'page/' || max(place) AS last_page_link, strftime(max(update_time), '%Y-%m-%d') AS t
      FROM list_pages GROUP BY 1)
SELECT section, w.last_page_link, CASE WHEN s.section IS NULL THEN 0 ELSE last_discussion_id END AS last_discussion_id,
       t AS last_scraping_time, s.section IS NOT NULL AS finish_once FROM w LEFT JOIN s USING (section)""",
       "questions list_pages")
def state_by_section(r: Roles):
    state = r.questions.filter("section > '2'").groupBy("section").agg(
        F.lit("page/0").alias("last_page_link"), F.max("view_count").alias("last_discussion_id"),
        F.lit("2000-01-01").alias("last_scraping_time"), F.lit(True).alias("finish_once"),
    )
    # One write per list page; only its link and time may change a known section.
    writes = r.list_pages().select(
        "section", F.concat(F.lit("page/"), "place").alias("last_page_link"),
        F.lit(0).cast("long").alias("last_discussion_id"),
        F.date_format("update_time", "yyyy-MM-dd").alias("last_scraping_time"), F.lit(False).alias("finish_once"),
        "place",
    )
    newest = writes.groupBy("section").agg(F.max("last_scraping_time").alias("last_scraping_time"))
    out = U.upsert(state, writes, ["section"], U.POLICIES["section_state"], ["place"])
    return out.drop("last_scraping_time").join(newest, "section")


@query("state_log", """
SELECT 'page' AS kind, NULL AS question_id, 'page/' || page AS link, NULL AS question_update_time, false AS finish,
       'Process URL' AS process_type FROM (SELECT DISTINCT page FROM list_pages)
UNION ALL SELECT 'record', question_id, link, strftime(update_time, '%Y-%m-%d %H:%M:%S'), false, 'Insert or Update'
FROM questions""", "questions list_pages")
def state_log(r: Roles):
    pages = r.list_pages().select("page").distinct().select(
        F.lit("page").alias("kind"), F.lit(None).cast("long").alias("question_id"),
        F.concat(F.lit("page/"), "page").alias("link"), F.lit(False).alias("finish"),
        F.lit("Process URL").alias("process_type"),
    )
    records = r.questions.select(
        F.lit("record").alias("kind"), "question_id", "link", format_ts("update_time").alias("question_update_time"),
        F.lit(False).alias("finish"), F.lit("Insert or Update").alias("process_type"),
    )
    return U.append_log(pages, records)


@query("tag_upsert", """
SELECT tag_id, CASE WHEN size_known THEN '/old/' || tag_id ELSE link END AS link, 'Tag ' || tag_id AS name
FROM (SELECT tag_id, link, tag_id IN (SELECT p_brand FROM part WHERE p_size <= 1) AS size_known FROM tags)""", "tags")
def tag_upsert(r: Roles):
    known = r.table("part").filter("p_size <= 1").select(F.col("p_brand").alias("tag_id")).distinct().select(
        "tag_id", F.concat(F.lit("/old/"), "tag_id").alias("link"), F.col("tag_id").alias("name")
    )
    # Every use of a tag writes it again.
    uses = r.table("part").select(
        F.col("p_brand").alias("tag_id"), F.concat(F.lit("/tags/"), "p_brand").alias("link"),
        F.concat(F.lit("Tag "), "p_brand").alias("name"), F.col("p_partkey").alias("seq"),
    )
    return U.upsert(known, uses, ["tag_id"], U.POLICIES["tag"], ["seq"])


@query("normalize_thread", """
SELECT 'question' AS tbl, question_id::VARCHAR AS key, title AS value FROM questions
UNION ALL SELECT 'content', question_id::VARCHAR, 'true:false' FROM questions
UNION ALL SELECT 'content', answer_id::VARCHAR, 'false:' || coalesce(answer_id = accept_id, false)
          FROM answers JOIN qa ON parent_id = question_id
UNION ALL SELECT 'question_content', question_id::VARCHAR, question_id::VARCHAR FROM questions
UNION ALL SELECT 'question_content', parent_id::VARCHAR, answer_id::VARCHAR FROM answers
UNION ALL SELECT 'question_answer', question_id::VARCHAR, accept_id::VARCHAR FROM qa WHERE accept_id IS NOT NULL
UNION ALL SELECT 'tag', tag_id, tag_id FROM tags WHERE tag_id IN (SELECT tag_id FROM post_tags)
UNION ALL SELECT 'question_tag', post_id::VARCHAR, tag_id FROM post_tags
          WHERE post_id IN (SELECT question_id FROM questions)""", "qa tags")
def normalize_thread(r: Roles):
    answers = A.nest(r.stored_answers, ["parent_id"], F.struct("answer_id", "body"), ["post_number"], "answers", numbered=True)
    threads = r.qa.select(
        "question_id", "title", F.col("title").alias("body"), "accept_id", F.col("list_part").alias("part"),
        F.transform(F.split(F.coalesce("tags", F.lit("")), ","), lambda t: F.struct(t.alias("tag_id"), t.alias("name")))
        .alias("tags"),
    ).join(answers.withColumnRenamed("parent_id", "question_id"), ["question_id", "part"], "left")
    threads = threads.withColumn("tags", F.filter("tags", lambda t: t["tag_id"] != ""))
    flat = U.normalize_thread(threads)
    text = lambda c: F.col(c).cast("string")
    values = {
        "question": ("question_id", F.col("title")),
        "content": ("content_id", F.concat_ws(":", text("is_question"), text("is_answer"))),
        "question_content": ("question_id", text("content_id")),
        "question_answer": ("question_id", text("answer_id")),
        "tag": ("tag_id", F.col("name")),
        "question_tag": ("question_id", F.col("tag_id")),
    }
    tables = [
        flat[name].select(F.lit(name).alias("tbl"), text(key).alias("key"), value.alias("value"))
        for name, (key, value) in values.items()
    ]
    return A.union_docs(*tables)
