"""Sources and sinks; file formats are written to the shared folder and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from millrace.functions.dates import format_ts, to_epoch
from millrace.operators import documents as A
from millrace.operators.joins import active_rules
from millrace.plans.catalog import query
from millrace.plans.roles import Roles, ts
from millrace.session import cut_lineage, scratch_path
from millrace.sources import api, feeds, pages, records


@query("scan_pages", "SELECT page_id, url, html FROM pages")
def scan_pages(r: Roles):
    return pages.read_pages(r.spark, f"{r.sf_dir}/pages.parquet")


def xml_text(c: str):
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def feed_docs(r: Roles, entry, head: str, foot: str):
    """One XML document per source and block of twenty documents."""
    rows = r.articles.select(
        "source_site", F.floor(F.col("doc_id") / 20).alias("block"), "doc_id", entry.alias("entry")
    )
    return rows.groupBy("source_site", "block").agg(
        F.concat(F.lit(head), F.array_join(A.in_order("doc_id", F.col("entry")), ""), F.lit(foot)).alias("xml")
    )


@query("rss_items", r"""
SELECT source_site AS crawlkey, regexp_replace(title, '^\s+|\s+$', '', 'g') AS title,
       CASE WHEN category = 'es' THEN '' ELSE url END AS link, strftime(pubdate, '%Y-%m-%d %H:%M:%S') AS pubdate
FROM articles""", "articles")
def rss_items(r: Roles):
    link = F.when(F.col("category") != "es", F.concat(F.lit("<link> "), "url", F.lit(" </link>"))).otherwise("")
    entry = F.concat(
        F.lit("<item><title>  "), xml_text("title"), F.lit("\n</title>"), link, F.lit("<pubDate>"),
        format_ts("pubdate"), F.lit("</pubDate></item>"),
    )
    docs = feed_docs(r, entry, '<rss version="2.0"><channel><title>feed</title>', "</channel></rss>")
    items = feeds.parse_rss(docs, "xml", F.col("source_site"))
    return items.withColumn("pubdate", format_ts("pubdate"))


@query("atom_entries", r"""
SELECT 'Article ' || doc_id AS title, url AS link, doc_id::VARCHAR AS id,
       strftime(pubdate, '%Y-%m-%dT%H:%M:%SZ') AS published, strftime(pubdate, '%Y-%m-%d') AS updated
FROM articles""", "articles")
def atom_entries(r: Roles):
    entry = F.concat(
        F.lit("<atom:entry><atom:title>Article "), "doc_id", F.lit('</atom:title><atom:link href="'), "url",
        F.lit('"/><atom:id>'), "doc_id", F.lit("</atom:id><atom:published>"),
        F.date_format("pubdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</atom:published><atom:updated>"),
        F.date_format("pubdate", "yyyy-MM-dd"), F.lit("</atom:updated></atom:entry>"),
    )
    docs = feed_docs(r, entry, '<atom:feed xmlns:atom="http://www.w3.org/2005/Atom">', "</atom:feed>")
    return feeds.parse_atom(docs, "xml")


@query("read_jsonl_state", """
SELECT item_id AS question_id, strftime(update_time, '%Y-%m-%d %H:%M:%S') AS update_time
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY update_time DESC, event_id DESC) AS rn FROM items)
WHERE rn = 1""", "items")
def read_jsonl_state(r: Roles):
    path = scratch_path(r.spark, "state")
    lines = r.items.orderBy("update_time", "event_id").select(
        F.col("item_id").alias("question_id"), format_ts("update_time").alias("update_time")
    )
    records.write_jsonl(lines, path)
    return records.read_jsonl(r.spark, path, "question_id bigint, update_time string", ["question_id"])


@query("write_jsonl", """
SELECT '{"question_id":' || question_id || ',"link":"' || link || '","score":' || score || ',"state":"' || state || '"}'
       AS line FROM questions""", "questions")
def write_jsonl(r: Roles):
    path = scratch_path(r.spark, "jsonl")
    records.write_jsonl(r.questions.select("question_id", "link", "score", "state"), path)
    return r.spark.read.text(path).withColumnRenamed("value", "line")


@query("export_by_crawler", "SELECT doc_id, url, source_site AS crawler FROM articles", "articles")
def export_by_crawler(r: Roles):
    path = scratch_path(r.spark, "export")
    rows = r.articles.select("doc_id", "url", F.col("source_site").alias("crawler"))
    records.export_partitioned(rows, path, "crawler")
    return r.spark.read.schema("doc_id bigint, url string, crawler string").json(path)


INDEXED = ["question_id", "title", "score", "answer_count", "answers"]


def documents(r: Roles, questions, chunk: int, stored: bool = False):
    """Question documents with the fields of their answers that an index takes."""
    questions = questions.select("question_id", "list_part", "title", "score", "accept_id", "answer_ids", "tags")
    docs = A.build_qa_docs(questions, r.qa_posts.select("post_id", "score", "body"), chunk=chunk, stored=stored)
    return docs.withColumn("answers", F.transform("answers", lambda a: F.struct(a["body"].alias("body"), a["score"].alias("score"), a["is_accepted"].alias("is_accepted"))))


@query("bulk_index_lines", """
WITH placed AS (SELECT question_id, a.body, a.score, coalesce(accept_id = answer_id, false) AS accepted,
                  row_number() OVER (PARTITION BY question_id ORDER BY coalesce(accept_id <> answer_id, true), post_number) - 1 AS pos
           FROM qa q JOIN answers a ON question_id = parent_id),
p AS (SELECT question_id, pos // 3 AS part, string_agg('{"body":"' || body || '","score":' || score || ',"is_accepted":' || accepted || '}', ',' ORDER BY pos) AS answers
      FROM placed GROUP BY 1, 2)
SELECT question_id, coalesce(part, 0) AS part, '{"index":{"_index":"spider_u3d_answers","_type":"question_u3danswers","_id":"'
       || question_id || CASE WHEN part > 0 THEN '-' || part || '-0' ELSE '' END || '"}}' || chr(10)
       || '{"question_id":' || question_id || ',"title":"' || title || '","score":' || score || ',"answer_count":'
       || CASE WHEN answer_ids IS NULL THEN 0 ELSE len(string_split(answer_ids, ',')) END || ',"answers":[' || coalesce(answers, '') || ']}' AS lines
FROM qa LEFT JOIN p USING (question_id)""", "qa")
def bulk_index_lines(r: Roles):
    names = A.SOURCES["u3danswers"]
    docs = documents(r, r.qa, 3).withColumn("_id", records.doc_key("question_id"))
    return records.to_bulk_lines(docs, names["index"], names["type"], "_id", INDEXED).select("question_id", "part", "lines")


@query("doc_index_upsert", """
WITH n AS (SELECT question_id, CASE WHEN answer_ids IS NULL THEN 0 ELSE len(string_split(answer_ids, ',')) END AS n FROM qa),
p AS (SELECT question_id, n, unnest(range(0, greatest(1, (n + 1) // 2))) AS part FROM n)
SELECT question_id, question_id || CASE WHEN part > 0 THEN '-' || part || '-0' ELSE '' END AS key,
       CASE WHEN question_id % 3 = 1 OR question_id % 3 = 0 AND n > 1 THEN 2 ELSE 1 END AS version
FROM p WHERE part = 0 OR question_id % 3 <> 0""", "qa")
def doc_index_upsert(r: Roles):
    """The index of all documents, then two thirds of them again: one third with a single answer, one with a new title."""
    questions = cut_lineage(r.qa.withColumn("accept_id", F.lit(None).cast("long")))
    first = records.index_rows(documents(r, questions, 2, True), "question_id", INDEXED)
    kind, leads = F.pmod("question_id", F.lit(3)), F.col("list_part") == 0
    again = questions.withColumns({
        "answer_ids": F.when(kind != 0, F.col("answer_ids")).when(leads, F.substring_index("answer_ids", ",", 1)),
        "title": F.when(kind == 1, F.concat("title", F.lit(" again"))).otherwise(F.col("title")),
    })
    existing = cut_lineage(first.withColumn("version", F.lit(1)))
    changes = records.index_changes(existing, records.index_rows(documents(r, again, 2, True), "question_id", INDEXED))
    after = records.upsert_documents(existing, changes.withColumn("version", F.lit(2)))
    return after.select(F.col("doc_id").alias("question_id"), "key", "version")


@query("rule_source", r"""
SELECT page_id, name, source_site FROM hosts JOIN rules ON host = 'www.' || domain OR host LIKE '%.' || domain
WHERE enable = 1""", "hosts rules")
def rule_source(r: Roles):
    rules = active_rules(r.rules).select("name", "source_site", F.explode("domains").alias("domain"))
    hosts = r.hosts.select("page_id", F.regexp_extract("host", r"\.([^.]+\.[^.]+)$", 1).alias("domain"))
    return hosts.join(rules, "domain").select("page_id", "name", "source_site")


def api_envelopes(r: Roles):
    """The question tables as API pages of up to one hundred questions.

    Long lists come in parts, and a question with several parts is an item of as many
    pages, so no page grows with a hot question.
    """
    talk = r.comments.withColumn("creation_date", to_epoch("creation_time"))
    counts = talk.groupBy("post_id").agg(F.count(F.lit(1)).alias("comment_count"))
    said = A.nest(talk, ["post_id"], F.struct("comment_id", "body", "creation_date"), ["comment_id"], "comments").join(counts, "post_id")
    count = F.coalesce("comment_count", F.lit(0)).alias("comment_count")

    # Posts travel with what is their own; fields that follow from others are added when a page is complete.
    answers = r.stored_answers.join(said.withColumnRenamed("post_id", "answer_id").drop("part"), "answer_id", "left")
    own = F.struct("body", to_epoch("creation_time").alias("at"), "score", count, "comments", "answer_id", "is_accepted")
    key = ["question_id", "part"]
    replies = A.nest(answers, ["parent_id"], own, ["post_number"], "answers", numbered=True)
    lists = [replies.withColumnRenamed("parent_id", "question_id"), r.tag_lists, said.withColumnRenamed("post_id", "question_id")]
    heads = A.answer_heads(r.stored_answers).withColumnRenamed("parent_id", "question_id")
    asking = r.questions.join(heads, "question_id", "left")
    # The first lists of a question stay where they are and it comes to them; only later ones move once more.  Its place is
    # 0, but as no constant, which would be taken out of the key of the join.
    place = F.pmod(F.coalesce("question_id", F.lit(0)), F.lit(1)).cast("long")
    first = reduce(lambda a, b: a.join(b, key, "left"), lists, asking.withColumn("part", place))
    beyond = [x.where(~F.col("part").eqNullSafe(F.lit(0))) for x in lists]
    later = asking.join(reduce(lambda a, b: a.join(b, key, "full"), beyond), "question_id")
    questions = first.unionByName(later)
    asked = F.struct(
        "question_id", "title", to_epoch("update_time").alias("at"), "score", count, "comments", "view_count",
        (F.col("state") == "Accepted").alias("is_answered"), F.coalesce("answer_count", F.lit(0)).alias("answer_count"),
        "accept_id", "tags", "answers",
    )
    placed = questions.select(
        "question_id", F.floor(F.col("question_id") / 100).cast("long").alias("page"),
        F.coalesce("part", F.lit(0)).alias("part"), asked.alias("item"),
    )

    def dates(p):
        return p["at"].alias("creation_date"), p["at"].alias("last_activity_date"), p["score"].alias("score")

    def comments(p, post: str):
        full = F.transform(p["comments"], lambda c: F.struct(
            c["comment_id"].alias("comment_id"), c["body"].alias("body"), c["creation_date"].alias("creation_date"),
            p[f"{post}_id"].alias("post_id"), F.lit(0).cast("long").alias("score"), F.lit(post).alias("post_type")))
        return p["comment_count"].alias("comment_count"), full.alias("comments")

    def answer(q, a):
        return F.struct(
            q["question_id"].alias("question_id"), F.lit("Re").alias("title"), a["body"].alias("body"), *dates(a),
            *comments(a, "answer"), a["answer_id"].alias("answer_id"), a["is_accepted"].alias("is_accepted"))

    def item(q):
        return F.struct(
            q["question_id"].alias("question_id"), q["title"].alias("title"), F.lit("?").alias("body"), *dates(q),
            *comments(q, "question"), q["view_count"].alias("view_count"), F.lit(0).alias("favorite_count"),
            q["is_answered"].alias("is_answered"), q["answer_count"].alias("answer_count"),
            q["accept_id"].alias("accepted_answer_id"), q["tags"].alias("tags"),
            F.transform(q["answers"], lambda a: answer(q, a)).alias("answers"))

    pages = placed.repartition("page", "part").groupBy("page", "part").agg(A.in_order("question_id", F.col("item")).alias("items"))
    items = F.transform("items", item).alias("items")
    envelope = F.struct(items, F.lit(True).alias("has_more"), "page", F.lit(100).alias("quota_remaining"))
    return pages.select(F.to_json(envelope).alias("json"))


@query("api_flatten", """
WITH c AS (SELECT post_id, count(*) AS n FROM comments GROUP BY 1)
SELECT 'question' AS kind, question_id AS id, NULL AS parent_id, strftime(update_time, '%Y-%m-%d %H:%M:%S') AS t, score,
       coalesce(n, 0)::VARCHAR || ':' || coalesce(accept_id::VARCHAR, '') AS value
FROM qa LEFT JOIN c ON post_id = question_id
UNION ALL SELECT 'answer', answer_id, parent_id, strftime(creation_time, '%Y-%m-%d %H:%M:%S'), answers.score,
       coalesce(n, 0)::VARCHAR || ':' FROM answers JOIN questions ON parent_id = question_id LEFT JOIN c ON post_id = answer_id
UNION ALL SELECT 'tag', post_id, NULL, NULL, NULL, tag_id FROM post_tags JOIN questions ON post_id = question_id
UNION ALL SELECT 'comment:question', comment_id, post_id, strftime(creation_time, '%Y-%m-%d %H:%M:%S'), 0, body
       FROM comments WHERE post_id IN (SELECT question_id FROM questions)
UNION ALL SELECT 'comment:answer', comment_id, post_id, strftime(creation_time, '%Y-%m-%d %H:%M:%S'), 0, body
       FROM comments WHERE post_id IN (SELECT answer_id FROM answers JOIN questions ON parent_id = question_id)""",
       "qa comments")
def api_flatten(r: Roles):
    flat = api.flatten_api(cut_lineage(api_envelopes(r)), "json")
    value = F.concat(F.col("comment_count"), F.lit(":"), F.coalesce(F.col("accept_id").cast("string"), F.lit("")))
    posts = flat["posts"].select(
        F.col("post_type").alias("kind"), F.col("post_id").alias("id"), "parent_id",
        format_ts("update_time").alias("t"), "score", value.alias("value"),
    )
    tags = flat["post_tags"].select(F.lit("tag").alias("kind"), F.col("post_id").alias("id"), F.col("tag_id").alias("value"))
    comments = flat["comments"].select(
        F.concat(F.lit("comment:"), "post_type").alias("kind"), F.col("comment_id").alias("id"),
        F.col("post_id").alias("parent_id"), format_ts("creation_time").alias("t"), "score",
        F.col("body").alias("value"),
    )
    return A.union_docs(posts, tags, comments)


@query("api_walk", """
WITH l AS (SELECT *, CASE WHEN update_time < TIMESTAMP '1998-01-01' THEN question_id END AS known FROM list_pages),
p AS (SELECT page100 AS page, count(known) AS known FROM l GROUP BY 1),
s AS (SELECT coalesce(min(page) FILTER (known > 0), max(page)) AS stop, (SELECT max(page) FROM p) AS pages FROM p)
SELECT 'later' AS source, page100 AS page, question_id, stop AS fetching_page FROM l, s WHERE page100 <= stop AND known IS NULL
UNION ALL SELECT 'first', page100, question_id, pages FROM l, s WHERE page100 >= 3 AND known IS NULL""", "list_pages")
def api_walk(r: Roles):
    """All questions as pages of a hundred, newest first: once after the first pass, once within it from page three."""
    at = to_epoch("update_time")
    item = F.struct("question_id", at.alias("last_activity_date"))
    listed = r.list_pages(100)
    pages = listed.groupBy("page").agg(F.collect_list(item).alias("items"))
    last = listed.agg(F.max("page").alias("last")).scalar()
    envelope = F.struct("items", (F.col("page") < last).alias("has_more"), "page", F.lit(100).alias("quota_remaining"))
    envelopes = pages.select(F.explode(F.array(F.lit("later"), F.lit("first"))).alias("source"), F.to_json(envelope).alias("json"))
    state = r.spark.createDataFrame([("later", 7, True, False), ("first", 3, True, True)], "source string, fetching_page long, has_more boolean, first_pass boolean")
    stored = r.questions.where(F.col("update_time") < ts("1998-01-01 00:00:00")).select("question_id", "update_time")
    taken, left = api.walk_pages(envelopes, state, stored)
    return taken.select("source", "page", F.col("q.question_id").alias("question_id")).join(left.select("source", "fetching_page"), "source")


@query("state_resume", """
SELECT source, page, has_more, first_pass FROM (
  SELECT section AS source, section < '3' OR section > '5' AS first_pass, true AS has_more,
         CASE WHEN section < '3' THEN count(*) // 30 ELSE 1 END AS page FROM questions GROUP BY 1)""", "questions")
def state_resume(r: Roles):
    known = F.col("source") < "5"
    saved = r.questions.groupBy(F.col("section").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    state = saved.select(
        "source", F.when(known, F.floor(F.col("n") / 30)).alias("fetching_page"), F.when(known, True).alias("has_more"),
        F.when(known, F.col("source") < "3").alias("first_pass"),
    )
    return api.resume_point(state)


@query("image_manifest", r"""
SELECT page_id, i::BIGINT AS ordinal, origin || src AS source_url, stored_name, '/images/' || stored_name AS public_url
FROM (SELECT page_id, origin, src, i, printf('%02d', i) || md5(url || i) || '.' ||
             list_extract(string_split(list_extract(string_split(src, '/'), -1), '.'), -1) AS stored_name
      FROM (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*') AS origin,
                   unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) || '.png' AS src,
                   generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) AS i FROM pages))""")
def image_manifest(r: Roles):
    html = F.regexp_replace("html", r'<a href="([^"]*)"', r'<img class="x" src="$1.png"')
    rows = pages.image_manifest(r.pages, html)
    return rows.select("page_id", "ordinal", "source_url", "stored_name", "public_url")
