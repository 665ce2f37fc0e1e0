"""Filters and their reject sides."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import filters as P
from millrace.plans.catalog import query
from millrace.plans.roles import NOW_QUESTIONS, Roles, ts


@query("drop_early", f"""
SELECT question_id, CASE WHEN update_time <= TIMESTAMP '{NOW_QUESTIONS}' - INTERVAL 366 DAY THEN 'too_old' END
       AS reject_reason FROM questions""", "questions")
def drop_early(r: Roles):
    return P.drop_early(r.questions, "update_time", ts(NOW_QUESTIONS)).select("question_id", "reject_reason")


WORDS = ["pilgrim", "license", "password", "copyright"]


@query("filter_words", """
SELECT doc_id, CASE WHEN contains(lower(body), 'pilgrim') THEN 'word:pilgrim'
       WHEN contains(lower(body), 'license') THEN 'word:license'
       WHEN contains(lower(body), 'password') THEN 'word:password'
       WHEN contains(lower(body), 'copyright') THEN 'word:copyright' END AS reject_reason FROM articles""", "articles")
def filter_words(r: Roles):
    return P.filter_words(r.articles, "body", WORDS).select("doc_id", "reject_reason")


@query("require_fields", """
SELECT doc_id, CASE WHEN quality IS NULL THEN 'missing:quality' WHEN lang = 'es' THEN 'empty:images' END
       AS reject_reason FROM documents LEFT JOIN labels USING (doc_id)""")
def require_fields(r: Roles):
    images = F.when(F.col("lang") == "es", F.array().cast("array<string>")).otherwise(F.array("source"))
    docs = r.table("documents").select("doc_id", images.alias("images"))
    rows = docs.join(r.table("labels"), "doc_id", "left")
    return P.require(rows, ["quality"], ["images"]).select("doc_id", "reject_reason")


@query("parse_or_reject", r"""
SELECT page_id, url, CASE WHEN NOT regexp_matches(tail, '^\d+$') THEN 'unparsed:number' END AS reject_reason,
       CASE WHEN regexp_matches(tail, '^\d+$') THEN tail::BIGINT END AS number
FROM (SELECT page_id, url, list_extract(string_split(url, '/'), -1) AS tail FROM pages)""")
def parse_or_reject(r: Roles):
    rows = r.pages.select("page_id", "url", F.substring_index("url", "/", -1).alias("number"))
    return P.parse_or_reject(rows, {"number": lambda c: c.try_cast("long")})


@query("allow_deny", r"""
SELECT page_id, url FROM pages WHERE regexp_matches(url, '/(en|fr)/\d+') AND NOT regexp_matches(url, '[?&]utm_')""")
def allow_deny(r: Roles):
    return P.filter_urls(r.pages.select("page_id", "url"), "url", [r"/en/\d+", r"/fr/\d+"], [r"[?&]utm_"])


@query("allowed_domains", r"""
SELECT page_id, host FROM hosts WHERE host = 'example.com' OR host LIKE '%.example.com'
   OR host = 'spam-farm.example.org' OR host LIKE '%.spam-farm.example.org'""", "hosts")
def allowed_domains(r: Roles):
    return P.filter_domains(r.hosts, "url", ["example.com", "spam-farm.example.org"]).select("page_id", "host")


@query("route_pages", """
SELECT page_id, CASE WHEN contains(url, '/en/') THEN 'list' WHEN regexp_matches(url, '#top$') THEN 'anchor'
       ELSE 'detail' END AS kind FROM pages""")
def route_pages(r: Roles):
    return P.route(r.pages, "url", {"list": "/en/", "anchor": "#top$"}).select("page_id", "kind")


@query("process_type_route", """
SELECT event_id, CASE WHEN process_type = 'signup' THEN 'upsert' ELSE 'patch' END AS target
FROM incoming_items WHERE process_type IN ('signup', 'view')""", "incoming_items")
def process_type_route(r: Roles):
    kind = F.when(F.col("process_type") == "signup", P.FULL).when(F.col("process_type") == "view", P.PATCH)
    parts = P.route_process(r.incoming_items.withColumn("process_type", kind))
    tagged = [df.select("event_id", F.lit(name).alias("target")) for name, df in parts.items()]
    return tagged[0].unionByName(tagged[1])
