"""Chains of steps over records."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import filters as P
from millrace.operators.steps import compose
from millrace.plans.catalog import query
from millrace.plans.roles import NOW_EVENTS, Roles, ts


@query("step_chain", """
SELECT doc_id, CASE WHEN contains(lower(body), 'license') THEN 'word:license'
       WHEN pubdate <= TIMESTAMP '2024-01-31' - INTERVAL 21 DAY THEN 'too_old'
       WHEN category = 'de' THEN 'missing:category' END AS reject_reason,
       CASE WHEN contains(lower(body), 'license') OR pubdate <= TIMESTAMP '2024-01-31' - INTERVAL 21 DAY
            OR category = 'de' THEN title ELSE 'ok: ' || title END AS title FROM articles""", "articles")
def step_chain(r: Roles):
    good = F.concat(F.lit("ok: "), "title")
    chain = compose([
        (900, lambda df: df.withColumn("title", F.when(F.col(P.REASON).isNull(), good).otherwise(F.col("title")))),
        (100, lambda df: P.filter_words(df, "body", ["license"])),
        (300, lambda df: P.require(df, ["category"])),
        (200, lambda df: P.drop_early(df, "pubdate", ts(NOW_EVENTS), 20)),
    ])
    rows = r.articles.withColumn("category", F.when(F.col("category") != "de", F.col("category")))
    return chain(rows).select("doc_id", "reject_reason", "title")
