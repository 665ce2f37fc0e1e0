"""Data quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import reports as Q
from millrace.operators.documents import concat_children
from millrace.plans.catalog import query
from millrace.plans.roles import Roles


@query("orphan_check", """
SELECT answer_id, parent_id FROM answers WHERE parent_id NOT IN (SELECT question_id FROM questions WHERE state = 'Accepted')""",
       "answers questions")
def orphan_check(r: Roles):
    parents = r.questions.filter("state = 'Accepted'")
    return Q.orphans(r.answers.select("answer_id", "parent_id"), parents, {"parent_id": "question_id"})


@query("key_check", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def key_check(r: Roles):
    return Q.key_violations(r.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("missing_lookup", """
SELECT parent_id AS question_id, answer_id::VARCHAR AS missing_id FROM answers WHERE is_staff""", "answers")
def missing_lookup(r: Roles):
    ids = concat_children(r.stored_answers, ["parent_id"], "answer_id", ["post_number"], "answer_ids", numbered=True)
    found = r.stored_answers.filter("NOT is_staff")
    missing = Q.missing_lookups(ids.select(F.col("parent_id").alias("question_id"), "answer_ids"), "answer_ids",
                                found, "answer_id")
    return missing.select("question_id", "missing_id")


@query("accept_mismatch", "SELECT question_id, accept_id FROM qa WHERE accept_id IS NOT NULL AND state <> 'Accepted'", "qa")
def accept_mismatch(r: Roles):
    flagged = r.accepts.withColumn("is_accepted", F.col("state") == "Accepted")
    return Q.accept_mismatch(flagged).select("question_id", "accept_id")


@query("count_mismatch", """
SELECT question_id, lines AS answer_count, coalesce(n, 0) AS found
FROM questions JOIN (SELECT l_orderkey AS question_id, count(*) AS lines FROM lineitem GROUP BY 1) USING (question_id)
LEFT JOIN (SELECT parent_id AS question_id, count(*) AS n FROM answers GROUP BY 1) USING (question_id)
WHERE lines <> coalesce(n, 0)""", "questions answers")
def count_mismatch(r: Roles):
    lines = r.table("lineitem").groupBy(F.col("l_orderkey").alias("question_id")).agg(
        F.count(F.lit(1)).alias("answer_count")
    )
    counted = r.questions.select("question_id").join(lines, "question_id")
    return Q.count_mismatch(counted, r.answers).select("question_id", "answer_count", "found")


@query("suspect_values", """
SELECT unnest(['no_views', 'no_creation_time', 'failed_body']) AS reason,
       unnest([count(*) FILTER (view_count = 0), count(*) FILTER (view_count > 400000),
               count(*) FILTER (imported)]) AS n FROM questions""", "questions")
def suspect_values(r: Roles):
    rows = r.questions.withColumns({
        "creation_time": F.when(F.col("view_count") <= 400_000, F.col("update_time")),
        "body": F.when(F.col("imported"), "scrapy failed").otherwise(F.col("title")),
    })
    return Q.suspect_values(rows, {
        "no_views": F.col("view_count") == 0,
        "no_creation_time": F.col("creation_time").isNull(),
        "failed_body": F.col("body") == "scrapy failed",
    })
