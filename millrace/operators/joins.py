"""Joins between pages, records and their lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.values import null_token, split_list
from millrace.operators.filters import domain_of
from millrace.operators.skew import small_enough


def join_detail(entries: DataFrame, details: DataFrame, link: str = "link") -> DataFrame:
    """Carry the fields of list entries to the detail page of the same link."""
    return entries.join(details, link, "inner")


def active_rules(rules: DataFrame) -> DataFrame:
    """Enabled extraction rules, with list columns as arrays; equal rules are one."""
    return rules.filter("enable = 1").distinct().withColumns(
        {"domains": F.array_distinct(split_list("allow_domains")), "starts": split_list("start_urls")}
    )


def rules_of_pages(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Each stored page with each active rule of its domain, once, however many of the rule's domains fit.

    The domains of a host turn the suffix test into an equality join, and a rule answers to the longest of them that it
    lists.  A rule table proven small is broadcast to the pages.  A larger one meets the distinct urls, so that page
    contents move once and not once per domain; the rows are the same.
    """
    by_domain = active_rules(rules).withColumn("_domain", F.explode("domains"))
    first = F.get(F.filter("_of", lambda d: F.array_contains("domains", d)), 0)
    wide = small_enough(by_domain)
    urls = pages if wide is not by_domain else pages.select("url").distinct()
    spread = urls.withColumn("_of", domain_of("url")).withColumn("_domain", F.explode("_of"))
    found = spread.join(wide, "_domain").where(F.col("_domain") == first).drop("_domain", "_of", "enable")
    return found if urls is pages else pages.join(found, "url")


def match_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Pages with each active rule of their domain whose url pattern they match."""
    return rules_of_pages(pages, rules).filter("rlike(url, allow_url)").drop("domains", "starts")


def join_accepted(questions: DataFrame, posts: DataFrame, fields: Sequence[str] = ("body", "score")) -> DataFrame:
    """Questions with the fields of their accepted answer, null where there is none."""
    lookup = posts.select(
        F.col("post_id").cast("string").alias("_accept"), *[F.col(f).alias(f"accepted_{f}") for f in fields]
    )
    asked = questions.withColumn("_accept", null_token(F.col("accept_id").cast("string")))
    return asked.join(lookup, "_accept", "left").drop("_accept")


def as_key(name: str, table: DataFrame) -> Column:
    """Listed ids in the type of the key they point at: whole numbers join faster than
    texts.  An id that cannot be such a key has no row there."""
    return F.col(name).try_cast(table.schema[name].dataType)


def explode_ids(parents: DataFrame, ids: str, child: str = "post_id", pos: str = "pos") -> DataFrame:
    """One row per entry of a comma list of ids, with its place."""
    kept = [c for c in parents.columns if c != ids]
    return parents.select(*kept, F.posexplode(split_list(ids)).alias(pos, child))


def with_starts(lists: DataFrame, key: str, part: str, size: Column, name: str) -> DataFrame:
    """Adds `name`, the number of entries in the parts of the same list before.

    Only the sizes of parts are summed; the lists themselves move for parts behind the first alone, and without such
    parts nothing moves.
    """
    first, later = lists.where(F.coalesce(F.col(part), F.lit(0)) == 0), lists.where(F.col(part) > 0)
    if later.isEmpty():
        return first.withColumn(name, F.lit(0).cast("long"))
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    several = small_enough(later.select(key).distinct())
    sizes = lists.join(several, key, "left_semi").select(key, part, size.alias("_size"))
    starts = sizes.select(key, part, F.coalesce(F.sum("_size").over(before), F.lit(0)).cast("long").alias(name)).where(F.col(part) > 0)
    return first.withColumn(name, F.lit(0).cast("long")).unionByName(later.join(starts, [key, part]))


def with_start(lists: DataFrame, key: str, ids: str) -> DataFrame:
    """`key`, `ids` and `start`, the number of entries in the parts of the same list before (column `part`, if any)."""
    if "part" not in lists.columns:
        return lists.select(key, ids, F.lit(0).cast("long").alias("start"))
    return with_starts(lists.select(key, "part", ids), key, "part", F.size(split_list(ids)), "start").select(key, ids, "start")


def join_id_list(questions: DataFrame, posts: DataFrame, ids: str = "answer_ids", key: str = "question_id") -> DataFrame:
    """The listed posts of each question in list order; ids without a row drop out.

    A list in several rows (`part`) is counted through."""
    listed = explode_ids(with_start(questions, key, ids), ids).withColumn("pos", (F.col("pos") + F.col("start")).cast("int")).drop("start")
    return listed.withColumn("post_id", as_key("post_id", posts)).join(posts, "post_id", "inner")


def join_comments(comment_lists: DataFrame, comments: DataFrame) -> DataFrame:
    """Comments of a post by its comma list of comment ids, with their place in it."""
    listed = explode_ids(with_start(comment_lists, "post_id", "comment_ids"), "comment_ids", "comment_id")
    listed = listed.withColumn("pos", (F.col("pos") + F.col("start")).cast("int")).drop("start")
    return listed.withColumn("comment_id", as_key("comment_id", comments)).join(
        comments.select("comment_id", "body", "creation_time"), "comment_id"
    )


def insert_pairs(existing: DataFrame, pairs: DataFrame) -> DataFrame:
    """Bridge table with each new pair added once."""
    fresh = pairs.select(*existing.columns).distinct().join(existing, existing.columns, "left_anti")
    return existing.unionByName(fresh)


def id_conflicts(answers: DataFrame, questions: DataFrame) -> DataFrame:
    """Answers whose id is already the id of a question."""
    taken = questions.select(F.col("question_id").alias("answer_id"))
    return answers.join(taken, "answer_id", "left_semi")


