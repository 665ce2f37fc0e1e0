"""The paged question API: envelopes of nested posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import from_epoch
from millrace.operators.changes import classify_changes
from millrace.session import cut_lineage

COMMENT = (
    "comment_id: bigint, body: string, creation_date: bigint, post_id: bigint, post_type: string, score: bigint"
)
COMMON = (
    "question_id: bigint, title: string, body: string, creation_date: bigint, last_activity_date: bigint, "
    f"score: bigint, comment_count: bigint, comments: array<struct<{COMMENT}>>"
)
ANSWER = f"{COMMON}, answer_id: bigint, is_accepted: boolean"
QUESTION = (
    f"{COMMON}, view_count: bigint, favorite_count: bigint, is_answered: boolean, answer_count: bigint, "
    f"accepted_answer_id: bigint, tags: array<string>, answers: array<struct<{ANSWER}>>"
)
ENVELOPE = f"items array<struct<{QUESTION}>>, has_more boolean, page bigint, quota_remaining bigint"


def flatten_api(df: DataFrame, json: str) -> dict[str, DataFrame]:
    """Envelopes to flat tables: posts (questions and answers), post_tags, comments.

    Answers and comments count only where the item says there are any.  The envelopes are parsed once, into a stored
    table of items.  A question that comes as several items (parts of its lists) gives one post; no list is cut.
    """
    items = cut_lineage(df.select(F.explode(F.from_json(F.col(json), ENVELOPE)["items"]).alias("q")))
    return flatten_items(items)


def flatten_items(items: DataFrame) -> dict[str, DataFrame]:
    """The flat tables of stored question items (column `q`)."""
    answers = items.filter("q.answer_count > 0").select(F.explode("q.answers").alias("a"))

    def post(item: str, kind: str, post_id: str, **more: Column) -> DataFrame:
        df = items if item == "q" else answers
        named = [value.alias(name) for name, value in more.items()]
        return df.select(
            F.col(f"{item}.{post_id}").alias("post_id"), F.lit(kind).alias("post_type"),
            from_epoch(f"{item}.creation_date").alias("creation_time"),
            from_epoch(f"{item}.last_activity_date").alias("update_time"),
            f"{item}.score", f"{item}.comment_count", f"{item}.title", f"{item}.body", *named,
            F.lit(False).alias("imported"),
        )

    questions = post(
        "q", "question", "question_id", is_accepted=F.col("q.is_answered"), view_count=F.col("q.view_count"),
        favorite_count=F.col("q.favorite_count"), answer_count=F.col("q.answer_count"),
        accept_id=F.col("q.accepted_answer_id"),
    ).dropDuplicates(["post_id"])
    replies = post(
        "a", "answer", "answer_id", is_accepted=F.col("a.is_accepted"), parent_id=F.col("a.question_id")
    ).dropDuplicates(["post_id"])

    def comments(df: DataFrame, item: str) -> DataFrame:
        rows = df.filter(F.col(f"{item}.comment_count") > 0).select(F.explode(f"{item}.comments").alias("c"))
        return rows.select(
            "c.comment_id", "c.post_id", "c.post_type", "c.score", "c.body",
            from_epoch("c.creation_date").alias("creation_time"),
        )

    return {
        "posts": questions.unionByName(replies, allowMissingColumns=True),
        "post_tags": items.select(F.col("q.question_id").alias("post_id"), F.explode("q.tags").alias("tag_id")),
        "comments": comments(items, "q").unionByName(comments(answers, "a")),
    }


def resume_point(state: DataFrame) -> DataFrame:
    """Where the next run of each source starts: the saved page while the first full
    pass is open, page 1 after it, and page 1 of a first pass without a state."""
    first = F.coalesce("first_pass", F.lit(True))
    return state.withColumns({
        "page": F.when(first, F.coalesce("fetching_page", F.lit(1))).otherwise(1).cast("long"),
        "has_more": F.coalesce("has_more", F.lit(True)),
        "first_pass": first,
    }).drop("fetching_page")


def next_state(state: DataFrame, fetched: DataFrame, source: str = "source") -> DataFrame:
    """State after a run that fetched (source, page, has_more): the page is saved, and
    the first pass ends with the last page."""
    both = state.join(
        fetched.select(source, F.col("page").alias("_page"), F.col("has_more").alias("_more")), source, "left"
    )
    ended = F.col("_more").isNotNull() & ~F.col("_more")
    return both.withColumns({
        "fetching_page": F.coalesce("_page", "fetching_page"),
        "first_pass": F.when(ended, F.lit(False)).otherwise(F.col("first_pass")),
    }).drop("_page", "_more")


LEAST_QUOTA = 5  # fixed value: with so few calls left a walk ends


def walk_pages(
    envelopes: DataFrame, state: DataFrame, stored: DataFrame, json: str = "json", source: str = "source"
) -> tuple[DataFrame, DataFrame]:
    """The questions a walk over the pages of each source takes, and the state it leaves.

    `envelopes` is (source, json) with the pages of a source in any order; `state` one row per source as for
    `resume_point`; `stored` the known questions (question_id, update_time).  A walk starts at its resume point and
    ends after the first page that is its last one, leaves no more calls, or, once the first pass is over, holds a
    question that has not changed.  Unchanged questions are not taken.  Taken are (source, page, q); the state is
    (source, fetching_page, has_more, first_pass), from which the next walk goes on.
    """
    parsed = cut_lineage(envelopes.select(source, F.from_json(F.col(json), ENVELOPE).alias("e")))  # read for items and for pages
    starts = resume_point(state).select(source, F.col("page").alias("_start"), "first_pass")
    pages = parsed.select(source, F.col("e.page").alias("page"), F.col("e.has_more").alias("more"), F.col("e.quota_remaining").alias("quota"))
    pages = pages.join(starts, source).where("page >= _start")
    items = parsed.select(source, F.col("e.page").alias("page"), F.explode("e.items").alias("q"))
    dated = items.select(source, "page", F.col("q.question_id").alias("question_id"), from_epoch("q.last_activity_date").alias("update_time"))
    marked = cut_lineage(classify_changes(dated, stored, "question_id", "update_time").select(source, "page", "question_id", "change").distinct())
    unchanged = marked.where("change = 'unchanged'").select(source, "page").distinct().withColumn("_known", F.lit(True))
    pages = pages.join(unchanged, [source, "page"], "left")
    ends = ~F.col("more") | (F.col("quota") <= LEAST_QUOTA) | (F.col("_known") & ~F.col("first_pass"))
    stops = pages.groupBy(source).agg(F.coalesce(F.min(F.when(ends, F.col("page"))), F.max("page")).alias("_stop"), F.min("_start").alias("_start"))
    stops = cut_lineage(stops)
    last = pages.join(stops.select(source, F.col("_stop").alias("page")), [source, "page"]).select(source, "page", F.col("more").alias("has_more"))
    taken = items.join(F.broadcast(stops), source).where("page BETWEEN _start AND _stop")  # one row for each source
    fresh = marked.where("change <> 'unchanged'").select(source, "page", "question_id")
    taken = taken.withColumn("question_id", F.col("q.question_id")).join(fresh, [source, "page", "question_id"], "left_semi")
    left = next_state(state.select(source, "fetching_page", "has_more", "first_pass"), last, source)
    return taken.select(source, "page", "q"), left.withColumn("first_pass", F.coalesce("first_pass", F.lit(True)))
