"""Keyed writes as new versions of a table.

`existing` has one row per key; so do incoming rows once they are folded, and no
join below meets a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.dedup import dedup_last
from millrace.session import cut_lineage

# The columns a repeated write may change, per target table. All other
# columns keep what the first write stored.
POLICIES: dict[str, tuple[str, ...]] = {
    "u3dforum_discussion": ("title", "update_time", "reply_count", "view_count"),
    "u3dforum_post": ("post_number", "update_time", "body"),
    "u3danswers_question": ("post_type", "is_accepted", "accept_id", "update_time", "score", "answer_count",
                            "following_count", "title", "body", "imported"),
    "u3danswers_answer": ("post_type", "is_accepted", "score", "title", "body"),
    "ueanswers_question": ("post_type", "is_accepted", "accept_id", "update_time", "score", "answer_count",
                           "following_count", "title", "body", "tags", "answer_ids", "imported", "scrapy_time"),
    "ueanswers_answer": ("post_type", "is_accepted", "score", "title", "body", "is_staff", "scrapy_time"),
    "stack_post": ("post_type", "creation_time", "update_time", "score", "comment_count", "title", "body", "imported"),
    "stack_comment": ("post_id", "post_type", "score", "body", "creation_time"),
    "tag": ("name",),
    "section_state": ("last_page_link", "last_scraping_time"),
}


def fold_writes(
    df: DataFrame, key: Sequence[str], order: Sequence[str], update_cols: Sequence[str]
) -> DataFrame:
    """One row per key after applying its writes in order: listed columns from the
    last write, the others from the first.  Both are partial aggregates."""
    fixed = [c for c in df.columns if c not in (*key, *update_cols)]
    moving = [c for c in df.columns if c in update_cols]
    at = F.struct(*order)
    parts = {"_first": F.min_by(F.struct(*fixed), at)} if fixed else {}
    parts |= {"_last": F.max_by(F.struct(*moving), at)} if moving else {}
    folded = df.groupBy(*key).agg(*[value.alias(name) for name, value in parts.items()])
    return folded.select(*key, *[f"{name}.*" for name in parts]).select(*df.columns)


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    update_cols: Sequence[str],
    order: Sequence[str] = (),
) -> DataFrame:
    """Insert new keys; on known keys write only `update_cols`, null included.

    `order` sorts repeated incoming writes of a key; without it keys must be unique.
    """
    columns = existing.columns
    if order:
        incoming = fold_writes(incoming, key, order, update_cols)
    new = incoming.select(*key, *[F.col(c).alias(f"_new_{c}") for c in columns if c not in key], F.lit(True).alias("_new"))
    both = existing.withColumn("_old", F.lit(True)).join(new, list(key), "full")

    def pick(c: str) -> Column:
        if c in key:
            return F.col(c)
        writes = F.col("_new").isNotNull()
        if c not in update_cols:
            writes = writes & F.col("_old").isNull()
        return F.when(writes, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    return both.select(*[pick(c) for c in columns])


def replace_rows(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Replace whole rows by key; the last incoming row of a key wins."""
    if order:
        incoming = dedup_last(incoming, key, order)
    kept = existing.join(incoming.select(*key), list(key), "left_anti")
    return kept.unionByName(incoming.select(*existing.columns))


def apply_patch(
    existing: DataFrame,
    patches: DataFrame,
    key: str,
    columns: Mapping[str, str],
    order: Sequence[str] = (),
    stamp: tuple[str, Column] | None = None,
) -> DataFrame:
    """Write the columns named in the patch map of a key; unknown keys are ignored.

    `columns` maps patch names to columns.  Several patches of a key are laid over
    each other in `order`.  `stamp` is a column set on every patched row.
    """
    if order:
        cells = patches.select(key, *order, F.explode("patch").alias("_name", "_value"))
        last = dedup_last(cells, [key, "_name"], order)
        entry = F.struct("_name", "_value")
        patches = last.groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).alias("patch"))
    both = existing.join(patches.select(key, F.col("patch").alias("_patch")), key, "left")

    def pick(name: str, c: str) -> Column:
        value = F.try_element_at("_patch", F.lit(name)).cast(existing.schema[c].dataType)
        return F.when(F.map_contains_key("_patch", F.lit(name)), value).otherwise(F.col(c))

    written = {c: pick(name, c) for name, c in columns.items()}
    if stamp:
        written[stamp[0]] = F.when(F.col("_patch").isNotNull(), stamp[1]).otherwise(F.col(stamp[0]))
    return both.withColumns(written).select(*existing.columns)


def update_columns(existing: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Second-step update: take over every value that is present in `changes`."""
    names = [c for c in changes.columns if c != key]
    both = existing.join(changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in names]), key, "left")
    return both.withColumns({c: F.coalesce(f"_new_{c}", c) for c in names}).select(*existing.columns)


def mark_published(df: DataFrame, published: DataFrame, key: str, changed: DataFrame | None = None) -> DataFrame:
    """Set the flag of published rows, and clear it again for rows changed since."""
    done = published.select(key).distinct().withColumn("_done", F.lit(True))
    out = df.join(done, key, "left").withColumn("imported", F.coalesce("_done", "imported")).drop("_done")
    if changed is None:
        return out
    moved = changed.select(key).distinct().withColumn("_moved", F.lit(True))
    cleared = F.when(F.col("_moved"), F.lit(False)).otherwise(F.col("imported"))
    return out.join(moved, key, "left").withColumn("imported", cleared).drop("_moved")


def append_log(log: DataFrame, *rows: DataFrame) -> DataFrame:
    """Append rows of pages and records to the crawl log; fields a row lacks are null."""
    for more in rows:
        log = log.unionByName(more, allowMissingColumns=True)
    return log


def normalize_thread(threads: DataFrame) -> dict[str, DataFrame]:
    """Nested threads to flat tables, from one stored copy of the threads.

    Input rows are (question_id, title, body, accept_id, tags: array<struct<tag_id,name>>,
    answers: array<struct<answer_id,body>>), one per thread or per part of a thread.
    """
    threads = cut_lineage(threads)  # read by each of the tables
    content = threads.select("question_id", "accept_id", F.explode("answers").alias("a"))
    answers = content.select(
        F.col("a.answer_id").alias("content_id"), F.col("a.body").alias("content"), F.lit(False).alias("is_question"),
        F.coalesce(F.col("a.answer_id") == F.col("accept_id"), F.lit(False)).alias("is_answer"), "question_id",
    )
    heads = threads.select("question_id", "title", "body").distinct()
    asked = heads.select(
        F.col("question_id").alias("content_id"), F.col("body").alias("content"), F.lit(True).alias("is_question"),
        F.lit(False).alias("is_answer"), "question_id",
    )
    rows = asked.unionByName(answers)
    tags = threads.select("question_id", F.explode("tags").alias("t"))
    return {
        "question": heads.select("question_id", "title"),
        "content": rows.drop("question_id"),
        "question_content": rows.select("question_id", "content_id"),
        "question_answer": answers.filter("is_answer").select("question_id", F.col("content_id").alias("answer_id")),
        "tag": tags.select("t.tag_id", "t.name").distinct(),
        "question_tag": tags.select("question_id", "t.tag_id").distinct(),
    }
