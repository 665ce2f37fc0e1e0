"""Nested documents from flat tables.

A nested row must fit one task, so children are cut into parts of at most `CHUNK`
by their place under the parent.  Ordinary parents have a single part 0; a parent
with more children gets more rows, and no child is lost.  Parts are a layout only:
places, counts, tags and bodies are those of the whole parent, also where its list
of children comes in several rows itself (column `list_part`).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.values import null_token, split_list
from millrace.operators.dedup import dedup_first
from millrace.operators.joins import as_key, with_starts
from millrace.operators.skew import HOT_ROWS, HOT_SHARE, fan_out_join, with_position
from millrace.session import cut_lineage

CHUNK = 1000


def in_order(place: str, value: Column) -> Column:
    """Aggregate: `value` of all rows as an array ordered by `place`."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(place).alias("p"), value.alias("v"))))
    return F.transform(pairs, lambda x: x["v"])


def nest(
    df: DataFrame,
    parent: Sequence[str],
    value: Column,
    order: Sequence[str],
    name: str,
    chunk: int = CHUNK,
    numbered: bool = False,
    hot: list[Row] | None = None,
) -> DataFrame:
    """Children of each parent as arrays in order: (parent..., part, name).

    With `numbered`, the single order column already counts the children of a parent
    from 1 (such as a post number), and no ranking is needed.  `hot` is as for
    `with_position`.
    """
    if not numbered:
        placed = with_position(df, parent, order, "_place", hot=hot)
        part = F.floor((F.col("_place") - 1) / chunk).cast("long")
        return placed.withColumn("part", part).groupBy(*parent, "part").agg(in_order("_place", value).alias(name))
    place = F.col(order[0])
    # Rows move as they are: children of a parent seldom lie together, and arrays of one child each cost more.
    rows = df.select(*parent, F.floor((place - 1) / chunk).cast("long").alias("part"), place.alias("_place"), value.alias("_value"))
    return rows.repartition(*parent, "part").groupBy(*parent, "part").agg(in_order("_place", F.col("_value")).alias(name))


def concat_children(
    df: DataFrame,
    parent: Sequence[str],
    child: str,
    order: Sequence[str],
    name: str,
    chunk: int = CHUNK,
    numbered: bool = False,
    hot: list[Row] | None = None,
) -> DataFrame:
    """Comma list of children per parent: (parent..., part, name)."""
    lists = nest(df, parent, F.col(child).cast("string"), order, name, chunk, numbered, hot)
    return lists.withColumn(name, F.array_join(name, ","))


def accepted_id(answers: DataFrame, parent: str = "parent_id", answer: str = "answer_id", pos: str = "post_number") -> DataFrame:
    """Accepted answer per question: the last one marked accepted, else null."""
    marked = F.max(F.when(F.col("is_accepted"), F.struct(pos, answer)))
    return answers.groupBy(parent).agg(marked[answer].alias("accept_id"))


def answer_heads(answers: DataFrame, parent: str = "parent_id") -> DataFrame:
    """Number of answers and accepted answer per question, in one aggregation."""
    marked = F.max(F.when(F.col("is_accepted"), F.struct("post_number", "answer_id")))
    return answers.groupBy(parent).agg(
        F.count(F.lit(1)).alias("answer_count"), marked["answer_id"].alias("accept_id")
    )


# What differs between the published sources.
SOURCES = {
    "u3danswers": {"index": "spider_u3d_answers", "type": "question_u3danswers", "favorite": "following_count"},
    "u3dstack": {"index": "spider_u3d_stack", "type": "question_u3dstack", "favorite": "favorite_count"},
    "ueanswers": {"index": "ue_spider_answers", "type": "question_ueanswers", "favorite": "following_count"},
    "u3dforum": {"index": "spider_u3d_forum", "type": "discussion_u3dforum", "favorite": None},
}
EXTRA_FIELDS = {"ueanswers": ("version", "section", "section_link")}


def _comments_of(comments: DataFrame | None, chunk: int) -> DataFrame | None:
    if comments is None:
        return None
    value = F.struct(F.col("body"), F.col("creation_time"))
    lists = nest(comments, ["post_id"], value, ["creation_time", "comment_id"], "comments", chunk)
    return lists.withColumnRenamed("part", "comment_part")


def build_qa_docs(
    questions: DataFrame,
    posts: DataFrame,
    comments: DataFrame | None = None,
    source: str = "u3danswers",
    chunk: int = CHUNK,
    hot_rows: int = HOT_ROWS,
    stored: bool = False,
) -> DataFrame:
    """Question documents with tags and answers, the accepted answer first.

    `questions` holds accept_id and the comma lists tags and answer_ids; `posts` is
    keyed by post_id.  Answers follow in list order, listed ids without a row drop out,
    and an accepted answer counts even when it is not listed.  answer_count is the
    length of the list.  With `comments`, a document has those of the question itself too.
    Rows are (question_id, part, comment_part, ...): both parts are 0 but for questions
    with very many answers or comments.  Lists may come in several rows per question,
    numbered from 0 by `list_part`; they count as one list.  `stored` says that `questions`
    is read from a table, which need not be written once more.  Answers have those of the
    fields creation_time, score and body that `posts` has.
    """
    if "list_part" in questions.columns and not stored:
        questions = cut_lineage(questions)  # the lists are an aggregate, read for answers, heads and long lists
    leads = F.col("list_part") == 0 if "list_part" in questions.columns else F.lit(True)
    accept = null_token(F.col("accept_id").cast("string"))
    listed = split_list(F.col("answer_ids"))
    others = F.when(accept.isNull(), listed).otherwise(F.filter(listed, lambda a: a != accept))
    ids = F.concat(F.when(accept.isNotNull() & leads, F.array(accept)).otherwise(F.array().cast("array<string>")), others)
    wanted = _explode_lists(questions.withColumn("_accept", accept), "question_id", ids, "_accept")
    leading = F.coalesce(F.col("post_id") == F.col("_accept"), F.lit(False))
    wanted = wanted.select("question_id", "pos", leading.alias("is_accepted"), as_key("post_id", posts).alias("post_id"))

    fields = [f for f in ("creation_time", "score", "body") if f in posts.columns]
    rows = wanted.join(posts.select("post_id", *fields), "post_id")
    talk = _comments_of(comments, chunk)
    hot = _long_lists(questions, "question_id", "answer_ids", hot_rows)
    if talk is None:
        if not hot:  # the parts are built where their head joins them
            rows = rows.drop("post_id").repartition("question_id")
        rows = rows.withColumns({
            "comment_part": F.lit(0).cast("long"),
            "comments": F.array().cast("array<struct<body:string,creation_time:timestamp_ntz>>"),
        })
    else:
        rows = rows.join(talk, "post_id", "left").withColumn("comment_part", F.coalesce("comment_part", F.lit(0)))
        rows = rows.withColumn("comments", F.coalesce("comments", F.array().cast(rows.schema["comments"].dataType)))
    answer = F.struct("is_accepted", *fields, "comments")
    rows = rows.withColumn("part", F.floor(F.col("pos") / chunk).cast("long"))
    if talk is not None or hot:
        rows = rows.repartition("question_id", "part", "comment_part")
    answers = (
        rows.groupBy("question_id", "part", "comment_part")
        .agg(in_order("pos", answer).alias("answers"))
    )
    if talk is not None:  # the comments of a question stand in its first parts, which need not have answers
        said = talk.withColumn("question_id", F.col("post_id").try_cast(answers.schema["question_id"].dataType))
        said = said.join(questions.select("question_id").distinct(), "question_id", "left_semi")
        said = said.select("question_id", F.lit(0).cast("long").alias("part"), "comment_part", "comments")
        answers = answers.join(said, ["question_id", "part", "comment_part"], "full")
    docs = fan_out_join(qa_heads(questions, source), answers, ["question_id"], hot)
    arrays = [c for c in ("answers", "comments") if c in docs.columns]
    return docs.withColumns({
        "part": F.coalesce("part", F.lit(0)),
        "comment_part": F.coalesce("comment_part", F.lit(0)),
        **{c: F.coalesce(c, F.array().cast(docs.schema[c].dataType)) for c in arrays},
    })


def _explode_lists(parents: DataFrame, key: str, ids: Column, *more: str) -> DataFrame:
    """One row per listed id: (key, more..., pos, post_id), with its place in the whole list of its parent."""
    lists = parents.withColumn("_ids", ids)
    if "list_part" in parents.columns:
        lists = with_starts(lists, key, "list_part", F.size("_ids"), "_start")
    else:
        lists = lists.withColumn("_start", F.lit(0).cast("long"))
    listed = lists.select(key, *more, "_start", F.posexplode("_ids").alias("_pos", "post_id"))
    return listed.select(key, *more, (F.col("_start") + F.col("_pos")).alias("pos"), "post_id")


def _one_head(heads: DataFrame, key: str, count: str | None = None) -> DataFrame:
    """One row per parent from those of its list parts: the first part's values, all tags, `count` summed."""
    if "list_part" not in heads.columns:
        return heads
    tags = F.sort_array(F.collect_list(F.when(F.size("tags") > 0, F.struct("list_part", "tags"))))
    summed = [F.sum(count).alias("_count")] if count else []
    changed = {key: F.col(key), "tags": F.col("_tags"), "tags_analyzer": F.col("_tags"), **({count: F.col("_count")} if count else {})}
    fixed = [c for c in heads.columns if c not in changed and c != "list_part"]
    whole = heads.repartition(key).groupBy(key).agg(
        F.min_by(F.struct(*fixed), "list_part").alias("_head"),
        F.flatten(F.transform(tags, lambda t: t["tags"])).alias("_tags"), *summed)
    return whole.select(*[changed.get(c, F.col("_head")[c]).alias(c) for c in heads.columns if c != "list_part"])


def _long_lists(df: DataFrame, key: str, ids: str, hot_rows: int, hot_share: float = HOT_SHARE) -> list[Row]:
    """Parents whose id lists are too long for one task; at most 1 / hot_share of them, as for `hot_keys`."""
    entries = F.sum(F.size(split_list(ids)))
    long = df.groupBy(key).agg(entries.alias("n")).filter(F.col("n") > hot_rows)
    if not long.agg(F.count(F.lit(1)).alias("keys")).first()["keys"]:
        return []
    floor = max(hot_rows, int(df.agg(entries.alias("n")).first()["n"] * hot_share))
    return long.filter(F.col("n") > floor).collect()


def qa_heads(questions: DataFrame, source: str = "u3danswers") -> DataFrame:
    """Question documents without their answers: scalars, counts, source and tags."""
    accept = null_token(F.col("accept_id").cast("string"))
    listed = split_list(F.col("answer_ids"))
    tags = split_list("tags")
    favorite = SOURCES[source]["favorite"]
    scalars = ["question_id", "list_part", "creation_time", "update_time", "score", "view_count", "comment_count", "title", "body",
               "link", *EXTRA_FIELDS.get(source, ())]
    heads = questions.select(
        *[c for c in scalars if c in questions.columns],
        accept.isNotNull().alias("is_accepted"),
        F.size(listed).cast("long").alias("answer_count"),
        *([F.col(favorite).alias("favorite_count")] if favorite in questions.columns else []),
        F.lit(source).alias("source"),
        tags.alias("tags"),
        tags.alias("tags_analyzer"),
    )
    return _one_head(heads, "question_id", "answer_count")


def build_forum_docs(
    discussions: DataFrame, posts: DataFrame, source: str = "u3dforum", chunk: int = CHUNK, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Discussion documents: body of post number 1, else of the last post, and all posts.

    `discussions` holds the comma lists tags and post_ids, in one row or in rows numbered
    by `list_part`.  A discussion without posts gives no document.
    """
    if "list_part" in discussions.columns:
        discussions = cut_lineage(discussions)
    wanted = _explode_lists(discussions, "discussion_id", split_list("post_ids"))
    fields = ["post_number", "creation_time", "update_time", "body", "is_staff"]
    fields = [f for f in fields if f in posts.columns]
    rows = wanted.withColumn("post_id", as_key("post_id", posts)).join(posts.select("post_id", *fields), "post_id")
    parts = (
        rows.withColumn("part", F.floor(F.col("pos") / chunk).cast("long"))
        .groupBy("discussion_id", "part")
        .agg(
            in_order("pos", F.struct(*fields)).alias("posts"),
            F.max(F.when(F.col("post_number") == 1, F.struct("pos", "body"))).alias("_first"),
            F.max(F.struct("pos", "body")).alias("_last"),
        )
    )
    heads = parts.groupBy("discussion_id").agg(F.coalesce(F.max("_first"), F.max("_last"))["body"].alias("body"))
    tags = split_list("tags")
    scalars = [c for c in ("discussion_id", "list_part", "link", "title", "creation_time", "update_time", "reply_count",
                           "view_count") if c in discussions.columns]
    rows = discussions.select(*scalars, F.lit(source).alias("source"), tags.alias("tags"), tags.alias("tags_analyzer"))
    heads = _one_head(rows, "discussion_id").join(heads, "discussion_id")
    hot = _long_lists(discussions, "discussion_id", "post_ids", hot_rows)
    return fan_out_join(heads, parts.drop("_first", "_last"), ["discussion_id"], hot)


def merge_thread_pages(df: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Posts of all pages of a thread in one record, the repeated question only once.

    Input rows are (thread_id, page, pos, post_type, post_id, body).
    """
    asked = dedup_first(df.filter("post_type = 'question'"), ["thread_id"], ["page", "pos"])
    rows = asked.unionByName(df.filter("post_type <> 'question'")).withColumn("_later", F.col("post_type") != "question")
    return nest(rows, ["thread_id"], F.struct("post_id", "post_type", "body"), ["_later", "page", "pos"], "posts", chunk)


def run_manifest(df: DataFrame, run: str, item: str, chunk: int = CHUNK) -> DataFrame:
    """Sorted set of the ids touched by each run: (run, part, ids)."""
    return nest(df.select(run, item).distinct(), [run], F.col(item), [item], "ids", chunk)


def merged_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both: structs by name at every depth, wider numbers, else equal types only."""
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        mine, other = ({f.name: f.dataType for f in t} for t in (a, b))
        both = {n: merged_type(mine[n], other[n]) if n in mine and n in other else mine.get(n, other.get(n)) for n in {**mine, **other}}
        return T.StructType([T.StructField(n, t) for n, t in both.items()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(merged_type(a.keyType, b.keyType), merged_type(a.valueType, b.valueType))
    widest = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType]
    if type(a) in widest and type(b) in widest:
        return widest[max(widest.index(type(a)), widest.index(type(b)))]()
    if a != b:
        raise TypeError(f"{a.simpleString()} and {b.simpleString()} do not merge")
    return a


def conform(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """`value` of the type `have` as `want`: fields it lacks are null, at every depth; nulls stay null."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name: f.dataType for f in have}
        fields = [(conform(value[f.name], own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in want]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: conform(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return F.transform_values(value, lambda k, v: conform(v, have.valueType, want.valueType))
    return value.cast(want)


def union_docs(*docs: DataFrame) -> DataFrame:
    """Documents of several sources in one schema, merged by name at every depth; fields a source lacks are null."""
    schema = reduce(merged_type, (d.schema for d in docs))

    def fitted(d: DataFrame) -> DataFrame:
        own = {f.name: f.dataType for f in d.schema}
        return d.select(*[(conform(F.col(f.name), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])

    return reduce(DataFrame.unionByName, map(fitted, docs))
