"""Operators against brute force on small rows, and their invariants."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from millrace.operators import changes as C
from millrace.operators import documents as A
from millrace.operators import extract as E
from millrace.operators import filters as P
from millrace.operators import graph as G
from millrace.operators import joins as J
from millrace.operators import paging as W
from millrace.operators import reports as Q
from millrace.operators import upserts as U
from millrace.operators.assign import assign_articles
from millrace.operators.steps import compose
from millrace.sources import records


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


# -- filters ------------------------------------------------------------------------

def test_kept_and_rejected_are_the_input(spark):
    df = spark.createDataFrame([(1, "a Pilgrim"), (2, "x"), (3, None)], "id int, body string")
    marked = P.require(P.filter_words(df, "body", ["pilgrim", "zz"]), ["body"])
    assert rows(P.kept(marked)) == [(2, "x")]
    assert rows(P.rejected(marked), "id", "reject_reason") == [(1, "word:pilgrim"), (3, "missing:body")]


def test_age_is_counted_in_whole_days(spark):
    days = [("2001-01-01 00:00:00", 366), ("2001-01-01 00:00:01", 365), ("2001-01-02 00:00:00", 365)]
    df = spark.createDataFrame([(d, n) for d, n in days], "d string, n int").withColumn("t", F.col("d").cast("timestamp_ntz"))
    marked = P.drop_early(df, "t", ntz("2002-01-02 00:00:00"))
    assert rows(P.kept(marked), "n") == [(365,), (365,)]
    bad = P.drop_early(spark.createDataFrame([(None,)], "t timestamp_ntz"), "t", ntz("2002-01-02 00:00:00"))
    assert bad.first()["reject_reason"] == "bad_date"


def test_question_mark_in_a_link_rule_stays_a_quantifier(spark):
    df = spark.createDataFrame([("http://h/list?f=front",), ("http://h/listf=front",)], "url string")
    assert rows(P.filter_urls(df, "url", ["/list?f=front"])) == [("http://h/listf=front",)]


def test_domains_and_routes(spark):
    df = spark.createDataFrame([("http://a.com/news/1",), ("http://x.a.com/2",), ("http://ba.com/3",)], "url string")
    assert rows(P.filter_domains(df, "url", ["a.com"])) == [("http://a.com/news/1",), ("http://x.a.com/2",)]
    assert rows(P.route(df, "url", {"list": "/news/"}), "kind") == [("detail",), ("detail",), ("list",)]


def test_parse_or_reject_keeps_the_others(spark):
    df = spark.createDataFrame([("u1", "5"), ("u2", "x"), ("u3", None)], "url string, n string")
    marked = P.parse_or_reject(df, {"n": lambda c: c.try_cast("int")})
    assert rows(P.rejected(marked), "url", "reject_reason") == [("u2", "unparsed:n")]
    assert sorted(r["url"] for r in P.kept(marked).collect()) == ["u1", "u3"]


# -- changes ------------------------------------------------------------------------

def test_changes_partition_the_input(spark):
    stored = spark.createDataFrame([(1, 10, 5), (2, 10, 5), (3, 10, 5)], "id int, t int, view_count int")
    new = spark.createDataFrame([(1, 10, 9, 1), (2, 11, 5, 1), (3, 9, 5, 1), (4, 1, 1, 1)], "id int, t int, view_count int, score int")
    marked = C.classify_changes(new, stored, "id", "t", ["view_count"])
    assert rows(marked, "id", "change") == [(1, "unchanged"), (2, "updated"), (3, "unchanged"), (4, "new")]
    assert rows(C.need_fetch(new, stored, "id", "t"), "id") == [(2,), (4,)]
    assert C.need_fetch(new, stored, "id", "t", force=True).count() == 4
    patches = C.summary_patches(marked)
    assert [(r["id"], r["patch"]) for r in patches.collect()] == [
        (1, {"ViewCount": "9", "Score": "1", "Imported": "False"})
    ]


# -- early stops --------------------------------------------------------------------

def entries(spark, seed):
    rng = random.Random(seed)
    data = [(p, i, rng.random() < 0.5, rng.random() < 0.3, rng.randrange(100)) for p in range(6) for i in range(40)]
    return data, spark.createDataFrame(data, "page int, pos int, unchanged boolean, sticky boolean, t int")


def walk(data, stop):
    """Rows kept when each page is walked in order: stop(state, row) -> (break, keep)."""
    kept = []
    for page in sorted({d[0] for d in data}):
        state = {"seen": 0}
        for row in sorted(d for d in data if d[0] == page):
            leave, keep = stop(state, row)
            if leave:
                break
            if keep:
                kept.append(row[:2])
    return sorted(kept)


def test_stop_at_date(spark):
    data, df = entries(spark, 1)
    got = W.stop_at_date(df, ["pos"], "t", F.lit(4), ["page"])
    assert rows(got, "page", "pos") == walk(data, lambda s, r: (r[4] <= 4, True))
    all_rows = W.stop_at_date(df, ["page", "pos"], "t", F.lit(-1))
    assert all_rows.count() == len(data)


@pytest.mark.parametrize("n", [0, 5, 15, 60])
def test_stop_after_unchanged(spark, n):
    data, df = entries(spark, 2)

    def counted(state, row):
        if row[2]:
            state["seen"] += 1
            if state["seen"] > n:
                return True, False
        return False, True

    def tested_before(state, row):
        if state["seen"] > n and row[4] < 70:
            return True, False
        state["seen"] += row[2]
        return False, True

    assert rows(W.stop_after_unchanged(df, n, ["page"], ["pos"]), "page", "pos") == walk(data, counted)
    recent = F.col("t") >= 70
    assert rows(W.stop_after_unchanged(df, n, ["page"], ["pos"], recent), "page", "pos") == walk(data, tested_before)


def test_stop_at_first_unchanged(spark):
    data, df = entries(spark, 3)
    got = rows(W.stop_at_unchanged(df, ["page"], ["pos"]), "page", "pos")
    assert got == walk(data, lambda s, r: (r[2] and not r[3], not r[2]))


def test_priorities_and_batches(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "page int, pos int")
    kept = df.filter("pos <> 2")
    assert rows(W.fetch_priority(df, kept, "page", ["pos"]), "pos", "priority") == [(1, 60), (3, 50)]
    assert rows(W.fetch_priority(df, kept, "page", ["pos"], "forum"), "pos", "priority") == [(1, 3), (3, 2)]
    batches = W.batch_numbers(spark.range(25), ["id"], 10)
    assert rows(batches.groupBy("batch").count()) == [(1, 10), (2, 10), (3, 5)]
    assert [r["id"] for r in W.next_batch(spark.range(25), ["-id"], 2).collect()] == [24, 23]
    walked = W.section_progress(spark.createDataFrame([("a",), ("b",), ("z",)], "section string"), ["a", "b"])
    assert [tuple(r) for r in walked.orderBy("section").collect()] == [("a", 0, "b", False), ("b", 1, None, True), ("z", None, None, None)]


# -- upserts ------------------------------------------------------------------------

def test_upsert_policy(spark):
    stored = spark.createDataFrame([(1, "/a", "A", 1), (2, "/b", "B", 2)], "id int, link string, title string, views int")
    writes = spark.createDataFrame(
        [(2, "/x", None, 9, 1), (3, "/c", "C1", 1, 1), (3, "/d", "C2", 2, 2)],
        "id int, link string, title string, views int, seq int",
    )
    once = U.upsert(stored, writes, ["id"], ["title", "views"], ["seq"])
    assert sorted(map(tuple, once.collect()), key=str) == [(1, "/a", "A", 1), (2, "/b", None, 9), (3, "/c", "C2", 2)]
    twice = U.upsert(once, writes, ["id"], ["title", "views"], ["seq"])
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))
    replaced = U.replace_rows(stored, writes, ["id"], ["seq"])
    assert sorted(map(str, map(tuple, replaced.collect()))) == sorted(map(str, [(1, "/a", "A", 1), (2, "/x", None, 9), (3, "/d", "C2", 2)]))


def test_patches(spark):
    stored = spark.createDataFrame([(1, 5, "x", None), (2, 6, "y", "old")], "id int, views int, title string, at string")
    patches = spark.createDataFrame(
        [(1, 1, {"ViewCount": "7", "Title": "a"}), (1, 2, {"Title": "b"}), (9, 1, {"ViewCount": "1"})],
        "id int, seq int, patch map<string,string>",
    )
    out = U.apply_patch(stored, patches, "id", {"ViewCount": "views", "Title": "title"}, ["seq"], ("at", F.lit("now")))
    assert rows(out) == [(1, 7, "b", "now"), (2, 6, "y", "old")]
    changes = spark.createDataFrame([(1, None, "t"), (9, 1, "z")], "id int, views int, title string")
    assert rows(U.update_columns(stored, changes, "id"), "id", "views", "title") == [(1, 5, "t"), (2, 6, "y")]


def test_published_marks(spark):
    df = spark.createDataFrame([(1, False), (2, True), (3, False)], "id int, imported boolean")
    ids = lambda *v: spark.createDataFrame([(i,) for i in v], "id int")
    assert rows(U.mark_published(df, ids(1, 1), "id", ids(2))) == [(1, True), (2, False), (3, False)]


# -- documents ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def posts(spark):
    data = [(i, "2020-01-01", i, f"b{i}") for i in range(1, 8)]
    return spark.createDataFrame(data, "post_id long, d string, score long, body string").select(
        "post_id", F.col("d").cast("timestamp_ntz").alias("creation_time"), "score", "body"
    )


def questions(spark, data):
    return spark.createDataFrame(data, "question_id long, accept_id string, answer_ids string, tags string")


def test_accepted_answer_leads(spark, posts):
    q = questions(spark, [(1, "3", "1,2,3,99", "a,b"), (2, "NULL", "4", ""), (3, "5", "6", None), (4, "", "", "t"), (5, "77", "1", "")])
    docs = {r["question_id"]: r for r in A.build_qa_docs(q, posts).collect()}
    bodies = {k: [a["body"] for a in d["answers"]] for k, d in docs.items()}
    assert bodies == {1: ["b3", "b1", "b2"], 2: ["b4"], 3: ["b5", "b6"], 4: [], 5: ["b1"]}
    assert {k: d["answer_count"] for k, d in docs.items()} == {1: 4, 2: 1, 3: 1, 4: 0, 5: 1}
    assert {k: d["is_accepted"] for k, d in docs.items()} == {1: True, 2: False, 3: True, 4: False, 5: True}
    assert [a["is_accepted"] for a in docs[1]["answers"]] == [True, False, False]
    assert docs[1]["tags"] == ["a", "b"] and docs[2]["tags"] == []


def test_large_documents_come_in_parts(spark, posts):
    q = questions(spark, [(1, "5", "1,2,3,4,5,6,7", "")])
    comments = spark.createDataFrame(
        [(i, 2, f"c{i}", f"2020-01-0{i}") for i in range(1, 6)], "comment_id long, post_id long, body string, d string"
    ).withColumn("creation_time", F.col("d").cast("timestamp_ntz"))
    docs = A.build_qa_docs(q, posts, comments, chunk=2).orderBy("part", "comment_part").collect()
    assert [(r["part"], r["comment_part"], [a["body"] for a in r["answers"]]) for r in docs] == [
        (0, 0, ["b5", "b1"]), (1, 0, ["b2", "b3"]), (1, 1, ["b2"]), (1, 2, ["b2"]), (2, 0, ["b4", "b6"]), (3, 0, ["b7"])
    ]
    said = [c["body"] for r in docs for a in r["answers"] for c in a["comments"]]
    assert said == ["c1", "c2", "c3", "c4", "c5"]


def test_lists_in_several_rows_are_one_list(spark):
    n, chunk = 2_500, 1_000
    posts = spark.range(1, n + 1).select(
        F.col("id").alias("post_id"), F.lit("2020-01-01").cast("timestamp_ntz").alias("creation_time"), F.lit(0).alias("score"),
        F.concat(F.lit("b"), "id").alias("body"), F.col("id").alias("post_number"), F.lit(1).cast("long").alias("parent"))
    lists = A.concat_children(posts, ["parent"], "post_id", ["post_number"], "ids", chunk, numbered=True)
    lists = lists.withColumnRenamed("part", "list_part")
    asked = lists.select(F.col("parent").alias("question_id"), "list_part", F.lit("1700").alias("accept_id"), F.col("ids").alias("answer_ids"),
                         F.when(F.col("list_part") == 0, "a,b").otherwise("c").alias("tags"))
    comments = spark.range(1, n + 1).select(F.col("id").alias("comment_id"), F.lit(1700).cast("long").alias("post_id"),
                                            F.concat(F.lit("c"), "id").alias("body"), F.lit("2020-01-01").cast("timestamp_ntz").alias("creation_time"))
    docs = A.build_qa_docs(asked, posts, comments, chunk=chunk).withColumn("key", records.doc_key("question_id"))
    docs = docs.orderBy("part", "comment_part").collect()
    assert [(r["key"], r["part"], r["comment_part"]) for r in docs] == [
        ("1", 0, 0), ("1-0-1", 0, 1), ("1-0-2", 0, 2), ("1-1-0", 1, 0), ("1-2-0", 2, 0)]
    assert {(r["answer_count"], r["is_accepted"], ",".join(r["tags"])) for r in docs} == {(n, True, "a,b,c,c")}
    listed = [a["body"] for r in docs if r["comment_part"] == 0 for a in r["answers"]]
    assert listed == ["b1700", *(f"b{i}" for i in range(1, n + 1) if i != 1700)]
    assert [c["body"] for r in docs for a in r["answers"] for c in a["comments"]] == [f"c{i}" for i in range(1, n + 1)]
    threads = lists.select(F.col("parent").alias("discussion_id"), "list_part", F.col("ids").alias("post_ids"), F.lit("t").alias("tags"))
    forum = A.build_forum_docs(threads, posts, chunk=chunk).orderBy("part").collect()
    assert [(r["part"], len(r["posts"]), r["body"]) for r in forum] == [(0, 1_000, "b1"), (1, 1_000, "b1"), (2, 500, "b1")]
    assert [p["post_number"] for r in forum for p in r["posts"]] == list(range(1, n + 1))


def test_comments_of_a_question_stand_in_its_document(spark, posts):
    q = questions(spark, [(101, "NULL", "1,2,3", ""), (102, "NULL", "", ""), (103, "NULL", "4", "")])
    data = [(i, 101, f"q{i}") for i in range(5)] + [(10, 102, "two"), (20, 103, "a three"), (30, 77, "nobody")]
    comments = spark.createDataFrame(data, "comment_id long, post_id long, body string").withColumn("creation_time", F.lit("2020-01-01").cast("timestamp_ntz"))
    docs = A.build_qa_docs(q, posts, comments, chunk=2)
    said = {}
    for r in docs.orderBy("question_id", "part", "comment_part").collect():
        said.setdefault(r["question_id"], []).extend(c["body"] for c in r["comments"])
        assert len(r["comments"]) <= 2 and (r["part"] == 0 or not r["comments"])
    assert said == {101: [f"q{i}" for i in range(5)], 102: ["two"], 103: ["a three"]}
    assert [a["body"] for r in docs.where("question_id = 101").orderBy("part", "comment_part").collect() for a in r["answers"]] == \
        [a["body"] for r in A.build_qa_docs(q, posts, chunk=2).where("question_id = 101").orderBy("part").collect() for a in r["answers"]]


def test_unions_merge_nested_fields(spark):
    one = spark.createDataFrame([(1, [(1, "x", [(5,)])], None, {"k": (1,)})], "id int, a array<struct<n:int,b:string,c:array<struct<u:int>>>>, s struct<p:int>, m map<string,struct<z:int>>")
    two = spark.createDataFrame([(2, [(7, [(6, "v")]), None], (8, "q"), {"k": (2, 3)})],
                                "id long, a array<struct<n:long,c:array<struct<u:int,w:string>>>>, s struct<p:int,r:string>, m map<string,struct<y:int,z:int>>")
    bare = spark.createDataFrame([(3,)], "id int")
    got = A.union_docs(one, two, bare)
    assert got.schema["a"].dataType.simpleString() == "array<struct<n:bigint,b:string,c:array<struct<u:int,w:string>>>>"
    assert got.schema["s"].dataType.simpleString() == "struct<p:int,r:string>"
    assert [r.asDict(True) for r in got.orderBy("id").collect()] == [
        {"id": 1, "a": [{"n": 1, "b": "x", "c": [{"u": 5, "w": None}]}], "s": None, "m": {"k": {"z": 1, "y": None}}},
        {"id": 2, "a": [{"n": 7, "b": None, "c": [{"u": 6, "w": "v"}]}, None], "s": {"p": 8, "r": "q"}, "m": {"k": {"z": 3, "y": 2}}},
        {"id": 3, "a": None, "s": None, "m": None}]
    with pytest.raises(TypeError):
        A.union_docs(one, spark.createDataFrame([("x",)], "s string"))


def test_a_document_that_shrinks_loses_its_parts(spark):
    docs = lambda rows: spark.createDataFrame(rows, "id long, part long, comment_part long, body string")
    index = records.index_rows(docs([(1, 0, 0, "a"), (1, 1, 0, "b"), (1, 2, 0, "c"), (2, 0, 0, "d"), (3, 0, 0, "e")]), "id", ["id", "body"])
    again = records.index_rows(docs([(1, 0, 0, "new"), (3, 0, 0, "e"), (4, 0, 0, "f")]), "id", ["id", "body"])
    changes = records.index_changes(index, again)
    assert sorted(rows(changes, "key", "action")) == [("1", "index"), ("1-1-0", "delete"), ("1-2-0", "delete"), ("4", "index")]
    after = records.upsert_documents(index, changes)
    assert sorted(rows(after, "key", "json")) == [("1", '{"id":1,"body":"new"}'), ("2", '{"id":2,"body":"d"}'), ("3", '{"id":3,"body":"e"}'), ("4", '{"id":4,"body":"f"}')]
    assert records.index_changes(after, again).count() == 0
    lines = {r["key"]: r["lines"] for r in records.change_lines(changes, "i", "t").collect()}
    assert lines["1-1-0"] == '{"delete":{"_index":"i","_type":"t","_id":"1-1-0"}}'
    assert lines["4"] == '{"index":{"_index":"i","_type":"t","_id":"4"}}\n{"id":4,"body":"f"}'


def test_documents_of_hot_parents_are_the_same(spark, posts):
    q = questions(spark, [(1, "3", "1,2,3,99", "a,b"), (2, "NULL", "4", ""), (3, "5", "98,99,97", None), (4, "", "", "t")])
    cold, hot = A.build_qa_docs(q, posts, chunk=2), A.build_qa_docs(q, posts, chunk=2, hot_rows=2)
    assert sorted(map(str, hot.select(*cold.columns).collect())) == sorted(map(str, cold.collect()))
    numbered = posts.withColumn("post_number", F.col("post_id"))
    disc = spark.createDataFrame([(1, "t", "1,2,3"), (2, "", "3,4"), (3, "", "97,98,99")], "discussion_id long, tags string, post_ids string")
    cold, hot = A.build_forum_docs(disc, numbered, chunk=2), A.build_forum_docs(disc, numbered, chunk=2, hot_rows=2)
    assert cold.count() == 3
    assert sorted(map(str, hot.select(*cold.columns).collect())) == sorted(map(str, cold.collect()))


def test_nested_parts_lose_no_child(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(100)], "p int, c int")
    parts = A.nest(df, ["p"], F.col("c"), ["c"], "cs", chunk=7).orderBy("p", "part").collect()
    assert all(len(r["cs"]) <= 7 for r in parts)
    for p in range(3):
        assert [c for r in parts if r["p"] == p for c in r["cs"]] == [i for i in range(100) if i % 3 == p]


def test_forum_body_and_empty_threads(spark):
    posts = spark.createDataFrame([(1, 1, "first"), (2, 2, "second"), (3, 2, "x"), (4, 3, "y")], "post_id long, post_number long, body string")
    disc = spark.createDataFrame([(1, "t", "1,2"), (2, "", "3,4"), (3, "", ""), (4, "", "2,99,1")], "discussion_id long, tags string, post_ids string")
    docs = {r["discussion_id"]: r for r in A.build_forum_docs(disc, posts).collect()}
    assert {k: d["body"] for k, d in docs.items()} == {1: "first", 2: "y", 4: "first"}
    assert [p["body"] for p in docs[4]["posts"]] == ["second", "first"]
    split = A.build_forum_docs(disc, posts, chunk=1).filter("discussion_id = 1").collect()
    assert len(split) == 2 and {r["body"] for r in split} == {"first"}


def test_last_accepted_answer_counts(spark):
    df = spark.createDataFrame([(1, 11, 1, True), (1, 12, 2, True), (1, 13, 3, False), (2, 21, 1, False)],
                               "parent_id int, answer_id int, post_number int, is_accepted boolean")
    assert rows(A.accepted_id(df).fillna(-1)) == [(1, 12), (2, -1)]


def test_thread_pages_keep_the_question_once(spark):
    data = [(1, 1, 1, "question", 10, "q"), (1, 1, 2, "answer", 11, "a"), (1, 2, 0, "question", 10, "q"), (1, 2, 1, "answer", 12, "b")]
    df = spark.createDataFrame(data, "thread_id int, page int, pos int, post_type string, post_id int, body string")
    merged = A.merge_thread_pages(df).collect()
    assert [[p["post_id"] for p in r["posts"]] for r in merged] == [[10, 11, 12]]


# -- joins, reports -----------------------------------------------------------------

def test_rules_join_once_per_stored_page_small_and_large(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "http://www.a.com/n/1", "h"), (1, "http://www.a.com/n/1", "h"), (2, "http://ba.com/n/1", "h"), (3, "http://a.com/x", "h"),
                                   (4, "http://x.b.a.com/n/4", "h"), (5, None, "h"), (9, "http://c.com/n/9", "-")], "page_id int, url string, html string")
    rules = spark.createDataFrame([("r", "a.com,c.com,b.a.com,a.com", "", r"/n/\d+", 1), ("r", "a.com,c.com,b.a.com,a.com", "", r"/n/\d+", 1),
                                   ("s", "b.a.com", "", "/n", 1), ("off", "a.com", "", "/", 0)],
                                  "name string, allow_domains string, start_urls string, allow_url string, enable int")
    small = J.match_rules(pages, rules)
    want = [(1, "r", "h"), (1, "r", "h"), (4, "r", "h"), (4, "s", "h"), (9, "r", "-")]
    assert sorted(rows(small, "page_id", "name", "html"), key=str) == sorted(want, key=str)
    monkeypatch.setattr(J, "small_enough", lambda df: df)
    assert sorted(rows(J.match_rules(pages, rules), *small.columns), key=str) == sorted(rows(small), key=str)


def test_walk_follows_lists_and_ends_at_articles(spark):
    page = lambda pager, listed: f'<div class="p"><a href="{pager}">n</a></div><ul>{"".join(f"<li><a href={chr(34)}{u}{chr(34)}>a</a>" for u in listed)}</ul>'
    pages = spark.createDataFrame([
        ("http://a.com/1", page("/2", ["/n/1", "/n/2#x", "/about", "http://b.com/n/3"])), ("http://a.com/2", page("/1", ["/n/2", "/n/4", "/3"])),
        ("http://a.com/n/1", page("/9", ["/n/5"])), ("http://b.com/1", page("http://a.com/2", [])), (None, page("/7", []))], "url string, html string")
    columns = "name string, allow_domains string, start_urls string, next_page string, allow_url string, extract_from string, enable int"
    rules = [("a", "a.com", "http://a.com/1", '//div[@class="p"]', r"/n/\d", "//ul", 1), ("b", "b.com", "http://b.com/1,http://b.com/1", "//div", ".", "", 1),
             ("c", "a.com", "http://a.com/1", "", r"/\d$", "", 1), ("d", "a.com", "http://a.com/1", "//div", ".", "//ul", 0)]
    table = spark.createDataFrame(rules, columns)
    links = E.rule_links(pages, table)
    got = sorted(rows(G.walk_rules(links, table), "name", "depth", "kind", "url"))
    url = "http://a.com"
    assert got == sorted([
        ("a", 0, "1 list", f"{url}/1"), ("a", 1, "1 list", f"{url}/2"), ("a", 1, "2 article", f"{url}/n/1"), ("a", 1, "2 article", f"{url}/n/2"),
        ("a", 2, "2 article", f"{url}/n/4"), ("b", 0, "1 list", "http://b.com/1"), ("c", 0, "1 list", f"{url}/1"), ("c", 1, "2 article", f"{url}/2"),
        ("c", 1, "2 article", f"{url}/n/1"), ("c", 1, "2 article", f"{url}/n/2")])
    odd = spark.createDataFrame([("a", "a.com", "", "div.pager", ".", "", 1)], columns)
    with pytest.raises(Exception, match="unknown region"):
        E.rule_links(pages, odd).collect()


def test_reports(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 2), (3, 3)], "a int, b int")
    assert sorted(map(str, rows(Q.key_violations(df, ["a"]).fillna(-1)))) == ["(-1, 1)", "(1, 2)"]
    assert Q.key_violations(df, ["a", "b"]).count() == 2
    parents = spark.createDataFrame([(1,)], "id int")
    assert rows(Q.orphans(df, parents, {"a": "id"})) == [(3, 3)]
    q = spark.createDataFrame([(1, 2), (2, 0), (3, 1)], "question_id int, answer_count int")
    answers = spark.createDataFrame([(1,), (1,), (3,), (3,)], "parent_id int")
    assert rows(Q.count_mismatch(q, answers)) == [(3, 1, 2)]


# -- graph --------------------------------------------------------------------------

def test_bfs_equals_brute_force(spark):
    rng = random.Random(5)
    edges = {(rng.randrange(40), rng.randrange(40)) for _ in range(70)} | {(0, i) for i in range(0, 40, 5)}
    depth, level, d = {0: 0, 7: 0}, [0, 7], 0
    while level:
        d += 1
        level = [t for t in {t for s, t in edges if s in level} if t not in depth]
        depth |= {t: d for t in level}
    df = spark.createDataFrame(sorted(edges), "src long, dst long")
    starts = spark.createDataFrame([(0,), (7,), (7,)], "page long")
    assert dict(rows(G.bfs(df, starts))) == depth
    assert dict(rows(G.bfs(df, starts, 1))) == {k: v for k, v in depth.items() if v <= 1}


def test_bfs_with_hubs_equals_brute_force(spark):
    edges = [(0, i) for i in range(1, 30)] + [(i, i + 30) for i in range(1, 30)] + [(31, 0), (59, 60), (60, 0)]
    df = spark.createDataFrame(edges, "src long, dst long")
    starts = spark.createDataFrame([(59,)], "page long")
    plain = dict(rows(G.bfs(df, starts)))
    assert plain[60] == 1 and plain[0] == 2 and plain[5] == 3 and plain[35] == 4
    assert dict(rows(G.bfs(df, starts, hubs=[Row(src=0), Row(src=77)]))) == plain


def test_page_chain_numbers_pages_of_chains_and_cycles(spark):
    links = [(i, i + 1 if i < 11 else None) for i in range(12)] + [(20, None), (32, 30), (31, 32), (30, 31), (40, 40)]
    df = spark.createDataFrame([*links, (None, 3)], "page_id long, next_id long")
    got = {r["page_id"]: (r["head_id"], r["page_number"], r["total"]) for r in G.page_chain(df).collect()}
    want = {i: (0, i + 1, 12) for i in range(12)} | {20: (20, 1, 1)} | {30: (30, 1, 3), 31: (30, 2, 3), 32: (30, 3, 3), 40: (40, 1, 1)}
    assert got == want


def test_page_chain_on_random_pointers(spark):
    """Trees and cycles: a page follows the least page that names it, a cycle begins at its least page."""
    rng = random.Random(11)
    links = {i: rng.choice([None, *range(90)]) for i in range(80)} | {i: i + 1 if i < 140 else 120 for i in range(120, 141)}
    before = {}
    for page, following in sorted(links.items()):
        if following in links:
            before.setdefault(following, page)
    want = {}
    for page in links:
        path = [page]
        while path[-1] in before and before[path[-1]] not in path:
            path.append(before[path[-1]])
        ring = before.get(path[-1])
        if ring is not None:  # the path leads around a cycle, and so `page` is on it
            head = min(path)
            want[page] = (head, path.index(head) + 1, len(path))
        else:
            want[page] = (path[-1], len(path), None)
    for page, (head, number, total) in want.items():
        if total is None:
            want[page] = (head, number, max(n for h, n, _ in want.values() if h == head))
    df = spark.createDataFrame(list(links.items()), "page_id long, next_id long")
    got = {r["page_id"]: (r["head_id"], r["page_number"], r["total"]) for r in G.page_chain(df).collect()}
    assert got == want and len({h for h, _, t in want.values() if t > 1}) > 3


def test_thread_posts_are_counted_through_the_pages(spark, monkeypatch):
    monkeypatch.setattr(E, "PAGES_PER_BLOCK", 2)
    post = lambda n, more="": f'<div class="p">{more}<b class="score">{n}</b></div>'
    pages = [(5, 3, [1, 2]), (3, 9, [1, 3, 4]), (9, 8, [1]), (8, 2, [1, 5]), (2, None, [1, 6]), (7, None, []), (6, None, [7])]
    df = spark.createDataFrame([(p, n, "".join(post(k) for k in posts), f"u{p}") for p, n, posts in pages],
                               "page_id long, next_id long, html string, url string")
    fields = {"score": lambda b: F.regexp_extract(b, r">(\d+)<", 1).cast("long")}
    containers = F.regexp_extract_all("html", F.lit(r'<div class="p">([\s\S]*?)</div>'), F.lit(1))
    got = E.thread_posts(df, containers, "staff", "score", fields, repeats_question=True)
    want = [(5, 5, 1, 1, 1, "question", None), (5, 5, 1, 2, 2, "answer", 5), (5, 3, 2, 1, 3, "answer", 5), (5, 3, 2, 2, 4, "answer", 5),
            (5, 8, 4, 1, 5, "answer", 5), (5, 2, 5, 1, 6, "answer", 5), (6, 6, 1, 1, 1, "question", None)]
    names = ["thread_id", "page_id", "page_number", "pos", "post_number", "post_type", "parent_id"]
    assert sorted(rows(got, *names), key=str) == sorted(want, key=str)
    assert [s for _, s in sorted(rows(got.where("thread_id = 5"), "post_number", "score"))] == [1, 2, 3, 4, 5, 6]
    assert got.where("is_accepted = (post_number = 1)").isEmpty() and set(rows(got, "url")) >= {("u5",), ("u2",)}
    plain = E.thread_posts(df, containers, "staff", "score")
    assert plain.where("thread_id = 5").count() == 10 and plain.where("post_type = 'question'").count() == 2


# -- pages --------------------------------------------------------------------------

def test_links_first_rule_wins(spark):
    html = '<nav><a href="/a">A</a><a href="/b" title="t">B</a><a href="/a">again</a></nav><a href="/c">C</a>'
    pages = spark.createDataFrame([(1, "http://h/x/y", html)], "page_id int, url string, html string")
    rules = [E.LinkRule("nav", lambda h: F.regexp_extract(h, "<nav>[\\s\\S]*?</nav>", 0), deny=["b$"]), E.LinkRule("any", lambda h: h)]
    got = E.extract_links(pages, rules)
    assert rows(got, "rule", "pos", "url", "text") == [("any", 2, "http://h/b", "B"), ("any", 4, "http://h/c", "C"), ("nav", 1, "http://h/a", "A")]


def test_steps_run_by_priority(spark):
    chain = compose([(20, lambda df: df.withColumn("v", F.col("v") * 2)), (10, lambda df: df.withColumn("v", F.col("v") + 1))])
    assert rows(chain(spark.createDataFrame([(1,)], "v int"))) == [(4,)]


def test_assignment_is_repeatable_and_total(spark):
    articles = spark.range(200).select(F.col("id").cast("string").alias("url"), F.col("id").alias("pubdate"))
    accounts = spark.range(7).select((F.col("id") * 10).alias("account_id"))
    first = assign_articles(articles, accounts, "s")
    assert rows(first) == rows(assign_articles(articles, accounts, "s"))
    assert first.count() == 200 and first.select("account_id").distinct().count() == 7
    assert rows(assign_articles(articles, accounts, "t")) != rows(first)
    assert assign_articles(articles, accounts, "s", newest=5).count() == 5


def test_places_go_on_over_the_parts_of_a_list(spark):
    ids = [(1, part, ",".join(str(part * 1000 + i) for i in range(1000 if part < 2 else 500))) for part in range(3)]
    lists = spark.createDataFrame(ids, "question_id long, part long, answer_ids string")
    posts = spark.range(2500).select(F.col("id").alias("post_id"))
    got = J.join_id_list(lists, posts).agg(F.min("pos"), F.max("pos"), F.count_distinct("pos"), F.sum((F.col("pos") != F.col("post_id")).cast("int")))
    assert tuple(got.first()) == (0, 2499, 2500, 0)
