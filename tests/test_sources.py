"""Formats: feeds, JSON lines, bulk lines, exports, API pages, image names."""

import json

from pyspark.sql import functions as F

from millrace.functions.dates import format_ts
from millrace.session import cut_lineage, scratch_path
from millrace.sources import api, feeds, pages, records

RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>t</title>
<item><title> A &amp; b </title><link>http://h/1</link><pubDate>2017-06-05 01:02:03</pubDate></item>
<item><link>http://h/2</link><pubDate>bad</pubDate></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>T</title><link href="http://h/1"/><id>i1</id>
<published>2017-01-01</published><updated>2017-01-02</updated></entry></feed>"""


def test_rss_column_and_files(spark, tmp_path):
    df = spark.createDataFrame([("feed", RSS)], "k string, xml string")
    want = [("feed", "", "http://h/2", None), ("feed", "A & b", "http://h/1", "2017-06-05 01:02:03")]
    shown = lambda d: sorted((tuple(r) for r in d.withColumn("pubdate", format_ts("pubdate")).collect()), key=str)
    assert shown(feeds.parse_rss(df, "xml", F.col("k"))) == want
    (tmp_path / "a.xml").write_text(RSS)
    assert shown(feeds.read_rss(spark, str(tmp_path), "feed")) == want


def test_atom_with_and_without_prefix(spark, tmp_path):
    prefixed = ATOM.replace("<", "<atom:").replace("<atom:/", "</atom:").replace("xmlns=", "xmlns:atom=")
    df = spark.createDataFrame([(ATOM,), (prefixed,)], "xml string")
    row = ("T", "http://h/1", "i1", "2017-01-01", "2017-01-02")
    assert [tuple(r) for r in feeds.parse_atom(df, "xml").collect()] == [row, row]
    (tmp_path / "a.xml").write_text(ATOM)
    assert [tuple(r) for r in feeds.read_atom(spark, str(tmp_path)).collect()] == [row]


def test_last_json_line_wins(spark, tmp_path):
    lines = [f'{{"question_id": "{i % 4}", "update_time": "{i:03d}"}}' for i in range(50)]
    (tmp_path / "state.jl").write_text("\n".join(lines))
    state = records.read_jsonl(spark, str(tmp_path), "question_id string, update_time string", ["question_id"])
    assert sorted(map(tuple, state.collect())) == [("0", "048"), ("1", "049"), ("2", "046"), ("3", "047")]


def test_export_has_a_folder_per_crawler(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "crawler string, n int")
    records.export_partitioned(df, path, "crawler")
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"crawler=a", "crawler=b"}
    assert sorted(map(tuple, spark.read.schema("n int, crawler string").json(path).collect())) == [(1, "a"), (2, "b"), (3, "a")]


def test_bulk_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, 0, "x"), (1, 1, 0, 'a "q"')], "id int, part int, comment_part int, title string")
    keyed = df.withColumn("key", records.doc_key("id"))
    bulk = records.to_bulk_lines(keyed, "ix", "ty", "key", ["id", "title"])
    path = str(tmp_path / "bulk")
    records.write_bulk(bulk, path)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert sorted(lines) == sorted([
        '{"index":{"_index":"ix","_type":"ty","_id":"1"}}', '{"id":1,"title":"x"}',
        '{"index":{"_index":"ix","_type":"ty","_id":"1-1-0"}}', '{"id":1,"title":"a \\"q\\""}',
    ])


def test_api_page(spark):
    answer = '{"question_id":1,"answer_id":7,"title":"T","body":"A","creation_date":60,"last_activity_date":61,"score":2,' \
             '"comment_count":1,"is_accepted":true,"comments":[{"comment_id":9,"post_id":7,"post_type":"answer","score":0,' \
             '"body":"c","creation_date":62}]}'
    head = '"title":"T","body":"Q","creation_date":0,"last_activity_date":1,"score":3,"comment_count":0,"view_count":5'
    page = (f'{{"items":[{{"question_id":1,{head},"favorite_count":1,"is_answered":true,"answer_count":1,'
            f'"accepted_answer_id":7,"tags":["x","y"],"answers":[{answer}]}},{{"question_id":2,{head},"answer_count":0,'
            f'"tags":[]}}],"has_more":true,"page":2,"quota_remaining":9}}')
    flat = api.flatten_api(spark.createDataFrame([(page,)], "json string"), "json")
    posts = {r["post_id"]: r for r in flat["posts"].collect()}
    assert sorted(posts) == [1, 2, 7]
    assert (posts[1]["accept_id"], posts[2]["accept_id"], posts[7]["parent_id"]) == (7, None, 1)
    assert (posts[1]["post_type"], posts[7]["post_type"], posts[7]["is_accepted"]) == ("question", "answer", True)
    assert str(posts[7]["update_time"]) == "1970-01-01 00:01:01"
    assert sorted(map(tuple, flat["post_tags"].collect())) == [(1, "x"), (1, "y")]
    assert [(r["comment_id"], r["post_id"]) for r in flat["comments"].collect()] == [(9, 7)]


def test_resume_and_next_state(spark):
    state = spark.createDataFrame([("a", 5, True, True), ("b", 5, True, False), ("c", None, None, None)],
                                  "source string, fetching_page long, has_more boolean, first_pass boolean")
    points = {r["source"]: (r["page"], r["first_pass"]) for r in api.resume_point(state).collect()}
    assert points == {"a": (5, True), "b": (1, False), "c": (1, True)}
    fetched = spark.createDataFrame([("a", 6, False)], "source string, page long, has_more boolean")
    after = {r["source"]: (r["fetching_page"], r["first_pass"]) for r in api.next_state(state, fetched).collect()}
    assert after["a"] == (6, False) and after["b"] == (5, False)


def test_images(spark):
    html = '<img class="x" src="/a/one.png"><img src="http://o/two.tar.gz">'
    df = spark.createDataFrame([("http://h/p", html)], "url string, html string")
    got = pages.image_manifest(df, "html").orderBy("ordinal").collect()
    assert [r["source_url"] for r in got] == ["http://h/a/one.png", "http://o/two.tar.gz"]
    assert [(r["stored_name"][:2], r["stored_name"][-3:]) for r in got] == [("01", "png"), ("02", ".gz")]
    assert got[0]["public_url"] == "/images/" + got[0]["stored_name"]


def test_staged_table_lies_in_the_shared_folder(spark):
    staged = cut_lineage(spark.range(5).filter("id > 1"))
    assert sorted(r["id"] for r in staged.collect()) == [2, 3, 4]
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in staged.inputFiles())
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_resumed_walk_equals_one_walk(spark):
    page = lambda n, ids, more, quota: ("so", json.dumps({"items": [{"question_id": i, "last_activity_date": 1000 + i} for i in ids], "has_more": more,
                                                          "page": n, "quota_remaining": quota}))
    known = spark.createDataFrame([(40, 1040), (21, 900), (11, 1011)], "question_id long, s long").select(
        "question_id", api.from_epoch("s").alias("update_time"))
    ids = {1: [50, 51], 2: [40, 41], 3: [30, 21], 4: [11, 12], 5: [1]}
    plain = [page(n, own, n < 5, 100) for n, own in ids.items()]
    short = [page(n, own, n < 5, 5 if n == 3 else 100) for n, own in ids.items()]

    def walk(rows, state):
        df = spark.createDataFrame(rows, "source string, json string")
        now = spark.createDataFrame([state], "source string, fetching_page long, has_more boolean, first_pass boolean")
        taken, left = api.walk_pages(df, now, known)
        return sorted((r["page"], r["q"]["question_id"]) for r in taken.collect()), tuple(left.first())

    whole, end = walk(plain, ("so", None, None, None))
    assert whole == [(1, 50), (1, 51), (2, 41), (3, 21), (3, 30), (4, 12), (5, 1)] and end[1] == 5 and end[3] is False
    part, state = walk(short, ("so", None, None, None))
    assert state[1] == 3 and state[3] is True
    rest, end = walk(plain, state)
    assert sorted({*part, *rest}) == whole and end[1] == 5 and end[3] is False
    later, end = walk(plain, end)  # after the first pass it ends behind the first page with a known question
    assert later == [(1, 50), (1, 51), (2, 41)] and end[1] == 2


def test_envelopes_are_parsed_once(spark):
    df = spark.createDataFrame([('{"items":[{"question_id":1,"answer_count":1,"tags":["a"],"answers":[{"answer_id":2,"question_id":1}]}]}',)], "json string")
    for table in api.flatten_api(df, "json").values():
        assert "from_json" not in table._jdf.queryExecution().toString()
