"""Plans of typical queries: what is read, pushed down and exchanged."""

import re

import pytest

import __spark_entry__ as entry
from pyspark.sql import functions as F

from millrace.functions import markup as M
from millrace.operators import graph as G
from millrace.operators import documents as A
from millrace.operators.extract import extract_posts
from millrace.plans.q_sources import api_envelopes
from millrace.plans.roles import Roles
from millrace.sources import records

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, table_columns", [
    ("allow_deny", {"page_id", "url"}),
    ("seen_anti", {"doc_id"}),
    ("unchanged_per_page", {"o_orderkey", "o_orderdate", "o_orderstatus"}),
    ("pending_count", {"o_orderstatus"}),
])
def test_only_needed_columns_are_read(spark, name, table_columns):
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, name)):
        assert {c.split(":")[0] for c in schema.split(",") if c} <= table_columns


@pytest.mark.parametrize("name, column", [("scheduled_run", "ts"), ("process_type_route", "ts"), ("batch_drain", "o_orderstatus")])
def test_filters_reach_the_scan(spark, name, column):
    text = plan(spark, name)
    if name != "scheduled_run":  # its filter ran inside the stream
        assert re.search(rf"PushedFilters: \[[^\]]*{column}", text) or column in text.split("DataFilters")[1].split("]")[0]


@pytest.mark.parametrize("name, most", [
    ("strip_tags", 0), ("extract_links", 0), ("parse_dates", 0), ("dedup_first", 1), ("key_check", 1),
    ("accept_id", 2), ("upsert_replace", 4),
])
def test_exchanges(spark, name, most):
    assert len(re.findall(r"\bExchange ", plan(spark, name))) <= most


def test_posts_of_single_pages_are_not_exchanged(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").drop("url")
    posts = extract_posts(pages, M.opened(M.inner("html", "article"), "p"), "page_id", "<b>", "<br>")
    assert "Exchange" not in posts._jdf.queryExecution().executedPlan().toString()


def test_a_round_of_the_walk_does_not_move_the_edges(spark):
    edges = spark.range(50_000).select((F.col("id") % 997).alias("src"), F.col("id").alias("dst"))
    placed = G.bucketed(edges, "src")
    level = spark.range(3000).select(F.col("id").alias("page")).hint("merge")
    text = G.next_nodes(placed, level)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and text.count("Exchange") == 1
    scan = text.split("Exchange")[0]  # the tree of the edges stands first and has no exchange
    assert "Bucketed: true" in scan


def exchanges(df):
    return re.findall(r"\bExchange [^\n]*", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture
def unbroadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_index_changes_move_neither_hex_digests_nor_documents_twice(unbroadcast):
    text = "doc_id long, key string, digest string, json string"
    index, again = (unbroadcast.createDataFrame([(1, "1", "ab", x)], text) for x in ("a", "b"))
    tables = []
    cut = records.cut_lineage
    try:
        records.cut_lineage = lambda df: tables.append(df) or cut(df)
        records.index_changes(index, again)
    finally:
        records.cut_lineage = cut
    assert len(tables) == 1 and len(exchanges(tables[0])) == 2


def test_numbered_children_move_as_rows(unbroadcast):
    rows = unbroadcast.range(10).select(F.floor((F.col("id") + 100) / 100).alias("p"), (F.col("id") + 1).alias("n"))
    nested = A.nest(rows, ["p"], F.col("n"), ["n"], "own", 4, numbered=True)
    text = nested._jdf.queryExecution().executedPlan().toString()
    assert len(exchanges(nested)) == 1 and "REPARTITION" in exchanges(nested)[0]
    assert text.index("partial_collect_list") < text.index("Exchange ")  # combined after the move
    assert sorted(nested.collect()) == [(1, 0, [1, 2, 3, 4]), (1, 1, [5, 6, 7, 8]), (1, 2, [9, 10])]


def test_lists_of_questions_move_few_times(unbroadcast):
    assert len(exchanges(Roles(unbroadcast, SF).qa)) <= 7


def test_api_pages_are_filled_with_lean_posts(unbroadcast):
    text = api_envelopes(Roles(unbroadcast, SF))._jdf.queryExecution().optimizedPlan().toString()
    below = text.split("RepartitionByExpression [page", 1)[1]
    assert "post_type" not in below and "last_activity_date" not in below


@pytest.mark.parametrize("name, most", [("bulk_index_lines", 4), ("union_sources", 26)])
def test_documents_move_few_times(unbroadcast, name, most):
    assert len(exchanges(entry.queries()[name](unbroadcast, SF))) <= most


def test_lists_in_several_parts_are_whole(spark, tmp_path):
    """An order of 2,500 lines with 1,001 tags: three parts of its answers, two of its tags, the accepted answer in the last."""
    lines = spark.range(2500).select(
        F.lit(7).cast("long").alias("l_orderkey"), (F.col("id") % 1001).alias("l_partkey"), F.lit(1).cast("long").alias("l_suppkey"),
        (F.col("id") + 1).cast("int").alias("l_linenumber"), F.lit(2.0).alias("l_quantity"), F.lit(3.0).alias("l_extendedprice"),
        F.when(F.col("id").isin(5, 2400), "R").otherwise("N").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
        F.expr("timestamp_ntz '2000-01-01 00:00:00'").alias("l_shipdate"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(1001).select(F.col("id").alias("p_partkey"), F.format_string("tag%04d", "id").alias("p_brand")).write.parquet(f"{tmp_path}/part.parquet")
    orders = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    when = __import__("datetime").datetime(2000, 1, 1)
    spark.createDataFrame([(7, 1, "F", 1000.0, when, "1"), (8, 1, "P", 1.0, when, "2"), (None, 1, "P", 1.0, when, "2")], orders).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(3 * 7, "x", when), (3 * 75, "y", when)], "event_id long, event_type string, ts timestamp_ntz").write.parquet(f"{tmp_path}/events.parquet")
    r = Roles(spark, str(tmp_path))
    rows = sorted(r.qa.collect(), key=lambda q: (q["question_id"] or 0, q["list_part"]))
    assert [(q["question_id"], q["accept_id"], q["list_part"], len((q["answer_ids"] or "").split(",")), len((q["tags"] or "").split(","))) for q in rows] == [
        (None, None, 0, 1, 1), (7, 7 * 10 + 2401, 0, 1000, 1000), (7, 7 * 10 + 2401, 1, 1000, 1), (7, 7 * 10 + 2401, 2, 500, 1), (8, None, 0, 1, 1)]
    flat = entry.queries()["api_flatten"](spark, str(tmp_path))
    assert {x["kind"]: x["count"] for x in flat.groupBy("kind").count().collect()} == {
        "question": 3, "answer": 2500, "tag": 1001, "comment:question": 1, "comment:answer": 1}
