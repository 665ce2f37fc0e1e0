"""The registered queries against their SQL twins, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from millrace.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
NATIVE = ("op1_licenses", "op4_fingerprints")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs.count(), stage(spark, docs, SF).cache()
        assert docs.columns == columns and 0.8 * before <= docs.count() <= before, name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


def test_pipeline_takes_odd_rows(spark):
    rows = [(1, None, "en", "s", 0, 5), (2, "", "en", "s", 0, 5), (None, "plain words of no id", None, None, None, None),
            (3, "the same words stand here twice", "en", "s", 31, 5), (4, "the same words stand here twice", "en", "s", 31, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept"]
    assert {r["doc_id"] for r in docs.collect()} == {None, 3}
    empty = docs.where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_copies_of_one_id_or_none_are_kept_once(spark):
    words = [f"w{i}" for i in range(60)]
    text, near = " ".join(words), " ".join([*words, "more"])
    rows = [(1, text, "b"), (1, text, "a"), (1, near, "a"), (None, "other " + " ".join(words[::-1]), None), (None, " ".join(words[::-1]), None),
            (None, " ".join(words[::-1]), None), (1, "quite different words stand in this text", "a"), (2, "", None), (3, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.dedup_near(spark, docs, SF).collect()
    assert sorted(r["doc_id"] or 9 for r in got) == [1, 1, 2, 3, 9]
    assert "b" not in {r["source"] for r in got}
    line, more = "a line of nine words that both documents hold here", "another line of nine words that they both do hold"
    shared = spark.createDataFrame([(i, f"{own}\n{line}\n{more}") for i in (7, None) for own in (f"one {i}", f"two {i}")], "doc_id long, text string")
    for stage in (corpus_pipeline.dedup_lines, corpus_pipeline.dedup_substrings):
        assert sum(line in r["text"] for r in stage(spark, shared, SF).collect()) == 1
