"""A pipeline from raw documents to packed training sequences; each stage is one of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import language, line_dedup, near_dedup, packing, substring_dedup
from millrace.llm.common import HASH, KEY, with_key
from millrace.session import scratch_path

SURE = 0.5  # least probability of the language found; with less, or without letters, a document is rejected


def _with_text(docs: DataFrame, new: DataFrame) -> DataFrame:
    """The columns of `docs` from `new`, with the number of characters brought up to date."""
    count = F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return new.select(*[count.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def find_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is found; the column `lang` gets it."""
    found = language.detect(docs, language.fit(docs), lang_pred="__lang", score="__score")
    kept = found.where((F.col("__lang") != language.UNDETERMINED) & (F.col("__score") >= SURE))
    return kept.select(*[F.col("__lang").alias(c) if c == "lang" else F.col(c) for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out blocks of lines that earlier documents hold."""
    return _with_text(docs, line_dedup.remove_common_lines(docs, removed="__removed"))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps exactly one row of each group of near-duplicates, the first by id, hash of the text and the other columns.

    Null ids rank last.  Documents without words are like no others; of rows that agree in id and text one is kept.
    """
    judged = near_dedup.linked(docs).select(F.coalesce("doc_id", F.lit(2**63 - 1)).alias(KEY), HASH, "root")
    document = F.struct(KEY, HASH)
    first = judged.where("root IS NOT NULL").groupBy("root").agg(F.min(document).alias("first")).select("first.*")
    first = first.union(judged.where("root IS NULL").select(KEY, HASH)).distinct()
    order = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(0)]
    rows = with_key(docs, "doc_id", "text").withColumn("__row", F.row_number().over(Window.partitionBy(KEY, HASH).orderBy(*order)))
    return rows.where("__row = 1").join(first, [KEY, HASH], "left_semi").select(*docs.columns)


def dedup_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out passages that stand earlier."""
    return _with_text(docs, substring_dedup.remove_repeats(docs, removed="__removed"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 ids."""
    return packing.pack(docs)


STAGES = [
    ("language", find_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("substring_dedup", dedup_substrings),
    ("packing", pack),
]

ORACLE_SQL = None  # models, alignments and token ids are beyond SQL; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
