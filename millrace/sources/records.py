"""Record files: JSON lines, one folder per crawler, and bulk index lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import col
from millrace.operators.dedup import dedup_last
from millrace.session import cut_lineage

LINE = ["_file", "_block", "_line"]


def read_jsonl(spark: SparkSession, path: str, schema: str, key: Sequence[str] = ()) -> DataFrame:
    """Records of JSON lines; with `key`, the last line of a key wins."""
    rows = spark.read.schema(schema).json(path)
    if not key:
        return rows
    # Lines of one block are read by one task in file order.
    placed = rows.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    return dedup_last(placed, key, LINE).drop(*LINE)


def json_line(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line."""
    df.write.mode(mode).json(path)


def export_partitioned(df: DataFrame, path: str, key: str, mode: str = "errorifexists") -> None:
    """JSON files in one folder per crawler. Rebalancing splits the rows of a large
    crawler over tasks and packs those of small ones together."""
    df.hint("rebalance", key).write.mode(mode).partitionBy(key).json(path)


def doc_key(id_col: str, parts: Sequence[str] = ("part", "comment_part")) -> Column:
    """Index id of a document row: the plain id, or id and part numbers for further parts."""
    numbers = [F.col(p) for p in parts]
    whole = F.lit(True)
    for n in numbers:
        whole = whole & (n == 0)
    plain = F.col(id_col).cast("string")
    return F.when(whole, plain).otherwise(F.concat_ws("-", plain, *[n.cast("string") for n in numbers]))


def to_bulk_lines(df: DataFrame, index: str, doc_type: str, id_col: Column | str, fields: Sequence[str]) -> DataFrame:
    """Search bulk format: the action line and its document line as one string, which
    no split can part."""
    action = F.to_json(F.struct(F.struct(
        F.lit(index).alias("_index"), F.lit(doc_type).alias("_type"), col(id_col).alias("_id")
    ).alias("index")))
    return df.withColumn("lines", F.concat(action, F.lit("\n"), json_line(*fields)))


def write_bulk(df: DataFrame, path: str) -> None:
    df.select("lines").write.text(path)


def index_rows(docs: DataFrame, id_col: str, fields: Sequence[str], parts: Sequence[str] = ("part", "comment_part")) -> DataFrame:
    """Built documents as rows of an index: (doc_id, key, digest, json), one for each part of a document."""
    json = json_line(*fields)
    return docs.select(F.col(id_col).alias("doc_id"), doc_key(id_col, parts).alias("key"), _digest(json).alias("digest"), json.alias("json"))


def _digest(json: Column | str) -> Column:
    return F.sha2(json, 256)


def index_changes(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """What an index has to do for some documents: (doc_id, key, action, digest, json).

    `rows` holds all parts of the documents it names.  Parts that are new or have another digest are `index`, parts
    that a document no longer has are `delete`; equal parts and other documents are not mentioned.  Of `existing` only
    keys and digests are read.  What differs is stored once; digests move as bytes, those of `rows` are made after the move.
    """
    old = existing.select("doc_id", "key", F.unhex("digest").alias("_old"))
    both = old.join(rows.select("doc_id", "key", "json"), ["doc_id", "key"], "full").withColumn("digest", _digest("json"))
    action = F.when(F.col("digest").isNull(), "delete").when(F.col("_old").isNull() | (F.col("_old") != F.unhex("digest")), "index")
    found = cut_lineage(both.select("doc_id", "key", action.alias("action"), "digest", "json").where("action IS NOT NULL"))
    gone = found.where("action = 'delete'").join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    return found.where("action = 'index'").unionByName(gone)


def upsert_documents(existing: DataFrame, changes: DataFrame) -> DataFrame:
    """The index after its changes."""
    kept = existing.join(changes.select("key"), "key", "left_anti")
    return kept.unionByName(changes.where("action = 'index'").select(*existing.columns))


def change_lines(changes: DataFrame, index: str, doc_type: str) -> DataFrame:
    """Changes in search bulk format: an action line, and its document line where there is one."""
    head = F.struct(F.lit(index).alias("_index"), F.lit(doc_type).alias("_type"), F.col("key").alias("_id"))
    index_line, delete_line = (F.to_json(F.struct(head.alias(name))) for name in ("index", "delete"))
    lines = F.when(F.col("action") == "delete", delete_line).otherwise(F.concat(index_line, F.lit("\n"), "json"))
    return changes.withColumn("lines", lines)
