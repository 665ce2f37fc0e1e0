"""RSS and Atom feeds, from XML columns or files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.dates import parse_any_date
from millrace.functions.text import strip_ws

RSS_ITEM = "title string, link string, pubDate string"
RSS = "channel struct<item: array<struct<title: string, link: string, pubDate: string>>>"
ATOM_ENTRY = "title string, link struct<_href: string>, id string, published string, updated string"
ATOM = (
    "entry array<struct<title: string, link: struct<_href: string>, id: string, published: string, updated: string>>"
)
OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE"}


def _text(c: str) -> Column:
    return F.coalesce(strip_ws(c), F.lit(""))


def _items(rows: DataFrame, crawlkey: Column) -> DataFrame:
    return rows.select(
        crawlkey.alias("crawlkey"), _text("item.title").alias("title"), _text("item.link").alias("link"),
        parse_any_date("item.pubDate", ["yyyy-MM-dd HH:mm:ss"]).alias("pubdate"),
    )


def parse_rss(df: DataFrame, xml: str, crawlkey: Column) -> DataFrame:
    """Items of RSS documents held in a column."""
    feed = F.from_xml(F.col(xml), RSS, OPTIONS)
    return _items(df.select(crawlkey.alias("_key"), F.explode(feed["channel"]["item"]).alias("item")), F.col("_key"))


def read_rss(spark: SparkSession, path: str, crawlkey: str) -> DataFrame:
    """Items of RSS files, read in parallel splits."""
    rows = spark.read.format("xml").options(rowTag="item", **OPTIONS).schema(RSS_ITEM).load(path)
    return _items(rows.select(F.struct("*").alias("item")), F.lit(crawlkey))


def _entries(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("entry.title").alias("title"), F.col("entry.link._href").alias("link"), F.col("entry.id").alias("id"),
        F.col("entry.published").alias("published"), F.col("entry.updated").alias("updated"),
    )


def parse_atom(df: DataFrame, xml: str) -> DataFrame:
    """Entries of Atom documents held in a column, with or without a namespace prefix."""
    return _entries(df.select(F.explode(F.from_xml(F.col(xml), ATOM, OPTIONS)["entry"]).alias("entry")))


def read_atom(spark: SparkSession, path: str, row_tag: str = "entry") -> DataFrame:
    """Entries of Atom files; `row_tag` is ``atom:entry`` where the feed uses a prefix."""
    rows = spark.read.format("xml").options(rowTag=row_tag, **OPTIONS).schema(ATOM_ENTRY).load(path)
    return _entries(rows.select(F.struct("*").alias("entry")))
