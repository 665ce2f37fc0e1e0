"""Page tables and their pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.markup import image_sources
from millrace.functions.text import col
from millrace.functions.urls import url_join


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page table (page_id, url, html): columns not used later are not read."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def image_manifest(
    df: DataFrame, html: Column | str, url: str = "url", prefix: str = "/images/"
) -> DataFrame:
    """Image rows of each record: ordinal, source url, stored name, public url.

    The stored name is the two-digit ordinal, a digest of record url and ordinal, and
    the suffix of the source, so a repeated run names the same image alike.
    """
    images = df.select(
        *[c for c in df.columns if c != "html"], F.posexplode(image_sources(col(html))).alias("_at", "_src")
    )
    ordinal = F.col("_at") + 1
    file_name = F.substring_index("_src", "/", -1)
    stored = F.concat(
        F.format_string("%02d", ordinal), F.md5(F.concat(F.col(url), ordinal.cast("string"))),
        F.lit("."), F.substring_index(file_name, ".", -1),
    )
    return images.withColumns({
        "ordinal": ordinal.cast("long"), "source_url": url_join(url, "_src"), "stored_name": stored,
        "public_url": F.concat(F.lit(prefix), stored),
    }).drop("_at", "_src")
