"""Spreading articles over subscriber accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.paging import top_n
from millrace.operators.skew import lookup_join, with_position


def assign_articles(
    articles: DataFrame, accounts: DataFrame, seed: str, newest: int | None = None, key: str = "url", ts: str = "pubdate"
) -> DataFrame:
    """Give each article to one account, at random but repeatably for a seed.

    The digest of seed and article picks a place in the ranking of the accounts.
    """
    if newest is not None:
        articles = top_n(articles, newest, [f"-{ts}", key])
    size = accounts.agg(F.count(F.lit(1)).alias("n")).scalar()
    digest = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col(key))), 1, 15), 16, 10).cast("long")
    ranked = with_position(accounts.select("account_id"), [], ["account_id"], "_place")
    picked = articles.withColumn("_place", F.pmod(digest, size) + 1)
    return lookup_join(picked, ranked, ["_place"]).drop("_place")
