"""URL filters: rules on hosts and path prefixes, found by hash prefixes of the url's expressions.

A url gives the expressions `host suffix, path prefix` whose lengths occur among the rules: suffixes begin at a label,
prefixes anywhere.  Each is hashed; the first 32 bits are joined with those of the rules, and the whole digests
confirm.  The rule with most characters wins, then the longer host, then `block`.

Urls without `://` and null urls have an empty host and path, which no rule with a host fits.  Repeated rows are
judged alike, each once.  An empty table of rules leaves every url to the default verdict.  Rules with a null part are
left out.  Very long urls are judged whole.  An empty table of pages gives an empty table.  Result columns replace
columns of the pages that bear the same names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower
from millrace.session import cut_lineage

PREFIX = 8  # hex digits of the digest that are joined first
DEFAULT = "allow"


def rest_of(url: Column) -> Column:
    """What stands behind the first `://`; null if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(rest_of(url), r"^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest_of(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _lengths(rules: DataFrame, column: str) -> list[int]:
    """The lengths that occur; at most as many as the longest rule has characters."""
    return sorted(r[0] for r in rules.select(F.char_length(column)).distinct().collect())


def _suffixes(host: Column, lengths: list[int]) -> Column:
    n = F.char_length(host)
    start = lambda x: n - x + 1
    fits = lambda x: (n == x) | ((n > x) & (F.substr(host, start(x) - 1, F.lit(1)) == "."))
    return F.transform(F.filter(F.lit(lengths).cast("array<int>"), fits), lambda x: F.substr(host, start(x), x))


def _prefixes(path: Column, lengths: list[int]) -> Column:
    fitting = F.filter(F.lit(lengths).cast("array<int>"), lambda x: x <= F.char_length(path))
    return F.transform(fitting, lambda x: F.substr(path, F.lit(1), x))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """`pages` with `host, path, rule, verdict`; `rules` has `host, path, verdict` (`allow` or `block`)."""
    rules = rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict").dropna().groupBy("host", "path").agg(
        F.max("verdict").alias("verdict"))  # of both, block
    rules = rules.withColumn("full", digest(F.col("host"), F.col("path"))).withColumn("prefix", F.substring("full", 1, PREFIX))
    hosts, paths = _lengths(rules, "host"), _lengths(rules, "path")
    pages = pages.drop("host", "path", "rule", "verdict").withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    if not hosts:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    own = pages.select("host", "path").distinct()
    parts = own.select("host", "path", F.explode(_suffixes(F.col("host"), hosts)).alias("suffix"))
    parts = parts.select("host", "path", "suffix", F.explode(_prefixes(F.col("path"), paths)).alias("beginning"))
    parts = parts.select("host", "path", digest(F.col("suffix"), F.col("beginning")).alias("own"))
    parts = parts.withColumn("prefix", F.substring("own", 1, PREFIX))
    found = parts.join(rules.select("prefix", "full", F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict"), "prefix")
    found = found.where(F.col("own") == F.col("full"))
    rank = F.struct(F.char_length(F.concat("rule_host", "rule_path")).alias("n"), F.char_length("rule_host").alias("host_n"),
                    F.col("verdict"), F.concat("rule_host", "rule_path").alias("rule"))
    best = cut_lineage(found.groupBy("host", "path").agg(F.max(rank).alias("best"))
                       .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict")))
    judged = pages.join(best, ["host", "path"], "left")
    return judged.select(*[F.col(c) for c in pages.columns], "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
