"""The link graph as data.

Rounds are joins over whole tables, cut by checkpoints in the shared folder.  Edges
into or out of a hub are joined to at most one row per node, and repeated targets are
combined map-side, so a hub is never gathered in one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from millrace.operators.filters import filter_domains, filter_urls
from millrace.operators.joins import active_rules
from millrace.operators.skew import hot_keys, lookup_join
from millrace.session import cut_lineage, scratch_path


def next_frontier(
    links: DataFrame,
    seen: DataFrame,
    allow: Sequence[str] = (),
    deny: Sequence[str] = (),
    domains: Sequence[str] = (),
    url: str = "url",
) -> DataFrame:
    """Distinct allowed links that were not seen before."""
    fit = filter_domains(filter_urls(links.select(url), url, allow, deny), url, domains)
    return fit.distinct().join(seen.select(url), url, "left_anti")


def bucketed(df: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """`df` as a stored table in sorted buckets of `key`: equality joins on it leave it where it lies."""
    spark = df.sparkSession
    name, path = f"bucketed_{uuid.uuid4().hex}", scratch_path(spark, "buckets")
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(count, key).write.bucketBy(count, key).sortBy(key)
    writer.option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def bfs(edges: DataFrame, starts: DataFrame, max_depth: int | None = None, hubs: list[Row] | None = None) -> DataFrame:
    """Breadth-first depth of every page reachable from the start pages.

    `edges` is (src, dst); `starts` is (page).  The edges are laid out once in buckets of `src`, and each round
    moves the newest level to them.  Edges out of hubs (as for `hot_keys`) are stored apart, where a round meets them
    with a broadcast of the hubs it reached.
    """
    edges = edges.select("src", "dst")
    hubs = hot_keys(edges, ["src"]) if hubs is None else hubs
    spread = None
    if hubs:
        names = F.broadcast(edges.sparkSession.createDataFrame([(r["src"],) for r in hubs], edges.select("src").schema))
        spread = cut_lineage(edges.join(names, "src", "left_semi"))
        edges = edges.join(names, "src", "left_anti")
    placed = bucketed(edges, "src")
    level = cut_lineage(starts.select(F.col("page")).distinct().withColumn("depth", F.lit(0).cast("long")))
    reached, depth = level, 0
    while (max_depth is None or depth < max_depth) and not level.isEmpty():
        depth += 1
        nodes = next_nodes(placed, level)
        if spread is not None:
            few = level.join(names.select(F.col("src").alias("page")), "page", "left_semi")  # at most one row per hub
            nodes = nodes.union(spread.join(F.broadcast(few.select(F.col("page").alias("src"))), "src", "left_semi").select("dst"))
        level = cut_lineage(
            nodes.distinct().join(reached.select("page"), "page", "left_anti").withColumn("depth", F.lit(depth).cast("long"))
        )
        reached = reached.unionByName(level)
    return reached


def next_nodes(edges: DataFrame, level: DataFrame) -> DataFrame:
    """(`page`) behind the edges of a level; `edges` in buckets of `src` are not moved."""
    return edges.join(level.select(F.col("page").alias("src")), "src", "left_semi").select(F.col("dst").alias("page"))


def walk_rules(links: DataFrame, rules: DataFrame) -> DataFrame:
    """The crawl of each active rule, from its start urls to the end: (name, url, kind, depth).

    `links` is (name, src, kind, url) as from `rule_links`.  Pages of the kind `1 list` hand their links on, articles do
    not.  A url is met once in each rule, by its first link; lists come before articles of the same round.
    Links are laid out once in buckets of rule and page; a round moves the newest level to them.
    """
    node = lambda url: F.concat_ws("\n", "name", url)
    placed = bucketed(links.select(node("src").alias("src"), "name", "kind", "url"), "src")
    starts = active_rules(rules).select("name", F.explode("starts").alias("url")).distinct()
    level = cut_lineage(starts.select(node("url").alias("page"), "name", "url", F.lit("1 list").alias("kind"), F.lit(0).cast("long").alias("depth")))
    reached, depth = level, 0
    while not level.isEmpty():
        depth += 1
        lists = level.where("kind = '1 list'").select(F.col("page").alias("src"))
        found = placed.join(lists, "src", "left_semi").groupBy("name", "url").agg(F.min("kind").alias("kind"))
        found = found.withColumn("page", node("url")).join(reached.select("page"), "page", "left_anti")
        level = cut_lineage(found.select("page", "name", "url", "kind", F.lit(depth).cast("long").alias("depth")))
        reached = reached.unionByName(level)
    return reached.drop("page")


def page_chain(pages: DataFrame) -> DataFrame:
    """Head, page number and total of each page of a thread, from next-page links.

    `pages` is (page_id, next_id).  A page that several name as next follows the least of them, and the chains of
    the others end before it.  A cycle begins at its least page.  Rows without a page id take no part.
    Links are doubled: after round k every page knows the page 2**k before it or the head of its thread, so a
    thread of n pages takes about log2(n) rounds, and a cycle as many again.
    """
    pages = pages.where(F.col("page_id").isNotNull()).select("page_id", "next_id")
    before = pages.filter("next_id IS NOT NULL").groupBy(F.col("next_id").alias("page_id")).agg(F.min("page_id").alias("prev"))
    linked = pages.select("page_id").distinct().join(before, "page_id", "left")
    state = _double(cut_lineage(_start(linked, F.col("prev").isNull())))
    rings = state.where("NOT done").select("page_id")
    if not rings.isEmpty():
        ring = cut_lineage(rings.join(before, "page_id"))
        least = _least_of_ring(ring)
        cut = ring.join(least, "page_id").select("page_id", "prev", (F.col("low") == F.col("page_id")).alias("head"))
        state = state.where("done").unionByName(_double(cut_lineage(_start(cut, F.col("head")))))
    placed = state.select("page_id", F.col("jump").alias("head_id"), (F.col("steps") + 1).alias("page_number"))
    totals = placed.groupBy("head_id").agg(F.max("page_number").alias("total"))
    return lookup_join(placed, totals, ["head_id"], "left")


def _start(linked: DataFrame, head: Column) -> DataFrame:
    return linked.select("page_id", F.when(head, F.col("page_id")).otherwise(F.col("prev")).alias("jump"),
                         (~head).cast("long").alias("steps"), head.alias("done"))


def _double(state: DataFrame) -> DataFrame:
    """Doubles the jumps until every page stands on its head, or none came to stand on one: the rest are cycles.

    The page next behind the finished ones of a chain always finishes, so a round without one leaves cycles only.
    """
    open_before = None
    while (open_now := state.agg(F.count_if(~F.col("done"))).first()[0]) not in (0, open_before):
        open_before = open_now
        target = state.select(
            F.col("page_id").alias("jump"), F.col("jump").alias("_jump"), F.col("steps").alias("_steps"),
            F.col("done").alias("_done"),
        )
        moved = state.filter("NOT done").join(target, "jump").select(
            "page_id", F.col("_jump").alias("jump"), (F.col("steps") + F.col("_steps")).alias("steps"),
            F.col("_done").alias("done"),
        )
        state = cut_lineage(state.filter("done").unionByName(moved))
    return state


def _least_of_ring(ring: DataFrame) -> DataFrame:
    """(`page_id`, `low`): the least page of the cycle of each page, by doubling until nothing changes."""
    state = cut_lineage(ring.select("page_id", F.col("prev").alias("jump"), F.least("page_id", "prev").alias("low"), F.lit(True).alias("moved")))
    while not state.where("moved").isEmpty():
        target = state.select(F.col("page_id").alias("jump"), F.col("jump").alias("_jump"), F.col("low").alias("_low"))
        state = cut_lineage(state.join(target, "jump").select(
            "page_id", F.col("_jump").alias("jump"), F.least("low", "_low").alias("low"), (F.col("_low") < F.col("low")).alias("moved")))
    return state.select("page_id", "low")
