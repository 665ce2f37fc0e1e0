"""Records out of page tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import markup as M
from millrace.functions.selectors import select_fields
from millrace.functions.text import apply_rule_fn, let, strip_tags, strip_ws
from millrace.functions.urls import section_base, url_join
from millrace.operators.filters import domain_of, url_allowed
from millrace.operators.graph import page_chain
from millrace.operators.joins import match_rules, rules_of_pages
from millrace.operators.paging import top_n
from millrace.session import cut_lineage


def extract_list(df: DataFrame, container: Column, fields: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """One row per repeated container of a list page, with its position from 1."""
    others = [c for c in df.columns if c != "html"]
    rows = df.select(*others, F.posexplode(container).alias("_at", "_entry"))
    return rows.select(
        *others, (F.col("_at") + 1).cast("long").alias("pos"),
        *[field(F.col("_entry")).alias(name) for name, field in fields.items()],
    )


def extract_by_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Articles by the rule of each page: title, body and time by its selectors or its
    own functions, and the site name of the rule."""
    matched = match_rules(pages, rules)
    selectors = F.array("title_xpath", "body_xpath", "publish_time_xpath")
    found = matched.withColumn("_found", select_fields("html", selectors))
    values = {
        name: apply_rule_fn("name", name, F.get("_found", i))
        for i, name in enumerate(("title", "body", "publish_time"))
    }
    return found.select("page_id", "url", *[v.alias(k) for k, v in values.items()], "source_site")


@dataclass(frozen=True)
class LinkRule:
    """Links of a page region whose absolute url is allowed and not denied."""

    name: str
    region: Callable[[Column], Column]
    allow: Sequence[str] = ()
    deny: Sequence[str] = ()


def extract_links(pages: DataFrame, rules: Sequence[LinkRule]) -> DataFrame:
    """Links as (page_id, rule, pos, href, url, text).

    The first rule that claims a link wins, and a page yields each url once; both are
    settled inside the row, before any link leaves its page.
    """

    def claimed(rule: LinkRule, order: int) -> Column:
        found = F.transform(
            M.links(rule.region(F.col("html"))),
            lambda a, i: F.struct(
                F.lit(order).alias("order"), F.lit(rule.name).alias("rule"), (i + 1).cast("long").alias("pos"),
                a["href"].alias("href"), url_join(F.col("url"), a["href"]).alias("url"), a["text"].alias("text"),
                a["title"].alias("title"), a["css"].alias("css"),
            ),
        )
        return F.filter(found, lambda a: url_allowed(a["url"], rule.allow, rule.deny))

    def once(all_links: Column) -> Column:
        """The first link of each url, found by sorting urls with their places, then in page order again."""
        keyed = F.array_sort(F.transform(all_links, lambda a, i: F.struct(a["url"].alias("url"), i.alias("at"))))
        first = lambda k: F.filter(k, lambda x, i: x["url"].isNotNull() & ((i == 0) | ~F.get(k, i - 1)["url"].eqNullSafe(x["url"])))
        places = F.array_sort(F.transform(let(keyed, first), lambda x: x["at"]))
        return F.transform(places, lambda at: F.get(all_links, at))

    every = F.concat(*[claimed(rule, i) for i, rule in enumerate(rules)])
    kept = let(every, once)
    links = pages.select("page_id", F.explode(kept).alias("a"))
    return links.select("page_id", "a.rule", "a.pos", "a.href", "a.url", "a.text", "a.title", "a.css")


SPEC = r"^//(\w+)(?:\[@([\w-]+)=\"([^\"\\]*)\"\])?$"


def region_pattern(spec: Column | str) -> Column:
    """The pattern of a page region named by a column: `//tag` or `//tag[@name="value"]`; others are refused."""
    part = lambda i: F.regexp_extract(spec, SPEC, i)
    named = F.when(part(2) != "", F.concat(F.lit("(?=[^>]*\\s"), part(2), F.lit('="\\Q'), part(3), F.lit('\\E")'))).otherwise("")
    pattern = F.concat(F.lit("(?i)<"), part(1), F.lit("\\b"), named, F.lit("[^>]*>[\\s\\S]*?</"), part(1), F.lit(">"))
    return F.when(part(1) != "", pattern).otherwise(F.raise_error(F.concat(F.lit("unknown region: "), spec)).cast("string"))


def rule_links(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """The links that the rule table lets a walk follow: (name, src, kind, url), each once.

    `kind` is `1 list` for links in the region `next_page` of a rule and `2 article` for those in its region
    `extract_from` (everywhere if empty) whose url fits `allow_url`.  Both stay in the domains of the rule.  Fragments
    are cut off.  Every page is read once, whether the walk gets there or not; the walk itself is `walk_rules`.
    """
    matched = rules_of_pages(pages.select("url", "html"), rules)
    in_region = lambda spec: F.call_function("regexp_extract", "html", region_pattern(spec), F.lit(0))
    regions = {
        "1 list": F.when(F.col("next_page") != "", in_region("next_page")),
        "2 article": F.when(F.col("extract_from") != "", in_region("extract_from")).otherwise(F.col("html")),
    }

    def links_of(kind: str, region: Column) -> Column:
        hrefs = F.transform(M.links(region), lambda a: F.struct(F.lit(kind).alias("kind"), a["href"].alias("href")))
        return F.coalesce(hrefs, F.array().cast("array<struct<kind:string,href:string>>"))

    found = F.concat(*[links_of(kind, region) for kind, region in regions.items()])
    rows = matched.select("name", "domains", "allow_url", F.col("url").alias("src"), F.explode(found).alias("a"))
    rows = rows.select("name", "domains", "allow_url", "src", "a.kind", F.regexp_replace(url_join("src", "a.href"), "#.*$", "").alias("url"))
    inside = F.arrays_overlap(domain_of("url"), "domains")
    fits = (F.col("kind") == "1 list") | F.expr("rlike(url, allow_url)")
    return rows.where(inside & fits).select("name", "src", "kind", "url").distinct()


def extract_fragment(html: Column | str, tag: str, attrs: str = "") -> Column:
    """A content region with its tags (`htmlcontent`) and as text (`content`)."""
    return let(
        M.region(html, tag, attrs), lambda r: F.struct(r.alias("htmlcontent"), strip_tags(r).alias("content"))
    )


def next_page(html: Column | str, url: Column | str, kind: str, value: str) -> Column:
    """Absolute url of the next-page link, found by its `text`, `title` or `css` class; null at the end."""
    # A pager may show the link twice; by text the last one counts, else the first.
    wanted = F.filter(M.links(html), lambda a: strip_ws(a[kind]) == value)
    href = F.try_element_at(wanted, F.lit(-1 if kind == "text" else 1))["href"]
    return let(href, lambda h: F.when(h.isNotNull(), url_join(url, h)))


def extract_tags(html: Column, url: Column, base_tag: Column | None = None, id_from: str = "text") -> Column:
    """Tags of a piece as array of (tag_id, link, tag); the base tag comes first.

    The id is the tag text, or with `id_from='path'` the second last part of its link.
    """
    tags = F.transform(
        M.links(html),
        lambda a: F.struct(
            (a["text"] if id_from == "text" else F.try_element_at(F.split(a["href"], "/"), F.lit(-2))).alias("tag_id"),
            url_join(url, a["href"]).alias("link"), a["text"].alias("tag"),
        ),
    )
    if base_tag is None:
        return tags
    return F.concat(F.array(F.struct(base_tag.alias("tag_id"), url.alias("link"), base_tag.alias("tag"))), tags)


def base_tag(url: Column | str) -> Column:
    return section_base(url)


def extract_posts(
    pages: DataFrame, containers: Column, thread: str, staff: str, accepted: str
) -> DataFrame:
    """Posts of thread pages in page order: the first is the question, the others its answers."""
    others = [c for c in pages.columns if c != "html"]
    rows = pages.select(*others, F.posexplode(containers).alias("_at", "body"))
    number = (F.col("_at") + 1).cast("long")
    is_question = number == 1
    return rows.select(
        *others, number.alias("post_number"), F.when(is_question, "question").otherwise("answer").alias("post_type"),
        F.when(~is_question, F.col(thread)).alias("parent_id"), "body",
        M.flag("body", staff).alias("is_staff"), (~is_question & M.flag("body", accepted)).alias("is_accepted"),
    )


PAGES_PER_BLOCK = 1000  # pages of a thread whose posts one task counts through


def thread_posts(
    pages: DataFrame,
    containers: Column,
    staff: str,
    accepted: str,
    fields: Mapping[str, Callable[[Column], Column]] | None = None,
    repeats_question: bool = False,
) -> DataFrame:
    """Posts of whole threads, counted through all pages of a thread.

    `pages` is (page_id, next_id, html, ...), linked by their next-page links as in `page_chain`; `containers` are
    the posts of a page.  The first post of a thread is its question and comes once: with `repeats_question` each
    later page begins with it again.  `fields` reads more columns (score, times) from the html of a post.
    Posts are (thread_id, page_id, page_number, pos, post_number, post_type, parent_id, body, is_staff, is_accepted,
    fields..., other columns of the page); a page without posts gives none.
    """
    others = [c for c in pages.columns if c not in ("page_id", "next_id", "html")]
    chain = page_chain(pages.select("page_id", "next_id")).withColumnRenamed("head_id", "thread_id").drop("total")
    later = (F.col("page_number") > 1) & F.lit(repeats_question)
    found = pages.select("page_id", *others, containers.alias("_posts")).join(chain, "page_id")
    found = found.withColumn("_posts", F.when(later, F.slice("_posts", 2, F.greatest(F.size("_posts") - 1, F.lit(0)))).otherwise(F.col("_posts")))
    found = cut_lineage(found)
    counts = found.select("thread_id", "page_id", "page_number", F.size("_posts").cast("long").alias("n"))
    ahead = _posts_before(counts)
    rows = found.join(ahead, "page_id").select(
        "thread_id", "page_id", "page_number", *others, "_before", F.posexplode("_posts").alias("_at", "body"))
    number = F.col("_before") + F.col("_at") + 1
    asked = F.col("post_number") == 1
    rows = rows.withColumn("post_number", number.cast("long"))
    return rows.select(
        "thread_id", "page_id", "page_number", (F.col("_at") + 1).cast("long").alias("pos"), "post_number",
        F.when(asked, "question").otherwise("answer").alias("post_type"), F.when(~asked, F.col("thread_id")).alias("parent_id"), "body",
        M.flag("body", staff).alias("is_staff"), (~asked & M.flag("body", accepted)).alias("is_accepted"),
        *[field(F.col("body")).alias(name) for name, field in (fields or {}).items()], *others,
    )


def _posts_before(counts: DataFrame) -> DataFrame:
    """(`page_id`, `_before`): posts on earlier pages of the thread, summed in blocks of pages and then over blocks."""
    counts = counts.withColumn("_block", F.floor(F.col("page_number") / PAGES_PER_BLOCK))
    earlier = lambda keys, place: Window.partitionBy(*keys).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(earlier(["thread_id", "_block"], "page_number")), F.lit(0))
    blocks = counts.groupBy("thread_id", "_block").agg(F.sum("n").alias("_n"))
    shift = F.coalesce(F.sum("_n").over(earlier(["thread_id"], "_block")), F.lit(0))
    shifts = blocks.select("thread_id", "_block", shift.alias("_shift"))
    both = counts.withColumn("_inside", inside).join(shifts, ["thread_id", "_block"])
    return both.select("page_id", (F.col("_inside") + F.col("_shift")).alias("_before"))


FAILED_BODY = "scrapy failed"  # fixed value: stored where no body was found


def needs_refetch(pages: DataFrame, marker: str, body: str | None = None) -> DataFrame:
    """Pages without their required region, or with a failed body."""
    bad = ~M.flag("html", marker)
    if body:
        bad = bad | (F.col(body) == FAILED_BODY)
    return pages.filter(bad)


def build_digest(
    df: DataFrame, order: Sequence[str], n: int = 6, by: Sequence[str] = (), image: Column | None = None
) -> DataFrame:
    """The top entries as HTML: a heading, then the lines joined by breaks with an
    optional strong lead; an entry with an image has the heading only.

    Input has title, lines (array) and lead (null if none).
    """
    heading = F.concat(F.lit("<h3>"), F.col("title"), F.lit("</h3>"))
    lead = F.when(F.col("lead") != "", F.concat(F.lit("<strong>"), "lead", F.lit("</strong><br/>")))
    text = F.concat(heading, F.coalesce(lead, F.lit("")), F.array_join("lines", "<br/>"))
    content = text if image is None else F.when(image, heading).otherwise(text)
    return top_n(df, n, order, by).withColumn("content", content)


def parse_pages(
    pages: DataFrame, parser: Callable[[str, str], Iterable[dict]], schema: str, keep: Sequence[str] = ("page_id",)
) -> DataFrame:
    """Records of a user-supplied parser `(url, html) -> dicts`, none or many per page.

    `schema` names the kept page columns and the fields of the parser.
    """
    keep = list(keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            heads = batch[keep].to_dict("records")
            records = [
                {**head, **record}
                for head, url, html in zip(heads, batch["url"], batch["html"])
                for record in parser(url, html)
            ]
            if records:
                yield pd.DataFrame.from_records(records)

    columns = list(dict.fromkeys([*keep, "url", "html"]))
    return pages.select(*columns).mapInPandas(run, schema)
