"""Extraction over the page table."""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import markup as M
from millrace.functions.dates import format_ts, from_epoch
from millrace.functions.selectors import select_fields
from millrace.functions.urls import ORIGIN
from millrace.operators import extract as E
from millrace.plans.catalog import query
from millrace.plans.q_functions import sql_strip, sql_strip_tags
from millrace.plans.roles import Roles

LIS = "regexp_extract_all(html, '<li>(.*?)</li>', 1)"


def sql_text(expr: str) -> str:
    """Decode the two entities that occur in article texts."""
    return f"replace(replace({expr}, '&quot;', '\"'), '&amp;', '&')"


@query("list_rows", f"""
SELECT page_id, i AS pos, regexp_extract(li, 'href="([^"]*)"', 1) AS href, regexp_extract(li, '>([^<]*)</a>', 1) AS title
FROM (SELECT page_id, unnest({LIS}) AS li, generate_subscripts({LIS}, 1) AS i FROM pages)""")
def list_rows(r: Roles):
    fields = {"href": lambda e: M.attribute(e, "href"), "title": lambda e: F.get(M.links(e), 0)["text"]}
    return E.extract_list(r.pages.drop("url"), M.all_inner("html", "li"), fields)


ARTICLE = "regexp_extract(html, '<article>(.*?)</article>', 1, 's')"
BODY_TEXTS = f"regexp_extract_all(regexp_replace({ARTICLE}, '^.*?</h1>', '</h1>', 's'), '>([^<]+)', 1)"


@query("rule_extract", f"""
SELECT m.page_id, m.url, {sql_strip(sql_text("regexp_extract(html, '<h1>(.*?)</h1>', 1)"))} AS title,
       {sql_strip(sql_text(f"array_to_string({BODY_TEXTS}, chr(10))"))} AS body, '' AS publish_time, source_site
FROM matched m JOIN pages USING (page_id)""", "matched")
def rule_extract(r: Roles):
    return E.extract_by_rules(r.pages, r.rules)


SELECTORS = {
    "title": "//title/text()",
    "last_link": "//nav/ul/li[last()]/a/text()",
    "hrefs": "//nav//a/@href",
    "later_hrefs": "/html/body/nav/ul/li[position()>1]/a/@href",
    "ad": '//div[starts-with(@class, "a")]/text()|//div[contains(@class,"zz")]/text()',
    "heading": '//article/*[1]/text()|//meta[@charset="utf-8"]/@charset',
}


@query("field_select", f"""
SELECT page_id, {sql_text("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS title,
       list_extract(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1), -1) AS last_link,
       array_to_string(regexp_extract_all(html, '<a href="([^"]*)"', 1), ' ') AS hrefs,
       array_to_string(regexp_extract_all(html, '<a href="([^"]*)"', 1)[2:], ' ') AS later_hrefs,
       regexp_extract(html, '<div class="ad">(.*?)</div>', 1, 's') AS ad,
       {sql_text("regexp_extract(html, '<h1>(.*?)</h1>', 1)")} || ' utf-8' AS heading FROM pages""")
def field_select(r: Roles):
    found = r.pages.select(
        "page_id", select_fields("html", F.array(*[F.lit(s) for s in SELECTORS.values()])).alias("f")
    )
    return found.select(
        "page_id", *[F.array_join(F.get("f", i), " ").alias(name) for i, name in enumerate(SELECTORS)]
    )


NAV = "regexp_extract(html, '<nav>(.*?)</nav>', 1, 's')"
HREFS = f"regexp_extract_all({NAV}, 'href=\"([^\"]*)\"', 1)"
TEXTS = f"regexp_extract_all({NAV}, '<a href=\"[^\"]*\">([^<]*)</a>', 1)"
LINKS_SQL = f"""SELECT page_id, unnest({HREFS}) AS href, generate_subscripts({HREFS}, 1) AS pos, unnest({TEXTS}) AS text,
    regexp_extract(url, '^[a-z]+://[^/?#]*') AS origin FROM pages"""
RULES = [
    E.LinkRule("t_words", lambda html: M.inner(html, "nav"), allow=[r"/[tT]\w*$"]),
    E.LinkRule("others", lambda html: M.inner(html, "nav"), deny=["ing$"]),
]


@query("extract_links", rf"""
SELECT page_id, rule, pos, href, origin || href AS url, text FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id, href ORDER BY pos) AS rn FROM (
    SELECT *, CASE WHEN regexp_matches(origin || href, '/[tT]\w*$') THEN 't_words'
                   WHEN NOT regexp_matches(href, 'ing$') THEN 'others' END AS rule FROM ({LINKS_SQL}))
  WHERE rule IS NOT NULL) WHERE rn = 1""")
def extract_links(r: Roles):
    return E.extract_links(r.pages, RULES).drop("title", "css")


@query("inner_fragment", f"""
SELECT page_id, regexp_extract(html, '<article>.*?</article>', 0, 's') AS htmlcontent,
       {sql_strip_tags("regexp_extract(html, '<article>.*?</article>', 0, 's')")} AS content FROM pages""")
def inner_fragment(r: Roles):
    return r.pages.select("page_id", E.extract_fragment("html", "article").alias("f")).select("page_id", "f.*")


@query("next_page", """
SELECT page_id, CASE WHEN closed THEN origin || '/p/' || page_id END AS by_text,
       CASE WHEN closed THEN origin || '/t/' || page_id END AS by_title,
       CASE WHEN closed THEN origin || '/c/' || page_id END AS by_css
FROM (SELECT page_id, contains(html, '</html>') AS closed, regexp_extract(url, '^[a-z]+://[^/?#]*') AS origin FROM pages)""")
def next_page(r: Roles):
    link = lambda attrs, path, text: F.concat(
        F.lit(f'<a {attrs} href="{path}'), F.col("page_id"), F.lit(f'">{text}</a>')
    )
    pager = F.concat(
        link('title="prev"', "/x/", "&lt; Prev"), link('class="text"', "/y/", "Next >"), link('title="next"', "/t/", "n"),
        link('class="next"', "/c/", "&gt;"), link('class="text"', "/p/", " Next > "),
    )
    html = F.when(F.contains("html", F.lit("</html>")), F.concat("html", pager)).otherwise(F.col("html"))
    kinds = {"by_text": ("text", "Next >"), "by_title": ("title", "next"), "by_css": ("css", "next")}
    return r.pages.select(
        "page_id", *[E.next_page(html, "url", kind, value).alias(name) for name, (kind, value) in kinds.items()]
    )


@query("extract_tags", f"""
SELECT page_id, len({TEXTS}) + 1 AS n, 'editor ' || array_to_string({TEXTS}, ' ') AS tag_ids,
       origin || '/forums/editor.1/ ' || array_to_string(list_transform({HREFS}, lambda h: origin || h), ' ') AS links
FROM (SELECT *, regexp_extract(url, '^[a-z]+://[^/?#]*') AS origin FROM pages)""")
def extract_tags(r: Roles):
    forum = F.concat(F.regexp_extract("url", ORIGIN, 1), F.lit("/forums/editor.1/"))
    tags = r.pages.select(
        "page_id", E.extract_tags(M.inner("html", "nav"), forum, E.base_tag(forum)).alias("tags")
    )
    return tags.select(
        "page_id", F.size("tags").cast("long").alias("n"),
        F.array_join(F.transform("tags", lambda t: t["tag_id"]), " ").alias("tag_ids"),
        F.array_join(F.transform("tags", lambda t: t["link"]), " ").alias("links"),
    )


@query("thread_posts", f"""
SELECT page_id, head AS thread_id, page_number, i AS pos, post_number, CASE WHEN post_number = 1 THEN 'question' ELSE 'answer' END AS post_type,
       CASE WHEN post_number > 1 THEN head END AS parent_id, regexp_replace(part, '</p>.*$', '', 's') AS body, contains(part, '<b>') AS is_staff,
       post_number > 1 AND contains(regexp_replace(part, '</p>.*$', '', 's'), '<br>') AS is_accepted, page_id % 50 AS score,
       strftime(TIMESTAMP '2024-01-01' + to_minutes(page_id::INT), '%Y-%m-%d %H:%M:%S') AS creation_time
FROM (SELECT *, row_number() OVER (PARTITION BY head ORDER BY page_number, i) AS post_number
      FROM (SELECT page_id, head, page_number, unnest(parts) AS part, generate_subscripts(parts, 1) AS i
            FROM (SELECT hosts.page_id, min(hosts.page_id) OVER (PARTITION BY host) AS head, row_number() OVER (PARTITION BY host ORDER BY hosts.page_id) AS page_number,
                         list_transform(string_split({ARTICLE}, '<p>')[2:], lambda p: '<i class="score">' || (page_id % 50) || '</i><i data-time="'
                             || (1704067200 + page_id * 60) || '"></i>' || p) AS parts FROM hosts JOIN pages USING (page_id))))""", "hosts")
def thread_posts(r: Roles):
    """The pages of a host as one thread, each post with a score and a time in its html."""
    by_host = Window.partitionBy("host").orderBy("page_id")
    linked = r.hosts.select("page_id", F.lead("page_id").over(by_host).alias("next_id"))
    marks = F.concat(F.lit('<p><i class="score">'), F.col("page_id") % 50, F.lit('</i><i data-time="'), F.col("page_id") * 60 + 1704067200, F.lit('"></i>'))
    pages = r.pages.select("page_id", F.replace("html", F.lit("<p>"), marks).alias("html")).join(linked, "page_id")
    fields = {
        "score": lambda b: F.regexp_extract(b, r'class="score">(\d+)<', 1).try_cast("long"),
        "creation_time": lambda b: format_ts(from_epoch(F.regexp_extract(b, r'data-time="(\d+)"', 1).try_cast("long"))),
    }
    return E.thread_posts(pages, M.opened(M.inner("html", "article"), "p"), "<b>", "<br>", fields)


@query("render_check", "SELECT page_id, url FROM pages WHERE NOT contains(html, '</html>')")
def render_check(r: Roles):
    return E.needs_refetch(r.pages, "</html>").select("page_id", "url")


@query("presence_flags", """
SELECT page_id, contains(html, 'class="ad"') AS has_ad, contains(html, '&amp;') AS has_amp,
       CASE WHEN contains(html, '</html>') THEN 'Accepted' ELSE 'notAccepted' END AS state FROM pages""")
def presence_flags(r: Roles):
    return r.pages.select(
        "page_id", M.flag("html", 'class="ad"').alias("has_ad"), M.flag("html", "&amp;").alias("has_amp"),
        M.accepted_state("html", "</html>").alias("state"),
    )


@query("digest_rows", """
SELECT source_site, doc_id, '<h3>' || title || '</h3>' || CASE WHEN category = 'es' THEN '' ELSE
       CASE WHEN category = 'fr' THEN '<strong>Nouveau</strong><br/>' ELSE '' END ||
       array_to_string(string_split(body, chr(10))[2:], '<br/>') END AS content
FROM (SELECT *, row_number() OVER (PARTITION BY source_site ORDER BY pubdate DESC, doc_id) AS rn FROM articles)
WHERE rn <= 6""", "articles")
def digest_rows(r: Roles):
    lines = F.split("body", "\n")
    entries = r.articles.select(
        "source_site", "doc_id", "pubdate", "category", "title", F.slice(lines, 2, F.size(lines)).alias("lines"),
        F.when(F.col("category") == "fr", "Nouveau").alias("lead"),
    )
    digest = E.build_digest(entries, ["-pubdate", "doc_id"], 6, ["source_site"], F.col("category") == "es")
    return digest.select("source_site", "doc_id", "content")


def heading_and_words(url: str, html: str):
    """A user parser: one record per navigation word, none for pages without any."""
    title = re.search(r"<title>([\s\S]*?)</title>", html)
    for place, word in enumerate(re.findall(r"<li>[\s\S]*?>([^<]*)</a></li>", html), 1):
        yield {"pos": place, "word": word, "title": title.group(1) if title else ""}


@query("selector_udtf", f"""
SELECT page_id, unnest({TEXTS}) AS word, generate_subscripts({TEXTS}, 1) AS pos,
       regexp_extract(html, '<title>(.*?)</title>', 1, 's') AS title FROM pages""")
def selector_udtf(r: Roles):
    return E.parse_pages(r.pages, heading_and_words, "page_id bigint, pos bigint, word string, title string")
