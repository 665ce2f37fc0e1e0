"""Link graph and article assignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.markup import inner
from millrace.operators import graph as G
from millrace.operators.assign import assign_articles
from millrace.operators.extract import LinkRule, extract_links, rule_links
from millrace.plans.catalog import query
from millrace.plans.q_extract import LINKS_SQL
from millrace.plans.roles import Roles
from millrace.session import cut_lineage


@query("link_frontier", rf"""
SELECT DISTINCT origin || href AS url FROM ({LINKS_SQL})
WHERE regexp_matches(href, '^/\w') AND NOT regexp_matches(href, 'ing$')
  AND regexp_matches(origin, '[/.]example\.(com|org)$')
  AND origin || href NOT IN (SELECT regexp_extract(url, '^[a-z]+://[^/?#]*') || '/the' FROM pages)""")
def link_frontier(r: Roles):
    links = extract_links(r.pages, [LinkRule("nav", lambda html: inner(html, "nav"))])
    seen = r.pages.select(F.concat(F.regexp_extract("url", "^[a-z]+://[^/?#]*", 0), F.lit("/the")).alias("url"))
    return G.next_frontier(links, seen, [r"://[^/]*/\w"], ["ing$"], ["example.com", "example.org"])


@query("rule_walk", """
SELECT name, url, kind, depth FROM (
  WITH RECURSIVE n AS (SELECT count(*) AS n FROM pages),
  web AS (SELECT page_id AS id, ['com', 'org', 'net'][page_id % 3 + 1] AS tld FROM pages),
  e AS (SELECT tld, '/p/' || id AS src, '1 list' AS kind, '/p/' || (4 * id + 3) AS dst FROM web
        UNION ALL SELECT tld, '/p/' || id, '1 list', '/p/' || (id + 3) FROM web WHERE id % 5 = 0
        UNION ALL SELECT tld, '/p/' || id, '2 article', '/p/' || (id + 6) FROM web WHERE (id + 6) % 4 = 0
        UNION ALL SELECT tld, '/p/' || id, '2 article', '/a/' || id FROM web WHERE id % 4 = 0),
  walk(tld, path, kind, depth) USING KEY (tld, path) AS (
    SELECT * FROM (VALUES ('com', '/p/0', '1 list', 0::BIGINT), ('org', '/p/1', '1 list', 0), ('net', '/p/2', '1 list', 0)) AS starts(tld, path, kind, depth)
    UNION SELECT e.tld, e.dst, min(e.kind), min(walk.depth + 1) FROM walk JOIN e ON e.tld = walk.tld AND e.src = walk.path AND walk.kind = '1 list'
      LEFT JOIN recurring.walk AS known ON known.tld = e.tld AND known.path = e.dst WHERE known.path IS NULL GROUP BY e.tld, e.dst)
  SELECT 'walk_' || tld AS name, 'http://www.example.' || tld || path AS url, kind, depth FROM walk)""")
def rule_walk(r: Roles):
    """The given pages at new urls, with a pager and a list of articles added to each."""
    tld = F.get(F.array(*map(F.lit, ("com", "org", "net"))), F.pmod("page_id", F.lit(3)).cast("int"))
    link = lambda path: F.concat(F.lit('<a href="'), path, F.lit('">x</a>'))
    page = lambda number: link(F.concat(F.lit("/p/"), number))
    number = F.col("page_id")
    pager = F.concat(F.lit('<div class="pager">'), page(number * 4 + 3), F.when(number % 5 == 0, page(number + 3)).otherwise(""), F.lit("</div>"))
    listed = F.concat(F.lit('<div id="x" class="list">'), page(number + 6), link(F.concat(F.lit("a/../../a/"), number, F.lit("#top"))),
                      link(F.concat(F.lit("http://other.test/p/"), number)), F.lit("</div>"))
    web = r.pages.select(F.concat(F.lit("http://www.example."), tld, F.lit("/p/"), number).alias("url"), F.concat("html", pager, listed).alias("html"))
    names = "name allow_domains start_urls next_page allow_url extract_from enable".split()
    rules = r.spark.createDataFrame([
        (f"walk_{t}", f"example.{t},www.example.{t}", f"http://www.example.{t}/p/{i}", '//div[@class="pager"]', r"/[ap]/([048]|\d*([02468][048]|[13579][26]))$",
         '//div[@class="list"]', 1) for i, t in enumerate(("com", "org", "net"))], " string, ".join(names[:-1]) + " string, enable int")
    return G.walk_rules(rule_links(web, rules), rules)


@query("bfs_depth", """
SELECT page, depth FROM (
  WITH RECURSIVE walk(page, depth) USING KEY (page) AS (SELECT 0::BIGINT, 0::BIGINT
    UNION SELECT dst, min(walk.depth + 1) FROM walk JOIN edges ON src = walk.page
      LEFT JOIN recurring.walk AS known ON known.page = dst WHERE known.page IS NULL GROUP BY dst)
  SELECT * FROM walk)""", "edges")
def bfs_depth(r: Roles):
    starts = r.table("part").filter("p_partkey = 0").select(F.col("p_partkey").alias("page"))
    return G.bfs(cut_lineage(r.edges), starts)


@query("page_chain", """
SELECT o_orderkey AS page_id, first_value(o_orderkey) OVER w AS head_id,
       row_number() OVER w AS page_number, count(*) OVER (PARTITION BY o_custkey) AS total
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def page_chain(r: Roles):
    return G.page_chain(r.chain)


@query("assign_articles", """
WITH ranked AS (SELECT c_custkey AS account_id, row_number() OVER (ORDER BY c_custkey) AS place FROM customer),
d AS (SELECT doc_id, url, ('0x' || substr(md5('day-1' || url), 1, 15))::BIGINT AS digest FROM articles)
SELECT doc_id, account_id FROM d JOIN ranked ON place = digest % (SELECT count(*) FROM customer) + 1""", "articles")
def assign(r: Roles):
    accounts = r.table("customer").select(F.col("c_custkey").alias("account_id"))
    return assign_articles(r.articles.select("doc_id", "url"), accounts, "day-1").select("doc_id", "account_id")
