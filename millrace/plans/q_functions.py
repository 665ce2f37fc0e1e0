"""Scalar functions over the role tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dates as D
from millrace.functions import text as T
from millrace.functions import urls as U
from millrace.functions import values as V
from millrace.plans.catalog import query
from millrace.plans.roles import Roles

FMT = "'%Y-%m-%d %H:%M:%S'"
SPACE_SQL = r"\s\x0B\x1C-\x1F\x{85}\p{Z}"


def sql_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^[{SPACE_SQL}]+|[{SPACE_SQL}]+$', '', 'g')"


def sql_decode(expr: str, rounds: int = 5) -> str:
    """Entity decoding in rounds; chr(1) stands for a decoded ampersand within a round."""
    for _ in range(rounds):
        for names, char in (("amp|38", "chr(1)"), ("nbsp|160", "' '"), ("lt|60", "'<'"), ("gt|62", "'>'"),
                            ("quot|34", "'\"'")):
            expr = f"regexp_replace({expr}, '&#?({names});', {char}, 'g')"
        expr = rf"regexp_replace({expr}, '&#?\w+;', '', 'g')"
        expr = f"replace({expr}, chr(1), '&')"
    return expr


def sql_lines(expr: str, strip: bool) -> str:
    line = sql_strip("x") if strip else "x"
    return (f"list_transform(list_filter(string_split({expr}, chr(10)), lambda x: {sql_strip('x')} <> ''), "
            f"lambda x: {line})")


def sql_strip_tags(expr: str) -> str:
    steps = [
        ("(?i)</p>", "chr(10)"), (r"(?i)//<!\[CDATA\[[^>]*//\]\]>", "''"),
        (r"(?i)<\s*script[^>]*>[^<]*<\s*/\s*script\s*>", "''"),
        (r"(?i)<\s*style[^>]*>[^<]*<\s*/\s*style\s*>", "''"), (r"<br\s*?/?>", "chr(10)"),
        (r"</?\w+[^>]*>", "''"), ("<!--[^>]*-->", "''"), (r"\n+", "chr(10)"),
    ]
    for pattern, new in steps:
        expr = f"regexp_replace({expr}, '{pattern}', {new}, 'g')"
    lines = sql_lines(sql_decode(expr), strip=True)
    return f"coalesce(array_to_string(list_transform({lines}, lambda x: x || chr(10)), ''), '')"


HREFS = ["/a/b?x=1", "c.html", "../up/d", "./g", "?page=2", "#top", "//cdn.example.org/e", "https://abs.example.com/f"]


@query("url_join", r"""
WITH b AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*') AS origin,
                  regexp_replace(url, '[?#].*$', '') AS bare, regexp_replace(url, '#.*$', '') AS unhashed FROM pages),
     d AS (SELECT *, CASE WHEN length(bare) = length(origin) THEN '/'
                     ELSE regexp_replace(substr(bare, length(origin) + 1), '[^/]*$', '') END AS dir FROM b)
SELECT page_id, unnest(['/a/b?x=1', 'c.html', '../up/d', './g', '?page=2', '#top', '//cdn.example.org/e',
                        'https://abs.example.com/f']) AS href,
       unnest([origin || '/a/b?x=1', origin || dir || 'c.html',
               origin || regexp_replace(dir, '[^/]+/$', '') || 'up/d', origin || dir || 'g',
               bare || '?page=2', unhashed || '#top', regexp_extract(url, '^[a-z]+:') || '//cdn.example.org/e',
               'https://abs.example.com/f']) AS absolute FROM d""")
def url_join(r: Roles):
    hrefs = F.explode(F.array(*[F.lit(h) for h in HREFS]))
    return r.pages.select("page_id", "url", hrefs.alias("href")).select(
        "page_id", "href", U.url_join("url", "href").alias("absolute")
    )


@query("url_host_path", r"""
SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host, path,
       list_extract(string_split(path, '/'), -1) AS file_name,
       CASE WHEN contains(list_extract(string_split(path, '/'), -1), '.')
            THEN '.' || list_extract(string_split(path, '.'), -1) ELSE '' END AS suffix,
       'editor' AS section
FROM (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages)""")
def url_host_path(r: Roles):
    forum = F.concat(F.regexp_extract("url", U.ORIGIN, 1), F.lit("/forums/editor."), "page_id", F.lit("/"))
    parts = r.pages.select("page_id", U.url_parts("url").alias("p"), U.section_base(forum).alias("section"))
    return parts.select("page_id", "p.host", "p.path", "p.file_name", "p.suffix", "section")


@query("id_from_link", """
SELECT question_id, question_id::VARCHAR AS by_path, question_id::VARCHAR AS by_dash,
       author_id::VARCHAR AS by_hash FROM questions""", "questions")
def id_from_link(r: Roles):
    return r.questions.select(
        "question_id",
        U.link_id("link").alias("by_path"),
        U.link_id(F.concat(F.lit("thread-"), "question_id"), "dash").alias("by_dash"),
        U.link_id(F.concat(F.lit("#"), "author_id"), "hash").alias("by_hash"),
    )


@query("strip_tags", f"SELECT page_id, {sql_strip_tags('html')} AS text FROM pages")
def strip_tags(r: Roles):
    return r.pages.select("page_id", T.strip_tags("html").alias("text"))


@query("decode_entities", f"SELECT page_id, {sql_decode('html')} AS text FROM pages")
def decode_entities(r: Roles):
    return r.pages.select("page_id", T.decode_entities("html").alias("text"))


LOOSE = "replace(html, '><', '>' || chr(10) || ' ' || chr(10) || '<')"


@query("clean_html", rf"""
SELECT page_id, array_to_string({sql_lines(
    r"regexp_replace(regexp_replace(" + LOOSE + r", '<div class=\"ad\">[\s\S]*?</div>', '', 'g'), "
    r"'<script[\s\S]*?</script>', '', 'g')", False)}, chr(10)) AS html FROM pages""".replace('\\"', '"'))
def clean_html(r: Roles):
    loose = F.replace("html", F.lit("><"), F.lit(">\n \n<"))
    blocks = [r'<div class="ad">[\s\S]*?</div>', r"<script[\s\S]*?</script>"]
    return r.pages.select("page_id", T.clean_html(loose, blocks).alias("html"))


@query("rewrite_strong", r"""
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(replace(html, '<br>', '</b> <B></b><b>'),
       '</b>(\s*)<b>', '\1', 'g'), '(?i)<b>', '<p>', 'g'), '(?i)</b>', '</p>', 'g') AS html FROM pages""")
def rewrite_strong(r: Roles):
    html = F.replace("html", F.lit("<br>"), F.lit("</b> <B></b><b>"))
    return r.pages.select("page_id", T.rewrite_strong(html, "b").alias("html"))


@query("rewrite_nth_image", """
SELECT page_id, parts[1] || array_to_string(list_transform(parts[2:], lambda p, i:
       '<img src="' || CASE WHEN i <= 3 THEN '/img/' || page_id || '-' || i || '.png' || substr(p, strpos(p, '"'))
                            ELSE p END), '') AS html
FROM (SELECT page_id, string_split(replace(html, '<a href="', '<img src="'), '<img src="') AS parts FROM pages)""")
def rewrite_nth_image(r: Roles):
    html = F.replace("html", F.lit('<a href="'), F.lit('<img src="'))
    stored = F.transform(
        F.array(*[F.lit(i) for i in (1, 2, 3)]),
        lambda i: F.concat(F.lit("/img/"), F.col("page_id"), F.lit("-"), i, F.lit(".png")),
    )
    return r.pages.select("page_id", T.replace_nth(html, r'(<img [\s\S]*?src=")([\s\S]*?)(?=")', stored).alias("html"))


@query("first_or_empty", f"""
SELECT doc_id, CASE WHEN category = 'es' THEN '' ELSE {sql_strip('title')} END AS first FROM articles""", "articles")
def first_or_empty(r: Roles):
    lines = F.when(F.col("category") != "es", F.split("body", "\n"))
    lines = F.coalesce(lines, F.array().cast("array<string>"))
    return r.articles.select("doc_id", T.first_or_empty(lines).alias("first"))


@query("join_texts", f"SELECT doc_id, {sql_strip('body')} AS joined FROM articles", "articles")
def join_texts(r: Roles):
    return r.articles.select("doc_id", T.join_texts(F.split("body", "\n")).alias("joined"))


@query("rule_function", """
SELECT question_id, CASE WHEN state = 'Accepted' THEN strftime(update_time, '%Y年%m月%d日')
       ELSE 'Posted on' || chr(10) || strftime(update_time, '%Y年%m月%d日') || ' by ' || author_id END AS publish_time
FROM questions""", "questions")
def rule_function(r: Roles):
    day = F.date_format("update_time", "yyyy年MM月dd日")
    texts = F.array(F.lit("  Posted on"), F.concat(day, F.lit(" by "), "author_id"))
    rule = F.when(F.col("state") == "Accepted", "osc").otherwise("huxiu")
    return r.questions.select("question_id", T.apply_rule_fn(rule, "publish_time", texts).alias("publish_time"))


@query("rule_udf_registry", f"""
SELECT doc_id, CASE WHEN category = 'fr' THEN 'FR: ' || title ELSE {sql_strip("title || chr(10) || category")} END AS title
FROM articles""", "articles")
def rule_udf_registry(r: Roles):
    texts = F.array("title", "category")
    T.register_rule_fn("fr", "title", lambda found: F.concat(F.lit("FR: "), F.get(found, 0)))
    try:
        title = T.apply_rule_fn("category", "title", texts)
    finally:
        T.remove_rule_fn("fr", "title")
    return r.articles.select("doc_id", title.alias("title"))


@query("parse_dates", f"""
SELECT event_id, unnest(range(6))::BIGINT AS form,
       unnest([second, second, day, second, day, NULL]) AS parsed
FROM (SELECT event_id, strftime(ts, {FMT}) AS second, strftime(ts, '%Y-%m-%d 00:00:00') AS day FROM events)""")
def parse_dates(r: Roles):
    ts = F.col("ts")
    forms = [
        F.date_format(ts, "MMM d, yyyy hh:mm:ss a"), F.date_format(ts, "yyyy, MMM dd 'at' HH:mm:ss'+0000'"),
        F.date_format(ts, "MMM d, yyyy"), F.date_format(ts, "yyyy-MM-dd H:m:s"), F.date_format(ts, "yyyy-MM-dd"),
        F.lit("yesterday"),
    ]
    rows = r.table("events").select("event_id", F.posexplode(F.array(*forms)).alias("form", "text"))
    return rows.select(
        "event_id", F.col("form").cast("long").alias("form"), D.format_ts(D.parse_any_date("text")).alias("parsed")
    )


@query("epoch_convert", f"""
SELECT event_id, epoch(date_trunc('second', ts))::BIGINT AS seconds, strftime(ts, {FMT}) AS back,
       strftime(ts, '%Y%m%d%H%M%S') AS stamp, strftime(ts, '%Y%m%d%H%M%S')::BIGINT + 7 AS number FROM events""")
def epoch_convert(r: Roles):
    rows = r.table("events").select("event_id", "ts", D.to_epoch("ts").alias("seconds"))
    return rows.select(
        "event_id", "seconds", D.format_ts(D.from_epoch("seconds")).alias("back"),
        D.run_stamp("ts").alias("stamp"), D.run_number("ts", 7).alias("number"),
    )


@query("date_assemble", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:00') AS timed, strftime(ts, '%Y-%m-%d 00:00:00') AS midnight,
       strftime(ts, '%Y-%m-%d 00:00:00') AS head_date, event_type AS location FROM events""")
def date_assemble(r: Roles):
    day, clock = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm")
    head = D.head_line(F.concat(F.lit(" "), day, F.lit(" \t "), "event_type", F.lit(" x")))
    rows = r.table("events").select(
        "event_id", D.assemble_ts(day, clock).alias("timed"), D.assemble_ts(day).alias("midnight"), head.alias("head")
    )
    return rows.select(
        "event_id", D.format_ts("timed").alias("timed"), D.format_ts("midnight").alias("midnight"),
        D.format_ts("head.pubdate").alias("head_date"), "head.location",
    )


@query("digits_only", """
SELECT question_id, view_count AS views, (score::VARCHAR || '2')::BIGINT AS short FROM questions""", "questions")
def digits_only(r: Roles):
    return r.questions.select(
        "question_id",
        V.digits_only(F.format_number("view_count", 0)).alias("views"),
        V.digits_only(F.concat("score", F.lit(".2K"))).alias("short"),
    )


@query("thousands", """
SELECT question_id, CASE WHEN view_count < 1000 THEN view_count
       ELSE trunc(((view_count // 1000) || '.' || (view_count % 1000 // 100))::DOUBLE * 1000)::BIGINT END AS views,
       score FROM questions""", "questions")
def thousands(r: Roles):
    v = F.col("view_count")
    short = F.concat(F.floor(v / 1000), F.lit("."), F.floor(F.pmod(v, F.lit(1000)) / 100), F.lit("k"))
    text = F.when(v < 1000, v.cast("string")).otherwise(short)
    return r.questions.select(
        "question_id", V.thousands(text).alias("views"), V.thousands(F.concat(F.lit(" "), "score")).alias("score")
    )


@query("labelled_stats", """
SELECT question_id, score::VARCHAR AS score,
       CASE WHEN imported THEN 1200 ELSE view_count END::BIGINT AS view_count FROM questions""", "questions")
def labelled_stats(r: Roles):
    labels = F.array(
        F.concat(F.lit("Votes:"), "score"), F.lit("Answers:2"), F.concat(F.lit("Views: "), "view_count")
    )
    short = F.when(F.col("imported"), "1.2k")
    return r.questions.select("question_id", V.labelled_stats(labels, short).alias("s")).select("question_id", "s.*")


@query("null_token", """
SELECT question_id, CASE WHEN state = 'Accepted' THEN question_id::VARCHAR END AS accept_id,
       state = 'Accepted' AS is_accepted, CASE WHEN imported THEN 'True' ELSE 'False' END AS imported_text,
       imported AS imported_back FROM questions""", "questions")
def null_token(r: Roles):
    stored = F.when(F.col("state") == "Accepted", F.col("question_id").cast("string")).when(
        F.col("imported"), "NULL").otherwise("")
    text = V.flag_text("imported")
    return r.questions.select(
        "question_id", V.null_token(stored).alias("accept_id"), V.is_accepted(stored).alias("is_accepted"),
        text.alias("imported_text"), V.flag_value(text).alias("imported_back"),
    )


@query("split_list", """
SELECT question_id, CASE WHEN imported THEN 0 ELSE 3 END::BIGINT AS n,
       CASE WHEN imported THEN '' ELSE question_id || ',' || author_id || ',' || section END AS joined
FROM questions""", "questions")
def split_list(r: Roles):
    text = F.when(~F.col("imported"), F.concat_ws(",", "question_id", "author_id", "section")).otherwise("")
    items = V.split_list(text)
    return r.questions.select(
        "question_id", F.size(items).cast("long").alias("n"), V.join_list(items).alias("joined")
    )


@query("md5_key", "SELECT doc_id, md5(body) AS key FROM articles", "articles")
def md5_key(r: Roles):
    return r.articles.select("doc_id", V.md5_key("body").alias("key"))
