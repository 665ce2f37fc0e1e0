"""Role tables: projections of the given tables onto the library's data model.

Each role exists twice, as a DataFrame and as SQL for the comparison, see FIXTURES.md.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.urls import url_host
from millrace.operators.dedup import dedup_first, dedup_last
from millrace.operators.documents import CHUNK, accepted_id, nest
from millrace.operators.skew import with_position
from millrace.session import cut_lineage

NOW_QUESTIONS = "2002-01-01 00:00:00"
NOW_EVENTS = "2024-01-31 00:00:00"
LIST_PAGE = 30  # fixed value: entries per list page
STOP_DATE = "1999-01-01 00:00:00"
SUMMARY_STOP = "2001-01-01 00:00:00"


def ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


class Roles:
    """The given tables and the roles made of them, for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def pages(self) -> DataFrame:
        return self.table("pages")

    @cached_property
    def articles(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id"),
            F.concat(F.lit("/article/"), F.col("doc_id"), F.lit(".html")).alias("url"),
            F.substring_index("text", "\n", 1).alias("title"),
            F.col("text").alias("body"),
            F.col("source").alias("source_site"),
            F.col("lang").alias("category"),
            F.timestamp_add("HOUR", F.pmod("doc_id", F.lit(720)), ts("2024-01-01 00:00:00")).alias("pubdate"),
        )

    @cached_property
    def questions(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.table("orders").select(
            F.col("o_orderkey").alias("question_id"),
            F.col("o_orderpriority").alias("section"),
            F.col("o_custkey").alias("author_id"),
            F.col("o_orderdate").alias("update_time"),
            F.floor(F.col("o_totalprice") / 1000).cast("long").alias("score"),
            F.floor("o_totalprice").cast("long").alias("view_count"),
            F.when(status == "F", "Accepted").otherwise("notAccepted").alias("state"),
            (status == "P").alias("imported"),
            F.concat(F.lit("/questions/"), F.col("o_orderkey"), F.lit("/q.html")).alias("link"),
            F.concat(F.lit("Question "), F.col("o_orderkey")).alias("title"),
        )

    @cached_property
    def answers(self) -> DataFrame:
        line = dedup_first(
            self.table("lineitem"),
            ["l_orderkey", "l_linenumber"],
            ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"],
        )
        return line.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("answer_id"),
            F.col("l_orderkey").alias("parent_id"),
            F.col("l_linenumber").cast("long").alias("post_number"),
            F.col("l_shipdate").alias("creation_time"),
            F.col("l_quantity").cast("long").alias("score"),
            (F.col("l_returnflag") == "R").alias("is_accepted"),
            (F.col("l_linestatus") == "F").alias("is_staff"),
            F.concat(F.lit("Answer "), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("body"),
        )

    @cached_property
    def stored_answers(self) -> DataFrame:
        """Answers as a table of their own, for queries that read them several times."""
        return cut_lineage(self.answers)

    @cached_property
    def tagged(self) -> DataFrame:
        """Tags of posts, a pair as often as it was given."""
        parts = self.table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("tag_id"))
        return (
            self.table("lineitem").select(F.col("l_orderkey").alias("post_id"), "l_partkey")
            .join(parts, "l_partkey").select("post_id", "tag_id")
        )

    @cached_property
    def post_tags(self) -> DataFrame:
        return self.tagged.distinct()

    @cached_property
    def tag_lists(self) -> DataFrame:
        """Distinct tags of each question in order, in parts as those of `nest`; it has at most as many as the tag table."""
        tag = F.collect_set(F.struct("tag_id"))  # in a struct, as a set of plain values has no null
        sets = self.tagged.groupBy(F.col("post_id").alias("question_id")).agg(F.sort_array(tag).alias("all"))
        last = F.floor((F.size("all") - 1) / CHUNK).cast("int")
        parts = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("all", i * CHUNK + 1, CHUNK)["tag_id"])
        found = sets.select("question_id", F.posexplode(parts).alias("part", "tags"))
        return found.withColumn("part", F.col("part").cast("long"))

    @cached_property
    def qa(self) -> DataFrame:
        """Questions with accepted id and the comma lists of answers and tags.

        The accepted id is the last one marked in the lists, of whatever part.
        """
        answers = self.stored_answers.withColumnRenamed("parent_id", "question_id")
        own = nest(answers, ["question_id"], F.struct("answer_id", "is_accepted"), ["post_number"], "own", numbered=True)
        marked = F.try_element_at(F.filter("own", lambda a: a["is_accepted"]), F.lit(-1))["answer_id"]
        ids = own.select(
            "question_id", "part", F.array_join(F.transform("own", lambda a: a["answer_id"].cast("string")), ",").alias("answer_ids"),
            F.when(marked.isNotNull(), F.struct(F.col("part").alias("at"), marked.alias("answer_id"))).alias("marked"),
        )
        names = self.tag_lists.withColumn("tags", F.array_join("tags", ","))
        lists = ids.join(names, ["question_id", "part"], "full").withColumnRenamed("part", "list_part")
        accepted = F.max("marked").over(Window.partitionBy("question_id"))["answer_id"]
        return (
            self.questions.join(lists, "question_id", "left")
            .select(*self.questions.columns, accepted.alias("accept_id"),
                    F.coalesce("list_part", F.lit(0).cast("long")).alias("list_part"), "answer_ids", "tags")
        )

    @cached_property
    def accepts(self) -> DataFrame:
        """Questions with the id of their accepted answer."""
        return self.questions.join(
            accepted_id(self.stored_answers).withColumnRenamed("parent_id", "question_id"), "question_id", "left"
        )

    @cached_property
    def qa_posts(self) -> DataFrame:
        return self.stored_answers.withColumnRenamed("answer_id", "post_id")

    @cached_property
    def tags(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_brand").alias("tag_id"), F.concat(F.lit("/tags/"), "p_brand").alias("link"),
            F.col("p_brand").alias("name"),
        ).distinct()

    @cached_property
    def comments(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("comment_id"),
            F.floor(F.col("event_id") / 3).cast("long").alias("post_id"),
            F.col("event_type").alias("body"),
            F.col("ts").alias("creation_time"),
        )

    @cached_property
    def posts(self) -> DataFrame:
        return self.table("conversations").select(
            F.col("conv_id").alias("discussion_id"),
            (F.col("conv_id") * 100 + F.col("turn")).alias("post_id"),
            (F.col("turn") + 1).alias("post_number"),
            F.col("text").alias("body"),
            (F.col("role") == "assistant").alias("is_staff"),
        )

    @cached_property
    def items(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").alias("item_id"),
            F.col("ts").alias("update_time"),
            F.floor("value").cast("long").alias("view_count"),
            F.col("event_type").alias("process_type"),
            "event_id",
        )

    @cached_property
    def stored_items(self) -> DataFrame:
        early = self.items.filter(
            (F.col("update_time") < ts("2024-01-16 00:00:00")) & (F.col("process_type") == "purchase")
            & (F.col("view_count") >= 80)
        )
        return dedup_last(early, ["item_id"], ["update_time", "event_id"]).select(
            "item_id", "update_time", "view_count"
        )

    @cached_property
    def incoming_items(self) -> DataFrame:
        return self.items.filter(F.col("update_time") >= ts("2024-01-11 00:00:00"))

    @cached_property
    def stored_posts(self) -> DataFrame:
        """Known questions: closed ones as they are, open ones a day older."""
        day = F.expr("INTERVAL '1' DAY")
        old = F.col("o_orderstatus") == "O"
        return self.table("orders").filter("o_orderstatus IN ('F', 'O')").select(
            F.col("o_orderkey").alias("id"),
            F.concat(F.lit("/stored/"), "o_orderkey").alias("link"),
            F.concat(F.lit("Stored "), "o_orderkey").alias("title"),
            F.col("o_orderdate").alias("creation_time"),
            F.when(old, F.col("o_orderdate") - day).otherwise(F.col("o_orderdate")).alias("update_time"),
            F.lit(0).cast("long").alias("reply_count"),
            (F.floor("o_totalprice").cast("long") - F.when(old | (F.col("o_custkey") < 500), 5).otherwise(0)).alias(
                "view_count"
            ),
            F.lit(True).alias("imported"),
        )

    @cached_property
    def incoming_posts(self) -> DataFrame:
        """Open and pending questions as a new crawl sees them."""
        return self.table("orders").filter("o_orderstatus IN ('O', 'P')").select(
            F.col("o_orderkey").alias("id"),
            F.concat(F.lit("/q/"), "o_orderkey").alias("link"),
            F.when(F.col("o_custkey") > 10, F.concat(F.lit("Question "), "o_orderkey")).alias("title"),
            (F.col("o_orderdate") + F.expr("INTERVAL '1' DAY")).alias("creation_time"),
            F.col("o_orderdate").alias("update_time"),
            F.lit(1).cast("long").alias("reply_count"),
            F.floor("o_totalprice").cast("long").alias("view_count"),
            F.lit(False).alias("imported"),
        )

    def ranked_list(self) -> DataFrame:
        """Questions as entries of a list with their place in it, newest first."""
        return with_position(
            self.table("orders").select(
                F.col("o_orderkey").alias("question_id"),
                F.col("o_orderpriority").alias("section"),
                F.col("o_orderdate").alias("update_time"),
                F.floor("o_totalprice").cast("long").alias("view_count"),
                (F.col("o_orderstatus") == "F").alias("unchanged"),
            ),
            [], ["-update_time", "question_id"], "place",
        )

    def list_pages(self, size: int = LIST_PAGE, ranked: DataFrame | None = None) -> DataFrame:
        """The entries of the list, ranked already if given so, on pages of `size`."""
        ranked = self.ranked_list() if ranked is None else ranked
        page = F.ceil(F.col("place") / size).cast("long")
        return ranked.select(
            "question_id", "section", "update_time", "view_count", "unchanged", "place",
            page.alias("page"), (F.col("place") - (page - 1) * size).alias("pos"),
        )

    @cached_property
    def rules(self) -> DataFrame:
        rows = [
            (f"site_{d}", f"example.{d}", f"http://example.{d}/", "", allow, "//article",
             "//h1/text()", "//article/p//text()", "//span/text()", f"Example {d}", enable)
            for d, allow, enable in (("com", r"/(en|fr|de)/\d+", 1), ("org", r"/\w+/\d+", 1),
                                     ("net", r"/en/\d+", 1), ("net", r"/fr/\d+", 0))
        ]
        names = (
            "name allow_domains start_urls next_page allow_url extract_from title_xpath body_xpath "
            "publish_time_xpath source_site enable"
        ).split()
        structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
        return self.spark.range(1).select(F.inline(F.array(*structs)))

    @cached_property
    def edges(self) -> DataFrame:
        size = self.table("part").agg(F.count(F.lit(1)).alias("n")).scalar()
        return self.table("lineitem").select(
            F.col("l_partkey").alias("src"),
            F.pmod(F.col("l_partkey") * 7 + F.col("l_linenumber"), size).cast("long").alias("dst"),
        ).distinct()

    @cached_property
    def chain(self) -> DataFrame:
        """Next order of the same customer, as a next-page link."""
        numbered = with_position(
            self.table("orders").select("o_custkey", "o_orderdate", "o_orderkey"),
            ["o_custkey"], ["o_orderdate", "o_orderkey"], "n",
        )
        ahead = numbered.select("o_custkey", (F.col("n") - 1).alias("n"), F.col("o_orderkey").alias("next_id"))
        return numbered.join(ahead, ["o_custkey", "n"], "left").select(
            F.col("o_orderkey").alias("page_id"), "next_id"
        )

    @cached_property
    def hosts(self) -> DataFrame:
        return self.pages.select("page_id", "url", url_host("url").alias("host"))


ROLE_SQL: dict[str, str] = {
    "articles": """SELECT doc_id, '/article/' || doc_id || '.html' AS url, split_part(text, chr(10), 1) AS title,
        text AS body, source AS source_site, lang AS category,
        TIMESTAMP '2024-01-01' + to_hours((doc_id % 720)::INT) AS pubdate FROM documents""",
    "questions": """SELECT o_orderkey AS question_id, o_orderpriority AS section, o_custkey AS author_id,
        o_orderdate AS update_time, floor(o_totalprice / 1000)::BIGINT AS score,
        floor(o_totalprice)::BIGINT AS view_count,
        CASE WHEN o_orderstatus = 'F' THEN 'Accepted' ELSE 'notAccepted' END AS state,
        o_orderstatus = 'P' AS imported, '/questions/' || o_orderkey || '/q.html' AS link,
        'Question ' || o_orderkey AS title FROM orders""",
    "answers": """SELECT l_orderkey * 10 + l_linenumber AS answer_id, l_orderkey AS parent_id,
        l_linenumber::BIGINT AS post_number, l_shipdate AS creation_time, l_quantity::BIGINT AS score,
        l_returnflag = 'R' AS is_accepted, l_linestatus = 'F' AS is_staff,
        'Answer ' || l_orderkey || '-' || l_linenumber AS body
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""",
    "post_tags": """SELECT DISTINCT l_orderkey AS post_id, p_brand AS tag_id
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "qa": """SELECT q.*, accept_id, answer_ids, tags FROM questions q
        LEFT JOIN (SELECT parent_id AS question_id, arg_max(answer_id, post_number) FILTER (is_accepted) AS accept_id,
              string_agg(answer_id::VARCHAR, ',' ORDER BY post_number) AS answer_ids FROM answers GROUP BY 1)
        USING (question_id)
        LEFT JOIN (SELECT post_id AS question_id, string_agg(tag_id, ',' ORDER BY tag_id) AS tags
              FROM post_tags GROUP BY 1) USING (question_id)""",
    "tags": "SELECT DISTINCT p_brand AS tag_id, '/tags/' || p_brand AS link, p_brand AS name FROM part",
    "comments": """SELECT event_id AS comment_id, event_id // 3 AS post_id, event_type AS body,
        ts AS creation_time FROM events""",
    "posts": """SELECT conv_id AS discussion_id, conv_id * 100 + turn AS post_id, turn + 1 AS post_number,
        text AS body, role = 'assistant' AS is_staff FROM conversations""",
    "items": """SELECT user_id AS item_id, ts AS update_time, floor(value)::BIGINT AS view_count,
        event_type AS process_type, event_id FROM events""",
    "stored_items": """SELECT item_id, update_time, view_count FROM (SELECT *, row_number() OVER
        (PARTITION BY item_id ORDER BY update_time DESC, event_id DESC) AS rn FROM items
        WHERE update_time < TIMESTAMP '2024-01-16' AND process_type = 'purchase' AND view_count >= 80)
        WHERE rn = 1""",
    "incoming_items": "SELECT * FROM items WHERE update_time >= TIMESTAMP '2024-01-11'",
    "stored_posts": """SELECT o_orderkey AS id, '/stored/' || o_orderkey AS link, 'Stored ' || o_orderkey AS title,
        o_orderdate AS creation_time,
        CASE WHEN o_orderstatus = 'O' THEN o_orderdate - INTERVAL 1 DAY ELSE o_orderdate END AS update_time,
        0::BIGINT AS reply_count,
        floor(o_totalprice)::BIGINT - CASE WHEN o_orderstatus = 'O' OR o_custkey < 500 THEN 5 ELSE 0 END AS view_count,
        true AS imported FROM orders WHERE o_orderstatus IN ('F', 'O')""",
    "incoming_posts": """SELECT o_orderkey AS id, '/q/' || o_orderkey AS link,
        CASE WHEN o_custkey > 10 THEN 'Question ' || o_orderkey END AS title,
        o_orderdate + INTERVAL 1 DAY AS creation_time, o_orderdate AS update_time, 1::BIGINT AS reply_count,
        floor(o_totalprice)::BIGINT AS view_count, false AS imported
        FROM orders WHERE o_orderstatus IN ('O', 'P')""",
    "list_pages": """SELECT *, (place - 1) // 30 + 1 AS page, (place - 1) % 30 + 1 AS pos,
        (place - 1) // 100 + 1 AS page100, (place - 1) % 100 + 1 AS pos100
        FROM (SELECT o_orderkey AS question_id, o_orderpriority AS section, o_orderdate AS update_time,
              floor(o_totalprice)::BIGINT AS view_count, o_orderstatus = 'F' AS unchanged,
              row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS place FROM orders)""",
    "rules": r"""SELECT * FROM (VALUES
        ('site_com', 'example.com', '/(en|fr|de)/\d+', 'Example com', 1),
        ('site_org', 'example.org', '/\w+/\d+', 'Example org', 1),
        ('site_net', 'example.net', '/en/\d+', 'Example net', 1),
        ('site_net', 'example.net', '/fr/\d+', 'Example net', 0))
        AS t(name, domain, allow_url, source_site, enable)""",
    "hosts": r"""SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host FROM pages""",
    "matched": r"""SELECT page_id, url, name, source_site FROM hosts JOIN rules
        ON (host = domain OR host LIKE '%.' || domain) AND regexp_matches(url, allow_url) WHERE enable = 1""",
    "edges": """SELECT DISTINCT l_partkey AS src, (l_partkey * 7 + l_linenumber) % (SELECT count(*) FROM part) AS dst
        FROM lineitem""",
    "chain": """SELECT o_orderkey AS page_id, lead(o_orderkey) OVER
        (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_id FROM orders""",
}
NEEDS = {
    "qa": ["questions", "answers", "post_tags"],
    "stored_items": ["items"], "incoming_items": ["items"], "matched": ["hosts", "rules"],
}


def role_sql(names: list[str], sql: str, recursive: bool = False) -> str:
    """`sql` with the named roles, and the roles they read, as leading CTEs."""
    wanted = {*names, *(need for name in names for need in NEEDS.get(name, []))}
    parts = [f"{name} AS ({body})" for name, body in ROLE_SQL.items() if name in wanted]
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        parts.append(body[5:])
        body = ", ".join(parts)
    else:
        body = (", ".join(parts) + " " if parts else "") + body
    return f"WITH {'RECURSIVE ' if recursive else ''}{body}" if parts else body
