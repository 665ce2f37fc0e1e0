"""The registered queries of the operators, on the given tables with production parameters, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (bpe, conversation_trie, fingerprints, language, licenses, line_dedup, near_dedup, neighbours, packing,
                          quality_rules, spelling, substring_dedup, url_filters)

LEARN_PARTS, HELD_OUT = 3, 1
FAMILY, MOST = 100, 6
SLIP_EVERY = 97
#: Fixed values of the url query.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", *columns)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return neighbours.nearest(vectors, F.col("id") % 20 == 0)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), with_ids=False).drop("ids")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(_documents(spark, sf_dir))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.linked(_documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.remove_common_lines(_documents(spark, sf_dir))
    return done.select("doc_id", "text", "removed_lines")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return url_filters.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "lang")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(LEARN_PARTS)) == HELD_OUT, F.lit(False))
    model = language.fit(docs, F.col("doc_id").isNotNull() & ~held_out)
    found = language.detect(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.remove_repeats(_documents(spark, sf_dir))
    return done.select("doc_id", "text", "removed")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(_documents(spark, sf_dir)).select("doc_id", "ids")
    done = bpe.decode(encoded)
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.turns_of(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversation_trie.prefix_trie(*conversation_trie.with_shared_heads(turns, FAMILY, MOST))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    spelled = spelling.slips(spelling.runs(_documents(spark, sf_dir)), SLIP_EVERY)
    return spelling.variants(spelling.vocabulary(spelled))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_documents(spark, sf_dir)).drop("text", "clean_text")


QUERIES = {f.__name__: f for f in (op1_licenses, op2_neighbours, op3_packing, op4_fingerprints, op5_near_dedup, op6_line_dedup, op7_url_filters,
                                   op8_language, op9_substring_dedup, op10_bpe, op11_conversation_trie, op12_spelling, op13_quality_rules)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: The unsigned CRC-32 of a string in SQL: a table of 256 steps, then one fold over the bytes.
_CRC_TABLE = """(SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
    ORDER BY i) AS t FROM range(256) AS r(i))"""
_BYTES = "list_transform(range(1, 2 * octet_length(encode({0})) + 1, 2), lambda i: ('0x' || substr(hex(encode({0})), i, 2))::BIGINT)"
_CRC = ("xor(list_reduce(list_prepend(4294967295, " + _BYTES + "), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")

ORACLES = {
    "op5_near_dedup": rf"""
        WITH RECURSIVE w AS MATERIALIZED (
            SELECT doc_id, list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
        s AS MATERIALIZED (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS g
            FROM w),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        e AS MATERIALIZED (
            SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
        both_ways AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
        reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r)
        SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r) AS component_id, d.doc_id = min(r) AS kept
        FROM reach d LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op7_url_filters": f"""
        WITH rules(host, path, verdict) AS (VALUES {", ".join(map(str, RULES))}),
        u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
        p AS (SELECT page_id, coalesce({_LOWER.format("regexp_extract(rest, '^[^/?#]*', 0)")}, '') AS host,
                     coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
        f AS (SELECT p.page_id, r.host || r.path AS rule, r.verdict,
                     row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
              FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
        SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
        FROM p LEFT JOIN f ON f.page_id = p.page_id AND f.k = 1""",
    "op11_conversation_trie": f"""
        WITH crc AS MATERIALIZED {_CRC_TABLE},
        t AS MATERIALIZED (
            SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos FROM conversations WHERE conv_id IS NOT NULL),
        c AS (SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, {_CRC.format("conv_id::VARCHAR")} % {MOST} AS h
              FROM (SELECT DISTINCT conv_id FROM t), crc),
        r AS (SELECT c.conv_id, 0 AS own, pos, turn FROM c JOIN t ON t.conv_id = c.base AND pos <= h
              UNION ALL SELECT c.conv_id, 1, pos, turn FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h),
        s AS MATERIALIZED (SELECT c.conv_id, coalesce(q, []) AS q FROM c LEFT JOIN (SELECT conv_id, list(turn ORDER BY own, pos) AS q FROM r GROUP BY conv_id) r
                           ON r.conv_id = c.conv_id),
        n AS MATERIALIZED (
            SELECT d, list_slice(q, 1, d) AS p, min(conv_id) AS conv_id, count(*) AS n,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(q) = d), '')) AS ends
            FROM s, unnest(range(0, len(q) + 1)) AS x(d) GROUP BY ALL),
        k AS MATERIALIZED (SELECT n.*, CASE WHEN d > 0 THEN md5(list_slice(p, 1, d - 1)::VARCHAR) END AS up, md5(p::VARCHAR) AS me FROM n),
        m AS (SELECT up, count(*) AS n_children FROM k WHERE d > 0 GROUP BY up),
        f AS (SELECT k.*, coalesce(n_children, 0) AS n_children, CASE WHEN d > 0 THEN (n - 1) * length(p[-1].text) ELSE 0 END AS saved
              FROM k LEFT JOIN m ON m.up = k.me),
        u AS (SELECT md5(list_slice(p, 1, i)::VARCHAR) AS me, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
              FROM f, unnest(range(0, d + 1)) AS x(i) GROUP BY ALL)
        SELECT f.conv_id, f.d AS depth, up.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, n_leaves, saved_tokens, f.ends AS ends_sha256
        FROM f JOIN u ON u.me = f.me LEFT JOIN f up ON up.me = f.up""",
    "op12_spelling": f"""
        WITH RECURSIVE crc AS MATERIALIZED {_CRC_TABLE},
        r AS (SELECT doc_id, {_LOWER.format("unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+'))")} AS run FROM documents),
        h AS (SELECT run, {_CRC.format("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM r, crc),
        w AS MATERIALIZED (
            SELECT CASE WHEN h % {SLIP_EVERY} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
                   count(*) AS n FROM h GROUP BY word HAVING length(word) >= {spelling.MIN_LENGTH} AND n >= {spelling.MIN_COUNT}),
        v AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM w, unnest(range(1, length(word) + 1)) AS p(i)),
        pairs AS (SELECT DISTINCT a.word AS a, b.word AS b FROM v a JOIN v b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word AND length(a.word) = length(b.word)
                  UNION SELECT v.word, w.word FROM v JOIN w ON w.word = v.rest UNION SELECT w.word, v.word FROM v JOIN w ON w.word = v.rest),
        best AS MATERIALIZED (SELECT a AS word, count(*) AS n_near, min((-w.n, b)) AS best FROM pairs JOIN w ON w.word = b GROUP BY a),
        f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= {spelling.RATIO} * w.n THEN best[2] END AS form,
                                  CASE WHEN -best[1] >= {spelling.RATIO} * w.n THEN -best[1] END AS form_n FROM w LEFT JOIN best ON best.word = w.word),
        chain AS (SELECT word, word AS root FROM f UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.root WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, chain.root, f.n, f.n_near, f.form_n
        FROM f JOIN chain ON chain.word = f.word JOIN f last ON last.word = chain.root AND last.form IS NULL""",
    "op13_quality_rules": rf"""
        WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
                   list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        n AS (SELECT r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                     len(regexp_extract_all(text, '{quality_rules.SYMBOL.pattern}')) AS n_symbols FROM d),
        g AS (SELECT r, i, list_slice(w, i, i + 2) AS g FROM d, unnest(range(1, len(w) - 1)) AS p(i)),
        k AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (
                SELECT r, unnest(flatten(list_transform(starts, lambda i: [i, i + 1, i + 2]))) AS j
                FROM (SELECT r, list(i) AS starts FROM g GROUP BY r, g HAVING count(*) > 1)) GROUP BY r),
        s AS (SELECT r, string_split(text, chr(10)) AS s FROM d),
        l AS (SELECT r, i, s[i] AS line, len(list_filter(string_split_regex(s[i], '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n
              FROM s, unnest(range(1, len(s) + 1)) AS p(i)),
        o AS (SELECT *, row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS again, {_LOWER.format("line")} AS low FROM l WHERE n > 0),
        j AS (SELECT r, n, again, NOT regexp_matches(line, '{quality_rules.CLOSED.replace("'", "''")}')
                OR 4 * (len(regexp_extract_all(line, '{quality_rules.SYMBOL.pattern}')) + len(regexp_extract_all(line, '{quality_rules.DOUBLED}'))) > n
                OR len(regexp_extract_all(line, '{quality_rules.SEPARATOR}')) >= 2
                OR n <= {quality_rules.NAVIGATION_WORDS} AND regexp_matches(low, '{quality_rules.MENU}')
                OR again OR n <= {quality_rules.BOILERPLATE_WORDS} AND regexp_matches(low, '{quality_rules.FRAME}') AS failed FROM o),
        t AS (SELECT r, count(*) FILTER (again) AS n_dup_lines, count(*) FILTER (failed) AS n_lines_removed,
                     coalesce(sum(n) FILTER (failed), 0)::BIGINT AS lost_words FROM j GROUP BY r),
        b AS (SELECT n.*, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines_removed, 0) AS n_lines_removed,
                     coalesce(lost_words, 0) AS lost_words FROM n LEFT JOIN k ON k.r = n.r LEFT JOIN t ON t.r = n.r)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines_removed, lost_words,
               n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEATED} * n_words AS base_failed,
               NOT (n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEATED} * n_words)
                   AND 100 * lost_words <= {quality_rules.MAX_LOST} * n_words AS kept FROM b""",
}
