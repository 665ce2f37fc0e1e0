"""Column functions against plain Python models and the documented quirks."""

import random
import re
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates as D
from millrace.functions import markup as M
from millrace.functions import selectors as S
from millrace.functions import text as T
from millrace.functions import urls as U
from millrace.functions import values as V
from millrace.session import shared_dir


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["r"] for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


KNOWN = {"nbsp": " ", "160": " ", "lt": "<", "60": "<", "gt": ">", "62": ">", "amp": "&", "38": "&", "quot": '"', "34": '"'}


def model_decode(s):
    """Leftmost entity first, one at a time."""
    while m := re.search(r"&#?(\w+);", s, re.ASCII):
        s = s[: m.start()] + KNOWN.get(m.group(1), "") + s[m.end():]
    return s


def test_entities_equal_the_model(spark):
    rng = random.Random(1)
    pieces = ["&", "#", "amp;", "lt;", "38;", "x", ";", "&amp;", "&foo;", "nbsp;", "am", "p;", "\n", "&#60;", " "]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(14))) for _ in range(3000)]
    texts += ["&amp;amp;lt;", "&am&z;p;", "&a&b&c;;;", "&" * 5 + ";" * 5, "a & b", "&NBSP;", "", "&am&z;p;am&y;p;lt;"]
    got = apply(spark, texts, T.decode_entities)
    assert got == [model_decode(t) for t in texts]
    assert not any(re.search(r"&#?\w+;", g, re.ASCII) for g in got)


def test_strip_tags(spark):
    html = [
        "<p>a &amp; b</p><p> c<br/>d </p>", '<script src="x">var a;</script>kept<style>p{}</style>',
        "<script>if (a<b) x</script>t", "<!DOCTYPE html><!-- c --><b>x</b>\n\n\n y", "", "　你好　</P>x",
    ]
    assert apply(spark, html, T.strip_tags) == [
        "a & b\nc\nd\n", "kept\n",
        "if (at\n",  # a script with a `<` inside is not cut as a whole: what looks like a tag goes
        "<!DOCTYPE html>x\ny\n", "", "你好\nx\n",
    ]


def test_clean_html_and_strong(spark):
    html = '<div class="hzh_botleft">ad\nad</div>x\n \n<script type="a">\n</script>\ny<a href="javascript:">z</a>'
    assert apply(spark, [html], T.clean_html) == ["x\ny"]
    strong = "<strong>a</strong> <strong>b</strong><STRONG>c</STRONG>"
    assert apply(spark, [strong], T.rewrite_strong) == ["<p>a b</p><p>c</p>"]


def test_replace_nth(spark):
    html = '<img a src="1.png"> x <img src="2.png">y<img src="3.png">'
    new = F.array(F.lit("A"), F.lit("B"))
    got = apply(spark, [html, "none", ""], lambda c: T.replace_nth(c, M.IMAGE, new))
    assert got == ['<img a src="A"> x <img src="B">y<img src="3.png">', "none", ""]


def test_first_join_rule(spark):
    lists = [["  a ", "b"], [], None, ["　x\n"]]
    assert apply(spark, lists, T.first_or_empty, "array<string>") == ["a", "", "", "x"]
    assert apply(spark, lists, T.join_texts, "array<string>") == ["a \nb", "", "", "x"]
    texts = [["发布于：", " 2016年04月08日"], ["none"], []]
    fn = lambda c: T.apply_rule_fn(F.lit("osc"), "publish_time", c)
    assert apply(spark, texts, fn, "array<string>") == ["2016年04月08日", "", ""]
    T.register_rule_fn("mine", "title", lambda t: F.upper(F.get(t, 0)))
    assert apply(spark, [["a"]], lambda c: T.apply_rule_fn(F.lit("mine"), "title", c), "array<string>") == ["A"]
    assert apply(spark, [["a"]], lambda c: T.apply_rule_fn(F.lit("other"), "title", c), "array<string>") == ["a"]


HREFS = ["/x", "y/z", "../up", "../../../far", "./k", "?q=1", "#f", "//o.org/p", "http://z.org/a", "mailto:a@b", "", "a/./b",
         "a/../b?x=../y", "/p/../q", "..", "."]


@pytest.mark.parametrize("base", ["http://a.b/c/d/e.html?x#y", "https://a.b/c/", "http://a.b"])
def test_url_join_equals_the_standard(spark, base):
    got = apply(spark, HREFS, lambda c: U.url_join(F.lit(base), c))
    assert got == [urljoin(base, h) for h in HREFS]


def test_url_parts_and_ids(spark):
    url = "http://u:p@Forum.Example.com:80/forums/editor.10/page.x.html?a=/b.c"
    assert apply(spark, [url], U.url_host) == ["forum.example.com"]
    parts = apply(spark, [url, "http://a.b"], U.url_parts)
    assert (parts[0]["path"], parts[0]["file_name"], parts[0]["suffix"]) == ("/forums/editor.10/page.x.html", "page.x.html", ".html")
    assert (parts[1]["path"], parts[1]["suffix"]) == ("", "")
    assert apply(spark, ["http://h/forums/editor.10/", "http://h/x"], U.section_base) == ["editor", None]
    assert apply(spark, ["http://h/q/123/t.html", "x"], U.link_id) == ["123", None]
    assert apply(spark, ["thread-123"], lambda c: U.link_id(c, "dash")) == ["123"]
    assert apply(spark, ["#12"], lambda c: U.link_id(c, "hash")) == ["12"]
    assert apply(spark, ["a.b.c"], U.host_suffixes) == [["a.b.c", "b.c", "c"]]


def test_dates(spark):
    texts = ["Jun 5, 2017 03:04:05 PM", "2017, Jun 05 at 03:04:05+0000", "May 23, 2017", "2017-06-05 1:2:3", "2017-06-05", "x", None]
    parsed = apply(spark, texts, lambda c: D.format_ts(D.parse_any_date(c)))
    assert parsed == ["2017-06-05 15:04:05", "2017-06-05 03:04:05", "2017-05-23 00:00:00", "2017-06-05 01:02:03",
                      "2017-06-05 00:00:00", None, None]
    assert apply(spark, [1332888820], lambda c: D.format_ts(D.from_epoch(c)), "long") == ["2012-03-27 22:53:40"]
    assert apply(spark, [1332888820], lambda c: D.to_epoch(D.from_epoch(c)), "long") == [1332888820]
    assert apply(spark, [1332888820], lambda c: D.run_number(D.from_epoch(c), 2), "long") == [20120327225342]
    assert apply(spark, ["2017-06-05"], lambda c: D.format_ts(D.assemble_ts(c, F.lit(" 12:30")))) == ["2017-06-05 12:30:00"]
    head = apply(spark, [" 2017-06-05  Daily x"], D.head_line)[0]
    assert (head["pubdate"].day, head["location"]) == (5, "Daily")


def test_counts_and_tokens(spark):
    assert apply(spark, ["1,234", "1.2K", "", None], V.digits_only) == [1234, 12, None, None]
    assert apply(spark, ["1.2k", " 15 ", "x", "4.1k"], V.thousands) == [1200, 15, None, int(float("4.1") * 1000)]
    stats = apply(spark, [["Votes:3", "Views:10", "Votes:4"], []], V.stats_map, "array<string>")
    assert stats == [{"Votes": "4", "Views": "10"}, {}]
    wins = apply(spark, [["Views:10"]], lambda c: V.labelled_stats(c, F.lit("1.2k")), "array<string>")[0]
    assert (wins["score"], wins["view_count"]) == (None, 1200)
    assert apply(spark, ["NULL", "", "7", None], V.null_token) == [None, None, "7", None]
    assert apply(spark, ["NULL", "7"], V.is_accepted) == [False, True]
    assert apply(spark, [True, False, None], V.flag_text, "boolean") == ["True", "False", "False"]
    assert apply(spark, ["a,b", "", None], V.split_list) == [["a", "b"], [], []]
    assert apply(spark, [["a", "b"], [], None], V.join_list, "array<string>") == ["a,b", "", ""]


PAGE = """<html><head><title>T &amp; t</title></head><body><div class="listbox x"><ul><li><span>1</span><a href="/a">A</a>
<li><span>2</span><a href="/b">B</a></ul></div><div id="art" class="Body"><p>one<p>two <b>bold</b> end<br>more</div>
<h1>Head</h1><img src="i.png"></body></html>"""


@pytest.mark.parametrize("selector, want", [
    ("//title/text()", ["T & t"]),
    ('//div[starts-with(@class, "listbox")]/ul/li/a/@href', ["/a", "/b"]),
    ("//ul/li[last()]/a/text()", ["B"]),
    ("//ul/li[1]/span/text()", ["1"]),
    ('//div[@id="art"]/p[position()>1]//text()', ["two ", " end", "more", "bold"]),
    ('//div[contains(@class,"ody")]/p/text()', ["one", "two ", " end", "more"]),
    ("//h1/text()|//img/@src", ["Head", "i.png"]),
    ("//ul/li/*[1]/text()", ["1", "2"]),
    ("//nothing/text()", []),
])
def test_selectors(spark, selector, want):
    got = apply(spark, [PAGE, None], lambda c: S.select_field(c, selector))
    assert sorted(got[0]) == sorted(want)
    assert got[1] == []


def test_selector_kinds_are_checked():
    with pytest.raises(ValueError):
        S.compile_selector("//a[foo()=1]/text()")


def test_shared_dir_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
