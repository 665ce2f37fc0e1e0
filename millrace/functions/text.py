"""Cleaning of HTML and text as native column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Unicode `strip` sees it, as a character class of Java
# regular expressions and as plain characters.
SPACE = r"\s\x0B\x1C-\x1F\x85\p{Z}"
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The markup patterns, in the order they are applied.
PARAGRAPH_END = r"(?i)</p>"
CDATA = r"(?i)//<!\[CDATA\[[^>]*//\]\]>"
SCRIPT = r"(?i)<\s*script[^>]*>[^<]*<\s*/\s*script\s*>"
STYLE = r"(?i)<\s*style[^>]*>[^<]*<\s*/\s*style\s*>"
LINE_BREAK = r"<br\s*?/?>"
TAG = r"</?\w+[^>]*>"
COMMENT = r"<!--[^>]*-->"

# The known entities, by name or number.
ENTITIES = {
    "nbsp|160": " ",
    "lt|60": "<",
    "gt|62": ">",
    "quot|34": '"',
    "amp|38": "&",
}
ANY_ENTITY = r"&#?\w+;"

# Boilerplate cut from article HTML before it is kept.
BOILERPLATE = (
    r'<div class="hzh_botleft">[\s\S]*?</div>',
    r"<script [\s\S]*?</script>",
    r'<a href="javascript:"[\s\S]*?</a>',
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once per row, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def strip_ws(text: Column | str) -> Column:
    """Strip any Unicode whitespace from both ends (`trim` knows spaces only)."""
    return F.btrim(col(text), F.lit(SPACES))


def _lines(text: Column) -> Column:
    """The non-blank lines of a text."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(rf"[^{SPACE}]"))


def decode_entities(text: Column | str) -> Column:
    """Decode known entities and drop unknown ones until none is left.

    One pass resolves a chain such as ``&amp;amp;lt;`` at any depth.  Dropping an
    unknown entity may bring a new one together; each further pass drops at least one
    semicolon, so their number bounds the passes and the result is exact.
    """
    chain = r"&(?:#?(?:amp|38);)*#?"

    def one_pass(s: Column) -> Column:
        for names, char in ENTITIES.items():
            s = F.regexp_replace(s, rf"{chain}(?:{names});", char)
        return F.regexp_replace(s, ANY_ENTITY, "")

    def settle(first: Column) -> Column:
        semicolons = F.length(first) - F.length(F.replace(first, F.lit(";"), F.lit("")))
        passes = F.aggregate(
            F.sequence(F.lit(1), semicolons),
            first,
            lambda acc, _: F.when(acc.rlike(ANY_ENTITY), one_pass(acc)).otherwise(acc),
        )
        return F.when(first.rlike(ANY_ENTITY), passes).otherwise(first)

    return let(col(text), lambda s: F.when(F.contains(s, F.lit("&")), let(one_pass(s), settle)).otherwise(s))


def strip_tags(html: Column | str) -> Column:
    """Readable text of an HTML piece, one stripped non-empty line each, all ended by a newline."""
    s = F.regexp_replace(col(html), PARAGRAPH_END, "\n")
    for pattern in (CDATA, SCRIPT, STYLE):
        s = F.regexp_replace(s, pattern, "")
    s = F.regexp_replace(s, LINE_BREAK, "\n")
    s = F.regexp_replace(s, TAG, "")
    s = F.regexp_replace(s, COMMENT, "")
    s = decode_entities(F.regexp_replace(s, r"\n+", "\n"))
    lines = F.transform(_lines(s), strip_ws)
    return F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")


def clean_html(html: Column | str, patterns: Sequence[str] = BOILERPLATE) -> Column:
    """Cut boilerplate blocks, then drop blank lines."""
    s = col(html)
    for pattern in patterns:
        s = F.regexp_replace(s, pattern, "")
    return F.array_join(_lines(s), "\n")


def rewrite_strong(html: Column | str, tag: str = "strong") -> Column:
    """Merge adjacent runs of `tag`, then turn what is left into paragraphs."""
    s = F.regexp_replace(col(html), rf"</{tag}>(\s*)<{tag}>", "$1")
    s = F.regexp_replace(s, rf"(?i)<{tag}>", "<p>")
    return F.regexp_replace(s, rf"(?i)</{tag}>", "</p>")


def replace_nth(text: Column | str, pattern: str, values: Column) -> Column:
    """Replace the n-th match of `pattern` by the n-th entry of `values`.

    `pattern` has two groups: what stays in front, and what is replaced.  Matches
    beyond the end of `values` stay as they are.
    """
    text = col(text)
    kept = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    old = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    between = F.split(text, pattern)
    joints = F.zip_with(
        kept, F.transform(old, lambda o, i: F.coalesce(F.get(values, i), o)), lambda k, v: F.concat(k, v)
    )
    return F.array_join(F.zip_with(between, joints, lambda b, j: F.concat(b, F.coalesce(j, F.lit("")))), "")


def first_or_empty(texts: Column | str) -> Column:
    """First list element stripped, or ''."""
    return F.coalesce(strip_ws(F.get(col(texts), 0)), F.lit(""))


def join_texts(texts: Column | str) -> Column:
    """List elements joined by newlines and stripped, or ''."""
    return F.coalesce(strip_ws(F.array_join(col(texts), "\n")), F.lit(""))


# -- per-rule overrides -------------------------------------------------------------

RuleFunction = Callable[[Column], Column]
_RULE_FUNCTIONS: dict[tuple[str, str], RuleFunction] = {}


def register_rule_fn(rule: str, field: str, fn: RuleFunction) -> None:
    """Use `fn` on the extracted texts of `field` for pages of `rule`."""
    _RULE_FUNCTIONS[rule, field] = fn


def remove_rule_fn(rule: str, field: str) -> None:
    """Take back what `register_rule_fn` set; expressions made so far keep it."""
    _RULE_FUNCTIONS.pop((rule, field), None)


def apply_rule_fn(rule: Column | str, field: str, texts: Column | str) -> Column:
    """Extracted texts to one value: the rule's own function, else `join_texts`."""
    rule, texts = col(rule), col(texts)
    chosen = None
    for (name, for_field), fn in _RULE_FUNCTIONS.items():
        if for_field == field:
            here = rule == name
            chosen = F.when(here, fn(texts)) if chosen is None else chosen.when(here, fn(texts))
    return join_texts(texts) if chosen is None else chosen.otherwise(join_texts(texts))


def chinese_date(texts: Column) -> Column:
    """The first date written like 2016年04月08日 in the joined texts, else ''."""
    joined = F.array_join(texts, "")
    return F.coalesce(F.regexp_extract(joined, r"\d{4}年\d{2}月\d{2}日", 0), F.lit(""))


register_rule_fn("osc", "publish_time", chinese_date)
