"""Pieces of HTML pages as native column expressions.

Pages are not well-formed, so regions and repeated pieces are found by patterns.
All patterns use ``[\\s\\S]*?``, which needs no recursion on large pages.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import col, let

LINK = r"(?i)<a(\s[^>]*)>([\s\S]*?)</a>"
IMAGE = r'(<img [\s\S]*?src=")([\s\S]*?)(?=")'


def region(html: Column | str, tag: str, attrs: str = "") -> Column:
    """The first `tag` element with its tags; '' when the page has none or cuts it off."""
    return F.regexp_extract(col(html), rf"(?i)<{tag}\b{attrs}[^>]*>[\s\S]*?</{tag}>", 0)


def inner(html: Column | str, tag: str, attrs: str = "") -> Column:
    """Content of the first `tag` element, else ''."""
    return F.regexp_extract(col(html), rf"(?i)<{tag}\b{attrs}[^>]*>([\s\S]*?)</{tag}>", 1)


def all_inner(html: Column | str, tag: str) -> Column:
    """Contents of all closed `tag` elements, in page order."""
    return F.regexp_extract_all(col(html), F.lit(rf"(?i)<{tag}\b[^>]*>([\s\S]*?)</{tag}>"), F.lit(1))


def opened(html: Column | str, tag: str) -> Column:
    """Contents after each opening `tag`, up to the next one: for elements left open."""
    parts = F.split(col(html), rf"(?i)<{tag}(?:\s[^>]*)?>")
    return F.transform(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda s: F.regexp_replace(s, rf"(?i)</{tag}>[\s\S]*$", ""),
    )


def links(html: Column | str) -> Column:
    """All links of a piece: array of (href, title, css, text)."""

    def read(page: Column) -> Column:
        attributes = F.regexp_extract_all(page, F.lit(LINK), F.lit(1))
        texts = F.regexp_extract_all(page, F.lit(LINK), F.lit(2))
        found = F.zip_with(
            attributes, texts,
            lambda a, text: F.struct(
                attribute(a, "href").alias("href"), attribute(a, "title").alias("title"),
                attribute(a, "class").alias("css"), text.alias("text"),
            ),
        )
        return F.filter(found, lambda a: a["href"] != "")

    return let(col(html), read)


def attribute(open_tag: Column | str, name: str) -> Column:
    """Value of an attribute of an opening tag, else ''."""
    return F.regexp_extract(col(open_tag), rf'(?i)\s{name}="([^"]*)"', 1)


def image_sources(html: Column | str) -> Column:
    return F.regexp_extract_all(col(html), F.lit(IMAGE), F.lit(2))


def flag(html: Column | str, marker: str) -> Column:
    """Presence of a marker such as ``class="staff"``."""
    return F.coalesce(F.contains(col(html), F.lit(marker)), F.lit(False))


def accepted_state(html: Column | str, marker: str) -> Column:
    return F.when(flag(html, marker), "Accepted").otherwise("notAccepted")
