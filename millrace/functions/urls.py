"""Url functions as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import col

ORIGIN = r"^(?i)([a-z][a-z0-9+.-]*://[^/?#]*)"


def _fold_dots(path: Column) -> Column:
    """Resolve `.` and `..` segments of an absolute path."""
    parts = F.split(path, "/")
    last = F.try_element_at(parts, F.lit(-1))
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, part: F.when(part == ".", acc)
        .when((part == "..") & (F.size(acc) > 1), F.slice(acc, F.lit(1), F.size(acc) - 1))
        .when(part == "..", acc)
        .otherwise(F.concat(acc, F.array(part))),
    )
    tail = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.when(F.contains(path, F.lit("/.")), F.concat(F.array_join(kept, "/"), tail)).otherwise(path)


def url_join(base: Column | str, href: Column | str) -> Column:
    """Absolute url of `href` as found on the page `base`."""
    base, href = col(base), col(href)
    origin = F.regexp_extract(base, ORIGIN, 1)
    no_fragment = F.regexp_replace(base, r"#.*$", "")
    no_query = F.regexp_replace(base, r"[?#].*$", "")
    directory = F.regexp_replace(F.substr(no_query, F.length(origin) + 1), r"[^/]*$", "")
    directory = F.when(directory == "", F.lit("/")).otherwise(directory)
    route = F.regexp_extract(href, r"^[^?#]*", 0)
    rest = F.substr(href, F.length(route) + 1)
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^(?i)[a-z][a-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^[^:]+:", 0), href))
        .when(href.startswith("/"), F.concat(origin, _fold_dots(route), rest))
        .when(href.startswith("?"), F.concat(no_query, href))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .otherwise(F.concat(origin, _fold_dots(F.concat(directory, route)), rest))
    )


def url_host(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(col(url), r"^(?i)[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def url_parts(url: Column | str) -> Column:
    """Struct of host, path, section base, file name and suffix.

    The section base is the second last dotted part of the second last path part, as
    in ``/forums/editor.10/`` -> ``editor``; null where the url has no such part.
    """
    url = col(url)
    path = F.regexp_extract(url, r"^(?i)[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    file_name = F.substring_index(path, "/", -1)
    return F.struct(
        url_host(url).alias("host"),
        path.alias("path"),
        section_base(url).alias("section"),
        file_name.alias("file_name"),
        F.when(F.contains(file_name, F.lit(".")), F.concat(F.lit("."), F.substring_index(file_name, ".", -1)))
        .otherwise(F.lit(""))
        .alias("suffix"),
    )


def section_base(url: Column | str) -> Column:
    folder = F.try_element_at(F.split(col(url), "/"), F.lit(-2))
    return F.try_element_at(F.split(folder, r"\."), F.lit(-2))


def link_id(link: Column | str, mode: str = "path") -> Column:
    """Id held by a link: second last path part (`path`), after the last dash
    (`dash`, as in ``thread-123``) or after the last hash (`hash`)."""
    link = col(link)
    if mode == "path":
        return F.try_element_at(F.split(link, "/"), F.lit(-2))
    return F.substring_index(link, {"dash": "-", "hash": "#"}[mode], -1)


def host_suffixes(host: Column | str) -> Column:
    """``a.b.c`` -> [a.b.c, b.c, c]: every domain the host belongs to."""
    parts = F.split(col(host), r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    )
