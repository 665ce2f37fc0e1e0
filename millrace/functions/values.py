"""Numbers, flags and lists kept as text in the sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import col, let, strip_ws


def digits_only(text: Column | str) -> Column:
    """Keep the digits of a count text: ``1,234`` -> 1234 (and ``1.2K`` -> 12)."""
    return F.regexp_replace(col(text), "[^0-9]", "").try_cast("long")


def thousands(text: Column | str) -> Column:
    """``1.2k`` -> 1200, else the plain whole number."""
    text = strip_ws(text)
    short = F.substring_index(text, "k", 1).try_cast("double") * 1000
    return F.when(F.contains(text, F.lit("k")), short.cast("long")).otherwise(text.try_cast("long"))


def stats_map(labels: Column | str) -> Column:
    """``['Votes:3', 'Views:10']`` -> map; the last of equal labels counts."""
    parts = F.transform(
        col(labels),
        lambda s: F.struct(
            strip_ws(F.substring_index(s, ":", 1)).alias("label"),
            strip_ws(F.get(F.split(s, ":"), 1)).alias("value"),
        ),
    )
    latest = lambda all_parts: F.filter(
        all_parts,
        lambda p, i: ~F.exists(F.slice(all_parts, i + 2, F.size(all_parts)), lambda q: q["label"] == p["label"]),
    )
    return F.map_from_entries(let(parts, latest))


def labelled_stats(labels: Column | str, short_views: Column | None = None) -> Column:
    """Votes and views of a list entry; a short form such as ``1.2k`` wins for views."""

    def read(stats: Column) -> Column:
        views = F.try_element_at(stats, F.lit("Views")).try_cast("long")
        return F.struct(
            F.try_element_at(stats, F.lit("Votes")).alias("score"),
            (views if short_views is None else F.coalesce(thousands(short_views), views)).alias("view_count"),
        )

    return let(stats_map(labels), read)


def null_token(text: Column | str) -> Column:
    """Real null for the stored tokens ``NULL`` and ''."""
    text = col(text)
    return F.when(~text.isin("NULL", ""), text)


def is_accepted(accept_id: Column | str) -> Column:
    """A question is accepted when it names an accepted answer."""
    return null_token(accept_id).isNotNull()


def flag_text(flag: Column | str) -> Column:
    """Boolean as the exported ``True`` / ``False``."""
    return F.when(col(flag), "True").otherwise("False")


def flag_value(text: Column | str) -> Column:
    """Exported flag back to a boolean: only ``True`` is true."""
    return F.coalesce(col(text) == "True", F.lit(False))


def split_list(text: Column | str) -> Column:
    """Comma text to an array; empty or missing text gives an empty array."""
    text = col(text)
    return F.when(text.isNull() | (text == ""), F.array().cast("array<string>")).otherwise(F.split(text, ","))


def join_list(items: Column | str) -> Column:
    """Array to comma text."""
    return F.coalesce(F.array_join(col(items), ","), F.lit(""))


def md5_key(text: Column | str) -> Column:
    return F.md5(col(text))
