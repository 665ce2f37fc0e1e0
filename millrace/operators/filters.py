"""Filters that keep the reason of every rejected row."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import col
from millrace.functions.urls import host_suffixes, url_host

REASON = "reject_reason"


def with_verdict(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """Add the reason of the first check that fails a row; null for good rows.

    A row that already carries a reason keeps it, so verdicts can be chained.
    """
    found = [F.when(F.coalesce(bad, F.lit(False)), F.lit(reason)) for reason, bad in checks]
    earlier = [F.col(REASON)] if REASON in df.columns else []
    return df.withColumn(REASON, F.coalesce(*earlier, *found))


def kept(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNotNull())


def drop_early(df: DataFrame, ts: str, now: Column, days: int = 365) -> DataFrame:
    """Reject records more than `days` whole days old; a missing date is an error."""
    oldest = now - F.make_dt_interval(days=F.lit(days + 1))
    return with_verdict(df, [("bad_date", F.col(ts).isNull()), ("too_old", F.col(ts) <= oldest)])


def filter_words(df: DataFrame, text: str, words: Sequence[str]) -> DataFrame:
    """Reject records whose text holds one of the words, given in lowercase."""
    lower = F.lower(F.col(text))
    return with_verdict(df, [(f"word:{w}", F.contains(lower, F.lit(w))) for w in words])


def require(df: DataFrame, columns: Sequence[str], arrays: Sequence[str] = ()) -> DataFrame:
    """Reject rows with a missing column or an empty array."""
    checks = [(f"missing:{c}", F.col(c).isNull()) for c in columns]
    checks += [(f"empty:{c}", F.coalesce(F.size(c), F.lit(0)) <= 0) for c in arrays]
    return with_verdict(df, checks)


def parse_or_reject(df: DataFrame, fields: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Parse text columns in place; a row with a value that does not parse is rejected,
    and no other row is touched."""
    parsed = {name: parse(F.col(name)) for name, parse in fields.items()}
    checks = [(f"unparsed:{n}", F.col(n).isNotNull() & value.isNull()) for n, value in parsed.items()]
    return with_verdict(df, checks).withColumns(parsed)


def url_allowed(url: Column | str, allow: Sequence[str] = (), deny: Sequence[str] = ()) -> Column:
    """Any `allow` pattern is found in the url (none given: all), and no `deny` pattern."""
    url, result = col(url), F.lit(True)
    if allow:
        result = url.rlike("|".join(f"(?:{p})" for p in allow))
    if deny:
        result = result & ~url.rlike("|".join(f"(?:{p})" for p in deny))
    return result


def filter_urls(df: DataFrame, url: str, allow: Sequence[str] = (), deny: Sequence[str] = ()) -> DataFrame:
    return df.filter(url_allowed(url, allow, deny))


def filter_domains(df: DataFrame, url: str, domains: Sequence[str]) -> DataFrame:
    """Keep urls whose host is one of the domains or a subdomain of one."""
    if not domains:
        return df
    names = "|".join(re.escape(d.lower()) for d in domains)
    return df.filter(url_host(url).rlike(rf"(^|\.)(?:{names})$"))


def route(df: DataFrame, url: str, routes: Mapping[str, str], other: str = "detail", name: str = "kind") -> DataFrame:
    """Name the kind of each page by the first url pattern found."""
    kind = F.lit(None).cast("string")
    for label, pattern in reversed(routes.items()):
        kind = F.when(F.col(url).rlike(pattern), label).otherwise(kind)
    return df.withColumn(name, F.coalesce(kind, F.lit(other)))


# How a record says what is to be done with it.
FULL, PATCH = "Insert or Update", "Fix or Update"


def route_process(df: DataFrame, process_type: str = "process_type") -> dict[str, DataFrame]:
    """Records for the full upsert and records for the column patch."""
    return {"upsert": df.filter(F.col(process_type) == FULL), "patch": df.filter(F.col(process_type) == PATCH)}


def domain_of(url: Column | str) -> Column:
    """All domains the host of a url belongs to, longest first."""
    return host_suffixes(url_host(url))
