"""Substring dedup by hashing units: of each unit that several places share, the earliest stays.

A unit is a sentence within a line: it ends with the line, behind `.`, `!` or `?` before white space, or behind an
ideographic full stop or a wide `!` or `?`.  Units are normalised (lower case, words only, single spaces) and hashed to
128 bits.  Units of fewer than `TELLING` words are hashed together: a line that has some as a whole, and of neighbouring
lines that have no others (lists, verse) the shortest runs with so many words.  Digests are grouped over all documents; a
unit, line or run is a repeat if a document before holds it, or its own document did before.  Every repeat is removed; a
small unit between repeats goes with them.  Removed spans are kept with their offsets in the original text.

Null texts stay null and empty ones empty.  Documents are ordered by id, null ids last, and those of one id by the hash of
their text.  Rows that agree in id and text are one document.  Very long texts are bounded by their own units only.  All
columns of the input stay; a result column replaces one of the same name.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import HASH, KEY, WORD, add_columns, with_key
from millrace.llm.line_dedup import shortest_runs
from millrace.session import cut_lineage

TELLING = 3  # words of a unit that is hashed
MIN_WORDS = TELLING  # words of neighbouring repeats that go
UNIT = re.compile(r"[^\n.!?。！？｡]*(?:[.!?]+(?!\s|\Z)[^\n.!?。！？｡]*)*(?:[.!?]+[^\S\n]*\n?|[。！？｡]+[」』”’）]*[^\S\n]*\n?|\n|\Z)")


def units_of(text: str) -> list[tuple[int, int, list[str]]]:
    """(start, end, words) of each unit; the units cover the text."""
    return [(m.start(), m.end(), WORD.findall(m.group().lower())) for m in UNIT.finditer(text) if m.end() > m.start()]


def digest_of(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words).encode())


def spans_of(text: str, units: list[tuple[int, int, list[str]]]) -> list[tuple[int, int, bytes]]:
    """(first unit, unit behind the last, digest) of all that is hashed."""
    spans, lines, first = [], [], 0

    def close():  # the lines without a telling unit
        sizes = [sum(len(units[k][2]) for k in range(x, y)) for x, y in lines]
        for x, y in shortest_runs(sizes, TELLING) if lines else ():
            own = [" ".join(w for k in range(*line) for w in units[k][2]) for line in lines[x:y]]
            spans.append((lines[x][0], lines[y - 1][1], digest_of(["\n".join(filter(None, own))])))
        lines.clear()

    for at, (_, end, words) in enumerate(units):
        if len(words) >= TELLING:
            spans.append((at, at + 1, digest_of(words)))
        if end < len(text) and text[end - 1] != "\n":
            continue
        sizes = [len(units[k][2]) for k in range(first, at + 1)]
        if max(sizes) < TELLING:
            lines.append((first, at + 1))
        else:
            close()
            if any(0 < n < TELLING for n in sizes):
                spans.append((first, at + 1, digest_of([w for k in range(first, at + 1) for w in units[k][2]])))
        first = at + 1
    close()
    return sorted(spans)


def _digests(batches):
    """(key, hash, text) -> (upper, lower half of the digest, key, document, place): the first place of each digest in a
    document, as a place among its spans; `document` is the hash."""
    names = ["upper", "lower", "key", "document", "place"]
    kinds = [pa.int64()] * 4 + [pa.int32()]
    for batch in batches:
        columns = [[] for _ in names]
        for key, document, text in zip(*(c.to_pylist() for c in batch.columns)):
            seen, text = set(), text or ""
            for place, (_, _, digest) in enumerate(spans_of(text, units_of(text))):
                if digest not in seen:
                    seen.add(digest)
                    halves = (int.from_bytes(half, "big", signed=True) for half in (digest[:8], digest[8:]))
                    for column, value in zip(columns, (*halves, key, document, place)):
                        column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)


def repeated_places(spans: list[tuple[int, int, bytes]], places: set[int]) -> set[int]:
    """The units of the repeats: of spans that documents before hold (`places`), or this one before without a common unit."""
    first: dict[bytes, int] = {}
    gone = set()
    for place, (start, end, digest) in enumerate(spans):
        at = first.setdefault(digest, place)
        if at in places or spans[at][1] <= start:
            gone.update(range(start, end))
    return gone


def repeats_removed(text: str, places: set[int], min_words: int) -> tuple[str, list[dict]]:
    """The text without its runs of repeats, and the spans removed."""
    kept, removed, run, size = [], [], [], 0

    def close():
        nonlocal run, size
        while run and not run[-1][2]:  # what trails the last repeat stays
            waiting.insert(0, run.pop())
        if run and size >= min_words:
            removed.append({"start": run[0][0], "end": run[-1][1]})
        else:
            kept.extend(text[s:e] for s, e, _ in run)
        kept.extend(text[s:e] for s, e, _ in waiting)
        waiting.clear()
        run, size = [], 0

    waiting: list[tuple] = []
    units = units_of(text)
    gone = repeated_places(spans_of(text, units), places)
    for place, (start, end, words) in enumerate(units):
        if place in gone:
            size += len(words)
            run.append((start, end, True))
        elif len(words) < TELLING:
            run.append((start, end, False)) if run else kept.append(text[start:end])
        else:
            close()
            kept.append(text[start:end])
    close()
    return "".join(kept), removed


def repeated_units(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(`key`, `document`, `places`) of the spans that documents before hold; `document` is the hash of the text.

    The shared units are a table, so that Spark can split the join at a unit which very many documents hold.
    """
    keyed = with_key(docs.select(key, text), key, text)
    units = keyed.select(KEY, HASH, text).mapInArrow(_digests, "upper long, lower long, key long, document long, place int")
    document = F.struct("key", "document")
    shared = cut_lineage(units.groupBy("upper", "lower").agg(F.min(document).alias("first"), F.max(document).alias("last"))
                         .where("first < last").select("upper", "lower", "first"))
    later = units.join(shared, ["upper", "lower"]).where(document > F.col("first"))
    return later.groupBy("key", "document").agg(F.collect_list("place").alias("places"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", removed: str = "removed",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with the repeats cut out of `text`; `removed` lists (start, end) in the original, in code points."""
    columns = [c for c in docs.columns if c != removed]
    found = repeated_units(docs, key, text).withColumnsRenamed({"key": KEY, "document": HASH, "places": "__places"})
    keyed = with_key(docs.select(*columns), key, text).join(found, [KEY, HASH], "left")

    def make():
        def run(batch):
            texts, spans = [], []
            for t, places in zip(*(batch.column(c).to_pylist() for c in (text, "__places"))):
                new, cut = (None, []) if t is None else repeats_removed(t, set(places or ()), min_words)
                texts.append(new)
                spans.append(cut)
            return [texts, spans]

        return run

    done = add_columns(keyed, make, f"`__new` string, `{removed}` array<struct<start: long, end: long>>")
    return done.select(*[F.col("__new").alias(text) if c == text else F.col(c) for c in columns], removed)
