"""Order MinHash fingerprints of whole texts, in column expressions only.

A text is cut into units: runs of up to 12 characters without white space, in lower case.  Each unit and the one before
it (a mark before the first) make a 2-mer.  Repeated 2-mers are told apart by their occurrence number.  A hash of
2-mer and number deals them to 64 coordinates and orders them there; each coordinate selects its two least, puts them
back into text order and hashes the pair.  So two texts agree in a coordinate only if the same 2-mers stand there in
the same order, and agreement falls with the edit distance.  One hash serves all coordinates, instead of one hash for
each; whole texts count, whatever their length (positions beyond 2^26 units start again from 0).

A fingerprint is 64 times 4 hex digits; a coordinate without 2-mers is `----`.  Null counts as the empty text, whose
coordinates are all empty.  Equal texts, repeated rows too, have equal fingerprints.  A very long text is one row of work.
An empty table gives an empty table.  Only id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COORDINATES = 64
SELECTED = 2
UNIT = r"\S{1,12}"
PLACE_BITS, HASH_BITS = 26, 32
EMPTY = "----"
NULL_ID = -(2**63)
ROWS_A_BUCKET = 2_000
BUCKETS = 100_000


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once."""
    return F.transform(F.array(value), body)[0]


def _mask(bits: int) -> Column:
    return F.lit((1 << bits) - 1)


def _place(x: Column) -> Column:
    return x.bitwiseAND(_mask(PLACE_BITS))


def _hash(x: Column) -> Column:
    return F.shiftrightunsigned(x, PLACE_BITS)


def _coordinate(x: Column) -> Column:
    return F.shiftrightunsigned(x, PLACE_BITS + HASH_BITS)


def _mers(units: Column) -> Column:
    """Hash of each 2-mer in the upper bits, its place below, sorted."""
    def from_hashes(h: Column) -> Column:
        return F.array_sort(F.transform(h, lambda x, i: F.shiftleft(
            F.xxhash64(F.when(i > 0, F.get(h, i - 1)).otherwise(F.lit(0)), x), PLACE_BITS).bitwiseOR(_place(i.cast("long")))))

    return let(F.transform(units, lambda u: F.xxhash64(u)), from_hashes)


def _numbered(mers: Column) -> Column:
    """(coordinate, hash of 2-mer and occurrence number, place) of each 2-mer, sorted: runs of equal 2-mers are counted."""
    def numbered(x: Column, number: Column) -> Column:
        return F.shiftleft(F.xxhash64(_hash(x), number), PLACE_BITS).bitwiseOR(_place(x))

    def runs(starts: Column) -> Column:
        def run(start: Column, r: Column) -> Column:
            end = F.coalesce(F.get(starts, r + 1), F.size(mers))
            return F.when(end == start + 1, F.array(numbered(F.get(mers, start), F.lit(0)))).otherwise(
                F.transform(F.slice(mers, start + 1, end - start), lambda x, number: numbered(x, number)))

        return F.flatten(F.transform(starts, run))

    indexes = F.when(F.size(mers) > 0, F.sequence(F.lit(0), F.size(mers) - 1)).otherwise(F.array().cast("array<int>"))
    first = lambda i: (i == 0) | (_hash(F.get(mers, i)) != _hash(F.get(mers, i - 1)))
    return F.array_sort(let(F.filter(indexes, first), runs))


def _signature(numbered: Column) -> Column:
    """The two least of each coordinate, back in text order, hashed."""
    least = F.filter(numbered, lambda x, i: (i < SELECTED) | (_coordinate(F.get(numbered, i - SELECTED)) != _coordinate(x)))

    def coordinate(c: Column, chosen: Column) -> Column:
        own = F.filter(chosen, lambda x: _coordinate(x) == c)
        in_order = F.transform(own, lambda x: F.shiftleft(_place(x), HASH_BITS).bitwiseOR(_hash(x).bitwiseAND(_mask(HASH_BITS))))
        hashes = F.transform(F.array_sort(in_order), lambda x: x.bitwiseAND(_mask(HASH_BITS)))
        digits = lambda h: F.lpad(F.lower(F.hex(F.xxhash64(h).bitwiseAND(_mask(16)))), 4, "0")
        return let(hashes, lambda h: F.when(F.size(h) == 0, EMPTY).otherwise(digits(h)))

    numbers = F.sequence(F.lit(0), F.lit(COORDINATES - 1)).cast("array<bigint>")
    return let(least, lambda chosen: F.concat_ws("", F.transform(numbers, lambda c: coordinate(c, chosen))))


def order_minhash(text: Column) -> Column:
    """The fingerprint of a text."""
    units = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(UNIT), F.lit(0))
    return let(let(_mers(units), _numbered), _signature)


def likeness(a: Column, b: Column) -> Column:
    """The share of the coordinates filled in either fingerprint that agree (1 if none is filled)."""
    starts = F.sequence(F.lit(1), F.lit(4 * COORDINATES - 3), F.lit(4))
    part = lambda f, i: F.substr(f, i, F.lit(4))
    filled = F.filter(starts, lambda i: (part(a, i) != EMPTY) | (part(b, i) != EMPTY))
    return let(filled, lambda own: F.when(F.size(own) == 0, 1.0).otherwise(
        F.size(F.filter(own, lambda i: part(a, i) == part(b, i))).cast("double") / F.size(own)))


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the rising bounds are at most `key`, by binary search."""
    values = F.lit(bounds).cast("array<bigint>") if bounds else F.array().cast("array<bigint>")
    steps = F.sequence(F.lit(1), F.lit(max(1, len(bounds).bit_length() + 1)))
    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))

    def step(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        above = F.coalesce(F.get(values, middle) <= key, F.lit(False))
        return F.when(at["low"] >= at["high"], at).otherwise(F.struct(
            F.when(above, middle + 1).otherwise(at["low"]).alias("low"), F.when(above, at["high"]).otherwise(middle).alias("high")))

    return F.aggregate(steps, start, step)["low"]


def with_next(docs: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Each row with `next_<column>` of the row after it in descending order of `key`; the first follows the last.

    Rows are dealt once, to buckets of the key's range whose bounds are quantiles; each bucket is sorted by itself.  The
    first row of the next bucket is looked up by its key, so nothing is sorted as a whole.  Null keys come last; equal
    keys are in the order of a hash of the columns.
    """
    docs = docs.withColumn("__key", F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)))
    order = [F.desc("__key"), F.xxhash64(*columns).asc()]
    total = docs.count()
    buckets = max(1, min(BUCKETS, total // ROWS_A_BUCKET))
    cuts = [i / buckets for i in range(1, buckets)]
    bounds: list[int] = []
    if cuts:
        bounds = sorted(set(docs.agg(F.percentile_approx("__key", cuts, 10 * buckets + 1_000).alias("q")).first()["q"]))
    docs = docs.withColumn("__bucket", _bucket(F.col("__key"), bounds))
    window = Window.partitionBy("__bucket").orderBy(*order)
    # at most one row a bucket: the greatest key of each, collected, then its first row
    heads = {r["__bucket"]: r["top"] for r in docs.groupBy("__bucket").agg(F.max("__key").alias("top")).collect()}
    falling = sorted(heads, reverse=True)
    after = dict(zip(falling, falling[1:] + falling[:1]))
    spark = docs.sparkSession
    first = (docs.where(F.col("__key").isin(list(heads.values())))
             .select("__bucket", F.struct(*columns).alias("row"), F.row_number().over(window).alias("n")).where("n = 1"))
    pairs = [F.struct(F.lit(a).alias("__bucket"), F.lit(b).alias("before")) for b, a in after.items()]
    before = spark.range(1).select(F.inline(F.array(*pairs).cast("array<struct<__bucket:int,before:int>>")))
    heads_rows = first.join(before, "__bucket").select(F.col("before").alias("__bucket"), F.col("row").alias("__head"))
    following = docs.withColumn("__next", F.lead(F.struct(*columns)).over(window)).join(heads_rows, "__bucket", "left")
    row = F.coalesce("__next", "__head")
    return following.select("*", *[row[c].alias(f"next_{c}") for c in columns]).drop("__key", "__bucket", "__next", "__head")


def edited_text(text: Column, other: Column) -> Column:
    """The last half of the code points (rounded down) replaced by the first as many of `other`, or all."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.char_length(text) - half), F.substr(other, F.lit(1), half))


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next document's text, with their likeness."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    docs = docs.withColumn("fingerprint", order_minhash(F.col("text")))
    pairs = with_next(docs, "doc_id", ["text", "fingerprint"])
    edited = pairs.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    edited = edited.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                           "fingerprint", "next_fingerprint", order_minhash(F.col("edited")).alias("edited_fingerprint"))
    return edited.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                         likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                         likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
