"""Near-duplicates by an inverted join of MinHash coordinates, confirmed on full shingle sets.

Each distinct set of shingles is one node with a signature of `COORDINATES` minima.  A node is posted under its pairs
(coordinate, value).  Linked nodes (Jaccard 0.75 or more) agree in at least `MATCHES` coordinates but for a chance of
about one in ten millions.  Two nodes with so many matches share one of the rarest `COORDINATES - MATCHES + 1` pairs of
each, in one order for all: only this prefix is joined, the `MATCHES - 1` most frequent pairs of a node are skipped.

Each list has a hub, the most central of its nodes: the one whose pairs are the most frequent, as those of the original
among its copies.  In a round each node meets one hub, the most central of those of its lists that are in other
components, so candidates never outnumber the nodes.  Candidates with enough matching coordinates are confirmed on their
full sets, links are joined to components, and only lists that still hold several components go on.  Copies whose original
is not there have no central node: from the second round on the hub of a list is drawn by a hash, and each node meets the hub
that most of its lists have.
When what is left is small, or a round after the first `HUB_ROUNDS` has not halved it, each node meets every node of other
components in its lists, each pair in one of the lists they share, which is exact for the rest.

Two exact bounds keep unlike candidates from the full sets: linked sets differ in size by a quarter at most, and in at
most a seventh of their summed sizes as elements; a sketch of one parity bit for each of 1,024 hash values differs in no
more bits than the sets differ in elements.

Null texts and texts without words have no shingles and are linked with nothing.  A null id ranks last; a component of
null ids alone has the id null and keeps its rows.  Repeated rows and equal texts are one node.  Only id and text are
read.  Very long texts are bounded by their own shingles.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import HASH, KEY, Cache, add_columns, with_key
from millrace.llm.components import components
from millrace.session import cut_lineage

SHINGLE = 5
COORDINATES = 64
MATCHES = 30
PERCENT = 75
PARITIES = 1024
HUB_ROUNDS = 2
FEW = 2  # candidates for each posting that may be met at once

_MIX = np.random.RandomState(20).randint(1, 2**62, (2, COORDINATES)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.random.RandomState(5).randint(1, 2**62, SHINGLE + 1).astype(np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=1)
def _word_hashes() -> Cache:
    return Cache(xxhash.xxh64_intdigest, 100_000)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the 5-word shingles; of fewer words, of the whole sequence."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    known = _word_hashes()
    hashes = np.array([known[w] for w in words], np.uint64)
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    sums = np.full(n, width, np.uint64) * _STEP[SHINGLE]
    for k in range(width):
        sums += hashes[k:k + n] * _STEP[k]
    return np.unique(_mixed(sums))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The upper halves of the minima of the set under each coordinate's hash."""
    add, factor = _MIX
    minima = np.full(COORDINATES, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), 512):
        minima = np.minimum(minima, ((shingles[at:at + 512, None] ^ add) * factor).min(0))
    return (minima >> np.uint64(32)).astype(np.uint32).view(np.int32)


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles has each of the hash values, as 64-bit words."""
    odd = np.bincount((shingles & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, hash, n_shingles, node, signature, parity) of every row; what follows the size is null without words."""

    def make():
        def run(batch):
            sizes, nodes, signatures, parity = [], [], [], []
            for t in (x.as_py() for x in batch.column(text)):
                own = shingle_set(t)
                sizes.append(len(own))
                nodes.append(xxhash.xxh3_64_intdigest(own.tobytes()) - 2**63 if len(own) else None)
                signatures.append(signature(own) if len(own) else None)
                parity.append(parities(own) if len(own) else None)
            return [sizes, nodes, signatures, parity]

        return run

    keyed = with_key(docs.select(key, text), key, text)
    return add_columns(keyed, make, "n_shingles long, node long, signature array<int>, parity array<long>").drop(text)


def postings(nodes: DataFrame) -> DataFrame:
    """(`node`, `token`, `central`, `places`): the prefix of each node's pairs, rarest first, without pairs that no other
    node has.

    `central` sums how often the node's pairs occur; `places` has a bit for each coordinate of the prefix."""
    tokens = nodes.select("node", F.posexplode("signature").alias("c", "v"))
    tokens = tokens.select("node", (F.shiftleft(F.col("c").cast("long"), 32) + F.col("v").cast("long")).alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    ordered = tokens.join(often, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("own"))
    length = COORDINATES - MATCHES + 1 - (COORDINATES - F.size("own"))  # pairs of this node alone come first
    central = F.aggregate("own", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    prefix = ordered.where(length > 0).select("node", central.alias("central"), F.slice("own", F.lit(1), length).alias("own"))
    places = F.aggregate("own", F.lit(0).cast("long"), lambda s, x: s.bitwiseOR(F.call_function(
        "shiftleft", F.lit(1).cast("long"), _coordinate(x["token"]))))
    prefix = prefix.select("node", "central", places.alias("places"), F.explode("own").alias("x"))
    return prefix.select("node", F.col("x.token").alias("token"), "central", "places")


def _coordinate(token: Column) -> Column:
    """The coordinate of a pair; its value is signed."""
    return F.shiftright(token + 2**31, 32).cast("int")


def _first_shared(a: str, b: str) -> Column:
    """The first coordinate in which the nodes in the structs `a` and `b` are posted together."""
    shared = F.col(f"{a}.places").bitwiseAND(F.col(f"{b}.places"))
    agree = F.zip_with(f"{a}.signature", f"{b}.signature", lambda x, y: x == y)
    at = F.transform(agree, lambda e, i: e & (F.call_function("shiftright", shared, i).bitwiseAND(F.lit(1).cast("long")) == 1))
    return F.array_position(at, True) - 1


def _alike(a: str, b: str) -> Column:
    """Whether the nodes in the structs `a` and `b` may be linked: sizes, parities, then coordinates."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    sizes = 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)
    words = [F.bit_count(F.get(f"{a}.parity", F.lit(i)).bitwiseXOR(F.get(f"{b}.parity", F.lit(i)))) for i in range(PARITIES // 64)]
    same = F.size(F.filter(F.zip_with(f"{a}.signature", f"{b}.signature", lambda x, y: x == y), lambda e: e))
    return sizes & (sum(words[1:], words[0]) * (100 + PERCENT) <= (100 - PERCENT) * (n + m)) & (same >= MATCHES)


def _matching(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs that may be linked."""
    sketch = F.struct("n", "parity", "signature")
    a = nodes.select(F.col("node").alias("a"), sketch.alias("s"))
    b = nodes.select(F.col("node").alias("b"), sketch.alias("t"))
    return pairs.join(a, "a").join(b, "b").where(_alike("s", "t")).select("a", "b")


def _confirmed(pairs: DataFrame, places: DataFrame, keyed: DataFrame, text: str) -> DataFrame:
    """The pairs whose full sets are alike enough; sets are made anew from the texts of one document a node."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()

    def make():
        return lambda batch: [[shingle_set(t).tobytes() for t in batch.column(text).to_pylist()]]

    rows = places.join(wanted, "node", "left_semi").select("node", KEY, HASH)
    texts = keyed.join(rows, [KEY, HASH]).dropDuplicates(["node"]).select("node", text)
    sets = cut_lineage(add_columns(texts, make, "own binary").select("node", "own"))
    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("own").alias("t")), "b").join(
        sets.select(F.col("node").alias("a"), F.col("own").alias("s")), "a")

    def alike(batches):
        for batch in batches:
            keep = []
            for s, t in zip(batch.column("s").to_pylist(), batch.column("t").to_pylist()):
                x, y = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "s", "t").mapInArrow(alike, "a long, b long")


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: `doc_id, n_shingles, component_id, kept`, its class `node` and component `root` (null: no words)."""
    keyed = with_key(docs.select(key, text), key, text)
    own = cut_lineage(sketches(docs, key, text))
    nodes = own.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.any_value("n_shingles").alias("n"), F.any_value("parity").alias("parity"), F.any_value("signature").alias("signature"))
    nodes = cut_lineage(nodes)
    places = own.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(F.struct(KEY, HASH)).alias("x")).select("node", "x.*")
    lists = cut_lineage(postings(nodes))
    links = own.sparkSession.createDataFrame([], "a long, b long")
    roots, rounds, before = None, 0, -1
    while True:
        left = lists.withColumn("root", F.col("node")) if roots is None else lists.join(roots, "node", "left").withColumn(
            "root", F.coalesce("root", "node"))
        # lists with one component are settled
        sizes = left.groupBy("token", "root").agg(F.count("*").alias("k")).groupBy("token").agg(
            F.sum("k").alias("size"), F.sum(F.col("k") * F.col("k")).alias("squares"), F.count("*").alias("roots")).where("roots > 1")
        left = cut_lineage(left.join(sizes.select("token", "size"), "token"))
        work = sizes.agg(F.sum((F.col("size") * F.col("size") - F.col("squares")) / 2).alias("pairs"), F.sum("size").alias("rows")).first()
        if not work["rows"]:
            break
        last = work["pairs"] <= FEW * work["rows"] or (rounds >= HUB_ROUNDS and 2 * work["pairs"] > before)
        before, rounds = work["pairs"], rounds + 1
        if last:
            whole = left.join(nodes, "node").select("token", "node", "root", F.struct("n", "parity", "signature", "places").alias("sketch"))
            a, b = (whole.select("token", F.col("node").alias(x), F.col("root").alias(f"root_{x}"), F.col("sketch").alias(f"sketch_{x}"))
                    for x in "ab")
            met = a.join(b, (a["token"] == b["token"]) & (F.col("root_a") < F.col("root_b")) & _alike("sketch_a", "sketch_b")
                         & (_first_shared("sketch_a", "sketch_b") == _coordinate(a["token"])))
            likely = cut_lineage(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        else:
            rank = F.col("central") if rounds == 1 else F.xxhash64("node", F.lit(rounds))
            hubs = left.groupBy("token").agg(F.max(F.struct(rank.alias("rank"), "node", "root")).alias("hub"))
            met = left.join(hubs, "token").where(F.col("hub.root") != F.col("root"))
            if rounds > 1:
                met = met.groupBy("node", "hub").agg(F.count("*").alias("lists")).select(
                    "node", F.struct("lists", F.col("hub.rank").alias("rank"), F.col("hub.node").alias("node")).alias("hub"))
            met = met.groupBy("node").agg(F.max("hub").alias("hub"))
            pairs = met.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()
            likely = cut_lineage(_matching(pairs, nodes))
        links = cut_lineage(links.union(_confirmed(likely, places, keyed, text)))
        roots = cut_lineage(components(links))
        if last:
            break
    if roots is None:
        roots = own.sparkSession.createDataFrame([], "node long, root long")
    least = own.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(KEY).alias("least")).join(roots, "node", "left")
    least = least.withColumn("root", F.coalesce("root", "node"))
    named = cut_lineage(least.join(least.groupBy("root").agg(F.min("least").alias("__component")), "root").select("node", "root", "__component"))
    done = own.join(named, "node", "left").withColumn("component", F.coalesce("__component", KEY))
    null_id = 2**63 - 1
    doc_id, component = (F.when(F.col(c) != null_id, F.col(c)) for c in (KEY, "component"))
    return done.select(doc_id.alias("doc_id"), "n_shingles", component.alias("component_id"),
                       (F.col(KEY) == F.col("component")).alias("kept"), "node", "root", HASH)
