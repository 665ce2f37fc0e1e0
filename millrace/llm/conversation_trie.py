"""Prefix trie of conversations, by union-find over sorted neighbours.

Each turn is a digest of role and text.  Conversations are range-partitioned and sorted by their sequences of digests; the
number of turns that two neighbours share is an edge between them.  A partition takes its edges in descending depth: an edge
lifts both of its components to its depth, which emits the unary nodes on the way, and merges them into one component, which
is the branching node of that depth.  Every component is an interval of the sorted rows.

A component that reaches the first or last row of its partition may go on in another one.  Its nodes are *open*: partitions
emit them as partial sums under a hash of their path, contracted to what is closed below them, so there are at most two paths
for each partition.  They are merged by path and summed along their trie from the deepest node up.

Long conversations are cut into segments of `WIDTH` turns.  A segment is keyed by a hash of all turns before it, and each key
is the root of a trie of its own, so that a row stays small however long a conversation is; tries of later segments hand their
totals to the node they hang on.  Segments whose key only one conversation has are chains and need no trie.  Shared prefixes
of k segments take k rounds.

Turns of one conversation are ordered by turn (null first), ties by the digest.  Null role and text are empty ones.  Rows
without a conversation id take no part.  Repeated rows are turns of their own.  Texts of any length are digested whole.
An empty table has no node, not even a root.  Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.skew import hot_keys, lookup_join, with_position
from millrace.session import cut_lineage

WIDTH = 128  # turns of a segment
CHUNK = 100_000  # ids of one row on the way to a digest
DIGEST = 32  # characters of a digest
ROOT = "root"


def turns_of(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(`conv`, `pos` from 1, `digest` of role and text, `chars`: code points of the text)."""
    who, said = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    digest = F.md5(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said))
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), digest.alias("digest"), F.char_length(said).cast("long").alias("chars"))
    rows = cut_lineage(rows)
    return cut_lineage(with_position(rows, ["conv"], ["turn", "digest"], "pos", hot=hot_keys(rows, ["conv"])).select("conv", "pos", "digest", "chars"))


def with_shared_heads(turns: DataFrame, family: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their family: the turns, and (`conv`, `total`) of all conversations.

    The first h turns of conversation c (h = checksum of c modulo `most`) give way to those of conversation c - c % `family`.
    """
    counts = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    convs = counts.withColumns({"base": F.col("conv") - F.pmod("conv", F.lit(family)),
                                "h": F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(most))})
    bases = counts.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = cut_lineage(convs.join(bases, "base", "left").select("conv", "base", "h", "n", taken.alias("taken")))
    first = turns.where(F.col("pos") < most).withColumnRenamed("conv", "base")
    heads = first.join(convs.where("taken > 0").select("conv", "base", "taken"), "base").where("pos <= taken")
    own = lookup_join(turns, convs.select("conv", "h", "taken"), ["conv"]).where("pos > h")
    own = own.withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    columns = ["conv", "pos", "digest", "chars"]
    totals = convs.select("conv", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total"))
    return heads.select(*columns).unionByName(own.select(*columns)), totals


def segments_of(turns: DataFrame, totals: DataFrame, width: int) -> DataFrame:
    """(`conv`, `seg`, `key`, `next_key`, `ends`, `digests`, `chars`) of each segment; turnless conversations have an empty one."""
    parts = turns.withColumn("seg", F.floor((F.col("pos") - 1) / width).cast("int")).groupBy("conv", "seg").agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "chars"))).alias("turns"))
    parts = parts.select("conv", "seg", F.array_join("turns.digest", "").alias("digests"), F.col("turns.chars").alias("chars"))
    bare = totals.where("total = 0").select("conv", F.lit(0).alias("seg"), F.lit("").alias("digests"), F.array().cast("array<long>").alias("chars"))
    order = Window.partitionBy("conv").orderBy("seg")

    def path(until: int):
        over = order.rowsBetween(Window.unboundedPreceding, until)
        halves = [F.hex(F.bit_xor(F.xxhash64(*parts)).over(over)) for parts in (("seg", "digests"), ("digests", "seg", F.lit(1)))]
        return F.concat_ws(":", (F.col("seg") + 1 + until).cast("string"), *halves)

    keyed = parts.unionByName(bare).select("*", F.when(F.col("seg") == 0, F.lit(ROOT)).otherwise(path(-1)).alias("key"), path(0).alias("next_key"))
    ends = F.lead("seg").over(order).isNull()
    return cut_lineage(keyed.withColumn("ends", ends))


def _chunks(ids: list[int]) -> Iterator[tuple[int, str]]:
    for at in range(0, len(ids), CHUNK):
        yield ids[at], ",".join(map(str, ids[at:at + CHUNK]))


def _shared(a: str, b: str) -> int:
    at, end = 0, min(len(a), len(b))
    while at < end and a[at:at + DIGEST] == b[at:at + DIGEST]:
        at += DIGEST
    return at // DIGEST


FOREST = ("kind string, trie string, node string, parent string, port string, depth long, conv long, parent_conv long, n_convs long, "
          "n_children long, n_leaves long, saved long, chars long, below array<long>, first long, ids string")
_NAMES = [part.split()[0] for part in FOREST.split(", ")]
_AT = {name: i for i, name in enumerate(_NAMES)}
_KINDS = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
_SCHEMA = pa.schema([(p.split()[0], _KINDS[p.split()[1]]) for p in FOREST.split(", ")])


class Component:
    """An interval of sorted rows that share `top` turns; what is known of the trie node of that depth."""

    __slots__ = ("lo", "hi", "top", "low", "children", "leaves", "saved", "ids", "kids", "below")

    def __init__(self, row: int, top: int, conv: int, ends: bool, below: list[int] | None):
        self.lo = self.hi = row
        self.top, self.low, self.below = top, conv, below
        self.children = self.leaves = self.saved = 0
        self.ids, self.kids = [conv] if ends else [], []

    def absorb(self, other: Component) -> None:
        """Both stand at the same depth, `other` to the right: they are one node."""
        self.hi, self.low = other.hi, min(self.low, other.low)
        self.children, self.leaves, self.saved = self.children + other.children, self.leaves + other.leaves, self.saved + other.saved
        self.ids += other.ids
        self.kids += other.kids
        self.below = self.below or other.below


def forest(rows: list[tuple]) -> list[list]:
    """The nodes of the sorted rows (key, digests, conv, chars, ends, next_key, below) of one partition, as `FOREST`."""
    out: list[list] = []
    made = [Component(i, len(r[1]) // DIGEST, r[2], r[4], r[6]) for i, r in enumerate(rows)]
    above = list(range(len(rows)))

    def find(i: int) -> int:
        while above[i] != i:
            above[i] = i = above[above[i]]
        return i

    def put(**values) -> int:
        row = [None] * len(_NAMES)
        for name, value in values.items():
            row[_AT[name]] = value
        out.append(row)
        return len(out) - 1

    def path(c: Component, depth: int) -> str:
        key, digests = rows[c.lo][:2]
        return hashlib.md5(f"{key}{digests[:DIGEST * depth]}".encode()).hexdigest() if depth else key

    def lift(c: Component, depth: int) -> None:
        """Emits the nodes of `c` from its top to one below `depth`."""
        while c.top > depth:
            row, n = rows[c.lo], c.hi - c.lo + 1
            common = {"trie": row[0], "depth": c.top, "conv": c.low, "n_convs": n, "chars": row[3][c.top - 1], "below": c.below,
                      "port": row[5] if c.below else None}
            if c.lo == 0 or c.hi == len(rows) - 1:
                emit_open(c, common)
                c.children = c.leaves = c.saved = 0
                c.kids = []
            else:
                children, leaves, saved = (x + y for x, y in zip((c.children, c.leaves, c.saved), c.below or (0, 0, 0)))
                c.leaves, c.saved, c.children = leaves or 1, saved + (n - 1) * common["chars"], 1
                at = put(kind="closed", **common, n_children=children, n_leaves=c.leaves, saved=c.saved, ids=",".join(map(str, sorted(c.ids))))
                for kid in c.kids:
                    out[kid][_AT["parent_conv"]] = c.low
                c.kids = [at]
            c.ids, c.below = [], None
            c.top -= 1

    def emit_open(c: Component, common: dict) -> None:
        node = path(c, c.top)
        put(kind="open", **common, node=node, parent=path(c, c.top - 1) if c.top else None, n_children=c.children, n_leaves=c.leaves, saved=c.saved)
        for kid in c.kids:
            out[kid][_AT["parent"]] = node
        for first, ids in _chunks(sorted(c.ids)):
            put(kind="ends", node=node, first=first, ids=ids)

    edges = [(_shared(rows[i - 1][1], rows[i][1]), i) for i in range(1, len(rows)) if rows[i - 1][0] == rows[i][0]]
    for depth, i in sorted(edges, key=lambda e: (-e[0], e[1])):
        left, right = find(i - 1), find(i)
        a, b = made[left], made[right]
        lift(a, depth)
        lift(b, depth)
        a.absorb(b)
        above[right] = left
    for i, c in enumerate(made):
        if above[i] == i:
            lift(c, 0)
            emit_open(c, {"trie": rows[c.lo][0], "depth": 0, "conv": c.low, "n_convs": c.hi - c.lo + 1, "chars": 0})
    return out


def _forests(batches):
    rows = []
    for batch in batches:
        rows += zip(*(batch.column(c).to_pylist() for c in ("key", "digests", "conv", "chars", "ends", "next_key", "below")))
    nodes = forest(rows)
    for at in range(0, len(nodes), 20_000):
        part = nodes[at:at + 20_000]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], f.type) for i, f in enumerate(_SCHEMA)], schema=_SCHEMA)


def _sums(batches):
    """Open nodes, by trie and from the deepest up -> the same with their totals."""
    names = ["trie", "node", "parent", "port", "depth", "conv", "n_convs", "n_children", "n_leaves", "saved"]
    trie, waiting = None, {}
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["trie"] != trie:
                trie, waiting = r["trie"], {}
            more = [r["n_children"], r["n_leaves"], r["saved"]]
            for extra in (r["below"], waiting.pop(r["node"], None)):
                more = [x + y for x, y in zip(more, extra or (0, 0, 0))]
            children, leaves, saved = more[0], more[1] or 1, more[2] + (r["n_convs"] - 1) * r["chars"]
            up = waiting.setdefault(r["parent"], [0, 0, 0])
            up[:] = up[0] + 1, up[1] + leaves, up[2] + saved
            out.append((*(r[n] for n in names[:7]), children, leaves, saved))
        kinds = [_SCHEMA.field(n).type for n in names]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names)


def _hashes(batches):
    """(node, first, ids), sorted -> (node, digest of the joined ids)."""
    node, digest, done = None, None, []
    for batch in batches:
        for n, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if n != node:
                if digest:
                    done.append((node, digest.hexdigest()))
                node, digest = n, hashlib.sha256(ids.encode())
            else:
                digest.update(f",{ids}".encode())
    if digest:
        done.append((node, digest.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in range(2)], ["node", "ends_sha256"])


def _level(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The forest of the segments of one level, and its open nodes with their totals."""
    columns = ["key", "digests", "conv"]
    made = rows.repartitionByRange(*columns).sortWithinPartitions(*columns)
    made = cut_lineage(made.select(*columns, "chars", "ends", "next_key", "below").mapInArrow(_forests, FOREST))
    merged = made.where("kind = 'open'").groupBy("trie", "node", "parent", "depth").agg(
        F.max("port").alias("port"), F.min("conv").alias("conv"), F.max("chars").alias("chars"), F.max("below").alias("below"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")])
    merged = merged.repartition("trie").sortWithinPartitions("trie", F.desc("depth"))
    totals = "trie string, node string, parent string, port string, depth long, conv long, n_convs long, n_children long, n_leaves long, saved long"
    return made, cut_lineage(merged.mapInArrow(_sums, totals))


def prefix_trie(turns: DataFrame, totals: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row for each prefix of any conversation.

    `turns` has (`conv`, `pos`, `digest`, `chars`), `totals` all conversations (`conv`, `total`).  Returns `conv_id` (least
    member), `depth`, `parent_conv_id`, `n_convs`, `n_children`, `n_leaves`, `saved_tokens`, `ends_sha256`.
    """
    segments = segments_of(turns, totals, width)
    later = segments.where("seg > 0")
    shared = cut_lineage(later.groupBy("key", "seg").agg(F.count("*").alias("n")).where("n > 1"))
    deepest = shared.agg(F.coalesce(F.max("seg"), F.lit(0)).alias("seg")).first()["seg"]
    chains = later.join(shared.select("key"), "key", "left_anti")
    columns = ["depth", "conv", "n_convs", "n_children", "n_leaves", "saved", "sha", "parent", "parent_conv"]
    nothing = F.sha2(F.lit(""), 256)
    i = F.col("i")
    last = F.col("ends") & (i == F.size("chars") - 1)
    known = [chains.select("*", F.posexplode("chars").alias("i", "_")).select(
        (F.col("seg") * width + i + 1).cast("long").alias("depth"), "conv", F.lit(1).cast("long").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved"),
        F.when(last, F.sha2(F.col("conv").cast("string"), 256)).otherwise(nothing).alias("sha"),
        F.when(i == 0, F.col("key")).alias("parent"), F.when(i > 0, F.col("conv")).alias("parent_conv"))]
    parents = [chains.where("NOT ends").select(F.col("next_key").alias("parent"), F.col("conv").alias("found"))]
    below = None
    for level in range(deepest, -1, -1):
        rows = segments.where(F.col("seg") == level)
        if level:
            rows = rows.join(shared.select("key"), "key", "left_semi")
        single = F.array(*[F.lit(x).cast("long") for x in (1, 1, 0)])
        if below is not None:
            rows = rows.join(below, "next_key", "left")
            single = F.coalesce("totals", single)
        made, opened = _level(rows.withColumn("below", F.when(~F.col("ends"), single)))
        below = opened.where("depth = 0").select(F.col("trie").alias("next_key"), F.array("n_children", "n_leaves", "saved").alias("totals"))
        ends = made.where("kind = 'ends'").select("node", "first", "ids").repartition("node").sortWithinPartitions("node", "first")
        opened = opened.where("depth > 0 OR trie = 'root'").join(ends.mapInArrow(_hashes, "node string, ends_sha256 string"), "node", "left")
        opened = cut_lineage(opened.withColumn("sha", F.coalesce("ends_sha256", nothing)))
        closed = made.where("kind = 'closed'").withColumn("sha", F.sha2("ids", 256))
        deep = (F.col("depth") + level * width).alias("depth")
        for part in (closed, opened.withColumn("parent_conv", F.lit(None).cast("long"))):
            known.append(part.select(deep, *columns[1:]))
            parents.append(part.where("port IS NOT NULL").select(F.col("port").alias("parent"), F.col("conv").alias("found")))
        parents.append(opened.select(F.col("node").alias("parent"), F.col("conv").alias("found")))
    nodes, keys = known[0], parents[0]
    for more in known[1:]:
        nodes = nodes.unionByName(more)
    for more in parents[1:]:
        keys = keys.unionByName(more)
    nodes = cut_lineage(nodes)
    asking = lookup_join(nodes.where("parent IS NOT NULL"), cut_lineage(keys), ["parent"], "left").withColumn("parent_conv", F.col("found"))
    done = nodes.where("parent IS NULL").select(*columns).unionByName(asking.select(*columns))
    return done.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
                       "n_leaves", F.col("saved").alias("saved_tokens"), F.col("sha").alias("ends_sha256"))
