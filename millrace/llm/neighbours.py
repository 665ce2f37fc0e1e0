"""Nearest neighbours by inner product over stable projections, kd-trees and a chi-square stopping test.

Inner products become distances by one more coordinate, which gives all vectors the length of the longest.  Vectors are
projected on a few random Gaussian directions.  A squared projected distance divided by the squared true distance is
chi-square distributed, so a tree of the projections is searched from near to far, what it yields is verified on the
whole vectors, and the search ends once the next projected distance would be exceeded by chance `1 - confidence` only
by a vector as near as the worst one kept.

The projected space is cut into at most `LEAVES` cells, by medians of a bounded sample; every vector goes to a cell, and
cells to chunks of some `CHUNK` vectors with a kd-tree each.  A query searches a chunk of its own cell, then, with the
bound found there, all chunks of the cells within reach; queries come in blocks.  Equal vectors are one node with its
first ids, so a third of all rows may be one vector.

Rows with a null id and vectors that are null, empty, zero, of a rare length (other than the most frequent) or hold
null or non-finite components take no part.  Rows that share an id count once for equal vectors, and never as neighbours of
their own id.  Equal scores go by the smaller id.  Only id and vector are read.  Empty tables give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut_lineage

NEAREST = 20
DIRECTIONS = 32  # even, for the closed form of the chi-square distribution
CONFIDENCE = 0.9  # chosen with the directions by measured recall, see the README
LEAVES, CHUNK, BLOCK = 8_192, 8_192, 1_024
SAMPLE = 20_000  # projected vectors that the cuts of the cells are fitted on, or 16 for each cell if that is more
BRANCH = 512  # vectors in a leaf of a kd-tree
SEED = 7


def chi_square_quantile(p: float, m: int) -> float:
    """The value that a chi-square variable of `m` (even) degrees stays under with probability `p`."""
    below = lambda x: 1 - math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(m // 2))
    low, high = 0.0, 10.0 * m + 100.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


class Tree:
    """A kd-tree over projected points: `order` puts them leaf by leaf, each leaf has its range there and its box."""

    def __init__(self, points: np.ndarray):
        leaves: list[np.ndarray] = []
        boxes: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = [np.arange(len(points))]
        while waiting:
            rows = waiting.pop()
            own = points[rows]
            low, high = own.min(0), own.max(0)
            axis = int(np.argmax(high - low))
            if len(rows) <= BRANCH or high[axis] == low[axis]:
                leaves.append(rows)
                boxes.append((low, high))
            else:
                half = len(rows) // 2
                cut = np.argpartition(own[:, axis], half)
                waiting += [rows[cut[half:]], rows[cut[:half]]]
        self.order = np.concatenate(leaves)
        self.ends = np.cumsum([len(rows) for rows in leaves])
        self.points = points[self.order]
        self.squares = np.einsum("ij,ij->i", self.points, self.points)
        self.low, self.high = (np.array([box[k] for box in boxes]) for k in range(2))

    def near_to_far(self, q: np.ndarray):
        """(projected squared distance of a leaf at least, its range), by rising distance."""
        gap = np.maximum(np.maximum(self.low - q, q - self.high), 0.0)
        distance = np.einsum("ij,ij->i", gap, gap)
        for at in np.argsort(distance, kind="stable").tolist():
            yield distance[at], slice(self.ends[at - 1] if at else 0, self.ends[at])


def search(tree: Tree, vectors: np.ndarray, first_ids: np.ndarray, q: np.ndarray, projected: np.ndarray, longest: float,
           most: int, bound: float, reach: float) -> tuple[list[tuple[float, int]], int]:
    """(score, row) of the best `most` rows, and how many rows were verified on their whole vectors.

    Vectors and ids come in the order of the tree.  `bound` is a squared distance that `most` vectors elsewhere stay
    within.  Leaves come by their projected distance, and of a leaf the rows whose own projected distance passes the test
    with the bound of that moment; the bound only falls, so a row that fails it once would fail it later.
    """
    base = longest + float(q @ q)  # squared distance = base - 2 * inner product
    square, best_scores, best_rows, verified = float(projected @ projected), np.zeros(0), np.zeros(0, int), 0
    for d, leaf in tree.near_to_far(projected):
        if d > reach * bound:
            break
        apart = tree.squares[leaf] + square - 2.0 * (tree.points[leaf] @ projected)
        rows = leaf.start + np.flatnonzero(apart <= reach * bound * (1 + 1e-12))
        if not len(rows):
            continue
        verified += len(rows)
        scores = vectors[rows] @ q
        if len(best_scores) == most:  # ties stay, they go by id
            rows, scores = rows[scores >= best_scores[-1]], scores[scores >= best_scores[-1]]
        own, scores = np.concatenate([best_rows, rows]), np.concatenate([best_scores, scores])
        order = np.lexsort((first_ids[own], -scores))[:most]
        best_scores, best_rows = scores[order], own[order]
        if len(order) == most:
            bound = min(bound, max(base - 2 * float(best_scores[-1]), 0.0))
    return list(zip(best_scores.tolist(), best_rows.tolist())), verified


def _directions(width: int) -> np.ndarray:
    return np.random.RandomState(SEED).standard_normal((width + 1, DIRECTIONS))


def _cut(points: np.ndarray, depth: int) -> list:
    """Axis and value of each cut of a balanced tree of `depth` levels, as a heap of 2**depth - 1 nodes."""
    cuts: list = [(0, 0.0)] * (2**depth - 1)
    parts = {0: points}
    for at in range(len(cuts)):
        own = parts.pop(at)
        axis = int(np.argmax(own.max(0) - own.min(0))) if len(own) else 0
        value = float(np.median(own[:, axis])) if len(own) else 0.0
        cuts[at] = (axis, value)
        right = own[:, axis] > value
        parts[2 * at + 1], parts[2 * at + 2] = own[~right], own[right]
    return cuts


def _cells(points: np.ndarray, cuts: list, depth: int) -> np.ndarray:
    axes, values = np.array([c[0] for c in cuts], int), np.array([c[1] for c in cuts])
    at = np.zeros(len(points), int)
    for _ in range(depth):
        at = 2 * at + 1 + (points[np.arange(len(points)), axes[at]] > values[at])
    return at - (2**depth - 1)


def _valid(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    own = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).dropna()
    sound = F.forall("v", lambda x: F.coalesce((x == x) & (F.abs(x) != float("inf")) & ~F.isnan(x), F.lit(False)))
    return own.where((F.size("v") > 0) & sound & F.exists("v", lambda x: x != 0))


def nearest(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = NEAREST,
            confidence: float = CONFIDENCE) -> DataFrame:
    """`query_id, rank, vec_id, score` of the `k` nearest rows found for each row whose id (column `id`) is a query."""
    rows = _valid(vectors, key, vector)
    widths = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    width = widths["n"] if widths else 1
    node = F.concat(F.hex(F.xxhash64("v")), F.lit("-"), F.hex(F.xxhash64("v", F.lit(SEED))))
    rows = cut_lineage(rows.where(F.size("v") == width).withColumn("node", node).dropDuplicates(["id", "node"]))
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("node").orderBy("id"))).where(F.col("n") <= k + 1)
    groups = first.groupBy("node").agg(F.any_value("v").alias("v"), F.array_sort(F.collect_list("id")).alias("ids"))
    squared = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    groups = cut_lineage(groups.withColumn("squared", squared))
    total = groups.agg(F.count("*").alias("n"), F.max("squared").alias("longest")).first()
    longest, count = total["longest"] or 0.0, total["n"]
    depth = max(0, min(int(math.log2(LEAVES)), math.ceil(math.log2(max(1, count / CHUNK)))))
    matrix, reach, most = _directions(width), chi_square_quantile(confidence, DIRECTIONS), k + 1

    def projections(pdf: pd.DataFrame, query: bool) -> np.ndarray:
        v = np.stack(pdf["v"]).astype(float)
        extra = np.zeros(len(v)) if query else np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", v, v), 0.0))
        return np.column_stack([v, extra]) @ matrix

    def projected(query: bool):
        def run(frames):
            for pdf in frames:
                if len(pdf):
                    yield pdf.assign(p=list(projections(pdf, query)))

        return run

    data = groups.mapInPandas(projected(False), "node string, v array<double>, ids array<long>, squared double, p array<double>")
    drawn = data.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, max(SAMPLE, 16 << depth) / max(1, count)))))
    cuts = _cut(np.array([r["p"] for r in drawn.select("p").collect()]).reshape(-1, DIRECTIONS), depth) if depth else []

    def with_cell(frames):
        for pdf in frames:
            if len(pdf):
                yield pdf.assign(cell=_cells(np.stack(pdf["p"]), cuts, depth).astype("int32"))

    columns = "node string, v array<double>, ids array<long>, p array<double>"
    data = data.select("node", "v", "ids", "p").mapInPandas(with_cell, f"{columns}, cell int")
    data = cut_lineage(data)
    # one row a cell, at most LEAVES
    edges = [f(F.col("p")[i]).alias(f"{n}{i}") for n, f in (("low", F.min), ("high", F.max)) for i in range(DIRECTIONS)]
    cells = {r["cell"]: r for r in data.groupBy("cell").agg(F.count("*").alias("n"), *edges).collect()}
    chunks = {c: -(-r["n"] // CHUNK) for c, r in cells.items()}
    names = np.array(sorted(cells), int)
    low = np.array([[cells[c][f"low{i}"] for i in range(DIRECTIONS)] for c in names]).reshape(-1, DIRECTIONS)
    high = np.array([[cells[c][f"high{i}"] for i in range(DIRECTIONS)] for c in names]).reshape(-1, DIRECTIONS)
    chunk_of = F.element_at(F.create_map(*[F.lit(x) for c, n in chunks.items() for x in (c, n)]), F.col("cell")) if chunks else F.lit(1)
    data = data.withColumn("chunk", F.pmod(F.xxhash64("node"), chunk_of).cast("int"))

    asked = rows.where(is_query).select("id", "node")
    queries = groups.join(asked.select("node").distinct(), "node", "left_semi")
    queries = queries.mapInPandas(projected(True), "node string, v array<double>, ids array<long>, squared double, p array<double>")

    def blocked(visits: DataFrame) -> DataFrame:
        """Visits (cell, chunk, ...) dealt to blocks, so that a task gets a bounded number of queries for a chunk."""
        sizes = visits.groupBy("cell", "chunk").agg(F.count("*").alias("n"))
        blocks = sizes.select("cell", "chunk", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
        blocks = cut_lineage(blocks)  # a number for each chunk asked
        visits = visits.join(blocks, ["cell", "chunk"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        visits = visits.drop("blocks")
        copies = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("block")
        own = data.join(blocks.withColumnRenamed("blocks", "copies"), ["cell", "chunk"]).select(*data.columns, copies)

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            found: dict[str, list] = {"query": [], "node": [], "score": [], "first_id": []}
            if len(left) and len(right):
                tree = Tree(np.stack(right["p"]))
                right = right.iloc[tree.order]
                vectors_, ids = np.stack(right["v"]).astype(float), right["ids"].map(lambda x: x[0]).to_numpy()
                nodes = right["node"].to_numpy()
                for name, v, p, bound in zip(left["node"], left["v"], left["p"], left["bound"]):
                    for score, row in search(tree, vectors_, ids, np.asarray(v, float), np.asarray(p), longest, most, bound, reach)[0]:
                        for column, value in zip(found.values(), (name, nodes[row], score, int(ids[row]))):
                            column.append(value)
            return pd.DataFrame(found)

        by = ["cell", "chunk", "block"]
        return visits.groupBy(*by).cogroup(own.groupBy(*by)).applyInPandas(
            run, "query string, node string, score double, first_id long")

    def at_home(frames):
        for pdf in frames:
            if len(pdf) and len(names):
                cell = _cells(np.stack(pdf["p"]), cuts, depth)
                gaps = [np.maximum(np.maximum(low - p, p - high), 0.0) for p in pdf["p"]]
                near = [c if c in cells else int(names[np.argmin((g * g).sum(1))]) for c, g in zip(cell.tolist(), gaps)]
                yield pdf[["node", "v", "p"]].assign(cell=np.array(near, "int32"), chunk=np.int32(0), bound=np.inf)

    visit = "node string, v array<double>, p array<double>, cell int, chunk int, bound double"
    home = cut_lineage(queries.mapInPandas(at_home, visit))
    start = cut_lineage(blocked(home))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "first_id")
    worst = start.withColumn("n", F.row_number().over(best)).where(F.col("n") == most).select(F.col("query").alias("node"), "score")

    def within_reach(frames):
        for pdf in frames:
            out = []
            for name, v, p, score, home_cell in zip(pdf["node"], pdf["v"], pdf["p"], pdf["score"], pdf["cell"]):
                v = np.asarray(v, float)
                bound = np.inf if score is None or np.isnan(score) else max(longest + float(v @ v) - 2 * score, 0.0)
                gaps = np.maximum(np.maximum(low - p, p - high), 0.0)
                for cell in names[(gaps * gaps).sum(1) <= reach * bound].tolist():
                    out += [(name, v, p, cell, c, bound) for c in range(chunks[cell]) if (cell, c) != (home_cell, 0)]
            yield pd.DataFrame(out, columns=["node", "v", "p", "cell", "chunk", "bound"])

    more = blocked(cut_lineage(home.select("node", "v", "p", "cell").join(worst, "node", "left").mapInPandas(within_reach, visit)))
    found = start.union(more).withColumn("n", F.row_number().over(best)).where(F.col("n") <= most)
    listed = found.select("query", "node", "score").join(groups.select("node", "ids"), "node")
    listed = listed.select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    listed = listed.withColumn("n", F.row_number().over(order)).where(F.col("n") <= most)
    lists = listed.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
    answers = asked.join(cut_lineage(lists).withColumnRenamed("query", "node"), "node")
    own = F.filter("near", lambda x: x["vec_id"] != F.col("id"))
    answers = answers.select(F.col("id").alias("query_id"), F.posexplode(F.slice(own, 1, k)).alias("n", "x"))
    return answers.select("query_id", (F.col("n") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
