"""Line dedup by pairwise alignment of documents that share lines.

Lines are normalised (lower case, words only) and hashed; where a script sets no spaces, two characters count as a word.  A line of at least four words, and each shortest run of
neighbouring lines that has `min_words` words, pairs each of its holders with its first holder (by id); a rare one, of
up to `rare` holders, also pairs its holders with each other.  So every shared line or run proposes pairs, as many as it
has holders, and no frequent one proposes the square of them.  A shared block is covered by such runs, and each is met
in its own first holder, so that a block is found whatever the first holders of its single lines are.  Pairs are
aligned by patience diff: lines unique in both are anchors, the longest rising run of them is kept, and the stretches
between are aligned the same way.  Blocks of neighbouring common lines with at least `min_words` words are deleted
from the later document, and what is left of it is compared again, in any order, until no such block is common.  The first holder of a line is never the later document for it, so a line never
vanishes from all its holders.

Null texts stay null, empty ones empty; documents are ordered by id, null ids last, and those of one id by the hash
of their text.  Rows that agree in id and text are one document.  Only hashes of lines are shuffled for
the comparison, so a very long text is bounded by its own lines.  All columns of the input stay; a result column
replaces one of the same name.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import HASH, KEY, WORD, add_columns, with_key
from millrace.session import cut_lineage

TELLING = 4
RARE = 4
MIN_WORDS = 8


def hashed_lines(text: str) -> tuple[list[int], list[int]]:
    """The hash and the number of words of each line."""
    words = [WORD.findall(line) for line in text.lower().split("\n")]
    return [xxhash.xxh64_intdigest(" ".join(w)) - 2**63 for w in words], [len(w) for w in words]


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs (rising in their first part) that rises in the second."""
    tops: list[int] = []
    ends: list[int] = []
    back = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        back.append(ends[at - 1] if at else -1)
        tops[at:at + 1], ends[at:at + 1] = [j], [k]
    found, k = [], ends[-1] if ends else -1
    while k >= 0:
        found.append(pairs[k])
        k = back[k]
    return found[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (i, j) with a[i] == b[j], rising in both."""
    found, work = [], [(0, len(a), 0, len(b))]
    while work:
        i, i_end, j, j_end = work.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            found.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        place = {b[y]: y for y in range(j, j_end) if in_b[b[y]] == 1}
        anchors = rising([(x, place[a[x]]) for x in range(i, i_end) if in_a[a[x]] == 1 and a[x] in place])
        for x, y in anchors:
            work.append((i, x, j, y))
            found.append((x, y))
            i, j = x + 1, y + 1
        if anchors:
            work.append((i, i_end, j, j_end))
    return sorted(found)


def shortest_runs(words: list[int], least: int) -> list[tuple[int, int]]:
    """(start, end) of the shortest runs of at least `least` words: from each line with words on, and up to each.

    Any longer run is covered by those within it, but for lines without words.
    """
    least, found, end, size = max(1, least), set(), 0, 0
    for start, n in enumerate(words):
        while end < len(words) and size < least:
            size, end = size + words[end], end + 1
        if size < least:
            break
        if n:
            found.add((start, end))
        size -= n
    start = size = 0
    for end, n in enumerate(words, 1):
        size += n
        while size - words[start] >= least:
            size, start = size - words[start], start + 1
        if n and size >= least:
            found.add((start, end))
    return sorted(found)


def windows(lines: list[int], words: list[int], min_words: int) -> dict[tuple[int, int], int]:
    """The hashes of the shortest runs; equal runs have equal ones in all documents."""
    return {(x, y): lines[x] if y == x + 1 else xxhash.xxh64_intdigest(array("q", lines[x:y]).tobytes()) - 2**63
            for x, y in shortest_runs(words, min_words)}


def proposals(lines: list[int], words: list[int], min_words: int) -> list[int]:
    """Hashes of the telling lines, and of the shortest runs of `min_words` words."""
    return list({h for h, n in zip(lines, words) if n >= TELLING}.union(windows(lines, words, min_words).values()))


def aligned_blocks(a: list[int], b: list[int], words: list[int], min_words: int) -> set[int]:
    """Places in `b` of the blocks of the patience diff that are long enough."""
    out, block = set(), []
    for i, j in [*patience(a, b), (-1, -1)]:
        if block and (i, j) != (block[-1][0] + 1, block[-1][1] + 1):
            if sum(words[y] for _, y in block) >= min_words:
                out.update(y for _, y in block)
            block = []
        block.append((i, j))
    return out


def common_blocks(a: list[int], b: list[int], words: list[int], min_words: int) -> list[int]:
    """Places in `b` of the blocks that `a` holds too: those aligned, and what is left is compared again until none is long enough.

    Blocks that no alignment finds (second copies, crossing order) are found by their windows.
    """
    left, sizes, held = list(range(len(b))), dict(zip(b, words)), None
    in_a = set(a)
    while left:
        lines, counts = [b[y] for y in left], [words[y] for y in left]
        size = most = 0
        for x, n in zip(lines, counts):
            size = size + n if x in in_a else 0
            most = max(most, size)
        if most < min_words:
            break
        gone = aligned_blocks(a, lines, counts, min_words)
        if held is None:  # runs of `a` with a line that `b` has not cannot match
            held = {h for x, y in stretches(a, sizes) for h in windows(a[x:y], [sizes[z] for z in a[x:y]], min_words).values()}
        for (x, y), h in windows(lines, counts, min_words).items():
            if h in held:
                gone.update(range(x, y))
        if not gone:
            break
        left = [y for at, y in enumerate(left) if at not in gone]
    kept = set(left)
    return [y for y in range(len(b)) if y not in kept]


def stretches(a: list[int], known: dict) -> list[tuple[int, int]]:
    """(start, end) of the longest stretches of `a` of known lines."""
    edges = [-1, *(i for i, x in enumerate(a) if x not in known), len(a)]
    return [(x + 1, y) for x, y in zip(edges, edges[1:]) if y > x + 1]


def document_pairs(lines: DataFrame, rare: int) -> DataFrame:
    """(`earlier`, `later`) documents that share a telling line or run; `lines` has (line, doc), `doc` is (key, tag).

    The shared lines are a table, so that Spark can split the join at a line which very many documents hold.
    """
    shared = lines.groupBy("line").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("n"))
    held = cut_lineage(lines.join(cut_lineage(shared.where("first < last").drop("last")), "line"))
    by_first = held.where("doc > first").select(F.col("first").alias("earlier"), F.col("doc").alias("later"))
    few = held.where(F.col("n") <= rare).select("line", "doc")
    by_line = few.withColumnRenamed("doc", "earlier").join(few.withColumnRenamed("doc", "later"), "line").where("earlier < later")
    return by_first.union(by_line.select("earlier", "later")).distinct()


def remove_common_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", removed: str = "removed_lines",
                        min_words: int = MIN_WORDS, rare: int = RARE) -> DataFrame:
    """`docs` without the lines that earlier documents hold in aligned blocks; `removed` lists their places (from 0)."""
    columns = [c for c in docs.columns if c != removed]

    def hashes():
        def run(batch):
            both = [hashed_lines(t or "") for t in batch.column(text).to_pylist()]
            return [[h for h, _ in both], [n for _, n in both], [proposals(h, n, min_words) for h, n in both]]

        return run

    keyed = with_key(docs.select(key, text), key, text)
    bodies = cut_lineage(add_columns(keyed, hashes, "lines array<long>, words array<int>, telling array<long>")
                         .select(KEY, HASH, "lines", "words", "telling"))
    telling = bodies.select(F.struct(F.col(KEY).alias("key"), F.col(HASH).alias("tag")).alias("doc"), F.explode("telling").alias("line")).distinct()
    pairs = document_pairs(telling, rare).select(F.col("earlier.key").alias("earlier"), F.col("earlier.tag").alias("earlier_tag"),
                                                 F.col("later.key").alias("later"), F.col("later.tag").alias("tag"))
    later = bodies.select(F.col(KEY).alias("later"), F.col(HASH).alias("tag"), F.col("lines").alias("b"), "words")
    earlier = bodies.select(F.col(KEY).alias("earlier"), F.col(HASH).alias("earlier_tag"), F.col("lines").alias("a"))

    def align(batches):
        names = ["later", "tag", "places"]
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("later", "tag", "a", "b", "words")))
            found = [(k, tag, places) for k, tag, a, b, words in rows if (places := common_blocks(a, b, words, min_words))]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], t) for i, t in enumerate(kinds)], names)

    aligned = pairs.join(later, ["later", "tag"]).join(earlier, ["earlier", "earlier_tag"]).mapInArrow(align, "later long, tag long, places array<int>")
    cuts = aligned.select("later", "tag", F.explode("places").alias("place")).distinct()
    cuts = cuts.groupBy("later", "tag").agg(F.array_sort(F.collect_list("place")).alias("__places"))
    cuts = cuts.withColumnsRenamed({"later": KEY, "tag": HASH})
    kept = with_key(docs.select(*columns), key, text).join(cuts, [KEY, HASH], "left")

    def without():
        def run(batch):
            texts, places = [], []
            for t, cut in zip(batch.column(text).to_pylist(), batch.column("__places").to_pylist()):
                gone = set(cut or ())
                texts.append(t if t is None or not gone else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone))
                places.append(cut or [])
            return [texts, places]

        return run

    done = add_columns(kept, without, f"`__new` string, `{removed}` array<int>")
    return done.select(*[F.col("__new").alias(text) if c == text else F.col(c) for c in columns], removed)
