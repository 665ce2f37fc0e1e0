"""Spelling variants: words that differ by one inserted, deleted or replaced code point, by dense prefix-suffix tiling.

Two words are near if and only if their common prefix and common suffix together reach the longer length minus one.  Words
are dealt to *tiles* in which padded code-point matrices are compared all against all.  A tile `(l, lo, hi)` seeks pairs whose
longer word has `l` code points and whose common prefix has at least `lo` and fewer than `hi`: all its words share a prefix of
`lo` and a suffix of `l - hi` code points.  Each word begins in the tiles of its own length and of the next; a tile of more
than `TILE` words is halved at the middle of `lo` and `hi`, which gives its two halves a longer common prefix or suffix.  A
pair lies in exactly one half, so it is found once, and no pair is lost.  A tile that cannot be halved has one free code
point and at most as many words as there are letters, so every tile is small, whatever the words are.

Counts of words are combined map-side.  A word's form is its near word of greatest count, if that is `RATIO` times its own;
counts grow along forms, so chains have at most log2 of the greatest count steps, and roots are found by doubling.

Null and empty texts hold no words; rows without an id count as having the empty id.  Repeated rows count as often as they
stand there.  Words of any length are taken whole.  Ties between forms go to the smaller word in code-point order.  Without
words the result is empty.  Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower
from millrace.session import cut_lineage

LETTERS = r"[A-Za-zÀ-ÿ]+"
TILE = 256  # words of a tile that is still halved if it has more
CELLS = 1 << 22  # code points compared at once
MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2


def runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(`key`, `run`): each maximal run of letters of each text, A-Z in lower case."""
    found = F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))
    return docs.select(key, F.explode(found).alias("run")).select(key, ascii_lower(F.col("run")).alias("run"))


def slips(spelled: DataFrame, every: int, key: str = "doc_id") -> DataFrame:
    """`run` with one code point left out where `every` divides the checksum of `<key>:<run>`; the column becomes `word`."""
    check = F.crc32(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = F.pmod("check", F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return spelled.withColumn("check", check).select(F.when(F.col("check") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(`word`, `n`) of the words that are long and frequent enough."""
    counted = words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


def _tile() -> list:
    """The key of a tile: its numbers, and the prefix and suffix that its words share."""
    word, length = F.col("word"), F.char_length("word")
    return [F.col("l"), F.col("lo"), F.col("hi"), F.substring(word, F.lit(1), F.col("lo")).alias("prefix"),
            F.substring(word, length - (F.col("l") - F.col("hi")) + 1, F.col("l") - F.col("hi")).alias("suffix")]


KEY = ["l", "lo", "hi", "prefix", "suffix"]


def tiles(words: DataFrame, size: int = TILE) -> DataFrame:
    """(key of the tile, `words`: an array of (word, n)) of all tiles that may hold a near pair."""
    length = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("l")).withColumns({"lo": F.lit(0), "hi": F.col("l")})
    done = []
    while True:
        rows = cut_lineage(rows.select("word", "n", *_tile()))
        sizes = rows.groupBy(*KEY).agg(F.count("*").alias("size"), F.max(F.char_length("word") == F.col("l")).alias("full"))
        sizes = cut_lineage(sizes.where("size > 1 AND full"))
        large = (F.col("size") > size) & (F.col("hi") - F.col("lo") > 1)
        joined = rows.join(sizes.withColumn("large", large).select(*KEY, "large"), KEY)
        done.append(joined.where("NOT large").groupBy(*KEY).agg(F.collect_list(F.struct("word", "n")).alias("words")))
        if sizes.where(large).isEmpty():
            break
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = F.explode(F.array(F.struct(middle.alias("lo"), "hi"), F.struct("lo", middle.alias("hi"))))
        rows = joined.where("large").select("word", "n", "l", halves.alias("half")).select("word", "n", "l", "half.*")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _matrix(words: list[list[str]], width: int, right: bool) -> np.ndarray:
    """Code points of each tile's words, padded to `width` on one side; unequal padding never matches."""
    high = max(map(len, words))
    out = np.zeros((len(words), high, width), dtype=np.int32)
    for t, tile in enumerate(words):
        for w, word in enumerate(tile):
            points = np.frombuffer(word.encode("utf-32-le"), dtype="<i4")
            out[t, w, width - len(points) if right else 0:][: len(points)] = points if not right else points
    return out


def compare(group: list[tuple[int, int, int, list[str]]]) -> list[np.ndarray]:
    """For each tile (l, lo, hi, words) the square matrix that tells which words are near.

    The tiles of a group are padded to one height and width and compared block against block.
    """
    width = max(l for l, _, _, _ in group)
    words = [tile for _, _, _, tile in group]
    left, right = _matrix(words, width, False), _matrix(words, width, True)
    lengths = np.zeros(left.shape[:2], dtype=np.int32)
    for t, tile in enumerate(words):
        lengths[t, : len(tile)] = [len(w) for w in tile]
    longer, lo, hi = (np.array([g[k] for g in group])[:, None, None] for k in range(3))
    step = max(1, CELLS // (left.shape[0] * left.shape[1] * width))
    near = np.zeros((len(group), left.shape[1], left.shape[1]), dtype=bool)
    for start in range(0, left.shape[1], step):
        block = slice(start, start + step)
        a, b = lengths[:, block, None], lengths[:, None, :]
        shorter = np.minimum(a, b)
        prefix = _run(left[:, block, None, :] == left[:, None, :, :])
        suffix = _run((right[:, block, None, :] == right[:, None, :, :])[..., ::-1])
        prefix, suffix = np.minimum(prefix, shorter), np.minimum(suffix, shorter)
        fits = (np.maximum(a, b) == longer) & (shorter >= longer - 1) & (prefix >= lo) & (prefix < hi)
        near[:, block] = fits & (prefix < np.maximum(a, b)) & (prefix + suffix >= longer - 1)
    return [near[t, : len(tile), : len(tile)] for t, tile in enumerate(words)]


def _run(equal: np.ndarray) -> np.ndarray:
    """Length of the run of true values at the start of the last axis."""
    first = np.argmin(equal, axis=-1)
    return np.where(equal.all(axis=-1), equal.shape[-1], first)


def _judge(batches):
    """Tiles -> (word, n_near, best_n, best): what each tile knows of each of its words that has a near one."""
    for batch in batches:
        rows = sorted(zip(*(batch.column(c).to_pylist() for c in ("l", "lo", "hi", "words"))), key=lambda r: (len(r[3]), r[0]))
        out, at = [[], [], [], []], 0
        while at < len(rows):
            end = at + 1
            while end < len(rows) and len(rows[end][3]) <= 1 + len(rows[at][3]) * 5 // 4 and \
                    (end - at + 1) * len(rows[end][3]) ** 2 * max(r[0] for r in (rows[at], rows[end])) <= CELLS:
                end += 1
            part = rows[at:end]
            group = [(l, lo, hi, [w["word"] for w in words]) for l, lo, hi, words in part]
            for (_, _, _, words), near in zip(part, compare(group)):
                for i in np.flatnonzero(near.any(axis=1)).tolist():
                    others = [(-words[j]["n"], words[j]["word"]) for j in np.flatnonzero(near[i]).tolist()]
                    best = min(others)
                    for column, value in zip(out, (words[i]["word"], len(others), -best[0], best[1])):
                        column.append(value)
            at = end
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                                          pa.array(out[3], pa.string())], ["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, size: int = TILE) -> DataFrame:
    """(`word`, `n_near`, `best_n`, `best`): number of near words, and the one of greatest count (ties: the smaller)."""
    judged = tiles(words, size).select("l", "lo", "hi", "words").mapInArrow(_judge, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    return judged.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first")).select(
        "word", "n_near", (-F.col("first.minus")).alias("best_n"), F.col("first.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(`word`, `root`) of every word with a form (columns `word`, `form`): the last of its chain, by doubling."""
    chains = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = chains.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = cut_lineage(chains.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                       F.col("next").isNotNull().alias("moved")))
        if stepped.where("moved").isEmpty():
            return stepped.select("word", "root")
        chains = stepped.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, size: int = TILE) -> DataFrame:
    """`words` (`word`, `n`) with `form`, `root`, `n_near` and `form_n`."""
    words = cut_lineage(words.select("word", "n"))
    near = words.join(near_words(words, size), "word", "left").withColumn("has", F.col("best_n") >= ratio * F.col("n"))
    near = cut_lineage(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                   F.when(F.col("has"), F.col("best")).alias("form"),
                                   F.when(F.col("has"), F.col("best_n")).alias("form_n")))
    last = roots(near.where("form IS NOT NULL"))
    return near.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
