"""Packing of tokenised documents into windows by Karmarkar-Karp multiway differencing.

Each task tokenises its documents and packs them as it goes; nothing is shuffled.  A document's whole windows stand
alone.  Its rest is cut into grains, and a block of grains is dealt to near-equal windows: the two partial
partitions with the greatest imbalance are merged, largest window on smallest, until one is left.  If a window
exceeds the capacity, the block is dealt anew to one window more.

Null and empty texts hold the end id alone.  Each row is a document of its own, so repeated rows and repeated or null
ids are packed as often as they come.  Very long texts are bounded by their own ids only.  Only the id and the text
column are read, so further columns cannot clash.  An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.vocabulary import public_path, read_ranks

WINDOW = 1024
GRAIN = 192
BLOCK_WINDOWS = 256
SLACK = 512  # of a full block's ids are left out, so that near-equal windows stay under the capacity
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Deals items to `k` sets of near-equal sums; gives the items of each set."""
    n = len(sizes)
    left, right, last = [0] * (n + 1), [0] * (n + 1), n  # nodes: 0 nothing, 1..n items, then pairs of nodes
    heap = []
    for item, size in enumerate(sizes, 1):
        sums, nodes = np.zeros(k, np.int64), np.zeros(k, np.int64)
        sums[0], nodes[0] = size, item
        heap.append((-size, item, sums, nodes))
    heapq.heapify(heap)
    order = n
    while len(heap) > 1:
        _, _, a, an = heapq.heappop(heap)
        _, _, b, bn = heap[0]
        b, bn = b[::-1], bn[::-1]
        sums, nodes = a + b, np.where(an > 0, an, bn)
        both = np.flatnonzero((an > 0) & (bn > 0))
        if len(both):
            left += an[both].tolist()
            right += bn[both].tolist()
            nodes[both] = np.arange(last + 1, last + 1 + len(both))
            last += len(both)
        falling = np.argsort(-sums, kind="stable")
        sums, nodes, order = sums[falling], nodes[falling], order + 1
        heapq.heapreplace(heap, (int(sums[-1] - sums[0]), order, sums, nodes))
    sets = []
    for node in heap[0][3].tolist() if heap else []:
        found, stack = [], [node] if node else []
        while stack:
            node = stack.pop()
            if node <= n:
                found.append(node - 1)
            else:
                stack += left[node], right[node]
        sets.append(found)
    return sets


def deal(sizes: list[int], window: int) -> list[list[int]]:
    """Near-equal sets of at most `window` each, in as few as differencing finds."""
    if not sizes:
        return []
    k = -(-sum(sizes) // window)
    while True:
        sets = difference(sizes, k)
        if max(sum(sizes[i] for i in s) for s in sets) <= window:
            return [s for s in sets if s]
        k += 1


@lru_cache(maxsize=4)
def text_tokenizer(tokenizer: str, ranks: str, pattern: str):
    """`str -> little-endian ids`, equal to those of the tokenizer file.

    The rank file holds the same vocabulary and is faster; texts with a special token's string take the tokenizer.
    """
    import tiktoken
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer)
    special = [t.content for t in own.get_added_tokens_decoder().values()]
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(ranks), special_tokens={})

    def run(text: str) -> bytes:
        if any(s in text for s in special):
            return array("I", own.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", fast.encode_ordinary(text)).tobytes()

    return run


class Packer:
    """Takes documents one by one; gives rows (document, start, ids, document's ids, sequence, offset)."""

    def __init__(self, first: int, window: int, grain: int, block: int, slack: int):
        self.sequence, self.window, self.grain = first, window, grain
        self.full = block * window - min(slack, block)
        self.waiting: list[tuple] = []
        self.held = 0

    def add(self, doc, ids: bytes):
        n, at = len(ids) // 4, 0
        while n - at >= self.window:
            yield doc, at, ids[4 * at:4 * (at + self.window)], n, self._next(), 0
            at += self.window
        while at < n:
            size = min(self.grain, n - at, self.full - self.held)
            self.waiting.append((doc, at, ids[4 * at:4 * (at + size)], n))
            self.held, at = self.held + size, at + size
            if self.held == self.full:
                yield from self.close()

    def close(self):
        for members in deal([len(w[2]) // 4 for w in self.waiting], self.window):
            sequence, offset = self._next(), 0
            for i in sorted(members):
                yield *self.waiting[i], sequence, offset
                offset += len(self.waiting[i][2]) // 4
        self.waiting, self.held = [], 0

    def _next(self) -> int:
        self.sequence += 1
        return self.sequence - 1


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = 0,
         tokenizer: str | None = None, ranks: str | None = None, pattern: str | None = None, grain: int = GRAIN,
         block_windows: int = BLOCK_WINDOWS, slack: int = SLACK, with_ids: bool = True) -> DataFrame:
    """One row per piece: `doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset`.

    `ids` are little-endian unsigned 32-bit integers (null unless `with_ids`); every document ends with `end_id`.
    Sequences hold at most `window` ids; their numbers come from the task's number and are unique.
    """
    end = array("I", [end_id]).tobytes()
    names = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        import public_tokenizers

        encode = text_tokenizer(tokenizer or public_path(TOKENIZER), ranks or public_path(RANKS),
                                pattern or public_tokenizers.PATTERN)
        packer = Packer(TaskContext.get().partitionId() << 33, window, grain, block_windows, slack)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

        def batch_of(rows):
            doc, start, ids, total, sequence, offset = zip(*rows)
            columns = [doc, start, [len(i) // 4 for i in ids], ids if with_ids else [None] * len(ids),
                       [zlib.crc32(i) for i in ids], total, sequence, offset]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        out = []
        for batch in batches:
            for doc, t in zip(batch.column(0), batch.column(1)):
                out += packer.add(doc.as_py(), encode(t.as_py() or "") + end)
                if len(out) >= 5_000:
                    yield batch_of(out)
                    out = []
        out += packer.close()
        if out:
            yield batch_of(out)

    schema = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
