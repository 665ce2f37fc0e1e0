"""The conversation trie against brute force: many partitions, segments, turnless, absent and odd rows."""

import hashlib
import random
import zlib

import pytest

from millrace.llm import conversation_trie as trie


def by_hand(rows, family=100, most=6):
    said = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            said.setdefault(conv, []).append(((turn is not None, turn or 0, digest), (role or "", text or "")))
    turns = {c: [t for _, t in sorted(v)] for c, v in said.items()}
    built = {c: tuple(turns.get(c - c % family, [])[:h] + t[h:]) for c, t in turns.items() for h in [zlib.crc32(str(c).encode()) % most]}
    members, children, below = {}, {}, {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = set()
    for node in sorted(members, key=len, reverse=True):
        own = children.get(node, [])
        leaves = sum(below[k][0] for k in own) or 1
        saved = sum(below[k][1] for k in own) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        below[node] = leaves, saved
        ends = ",".join(map(str, sorted(c for c in members[node] if built[c] == node)))
        out.add((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(own), leaves, saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    assert len(out) == len(members)
    return out


@pytest.fixture(scope="module")
def rows():
    rng, rows = random.Random(1), []
    for c in range(150):
        rows += [(c, rng.choice([None, t, t]), rng.choice(["u", None, "a"]), rng.choice(["x", "yy", "", None])) for t in range(rng.choice([0, 1, 2, 3, 5, 9]))]
    for c in range(300, 330):  # long shared beginnings
        rows += [(c, t, "u", "same" if t < 10 or rng.random() < 0.7 else "q") for t in range(rng.choice([11, 12, 12, 14]))]
    rows += [(c, t, "u", f"copy {t}") for c in range(400, 450) for t in range(3)]  # a group of copies
    rows += [(307, 3, "u", "same"), (None, 1, "u", "no id"), (5001, 1, "u", "😀é" * 9), (901, 0, None, None)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def result(spark, rows, width, schema=SCHEMA):
    turns = trie.turns_of(spark.createDataFrame(rows, schema))
    return {tuple(r) for r in trie.prefix_trie(*trie.with_shared_heads(turns, 100, 6), width=width).collect()}


@pytest.mark.parametrize("width, partitions", [(128, 1), (128, 6), (3, 4), (1, 3)])
def test_trie_equals_brute_force(spark, rows, width, partitions):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        some = rows if width > 1 else [r for r in rows if r[0] is None or r[0] < 40 or r[0] > 300]
        assert result(spark, some, width) == by_hand(some)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_forest_of_one_partition_closes_what_no_boundary_touches():
    digest = lambda s: "".join(hashlib.md5(c.encode()).hexdigest() for c in s)
    texts = sorted(["a", "abc", "abd", "abd", "b", "bb", "c"], key=digest)
    rows = [(trie.ROOT, digest(t), i, [1] * len(t), True, "", None) for i, t in enumerate(texts)]
    nodes = trie.forest(rows)
    paths = {t[:d] for t in texts for d in range(1, len(t) + 1)}
    edge = {t[:d] for t in (texts[0], texts[-1]) for d in range(len(t) + 1)}
    kinds = [n[0] for n in nodes]
    assert kinds.count("open") == len(edge) and kinds.count("closed") == len(paths - edge)
    assert trie.forest([]) == []


def test_odd_tables(spark):
    assert result(spark, [], 128) == set()
    assert result(spark, [(None, 1, "u", "x")], 128) == set()
    one = [(7, None, None, None, "clash", 3)]
    got = result(spark, one, 128, SCHEMA + ", depth string, conv int")
    assert got == by_hand([r[:4] for r in one])
