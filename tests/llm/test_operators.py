"""Each operator against brute force on small rows: nulls, empty and long texts, ties, repeats, clashing columns."""

import base64
import decimal
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import (bpe, fingerprints, language, licenses, line_dedup, near_dedup, neighbours, packing, substring_dedup,
                          url_filters)
from millrace.llm.components import components

LONG = "word " * 30_000
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "Erinst resh."), (4, "Erinst resh."), (None, "no id here at all"), (5, LONG),
       (6, "中文字 ß İ 😀  double  spaces \n \n end \n"), (7, "x"), (8, "<|endoftext|> in a text")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "clash", 1) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, removed int")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def prose(rng, n, letters="aeinrst"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


# --- byte-level BPE

def reference_bpe():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_reference_and_decodes(odd, none):
    known = reference_bpe()
    done = bpe.decode(bpe.encode(odd)).collect()
    assert len(done) == len(ODD)
    for row in done:
        assert np.frombuffer(bytes(row["ids"]), "<u4").tolist() == known.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]).decode() == (row["text"] or "")
    assert bpe.decode(bpe.encode(none)).count() == 0


def test_bpe_on_random_white_space_and_scripts():
    known, rng = reference_bpe(), random.Random(1)
    encode = bpe.text_encoder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    parts = [" ", "  ", "\n", "\t", "　", "a", "The", "é", "12", "'s", "!", "中文", "😀", "\x1c", "\x85", "​", "\r\n", "́"]
    for _ in range(3_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(encode(text), "<u4").tolist() == known.encode_ordinary(text), repr(text)


# --- packing

def test_packing_keeps_each_id_once(odd, none):
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = packing.pack(odd.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        assert r["length"] * 4 == len(r["ids"]) and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
    for doc, text in {i: t for i, t in ODD if i is not None}.items():
        want = own.encode(text or "", add_special_tokens=False).ids + [0]
        pieces = sorted(by_doc[doc], key=lambda r: r["start"])
        assert [i for r in pieces for i in np.frombuffer(bytes(r["ids"]), "<u4").tolist()] == want
        assert all(r["doc_tokens"] == len(want) for r in pieces)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    assert packing.pack(none).count() == 0
    assert packing.pack(odd).groupBy("doc_id").count().where("doc_id is null").count() == 1


def test_differencing_is_near_equal_and_raises_the_count():
    rng = random.Random(2)
    for n, window in ((1, 10), (40, 100), (700, 1024)):
        sizes = [rng.randint(1, window // 5 or 1) for _ in range(n)]
        sets = packing.deal(sizes, window)
        assert sorted(i for s in sets for i in s) == list(range(n))
        sums = [sum(sizes[i] for i in s) for s in sets]
        assert max(sums) <= window and len(sets) <= -(-sum(sizes) // window) + 2
        if n == 700:
            assert max(sums) - min(sums) <= 20
    assert len(packing.deal([60, 60, 60], 100)) == 3  # two windows would hold them by sum alone
    assert packing.deal([], 10) == []


# --- fingerprints

def test_fingerprints_of_texts_and_edits(odd, spark):
    rows = fingerprints.fingerprint_edits(odd).collect()
    order = sorted(((-(2**63) if i is None else i, t or "", i) for i, t in ODD), key=lambda x: -x[0])
    assert len(rows) == len(order)
    edits = set()
    for k, (_, text, doc) in enumerate(order):
        other, half = order[(k + 1) % len(order)][1], len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        edits.add((doc, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert {(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows} == edits
    assert len({r["fingerprint"] for r in rows if r["doc_id"] == 4}) == 1
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)


def test_fingerprints_feel_order_and_edits(spark):
    rng = random.Random(3)
    words = prose(rng, 400).split()
    shuffled = words[:]
    rng.shuffle(shuffled)
    swapped = words[200:] + words[:200]
    few = words[:]
    few[17] = "zzz"
    texts = [" ".join(w) for w in (words, few, swapped, shuffled)] + [prose(rng, 400, "bdgkmpu")]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", fingerprints.order_minhash(F.col("t")).alias("f"))
    base = rows.where("i = 0").select(F.col("f").alias("g"))
    near = {r["i"]: r["n"] for r in rows.join(base).select("i", fingerprints.likeness(F.col("f"), F.col("g")).alias("n")).collect()}
    assert near[0] == 1.0 and near[1] > 0.9 and 0.2 < near[2] < 0.8 and near[3] < 0.2 and near[4] < 0.05


def test_next_rows_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_A_BUCKET", 7)
    docs = spark.range(0, 300, 3).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(docs, "doc_id", ["text"]).collect()}
    assert got == {i: str(i - 3 if i else 297) for i in range(0, 300, 3)}
    assert fingerprints.with_next(docs.where("doc_id < 0"), "doc_id", ["text"]).count() == 0


# --- near-duplicates

def brute_components(docs):
    sets = {}
    for i, text in docs:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}
    find = lambda i: i if root[i] == i else find(root[i])
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_near_duplicates_equal_brute_force(spark, odd, none):
    rng = random.Random(4)
    docs = [(i, t) for i, t in dict((i, t) for i, t in ODD if i is not None).items()]
    base = prose(rng, 150).split()
    for i in range(10, 90):  # a group of near copies, each with some edits, about the threshold
        own = base[:]
        for _ in range(rng.randint(0, 9)):
            own[rng.randrange(len(own))] = "e" + str(rng.random())
        docs.append((i, " ".join(own)))
    docs += [(i, prose(rng, 60)) for i in range(100, 120)] + [(130, " ".join(base).upper()), (131, "ONE two"), (132, "one TWO")]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("node", F.lit("clash"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.linked(table).collect()}
    assert got == brute_components(docs)
    assert near_dedup.linked(none).count() == 0
    rows = near_dedup.linked(odd).collect()
    assert len(rows) == len(ODD) and all(r["kept"] for r in rows)


def test_components_of_chains_and_cycles(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


# --- line and substring dedup

def test_patience_aligns():
    a, b = [1, 2, 3, 4, 5, 6], [9, 2, 3, 8, 5, 6, 1]
    assert line_dedup.patience(a, b) == [(1, 1), (2, 2), (4, 4), (5, 5)]
    assert line_dedup.patience([], [1]) == [] and line_dedup.patience([1, 1], [1, 1]) == [(0, 0), (1, 1)]


def test_common_lines_leave_the_later_document(spark, odd, none):
    block = "the first common line of the block\nand the second common line of it"
    docs = [(1, f"own line of one here\n{block}\nend"), (2, f"start\n{block}\nown line of two here"), (3, "end\nstart"), (4, None),
            (5, f"{block}\nlast words"), (6, "all rights reserved"), (7, "all rights reserved"), (None, block)]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("removed_lines", F.lit(0))
    got = {r["doc_id"]: (r["text"], r["removed_lines"]) for r in line_dedup.remove_common_lines(table).collect()}
    assert got == {1: (docs[0][1], []), 2: ("start\nown line of two here", [1, 2]), 3: ("end\nstart", []), 4: (None, []),
                   5: ("last words", [0, 1]), 6: (docs[5][1], []), 7: (docs[6][1], []), None: ("", [0, 1])}
    assert line_dedup.remove_common_lines(none).count() == 0
    assert sorted(str(r["text"]) for r in line_dedup.remove_common_lines(odd).collect()) == sorted(str(t) for _, t in ODD)


def test_second_copies_and_crossing_blocks_go():
    s, u, p, q, r = range(5)
    assert line_dedup.common_blocks([s, u], [p, s, q, s, r], [9] * 5, 8) == [1, 3]
    assert line_dedup.common_blocks([s, u, p], [p, u, q, s], [9] * 4, 8) == [0, 1, 3]
    assert line_dedup.common_blocks([s, u, p], [u, s, p], [4, 8, 4], 8) == [0, 1, 2]  # what is left is neighbouring
    rng = random.Random(8)
    for _ in range(500):  # no alignment: each run of both, by trying all
        size = [rng.randint(0, 9) for _ in range(6)]
        a, b = ([rng.randrange(6) for _ in range(rng.randint(0, 9))] for _ in "ab")
        left = b
        while runs := [(x, y) for x in range(len(left)) for y in range(x + 1, len(left) + 1) if sum(size[z] for z in left[x:y]) >= 8
                       and any(a[i:i + y - x] == left[x:y] for i in range(len(a)))]:
            left = [z for i, z in enumerate(left) if not any(x <= i < y for x, y in runs)]
        gone = line_dedup.common_blocks(a, b, [size[z] for z in b], 8)
        kept = [z for i, z in enumerate(b) if i not in gone]
        assert [z for z in kept if size[z]] == [z for z in left if size[z]]


def test_blocks_are_met_whatever_the_first_holders_of_their_lines(spark):
    one, two = "five words of line one", "five words of line two"
    docs = [(0, f"{one}\nalpha"), (1, f"{two}\nbeta"), *[(i, f"own{i}\n{one}\n{two}\nlast{i}") for i in range(3, 20)]]
    verse = "\n".join(f"verse {i}" for i in range(20))
    docs += [(30, f"{verse}\nthirty"), (31, f"thirty one\n{verse}")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.remove_common_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(got[i] == t for i, t in docs if i in (0, 1, 3, 30)) and got[31] == "thirty one"
    assert all(got[i] == f"own{i}\nlast{i}" for i in range(4, 20))


def test_repeated_passages_are_cut_with_offsets(spark, odd, none):
    rng = random.Random(5)
    passage = ". ".join(prose(rng, 9) for _ in range(7)) + "."
    docs = [(1, f"{prose(rng, 12)}.\n{passage}\n{prose(rng, 12)}."), (2, f"{prose(rng, 5)}. {passage} {prose(rng, 6)}."),
            (3, prose(rng, 50) + "."), (4, None), (5, "Short one. Short one. Short one."), (None, passage)]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("removed", F.lit("clash"))
    got = {r["doc_id"]: r for r in substring_dedup.remove_repeats(table).collect()}
    assert got[1]["text"] == docs[0][1] and got[3]["text"] == docs[2][1] and got[4]["text"] is None and got[5]["text"] == docs[4][1]
    assert passage not in got[2]["text"] and got[None]["text"] == ""
    for i, text in docs:
        if text is not None:
            cut = "".join(text[s["start"]:s["end"]] for s in got[i]["removed"])
            assert len(cut) + len(got[i]["text"]) == len(text)
    assert substring_dedup.remove_repeats(none).count() == 0
    kept = substring_dedup.remove_repeats(odd).collect()
    assert {(r["doc_id"], r["text"]) for r in kept} == set(ODD)


def test_every_repeat_goes(spark):
    docs = [(1, "Sign up for news.\nFirst own words here. A shared one stands inside.\nbye"),
            (2, "Some new words stand.\nSign up for news.\nOther words follow now. A shared one stands inside. The last new words.")]
    got = dict(substring_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", "text").collect())
    assert got == {1: docs[0][1], 2: "Some new words stand.\nOther words follow now. The last new words."}


def test_texts_without_spaces_and_short_lines(spark):
    chinese, other = "这一行文字在两个文档中都出现并且相当长", "后面的文档里还有别的一些内容"
    sentences = "第一个共同的句子在这里。第二个共同的句子也在这里！"
    names = "\n".join(f"name{i}" for i in range(60))
    docs = [(1, f"{chinese}\n开头"), (2, f"{other}\n{chinese}"), (3, f"{sentences}只有这里的句子。"), (4, f"不同的一个开头在此。{sentences}"),
            (5, f"five\n{names}"), (6, f"{names}\nsix six")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = dict(line_dedup.remove_common_lines(table).select("doc_id", "text").collect())
    assert got == dict(docs) | {2: other, 6: "six six"}
    got = dict(substring_dedup.remove_repeats(table).select("doc_id", "text").collect())
    assert got == dict(docs) | {2: f"{other}\n", 4: "不同的一个开头在此。", 6: "six six"}


def test_own_repeats_keep_the_first_copy():
    text = "la\nla\nla\nla\nla\nla\n"
    assert substring_dedup.repeats_removed(text, set(), 3)[0] == "la\nla\nla\n"
    line = "1. Buy milk and bread\n"
    assert substring_dedup.repeats_removed(line + "then\n" + line, set(), 3)[0] == line + "then\n"


def test_units_cover_the_text():
    rng = random.Random(6)
    for _ in range(300):
        text = "".join(rng.choice("ab .!?\n\t") for _ in range(rng.randint(0, 40)))
        assert "".join(text[s:e] for s, e, _ in substring_dedup.units_of(text)) == text


# --- url filters

def test_url_rules(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("b.com", "/x", "block"), (None, "/", "block")]
    urls = ["http://Example.com/en/1?q", "https://a.example.com/en/", "http://example.com", "http://xexample.com/en/1", "ftp://b.com/xyz",
            "http://b.com/y#://c", "no scheme", None, "", "http://b.com:80/x", "http://a.b.com/x/en/", "http://b.com/x", "http://b.com/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").withColumn("rule", F.lit("clash"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"])
           for r in url_filters.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    for i, url in enumerate(urls):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1].split("?")[0].split("#")[0]
            host, slash, tail = rest.partition("/")
            host, path = host.lower(), slash + tail
        fits = [(len(h + p), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        assert got[i] == (host, path, best[1], best[2]), url
    empty = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r["verdict"] for r in url_filters.judge_urls(pages, empty).collect()} == {"allow"}


# --- language

def test_languages_learn_and_mark_the_undetermined(spark, odd, none):
    rng = random.Random(8)
    rows = [(i, prose(rng, 40, "aeiost"), "xx") if i % 2 else (i, prose(rng, 40, "uorkng"), "yy") for i in range(60)]
    docs = spark.createDataFrame(rows + [(99, None, "xx"), (98, "...", None)], "doc_id long, text string, lang string")
    model = language.fit(docs, F.col("doc_id") < 30)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.detect(docs, model).collect()}
    assert all(got[i][0] == lang and got[i][1] > 0.9 for i, _, lang in rows)
    assert got[99] == ("und", 0.0) and got[98] == ("und", 0.0)
    assert {r["lang_pred"] for r in language.detect(odd, language.fit(none)).collect()} == {"und"}


def test_forward_sums_all_segmentations():
    pieces = language.Pieces(["a", "b", "ab", "▁", "▁a"])
    p = [0.3, 0.2, 0.1, 0.25, 0.15, 1e-9]
    word = "▁ab"
    ways = [("▁", "a", "b"), ("▁", "ab"), ("▁a", "b")]
    want = sum(np.prod([p[pieces.index[x]] for x in way]) for way in ways)
    edges = pieces.edges(word)
    assert np.exp(language.log_likelihoods([word, "z", "▁"], pieces, np.array([p]).T))[0, 0] == pytest.approx(want)
    counts = language.expected_counts(["z", word], np.array([1.0, 2.0]), pieces, np.array(p))
    assert counts[pieces.index["ab"]] == pytest.approx(2 * p[3] * p[2] / want) and counts[pieces.stray] == pytest.approx(1)
    assert edges == [(0, 1, 3), (0, 2, 4), (1, 2, 0), (1, 3, 2), (2, 3, 1)]
    assert pieces.edges("z") == [(0, 1, pieces.stray)]


def whole_text_model(text, pieces, p):
    """Log-likelihood of a text in exact decimals, by the recursion over its letters, without cuts or scales."""
    total = decimal.Decimal(0)
    with decimal.localcontext(prec=60, Emin=-999_999, Emax=999_999):
        for word in language.words_of(text):
            a = [decimal.Decimal(1)]
            for j in range(1, len(word) + 1):
                last = word[j - 1]
                a.append(sum((a[i] * decimal.Decimal(p[pieces.index[word[i:j]]]) for i in range(j) if word[i:j] in pieces.index), decimal.Decimal(0))
                         + (0 if last in pieces.letters else a[j - 1] * decimal.Decimal(p[pieces.stray])))
            total += a[-1].ln()
    return float(total)


def test_texts_and_long_runs_equal_a_whole_text_model():
    rng = random.Random(4)
    pieces = language.Pieces(["a", "b", "c", "ab", "abc", "▁", "▁a", "ca", "é"])
    p = np.random.RandomState(2).dirichlet(np.ones(len(pieces.index) + 1), 3)
    p[:, -1] = 1e-9
    model = language.Model(["x", "y", "z"], p)
    model.__class__ = type("Own", (language.Model,), {"pieces": pieces})
    texts = ["abc ca 12 x. Ab", "", "a" * 200, "".join(rng.choice("abcé中") for _ in range(700)), " ".join("".join(rng.choice("abcz") for _ in range(9)) for _ in range(300))]
    scorer = language.Scorer(model, limit=50)
    for got, text in zip(scorer.sums(texts), texts):
        assert got[:3] == pytest.approx([whole_text_model(text, pieces, row) for row in p], rel=1e-9)
        assert got[3] == sum(len(w) - 1 for w in language.words_of(text))
    counts = language.expected_counts(["▁" + "ab" * 150, "▁ca"], np.array([1.0, 3.0]), pieces, p[0])
    assert counts[pieces.index["▁"]] + counts[pieces.index["▁a"]] == pytest.approx(4)
    assert sum(counts * [len(x) for x in [*pieces.index, "z"]]) == pytest.approx(301 + 9)


def test_documents_without_an_id_are_drawn_by_their_text(spark):
    rng = random.Random(6)
    rows = [(None, prose(rng, 4, "aeiost"), "xx") for _ in range(400)] + [(i, prose(rng, 40, "uorkng"), "yy") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, sample=60)
    found = language.detect(docs.withColumns({"lang_pred": F.lit(1), "score": F.lit("clash")}), model)
    assert found.where("lang_pred = lang").count() > 440 and found.columns.count("score") == 1


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs, F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1)
    held = language.detect(docs.where("pmod(crc32(cast(doc_id as string)), 3) = 1"), model)
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


# --- licences

def test_licences(spark, odd, none):
    lines = [(1, "intro\nReleased under the MIT License.\nbye"), (2, "Drivers must carry a valid licence and proof of insurance."),
             (3, "Licensed under CC BY-NC 4.0."), (4, None), (4, "Licensed under the Apache License, Version 2.0."), (5, "plain prose")]
    table = spark.createDataFrame(lines, "doc_id long, text string").withColumn("family", F.lit("clash"))
    got = {(r["doc_id"], r["place"], r["family"], r["confirmed"]) for r in licenses.scan(table).collect()}
    assert got == {(1, 1, "mit", True), (2, 0, "unknown", False), (3, 0, "cc-by-nc", True), (4, 0, "apache", True)}
    assert licenses.scan(none).count() == 0 and licenses.scan(odd).count() == 0


def test_licence_classes_on_held_out_variants():
    model, rng = licenses.fit(), random.Random(99)
    at, right, total = {g: i for i, g in enumerate(model.grams)}, 0, 0
    weights = np.vstack([model.weights, model.share, model.bias])
    for label, own in enumerate([*licenses.NOTICES.values(), licenses.UNRELATED]):
        made = [v for t in own for v in licenses._variants(rng, t, 6)]
        right += (np.argmax(licenses._rows(made, at) @ weights, axis=1) == label).sum()
        total += len(made)
    assert right / total > 0.95


# --- nearest neighbours

def test_nearest_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK", 64)
    rng = np.random.RandomState(9)
    centres = rng.standard_normal((10, 16))
    vectors = {i: (centres[i % 10] + 0.4 * rng.standard_normal(16)).astype("float32").tolist() for i in range(600)}
    for i in range(300, 360):  # one vector many times
        vectors[i] = vectors[300]
    odd = {1000: None, 1020: [], 1040: [0.0] * 16, 1060: [float("nan")] * 16, 1080: [None] * 16, 1100: [1.0] * 3}
    table = spark.createDataFrame([*vectors.items(), *odd.items()], "vec_id long, embedding array<float>")
    rows = neighbours.nearest(table.repartition(3), F.col("id") % 20 == 0).collect()
    ids, matrix = np.array(list(vectors)), np.array(list(vectors.values()), float)
    hits = total = 0
    for q in range(0, 600, 20):
        scores = matrix @ matrix[q]
        order = [i for i in np.lexsort((ids, -scores)) if i != q][:20]
        got = sorted((r for r in rows if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, 21))
        assert [(-r["score"], r["vec_id"]) for r in got] == sorted((-r["score"], r["vec_id"]) for r in got)
        assert all(r["score"] == pytest.approx(scores[r["vec_id"]], abs=1e-9) for r in got)
        hits, total = hits + len({r["vec_id"] for r in got} & set(order)), total + 20
    assert hits / total >= 0.95 and {r["query_id"] for r in rows} == set(range(0, 600, 20))
    few = spark.createDataFrame([(20, [1.0, 0.0]), (21, [1.0, 0.0]), (22, [0.5, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r)[:3] for r in neighbours.nearest(few, F.col("id") % 20 == 0).orderBy("rank").collect()] == [(20, 1, 21), (20, 2, 22)]
    assert neighbours.nearest(few.where("vec_id < 0"), F.col("id") % 20 == 0).count() == 0


def test_the_stopping_test_prunes_and_keeps_the_nearest():
    """Share of the vectors verified, and recall, of one tree over the given ones."""
    import duckdb

    own = np.array(duckdb.sql("SELECT embedding FROM '/root/testdata/sf0.1/embeddings.parquet'").fetchnumpy()["embedding"].tolist(), float)
    rng = np.random.RandomState(3)
    squared = np.einsum("ij,ij->i", own, own)
    longest = squared.max()
    directions = neighbours._directions(own.shape[1])
    tree = neighbours.Tree(np.column_stack([own, np.sqrt(np.maximum(longest - squared, 0))]) @ directions)
    own, ids = own[tree.order], np.arange(len(own))
    reach = neighbours.chi_square_quantile(neighbours.CONFIDENCE, neighbours.DIRECTIONS)
    hits = seen = 0
    for k in rng.choice(len(own), 60, replace=False):
        found, verified = neighbours.search(tree, own, ids, own[k], np.append(own[k], 0) @ directions, longest, 21, np.inf, reach)
        hits += len({row for _, row in found} & set(np.argsort(-(own @ own[k]))[:21].tolist()))
        seen += verified
    assert hits / (60 * 21) >= 0.93 and seen / (60 * len(own)) < 0.7  # 2,000 vectors; the share falls with their number


def test_no_queries_extra_columns_and_ids_with_several_vectors(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0], 5), (2, [0.0, 1.0], 5), (2, [1.0, 1.0], 5), (40, [1.0, 0.5], 6), (40, [0.9, 0.5], 6)],
                                  "vec_id long, embedding array<double>, rank int").withColumn("score", F.lit("clash"))
    assert neighbours.nearest(table.where("vec_id < 40"), F.col("id") % 20 == 0).count() == 0
    got = neighbours.nearest(table, F.col("id") % 20 == 0).collect()
    assert {r["query_id"] for r in got} == {40} and 40 not in {r["vec_id"] for r in got}


def test_chi_square_quantile():
    assert neighbours.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
