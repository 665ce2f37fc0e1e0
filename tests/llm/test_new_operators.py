"""Spelling variants and quality rules against brute force on small rows, with odd ones among them."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, fingerprints, quality_rules, spelling, url_filters

LONG = "word " * 30_000
ODD = [(1, None), (2, ""), (3, " \n\t\n"), (4, "Erinst resh."), (4, "Erinst resh."), (None, "no id here at all"), (5, LONG),
       (6, "中文字 ß İ 😀  double  spaces \n \n end \n"), (7, "x")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in ODD], "doc_id long, text string, word string, kept int")


# --- empty tables, very long urls, clashing names of earlier operators

def test_fingerprints_of_an_empty_table(odd):
    assert fingerprints.fingerprint_edits(odd.limit(0)).count() == 0


def test_urls_empty_and_very_long(spark):
    rules = spark.createDataFrame([("com", "/a", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://x.com/a" + "b/" * 50_000), (2, "http://" + "x." * 500 + "com/a")], "page_id long, url string")
    got = url_filters.judge_urls(pages.withColumn("verdict", F.lit("clash")), rules).collect()
    assert {(r["page_id"], r["rule"], r["verdict"], len(r["path"])) for r in got} == {(1, "com/a", "block", 100_002), (2, "com/a", "block", 2)}
    assert url_filters.judge_urls(pages.limit(0), rules).count() == 0


def test_bpe_columns_of_clashing_names_give_way(spark, odd):
    docs = odd.withColumns({"ids": F.lit("clash"), "decoded": F.lit(7)})
    done = bpe.decode(bpe.encode(docs))
    assert sorted(done.columns) == sorted(docs.columns)
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in done.collect())


# --- spelling variants

def near(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_by_hand(words):
    form, rows = {}, {}
    for w, n in words.items():
        others = sorted((-words[v], v) for v in words if near(w, v))
        form[w] = others[0][1] if others and -others[0][0] >= 2 * n else None
        rows[w] = len(others)
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], rows[w], words[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("size", [2, 256])
def test_variants_equal_brute_force(spark, size):
    rng, words = random.Random(3), {}
    while len(words) < 250:
        words["".join(rng.choice("abé") for _ in range(rng.randint(5, 8)))] = rng.randint(3, 60)
    words |= {"ab" * 60: 5, "ab" * 60 + "a": 50, "ab" * 61: 200, "aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaaaaaa": 24, "aaaaaaaaa": 48}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {tuple(r) for r in spelling.variants(df, size=size).collect()}
    assert got == variants_by_hand(words)


def test_one_free_letter_fills_a_tile_that_cannot_be_halved(spark):
    letters = [chr(c) for c in range(0xE0, 0xFF)] + [chr(c) for c in range(97, 123)]
    words = {f"stem{c}end": 3 + i for i, c in enumerate(letters)} | {"stemend": 500}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {tuple(r) for r in spelling.variants(df, size=4).collect()} == variants_by_hand(words)


def test_vocabulary_counts_runs_with_their_slips(spark, odd):
    rng = random.Random(5)
    rows = ODD + [(i, " ".join(rng.choice(["Straße", "Grüße", "ÀÉà", "plainly", "PLAINLY", "x1plainly"]) for _ in range(40))) for i in range(90)]
    rows[-1] = (None, rows[-1][1])
    counts = Counter()
    for key, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += chr(ord(c) + 32) if c <= "Z" else c
            elif run:
                h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
                counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
                run = ""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["word"]: r["n"] for r in spelling.vocabulary(spelling.slips(spelling.runs(docs), 97)).collect()}
    assert got == {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3} and len(got) > 5
    few = spelling.variants(spelling.vocabulary(spelling.slips(spelling.runs(odd), 97), 4, 1)).collect()
    assert {r["word"] for r in few} >= {"word", "erinst", "resh", "here", "spaces"}
    assert spelling.variants(spelling.vocabulary(spelling.slips(spelling.runs(odd.limit(0)), 97))).count() == 0


# --- quality rules

def base_by_hand(text):
    words, space = [], "\t\n\v\f\r "
    for c in (text or "") + " ":
        words = words + [""] if c in space and words and words[-1] else words if c in space else words[:-1] + [words[-1] + c] if words else [c]
    words = [w for w in words if w]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(space)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated),
            len(words) < 50 or 100 * len(repeated) > 50 * len(words))


def test_base_counts_equal_brute_force(spark, odd):
    rng = random.Random(7)
    texts = ["".join(rng.choice(["a", "b", "c", " ", " ", "\n", "\t", "#", "|", "."]) for _ in range(rng.randint(0, 400))) for _ in range(60)]
    texts += [" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(40, 70))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = quality_rules.judge(docs).collect()
    assert [tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in rows] == \
        [base_by_hand(t) for t in texts]
    assert any(r["base_failed"] for r in rows) and not all(r["base_failed"] for r in rows)
    assert all(not r["kept"] for r in rows if r["base_failed"])
    many = {r["doc_id"]: r for r in quality_rules.judge(odd.where("doc_id <> 6")).collect()}
    assert many[5]["n_words"] == 30_000 == many[5]["n_repeat_words"] and not many[5]["kept"]
    assert many[1]["clean_text"] is None and many[2]["clean_text"] == "" and many[1]["n_words"] == 0
    assert quality_rules.judge(odd).count() == len(ODD) and quality_rules.judge(odd).columns.count("kept") == 1
    assert quality_rules.judge(odd.limit(0)).count() == 0


def prose(n, start=0):
    return " ".join(f"word{start + i}" for i in range(n)) + "."


def test_lines_fail_by_rule_and_texts_by_loss():
    rule = lambda line, seen=False: quality_rules.failed_rule(line, len(line.split()), seen)
    assert rule("A plain sentence stands here.") is None and rule("„So it ends.”") is None and rule("这是一个句子。") is None
    assert rule("A heading without a mark") == "punctuation" and rule("WHAT!! A!! DEAL!! HERE.") == "punctuation"
    assert rule("some### odd$$$ signs%%% all&&& along.") == "punctuation"
    assert rule("Home | News | About us and many more sections of it.") == "navigation" and rule("Sign in.") == "navigation"
    assert rule("Home is where all of us wish to go in the end.") is None
    assert rule("We use cookies to improve the site.") == "boilerplate" and rule("Said before.", True) == "boilerplate"
    for lost, kept in ((30, True), (31, False)):
        text = f"{prose(100 - lost)}\n{prose(lost, 200)[:-1]}"
        got = quality_rules.judge_text(text)
        assert got[-4:] == (prose(100 - lost), 1, lost, kept)
    text = "\n".join([prose(60), "", prose(20, 100), prose(20, 100)])
    assert quality_rules.judge_text(text)[-4:] == ("\n".join([prose(60), "", prose(20, 100)]), 1, 20, True)
