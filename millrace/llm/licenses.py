"""Licence scans: a trained paragraph classifier whose predictions are confirmed by comparison with templates.

A paragraph is a line.  Lines with a telling word (a fixed pattern that all notices match) are classified by logistic
regression over their distinct word 1- to 3-grams, with an `unknown` class and a temperature that is fitted on
held-out variants; less than `LEAST` probability is `unknown` too.  A family is confirmed if the grams of one of its
notices cover the line, or the line covers a notice, to the share `COVERED`.

The fit runs on the driver over the fixed notices and variants of them (about a thousand short texts) and reads no
table.  The scan is column expressions only: distinct lines are classified once, however often they occur, and joined
back by line, so that a line in a third of all documents is one row of work.

Null and empty texts and texts without telling words give no rows.  Repeated rows give their rows again.  Very
long texts and lines are scanned whole.  Of equally probable families the one that sorts last is named.  Empty tables
give no rows.  Only id and text are read.
"""

from __future__ import annotations

import json
import random
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.license_texts import NOTICES, UNRELATED
from millrace.session import cut_lineage

UNKNOWN = "unknown"
TELLING = r"(?i)licen[sc]|copyright|rights reserved|redistribut|public domain|permission|creative commons|spdx|\bmpl\b|warrant"
WORD = r"[a-z0-9]+(?:\.[0-9]+)*"
GRAMS = 3
LEAST = 0.5
COVERED = 0.5
VARIANTS = 24  # of each notice to learn from
KEPT_WEIGHT = 0.01  # smaller weights are dropped
SEED = 11


def grams_of(text: str) -> list[str]:
    """The distinct word 1- to 3-grams."""
    words = re.findall(WORD, text.lower())
    return sorted({" ".join(words[i:i + n]) for n in range(1, GRAMS + 1) for i in range(len(words) - n + 1)})


@dataclass(frozen=True)
class Model:
    """Weights by gram and class; `share` weighs the share of words that no notice has, `temperature` calibrates."""

    classes: list[str]
    grams: list[str]
    weights: np.ndarray
    bias: np.ndarray
    share: np.ndarray
    temperature: float


def _variants(rng: random.Random, text: str, count: int) -> list[str]:
    """The text, and as many others with words left out, cut short or set among filler."""
    words, out = text.split(), [text]
    filler = lambda: "".join(rng.choice("abdefghilmnorstu") for _ in range(rng.randint(2, 8)))
    while len(out) < count:
        own = [w for w in words if rng.random() > 0.12] or words
        if len(own) > 8 and rng.random() < 0.4:
            start = rng.randint(0, len(own) - 8)
            own = own[start:start + rng.randint(8, len(own))]
        before, after = rng.choice((0, 0, 2, 6)), rng.choice((0, 0, 2, 6))
        out.append(" ".join([*[filler() for _ in range(before)], *own, *[filler() for _ in range(after)]]))
    return out


def _rows(texts: list[str], at: dict[str, int]) -> np.ndarray:
    x = np.zeros((len(texts), len(at) + 2))
    for row, text in zip(x, texts):
        own = grams_of(text)
        row[[at[g] for g in own if g in at]] = 1.0
        single = [g for g in own if " " not in g]
        row[-2] = sum(g not in at for g in single) / max(1, len(single))
        row[-1] = 1.0
    return x


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@lru_cache(maxsize=1)
def fit() -> Model:
    """Learns from the notices; the same model in every session."""
    rng, classes = random.Random(SEED), [*NOTICES, UNKNOWN]
    grams = sorted({g for texts in [*NOTICES.values(), UNRELATED] for t in texts for g in grams_of(t)})
    at = {g: i for i, g in enumerate(grams)}
    texts, labels = [], []
    for label, own in enumerate([*NOTICES.values(), UNRELATED]):
        for text in own:
            made = _variants(rng, text, VARIANTS)
            texts += made
            labels += [label] * len(made)
    x, y = _rows(texts, at), np.eye(len(classes))[labels]
    held = np.arange(len(x)) % 4 == 3
    w, speed = np.zeros((x.shape[1], len(classes))), np.zeros((x.shape[1], len(classes)))
    xt, yt = x[~held], y[~held]
    for _ in range(120):
        slope = xt.T @ (_softmax(xt @ w) - yt) / len(xt) + 1e-4 * w
        speed = 0.9 * speed - 0.5 * slope
        w = w + speed
    w[np.abs(w) < KEPT_WEIGHT] = 0.0
    z, truth = x[held] @ w, y[held].astype(bool)
    temperature = min((float(t) for t in np.geomspace(0.3, 3.0, 40)), key=lambda t: -np.log(_softmax(z / t)[truth] + 1e-12).sum())
    return Model(classes, grams, w[:-2], w[-1], w[-2], temperature)


def _grams(words: Column) -> Column:
    joined = lambda n: F.when(F.size(words) >= n, F.transform(
        F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.concat_ws(" ", F.slice(words, i, n)))).otherwise(
        F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*[joined(n) for n in range(1, GRAMS + 1)]))


def _tables(spark: SparkSession, model: Model) -> tuple[DataFrame, DataFrame]:
    """(gram, weights) and (family, template, size, gram); their size is that of the notices."""
    weights = [(g, [float(x) for x in w]) for g, w in zip(model.grams, model.weights)]
    templates = [(family, i, len(own), g) for family, texts in NOTICES.items() for i, t in enumerate(texts) if (own := grams_of(t)) for g in own]
    inline = lambda rows, kind: spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))
    return (inline([{"gram": g, "weights": w} for g, w in weights], "array<struct<gram:string,weights:array<double>>>"),
            inline([{"family": f, "template": i, "size": n, "gram": g} for f, i, n, g in templates],
                   "array<struct<family:string,template:int,size:int,gram:string>>"))


def paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(`doc_id`, `place`, `paragraph`) of the lines with a telling word."""
    lines = docs.where(F.col(text).rlike(TELLING)).select(F.col(key).alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("place", "paragraph"))
    return lines.where(F.col("paragraph").rlike(TELLING))


def classify(lines: DataFrame, model: Model) -> DataFrame:
    """(`paragraph`, `family`, `probability`, `similarity`, `confirmed`) of distinct lines."""
    weights, templates = _tables(lines.sparkSession, model)
    own = lines.select("paragraph").distinct().withColumn("words", F.regexp_extract_all(F.lower("paragraph"), F.lit(WORD), F.lit(0)))
    own = own.withColumn("grams", _grams(F.col("words")))
    each = own.select("paragraph", F.size("grams").alias("n"), F.size(F.array_distinct("words")).alias("words"), F.explode("grams").alias("gram"))
    scored = each.join(weights, "gram", "left").groupBy("paragraph").agg(
        F.sum(F.when(F.col("weights").isNull() & (F.instr("gram", " ") == 0), 1.0).otherwise(0.0)).alias("strange"),
        F.first("words").alias("words"), *[F.sum(F.col("weights")[c]).alias(f"z{c}") for c in range(len(model.classes))])
    logit = lambda c: (F.coalesce(f"z{c}", F.lit(0.0)) + float(model.bias[c])
                       + float(model.share[c]) * F.col("strange") / F.col("words")) / model.temperature
    z = F.array(*[F.struct(logit(c).alias("z"), F.lit(name).alias("family")) for c, name in enumerate(model.classes)])
    scored = scored.select("paragraph", F.array_max(z).alias("best"), F.transform(z, lambda x: x["z"]).alias("z"))
    total = F.aggregate("z", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("best.z")))
    scored = scored.select("paragraph", F.col("best.family").alias("family"), (1.0 / total).alias("probability"))
    common = each.join(templates, "gram").groupBy("paragraph", "family", "template").agg(
        F.count("*").alias("common"), F.first("n").alias("n"), F.first("size").alias("size"))
    alike = common.groupBy("paragraph", "family").agg(F.max(F.col("common") / F.least("n", "size")).alias("similarity"))
    judged = scored.join(alike, ["paragraph", "family"], "left")
    similarity = F.coalesce("similarity", F.lit(0.0))
    named = (F.col("family") != UNKNOWN) & (F.col("probability") >= LEAST)
    return judged.select("paragraph", F.when(named, F.col("family")).otherwise(UNKNOWN).alias("family"), "probability",
                         similarity.alias("similarity"), (named & (similarity >= COVERED)).alias("confirmed"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """One row per paragraph with a telling word: `doc_id, place, paragraph, family, probability, similarity, confirmed`."""
    lines = cut_lineage(paragraphs(docs, key, text))
    verdicts = cut_lineage(classify(lines, model or fit()))
    return lines.join(verdicts, "paragraph").select("doc_id", "place", "paragraph", "family", "probability", "similarity", "confirmed")
