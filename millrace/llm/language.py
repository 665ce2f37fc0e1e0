"""Language identification by unigram pieces whose segmentations are summed.

For each language a model holds the probabilities of the pieces of a fixed public vocabulary.  A word's likelihood is
the sum over all its segmentations into pieces, found by the forward algorithm; a text's is the product over its words.
Training is expectation-maximisation: expected counts of pieces over all segmentations, from the words of labelled
texts.  Words are runs of letters in lower case, of any length; other characters say nothing.

Null texts and texts without a letter are `und` with score 0, as is every text if nothing was learned.  Ties go to the
language that sorts first.  Very long texts and words are judged whole.  Rows are judged by themselves, so repeated rows agree.  Empty tables give empty results.
Input columns that bear a name of an output column give way.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import add_columns
from millrace.llm.vocabulary import public_path
from millrace.session import cut_lineage

VOCABULARY = "piece_bpe_32k.model"
SAMPLE = 1_200  # labelled documents of each language to learn from, about; the only bound here
ROUNDS = 3
SMOOTH = 0.05
UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")
STRAY = 1e-9  # likelihood of a letter that no piece covers, in any language
LANGUAGES = 1_000  # at most; a model has a number for each language and piece
STEP = 8  # letters between two rescalings of the forward sums
CELLS = 1 << 18  # forward sums held at once; with their pieces about ten times as much memory
TEXTS = 256  # texts whose words are scored together


def words_of(text: str) -> list[str]:
    """The words of a text, each with the mark of a word's beginning."""
    return ["▁" + run for run in LETTERS.findall(text.lower())]


class Pieces:
    """The vocabulary: piece -> index, and an automaton that finds all pieces of a word."""

    def __init__(self, pieces: Iterable[str]):
        self.index = {p: i for i, p in enumerate(dict.fromkeys(pieces))}
        self.letters = {p for p in self.index if len(p) == 1}
        self.points = np.array([ord(p) for p in self.letters], dtype="<u4")
        self.reach = max(map(len, self.index), default=1)
        self.stray = len(self.index)  # the index of letters that no piece covers
        self.finder = ahocorasick.Automaton()
        for p, i in self.index.items():
            self.finder.add_word(p, len(p) << 32 | i)
        self.finder.make_automaton()

    def edges(self, word: str) -> list[tuple[int, int, int]]:
        """All (start, end, piece) of the word, by end; a stray letter is a piece of its own."""
        return [(i, j, piece) for _, i, j, piece in zip(*(x.tolist() for x in self.edges_of([word])))]

    def edges_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word, start, end, piece) of all pieces in some words, by end and word."""
        joined = "\n".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        word_at, starts = np.repeat(np.arange(len(words)), lengths), np.cumsum(lengths) - lengths
        hits = np.fromiter(chain.from_iterable(self.finder.iter(joined)) if self.index else (), np.int64).reshape(-1, 2)
        last, size, piece = hits[:, 0], hits[:, 1] >> 32, hits[:, 1] & 0xFFFFFFFF
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        strays = np.flatnonzero(~np.isin(points, self.points) & (points != ord("\n")))
        if len(strays):
            by_place = np.argsort(np.concatenate([last, strays]), kind="stable")
            last, size, piece = (np.concatenate(pair)[by_place] for pair in (
                (last, strays), (size, np.ones(len(strays), np.int64)), (piece, np.full(len(strays), self.stray))))
        word = word_at[last]
        end = last - starts[word] + 1
        order = np.argsort(end.astype(np.int16) if lengths.max(initial=0) < 1 << 15 else end, kind="stable")  # a radix sort for short words
        return word[order], (end - size)[order], end[order], piece[order]


@lru_cache(maxsize=2)
def vocabulary_pieces(path: str) -> Pieces:
    """Pieces of letters (and the mark) in lower case, of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    own = (model.id_to_piece(i) for i in range(model.get_piece_size())
           if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return Pieces(p for p in (x.lower() for x in own) if LETTERS.fullmatch(p.replace("▁", "", 1) or "a"))


def _groups(words: list[str], width: int):
    """Indices of words of about one length, few enough that `width` sums for each of their letters fit in `CELLS`."""
    order = sorted(range(len(words)), key=lambda k: len(words[k]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end - at + 1) * (len(words[order[end]]) + 1) * width <= CELLS:
            end += 1
        yield order[at:end]
        at = end


def _forward(lengths: np.ndarray, edges: tuple, p: np.ndarray, reach: int, beginnings: bool) -> np.ndarray:
    """Log-likelihood of each word in each language, summed over all segmentations, or of all its `beginnings` (second axis).

    Words come sorted by length, `edges` by end and word.  Sums are rescaled on the way, so that words may be of any length.
    """
    word, start, end, piece = edges
    sums = np.zeros((len(lengths), lengths[-1] + 1, p.shape[1]))
    sums[:, 0] = 1.0
    scale = np.zeros((len(lengths), p.shape[1]))
    logs = np.zeros(sums.shape if beginnings else scale.shape)
    bounds = np.searchsorted(end, np.arange(1, lengths[-1] + 2))
    ended = np.searchsorted(lengths, np.arange(lengths[-1] + 2))
    for j in range(1, lengths[-1] + 1):
        own = slice(bounds[j - 1], bounds[j])
        w = word[own]
        if len(w):
            first = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            sums[w[first], j] = np.add.reduceat(sums[w, start[own]] * p[piece[own]], first)
        wanted = slice(ended[j], len(lengths) if beginnings else ended[j + 1])
        logs[(wanted, j) if beginnings else wanted] = np.log(np.maximum(sums[wanted, j], 1e-300)) + scale[wanted]
        if j % STEP == 0:
            live = slice(ended[j + 1], len(lengths))
            window = sums[live, max(0, j + 1 - reach):j + 1]
            top = np.maximum(window.max(axis=1), 1e-300)
            window /= top[:, None]
            scale[live] += np.log(top)
    return logs


def log_likelihoods(words: list[str], pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """The log-likelihood of each word (row) in each language; `p` has a row for each piece and a column for each language."""
    out = np.zeros((len(words), p.shape[1]))
    for group in _groups(words, p.shape[1]):
        own = [words[k] for k in group]
        lengths = np.array([len(w) for w in own])
        out[group] = _forward(lengths, pieces.edges_of(own), p, pieces.reach, False)
    return out


def expected_counts(words: list[str], times: np.ndarray, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """How often each piece is expected in words that occur so many `times`, in a language of probabilities `p`."""
    out, column = np.zeros(len(p)), p[:, None]
    for group in _groups(words, 2):
        own = [words[k] for k in group]
        lengths = np.array([len(w) for w in own])
        word, start, end, piece = pieces.edges_of(own)
        before = _forward(lengths, (word, start, end, piece), column, pieces.reach, True)[:, :, 0]
        turned = np.lexsort((word, lengths[word] - start))  # the words read from behind
        mirrored = (word[turned], (lengths[word] - end)[turned], (lengths[word] - start)[turned], piece[turned])
        behind = _forward(lengths, mirrored, column, pieces.reach, True)[:, :, 0]
        whole = before[np.arange(len(own)), lengths]
        share = np.exp(before[word, start] + np.log(p[piece]) + behind[word, lengths[word] - end] - whole[word])
        out += np.bincount(piece, share * times[group][word], len(p))
    return out


@dataclass
class Model:
    """Languages in sorted order and, for each, the probabilities of all pieces and of a stray letter."""

    languages: list[str]
    probabilities: np.ndarray
    path: str | None = None

    @property
    def pieces(self) -> Pieces:
        return vocabulary_pieces(self.path or public_path(VOCABULARY))


def _counts(batches):
    """(lang, text) -> (lang, word, n); what a task has counted goes out before it grows large."""
    counts: dict[str, Counter] = {}

    def flush():
        rows = [(lang, word, n) for lang, own in counts.items() for word, n in own.items()]
        counts.clear()
        columns = list(zip(*rows)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
                                           pa.array(columns[2], pa.int64())], ["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.setdefault(lang, Counter()).update(words_of(text))
        if sum(map(len, counts.values())) > 200_000:
            yield flush()
    yield flush()


def _expectations(model: Model) -> Callable:
    """(lang, word, n) -> (lang, piece, expected count), summed within the task."""

    def run(batches):
        pieces, sums = model.pieces, np.zeros(model.probabilities.shape)
        at = {lang: i for i, lang in enumerate(model.languages)}
        for batch in batches:
            words: dict[str, tuple[list, list]] = {}
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                own = words.setdefault(lang, ([], []))
                own[0].append(word)
                own[1].append(n)
            for lang, (own, times) in words.items():
                sums[at[lang]] += expected_counts(own, np.array(times, float), pieces, model.probabilities[at[lang]])
        lang, piece = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(piece, pa.int32()),
                                          pa.array(sums[lang, piece], pa.float64())], ["lang", "piece", "expected"])

    return run


def fit(docs: DataFrame, learn: Column | None = None, key: str = "doc_id", text: str = "text", lang: str = "lang",
        sample: int = SAMPLE, rounds: int = ROUNDS, vocabulary: str | None = None) -> Model:
    """Learns from the rows of `docs` where `learn` holds and text and language are not null.

    About `sample` documents of each language are taken, all if there are fewer, by a hash of id and text; this bounds
    the fit, whatever the input.  More than `LANGUAGES` languages are refused.  Collected are the languages and at most one number for each language and piece.
    """
    known = docs.where(F.col(lang).isNotNull() if learn is None else learn & F.col(lang).isNotNull())
    known = known.select(F.col(lang).cast("string").alias("lang"), F.col(key).alias("key"), F.col(text).alias("text"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()}
    languages = sorted(sizes)
    if len(languages) > LANGUAGES:
        raise ValueError(f"{len(languages)} languages, at most {LANGUAGES} can be learned")
    pieces = vocabulary_pieces(vocabulary or public_path(VOCABULARY))
    width = len(pieces.index) + 1
    start = np.full((len(languages), width), 1.0 / width)
    start[:, -1] = STRAY
    model = Model(languages, start, vocabulary)
    if not languages:
        return model
    share = F.create_map(*[F.lit(x) for x in languages for x in (x, sample / sizes[x])])
    chance = F.pmod(F.xxhash64(F.col("key").cast("string"), "text", F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    drawn = known.where((chance < share[F.col("lang")]) & F.col("text").isNotNull()).select("lang", "text")
    words = cut_lineage(drawn.mapInArrow(_counts, "lang string, word string, n long")
                        .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    for _ in range(rounds):
        found = words.select("lang", "word", "n").mapInArrow(_expectations(model), "lang int, piece int, expected double")
        table = found.groupBy("lang", "piece").agg(F.sum("expected").alias("expected")).toArrow()
        counts = np.full(model.probabilities.shape, SMOOTH)
        counts[table["lang"].to_numpy(), table["piece"].to_numpy()] += table["expected"].to_numpy()
        counts[:, -1] = 0.0
        p = counts / counts.sum(axis=1, keepdims=True)
        p[:, -1] = STRAY
        model = Model(languages, p, vocabulary)
    return model


class Scorer:
    """Log-likelihoods of texts, the words of many texts at once; the words met so far are remembered, up to a limit."""

    def __init__(self, model: Model, limit: int = 250_000):
        self.pieces, self.languages, self.limit = model.pieces, model.languages, limit
        self.p = np.ascontiguousarray(model.probabilities.T)
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}  # token -> row; words of letters only have one row in each of the two tables
        self.words: dict[str, int] = {}
        self.table = self.word_table = np.zeros((0, len(self.languages) + 1))

    def _learn(self, tokens: list[str]) -> None:
        """Adds the rows of new tokens: for each language the log-likelihood of its words, then its number of letters."""
        spelled = [words_of(t) for t in tokens]
        new = list({w for ws in spelled for w in ws if w not in self.words})
        if new:
            rows = np.column_stack([log_likelihoods(new, self.pieces, self.p), [len(w) - 1.0 for w in new]])
            self.words.update(zip(new, range(len(self.word_table), len(self.word_table) + len(new))))
            self.word_table = np.concatenate([self.word_table, rows])
        token = np.repeat(np.arange(len(tokens)), [len(ws) for ws in spelled])
        rows = np.zeros((len(tokens), self.table.shape[1]))
        np.add.at(rows, token, self.word_table[[self.words[w] for ws in spelled for w in ws]])
        self.at.update(zip(tokens, range(len(self.table), len(self.table) + len(tokens))))
        self.table = np.concatenate([self.table, rows])

    def sums(self, texts: list[str]) -> np.ndarray:
        """For each text its log-likelihood in each language, then its number of letters."""
        counted = [Counter(t.split()) for t in texts]
        if len(self.at) > self.limit:
            self.clear()
        self._learn(list({t for c in counted for t in c if t not in self.at}))
        out = np.zeros((len(texts), self.table.shape[1]))
        for k, c in enumerate(counted):
            if c:
                out[k] = np.fromiter(c.values(), float, len(c)) @ self.table[[self.at[t] for t in c]]
        return out

    def judge(self, texts: list[str | None] | pa.Array) -> list[tuple[str, float]]:
        out = []
        for at in range(0, len(texts), TEXTS):  # a list, or an Arrow array of which only so many texts are Python's at a time
            own = texts[at:at + TEXTS]
            for sums in self.sums([t or "" for t in (own.to_pylist() if isinstance(own, pa.Array) else own)]):
                if not self.languages or not sums[-1]:
                    out.append((UNDETERMINED, 0.0))
                    continue
                best = int(np.argmax(sums[:-1]))
                out.append((self.languages[best], float(1.0 / np.exp(sums[:-1] - sums[best]).sum())))
        return out


def detect(docs: DataFrame, model: Model, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """`docs` with the language and its probability given the text (all languages alike beforehand)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a number for each language and piece of the vocabulary

    def make():
        scorer = Scorer(shared.value)
        return lambda batch: list(zip(*scorer.judge(batch.column(text)))) or [[], []]

    return add_columns(docs, make, f"`{lang_pred}` string, `{score}` double")
