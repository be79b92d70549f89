"""Toxicity by class-conditional Kneser-Ney models of the letters of words.

Toxic expressions here are words and families of words, many of them rare, so
the models run over letters: P(letter | up to four letters before it). The two
classes have counts of their own for the longer contexts; below these both fall back on
the same continuation counts, so an expression that neither class has seen
gets the same probability from both and says nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.llm.common import crc_fold, encode_words, materialize, per_text, slices, split_words

# Letters of an n-gram, the predicted one included; orders below CLASS_ORDER are shared.
ORDER, CLASS_ORDER = 6, 3
DISCOUNT = 0.75
# Labelled documents of each class that are learned from (those with the smallest hashes of their id).
MAX_DOCS_PER_CLASS = 10_000
# Longest run of letters whose likelihoods are averaged; a longer word (a run of a script without spaces) has the best of all such runs.
MAX_LETTERS = 40
# Words, and letters of words, worked on at once.
WORDS_AT_ONCE, LETTERS_AT_ONCE = 20_000, 400_000
CACHED_WORDS = 500_000
# Letters of the windows whose likelihoods are compared; shorter words count as so many letters.
WINDOW = 5
_MIX = np.uint64(0x9E3779B97F4A7C15)


def expressions(words: Iterable[str]) -> list[str]:
    """Words without surrounding punctuation, lower-cased; the word itself if nothing is left."""
    out = []
    for w in words:
        if w.isalpha():
            out.append(w.lower())
        elif w[:-1].isalpha() and not w[-1].isalnum():
            out.append(w[:-1].lower())
        else:
            low = w.lower()
            a, b = 0, len(low)
            while a < b and not low[a].isalnum():
                a += 1
            while b > a and not low[b - 1].isalnum():
                b -= 1
            out.append(low[a:b] or low)
    return out


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of '^word$' for all words in a row, and where each word starts and ends."""
    text = "".join(f"^{w}$" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    return codes, np.concatenate(([0], np.cumsum([len(w) + 2 for w in words]))).astype(np.int64)


def _parts(words: list[str]) -> Iterator[tuple[int, int]]:
    """Starts and ends of runs of whole words that are worked on at once."""
    start, held = 0, 0
    for i, w in enumerate(words):
        if i > start and (i - start == WORDS_AT_ONCE or held + len(w) > LETTERS_AT_ONCE):
            yield start, i
            start, held = i, 0
        held += len(w)
    if len(words) > start:
        yield start, len(words)


def _ngrams(words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """For n = 1..ORDER, hashes of the n-gram that ends at each letter and of the n-1 letters before it.

    0 where a word is too short for n; the leading '^' predicts nothing and
    has no n-gram of its own. Also the letters' places in their words ('^' is
    0) and the words' ends.
    """
    codes, ends = _letters(words)
    at = np.arange(len(codes)) - np.repeat(ends[:-1], np.diff(ends))
    grams, contexts = [], []
    before, power = np.zeros(len(codes), np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for n in range(1, ORDER + 1):
            if n > 1:  # the letter n-1 places back joins the context
                back = np.zeros(len(codes), np.uint64)
                back[n - 1:] = codes[:max(0, len(codes) - n + 1)]
                power = power * _MIX
                before = before + back * power
            inside = (at >= n - 1) & (at > 0)
            for value, salt, out in ((before + codes, n, grams), (before, 64 + n, contexts)):
                h = (value + np.uint64(salt)) * np.uint64(0xC2B2AE3D27D4EB4F)
                h = (h ^ (h >> np.uint64(29))) * _MIX
                h ^= h >> np.uint64(32)
                out.append(np.where(inside, h | np.uint64(1), np.uint64(0)))
    return grams, contexts, at, ends


@dataclass
class Counts:
    """Sorted n-gram hashes with their counts."""

    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, weights: np.ndarray) -> Counts:
        distinct, place = np.unique(keys, return_inverse=True)
        if weights.ndim == 1:
            return cls(distinct, np.bincount(place, weights, len(distinct)))
        return cls(distinct, np.stack([np.bincount(place, w, len(distinct)) for w in weights.T], axis=1))

    def get(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros((len(keys), *self.values.shape[1:]))
        if len(self.keys):
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[place] == keys
            out[hit] = self.values[place[hit]]
        return out


class KneserNey:
    """Two interpolated models with shared lower orders, from a table of n-grams (``NGRAMS``) and counts in each class."""

    def __init__(self, table: dict[str, np.ndarray], counts: np.ndarray):
        """``counts``: a row per n-gram with its number of ordinary and of toxic documents."""
        self.grams: list[Counts] = []
        self.contexts: list[Counts] = []  # per order: totals and numbers of different continuations
        some = counts.sum(axis=1) > 0
        of_order = [np.flatnonzero(some & (table["n"] == n)) for n in range(1, ORDER + 1)]
        for n in range(1, ORDER + 1):
            rows = of_order[n - 1]
            g, c = table["gram"][rows], table["context"][rows]
            if n >= CLASS_ORDER:
                own = counts[rows]
                self.grams.append(Counts.of(g, own))
                totals = Counts.of(c, np.concatenate([own, own > 0], axis=1).astype(np.float64))
            else:
                # Continuation counts: in how many different longer n-grams, of either class, this one ends.
                longer = of_order[n]
                self.grams.append(Counts.of(table["ending"][longer], np.ones(len(longer))))
                own = self.grams[-1].get(g)
                totals = Counts.of(c, np.stack([own, own > 0], axis=1).astype(np.float64))
            self.contexts.append(totals)
        self.alphabet = max(2, len(self.grams[0].keys) + 1)  # one more for letters never seen

    def ratios(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """log10 P(letter | toxic) - log10 P(letter | ordinary) for the letters of all words ('^' 0), and the words' ends."""
        grams, contexts, at, ends = _ngrams(words)
        p = np.full((len(at), 2), 1.0 / self.alphabet)
        for n in range(1, ORDER + 1):
            g, c = grams[n - 1], contexts[n - 1]
            seen, around = self.grams[n - 1].get(g), self.contexts[n - 1].get(c)
            if n < CLASS_ORDER:
                seen, total, kinds = seen[:, None], around[:, :1], around[:, 1:]
            else:
                total, kinds = around[:, :2], around[:, 2:]
            known = (total > 0) & (c != 0)[:, None]
            safe = np.where(known, total, 1.0)
            p = np.where(known, np.maximum(seen - DISCOUNT, 0.0) / safe + DISCOUNT * kinds / safe * p, p)
        logs = np.where((at > 0)[:, None], np.log10(p), 0.0)
        return logs[:, 1] - logs[:, 0], ends


def normalised(ratios: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per word: the log-likelihood ratio per letter of the word, and of its most toxic WINDOW letters in a row.

    A word of more than MAX_LETTERS letters has the ratio of its most toxic MAX_LETTERS letters in a row.
    """
    sizes = np.diff(ends)
    sums = np.concatenate(([0.0], np.cumsum(ratios)))
    whole = (sums[ends[1:]] - sums[ends[:-1]]) / np.maximum(sizes - 1, WINDOW)
    for k in np.flatnonzero(sizes > MAX_LETTERS + 2):
        runs = sums[ends[k] + 1 + MAX_LETTERS:ends[k + 1] + 1] - sums[ends[k] + 1:ends[k + 1] + 1 - MAX_LETTERS]
        whole[k] = runs.max() / MAX_LETTERS
    # The window that ends at each letter, cut at the word's start.
    starts = np.maximum(np.arange(len(ratios)) + 1 - WINDOW, np.repeat(ends[:-1], sizes))
    windows = (sums[1:] - sums[starts]) / WINDOW
    return np.stack([whole, np.maximum.reduceat(windows, ends[:-1])], axis=1)


class WordScores:
    """Scores words through a model and remembers them."""

    def __init__(self, model: KneserNey):
        self.model, self.known = model, {}

    def __call__(self, words: list[str]) -> np.ndarray:
        """A row per word: score of the whole word and of its most toxic window."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        for start, stop in _parts(new):
            part = new[start:stop]
            self.known.update(zip(part, map(tuple, normalised(*self.model.ratios(part)).tolist())))
        return np.array([self.known[w] for w in words], np.float64).reshape(-1, 2)


FEATURES = ("window", "second", "word", "mean")
N_FEATURES = len(FEATURES)


def text_features(texts: pa.Array, scores: WordScores) -> np.ndarray:
    """Per text: the largest window score, the next largest of another place, the largest and the mean word score."""
    words, ends = split_words(texts)
    distinct, codes = encode_words(words)
    values = scores(expressions(distinct))[codes] if len(codes) else np.zeros((0, 2))
    whole, window = values[:, 0], values[:, 1]
    sizes = np.diff(ends)
    top = per_text(np.maximum, window, ends)
    reached = np.concatenate(([0], np.cumsum(window >= np.repeat(top, sizes))))
    first = (np.diff(reached) > 0) & (reached[1:] == np.repeat(reached[ends[:-1]], sizes) + 1)
    second = per_text(np.maximum, np.where(first, 0.0, window), ends)
    return np.stack([top, second, per_text(np.maximum, whole, ends), per_text(np.add, whole, ends) / np.maximum(sizes, 1)], axis=1)


@dataclass
class Toxicity:
    """A model and the logistic weights of its features."""

    model: KneserNey
    weights: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = np.clip(features @ self.weights[1:] + self.weights[0], -30, 30)
        return 1.0 / (1.0 + np.exp(-z))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Newton's method; intercept first. Without both classes the intercept alone.

    With the ``weight`` of each row the mean score is the weighted rate of ``y``.
    """
    weight = np.ones(len(y)) if weight is None else weight
    if not len(y) or y.min() == y.max():
        rate = ((weight * y).sum() + 0.5) / (weight.sum() + 1)
        return np.concatenate(([np.log(rate / (1 - rate))], np.zeros(x.shape[1])))
    a = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    weight = weight / weight.mean()
    w, keep = np.zeros(a.shape[1]), ridge * len(y) * np.eye(a.shape[1])
    keep[0, 0] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + keep, a.T @ (weight * (p - y)) + keep @ w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _word_kinds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, half, toxic): a row for each expression of a document."""
    for batch in slices(batches, "text"):
        words, ends = split_words(batch.column(0))
        distinct, codes = encode_words(words)
        names = expressions(distinct)
        small, place = np.unique(np.array(names, dtype=object), return_inverse=True) if names else (np.zeros(0, object), np.zeros(0, int))
        doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        pairs = np.unique(doc * max(1, len(small)) + place[codes]) if len(codes) else np.zeros(0, np.int64)
        docs, kinds = pairs // max(1, len(small)), pairs % max(1, len(small))
        group = batch.column(1).to_numpy(zero_copy_only=False)[docs] * 2 + batch.column(2).to_numpy(zero_copy_only=False)[docs]
        keys, n = np.unique(kinds * 4 + group, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(small[keys // 4].tolist(), pa.string()), pa.array(keys % 4, pa.int32()), pa.array(n, pa.int64())], ["word", "grp", "n"])


NGRAMS = "n int, gram long, context long, ending long, n0 long, n1 long, n2 long, n3 long"


def _count_ngrams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams of words: order, hash, hashes of the letters before the last and of the n-gram without its first letter, counts."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        for start, stop in _parts(words):
            part = batch.slice(start, stop - start)
            grams, contexts, _, ends = _ngrams(words[start:stop])
            counts = np.stack([np.asarray(part.column(k + 1), dtype=np.int64) for k in range(4)], axis=1)
            weights = np.repeat(counts, np.diff(ends), axis=0)
            for n in range(1, ORDER + 1):
                rows = np.flatnonzero(grams[n - 1])
                distinct, first, place = np.unique(grams[n - 1][rows], return_index=True, return_inverse=True)
                first = rows[first]
                ending = grams[n - 2][first] if n > 1 else np.zeros(len(first), np.uint64)
                sums = [np.bincount(place, weights[rows, k], len(distinct)).astype(np.int64) for k in range(4)]
                hashes = [pa.array(h.view(np.int64)) for h in (distinct, contexts[n - 1][first], ending)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(distinct), n, np.int32)), *hashes, *map(pa.array, sums)],
                                                 [f.split()[0] for f in NGRAMS.split(", ")])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, fold: int, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, half, y, weight) of labelled documents outside fold 0 of crc32: at most ``limit`` of each class, those with the smallest hashes.

    ``weight`` is how many labels of its class a chosen one stands for, so weighted rates are those of all labels.
    """
    marked = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("_id")).agg((F.max(label) > 0).cast("int").alias("y"))
    known = marked.filter(crc_fold("_id", fold) != 0).withColumn("_h", F.xxhash64("_id", F.lit(7)))
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    parts = [known.filter(F.col("y") == y).orderBy("_h", "_id").limit(limit).withColumn("weight", F.lit(max(1.0, totals.get(y, 0) / limit))) for y in (0, 1)]
    chosen = materialize(parts[0].unionByName(parts[1]), "labelled")  # at most 2 * limit rows of four numbers
    rows = docs.select(F.col(key).alias("_doc"), F.col(text).alias("text"))
    return rows.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("text", F.pmod("_h", F.lit(2)).cast("int").alias("half"), "y", "weight")


def _features(model_pair: tuple[KneserNey, KneserNey]):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = [WordScores(m) for m in model_pair]
        for batch in slices(batches, "text"):
            half = batch.column(1).to_numpy(zero_copy_only=False)
            x = np.zeros((batch.num_rows, N_FEATURES))
            for h in (0, 1):  # the model of the other half
                rows = np.flatnonzero(half == h)
                if len(rows):
                    x[rows] = text_features(batch.column(0).take(pa.array(rows)), scores[1 - h])
            yield pa.RecordBatch.from_arrays([*[pa.array(x[:, k]) for k in range(N_FEATURES)], batch.column(2).cast(pa.int32()), batch.column(3)], [*FEATURES, "y", "weight"])
    return score


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", fold: int = 5, limit: int = MAX_DOCS_PER_CLASS) -> Toxicity:
    """Learn from labelled documents whose crc32 fold is not 0, at most ``limit`` of each class.

    Word counts are merged on Spark. Each half's documents are scored by the
    other half's model, and a logistic curve is fitted to these scores, with
    each class weighted up to all its labels, so the sample's balance does not
    move the scores; the final model uses both halves. Without labels every score is 0.5 or so.
    """
    sample = materialize(labelled_sample(docs, labels, label, fold, limit), "toxicity-sample")
    counted = sample.mapInArrow(_word_kinds, "word string, grp int, n long").groupBy("word").agg(
        *[F.sum(F.when(F.col("grp") == g, F.col("n")).otherwise(F.lit(0))).alias(f"n{g}") for g in range(4)])
    groups = [f"n{g}" for g in range(4)]
    found = counted.mapInArrow(_count_ngrams, NGRAMS).groupBy("n", "gram").agg(
        F.min("context").alias("context"), F.min("ending").alias("ending"), *[F.sum(g).alias(g) for g in groups]).toArrow()  # of at most 2 * limit documents
    table = {k: np.asarray(found.column(k)) if k == "n" else np.asarray(found.column(k), dtype=np.int64).view(np.uint64) for k in ("n", "gram", "context", "ending")}
    n = np.stack([np.asarray(found.column(g), dtype=np.float64) for g in groups], axis=1)
    del found
    halves = (KneserNey(table, n[:, :2]), KneserNey(table, n[:, 2:]))
    schema = ", ".join(f"{f} double" for f in FEATURES) + ", y int, weight double"
    found = sample.mapInArrow(_features(halves), schema).orderBy(*FEATURES, "y").toPandas()
    weights = fit_logistic(found[[*FEATURES]].to_numpy(), found["y"].to_numpy(np.float64), found["weight"].to_numpy(np.float64))
    return Toxicity(KneserNey(table, n[:, :2] + n[:, 2:]), weights)


def _scorer(shared):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxicity = shared.value
        words = WordScores(toxicity.model)
        for batch in slices(batches, "text"):
            p = toxicity.scores(text_features(batch.column(batch.schema.get_field_index("text")), words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], ["doc_id", "score"])
    return score


def score(docs: DataFrame, toxicity: Toxicity, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of each row; an empty or null text has the score of no expressions.

    The model is bounded by the labelled sample, so it is sent to the tasks once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(toxicity)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_scorer(shared), "doc_id long, score double")
