"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network.

Random indexing: every term has a fixed sparse random vector of +1 and -1 (its
index vector, made from a hash); a term's word vector is the sum of the index
vectors of its neighbours over the whole corpus. A word gives two terms: the
lower-cased word, and its form (letters become ``a`` or ``A``, digits ``9``,
runs one sign, with a mark if the word equals one of the two before it), so that a
word never seen still has a form that was.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.llm.common import WordMemory, as_blocks, encode_words, free_names, kept_in_worker, materialize, per_text, quoted, schema_text, slices, split_words, sum_blocks
from pairwright.llm.toxicity import labelled_sample

# Word vectors: terms fall into so many buckets by hash, DIMS numbers each (a model of 4 MB), NONZERO of an index vector.
BUCKETS, FORM_BUCKETS, DIMS, NONZERO = 16_384, 4_096, 32, 4
# Labelled documents of each class that the network is fitted on (smallest hashes of the id).
MAX_DOCS_PER_CLASS = 10_000
HIDDEN, STEPS, RATE = 24, 400, 0.02
# Words that a worker remembers, 12 bytes each besides the word.
CACHED_WORDS = 150_000
# Terms whose vectors are laid out at once (20 MB).
TERMS_AT_ONCE = 50_000


def _index_vectors(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero numbers of each bucket's index vector."""
    random = np.random.default_rng(seed)
    return random.integers(0, DIMS, (n, NONZERO)), random.choice([-1.0, 1.0], (n, NONZERO))


PLACES, SIGNS = _index_vectors(BUCKETS + FORM_BUCKETS, 2)


def word_form(word: str) -> str:
    """One sign for each run of small letters, other letters, digits, or an equal sign."""
    out = []
    for ch in word:
        kind = "a" if ch.islower() else "A" if ch.isalpha() else "9" if ch.isdigit() else ch
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def _term_buckets(words: list[str]) -> list[tuple[int, int, int]]:
    """Of each word its bucket, and those of its form, plain and with the mark of a repetition."""
    digest = xxhash.xxh32_intdigest
    out = []
    for w in words:
        form = word_form(w)
        out.append((digest(w.lower()) % BUCKETS, BUCKETS + digest(form) % FORM_BUCKETS, BUCKETS + digest(form + "=") % FORM_BUCKETS))
    return out


class Terms(WordMemory):
    """Buckets of words and of their forms, remembered by word."""

    def __init__(self):
        super().__init__(_term_buckets, 3, CACHED_WORDS)

    def __call__(self, words: list[str]) -> np.ndarray:
        return self.array(words).astype(np.int64)


def worker_terms() -> Terms:
    return kept_in_worker("quality-terms", Terms)


def term_streams(texts: pa.Array, terms: Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets and form buckets of all words in a row, and the ends of texts."""
    words, ends = split_words(texts)
    distinct, codes = encode_words(words)
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), ends
    of = terms(distinct)
    place = np.arange(len(codes)) - np.repeat(ends[:-1], np.diff(ends))
    again = np.zeros(len(codes), bool)
    again[1:] |= (codes[1:] == codes[:-1]) & (place[1:] > 0)
    again[2:] |= (codes[2:] == codes[:-2]) & (place[2:] > 1)
    return of[codes, 0], np.where(again, of[codes, 2], of[codes, 1]), ends


def _contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of neighbours' index vectors by bucket, then how often each bucket occurs."""
    n = BUCKETS + FORM_BUCKETS
    vectors, counts, terms = np.zeros(n * DIMS), np.zeros(n), worker_terms()
    for batch in slices(batches, "text"):
        words, forms, ends = term_streams(batch.column(0), terms)
        counts += np.bincount(words, minlength=n) + np.bincount(forms, minlength=n)
        inside = np.ones(len(words), bool)
        inside[ends[:-1][ends[:-1] < len(words)]] = False  # a text's first word has no left neighbour
        right = np.flatnonzero(inside)
        for stream in (words, forms):
            for here, there in ((right, right - 1), (right - 1, right)):
                base = stream[here] * DIMS
                for source in (words, forms):
                    seen = source[there]
                    for k in range(NONZERO // 2):  # words lend the first half of their numbers, forms the second
                        j = k if source is words else NONZERO // 2 + k
                        vectors += np.bincount(base + PLACES[seen, j], SIGNS[seen, j], n * DIMS)
    yield from as_blocks(np.concatenate([vectors, counts]))


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """A row of DIMS numbers per bucket, learned from all texts, of unit length (0 for a bucket never seen)."""
    n = BUCKETS + FORM_BUCKETS
    flat = sum_blocks(docs.select(F.col(text).alias("text")).mapInArrow(_contexts, "block int, data binary"), n * (DIMS + 1))
    vectors, counts = flat[:n * DIMS].reshape(n, DIMS), flat[n * DIMS:]
    # Sums are whole numbers, so they do not depend on the order of additions.
    mean = vectors.sum(axis=0) / max(1.0, counts.sum())
    centred = vectors - counts[:, None] * mean
    return (centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def text_sums(vectors: np.ndarray, stream: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per text the sum of its terms' vectors; texts are taken in runs of TERMS_AT_ONCE terms, a longer text in parts of so many."""
    docs, at = len(ends) - 1, 0
    out = np.zeros((docs, vectors.shape[1]))
    while at < docs:
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + TERMS_AT_ONCE, "right")) - 1)
        for start in range(int(ends[at]), int(ends[stop]), TERMS_AT_ONCE):
            part = stream[start:min(start + TERMS_AT_ONCE, ends[stop])]
            out[at:stop] += per_text(np.add, vectors[part].astype(np.float64), np.clip(ends[at:stop + 1] - start, 0, len(part)))
        at = stop
    return out


def pooled(texts: pa.Array, vectors: np.ndarray, terms: Terms) -> np.ndarray:
    """Per text: mean word vector, mean vector of forms, and the logarithm of the number of words."""
    words, forms, ends = term_streams(texts, terms)
    n = np.maximum(np.diff(ends), 1)[:, None].astype(np.float64)
    means = [text_sums(vectors, s, ends) / n for s in (words, forms)]
    return np.concatenate([*means, np.log1p(np.diff(ends))[:, None]], axis=1)


N_FEATURES = 2 * DIMS + 1


@dataclass
class Network:
    """Two layers; the output is divided by a temperature before it becomes a probability."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray, share: np.ndarray, weight: np.ndarray | None = None, seed: int = 3) -> Network:
    """Full-batch Adam on a balanced log loss; ``share`` marks rows kept for the temperature.

    The temperature minimises the log loss of the kept rows, each as often as
    its ``weight`` says, with the balance taken back to the weighted one as a
    shift of the output, so scores are probabilities.
    """
    represents = np.ones(len(y)) if weight is None else weight
    good, bad = (represents * y).sum(), (represents * (1 - y)).sum()
    random = np.random.default_rng(seed)
    net = Network(x.mean(axis=0) if len(x) else np.zeros(N_FEATURES), x.std(axis=0) + 1e-6 if len(x) else np.ones(N_FEATURES),
                  random.normal(0, 1 / np.sqrt(N_FEATURES), (N_FEATURES, HIDDEN)), np.zeros(HIDDEN), random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), 0.0)
    rows = ~share
    if not rows.any() or y[rows].min() == y[rows].max():
        net.w2[:] = 0
        net.b2 = float(np.log((good + 0.5) / (bad + 0.5)))
        return net
    z, t = (x[rows] - net.mean) / net.scale, y[rows]
    weight = np.where(t == 1, 0.5 / t.mean(), 0.5 / (1 - t.mean())) / len(t)
    values = [net.w1, net.b1, net.w2, np.array(net.b2)]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, STEPS + 1):
        w1, b1, w2, b2 = values
        h = np.tanh(z @ w1 + b1)
        error = (1 / (1 + np.exp(-np.clip(h @ w2 + b2, -30, 30))) - t) * weight
        back = np.outer(error, w2) * (1 - h * h)
        slopes = [z.T @ back + 1e-4 * w1, back.sum(axis=0), h.T @ error + 1e-4 * w2, error.sum()]
        for k, g in enumerate(slopes):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            values[k] = values[k] - RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = values[0], values[1], values[2], float(values[3])
    kept = share if share.any() else rows
    shift, out, t = float(np.log(good / bad)), net.logits(x[kept]), y[kept]
    grid = np.exp(np.linspace(np.log(0.25), np.log(20), 200))
    losses = [np.average(np.logaddexp(0, -(2 * t - 1) * (out / g + shift)), weights=represents[kept]) for g in grid]
    net.temperature = float(grid[int(np.argmin(losses))])
    net.b2 += shift * net.temperature  # the temperature flattens what the network says, not the balance
    return net


def _features(shared):
    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, terms = shared.value, worker_terms()
        for batch in slices(batches, "text"):
            x = pooled(batch.column(0), vectors, terms)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column(1).cast(pa.int32()), batch.column(2).cast(pa.int32()), batch.column(3)], ["x", "half", "y", "weight"])
    return make


@dataclass
class Quality:
    vectors: np.ndarray
    network: Network


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", fold: int = 5, limit: int = MAX_DOCS_PER_CLASS) -> Quality:
    """Word vectors from all texts; the network from labelled documents whose crc32 fold is not 0.

    At most ``limit`` of each class are used, so what comes to the driver is
    bounded; a quarter of them serves the temperature alone. The balance of the
    sample is undone: a document of it stands for all labels of its class that
    it was drawn from, so scores have the odds of all labels.
    """
    spark = docs.sparkSession
    vectors = word_vectors(docs)
    sample = materialize(labelled_sample(docs, labels, label, fold, limit), "quality-sample")
    shared = spark.sparkContext.broadcast(vectors)
    found = sample.mapInArrow(_features(shared), "x array<double>, half int, y int, weight double").toPandas()
    x = np.array(found["x"].tolist(), np.float64).reshape(-1, N_FEATURES)
    order = np.lexsort(np.round(x[:, ::-1], 6).T) if len(x) else np.zeros(0, int)  # the order of rows must not depend on tasks
    x, y, weight = (v[order] for v in (x, found["y"].to_numpy(np.float64), found["weight"].to_numpy(np.float64)))
    return Quality(vectors, fit_network(x, y, np.arange(len(x)) % 4 == 3, weight))


def _scorer(shared, text: str, name: str):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, terms = shared.value, worker_terms()
        for batch in slices(batches, text):
            p = model.network.scores(pooled(batch.column(batch.schema.get_field_index(text)), model.vectors, terms))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*batch.schema.names, name])
    return score


def with_score(docs: DataFrame, model: Quality, text: str = "text", name: str = "_score") -> DataFrame:
    """Add ``name`` (0 to 1) to the columns of ``docs``; null and empty texts get the score of a text without words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS * DIMS numbers
    return docs.mapInArrow(_scorer(shared, text, name), f"{schema_text(docs)}, {name} double")


def keep_good(docs: DataFrame, model: Quality, minimum: float, text: str = "text") -> DataFrame:
    """Columns of ``docs``, whatever their names; rows with a score of ``minimum`` or more."""
    name, = free_names(docs, "_score")
    return with_score(docs, model, text, name).filter(F.col(name) >= minimum).select(*[quoted(c) for c in docs.columns])
