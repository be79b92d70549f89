"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

P(word | before) = P(class | before) P(word | class). Frequent words and the
end are classes of their own; the other words share classes by their endings.
The class is predicted by a maximum-entropy model: a bias, and weights of
hashed features of the words before (one before; the one two before, skipping one; both
together). Within a class the only feature is the word itself, whose best
weight is known: the smoothed share of the class's training tokens.

Texts are split once. A slice of documents keeps its own short dictionary,
so that what is shuffled by word is a row per slice and distinct word, not
per token, and a very frequent word is one row of each slice.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairwright.llm.common import as_blocks, crc_fold, encode_words, materialize, per_text, slices, split_words, sum_blocks

# Classes: SINGLES frequent words, the end, and the rest by ending.
CLASSES, SINGLES = 64, 24
END = SINGLES
ENDINGS = CLASSES - SINGLES - 1
# Buckets of each kind of feature; a model of 3 * BUCKETS * CLASSES weights (1.6 MB).
KINDS, BUCKETS = 3, 2_048
# Distributed updates: each training document takes part in one round of an epoch.
ROUNDS, EPOCHS, RATE, PRIOR = 4, 1, 0.5, 2.0
# A slice ends at so many tokens or distinct words; tokens scored at once.
SLICE_TOKENS, SLICE_WORDS, PART_TOKENS, AT_ONCE = 1_000_000, 150_000, 100_000, 40_000
# Slices are long rows: a batch sent to a worker holds so many bytes.
BATCH_BYTES = "8m"

SLICE_DDL = "slice long, train_docs long, doc_ids array<long>, train binary, ends binary, codes binary, words array<string>, hashes binary, endings binary, counts binary"


def pack_codes(codes: np.ndarray) -> bytes:
    """Bytes of the same weight side by side: those of high weight are mostly zero, so that files and shuffles hold little of them."""
    return codes.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_codes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()


def _slices_of(fold_column: int, holdout: int):
    """Rows of SLICE_DDL: documents as numbers of the slice's own dictionary, and each word's training count."""
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, k = TaskContext.get().partitionId(), 0
        place: dict[str, int] = {}
        ids, train, sizes, codes = [], [], [], []

        def close():
            flat = np.concatenate(codes) if codes else np.zeros(0, np.int32)
            n, keep = np.concatenate(sizes), np.concatenate(train)
            counts = np.bincount(flat[np.repeat(keep, n)], minlength=len(place)).astype("<i4")
            values = [task * 2**32 + k, int(keep.sum()), ids, keep.tobytes(), np.concatenate(([0], np.cumsum(n))).astype("<i8").tobytes(), pack_codes(flat), list(place),
                      np.fromiter((xxhash.xxh64_intdigest(w) for w in place), np.uint64, len(place)).astype("<u8").tobytes(),
                      np.fromiter((ending_class(w) for w in place), np.uint8, len(place)).tobytes(), counts.tobytes()]
            types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], [f.split()[0] for f in SLICE_DDL.split(", ")])

        for batch in slices(batches, "text"):
            words, ends = split_words(batch.column(1), lower=True)
            distinct, own = encode_words(words)
            numbers = np.fromiter((place.setdefault(w, len(place)) for w in distinct), np.int32, len(distinct))
            ids.extend(batch.column(0).to_pylist())
            train.append(batch.column(fold_column).to_numpy(zero_copy_only=False) != holdout)
            sizes.append(np.diff(ends))
            codes.append(numbers[own] if len(own) else np.zeros(0, np.int32))
            if len(place) >= SLICE_WORDS or sum(map(len, codes)) >= SLICE_TOKENS:
                yield close()
                place, k = {}, k + 1
                ids, train, sizes, codes = [], [], [], []
        if ids:
            yield close()
    return cut


def split_corpus(docs: DataFrame, fold: int, holdout: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All documents in slices, written to the shared folder."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), crc_fold(key, fold).cast("int").alias("fold"))
    return materialize(rows.mapInArrow(_slices_of(2, holdout), SLICE_DDL), "lm-slices")


def _dictionary(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for slice_id, words, endings, counts in zip(*[c.to_pylist() for c in batch.columns]):
            n = len(words)
            for at in range(0, n, 50_000):
                part = words[at:at + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(part), slice_id)), pa.array(np.arange(at, at + len(part), dtype=np.int32)), pa.array(part, pa.string()),
                    pa.array(np.frombuffer(counts, "<i4")[at:at + len(part)].astype(np.int64)), pa.array(np.frombuffer(endings, np.uint8)[at:at + len(part)].astype(np.int32))],
                    ["slice", "code", "word", "n", "ending"])


def ending_class(word: str) -> int:
    """A class by the last three letters and whether a mark follows them."""
    end = len(word)
    while end and not word[end - 1].isalnum():
        end -= 1
    return SINGLES + 1 + xxhash.xxh32_intdigest(word[max(0, end - 3):end] + (word[end:] and ".")) % ENDINGS


@dataclass
class Unigrams:
    """Training totals: tokens, distinct tokens, count of the end, and of each class; the frequent words."""

    tokens: int
    types: int
    ends: int
    singles: list[str]
    class_tokens: np.ndarray
    class_types: np.ndarray


def unigrams(vocabulary: DataFrame, ends: int) -> Unigrams:
    seen = vocabulary.filter("c > 0")
    top = seen.orderBy(F.col("c").desc(), "word").limit(SINGLES).collect()
    classes = seen.groupBy("ending").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    tokens, types = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in classes:
        tokens[r["ending"]], types[r["ending"]] = r["c"], r["v"]
    total, distinct = int(tokens.sum()), int(types.sum())
    for k, r in enumerate(top):
        tokens[k], types[k] = r["c"], 1
        tokens[r["ending"]] -= r["c"]
        types[r["ending"]] -= 1
    tokens[END], types[END] = ends, min(ends, 1)
    return Unigrams(total + ends, distinct + min(ends, 1), ends, [r["word"] for r in top], tokens, types)


class SliceTokens:
    """The tokens of a part of a slice with the end of each document, as hashes and classes."""

    def __init__(self, row: dict):
        hashes, classes, ends, codes = row["hashes"], row["classes"], row["ends"], row["codes"]
        docs = len(ends) - 1
        self.train = row["train"]
        self.ends = ends + np.arange(docs + 1)
        at = np.ones(self.ends[-1], bool)
        at[self.ends[1:] - 1] = False
        self.is_end = ~at
        self.codes = np.full(len(at), -1, np.int32)
        self.codes[at] = codes
        self.classes = np.full(len(at), END, np.int32)
        self.classes[at] = classes[codes]
        # Hashes of the words one and two before; a text starts after two marks of its own.
        full = np.zeros(len(at), np.uint64)
        full[at] = hashes[codes] | np.uint64(1)
        first = np.concatenate(([0], full[:-1])).astype(np.uint64)
        second = np.concatenate(([0, 0], full[:-2])).astype(np.uint64)[:len(at)]
        starts = self.ends[:-1]
        first[starts], second[starts] = 0, 0
        second[starts[starts + 1 < len(at)] + 1] = 0
        with np.errstate(over="ignore"):
            mixed = [(first * np.uint64(0x9E3779B97F4A7C15)), (second * np.uint64(0xC2B2AE3D27D4EB4F)),
                     (first * np.uint64(0x165667B19E3779F9) + second * np.uint64(0x27D4EB2F165667C5))]
        self.features = np.stack([((m >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int32) + np.int32(k * BUCKETS) for k, m in enumerate(mixed)])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, dict]]:
    """Slices one by one, as a batch of one row and its plain columns."""
    for batch in batches:
        for k in range(batch.num_rows):
            one = batch.slice(k, 1)
            yield one, {name: one.column(i)[0].as_py() for i, name in enumerate(one.schema.names) if name != "seen"}


def _parts(row: dict, singles: list[str], round_number: int | None = None) -> Iterator[dict]:
    """A slice in runs of documents of about PART_TOKENS tokens: the arrays that are made of tokens stay short.

    With a round's number, of its training documents alone.
    """
    ends, codes, train = np.frombuffer(row["ends"], "<i8"), unpack_codes(row["codes"]), np.frombuffer(row["train"], np.bool_)
    hashes = np.frombuffer(row["hashes"], "<u8")
    classes = np.frombuffer(row["endings"], np.uint8).astype(np.int64)
    for k, w in enumerate(singles):  # 64-bit hashes tell words apart
        classes[hashes == np.uint64(xxhash.xxh64_intdigest(w))] = k
    if round_number is not None:
        turn = train & (np.arange(len(train)) % ROUNDS == round_number)
        sizes = np.diff(ends)
        ends, codes, train = np.concatenate(([0], np.cumsum(sizes[turn]))), codes[np.repeat(turn, sizes)], train[turn]
    docs, at = len(ends) - 1, 0
    while at < docs:
        stop = min(docs, max(at + 1, int(np.searchsorted(ends, ends[at] + PART_TOKENS, "right")) - 1))
        yield {"hashes": hashes, "classes": classes, "ends": ends[at:stop + 1] - ends[at], "codes": codes[ends[at]:ends[stop]], "train": train[at:stop],
               "doc_ids": row.get("doc_ids", [])[at:stop]}
        at = stop


def class_probabilities(bias: np.ndarray, weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """P(class | before) for a batch of tokens: the few active rows of the weights are added up."""
    z = weights[features[0]]
    for f in features[1:]:
        z = z + weights[f]
    z += bias
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def _gradients(shared, round_number: int):
    """Observed and expected sums of each feature and class, over this round's training documents."""
    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, weights, singles = shared.value
        observed, expected = np.zeros(KINDS * BUCKETS * CLASSES), np.zeros((KINDS * BUCKETS, CLASSES), np.float64)
        for row in (part for _, whole in _rows(batches) for part in _parts(whole, singles, round_number)):
            tokens = SliceTokens(row)
            for at in range(0, len(tokens.classes), AT_ONCE):
                features, classes = tokens.features[:, at:at + AT_ONCE], tokens.classes[at:at + AT_ONCE]
                p = class_probabilities(bias, weights, features)
                observed += np.bincount((features.astype(np.int64) * CLASSES + classes).ravel(), minlength=len(observed))
                for f in features:
                    order = np.argsort(f.astype(np.min_scalar_type(len(weights))), kind="stable")  # short numbers are sorted by their digits
                    rows = f[order]
                    starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
                    expected[rows[starts]] += np.add.reduceat(p[order], starts, axis=0)
        yield from as_blocks(np.concatenate([observed, expected.ravel()]), single=True)
    return sums


def train_classes(corpus: DataFrame, counts: Unigrams) -> tuple[np.ndarray, np.ndarray]:
    """Bias and weights. Each round sums the gradient (observed less expected) over its
    documents on all tasks, and moves every weight by the gradient measured on
    a logarithmic scale, log((observed + PRIOR) / (expected + PRIOR)). An epoch's
    rounds take every training document once."""
    spark, size = corpus.sparkSession, KINDS * BUCKETS * CLASSES
    bias = np.log((counts.class_tokens + 1) / (counts.class_tokens + 1).sum()).astype(np.float32)
    weights = np.zeros((KINDS * BUCKETS, CLASSES), np.float32)
    parts = corpus.select("train", "ends", "codes", "hashes", "endings")
    # A task sends one array of the model's size, so it takes several slices.
    parts = parts.coalesce(max(spark.sparkContext.defaultParallelism, parts.rdd.getNumPartitions() // 4))
    for step in range(ROUNDS * EPOCHS):
        shared = spark.sparkContext.broadcast((bias, weights, counts.singles))
        both = sum_blocks(parts.mapInArrow(_gradients(shared, step % ROUNDS), "block int, data binary"), 2 * size)
        observed, expected = both[:size].reshape(weights.shape), both[size:].reshape(weights.shape)
        weights = np.round(weights + RATE * np.log((observed + PRIOR) / (expected + PRIOR)), 4).astype(np.float32)
        shared.unpersist()
    return bias, weights


def _counts(one: pa.RecordBatch, row: dict, u: Unigrams) -> np.ndarray:
    """Training count of each word of a slice; the end has code -1."""
    n = np.zeros(len(row["endings"]) + 1, np.int64)
    seen = one.column(one.schema.get_field_index("seen")).flatten()
    n[seen.field("code").to_numpy(zero_copy_only=False)] = seen.field("c").to_numpy(zero_copy_only=False)
    n[-1] = u.ends
    return n


def _scorer(shared):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, weights, u = shared.value
        unknown = math.log10(u.tokens + u.types + 1)
        within = np.log10(u.class_tokens + u.class_types + 1)
        for n, row in ((counts, part) for one, whole in _rows(batches) for counts in [_counts(one, whole, u)] for part in _parts(whole, u.singles)):
            tokens = SliceTokens(row)
            c = n[tokens.codes].astype(np.float64)
            own = np.log10(c + 1)
            base = own - unknown
            logs = np.empty(len(c))
            for at in range(0, len(c), AT_ONCE):
                stop = min(len(c), at + AT_ONCE)
                p = class_probabilities(bias, weights, tokens.features[:, at:stop])
                logs[at:stop] = np.log10(np.maximum(p[np.arange(stop - at), tokens.classes[at:stop]], 1e-30))
            logs += own - within[tokens.classes]
            held = ~tokens.train
            docs = [per_text(np.add, x, tokens.ends) for x in (base, logs, (c > 0).astype(np.int64))]
            yield pa.RecordBatch.from_arrays([
                pa.array(row["doc_ids"], pa.int64()), pa.array(held), pa.array(np.diff(tokens.ends)), pa.array(docs[2]),
                pa.array(np.full(len(held), u.tokens)), pa.array(docs[0]), pa.array(docs[1])],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return score


@contextmanager
def _short_batches(spark):
    """While work runs inside, batches to workers hold BATCH_BYTES; the session's own setting comes back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_corpus(docs: DataFrame, fold: int = 7, holdout: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from the documents outside the fold, and score all: RESULT, a row for each document.

    A null or empty text has one token, the end. Repeated rows count and are
    scored each; a null id is outside fold 2 of 7 (its crc32 is 0). Words
    never seen in training share one count of their class. An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    corpus = split_corpus(docs, fold, holdout, key, text)
    listed = corpus.select("slice", "words", "endings", "counts").mapInArrow(_dictionary, "slice long, code int, word string, n long, ending int")
    # A word's rows, one for each slice, meet once: each gets the word's count, and one of them stands for it.
    of_word = Window.partitionBy("hash", "word")
    first = F.row_number().over(of_word.orderBy("slice")) == 1
    counted = listed.withColumn("hash", F.xxhash64("word")).select("slice", "code", "ending", F.sum("n").over(of_word).alias("c"), first.alias("first"), "word")
    counted = materialize(counted.withColumn("word", F.when(F.col("first"), F.col("word"))), "lm-words")
    vocabulary = counted.filter("first").select("word", "c", "ending")
    ends = corpus.agg(F.sum("train_docs")).first()[0]
    counts = unigrams(vocabulary, int(ends or 0))
    # A slice's words with their counts in the whole training corpus; rows of a slice are bounded by SLICE_WORDS and a text's own words.
    seen = counted.filter("c > 0").groupBy("slice").agg(F.collect_list(F.struct("code", "c")).alias("seen"))
    whole = corpus.select("slice", "doc_ids", "train", "ends", "codes", "hashes", "endings").join(seen, "slice", "left")
    ready = whole.withColumn("seen", F.coalesce("seen", F.expr("CAST(array() AS array<struct<code: int, c: bigint>>)")))
    with _short_batches(spark):
        bias, weights = train_classes(corpus, counts)
        shared = spark.sparkContext.broadcast((bias, weights, counts))
        return materialize(ready.mapInArrow(_scorer(shared), RESULT), "lm-scores")
