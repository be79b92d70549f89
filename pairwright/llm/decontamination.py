"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of WINDOW words, half overlapping, of documents and of
benchmark items alike. Their TF-IDF vectors (document frequencies of the
whole corpus) are projected on the leading right singular vectors of all
these passages, found by a distributed randomised SVD. A document's
passage is a candidate for the items whose passages have a cosine of
MIN_COSINE or more there. A candidate region is then compared word by word:
the longest common subsequence with the item, and with the item's answer.
Items of few words, and items of scripts without spaces, are not projected:
their halves are looked up in the text, by word or by letter, and the text
around a half is compared with the item.

Texts are read once: what is kept of them is a stream of numbers, one for each word
that stands in some item and one for each bucket of all other words. Where an item can be found at all, MIN_PARAPHRASE of its words stand near
each other, so at least ANCHORS of its rarest words that are one more than half
of it and ANCHORS more. Only passages near so many of an item's rare words are projected, and
compared with that item; no other passage can lead to a find.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.llm.common import WordMemory, as_blocks, encode_words, free_names, join_small, kept_in_worker, materialize, quoted, slices, split_words, sum_blocks
from pairwright.llm.toxicity import expressions

WINDOW, STRIDE = 24, 12
# Terms of the latent space fall into so many buckets; directions kept, and more that only the search for them uses.
TERM_BUCKETS, RANK, OVERSAMPLE, POWER_STEPS = 8_192, 128, 16, 2
MIN_COSINE = 0.5
# An item is found if so much of it runs through a region in order; or a smaller share together with its answer.
MIN_COPY, MIN_PARAPHRASE, MIN_ANSWER = 0.8, 0.5, 0.8
# So many rare words of an item must stand within REACH times its length (or fewer, if its MIN_PARAPHRASE are fewer).
ANCHORS, REACH = 5, 2
# Half passages whose sums are held at once while the space is searched for, and words of one code that are added one by one.
HALVES_AT_ONCE, ROUNDS = 8_000, 16
# Items of fewer words are looked up by their halves.
MIN_ITEM_WORDS = 8
# Scripts whose words are not separated (Thai to Khmer, kana, Han); an item mostly of these is compared by letter.
UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
# Text worked on at once; a larger part has fewer distinct words for its size.
TEXT_AT_ONCE = 6_000_000
# The benchmark is searched in blocks of about so many words (of whole items).
BLOCK_WORDS = 200_000
# Passages projected at once; what a worker remembers of words.
PASSAGES_AT_ONCE, MEMORY_WORDS = 2_000, 300_000


def _hash(word: str, buckets: int) -> int:
    return xxhash.xxh32_intdigest(word) % buckets


# --- benchmark ---------------------------------------------------------------


def item_words(text: str | None) -> list[str]:
    return expressions(w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w)


def answer_words(text: str, answer: str | None = None) -> list[str]:
    """The given answer, else the item's last sentence, else the last quarter of its words."""
    if answer:
        return item_words(answer)
    sentences = [s for s in re.split(r"[.!?]+(?=\s|$)", text) if s.strip()]
    words = item_words(text)
    return item_words(sentences[-1]) if len(sentences) > 1 else words[-max(1, len(words) // 4):]


def windows(n: int) -> list[tuple[int, int]]:
    """Starts and ends of the passages of n words."""
    return [(s, min(n, s + WINDOW)) for s in range(0, max(1, n - STRIDE), STRIDE)] if n else []


@dataclass
class Items:
    ids: list[int | None]
    words: list[list[str]]
    answers: list[list[str]]


def item_blocks(benchmark: DataFrame, key: str, text: str, answer: str | None) -> Iterator[Items]:
    """All items with words, in blocks by a hash, of about BLOCK_WORDS words; a block at a time comes to the driver."""
    columns = [F.col(key).alias("k"), F.col(text).alias("t"), (F.col(answer) if answer else F.lit(None).cast("string")).alias("a")]
    rows = benchmark.select(*columns).filter(F.length("t") > 0)
    total = rows.agg(F.sum(F.regexp_count("t", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_WORDS))
    for block in range(blocks):
        out = Items([], [], [])
        for row in rows.filter(F.pmod(F.xxhash64("t"), F.lit(blocks)) == block).orderBy("k", "t").collect():
            words = item_words(row["t"])
            if words:
                out.ids.append(row["k"])
                out.words.append(words)
                out.answers.append(answer_words(row["t"], row["a"]))
        if out.ids:
            yield out


# --- latent space ------------------------------------------------------------


def _vectors(passages: list[list[int]], weights: list[list[float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms, unit-length weights and the ends of the rows of a sparse matrix."""
    terms = np.array([t for p in passages for t in p], np.int64)
    values = np.array([v for p in weights for v in p], np.float64)
    ends = np.concatenate(([0], np.cumsum([len(p) for p in passages]))).astype(np.int64)
    row = np.repeat(np.arange(len(passages)), np.diff(ends))
    norms = np.sqrt(np.bincount(row, values * values, len(passages)))
    return terms, values / np.maximum(norms[row], 1e-12), ends


def _times(shared):
    """Each task's part of A' (A M), for the sparse rows of A it holds."""
    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        total = np.zeros_like(m)
        for batch in batches:
            terms, values, ends = _vectors(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            if len(terms):
                rows = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
                projected = np.add.reduceat(m[terms] * values[:, None], ends[:-1], axis=0)
                np.add.at(total, terms, projected[rows] * values[:, None])
        yield from as_blocks(total.ravel())
    return multiply


def latent_space(passages: DataFrame, rank: int = RANK, seed: int = 5) -> np.ndarray:
    """Leading right singular vectors (TERM_BUCKETS rows) of the sparse matrix (terms array<int>, weights array<double>)."""
    spark = passages.sparkSession

    def product(m: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(m)
        out = sum_blocks(passages.mapInArrow(_times(shared), "block int, data binary"), m.size).reshape(m.shape)
        shared.unpersist()
        return out
    return _leading(product, rank, seed)


def _leading(product: Callable[[np.ndarray], np.ndarray], rank: int = RANK, seed: int = 5) -> np.ndarray:
    """Leading right singular vectors of a matrix A with TERM_BUCKETS columns, of which ``product`` gives A' (A M).

    Randomised range finder with power steps: every product is summed over the
    tasks that hold the rows, and only a bounded matrix comes to the driver.
    """
    q = np.random.default_rng(seed).normal(size=(TERM_BUCKETS, rank + OVERSAMPLE))
    for _ in range(POWER_STEPS):
        q = np.linalg.qr(product(q))[0]
    values, turned = np.linalg.eigh(q.T @ product(q))
    best = np.argsort(-values)[:rank]
    return (q @ turned[:, best[values[best] > 1e-9 * max(values.max(), 1e-300)]]).astype(np.float32)


def places_of(stream: np.ndarray, known: int) -> np.ndarray:
    """The place of each word of a stream in tables of weights: known words, then buckets of the others."""
    return np.where(stream >= 0, stream, known - 1 - stream)


@dataclass
class Weights:
    """Of each place its bucket in the latent space and its inverse document frequency; of the last, for no word, 0."""

    term: np.ndarray
    inverse: np.ndarray
    known: int


def add_products(total: np.ndarray, m: np.ndarray, weights: Weights, stream: np.ndarray, ends: np.ndarray) -> None:
    """Add A' (A M) of all passages of a part of the texts to ``total``, by place instead of bucket.

    A passage is a half and the next one of its text, so each word is summed once. A row of A has unit length.
    """
    none = len(weights.term) - 1
    directions = (m[weights.term] * weights.inverse[:, None]).astype(np.float32)
    square = weights.inverse ** 2
    places = np.append(places_of(stream, weights.known), none)
    counts = -(-np.diff(ends) // STRIDE)
    upto = np.cumsum(counts)
    doc = 0
    while doc < len(counts):  # whole texts of about HALVES_AT_ONCE halves
        last = max(doc + 1, int(np.searchsorted(upto, (upto[doc - 1] if doc else 0) + HALVES_AT_ONCE, "right")))
        n = counts[doc:last]
        of = np.repeat(np.arange(doc, last), n)
        number = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        begin = ends[of] + number * STRIDE
        at = begin[:, None] + np.arange(STRIDE)
        word = places[np.where(at < ends[of + 1][:, None], at, len(stream))]
        doc = last
        if not len(of):
            continue
        half, length = np.zeros((len(of), m.shape[1]), np.float32), square[word].sum(axis=1)
        for k in range(STRIDE):
            half += directions[word[:, k]]
        follows = np.append(number[1:] > 0, False)
        starts = follows | (number == 0)  # a text of one half is a passage as well; other last halves are in the one before
        row = half + np.where(follows[:, None], np.roll(half, -1, axis=0), 0)
        scale = np.where(starts, 1 / np.maximum(length + np.where(follows, np.roll(length, -1), 0), 1e-24), 0)
        row *= scale[:, None].astype(np.float32)
        row += np.where(np.append(False, follows[:-1])[:, None], np.roll(row, 1, axis=0), 0)
        _add_rows(total, word.ravel(), row)


def _add_rows(total: np.ndarray, place: np.ndarray, rows: np.ndarray) -> None:
    """Add to each place the row of its half, as often as it stands there. Frequent places are summed at once, others round by round."""
    order = np.argsort(place, kind="stable")
    at, half = place[order], order // STRIDE
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    times = np.diff(np.append(first, len(at)))
    by = np.argsort(-times, kind="stable")
    first, times = first[by], times[by]
    sums = np.zeros((len(first), rows.shape[1]), np.float32)
    for k in range(min(ROUNDS, int(times[0]))):
        more = np.searchsorted(-times, -k, "left")
        sums[:more] += rows[half[first[:more] + k]]
    for k in range(np.searchsorted(-times, -ROUNDS, "left")):
        for low in range(first[k] + ROUNDS, first[k] + times[k], HALVES_AT_ONCE):
            sums[k] += rows[half[low:min(low + HALVES_AT_ONCE, first[k] + times[k])]].sum(axis=0)
    total[at[first]] += sums


def _by_bucket(total: np.ndarray, weights: Weights) -> np.ndarray:
    out = np.zeros((TERM_BUCKETS, total.shape[1]))
    np.add.at(out, weights.term, total * weights.inverse[:, None])
    return out


def _stream_products(shared):
    """Each task's part of A' (A M), for the passages of the texts that it holds as streams."""
    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, weights = shared.value
        total = np.zeros((len(weights.term), m.shape[1]))
        for batch in batches:
            for row in range(batch.num_rows):
                add_products(total, m, weights, np.frombuffer(batch.column(1)[row].as_py(), "<i4"), np.frombuffer(batch.column(0)[row].as_py(), "<i8"))
        yield from as_blocks(_by_bucket(total, weights).ravel(), single=True)
    return multiply


def corpus_space(streams: DataFrame, weights: Weights, items: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Leading right singular vectors of all passages of the texts (ends, stream) and of the items."""
    spark = streams.sparkSession
    streams = streams.coalesce(2 * spark.sparkContext.defaultParallelism)  # each task sends a whole matrix, however few texts it has

    def product(m: np.ndarray) -> np.ndarray:
        m = m.astype(np.float32)
        shared = spark.sparkContext.broadcast((m, weights))
        out = sum_blocks(streams.mapInArrow(_stream_products(shared), "block int, data binary"), m.size).reshape(m.shape)
        shared.unpersist()
        own = np.zeros((len(weights.term), m.shape[1]))
        add_products(own, m, weights, *items)
        return out + _by_bucket(own, weights)
    return _leading(product)


def common_subsequence(masks: dict[str, int], size: int, words: Iterable[str]) -> int:
    """Length of the longest common subsequence, by one addition of ``size`` bits per word."""
    full = (1 << size) - 1
    rest = full
    for w in words:
        hit = rest & masks.get(w, 0)
        if hit:
            rest = ((rest + hit) | (rest - hit)) & full
    return size - rest.bit_count()


# --- reading -------------------------------------------------------------------


@dataclass
class Vocabulary:
    """Words of a block of items by number, and its items of scripts without spaces."""

    numbers: dict[str, int]
    unspaced: list[tuple[int, list[str]]]
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    @staticmethod
    def of(items: Items) -> Vocabulary:
        distinct = sorted({w for words in (*items.words, *items.answers) for w in words})
        return Vocabulary({w: n for n, w in enumerate(distinct)}, [(k, list(letters("".join(w)))) for k, w in enumerate(items.words) if is_unspaced(w)])

    def codes(self, words: list[str]) -> list[int]:
        """The number of a word; of a word of no item -1 less its bucket."""
        found = ((w, self.numbers.get(w)) for w in expressions(words))
        return [-1 - _hash(w, TERM_BUCKETS) if n is None else n for w, n in found]


def _reader(shared, key_type: pa.DataType):
    """Rows of a part of a task's documents: ``kind`` 0 with their ids, ends and numbers of known words (of others -1 less their bucket), and
    finds by letter; at the end ``kind`` 1 with document frequencies of all known words and of the buckets of others, and as last number the documents."""
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = shared.value
        known, size = len(vocabulary.numbers), len(vocabulary.numbers) + TERM_BUCKETS
        memory = kept_in_worker(("items", vocabulary.name), lambda: WordMemory(vocabulary.codes, 1, MEMORY_WORDS))
        by_letter = Halves(vocabulary.unspaced) if vocabulary.unspaced else None
        counts = np.zeros(size + 1)
        schema = pa.schema([("keys", pa.list_(key_type)), ("ends", pa.binary()), ("stream", pa.binary()), ("found", _FOUND), ("block", pa.int32()), ("data", pa.binary())])
        for batch in slices(batches, "text", TEXT_AT_ONCE):
            words, ends = split_words(batch.column(1))
            distinct, codes = encode_words(words)
            stream = memory.array(distinct)[:, 0][codes].astype(np.int32) if len(codes) else np.zeros(0, np.int32)
            doc = np.repeat(np.arange(len(ends) - 1, dtype=np.int64), np.diff(ends))
            counts[:-1] += np.bincount(np.unique(doc * size + places_of(stream, known)) % size, minlength=size)
            counts[-1] += len(ends) - 1
            found = [[] for _ in range(len(ends) - 1)]
            if by_letter:
                for d in range(len(ends) - 1):
                    found[d] = find_by_letter(by_letter, words.slice(int(ends[d]), int(ends[d + 1] - ends[d])).to_pylist())
            yield pa.RecordBatch.from_arrays([
                pa.array([batch.column(0).to_pylist()], pa.list_(key_type)), pa.array([ends.astype("<i8").tobytes()]), pa.array([stream.astype("<i4").tobytes()]),
                pa.array([[{"doc": d, "item": k, "share": s, "low": a, "high": b} for d, rows in enumerate(found) for k, s, a, b in rows]], _FOUND),
                pa.array([None], pa.int32()), pa.array([None], pa.binary())], schema=schema)
        for part in as_blocks(counts):
            n = part.num_rows
            yield pa.RecordBatch.from_arrays([pa.nulls(n, schema.field(c).type) for c in range(4)] + list(part.columns), schema=schema)
    return read


_FOUND = pa.list_(pa.struct([("doc", pa.int64()), ("item", pa.int64()), ("share", pa.float64()), ("low", pa.int64()), ("high", pa.int64())]))
FOUND_DDL = "array<struct<doc: bigint, item: bigint, share: double, low: bigint, high: bigint>>"


@dataclass
class Index:
    """What a task needs to search streams for a block of items."""

    items: Items
    answers: list[np.ndarray]
    codes: list[np.ndarray]        # numbers of each item's words
    weighted: np.ndarray           # place of a word -> its direction in the latent space, times its weight; zeros for words of no item
    known: int                     # words with a number
    pieces: np.ndarray             # directions x passages of items, unit length
    first_piece: np.ndarray        # item -> its first passage; one more at the end
    anchor_starts: np.ndarray      # word -> first place in anchor_items
    anchor_items: np.ndarray
    asked: np.ndarray              # item -> anchors it must have (0: not a long item)
    short: Halves = field(default=None)
    masks: dict = field(default_factory=dict)

    def mask(self, kind: str, k: int) -> tuple[dict[int, int], int]:
        """Bit positions of each word, for the longest common subsequence."""
        if (kind, k) not in self.masks:
            at: dict[int, int] = {}
            own = (self.codes if kind == "item" else self.answers)[k]
            for i, w in enumerate(own.tolist()):
                at[w] = at.get(w, 0) | 1 << i
            self.masks[kind, k] = at, len(own)
        return self.masks[kind, k]


def build_index(vocabulary: Vocabulary, df: np.ndarray, items: Items, streams: DataFrame) -> Index:
    """``df`` holds the document frequency of each known word and of the buckets of others, and as last number the documents.

    The latent space is that of all passages of the ``streams`` and of the items.
    """
    known = len(vocabulary.numbers)
    inverse = np.append(np.log((1 + df[-1]) / (1 + df[:-1])) + 0.01, 0.0)
    codes = [np.array([vocabulary.numbers[w] for w in words], np.int32) for words in items.words]
    answers = [np.array([vocabulary.numbers[w] for w in words], np.int32) for words in items.answers]
    weights = Weights(np.array([*(_hash(w, TERM_BUCKETS) for w in vocabulary.numbers), *range(TERM_BUCKETS), 0], np.int64), inverse, known)
    pieces_of, first = [], [0]
    anchors: list[tuple[int, int]] = []
    asked = np.zeros(len(codes), np.int64)
    for k, words in enumerate(items.words):
        if is_long(words):
            pieces_of += [codes[k][s:e] for s, e in windows(len(words))]
            needed = math.ceil(MIN_PARAPHRASE * len(words))
            asked[k] = min(ANCHORS, needed)
            # Of any ``needed`` of the item's words, ``asked`` are among its rarest len - needed + asked.
            rare = sorted(codes[k].tolist(), key=lambda w: (df[w], w))[:len(words) - needed + int(asked[k])]
            anchors += [(w, k) for w in set(rare)]
        first.append(len(pieces_of))
    anchors.sort()
    starts = np.searchsorted([w for w, _ in anchors], np.arange(known + 1))
    space = np.zeros((TERM_BUCKETS, 1), np.float32)
    pieces = np.zeros((1, 0), np.float32)
    if pieces_of:
        long = [codes[k] for k, words in enumerate(items.words) if is_long(words)]
        space = corpus_space(streams, weights, (np.concatenate(long), np.concatenate(([0], np.cumsum([len(c) for c in long])))))
    weighted = (space[weights.term] * inverse[:, None]).astype(np.float32)
    weighted[known:] = 0  # words of no item stand beside an item, not in it: a short one among many of them has to be found
    if pieces_of:
        pieces = np.stack([weighted[p].sum(axis=0) for p in pieces_of])
        pieces = (pieces / np.maximum(np.linalg.norm(pieces, axis=1, keepdims=True), 1e-9)).T.astype(np.float32).copy()
    short = Halves([(k, codes[k].tolist()) for k, words in enumerate(items.words) if not is_long(words) and not is_unspaced(words)])
    return Index(items, answers, codes, weighted, known, pieces, np.array(first), starts, np.array([k for _, k in anchors], np.int64), asked, short)


# --- search -------------------------------------------------------------------


def is_long(words: list[str]) -> bool:
    """Whether an item is projected; the others are looked up by halves."""
    return len(words) >= MIN_ITEM_WORDS and not is_unspaced(words)


def is_unspaced(words: list[str]) -> bool:
    joined = "".join(words)
    return 2 * len(UNSPACED.findall(joined)) > len(joined)


def letters(text: str) -> str:
    return "".join(ch for ch in text.lower() if ch.isalnum())


class Halves:
    """Items by their two halves, of which one is whole in a copy with one change."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.items = dict(items)
        self.starts: dict[int, dict[tuple[str, ...], list[tuple[int, int]]]] = {}  # by length: item and place of the half
        for k, signs in items:
            # A change in fewer than five signs leaves less than MIN_COPY of them.
            cut = len(signs) // 2 if len(signs) - 1 >= MIN_COPY * len(signs) else 0
            for a, b in ((0, cut), (cut, len(signs))):
                if b > a:
                    self.starts.setdefault(b - a, {}).setdefault(tuple(signs[a:b]), []).append((k, a))
        self.first = {half[0] for halves in self.starts.values() for half in halves}

    def find(self, signs: list[str]) -> dict[int, tuple[float, int, int]]:
        """Per item the largest share that runs through a window of its own length and one sign more at each end, and the window."""
        best: dict[int, tuple[float, int, int]] = {}
        for i in [i for i, sign in enumerate(signs) if sign in self.first] if self.first else []:
            for n, halves in self.starts.items():
                for k, place in halves.get(tuple(signs[i:i + n]), ()):
                    item = self.items[k]
                    if best.get(k, (0.0,))[0] == 1.0:
                        continue
                    low, high = max(0, i - place - 1), min(len(signs), i - place + len(item) + 1)
                    masks: dict[str, int] = {}
                    for j, sign in enumerate(item):
                        masks[sign] = masks.get(sign, 0) | 1 << j
                    share = common_subsequence(masks, len(item), signs[low:high]) / len(item)
                    if share >= MIN_COPY and share > best.get(k, (0.0,))[0]:
                        best[k] = share, low, high
        return best


def find_by_letter(halves: Halves, words: list[str]) -> list[tuple[int, float, int, int]]:
    """(item, share, first word, last word) of items of scripts without spaces."""
    spelled = [letters(w) for w in words]
    ends = np.cumsum([len(w) for w in spelled])
    return [(k, share, int(np.searchsorted(ends, low, "right")), int(np.searchsorted(ends, high - 1, "right")) + 1)
            for k, (share, low, high) in halves.find(list("".join(spelled))).items()]


def zones(index: Index, stream: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, first word, last word) of the stretches in which an item has its anchors, by item and place; they do not cross documents.

    Anchors that stand together within REACH times the item's length open a
    stretch of so many words on either side of them.
    """
    none = np.zeros(0, np.int64)
    places = np.flatnonzero(stream >= 0)
    word = stream[places]
    degree = index.anchor_starts[word + 1] - index.anchor_starts[word]
    places, word, degree = places[degree > 0], word[degree > 0], degree[degree > 0]
    if not len(places):
        return none, none, none
    at = np.arange(degree.sum()) - np.repeat(np.cumsum(degree) - degree, degree) + np.repeat(index.anchor_starts[word], degree)
    span = len(stream) + 1
    keys = np.sort(index.anchor_items[at] * span + np.repeat(places, degree))
    item, place = keys // span, keys % span
    doc = np.searchsorted(ends, place, "right") - 1
    reach = REACH * np.array([len(c) for c in index.codes])[item]
    opened = np.zeros(len(keys), bool)
    for asked in np.unique(index.asked[item]):
        last = np.arange(len(keys)) + asked - 1
        held = (index.asked[item] == asked) & (last < len(keys))
        last = np.minimum(last, len(keys) - 1)
        opened |= held & (item[last] == item) & (doc[last] == doc) & (place[last] - place <= reach)
    item, place, doc, reach = item[opened], place[opened], doc[opened], reach[opened]
    low, high = np.maximum(ends[doc], place - reach), np.minimum(ends[doc + 1], place + 2 * reach)
    if not len(item):
        return none, none, none
    fresh = np.concatenate(([True], (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (low[1:] > high[:-1])))
    first = np.flatnonzero(fresh)
    return item[first], low[first], np.maximum.reduceat(high, first)


def find_regions(index: Index, stream: np.ndarray, ends: np.ndarray) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """(document, item) and the runs of words in which candidates lie: passages near enough to one of the item's, and half a passage around them."""
    item, low, high = zones(index, stream, ends)
    if not len(item):
        return {}
    doc = np.searchsorted(ends, low, "right") - 1
    # Half windows are counted from the start of their document; a passage is one and the next.
    counts = -(-np.diff(ends) // STRIDE)
    base = np.cumsum(counts) - counts
    first = base[doc] + np.maximum(0, (low - ends[doc]) // STRIDE - 1)
    last = base[doc] + (high - 1 - ends[doc]) // STRIDE
    n = last - first + 1
    zone = np.repeat(np.arange(len(item)), n)
    half = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    needed, place = np.unique(np.concatenate([half, half + 1]), return_inverse=True)
    of = np.minimum(np.searchsorted(base, needed, "right") - 1, len(counts) - 1)
    begin = ends[of] + (needed - base[of]) * STRIDE
    near = np.zeros(len(half), bool)
    for at in range(0, len(half), PASSAGES_AT_ONCE * 8):
        part = slice(at, at + PASSAGES_AT_ONCE * 8)
        halves, local = np.unique(np.concatenate([place[:len(half)][part], place[len(half):][part]]), return_inverse=True)
        sums = _half_vectors(index, stream, begin[halves], np.minimum(begin[halves] + STRIDE, ends[of[halves] + 1]))
        k = len(half[part])
        other = of[halves[local[k:]]] == of[halves[local[:k]]]  # the next half belongs to the same document
        other &= needed[halves[local[k:]]] < base[of[halves[local[:k]]]] + counts[of[halves[local[:k]]]]
        vectors = sums[local[:k]] + np.where(other[:, None], sums[local[k:]], 0)
        norms = np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)
        own = item[zone[part]]
        most = int((index.first_piece[own + 1] - index.first_piece[own]).max())
        for step in range(most):  # an item has few passages
            piece = index.first_piece[own] + step
            there = piece < index.first_piece[own + 1]
            cosine = np.einsum("nd,nd->n", vectors[there], index.pieces.T[piece[there]]) / norms[there]
            near[at + np.flatnonzero(there)[cosine >= MIN_COSINE]] = True
    regions: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for z, h in zip(zone[near].tolist(), half[near].tolist()):
        d = int(doc[z])
        start = int(ends[d] + (h - base[d]) * STRIDE)
        a, b = max(int(ends[d]), start - STRIDE), min(int(ends[d + 1]), start + WINDOW + STRIDE)
        runs = regions.setdefault((d, int(item[z])), [])
        if runs and a <= runs[-1][1]:
            runs[-1] = min(a, runs[-1][0]), max(b, runs[-1][1])
        else:
            runs.append((a, b))
    return regions


def _half_vectors(index: Index, stream: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums of the weighted directions of the words from ``begin`` to ``end``."""
    out = np.empty((len(begin), index.weighted.shape[1]), np.float32)
    for s in range(0, len(begin), 256):  # a few at a time stay in the processor's cache
        at = begin[s:s + 256, None] + np.arange(STRIDE)
        word = places_of(stream[np.minimum(at, len(stream) - 1)], index.known)
        word = np.where(at < end[s:s + 256, None], word, -1)  # the last row, for no word, is 0
        out[s:s + 256] = index.weighted[word].sum(axis=1)
    return out


def _compare(index: Index, item: int, words: list[int]) -> tuple[float, float]:
    """Share of the item, and of its answer, that runs through the words in order."""
    out = []
    for kind in ("item", "answer"):
        masks, size = index.mask(kind, item)
        out.append(common_subsequence(masks, size, words) / size if size else 0.0)
    return out[0], out[1]


def _searcher(shared):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        starts = np.array(sorted(index.short.first), np.int32)
        for batch in batches:
            for row in range(batch.num_rows):
                keys, ends = batch.column(0)[row].values, np.frombuffer(batch.column(1)[row].as_py(), "<i8")
                stream = np.frombuffer(batch.column(2)[row].as_py(), "<i4")
                docs, found = [], []

                def add(doc: int, item: int, share: float, answer: float, low: int, high: int) -> None:
                    docs.append(doc)
                    found.append((index.items.ids[item], share, answer, low, high))

                for (doc, item), runs in find_regions(index, stream, ends).items():
                    best = max((*_compare(index, item, stream[low:high].tolist()), low - int(ends[doc]), high - int(ends[doc])) for low, high in runs)
                    if best[0] >= MIN_COPY or best[0] >= MIN_PARAPHRASE and best[1] >= MIN_ANSWER:
                        add(doc, item, *best)
                if len(starts):
                    hits = np.flatnonzero(np.isin(stream, starts))
                    for doc in np.unique(np.searchsorted(ends, hits, "right") - 1).tolist():
                        own = stream[ends[doc]:ends[doc + 1]].tolist()
                        for item, (share, low, high) in index.short.find(own).items():
                            add(doc, item, share, _compare(index, item, own[low:high])[1], low, high)
                for f in batch.column(3)[row].as_py() or ():
                    add(f["doc"], f["item"], f["share"], 0.0, f["low"], f["high"])
                columns = list(zip(*found)) if found else [()] * 5
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(docs, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()))]],
                                                 ["key", "item_id", "share", "answer", "first_word", "last_word"])
    return search


LEAK = "item_id long, share double, answer double, first_word long, last_word long"


def _found(rows: DataFrame, benchmark: DataFrame, item_key: str, item_text: str, answer: str | None) -> DataFrame:
    """(key, LEAK) of the rows (key, text), a row for each item found in a text."""
    spark, key_type = rows.sparkSession, rows.schema["key"].dataType.simpleString()
    out = None
    for items in item_blocks(benchmark, item_key, item_text, answer):
        vocabulary = Vocabulary.of(items)
        words = spark.sparkContext.broadcast(vocabulary)  # about BLOCK_WORDS words
        kind = pa.int64() if key_type == "bigint" else pa.string() if key_type == "string" else pa.int32()
        read = materialize(rows.mapInArrow(_reader(words, kind), f"keys array<{key_type}>, ends binary, stream binary, found {FOUND_DDL}, block int, data binary"), "leak-streams")
        df = sum_blocks(read.filter("block IS NOT NULL").select("block", "data"), len(vocabulary.numbers) + TERM_BUCKETS + 1)
        streams = read.filter("keys IS NOT NULL").select("keys", "ends", "stream", "found")
        shared = spark.sparkContext.broadcast(build_index(vocabulary, df, items, streams.select("ends", "stream")))
        found = materialize(streams.mapInArrow(_searcher(shared), f"key {key_type}, {LEAK}"), "leaks")
        words.unpersist()
        shared.unpersist()
        out = found if out is None else out.unionByName(found)
    if out is None:
        names = [f.split() for f in LEAK.split(", ")]
        out = rows.select("key", *[F.lit(None).cast(t).alias(n) for n, t in names]).limit(0)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", answer: str | None = None) -> DataFrame:
    """doc_id, item_id, share (of the item, in order), answer (share found), first_word, last_word: a row for each item found in a document.

    Every passage of every whole text is looked at; texts are not shuffled. A
    null or empty text leaks nothing; items without words, null ones included,
    cannot be found; items of fewer than MIN_ITEM_WORDS words and unspaced ones
    are found by MIN_COPY alone, within a window of their length; repeated items are each found; repeated
    rows are each listed. Empty tables give no leaks. The benchmark is the query set, in
    blocks of bounded size, one scan of the documents each. Ids are whole numbers or texts.
    """
    rows = docs.select(quoted(key).alias("key"), quoted(text).alias("text"))
    return _found(rows, benchmark, item_key, item_text, answer).withColumnRenamed("key", "doc_id")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **columns) -> DataFrame:
    """Columns of ``docs``, whatever their names, without the rows in whose text an item is found.

    What is found depends on the text alone, so rows are told by a digest of it.
    """
    mark, = free_names(docs, "_text")
    digest = F.md5(F.coalesce(quoted(text), F.lit("")).cast("binary"))
    found = _found(docs.select(digest.alias("key"), quoted(text).alias("text")), benchmark, **{"item_key": "item_id", "item_text": "text", "answer": None, **columns})
    bad = materialize(found.select(F.col("key").alias(mark)).distinct(), "leaking-texts")
    return join_small(docs.withColumn(mark, digest), bad, [mark], "left_anti").select(*[quoted(c) for c in docs.columns])


__all__ = ["drop_leaks", "latent_space", "leaks"]
