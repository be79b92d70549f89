"""Ranked lexical search by bag deduplication.

A document matters to the items only by how often each term of theirs occurs
in it (its bag) and by m, which stands for its length. Documents with equal
bag and m form a class: rows are brought together by a hash of both, and told
apart by the bag itself. A class is scored once; the classes that can reach
an item's list are then expanded into their members by ascending id.

A bag is bytes: one for the width of a term's number, one for the width of a
count, then the numbers in ascending order, then the counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairwright.llm.common import as_blocks, join_small, materialize, slices, split_words, sum_blocks

# A term is a run of ASCII letters and digits, and of all signs beyond ASCII; only A-Z is lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = 20
# Items are searched in blocks of about so many distinct terms and items, which is what is broadcast.
BLOCK_TERMS, BLOCK_ITEMS = 400_000, 4_000
# Classes scored at once; a term of more items than HEAVY is scored by a matrix product.
CLASSES_AT_ONCE, HEAVY = 256, 8
# Selected classes are broadcast up to so many.
BROADCAST_CLASSES = 20_000
# Floating numbers hold whole ones exactly below this.
EXACT = 2.0 ** 53

_SIGNS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def split_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts, and where each text's terms start and end."""
    texts = pc.fill_null(texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts)))), "")
    _, offsets, data = texts.buffers()
    plain = pa.py_buffer((data.to_pybytes() if data is not None else b"").translate(_SIGNS))
    return split_words(pa.LargeStringArray.from_buffers(len(texts), offsets, plain))


def pack_bag(codes: np.ndarray, counts: np.ndarray) -> bytes:
    wide = [1 if len(x) and x.max() >= 65_536 else 0 for x in (codes, counts)]
    return bytes(wide) + b"".join(x.astype("<u4" if w else "<u2").tobytes() for x, w in zip((codes, counts), wide))


def unpack_bags(bags: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term numbers and counts of all bags in a row, and the ends of bags."""
    codes, counts, sizes = [], [], []
    for bag in bags:
        first, second = ("<u4" if w else "<u2" for w in bag[:2])
        n = (len(bag) - 2) // (np.dtype(first).itemsize + np.dtype(second).itemsize)
        codes.append(np.frombuffer(bag, first, n, 2))
        counts.append(np.frombuffer(bag, second, n, 2 + n * np.dtype(first).itemsize))
        sizes.append(n)
    flat = [np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (codes, counts)]
    return flat[0], flat[1], np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def _bags(shared):
    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(shared.value, pa.large_string())
        size = max(1, len(vocabulary))
        for batch in slices(batches, "text"):
            words, ends = split_terms(batch.column(1))
            code = pc.fill_null(pc.index_in(words, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            known = code >= 0
            pairs, counts = np.unique(doc[known] * size + code[known], return_counts=True)
            at = np.searchsorted(pairs // size, np.arange(len(ends)))
            bags = [pack_bag(pairs[s:e] % size, counts[s:e]) if e > s else None for s, e in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends)), pa.array(bags, pa.binary())], ["doc_id", "n", "bag"])
    return make


def _document_frequencies(size: int):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            codes, _, _ = unpack_bags(batch.column(0).to_pylist())
            total += np.bincount(codes, minlength=size)
        yield from as_blocks(total)
    return count


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass
class Queries:
    """Terms' weights by item: for each term its items and weight times repeats; terms of many items as a matrix."""

    items: np.ndarray     # the item's number in the table
    starts: np.ndarray    # term -> first place in owners
    owners: np.ndarray    # place of the item
    weights: np.ndarray
    heavy: np.ndarray     # term -> row of the matrix, or -1
    matrix: np.ndarray


def build_queries(terms: np.ndarray, items: np.ndarray, weights: np.ndarray, size: int) -> Queries:
    """From rows (term, item, weight times repeats); ``size`` terms in all."""
    distinct, place = np.unique(items, return_inverse=True)
    # A count's share is below a million, so a score is below a million times the item's weights.
    exact = np.float64 if len(weights) == 0 or 1e6 * np.bincount(place, weights).max() < EXACT else np.int64
    order = np.lexsort((place, terms))
    terms, place, weights = terms[order], place[order], weights[order].astype(exact)
    starts = np.searchsorted(terms, np.arange(size + 1))
    often = np.flatnonzero(np.diff(starts) > HEAVY)
    heavy = np.full(size, -1)
    heavy[often] = np.arange(len(often))
    matrix = np.zeros((len(often), len(distinct)), exact)
    for row, t in enumerate(often):
        matrix[row, place[starts[t]:starts[t + 1]]] = weights[starts[t]:starts[t + 1]]
    return Queries(distinct, starts, place, weights, heavy, matrix)


def class_scores(queries: Queries, codes: np.ndarray, counts: np.ndarray, ends: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores (classes x items), whole numbers."""
    n, kind = len(ends) - 1, queries.matrix.dtype
    row = np.repeat(np.arange(n), np.diff(ends))
    share = (1_000_000_000 * counts) // (1000 * counts + 12 * m[row])
    heavy = queries.heavy[codes]
    dense = np.zeros((n, len(queries.matrix)), kind)
    often = heavy >= 0
    dense[row[often], heavy[often]] = share[often]
    out = dense @ queries.matrix
    few = ~often
    first, degree = queries.starts[codes[few]], queries.starts[codes[few] + 1] - queries.starts[codes[few]]
    at = np.arange(degree.sum()) - np.repeat(np.cumsum(degree) - degree, degree) + np.repeat(first, degree)
    cell = np.repeat(row[few], degree) * len(queries.items) + queries.owners[at]
    np.add.at(out.reshape(-1), cell, np.repeat(share[few].astype(kind), degree) * queries.weights[at])
    return out


def best_rows(item: np.ndarray, score: np.ndarray, last: np.ndarray, first: np.ndarray, top: int) -> np.ndarray:
    """Rows among the ``top`` of their item by falling score, then ascending first id (null ids last)."""
    order = np.lexsort((first, last, -score, item))
    starts = np.flatnonzero(np.concatenate(([True], item[order][1:] != item[order][:-1]))) if len(order) else np.zeros(0, np.int64)
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[place < top]


def _ranker(shared, top: int):
    """Each task's best classes of every item; no other class can hold one of an item's best documents.

    A class ranks by score, then by its smallest id. Each class above another
    has a member that comes before all members of the lower one, so a class
    with ``top`` classes above it gives nothing.
    """
    def rank(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        items = len(queries.items)
        least = np.ones(items, queries.matrix.dtype)  # the score an item's list asks for
        held = [np.zeros(0, np.int64) for _ in range(5)]  # item, score, null id, first id, class
        waiting, fresh = [held], 0

        def merged() -> list[np.ndarray]:
            columns = [np.concatenate(x) for x in zip(*waiting)]
            keep = best_rows(*columns[:4], top)
            return [c[keep] for c in columns]

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            m = batch.column(2).to_numpy(zero_copy_only=False)
            first = pc.fill_null(batch.column(3), 0).to_numpy(zero_copy_only=False)
            last = np.asarray(batch.column(3).is_null()).astype(np.int64)
            for at in range(0, batch.num_rows, CLASSES_AT_ONCE):
                part = slice(at, at + CLASSES_AT_ONCE)
                codes, counts, ends = unpack_bags(batch.column(1).slice(at, CLASSES_AT_ONCE).to_pylist())
                scores = class_scores(queries, codes, counts, ends, m[part])
                row, item = np.nonzero(scores >= least)
                waiting.append([item, scores[row, item].astype(np.int64), last[part][row], first[part][row], ids[part][row]])
                fresh += len(row)
                if fresh > 4 * top * items:
                    held = merged()
                    waiting, fresh = [held], 0
                    full = np.bincount(held[0], minlength=items) >= top
                    lowest = np.full(items, np.iinfo(np.int64).max)
                    np.minimum.at(lowest, held[0], held[1])
                    least = np.where(full, lowest, 1).astype(queries.matrix.dtype)
        held = merged()
        yield pa.RecordBatch.from_arrays([pa.array(queries.items[held[0]]), pa.array(held[1]), pa.array(held[3], mask=held[2] == 1), pa.array(held[4])], ["item", "score", "first_id", "class"])
    return rank


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` documents with a score above 0.

    Every row of ``benchmark`` is an item of its own, also a repeated one and
    one with a null id; an item without terms finds nothing. Every row of
    ``docs`` is a document; equal ids stay separate, null ids come last among
    equal scores. A null or empty text has no term and is not counted in N. A
    term's weight needs the counts of all documents; empty tables give no rows.

    The items are the query set: blocks of them are broadcast, one scan of
    the documents each. Documents are shuffled once, as bags, and copies are
    merged before the shuffle; a large class adds no work to one task,
    because of its members only the ``top`` smallest ids go on, also before
    the shuffle.
    """
    items = materialize(benchmark.select(F.col(item_key).alias("item_id"), F.col(item_text).alias("text")).withColumn("item", F.monotonically_increasing_id()), "search-items")
    words = materialize(items.select("item", F.explode(_terms(F.col("text"))).alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("repeats")), "search-terms")
    size = words.agg(F.count(F.lit(1)).alias("terms"), F.countDistinct("item").alias("items")).first()
    blocks = max(1, -(-size["terms"] // BLOCK_TERMS), -(-size["items"] // BLOCK_ITEMS))
    found = None
    for block in range(blocks):
        part = words.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow()
        if not part.num_rows:
            continue
        one = _search_block(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), part, top)
        found = one if found is None else found.unionByName(one)
    if found is None:  # no item has a term
        return items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast(docs.schema[key].dataType).alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    ids = items.select("item", "item_id")
    return join_small(found, ids, ["item"], "inner").select("item_id", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, words: pa.Table, top: int) -> DataFrame:
    """item, rank, doc_id, score for the items of one block (item, term, repeats)."""
    spark = docs.sparkSession
    vocabulary = sorted(set(words["term"].to_pylist()))
    number = {t: i for i, t in enumerate(vocabulary)}
    code = np.array([number[t] for t in words["term"].to_pylist()], np.int64)
    shared = spark.sparkContext.broadcast(vocabulary)  # BLOCK_TERMS terms
    every = materialize(docs.mapInArrow(_bags(shared), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, bag binary"), "search-bags")
    rows = every.filter("bag IS NOT NULL")
    total = every.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("length")).first()
    documents, length = total["documents"], total["length"] or 0
    df = sum_blocks(rows.select("bag").mapInArrow(_document_frequencies(len(vocabulary)), "block int, data binary"), len(vocabulary)).astype(np.int64)
    weights = np.array([term_weight(documents, int(n)) for n in df], np.int64)
    queries = spark.sparkContext.broadcast(build_queries(code, words["item"].to_numpy(), weights[code] * words["repeats"].to_numpy(), len(vocabulary)))

    m = F.lit(75).cast("long") + F.expr(f"(25 * n * {documents}L) div {max(1, length)}L")
    hashed = rows.select("doc_id", "bag", m.alias("m")).withColumn("hash", F.xxhash64("bag", "m"))
    # Equal hashes bring rows together; equal bags and m make them a class.
    grouped = hashed.groupBy("hash", "m", "bag").agg(F.min("doc_id").alias("first_id"))
    classes = materialize(grouped.withColumn("class", F.monotonically_increasing_id()), "search-classes")
    best = classes.select("class", "bag", "m", F.col("first_id").cast("long")).mapInArrow(_ranker(queries, top), "item long, score long, first_id long, class long")
    of_item = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("first_id").asc_nulls_last(), "class")
    chosen = materialize(best.withColumn("place", F.row_number().over(of_item)).filter(F.col("place") <= top).select("item", "score", "class"), "search-chosen")

    wanted = materialize(join_small(classes, chosen.select("class").distinct(), ["class"], "left_semi"), "search-wanted").select("class", "hash", "m", "bag")
    members = join_small(hashed, wanted, ["hash", "m", "bag"], "inner", BROADCAST_CLASSES)
    in_class = Window.partitionBy("class").orderBy(F.col("doc_id").asc_nulls_last())
    firsts = materialize(members.select("class", "doc_id").withColumn("place", F.row_number().over(in_class)).filter(F.col("place") <= top), "search-members")
    final = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    listed = chosen.join(firsts, "class").select("item", "score", "doc_id").withColumn("rank", F.row_number().over(final))
    return listed.filter(F.col("rank") <= top).select("item", "rank", "doc_id", "score")
