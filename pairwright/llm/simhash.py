"""SimHash near duplicates, with pigeonring filtering of candidates."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.llm.common import free_names, materialize, quoted, schema_text, slices, split_words
from pairwright.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
# Fingerprints of 64 bits link at so many differing bits or fewer.
MAX_BITS = 3
# The ring: four segments of 16 bits, segment 0 the lowest.
SEGMENTS, WIDTH = 4, 16
MASK = (1 << WIDTH) - 1
# Set bits are counted for so many shingles at once (64 bytes each).
SHINGLES_AT_ONCE = 500_000


def _hashes(words: list[str]) -> list[int]:
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE_WORDS:
        return [digest(" ".join(words), SEED)] if words else []
    return [digest(f"{a} {b} {c}", SEED) for a, b, c in zip(words, words[1:], words[2:])]


def fingerprint(words: list[str]) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; 0 without words."""
    hashes = np.array(_hashes(words), dtype="<u8")
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = hashes[at:at + SHINGLES_AT_ONCE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(text: str, name: str):
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            words, ends = split_words(batch.column(batch.schema.get_field_index(text)), lower=True)
            words = words.to_pylist()
            prints = np.array([fingerprint(words[s:e]) for s, e in zip(ends[:-1], ends[1:])], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints)], names=[*batch.schema.names, name])
    return add


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "_fp") -> DataFrame:
    """Add ``name``, the fingerprint of ``text`` as a signed number, to the columns of ``docs``."""
    return docs.mapInArrow(_fingerprints(text, name), f"{schema_text(docs)}, {name} long")


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * (i % SEGMENTS)).bitwiseAND(F.lit(MASK))


def _key(start: int, first: Column, second: Column) -> Column:
    return F.lit(start << (2 * WIDTH)).cast("long") + F.shiftleft(first, WIDTH) + second


def linked_fingerprints(prints: DataFrame) -> DataFrame:
    """Pairs (u, v), u < v, of distinct fingerprints ``_fp`` at most MAX_BITS bits apart; none is missed.

    Pigeonring principle: with the differing bits of the segments placed on a
    ring of m = 4, some segment starts a chain in which the first l segments
    together differ in at most l * MAX_BITS / m bits, for every l. So for
    some start the first segment is equal, the first two differ in at most 1
    bit, three in at most 2. A pair is looked up by that chain of two (32 bits: equal
    first, second with none or one bit flipped), and dropped unless the chain
    of three keeps its budget too; the full distance is checked last. 32-bit
    keys keep candidates few as the number of texts grows; keys are spread by
    hash, and large ones are split by adaptive execution.
    """
    fp = F.col("_fp")
    own = prints.select(fp.alias("v"), F.explode(F.array(*[_key(i, _segment(fp, i), _segment(fp, i + 1)) for i in range(SEGMENTS)])).alias("key"))
    flips = [0, *[1 << b for b in range(WIDTH)]]
    probes = prints.select(fp.alias("u"), F.explode(F.array(
        *[_key(i, _segment(fp, i), _segment(fp, i + 1).bitwiseXOR(F.lit(x))) for i in range(SEGMENTS) for x in flips])).alias("key"))
    differ = F.col("u").bitwiseXOR(F.col("v"))
    start = F.shiftrightunsigned("key", 2 * WIDTH).cast("int")
    three = [sum((F.bit_count(_segment(differ, i + k)) for k in range(3)), F.lit(0)) for i in range(SEGMENTS)]
    in_budget = F.coalesce(*[F.when(start == i, x) for i, x in enumerate(three)]) <= 3 * MAX_BITS // SEGMENTS
    candidates = probes.join(own, "key").filter((F.col("u") < F.col("v")) & in_budget)
    return candidates.filter(F.bit_count(differ) <= MAX_BITS).select("u", "v").distinct()


def fingerprint_classes(prints: DataFrame) -> DataFrame:
    """(_fp, _root) for the fingerprints that link to another one."""
    edges = linked_fingerprints(prints)
    return components(edges).select(F.col("node").alias("_fp"), F.col("root").alias("_root"))


def near_duplicate_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id, a row for each row of ``docs``.

    Copies share a fingerprint, so links are sought between distinct
    fingerprints only. component_id is the smallest id that can be reached;
    null ids count as larger than all others, and a class of null ids alone has a null
    component. A null or empty text has fingerprint zero. Rows with equal ids
    stay separate rows.
    """
    rows = materialize(with_fingerprint(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "_fp"), "fingerprints")
    prints = materialize(rows.groupBy("_fp").agg(F.min("doc_id").alias("_least")), "distinct-fingerprints")
    linked = materialize(fingerprint_classes(prints.select("_fp")), "fingerprint-classes")
    least = prints.join(linked, "_fp").groupBy("_root").agg(F.min("_least").alias("_first"))
    of_linked = linked.join(least, "_root").select("_fp", "_first")
    firsts = prints.join(of_linked, "_fp", "left").select("_fp", F.coalesce("_first", "_least").alias("component_id"))
    return rows.join(firsts, "_fp").select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns of ``docs``; of each class the row with the smallest id stays, whole rows included.

    Among rows with the same id any one stays (the first as read); null ids come last. Columns may have any names.
    """
    fp, row = free_names(docs, "_fp", "_row")
    rows = materialize(with_fingerprint(docs, text, fp).withColumn(row, F.monotonically_increasing_id()), "fingerprinted")
    own = rows.select(F.col(fp).alias("_fp"), F.struct(quoted(key).isNull().alias("n"), quoted(key).alias("k"), F.col(row).alias("r")).alias("rank"))
    prints = materialize(own.groupBy("_fp").agg(F.min("rank").alias("_best")), "distinct-fingerprints")
    linked = materialize(fingerprint_classes(prints.select("_fp")), "fingerprint-classes")
    best = prints.join(linked, "_fp", "left").groupBy(F.coalesce("_root", "_fp").alias("_class")).agg(F.min("_best").alias("_best"))
    kept = materialize(best.select(F.col("_best.r").alias(row)), "kept-rows")
    return rows.join(kept, row, "left_semi").select(*[quoted(c) for c in docs.columns])
