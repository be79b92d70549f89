"""Word splitting in Arrow, block sums of model arrays, size-checked joins."""

from __future__ import annotations

import ctypes
import gc
import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.plans.storage import materialize

# A word is a run of characters other than the six ASCII white-space ones.
WORD = r"[^\x20\x09-\x0D]+"
# Text held by one step of a task, unless a single text is larger.
SLICE_BYTES = 4_000_000
# Bytes of a batch that goes to a worker of the pipeline; more of them would only wait in memory.
BATCH_BYTES = "4m"
# Rows of a small table that may be broadcast after they were counted.
BROADCAST_ROWS = 50_000
# Model arrays travel in blocks of this many numbers.
BLOCK = 16_384


def short_batches(spark) -> None:
    """From here on the session's batches to workers hold BATCH_BYTES, unless its own setting says less or more."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in dict(spark.sparkContext.getConf().getAll()):
        spark.conf.set(name, BATCH_BYTES)


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a piece holds about ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if len(sizes) > start:
            yield batch.slice(start)


def split_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and where each text's words start and end.

    A null text has no words. ``lower`` lower-cases A-Z only.
    """
    # take() makes a copy that starts at byte 0; ascii_lower goes wrong on a part of a larger array.
    texts = pc.fill_null(texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts)))), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    ends = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    words = lists.flatten()
    full = np.asarray(pc.greater(pc.binary_length(words), 0))
    if not full.all():  # a leading or trailing blank gives an empty piece
        words = words.filter(pa.array(full))
        ends = np.concatenate(([0], np.cumsum(full)))[ends]
    return words, ends.astype(np.int64)


def encode_words(words: pa.Array) -> tuple[list[str], np.ndarray]:
    """Distinct words, and each word's place among them."""
    coded = words.dictionary_encode()
    return coded.dictionary.to_pylist(), np.asarray(coded.indices, dtype=np.int64)


def per_text(ufunc: np.ufunc, values: np.ndarray, ends: np.ndarray, empty: float = 0.0) -> np.ndarray:
    """``ufunc`` over the values of each text; ``empty`` for a text without any."""
    out = np.full((len(ends) - 1, *values.shape[1:]), empty, dtype=values.dtype)
    some = ends[1:] > ends[:-1]
    if some.any():
        out[some] = ufunc.reduceat(values, ends[:-1][some], axis=0)
    return out


_KEPT: list = [None, None]


def _give_back() -> None:
    """Return freed memory to the system: a worker process outlives the work that needed it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def kept_in_worker(owner: object, make):
    """What a worker process keeps for later tasks of ``owner``. It keeps one thing only: another owner's is dropped."""
    if _KEPT[0] != owner:
        _KEPT[:] = [None, None]
        _give_back()
        _KEPT[:] = [owner, make()]
    return _KEPT[1]


class WordMemory:
    """A row of whole numbers for each word, worked out once by a worker and packed in one table.

    ``of`` gives the rows of a list of words. What is remembered stays, as
    frequent words come early; beyond ``limit`` words others are worked out again
    for each part of a text.
    """

    def __init__(self, of, width: int, limit: int = 200_000):
        self.of, self.limit, self.places = of, limit, {}
        self.table = np.zeros((1024, width), np.int32)

    def array(self, words: list[str]) -> np.ndarray:
        places = self.places
        at = np.fromiter((places.get(w, -1) for w in words), np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        if not len(missing):
            return self.table[at]
        new = [words[k] for k in missing]
        rows = np.asarray(self.of(new), np.int32).reshape(len(new), -1)
        out = self.table[np.maximum(at, 0)]
        out[missing] = rows
        kept = min(len(new), self.limit - len(places))
        if kept > 0:
            start = len(places)
            while start + kept > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[start:start + kept] = rows[:kept]
            places.update(zip(new[:kept], range(start, start + kept)))
        return out


def crc_fold(key: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def as_blocks(flat: np.ndarray, single: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows (block, data) of a flat float array, without blocks of zeros; ``single`` sends 4 bytes a number."""
    blocks, data = [], []
    for k in range(math.ceil(len(flat) / BLOCK)):
        part = flat[k * BLOCK:(k + 1) * BLOCK]
        if part.any():
            blocks.append(k)
            data.append(np.pad(part, (0, BLOCK - len(part))).astype("<f4" if single else "<f8").tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(data, pa.binary())], ["block", "data"])


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<f4" if len(data) == 4 * BLOCK else "<f8").astype(np.float64)


def _add_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sums[k] = sums[k] + _numbers(data) if k in sums else _numbers(data)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["block", "data"])


def sum_blocks(parts: DataFrame, size: int) -> np.ndarray:
    """Sum arrays that tasks emitted by ``as_blocks``; ``size`` numbers come to the driver.

    Blocks are added in two shuffled steps, so that no task reads one block
    from every other task; each step holds one running sum per block. The
    order of additions, and so the last bits, may differ between runs: round
    where that matters.
    """
    n_blocks = math.ceil(size / BLOCK)
    salted = parts.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(16)))
    first = salted.repartition(min(16 * n_blocks, 64), "block", "_salt").select("block", "data").mapInArrow(_add_blocks, "block int, data binary")
    last = first.repartition(min(n_blocks, 32), "block").mapInArrow(_add_blocks, "block int, data binary")
    out = np.zeros(n_blocks * BLOCK)
    for row in last.collect():
        out[row["block"] * BLOCK:(row["block"] + 1) * BLOCK] = _numbers(row["data"])
    return out[:size]


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that ``df`` does not have: the wanted ones, with underscores put before them as needed."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str, of: DataFrame | None = None) -> Column:
    """A column by its exact name, whatever signs it has; ``of`` says of which table."""
    exact = "`" + name.replace("`", "``") + "`"
    return F.col(exact) if of is None else of[exact]


def schema_text(df: DataFrame) -> str:
    """The columns of ``df`` as mapInArrow wants its result described."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)


def join_small(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a table that is already written; it is broadcast only if a count shows it small."""
    if small.limit(rows + 1).count() <= rows:
        small = F.broadcast(small)
    on = None
    for k in keys:
        same = big[k].eqNullSafe(small[k])
        on = same if on is None else on & same
    if how in ("left_semi", "left_anti"):
        return big.join(small, on, how)
    return big.join(small, on, how).select(*[big[c] for c in big.columns], *[small[c] for c in small.columns if c not in keys])


__all__ = ["BLOCK", "BROADCAST_ROWS", "SLICE_BYTES", "WORD", "WordMemory", "as_blocks", "crc_fold", "encode_words", "free_names", "join_small", "materialize",
           "per_text", "quoted", "schema_text", "slices", "split_words", "sum_blocks"]
