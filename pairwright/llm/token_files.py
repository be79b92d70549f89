"""Token ids in bit-packed files: every id takes the fewest bits that hold the vocabulary.

File format: a Parquet table with a row for each block of whole documents.

* ``shard``, ``block``: place in the order of ``doc_id``; shards are written by
  one task each and cover ranges of ``doc_id``.
* ``first``: ids of the shard before this block; ``n_ids``: ids in the block.
* ``bits``: width of an id. Id i of the block is stored little-endian in bits
  ``i * bits`` to ``(i + 1) * bits - 1`` of ``payload``.
* ``doc_ids``, ``doc_ends``: the block's documents, and where each ends (in ids).

A document is found by its shard, block and end, and unpacked alone.
"""

from __future__ import annotations

import os
import zlib
from collections import ChainMap
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairwright.llm.common import encode_words, kept_in_worker, slices, split_words
from pairwright.plans.storage import new_path

FORMAT = ("shard int, block int, first long, n_ids long, bits int, doc_ids array<long>, doc_ends array<long>, payload binary")
# A block is closed when it holds this many ids; one document is never cut.
IDS_PER_BLOCK = 65_536
# Distinct runs of letters whose ids a worker remembers.
CACHED_WORDS = 400_000
# Text encoded at once; a larger part has fewer distinct words for its size.
TEXT_AT_ONCE = 6_000_000
# Closing marks that the tokenizer splits from letters.
MARKS = ".,!?;:"
# The sign by which the vocabulary marks the last piece of a word.
WORD_END = "</w>"


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Fixed-width packing, little-endian bit order."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError("an id does not fit the width")
    # Eight ids fill ``bits`` bytes; each id is added to the bytes it touches.
    rows = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    rows.ravel()[:len(ids)] = ids
    out = np.zeros((len(rows), bits + 4), np.uint8)
    for k in range(8):
        value = rows[:, k] << np.uint64(k * bits & 7)
        for j in range((bits + 14) // 8):
            out[:, (k * bits >> 3) + j] |= ((value >> np.uint64(8 * j)) & np.uint64(255)).astype(np.uint8)
    return out[:, :bits].tobytes()[:-(-len(ids) * bits // 8)]


def unpack(payload: bytes, bits: int, start: int, end: int) -> np.ndarray:
    """Ids ``start`` to ``end`` of a block, without touching the others."""
    at = np.arange(start, end, dtype=np.int64) * bits
    raw = np.frombuffer(payload, np.uint8)
    byte, out = at >> 3, np.zeros(end - start, np.uint64)
    for k in range((bits + 14) // 8):  # an id touches at most so many bytes
        out |= raw[np.minimum(byte + k, len(raw) - 1)].astype(np.uint64) << np.uint64(8 * k)
    return ((out >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


class WordEncoder:
    """Encodes texts through their distinct words.

    Valid for tokenizers that drop white space, lower-case, and split letters
    from marks, which is tested for the given file: the ids of a text are
    then those of its words in order, and those of a word that ends in a mark
    are those of its letters and of the mark. So the library encodes each
    distinct run of letters once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # Place of each run of letters or mark that is remembered; ids of place k are flat[ends[k]:ends[k + 1]].
        self.places: dict[str, int] = {}
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
        words = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(words.values()) + 1, bool)
        self.ends_word[[i for w, i in words.items() if w.endswith(WORD_END)]] = True

    def _encode_letters(self, cores: list[str]) -> list[tuple[int, ...]]:
        """Ids of runs of letters: many are encoded as one text, and cut after each id that ends a word."""
        lines = [" ".join(cores[k:k + 500]) for k in range(0, len(cores), 500)]
        ids = [i for e in self.tokenizer.encode_batch(lines, add_special_tokens=False) for i in e.ids]
        ends = (np.flatnonzero(self.ends_word[ids]) + 1).tolist() if ids else []
        if len(ends) != len(cores):
            raise ValueError("the tokenizer does not end each run of letters with one id that ends a word")
        return [tuple(ids[a:b]) for a, b in zip([0, *ends], ends)]

    @staticmethod
    def _parts(word: str) -> tuple[str, str, bool]:
        """Letters and closing mark; other words stay whole. Letters up to Latin Extended have one lower-case form."""
        core, mark = (word[:-1], word[-1]) if word[-1] in MARKS else (word, "")
        if core.isalpha() and (core.isascii() or max(core) < "\u0250" and "\u0130" not in core):
            return core.lower(), mark, True
        return word, "", False

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in a row, and where each word's ids start and end."""
        parts = [self._parts(w) for w in words]
        places = self.places
        letters = list({c for c, _, plain in parts if plain and c not in places})
        others = list({x for c, m, plain in parts for x in ((m,) if plain else (c,)) if x and x not in places})
        coded = self._encode_letters(letters) + [tuple(e.ids) for e in self.tokenizer.encode_batch(others, add_special_tokens=False)]
        new = dict(zip(chain(letters, others), range(len(places), len(places) + len(coded))))
        flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(coded), np.int32)])
        ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(x) for x in coded], dtype=np.int64)])
        if len(places) + len(new) <= CACHED_WORDS:
            places.update(new)
            self.flat, self.ends = flat, ends
        else:  # what is remembered stays: frequent words come early
            places = ChainMap(new, places)
        # Letters and mark of each word side by side; a word without a mark has no ids there.
        at = np.fromiter((places[x] if x else -1 for c, m, _ in parts for x in (c, m)), np.int64, 2 * len(parts))
        sizes = np.where(at >= 0, ends[at + 1] - ends[at], 0)
        stops = np.concatenate(([0], np.cumsum(sizes)))
        return flat[np.arange(stops[-1]) + np.repeat(ends[at] - stops[:-1], sizes)], stops[::2]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids start and end."""
        words, word_ends = split_words(texts)
        distinct, codes = encode_words(words)
        if not len(codes):
            return np.zeros(0, np.int32), np.zeros(len(word_ends), np.int64)
        flat, ends = self._ids(distinct)
        ends = ends.astype(np.int32)
        sizes = np.diff(ends)[codes]
        id_ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        places = np.arange(id_ends[-1], dtype=np.int32) + np.repeat(ends[codes] - id_ends[:-1].astype(np.int32), sizes)
        return flat[places], id_ends[word_ends]


def encoder(path: str) -> WordEncoder:
    """One encoder for the tasks of a worker process."""
    return kept_in_worker(("encoder", path), lambda: WordEncoder(path))


def _writer(path: str, end_id: int, ids_per_block: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, coder = TaskContext.get().partitionId(), encoder(path)
        bits = bits_for(coder.tokenizer.get_vocab_size(with_added_tokens=True))
        names = [f.split()[0] for f in FORMAT.split(", ")]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        docs: list[int | None] = []
        parts: list[np.ndarray] = []
        held = first = block = 0

        def close():
            values = [shard, block, first, held, bits, docs, np.cumsum([len(p) for p in parts]).tolist(), pack(np.concatenate(parts), bits)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

        for batch in slices(batches, "text", TEXT_AT_ONCE):
            ids, ends = coder.encode(batch.column(1))
            for doc, s, e in zip(batch.column(0).to_pylist(), ends[:-1], ends[1:]):
                docs.append(doc)
                parts.append(np.append(ids[s:e], end_id))
                held += int(e - s) + 1
                if held >= ids_per_block:
                    yield close()
                    first, block, docs, parts, held = first + held, block + 1, [], [], 0
        if docs:
            yield close()
    return write


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, path: str, key: str = "doc_id", text: str = "text",
                      ids_per_block: int = IDS_PER_BLOCK) -> None:
    """Encode all texts and write the format above, in ascending order of ``key``.

    A null text is empty and gives the end id alone; a null key comes first;
    rows with equal keys are all written, ordered by a hash of their text. An
    empty table gives an empty file set. A task sorts and encodes one range of
    keys; it holds a few megabytes of text and one block. ``tokenizer_path``
    must exist on every executor.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", tie)
    ordered.mapInArrow(_writer(tokenizer_path, end_id, ids_per_block), FORMAT).write.parquet(path)


def _reader(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row["payload"], row["bits"], 0, row["n_ids"]).astype("<u4")
            ends = np.array([0, *row["doc_ends"]])
            crcs = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([
                pa.array(row["doc_ids"], pa.int64()), pa.array([row["shard"]] * len(crcs), pa.int32()),
                pa.array(row["first"] + ends[:-1], pa.int64()), pa.array(np.diff(ends), pa.int64()), pa.array(crcs, pa.int64())],
                ["doc_id", "shard", "at", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FORMAT).parquet(path)


def shard_starts(files: DataFrame) -> DataFrame:
    """(shard, before): ids in all earlier shards. One row per shard, that is per task that wrote."""
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("n"), F.min(F.coalesce(F.element_at("doc_ids", 1), F.lit(-2**63))).alias("low"))
    before = Window.orderBy("low", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def token_digest(files: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    docs = files.mapInArrow(_reader, "doc_id long, shard int, at long, n_tokens long, ids_crc32 long")
    starts = F.broadcast(shard_starts(files))  # a row per shard, of 12 bytes
    return docs.join(starts, "shard").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _document_reader(doc_id: int):
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends = [0, *row["doc_ends"]]
                for k, doc in enumerate(row["doc_ids"]):
                    if doc == doc_id:
                        ids = unpack(row["payload"], row["bits"], ends[k], ends[k + 1])
                        yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([ids.tolist()], pa.list_(pa.int64()))], ["doc_id", "ids"])
    return read


def read_document(files: DataFrame, doc_id: int) -> DataFrame:
    """Random access: (doc_id, ids) of one document; other documents stay packed."""
    return files.filter(F.array_contains("doc_ids", doc_id)).mapInArrow(_document_reader(doc_id), "doc_id long, ids array<long>")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Write the files and return their digest, read back from them."""
    path = path or new_path(docs.sparkSession, "token-files")
    write_token_files(docs, tokenizer_path, end_id, path)
    return token_digest(read_token_files(docs.sparkSession, path))
