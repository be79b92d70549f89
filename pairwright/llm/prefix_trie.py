"""Prefix trie of conversations by a splitter skeleton.

A conversation is a path: the digests of its turns, one after the other, as
bytes. In the order of (path, conversation) a node's conversations lie side by
side. The order is cut into shards at splitters. A node whose conversations
lie in several shards begins both the last path of one shard and the first of
the next, so it begins a splitter: the skeleton is the trie of the splitters'
paths, which every task is given. A task runs through its sorted shard with
the nodes of the current path on a stack; it finishes every node outside the
skeleton, and gives partial sums for those inside. The partial sums of a
skeleton node are added up, and then carried from the leaves of the skeleton
to its root.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.llm.common import WORD, join_small, materialize

# Bytes of a turn's digest.
DIGEST = 16
# A conversation takes up to HEAD_TURNS - 1 turns from the first one of its group of GROUP ids.
GROUP, HEAD_TURNS = 20, 4
# Conversations of a shard; shards; turns of a splitter's path. The skeleton has at most MAX_SHARDS * SPLIT_TURNS nodes and the root.
SHARD_ROWS, MAX_SHARDS, SPLIT_TURNS = 100_000, 2_048, 64
# Conversations drawn for each shard to place the splitters.
DRAWN = 24
# Bytes of ids that are hashed by one row, for a skeleton node.
CHUNK = 32_768
# Rows of a result batch.
ROWS_AT_ONCE = 5_000


def turn_digest(role: Column, text: Column) -> Column:
    """32 hex digits that stand for role and text; the length of the role keeps the two apart."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(whole, 256), 1, 2 * DIGEST)


def rebuilt_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path, words): each conversation c after it took its first turns from conversation c - c % GROUP.

    It takes crc32(decimal c) % HEAD_TURNS turns, or all if there are fewer, in place of
    as many of its own. Turns go by ``turn``, null first; equal ones by their digest.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    each = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(
        F.col("turn"), turn_digest(role, text).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")).alias("one"))
    own = materialize(each.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("one")), lambda x: F.struct(x["digest"].alias("digest"), x["words"].alias("words"))).alias("turns")), "trie-conversations")
    heads = own.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, HEAD_TURNS - 1).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_TURNS).cast("int")
    none = F.expr("CAST(array() AS array<struct<digest: string, words: bigint>>)")
    joined = own.join(heads, F.col("conv_id") - F.col("conv_id") % GROUP == F.col("head_id"), "left")
    rebuilt = F.concat(F.slice(F.coalesce("head", none), F.lit(1), taken), F.slice("turns", taken + 1, F.greatest(F.size("turns") - taken, F.lit(0))))
    path = F.unhex(F.array_join(F.transform("rebuilt", lambda x: x["digest"]), ""))
    return joined.select("conv_id", rebuilt.alias("rebuilt")).select("conv_id", path.alias("path"), F.transform("rebuilt", lambda x: x["words"]).alias("words"))


# --- shards ------------------------------------------------------------------


def splitters(paths: DataFrame, rows: int, shard_rows: int = SHARD_ROWS) -> list[tuple[bytes, int]]:
    """Ascending places (path, conv_id) at which shards begin, at most MAX_SHARDS - 1. They decide who works on a node, not its result."""
    shards = min(MAX_SHARDS, max(paths.sparkSession.sparkContext.defaultParallelism, -(-rows // shard_rows)))
    every = max(1, rows // (DRAWN * shards))
    drawn = paths.filter(F.pmod(F.xxhash64("conv_id"), F.lit(every)) == 0).select(F.substring("path", 1, SPLIT_TURNS * DIGEST).alias("path"), "conv_id")
    places = sorted({(bytes(r["path"]), r["conv_id"]) for r in drawn.limit(4 * DRAWN * MAX_SHARDS).collect()})
    return sorted({places[len(places) * k // shards] for k in range(1, shards)}) if places else []


def _dealer(shared):
    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        for batch in batches:
            keys = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([bisect_right(places, k) for k in keys], pa.int32()), *batch.columns], ["shard", *batch.schema.names])
    return deal


def common_turns(a: bytes, b: bytes) -> int:
    """How many turns two paths share from the start."""
    n = min(len(a), len(b)) // DIGEST
    if a[:n * DIGEST] == b[:n * DIGEST]:
        return n
    x, y = (np.frombuffer(p, np.uint8, n * DIGEST) for p in (a, b))
    return int(np.argmax(x != y)) // DIGEST


def node_name(path: bytes) -> bytes:
    return hashlib.sha256(path).digest()[:DIGEST]


@dataclass
class Node:
    """A node on the stack, and the sums of its subtree so far (of a skeleton node: outside the skeleton, in this shard)."""

    depth: int
    words: int
    name: bytes | None = None  # of a skeleton node
    parent: bytes | None = None
    convs: int = 0
    first: int | None = None
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: object = None
    chunk: list[str] = field(default_factory=list)
    size: int = 0
    waiting: list[tuple] = field(default_factory=list)  # finished children, until this node's first conversation is known


RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
PART = RESULT + ", kind int, node binary, parent binary, words long, shard int, seq int, ids string"
_PART = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}[t]) for n, t in (f.split() for f in PART.split(", "))])
WHOLE, PARTIAL, ENDS = 0, 1, 2


class Walk:
    """Runs through the sorted rows of shards and collects finished rows (PART)."""

    def __init__(self, places: list[tuple[bytes, int]]):
        self.places, self.shard, self.stack, self.path = places, None, [], b""
        self.rows: list[tuple] = []
        self.seq = 0

    def _inside(self, path: bytes) -> int:
        """How many turns of the path belong to the skeleton: what it shares with the splitters around its shard."""
        around = [self.places[k][0] for k in (self.shard - 1, self.shard) if 0 <= k < len(self.places)]
        return max((common_turns(path, p) for p in around), default=0)

    def add(self, shard: int, path: bytes, conv: int, words: list[int]) -> None:
        if shard != self.shard:
            self.close()
            self.shard = shard
        depth = len(path) // DIGEST
        keep = common_turns(self.path, path) if self.stack else -1
        while len(self.stack) > keep + 1:
            self._pop()
        inside = self._inside(path) if len(self.stack) <= depth else 0
        for d in range(len(self.stack), depth + 1):
            name = node_name(path[:d * DIGEST]) if d <= inside else None
            self.stack.append(Node(d, words[d - 1] if d else 0, name, self.stack[-1].name if d else None))
        self.path = path
        node = self.stack[-1]
        node.convs += 1
        node.first = conv if node.first is None else min(node.first, conv)
        if node.name is None:
            if node.ends is None:
                node.ends = hashlib.sha256(str(conv).encode())
            else:
                node.ends.update(b",%d" % conv)
        else:
            node.chunk.append(str(conv))
            node.size += len(node.chunk[-1]) + 1
            if node.size > CHUNK:
                self._send_ends(node)

    def _send_ends(self, node: Node) -> None:
        if node.chunk:
            self.rows.append((None,) * 8 + (ENDS, node.name, None, None, self.shard, self.seq, ",".join(node.chunk)))
            self.seq += 1
            node.chunk, node.size = [], 0

    def _pop(self) -> None:
        node = self.stack.pop()
        above = self.stack[-1] if self.stack else None
        if node.name is not None:
            self._send_ends(node)
            self.rows.append((node.first, node.depth, None, node.convs, node.children, node.leaves, node.saved, None,
                              PARTIAL, node.name, node.parent, node.words, None, None, None))
            return
        if not node.children:
            node.leaves = 1
        node.saved += (node.convs - 1) * node.words
        for own in node.waiting:
            self.rows.append(own[:2] + (node.first,) + own[3:])
        digest = (node.ends or hashlib.sha256()).hexdigest()
        done = (node.first, node.depth, None, node.convs, node.children, node.leaves, node.saved, digest, WHOLE, None, above.name, None, None, None, None)
        (self.rows if above.name is not None else above.waiting).append(done)
        above.convs += node.convs
        above.first = node.first if above.first is None else min(above.first, node.first)
        above.children += 1
        above.leaves += node.leaves
        above.saved += node.saved

    def close(self) -> None:
        while self.stack:
            self._pop()
        self.path = b""

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PART.types)] if rows else [pa.array([], t) for t in _PART.types], schema=_PART)


def _walker(shared):
    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = Walk(shared.value)
        for batch in batches:
            shard, conv, path = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            ends, words = np.asarray(batch.column(3).offsets), batch.column(3).values.to_numpy(zero_copy_only=False)
            for k in range(batch.num_rows):
                run.add(shard[k], path[k], conv[k], words[ends[k]:ends[k + 1]].tolist())
                if len(run.rows) >= ROWS_AT_ONCE:
                    yield run.take()
        run.close()
        yield run.take()
    return walk


# --- skeleton ----------------------------------------------------------------


def _hash_ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for the sorted chunks of each node; a node's chunks are read one after the other, and not kept."""
    node, digest, out = None, None, []
    for batch in batches:
        for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name != node:
                if node is not None:
                    out.append((node, digest.hexdigest()))
                node, digest = name, hashlib.sha256(ids.encode())
            else:
                digest.update(b",")
                digest.update(ids.encode())
    if node is not None:
        out.append((node, digest.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.string())], ["node", "ends_sha256"])


def carry_up(skeleton: list[dict]) -> list[tuple]:
    """(node, RESULT without the ends) of the skeleton's nodes, from their sums outside the skeleton.

    A node takes its children's totals once these are whole, so nodes go by falling depth.
    """
    by_name = {bytes(r["node"]): r for r in skeleton}
    for r in sorted(skeleton, key=lambda r: -r["depth"]):
        if not r["n_children"]:
            r["n_leaves"] = 1
        r["saved_tokens"] += (r["n_convs"] - 1) * r["words"]
        above = by_name[bytes(r["parent"])] if r["depth"] else None
        if above:
            above["n_children"] += 1
            for name in ("n_convs", "n_leaves", "saved_tokens"):
                above[name] += r[name]
            above["conv_id"] = r["conv_id"] if above["conv_id"] is None else min(above["conv_id"], r["conv_id"])
    return [(bytes(r["node"]), r["conv_id"], r["depth"], by_name[bytes(r["parent"])]["conv_id"] if r["depth"] else None,
             r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]) for r in skeleton]


def trie_nodes(turns: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """RESULT, a row for each distinct beginning of the rebuilt conversations of ``turns`` (conv_id, turn, role, text).

    Null roles and texts count as empty; rows without conv_id belong to no
    conversation; equal rows are turns each. A conversation without turns after
    it was rebuilt is a member of the root, which has no text. An empty table
    has no node. Columns beyond these four are not looked at. One conversation,
    as digests, must fit in a row; conversations that share turns, however
    many, are spread over shards.
    """
    spark = turns.sparkSession
    paths = materialize(rebuilt_paths(turns), "trie-paths")
    places = splitters(paths, paths.count(), shard_rows)
    shared = spark.sparkContext.broadcast(places)  # MAX_SHARDS paths of SPLIT_TURNS turns
    dealt = paths.mapInArrow(_dealer(shared), "shard int, conv_id long, path binary, words array<long>")
    sorted_rows = dealt.repartitionById(len(places) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
    parts = materialize(sorted_rows.mapInArrow(_walker(shared), PART), "trie-parts")

    ends = parts.filter(F.col("kind") == ENDS).select("node", "shard", "seq", "ids").repartition("node").sortWithinPartitions("node", "shard", "seq")
    hashed = ends.select("node", "ids").mapInArrow(_hash_ends, "node binary, ends_sha256 string")
    sums = parts.filter(F.col("kind") == PARTIAL).groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("words").alias("words"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    inner = spark.createDataFrame(carry_up([r.asDict() for r in sums.collect()]),  # MAX_SHARDS * SPLIT_TURNS rows
                                  "node binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    inner = materialize(inner, "trie-skeleton")
    columns = [f.split()[0] for f in RESULT.split(", ")]
    skeleton = inner.join(hashed, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))).select(*columns)
    whole = parts.filter(F.col("kind") == WHOLE).select(*columns, "parent")
    parents = inner.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_first"))
    others = join_small(whole, parents, ["parent"]).withColumn("parent_conv_id", F.coalesce("parent_conv_id", "parent_first"))
    return others.select(*columns).unionByName(skeleton)
