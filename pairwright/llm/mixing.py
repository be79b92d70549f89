"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairwright.llm.common import WORD, free_names, materialize, quoted

# A source's weight is a setting, so there are few; more is an error.
MAX_SOURCES = 100_000
# Hex digits of the sampling key that make a bucket: 4,096 per source.
BUCKET_DIGITS = 3
# Rows of a group of equal rows that one task numbers.
ROWS_PER_PART = 50_000


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(caps: Sequence[float], weights: Sequence[float], total: float) -> list[float]:
    """Share ``total`` by weight; what a source may not take is shared again.

    Clamps every source above its cap, and repeats with the others until none
    is above. If ``total`` exceeds all caps, every source is at its cap.
    """
    clamped = [w <= 0 or c <= 0 for c, w in zip(caps, weights)]
    while True:
        left = total - sum(c for c, full, w in zip(caps, clamped, weights) if full and w > 0)
        free = sum(w for w, full in zip(weights, clamped) if not full)
        level = left / free if free else 0.0
        above = [not full and level * w > c for c, w, full in zip(caps, weights, clamped)]
        if not any(above):
            return [(c if w > 0 else 0.0) if full else level * w for c, w, full in zip(caps, weights, clamped)]
        clamped = [full or more for full, more in zip(clamped, above)]


def cyclic_weights(sources: Sequence[str | None], cycle: Sequence[float]) -> list[float]:
    """Weights by the order of the sources (code points, null last), repeating ``cycle``."""
    order = sorted(range(len(sources)), key=lambda i: (sources[i] is None, sources[i] or ""))
    weights = [0.0] * len(sources)
    for rank, i in enumerate(order):
        weights[i] = float(cycle[rank % len(cycle)])
    return weights


def source_targets(sizes: DataFrame, share: float, max_epochs: float, cycle: Sequence[float]) -> list[dict]:
    """Per source: size, target, whole repetitions, words of the fractional one."""
    rows = sizes.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    caps = [max_epochs * r["n"] for r in rows]
    targets = water_fill(caps, cyclic_weights([r["source"] for r in rows], cycle), share * sum(r["n"] for r in rows))
    out = []
    for r, t in zip(rows, targets):
        whole = int(t // r["n"]) if r["n"] else 0
        out.append({"source": r["source"], "source_size": r["n"], "target": t, "whole": whole, "part": int(t - whole * r["n"] + 0.5)})
    return out


def mix(docs: DataFrame, share: float = 1.5, max_epochs: float = 2.0, cycle: Sequence[float] = (5, 2, 1), seed: str = "mix",
        key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source, source_size, target, taken: how many words the mix takes of each document.

    ``share`` of all words is shared out by weight; a source gives at most
    ``max_epochs`` times its words. Every document is taken ``whole`` times,
    and one more time if it comes early in its source's seeded order (MD5 of
    seed and id); the document at the cut gives the rest of the words, so
    each source meets its target to the word. Documents without words (null
    or empty text) take 0. A null source is a source of its own. Rows with
    equal ids are separate documents; between them the smaller size comes
    first, and equal rows are interchangeable. Empty tables give no rows.

    Only rows of each source's cut bucket (1/4096 of it) are ordered, so a
    source with a third of all rows is no hot window.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"))
    order = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sizes = materialize(keyed.withColumn("_order", order).withColumn("_bucket", F.substring("_order", 1, BUCKET_DIGITS)), "mix-sizes")
    targets = source_targets(sizes, share, max_epochs, cycle)
    plan = F.broadcast(spark.createDataFrame(  # at most MAX_SOURCES rows
        [(t["source"], t["source_size"], float(t["target"]), t["whole"], t["part"]) for t in targets],
        "source string, source_size long, target double, whole long, part long"))
    sums = sizes.groupBy("source", "_bucket").agg(F.sum("size").alias("n"))
    upto = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)  # 4,096 rows at most
    running = sums.withColumn("_upto", F.sum("n").over(upto))
    cut = running.join(plan, running["source"].eqNullSafe(plan["source"])).filter((F.col("_upto") >= F.col("part")) & (F.col("_upto") - F.col("n") < F.col("part")))
    cut = F.broadcast(materialize(cut.groupBy(running["source"].alias("source")).agg(F.min(F.struct("_bucket", (F.col("_upto") - F.col("n")).alias("before"))).alias("cut")), "mix-cuts"))
    rows = sizes.join(plan, sizes["source"].eqNullSafe(plan["source"])).join(cut, sizes["source"].eqNullSafe(cut["source"]), "left").select(
        "doc_id", sizes["source"], "size", "source_size", "target", "whole", "part", "_order", "_bucket",
        F.col("cut._bucket").alias("_cut"), F.col("cut.before").alias("_before"))
    at_cut = F.col("_bucket").eqNullSafe(F.col("_cut"))
    inside = Window.partitionBy("source").orderBy("_order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.col("part") - F.col("_before") - F.coalesce(F.sum("size").over(inside), F.lit(0))
    extra = F.greatest(F.lit(0), F.least(F.col("size"), rest))
    edge = rows.filter(at_cut).withColumn("_extra", extra)
    others = rows.filter(~at_cut).withColumn("_extra", F.when(F.col("_bucket") < F.col("_cut"), F.col("size")).otherwise(F.lit(0)))
    both = edge.unionByName(others)
    return both.select("doc_id", "size", "source", "source_size", "target", (F.col("whole") * F.col("size") + F.col("_extra")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: columns of ``docs``, a row for each time a document is taken.

    Documents stay whole: one that is cut is taken if at least half of its
    words are. Documents without words are kept once. Rows with equal id, size
    and source share their copies: each takes the whole part of its share, and
    the first so many of them, in an order of their own, one of what is left. Columns may have any names.
    """
    taken = mix(docs, **settings)
    key, text, source = (settings.get(n, d) for n, d in (("key", "doc_id"), ("text", "text"), ("source", "source")))
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.floor(F.col("taken") / F.col("size") + 0.5)).cast("long")
    size, k_id, k_size, k_source, n_copies, n_rows, times = free_names(docs, "_size", "_k_id", "_k_size", "_k_source", "_copies", "_rows", "_times")
    shares = materialize(taken.select(F.col("doc_id").alias(k_id), F.col("size").alias(k_size), F.col("source").alias(k_source), copies.alias(n_copies))
                         .groupBy(k_id, k_size, k_source).agg(F.sum(n_copies).alias(n_copies), F.count(F.lit(1)).alias(n_rows)).filter(F.col(n_copies) > 0), "mix-copies")
    own = docs.withColumn(size, word_count(text))
    same = own[key].eqNullSafe(shares[k_id]) & (own[size] == shares[k_size]) & own[source].eqNullSafe(shares[k_source])
    joined = own.join(shares, same).select(*[quoted(c, own) for c in own.columns], k_id, k_source, n_copies, n_rows)
    rest = F.col(n_copies) % F.col(n_rows)
    even = joined.filter((F.col(n_rows) == 1) | (rest == 0)).withColumn(times, F.col(n_copies) / F.col(n_rows))
    uneven = _dealt(joined.filter((F.col(n_rows) > 1) & (rest > 0)), [k_id, size, k_source], n_copies, n_rows, times)
    both = even.select(*map(quoted, own.columns), F.col(times).cast("int").alias(times)).unionByName(uneven.select(*map(quoted, own.columns), F.col(times).cast("int").alias(times)))
    return both.filter(F.col(times) > 0).withColumn(size, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*[quoted(c) for c in docs.columns])


def _dealt(rows: DataFrame, group: Sequence[str], n_copies: str, n_rows: str, times: str) -> DataFrame:
    """Add ``times``, a whole share of its group's copies for each row; written, because rows are numbered.

    A large group is cut into parts by a hash of the row number: a row's place is the
    rows of earlier parts and its place in its own.
    """
    row, part, before = free_names(rows, "_row", "_part", "_before")
    numbered = materialize(rows.withColumn(row, F.monotonically_increasing_id()), "mix-repeats")
    parts = F.pmod(F.xxhash64(row), F.ceil(F.col(n_rows) / ROWS_PER_PART))
    cut = numbered.withColumn(part, parts)
    of_group = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy(*group, part).agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select(*group, part, F.coalesce(F.sum("n").over(of_group), F.lit(0)).alias(before))
    on = cut[part] == offsets[part]
    for g in group:
        on = on & cut[g].eqNullSafe(offsets[g])
    inside = Window.partitionBy(*[cut[g] for g in group], cut[part]).orderBy(cut[row])
    place = F.row_number().over(inside) + offsets[before]
    share = F.floor(F.col(n_copies) / F.col(n_rows)) + (place <= F.col(n_copies) % F.col(n_rows)).cast("long")
    return cut.join(offsets, on).select(*[quoted(c, cut) for c in rows.columns], share.alias(times))
