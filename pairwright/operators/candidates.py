"""Candidates against a labelled test set, without building all candidates.

The block predicate needs both sides of a pair, and so does membership in the
test set. Joining the (small) test set to A and then to B on the record
fields gives the same pairs as filtering all block pairs, at a cost of
|A| + |B| + |test| instead of the sum of block products.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.functions.scoring import MATCH_THRESHOLD, match_flag, pair_score
from pairwright.functions.serialize import group_fingerprint, pair_text
from pairwright.functions.values import blank_if_null
from pairwright.operators.schema import BLOCK_KEY, FIELDS, PAIR_KEY, pairs_to_prefixed, side
from pairwright.plans.skew import ROWS_PER_CELL, skew_join
from pairwright.plans.storage import materialize


def test_lookup(test: DataFrame) -> DataFrame:
    """One row per pair key (null read as ''); the last label by ``rid`` wins.

    ``test`` is read once and written. Rows are grouped only where the hash of their key occurs
    more than once; all others stay where they are.
    """
    keyed = test.select(*[blank_if_null(F.col(k)).alias(k) for k in PAIR_KEY], "rid", F.col("match").cast("int").alias("match"))
    keyed = materialize(keyed.withColumn("_key", F.xxhash64(*PAIR_KEY)), "test-rows")
    counts = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    repeated = materialize(counts.filter("n > 1").select("_key"), "repeated-keys")
    label = F.when(F.col("rid").isNotNull(), F.col("match")).alias("match")  # a label without a rid is never the last one
    if repeated.isEmpty():
        return keyed.select(*PAIR_KEY, label)
    once = keyed.join(repeated, "_key", "left_anti").select(*PAIR_KEY, label)
    again = keyed.join(repeated, "_key", "left_semi").groupBy(*PAIR_KEY).agg(F.max_by("match", "rid").alias("match"))
    return once.unionByName(again)


def _print(columns: list[Column]) -> Column:
    """The fingerprint of the values as 16 bytes, half of its text."""
    return F.unhex(group_fingerprint(columns))


def _blocked() -> Column:
    """The pair key (without nulls) agrees on the block key."""
    # As one value: from equal columns the optimizer derives one more filter for each way to write the key's hash.
    return F.array(*[F.col(f"a_{k}") for k in BLOCK_KEY]) == F.array(*[F.col(f"b_{k}") for k in BLOCK_KEY])


def _blockable(keys: DataFrame) -> DataFrame:
    return keys.filter(_blocked())


def candidates_in_test(a: DataFrame, b: DataFrame, test: DataFrame,
                       rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Block pairs whose field values form a pair key of the test set.

    Same rows and columns as filtering the result of blocking on manufacturer
    and year.
    """
    # A record is known by a fingerprint of its compared fields; nulls count as ''.
    print_of = lambda s, name: _print([blank_if_null(F.col(f"{s}{f}")) for f in FIELDS]).alias(name)
    keys = _blockable(test.select(*[blank_if_null(F.col(k)).alias(k) for k in PAIR_KEY]))
    keys = materialize(keys.select(print_of("a_", "_in_a"), print_of("b_", "_in_b")).distinct(), "test-keys")

    def records(df: DataFrame, s: str) -> DataFrame:
        """Rows of a table that are in the test set, read once and written: the join below needs them twice."""
        wanted = keys.select(f"_in_{s}").distinct()
        own = df.select(print_of("", f"_in_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in df.columns])
        return materialize(own.join(wanted, f"_in_{s}", "left_semi"), f"test-records-{s}")
    with_a = skew_join(keys, records(a, "a"), ["_in_a"], ["_in_b"], ["rid_a"], rows_per_cell=rows_per_cell)
    with_a = materialize(with_a.drop("_in_a"), "test-with-a")
    pairs = skew_join(with_a, records(b, "b"), ["_in_b"], ["rid_a"], ["rid_b"], rows_per_cell=rows_per_cell)
    same = reduce(and_, [F.col(f"{k}_a").eqNullSafe(F.col(f"{k}_b")) for k in BLOCK_KEY])
    return pairs.filter(same).select(
        *[F.col(f"{k}_a").alias(k) for k in BLOCK_KEY],
        *[f"{c}_a" for c in a.columns if c not in BLOCK_KEY],
        *[f"{c}_b" for c in b.columns if c not in BLOCK_KEY])


def _in_side(prefix: str, s: str) -> dict[str, Column]:
    """A record by two 64-bit hashes of its compared fields; nulls count as ''."""
    values = [blank_if_null(F.col(f"{prefix}{f}")) for f in FIELDS]
    return {f"_in_{s}": F.xxhash64(*values), f"_too_{s}": F.xxhash64(F.lit("too"), *values)}


def _record_counts(df: DataFrame, s: str) -> DataFrame:
    # A null and a '' have the same pair key but do not share a block, so
    # counts are kept apart by which block columns are null.
    null_mask = sum((F.col(k).isNull().cast("int") * (2 ** i) for i, k in enumerate(BLOCK_KEY)), F.lit(0))
    masks = [F.count(F.when(F.col("_mask") == m, 1)).alias(f"n{m}_{s}") for m in range(2 ** len(BLOCK_KEY))]
    own = _in_side("", s)
    return df.select(*[c.alias(n) for n, c in own.items()], null_mask.alias("_mask")).groupBy(*own).agg(*masks)


def linkage_table(a: DataFrame, b: DataFrame, test: DataFrame, threshold: float = MATCH_THRESHOLD) -> DataFrame:
    """Every distinct test pair with its rule score and prediction.

    ``candidate_rows`` is how many block pairs have the pair's key (the
    product of record counts, so repeated records are never multiplied out);
    0 means that blocking missed the pair, which is then predicted 0.

    Only pairs that agree on the block key meet the record counts, by hashes; then their texts are moved once.
    """
    lookup = test_lookup(test)
    in_a, in_b = _in_side("a_", "a"), _in_side("b_", "b")
    pairs = _blockable(lookup).withColumns({**in_a, **in_b})
    products = [F.col(f"n{m}_a") * F.col(f"n{m}_b") for m in range(2 ** len(BLOCK_KEY))]
    found = (pairs.select(*in_a, *in_b).join(_record_counts(a, "a"), [*in_a]).join(_record_counts(b, "b"), [*in_b])
             .select(*in_a, *in_b, reduce(lambda x, y: x + y, products).alias("_rows")).filter("_rows > 0"))
    none = F.lit(0).cast("bigint")
    met = pairs.join(found, [*in_a, *in_b], "left").select(*PAIR_KEY, "match", F.coalesce("_rows", none).alias("candidate_rows"))
    score = F.when(F.col("candidate_rows") > 0, pair_score(side("a_"), side("b_")))
    met = met.withColumn("score", score).withColumn("predicted", F.coalesce(match_flag(F.col("score"), threshold), F.lit(0)))
    apart = lookup.filter(~_blocked()).select(*PAIR_KEY, "match", none.alias("candidate_rows"), F.lit(None).cast("double").alias("score"), F.lit(0).alias("predicted"))
    return met.unionByName(apart)


def missing_pairs(table: DataFrame) -> DataFrame:
    """Test pairs of a :func:`linkage_table` that blocking never produced."""
    return table.filter(F.col("candidate_rows") == 0)


def candidates_right_join(candidates: DataFrame, test: DataFrame) -> DataFrame:
    """All test rows, each once per equal candidate row and at least once.

    ``candidates``: suffix-shaped block pairs. Keys are compared null-safe on
    all 20 columns; a missing label reads '0'. Only counts of equal
    candidates are joined.
    """
    key = _print([F.col(k) for k in PAIR_KEY])
    copies = pairs_to_prefixed(candidates).groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("_copies"))
    # Rows meet by a fingerprint of their key, so of the candidates no text is shuffled.
    return _times(_labels(test, key.alias("_key")).join(copies, "_key", "left"), F.col("_copies"))


def test_right_join(a: DataFrame, b: DataFrame, test: DataFrame, distinct: bool = True) -> DataFrame:
    """As :func:`candidates_right_join` with the candidates of two tables, which are not built.

    A candidate has a test row's key if each side has a record with exactly
    its ten values (null is not ''), and both agree on the block key. With
    ``distinct``, as after removing repeated candidates, rows that differ in other
    columns (all but ``rid``) are told apart; without, every pair of rows counts.
    """
    def counted(df: DataFrame, s: str) -> DataFrame:
        own, rest = _print([F.col(f) for f in FIELDS]), _print([F.col(c) for c in df.columns if c not in ("rid", *FIELDS)])
        rows = df.select(own.alias(f"_in_{s}"), rest.alias("_rest")).distinct() if distinct else df.select(own.alias(f"_in_{s}"))
        return rows.groupBy(f"_in_{s}").agg(F.count(F.lit(1)).alias(f"_n_{s}"))
    # The test rows are read once and meet the counts of either side.
    prints = [_print([F.col(f"{s}_{f}") for f in FIELDS]).alias(f"_in_{s}") for s in "ab"]
    agree = reduce(and_, [F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in BLOCK_KEY])
    found = _labels(test, *prints).join(counted(a, "a"), "_in_a", "left").join(counted(b, "b"), "_in_b", "left")
    return _times(found, F.when(agree, F.col("_n_a") * F.col("_n_b")))


def _labels(test: DataFrame, *more: Column) -> DataFrame:
    """The pair key and the label as text, null read '0', and ``more``."""
    return test.select(*PAIR_KEY, F.coalesce(F.col("match").cast("string"), F.lit("0")).alias("match"), *more)


def _times(rows: DataFrame, copies: Column) -> DataFrame:
    """Each row as often as ``copies`` says, and at least once."""
    times = F.sequence(F.lit(1).cast("bigint"), F.coalesce(copies, F.lit(1).cast("bigint")))
    return rows.select(*PAIR_KEY, "match", F.explode(times).alias("_copy")).drop("_copy")


def serialize_pairs(pairs: DataFrame) -> DataFrame:
    """``a_*``/``b_*``/``match`` rows as text lines."""
    return pairs.select(pair_text(side("a_"), side("b_"), F.col("match"), FIELDS).alias("line"))
