"""Precision, recall, F1 and breakdowns of predicted pairs."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.functions.scoring import MATCH_THRESHOLD
from pairwright.operators.blocking import candidate_count, dense_block_index
from pairwright.operators.candidates import linkage_table
from pairwright.plans.rank import in_range_buckets, running_totals
from pairwright.plans.skew import ROWS_PER_CELL, skew_join

PAIR = ["a_id", "b_id"]


def _ratio(x: Column, y: Column) -> Column:
    return F.when(y > 0, x / y).otherwise(0.0)


def metrics(counts: DataFrame, digits: int | None = None) -> DataFrame:
    """tp, fp, fn -> the same with precision, recall and F1 (0 when undefined)."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    shown = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return counts.select("tp", "fp", "fn", shown(_ratio(tp, tp + fp)).alias("precision"),
                         shown(_ratio(tp, tp + fn)).alias("recall"),
                         shown(_ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"))


def prf_metrics(df: DataFrame, predicted: str = "predicted", actual: str = "match",
                weight: Column | None = None, digits: int | None = None) -> DataFrame:
    """Metrics of class 1 from 0/1 columns, rows counted ``weight`` times."""
    w = F.lit(1).cast("bigint") if weight is None else weight
    p, t = F.col(predicted) == 1, F.col(actual) == 1
    total = lambda c: F.coalesce(F.sum(F.when(c, w)), F.lit(0))
    return metrics(df.agg(total(p & t).alias("tp"), total(p & ~t).alias("fp"), total(~p & t).alias("fn")), digits)


def rule_linkage_eval(a: DataFrame, b: DataFrame, test: DataFrame, threshold: float = MATCH_THRESHOLD,
                      digits: int | None = None) -> DataFrame:
    """Metrics over the candidate rows that are in the test set."""
    seen = linkage_table(a, b, test, threshold).filter("candidate_rows > 0")
    return prf_metrics(seen, weight=F.col("candidate_rows"), digits=digits)


def rule_linkage_eval_full(a: DataFrame, b: DataFrame, test: DataFrame, threshold: float = MATCH_THRESHOLD,
                           digits: int | None = None) -> DataFrame:
    """As :func:`rule_linkage_eval`, with test pairs that blocking missed
    counted once as predicted 0."""
    table = linkage_table(a, b, test, threshold)
    return prf_metrics(table, weight=F.greatest(F.col("candidate_rows"), F.lit(1)), digits=digits)


def coverage(a: DataFrame, b: DataFrame, test: DataFrame) -> DataFrame:
    """Distinct test pairs evaluated, test rows, and candidate rows in all.

    Three one-number tables side by side, as rows of one union.
    """
    table = linkage_table(a, b, test)
    parts = [
        table.agg(F.count(F.when(F.col("candidate_rows") > 0, 1)).alias("n")).withColumn("measure", F.lit("pairs_evaluated")),
        table.agg(F.count(F.lit(1)).alias("n")).withColumn("measure", F.lit("test_pairs")),
        test.agg(F.count(F.lit(1)).alias("n")).withColumn("measure", F.lit("test_rows")),
        candidate_count(a, b).select(F.col("n_pairs").alias("n"), F.lit("candidate_rows").alias("measure")),
    ]
    return reduce(DataFrame.unionByName, parts).select("measure", "n")


def scored_pair_eval(scored: DataFrame, threshold: float = 0.7, digits: int | None = None) -> DataFrame:
    """Metrics of externally scored pairs: columns ``score`` and ``label``."""
    flagged = scored.withColumn("predicted", (F.col("score") >= F.lit(threshold)).cast("int"))
    return prf_metrics(flagged, actual="label", digits=digits)


def labelled_pair_ids(labelled: DataFrame, valid_a: DataFrame, valid_b: DataFrame) -> DataFrame:
    """Distinct true pairs (``match = 1``) whose ids are known on both sides."""
    true = labelled.filter(F.col("match").cast("int") == 1).select(*PAIR).distinct()
    ids_a = valid_a.select(F.col("rid").alias("a_id"))
    ids_b = valid_b.select(F.col("rid").alias("b_id"))
    return true.join(ids_a, "a_id", "left_semi").join(ids_b, "b_id", "left_semi").select(*PAIR)


def positional_ids(df: DataFrame, rid: str = "rid") -> DataFrame:
    """``A_i``, ``B_i`` for the i-th row (from 0) in the order of its key."""
    keys = in_range_buckets(df.select(F.col(rid).alias("rid")), "rid")
    at = running_totals(keys, F.col("_range"), [F.col("rid")], {"position": F.lit(1).cast("bigint")})
    name = lambda s: F.concat(F.lit(s), (F.col("position") - 1).cast("string"))
    return at.select(name("A_").alias("a_id"), name("B_").alias("b_id"))


def positional_pair_ids(labelled: DataFrame, records: DataFrame, rid: str = "rid") -> DataFrame:
    """Labelled rows as pairs ``(A_i, B_i)`` by position, restricted to the
    positions that the table of record pairs has. Labels are not looked at."""
    known = positional_ids(records, rid)
    return (positional_ids(labelled, rid).join(known.select("a_id"), "a_id", "left_semi")
            .join(known.select("b_id"), "b_id", "left_semi").select(*PAIR))


def pair_intersect(x: DataFrame, y: DataFrame) -> DataFrame:
    return x.select(*PAIR).intersect(y.select(*PAIR))


def pair_except(x: DataFrame, y: DataFrame) -> DataFrame:
    return x.select(*PAIR).subtract(y.select(*PAIR))


def pair_union(x: DataFrame, y: DataFrame) -> DataFrame:
    return x.select(*PAIR).union(y.select(*PAIR)).distinct()


def cluster_pairs(clusters: DataFrame, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """(cluster_id, member) -> every unordered pair of members of a cluster.

    The pairs are the result asked for; a linker's clusters have two members.
    """
    x = clusters.select("cluster_id", F.col("member").alias("member_1"))
    y = clusters.select("cluster_id", F.col("member").alias("member_2"))
    pairs = skew_join(x, y, ["cluster_id"], ["member_1"], ["member_2"], rows_per_cell=rows_per_cell)
    return pairs.filter(F.col("member_1") < F.col("member_2"))


def set_metrics(predicted: DataFrame, truth: DataFrame, digits: int | None = None) -> DataFrame:
    """Metrics of a set of predicted pairs against the set of true pairs."""
    return prf_metrics(_flagged(predicted, truth), digits=digits)


def _flagged(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    one = lambda df, p, t: df.select(*PAIR, F.lit(p).alias("predicted"), F.lit(t).alias("match"))
    return (one(predicted, 1, 0).unionByName(one(truth, 0, 1)).groupBy(*PAIR)
            .agg(F.max("predicted").alias("predicted"), F.max("match").alias("match")))


def block_eval(a: DataFrame, b: DataFrame, predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """Per block: predicted, true and hit pairs, and an example key.

    A pair belongs to the block of its A record. All blocks are listed; the
    rows without a block form a last entry with null number and no pairs.
    """
    index = dense_block_index(a, b)
    example = F.min_by(F.struct("manufacturer", "year"), F.struct("side", "rid"))
    blocks = index.groupBy("block_index").agg(example.alias("example"))
    of_a = index.filter(F.col("side") == "A").select(F.col("rid").alias("a_id"), "block_index")
    stats = (_flagged(predicted, truth).join(of_a, "a_id").filter(F.col("block_index").isNotNull())
             .groupBy("block_index")
             .agg(F.sum("predicted").alias("predicted"), F.sum("match").alias("actual"),
                  F.sum(F.col("predicted") * F.col("match")).alias("tp")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return (blocks.join(stats, "block_index", "left")
            .select("block_index", F.col("example.manufacturer").alias("manufacturer"),
                    F.col("example.year").alias("year"), zero("predicted"), zero("actual"), zero("tp"))
            .orderBy(F.asc_nulls_last("block_index")))
