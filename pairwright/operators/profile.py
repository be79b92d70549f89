"""Profiles of a table: nulls, distinct values, ranges, frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.functions.values import number, strip


def value_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n): how often each column holds each value, null included.

    One scan for any number of columns; frequent values are merged before the
    shuffle, so a value that fills a third of a column costs nothing extra.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                        for c in columns])
    return (df.select(F.inline(entries)).groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("n")))


def profile_nulls_uniques(df: DataFrame) -> DataFrame:
    """Null count, null percentage and distinct values per column, most nulls first."""
    return (value_table(df, df.columns).groupBy("column")
            .agg(F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
                 F.sum("n").alias("total_rows"),
                 F.count("value").alias("unique_values"))
            .select("column", "total_rows", "null_count",
                    F.round(F.col("null_count") / F.col("total_rows") * 100, 2).alias("null_pct"),
                    "unique_values")
            .orderBy(F.desc("null_pct"), "column"))


def representativity(df: DataFrame) -> DataFrame:
    """One row: coverage of VINs, years, manufacturers and models, and the
    range and mean of price and mileage. Absent columns give null or 0."""
    wanted = ["vin", "year", "manufacturer", "model", "price", "mileage"]
    present = [c for c in wanted if c in df.columns]
    # A constant first column counts the rows even when nothing else is there.
    rows = df.select(F.lit("x").alias("_row"), *present)
    v = value_table(rows, ["_row", *present])

    def of(column: str, value: Column) -> Column:
        return F.when((F.col("column") == column) & F.col("value").isNotNull(), value)

    n, total = F.col("n"), F.sum(of("_row", F.col("n")))
    vins = F.coalesce(F.sum(of("vin", n)), F.lit(0))
    aggs = [
        total.alias("total_rows"),
        vins.alias("vin_present"),
        F.round(vins / total * 100, 2).alias("vin_pct"),
        F.count(of("year", n)).alias("distinct_years"),
        F.min(of("year", F.col("value"))).alias("min_year"),
        F.max(of("year", F.col("value"))).alias("max_year"),
        F.count(of("manufacturer", n)).alias("distinct_manufacturers"),
        F.count(of("model", n)).alias("distinct_models"),
    ]
    for c in ("price", "mileage"):
        x = of(c, number(F.col("value")))
        counted = F.sum(F.when(x.isNotNull(), n))
        aggs += [F.min(x).alias(f"{c}_min"), F.max(x).alias(f"{c}_max"),
                 F.round(F.sum(x * n) / counted, 2).alias(f"{c}_mean")]
    return v.agg(*aggs)


def unique_vins(df: DataFrame) -> DataFrame:
    """VINs that occur in exactly one row; blank ones are ignored."""
    return vin_counts(df).filter(F.col("n") == 1).select("vin")


def unique_vin_summary(df: DataFrame) -> DataFrame:
    return vin_counts(df).agg(F.count(F.lit(1)).alias("distinct_vins"),
                              F.count(F.when(F.col("n") == 1, 1)).alias("unique_vins"))


def vin_counts(df: DataFrame) -> DataFrame:
    return df.filter(strip(F.col("vin")) != "").groupBy("vin").agg(F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each non-null value of a column."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


# --- profiles of parts, merged later ------------------------------------------

# Bits of a distinct-count sketch: 2 ** 12 buckets, a standard error of 1.6 %; and the size of a quantile sketch, an error of about 0.7 % in rank.
HLL_BITS, KLL_SIZE = 12, 400


def sketch_profile(df: DataFrame, columns: list[str], part: Column) -> DataFrame:
    """(part, column, total_rows, null_count, numbers, low, high, total, distinct_sketch, number_sketch): one row for each part and column.

    A sketch is a few kilobytes whatever the rows, so profiles of parts are kept and merged instead of scanning them again.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    rows = df.select(part.cast("string").alias("part"), F.inline(entries)).withColumn("x", number(F.col("value")))
    return rows.groupBy("part", "column").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count(F.when(F.col("value").isNull(), 1)).alias("null_count"), F.count("x").alias("numbers"),
        F.min("x").alias("low"), F.max("x").alias("high"), F.sum("x").alias("total"),
        F.hll_sketch_agg("value", F.lit(HLL_BITS)).alias("distinct_sketch"), F.kll_sketch_agg_double("x", F.lit(KLL_SIZE)).alias("number_sketch"))


def merge_profiles(parts: DataFrame, quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
    """(column, total_rows, null_count, null_pct, unique_estimate, low, high, mean, quantiles): profiles of parts as one. Counts, ranges and means
    are exact; distinct values and quantiles carry the sketches' error."""
    merged = parts.groupBy("column").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("null_count").alias("null_count"), F.sum("numbers").alias("numbers"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("total").alias("total"), F.hll_union_agg("distinct_sketch").alias("d"), F.kll_merge_agg_double("number_sketch").alias("q"))
    shown = F.array(*[F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double("q", F.lit(x))) for x in quantiles])
    return merged.select("column", "total_rows", "null_count", F.round(F.col("null_count") / F.col("total_rows") * 100, 2).alias("null_pct"),
                         F.hll_sketch_estimate("d").alias("unique_estimate"), "low", "high", F.when(F.col("numbers") > 0, F.col("total") / F.col("numbers")).alias("mean"),
                         shown.alias("quantiles"))
