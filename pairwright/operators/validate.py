"""Flags for rows whose VIN cannot be trusted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.functions import vin as checks
from pairwright.operators.schema import require


def _flags() -> dict:
    v, y = F.col("vin"), F.col("year")
    return {"length": checks.length_bad(v), "charset": checks.charset_bad(v),
            "year_code": checks.year_code_bad(v, y)}


def mark_invalid_vin(df: DataFrame) -> DataFrame:
    """Reset ``invalid`` to 0, then 1 where a VIN check fails; a null VIN stays null."""
    require(df, "vin", "year")
    f = _flags()
    bad = f["length"] | f["charset"] | f["year_code"]
    return df.withColumn("invalid", bad.cast("int"))


def error_counts() -> dict[str, Column]:
    """Valid rows and, overlapping, rows failing each check, as aggregates."""
    f = _flags()
    count = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    return {"valid": count(~(f["length"] | f["charset"] | f["year_code"])), **{f"{n}_errors": count(c) for n, c in f.items()}}


def vin_error_summary(df: DataFrame) -> DataFrame:
    require(df, "vin", "year")
    return df.agg(*[c.alias(n) for n, c in error_counts().items()])


def _with_repeats(df: DataFrame) -> DataFrame:
    require(df, "vin")
    if "invalid" not in df.columns:
        df = df.withColumn("invalid", F.lit(0))
    # A missing VIN, null or '', repeats nothing.
    # Counting merges a hot VIN before the shuffle; a window over the VIN
    # would gather all its rows in one task. The optimizer splits the hot
    # partition of the join, since the other side has one row per VIN.
    repeated = (df.filter(F.col("vin") != "").groupBy("vin").agg(F.count(F.lit(1)).alias("_n"))
                .filter("_n > 1").select(F.col("vin").alias("_vin")))
    return df.join(repeated, df["vin"] == repeated["_vin"], "left")


def mark_duplicate_vins(df: DataFrame) -> DataFrame:
    """``invalid = 1`` on every row whose VIN occurs more than once."""
    columns = [c for c in df.columns if c != "invalid"]
    return _with_repeats(df).select(
        *columns, F.when(F.col("_vin").isNotNull(), 1).otherwise(F.col("invalid").cast("int")).alias("invalid"))


def duplicate_vin_summary(df: DataFrame) -> DataFrame:
    return _with_repeats(df).agg(
        F.count("_vin").alias("rows_modified"),
        F.count(F.when(F.col("_vin").isNull() & (F.col("invalid").cast("int") == 0), 1)).alias("rows_left_valid"))
