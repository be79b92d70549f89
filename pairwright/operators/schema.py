"""The mediated listing schema and the shapes of record pairs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.functions import normalize as norm
from pairwright.functions.values import number_with_commas, whole_number_text

# The ten compared fields of a listing, in their fixed order.
FIELDS = ("manufacturer", "model", "year", "mileage", "fuel_type", "transmission",
          "body_type", "cylinders", "drive", "color")
LISTING_COLUMNS = ("vin", *FIELDS, "invalid")
# The 20 columns that identify a labelled pair by value.
PAIR_KEY = tuple(f"{side}_{f}" for side in "ab" for f in FIELDS)
BLOCK_KEY = ("manufacturer", "year")

# Column of each source -> column of the mediated schema.
SOURCE_COLUMNS = {
    "vehicles": {
        "VIN": "vin", "manufacturer": "manufacturer", "model": "model", "year": "year", "odometer": "mileage", "fuel": "fuel_type",
        "transmission": "transmission", "type": "body_type", "cylinders": "cylinders", "drive": "drive", "paint_color": "color",
    },
    "used_cars": {
        "vin": "vin", "make_name": "manufacturer", "model_name": "model", "year": "year", "mileage": "mileage", "fuel_type": "fuel_type",
        "transmission": "transmission", "body_type": "body_type", "engine_cylinders": "cylinders", "wheel_system": "drive", "exterior_color": "color",
    },
}


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")


def side(prefix: str = "", suffix: str = "") -> Callable[[str], Column]:
    """Accessor of one side's fields in a pair table: ``side('a_')('year')``."""
    return lambda field: F.col(f"{prefix}{field}{suffix}")


def align(df: DataFrame, dataset_type: str = "vehicles", rid: str | None = None) -> DataFrame:
    """Select and rename a source's columns to the mediated schema.

    ``rid`` names the source's row key, carried along as ``rid``.
    """
    if dataset_type not in SOURCE_COLUMNS:
        raise ValueError(f"dataset_type must be one of {', '.join(SOURCE_COLUMNS)}")
    sources = SOURCE_COLUMNS[dataset_type]
    require(df, *sources)
    key = [F.col(rid).cast("bigint").alias("rid")] if rid else []
    return df.select(*key, *[F.col(s).cast("string").alias(d) for s, d in sources.items()], F.lit(0).alias("invalid"))


def normalize_all(df: DataFrame) -> DataFrame:
    """Apply every category normaliser in one projection."""
    require(df, *norm.NORMALIZERS)
    return df.withColumns({c: f(F.col(c)) for c, f in norm.NORMALIZERS.items()})


def normalize_numeric(df: DataFrame, cols: Sequence[str] = ("mileage", "year", "cylinders")) -> DataFrame:
    """'2018.0' -> '2018' in the given columns; absent columns are skipped."""
    return df.withColumns({c: whole_number_text(F.col(c)) for c in cols if c in df.columns})


def normalize_numeric_pairs(df: DataFrame) -> DataFrame:
    return normalize_numeric(df, [f"{s}_{c}" for c in ("year", "mileage", "cylinders") for s in "ab"])


def clean_numeric(df: DataFrame, fields: Sequence[str] = ("year", "mileage", "price")) -> DataFrame:
    """Numeric fields to double, null where not a number."""
    return df.withColumns({c: number_with_commas(F.col(c).cast("string")) for c in fields if c in df.columns})


def drop_vin(df: DataFrame) -> DataFrame:
    return df.drop("vin")


def drop_pair_vins(df: DataFrame) -> DataFrame:
    return df.drop("a_vin", "b_vin")


def extract_valid(df: DataFrame) -> DataFrame:
    """Rows whose ``invalid`` flag is 0."""
    require(df, "invalid")
    return df.filter(F.col("invalid").cast("int") == 0)


def prefixed(df: DataFrame, prefix: str, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in (columns or df.columns)])


def pairs_to_prefixed(df: DataFrame) -> DataFrame:
    """Suffix-shaped candidates (shared block key) -> ``a_*``/``b_*`` columns."""
    def source(s: str, f: str) -> Column:
        return F.col(f if f in BLOCK_KEY else f"{f}_{s}")
    ids = [F.col(f"rid_{s}").alias(f"{s}_rid") for s in "ab" if f"rid_{s}" in df.columns]
    return df.select(*ids, *[source(s, f).alias(f"{s}_{f}") for s in "ab" for f in FIELDS])
