"""Vehicle identification number checks, one boolean Column each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairwright.functions.values import number

VIN_LENGTH = 17
# Model-year codes at position 10, from 1980 on; the cycle
# repeats every 30 years and is defined up to 2039.
YEAR_CODES = "ABCDEFGHJKLMNPRSTVWXY123456789"
FIRST_YEAR, LAST_YEAR = 1980, 2039


def length_bad(vin: Column) -> Column:
    return F.length(F.coalesce(vin, F.lit(""))) != VIN_LENGTH


def charset_bad(vin: Column) -> Column:
    """Outside the VIN alphabet, or digits only, or letters only."""
    v = F.coalesce(vin, F.lit(""))
    return (
        ~v.rlike(r"\A(?i:[A-HJ-NPR-Z0-9]{17})\z")
        | v.rlike(r"\A[0-9]{17}\z")
        | v.rlike(r"\A[A-Za-z]{17}\z")
    )


def year_code_bad(vin: Column, year: Column) -> Column:
    """Tenth character differs from the year's code (case-sensitive).

    Years that are missing or outside the code table are never flagged.
    """
    v = F.coalesce(vin, F.lit(""))
    y = number(year.cast("string")).try_cast("int")
    position = F.pmod(y - FIRST_YEAR, F.lit(len(YEAR_CODES))) + 1
    code = F.substr(F.lit(YEAR_CODES), position, F.lit(1))
    known = y.between(FIRST_YEAR, LAST_YEAR) & (F.length(v) >= 10)
    return F.coalesce(known & (F.substring(v, 10, 1) != code), F.lit(False))
