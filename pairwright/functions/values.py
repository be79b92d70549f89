"""Reading messy strings: null tokens, numbers, blanks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that a CSV field may hold instead of being empty.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# What surrounds a text without being part of it (ASCII white
# space, the information separators, the next-line sign, Unicode separators).
BLANKS = (" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
          "\u2028\u2029\u202f\u205f\u3000")

# A plain decimal number. The guard keeps out texts such as "12d", which
# Spark's own cast would accept.
NUMBER_PATTERN = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def null_if_token(c: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """Null for a missing-value token, otherwise the text unchanged."""
    return F.when(~c.isin(*tokens), c)


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(c, F.lit(BLANKS))


def number(c: Column) -> Column:
    """Double for a plain decimal number, else null."""
    bare = strip(c)
    return F.when(bare.rlike(NUMBER_PATTERN), bare.try_cast("double"))


def number_with_commas(c: Column) -> Column:
    """As :func:`number`, after removing thousands separators."""
    return number(F.replace(c, F.lit(","), F.lit("")))


def whole_number(c: Column) -> Column:
    """Number cut towards zero, as bigint; null when not a number."""
    return number(c).try_cast("bigint")


def whole_number_text(c: Column) -> Column:
    """'2018.0' -> '2018'; texts that are no number are only stripped."""
    return F.coalesce(whole_number(c).cast("string"), strip(c))


def blank_if_null(c: Column) -> Column:
    """Null -> '' (no trimming), the form in which pair keys are compared."""
    return F.coalesce(c, F.lit(""))


def null_if_blank(c: Column) -> Column:
    """'' or white space -> null."""
    return F.when(strip(c) != "", c)
