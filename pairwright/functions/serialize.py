"""Records and pairs as text, and row fingerprints."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairwright.functions.values import blank_if_null, strip


def row_fingerprint(columns: Sequence[Column]) -> Column:
    """MD5 of the values joined by '|'; null is written ``__NULL__``."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("__NULL__")) for c in columns]))


def group_fingerprint(columns: Sequence[Column]) -> Column:
    """MD5 under which only equal rows meet: each value carries its length,
    so neither a separator inside a value nor a null can be confused."""
    parts = []
    for c in columns:
        s = c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.md5(F.concat(*parts))


def record_text(side: Callable[[str], Column], fields: Sequence[str]) -> Column:
    """``COL <field> VAL <value>`` for each field, separated by a space."""
    return F.concat_ws(" ", *[
        F.concat(F.lit(f"COL {f} VAL "), F.translate(strip(blank_if_null(side(f).cast("string"))), "\t\n", "  "))
        for f in fields])


def pair_text(side_a: Callable[[str], Column], side_b: Callable[[str], Column],
              label: Column, fields: Sequence[str]) -> Column:
    """``left<TAB>right<TAB>label``."""
    return F.concat_ws("\t", record_text(side_a, fields), record_text(side_b, fields),
                       strip(blank_if_null(label.cast("string"))))
