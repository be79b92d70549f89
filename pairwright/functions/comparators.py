"""Distances for the learned matcher: 0 is 'same', 1 is 'different'.

Any ``Callable[[Column, Column], Column]`` can be used as a comparator, so a
user adds one by passing it in a comparison specification (see
:func:`comparison_features`); a pandas UDF works as well, built-ins are faster.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairwright.functions.affine import affine_gap
from pairwright.functions.scoring import NEAR_BODIES, NEAR_DRIVES, either
from pairwright.functions.text import pair_cosine
from pairwright.functions.values import number

Comparator = Callable[[Column, Column], Column]

def _distance(same: Column) -> Column:
    return F.when(same, 0).otherwise(1)


def other_distance(a: Column, b: Column, equal_is_match: bool = False) -> Column:
    """0 if either side is 'other'. Equal values count as different unless
    ``equal_is_match`` is set: that is the rule the matcher was built on."""
    same = (a == "other") | (b == "other")
    return _distance(same | (a == b) if equal_is_match else same)


def body_distance(a: Column, b: Column, equal_is_match: bool = False) -> Column:
    same = (a == "other") | (b == "other") | either(a, b, NEAR_BODIES)
    return _distance(same | (a == b) if equal_is_match else same)


def drive_distance(a: Column, b: Column, equal_is_match: bool = False) -> Column:
    same = either(a, b, NEAR_DRIVES)
    return _distance(same | (a == b) if equal_is_match else same)


def string_distance(a: Column, b: Column) -> Column:
    """Edit distance divided by the longer length."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 0.0).otherwise(F.levenshtein(a, b) / longest)


def affine_distance(a: Column, b: Column) -> Column:
    """Affine-gap distance divided by both lengths together: what equal texts cost is the least, not 0."""
    return affine_gap(a, b)


def text_distance(a: Column, b: Column) -> Column:
    return 1 - pair_cosine(a, b)


def exact_distance(a: Column, b: Column) -> Column:
    return _distance(a == b)


def price_distance(a: Column, b: Column) -> Column:
    """Distance of the logarithms; null unless both are positive numbers."""
    x, y = number(a.cast("string")), number(b.cast("string"))
    return F.when((x > 0) & (y > 0), F.abs(F.log10(x) - F.log10(y)))


# Those worth comparing once for values that meet in many pairs.
COSTLY: tuple[Comparator, ...] = (affine_distance, text_distance)

DEFAULT_COMPARATORS: dict[str, Comparator] = {
    "manufacturer": affine_distance,
    "model": text_distance,
    "year": exact_distance,
    "mileage": price_distance,
    "fuel_type": other_distance,
    "transmission": affine_distance,
    "body_type": body_distance,
    "cylinders": other_distance,
    "drive": drive_distance,
    "color": text_distance,
}


def comparison_features(side_a: Callable[[str], Column], side_b: Callable[[str], Column],
                        comparators: dict[str, Comparator] | None = None) -> list[Column]:
    """One distance ``d_<field>`` (0 when undefined) and one 0/1 indicator
    ``m_<field>`` (value missing on a side) per compared field."""
    out = []
    for field, compare in (comparators or DEFAULT_COMPARATORS).items():
        a, b = side_a(field), side_b(field)
        missing = a.isNull() | b.isNull()
        distance = F.when(~missing, compare(a, b).cast("double"))
        out.append(F.coalesce(distance, F.lit(0.0)).alias(f"d_{field}"))
        out.append(missing.cast("int").alias(f"m_{field}"))
    return out
