"""Weighted rule scores of two field values.

A value that is null or '' on either side scores 0 everywhere. Weights and
partial credits are fixed values of the rule set.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairwright.functions.text import pair_cosine
from pairwright.functions.values import blank_if_null, whole_number

NEAR, VAGUE = 0.8, 0.3
MATCH_THRESHOLD = 0.70

# Categories that count as nearly the same, in either order.
NEAR_FUELS = [("flex fuel vehicle", "gasoline"), ("biodiesel", "diesel")]
NEAR_BODIES = [("truck", "pickup"), ("offroad", "suv"), ("offroad", "pickup")]
NEAR_DRIVES = [("4wd", "awd"), ("fwd", "4x2"), ("rwd", "4x2")]


def either(a: Column, b: Column, pairs: list[tuple[str, str]]) -> Column:
    """The two values are one of the listed pairs, in any order."""
    tests = [((a == x) & (b == y)) | ((a == y) & (b == x)) for x, y in pairs]
    return reduce(or_, tests)


def _present(a: Column, b: Column) -> Column:
    return (a != "") & (b != "")


def model_score(a: Column, b: Column, max_score: float = 0.5) -> Column:
    return pair_cosine(a, b) * F.lit(max_score)


def mileage_score(a: Column, b: Column, max_score: float = 0.1, max_diff: int = 50000) -> Column:
    x, y = whole_number(a), whole_number(b)
    # A difference beyond 64 bits is null, and so scores 0.
    diff = F.try_subtract(F.greatest(x, y), F.least(x, y))
    return F.when(x.isNotNull() & y.isNotNull() & (diff <= max_diff), F.lit(max_score) * (1 - diff / F.lit(float(max_diff)))).otherwise(0.0)


def _category_score(a: Column, b: Column, max_score: float, near: list[tuple[str, str]],
                    vague: Callable[[Column, Column], Column] | None) -> Column:
    x, y = F.lower(blank_if_null(a)), F.lower(blank_if_null(b))
    score = F.when(~_present(x, y), 0.0).when(x == y, max_score)
    if near:
        score = score.when(either(x, y, near), max_score * NEAR)
    if vague is not None:
        score = score.when(vague(x, y), max_score * VAGUE)
    return score.otherwise(0.0)


def _any_other(x: Column, y: Column) -> Column:
    return (x == "other") | (y == "other")


def _other_against_plain_body(x: Column, y: Column) -> Column:
    # 'truck' and 'offroad' match their own relatives only, not 'other'.
    narrow = ("truck", "offroad")
    return _any_other(x, y) & ~x.isin(*narrow) & ~y.isin(*narrow)


def fuel_score(a: Column, b: Column, max_score: float = 0.05) -> Column:
    return _category_score(a, b, max_score, NEAR_FUELS, _any_other)


def body_score(a: Column, b: Column, max_score: float = 0.05) -> Column:
    return _category_score(a, b, max_score, NEAR_BODIES, _other_against_plain_body)


def cylinders_score(a: Column, b: Column, max_score: float = 0.03) -> Column:
    return _category_score(a, b, max_score, [], _any_other)


def drive_score(a: Column, b: Column, max_score: float = 0.02) -> Column:
    return _category_score(a, b, max_score, NEAR_DRIVES, None)


def color_score(a: Column, b: Column, max_score: float = 0.02) -> Column:
    return _category_score(a, b, max_score, [], None)


def exact_score(a: Column, b: Column, max_score: float) -> Column:
    x, y = blank_if_null(a), blank_if_null(b)
    return F.when(_present(x, y) & (x == y), max_score).otherwise(0.0)


def pair_score(side_a: Callable[[str], Column], side_b: Callable[[str], Column]) -> Column:
    """Total score of a pair. ``side_a('year')`` is A's year column, and so on.

    The terms are added in a set order: the sum is compared with a threshold,
    so its last bit matters.
    """
    def both(scorer, field, **kw):
        return scorer(side_a(field), side_b(field), **kw)

    terms = [
        both(model_score, "model"),
        both(exact_score, "manufacturer", max_score=0.2),
        both(exact_score, "year", max_score=0.1),
        both(mileage_score, "mileage"),
        both(fuel_score, "fuel_type"),
        both(exact_score, "transmission", max_score=0.05),
        both(body_score, "body_type"),
        both(cylinders_score, "cylinders"),
        both(drive_score, "drive"),
        both(color_score, "color"),
    ]
    return reduce(lambda total, term: total + term, terms)


def match_flag(score: Column, threshold: float = MATCH_THRESHOLD) -> Column:
    return (score >= F.lit(threshold)).cast("int")
