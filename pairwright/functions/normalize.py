"""Category normalisers for listing columns. Null stays null throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairwright.functions.values import strip

# Rewrites of single categories.
FUEL_RENAMES = {"gas": "gasoline"}
TRANSMISSION_RENAMES = {
    "a": "automatic", "m": "manual", "cvt": "other", "dual clutch": "other",
}
BODY_RENAMES = {"suv / crossover": "suv", "pickup truck": "pickup"}
BLOCK_FUEL_RENAMES = {
    "flex fuel vehicle": "gasoline", "biodiesel": "diesel",
    "compressed natural gas": "other", "propane": "other",
}
# Colour families, first one contained in the text wins.
COLORS = (
    "white", "black", "silver", "blue", "grey", "red", "green", "custom",
    "brown", "yellow", "orange", "purple",
)


def renamed(c: Column, renames: dict[str, str]) -> Column:
    """Whole-value replacement; values outside the table pass through."""
    pairs = [F.lit(x) for kv in renames.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c)


def manufacturer(c: Column) -> Column:
    return F.translate(F.lower(c), "- ", "")


def fuel_type(c: Column) -> Column:
    return renamed(F.lower(strip(c)), FUEL_RENAMES)


def model(c: Column) -> Column:
    return F.lower(c)


def transmission(c: Column) -> Column:
    return renamed(F.lower(c), TRANSMISSION_RENAMES)


def body_type(c: Column) -> Column:
    return F.translate(renamed(F.lower(c), BODY_RENAMES), " -", "")


def cylinders(c: Column) -> Column:
    """First digit run as a number; a bare '2' and digit-free texts are 'other'."""
    digits = F.regexp_extract(c, "[0-9]+", 0)
    return (
        F.when(c.isNull(), None)
        .when(digits.isin("", "2"), "other")
        .otherwise(F.regexp_replace(digits, "^0+(?=.)", ""))
    )


def drive(c: Column) -> Column:
    return F.lower(c)


def color(c: Column) -> Column:
    text = F.replace(F.lower(c), F.lit("gray"), F.lit("grey"))
    families = [F.when(F.contains(text, F.lit(name)), name) for name in COLORS]
    return F.coalesce(*families, text)


def block_fuel(c: Column) -> Column:
    """Fuel category for blocking: near-equal fuels share a key."""
    return renamed(F.lower(strip(c)), BLOCK_FUEL_RENAMES)


NORMALIZERS = {
    "manufacturer": manufacturer,
    "fuel_type": fuel_type,
    "color": color,
    "drive": drive,
    "transmission": transmission,
    "body_type": body_type,
    "cylinders": cylinders,
    "model": model,
}
