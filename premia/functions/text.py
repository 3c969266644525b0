"""Text expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that mark a title, in order of precedence by class.
COLLAB_TOKENS = [
    "off-white", "travis scott", "fragment", "union", "supreme", "dior",
    " x ", "kaws", "sacai", "ambush", "cactus jack",
]
LIMITED_TOKENS = ["yeezy", "retro high og", "limited"]


def contains_any(text: Column, tokens: list[str]) -> Column:
    """True where the text holds at least one of the tokens."""
    return reduce(Column.__or__, (text.contains(token) for token in tokens))


def classify_release(title: Column) -> Column:
    """Release class of a title: collab before limited before general."""
    padded = F.concat(F.lit(" "), F.lower(F.coalesce(title, F.lit(""))), F.lit(" "))
    return (
        F.when(contains_any(padded, COLLAB_TOKENS), "collab")
        .when(contains_any(padded, LIMITED_TOKENS), "limited")
        .otherwise("general")
    )


def strip(text: Column) -> Column:
    """Text without outer white space; NULL gives ''."""
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\r\x0b\x0c"))


def brands_conflict(left: Column, right: Column) -> Column:
    """True where both brands are given and differ, ignoring case and outer white space."""
    a = F.lower(strip(left))
    b = F.lower(strip(right))
    return (a != "") & (b != "") & (a != b)
