"""Predicates and reasons: what a row is kept, held or refused for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def optional(df: DataFrame, *pairs: tuple[object, Column]) -> DataFrame:
    """Keeps the rows that meet every predicate whose argument was given (is not None)."""
    given = [p for value, p in pairs if value is not None]
    return df.where(reduce(lambda a, b: a & b, given)) if given else df


def half_open(at: Column, start: object, end: object) -> Column:
    return (at >= F.lit(start)) & (at < F.lit(end))


def contains_text(columns: list[Column], text: str) -> Column:
    """Case-blind substring over the columns, nulls counting as empty."""
    joined = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in columns])
    return F.contains(F.lower(joined), F.lit(text.lower()))


def any_matches(columns: list[Column], pattern: str) -> Column:
    """Whether a column matches a regular expression, whatever the case; null columns do not."""
    return reduce(lambda a, b: a | b, [F.coalesce(c.rlike(f"(?i){pattern}"), F.lit(False)) for c in columns])


def has_prefix(path: Column, prefix: str) -> Column:
    """Case-blind, and without wildcards, unlike LIKE."""
    return F.lower(path).startswith(prefix.lower())


def non_empty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def first_reason(rules: list[tuple[Column, str]]) -> Column:
    """The label of the first rule that holds, null if none does. Rules that are null do not hold."""
    out = F.when(rules[0][0], rules[0][1])
    for rule, label in rules[1:]:
        out = out.when(rule, label)
    return out


def split_by(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """The rows that meet a rule and the others, those where it is null among these."""
    held = F.coalesce(rule, F.lit(False))
    return df.where(held), df.where(~held)


def pick_by_shape(columns: list[Column], pattern: str) -> Column:
    """The first of a row's values that matches a pattern as a whole."""
    return F.try_element_at(F.filter(F.array(*[c.cast("string") for c in columns]), lambda x: x.rlike(f"^(?:{pattern})$")), F.lit(1))


def valid_point(lat: Column, lon: Column) -> Column:
    """Coordinates (text or numbers) on the globe that are not the (0, 0) of an empty field."""
    y, x = lat.try_cast("double"), lon.try_cast("double")
    return F.coalesce(y.between(-90, 90) & x.between(-180, 180) & ~((y == 0) & (x == 0)), F.lit(False))
