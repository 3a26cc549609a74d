"""Rule classifiers: a label and the signal that decided it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fernglass.operators.filters import first_reason


def route(path: Column, rules: list[tuple[str, str, str]], otherwise: tuple[str, str]) -> Column:
    """struct(dest, why): the first rule (pattern, destination, why) whose pattern the path matches."""
    out = F.struct(F.lit(otherwise[0]).alias("dest"), F.lit(otherwise[1]).alias("why"))
    for pattern, dest, why in reversed(rules):
        out = F.when(path.rlike(pattern), F.struct(F.lit(dest).alias("dest"), F.lit(why).alias("why"))).otherwise(out)
    return out


def signals(tests: dict[str, Column]) -> Column:
    """The names of the tests that hold, in their order."""
    return F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()]))


def hold(sensitivity: Column, exposed: Column, age: Column, suggestive: Column, released: Column) -> Column:
    """The publication rule as a reason, null if the item may go out. What is not known is held.

    Class a never goes out, released or not, nor does a minor who is exposed; class b and adults exposed go out once
    released; class c goes out.
    """
    minor = (age == "child") | (age == "teen")
    return first_reason([
        (sensitivity.isNull(), "unknown"),
        (sensitivity == "a", "class a"),
        (minor & ((exposed != "none") | suggestive), "minor"),
        (age.isNull() & (exposed != "none"), "age unknown"),
        (((exposed != "none") | suggestive) & ~released, "not released"),
        ((sensitivity == "b") & ~released, "class b"),
    ])


def by_prefix(word: Column, mapping: dict[str, str], otherwise: str = "other") -> Column:
    """The name whose prefix the word starts with, longest prefix first."""
    out = F.lit(otherwise)
    for prefix in sorted(mapping, key=lambda s: (len(s), s)):
        out = F.when(word.startswith(prefix), mapping[prefix]).otherwise(out)
    return out


def holds_term(text: Column, terms: list[str]) -> Column:
    """Whether a term occurs anywhere, inside words too, whatever the case."""
    return reduce(lambda a, b: a | b, [F.contains(F.lower(text), F.lit(t.lower())) for t in terms], F.lit(False))


def tripwire(text: Column, terms: list[str], pseudonyms: list[str]) -> Column:
    """How often a sensitive term is left after pseudonyms have been taken out."""
    clean = text
    for p in sorted(pseudonyms, key=lambda s: (-len(s), s)):
        clean = F.regexp_replace(clean, F.lit("(?i)" + p), F.lit(""))
    return F.size(F.regexp_extract_all(clean, F.lit("(?i)(?:" + "|".join(terms) + ")"), F.lit(0)))
