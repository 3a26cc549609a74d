"""Names, paths and free text as column functions. Built-ins throughout, but for NFKC, OSA distance and stemming."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def nfkc(values: pd.Series) -> pd.Series:
    """Compatibility composition, which Spark has no function for."""
    return values.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s))


def name_key(name: Column, compose: bool = False) -> Column:
    """Lower case, runs of all but letters and digits as one blank, trimmed. compose: NFKC first (not for plain data)."""
    return F.trim(F.regexp_replace(F.lower(nfkc(name) if compose else name), r"[^\p{L}\p{N}]+", " "))


def fold(name: Column, compose: bool = False) -> Column:
    """As name_key, but without any blank: 'a b' equals 'ab' here and not there."""
    return F.regexp_replace(F.lower(nfkc(name) if compose else name), r"[^\p{L}\p{N}]+", "")


def place_key(name: Column) -> Column:
    """As fold, null where nothing is left."""
    return F.nullif(fold(name), F.lit(""))


def _osa(a: str, b: str) -> int:
    """Edits, a swap of neighbours being one, with no part edited twice."""
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, now[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                cost = min(cost, before[j - 2] + 1)
            now.append(cost)
        before, last = last, now
    return last[-1]


@F.pandas_udf(T.IntegerType())
def osa_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Optimal string alignment distance; null if either side is."""
    return pd.Series([None if x is None or y is None else _osa(x, y) for x, y in zip(a, b)], dtype="Int32")


def slack(name: Column) -> Column:
    """Edits that a name of this length may be off by: 0, 1 from 3 characters, 2 from 5, 3 from 9."""
    n = F.length(name)
    return F.when(n >= 9, 3).when(n >= 5, 2).when(n >= 3, 1).otherwise(0)


def close_score(typed: str, known: str) -> float | None:
    """Distance of a typed name to a known one within the slack of the longer, else word by word at 0.5 more; None if far, or the same."""

    def room(s: str) -> int:
        return 3 if len(s) >= 9 else 2 if len(s) >= 5 else 1 if len(s) >= 3 else 0

    def near(a: str, b: str) -> int | None:
        d = _osa(a, b)
        return d if d <= max(room(a), room(b)) else None

    if not typed or not known:
        return None
    if (d := near(typed, known)) is not None:
        return float(d) if d else None
    left = known.split()
    total = 0
    for word in typed.split():
        found = [(d, i) for i, w in enumerate(left) if (d := near(word, w)) is not None]
        if not found:
            return None
        d, i = min(found)
        total += d
        del left[i]
    return total + 0.5


def close_names(typed: str, known: list[str], most: int = 3) -> list[str]:
    """The closest known names, best first, then by name; none if the typed one is known."""
    if typed in known:
        return []
    scored = sorted((s, k) for k in set(known) if (s := close_score(typed, k)) is not None)
    return [k for _, k in scored[:most]]


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dirname(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def extension(path: Column) -> Column:
    """Lower-case extension without its dot, empty if there is none."""
    return F.lower(F.regexp_extract(basename(path), r"\.([A-Za-z0-9]+)$", 1))


def leaf_folder(path: Column) -> Column:
    return basename(dirname(path))


def digit_shape(name: Column) -> Column:
    """Each run of digits as one #."""
    return F.regexp_replace(name, r"\d+", "#")


def clock(seconds: Column) -> Column:
    """h:mm:ss, or m:ss below an hour."""
    h, m, s = (seconds / 3600).cast("long"), F.pmod((seconds / 60).cast("long"), F.lit(60)), F.pmod(seconds.cast("long"), F.lit(60))
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, s)).otherwise(F.format_string("%d:%02d", m, s))


def mask(text: Column, literals: list[str], by: str = "***") -> Column:
    """Replaces literals, longest first, whatever their case."""
    out = text
    for literal in sorted(literals, key=lambda s: (-len(s), s)):
        out = F.regexp_replace(out, F.lit("(?i)" + _quoted(literal)), F.lit(by))
    return out


def _quoted(literal: str) -> str:
    return "".join(c if c.isalnum() or c == " " else "\\" + c for c in literal)


def outermost_json(text: Column) -> Column:
    """From the first { to the last }, empty if there is none."""
    return F.regexp_extract(text, r"(?s)\{.*\}", 0)
