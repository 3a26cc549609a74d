"""Digests that Spark has no function for."""

from __future__ import annotations

import hashlib
import uuid

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def blake2b_256(content: pd.Series) -> pd.Series:
    """Hexadecimal BLAKE2b of 32 bytes of a binary column."""
    return content.map(lambda b: None if b is None else hashlib.blake2b(bytes(b), digest_size=32).hexdigest())


@F.pandas_udf(T.StringType())
def uuid5(name: pd.Series) -> pd.Series:
    """Name-based UUID in the URL namespace: the same name always has the same id."""
    return name.map(lambda s: None if s is None else str(uuid.uuid5(uuid.NAMESPACE_URL, s)))


def signature(content: Column, window: int) -> Column:
    """Digest of a text's length and both ends; a tail only where the text is longer than two windows."""
    n = F.length(content)
    tail = F.when(n > 2 * window, F.substring(content, -window, window)).otherwise("")
    return F.md5(F.concat_ws("|", n.cast("string"), F.substring(content, 1, window), tail).cast("binary"))


def keyed(secret: str, *parts: Column) -> Column:
    """A keyed digest of values, separated so that they can't run together."""
    return F.sha2(F.concat_ws("|", F.lit(secret), *parts), 256)
