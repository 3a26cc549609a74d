"""Decisions that other tools act on: what is held, what may go, what is new. Nothing is moved or deleted here."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernglass.operators.running import with_running


def staged(df: DataFrame, stages: list[tuple[str, list[str], DataFrame]], otherwise: str, alias: str = "proof") -> DataFrame:
    """df with the name of the first stage whose table has the row's keys."""
    for i, (_, keys, table) in enumerate(stages):
        df = df.join(table.select(*keys).distinct().withColumn(f"_s{i}", F.lit(True)), keys, "left")
    told = reduce(lambda rest, i: F.when(F.col(f"_s{i}"), stages[i][0]).otherwise(rest), range(len(stages) - 1, -1, -1), F.lit(otherwise))
    return df.withColumn(alias, told).drop(*[f"_s{i}" for i in range(len(stages))])


def bucketed(value: Column, edges: list[float]) -> Column:
    """Which of the intervals (< e1, < e2, ..., the rest) a value is in, from 0."""
    out = F.when(value < edges[0], 0)
    for i, e in enumerate(edges[1:], 1):
        out = out.when(value < e, i)
    return out.otherwise(len(edges))


def within_budget(df: DataFrame, size: str, limit: float, *order: str) -> DataFrame:
    """The rows, in order (nulls first, ties by the rows' hashes), whose running size stays within a limit.

    A null size counts as nothing. The running sum is made in two levels, over ranges and inside them, so that no task
    has all rows.
    """
    return with_running(df, list(order), F.coalesce(F.col(size), F.lit(0)), "_run").where(F.col("_run") <= limit).drop("_run")


def rebased(shards: DataFrame, shard: str, id_col: str) -> DataFrame:
    """Ids of several shards as one sequence: each shard's are raised by the sizes of those before it."""
    sizes = shards.groupBy(shard).agg((F.max(id_col) + 1).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(shard).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return shards.join(sizes.select(shard, before.alias("_b")), shard).withColumn(id_col, F.col(id_col) + F.col("_b")).drop("_b")


def catch_rate(terms: DataFrame, term: str, texts: DataFrame, text: str, most: float) -> DataFrame:
    """term, caught, share, refused: how many texts each term would catch; catch-all terms are refused.

    terms is a short list (checked: 10,000); all texts are read once, with all terms' counts made on the way.
    """
    words = [r[0] for r in terms.select(term).distinct().limit(10_001).collect()]
    if len(words) > 10_000:
        raise ValueError("more than 10,000 terms")
    hits = F.array_compact(F.array(*[F.when(F.contains(F.lower(text), F.lit(w.lower())), F.lit(w)) for w in sorted(words)]))
    total = texts.agg(F.count("*").alias("_all"))
    caught = texts.select(F.explode(hits).alias(term)).groupBy(term).agg(F.count("*").alias("caught"))
    rows = terms.select(term).distinct().join(caught, term, "left").crossJoin(total)
    share = F.round(F.coalesce("caught", F.lit(0)) / F.col("_all"), 6)
    return rows.select(term, F.coalesce("caught", F.lit(0)).cast("bigint").alias("caught"), share.alias("share"), (share > most).alias("refused"))
