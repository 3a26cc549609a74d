"""Checks that may refuse: coverage, samples, agreement, guards before anything is taken away."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernglass.operators.running import with_running


def verdict(wrong: Column, checked: Column, sampled: Column) -> Column:
    """ok, wrong or cannot tell, from counts: a sample of which nothing was derived again is wrong."""
    return F.when(sampled == 0, "cannot tell").when((checked == 0) | (wrong > 0), "wrong").otherwise("ok")


def stratified(df: DataFrame, stratum: str, order: Column, n: int) -> DataFrame:
    """n rows of each stratum in an order, as by a hash of the key; reruns draw the same."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(stratum).orderBy(order))).where(F.col("_k") <= n).drop("_k")


def every_nth(df: DataFrame, key: str, n: int) -> DataFrame:
    """Every n-th row by key (nulls first), the first included; rows with equal keys in the order of their hashes.

    Ranks are counted in two levels, within key ranges and over them, so that no task holds all rows. Empty: no rows.
    """
    return with_running(df, [key], F.lit(1).cast("long"), "_rank").where((F.col("_rank") - 1) % n == 0).drop("_rank")


def removal_guard(known: DataFrame, listed: DataFrame, key: str, share: float = 0.2, few: int = 20) -> DataFrame:
    """One row: known, gone, allowed. Refuses an empty listing, and more than a share gone of more than a few known."""
    gone = known.join(listed.select(key).distinct(), key, "left_anti").agg(F.count("*").alias("gone"))
    counts = known.agg(F.count("*").alias("known")).crossJoin(gone).crossJoin(listed.agg(F.count("*").alias("listed")))
    refused = (F.col("listed") == 0) | ((F.col("known") > few) & (F.col("gone") > share * F.col("known")))
    return counts.select("known", "gone", (~refused).alias("allowed"))


def floor_guard(present: Column, expected: Column, share: float = 0.8) -> Column:
    return (expected > 0) & (present >= share * expected)


def completeness(truth: DataFrame, handled: DataFrame, part: str, member: str) -> DataFrame:
    """part, missing, verdict: members of the ground truth that were not handled; parts without ground truth can't pass."""
    lost = truth.join(handled, [part, member], "left_anti").groupBy(part).agg(F.count("*").alias("missing"))
    parts = handled.select(part).union(truth.select(part)).distinct()
    known = truth.select(part).distinct().withColumn("_known", F.lit(True))
    rows = parts.join(known, part, "left").join(lost, part, "left")
    told = F.when(F.col("_known").isNull(), "cannot tell").when(F.col("missing") > 0, "incomplete").otherwise("complete")
    return rows.select(part, F.coalesce("missing", F.lit(0)).cast("bigint").alias("missing"), told.alias("verdict"))
