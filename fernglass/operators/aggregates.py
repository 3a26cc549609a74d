"""Aggregations, windows and rankings."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pivot_wide(df: DataFrame, key: str, field: str, value: str, fields: list[str]) -> DataFrame:
    """Long (key, field, value) to one column for each field, the greatest value of each; the fields are given, not looked up."""
    return df.groupBy(key).pivot(field, fields).agg(F.max(value))


def mode_of(df: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """The most frequent value of each group, the least one on ties, nulls aside.

    Counts come first, so that a large group meets as few rows as it has values.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(alias))


def joined_names(name: str, separator: str = "; ") -> Column:
    return F.array_join(F.array_sort(F.collect_set(name)), separator)


def mean_vectors(df: DataFrame, keys: list[str], vector: str, weight: Column | None = None) -> DataFrame:
    """keys, n (sum of weights), centre: the (weighted) mean, position by position with partial sums."""
    w = F.lit(1.0) if weight is None else weight.cast("double")
    parts = df.select(*keys, w.alias("_w"), F.posexplode(vector).alias("_i", "_x"))
    sums = parts.groupBy(*keys, "_i").agg(F.sum(F.col("_w") * F.col("_x")).alias("_s"), F.sum("_w").alias("n"))
    rows = sums.groupBy(*keys, "n").agg(F.array_sort(F.collect_list(F.struct("_i", "_s"))).alias("_a"))
    return rows.select(*keys, "n", F.transform("_a", lambda p: p["_s"] / F.col("n")).alias("centre"))


def top_values(df: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    """keys, top: the k most frequent values, (count desc, value) in order."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("_n"), value)
    best = counts.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= k)
    return best.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_k", value))).alias("_a")).select(*keys, F.transform("_a", lambda p: p[value]).alias("top"))


def coverage(df: DataFrame, columns: dict[str, Column | None]) -> DataFrame:
    """field, filled, applicable, share: non-empty values of each column among the rows that it applies to (None: all)."""
    aggs = []
    for c, applies in columns.items():
        on = F.lit(True) if applies is None else F.coalesce(applies, F.lit(False))
        full = F.col(c).isNotNull() & (F.col(c).cast("string") != "")
        aggs += [F.count_if(on & full).alias(f"f_{c}"), F.count_if(on).alias(f"a_{c}")]
    cells = ", ".join(f"'{c}', f_{c}, a_{c}" for c in columns)
    rows = df.agg(*aggs).selectExpr(f"stack({len(columns)}, {cells}) as (field, filled, applicable)")
    return rows.withColumn("share", F.when(F.col("applicable") > 0, F.round(F.col("filled") / F.col("applicable"), 4)))


def latest(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key in an order, which should end in a unique column.

    Names alone mean that the greatest comes first, nulls last: then a key's rows meet as partial maxima and are never
    sorted. Other orders take a window, which sorts each key.
    """
    if all(isinstance(o, str) for o in order):
        rest = [c for c in df.columns if c not in keys]
        best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_best")
        return df.groupBy(*keys).agg(best).select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_k = 1").drop("_k")


def sessions(df: DataFrame, keys: list[str], at: str, tie: str, gap: str, least: int = 1) -> DataFrame:
    """keys, run, start, finish, n: runs of rows of which each is at most the gap after the last; a longer gap starts anew.

    Rows with a null time belong to no run; runs of fewer than `least` rows are left out.
    """
    w = Window.partitionBy(*keys).orderBy(at, tie)
    rows = df.where(F.col(at).isNotNull()).withColumn("_new", F.coalesce((F.col(at) > F.lag(at).over(w) + F.expr(f"interval {gap}")).cast("int"), F.lit(1)))
    rows = rows.withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "run").agg(F.min(at).alias("start"), F.max(at).alias("finish"), F.count("*").alias("n")).where(F.col("n") >= least)


def batches_by_size(df: DataFrame, keys: list[str], order: list[str], size: str, limit: float) -> DataFrame:
    """keys, order, batch: consecutive rows of a key as long as their sizes stay within the limit; a larger row is alone.

    The sum starts anew with each batch, which no running sum can say: the rows of a key pass through one task, sorted on
    disk, which carries the sum and the number from row to row and holds one Arrow batch. A null size counts as nothing.
    """
    rows = df.select(*keys, *order, F.coalesce(F.col(size).cast("double"), F.lit(0.0)).alias("_size"))
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, *order)
    kinds = dict(df.dtypes)
    n = len(keys)

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, used, batch = None, 0.0, 0
        for t in tables:
            out = []
            for own, x in zip(zip(*(t.column(i).to_pylist() for i in range(n))), t.column(t.num_columns - 1).to_pylist()):
                if own != last:
                    last, used, batch = own, 0.0, 0
                if batch and used + x <= limit:
                    used += x
                else:
                    used, batch = x, batch + 1
                out.append(batch)
            yield pa.RecordBatch.from_arrays([*t.columns[:-1], pa.array(out, pa.int32())], names=[*keys, *order, "batch"])

    return dealt.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in [*keys, *order]) + ", batch int")
