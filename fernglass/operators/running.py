"""Running sums over a whole table in two levels: within ranges of the order, and over the ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that the rows are dealt to at most, and rows of the sample, about, from which their borders are taken.
RANGES, SAMPLE = 256, 8_192
#: Borders of a block: a row is compared with each block's last border, then with the borders of its own block.
BLOCK = 16


def with_running(df: DataFrame, order: list[str], value: Column, alias: str, **more: Column) -> DataFrame:
    """df with the sum of value over the rows up to and including each, by order and then by a hash of the whole row.

    more: further sums in the same order, by their names.

    A row's range is a column computed from its own order and from borders of a hashed sample (one row of RANGES borders
    at most), not from where it lies: both branches of the plan agree on it whatever columns they keep and however
    Spark deals them. Rows that are equal in all columns share a place in the order. Nulls come first.
    """
    names = df.columns
    flat = df.toDF(*[f"_{i}" for i in range(len(names))])  # so that no name of df clashes with those used here
    own = [f"_{i}" for i in range(len(names))]
    keys = [f"_{names.index(o)}" for o in order]
    # The order and the value are computed once, ahead of both branches, on df's own names.
    sums = {alias: value} | more
    cells = [f"_value{i}" for i in range(len(sums))]
    placed = df.select("*", *[v.alias(f"_value_{i}") for i, v in enumerate(sums.values())]).toDF(*own, *cells)
    hashed = F.xxhash64(*own)
    at = F.struct(*[F.col(k) for k in keys], hashed.alias("_hash"))
    rows = flat.agg(F.count("*").alias("_rows"))
    drawn = flat.select(at.alias("_at"), F.pmod(F.xxhash64(F.lit(17), *own), F.lit(1_000_003)).alias("_draw")).crossJoin(rows)
    drawn = drawn.where(F.col("_draw") * F.col("_rows") < F.lit(SAMPLE * 1_000_003)).agg(F.array_sort(F.collect_list("_at")).alias("_sample"))
    step = F.greatest(F.lit(1), F.ceil(F.size("_sample") / F.lit(RANGES)).cast("int"))
    borders = drawn.select(F.filter("_sample", lambda _, i: F.pmod(i, step) == step - 1).alias("_borders"))
    borders = borders.select("_borders", F.filter("_borders", lambda _, i: F.pmod(i, F.lit(BLOCK)) == BLOCK - 1).alias("_ends"))
    # As a lambda's argument a row's place, with its hash, is computed once and not for each border.
    below = lambda found, a: F.size(F.filter(found, lambda b: b < a))
    inner = lambda a: F.transform(F.array(below("_ends", a) * BLOCK), lambda k: k + below(F.slice("_borders", k + 1, BLOCK), a))[0]
    ranged = placed.withColumn("_at", at).crossJoin(F.broadcast(borders))
    ranged = ranged.withColumn("_range", F.transform(F.array("_at"), inner)[0]).drop("_borders", "_ends")
    totals = ranged.groupBy("_range").agg(*[F.sum(v).alias(f"_total{v}") for v in cells])  # RANGES + 1 rows at most
    over = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(f"_total{v}").over(over), F.lit(0)).alias(f"_before{v}") for v in cells]
    within = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    inside = ranged.withColumns({f"_inside{v}": F.sum(v).over(within) for v in cells})
    out = inside.join(F.broadcast(totals.select("_range", *before)), "_range")
    return out.select(*own, *[(F.col(f"_inside{v}") + F.col(f"_before{v}")).alias(f"_sum{v}") for v in cells]).toDF(*names, *sums)
