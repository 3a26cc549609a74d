"""Running sums and systematic samples on wide tables dealt over many partitions."""

import pytest
from pyspark.sql import functions as F

from fernglass.operators import plans, quality
from fernglass.operators.running import with_running

SETTINGS = [("40", "true"), ("40", "false"), ("3", "true")]


@pytest.fixture(params=SETTINGS, ids=lambda s: "-".join(s))
def dealt(spark, request):
    conf = {"spark.sql.shuffle.partitions": request.param[0], "spark.sql.adaptive.coalescePartitions.enabled": request.param[1], "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def wide(spark, n):
    return spark.range(n).repartition(7).select("id", (F.col("id") % 5 + 1).alias("n"), F.repeat(F.md5(F.col("id").cast("string")), 20).alias("text"), F.lit("x").alias("_range"), F.array("id").alias("many"))


def test_every_nth_of_a_wide_table(dealt):
    got = quality.every_nth(wide(dealt, 20_000), "id", 97)
    assert got.columns == ["id", "n", "text", "_range", "many"]
    assert sorted(r.id for r in got.collect()) == list(range(0, 20_000, 97))


def test_every_nth_of_orders(dealt):
    orders = dealt.read.parquet("/root/testdata/sf0.01/orders.parquet")
    keys = sorted(r[0] for r in orders.select("o_orderkey").collect())
    assert sorted(r.o_orderkey for r in quality.every_nth(orders, "o_orderkey", 97).collect()) == keys[::97]


def test_budget_of_a_wide_table(dealt):
    got = plans.within_budget(wide(dealt, 20_000), "n", 30_000, "id")
    assert sorted(r.id for r in got.collect()) == list(range(10_000))


def test_running_with_ties_nulls_and_repeated_rows(dealt):
    rows = [(None, 1.0, "a"), (None, None, "b")] + [(1, 2.0, "same")] * 30 + [(k % 3, float(k), str(k)) for k in range(60)]
    df = dealt.createDataFrame(rows, "k int, v double, s string").repartition(5)
    got = with_running(df, ["k"], F.lit(1).cast("long"), "rank").collect()
    assert sorted(r["rank"] for r in got) == list(range(1, len(rows) + 1))
    ordered = [r.k for r in sorted(got, key=lambda r: r["rank"])]
    assert ordered == sorted(ordered, key=lambda k: (k is not None, k))
    assert with_running(df.limit(0), ["k"], F.lit(1).cast("long"), "rank").count() == 0
    kept = plans.within_budget(df, "v", 3.0, "k").collect()
    assert sum(r.v or 0 for r in kept) <= 3.0 and {(r.s) for r in kept} >= {"a", "b"}
