"""Claims, answers, votes and duplicates: which of several opinions or copies stands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernglass.operators.aggregates import latest


def resolve(claims: DataFrame, live: DataFrame, rank: Column) -> DataFrame:
    """hash, field, value, source: the best claim for each, by rank, then confidence (high first), then value.

    claims: hash, field, value, source, confidence. Only hashes in live count.
    """
    held = claims.join(live.select("hash").distinct(), "hash", "left_semi").withColumn("_rank", rank)
    best = F.min_by(F.struct("value", "source"), F.struct("_rank", -F.col("confidence"), "value", "source")).alias("_b")
    return held.groupBy("hash", "field").agg(best).select("hash", "field", "_b.value", "_b.source")


def overlay(resolved: DataFrame, answers: DataFrame) -> DataFrame:
    """resolved with the newest answer of each (hash, field) above every machine value; its source is human.

    answers: hash, field, value, at, seq.
    """
    top = latest(answers, ["hash", "field"], "at", "seq").select("hash", "field", "value", F.lit("human").alias("source"))
    return top.unionByName(resolved.join(top, ["hash", "field"], "left_anti"))


def superseded(asserted: DataFrame, keys: list[str], value: str, *order: Column | str) -> DataFrame:
    """keys, value: whatever was said once and is not what is said last."""
    now = latest(asserted, keys, *order).select(*keys, value)
    return asserted.select(*keys, value).distinct().join(now, [*keys, value], "left_anti")


def tally(votes: DataFrame, item: list[str], voter: str, yes: Column, no: Column, *order: Column | str) -> DataFrame:
    """item, yes, no, verdict of each voter's latest vote: more yes adds, more no removes, a tie changes nothing."""
    last = latest(votes, [*item, voter], *order)
    counts = last.groupBy(*item).agg(F.count_if(yes).alias("yes"), F.count_if(no).alias("no"))
    return counts.withColumn("verdict", F.when(F.col("yes") > F.col("no"), "add").when(F.col("no") > F.col("yes"), "remove").otherwise("unchanged"))


def plurality(votes: DataFrame, group: str, key: Column, spelling: str, at: str) -> DataFrame:
    """group, name, n, contested: the name that most say, in the spelling said first; contested if another has as many.

    On a tie the name said first leads, then the least.
    """
    said = votes.withColumn("_key", key).groupBy(group, "_key").agg(F.count("*").alias("n"), F.min(at).alias("_first"), F.min_by(spelling, F.struct(at, spelling)).alias("name"))
    w = Window.partitionBy(group).orderBy(F.desc("n"), "_first", "_key")
    rows = said.withColumns({"_k": F.row_number().over(w), "_next": F.lead("n").over(w)}).where("_k = 1")
    return rows.select(group, "name", "n", F.coalesce(F.col("_next") == F.col("n"), F.lit(False)).alias("contested"))


def bridge(sources: list[tuple[str, DataFrame]], keys: list[str]) -> DataFrame:
    """keys, source: each key once, by the first of the sources that has it."""
    rows = reduce(DataFrame.unionByName, [t.select(*keys).distinct().withColumns({"source": F.lit(n), "_p": F.lit(i)}) for i, (n, t) in enumerate(sources)])
    return rows.groupBy(*keys).agg(F.min_by("source", "_p").alias("source"))


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], update: Column | None = None) -> DataFrame:
    """target with changes by key. update: whether a change to a row that exists is taken (over n_ columns of the change
    and the row's own); None takes all."""
    fields = [c for c in target.columns if c not in keys]
    new = changes.select(*keys, *[F.col(c).alias(f"n_{c}") for c in fields], F.lit(True).alias("_new"))
    both = target.withColumn("_old", F.lit(True)).join(new, keys, "full_outer")
    take = F.col("_new").isNotNull() & (F.col("_old").isNull() | F.coalesce(F.lit(True) if update is None else update, F.lit(False)))
    return both.select(*keys, *[F.when(take, F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) for c in fields])


def keep_newest_days(df: DataFrame, at: str, days: int) -> DataFrame:
    """The rows of the newest so many distinct days. The days go through one task, not the rows."""
    marks = df.select(F.to_date(at).alias("_day")).distinct().orderBy(F.desc("_day")).limit(days)
    return df.withColumn("_day", F.to_date(at)).join(marks, "_day", "left_semi").drop("_day")


def duplicate_tiers(df: DataFrame, key: str, size: str, ends: Column, whole: Column) -> DataFrame:
    """key, tier: unique size, unique ends, unique content or duplicate; only whole content declares a duplicate.

    Sizes and ends are counted with partial sums, over rows without their content. Contents are read once more, and
    digested, only for rows whose size and ends agree with another's. A null size is a size of its own.
    """
    small = df.select(key, F.col(size).alias("_s"), ends.alias("_e"))
    counts = small.groupBy("_s", "_e").agg(F.count("*").alias("_m"))
    sizes = counts.groupBy("_s").agg(F.sum("_m").alias("_n"))
    counts = counts.join(sizes.withColumnRenamed("_s", "_s2"), F.col("_s").eqNullSafe(F.col("_s2"))).select(F.col("_s").alias("_s1"), F.col("_e").alias("_e1"), "_n", "_m")
    told = small.join(counts, F.col("_s").eqNullSafe(F.col("_s1")) & F.col("_e").eqNullSafe(F.col("_e1"))).select(key, "_n", "_m")
    apart = told.where("_n = 1 or _m = 1").select(key, F.when(F.col("_n") == 1, "unique size").otherwise("unique ends").alias("tier"))
    close = df.join(told.where("_n > 1 and _m > 1").select(key), key, "left_semi").select(key, whole.alias("_w"))
    copies = close.groupBy("_w").agg(F.count("*").alias("_c")).withColumnRenamed("_w", "_w1")
    whole_told = close.join(copies, F.col("_w").eqNullSafe(F.col("_w1")))
    return apart.unionByName(whole_told.select(key, F.when(F.col("_c") > 1, "duplicate").otherwise("unique content").alias("tier")))


def blocked(df: DataFrame, block: DataFrame, size: str, digest: str) -> DataFrame:
    """df with `blocked`: its size is listed and its digest is listed with it, or is not known."""
    sizes = block.select(size).distinct().withColumn("_size", F.lit(True))
    listed = block.select(size, digest).distinct().withColumn("_listed", F.lit(True))
    rows = df.join(sizes, size, "left").join(listed, [size, digest], "left")
    return rows.withColumn("blocked", F.coalesce(F.col("_listed") | (F.col("_size") & F.col(digest).isNull()), F.lit(False))).drop("_size", "_listed")


def move_plan(moves: DataFrame, dest: str, digest: str, key: str) -> DataFrame:
    """moves with `action` and `to`: the first of a destination keeps its name, equals of it are skipped, others get a number."""
    w = Window.partitionBy(dest).orderBy(key)
    first = F.first(digest).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = moves.withColumns({"_k": F.row_number().over(w), "_same": F.col(digest) == first})
    action = F.when(F.col("_k") == 1, "move").when(F.col("_same"), "skip").otherwise("rename")
    n = F.count_if(~F.col("_same")).over(w)
    to = F.when(F.col("_k") == 1, F.col(dest)).when(~F.col("_same"), F.concat(F.col(dest), F.lit("-"), n.cast("string")))
    return moves.select("*").join(rows.select(key, action.alias("action"), to.alias("to")), key)
