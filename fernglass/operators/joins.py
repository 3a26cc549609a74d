"""Joins that say what they do: staged fallbacks, division, bands, arrays, scopes, completeness.

No side is broadcast by hint: sizes are Spark's to know (statistics, and AQE at run time).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernglass.operators.storage import written


def complete(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The inner join on keys, and the left rows that it would lose; a caller stops if there are any."""
    return left.join(right, keys), left.join(right.select(*keys).distinct(), keys, "left_anti")


def with_fallback(df: DataFrame, stages: list[tuple[str, list[str], DataFrame]], value: str) -> DataFrame:
    """df with `value` from the first stage that has one, and `kind`, that stage's name, or 'none'.

    A stage is (name, keys, table of keys and value). Keys with several values in a table are ambiguous and give none.
    """
    found = []
    for name, keys, table in stages:
        sure = table.groupBy(*keys).agg(F.min(value).alias(f"_{name}"), F.max(value).alias("_most")).where(F.col(f"_{name}") == F.col("_most")).drop("_most")
        df = df.join(sure, keys, "left")
        found.append(f"_{name}")
    kind = reduce(lambda rest, f: F.when(F.col(f).isNotNull(), f[1:]).otherwise(rest), reversed(found), F.lit("none"))
    return df.withColumns({value: F.coalesce(*found), "kind": kind}).drop(*found)


def holding_all(df: DataFrame, key: str, item: str, wanted: list) -> DataFrame:
    """Relational division: the keys that have every wanted item."""
    return df.where(F.col(item).isin(wanted)).groupBy(key).agg(F.count_distinct(item).alias("_n")).where(F.col("_n") == len(set(wanted))).select(key)


def near_in_time(df: DataFrame, anchors: DataFrame, key: str, at: str, minutes: int) -> DataFrame:
    """Rows of df with an anchor of the same key within so many minutes on either side, both ends included.

    Rows meet anchors by time cell: an anchor stands in its own cell and the two beside it, so that this is an equi
    join; null times match nothing.
    """
    width = minutes * 60
    cell = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000 / width)
    marks = anchors.where(F.col(at).isNotNull()).select(F.col(key).alias("_k"), F.col(at).alias("_at"), F.explode(F.array(*[cell(at) + i for i in (-1, 0, 1)])).alias("_cell"))
    close = F.abs(F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(F.col("_at").cast("timestamp"))) <= width * 1_000_000
    return df.withColumn("_own", cell(at)).join(marks, (F.col(key) == F.col("_k")) & (F.col("_own") == F.col("_cell")) & close, "left_semi").drop("_own")


def by_size_then_digest(left: DataFrame, right: DataFrame, size: str, content: str) -> DataFrame:
    """Left rows whose content is on the right: only rows whose size occurs there are hashed."""
    sized = left.join(right.select(size).distinct(), size, "left_semi").withColumn("_digest", F.sha2(content, 256))
    known = right.join(left.select(size).distinct(), size, "left_semi").select(size, F.sha2(content, 256).alias("_digest")).distinct()
    return sized.join(known, [size, "_digest"], "left_semi").drop("_digest")


def rename_prefixes(path: Column, renames: dict[str, str]) -> Column:
    """A path with its longest matching prefix renamed."""
    out = path
    for old in sorted(renames, key=lambda s: (len(s), s)):
        out = F.when(path.startswith(old), F.concat(F.lit(renames[old]), F.substring(path, len(old) + 1, 1_000_000))).otherwise(out)
    return out


#: Parts that a key which all rows share is dealt into.
SALTS = 256


def expand_scopes(answers: DataFrame, files: DataFrame) -> DataFrame:
    """Answers on a file, a folder, an origin, a cluster or all, as one row for each (answer, hash) they reach.

    answers: answer_id, scope, target; files: hash, folder, origin, cluster. A folder reaches what lies below it.
    """
    per = []
    for scope, column in (("file", "hash"), ("origin", "origin"), ("cluster", "cluster")):
        own = answers.where(F.col("scope") == scope)
        per.append(own.join(files, own["target"] == files[column]).select("answer_id", "hash"))
    parents = files.select("hash", F.explode(ancestors(F.col("folder"))).alias("above"))
    folder = answers.where(F.col("scope") == "folder")
    per.append(folder.join(parents, folder["target"] == parents["above"]).select("answer_id", "hash"))
    every = answers.where(F.col("scope") == "all").select("answer_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    per.append(every.join(files.select("hash", F.pmod(F.xxhash64("hash"), F.lit(SALTS)).cast("int").alias("_salt")), "_salt").select("answer_id", "hash"))
    return reduce(DataFrame.unionByName, per).distinct()


def ancestors(folder: Column) -> Column:
    """A folder and all that are above it: a/b/c, a/b, a."""
    parts = F.split(folder, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))


def close_pairs(names: DataFrame, name: str, slack: dict[int, int]) -> DataFrame:
    """a, b: distinct names a < b whose edit distance is within the slack of a's length (slack: least length -> edits).

    A name of slack s is cut into s + 1 segments, of which one at least is whole in every partner, moved by s places at
    most. Partners meet by segment, so that names of one length are not all compared.
    """
    own = names.select(F.col(name).alias("n")).where(F.col(name).isNotNull()).distinct().withColumn("_l", F.length("n"))
    room = lambda length: reduce(lambda rest, k: F.when(length >= k, slack[k]).otherwise(rest), sorted(slack), F.lit(0))
    most = max(slack.values(), default=0)

    def segment(length: Column, s: Column, k: Column) -> tuple[Column, Column]:
        first = F.floor(k * length / (s + 1)).cast("int")
        return first, (F.floor((k + 1) * length / (s + 1)) - first).cast("int")

    a = own.select(F.col("n").alias("a"), F.col("_l"), room(F.col("_l")).alias("_s"))
    a = a.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_s"))))
    first, size = segment(F.col("_l"), F.col("_s"), F.col("_k"))
    a = a.select("a", "_l", "_k", F.substr("a", first + 1, size).alias("_part"))
    b = own.select(F.col("n").alias("b"), F.explode(F.sequence(F.greatest(F.lit(0), F.col("_l") - most), F.col("_l") + most)).alias("_l"), F.col("_l").alias("_own"))
    b = b.withColumn("_s", room(F.col("_l"))).where(F.abs(F.col("_own") - F.col("_l")) <= F.col("_s")).withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_s"))))
    first, size = segment(F.col("_l"), F.col("_s"), F.col("_k"))
    b = b.withColumns({"_first": first, "_size": size}).withColumn("_at", F.explode(F.sequence(F.greatest(F.lit(0), F.col("_first") - F.col("_s")), F.greatest(F.lit(0), F.col("_first") + F.col("_s")))))
    b = b.where(F.col("_at") + F.col("_size") <= F.col("_own")).select("b", "_l", "_k", F.substr("b", F.col("_at") + 1, F.col("_size")).alias("_part")).distinct()
    met = a.join(b, ["_l", "_k", "_part"]).where("a < b").select("a", "b").distinct()
    return met.where(F.levenshtein("a", "b") <= room(F.length("a")))


def best_of_each_other(pairs: DataFrame, group: str, a: str, b: str, score: str) -> DataFrame:
    """group, a, b: the pairs of a group that are the best of each other by score, ties going to the lesser b and a.

    Rows that repeat a pair count once, by their highest score: no rank then depends on how rows happen to lie, so that
    both ways choose the same row. Null scores come last.
    """
    once = pairs.groupBy(group, a, b).agg(F.max(score).alias("_s"))
    rank = lambda own, other: F.row_number().over(Window.partitionBy(group, own).orderBy(F.desc("_s"), other))
    return once.withColumn("_k1", rank(a, b)).withColumn("_k2", rank(b, a)).where("_k1 = 1 and _k2 = 1").select(group, a, b)


def explain_absence(wanted: DataFrame, key: str, sources: list[tuple[str, DataFrame]], otherwise: str = "unexplained") -> DataFrame:
    """wanted with `reason`: the first source that has the key."""
    names = []
    for name, table in sources:
        wanted = wanted.join(table.select(key).distinct().withColumn(f"_{name}", F.lit(True)), key, "left")
        names.append(name)
    reason = reduce(lambda rest, n: F.when(F.col(f"_{n}"), n).otherwise(rest), reversed(names), F.lit(otherwise))
    return wanted.withColumn("reason", reason).drop(*[f"_{n}" for n in names])


def resolve_paths(nodes: DataFrame, most: int = 64) -> DataFrame:
    """id, path of a table (id, parent, name): names from the root down. Only cycles, and what hangs on them, end without a path.

    Pointers are doubled: after k rounds a row knows 2^k of its ancestors, so that depth costs its logarithm. Depths up to
    most take no look at the rows; then rounds go on until one settles no row: what is still open leads into a cycle, as
    a row of some depth has ancestors of each lesser one.
    """
    rows = nodes.select("id", F.col("parent").alias("up"), F.col("name").alias("path"))
    for _ in range(max(1, most.bit_length())):
        rows = _doubled(rows)
    rows = written(rows, "paths")
    before, left = None, rows.where("up is not null").count()
    while left and left != before:
        rows = written(_doubled(rows), "paths")
        before, left = left, rows.where("up is not null").count()
    return rows.select("id", F.when(F.col("up").isNull(), F.col("path")).alias("path"))


def _doubled(rows: DataFrame) -> DataFrame:
    above = rows.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"))
    return rows.join(above, "up", "left").select("id", F.col("_up").alias("up"), F.when(F.col("_path").isNull(), F.col("path")).otherwise(F.concat_ws("/", "_path", "path")).alias("path"))
