"""Greedy clustering of vectors around running means, and what follows from it.

These folds depend on their order, so that they run over one ordered sequence; the order is always stated. A block key
(a coarse cell, a year, a label) makes them parallel: each block is a task. A block must fit in a task's memory.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x)
    return x / n if n > 0 else x


class Centres:
    """Sums of unit vectors of clusters, and their directions, in growing arrays."""

    def __init__(self, dim: int):
        self.sums = np.zeros((16, dim))
        self.units = np.zeros((16, dim))
        self.n = 0

    def put(self, at: int, vector: np.ndarray) -> None:
        if at == len(self.sums):
            self.sums = np.vstack([self.sums, np.zeros_like(self.sums)])
            self.units = np.vstack([self.units, np.zeros_like(self.units)])
        self.n = max(self.n, at + 1)
        self.sums[at] += vector
        self.units[at] = _unit(self.sums[at])

    def best(self, vector: np.ndarray) -> tuple[int, float]:
        if not self.n:
            return -1, -1.0
        sims = self.units[: self.n] @ vector
        at = int(sims.argmax())
        return at, float(sims[at])


def greedy(df: DataFrame, key: str, vector: str, score: Column, join: float = 0.55, seed: float = 0.6, block: Column | None = None) -> DataFrame:
    """key, block, cluster: rows join the nearest running mean at `join` or start one if their score is at least `seed`.

    Order: score high first, then key. A row that neither joins nor may start one has cluster null. Null vectors are
    left out. Clusters count from 0 within a block (all rows are one block if none is given).
    """
    kind = dict(df.dtypes)[key]
    rows = df.where(F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).alias("v"), score.cast("double").alias("s"), (F.lit(0) if block is None else block).cast("long").alias("block"))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["s", "key"], ascending=[False, True])
        vectors = np.array([_unit(np.array(v, np.float64)) for v in pdf["v"]])
        centres = Centres(vectors.shape[1])
        out = []
        for v, s in zip(vectors, pdf["s"]):
            at, sim = centres.best(v)
            if sim < join:
                at = centres.n if s >= seed else -1
            if at >= 0:
                centres.put(at, v)
            out.append(at if at >= 0 else None)
        return pd.DataFrame({"key": pdf["key"].to_numpy(), "block": pdf["block"].to_numpy(), "cluster": pd.array(out, dtype="Int64")})

    return rows.groupBy("block").applyInPandas(fold, f"key {kind}, block long, cluster long")


def merge(centres: DataFrame, key: str, centre: str, weight: str, name: str | None = None, least: float = 0.68) -> DataFrame:
    """key, grp: clusters joined greedily, largest first, to the group whose weighted mean is near enough.

    A cluster with a name never joins a group with another. centres is a table of clusters, not of vectors: at most
    200,000 rows, which is checked.
    """
    cols = [key, centre, weight] + ([name] if name else [])
    rows = centres.select(*cols).limit(200_001).collect()
    if len(rows) > 200_000:
        raise ValueError("more than 200,000 clusters to merge on the driver")
    rows.sort(key=lambda r: (-r[weight], r[key]))
    groups: Centres | None = None
    names: list = []
    out = []
    for r in rows:
        v = _unit(np.array(r[centre], np.float64))
        groups = groups or Centres(len(v))
        own = r[name] if name else None
        sims = groups.units[: groups.n] @ v if groups.n else np.zeros(0)
        for at in np.argsort(-sims, kind="stable"):
            if sims[at] < least:
                at = groups.n
                break
            if own is None or names[at] is None or names[at] == own:
                break
        else:
            at = groups.n
        if at == groups.n:
            names.append(None)
        groups.put(int(at), v * r[weight])
        names[at] = names[at] if names[at] is not None else own
        out.append((r[key], int(at)))
    kind = dict(centres.dtypes)[key]
    return centres.sparkSession.createDataFrame(out, f"{key} {kind}, grp long")


def conflicts(members: DataFrame, group: str, name: str) -> DataFrame:
    """Groups with several names: there must be none."""
    return members.where(F.col(name).isNotNull()).groupBy(group).agg(F.count_distinct(name).alias("names")).where("names > 1")


def spread_names(members: DataFrame, group: str, key: str, name: str) -> DataFrame:
    """key, name of the unnamed members of groups with exactly one name."""
    only = members.where(F.col(name).isNotNull()).groupBy(group).agg(F.min(name).alias("_lo"), F.max(name).alias("_hi")).where("_lo = _hi")
    return members.where(F.col(name).isNull()).join(only, group).select(key, F.col("_lo").alias(name))


def next_id(counter: Column, *tables: Column) -> Column:
    return F.greatest(counter, *tables) + 1


def kept_ids(new: DataFrame, prior: DataFrame, key: str, cluster: str) -> tuple[DataFrame, DataFrame]:
    """new with ids that were given before, and the rows whose id would change, for which a run is refused."""
    before = prior.select(key, F.col(cluster).alias("_prior"))
    both = new.join(before, key, "left")
    changed = both.where(F.col("_prior").isNotNull() & ~F.col("_prior").eqNullSafe(F.col(cluster)))
    return both.withColumn(cluster, F.coalesce("_prior", cluster)).drop("_prior"), changed.select(key, F.col("_prior").alias("prior"), cluster)

