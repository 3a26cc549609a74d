"""Work that comes in and goes out in measured steps: sheets that people fill in, re-reads, re-derivations, budgets."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernglass.functions import values
from fernglass.operators.running import with_running
from fernglass.operators.storage import written


def sheet_answers(shown: DataFrame, filled: DataFrame, known: DataFrame, key: str, said: str) -> DataFrame:
    """key, outcome, name: what a filled-in sheet says of each row that was shown.

    A text is a name; ? asks someone else, x (or -) is unidentifiable; a row left blank is declined, so that it is not
    shown again. A row that the store does not hold is refused, whatever was written: neither a name nor a blank may
    hide it. Of several lines for a row the least text counts.
    """
    text = F.trim(F.col(said))
    lines = filled.groupBy(key).agg(F.min(F.when(text != "", text)).alias("_said"))
    rows = shown.select(key).distinct().join(lines, key, "left").join(known.select(key).distinct().withColumn("_known", F.lit(True)), key, "left")
    outcome = F.when(F.col("_known").isNull(), "refused").when(F.col("_said").isNull(), "declined").when(F.col("_said") == "?", "asked").when(F.lower("_said").isin("x", "-"), "unidentifiable").otherwise("named")
    return rows.select(key, outcome.alias("outcome"), F.when(outcome == "named", F.col("_said")).alias("name"))


def sheet(groups: DataFrame, key: str, order: list[Column], answered: DataFrame, most: int) -> DataFrame:
    """The next rows to show: without an answer yet, in an order, as many as fit a sheet."""
    return groups.join(answered.select(key).distinct(), key, "left_anti").orderBy(*order, key).limit(most)


def sheet_problems(crops: DataFrame, assigned: DataFrame, row: str, face: list[str], content: str) -> DataFrame:
    """row, problem, n of a sheet's crops: faces in no assignment, faces of another row, one content shown twice.

    crops: row, face keys, content; assigned: face keys, owner.
    """
    met = crops.join(assigned.select(*face, "owner"), face, "left")
    wrong = F.when(F.col("owner").isNull(), "unassigned").when(F.col("owner") != F.col(row), "another row")
    per = met.withColumn("problem", wrong).where("problem is not null").groupBy(row, "problem").agg(F.count("*").alias("n"))
    twice = crops.groupBy(row, content).agg((F.count("*") - 1).alias("_more")).where("_more > 0").groupBy(row).agg(F.sum("_more").alias("n"))
    return per.unionByName(twice.select(row, F.lit("shown twice").alias("problem"), "n"))


def reread(new: DataFrame, old: DataFrame, photo: str, least: float = 0.3) -> DataFrame:
    """photo, i, cluster of boxes found anew in a photo that was turned; null where none of the old boxes is it.

    new: photo, i, box [x, y, w, h]; old: photo, j, cluster, box as it lies after the turn. New boxes are taken in the
    order of i, and each gets the unused old one that it overlaps most, the least j, then cluster, on ties (of nine digits), if they overlap enough.
    A photo's boxes meet each other; the rest of the fold is over its list of candidates.
    """
    sides = lambda c: [F.col(c)[k] for k in range(4)]
    near = new.select(photo, "i", F.col("box").alias("_a")).join(old.select(photo, "j", "cluster", F.col("box").alias("_b")), photo)
    near = near.withColumn("_iou", F.round(values.overlap(sides("_a"), sides("_b")), 9)).where((F.col("_iou") >= least) & F.col("cluster").isNotNull())
    own = near.groupBy(photo, "i").agg(F.array_sort(F.collect_list(F.struct((-F.col("_iou")).alias("far"), "j", "cluster"))).alias("_found"))
    rows = own.groupBy(photo).agg(F.array_sort(F.collect_list(F.struct("i", "_found"))).alias("_rows"))

    def step(acc: Column, r: Column) -> Column:
        best = F.get(F.filter(r["_found"], lambda c: ~F.array_contains(acc["used"], c["j"])), F.lit(0))
        used = F.when(best.isNull(), acc["used"]).otherwise(F.array_append(acc["used"], best["j"]))
        out = F.when(best.isNull(), acc["out"]).otherwise(F.array_append(acc["out"], F.struct(r["i"].alias("i"), best["cluster"].alias("cluster"))))
        return F.struct(used.alias("used"), out.alias("out"))

    kinds = dict(old.dtypes) | {"i": dict(new.dtypes)["i"]}
    start = F.struct(F.array().cast(f"array<{kinds['j']}>").alias("used"), F.array().cast(f"array<struct<i:{kinds['i']},cluster:{kinds['cluster']}>>").alias("out"))
    kept = rows.select(photo, F.explode(F.aggregate("_rows", start, step, lambda a: a["out"])).alias("_k")).select(photo, "_k.i", "_k.cluster")
    return new.select(photo, "i").join(kept, [photo, "i"], "left")


def tail_weighted(df: DataFrame, order: list[str], sample: int) -> DataFrame:
    """A sample mostly from the end, where a drift shows: a quarter of it, 2 at least, from the start, the rest from the end."""
    first = max(2, sample // 4)
    head = df.orderBy(*order).limit(first)
    tail = df.orderBy(*[F.desc(c) for c in order]).limit(max(0, sample - first))
    return head.unionByName(tail).dropDuplicates(order)


def rederived(stored: DataFrame, again: DataFrame, key: str, vector: str, order: list[str], sample: int, least: float = 0.99) -> DataFrame:
    """One row: sampled, checked, wrong, code. code 0 is right, 1 wrong, or nothing could be derived again; 2 fewer than 4 rows.

    Of a sample weighted to the tail, those with a second vector are compared by cosine; another length is wrong.
    """
    picks = tail_weighted(stored.select(key, vector, *[o for o in order if o != key]), order, sample)
    both = picks.join(again.select(key, F.col(vector).alias("_again")), key, "left")
    off = (F.size(vector) != F.size("_again")) | ~F.coalesce(values.cosine(F.col(vector), F.col("_again")) > least, F.lit(False))
    said = both.agg(F.count("*").alias("sampled"), F.count("_again").alias("checked"), F.count_if(F.col("_again").isNotNull() & off).alias("wrong"))
    code = F.when(F.col("sampled") < 4, 2).when((F.col("checked") == 0) | (F.col("wrong") > 0), 1).otherwise(0)
    return said.withColumn("code", code)


def described(df: DataFrame, text: str, filled: list[str], order: list[str], sample: int, words: int, share: float) -> DataFrame:
    """One row: rows, median, short, code of the newest descriptions: 1 if they are labels, or the other fields are empty; 2 below 5 rows."""
    recent = df.orderBy(*[F.desc(o) for o in order]).limit(sample)
    n = F.when(F.trim(text) != "", F.size(F.split(F.trim(text), r"\s+")))
    given = [F.count_if(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "") for c in filled]
    said = recent.agg(F.count("*").alias("rows"), F.sort_array(F.collect_list(n)).alias("_n"), *[g.alias(f"_f{i}") for i, g in enumerate(given)])
    middle = F.get("_n", F.floor(F.size("_n") / 2).cast("int"))
    empty = F.lit(True)
    for i in range(len(filled)):
        empty = empty & (F.col(f"_f{i}") < share * F.col("rows"))
    code = F.when(F.col("rows") < 5, 2).when(middle.isNull() | (middle < words) | (empty if filled else F.lit(False)), 1).otherwise(0)
    return said.select("rows", middle.cast("bigint").alias("median"), F.size(F.filter("_n", lambda x: x < words)).cast("bigint").alias("short"), code.alias("code"))


def still_sideways(width: Column, height: Column, orientation: Column, thumb_width: Column, thumb_height: Column) -> Column:
    """Whether the thumbnail of a picture that was taken sideways (Exif orientation 5 to 8) is not upright; null for others."""
    return F.when(orientation.between(5, 8), (width > height) != (thumb_height > thumb_width))


def stale_assets(assets: DataFrame, sources: DataFrame, key: str, made: str, changed: str) -> DataFrame:
    """key, reason of assets to make again: older than their source, or without one."""
    rows = assets.select(key, made).join(sources.select(key, changed), key, "left")
    reason = F.when(F.col(changed).isNull(), "no source").when(F.col(made) < F.col(changed), "older than its source")
    return rows.select(key, reason.alias("reason")).where("reason is not null")


def deletion_verdict(path: Column, reason: Column, protected: list[str], scratch: str, proven: Column, accounted: Column, original: Column, allow_originals: bool = False) -> Column:
    """allowed, or why a removal is refused. Nothing is removed here.

    A protected root refuses before any reason counts. scratch must lie in the scratch folder; a verified duplicate needs
    its proof and must not look like a camera's original; a consumed archive needs all members accounted for.
    """
    inside = lambda root: (path == root) | path.startswith(root.rstrip("/") + "/")
    guarded = F.lit(False)
    for root in protected:
        guarded = guarded | inside(root)
    yes = lambda c: F.coalesce(c, F.lit(False))
    by_reason = (
        F.when(reason == "scratch", F.when(inside(scratch), "allowed").otherwise("not in scratch"))
        .when(reason == "verified-duplicate", F.when(~yes(proven), "no proof").when(yes(original) & F.lit(not allow_originals), "camera original").otherwise("allowed"))
        .when(reason == "consumed-archive", F.when(yes(accounted), "allowed").otherwise("members not accounted for"))
        .otherwise("unknown reason")
    )
    return F.when(path.isNull(), "no path").when(guarded, "protected root").otherwise(by_reason)


def budgeted(work: DataFrame, cost: str, cap: float, *order: str) -> DataFrame:
    """What a run takes on: items in order as long as the spend before each is below the cap. The last one is finished, as work in flight is."""
    spent = with_running(work, list(order), F.coalesce(F.col(cost), F.lit(0)), "_spent")
    return spent.where(F.col("_spent") - F.coalesce(F.col(cost), F.lit(0)) < cap).drop("_spent")


def in_flight(df: DataFrame, call: Callable, schema: str, workers: int = 4, deadline: float | None = None) -> DataFrame:
    """call(row as a dict) -> tuple for each row, by `workers` threads in each task, with two calls a worker under way at most.

    For calls that wait on something else. With a deadline (seconds since the epoch) no call begins after it: those under
    way finish, and the rows left are not in the result, so that the next run finds them pending.
    """
    names = [c.strip().split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(workers) as pool:
            for pdf in batches:
                out, under_way = [], set()
                for row in pdf.to_dict("records"):
                    if deadline is not None and time.time() > deadline:
                        break
                    if len(under_way) >= 2 * workers:
                        done, under_way = wait(under_way, return_when=FIRST_COMPLETED)
                        out += [f.result() for f in done]
                    under_way.add(pool.submit(call, row))
                out += [f.result() for f in under_way]
                yield pd.DataFrame(out, columns=names)

    return df.mapInPandas(run, schema)


class Memo:
    """Results kept for a while: get() makes a table at most once in `seconds`, in the shared folder, and reads it until then."""

    def __init__(self, seconds: float = 60.0, clock: Callable[[], float] = time.time):
        self.seconds, self.clock = seconds, clock
        self.held: dict[str, tuple[float, DataFrame]] = {}

    def get(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        at, found = self.held.get(name, (0.0, None))
        if found is None or self.clock() - at >= self.seconds:
            found = written(make(), name)
            self.held[name] = (self.clock(), found)
        return found
