"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight and a shape over training time t in [0, 1]. Its demand is the integral of weight x shape;
its target is that integral over the whole run, at most twice its words, the excess reshared by weight. A document
that takes the words from c on in its source is trained at the t where the source's cumulative demand is c: the
inverse of the integral. Documents are then range-sorted by that position.

Words before a document in its source are a prefix sum in two levels (a window in each of many hash buckets, and one
over the buckets' sums), so that a source with a third of all rows is dealt over all tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernglass.llm.shared import keep_rows, pick, stash, text_key, texts
from fernglass.operators.running import with_running

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
#: Share of all words that the mix takes.
TOTAL = 1.5
#: Times that a source, and so a document, may be used at most.
REPEATS = 2
#: Slope of each weight's shape: the weight at t is its mean x (1 + slope x (2 t - 1)), repeating like WEIGHTS.
SLOPES = (-0.5, 0.5, 0.0)


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, source, size: the words of each text, 0 where it is null."""
    rows = pick(docs, "doc_id", "source", "text").select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string")).withColumn("text_key", text_key())
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    return rows.select("doc_id", "text_key", "source", F.coalesce(words, F.lit(0)).cast("long").alias("size"))


def _cycle(rank: Column, values: tuple[float, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.pmod(rank - 1, F.lit(len(values))) + 1).cast("int"))


def targets(sized: DataFrame, weights=WEIGHTS, total: float = TOTAL, repeats: int = REPEATS, slopes=SLOPES) -> DataFrame:
    """One row per source: source, source_size, target, slope.

    Water filling: with sources by (repeats x size / weight), the first k are held at their limit, where k is the
    least such that the level of the rest is at most the next one's ratio. Ranks and sums over the sources are made in
    two levels, as there may be as many sources as hosts.
    """
    per = stash(sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("unnamed", F.col("source").isNull()), "sources")
    per = with_running(per, ["unnamed", "source"], F.lit(1).cast("long"), "rank")  # by code point, null last
    per = per.select("source", "source_size", "rank", _cycle(F.col("rank"), weights).alias("weight"), _cycle(F.col("rank"), slopes).alias("slope"), (F.lit(float(repeats)) * F.col("source_size")).alias("limit"))
    per = stash(per.withColumn("ratio", F.col("limit") / F.col("weight")), "ratios")
    sums = with_running(per, ["ratio", "rank"], F.col("limit"), "limits", weights=F.col("weight"))
    whole = per.agg(F.sum("source_size").alias("all_sizes"), F.sum("weight").alias("all_weights"))
    level = (F.lit(float(total)) * F.col("all_sizes") - (F.col("limits") - F.col("limit"))) / (F.col("all_weights") - F.col("weights") + F.col("weight"))
    levels = sums.crossJoin(whole).withColumn("level", level)
    found = levels.agg(F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))).alias("found"))
    per = per.crossJoin(found)
    return per.select("source", "source_size", "slope", F.when(F.col("found").isNull(), F.col("limit")).otherwise(F.least(F.col("limit"), F.col("found.level") * F.col("weight"))).alias("target"))


def _when(share: Column, slope: Column) -> Column:
    """The t at which the integral of 1 + slope (2 u - 1) over u from 0 reaches share."""
    b = 1 - slope
    return F.when(slope == 0, share).otherwise((F.sqrt(b * b + 4 * slope * share) - b) / (2 * slope))


def mix(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, repeats: int = REPEATS, slopes=SLOPES) -> DataFrame:
    """One row per document, range-sorted by position: doc_id, text_key, source, size, source_size, target, taken,
    positions, words.

    taken: words that the mix takes of it, repeats counted, at most repeats x size; over a source they add up to its
    rounded target. All of a source's documents are taken as often as its target holds its words; what remains goes to
    its documents in the order of md5(id), the last of them in part. positions: where in [0, 1] each use of the
    document begins, empty if nothing is taken; words: how many each use takes, from the first on. A null source is a source of its own, after the others; null texts and
    texts without words have size 0 and are never taken. Rows that repeat count each for itself. Other columns of docs
    are ignored. Empty table: no rows. Reruns give the same rows.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    sized = stash(sizes(docs).withColumn("h", key), "sizes")
    per = stash(targets(sized, weights, total, repeats, slopes), "targets")
    rows = sized.join(per, sized["source"].eqNullSafe(per["source"])).select(sized["doc_id"], "text_key", sized["source"], "size", "h", "source_size", "target", "slope")
    bucket = F.substring("h", 1, 3)
    rows = rows.withColumn("bucket", bucket)
    within = Window.partitionBy("source", "bucket").orderBy("h", F.asc_nulls_last("doc_id"), "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    over = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    sums = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(over), F.lit(0)).alias("outside"))
    rows = rows.join(sums, rows["source"].eqNullSafe(sums["s"]) & (rows["bucket"] == sums["b"]))
    whole = F.floor(F.col("target") + 0.5).cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0).cast("long")
    full = F.least(full, F.lit(repeats))
    left = whole - full * F.col("source_size")
    start = F.col("inside") + F.col("outside")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left - start))
    rows = rows.withColumns({"start": start, "uses": F.when(F.col("size") > 0, full + (part > 0).cast("int")).otherwise(0).cast("int"), "taken": full * F.col("size") + part, "whole": whole, "full": full, "part": part})
    at = F.transform(F.when(F.col("uses") > 0, F.sequence(F.lit(0), F.col("uses") - 1)).otherwise(F.array().cast("array<int>")), lambda k: _when((k * F.col("source_size") + F.col("start")) / F.col("whole"), F.col("slope")))
    words = F.transform(at, lambda _, k: F.when(k < F.col("full"), F.col("size")).otherwise(F.col("part")))
    rows = rows.select("doc_id", "text_key", "source", "size", "source_size", "target", "taken", at.alias("positions"), words.alias("words"))
    first = F.element_at(F.concat("positions", F.array(F.lit(2.0))), 1)
    return rows.repartitionByRange(first, F.xxhash64("doc_id")).sortWithinPartitions(first, F.asc_nulls_last("doc_id"))


_HEAD = re.compile(rb"[ \t-\r]*[^ \t-\r]+")


def _first_words(text: bytes, words: int) -> bytes:
    """A text up to the end of its words-th word."""
    at = 0
    for _ in range(words):
        at = _HEAD.match(text, at).end()
    return text[:at]


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix as documents: each use of a row of docs is a row, in the order of its position, all columns as they were.

    What mix() takes of a text in part is its first words, and n_chars, if there is such a column, is then its length.
    docs must not repeat rows in doc_id and text, as after exact dedup: their uses would multiply.
    """
    names = docs.columns
    use = F.explode(F.arrays_zip(F.col("positions").alias("position"), F.col("words").alias("words")))
    uses = mix(docs, **how).where("taken > 0").select("doc_id", "text_key", "size", use.alias("_use"))
    uses = uses.select("doc_id", "text_key", F.col("_use.position").alias("_position"), (F.col("_use.words") < F.col("size")).alias("_cut"), F.col("_use.words").alias("_words"))
    found = keep_rows(docs, uses)
    flat = [f"c{i}" for i in range(len(names))]
    found = found.toDF(*flat, "position", "cut", "words")
    text, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(len(names) + 1).to_pylist()
            if any(marks):
                words = batch.column(len(names) + 2).to_pylist()
                own = [_first_words(t, n) if m else t for t, m, n in zip(texts(batch.column(text)), marks, words)]
                columns = batch.columns
                columns[text] = pa.array([t.decode("utf-8", "replace") for t in own], batch.schema.field(text).type)
                if chars is not None:
                    columns[chars] = pa.array([len(t.decode("utf-8", "replace")) if m else n for t, m, n in zip(own, marks, columns[chars].to_pylist())], batch.schema.field(chars).type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    dealt = found.mapInArrow(cut, found.schema).repartitionByRange("position").sortWithinPartitions("position")
    return dealt.select(*flat).toDF(*names)


SQL = r"""
with sized as (
  select doc_id, source, cast(case when text is null then 0 else len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) end as bigint) as size,
    md5(cast(doc_id as varchar)) as h from documents
), per as (
  select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as rank from sized group by source
), weighed as (
  select *, case (rank - 1) % 3 when 0 then 3.0::double when 1 then 1.0::double else 2.0::double end as weight, 2.0::double * source_size as lim from per
), levels as (
  select *, lim / weight as ratio,
    (1.5::double * sum(source_size) over () - coalesce(sum(lim) over (order by lim / weight, rank rows between unbounded preceding and 1 preceding), 0.0::double))
      / sum(weight) over (order by lim / weight, rank rows between current row and unbounded following) as level from weighed
), found as (
  select *, (select l2.level from levels l2 where l2.level <= l2.ratio order by l2.ratio, l2.rank limit 1) as lam from levels
), targets as (
  select source, source_size, rank, case when lam is null then lim else least(lim, lam * weight) end as target from found
), cum as (
  select s.*, t.source_size, t.target, t.rank, cast(floor(t.target + 0.5) as bigint) as whole,
    cast(coalesce(sum(s.size) over (partition by s.source order by s.h, s.doc_id, s.size rows between unbounded preceding and 1 preceding), 0) as bigint) as start
  from sized s join targets t on s.source is not distinct from t.source
), uses as (
  select *, case when source_size > 0 then least(whole // source_size, 2) else 0 end as n from cum
)
select doc_id, size, source_size, target, cast(n * size + part as bigint) as taken, cast(case when size > 0 then n + case when part > 0 then 1 else 0 end else 0 end as int) as uses,
  round(case when size > 0 and n * size + part > 0 then case (rank - 1) % 3 when 0 then (sqrt(1.5 * 1.5 + 4 * -0.5::double * (start / whole)) - 1.5) / (2 * -0.5::double) when 1 then (sqrt(0.5 * 0.5 + 4 * 0.5::double * (start / whole)) - 0.5) / (2 * 0.5::double) else start / whole end end, 9) as position
from (select *, greatest(0, least(size, whole - n * source_size - start)) as part from uses)
"""
