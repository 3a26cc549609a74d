"""Exact dedup by content sort.

Texts are equal when their bytes are equal after deleting white space. Sampled splitters range-partition the
normalised texts (Spark's range exchange on the first bytes, the digest, then length and id, so that splitters stay
short and a group of copies of any size is dealt over many partitions), each partition is sorted externally, and each
row is compared with its neighbour in full. A run of equals that touches the first or last row of a partition may go
on next door: such runs, two for each partition at most, are merged by a small aggregation on their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernglass.llm.shared import OUT_ROWS, WHITE, keep_rows, pick, stash, text_key, texts

#: Bytes of the normalised text that lead the sort key; equality never rests on them.
HEAD = 32


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        norm = [t.translate(None, WHITE) for t in texts(batch.column("text"))]
        digest = [hashlib.sha256(t).digest() for t in norm]
        chars = pc.fill_null(pc.utf8_length(batch.column("text")), 0).cast(pa.int64())
        heads = [t[:HEAD] for t in norm]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), chars, *(pa.array(x, pa.binary()) for x in (heads, digest, norm))], names=["doc_id", "text_key", "chars", "head", "digest", "norm"])


NORMALISED = "doc_id long, text_key long, chars long, head binary, digest binary, norm binary"
RUNS = "doc_id long, text_key long, digest binary, keep_id long, keep_chars long, size long, kept boolean, part int, edge int, edge_norm binary"


class _Runs:
    """Gathers the runs of one partition; ids are held for one run at a time, never its texts."""

    def __init__(self, part: int):
        self.part, self.seen, self.ids, self.rows = part, 0, [], []
        self.norm = self.digest = self.chars = None

    def end(self, last: bool) -> None:
        if not self.ids:
            return
        self.seen += 1
        edge = 1 if self.seen == 1 else 2 if last else None
        for i, (doc_id, key) in enumerate(self.ids):
            self.rows.append((doc_id, key, self.digest, self.ids[0][0], self.chars, len(self.ids), i == 0, self.part, edge, self.norm if edge and i == 0 else None))

    def start(self, row: tuple, chars: int, digest: bytes, norm: bytes) -> None:
        self.ids, self.chars, self.digest, self.norm = [row], chars, digest, norm

    def out(self, at_least: int) -> Iterator[pa.RecordBatch]:
        while len(self.rows) >= max(1, at_least):
            part, self.rows = self.rows[:OUT_ROWS], self.rows[OUT_ROWS:]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], names=[x.split()[0] for x in RUNS.split(", ")])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs = _Runs(TaskContext.get().partitionId())
    for batch in batches:
        norms = batch.column("norm")
        rows = zip(zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()), batch.column("chars").to_pylist(), batch.column("digest").to_pylist())
        for i, (row, chars, digest) in enumerate(rows):
            norm = None
            if digest == runs.digest and (norm := norms[i].as_py()) == runs.norm:
                runs.ids.append(row)
                continue
            runs.end(last=False)
            runs.start(row, chars, digest, norms[i].as_py() if norm is None else norm)
        yield from runs.out(OUT_ROWS)
    runs.end(last=True)
    yield from runs.out(1)


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, text_key, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; all empty or blank texts are one group. Of equal texts the row with the most code
    points in the original stays, then the smallest id, a null id last; of rows that repeat even those, one stays
    (kept is true once for each group). An empty table gives an empty result. Other columns are ignored.
    """
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("text_key", text_key())
    order = [F.col("head"), F.col("digest"), F.col("norm"), F.desc("chars"), F.asc_nulls_last("doc_id")]
    deal = [F.col("head"), F.col("digest"), F.desc("chars"), F.asc_nulls_last("doc_id")]
    dealt = rows.mapInArrow(_normalised, NORMALISED).repartitionByRange(*deal).sortWithinPartitions(*order)
    runs = stash(dealt.mapInArrow(_neighbours, RUNS), "runs")

    edges = runs.where("edge_norm is not null").select("part", "edge", "keep_id", "keep_chars", "size", "edge_norm")
    best = F.min(F.struct(-F.col("keep_chars"), F.col("keep_id").isNull(), F.col("keep_id"), F.col("part"))).alias("best")
    whole = edges.groupBy("edge_norm").agg(F.sum("size").alias("whole_size"), best)
    merged = edges.join(whole, "edge_norm").select("part", "edge", "whole_size", F.col("best.keep_id").alias("whole_keep"), F.col("best.part").alias("keep_part"))

    plain = runs.where("edge is null").select("doc_id", "text_key", "keep_id", F.col("size").alias("group_size"), "kept", "digest")
    touching = runs.where("edge is not null").join(merged, ["part", "edge"]).select("doc_id", "text_key", F.col("whole_keep").alias("keep_id"), F.col("whole_size").alias("group_size"), (F.col("kept") & (F.col("part") == F.col("keep_part"))).alias("kept"), "digest")
    return plain.unionByName(touching).select("doc_id", "text_key", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """copies() without the key: doc_id, keep_id, group_size, kept, text_sha256."""
    return copies(docs, id_col, text_col).drop("text_key")


def drop_copies(docs: DataFrame) -> DataFrame:
    """docs without the rows that copies() does not keep, all columns as they were."""
    return keep_rows(docs, copies(docs).where("kept").select("doc_id", "text_key"))


SQL = r"""
with n as (
  select doc_id, coalesce(text, '') as t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents
), g as (
  select doc_id, sha256(norm) as text_sha256,
    first_value(doc_id) over (partition by norm order by length(t) desc, doc_id) as keep_id,
    count(*) over (partition by norm) as group_size
  from n
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from g
"""
