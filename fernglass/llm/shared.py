"""What the operators share: column picking, tables in the cluster's shared folder, words.

White space is everywhere the six ASCII characters U+0020 and U+0009 to U+000D, and a word a longest run of
other characters; ``bytes.split()`` cuts at exactly these, and ``bytes.lower()`` folds exactly A-Z.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fernglass.operators.storage import delete, shared_folder, written

#: Rows of one Arrow batch that an operator emits.
OUT_ROWS = 1000

WHITE = b" \t\n\x0b\x0c\r"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly the named columns (in the case given), whatever else the table holds, doubles and case twins included."""
    columns = df.columns
    flat = small_batches(df).toDF(*[f"_{i}" for i in range(len(columns))])
    missing = [n for n in names if n not in columns]
    if missing:
        raise ValueError(f"no column {missing} in {columns}")
    return flat.select(*[F.col(f"_{columns.index(n)}").alias(n) for n in names])


#: Limits of one Arrow batch sent to Python, set where the session has Spark's own defaults: whole texts are long.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": (None, str(4 << 20))}


def small_batches(df: DataFrame) -> DataFrame:
    """df, in a session whose Arrow batches are small enough for long texts; limits that a user has set stay."""
    conf = df.sparkSession.conf
    for key, (default, value) in BATCH.items():
        now = conf.get(key, None)
        if now is None or now == default or default is None and int(now) >= 64 << 20:
            conf.set(key, value)
    return df


def stash(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: lineage ends there and lost executors lose nothing.

    The tables of an application lie under ``<shared folder>/tables/<application id>``; drop_stash removes them.
    """
    return written(df, name)


def discard(found: DataFrame) -> None:
    """Deletes a table of stash() that nothing reads any more."""
    delete(found.sparkSession, found._stashed_at)


def drop_stash(spark: SparkSession) -> None:
    """Deletes all that stash() has written in this application. Results that still read it become unreadable."""
    delete(spark, f"{shared_folder(spark)}/tables/{spark.sparkContext.applicationId}")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % parts


def text_key() -> Column:
    """64 bits that tell rows with the same doc_id apart by their text."""
    return F.xxhash64("doc_id", "text")


def keep_rows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of docs, all columns as they are, that chosen names by (doc_id, text_key); with its other columns, if any.

    Rows that repeat in doc_id and text count as one and one of them stays. Only the names of the columns doc_id and
    text are needed; others may be called anything.
    """
    names = docs.columns
    flat = docs.toDF(*[f"_{i}" for i in range(len(names))])
    doc_id, text = (f"_{names.index(c)}" for c in ("doc_id", "text"))
    flat = flat.withColumn("_key", F.xxhash64(F.col(doc_id).cast("long"), F.col(text).cast("string"))).withColumn("_id", F.col(doc_id).cast("long"))
    repeated = flat.groupBy("_id", "_key").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("_id").alias("_rid"), F.col("_key").alias("_rkey"))
    same = F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_key") == F.col("_rkey"))
    once = flat.join(repeated, same, "left_anti").unionByName(flat.join(repeated, same, "left_semi").dropDuplicates(["_id", "_key"]))
    extra = [c for c in chosen.columns if c not in ("doc_id", "text_key")]
    named = chosen.select(F.col("doc_id").alias("_cid"), F.col("text_key").alias("_ckey"), *extra)
    joined = once.join(named, F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_key") == F.col("_ckey")), "inner" if extra else "left_semi")
    return joined.select(*[f"_{i}" for i in range(len(names))], *extra).toDF(*names, *extra)


def texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text of a batch; null counts as empty."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    view = memoryview(data) if data is not None else memoryview(b"")
    nulls = column.is_null().to_numpy(zero_copy_only=False) if column.null_count else None
    for i in range(len(column)):
        yield b"" if nulls is not None and nulls[i] else bytes(view[offsets[i] : offsets[i + 1]])


#: Bytes of a text that are cut into words at a time.
WORDS_OF = 4 << 20
_CUT = re.compile(rb"[ \t-\r]")


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in slices, so that a very long one is never a list of all its words."""
    if len(text) <= WORDS_OF:
        yield text.split()
        return
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + WORDS_OF)
        end = cut.start() if cut else len(text)
        yield text[at:end].split()
        at = end


_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE)] = True


def count_words(column: pa.Array) -> np.ndarray:
    """Words of each text of a batch, 0 where it is null."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    n = len(column)
    if n == 0 or column.buffers()[2] is None:
        return np.zeros(n, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    lo, hi = int(offsets[0]), int(offsets[-1])
    inside = ~_IS_WHITE[np.frombuffer(column.buffers()[2], np.uint8, hi - lo, lo)] if hi > lo else np.zeros(0, bool)
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = offsets[:-1] - lo
    begins = first[first < hi - lo]
    starts[begins] = inside[begins]  # a text's first character starts a word even if the text before ends in one
    total = np.concatenate([[0], np.cumsum(starts, dtype=np.int64)])
    counts = total[offsets[1:] - lo] - total[first]
    if column.null_count:
        counts[column.is_null().to_numpy(zero_copy_only=False)] = 0
    return counts


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0) and base by Newton's method with a weak pull to 0."""
    centre, spread = float(x.mean()), float(x.std()) or 1.0
    z = np.column_stack([(x - centre) / spread, np.ones(len(x))])
    w = np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        g = z.T @ (p - y) + 0.5 * np.array([w[0], 0.0])
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag([0.5, 1e-6])
        step = np.linalg.solve(h, g)
        w = w - np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    slope = max(0.0, w[0]) / spread
    return float(slope), float(w[1] - slope * centre)
