"""Best-fit packing of tokenised documents into sequences, after Martello-Toth dominance reduction.

Only the number of pieces of each length matters for the choice of bins, and there are at most `capacity` lengths:
the histogram (at most 2,048 rows, whatever the corpus) goes to the driver, which plans on runs of equal pieces, and
the plan, runs of (length, first rank, count, first sequence, offset), goes back. A plan has at most a few runs for
each pair of lengths. Pieces find their place by their rank among the pieces of their length, which is counted in two
levels: within a task, and over the tasks.
"""

from __future__ import annotations

import os
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fernglass.llm.shared import pick, small_batches, stash, texts
from fernglass.operators.running import with_running

CAPACITY = 2048
#: Words whose ids a Python worker keeps; the rest are encoded anew each time.
KEPT_WORDS = 800_000

Run = tuple[int, int, int, int, int]


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies spell printable bytes as themselves and the others, in order, from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + k) for k, b in enumerate(others)}


class Encoder:
    """Ids of whole texts by a tokenizer that lower-cases and whose pre-tokenizer never joins what white space parts.

    There a text's ids are those of its words in order, so that common words are looked up. Of the others, letters
    of the Latin blocks, with a full stop or comma after them or not, go straight to the merges, as they are composed
    and one piece before them; the rest goes through the whole tokenizer. The tests hold all of this against encoding
    texts whole.
    """

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = _Words(self)
        self.letters = _byte_letters()
        self.marks = {b"": b""} | dict(zip((b".", b","), self.slow([b".", b","])))

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def slow(self, words: list[bytes]) -> list[bytes]:
        batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [array("I", e.ids).tobytes() for e in batch([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)]

    def of_word(self, word: bytes) -> bytes:
        """The ids of one word."""
        mark = word[-1:] if word[-1:] in (b".", b",") else b""
        core = word[: len(word) - len(mark)].decode("utf-8", "replace")
        if core.isalpha() and max(core) < "\u0250" and "\u0130" not in core:
            pieces = self.tokenizer.model.tokenize(core.lower().encode().decode("latin-1").translate(self.letters))
            return array("I", [t.id for t in pieces]).tobytes() + self.marks[mark]
        return self.slow([word])[0]

    def encode(self, text: bytes) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self.words.__getitem__, text.split()))


class _Words(dict):
    """Ids of words, kept while there is room."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: bytes) -> bytes:
        ids = self.encoder.of_word(word)
        if len(self) < KEPT_WORDS:
            self[word] = ids
        return ids


def pieces_of(tokenizer_path: str, capacity: int, end_id: int, carried: list[str]):
    """The mapInArrow function: each document's ids and an end id, cut where they are longer than the capacity."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder.of(tokenizer_path), TaskContext.get().partitionId()
        ranks = [0] * (capacity + 1)
        for batch in batches:
            out: list[tuple] = []
            rows: list[int] = []
            for row, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")))):
                ids = encoder.encode(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    n = len(own) // 4
                    out.append((doc_id, k, at // 4, n, zlib.crc32(own), part, ranks[n]))
                    ranks[n] += 1
                    rows.append(row)
            if out:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                own = [batch.column(c).take(pa.array(rows)) for c in carried]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(zip(*out), kinds)), *own], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank", *carried])

    return cut


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"


class _Plan:
    """Places runs of equal pieces. left: pieces of each length not yet placed; rooms: runs of open sequences."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = dict(counts)
        self.placed = dict.fromkeys(counts, 0)
        self.next = 0
        self.runs: list[Run] = []

    def take(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.runs.append((length, self.placed[length], count, sequence, offset))
        self.placed[length] += count
        self.left[length] -= count

    def group(self, lengths: list[int], count: int) -> None:
        """count sequences, each with these lengths."""
        at = 0
        for n in lengths:
            self.take(n, count, self.next, at)
            at += n
        self.next += count


def _fixed(plan: _Plan, lengths: list[int], j: int) -> bool:
    """Fixes sets with pieces of length j if one set is at least as good as every other that holds such a piece.

    With room r beside j and k the longest other piece that fits in r, a set better than {j} + S has for each part of
    a partition of S a piece of at least its length:
    - nothing fits: {j};
    - k fills r: {j, k}, as all of S is at most k;
    - no two fit in r together: {j, k}, as S is one piece;
    - no three fit, and two of length k do: {j, k, k}, as S is two pieces of at most k each.
    """
    room = plan.capacity - j
    spare = lambda n: plan.left[n] - (n == j)
    at = bisect_left(lengths, room + 1) - 1
    while at >= 0 and spare(lengths[at]) <= 0:
        at -= 1
    if at < 0:
        plan.group([j], plan.left[j] if j > room else 1)
        return True
    k = lengths[at]
    least: list[int] = []
    for n in lengths:
        least += [n] * min(3 - len(least), max(0, spare(n)))
        if len(least) == 3:
            break
    if k == room or len(least) < 2 or sum(least[:2]) > room:
        plan.group([j, k], plan.left[j] // 2 if k == j else min(plan.left[j], plan.left[k]))
        return True
    if spare(k) >= 2 and 2 * k <= room and (len(least) < 3 or sum(least) > room):
        plan.group([j, k, k], plan.left[j] // 3 if k == j else min(plan.left[j], plan.left[k] // 2))
        return True
    return False


def reduce(plan: _Plan) -> None:
    """Martello and Toth's reduction: goes over the lengths, longest first, until no set can be fixed any more.

    Each fix uses up a length but for two pieces at most, so that there are a few passes over 2,048 lengths at most.
    """
    again = True
    while again:
        again = False
        for j in sorted((n for n, c in plan.left.items() if c > 0), reverse=True):
            while plan.left[j] > 0:
                lengths = sorted(n for n, c in plan.left.items() if c > 0)
                if not _fixed(plan, lengths, j):
                    break
                again = True


def best_fit(plan: _Plan) -> None:
    """Best-fit decreasing of what is left, over runs of sequences with the same room."""
    rooms: list[int] = []
    open_: dict[int, list[tuple[int, int]]] = {}  # room -> runs of (first sequence, count)

    def add(room: int, first: int, count: int) -> None:
        if room > 0:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append((first, count))

    for n in sorted((n for n, c in plan.left.items() if c > 0), reverse=True):
        while plan.left[n] > 0:
            i = bisect_left(rooms, n)
            if i < len(rooms):
                room = rooms[i]
                first, count = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(i)
                used = min(count, plan.left[n])
                plan.take(n, used, first, plan.capacity - room)
                if used < count:
                    add(room, first + used, count - used)
                add(room - n, first, used)
                continue
            each = plan.capacity // n  # full sequences of n, then one with the rest
            full = plan.left[n] // each
            if full:
                first = plan.next
                plan.group([n] * each, full)
                add(plan.capacity - each * n, first, full)
            if plan.left[n] and plan.left[n] < each:
                first, count = plan.next, plan.left[n]
                plan.group([n] * count, 1)
                add(plan.capacity - count * n, first, 1)


def plan_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs (length, first rank, count, first sequence, offset) that place every piece once."""
    plan = _Plan({int(n): int(c) for n, c in counts.items() if c > 0}, capacity)
    reduce(plan)
    best_fit(plan)
    return plan.runs


def _placer(runs: list[Run], carried: list[str]):
    runs = sorted(runs)
    lengths, ranks, counts, sequences, offsets = (np.array(c, np.int64) for c in zip(*runs)) if runs else (np.zeros(0, np.int64),) * 5
    top = int(ranks.max()) + int(counts.max()) + 1 if runs else 1
    keys = lengths * top + ranks  # below 2,049 x the pieces of a length

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("length").to_numpy()
            r = batch.column("rank").to_numpy()
            i = np.searchsorted(keys, n * top + r, "right") - 1
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequences[i] + r - ranks[i]), pa.array(offsets[i]), *(batch.column(c) for c in carried)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *carried])

    return place


def stored_order(docs: DataFrame) -> DataFrame:
    """docs with `stored`: the place of each row in the files that it was read from, by file name and number in the file.

    A table that was written from sorted ranges, as a mix in training order is, keeps its order there without a column
    for it. A table that was not read from files has no order: stored is null.
    """
    try:
        return docs.select("*", F.struct("_metadata.file_name", "_metadata.row_index").alias("stored"))
    except AnalysisException:
        return docs.withColumn("stored", F.lit(None).cast("struct<file_name: string, row_index: bigint>"))


def pack_in_order(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """pack() of a stored mix, with train_rank for each piece: the place of its sequence in training, from 1.

    Sequences are trained in the order of their first document in the mix; a sequence's pieces share its rank. Ranks are
    counted in two levels. Without a stored order sequences keep the order of their numbers.
    """
    names = docs.columns
    at = [names.index(c) for c in ("doc_id", "text")]
    flat = stored_order(docs).toDF(*[f"_{i}" for i in range(len(names))], "_stored")
    rows = flat.select(F.col(f"_{at[0]}").alias("doc_id"), F.col(f"_{at[1]}").alias("text"), F.col("_stored.file_name").alias("file"), F.col("_stored.row_index").alias("line"))
    packed = stash(_packed(rows, tokenizer_path, capacity, end_id, ["file", "line"]), "packed")
    first = packed.groupBy("sequence_id").agg(F.min(F.struct("file", "line")).alias("first"))
    ranked = with_running(first, ["first", "sequence_id"], F.lit(1).cast("long"), "train_rank").select("sequence_id", "train_rank")
    return packed.drop("file", "line").join(ranked, "sequence_id").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "train_rank")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone. Documents longer than the capacity are cut into pieces of the capacity,
    the last one shorter. Rows that repeat, null ids included, are packed each for itself. Sequences are numbered from
    0 and hold their pieces without gaps from offset 0. Other columns are ignored. Empty table: no rows.
    """
    return _packed(pick(docs, "doc_id", "text"), tokenizer_path, capacity, end_id, [])


def _packed(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, carried: list[str]) -> DataFrame:
    """pack() of doc_id and text, with further columns carried along: file, a text, and line, a number."""
    extra = "".join(f", {c} {'string' if c == 'file' else 'long'}" for c in carried)
    rows = small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *carried)
    pieces = stash(rows.mapInArrow(pieces_of(tokenizer_path, capacity, end_id, carried), PIECES + extra), "pieces")
    tasks = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    over = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tasks = stash(tasks.withColumn("before", F.coalesce(F.sum("n").over(over), F.lit(0))), "ranks")
    counts = {r["length"]: r["n"] for r in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    ranked = pieces.join(tasks.select("length", "part", "before"), ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before"))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank", *carried)
    return ranked.mapInArrow(_placer(plan_runs(counts, capacity), carried), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long" + extra)
