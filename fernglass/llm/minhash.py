"""Near-dedup by MinHash: universal hash minima, banding, signature check, full check, components by stars.

Texts with equal shingle sets are one class from the start and only its least row goes on. Candidates are found in
buckets (one band of a signature), without a list of all pairs of a bucket:

1. each class is compared with one centre, the one that it meets in most buckets;
2. where a bucket still holds several components, its classes' signatures are compared inside tasks (a full bucket is
   cut into chunks, and chunks are compared with each other) and each class gives its most similar partner of another
   component; this is repeated while it joins any, a few times at most;
3. what is left, pairs of different components whose signatures agree enough, is listed in full: pairs within a
   component can't change the result, so that nothing is lost.

A pair is dropped on its signatures only where their estimate is far too low, and links only on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernglass.llm.graph import components
from fernglass.llm.shared import keep_rows, pick, stash, text_key, texts

WORDS = 5
PERCENT = 85
#: The first minima of a signature are BANDS bands of ROWS each: a pair at 0.85 meets in no band with probability
#: (1 - 0.85^6)^42, 2e-9, and one at 0.8, where the pipeline links, with 3e-6. All HASHES minima, of which a signature
#: has the low 8 bits, estimate the similarity; by chance alone one in 256 agrees, which never hides a pair.
BANDS, ROWS, HASHES = 42, 6, 504
#: Standard deviations below the threshold at which a signature's estimate rules a pair out.
DEVIATIONS = 5
#: Classes of a bucket that one task compares with each other, or with as many others.
CHUNK = 2_000
#: Rounds of most similar partners at most; the list that follows is exact after any number of them.
PARTNER_ROUNDS = 2
SEED = 20_240_607

_RNG = np.random.default_rng(SEED)
_A = (_RNG.integers(0, 2**32, HASHES, np.uint32) | np.uint32(1))[:, None]
_B = _RNG.integers(0, 2**32, HASHES, np.uint32)[:, None]
_P = np.uint64(0x9E3779B97F4A7C15)
_KEPT = 100_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word, SEED)
        if len(self) < _KEPT:
            self[word] = h
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, hashes: _Hashes, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text, lower-cased A-Z; none without words.

    With fewer words than a shingle the whole sequence is the only one; its length is part of the hash.
    """
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    n = min(words, len(h))
    with np.errstate(over="ignore"):
        s = h[: len(h) - n + 1].copy()
        for k in range(1, n):
            s = s * _P + h[k : len(h) - n + 1 + k]
        return np.unique(_mixed(s + np.uint64(n)))


def signature(s: np.ndarray) -> np.ndarray:
    """The minimum of each universal hash a x + b (mod 2^32, a odd) over the set's hashes, folded to 32 bits: its low 8 bits."""
    x = (s ^ (s >> np.uint64(32))).astype(np.uint32)[None, :]
    low = np.empty(len(_A), np.uint32)
    for i in range(0, len(_A), 18):
        h = _A[i : i + 18] * x
        h += _B[i : i + 18]
        h.min(axis=1, out=low[i : i + 18])
    return low.astype(np.uint8)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for batch in batches:
        sizes, keys, signatures = [], [], []
        for text in texts(batch.column("text")):
            s = shingles(text, hashes)
            sizes.append(len(s))
            keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            signatures.append(signature(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())], names=["row", "doc_id", "text_key", "n_shingles", "set_key", "signature"])


SIGNED = "row long, doc_id long, text_key long, n_shingles long, set_key binary, signature binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes with their full sets, each from a text that has its set_key; other texts, which share a text_key, fall out."""
    hashes = _Hashes()
    for batch in batches:
        found = [shingles(text, hashes).tobytes() for text in texts(batch.column("text"))]
        same = pa.array([xxhash.xxh3_128_digest(x) == key for x, key in zip(found, batch.column("set_key").to_pylist())], pa.bool_())
        kept = [batch.column(c) for c in ("node", "signature", "n_shingles")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.binary())], names=["node", "signature", "n_shingles", "items"]).filter(same)


def _least(percent: int) -> int:
    """Equal minima that a pair needs: DEVIATIONS below what is expected at the threshold."""
    t, n = percent / 100, HASHES
    return math.ceil(n * t - DEVIATIONS * math.sqrt(n * t * (1 - t)))


def _similar(percent: int):
    least = _least(percent)

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keeps the pairs whose signatures agree enough for the threshold."""
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
            keep = (a == b).sum(axis=1) >= least
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return estimate


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of rows with equal keys of a partition sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(k).to_numpy() for k in keys], axis=1)
        cuts = [0, *(np.flatnonzero((rows[1:] != rows[:-1]).any(axis=1)) + 1).tolist(), len(rows)]
        if last is not None and not (rows[0] == last).all():
            yield pa.Table.from_batches(held)
            held = []
        for lo, hi in zip(cuts, cuts[1:]):
            if lo:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
        last = rows[-1]
    if held:
        yield pa.Table.from_batches(held)


def _met(percent: int, best: bool):
    """Compares the classes of a task (band, lo, hi): those of chunk lo with those of chunk hi.

    Gives pairs of different components whose sizes and signatures allow the threshold, in the first band in which the
    two meet: for each class its most similar partner there (best), or all.
    """
    least = _least(percent)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int]] = []
        for table in _runs(batches, ["band", "lo", "hi"]):
            node, comp, n, chunk = (table.column(c).to_numpy() for c in ("node", "c", "n_shingles", "chunk"))
            sig = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(len(node), -1)
            lo, hi, k = (table.column(c)[0].as_py() for c in ("lo", "hi", "k"))
            left, right = (np.flatnonzero(chunk == lo), np.flatnonzero(chunk == hi))
            if lo == hi and len(left) < 2:
                continue
            tops = {}
            for at in range(0, len(left), 64):
                i = left[at : at + 64]
                j = right[at + 1 :] if lo == hi else right
                ok = comp[i][:, None] != comp[j][None, :]
                ok &= 100 * np.minimum(n[i][:, None], n[j][None, :]) >= percent * np.maximum(n[i][:, None], n[j][None, :])
                if lo == hi:
                    ok &= j[None, :] > i[:, None]
                rows, cols = np.nonzero(ok)
                for p in range(0, len(rows), 4_000):
                    r, c = rows[p : p + 4_000], cols[p : p + 4_000]
                    a, b = sig[i[r]], sig[j[c]]
                    equal = a == b
                    agree = equal.sum(axis=1)
                    likely = np.flatnonzero(agree >= least)
                    first = equal[likely, : BANDS * ROWS].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
                    for q in likely[first == k]:
                        m, u, v = int(agree[q]), int(node[i[r[q]]]), int(node[j[c[q]]])
                        if best:
                            tops[u] = max(tops.get(u, (0, 0)), (m, v))
                            tops[v] = max(tops.get(v, (0, 0)), (m, u))
                        else:
                            out.append((min(u, v), max(u, v), m))
            out += [(u, v, m) for u, (m, v) in tops.items()]
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b", "agree"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b", "agree"])

    return compare


def _linked(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("items_a").to_pylist(), batch.column("items_b").to_pylist()):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                merged = np.concatenate([a, b])
                merged.sort(kind="stable")
                both = int((merged[1:] == merged[:-1]).sum())
                keep.append(100 * both >= percent * (len(merged) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirm


def _likely(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of classes that may link by size and signature."""
    side = lambda k: members.select(F.col("node").alias(k), F.col("signature").alias(f"sig_{k}"), F.col("n_shingles").alias(f"n_{k}"))
    likely = pairs.join(side("a"), "a").join(side("b"), "b")
    likely = likely.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b", "sig_a", "sig_b")
    return likely.mapInArrow(_similar(percent), "a long, b long")


def _confirmed(likely: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of classes that link on their full sets."""
    held = lambda k: members.select(F.col("node").alias(k), F.col("items").alias(f"items_{k}"))
    return stash(likely.join(held("a"), "a").join(held("b"), "b").select("a", "b", "items_a", "items_b").mapInArrow(_linked(percent), "a long, b long"), "links")


def near_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: row (its number here), doc_id, text_key, n_shingles, component_id, first.

    Classes are linked where 100 x intersection >= percent x union of their sets of distinct 5-word shingles; a text
    with fewer words is one shingle; one without words, or null, links with nothing and is its own component.
    component_id is the smallest doc_id of the rows reachable (a null id last, null if there is no other). first marks
    one row of each component: the one with that id, of repeated ids the first by row number. Repeated rows are linked
    as equal texts. Empty table: no rows.
    """
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("text_key", text_key())
    signed = stash(rows.select(F.monotonically_increasing_id().alias("row"), "*").mapInArrow(_signed, SIGNED), "signed")
    filled = signed.where("set_key is not null")
    classes = filled.groupBy("set_key").agg(F.min("row").alias("node"))
    nodes = filled.withColumnRenamed("row", "node").join(classes.select("node"), "node").select("node", "text_key", "set_key", "signature", "n_shingles")
    nodes = stash(nodes, "nodes")
    bands = F.array(*[F.struct(F.lit(k).alias("k"), F.xxhash64(F.lit(k), F.substring("signature", ROWS * k + 1, ROWS)).alias("band")) for k in range(BANDS)])
    spread = nodes.select("node", F.explode(bands).alias("b")).select("node", "b.k", "b.band")
    meeting = spread.groupBy("band").agg(F.count("*").alias("members"), F.min_by("node", F.xxhash64("node")).alias("centre")).where("members > 1").select("band", "centre")
    buckets = stash(spread.join(meeting, "band"), "buckets")

    # Only classes that share a bucket need their sets: their texts are read once more.
    wanted = nodes.join(buckets.select("node").distinct(), "node")
    found = rows.select("text_key", "text").join(wanted.select("text_key", "node", "set_key", "signature", "n_shingles"), "text_key")
    members = found.mapInArrow(_sets, "node long, signature binary, n_shingles long, items binary")
    members = stash(members.dropDuplicates(["node"]), "members")

    # A class is in BANDS buckets at most, dealt by class once; a pair is found once, as centres go by the order of hashes.
    star = buckets.where("node != centre").repartition("node").groupBy("node", "centre").agg(F.count("*").alias("times"))
    star = star.groupBy("node").agg(F.max_by("centre", F.struct("times", "centre")).alias("b")).withColumnRenamed("node", "a")
    links = _confirmed(_likely(star, members, percent), members, percent)
    joined = components(links)
    best, rounds = True, 0
    while True:
        pairs = _apart(buckets, members, joined).mapInArrow(_met(percent, best), "a long, b long, agree long")
        if best:
            pairs = pairs.groupBy("a").agg(F.max_by("b", F.struct("agree", "b")).alias("b"))
            pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        found = _confirmed(pairs.select("a", "b"), members, percent)  # a list holds each pair once, in its first band
        new = not found.isEmpty()  # a table by now: pairs are confirmed once
        if new:
            joined = components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(found))
        if not best:
            break
        rounds += 1
        best = new and rounds < PARTNER_ROUNDS  # once no partner links any more, the rest is listed

    of_class = nodes.select("set_key", "node").join(joined, "node", "left").select("set_key", F.coalesce("component", "node").alias("group"))
    out = signed.join(of_class, "set_key", "left").select("row", "doc_id", "text_key", "n_shingles", F.coalesce("group", "row").alias("group"))
    out = stash(out, "grouped")
    least = out.groupBy("group").agg(F.min("doc_id").alias("component_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best"))
    least = stash(least.select("group", "component_id", F.col("best.row").alias("best")), "least")  # so that Spark can split the join
    return out.join(least, "group").select("row", "doc_id", "text_key", "n_shingles", "component_id", (F.col("row") == F.col("best")).alias("first"))


def _apart(buckets: DataFrame, members: DataFrame, joined: DataFrame) -> DataFrame:
    """The buckets that hold several components, dealt out to tasks (band, lo, hi) of two chunks at most, sorted."""
    tagged = buckets.join(joined, "node", "left").select("k", "band", "node", F.coalesce("component", "node").alias("c"))
    mixed = tagged.groupBy("band").agg(F.min("c").alias("least"), F.max("c").alias("most"), F.count("*").alias("n")).where("least != most")
    tagged = tagged.join(mixed.select("band", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), "band")
    tagged = tagged.join(members.select("node", "n_shingles", "signature"), "node").withColumn("chunk", F.pmod(F.xxhash64(F.lit(9), "node"), F.col("chunks")).cast("int"))
    tagged = tagged.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    tagged = tagged.select("band", "k", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "chunk", "node", "c", "n_shingles", "signature")
    return tagged.repartition("band", "lo", "hi").sortWithinPartitions("band", "lo", "hi")


def near_dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs; kept as doc_id = component_id (null: false).

    See near_components for the links and for nulls, short texts and repeated rows.
    """
    found = near_components(docs, percent)
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def drop_near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of docs for each component of near_components(), all columns as they were."""
    return keep_rows(docs, near_components(docs, percent).where("first").select("doc_id", "text_key"))


SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) end as s from words
), classes as (
  select list_sort(s) as s, min(doc_id) as node, len(any_value(s)) as n from sets where len(s) > 0 group by 1
), items as (
  select node, n, unnest(s) as item from classes
), rare as (
  select node, n, item, row_number() over (partition by node order by freq, item) as k
  from (select *, count(*) over (partition by item) as freq from items)
), probe as (
  select * from rare where k <= n - ceil(0.85 * n) + 1
), pairs as (
  select distinct p.node as a, q.node as b from probe p join probe q on p.item = q.item and p.node < q.node
  where 100 * least(p.n, q.n) >= 85 * greatest(p.n, q.n)
), linked as (
  select a, b from pairs join items x on x.node = a join items y on y.node = b and y.item = x.item
  group by a, b, x.n, y.n having 100 * count(*) >= 85 * (x.n + y.n - count(*))
), ways as (select a, b from linked union all select b, a from linked
), reach as (
  select node as a, node as b from classes union select r.a, w.b from reach r join ways w on r.b = w.a
), comp as (select a as node, min(b) as component_id from reach group by a
)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, coalesce(c.component_id, s.doc_id) as component_id, s.doc_id = coalesce(c.component_id, s.doc_id) as kept
from sets s left join classes k on list_sort(s.s) = k.s left join comp c on c.node = k.node
"""
