"""Toxicity by maximum-scoring segments of token log-odds.

A word's score is its log-odds between toxic and other labelled texts, in texts that have it, smoothed by a chain of
Dirichlet priors: each prefix of the word is the prior of the next longer one, and the longest that of the word, so
that unseen forms of a known stem have its score. It leaves its prior's score only by what exceeds a multiple of its
standard error, so that chance words have none. A text is scanned once (Ruzzo and Tompa's algorithm): less a drift, its scores have disjoint
maximal segments. The best one's score S follows an extreme-value law in clean texts of n words,
P(S >= x) = 1 - exp(-K n exp(-lambda x)); lambda and K are the most likely ones for clean labelled texts (PULL texts of
a mean score of 1 pull lambda to 1, its value for plain log-odds). A text's evidence is the sum over its significant segments of -ln P, and a logistic curve takes
its root, which grows like a normal deviate, to a probability. Counts come from one part of the labelled rows and the calibration from another.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernglass.llm.shared import discard, fold, logistic, pick, small_batches, stash, texts, words_of

#: Labelled rows of each class that are learned from, about: all of them, or as many of the least hashes of the id.
SAMPLE_DOCS = 20_000
#: Texts that stand for lambda = 1 in its fit, and where it is looked for.
PULL, LAMBDAS = 5.0, (0.02, 50.0)
PREFIXES = range(2, 10)
#: Characters of the prefixes that are scored ahead of all others.
SHORT = 3
PRIOR = 2.0
#: Bound of a prior's share: the same occurrences stand behind a word and its prefixes, and must not multiply.
LEAST = 0.05
#: Standard errors taken off a departure from the prior.
ERRORS = 1.64
#: Taken from each word's score.
DRIFT = 0.7
#: Texts of fewer words count as this long in the extreme-value law.
SHORTEST = 50
#: A segment is significant if a clean text has one as good with at most this chance.
CHANCE = 0.01
THRESHOLD = 0.3
_TRIM = re.compile(r"^\W+|\W+$")
_KEPT = 200_000
_FLUSH = 30_000


@dataclass
class Model:
    """words and prefixes: log-odds; lam, k: the extreme-value law; slope, base: the logistic curve."""

    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    lam: float = 1.0
    k: float = 1.0
    slope: float = 0.0
    base: float = -6.0

    def score(self, word: str) -> float:
        if (s := self.words.get(word)) is not None:
            return s
        for n in reversed(PREFIXES):
            if n < len(word) and (s := self.prefixes.get(word[:n])) is not None:
                return s
        return 0.0

    def tail(self, best: float, n: int) -> float:
        """-ln of the probability that a clean text of n words has a segment this good."""
        if best <= 0:
            return 0.0
        expected = self.k * max(n, SHORTEST) * math.exp(-self.lam * best)
        return -math.log(-math.expm1(-expected)) if expected > 1e-12 else self.lam * best - math.log(self.k * max(n, SHORTEST))

    def evidence(self, found: list[tuple[int, int, float]], n: int) -> float:
        return sum(t for _, _, s in found if (t := self.tail(s, n)) >= -math.log(CHANCE))

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * math.sqrt(evidence) + self.base))))


class Scores(dict):
    """Scores of words as they stand in a text (bytes), less the drift, kept while there is room."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, raw: bytes) -> float:
        word = _TRIM.sub("", raw.decode("utf-8", "replace").lower())
        s = (self.model.score(word) if word else 0.0) - DRIFT
        if len(self) >= _KEPT:
            self.clear()
        self[raw] = s
        return s


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments [start, end) of a sequence, in its order, in one scan over its positive items."""
    at = np.flatnonzero(scores > 0)
    if not len(at):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    kept: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum after
    for i in at.tolist():
        start, end, left, right = i, i + 1, float(total[i]), float(total[i + 1])
        while kept:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= left:
                j -= 1
            if j < 0 or kept[j][3] >= right:
                break
            start, left = kept[j][0], kept[j][2]
            del kept[j:]
        kept.append((start, end, left, right))
    return [(s, e, r - q) for s, e, q, r in kept]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key (w: a word, p: a prefix), n1, n0 of a task's labelled texts, sent on whenever many have gathered."""
    counts = (Counter(), Counter())

    def out():
        found = (Counter(), Counter())
        for label, words in enumerate(counts):
            for raw, n in words.items():
                word = _TRIM.sub("", raw.decode("utf-8", "replace").lower())
                if word:
                    found[label]["w" + word] += n
                    for k in PREFIXES:
                        if k < len(word):
                            found[label]["p" + word[:k]] += n
            words.clear()
        keys = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([found[1][k] for k in keys], pa.int64()), pa.array([found[0][k] for k in keys], pa.int64())], names=["key", "n1", "n0"])

    for batch in batches:
        for label, text in zip(batch.column("toxic").to_pylist(), texts(batch.column("text"))):
            counts[label].update(set(chain.from_iterable(words_of(text.lower()))))
        if len(counts[0]) + len(counts[1]) > _FLUSH:
            yield from out()
    yield from out()


def _log_odds(rows: list[tuple[str, int, int]], total1: int, total0: int, known: dict[str, float] | None = None) -> tuple[dict, dict]:
    """Scores of words and prefixes, each smoothed towards its longest prefix; known: prefixes with scores already.

    Left out are those that do not depart from that prefix's score: looking them up finds it all the same.
    """
    rate = total1 / max(total0, 1)
    prefixes: dict[str, float] = dict(known or {})

    def prior(text: str) -> float:
        for n in range(len(text) - 1, PREFIXES[0] - 1, -1):
            if (s := prefixes.get(text[:n])) is not None:
                return s
        return 0.0

    def smoothed(text: str, n1: int, n0: int, found: dict[str, float]) -> None:
        stem = prior(text)
        q = min(1 - LEAST, max(LEAST, 1 / (1 + math.exp(-stem))))
        off = math.log((n1 + PRIOR * q) / (n0 * rate + PRIOR * (1 - q))) - stem
        error = ERRORS * math.sqrt(1 / (n1 + 1) + 1 / (n0 * rate + 1))
        if abs(off) > error:
            found[text] = stem + math.copysign(abs(off) - error, off)

    words: dict[str, float] = {}
    for key, n1, n0 in sorted((r for r in rows if r[0][0] == "p"), key=lambda r: len(r[0])):
        smoothed(key[1:], n1, n0, prefixes)
    for key, n1, n0 in rows:
        if key[0] == "w":
            smoothed(key[1:], n1, n0, words)
    return words, prefixes


def _departing(total1: int, total0: int, known: dict[str, float]):
    """Of keys that hold each other's prefixes but for the known ones: those with a score of their own."""

    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table.column(c).to_pylist() for c in ("key", "n1", "n0"))))
        words, prefixes = _log_odds(rows, total1, total0, known)
        found = {"w" + w: s for w, s in words.items()} | {"p" + p: s for p, s in prefixes.items() if p not in known}
        return pa.table({"key": pa.array(list(found), pa.string()), "score": pa.array(list(found.values()), pa.float64())})

    return run


def lexicon(counts: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Scores of words and of prefixes, of counts (key, n1, n0) of all words and prefixes of the labelled sample."""
    counts = stash(counts, "toxic-counts")
    total = counts.where(F.substring("key", 1, 1) == "w").agg(F.coalesce(F.sum("n1"), F.lit(0)).alias("n1"), F.coalesce(F.sum("n0"), F.lit(0)).alias("n0")).first()
    words: dict[str, float] = {}
    prefixes: dict[str, float] = {}
    if total["n1"] and total["n0"]:
        # Prefixes of up to three characters first, which are few, so that the rest can be dealt by four.
        short = F.expr(f"substring(key, 1, 1) = 'p' and length(key) <= {SHORT + 1}")
        for rows, dealt in ((counts.where(short), PREFIXES[0]), (counts.where(~short), SHORT + 1)):
            start = F.substring("key", 2, dealt).alias("start")
            found = rows.groupBy(start).applyInArrow(_departing(total["n1"], total["n0"], prefixes), "key string, score double").toArrow()
            for key, score_ in zip(found.column("key").to_pylist(), found.column("score").to_pylist()):
                (words if key[0] == "w" else prefixes)[key[1:]] = score_
    discard(counts)
    return words, prefixes


def extreme_law(clean: list[tuple[int, float]]) -> tuple[float, float]:
    """The most likely lambda and K of clean texts' (words, best score; 0 where no segment is above 0)."""
    n = np.array([max(words, SHORTEST) for words, _ in clean], float)
    s = np.array([best for _, best in clean], float)
    some = s > 0
    if not len(n):
        return 1.0, 1.0
    m, total = some.sum() + PULL, s[some].sum() + PULL

    def likely(lam: float) -> float:
        return m * math.log(lam) - lam * total - some.sum() * math.log((n * np.exp(-lam * s)).sum())

    lo, hi = map(math.log, LAMBDAS)
    for _ in range(80):  # by thirds of the logarithm: the likelihood rises to its maximum and falls
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        lo, hi = (a, hi) if likely(math.exp(a)) < likely(math.exp(b)) else (lo, b)
    lam = math.exp((lo + hi) / 2)
    return lam, float((some.sum() + 0.5) / (n * np.exp(-lam * s)).sum())


def _best(texts_: Iterator[bytes], model: Model) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """Words and segments of each text."""
    scores = Scores(model)
    for text in texts_:
        times: Counter = Counter()
        parts = []
        for words in words_of(text):
            own = np.fromiter(map(scores.__getitem__, words), np.float64, len(words))
            for i in np.flatnonzero(own > 0).tolist():
                times[words[i]] += 1
                own[i] = (own[i] + DRIFT) / times[words[i]] - DRIFT
            parts.append(own)
        own = np.concatenate(parts) if len(parts) != 1 else parts[0]
        yield len(own), segments(own)


def _extremes(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_best(texts(batch.column("text")), shared.value))
            scores = pa.array([[s for _, _, s in parts] for _, parts in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([n for n, _ in found], pa.int64()), scores], names=["toxic", "n", "scores"])

    return run


def labelled(docs: DataFrame, labels: DataFrame, folds: tuple[int, ...], sample_docs: int) -> DataFrame:
    """text and toxic of the labelled rows in these folds (crc32(doc_id) mod 4), about sample_docs of each class.

    Rows of labels without an id or a label are left out; of several rows for an id the highest label counts.
    """
    marks = pick(labels, "doc_id", "toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    marks = marks.where(fold(F.col("doc_id"), 4).isin(*folds))
    sizes = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    for label, n in sizes.items():
        if n > sample_docs:
            marks = marks.where((F.col("toxic") != label) | (share < sample_docs / n))
    # Two classes of about sample_docs ids at most, whatever the table of labels.
    return pick(docs, "doc_id", "text").join(F.broadcast(marks), "doc_id").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learns from labelled rows with crc32(doc_id) mod 4 of 0 and 1 (counts) and 3 (calibration), never from 2.

    Without rows of both classes the model knows nothing: it gives every text the share of toxic labels, 0.0025 if
    there is no label.
    """
    rows = labelled(docs, labels, (0, 1), sample_docs)
    counts = rows.mapInArrow(_word_counts, "key string, n1 long, n0 long").groupBy("key").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    model = Model()
    model.words, model.prefixes = lexicon(counts)
    found = labelled(docs, labels, (3,), sample_docs).mapInArrow(_extremes(docs.sparkSession.sparkContext.broadcast(model)), "toxic int, n long, scores array<double>").collect()
    y = np.array([r["toxic"] for r in found], float)
    if not len(y):
        return model
    if not 0 < y.sum() < len(y):
        model.slope, model.base = 0.0, math.log((y.sum() + 0.01) / (len(y) - y.sum() + 0.01))
        return model
    model.lam, model.k = extreme_law([(r["n"], max(r["scores"], default=0.0)) for r in found if not r["toxic"]])
    x = np.sqrt([model.evidence([(0, 0, s) for s in r["scores"]], r["n"]) for r in found])
    model.slope, model.base = logistic(x, y)
    return model


SCORED = "doc_id long, held_out boolean, score double, predicted int, n_words long, segments array<struct<start:int,end:int,score:double,chance:double>>"


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("chance", pa.float64())]))
        for batch in batches:
            ns, scores, parts = [], [], []
            for n, found in _best(texts(batch.column("text")), model):
                ns.append(n)
                scores.append(model.probability(model.evidence(found, n)))
                told = [{"start": a, "end": b, "score": s, "chance": p} for a, b, s in found if (p := math.exp(-model.tail(s, n))) <= CHANCE]
                parts.append(told)
            p = pa.array(scores, pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), p, pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()), pa.array(ns, pa.int64()), pa.array(parts, spans)], names=["doc_id", "held_out", "score", "predicted", "n_words", "segments"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted, n_words, segments.

    segments: the passages (word positions) whose like a clean text of this length has with a chance of CHANCE at most. A
    null or empty text has no words and the score of a text without evidence. Very long texts are scanned whole. Of
    segments that tie, the shortest is the maximal one; a score of exactly THRESHOLD is predicted toxic. Rows that repeat are scored each for itself. Other
    columns of docs are ignored. Empty table: no rows.
    """
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), (fold(F.col("doc_id"), 4) == 2).alias("held_out"))
    return rows.mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast(model)), SCORED)


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """docs without the rows whose text is predicted toxic, all columns as they were. Null and empty texts stay."""
    names = docs.columns
    at = names.index("text")
    flat = small_batches(docs).toDF(*[f"_{i}" for i in range(len(names))])  # as names may differ in case only
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [shared.value.probability(shared.value.evidence(found, n)) < THRESHOLD for n, found in _best(texts(batch.column(at)), shared.value)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return flat.mapInArrow(run, flat.schema).toDF(*names)
