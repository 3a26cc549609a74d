"""A hidden Markov language model, trained by Baum-Welch over all training texts and scored by the forward recursion.

States emit symbols. A symbol is one of the FREQUENT most frequent words, the end of a text, or a class of other
words (by the last bytes of the word); a class emits its words by their corpus counts, with one place for unknown
words: P(w | class) = (c(w) + 1) / (N_class + V_class + 1). All counts cover all training texts.

Words with counts at or above a cut, TABLE of them at most, are broadcast with their counts; what a text holds
besides, its rare words, meets the whole table of counts in one join, so that no step holds a vocabulary that grows
with the corpus. Baum-Welch starts from clusters of all training texts: each is dealt by its words to one of CELLS cells,
by the sides of PLANES planes through the corpus's own mean on which it lies, and the symbols of all texts of a cell are
counted; cells of one language or subject make a state. It then passes over all training texts, whose expected counts are added up across partitions, until a pass finds that the one
before gained less than GAIN a token, PASSES times at most. Texts are trained on and scored whole: very long ones keep the
forward variables of every BLOCK-th token only, and those between are made again on the way back.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernglass.llm.shared import fold, pick, stash, texts, words_of

STATES = 12
#: Words with a symbol of their own; classes of the others; bytes at a word's end that make its class.
FREQUENT, CLASSES, TAIL = 16_384, 2_048, 3
#: Words that are broadcast with their counts.
TABLE = 300_000
#: Passes of Baum-Welch over all training texts at most, and the gain in nats a token below which they end.
PASSES, GAIN = 2, 0.002
#: Planes that deal all training texts to cells, whose counts are clustered in WARM_STEPS steps to start from.
PLANES, WARM_STEPS = 6, 12
CELLS = 2**PLANES
#: A state's emissions are smoothed by so many tokens of the whole corpus, its transitions by so many to each state.
SMOOTH, SMOOTH_MOVES = 200.0, 1.0
#: Tokens that a worker gathers before it runs the recursions, and tokens from which texts are gathered with other long
#: ones, as a step of the recursions costs the same for few texts as for many.
GATHER, LONG = 1_000_000, 1_500
#: Tokens from which a text's recursions run in blocks, and of a block.
HUGE, BLOCK = 1_000_000, 20_000
END = b""
#: Other words whose class a Python worker keeps.
KEPT_WORDS = 200_000
_FLUSH = 400_000


class Rows(dict):
    """Row of each table word; for other words -1 - class, kept while there is room."""

    room = KEPT_WORDS

    def __missing__(self, word: bytes) -> int:
        row = -1 - zlib.crc32(word[-TAIL:]) % CLASSES
        if self.room > 0:
            self.room -= 1
            self[word] = row
        return row

    def __reduce__(self):
        return Rows, (dict(self),)


@dataclass
class Vocabulary:
    """index: table word -> row; symbols, counts: of each row; classes: N and V of each class; n, v: of all tokens."""

    index: Rows
    symbols: np.ndarray
    counts: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    n: int
    v: int
    frequent: int

    @property
    def size(self) -> int:
        return self.frequent + CLASSES

    def rows(self, words: list[bytes]) -> np.ndarray:
        """Row of each word, or -1 - class for those outside the table."""
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def symbols_of(self, rows: np.ndarray) -> np.ndarray:
        return np.where(rows >= 0, self.symbols[np.maximum(rows, 0)], self.frequent - 1 - rows)


@dataclass
class Hmm:
    """start [K], move [K, K], emit [symbols, K]: probabilities."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out():
        keys = list(counts)
        for i in range(0, len(keys), 50_000):
            part = keys[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([counts[k] for k in part], pa.int64())], names=["word", "n"])
        counts.clear()

    for batch in batches:
        for text in texts(batch.column("text")):
            for words in chain(words_of(text.lower()), [[END]]):
                counts.update(words)
                if len(counts) > _FLUSH:
                    yield from out()
    yield from out()


def word_counts(rows: DataFrame) -> DataFrame:
    """word (binary, empty for the end), n: over all texts of rows."""
    return rows.select("text").mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, table: int = TABLE, frequent: int = FREQUENT) -> Vocabulary:
    """Collects at most `table` words, 4,096 numbers of classes and a histogram of counts below 10,000."""
    spread = counts.groupBy(F.least("n", F.lit(10_000)).alias("n")).agg(F.count("*").alias("words")).collect()
    spread = sorted(((r["n"], r["words"]) for r in spread), reverse=True)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    cut, held = None, 0
    for n, words in spread:
        if held + words > table:
            break
        cut, held = n, held + words
    best = [(bytes(r["word"]), r["n"]) for r in (counts.where(F.col("n") >= cut).collect() if cut else counts.orderBy(F.desc("n"), "word").limit(table).collect())]
    best.sort(key=lambda x: (-x[1], x[0]))
    own = min(frequent, len(best))
    klass = F.pmod(F.crc32(F.expr(f"substring(word, -{TAIL}, {TAIL})")), F.lit(CLASSES))
    lowest = best[own - 1] if own else None
    rest = counts if lowest is None else counts.where((F.col("n") < lowest[1]) | ((F.col("n") == lowest[1]) & (F.col("word") > F.lit(lowest[0]))))
    tokens_of, words_of = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in rest.groupBy(klass.alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():  # at most CLASSES rows
        tokens_of[r["k"]], words_of[r["k"]] = r["n"], r["v"]
    symbols = np.array([i if i < own else own + zlib.crc32(w[-TAIL:]) % CLASSES for i, (w, _) in enumerate(best)] or [0], np.int64)
    return Vocabulary(Rows((w, i) for i, (w, _) in enumerate(best)), symbols, np.array([n for _, n in best] or [0], np.float64), tokens_of, words_of, int(total["n"]), int(total["v"]), own)


def background(v: Vocabulary) -> np.ndarray:
    """Each symbol's share of the training tokens, with one token more for each."""
    share = np.concatenate([v.counts[: v.frequent], v.class_tokens]) + 1
    return share / share.sum()


class Packed:
    """Sequences of symbols, longest first, laid out by position: the symbols at position t are one slice."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(s) for s in sequences], np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        flat = np.concatenate([sequences[i] for i in self.order]) if len(sequences) else np.zeros(0, np.int64)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.symbols = flat[np.argsort(at.astype(np.uint16 if len(lengths) and lengths[0] < 65_536 else np.int64), kind="stable")]
        self.active = np.bincount(at) if len(flat) else np.zeros(0, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.active)])


def forward(h: Hmm, p: Packed, keep: bool = False) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    """Log likelihood (natural) of each sequence, in the order given; with keep, the scaled alphas and the scales."""
    ll = np.zeros(len(p.order))
    alphas = np.empty((len(p.symbols), len(h.start)), h.emit.dtype) if keep else None
    scales = np.empty(len(p.symbols), h.emit.dtype) if keep else None
    alpha = None
    for t, n in enumerate(p.active.tolist()):
        lo = p.starts[t]
        e = h.emit[p.symbols[lo : lo + n]]
        alpha = e * h.start if alpha is None else (alpha[:n] @ h.move) * e
        c = alpha.sum(axis=1)
        alpha /= c[:, None]
        ll[:n] += np.log(c)
        if keep:
            alphas[lo : lo + n] = alpha
            scales[lo : lo + n] = c
    out = np.empty(len(ll))
    out[p.order] = ll
    return out, alphas, scales


def expected(h: Hmm, p: Packed, size: int, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts of starts (of the sequences that begin a text), moves and emissions; the log likelihood of all."""
    ll, alphas, scales = forward(h, p, keep=True)
    k = len(h.start)
    moves = np.zeros((k, k))
    gamma = alphas  # in place: alpha becomes gamma from the last position on
    beta = None
    for t in range(len(p.active) - 1, -1, -1):
        lo, n = p.starts[t], int(p.active[t])
        own = np.ones((n, k), h.emit.dtype)
        if beta is not None:
            nlo, m = p.starts[t + 1], int(p.active[t + 1])
            w = h.emit[p.symbols[nlo : nlo + m]] * beta / scales[nlo : nlo + m, None]
            own[:m] = w @ h.move.T
            moves += gamma[lo : lo + m].T @ w
        gamma[lo : lo + n] *= own
        beta = own
    moves *= h.move
    starts = (gamma[: len(p.order)] * begins[p.order][:, None]).sum(axis=0) if len(p.symbols) else np.zeros(k)
    emits = np.stack([np.bincount(p.symbols, weights=column, minlength=size) for column in np.ascontiguousarray(gamma.T)], axis=1)
    return starts, moves, emits, float(ll.sum())


def expected_in_blocks(h: Hmm, symbols: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """The same for one very long text, and its log likelihood, with no more than a block's variables at a time."""
    k = len(h.start)

    def block(lo: int, alpha: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        own = symbols[lo : lo + BLOCK]
        alphas, scales = np.empty((len(own), k), h.emit.dtype), np.empty(len(own), h.emit.dtype)
        for t, e in enumerate(h.emit[own]):
            alpha = e * h.start if alpha is None else (alpha @ h.move) * e
            scales[t] = alpha.sum()
            alpha = alphas[t] = alpha / scales[t]
        return alphas, scales

    borders: list[np.ndarray | None] = [None]
    ll = 0.0
    for lo in range(0, len(symbols), BLOCK):
        alphas, scales = block(lo, borders[-1])
        borders.append(alphas[-1].copy())
        ll += float(np.log(scales.astype(np.float64)).sum())
    starts, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros((size, k))
    w = None  # of the token after: its emission times beta over its scale
    for i in range(len(borders) - 2, -1, -1):
        lo = i * BLOCK
        alphas, scales = block(lo, borders[i])
        gamma = np.empty_like(alphas)
        own = symbols[lo : lo + BLOCK]
        for t in range(len(own) - 1, -1, -1):
            beta = h.move @ w if w is not None else np.ones(k, h.emit.dtype)
            if w is not None:
                moves += np.outer(alphas[t], w)
            gamma[t] = alphas[t] * beta
            w = h.emit[own[t]] * beta / scales[t]
        for z in range(k):
            emits[:, z] += np.bincount(own, weights=gamma[:, z], minlength=size)
        starts = gamma[0].astype(np.float64)
    return starts, moves * h.move, emits, ll


def estimate(starts: np.ndarray, moves: np.ndarray, emits: np.ndarray, share: np.ndarray) -> Hmm:
    emit = emits + SMOOTH * share[:, None]
    move = moves + SMOOTH_MOVES
    start = starts + 1
    return Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0, keepdims=True))


def cluster(sequences: list[np.ndarray], share: np.ndarray, states: int) -> Hmm:
    """cluster_counts() of single texts."""
    return cluster_counts(np.stack([np.bincount(s, minlength=len(share)) for s in sequences]) if sequences else np.zeros((0, len(share))), share, states)


def cluster_counts(counts: np.ndarray, share: np.ndarray, states: int) -> Hmm:
    """A first model: a mixture of word distributions over whole texts, or sums of texts, one for each state, which rarely changes.

    counts: of the symbols of each text, [texts, symbols]; empty ones say nothing.
    """
    k = states
    counts = counts[counts.sum(axis=1) > 0].astype(np.float64)
    emits = np.zeros((len(share), k))
    if len(counts):
        # Seeds far apart: each next one is the text that the clusters so far explain worst, for each of its tokens.
        lengths = counts.sum(axis=1)
        long = lengths >= min(40, lengths.max())
        seeds = [int(np.argmax(np.minimum(lengths, 400)))]
        worst = np.full(len(counts), -np.inf)
        for _ in range(k - 1):
            seed = counts[seeds[-1]] / lengths[seeds[-1]] * min(lengths[seeds[-1]], 20_000) + 50 * share
            worst = np.maximum(worst, counts @ (np.log(seed / seed.sum()) - np.log(share)) / lengths)
            seeds.append(int(np.argmin(np.where(long, worst, np.inf))))
        emits = counts[seeds].T.copy()
        prior = np.full(k, 1 / k)
        for _ in range(WARM_STEPS):
            emit = emits + 50 * share[:, None]
            score = counts @ np.log(emit / emit.sum(axis=0)) + np.log(prior)
            score -= score.max(axis=1, keepdims=True)
            post = np.exp(score)
            post /= post.sum(axis=1, keepdims=True)
            emits = counts.T @ post
            prior = (post.sum(axis=0) + 1) / (len(post) + k)
    total = emits.sum(axis=0)
    moves = np.full((k, k), 0.02 / k) + 0.98 * np.eye(k)
    return estimate(total / max(total.sum(), 1), moves * 1000, emits, share)


class Pools:
    """Items with their numbers of tokens, given back in lots of about GATHER tokens: short texts, long ones, huge ones."""

    def __init__(self):
        self.lots: list[list] = [[], []]
        self.sizes = [0, 0]

    def add(self, item, tokens: int) -> list | None:
        """The lot that is full now, if any; a huge text is one by itself."""
        if tokens >= HUGE:
            return [item]
        k = int(tokens > LONG)
        self.lots[k].append(item)
        self.sizes[k] += tokens
        return self.take(k) if self.sizes[k] >= GATHER else None

    def take(self, k: int) -> list:
        lot, self.lots[k], self.sizes[k] = self.lots[k], [], 0
        return lot

    def rest(self) -> Iterator[list]:
        for k in (0, 1):
            if self.lots[k]:
                yield self.take(k)


def symbols_in(v: Vocabulary, text: bytes) -> np.ndarray:
    """The symbols of a text and its end, as 32-bit numbers."""
    parts = [v.symbols_of(v.rows(words)).astype(np.int32) for words in words_of(text.lower())]
    return np.concatenate([*parts, v.symbols_of(v.rows([END])).astype(np.int32)])


def _expectations(shared):
    """A task's expected counts as (key, value) rows: starts, then moves, then emissions; at -1 the log likelihood and at -2 the tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, h = shared.value
        h = Hmm(*(x.astype(np.float32) for x in (h.start, h.move, h.emit)))
        k = len(h.start)
        total = [np.zeros(k), np.zeros((k, k)), np.zeros((v.size, k))]
        ll = tokens_ = 0.0
        pools = Pools()

        def count(lot: list[np.ndarray]) -> None:
            nonlocal ll, tokens_
            if len(lot) == 1 and len(lot[0]) >= HUGE:
                *found, own = expected_in_blocks(h, lot[0], v.size)
            else:
                *found, own = expected(h, Packed(lot), v.size, np.ones(len(lot)))
            ll += own
            tokens_ += sum(map(len, lot))
            for a, b in zip(total, found):
                a += b

        for batch in batches:
            if "symbols" in batch.schema.names:
                sequences = (np.frombuffer(x.as_buffer(), _kind(v)).astype(np.int32) for x in batch.column("symbols"))
            else:
                sequences = (symbols_in(v, text) for text in texts(batch.column("text")))
            for own in sequences:
                if (lot := pools.add(own, len(own))) is not None:
                    count(lot)
        for lot in pools.rest():
            count(lot)
        values = np.concatenate([t.ravel() for t in total])
        keys = np.flatnonzero(values > 1e-9)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2], pa.int64()), pa.array([ll, tokens_])], names=["key", "value"])
        for i in range(0, len(keys), 50_000):
            part = keys[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(values[part])], names=["key", "value"])

    return run


def baum_welch(rows: DataFrame, v: Vocabulary, h: Hmm) -> tuple[Hmm, float]:
    """One pass over all texts of rows, or over the symbols that stand for them: expected counts of all tasks, added up by key, make the next model.

    Also the log likelihood (natural) of a token under h.
    """
    k = len(h.start)
    shared = rows.sparkSession.sparkContext.broadcast((v, h))
    sums = rows.select("symbols" if "symbols" in rows.columns else "text").mapInArrow(_expectations(shared), "key long, value double").groupBy("key").agg(F.sum("value").alias("value"))
    values, told = np.zeros(k + k * k + v.size * k), {-1: 0.0, -2: 0.0}
    for r in sums.toLocalIterator():  # at most states x (states + symbols + 1) rows, whatever the corpus
        if r["key"] < 0:
            told[r["key"]] = r["value"]
        else:
            values[r["key"]] = r["value"]
    return estimate(values[:k], values[k : k + k * k].reshape(k, k), values[k + k * k :].reshape(v.size, k), background(v)), told[-1] / max(told[-2], 1.0)


def _kind(v: Vocabulary) -> type:
    """The type in which symbols are stored: two bytes each where they fit, so that they take no more than the text."""
    return np.uint16 if v.size <= 1 << 16 else np.int32


def _dealt(shared):
    """Each text's cell and its symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        normals = np.random.default_rng(11).normal(size=(v.size, PLANES))
        normals -= background(v) @ normals
        for batch in batches:
            cells, found = [], []
            for text in texts(batch.column("text")):
                own = symbols_in(v, text)
                sums = normals[own].sum(axis=0) if len(own) < v.size else np.bincount(own, minlength=v.size) @ normals
                cells.append(int((sums > 0) @ (1 << np.arange(PLANES))))
                found.append(own.astype(_kind(v)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(found, pa.binary())], names=["cell", "symbols"])

    return run


def _cell_counts(size: int, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CELLS, size), np.int64)
        for batch in batches:
            for cell, found in zip(batch.column("cell").to_pylist(), batch.column("symbols")):
                np.add.at(total[cell], np.frombuffer(found.as_buffer(), kind), 1)
        flat = total.ravel()
        keys = np.flatnonzero(flat)
        for i in range(0, len(keys), 50_000):
            part = keys[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(flat[part])], names=["key", "n"])

    return run


def cell_counts(dealt: DataFrame, v: Vocabulary) -> np.ndarray:
    """How often each cell's texts, all of them, hold each symbol: [cells, symbols]."""
    sums = dealt.mapInArrow(_cell_counts(v.size, _kind(v)), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    out = np.zeros(CELLS * v.size)
    for r in sums.toLocalIterator():  # at most cells x symbols rows, whatever the corpus
        out[r["key"]] = r["n"]
    return out.reshape(CELLS, v.size)


@dataclass
class Model:
    vocabulary: Vocabulary
    hmm: Hmm
    counts: DataFrame
    #: Log likelihood of a training token before each pass, in nats.
    likelihoods: list[float]


def train(rows: DataFrame, states: int = STATES, passes: int = PASSES) -> Model:
    """rows: doc_id, text of the training texts. Without any, all words are unknown and states are alike."""
    counts = stash(word_counts(rows), "counts")
    v = vocabulary(counts, TABLE, FREQUENT)
    spark = rows.sparkSession
    dealt = stash(rows.select("text").mapInArrow(_dealt(spark.sparkContext.broadcast(v)), "cell int, symbols binary"), "symbols")
    h = cluster_counts(cell_counts(dealt, v), background(v), states)
    likelihoods: list[float] = []
    while len(likelihoods) < passes and not (len(likelihoods) > 1 and likelihoods[-1] - likelihoods[-2] < GAIN):
        h, ll = baum_welch(dealt, v, h)
        likelihoods.append(ll)
    return Model(v, h, counts, likelihoods)


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, lm double, rare array<binary>"


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, h = shared.value
        counts = np.log10(v.counts + 1)
        whole = math.log10(v.n + (v.v + 1))
        own = np.log10(v.class_tokens + v.class_words + 1)
        pools = Pools()

        def out(lot: list[tuple]):
            ll, _, _ = forward(h, Packed([x[8] for x in lot]))
            cols = list(zip(*lot))
            lm = np.array(cols[6]) + ll / math.log(10)
            for i in range(0, len(lot), 2000):
                j = i + 2000
                yield pa.RecordBatch.from_arrays([pa.array(cols[0][i:j], pa.int64()), pa.array(cols[1][i:j], pa.int64()), pa.array(cols[2][i:j], pa.bool_()), pa.array(cols[3][i:j], pa.int64()), pa.array(cols[4][i:j], pa.int64()), pa.array(cols[5][i:j], pa.float64()), pa.array(lm[i:j]), pa.array(cols[7][i:j], pa.list_(pa.binary()))], names=[x.split()[0] for x in SCORED.split(", ")])

        for batch in batches:
            for row, doc_id, held_out, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), texts(batch.column("text"))):
                n_tokens = n_known = 0
                base = in_class = 0.0
                rare: list[bytes] = []
                parts = []
                for words in chain(words_of(text.lower()), [[END]]):
                    rows = v.rows(words)
                    symbols = v.symbols_of(rows)
                    known = rows >= 0
                    logs = counts[rows[known]]
                    classed = symbols[symbols >= v.frequent] - v.frequent
                    in_class += float(logs[symbols[known] >= v.frequent].sum() - own[classed].sum())
                    base += float(logs.sum() - len(words) * whole)
                    rare += [words[i] for i in np.flatnonzero(~known).tolist()]
                    n_tokens += len(words)
                    n_known += int(known.sum())
                    parts.append(symbols.astype(np.int32))
                item = (row, doc_id, held_out, n_tokens, n_known, base, in_class, rare, np.concatenate(parts))
                if (lot := pools.add(item, n_tokens)) is not None:
                    yield from out(lot)
        for lot in pools.rest():
            yield from out(lot)

    return run


def score(docs: DataFrame, model: Model, held_out=None) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    base_score is the add-one unigram score, score the model's log10 probability of the text, its end included. A
    null or empty text is the end alone; very long texts are scored whole. Rows that repeat are scored each for itself; other columns of docs are
    ignored. Empty table: no rows.
    """
    rows = pick(docs, "doc_id", "text").select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), (F.lit(False) if held_out is None else held_out).alias("held_out"), F.col("text").cast("string"))
    found = stash(rows.mapInArrow(_scores(docs.sparkSession.sparkContext.broadcast((model.vocabulary, model.hmm))), SCORED), "scored")
    rare = found.select("row", F.explode("rare").alias("word")).join(model.counts, "word")
    sums = rare.groupBy("row").agg(F.sum(F.log10(F.col("n") + 1)).alias("logs"), F.count("*").alias("known"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    joined = found.drop("rare").join(sums, "row", "left")
    return joined.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("known")).alias("n_known"), F.lit(model.vocabulary.n).cast("long").alias("train_tokens"), (F.col("base") + zero("logs")).alias("base_score"), (F.col("lm") + zero("logs")).alias("score"))


def train_and_score(docs: DataFrame) -> DataFrame:
    """Learns from the rows whose crc32(doc_id) mod 7 is not 2 and scores all; held_out marks the others."""
    part = fold(F.col("doc_id"), 7)
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return score(docs, train(rows.where(part != 2)), part == 2)
