"""Language identification by interpolated Kneser-Ney models of characters, one for each language.

The model of a language gives a character after the ORDER - 1 before it
P(c | h) = max(n(hc) - D, 0) / n(h) + D t(h) / n(h) P(c | h without its first character), with counts of contexts
instead of n below the highest order, and a uniform floor. All languages share one sorted array of 64-bit hashes for
each order: a row holds the finished log probability of its n-gram in every language, or a context's back-off weight.
The language with the lowest cross-entropy for each character wins; a logistic curve on its lead, and on the length,
makes the score (fitted on whole calibration texts and on a few letters of each), and texts that even the winner
explains worse than nearly all calibration texts can be rejected.

A language is learned from a sample of its labelled texts that is bounded in texts and in bytes; of those texts every
n-gram counts, with no cut by frequency.
"""

from __future__ import annotations

import codecs
import math
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernglass.llm.shared import fold, logistic, pick, texts

ORDER = 5
DISCOUNT = 0.75
#: Labelled rows of each language that are learned from, about, and their bytes: all, or a share by the hash of the id.
SAMPLE_DOCS, SAMPLE_BYTES = 3_000, 16_000_000
#: Share of calibration texts that rejection may lose.
REJECT = 0.001
#: Characters of text that are scored at a time, and bytes that are folded at a time.
CHUNK, FOLDED = 400_000, 1_000_000
UNKNOWN = "und"
_BUCKET_BITS = 18
_P = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xD6E8FEB86659FD93)


def _fold_table() -> tuple[np.ndarray, np.ndarray]:
    """Each code point's lower-case letter, itself for a combining mark, or a blank for what is neither; which are letters."""
    table, letter = np.full(0x110000, 32, np.uint32), np.zeros(0x110000, bool)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
            letter[c] = True
        elif unicodedata.category(ch)[0] == "M":
            table[c] = c
    return table, letter


_TABLES: list[tuple[np.ndarray, np.ndarray]] = []


def letters(text: bytes) -> np.ndarray:
    """Code points of a text's lower-cased letters and marks, runs of all else as one blank, none at its ends.

    Nothing for a text without a letter. Read in slices, so that a long text takes four bytes for each of its characters.
    """
    if not _TABLES:
        _TABLES.append(_fold_table())
    table, letter = _TABLES[0]
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    found, some, last = [], False, 32
    for at in range(0, max(1, len(text)), FOLDED):
        raw = np.frombuffer(decoder.decode(text[at : at + FOLDED], at + FOLDED >= len(text)).encode("utf-32-le", "replace"), np.uint32)
        if not len(raw):
            continue
        some = some or bool(letter[raw].any())
        codes = table[raw]
        blank = codes == 32
        keep = ~blank
        keep[1:] |= ~blank[:-1]
        keep[0] |= last != 32
        last = int(codes[-1])
        found.append(codes[keep])
    if not some:
        return np.zeros(0, np.uint32)
    codes = np.concatenate(found) if len(found) > 1 else found[0]
    if len(codes) and codes[0] == 32:
        codes = codes[1:]
    return codes[:-1] if len(codes) and codes[-1] == 32 else codes


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            h = (h + c + np.uint64(1)) * _P
        h ^= h >> np.uint64(32)
        return h * _M


@dataclass
class Table:
    """Sorted hashes, where each bucket (their highest bits) starts, the most in one, and a row of values for each."""

    keys: np.ndarray
    starts: np.ndarray
    most: int
    values: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Table:
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order].astype(np.float32)
        starts = np.searchsorted(keys, np.arange(1 << _BUCKET_BITS, dtype=np.uint64) << np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
        sizes = np.diff(np.append(starts, len(keys)))
        return cls(np.append(keys, np.uint64(0)), starts, int(sizes.max()) if len(keys) else 0, np.vstack([values, np.zeros((1, values.shape[1]), np.float32)]))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, or -1."""
        at = self.starts[hashes >> np.uint64(64 - _BUCKET_BITS)]
        out = np.full(len(hashes), -1, np.int64)
        last = len(self.keys) - 1
        for k in range(self.most):
            i = np.minimum(at + k, last)
            hit = self.keys[i] == hashes
            hit &= i < last
            out[hit] = i[hit]
        return out


@dataclass
class Model:
    languages: list[str]
    #: grams[n - 1], contexts[n - 1]: tables of n-grams and of contexts of n characters.
    grams: list[Table] = field(default_factory=list)
    contexts: list[Table] = field(default_factory=list)
    floor: np.ndarray | None = None
    slope: float = 1.0
    base: float = 0.0
    limit: float = math.inf

    def entropies(self, parts: list[np.ndarray]) -> np.ndarray:
        """Cross-entropy for each character [texts, languages], in nats; the blank before and after a text included."""
        pad = np.full(ORDER - 1, 32, np.uint32)
        end = np.full(1, 32, np.uint32)
        codes = np.concatenate([x for p in parts for x in (pad, p, end)]).astype(np.uint64)
        sizes = np.array([len(p) + ORDER for p in parts])
        first = np.cumsum(sizes) - sizes
        inside = np.ones(len(codes), bool)
        for k in range(ORDER - 1):
            inside[first + k] = False
        at = np.flatnonzero(inside)
        logs = self.logs(codes, at)
        lengths = np.array([len(p) + 1 for p in parts])
        sums = np.add.reduceat(logs, np.cumsum(lengths) - lengths, axis=0, dtype=np.float64)
        return -sums / lengths[:, None]

    def entropy(self, codes: np.ndarray) -> np.ndarray:
        """The same of one long text, in slices that begin with the characters before them."""
        pad = ORDER - 1
        whole = np.concatenate([np.full(pad, 32, np.uint32), codes, np.full(1, 32, np.uint32)])
        total = np.zeros(len(self.languages))
        for lo in range(pad, len(whole), CHUNK):
            part = whole[lo - pad : lo + CHUNK].astype(np.uint64)
            total += self.logs(part, np.arange(pad, len(part))).sum(axis=0, dtype=np.float64)
        return -total / (len(codes) + 1)

    def logs(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log probability of the character at each place in each language, by the longest known n-gram."""
        out = np.zeros((len(at), len(self.languages)), np.float32)
        left = np.arange(len(at))
        for n in range(ORDER, 0, -1):
            places = at[left]
            rows = self.grams[n - 1].find(_hash([codes[places - k] for k in range(n - 1, -1, -1)]))
            known = rows >= 0
            out[left[known]] += self.grams[n - 1].values[rows[known]]
            left = left[~known]
            if not len(left):
                return out
            if n > 1:
                places = at[left]
                rows = self.contexts[n - 2].find(_hash([codes[places - k] for k in range(n - 1, 0, -1)]))
                out[left] += self.contexts[n - 2].values[rows]  # the last row, of zeros, where the context is unknown
        out[left] += self.floor
        return out


def kneser_ney(counts: dict[str, dict[str, int]], order: int = ORDER) -> Model:
    """The model of the languages' counts of n-grams of the highest order (strings)."""
    coded = {}
    for lang, found in counts.items():
        codes = np.frombuffer("".join(found).encode("utf-32-le"), np.uint32).reshape(len(found), order)
        coded[lang] = (codes, np.fromiter(found.values(), np.int64, len(found)))
    return kneser_ney_of(coded, order)


def _columns(codes: np.ndarray) -> np.ndarray:
    """The hash of each row of code points."""
    return _hash([codes[:, k].astype(np.uint64) for k in range(codes.shape[1])]) if codes.shape[1] else np.zeros(len(codes), np.uint64)


@dataclass
class _Level:
    """One language's n-grams: sorted hashes, code points, counts; then, hash of the context and log probability.

    contexts, weights: the sorted hashes of contexts and the logs of their back-off weights.
    """

    keys: np.ndarray
    codes: np.ndarray
    counts: np.ndarray
    logs: np.ndarray | None = None
    contexts: np.ndarray | None = None
    weights: np.ndarray | None = None

    @classmethod
    def of(cls, codes: np.ndarray, counts: np.ndarray | None = None) -> _Level:
        """Of rows of code points: distinct ones with their counts, or with the number of times that they occur."""
        keys, first, times = np.unique(_columns(codes), return_index=True, return_counts=True)
        return cls(keys, codes[first], times if counts is None else counts[first])


def _at(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each wanted hash among sorted keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def kneser_ney_of(counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int = ORDER) -> Model:
    """The model of the languages' n-grams of the highest order: code points [n-grams, order], each row once, and counts."""
    languages = sorted(counts)
    model = Model(languages)
    per: list[list[_Level]] = []
    for lang in languages:
        levels = [_Level.of(*counts[lang])]
        for _ in range(order - 1):
            levels.insert(0, _Level.of(levels[0].codes[:, 1:]))  # in how many contexts each continues
        per.append(levels)
    alphabet = len(np.unique(np.concatenate([levels[0].keys for levels in per]))) + 1
    for levels in per:
        for n, level in enumerate(levels):
            level.contexts, inverse, types = np.unique(_columns(level.codes[:, :-1]), return_inverse=True, return_counts=True)
            total = np.bincount(inverse, weights=level.counts, minlength=len(types))
            weight = DISCOUNT * types / total
            lower = np.exp(levels[n - 1].logs[_at(levels[n - 1].keys, _columns(level.codes[:, 1:]))[0]]) if n else 1 / alphabet
            level.logs = np.log((level.counts - DISCOUNT) / total[inverse] + weight[inverse] * lower)
            level.weights = np.log(weight)
    model.floor = np.array([levels[0].weights[0] - math.log(alphabet) if len(levels[0].weights) else -math.log(alphabet) for levels in per], np.float32)

    below: tuple[np.ndarray, np.ndarray] | None = None  # keys and values of the order before
    for n in range(order):
        keys, first = np.unique(np.concatenate([levels[n].keys for levels in per]), return_index=True)
        codes = np.concatenate([levels[n].codes for levels in per])[first]
        contexts, suffixes = _columns(codes[:, :-1]), _columns(codes[:, 1:])
        values = np.empty((len(keys), len(languages)))
        for k, levels in enumerate(per):
            at, known = _at(levels[n].contexts, contexts)
            backed = np.where(known, levels[n].weights[at], 0.0) if len(levels[n].weights) else np.zeros(len(keys))
            values[:, k] = backed + (below[1][_at(below[0], suffixes)[0], k] if below is not None else -math.log(alphabet))
            at, known = _at(levels[n].keys, keys)
            values[known, k] = levels[n].logs[at[known]]
        model.grams.append(Table.of(keys, values))
        below = keys, values
        if n:
            keys = np.unique(np.concatenate([levels[n].contexts for levels in per]))
            values = np.zeros((len(keys), len(languages)))
            for k, levels in enumerate(per):
                at, known = _at(levels[n].contexts, keys)
                values[known, k] = levels[n].weights[at[known]]
            model.contexts.append(Table.of(keys, values))
    return model


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = defaultdict(Counter)

    def out():
        for lang, found in counts.items():
            keys = list(found)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.string()), pa.array([found[k] for k in keys], pa.int64())], names=["lang", "gram", "n"])
        counts.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), texts(batch.column("text"))):
            codes = letters(text)
            if len(codes):
                s = " " * (ORDER - 1) + codes.tobytes().decode("utf-32-le", "replace") + " "
                counts[lang].update(s[i : i + ORDER] for i in range(len(s) - ORDER + 1))
        if sum(map(len, counts.values())) > 400_000:
            yield from out()
    yield from out()


def _chunks(parts: list[np.ndarray]) -> Iterator[list[int]]:
    """Texts that are scored at a time; one of more than CHUNK characters alone."""
    chunk, size = [], 0
    for i, p in enumerate(parts):
        if not len(p):
            continue
        if chunk and size + len(p) > CHUNK:
            yield chunk
            chunk, size = [], 0
        chunk.append(i)
        size += len(p)
    if chunk:
        yield chunk


def identify_texts(model: Model, found: list[bytes]) -> list[tuple[str, float, float, float, int]]:
    """(language, score, entropy, lead over the second, letters and blanks) of each text, (UNKNOWN, 0, ...) without a letter."""
    parts = [letters(t) for t in found]
    out = [(UNKNOWN, 0.0, 0.0, 0.0, 0)] * len(parts)
    if not model.grams:
        return out
    for chunk in _chunks(parts):
        h = model.entropies([parts[i] for i in chunk]) if len(parts[chunk[0]]) <= CHUNK else model.entropy(parts[chunk[0]])[None, :]
        best = h.argmin(axis=1)
        ordered = np.sort(h, axis=1)
        lead = ordered[:, 1] - ordered[:, 0] if h.shape[1] > 1 else np.full(len(chunk), 1.0)
        for i, b, own, gap in zip(chunk, best.tolist(), ordered[:, 0].tolist(), lead.tolist()):
            x = model.slope * gap * math.sqrt(len(parts[i])) + model.base
            out[i] = (model.languages[b], 1 / (1 + math.exp(-max(-500.0, min(500.0, x)))), own, gap, len(parts[i]))
    return out


def _leads(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = list(texts(batch.column("text")))
            langs = batch.column("lang").to_pylist()
            short = [" ".join(t.decode("utf-8", "replace").split()[-1:])[: 2 + i % 7].encode() for i, t in enumerate(own)]
            found = identify_texts(shared.value, own + short)
            right = [lang == x[0] for lang, x in zip(langs + langs, found)]
            whole = [True] * len(own) + [False] * len(short)
            yield pa.RecordBatch.from_arrays([pa.array(right, pa.bool_()), pa.array(whole, pa.bool_()), *(pa.array([x[k] for x in found], pa.float64()) for k in (2, 3, 4))], names=["right", "whole", "entropy", "lead", "n"])

    return run


def _sample(docs: DataFrame, folds: tuple[int, ...], shares: dict[str, float]) -> DataFrame:
    rows = pick(docs, "doc_id", "text", "lang").where(F.col("lang").isNotNull() & fold(F.col("doc_id"), 4).isin(*folds))
    drawn = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1_000_003)) / 1_000_003
    for lang, share in shares.items():
        if share < 1:
            rows = rows.where((F.col("lang") != lang) | (drawn < share))
    return rows.select("text", "lang")


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Learns from labelled rows with crc32(doc_id) mod 4 of 0 and 1 (models) and 3 (calibration), never from 2.

    Of each language about sample_docs rows and sample_bytes bytes of text are drawn, by the hash of the id. Rows without
    a label teach nothing. Without any label the model knows no language and answers UNKNOWN.
    """
    marks = pick(docs, "doc_id", "text", "lang").where(F.col("lang").isNotNull() & (fold(F.col("doc_id"), 4) != 2))
    sizes = marks.groupBy("lang").agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).collect()  # one row a language
    shares = {r["lang"]: min(1.0, sample_docs / r["n"], sample_bytes / max(1, r["size"])) for r in sizes}
    counts = _sample(docs, (0, 1), shares).mapInArrow(_grams, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counts.toArrow()  # distinct n-grams of the sample, as arrays: below its bytes
    if not len(found):
        return Model(sorted(shares))
    langs = found.column("lang").to_numpy(zero_copy_only=False)
    codes = np.frombuffer("".join(found.column("gram").to_pylist()).encode("utf-32-le"), np.uint32).reshape(-1, ORDER)
    times = found.column("n").to_numpy()
    model = kneser_ney_of({lang: (codes[langs == lang], times[langs == lang]) for lang in sorted(set(langs))})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = _sample(docs, (3,), shares).mapInArrow(_leads(shared), "right boolean, whole boolean, entropy double, lead double, n double").where("n > 0").collect()
    if rows:
        x = np.array([r["lead"] * math.sqrt(r["n"]) for r in rows])
        model.slope, model.base = logistic(x, np.array([r["right"] for r in rows], float))
        right = np.sort([r["entropy"] for r in rows if r["right"] and r["whole"]])
        model.limit = float(right[min(len(right) - 1, int((1 - REJECT) * len(right)))]) if len(right) else math.inf
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score, entropy, rejected.

    lang_pred is a learned language, of equally likely ones the first by code point, or UNKNOWN for texts that are null or
    without a letter (score 0). Very long texts are scored whole, in slices. rejected marks texts with a higher cross-entropy than nearly all calibration texts, whose lang_pred should not be relied upon, and
    those without a letter. Rows that repeat are judged each for itself; only doc_id and text are read. Empty: no rows.
    """
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), (fold(F.col("doc_id"), 4) == 2).alias("held_out"), F.col("text").cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = identify_texts(shared.value, list(texts(batch.column("text"))))
            rejected = [x[0] == UNKNOWN or x[2] > shared.value.limit for x in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], pa.float64()), pa.array(rejected, pa.bool_())], names=["doc_id", "held_out", "lang_pred", "score", "entropy", "rejected"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, entropy double, rejected boolean")
