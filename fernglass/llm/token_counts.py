"""Token counts by a count-only Viterbi search over a unigram vocabulary.

A text is cut before each run of blanks, which the word after it keeps as U+2581s; where no piece of the vocabulary
crosses a cut, the best segmentation of a text is that of its words, else the whole text is searched. An Aho-Corasick
automaton lists the pieces that end at each character of a word, and a dynamic programme carries the best score and its
number of pieces, never the pieces. Ties go as in the tokenizer: a later candidate must be better, and candidates come
in the order of their starts. A character that is no piece itself is unknown, at the lowest score less 10; where the
vocabulary has pieces for all bytes it counts as its bytes, else a run of unknown characters is one token. Control,
unknown and byte pieces never match text.

The file at hand lists merges by rank and has no unigram probabilities, and tokenizers are not to be trained here: a
piece of rank r has the probability that Zipf's law as Mandelbrot wrote it gives, in proportion to 1 / (r + ZIPF).
Long texts are searched in slices, with the best scores of the last characters carried from each to the next.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernglass.llm.shared import pick, texts

BLANK = "▁"
#: What an unknown character scores below the lowest piece.
PENALTY = 10.0
#: Words whose counts a Python worker keeps, and their characters at most.
KEPT_WORDS, KEPT_CHARS = 500_000, 64
#: The shift of ranks. At 100 counts are nearest to those of the merges themselves (the README has the figures).
ZIPF = 100.0
#: Bytes of a text, or characters of a word, that are searched at a time.
SLICE = 1_000_000
_BLANK_BYTES = BLANK.encode()
_FIRST_BLANK = re.compile(rb"(?<! ) ")


def pieces(path: str) -> list[tuple[str, float]]:
    """(piece, log probability but for a constant) of the pieces of a SentencePiece file that match text, in the order of ids."""
    model = _model(path)
    return [(model.id_to_piece(i), -math.log(ZIPF - model.get_score(i))) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


def has_bytes(path: str) -> bool:
    """Whether a SentencePiece file has pieces for all bytes."""
    model = _model(path)
    return sum(map(model.is_byte, range(model.get_piece_size()))) == 256


def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Counter(dict):
    """(score, tokens) of a word given as bytes without the first of its leading blanks, looked up or searched."""

    _made: dict[str, Counter] = {}

    def __init__(self, vocabulary: list[tuple[str, float]], in_bytes: bool = False):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.longest = max((len(p) for p, _ in vocabulary), default=1)
        self.unknown = min((s for _, s in vocabulary), default=0.0) - PENALTY
        names = {p for p, _ in vocabulary}
        self.in_bytes = in_bytes
        #: Neither a piece nor a run of unknown characters goes on from a character to a blank.
        self.in_words = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in names) and (BLANK in names or self.in_bytes)

    @classmethod
    def of(cls, path: str) -> Counter:
        if path not in cls._made:
            cls._made[path] = cls(pieces(path), has_bytes(path))
        return cls._made[path]

    def search(self, word: str) -> tuple[float, int]:
        """Score and tokens of a word as the automaton sees it, its blanks included."""
        held = ([0.0], [0], bytearray(1))
        for lo in range(0, max(1, len(word)), SLICE):
            before = min(lo, self.longest)
            held = self._searched(word[lo - before : lo + SLICE], before, *(h[-before - 1 :] for h in held))
        return held[0][-1], held[1][-1]

    def _searched(self, word: str, before: int, best: list[float], count: list[int], tail: bytearray) -> tuple[list[float], list[int], bytearray]:
        """Of each place in word: the best score up to it, the tokens of that path (-1: not reached), and whether it ends
        in an unknown character. Those of the first `before` characters are given."""
        n = len(word)
        best = best + [0.0] * (n - before)
        count = count + [-1] * (n - before)
        tail = tail + bytearray(n - before)
        single = bytearray(n)  # characters that are pieces
        at = before  # characters whose candidates are complete
        unknown, in_bytes = self.unknown, self.in_bytes

        def close(end: int) -> None:
            """The unknown candidate of each character up to end, after all pieces that end there."""
            nonlocal at
            while at < end:
                if not single[at]:
                    score = best[at] + unknown
                    if count[at + 1] < 0 or score > best[at + 1]:
                        best[at + 1] = score
                        count[at + 1] = count[at] + (len(word[at].encode()) if in_bytes else 1 - tail[at])
                        tail[at + 1] = 1
                at += 1

        for end, (length, score) in self.automaton.iter(word):
            if end < before:
                continue
            if at < end:
                close(end)
            start = end + 1 - length
            if length == 1:
                single[end] = 1
            score += best[start]
            if count[end + 1] < 0 or score > best[end + 1]:
                best[end + 1] = score
                count[end + 1] = count[start] + 1
                tail[end + 1] = 0
        close(n)
        return best, count, tail

    def __missing__(self, word: bytes) -> tuple[float, int]:
        found = self.search(BLANK + word.decode("utf-8", "replace").replace(" ", BLANK))
        if len(self) < KEPT_WORDS and len(word) <= KEPT_CHARS:
            self[word] = found
        return found

    def count(self, text: bytes) -> tuple[float, int]:
        """Score and tokens of a text; an empty one has none."""
        if not text:
            return 0.0, 0
        text = text.replace(_BLANK_BYTES, b" ")
        if not self.in_words:
            return self.search(BLANK + text.removeprefix(b" ").decode("utf-8", "replace").replace(" ", BLANK))
        score, tokens, at = 0.0, 0, 0
        while at < len(text):
            cut = _FIRST_BLANK.search(text, at + SLICE) if len(text) - at > SLICE else None
            part = text[at : cut.start()] if cut else text[at:]
            words = _FIRST_BLANK.split(part) if b"  " in part else part.split(b" ")
            if not words[0]:
                del words[0]  # a text that starts with a blank gets no other
            for s, n in map(self.__getitem__, words):
                score += s
                tokens += n
            at += len(part)
        return score, tokens


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.of(path)
        for batch in batches:
            found = [counter.count(t) for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([n for _, n in found], pa.int64()), pa.array([s for s, _ in found], pa.float64())], names=["doc_id", "n_tokens", "score"])

    return run


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, score (of the best segmentation).

    A null or empty text has no tokens. Of segmentations with the same score the one counts that the tokenizer finds, see
    above. Very long texts, and very long words, are counted whole, in slices. Rows that repeat are counted each for
    itself. Other columns are ignored. Empty table: no rows. path: a SentencePiece file that all executors have, whose pieces and scores are the vocabulary.
    """
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_counted(path), "doc_id long, n_tokens long, score double")
