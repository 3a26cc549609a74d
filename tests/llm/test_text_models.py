import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from fernglass.llm import hmm_lm, langid, toxicity

SYLLABLES = {"en": "the ing ion and er st re".split(), "de": "der sch ung ein ich ge".split(), "es": "que cion os ar la do".split()}


def prose(lang, words, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(words))


def fold(doc_id, parts):
    return zlib.crc32(("null" if doc_id is None else str(doc_id)).encode()) % parts


@pytest.fixture
def tongues():
    rows = [(i, prose(lang, 20 + i % 40, i), lang, "s") for i in range(120) for lang in [list(SYLLABLES)[i % 3]]]
    return rows + [(500, None, "en", "s"), (501, "", "de", "s"), (502, "12 34 !!", "es", "s"), (503, "the", None, None), (None, prose("de", 30, 999), "de", "s"), (504, prose("en", 20_000, 7), "en", "s"), (504, prose("en", 20_000, 7), "en", "s")]


def test_languages(frame, tongues):
    docs = frame(tongues)
    got = langid.identify(docs, langid.fit(docs)).collect()
    assert len(got) == len(tongues)
    at = {r.doc_id: r for r in got}
    for i, text, lang, _ in tongues:
        assert at[i].held_out == (fold(i, 4) == 2) and 0 <= at[i].score <= 1
        if i in (500, 501, 502):
            assert at[i].lang_pred == "und" and at[i].score == 0
        elif lang:
            assert at[i].lang_pred == lang, (i, text[:40])


def test_languages_without_labels(frame):
    docs = frame([(1, "some text", None, "s")])
    assert [r.lang_pred for r in langid.identify(docs, langid.fit(docs)).collect()] == ["und"]
    assert langid.identify(frame([]), langid.fit(frame([]))).count() == 0


def plain_kneser_ney(counts, order, alphabet):
    """P(c | h) from the definition, for one language."""
    levels = [Counter() for _ in range(order + 1)]
    levels[order] = Counter(counts)
    for n in range(order - 1, 0, -1):
        for g in levels[n + 1]:
            levels[n][g[1:]] += 1

    def p(h, c):
        n = len(h) + 1
        total = sum(v for g, v in levels[n].items() if g[:-1] == h)
        lower = p(h[1:], c) if h else 1 / alphabet
        if not total:
            return lower
        types = sum(1 for g in levels[n] if g[:-1] == h)
        return max(levels[n][h + c] - langid.DISCOUNT, 0) / total + langid.DISCOUNT * types / total * lower

    return p


def test_kneser_ney_against_definition():
    texts = {"x": ["abra cadabra", "bab"], "y": ["zebra zaz", "aba"]}
    counts = {}
    for lang, own in texts.items():
        c = Counter()
        for t in own:
            s = " " * (langid.ORDER - 1) + t + " "
            c.update(s[i : i + langid.ORDER] for i in range(len(s) - langid.ORDER + 1))
        counts[lang] = dict(c)
    model = langid.kneser_ney(counts)
    alphabet = len({g[-1] for c in counts.values() for g in c}) + 1
    for text in ("abra", "zaza bab", "q", "cab zeb"):
        got = model.entropies([langid.letters(text.encode())])[0]
        for k, lang in enumerate(model.languages):
            p = plain_kneser_ney(counts[lang], langid.ORDER, alphabet)
            s = " " * (langid.ORDER - 1) + text + " "
            want = -sum(math.log(p(s[i : i + langid.ORDER - 1], s[i + langid.ORDER - 1])) for i in range(len(text) + 1)) / (len(text) + 1)
            assert abs(got[k] - want) < 1e-5, (text, lang)
    total = sum(plain_kneser_ney(counts["x"], langid.ORDER, alphabet)("abra", c) for c in {g[-1] for x in counts.values() for g in x})
    assert total <= 1 + 1e-9


def test_forward_against_enumeration():
    r = np.random.default_rng(0)
    k, m = 3, 5
    h = hmm_lm.Hmm(r.dirichlet(np.ones(k)), r.dirichlet(np.ones(k), k), r.dirichlet(np.ones(m), k).T)
    sequences = [r.integers(0, m, n) for n in (1, 4, 2, 6, 6)]
    got, _, _ = hmm_lm.forward(h, hmm_lm.Packed(sequences))
    for s, ll in zip(sequences, got):
        total = 0.0
        for path in itertools.product(range(k), repeat=len(s)):
            p = h.start[path[0]] * h.emit[s[0], path[0]]
            for a, b, x in zip(path, path[1:], s[1:]):
                p *= h.move[a, b] * h.emit[x, b]
            total += p
        assert abs(math.log(total) - ll) < 1e-9


def test_expected_counts_against_enumeration():
    r = np.random.default_rng(1)
    k, m = 2, 3
    h = hmm_lm.Hmm(r.dirichlet(np.ones(k)), r.dirichlet(np.ones(k), k), r.dirichlet(np.ones(m), k).T)
    sequences = [r.integers(0, m, n) for n in (3, 5, 1)]
    starts, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros((m, k))
    for s in sequences:
        weights = {}
        for path in itertools.product(range(k), repeat=len(s)):
            p = h.start[path[0]] * h.emit[s[0], path[0]]
            for a, b, x in zip(path, path[1:], s[1:]):
                p *= h.move[a, b] * h.emit[x, b]
            weights[path] = p
        total = sum(weights.values())
        for path, p in weights.items():
            starts[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / total
            for x, z in zip(s, path):
                emits[x, z] += p / total
    got = hmm_lm.expected(h, hmm_lm.Packed(sequences), m, np.ones(len(sequences)))
    for a, b in zip(got, (starts, moves, emits)):
        assert np.allclose(a, b)
    assert abs(got[3] - sum(hmm_lm.forward(h, hmm_lm.Packed(sequences))[0])) < 1e-9


def test_blocks_of_a_very_long_text(monkeypatch):
    r = np.random.default_rng(2)
    k, m = 4, 9
    h = hmm_lm.Hmm(r.dirichlet(np.ones(k)), r.dirichlet(np.ones(k), k), r.dirichlet(np.ones(m), k).T)
    for n in (1, 7, 8, 50):
        s = r.integers(0, m, n)
        want = hmm_lm.expected(h, hmm_lm.Packed([s]), m, np.ones(1))
        for block in (1, 4, 7, 1000):
            monkeypatch.setattr(hmm_lm, "BLOCK", block)
            for a, b in zip(hmm_lm.expected_in_blocks(h, s, m), want):
                assert np.allclose(a, b)


def test_training_is_independent_of_lots(frame, tongues, monkeypatch):
    """Whole texts are trained on, however they are gathered: one pass gives the same model."""
    docs = hmm_lm.pick(frame([r for r in tongues if r[0] != 504]), "doc_id", "text")
    v = hmm_lm.vocabulary(hmm_lm.word_counts(docs))
    h = hmm_lm.cluster([hmm_lm.symbols_in(v, prose(lang, 200, 1).encode()).astype(np.int64) for lang in SYLLABLES], hmm_lm.background(v), 3)
    found = []
    for gather, long, huge in ((1_000_000, 1_500, 1_000_000), (50, 30, 40), (10, 5, 12)):
        monkeypatch.setattr(hmm_lm, "GATHER", gather)
        monkeypatch.setattr(hmm_lm, "LONG", long)
        monkeypatch.setattr(hmm_lm, "HUGE", huge)
        monkeypatch.setattr(hmm_lm, "BLOCK", 13)
        own, ll = hmm_lm.baum_welch(docs, v, h)
        found.append((own, ll))
    for own, ll in found[1:]:
        assert abs(ll - found[0][1]) < 1e-4
        assert np.allclose(own.move, found[0][0].move, atol=1e-3) and np.allclose(own.start, found[0][0].start, atol=1e-3)


def test_scores_against_plain_recursion(frame, tongues, monkeypatch):
    """Words, classes, rare words and the recursion put together, by a plain walk over each text."""
    monkeypatch.setattr(hmm_lm, "FREQUENT", 25)
    monkeypatch.setattr(hmm_lm, "TABLE", 40)
    monkeypatch.setattr(hmm_lm, "GATHER", 500)
    monkeypatch.setattr(hmm_lm, "LONG", 30)
    rows = [r for r in tongues if r[0] != 504]
    docs = frame(rows)
    part = hmm_lm.fold(hmm_lm.F.col("doc_id"), 7)
    model = hmm_lm.train(hmm_lm.pick(docs, "doc_id", "text").where(part != 2), states=3)
    assert len(model.likelihoods) == 2 and model.likelihoods[1] > model.likelihoods[0]
    counts = Counter(w for i, t, _, _ in rows if fold(i, 7) != 2 for w in [*(t or "").encode().lower().split(), b""])
    order = sorted(counts, key=lambda w: (-counts[w], w))[: model.vocabulary.frequent]
    symbol = {w: k for k, w in enumerate(order)}
    klass = lambda w: zlib.crc32(w[-hmm_lm.TAIL :]) % hmm_lm.CLASSES
    tokens_of, words_of = Counter(), Counter()
    for w, n in counts.items():
        if w not in symbol:
            tokens_of[klass(w)] += n
            words_of[klass(w)] += 1
    h = model.hmm
    for r in hmm_lm.score(docs, model, part == 2).collect():
        text = next(t for i, t, _, _ in rows if i == r.doc_id)
        alpha, log = None, 0.0
        for w in [*(text or "").encode().lower().split(), b""]:
            e = h.emit[symbol[w]] if w in symbol else h.emit[len(symbol) + klass(w)] * (counts[w] + 1) / (tokens_of[klass(w)] + words_of[klass(w)] + 1)
            alpha = h.start * e if alpha is None else (alpha @ h.move) * e
            log += math.log10(alpha.sum())
            alpha = alpha / alpha.sum()
        assert abs(r.score - log) < 1e-6 * max(1, abs(log)), r.doc_id


def test_language_model(frame, tongues, monkeypatch):
    monkeypatch.setattr(hmm_lm, "FREQUENT", 40)  # so that words have classes, and some are outside the table
    monkeypatch.setattr(hmm_lm, "TABLE", 60)
    rows = [r for r in tongues if r[0] != 504] + [(504, prose("en", 3000, 7), "en", "s")] * 2
    part = hmm_lm.fold(hmm_lm.F.col("doc_id"), 7)
    docs = frame(rows)
    plain = hmm_lm.pick(docs, "doc_id", "text")
    model = hmm_lm.train(plain.where(part != 2), states=3)
    assert model.vocabulary.frequent <= 40 and len(model.vocabulary.index) <= 60
    got = hmm_lm.score(docs, model, part == 2).collect()
    assert len(got) == len(rows)
    split = {i: [*(t or "").encode().lower().split(), b""] for i, t, _, _ in rows}
    counts = Counter(w for i, t, _, _ in rows if fold(i, 7) != 2 for w in split[i])
    n, v = sum(counts.values()), len(counts)
    for r in got:
        words = split[r.doc_id]
        assert r.n_tokens == len(words) and r.n_known == sum(counts[w] > 0 for w in words) and r.train_tokens == n
        want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        assert abs(r.base_score - want) < 1e-6 * max(1, abs(want))
        assert r.held_out == (fold(r.doc_id, 7) == 2) and r.score < 0
    held = [r for r in got if r.n_tokens > 10]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_words_share_their_class():
    """All known words of a class and one unknown share at most its probability."""
    v = hmm_lm.Vocabulary(hmm_lm.Rows({b"a": 0}), np.array([0]), np.array([3.0]), np.zeros(hmm_lm.CLASSES), np.zeros(hmm_lm.CLASSES), 10, 4, 1)
    k = -1 - v.index[b"zzz"]
    v.class_tokens[k], v.class_words[k] = 7, 3
    known = [4, 2, 1]
    assert sum((c + 1) / (7 + 3 + 1) for c in known) + 1 / 11 <= 1 + 1e-12
    assert v.symbols_of(v.rows([b"a", b"zzz"])).tolist() == [0, 1 + k]


def test_language_model_without_texts(frame):
    assert hmm_lm.train_and_score(frame([])).count() == 0
    got = hmm_lm.train_and_score(frame([(1, None, None, None)])).collect()
    assert got[0].n_tokens == 1 and got[0].score <= 0


def all_segments(scores):
    """Maximal segments by definition: the best one, and again on both sides of it."""
    best = None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = sum(scores[i:j])
            if s > 1e-12 and (best is None or s > best[2] + 1e-12 or abs(s - best[2]) <= 1e-12 and j - i < best[1] - best[0]):
                best = (i, j, s)
    if best is None:
        return []
    i, j, s = best
    return all_segments(scores[:i]) + [best] + [(a + j, b + j, t) for a, b, t in all_segments(scores[j:])]


def test_segments_against_definition():
    r = random.Random(4)
    for _ in range(200):
        scores = [round(r.uniform(-1, 1), 3) for _ in range(r.randint(0, 14))]
        got = toxicity.segments(np.array(scores))
        want = all_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want], scores


def labelled_corpus():
    r = random.Random(8)
    clean = [f"c{k}" for k in range(200)]
    rows, marks = [], []
    for i in range(600):
        words = [r.choice(clean) for _ in range(r.randint(5, 150))]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(["foulword", "nastyness", "vileing"]) + r.choice(["", "s", "x", "est", ","]))
        rows.append((i, " ".join(words), "en", "s"))
        if i % 2 == 0 or bad:
            marks.append((i, 1, int(bad)))
    rows += [(2000, None, "en", "s"), (2001, "", "en", "s"), (2002, " ".join(r.choice(clean) for _ in range(20_000)) + " foulword nastyness vileings", "en", "s"), (2002, "c1 c2", "en", "s"), (None, "c3", None, None)]
    return rows, marks + [(None, 1, 1), (3, None, None), (0, 1, 0), (0, 1, 1)]


def test_toxicity(spark, frame):
    rows, marks = labelled_corpus()
    docs = frame(rows)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (fold(r.doc_id, 4) == 2)
        if r.doc_id is not None and r.doc_id < 2000:
            assert r.predicted == int(r.doc_id % 5 == 0), r.doc_id
    assert {r.predicted for r in got if r.doc_id in (2000, 2001, None)} == {0}
    assert any(r.predicted and r.segments for r in got if r.doc_id == 2002)
    kept = toxicity.reject(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(not r.predicted for r in got)


def test_toxicity_without_labels(spark, frame):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame([(1, "a b", "en", "s"), (2, None, "en", "s")])
    got = toxicity.score(docs, toxicity.fit(docs, none)).collect()
    assert len({r.score for r in got}) == 1 and all(r.predicted == 0 for r in got)
    one = spark.createDataFrame([(i, 1, 1) for i in range(50)], "doc_id long, quality int, toxic int")
    docs = frame([(i, "a b", "en", "s") for i in range(50)])
    assert {r.predicted for r in toxicity.score(docs, toxicity.fit(docs, one)).collect()} == {1}
    assert toxicity.score(frame([]), toxicity.Model()).count() == 0


def test_counts_are_independent_of_dealing(frame, tongues):
    rows = [r for r in tongues if r[0] not in (504,)]
    got = []
    for parts in (1, 5):
        docs = hmm_lm.pick(frame(rows, parts=parts), "doc_id", "text")
        got.append({bytes(r["word"]): r["n"] for r in hmm_lm.word_counts(docs).collect()})
    assert got[0] == got[1]
    assert defaultdict(int, got[0])[b""] == len(rows)


def test_languages_of_few_texts_and_with_marks(frame):
    """A language with a hundredth of the rows keeps its n-grams; combining marks are part of words."""
    rows = [(i, prose("en", 60, i), "en", "s") for i in range(400)] + [(10_000 + i, prose("de", 25, i), "de", "s") for i in range(12)]
    hindi = ["नदी शहर के ऊपर की पहाड़ियों से निकलती है", "वसंत में पानी ऊँचा होता है", "किसान अब भी खेती करते हैं", "पुराना पुल किसने बनाया था"]
    rows += [(20_000 + i, hindi[i % 4], "hi", "s") for i in range(12)]
    docs = frame(rows)
    model = langid.fit(docs)
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang, _ in rows)
    assert langid.letters("की".encode()).tolist() == [0x915, 0x940] and langid.letters("\u0940 1".encode()).tolist() == []


def test_rejected_texts(frame):
    rows = [(i, prose("en", 60, i), "en", "s") for i in range(300)] + [(1000 + i, "Ωραία μέρα σήμερα " * 3, None, "s") for i in range(5)] + [(2000, "qzx vvkq jjxq zzqw xkcd qqqq", None, "s"), (2001, "", None, "s")]
    docs = frame(rows)
    model = langid.fit(docs)
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert all(got[i].rejected for i in (1000, 1001, 2000, 2001))
    assert sum(got[i].rejected for i in range(300)) <= 3
    plain = {i: langid.identify_texts(model, [(t or "").encode()])[0] for i, t, _, _ in rows}
    for i, (lang, score, entropy, _, _) in plain.items():
        assert got[i].lang_pred == lang and abs(got[i].score - score) < 1e-9 and got[i].rejected == (lang == "und" or entropy > model.limit)


def test_languages_by_plain_models(frame):
    """Predictions are those of the lowest cross-entropy by the definition, on models of all labelled texts outside fold 2 and 3."""
    rows = [(i, prose(list(SYLLABLES)[i % 3], 6, i), list(SYLLABLES)[i % 3], "s") for i in range(60)]
    docs = frame(rows)
    model = langid.fit(docs)
    counts = {lang: Counter() for lang in SYLLABLES}
    for i, t, lang, _ in rows:
        if fold(i, 4) in (0, 1):
            s = " " * (langid.ORDER - 1) + t + " "
            counts[lang].update(s[k : k + langid.ORDER] for k in range(len(s) - langid.ORDER + 1))
    alphabet = len({g[-1] for c in counts.values() for g in c}) + 1
    models = {lang: plain_kneser_ney(c, langid.ORDER, alphabet) for lang, c in counts.items()}
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    for i, t, _, _ in rows[:6]:
        s = " " * (langid.ORDER - 1) + t + " "
        h = {lang: -sum(math.log(p(s[k : k + langid.ORDER - 1], s[k + langid.ORDER - 1])) for k in range(len(t) + 1)) / (len(t) + 1) for lang, p in models.items()}
        best = min(sorted(h), key=h.get)
        assert got[i].lang_pred == best and abs(got[i].entropy - h[best]) < 1e-5


def test_long_texts_are_scored_in_slices(monkeypatch):
    rows = {lang: {} for lang in SYLLABLES}
    for lang in SYLLABLES:
        s = " " * (langid.ORDER - 1) + prose(lang, 300, 1) + " "
        rows[lang] = dict(Counter(s[k : k + langid.ORDER] for k in range(len(s) - langid.ORDER + 1)))
    model = langid.kneser_ney(rows)
    texts = [(prose("de", 400, 2) + " Ñandú ☃☃ " + prose("es", 90, 3)).encode(), b"a", prose("en", 50, 4).encode()]
    want = langid.identify_texts(model, texts)
    for chunk, folded in ((100, 37), (7, 3)):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        monkeypatch.setattr(langid, "FOLDED", folded)
        for a, b in zip(langid.identify_texts(model, texts), want):
            assert a[0] == b[0] and a[4] == b[4] and abs(a[2] - b[2]) < 1e-5


def plain_scores(rows, folds):
    """Log-odds of words by the definition, every prefix the prior of the next, nothing left out."""
    counts = defaultdict(lambda: [0, 0])
    totals = [0, 0]
    for text, label in rows:
        for word in filter(None, (toxicity._TRIM.sub("", w) for w in set(text.lower().split()))):  # forms with other marks count each
            counts["w" + word][label] += 1
            totals[label] += 1
            for k in toxicity.PREFIXES:
                if k < len(word):
                    counts["p" + word[:k]][label] += 1
    rate = totals[1] / totals[0]

    def smoothed(key, stem):
        n0, n1 = counts[key]
        q = min(1 - toxicity.LEAST, max(toxicity.LEAST, 1 / (1 + math.exp(-stem))))
        off = math.log((n1 + toxicity.PRIOR * q) / (n0 * rate + toxicity.PRIOR * (1 - q))) - stem
        return stem + math.copysign(max(0.0, abs(off) - toxicity.ERRORS * math.sqrt(1 / (n1 + 1) + 1 / (n0 * rate + 1))), off)

    def score(word):
        stem = 0.0
        for k in toxicity.PREFIXES:
            if k < len(word) and "p" + word[:k] in counts:
                stem = smoothed("p" + word[:k], stem)
        return smoothed("w" + word, stem) if "w" + word in counts else stem

    return score


def test_log_odds_against_definition(spark, frame):
    rows, marks = labelled_corpus()
    marks = [m for m in marks if m[0] is not None and m[2] is not None]
    docs, labels = frame(rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    toxic = {}
    for i, _, y in marks:
        toxic[i] = max(toxic.get(i, 0), int(y > 0))
    learnt = [(t or "", toxic[i]) for i, t, _, _ in rows if i in toxic and fold(i, 4) in (0, 1)]
    score = plain_scores(learnt, (0, 1))
    words = {toxicity._TRIM.sub("", w.lower()) for t, _ in learnt for w in t.split()} | {"foulwordly", "vile", "nast", "c1", "unseen", "foulwordxx"}
    for w in words - {""}:
        assert abs(model.score(w) - score(w)) < 1e-9, w
    assert len(model.words) + len(model.prefixes) < len(words)  # those that do not depart are not sent
    clean = []
    for text, label in [(t or "", toxic[i]) for i, t, _, _ in rows if i in toxic and fold(i, 4) == 3]:
        n, found = next(toxicity._best([text.encode()], model))
        if not label:
            clean.append((n, max((s for _, _, s in found), default=0.0)))
    assert np.allclose(toxicity.extreme_law(clean), (model.lam, model.k))


def test_extreme_law_recovers_its_parameters():
    r = np.random.default_rng(3)
    for lam, k in ((0.7, 0.004), (1.0, 0.02), (2.0, 0.001)):
        n = r.integers(50, 400, 20_000)
        best = -(np.log(-np.log(r.random(len(n)))) - np.log(k * n)) / lam
        got = toxicity.extreme_law(list(zip(n.tolist(), np.maximum(0, best).tolist())))
        assert abs(got[0] / lam - 1) < 0.1 and abs(got[1] / k - 1) < 0.1
    grid = [(60, 0.0), (80, 1.2), (300, 0.4), (90, 2.5)]
    lam, kk = toxicity.extreme_law(grid)

    def likely(x):
        z = sum(n * math.exp(-x * s) for n, s in grid)
        return (3 + toxicity.PULL) * math.log(x) - x * (4.1 + toxicity.PULL) - 3 * math.log(z)

    assert all(likely(lam) >= likely(x / 100) - 1e-9 for x in range(5, 2000))
    assert toxicity.extreme_law([]) == (1.0, 1.0) and toxicity.extreme_law([(10, 0.0)] * 5)[1] > 0


def test_words_in_slices(monkeypatch):
    from fernglass.llm import shared

    monkeypatch.setattr(shared, "WORDS_OF", 11)
    for text in (b"", b"  a b\tccccccccccccccccccccc d\n\n", b"x" * 50, b"one two three four five six seven"):
        assert [w for part in shared.words_of(text) for w in part] == text.split()


def test_first_states_count_every_training_text(spark, frame, monkeypatch):
    """Training starts from the symbols of all training texts, none left out, however many there are."""
    seen = []
    monkeypatch.setattr(hmm_lm, "cluster_counts", lambda counts, *a, f=hmm_lm.cluster_counts: seen.append(counts) or f(counts, *a))
    rows = [(i, f"w{i % 50} w{i % 7} only{i}" if i % 9 else None, None, None) for i in range(5_000)]
    model = hmm_lm.train(hmm_lm.pick(frame(rows, parts=3), "doc_id", "text"), states=3, passes=1)
    v = model.vocabulary
    want = np.bincount(np.concatenate([hmm_lm.symbols_in(v, (text or "").encode()) for _, text, _, _ in rows]), minlength=v.size)
    assert seen[0].shape == (hmm_lm.CELLS, v.size) and want.sum() == v.n
    assert (seen[0].sum(axis=0) == want).all()
