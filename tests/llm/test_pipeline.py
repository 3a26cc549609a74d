"""The pipeline against a plain version of its stages on a small corpus."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from fernglass.llm import toxicity

WHITE, WORD = re.compile(r"[\x20\x09-\x0D]"), re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(12)
    words = [f"v{k}" for k in range(300)]
    base = [" ".join(r.choice(words) for _ in range(r.randint(40, 150))) for _ in range(40)]
    rows, marks = [], []
    for i in range(240):
        text = base[i % 40]
        if i >= 40 and i % 4 == 0:
            parts = text.split()
            parts[r.randrange(len(parts))] = "edited"
            text = " ".join(parts)
        elif i >= 40 and i % 4 == 1:
            text = text.replace(" ", "  ", 3)
        elif i >= 40:
            text = " ".join(r.choice(words) for _ in range(r.randint(1, 200)))
        bad = i % 6 == 5
        if bad:
            text += " foulword nastything " + text[:30]
        rows.append((i, text, "en", ("a", "a", "b", "c", None)[i % 5], len(text)))
        marks.append((i, 1, int(bad)))
    rows += [(900, None, None, None, None), (901, "", "en", "a", 0), (902, "", "en", "b", 0), (903, " ".join(r.choice(words) for _ in range(6000)), "en", "long", None)]
    at = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at), rows


def shingle_set(text):
    words = text.encode().lower().split()
    return frozenset([tuple(words)] if 0 < len(words) < 5 else [tuple(words[i : i + 5]) for i in range(len(words) - 4)])


def plain(rows, toxic):
    rows = [r for r in rows if r[0] not in toxic]
    best = {}
    for r in rows:
        key = WHITE.sub("", r[1] or "")
        rank = (-len(r[1] or ""), r[0])
        if key not in best or rank < best[key][0]:
            best[key] = (rank, r)
    rows = sorted((r for _, r in best.values()), key=lambda r: r[0])
    sets = [shingle_set(r[1] or "") for r in rows]
    root = list(range(len(rows)))
    changed = True
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    rows = [r for i, r in enumerate(rows) if root[i] == i]
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    per = Counter()
    for r in rows:
        per[r[3]] += size[r[0]]
    names = sorted(s for s in per if s is not None) + ([None] if None in per else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(per.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * per[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = 2.0 * per[s]
            left -= target[s]
        open_ -= full
    out = []
    for s in names:
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (hashlib.md5(str(r[0]).encode()).hexdigest(), r[0]))
        whole = math.floor(target[s] + 0.5)
        uses = min(2, whole // per[s]) if per[s] else 0
        rest = whole - uses * per[s]
        for r in own:
            out += [(r[0], r[1])] * (uses if size[r[0]] else 0)
            part = max(0, min(size[r[0]], rest))
            rest -= part
            if part:
                out.append((r[0], r[1][: [m.end() for m in WORD.finditer(r[1])][part - 1]]))
    return out


def test_pipeline(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{path}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    assert toxic == {i for i in range(240) if i % 6 == 5}
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, text in plain(rows, toxic):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            own = np.array(ids[at : at + 2048], "<u4")
            want[i, k, at, len(own), zlib.crc32(own.tobytes())] += 1
    got = corpus_pipeline.run(spark, path).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    filled = Counter()
    for r in got:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048 and len(filled) <= -(-sum(filled.values()) // 2048) + 1


def test_stages_return_documents(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)


def test_empty_corpus(spark, folder, tmp_path):
    path, _ = folder
    for name in ("documents", "labels"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_from_four_fifths(spark):
    """100 distinct shingles on each side: 88 shared are 0.786, 89 to 91 are 0.802 to 0.835."""
    rows = []
    for shared in (88, 89, 90, 91):
        words = [f"{shared}a{k}" for k in range(104)]
        other = words[: shared + 4] + [f"{shared}b{k}" for k in range(100 - shared)]
        rows += [(2 * shared, " ".join(words)), (2 * shared + 1, " ".join(other))]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == [176, 177, 178, 180, 182]


def test_sequences_are_trained_in_the_order_of_the_mix(spark, folder, tmp_path):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    mix = corpus_pipeline.mix_sources(spark, docs, path)
    mix.write.parquet(f"{tmp_path}/mix")
    stored = spark.read.parquet(f"{tmp_path}/mix")
    import pyarrow.parquet as pq
    from pathlib import Path

    order = [i for f in sorted(Path(f"{tmp_path}/mix").glob("part-*")) for i in pq.read_table(f).column("doc_id").to_pylist()]
    place = {}
    for k, i in enumerate(order):
        place.setdefault(i, k)
    got = corpus_pipeline.pack(spark, stored, path).collect()
    rank = {}
    for r in got:
        assert rank.setdefault(r.sequence_id, r.train_rank) == r.train_rank
    assert sorted(rank.values()) == list(range(1, len(rank) + 1))
    first = {}
    for r in got:
        first[r.sequence_id] = min(first.get(r.sequence_id, 10**9), place[r.doc_id])
    by_rank = [first[s] for s in sorted(rank, key=rank.get)]
    assert by_rank[0] == 0 and len(got) >= len(order)
    unordered = corpus_pipeline.pack(spark, spark.createDataFrame([(1, "a b", "en", "s", 3)], docs.schema), path).collect()
    assert [r.train_rank for r in unordered] == [1]
