import hashlib
import random
import re

import numpy as np
import pytest

from fernglass.llm import embed_dedup, exact_dedup, graph, minhash

WHITE = re.compile(r"[\x20\x09-\x0D]")


def smaller(a, b):
    return b if a is None else a if b is None else min(a, b)


def classes(links, n):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def test_exact_against_plain(frame, corpus):
    rows = corpus + [(5000 + i, "same same" + " " * (i % 3), "en", "a") for i in range(300)]
    got = exact_dedup.exact_dedup(frame(rows)).collect()
    norm = [WHITE.sub("", t or "") for _, t, _, _ in rows]
    groups = {}
    for (i, t, _, _), n in zip(rows, norm):
        groups.setdefault(n, []).append((-len(t or ""), i is None, i or 0))
    want = sorted((str(i), str(None if min(groups[n])[1] else min(groups[n])[2]), len(groups[n]), hashlib.sha256(n.encode()).hexdigest()) for (i, _, _, _), n in zip(rows, norm))
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)


def test_exact_group_over_many_partitions(spark, frame):
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, "copy" if i % 10 else f"text {i}", "en", "a") for i in range(2000)]
        got = exact_dedup.exact_dedup(frame(rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])
    hot = [r for r in got if r.doc_id % 10]
    assert {(r.keep_id, r.group_size) for r in hot} == {(1, 1800)} and sum(r.kept for r in hot) == 1
    assert len(got) == 2000


def test_exact_keeps_columns(frame, corpus):
    docs = frame(corpus)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({WHITE.sub("", t or "") for _, t, _, _ in corpus})


@pytest.mark.parametrize("op", [exact_dedup.exact_dedup, minhash.near_dedup, exact_dedup.drop_copies, minhash.drop_near_copies])
def test_empty_tables(frame, op):
    assert op(frame([])).count() == 0


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < 5 else [tuple(words[i : i + 5]) for i in range(len(words) - 4)])


def plain_near(rows):
    sets = [shingle_set(t) for _, t, _, _ in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    group = classes(links, len(rows))
    least = {}
    for g, (i, _, _, _) in zip(group, rows):
        least[g] = smaller(least.get(g), i)
    return sorted((str(i), len(s), str(least[g])) for (i, _, _, _), s, g in zip(rows, sets, group)), len(set(group))


def test_minhash_against_plain(frame, corpus):
    want, groups = plain_near(corpus)
    got = minhash.near_dedup(frame(corpus)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == want
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got)
    assert minhash.drop_near_copies(frame(corpus)).count() <= groups


def test_minhash_group_without_a_centre(frame, monkeypatch):
    """Many copies with several edits each, of which few link: all of it must come from the later steps."""
    monkeypatch.setattr(minhash, "CHUNK", 16)
    r = random.Random(3)
    base = [f"b{k}" for k in range(140)]
    rows = []
    for i in range(90):
        own = list(base)
        for _ in range(r.randint(0, 5)):
            own[r.randrange(len(own))] = f"x{i}{r.randrange(99)}"
        rows.append((i, " ".join(own), "en", "a"))
    want, _ = plain_near(rows)
    got = minhash.near_dedup(frame(rows)).collect()
    assert sorted((str(x.doc_id), x.n_shingles, str(x.component_id)) for x in got) == want


def test_signatures_estimate_similarity():
    hashes = minhash._Hashes()
    a = minhash.shingles(" ".join(f"a{i}" for i in range(500)).encode(), hashes)
    b = minhash.shingles(" ".join(f"a{i}" for i in range(60, 560)).encode(), hashes)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((minhash.signature(a) == minhash.signature(b)).mean() - true) < 0.1


def test_components_against_union_find(spark):
    r = random.Random(1)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    nodes = sorted({x for ab in links if ab[0] != ab[1] for x in ab})
    at = {x: i for i, x in enumerate(nodes)}
    group = classes([(at[a], at[b]) for a, b in links if a != b], len(nodes))
    least = {g: min(x for x, h in zip(nodes, group) if h == g) for g in set(group)}
    got = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted((x.node, x.component) for x in got) == sorted((x, least[g]) for x, g in zip(nodes, group))
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors():
    r = np.random.default_rng(2)
    rows = []
    for _ in range(6):
        c = r.normal(size=16)
        rows += [(c + r.normal(size=16) * s).tolist() for s in (0, 0, 0.05, 0.1, 0.3)]
    hot = r.normal(size=16)
    rows += [(hot + r.normal(size=16) * 0.12).tolist() for _ in range(150)]
    rows += [rows[0], [2 * x for x in rows[0]], None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [1e200] * 16]
    return [(i if i != 40 else None, v, 0, "x") for i, v in enumerate(rows)]


@pytest.mark.parametrize("dense,chunk", [(64, 6000), (4, 40)])
def test_embeddings_against_plain(spark, monkeypatch, dense, chunk):
    monkeypatch.setattr(embed_dedup, "DENSE", dense)
    monkeypatch.setattr(embed_dedup, "CHUNK", chunk)
    rows = vectors()
    units = []
    for _, v, _, _ in rows:
        ok = v and None not in v and np.isfinite(v).all() and np.any(v)
        x = np.array(v) / np.abs(v).max() if ok else None
        units.append(x / np.linalg.norm(x) if ok else None)
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.95]
    group = classes(pairs, len(rows))
    least, n = {}, [0] * len(rows)
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    for g, (i, _, _, _) in zip(group, rows):
        least[g] = smaller(least.get(g), i)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string").repartition(3)
    got = embed_dedup.near_dedup(df).collect()
    assert sorted((str(x.vec_id), x.n_links, str(x.component_id)) for x in got) == sorted((str(i), k, str(least[g])) for (i, _, _, _), k, g in zip(rows, n, group))


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embed_dedup.near_dedup(df).count() == 0
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [(r.n_links, r.component_id, r.kept) for r in embed_dedup.near_dedup(df).collect()] == [(0, 1, True)]


def test_tiles_decide_like_single_pairs():
    """A tile's links are those of its pairs taken one by one, on distances that lie on the limits."""
    r = np.random.default_rng(4)
    x = r.normal(size=(60, 8))
    x[30:] = x[:30] + r.choice([0, 1e-17, 1e-3, 0.02], size=(30, 1)) * r.normal(size=(30, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    space = embed_dedup.Space(8, x, 0.95)
    rotated = space.rotate(x)
    d = ((rotated[:, None, space.blocks[1]] - rotated[None, :, space.blocks[1]]) ** 2).sum(axis=2)
    space.shares[1] = float(d[3, 33])  # a pair lies on the limit to the last bit
    space.least = float(embed_dedup.products(x[5:6], x[35:36])[0])
    for block in range(len(space.blocks)):
        got = space.links(np.ones((60, 60), bool), x, x, rotated, rotated, block)
        for i in range(60):
            for j in range(60):
                one = embed_dedup.products(x[i : i + 1], x[j : j + 1])[0] >= space.least and space.admits(rotated[i : i + 1], rotated[j : j + 1], block)[0]
                assert got[i, j] == one, (block, i, j)


def test_every_pair_is_dealt_once():
    """Over all cells and chunks, each pair of vectors within a block's radius meets in exactly one task."""
    r = np.random.default_rng(8)
    x = r.normal(size=(300, 6)) * [0.5, 0.3, 0.3, 0.1, 0.1, 0.1]
    x /= np.linalg.norm(x, axis=1)[:, None]
    space = embed_dedup.Space(6, x, 0.9)
    rotated = space.rotate(x)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(300)), embed_dedup._packed(rotated)], names=["node", "rotated"])
    placed = pa.Table.from_batches(list(embed_dedup._placed(space)(iter([batch])))).to_pydict()
    counts = {}
    for b, c, m in zip(placed["block"], placed["cell"], placed["bits"]):
        n, shared = counts.get((b, c), (0, 7))
        counts[b, c] = (n + 1, shared & m)
    old = embed_dedup.CHUNK
    embed_dedup.CHUNK = 20
    try:
        deal = embed_dedup.Deal(counts)
        rows, task, side = deal.tasks_of(*(np.array(placed[k]) for k in ("block", "cell", "node")))
    finally:
        embed_dedup.CHUNK = old
    members = {}
    for k, t, s in zip(rows.tolist(), task.tolist(), side.tolist()):
        members.setdefault(t, ([], []))[s].append((placed["node"][k], placed["bits"][k]))
    met = {}
    for t, (a, b) in members.items():
        pairs = [(p, q) for i, p in enumerate(a) for q in a[i + 1 :]] if not b else [(p, q) for p in a for q in b]
        for (i, bi), (j, bj) in pairs:
            if not bi & bj:
                key = (deal.block(t), min(i, j), max(i, j))
                met[key] = met.get(key, 0) + 1
    assert set(met.values()) == {1}
    for block, part in enumerate(space.blocks):
        for i in range(300):
            near = np.flatnonzero(embed_dedup.squares(rotated[i : i + 1, part].repeat(300, 0), rotated[:, part]) <= space.shares[block])
            assert all((block, i, j) in met for j in near.tolist() if j > i)


@pytest.mark.parametrize("alone", [0, 200, 10_000])
def test_components_in_one_task_and_by_steps(spark, monkeypatch, alone):
    """A small graph is joined at once, without a table for each step; a larger one by stars, with the same result."""
    made = []
    monkeypatch.setattr(graph, "EDGES_OF_A_TASK", alone)
    monkeypatch.setattr(graph, "stash", lambda df, name, f=graph.stash: made.append(name) or f(df, name))
    links = [(i, i + 1) for i in range(0, 99)] + [(i + 7, i) for i in range(200, 300, 7)] * 3 + [(500, 400), (400, 500), (450, 450)]
    got = {x.node: x.component for x in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(100)} | {i: 200 for i in range(200, 306, 7)} | {400: 400, 500: 400}
    assert got == want
    assert made == ["edges", "components"] if alone >= len(links) else made.count("edges") > 3
