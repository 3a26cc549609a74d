"""What the semantics require, on invented rows with known answers."""

import datetime as dt
import io
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from fernglass.functions import hashes, text, values
from fernglass.operators import aggregates as A
from fernglass.operators import clusters as C
from fernglass.operators import entities as E
from fernglass.operators import joins, plans, quality
from fernglass.operators import search as S
from fernglass.sources import archives, files, sinks
from fernglass.sources.paged import PagedSource
from fernglass.streaming import state


def at(hours, minutes=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours, minutes=minutes)


def test_claims_and_answers(spark):
    claims = spark.createDataFrame([("k1", "place", "Alder", "model", 0.9), ("k1", "place", "Birch", "gazetteer", 0.1), ("k2", "place", "Cedar", "model", 0.9), ("k9", "place", "Gone", "gazetteer", 1.0)], "hash string, field string, value string, source string, confidence double")
    live = spark.createDataFrame([("k1",), ("k2",), ("k3",)], "hash string")
    rank = F.when(F.col("source") == "gazetteer", 1).otherwise(2)
    resolved = E.resolve(claims, live, rank)
    assert sorted(map(tuple, resolved.collect())) == [("k1", "place", "Birch", "gazetteer"), ("k2", "place", "Cedar", "model")]
    answers = spark.createDataFrame([("k1", "place", "Dale", at(1), 1), ("k1", "place", "Elm", at(1), 2), ("k2", "event", "Trip", at(0), 3)], "hash string, field string, value string, at timestamp, seq long")
    assert sorted(map(tuple, E.overlay(resolved, answers).collect())) == [("k1", "place", "Elm", "human"), ("k2", "event", "Trip", "human"), ("k2", "place", "Cedar", "model")]


def test_votes(spark):
    rows = [("i", "a", "no", at(0)), ("i", "b", "no", at(0)), ("i", "c", "yes", at(0)), ("j", "a", "no", at(0)), ("j", "a", "yes", at(1)), ("k", "a", "yes", at(0)), ("k", "b", "no", at(0))]
    votes = spark.createDataFrame(rows, "item string, voter string, word string, at timestamp")
    got = {r.item: r.verdict for r in E.tally(votes, ["item"], "voter", F.col("word") == "yes", F.col("word") == "no", F.desc("at")).collect()}
    assert got == {"i": "remove", "j": "add", "k": "unchanged"}


def test_plurality(spark):
    rows = [("g", "Sam Lee", 1), ("g", "sam  lee.", 2), ("g", "Kim", 3), ("h", "Sam Lee", 1), ("h", "Kim", 2)]
    votes = spark.createDataFrame(rows, "g string, said string, at long")
    got = {r.g: (r.name, r.n, r.contested) for r in E.plurality(votes, "g", text.name_key(F.col("said")), "said", "at").collect()}
    assert got == {"g": ("Sam Lee", 2, False), "h": ("Sam Lee", 1, True)}


def test_sessions(spark):
    times = [at(0), at(10), at(24), at(38), at(52, 1), None]
    df = spark.createDataFrame([(1, t, i) for i, t in enumerate(times)], "k long, t timestamp, i long")
    got = sorted((r.n, r.start) for r in A.sessions(df, ["k"], "t", "i", "14 hours").collect())
    assert got == [(1, at(52, 1)), (4, at(0))]
    assert [r.n for r in A.sessions(df, ["k"], "t", "i", "14 hours", 4).collect()] == [4]


def test_band_join(spark):
    rows = [("x", at(10)), ("x", at(14)), ("x", at(9, 59)), ("x", at(14, 1)), ("x", None), ("y", at(12))]
    df = spark.createDataFrame(rows, "k string, t timestamp")
    anchors = spark.createDataFrame([("x", at(12)), ("y", None)], "k string, t timestamp")
    assert sorted((r.k, r.t) for r in joins.near_in_time(df, anchors, "k", "t", 120).collect()) == [("x", at(10)), ("x", at(14))]


def test_duplicate_tiers(spark):
    same = "a" * 40
    rows = [(0, same), (1, same), (2, "ab" + "x" * 20 + "yz"), (3, "ab" + "q" * 20 + "yz"), (4, "lonely one")] + [(10 + i, "nine") for i in range(9)]
    df = spark.createDataFrame(rows, "k long, t string").withColumn("n", F.length("t"))
    got = {r.k: r.tier for r in E.duplicate_tiers(df, "k", "n", hashes.signature(F.col("t"), 2), F.md5(F.col("t").cast("binary"))).collect()}
    assert got == {0: "duplicate", 1: "duplicate", 2: "unique content", 3: "unique content", 4: "unique size"} | {10 + i: "duplicate" for i in range(9)}


def test_facets(spark):
    df = spark.createDataFrame([(1998, "photo", "A"), (1999, "photo", "A"), (1998, "video", "B"), (1999, "video", "B")], "year int, media string, place string")
    dims = {"year": ("year", F.col("year") == 1998), "media": ("media", None), "place": ("place", None)}
    got = {(r.facet, r.v): r.n for r in S.facets(df, dims).collect()}
    assert got == {("year", "1998"): 2, ("year", "1999"): 2, ("media", "photo"): 1, ("media", "video"): 1, ("place", "A"): 1, ("place", "B"): 1}


def test_keys(spark):
    rows = spark.createDataFrame([("Asha  Lane.", "asha lane"), ("Ash Ley", "Ashley"), ("Éclair!", "éclair")], "a string, b string")
    same = rows.select((text.name_key(F.col("a")) == text.name_key(F.col("b"))).alias("key"), (text.fold(F.col("a")) == text.fold(F.col("b"))).alias("fold")).collect()
    assert [tuple(r) for r in same] == [(True, True), (False, True), (True, True)]
    assert rows.limit(1).select(text.place_key(F.lit(" .. "))).first()[0] is None
    assert rows.limit(1).select(text.name_key(F.lit("ﬁne ①"), compose=True)).first()[0] == "fine 1"


@pytest.mark.parametrize("a,b,d", [("ca", "abc", 3), ("abcd", "acbd", 1), ("", "ab", 2), ("same", "same", 0), ("kitten", "sitting", 3)])
def test_osa(a, b, d):
    assert text._osa(a, b) == d == text._osa(b, a)


def test_close_names():
    assert text.close_score("rde bolt", "red bolt") == 1 and text.close_score("blot rde", "red bolt") == 2.5
    assert text.close_score("zzz", "red bolt") is None


def test_removal_guards(spark):
    def guard(known, gone, listing=None):
        k = spark.range(known)
        return quality.removal_guard(k, k.where(F.col("id") >= gone) if listing is None else listing, "id").first().allowed

    assert guard(25, 5) and not guard(25, 6) and guard(15, 10)
    assert not guard(25, 0, spark.range(0)) and guard(25, 0)


def test_parser_round_trip():
    people, places, countries = ["Asha Lane", "Ben Cole", "Cole Park"], ["Alder Bay", "Birch Hill"], ["Norland"]
    s = S.parse("asha lane at alder bay in 1998", people, places, countries)
    assert (s.people, s.place, s.year_from, s.year_to, s.rest) == (("Asha Lane",), "Alder Bay", 1998, 1998, "")
    assert S.parse("cole sunset", people, places, countries).people == ()  # two people have this name
    assert S.parse("lane videos from the 90s", people, places, countries) == S.Spec(people=("Asha Lane",), media="video", year_from=1990, year_to=1999)
    for typed in ("asha lane alder bay 1998", "ben cole norland photos sunset walk", "1980s videos", "birch hill 2001 dinner"):
        spec = S.parse(typed, people, places, countries)
        assert S.parse(S.compose(spec), people, places, countries) == spec
    assert S.describe(S.parse("ben cole videos 1998", people, places, countries)) == "Videos with Ben Cole from 1998."


def test_paths_without_end(spark):
    nodes = spark.createDataFrame([(1, None, "root"), (2, 1, "a"), (3, 2, "b"), (8, 9, "x"), (9, 8, "y"), (5, 77, "lost")], "id long, parent long, name string")
    got = {r.id: r.path for r in joins.resolve_paths(nodes, 8).collect()}
    assert got[3] == "root/a/b" and got[1] == "root" and got[8] is None and got[9] is None


def test_paths_of_deep_trees(spark):
    rows = [(i, i - 1 if i else None, f"n{i}") for i in range(300)] + [(900, 901, "x"), (901, 900, "y"), (902, 901, "z")]
    got = {r.id: r.path for r in joins.resolve_paths(spark.createDataFrame(rows, "id long, parent long, name string"), 8).collect()}
    assert got == {i: "/".join(f"n{k}" for k in range(i + 1)) for i in range(300)} | {900: None, 901: None, 902: None}


def test_fallback_says_its_kind(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "k long, base string")
    exact = spark.createDataFrame([(1, "x")], "k long, v string")
    base = spark.createDataFrame([("a", "no"), ("b", "y"), ("b", "y"), ("c", "p"), ("c", "q")], "base string, v string")
    got = {r.k: (r.v, r.kind) for r in joins.with_fallback(df, [("exact", ["k"], exact), ("base", ["base"], base)], "v").collect()}
    assert got == {1: ("x", "exact"), 2: ("y", "base"), 3: (None, "none"), 4: (None, "none")}


def test_greedy_clusters(spark):
    r = np.random.default_rng(3)
    centres = np.eye(8)[:3]
    rows = [(i, (centres[i % 3] + r.normal(size=8) * 0.05).tolist(), 0.9 if i < 3 else 0.1) for i in range(30)]
    rows += [(100, (-np.eye(8)[7]).tolist(), 0.1), (101, None, 0.9)]
    df = spark.createDataFrame(rows, "k long, v array<double>, s double")
    got = {x.key: x.cluster for x in C.greedy(df, "k", "v", F.col("s")).collect()}
    assert got[100] is None and 101 not in got
    assert len({got[i] for i in range(3)}) == 3 and all(got[i] == got[i % 3] for i in range(30))


def test_merge_respects_names(spark):
    rows = [(1, [1.0, 0.0], 9.0, "Pat"), (2, [0.99, 0.05], 5.0, "Quinn"), (3, [0.98, 0.1], 4.0, None), (4, [0.0, 1.0], 3.0, None)]
    df = spark.createDataFrame(rows, "c long, centre array<double>, n double, name string")
    groups = C.merge(df, "c", "centre", "n", "name")
    got = {x.c: x.grp for x in groups.collect()}
    assert got[1] != got[2] and got[3] in (got[1], got[2]) and got[4] not in (got[1], got[2])
    assert C.conflicts(df.join(groups, "c"), "grp", "name").count() == 0


def test_nearest_against_plain(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(60, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(90, None), (91, [0.0] * 6)], "id long, v array<double>")
    got = S.nearest(df, "id", "v", df.where("id % 20 = 0"), "id", "v", 4).collect()
    u = x / np.linalg.norm(x, axis=1)[:, None]
    for q in (0, 20, 40):
        want = np.argsort(-(u @ u[q]), kind="stable")[:4].tolist()
        assert [g.key for g in sorted((g for g in got if g.query == q), key=lambda g: g.rank)] == want


def test_places_at_the_edges(spark):
    places = spark.createDataFrame([(1, 0.0, 179.99), (2, 60.0, -180.0), (3, 10.0, 10.0)], "id long, lat double, lon double")
    points = spark.createDataFrame([("a", 0.0, -179.95), ("b", 60.05, 179.9), ("c", 10.0, 10.3), ("d", -10.0, 10.0), ("e", None, 1.0)], "k string, lat double, lon double")
    got = {r.k: r.place for r in S.nearest_place(points, "k", places).collect()}
    assert got == {"a": 1, "b": 2}


def test_batches(spark):
    df = spark.createDataFrame([("g", i, s) for i, s in enumerate([4, 4, 4, 20, 1, 9, 1])], "g string, i long, s long")
    got = [r.batch for r in sorted(A.batches_by_size(df, ["g"], ["i"], "s", 10).collect(), key=lambda r: r.i)]
    assert got == [1, 1, 2, 3, 4, 4, 5]


def test_every_nth_and_budget(spark):
    df = spark.range(1000).withColumn("n", F.lit(3))
    assert sorted(r.id for r in quality.every_nth(df, "id", 97).collect()) == list(range(0, 1000, 97))
    assert sorted(r.id for r in plans.within_budget(df, "n", 100, "id").collect()) == list(range(33))


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    assert sorted(map(tuple, E.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(map(tuple, E.upsert(old, new, ["k"], F.lit(False)).collect())) == [(1, "a"), (2, "b"), (3, "C")]


def test_boxes_and_dates(spark):
    row = spark.range(1).select(
        values.turned_box(F.array(F.lit(0.1), F.lit(0.2), F.lit(0.3), F.lit(0.4)), F.lit(1)).alias("q1"),
        values.turned_box(F.array(F.lit(0.1), F.lit(0.2), F.lit(0.3), F.lit(0.4)), F.lit(-4)).alias("q0"),
        values.date_in_name(F.lit("IMG_20240229_101500.jpg")).alias("day"),
        values.date_in_name(F.lit("IMG_20230229.jpg")).alias("no_day"),
        values.date_in_name(F.lit("1985-01-01.jpg")).alias("early"),
        values.moment_in_name(F.lit("20240229.jpg")).alias("moment"),
        values.segments(F.lit(2400)).alias("segments"),
    ).first()
    assert np.allclose(row.q1, [0.4, 0.1, 0.4, 0.3]) and np.allclose(row.q0, [0.1, 0.2, 0.3, 0.4])
    assert row.day == dt.date(2024, 2, 29) and row.no_day is None and row.early is None and row.moment is None
    assert row.segments == [0, 1200]


def test_archives_and_vectors(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("d/a.txt", "hello")
        z.writestr("b.txt", "")
    (tmp_path / "x.zip").write_bytes(buffer.getvalue())
    (tmp_path / "broken.zip").write_bytes(b"PK nonsense")
    got = {(r.path.rsplit("/", 1)[1], r.member): r.bytes for r in archives.members(spark, str(tmp_path), digest=True).collect()}
    assert got == {("x.zip", "d/a.txt"): 5, ("x.zip", "b.txt"): 0, ("broken.zip", None): None}
    import base64

    half = base64.b64encode(np.array([0.5, -2], "<f2").tobytes()).decode()
    blob = np.array([1.5, 2.5, 3.5], "<f4").tobytes()
    df = spark.createDataFrame([(half, bytearray(blob), "[1,2.5]"), (None, bytearray(b"xx"), None)], "h string, b binary, t string")
    rows = df.select(files.float16_base64("h").alias("h"), files.float32_blob(3)("b").alias("b"), files.vector_literal(F.col("t")).alias("t")).collect()
    assert rows[0].h == [0.5, -2.0] and rows[0].b == [1.5, 2.5, 3.5] and rows[0].t == [1.0, 2.5]
    assert rows[1].h is None and rows[1].b is None and rows[1].t is None


def test_image_headers(spark):
    import struct

    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">II", 640, 480)
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + struct.pack(">HH", 30, 20) + b"\x03"
    df = spark.createDataFrame([(bytearray(png),), (bytearray(jpeg),), (bytearray(b"no"),)], "b binary")
    assert [tuple(r[0]) for r in df.select(files.image_size("b")).collect()] == [(640, 480, "png"), (20, 30, "jpeg"), (None, None, None)]


def test_text_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,x\nbad,y\n3\n")
    got = files.csv(spark, str(tmp_path / "a.csv"), "k int, v string").collect()
    assert [tuple(r) for r in got] == [(1, "x"), (None, "y"), (3, None)]
    (tmp_path / "p.csv").write_text("1,x\n2\n")
    assert files.positional_csv(spark, str(tmp_path / "p.csv"), "k int, v string", ["v"]).count() == 1
    (tmp_path / "e.json").write_text('{"events": [{"start": "s1", "hashes": ["a", "b"]}, {"start": "s2", "hashes": []}]}')
    got = files.nested_json(spark, str(tmp_path / "e.json"), "events array<struct<start:string,hashes:array<string>>>", "events", "hashes")
    assert sorted(map(tuple, got.collect())) == [("s1", "a"), ("s1", "b")]
    (tmp_path / "l.txt").write_text("# head\n a \n\nb # tail\n")
    assert [r.line for r in files.lines(spark, str(tmp_path / "l.txt")).collect()] == ["a", "b"]
    assert files.tree(spark, str(tmp_path), "*.csv").count() == 2


def test_publish_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "table")
    sinks.publish(spark.range(5).toDF("x"), root)
    with pytest.raises(ValueError):
        sinks.publish(spark.range(7).toDF("x"), root, sinks.same_count(8))
    assert sinks.current(spark, root).count() == 5
    sinks.publish(spark.range(7).toDF("x"), root, sinks.same_count(7))
    assert sinks.current(spark, root).count() == 7


def test_bundle_shards_and_redaction(spark, tmp_path):
    assert sinks.bundle({"a": spark.range(3), "b": spark.range(0)}, str(tmp_path / "b")) == {"a": 3, "b": 0}
    sinks.shards(spark.range(25).coalesce(1), str(tmp_path / "s"), 10)
    assert len(list((tmp_path / "s").glob("part-*"))) == 3
    sinks.export_csv(spark.range(9), str(tmp_path / "c"), ["id"])
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 9
    df = spark.createDataFrame([("Ann Bee met ann",)], "t string")
    assert sinks.redact(df, ["t"], ["ann", "ann bee"]).first()[0] == "*** met ***"
    with pytest.raises(Exception, match="was to be masked"):
        sinks.redact(df, ["t"], ["bee"], F.regexp_count("t", F.lit("(?i)ann"))).collect()
    assert sinks.checksum(df).first() == sinks.checksum(df.repartition(3)).first()


def test_paged_source(spark):
    spark.dataSource.register(PagedSource)
    df = spark.read.format("paged").option("table", "t").option("rows", "25").option("page", "10").option("transport", "fernglass.sources.paged:numbered").load()
    assert df.count() == 25 and df.rdd.getNumPartitions() == 3


def test_streams_equal_batches(spark, tmp_path):
    path = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{path}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = state.run_to_end(state.window_counts(stream.withWatermark("ts", "1 hour"), "ts", ["event_type"]), "hours", str(tmp_path / "c1"), "complete")
    batch = state.window_counts(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"])
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, batch.collect()))
    once = state.run_to_end(stream.dropDuplicates(["event_id"]).select("event_id"), "once", str(tmp_path / "c2"))
    assert once.count() == events.count()


def test_online_means_stream(spark, tmp_path):
    r = np.random.default_rng(5)
    rows = [(0, i, (np.eye(4)[i % 2] + r.normal(size=4) * 0.05).tolist()) for i in range(20)]
    spark.createDataFrame(rows, "b long, k long, v array<double>").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("b long, k long, v array<double>").parquet(str(tmp_path / "in"))
    got = state.run_to_end(state.online_means(stream, "b", "k", "v"), "means", str(tmp_path / "c"))
    assert {(x.key % 2, x.cluster) for x in got.collect()} == {(0, 0), (1, 1)}


def test_composed_keys_of_whole_texts(spark, tmp_path):
    import re
    import unicodedata

    from fernglass.plans import all_queries

    rows = [(1, "ﬁne ① " * 50 + "End"), (2, "short"), (3, ""), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.key for r in all_queries()["str_02_name_key_composed"](spark, str(tmp_path)).collect()}
    assert got == {i: None if t is None else re.sub(r"[\W_]+", " ", unicodedata.normalize("NFKC", t).lower()).strip() for i, t in rows}


def test_close_names():
    known = ["red bolt", "ted bolt", "abc", "blue ring", "small widget"]
    assert text.close_names("ab", known) == ["abc"]
    assert text.close_names("red bolt", known) == []
    assert text.close_names("rde bolt", known)[0] == "red bolt"
    assert text.close_names("widgte", known) == ["small widget"]
    assert text.close_names("smal wigdet", known) == ["small widget"]
    assert text.close_names("nothing like it", known) == []
    assert text.close_score("red bolt", "red bolt") is None and text.close_score("", "abc") is None


def test_close_pairs_against_all_pairs(spark):
    import random

    r = random.Random(5)
    names = {"".join(r.choice("ab ") for _ in range(r.randint(0, 13))) for _ in range(150)} | {"blue widget", "blue widgte", "bleu widget", "a", "b", "ab"}
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "n string")
    got = {(x.a, x.b) for x in joins.close_pairs(df, "n", {3: 1, 5: 2, 9: 3}).collect()}
    pairs = spark.createDataFrame([(a, b) for a in names for b in names if a < b], "a string, b string").withColumn("d", F.levenshtein("a", "b")).collect()
    assert got == {(p.a, p.b) for p in pairs if p.d <= (3 if len(p.a) >= 9 else 2 if len(p.a) >= 5 else 1 if len(p.a) >= 3 else 0)}


def test_latest_by_names_and_by_window(spark):
    rows = [(k % 5 if k % 7 else None, k % 3 if k % 4 else None, k, str(k)) for k in range(200)]
    df = spark.createDataFrame(rows, "k int, at int, id int, s string")
    a = A.latest(df, ["k"], "at", "id")
    assert a.columns == df.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, A.latest(df, ["k"], F.desc("at"), F.desc("id")).collect()))


def test_tiers_of_hot_and_null_sizes(spark):
    rows = [(i, 0, "") for i in range(50)] + [(100, 3, "abc"), (101, 3, "abd"), (102, 3, "abc"), (103, None, "x"), (104, 7, "aXXXXXb"), (105, 7, "aYYYYYb")]
    df = spark.createDataFrame(rows, "k int, n int, t string")
    got = {r.k: r.tier for r in E.duplicate_tiers(df, "k", "n", hashes.signature(F.col("t"), 1), F.md5(F.col("t").cast("binary"))).collect()}
    assert len(got) == len(rows) and {got[i] for i in range(50)} == {"duplicate"}
    assert (got[100], got[101], got[102], got[103]) == ("duplicate", "unique ends", "duplicate", "unique size") and got[104] == got[105] == "unique content"


def test_nearest_against_plain(spark, monkeypatch):
    import random

    r = random.Random(2)
    rows = [(i, [float(r.randint(-2, 2)) for _ in range(4)]) for i in range(300)] + [(400, None), (401, [0.0] * 4), (402, [1.0]), (403, [None, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(4)
    queries = df.where("id % 9 = 0 or id > 399")
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if v and None not in v and len(v) == 4 and any(v)}
    for size in (64 << 20, 100):
        monkeypatch.setattr(S, "QUERY_BYTES", size)
        monkeypatch.setattr(S, "QUERY_TILE", 7)
        got = {}
        for x in S.nearest(df, "id", "v", queries, "id", "v", 5).collect():
            got.setdefault(x["query"], {})[x["rank"]] = x
        assert set(got) == {i for i in unit if i % 9 == 0}
        for q, best in got.items():
            want = sorted((-round(float(unit[q] @ u), 9), i) for i, u in unit.items())[:5]
            assert [-round(best[k].sim, 9) for k in range(1, 6)] == [s for s, _ in want]


def test_boxes_that_are_the_best_of_each_other(spark):
    """Boxes that share a number give the same pair twice, at times with the same overlap; it is found once all the same."""
    rows = [(1, 1, 4, 0.5), (1, 1, 4, 0.5), (1, 1, 5, 0.5), (1, 2, 4, 0.5), (1, 2, 5, 0.4), (2, 3, 6, 0.3), (2, 3, 6, 0.9), (2, 2, 6, 0.8)]
    for n in range(len(rows)):
        pairs = spark.createDataFrame(rows[n:] + rows[:n], "photo long, old int, new int, iou double").repartition(3)
        got = joins.best_of_each_other(pairs, "photo", "old", "new", "iou")
        assert sorted(map(tuple, got.collect())) == [(1, 1, 4), (2, 3, 6)]


def test_database_of_several_processes(spark, tmp_path):
    """What executors read over JDBC isn't in the driver's memory: a second JVM reads it while the first has it open."""
    import subprocess
    import sys

    rows = [(k, None if k % 7 == 0 else "" if k % 5 == 0 else f"ü {k}", k / 4) for k in range(2_500)] + [(None, "no key", None)]
    frame = spark.createDataFrame(rows, "k long, name string, share double")
    url = sinks.database(frame.repartition(3), "T", f"file://{tmp_path}/database")
    read = files.jdbc(spark, url, "T", "k", 100, 200, 4, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    order = lambda found: sorted(map(tuple, found), key=repr)
    assert read.rdd.getNumPartitions() == 4 and order(read.collect()) == order(rows)
    other = (
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        f"print('ROWS', spark.read.format('jdbc').options(url={url!r}, dbtable='T', driver='org.apache.derby.iapi.jdbc.AutoloadedDriver').load().count())"
    )
    said = subprocess.run([sys.executable, "-c", other], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert f"ROWS {len(rows)}" in said.stdout, said.stderr[-2000:]
    with pytest.raises(ValueError):
        sinks.database(spark.createDataFrame([([1],)], "k array<int>"), "T", str(tmp_path / "lists"))
