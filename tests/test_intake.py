"""Sheets, re-reads, re-derivations, guards, budgets, readers of headers and listings on fixtures with known answers."""

import datetime as dt
import threading
import time

import pytest
from pyspark.sql import functions as F

from fernglass.operators import intake, storage
from fernglass.sources import archives, exif, files, paged, sinks


def test_sheet_answers(spark):
    shown = spark.createDataFrame([(k,) for k in "abcdefz"], "k string")
    filled = spark.createDataFrame([("a", " Kim "), ("b", ""), ("c", "?"), ("d", "X"), ("z", "Lee"), ("a", None)], "k string, t string")
    known = spark.createDataFrame([(k,) for k in "abcdef"], "k string")
    got = {r.k: (r.outcome, r.name) for r in intake.sheet_answers(shown, filled, known, "k", "t").collect()}
    assert got == {"a": ("named", "Kim"), "b": ("declined", None), "c": ("asked", None), "d": ("unidentifiable", None), "e": ("declined", None), "f": ("declined", None), "z": ("refused", None)}


def test_reread_keeps_clusters(spark):
    old = spark.createDataFrame([("p", 0, "c1", [0.0, 0.0, 0.4, 0.4]), ("p", 1, "c2", [0.5, 0.5, 0.4, 0.4]), ("p", 2, None, [0.9, 0.9, 0.1, 0.1])], "photo string, j int, cluster string, box array<double>")
    new = spark.createDataFrame([("p", 0, [0.02, 0.0, 0.4, 0.4]), ("p", 1, [0.0, 0.02, 0.4, 0.4]), ("p", 2, [0.5, 0.5, 0.4, 0.4]), ("p", 3, [0.9, 0.9, 0.1, 0.1]), ("q", 0, [0.0, 0.0, 1.0, 1.0])], "photo string, i int, box array<double>")
    got = {(r.photo, r.i): r.cluster for r in intake.reread(new, old, "photo").collect()}
    assert got == {("p", 0): "c1", ("p", 1): None, ("p", 2): "c2", ("p", 3): None, ("q", 0): None}


def test_rederived(spark):
    rows = [(i, [1.0, float(i)]) for i in range(20)]
    stored = spark.createDataFrame(rows, "id long, v array<double>")
    one = lambda again, sample=8: tuple(intake.rederived(stored, spark.createDataFrame(again, "id long, v array<double>"), "id", "v", ["id"], sample).first())
    assert one(rows) == (8, 8, 0, 0)
    assert one([(i, v if i != 19 else [-1.0, 0.0]) for i, v in rows]) == (8, 8, 1, 1)
    assert one([(i, v + [0.0]) for i, v in rows])[3] == 1
    assert one([(99, [1.0, 1.0])]) == (8, 0, 0, 1)
    few = stored.where("id < 3")
    assert intake.rederived(few, few, "id", "v", ["id"], 8).first().code == 2


def test_descriptions(spark):
    def code(texts, tags):
        df = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(zip(texts, tags))], "i int, t string, g string")
        return intake.described(df, "t", ["g"], ["i"], 10, 3, 0.5).first().code

    assert code(["a b c d"] * 6, ["x"] * 6) == 0
    assert code(["a"] * 6, ["x"] * 6) == 1
    assert code(["a b c d"] * 6, [""] * 6) == 1
    assert code([None] * 6, ["x"] * 6) == 1
    assert code(["a b c d"] * 4, ["x"] * 4) == 2


def test_deletion_verdicts(spark):
    cases = [("/keep/a", "scratch", True, True, False, "protected root"), ("/tmp1/a", "scratch", None, None, None, "allowed"), ("/tmp12/a", "scratch", None, None, None, "not in scratch"), ("/x/a", "verified-duplicate", False, None, None, "no proof"), ("/x/a", "verified-duplicate", True, None, True, "camera original"), ("/x/a", "verified-duplicate", True, None, False, "allowed"), ("/x/a", "consumed-archive", None, False, None, "members not accounted for"), ("/x/a", "consumed-archive", None, True, None, "allowed"), ("/x/a", "why not", None, None, None, "unknown reason"), (None, "scratch", None, None, None, "no path")]
    df = spark.createDataFrame(cases, "p string, r string, proof boolean, acc boolean, orig boolean, want string")
    got = df.select("want", intake.deletion_verdict(F.col("p"), F.col("r"), ["/keep"], "/tmp1", F.col("proof"), F.col("acc"), F.col("orig")).alias("v")).collect()
    assert all(r.v == r.want for r in got)


def test_budget_and_deadline(spark):
    df = spark.createDataFrame([(i, 4.0 if i else None) for i in range(6)], "i int, c double")
    assert sorted(r.i for r in intake.budgeted(df, "c", 9.0, "i").collect()) == [0, 1, 2, 3]

    def call(row):
        return row["i"], threading.active_count()

    got = intake.in_flight(df.repartition(1), call, "i int, n int", workers=2).collect()
    assert sorted(r.i for r in got) == list(range(6))
    assert intake.in_flight(df, call, "i int, n int", deadline=time.time() - 1).count() == 0


def test_memo_lasts_a_minute(spark):
    now, made = [100.0], []
    memo = intake.Memo(60, lambda: now[0])

    def make():
        made.append(1)
        return spark.range(len(made))

    assert memo.get("x", make).count() == 1
    now[0] = 159.0
    assert memo.get("x", make).count() == 1
    now[0] = 161.0
    assert memo.get("x", make).count() == 2 and len(made) == 2


def test_exif(spark):
    one = exif.write("2019:07:03 10:11:12", "Acme", "X 100", -12.5, 170.25, 4000, 3000)
    for order in "<>":
        got = exif.read(exif.write("2019:07:03 10:11:12", "Acme", "X 100", -12.5, 170.25, 4000, 3000, order))
        assert got[0] == dt.datetime(2019, 7, 3, 10, 11, 12) and got[1:3] == ("Acme", "X 100") and abs(got[3] + 12.5) < 1e-6 and abs(got[4] - 170.25) < 1e-6 and got[5:] == (4000, 3000)
    assert exif.read(exif.write("0000:00:00 00:00:00", "", "", 0.0, 0.0, 1, 2)) == (None, None, None, None, None, 1, 2)
    for cut in range(0, len(one), 7):
        exif.read(one[:cut])
        exif.read(one[:cut] + b"\xff" * 40)
    df = spark.createDataFrame([(bytearray(one),), (None,), (bytearray(b"no picture"),)], "b binary")
    assert [r.e.model for r in df.select(exif.exif("b").alias("e")).collect()] == ["X 100", None, None]


def test_profile_sidecar_and_numbers(spark, tmp_path):
    (tmp_path / "p.yaml").write_text("# x\nother:\n  - no\nprotect:\n  - 'Ann'  # why\n  - bo\nlast:\n  - z\n")
    assert files.protective_terms(spark, str(tmp_path / "p.yaml")) == ["ann", "bo"]
    (tmp_path / "q.yaml").write_text("protect:\n")
    for name in ("q.yaml", "missing.yaml"):
        with pytest.raises(Exception):
            files.protective_terms(spark, str(tmp_path / name))
    df = spark.createDataFrame([('{"title": "A.JPG", "photoTakenTime": {"timestamp": "12"}}',), ('{"title": "A"}',), ("no",), (None,), ('{"title": "' + "x" * (5 << 20) + '", "photoTakenTime": {"timestamp": "1"}}',)], "s string")
    assert [None if r.c is None else tuple(r.c) for r in df.select(files.sidecar(F.col("s")).alias("c")).collect()] == [("a.jpg", 12), None, None, None, None]
    found = spark.createDataFrame([(f"/a/t-{n}.zip",) for n in ("01", "02", "05", "x")], "path string")
    assert sorted((r.number, r.missing) for r in files.numbered(found, r"^(t)-(\d+)\.zip$").collect()) == [(1, 2), (2, 2), (5, 2)]


def test_members_that_are_done_are_not_opened(spark, tmp_path):
    import io
    import tarfile

    with tarfile.open(tmp_path / "a.tar", "w") as t:
        for name, body in (("x", b"one"), ("y", b"two" * 500_000)):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    first = archives.members(spark, str(tmp_path), "*.tar", digest=True, content_to=10)
    rows = {r.member: r for r in first.collect()}
    assert bytes(rows["x"].content) == b"one" and rows["y"].content is None and rows["y"].bytes == 1_500_000 and len(rows["y"].sha256) == 64
    left = archives.members(spark, str(tmp_path), "*.tar", done=first.where("member = 'x'").select("path", "member"))
    assert [r.member for r in left.collect()] == ["y"]


def test_listing_that_goes_round_is_stopped():
    reader = paged.ListedReader({"roots": "a", "transport": "tests_none:none"})
    import sys
    import types

    sys.modules["tests_none"] = types.SimpleNamespace(none=lambda table, root, token: ([(1, "x")], "again"))
    with pytest.raises(ValueError):
        list(reader.read(reader.partitions()[0]))


def test_refill_changes_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "r")
    sinks.refill({"a": spark.range(2), "b": spark.range(3)}, root)

    def refuse(tables):
        raise ValueError("no")

    with pytest.raises(ValueError):
        sinks.refill({"a": spark.range(20), "b": spark.range(30)}, root, refuse)
    assert (sinks.current(spark, root, "a").count(), sinks.current(spark, root, "b").count()) == (2, 3)
    sinks.refill({"a": spark.range(4), "b": spark.range(5)}, root)
    assert (sinks.current(spark, root, "a").count(), sinks.current(spark, root, "b").count()) == (4, 5)
    with pytest.raises(ValueError):
        sinks.refresh(spark.createDataFrame([(1,), (1,)], "k int"), str(tmp_path / "v"), ["k"])


def test_shared_folder_must_be_named_on_a_cluster():
    class Conf(dict):
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        storage.shared_folder(Session())
