"""Queries whose plans deal rows by range, rank or salt, dealt over many small partitions: the same rows as the SQL's."""

import os
import sys

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import TABLES, rows

from fernglass.plans import all_queries, all_sql

FOLDER = "/root/testdata/sf0.001"
CONF = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
NAMES = ["qua_07_every_nth", "msc_44_copy_budget", "inc_06_budget", "win_05_latest", "win_11_batches", "ded_01_tiers", "joi_23_near_pairs", "joi_28_scopes", "srh_06_knn", "ent_02_overlay", "msc_17_shard_union", "clu_10_reread"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


@pytest.fixture(params=["true", "false"], ids=["coalesced", "apart"])
def many(spark, request):
    conf = CONF | {"spark.sql.adaptive.coalescePartitions.enabled": request.param}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_many_partitions(many, duck, name):
    frame = all_queries()[name](many, FOLDER)
    got = pd.DataFrame([tuple(r) for r in frame.collect()], columns=frame.columns)
    out = duck.sql(all_sql()[name])
    assert rows(got) == rows(pd.DataFrame(out.fetchall(), columns=out.columns))
