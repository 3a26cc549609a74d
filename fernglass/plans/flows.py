"""Queries of sections SRC, SNK and INC."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fernglass.functions import text
from fernglass.operators import aggregates as A
from fernglass.operators import entities as E
from fernglass.sources import files, sinks
from fernglass.streaming import state
from fernglass.plans.base import Family, Tables

query = Family()


@query("src_01_tree")
def src_01(spark, d):
    """The tables' own files, without reading them."""
    return files.tree(spark, d, "*.parquet").select(text.basename(F.col("path")).alias("name"), "bytes")


@query("src_05_json_lines", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def src_05(spark, d):
    return Tables(spark, d).events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("src_08_paged", "select c_custkey as id, c_name as value from customer")
def src_08(spark, d):
    """A table served in pages of 1,000 rows, each read by a task of its own."""
    from fernglass.operators.storage import mounted, place
    from fernglass.sources.paged import PagedSource

    at = place(spark, "served")
    customers = Tables(spark, d).customer.select("c_custkey", "c_name")
    customers.coalesce(1).write.parquet(at)  # what the service holds: one file that is read a slice at a time
    file = [r[0] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(at).select("path").collect()][0]
    spark.dataSource.register(PagedSource)
    return spark.read.format("paged").options(table=mounted(file), rows=str(customers.count()), transport="fernglass.sources.paged:parquet_rows").load()


@query("src_13_shards", "select vec_id, len(embedding) as dim from embeddings")
def src_13(spark, d):
    return Tables(spark, d).embeddings.select("vec_id", F.size("embedding").cast("bigint").alias("dim"))


@query("src_16_literal", "select vec_id, round(embedding[1]::double, 5) as x from embeddings")
def src_16(spark, d):
    literal = F.to_json("embedding")
    return Tables(spark, d).embeddings.select("vec_id", F.round(files.vector_literal(literal)[0].cast("double"), 5).alias("x"))


@query("src_21_gazetteer", "select c_custkey, n_name, r_name from customer left join nation on n_nationkey = c_nationkey left join region on r_regionkey = c_custkey % 7")
def src_21(spark, d):
    t = Tables(spark, d)
    places = t.customer.select("c_custkey", F.col("c_nationkey").alias("admin_code"), (F.col("c_custkey") % 7).alias("country_code"))
    named = files.gazetteer(places, t.nation.select(F.col("n_nationkey").alias("admin_code"), "n_name"), t.region.select(F.col("r_regionkey").alias("country_code"), "r_name"))
    return named.select("c_custkey", "n_name", "r_name")


@query("src_24_ids", """select page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) as href from pages""")
def src_24(spark, d):
    return Tables(spark, d).pages.select("page_id", F.explode(files.ids_in_html(F.col("html"), "href")).alias("href"))


@query("snk_03_upsert", "with c as (select c_custkey, 'NEW' as c_mktsegment, c_acctbal + 1 as c_acctbal from customer where c_custkey % 5 = 0 union all select c_custkey + 100000, 'ADDED', 0.0 from customer where c_custkey < 10) select coalesce(t.c_custkey, c.c_custkey) as c_custkey, case when c.c_custkey is not null and (t.c_custkey is null or t.c_acctbal < 5000) then c.c_mktsegment else t.c_mktsegment end as c_mktsegment, round(case when c.c_custkey is not null and (t.c_custkey is null or t.c_acctbal < 5000) then c.c_acctbal else t.c_acctbal end, 2) as c_acctbal from customer t full join c on c.c_custkey = t.c_custkey")
def snk_03(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    changes = c.where("c_custkey % 5 = 0").select("c_custkey", F.lit("NEW").alias("c_mktsegment"), (F.col("c_acctbal") + 1).alias("c_acctbal")).unionByName(c.where("c_custkey < 10").select((F.col("c_custkey") + 100000).alias("c_custkey"), F.lit("ADDED").alias("c_mktsegment"), F.lit(0.0).alias("c_acctbal")))
    return E.upsert(c, changes, ["c_custkey"], F.col("c_acctbal") < 5000).withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("snk_06_retention", "select event_id from (select event_id, dense_rank() over (order by ts::date desc) as k from events) where k <= 7")
def snk_06(spark, d):
    return E.keep_newest_days(Tables(spark, d).events, "ts", 7).select("event_id")


@query("snk_09_filter_rewrite", "select count(*) filter (where doc_id not in (select doc_id from labels where toxic = 1)) as kept, count(*) filter (where doc_id in (select doc_id from labels where toxic = 1)) as gone from documents")
def snk_09(spark, d):
    t = Tables(spark, d)
    kept, gone = sinks.without(t.documents.select("doc_id"), t.labels.where("toxic = 1"), ["doc_id"])
    return kept.agg(F.count("*").alias("kept")).crossJoin(gone.agg(F.count("*").alias("gone")))


@query("snk_10_patch", "select p_partkey, case p_type when 'PROMO' then 'OFFER' when 'SMALL' then 'MINI' else p_type end as p_type from part")
def snk_10(spark, d):
    moves = spark.createDataFrame([("PROMO", "OFFER"), ("SMALL", "MINI")], "old string, new string")
    return sinks.patched(Tables(spark, d).part.select("p_partkey", "p_type"), moves, "p_type")


@query("snk_11_events_document", "select user_id, count(*) as n, string_agg(event_type, ',' order by ts, event_id) as kinds from events group by user_id")
def snk_11(spark, d):
    e = Tables(spark, d).events.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))).alias("a"))
    return e.select("user_id", F.size("a").cast("bigint").alias("n"), F.array_join("a.event_type", ",").alias("kinds"))


@query("snk_15_redact", "select doc_id, regexp_replace(regexp_replace(text, '(?i)worthless', '***', 'g'), '(?i)moron', '***', 'g') as text from documents where doc_id in (select doc_id from labels where toxic = 1)")
def snk_15(spark, d):
    t = Tables(spark, d)
    rows = t.documents.select("doc_id", "text").join(t.labels.where("toxic = 1").select("doc_id"), "doc_id", "left_semi")
    return sinks.redact(rows, ["text"], ["moron", "worthless"], F.regexp_count("text", F.lit("(?i)moron|worthless")))


@query("inc_01_pending", "select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')")
def inc_01(spark, d):
    t = Tables(spark, d)
    return state.pending(t.orders.select("o_orderkey"), t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("inc_02_pending_members", "select distinct l_orderkey, l_suppkey from lineitem where l_quantity > 40 except select l_orderkey, l_suppkey from lineitem where l_returnflag = 'N'")
def inc_02(spark, d):
    li = Tables(spark, d).lineitem
    return state.pending(li.where("l_quantity > 40").select("l_orderkey", "l_suppkey").distinct(), li.where("l_returnflag = 'N'"), ["l_orderkey", "l_suppkey"])


@query("inc_03_watermark", "select event_id from events where ts > (select max(ts) from events where event_type = 'signup' and value > 200)")
def inc_03(spark, d):
    e = Tables(spark, d).events
    return state.after_watermark(e, "ts", e.where("event_type = 'signup' and value > 200").select(F.col("ts").alias("at")), "at").select("event_id")


@query("inc_04_late_correction", "select user_id, event_id, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as k from events where event_type in ('signup', 'error')) where k = 1")
def inc_04(spark, d):
    e = Tables(spark, d).events.where(F.col("event_type").isin("signup", "error"))
    return A.latest(e, ["user_id"], "ts", "event_id").select("user_id", "event_id", "value")


@query("inc_05_idempotent", "select distinct event_id, user_id from events")
def inc_05(spark, d):
    e = Tables(spark, d).events.select("event_id", "user_id")
    return e.unionByName(e.where("event_id % 3 = 0")).dropDuplicates(["event_id"])


@query("inc_08_online_means")
def inc_08(spark, d):
    """Vectors written as files and read as a stream to its end; a label's running means are its state."""
    from fernglass.operators.storage import place

    at = place(spark, "vectors")
    rows = Tables(spark, d).embeddings.select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
    rows.write.parquet(at)
    stream = spark.readStream.schema(spark.read.parquet(at).schema).parquet(at)
    return state.run_to_table(state.online_means(stream, "label", "vec_id", "embedding"), place(spark, "means"), place(spark, "progress")).withColumnRenamed("key", "vec_id")


@query("inc_09_retry", "select event_id from events where event_type = 'error' and cast(json_extract_string(props, '$.k') as int) % 6 < 3")
def inc_09(spark, d):
    tries = F.get_json_object("props", "$.k").cast("int") % 6
    return Tables(spark, d).events.where(state.retryable(F.col("event_type"), tries)).select("event_id")


@query("inc_11_reconcile", "select c_custkey, case when c_mktsegment = 'BUILDING' then 'delete' else 'unbind' end as action from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F' and o_totalprice > 100000)")
def inc_11(spark, d):
    t = Tables(spark, d)
    known = t.customer.select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", "cloud").otherwise("library").alias("kind"))
    listed = t.orders.where("o_orderstatus = 'F' and o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey"))
    return state.reconcile(known, listed, "c_custkey", "kind")


@query("inc_12_rates", "select date_trunc('hour', ts)::timestamp as start, event_type, count(*) as n from events group by 1, 2")
def inc_12(spark, d):
    return state.window_counts(Tables(spark, d).events, "ts", ["event_type"])


@query("inc_12_trailing_rates", "select event_id, count(*) over (partition by user_id order by epoch_us(ts) range between 3600000000 preceding and current row) as n from events")
def inc_12b(spark, d):
    w = Window.partitionBy("user_id").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-3_600_000_000, 0)
    return Tables(spark, d).events.select("event_id", F.count("*").over(w).alias("n"))


SESSIONS = """with g as (select user_id, ts, case when ts - lag(ts) over w <= interval 14 hour then 0 else 1 end as new from events window w as (partition by user_id order by ts, event_id)),
r as (select *, sum(new) over (partition by user_id order by ts rows unbounded preceding) as run from g) select user_id, min(ts) as start, count(*) as n from r group by user_id, run"""


@query("inc_13_session_window", SESSIONS)
def inc_13(spark, d):
    return state.session_counts(Tables(spark, d).events, "ts", ["user_id"])


QUERIES, SQL = query.queries, query.sql
