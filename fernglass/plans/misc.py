"""Queries of section MSC: the remaining reports and plans."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fernglass.operators import aggregates as A
from fernglass.operators import plans as P
from fernglass.operators.filters import first_reason
from fernglass.plans.base import Family, Tables

query = Family()


def _md5(c="text"):
    return F.md5(F.col(c).cast("binary"))


@query("msc_01_size_novelty", "with a as (select n_chars, n_chars in (select n_chars from documents where doc_id % 2 = 0) as known from documents where doc_id % 2 = 1) select cast(sum(case when known then 0 else n_chars end) as bigint) as certain_new, cast(sum(case when known then n_chars else 0 end) as bigint) as possibly_held, count(*) as files from a")
def msc_01(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "n_chars")
    known = docs.where("doc_id % 2 = 0").select("n_chars").distinct().withColumn("known", F.lit(True))
    rows = docs.where("doc_id % 2 = 1").join(known, "n_chars", "left")
    n = F.col("n_chars")
    return rows.agg(F.sum(F.when(F.col("known"), 0).otherwise(n)).cast("bigint").alias("certain_new"), F.sum(F.when(F.col("known"), n).otherwise(0)).cast("bigint").alias("possibly_held"), F.count("*").alias("files"))


@query("msc_02_triage", "select case when n_chars > 5000 then 'large' when lang = 'en' then 'english' else 'rest' end as bucket, count(*) as n, cast(sum(n_chars) as bigint) as chars, max(n_chars) as largest from documents group by 1")
def msc_02(spark, d):
    bucket = F.when(F.col("n_chars") > 5000, "large").when(F.col("lang") == "en", "english").otherwise("rest")
    return Tables(spark, d).documents.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.max("n_chars").alias("largest"))


@query("msc_03_survey", "select source, lang, count(*) as n, cast(sum(n_chars) as bigint) as chars, min(doc_id) as first_id from documents group by 1, 2")
def msc_03(spark, d):
    return Tables(spark, d).documents.groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.min("doc_id").alias("first_id"))


@query("msc_04_histogram", "select source, case when n_chars < 100 then 0 when n_chars < 500 then 1 when n_chars < 1000 then 2 when n_chars < 2000 then 3 when n_chars < 5000 then 4 when n_chars < 10000 then 5 else 6 end as bucket, count(*) as n from documents group by 1, 2")
def msc_04(spark, d):
    return Tables(spark, d).documents.groupBy("source", P.bucketed(F.col("n_chars"), [100, 500, 1000, 2000, 5000, 10000]).alias("bucket")).agg(F.count("*").alias("n"))


@query("msc_05_shrink", "select event_id, value < last as shrunk from (select event_id, value, lag(value) over (partition by user_id order by ts, event_id) as last from events) where last is not null")
def msc_05(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return Tables(spark, d).events.withColumn("last", F.lag("value").over(w)).where("last is not null").select("event_id", (F.col("value") < F.col("last")).alias("shrunk"))


@query("msc_06_unseen_sizes", "select doc_id from documents where source = 'src7' and n_chars not in (select n_chars from documents where source <> 'src7')")
def msc_06(spark, d):
    docs = Tables(spark, d).documents
    return docs.where("source = 'src7'").join(docs.where("source <> 'src7'").select("n_chars"), "n_chars", "left_anti").select("doc_id")


@query("msc_07_progress", "select cast(sum(n_chars) as bigint) as total, cast(sum(n_chars) filter (where doc_id in (select doc_id from labels)) as bigint) as done, round(sum(n_chars) filter (where doc_id in (select doc_id from labels)) / sum(n_chars)::double, 6) as share from documents")
def msc_07(spark, d):
    t = Tables(spark, d)
    rows = t.documents.select("doc_id", "n_chars").join(t.labels.select("doc_id").distinct().withColumn("_d", F.lit(True)), "doc_id", "left")
    done = F.sum(F.when(F.col("_d"), F.col("n_chars")))
    return rows.agg(F.sum("n_chars").alias("total"), done.alias("done"), F.round(done / F.sum("n_chars"), 6).alias("share"))


@query("msc_09_composition", "with c as (select p_brand, p_type, count(*) as n from part group by 1, 2), s as (select p_brand, p_type, list(p_partkey order by p_partkey)[1:3] as samples from part group by 1, 2) select p_brand, p_type, n, round(100.0 * n / sum(n) over (partition by p_brand), 4) as percent, samples from c join s using (p_brand, p_type)")
def msc_09(spark, d):
    w = Window.partitionBy("p_brand", "p_type").orderBy("p_partkey")
    rows = Tables(spark, d).part.withColumn("k", F.row_number().over(w)).groupBy("p_brand", "p_type").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("k") <= 3, F.col("p_partkey")))).alias("samples"))
    return rows.withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("p_brand")), 4))


@query("msc_10_batch_check", "select o_orderstatus, count(*) as orders, count(*) filter (where o_orderkey not in (select l_orderkey from lineitem)) as without_lines from orders group by 1")
def msc_10(spark, d):
    t = Tables(spark, d)
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("_l", F.lit(True))
    return t.orders.join(lines, "o_orderkey", "left").groupBy("o_orderstatus").agg(F.count("*").alias("orders"), F.count_if(F.col("_l").isNull()).alias("without_lines"))


@query("msc_11_unmatched_route", "select c_custkey, case when c_acctbal > 5000 then 'rich' else 'plain' end as dest from customer where c_custkey not in (select o_custkey from orders where year(o_orderdate) = 1999)")
def msc_11(spark, d):
    t = Tables(spark, d)
    seen = t.orders.where(F.year("o_orderdate") == 1999).select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(seen, "c_custkey", "left_anti").select("c_custkey", F.when(F.col("c_acctbal") > 5000, "rich").otherwise("plain").alias("dest"))


@query("msc_12_small_but_real", "select doc_id from documents where n_chars < 300 and len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) >= 20")
def msc_12(spark, d):
    return Tables(spark, d).documents.where((F.col("n_chars") < 300) & (F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) >= 20)).select("doc_id")


@query("msc_13_redate", "with j as (select o_orderkey, o_orderdate, min(l_shipdate) as at_ from orders left join lineitem on l_orderkey = o_orderkey and l_returnflag = 'R' group by 1, 2) select case when at_ is null then 'no timestamp' when year(at_) = year(o_orderdate) then 'already correct' when year(at_) < 1995 then 'outside' else 'misfiled' end as verdict, count(*) as n from j group by 1")
def msc_13(spark, d):
    t = Tables(spark, d)
    ship = t.lineitem.where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("at"))
    verdict = F.when(F.col("at").isNull(), "no timestamp").when(F.year("at") == F.year("o_orderdate"), "already correct").when(F.year("at") < 1995, "outside").otherwise("misfiled")
    return t.orders.join(ship, "o_orderkey", "left").groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


@query("msc_14_unhashed", "select doc_id from documents where doc_id not in (select doc_id from labels where quality = 1)")
def msc_14(spark, d):
    t = Tables(spark, d)
    return t.documents.join(t.labels.where("quality = 1"), "doc_id", "left_anti").select("doc_id")


@query("msc_15_origin_status", "select case when l.doc_id is null then 'unrecorded' when l.quality = 0 then 'gone' when l.toxic = 1 then 'offline' else 'present' end as status, count(*) as n, cast(sum(case when l.quality = 0 then n_chars else 0 end) as bigint) as freeable from documents d left join labels l using (doc_id) group by 1")
def msc_15(spark, d):
    t = Tables(spark, d)
    rows = t.documents.join(t.labels.withColumn("_l", F.lit(True)), "doc_id", "left")
    status = F.coalesce(first_reason([(F.col("_l").isNull(), "unrecorded"), (F.col("quality") == 0, "gone"), (F.col("toxic") == 1, "offline")]), F.lit("present"))
    return rows.groupBy(status.alias("status")).agg(F.count("*").alias("n"), F.sum(F.when(F.col("quality") == 0, F.col("n_chars")).otherwise(0)).cast("bigint").alias("freeable"))


@query("msc_16_big_by_device", "select case when contains(url, 'blog.') then 'blog' when contains(url, '//m.') then 'mobile' else 'desk' end as device, count(*) as n, cast(sum(length(html)) as bigint) as bytes from pages where length(html) > 3000 group by 1")
def msc_16(spark, d):
    u = F.col("url")
    device = F.when(F.contains(u, F.lit("blog.")), "blog").when(F.contains(u, F.lit("//m.")), "mobile").otherwise("desk")
    return Tables(spark, d).pages.where(F.length("html") > 3000).groupBy(device.alias("device")).agg(F.count("*").alias("n"), F.sum(F.length("html")).cast("bigint").alias("bytes"))


@query("msc_17_shard_union", "with s as (select label as shard, row_number() over (partition by label order by vec_id) - 1 as id, vec_id from embeddings), z as (select shard, max(id) + 1 as n from s group by 1), b as (select shard, coalesce(sum(n) over (order by shard rows between unbounded preceding and 1 preceding), 0) as before from z) select vec_id, cast(id + before as bigint) as id from s join b using (shard)")
def msc_17(spark, d):
    s = Tables(spark, d).embeddings.select(F.col("label").alias("shard"), (F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1).cast("long").alias("id"), "vec_id")
    return P.rebased(s, "shard", "id").select("vec_id", "id")


@query("msc_18_without_asset", "select md5(text) as h from documents group by 1 having not bool_or(doc_id in (select doc_id from labels))")
def msc_18(spark, d):
    t = Tables(spark, d)
    held = t.documents.join(t.labels, "doc_id", "left_semi").select(_md5().alias("h")).distinct()
    return t.documents.select(_md5().alias("h")).join(held, "h", "left_anti").distinct()


@query("msc_19_best_claim", "select user_id, event_type, event_id from (select *, row_number() over (partition by user_id, event_type order by value desc, ts desc, event_id) as k from events where event_type <> 'view') where k = 1")
def msc_19(spark, d):
    return A.latest(Tables(spark, d).events.where("event_type <> 'view'"), ["user_id", "event_type"], F.desc("value"), F.desc("ts"), F.col("event_id")).select("user_id", "event_type", "event_id")


@query("msc_20_store_summary", "select count(distinct user_id) as ids, count(distinct event_type) as tags, count(*) filter (where event_type = 'purchase' and cast(json_extract_string(props,'$.k') as int) > 90) as crossed from events")
def msc_20(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    return Tables(spark, d).events.agg(F.count_distinct("user_id").alias("ids"), F.count_distinct("event_type").alias("tags"), F.count_if((F.col("event_type") == "purchase") & (k > 90)).alias("crossed"))


@query("msc_23_missed_rate", "with s as (select * from (select *, row_number() over (order by md5(cast(event_id as varchar)), event_id) as k from events) where k <= 500) select count(*) as sampled, count(*) filter (where value > 75) as above, round(count(*) filter (where value > 75) / count(*)::double * (select count(*) from events), 2) as extrapolated from s")
def msc_23(spark, d):
    e = Tables(spark, d).events
    s = e.orderBy(F.md5(F.col("event_id").cast("string").cast("binary")), "event_id").limit(500)
    counts = s.agg(F.count("*").alias("sampled"), F.count_if(F.col("value") > 75).alias("above")).crossJoin(e.agg(F.count("*").alias("all")))
    return counts.select("sampled", "above", F.round(F.col("above") / F.col("sampled") * F.col("all"), 2).alias("extrapolated"))


@query("msc_25_cluster_history", "select l_suppkey, count(*) as lines, min(l_shipdate) as since, max(l_shipdate) as until, (array_agg(l_returnflag order by l_shipdate desc, l_orderkey desc, l_linenumber desc, l_partkey desc, l_returnflag desc))[1] as state from lineitem group by 1")
def msc_25(spark, d):
    last = F.max_by("l_returnflag", F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"))
    return Tables(spark, d).lineitem.groupBy("l_suppkey").agg(F.count("*").alias("lines"), F.min("l_shipdate").alias("since"), F.max("l_shipdate").alias("until"), last.alias("state"))


@query("msc_26_term_coverage", "with t(term) as (values ('the'), ('idiot'), ('zzzz'), ('e')) select term, (select count(*) from documents where contains(lower(text), term)) as caught, round((select count(*) from documents where contains(lower(text), term)) / (select count(*) from documents)::double, 6) as share, (select count(*) from documents where contains(lower(text), term)) / (select count(*) from documents)::double > 0.5 as refused from t")
def msc_26(spark, d):
    terms = spark.createDataFrame([("the",), ("idiot",), ("zzzz",), ("e",)], "term string")
    return P.catch_rate(terms, "term", Tables(spark, d).documents, "text", 0.5)


@query("msc_28_next_question", "select kind, id from (select 1 as p, 'merge' as kind, s_suppkey as id, s_acctbal as o from supplier where s_acctbal < -900 union all select 2, 'unnamed', c_custkey, -c_acctbal from customer where c_acctbal > 9900 union all select 3, 'doubt', p_partkey, p_retailprice from part) order by p, o, id limit 1")
def msc_28(spark, d):
    t = Tables(spark, d)
    merge = t.supplier.where("s_acctbal < -900").select(F.lit(1).alias("p"), F.lit("merge").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("o"))
    unnamed = t.customer.where("c_acctbal > 9900").select(F.lit(2).alias("p"), F.lit("unnamed").alias("kind"), F.col("c_custkey").alias("id"), (-F.col("c_acctbal")).alias("o"))
    doubt = t.part.select(F.lit(3).alias("p"), F.lit("doubt").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("o"))
    return merge.unionByName(unnamed).unionByName(doubt).orderBy("p", "o", "id").limit(1).select("kind", "id")


@query("msc_30_move_counts", "select p_type as side, count(*) as planned, count(distinct p_name || '/' || p_size) as destinations from part group by 1")
def msc_30(spark, d):
    return Tables(spark, d).part.groupBy(F.col("p_type").alias("side")).agg(F.count("*").alias("planned"), F.count_distinct(F.concat_ws("/", "p_name", F.col("p_size").cast("string"))).alias("destinations"))


@query("msc_31_class_moves", "with h as (select md5(text) as h from documents join labels using (doc_id) where toxic = 1 group by 1) select doc_id, 'aside/' || source as dest from documents where md5(text) in (select h from h)")
def msc_31(spark, d):
    t = Tables(spark, d)
    held = t.documents.join(t.labels.where("toxic = 1"), "doc_id").select(_md5().alias("h")).distinct()
    rows = t.documents.withColumn("h", _md5()).join(held, "h", "left_semi")
    return rows.select("doc_id", F.concat_ws("/", F.lit("aside"), "source").alias("dest"))


@query("msc_32_freeable", "with s as (select doc_id, n_chars, md5(text) as h from documents where source in ('src5','src6')), l as (select n_chars, md5(text) as h, min(doc_id) as first_id from documents where source not in ('src5','src6') group by 1, 2) select s.doc_id, l.first_id from s join l on l.n_chars = s.n_chars and l.h = s.h")
def msc_32(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "source", "n_chars", _md5().alias("h"))
    mine = F.col("source").isin("src5", "src6")
    library = docs.where(~mine).groupBy("n_chars", "h").agg(F.min("doc_id").alias("first_id"))
    return docs.where(mine).join(library, ["n_chars", "h"]).select("doc_id", "first_id")


@query("msc_33_deleted_audit", "select p_partkey, case when exists (select 1 from part q where q.p_partkey < 400 and q.p_name = p.p_name and q.p_size = p.p_size) then 'held' when exists (select 1 from part q where q.p_partkey < 400 and q.p_name = p.p_name) then 'other size' else 'lost' end as proof from part p where p_partkey >= 400")
def msc_33(spark, d):
    p = Tables(spark, d).part
    held = p.where("p_partkey < 400")
    rows = p.where("p_partkey >= 400").select("p_partkey", "p_name", "p_size")
    return P.staged(rows, [("held", ["p_name", "p_size"], held), ("other size", ["p_name"], held)], "lost").select("p_partkey", "proof")


@query("msc_34_size_and_name", "select p_partkey, exists (select 1 from part q where q.p_partkey < 500 and q.p_size = p.p_size and split_part(q.p_name, ' ', 2) = split_part(p.p_name, ' ', 2) and q.p_brand = p.p_brand) as evidence from part p where p_partkey >= 500")
def msc_34(spark, d):
    base = F.split_part("p_name", F.lit(" "), F.lit(2)).alias("base")
    p = Tables(spark, d).part.select("p_partkey", "p_size", "p_brand", base)
    rows = P.staged(p.where("p_partkey >= 500"), [("yes", ["p_size", "base", "p_brand"], p.where("p_partkey < 500"))], "no")
    return rows.select("p_partkey", (F.col("proof") == "yes").alias("evidence"))


@query("msc_35_source_held", "select p_partkey, case when p_partkey % 10 = 0 then 'provenance' when exists (select 1 from part q where q.p_partkey < 300 and q.p_name = p.p_name and q.p_size = p.p_size) then 'name and size' when exists (select 1 from part q where q.p_partkey < 300 and q.p_size = p.p_size) then 'size only' else 'none' end as proof from part p where p_partkey >= 300")
def msc_35(spark, d):
    p = Tables(spark, d).part
    held = p.where("p_partkey < 300")
    stages = [("provenance", ["p_partkey"], p.where("p_partkey % 10 = 0")), ("name and size", ["p_name", "p_size"], held), ("size only", ["p_size"], held)]
    return P.staged(p.where("p_partkey >= 300").select("p_partkey", "p_name", "p_size"), stages, "none").select("p_partkey", "proof")


@query("msc_36_reclaimable", "with s as (select doc_id, n_chars, md5(text) as h from documents), l as (select n_chars, md5(text) as h from documents where source = 'src9') select s.doc_id, case when n_chars = 0 then 'UNREADABLE' when doc_id % 13 = 0 then 'HARDLINK' when exists (select 1 from l where l.n_chars = s.n_chars and l.h = s.h) then 'RECLAIMABLE' else 'ONLY' end as verdict from s where doc_id not in (select doc_id from documents where source = 'src9')")
def msc_36(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "source", "n_chars", _md5().alias("h"))
    rows = P.staged(docs.where("source <> 'src9'"), [("yes", ["n_chars", "h"], docs.where("source = 'src9'"))], "no", "_held")
    verdict = F.when(F.col("n_chars") == 0, "UNREADABLE").when(F.col("doc_id") % 13 == 0, "HARDLINK").when(F.col("_held") == "yes", "RECLAIMABLE").otherwise("ONLY")
    return rows.select("doc_id", verdict.alias("verdict"))


@query("msc_37_victims", "select doc_id as victim, survivor from (select doc_id, first_value(doc_id) over (partition by md5(text) order by length(text), doc_id) as survivor from documents) where doc_id <> survivor")
def msc_37(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", _md5().alias("h"))
    best = docs.groupBy("h").agg(F.min("doc_id").alias("survivor"))
    return docs.join(best, "h").where("doc_id <> survivor").select(F.col("doc_id").alias("victim"), "survivor")


@query("msc_38_purge_list", "select o_orderkey from orders where o_orderstatus = 'F' and o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R') and o_custkey in (select c_custkey from customer where c_acctbal > 0)")
def msc_38(spark, d):
    t = Tables(spark, d)
    mirrored = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    listed = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    if mirrored.isEmpty() or listed.isEmpty():
        raise ValueError("a proof set is empty: nothing may be purged")
    return t.orders.where("o_orderstatus = 'F'").join(mirrored, "o_orderkey", "left_semi").join(listed, "o_custkey", "left_semi").select("o_orderkey")


@query("msc_39_stage_originals", "with x as (select md5(text) as h, min(doc_id) as doc_id, case when bool_or(source = 'src1') then 'exclude' when bool_or(source = 'src2') then 'scratch' else 'take' end as tag from documents group by 1) select tag, count(*) as n from x where doc_id not in (select doc_id from labels where toxic = 1) group by 1")
def msc_39(spark, d):
    t = Tables(spark, d)
    s = F.col("source")
    x = t.documents.groupBy(_md5().alias("h")).agg(F.min("doc_id").alias("doc_id"), F.when(F.bool_or(s == "src1"), "exclude").when(F.bool_or(s == "src2"), "scratch").otherwise("take").alias("tag"))
    return x.join(t.labels.where("toxic = 1"), "doc_id", "left_anti").groupBy("tag").agg(F.count("*").alias("n"))


@query("msc_40_copy_proof", "select a.doc_id, case when b.doc_id is null then 'MISSING' when md5(a.text) = md5(b.text) then 'OK' else 'MISMATCH' end as proof from documents a left join documents b on b.doc_id = case when a.doc_id % 17 = 0 then a.doc_id + 1 when a.doc_id % 19 = 0 then -1 else a.doc_id end")
def msc_40(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", _md5().alias("h"))
    k = F.col("doc_id")
    source = docs.withColumn("k", F.when(k % 17 == 0, k + 1).when(k % 19 == 0, -1).otherwise(k))
    rows = source.join(docs.select(F.col("doc_id").alias("k"), F.col("h").alias("again")), "k", "left")
    return rows.select("doc_id", F.when(F.col("again").isNull(), "MISSING").when(F.col("h") == F.col("again"), "OK").otherwise("MISMATCH").alias("proof"))


@query("msc_41_named_checks", "select 'keys' as name, count(*) = count(distinct o_orderkey) as passed from orders union all select 'customers', (select count(*) from orders where o_custkey not in (select c_custkey from customer)) = 0 union all select 'prices', min(o_totalprice) > 0 from orders")
def msc_41(spark, d):
    t = Tables(spark, d)
    lost = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left_anti").agg((F.count("*") == 0).alias("customers"))
    row = t.orders.agg((F.count("*") == F.count_distinct("o_orderkey")).alias("keys"), (F.min("o_totalprice") > 0).alias("prices")).crossJoin(lost)
    return row.selectExpr("stack(3, 'keys', keys, 'customers', customers, 'prices', prices) as (name, passed)")


@query("msc_42_removals", "select c_custkey, case when c_custkey % 20 = 0 then 'already gone' when c_custkey in (select o_custkey from orders where o_orderstatus = 'F') then 'remove' else 'no keeper' end as outcome from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P' and o_orderpriority = '5-LOW')")
def msc_42(spark, d):
    t = Tables(spark, d)
    done = t.orders.where("o_orderstatus = 'P' and o_orderpriority = '5-LOW'").select(F.col("o_custkey").alias("c_custkey"))  # the journal of earlier runs
    keeper = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    rows = P.staged(t.customer.select("c_custkey").join(done, "c_custkey", "left_anti"), [("already gone", ["c_custkey"], t.customer.where("c_custkey % 20 = 0")), ("remove", ["c_custkey"], keeper)], "no keeper", "outcome")
    return rows.select("c_custkey", "outcome")


@query("msc_43_sampled_verdicts", "with last as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as k from events), s as (select * from last where k = 1 and substr(md5(cast(user_id as varchar)), 1, 1) < '5') select case when value > 100 then 'large' when event_type = 'error' then 'failed' else 'ok' end as verdict, count(*) as n from s group by 1")
def msc_43(spark, d):
    last = A.latest(Tables(spark, d).events, ["user_id"], "ts", "event_id").where("substr(md5(cast(user_id as string)), 1, 1) < '5'")  # a sample by hash, as the check asks for
    return last.groupBy(F.when(F.col("value") > 100, "large").when(F.col("event_type") == "error", "failed").otherwise("ok").alias("verdict")).agg(F.count("*").alias("n"))


@query("msc_44_copy_budget", "with m as (select doc_id, lang, n_chars from documents where md5(text) not in (select md5(text) from documents where source = 'src8') and source <> 'src8'), r as (select *, sum(n_chars) over (order by doc_id rows unbounded preceding) as run from m) select doc_id, lang, n_chars from r where run <= 500000")
def msc_44(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "source", "lang", "n_chars", _md5().alias("h"))
    missing = docs.where("source <> 'src8'").join(docs.where("source = 'src8'").select("h"), "h", "left_anti")
    return P.within_budget(missing, "n_chars", 500_000, "doc_id").select("doc_id", "lang", "n_chars")


@query("msc_45_state_counters", "select (select count(*) from events) as lines, (select count(*) from events where event_type = 'error') as errors, (select cast(sum(n_chars) as bigint) from documents where lang = 'en') as freed")
def msc_45(spark, d):
    t = Tables(spark, d)
    e = t.events.agg(F.count("*").alias("lines"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return e.crossJoin(t.documents.where("lang = 'en'").agg(F.sum("n_chars").alias("freed")))


@query("msc_46_reprobe", "select count(*) as sampled, count(*) filter (where length(text) = n_chars) as same from documents")
def msc_46(spark, d):
    return Tables(spark, d).documents.agg(F.count("*").alias("sampled"), F.count_if(F.length("text") == F.col("n_chars")).alias("same"))


@query("msc_47_access", "select c_custkey, case when c_acctbal < 0 then 'refused' when c_acctbal < 1000 then 'asked' when p.pin is null then 'welcome' else 'member' end as step from customer left join (select o_custkey, min(o_orderkey) as pin from orders where o_orderpriority = '1-URGENT' group by 1) p on p.o_custkey = c_custkey")
def msc_47(spark, d):
    t = Tables(spark, d)
    pins = t.orders.where("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderkey").alias("pin"))
    b = F.col("c_acctbal")
    return t.customer.join(pins, "c_custkey", "left").select("c_custkey", F.when(b < 0, "refused").when(b < 1000, "asked").when(F.col("pin").isNull(), "welcome").otherwise("member").alias("step"))


QUERIES, SQL = query.queries, query.sql
