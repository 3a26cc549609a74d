"""Queries of section JOI: joins."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fernglass.functions import text, values
from fernglass.operators import joins
from fernglass.plans.base import Family, Tables

query = Family()


@query("joi_01_left_fields", "select c_custkey, o_orderkey, o_orderstatus from customer left join orders on c_custkey = o_custkey and o_totalprice > 400000")
def joi_01(spark, d):
    t = Tables(spark, d)
    big = t.orders.where("o_totalprice > 400000")
    return t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey", "o_orderstatus")


@query("joi_02_inner_dedup", "select distinct d.doc_id, d.source, l.quality from documents d join labels l using (doc_id)")
def joi_02(spark, d):
    t = Tables(spark, d)
    return t.documents.join(t.labels, "doc_id").select("doc_id", "source", "quality").dropDuplicates()


@query("joi_03_alternate_keys", "select c_custkey, coalesce(n1.n_name, n2.n_name) as place from customer left join nation n1 on n1.n_nationkey = c_nationkey and n1.n_nationkey < 10 left join nation n2 on n2.n_nationkey = c_custkey % 25")
def joi_03(spark, d):
    t = Tables(spark, d)
    one = t.nation.where("n_nationkey < 10").select(F.col("n_nationkey").alias("k1"), F.col("n_name").alias("name1"))
    two = t.nation.select(F.col("n_nationkey").alias("k2"), F.col("n_name").alias("name2"))
    c = t.customer.join(one, F.col("c_nationkey") == F.col("k1"), "left").join(two, F.col("c_custkey") % 25 == F.col("k2"), "left")
    return c.select("c_custkey", F.coalesce("name1", "name2").alias("place"))


@query("joi_04_chain", "select r_name, cast(count(*) as bigint) as n from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by r_name")
def joi_04(spark, d):
    t = Tables(spark, d)
    chain = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return chain.groupBy("r_name").agg(F.count("*").alias("n"))


@query("joi_05_total_join", "select (select count(*) from lineitem l join orders o on l.l_orderkey = o.o_orderkey) as joined, (select count(*) from lineitem l where not exists (select 1 from orders o where o.o_orderkey = l.l_orderkey)) as lost")
def joi_05(spark, d):
    t = Tables(spark, d)
    joined, lost = joins.complete(t.lineitem.select(F.col("l_orderkey").alias("k")), t.orders.select(F.col("o_orderkey").alias("k")), ["k"])
    return joined.agg(F.count("*").alias("joined")).crossJoin(lost.agg(F.count("*").alias("lost")))


@query("joi_06_fallback", """
with exact as (select c_custkey as k, c_mktsegment as v from customer where c_custkey % 3 = 0),
byn as (select c_nationkey as nk, min(c_mktsegment) as v from customer where c_custkey < 60 group by 1 having min(c_mktsegment) = max(c_mktsegment))
select c.c_custkey as k, coalesce(e.v, b.v) as v, case when e.v is not null then 'exact' when b.v is not null then 'nation' else 'none' end as kind
from customer c left join exact e on e.k = c.c_custkey left join byn b on b.nk = c.c_nationkey""")
def joi_06(spark, d):
    c = Tables(spark, d).customer.select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nk"), F.col("c_mktsegment").alias("v"))
    return joins.with_fallback(c.select("k", "nk"), [("exact", ["k"], c.where("k % 3 = 0").select("k", "v")), ("nation", ["nk"], c.where("k < 60").select("nk", "v"))], "v").select("k", "v", "kind")


@query("joi_07_bind", """
with f as (select doc_id, md5(text) as h, source from documents), r as (
 select a.doc_id, b.doc_id as target, row_number() over (partition by a.doc_id order by (a.source = b.source) desc, b.doc_id) as k from f a join f b on a.h = b.h and a.doc_id > b.doc_id)
select doc_id, target from r where k = 1""")
def joi_07(spark, d):
    f = Tables(spark, d).documents.select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"), "source")
    b = f.select(F.col("doc_id").alias("target"), "h", F.col("source").alias("s2"))
    best = F.max_by(F.col("target"), F.struct((F.col("source") == F.col("s2")).alias("same"), (-F.col("target")).alias("least")))
    return f.join(b, "h").where("doc_id > target").groupBy("doc_id").agg(best.alias("target"))


@query("joi_08_semi", "select o_orderkey from orders where exists (select 1 from lineitem where l_orderkey = o_orderkey and l_quantity = 50)")
def joi_08(spark, d):
    t = Tables(spark, d)
    return t.orders.join(t.lineitem.where("l_quantity = 50"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@query("joi_09_anti", "select doc_id from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def joi_09(spark, d):
    t = Tables(spark, d)
    return t.documents.join(t.labels, "doc_id", "left_anti").select("doc_id")


@query("joi_10_division", "select l_orderkey from lineitem where l_returnflag in ('A','N','R') group by l_orderkey having count(distinct l_returnflag) = 3")
def joi_10(spark, d):
    return joins.holding_all(Tables(spark, d).lineitem, "l_orderkey", "l_returnflag", ["A", "N", "R"])


@query("joi_11_division_nested", "select distinct o.user_id from events o where not exists (select 1 from (values (0),(1),(2),(3),(4),(5),(6)) w(day) where not exists (select 1 from events e where e.user_id = o.user_id and e.event_type = 'purchase' and dayofweek(e.ts) = w.day))")
def joi_11(spark, d):
    bought = Tables(spark, d).events.where("event_type = 'purchase'").select("user_id", (F.dayofweek("ts") - 1).alias("day"))
    return joins.holding_all(bought, "user_id", "day", list(range(7)))


@query("joi_12_rules", """
with rules(rule, pattern, low, high) as (values ('r1','^red', 0, 20), ('r2','ring$', 10, 50), ('r3','bolt', 45, 50))
select distinct p_partkey from part join rules on regexp_matches(p_name, pattern) and p_size >= low and p_size < high""")
def joi_12(spark, d):
    rules = spark.createDataFrame([("^red", 0, 20), ("ring$", 10, 50), ("bolt", 45, 50)], "pattern string, low int, high int")
    return Tables(spark, d).part.join(rules, F.expr("p_name rlike pattern") & (F.col("p_size") >= F.col("low")) & (F.col("p_size") < F.col("high")), "left_semi").select("p_partkey")


NEARBY = """select v.event_id from events v where v.event_type = 'view' and exists (select 1 from events p where p.event_type = 'purchase' and p.user_id = v.user_id and abs(epoch_us(v.ts) - epoch_us(p.ts)) <= 7200000000)"""


@query("joi_13_band", NEARBY)
def joi_13(spark, d):
    e = Tables(spark, d).events
    return joins.near_in_time(e.where("event_type = 'view'"), e.where("event_type = 'purchase'"), "user_id", "ts", 120).select("event_id")


@query("joi_14_unnest", "select doc_id, w from (select doc_id, unnest(string_split(source, 'r')) as w from documents)")
def joi_14(spark, d):
    return Tables(spark, d).documents.select("doc_id", F.explode(F.split("source", "r")).alias("w"))


@query("joi_15_flag", "select v.event_id, exists (select 1 from events p where p.event_type = 'purchase' and p.user_id = v.user_id and abs(epoch_us(v.ts) - epoch_us(p.ts)) <= 7200000000) as near from events v where v.event_type = 'view'")
def joi_15(spark, d):
    e = Tables(spark, d).events
    views = e.where("event_type = 'view'")
    near = joins.near_in_time(views, e.where("event_type = 'purchase'"), "user_id", "ts", 120).select("event_id", F.lit(True).alias("near"))
    return views.select("event_id").join(near, "event_id", "left").select("event_id", F.coalesce("near", F.lit(False)).alias("near"))


@query("joi_16_scalar", "select event_id from events, (select max(ts) - interval 2 day as since from events) w where ts > since")
def joi_16(spark, d):
    e = Tables(spark, d).events
    bound = e.agg((F.max("ts") - F.expr("interval 2 days")).alias("since"))  # one row
    return e.join(bound, F.col("ts") > F.col("since")).select("event_id")


@query("joi_17_cover", "select c_nationkey, (select min(c2.c_custkey) from customer c2 where c2.c_nationkey = c.c_nationkey and c2.c_acctbal = max(c.c_acctbal)) as cover from customer c group by c_nationkey")
def joi_17(spark, d):
    return Tables(spark, d).customer.groupBy("c_nationkey").agg(F.max_by("c_custkey", F.struct("c_acctbal", -F.col("c_custkey"))).alias("cover"))


@query("joi_18_array_join", "select distinct a.o_custkey from orders a join (select unnest([11, 99, 500, 1201]) as k) b on a.o_custkey = b.k")
def joi_18(spark, d):
    t = Tables(spark, d)
    held = spark.createDataFrame([([11, 99, 500, 1201],)], "keys array<bigint>").select(F.explode("keys").alias("o_custkey"))
    return t.orders.join(held, "o_custkey").select("o_custkey").distinct()


@query("joi_19_size_gate", "select a.doc_id from documents a where a.doc_id % 2 = 0 and exists (select 1 from documents b where b.doc_id % 2 = 1 and b.n_chars = a.n_chars and md5(b.text) = md5(a.text))")
def joi_19(spark, d):
    docs = Tables(spark, d).documents
    return joins.by_size_then_digest(docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1"), "n_chars", "text").select("doc_id")


@query("joi_20_pair_membership", "select p.p_partkey from part p where not exists (select 1 from part q where q.p_partkey < 200 and q.p_name = p.p_name and q.p_size = p.p_size)")
def joi_20(spark, d):
    p = Tables(spark, d).part
    return p.join(p.where("p_partkey < 200").select("p_name", "p_size"), ["p_name", "p_size"], "left_anti").select("p_partkey")


@query("joi_21_folded_path", "select c_custkey, s_suppkey from customer join supplier on lower(replace(c_name, 'Customer', 'X')) = lower(replace(s_name, 'SUPPLIER', 'x')) or lower(replace(c_name, 'Customer', 'X')) = replace(lower(s_name), 'supplier', 'x')")
def joi_21(spark, d):
    t = Tables(spark, d)
    key = lambda c, word: F.lower(F.regexp_replace(c, f"(?i){word}", "X"))
    return t.customer.withColumn("k", key("c_name", "customer")).join(t.supplier.withColumn("k", key("s_name", "supplier")), "k").select("c_custkey", "s_suppkey")


@query("joi_22_rename", "select page_id, case when starts_with(url, 'https://m.') then 'secure/mobile/' || substr(url, 11) when starts_with(url, 'https://') then 'secure/' || substr(url, 9) when starts_with(url, 'http://') then 'plain/' || substr(url, 8) else url end as path from pages")
def joi_22(spark, d):
    renames = {"https://": "secure/", "http://": "plain/", "https://m.": "secure/mobile/"}
    return Tables(spark, d).pages.select("page_id", joins.rename_prefixes(F.col("url"), renames).alias("path"))


@query("joi_23_near_pairs", "with n as (select distinct p_name as name from part) select a.name as a, b.name as b from n a join n b on a.name < b.name and levenshtein(a.name, b.name) <= case when length(a.name) >= 9 then 3 when length(a.name) >= 5 then 2 when length(a.name) >= 3 then 1 else 0 end and abs(length(a.name) - length(b.name)) <= 3")
def joi_23(spark, d):
    return joins.close_pairs(Tables(spark, d).part, "p_name", {3: 1, 5: 2, 9: 3})


@query("joi_24_condition_in_on", "select o_orderkey, l_linenumber from orders left join lineitem on l_orderkey = o_orderkey and o_orderstatus = 'F' and l_quantity >= 49")
def joi_24(spark, d):
    t = Tables(spark, d)
    on = (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("o_orderstatus") == "F") & (F.col("l_quantity") >= 49)
    return t.orders.join(t.lineitem, on, "left").select("o_orderkey", "l_linenumber")


@query("joi_25_time_in_on", "select c_custkey, cast(count(o_orderkey) as bigint) as recent from customer left join orders on o_custkey = c_custkey and o_orderdate > timestamp '2001-06-01' group by c_custkey")
def joi_25(spark, d):
    t = Tables(spark, d)
    on = (F.col("o_custkey") == F.col("c_custkey")) & (F.col("o_orderdate") > F.lit("2001-06-01").cast("timestamp_ntz"))
    return t.customer.join(t.orders, on, "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("recent"))


@query("joi_26_parents", """
with recursive n as (select c_custkey as id, case when c_custkey > 0 then c_custkey // 3 end as parent, c_mktsegment as name from customer),
p as (select id, parent, name as path, id as leaf from n union all select n.id, n.parent, n.name || '/' || p.path, p.leaf from p join n on n.id = p.parent)
select leaf as id, path from p where parent is null""")
def joi_26(spark, d):
    c = Tables(spark, d).customer
    nodes = c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") > 0, F.floor(F.col("c_custkey") / 3)).alias("parent"), F.col("c_mktsegment").alias("name"))
    return joins.resolve_paths(nodes, 16)


@query("joi_27_latest_outcome", """
with last as (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as k from events)
select user_id, event_type, case when value > 100 then 'large' when json_extract_string(props, '$.k')::int > 50 then 'high' when event_type = 'error' then 'failed' else 'plain' end as outcome from last where k = 1""")
def joi_27(spark, d):
    w = Window.partitionBy("user_id", "event_type").orderBy(F.desc("ts"), F.desc("event_id"))
    last = Tables(spark, d).events.withColumn("k", F.row_number().over(w)).where("k = 1")
    outcome = F.when(F.col("value") > 100, "large").when(F.get_json_object("props", "$.k").try_cast("int") > 50, "high").when(F.col("event_type") == "error", "failed").otherwise("plain")
    return last.select("user_id", "event_type", outcome.alias("outcome"))


@query("joi_28_scopes", """
with files as (select o_orderkey as hash, o_orderstatus || '/' || o_orderpriority as folder, o_orderpriority as origin, cast(o_custkey % 50 as varchar) as cluster from orders),
answers(answer_id, scope, target) as (values (1,'file','17'), (2,'folder','F'), (3,'folder','O/2-HIGH'), (4,'origin','5-LOW'), (5,'cluster','7'), (6,'all',''))
select distinct answer_id, hash from (
 select answer_id, hash from answers join files on scope = 'file' and target = cast(hash as varchar)
 union all select answer_id, hash from answers join files on scope = 'folder' and (folder = target or starts_with(folder, target || '/'))
 union all select answer_id, hash from answers join files on scope = 'origin' and origin = target
 union all select answer_id, hash from answers join files on scope = 'cluster' and cluster = target
 union all select answer_id, hash from answers join files on scope = 'all')""")
def joi_28(spark, d):
    o = Tables(spark, d).orders
    files = o.select(F.col("o_orderkey").alias("hash"), F.concat_ws("/", "o_orderstatus", "o_orderpriority").alias("folder"), F.col("o_orderpriority").alias("origin"), (F.col("o_custkey") % 50).cast("string").alias("cluster"))
    answers = spark.createDataFrame([(1, "file", "17"), (2, "folder", "F"), (3, "folder", "O/2-HIGH"), (4, "origin", "5-LOW"), (5, "cluster", "7"), (6, "all", "")], "answer_id int, scope string, target string")
    reached = joins.expand_scopes(answers, files.withColumn("hash", F.col("hash").cast("string")))
    return reached.select("answer_id", F.col("hash").cast("bigint").alias("hash"))


@query("joi_29_box_match", """
with b as (select l_orderkey as photo, l_linenumber as box, l_discount as x, l_tax as y, 0.05 + l_quantity / 500 as w, 0.05 + l_quantity / 400 as h from lineitem where l_linenumber <= 6),
p as (select a.photo, a.box as old, c.box as new, greatest(0, least(a.x+a.w, c.x+c.w) - greatest(a.x, c.x)) * greatest(0, least(a.y+a.h, c.y+c.h) - greatest(a.y, c.y)) as i, a.w*a.h + c.w*c.h as s from b a join b c on a.photo = c.photo and a.box <= 3 and c.box > 3),
q as (select *, i / (s - i) as iou from p), r as (select *, row_number() over (partition by photo, old order by iou desc, new) as k1, row_number() over (partition by photo, new order by iou desc, old) as k2 from q where iou >= 0.3)
select photo, old, new from r where k1 = 1 and k2 = 1""")
def joi_29(spark, d):
    q = F.col("l_quantity")
    b = Tables(spark, d).lineitem.where("l_linenumber <= 6").select(F.col("l_orderkey").alias("photo"), F.col("l_linenumber").alias("box"), F.col("l_discount").alias("x"), F.col("l_tax").alias("y"), (0.05 + q / 500).alias("w"), (0.05 + q / 400).alias("h"))
    c = b.where("box > 3").toDF("photo", "new", "x2", "y2", "w2", "h2")
    iou = values.overlap([F.col(k) for k in "xywh"], [F.col(f"{k}2") for k in "xywh"])
    pairs = b.where("box <= 3").withColumnRenamed("box", "old").join(c, "photo").withColumn("iou", iou).where("iou >= 0.3")
    return joins.best_of_each_other(pairs, "photo", "old", "new", "iou")


@query("joi_30_absence", """
select d.doc_id, case when exists (select 1 from labels l where l.doc_id = d.doc_id and l.toxic = 1) then 'toxic' when exists (select 1 from labels l where l.doc_id = d.doc_id and l.quality = 0) then 'poor' when exists (select 1 from documents e where e.doc_id < d.doc_id and e.text = d.text) then 'copy' else 'unexplained' end as reason from documents d""")
def joi_30(spark, d):
    t = Tables(spark, d)
    first = t.documents.groupBy(F.md5(F.col("text").cast("binary")).alias("h")).agg(F.min("doc_id").alias("least"))
    copy = t.documents.select("doc_id", F.md5(F.col("text").cast("binary")).alias("h")).join(first, "h").where("doc_id > least")
    return joins.explain_absence(t.documents.select("doc_id"), "doc_id", [("toxic", t.labels.where("toxic = 1")), ("poor", t.labels.where("quality = 0")), ("copy", copy)])


QUERIES, SQL = query.queries, query.sql
