"""Queries of sections AGG, WIN and TOP."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fernglass.functions import values
from fernglass.operators import aggregates as A
from fernglass.plans.base import Family, Tables

query = Family()
TYPES = ["click", "error", "purchase", "signup", "view"]


@query("agg_01_pivot", "select user_id, max(case when event_type='click' then value end) as click, max(case when event_type='error' then value end) as error, max(case when event_type='purchase' then value end) as purchase, max(case when event_type='signup' then value end) as signup, max(case when event_type='view' then value end) as view from events group by user_id")
def agg_01(spark, d):
    return A.pivot_wide(Tables(spark, d).events, "user_id", "event_type", "value", TYPES)


@query("agg_02_counts", "select o_orderstatus, count(*) as n, count(distinct o_custkey) as customers from orders group by o_orderstatus")
def agg_02(spark, d):
    return Tables(spark, d).orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"))


@query("agg_03_filtered", "select user_id, count(*) filter (where event_type='click') as yes, count(*) filter (where event_type='error') as no from events group by user_id")
def agg_03(spark, d):
    return Tables(spark, d).events.groupBy("user_id").agg(F.count_if(F.col("event_type") == "click").alias("yes"), F.count_if(F.col("event_type") == "error").alias("no"))


@query("agg_04_having_scalar", "select o_custkey, count(*) as n from orders group by o_custkey having count(*) >= (select count(*) / count(distinct o_custkey) * 1.5 from orders)")
def agg_04(spark, d):
    o = Tables(spark, d).orders
    bound = o.agg((F.count("*") / F.count_distinct("o_custkey") * 1.5).alias("least"))
    return o.groupBy("o_custkey").agg(F.count("*").alias("n")).join(bound, F.col("n") >= F.col("least")).select("o_custkey", "n")


@query("agg_05_mode", "select c_nationkey, c_mktsegment as segment from (select c_nationkey, c_mktsegment, row_number() over (partition by c_nationkey order by count(*) desc, c_mktsegment) as k from customer group by 1, 2) where k = 1")
def agg_05(spark, d):
    return A.mode_of(Tables(spark, d).customer, ["c_nationkey"], "c_mktsegment", "segment")


@query("agg_06_bool_or", "select o_custkey, bool_or(o_orderpriority = '1-URGENT') as urgent from orders group by o_custkey")
def agg_06(spark, d):
    return Tables(spark, d).orders.groupBy("o_custkey").agg(F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))


@query("agg_07_latest_filtered", "select user_id, (array_agg(value order by ts desc, event_id desc) filter (where event_type = 'purchase'))[1] as last from events group by user_id")
def agg_07(spark, d):
    bought = F.col("event_type") == "purchase"
    return Tables(spark, d).events.groupBy("user_id").agg(F.max_by(F.when(bought, F.col("value")), F.when(bought, F.struct("ts", "event_id"))).alias("last"))


@query("agg_08_joined_names", "select o_custkey, string_agg(distinct o_orderpriority, '; ' order by o_orderpriority) as priorities from orders group by o_custkey")
def agg_08(spark, d):
    return Tables(spark, d).orders.groupBy("o_custkey").agg(A.joined_names("o_orderpriority").alias("priorities"))


@query("agg_09_min_max", "select l_suppkey, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship, min(l_quantity) as least, max(l_extendedprice) as most from lineitem group by l_suppkey")
def agg_09(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_suppkey").agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"), F.min("l_quantity").alias("least"), F.max("l_extendedprice").alias("most"))


@query("agg_10_centroid", "select label, cast(i as int) as i, round(avg(embedding[i]::double), 6) as x from embeddings, range(1, 65) t(i) group by label, i")
def agg_10(spark, d):
    centres = A.mean_vectors(Tables(spark, d).embeddings, ["label"], "embedding")
    return centres.select("label", F.posexplode("centre").alias("p", "v")).select("label", (F.col("p") + 1).alias("i"), F.round("v", 6).alias("x"))


@query("agg_11_weighted_centroid", "select label % 3 as g, cast(i as int) as i, round(sum(embedding[i]::double * (1 + vec_id % 5)) / sum(1 + vec_id % 5), 6) as x from embeddings, range(1, 65) t(i) group by 1, i")
def agg_11(spark, d):
    e = Tables(spark, d).embeddings.withColumn("g", F.col("label") % 3)
    centres = A.mean_vectors(e, ["g"], "embedding", 1 + F.col("vec_id") % 5)
    return centres.select("g", F.posexplode("centre").alias("p", "v")).select("g", (F.col("p") + 1).alias("i"), F.round("v", 6).alias("x"))


@query("agg_12_top_values", "select o_custkey, list(o_orderpriority order by k) as top from (select o_custkey, o_orderpriority, row_number() over (partition by o_custkey order by count(*) desc, o_orderpriority) as k from orders group by 1, 2) where k <= 2 group by o_custkey")
def agg_12(spark, d):
    return A.top_values(Tables(spark, d).orders, ["o_custkey"], "o_orderpriority", 2)


@query("agg_13_longest", "select p_brand, (array_agg(p_name order by length(p_name) desc, p_name desc))[1] as longest from part group by p_brand")
def agg_13(spark, d):
    return Tables(spark, d).part.groupBy("p_brand").agg(F.max_by("p_name", F.struct(F.length("p_name"), "p_name")).alias("longest"))


@query("agg_14_rollup", "select source, count(*) as n, cast(sum(n_chars) as bigint) as chars, min(lang) || '-' || max(lang) as span, count(*) filter (where lang='en') as english from documents group by source")
def agg_14(spark, d):
    return Tables(spark, d).documents.groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.concat_ws("-", F.min("lang"), F.max("lang")).alias("span"), F.count_if(F.col("lang") == "en").alias("english"))


@query("agg_15_multi_key", "select p_brand, p_type, regexp_replace(p_name, '[aeiou]', 'v', 'g') as shape, count(*) as n from part group by 1, 2, 3")
def agg_15(spark, d):
    return Tables(spark, d).part.groupBy("p_brand", "p_type", F.regexp_replace("p_name", "[aeiou]", "v").alias("shape")).agg(F.count("*").alias("n"))


COVER = """
with j as (select d.doc_id, d.source, l.quality, l.toxic from documents d left join labels l using (doc_id))
select 'quality' as field, count(*) filter (where quality is not null) as filled, count(*) as applicable, round(count(*) filter (where quality is not null) / count(*)::double, 4) as share from j
union all select 'toxic', count(*) filter (where toxic is not null and quality = 1), count(*) filter (where quality = 1), round(count(*) filter (where toxic is not null and quality = 1) / (count(*) filter (where quality = 1))::double, 4) from j
union all select 'source', count(*) filter (where source <> ''), count(*), round(count(*) filter (where source <> '') / count(*)::double, 4) from j"""


@query("agg_16_coverage", COVER)
def agg_16(spark, d):
    t = Tables(spark, d)
    return A.coverage(t.documents.join(t.labels, "doc_id", "left"), {"quality": None, "toxic": F.col("quality") == 1, "source": None})


@query("agg_17_completeness", "select d.source, round(avg((l.quality is not null)::int), 4) as complete from documents d left join labels l using (doc_id) group by d.source")
def agg_17(spark, d):
    t = Tables(spark, d)
    return t.documents.join(t.labels, "doc_id", "left").groupBy("source").agg(F.round(F.sum(F.col("quality").isNotNull().cast("int")) / F.count("*"), 4).alias("complete"))


@query("agg_18_mean_and_sources", "select l_orderkey, round(avg(l_discount), 8) as mean, list_sort(list(distinct l_returnflag)) as sources from lineitem group by l_orderkey")
def agg_18(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_orderkey").agg(F.round(F.avg("l_discount"), 8).alias("mean"), F.array_sort(F.collect_set("l_returnflag")).alias("sources"))


@query("agg_19_contested", "select l_orderkey, count(distinct l_linestatus) > 1 as contested, string_agg(distinct l_linestatus, ',' order by l_linestatus) as said from lineitem group by l_orderkey")
def agg_19(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_orderkey").agg((F.count_distinct("l_linestatus") > 1).alias("contested"), A.joined_names("l_linestatus", ",").alias("said"))


@query("agg_20_majority", "select o_custkey, case when count(*) filter (where o_orderstatus='F') > count(*) filter (where o_orderstatus='O') then 'shared' else 'own' end as side from orders group by o_custkey")
def agg_20(spark, d):
    s = F.col("o_orderstatus")
    return Tables(spark, d).orders.groupBy("o_custkey").agg(F.when(F.count_if(s == "F") > F.count_if(s == "O"), "shared").otherwise("own").alias("side"))


@query("agg_21_once_per_inode", "with i as (select p_brand, p_size, max(p_retailprice) as bytes, bool_or(p_type='PROMO') as promo from part group by 1, 2) select case when promo then 'promo' else 'plain' end as category, count(*) as inodes, round(sum(bytes), 2) as bytes from i group by 1")
def agg_21(spark, d):
    inodes = Tables(spark, d).part.groupBy("p_brand", "p_size").agg(F.max("p_retailprice").alias("b"), F.bool_or(F.col("p_type") == "PROMO").alias("promo"))
    return inodes.groupBy(F.when(F.col("promo"), "promo").otherwise("plain").alias("category")).agg(F.count("*").alias("inodes"), F.round(F.sum("b"), 2).alias("bytes"))


@query("agg_22_distinct_content", "with h as (select md5(text) as h, any_value(n_chars) as c, count(*) as copies from documents group by 1) select cast(sum(c) as bigint) as distinct_chars, cast(sum(c * copies) as bigint) as all_chars, max(copies) as most from h")
def agg_22(spark, d):
    per = Tables(spark, d).documents.groupBy(F.md5(F.col("text").cast("binary")).alias("h")).agg(F.first("n_chars").alias("c"), F.count("*").alias("copies"))
    return per.agg(F.sum("c").alias("distinct_chars"), F.sum(F.col("c") * F.col("copies")).alias("all_chars"), F.max("copies").alias("most"))


@query("agg_23_duplicates", "select md5(text) as h, count(*) as n, min(doc_id) as first_id from documents group by 1 having count(*) > 1")
def agg_23(spark, d):
    return Tables(spark, d).documents.groupBy(F.md5(F.col("text").cast("binary")).alias("h")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query("agg_24_status_precedence", "select user_id, case when bool_or(event_type='error' and value > 60) then 'held' when bool_or(event_type='error') then 'error' when bool_and(event_type in ('view','click')) then 'pending' else 'complete' end as status from events group by user_id")
def agg_24(spark, d):
    e = Tables(spark, d).events
    error = F.col("event_type") == "error"
    status = F.when(F.bool_or(error & (F.col("value") > 60)), "held").when(F.bool_or(error), "error").when(F.bool_and(F.col("event_type").isin("view", "click")), "pending").otherwise("complete")
    return e.groupBy("user_id").agg(status.alias("status"))


@query("agg_25_most_severe", "select o_custkey, case when list_contains(list(o_orderpriority), '1-URGENT') then 'urgent' when list_contains(list(o_orderpriority), '2-HIGH') then 'high' else 'other' end as worst from orders group by o_custkey")
def agg_25(spark, d):
    per = Tables(spark, d).orders.groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("all"))
    return per.select("o_custkey", F.when(F.exists("all", lambda x: x == "1-URGENT"), "urgent").when(F.exists("all", lambda x: x == "2-HIGH"), "high").otherwise("other").alias("worst"))


@query("agg_26_decades", "select cast(year(o_orderdate) // 10 * 10 as int) as decade, count(*) as n from orders group by 1")
def agg_26(spark, d):
    return Tables(spark, d).orders.groupBy(values.decade(F.year("o_orderdate")).alias("decade")).agg(F.count("*").alias("n"))


@query("agg_27_bundle", "select count(*) as n, count(*) filter (where event_type='error') as errors, count(distinct user_id) as users, round(sum(value), 2) as total from events")
def agg_27(spark, d):
    return Tables(spark, d).events.agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), F.count_distinct("user_id").alias("users"), F.round(F.sum("value"), 2).alias("total"))


@query("agg_28_watermark", "select coalesce(max(ts) filter (where event_type='none'), timestamp '1970-01-01') as mark, coalesce(max(ts), timestamp '1970-01-01') as last from events")
def agg_28(spark, d):
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return Tables(spark, d).events.agg(F.coalesce(F.max(F.when(F.col("event_type") == "none", F.col("ts"))), epoch).alias("mark"), F.coalesce(F.max("ts"), epoch).alias("last"))


@query("agg_29_only_one", "select o_orderkey, count(*) over (partition by o_custkey) = 1 as only from orders")
def agg_29(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", (F.count("*").over(Window.partitionBy("o_custkey")) == 1).alias("only"))


@query("agg_30_cost", "select role, cast(sum(length(text)) as bigint) as chars, round(sum(length(text)) * 0.25 / 1000000 * 3, 8) as cost from conversations group by role")
def agg_30(spark, d):
    return Tables(spark, d).conversations.groupBy("role").agg(F.sum(F.length("text")).cast("bigint").alias("chars"), F.round(F.sum(F.length("text")) * 0.25 / 1_000_000 * 3, 8).alias("cost"))


LOO = """
with v as (select user_id, event_type as model, case when value > 50 then 'high' else 'low' end as said from events where event_type in ('click','view','purchase')),
m as (select user_id, model, max(said) as said from v group by 1, 2),
o as (select a.user_id, a.model, a.said, count(*) filter (where b.said = 'high') as h, count(*) filter (where b.said = 'low') as l from m a join m b on a.user_id = b.user_id and a.model <> b.model group by 1, 2, 3)
select model, count(*) as judged, count(*) filter (where (h >= 2 and said = 'high') or (l >= 2 and said = 'low')) as agreed from o where h >= 2 or l >= 2 group by model"""


@query("agg_31_leave_one_out", LOO)
def agg_31(spark, d):
    e = Tables(spark, d).events.where(F.col("event_type").isin("click", "view", "purchase"))
    m = e.groupBy("user_id", F.col("event_type").alias("model")).agg(F.max(F.when(F.col("value") > 50, "high").otherwise("low")).alias("said"))
    w = Window.partitionBy("user_id")
    high = F.count_if(F.col("said") == "high").over(w) - (F.col("said") == "high").cast("int")
    low = F.count_if(F.col("said") == "low").over(w) - (F.col("said") == "low").cast("int")
    o = m.withColumns({"h": high, "l": low}).where("h >= 2 or l >= 2")
    agreed = ((F.col("h") >= 2) & (F.col("said") == "high")) | ((F.col("l") >= 2) & (F.col("said") == "low"))
    return o.groupBy("model").agg(F.count("*").alias("judged"), F.count_if(agreed).alias("agreed"))


@query("agg_32_receipt", "select 'click' as k, count(*) filter (where event_type='click') as v from events union all select 'error', count(*) filter (where event_type='error') from events")
def agg_32(spark, d):
    kinds = F.array(*[F.struct(F.lit(k).alias("k"), F.count_if(F.col("event_type") == k).alias("v")) for k in ("click", "error")])
    return Tables(spark, d).events.agg(F.map_from_entries(kinds).alias("receipt")).select(F.explode("receipt").alias("k", "v"))


@query("win_01_row_number", "select l_suppkey, l_returnflag, row_number() over (partition by l_suppkey order by count(*) desc, min(l_shipdate), l_returnflag) as k from lineitem group by 1, 2")
def win_01(spark, d):
    tally = Tables(spark, d).lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("n"), F.min("l_shipdate").alias("at"))
    w = Window.partitionBy("l_suppkey").orderBy(F.desc("n"), "at", "l_returnflag")
    return tally.select("l_suppkey", "l_returnflag", F.row_number().over(w).cast("bigint").alias("k"))


@query("win_02_runner_up", "select l_suppkey, l_returnflag, n, runner_up from (select l_suppkey, l_returnflag, n, row_number() over w as k, lead(n) over w as runner_up from (select l_suppkey, l_returnflag, count(*) as n from lineitem group by 1, 2) window w as (partition by l_suppkey order by n desc, l_returnflag)) where k = 1")
def win_02(spark, d):
    tally = Tables(spark, d).lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("n"))
    w = Window.partitionBy("l_suppkey").orderBy(F.desc("n"), "l_returnflag")
    return tally.withColumns({"k": F.row_number().over(w), "runner_up": F.lead("n").over(w)}).where("k = 1").select("l_suppkey", "l_returnflag", "n", "runner_up")


@query("win_03_total_with_page", "select o_orderkey, o_totalprice, count(*) over () as total from orders where o_orderstatus = 'F' order by o_totalprice desc, o_orderkey limit 60 offset 60")
def win_03(spark, d):
    shown = Tables(spark, d).orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    page = shown.orderBy(F.desc("o_totalprice"), "o_orderkey").offset(60).limit(60)
    return page.crossJoin(shown.agg(F.count("*").alias("total")))  # one row


@query("win_04_sum_beside", "select distinct p_brand, p_type, sum(p_size) over (partition by p_brand, p_type)::bigint as total from part")
def win_04(spark, d):
    return Tables(spark, d).part.groupBy("p_brand", "p_type").agg(F.sum("p_size").alias("total"))


@query("win_05_latest", "select distinct on (user_id, event_type) user_id, event_type, event_id, value from events order by user_id, event_type, ts desc, event_id desc")
def win_05(spark, d):
    return A.latest(Tables(spark, d).events, ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id", "value")


@query("win_06_replay", "select conv_id, role, turn, length(text) as chars from (select *, row_number() over (partition by conv_id, role order by turn desc) as k from conversations) where k = 1")
def win_06(spark, d):
    return A.latest(Tables(spark, d).conversations, ["conv_id", "role"], "turn").select("conv_id", "role", "turn", F.length("text").cast("bigint").alias("chars"))


SESSIONS = """
with g as (select user_id, ts, event_id, case when ts - lag(ts) over w <= interval 14 hour then 0 else 1 end as new from events window w as (partition by user_id order by ts, event_id)),
r as (select *, sum(new) over (partition by user_id order by ts, event_id rows unbounded preceding) as run from g)
select user_id, cast(run as bigint) as run, min(ts) as start, max(ts) as finish, count(*) as n from r group by user_id, run having count(*) >= 4"""


@query("win_07_sessions", SESSIONS)
def win_07(spark, d):
    return A.sessions(Tables(spark, d).events, ["user_id"], "ts", "event_id", "14 hours", 4)


@query("win_08_best_claim", "select user_id, event_id from (select user_id, event_id, row_number() over (partition by user_id order by case event_type when 'purchase' then 0 when 'signup' then 1 when 'click' then 2 else 3 end, value desc, event_id) as k from events) where k = 1")
def win_08(spark, d):
    t = F.col("event_type")
    rank = F.when(t == "purchase", 0).when(t == "signup", 1).when(t == "click", 2).otherwise(3)
    return A.latest(Tables(spark, d).events, ["user_id"], rank, F.desc("value"), F.col("event_id")).select("user_id", "event_id")


@query("win_09_queue_rank", "select n.n_regionkey as queue, s_suppkey, row_number() over (partition by n.n_regionkey order by s_acctbal desc, s_suppkey) as rank from supplier join nation n on s_nationkey = n_nationkey")
def win_09(spark, d):
    t = Tables(spark, d)
    w = Window.partitionBy("queue").orderBy(F.desc("s_acctbal"), "s_suppkey")
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).withColumnRenamed("n_regionkey", "queue")
    return s.select("queue", "s_suppkey", F.row_number().over(w).cast("bigint").alias("rank"))


@query("win_10_samples", "with p as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as k from orders) select o_custkey, list(o_orderkey order by k) as samples from p where k between 2 and 5 group by o_custkey")
def win_10(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    p = Tables(spark, d).orders.withColumn("k", F.row_number().over(w)).where("k between 2 and 5")  # the first is the hero
    return p.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("k", "o_orderkey"))).alias("a")).select("o_custkey", F.col("a.o_orderkey").alias("samples"))


BATCHES = """
with recursive s as (select o_custkey, o_orderkey, o_totalprice as size, row_number() over (partition by o_custkey order by o_orderkey) as i from orders),
b as (select o_custkey, o_orderkey, i, size as used, 1 as batch from s where i = 1
 union all select s.o_custkey, s.o_orderkey, s.i, case when b.used + s.size <= 600000 then b.used + s.size else s.size end, case when b.used + s.size <= 600000 then b.batch else b.batch + 1 end from b join s on s.o_custkey = b.o_custkey and s.i = b.i + 1)
select o_custkey, o_orderkey, batch from b"""


@query("win_11_batches", BATCHES)
def win_11(spark, d):
    return A.batches_by_size(Tables(spark, d).orders, ["o_custkey"], ["o_orderkey"], "o_totalprice", 600_000)


@query("win_12_best_copy", "with m as (select p_name, max(p_retailprice) as most from part where p_partkey % 2 = 0 group by 1) select p.p_partkey, case when m.most is null then 'absent' when p.p_retailprice > m.most * 1.1 then 'upgrade' when m.most > p.p_retailprice * 1.1 then 'downgrade' else 'same' end as verdict from part p left join m using (p_name) where p.p_partkey % 2 = 1")
def win_12(spark, d):
    p = Tables(spark, d).part
    held = p.where("p_partkey % 2 = 0").groupBy("p_name").agg(F.max("p_retailprice").alias("most"))
    own = F.col("p_retailprice")
    verdict = F.when(F.col("most").isNull(), "absent").when(own > F.col("most") * 1.1, "upgrade").when(F.col("most") > own * 1.1, "downgrade").otherwise("same")
    return p.where("p_partkey % 2 = 1").join(held, "p_name", "left").select("p_partkey", verdict.alias("verdict"))


@query("top_01_search_order", "select o_orderkey from orders order by case when o_orderpriority = '1-URGENT' then o_totalprice end desc nulls last, year(o_orderdate) desc nulls last, o_orderdate desc, o_orderkey limit 40 offset 20")
def top_01(spark, d):
    score = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice"))
    return Tables(spark, d).orders.orderBy(score.desc_nulls_last(), F.year("o_orderdate").desc_nulls_last(), F.desc("o_orderdate"), "o_orderkey").offset(20).limit(40).select("o_orderkey")


@query("top_02_global", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25")
def top_02(spark, d):
    return Tables(spark, d).orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@query("top_03_filtered", "select o_orderkey, o_totalprice from orders where o_orderstatus = 'P' and year(o_orderdate) = 1999 order by o_totalprice desc, o_orderkey limit 10")
def top_03(spark, d):
    return Tables(spark, d).orders.where((F.col("o_orderstatus") == "P") & (F.year("o_orderdate") == 1999)).orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10).select("o_orderkey", "o_totalprice")


@query("top_04_per_branch", "(select 'brand' as facet, p_brand as v, count(*) as n from part group by 2 order by n desc, v limit 5) union all (select 'type', p_type, count(*) as n from part group by 2 order by n desc, p_type limit 3)")
def top_04(spark, d):
    p = Tables(spark, d).part
    branch = lambda name, c, k: p.groupBy(F.col(c).alias("v")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "v").limit(k).select(F.lit(name).alias("facet"), "v", "n")
    return branch("brand", "p_brand", 5).unionByName(branch("type", "p_type", 3))


@query("top_05_boolean_order", "select o_orderkey from orders order by (o_orderpriority = '2-HIGH') desc, (o_orderstatus = 'F'), o_totalprice desc, o_orderkey limit 30")
def top_05(spark, d):
    return Tables(spark, d).orders.orderBy((F.col("o_orderpriority") == "2-HIGH").desc(), F.col("o_orderstatus") == "F", F.desc("o_totalprice"), "o_orderkey").limit(30).select("o_orderkey")


@query("top_06_five_each", "select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as k from orders) where k <= 5")
def top_06(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return Tables(spark, d).orders.withColumn("k", F.row_number().over(w)).where("k <= 5").select("o_custkey", "o_orderkey")


@query("top_07_largest", "select doc_id, n_chars from documents where n_chars >= 3000 order by n_chars desc, doc_id limit 50")
def top_07(spark, d):
    return Tables(spark, d).documents.where("n_chars >= 3000").orderBy(F.desc("n_chars"), "doc_id").limit(50).select("doc_id", "n_chars")


@query("top_08_random_order", "select p_partkey from part order by md5('7|' || p_partkey), p_partkey limit 10")
def top_08(spark, d):
    """Ten parts in an order that a seed mixes: the same however the rows are dealt, which a random column's is not."""
    return Tables(spark, d).part.orderBy(F.md5(F.concat(F.lit("7|"), F.col("p_partkey").cast("string"))), "p_partkey").limit(10).select("p_partkey")


@query("top_09_canonical", "select doc_id, k = 1 as kept from (select doc_id, row_number() over (partition by md5(text) order by source, length(text), doc_id) as k from documents)")
def top_09(spark, d):
    w = Window.partitionBy(F.md5(F.col("text").cast("binary"))).orderBy("source", F.length("text"), "doc_id")
    return Tables(spark, d).documents.select("doc_id", (F.row_number().over(w) == 1).alias("kept"))


@query("top_10_hero", "select o_custkey, (array_agg(o_orderkey order by (o_orderstatus = 'F') desc, o_totalprice desc, o_orderkey))[1] as hero from orders where o_totalprice >= 20000 group by o_custkey")
def top_10(spark, d):
    return Tables(spark, d).orders.where("o_totalprice >= 20000").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct(F.col("o_orderstatus") == "F", "o_totalprice", -F.col("o_orderkey"))).alias("hero"))


QUERIES, SQL = query.queries, query.sql
