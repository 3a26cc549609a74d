"""Queries of sections ENT and DED."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fernglass.functions import hashes, text
from fernglass.operators import aggregates as A
from fernglass.operators import entities as E
from fernglass.operators import joins
from fernglass.plans.base import Family, Tables

query = Family()


def _claims(t):
    """Events as claims: a user is the content, the item k is the field, the kind of event the source."""
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select(F.col("user_id").alias("hash"), F.concat(F.lit("f"), (k % 4).cast("string")).alias("field"), F.concat(F.lit("v"), (k % 7).cast("string")).alias("value"), F.col("event_type").alias("source"), F.col("value").alias("confidence"), F.col("ts").alias("at"), F.col("event_id").alias("seq"))


CLAIMS = "claims as (select user_id as hash, 'f' || cast(json_extract_string(props,'$.k') as int) % 4 as field, 'v' || cast(json_extract_string(props,'$.k') as int) % 7 as value, event_type as source, value as confidence, ts as at_, event_id as seq from events)"
RANK = "case source when 'purchase' then 0 when 'signup' then 1 when 'click' then 2 else 3 end"


def _rank():
    s = F.col("source")
    return F.when(s == "purchase", 0).when(s == "signup", 1).when(s == "click", 2).otherwise(3)


def _resolved(t):
    return E.resolve(_claims(t).where("source <> 'error'"), t.customer.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("hash")), _rank())


RESOLVED = f"resolved as (select hash, field, value, source from (select *, row_number() over (partition by hash, field order by {RANK}, confidence desc, value, source) as k from claims where source <> 'error' and hash in (select c_custkey from customer where c_custkey % 3 <> 0)) where k = 1)"


@query("ent_01_resolve", f"with {CLAIMS}, {RESOLVED} select * from resolved")
def ent_01(spark, d):
    return _resolved(Tables(spark, d))


@query("ent_02_overlay", f"with {CLAIMS}, {RESOLVED}, a as (select hash, field, value from (select *, row_number() over (partition by hash, field order by at_ desc, seq desc) as k from claims where source = 'error' and confidence > 60) where k = 1) select hash, field, value, 'human' as source from a union all select * from resolved r where not exists (select 1 from a where a.hash = r.hash and a.field = r.field)")
def ent_02(spark, d):
    t = Tables(spark, d)
    return E.overlay(_resolved(t), _claims(t).where("source = 'error' and confidence > 60"))


PEOPLE = f"""with {CLAIMS},
human as (select distinct hash, value from claims where source = 'signup'), dead as (select hash, value from claims where source = 'error' group by 1, 2 having count(*) >= 3),
machine as (select distinct hash, value from claims where source = 'view')
select hash, value, min(case p when 0 then '0human' else '1machine' end)[2:] as source from (select *, 0 as p from human union all select *, 1 from machine) x
where not exists (select 1 from dead d where d.hash = x.hash and d.value = x.value) group by hash, value"""


@query("ent_03_people", PEOPLE)
def ent_03(spark, d):
    c = _claims(Tables(spark, d))
    dead = c.where("source = 'error'").groupBy("hash", "value").agg(F.count("*").alias("n")).where("n >= 3")
    named = E.bridge([("human", c.where("source = 'signup'")), ("machine", c.where("source = 'view'"))], ["hash", "value"])
    return named.join(dead, ["hash", "value"], "left_anti")


@query("ent_04_superseded", f"with {CLAIMS}, now as (select hash, field, value from (select *, row_number() over (partition by hash, field order by at_ desc, seq desc) as k from claims) where k = 1) select distinct hash, field, value from claims except select hash, field, value from now")
def ent_04(spark, d):
    return E.superseded(_claims(Tables(spark, d)), ["hash", "field"], "value", "at", "seq")


VOTES = """with v as (select cast(json_extract_string(props,'$.k') as int) % 20 as item, user_id, event_type, row_number() over (partition by cast(json_extract_string(props,'$.k') as int) % 20, user_id order by ts desc, event_id desc) as k from events where event_type in ('click','error'))
select item, count(*) filter (where event_type='click') as yes, count(*) filter (where event_type='error') as no, case when count(*) filter (where event_type='click') > count(*) filter (where event_type='error') then 'add' when count(*) filter (where event_type='click') < count(*) filter (where event_type='error') then 'remove' else 'unchanged' end as verdict from v where k = 1 group by item"""


@query("ent_05_votes", VOTES)
def ent_05(spark, d):
    e = Tables(spark, d).events.where(F.col("event_type").isin("click", "error")).withColumn("item", F.get_json_object("props", "$.k").cast("int") % 20)
    return E.tally(e, ["item"], "user_id", F.col("event_type") == "click", F.col("event_type") == "error", "ts", "event_id")


@query("ent_06_audience", """with fam as (select distinct o_custkey from orders where o_orderpriority = '1-URGENT' and o_totalprice > 480000)
select o_orderkey, case when o_orderstatus = 'P' then 'private' when o_orderstatus = 'F' or o_custkey in (select o_custkey from fam) then 'family' else 'private' end as audience from orders""")
def ent_06(spark, d):
    o = Tables(spark, d).orders
    fam = o.where("o_orderpriority = '1-URGENT' and o_totalprice > 480000").select("o_custkey").distinct().withColumn("_fam", F.lit(True))
    audience = F.when(F.col("o_orderstatus") == "P", "private").when((F.col("o_orderstatus") == "F") | F.col("_fam"), "family").otherwise("private")
    return o.join(fam, "o_custkey", "left").select("o_orderkey", audience.alias("audience"))


PLURAL = """with s as (select l_partkey as grp, lower(l_returnflag) as key, count(*) as n, min(l_orderkey * 10 + l_linenumber) as first_at, (array_agg(l_returnflag order by l_orderkey * 10 + l_linenumber, l_returnflag))[1] as name from lineitem group by 1, 2),
r as (select *, row_number() over w as k, lead(n) over w as nxt from s window w as (partition by grp order by n desc, first_at, key))
select grp, name, n, coalesce(nxt = n, false) as contested from r where k = 1"""


def _plurality(t):
    votes = t.lineitem.select(F.col("l_partkey").alias("grp"), "l_returnflag", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    return E.plurality(votes, "grp", text.name_key(F.col("l_returnflag")), "l_returnflag", "at")


@query("ent_07_plurality", PLURAL)
def ent_07(spark, d):
    return _plurality(Tables(spark, d))


@query("ent_08_contests", PLURAL + " and nxt = n")
def ent_08(spark, d):
    return _plurality(Tables(spark, d)).where("contested")


@query("ent_09_settle", """with live as (select user_id, cast(json_extract_string(props,'$.k') as int) % 5 as answer, count(*) as n from events where event_type = 'signup' and value > 40 group by 1, 2),
best as (select user_id, answer from (select *, row_number() over (partition by user_id order by n desc, answer) as k from live) where k = 1)
select u.user_id, b.answer from (select distinct user_id from events where event_type = 'signup') u left join best b using (user_id)""")
def ent_09(spark, d):
    e = Tables(spark, d).events.where("event_type = 'signup'").withColumn("answer", F.get_json_object("props", "$.k").cast("int") % 5)
    return e.select("user_id").distinct().join(A.mode_of(e.where("value > 40"), ["user_id"], "answer", "answer"), "user_id", "left")


@query("ent_10_undo", """with u as (select user_id, max(ts) as at from events where event_type = 'error' group by 1)
select e.user_id, count(*) as standing from events e left join u on u.user_id = e.user_id where e.event_type = 'click' and (u.at is null or not (e.ts <= u.at and e.ts > u.at - interval 10 minute)) group by 1""")
def ent_10(spark, d):
    e = Tables(spark, d).events
    undo = e.where("event_type = 'error'").groupBy("user_id").agg(F.max("ts").alias("at"))
    undone = (F.col("ts") <= F.col("at")) & (F.col("ts") > F.col("at") - F.expr("interval 10 minutes"))
    return e.where("event_type = 'click'").join(undo, "user_id", "left").where(~F.coalesce(undone, F.lit(False))).groupBy("user_id").agg(F.count("*").alias("standing"))


@query("ent_11_respell", "select c_custkey, 'HOUSEHOLD' as old_name, 'HOME' as new_name from customer where c_mktsegment = 'HOUSEHOLD' union all select o_custkey, 'HOUSEHOLD', 'HOME' from orders join customer on o_custkey = c_custkey where c_mktsegment = 'HOUSEHOLD' and o_totalprice > 490000")
def ent_11(spark, d):
    t = Tables(spark, d)
    c = t.customer.where("c_mktsegment = 'HOUSEHOLD'").select("c_custkey")
    listed = t.orders.where("o_totalprice > 490000").join(c, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey")
    return c.unionByName(listed).withColumns({"old_name": F.lit("HOUSEHOLD"), "new_name": F.lit("HOME")})


@query("ent_12_group_verdict", "select user_id, case event_type when 'signup' then 'person' when 'error' then 'unidentifiable' else 'needs identifying' end as verdict from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as k from events where event_type in ('signup','error','view')) where k = 1")
def ent_12(spark, d):
    last = A.latest(Tables(spark, d).events.where(F.col("event_type").isin("signup", "error", "view")), ["user_id"], "ts", "event_id")
    t = F.col("event_type")
    return last.select("user_id", F.when(t == "signup", "person").when(t == "error", "unidentifiable").otherwise("needs identifying").alias("verdict"))


@query("ent_13_queue", "select o_custkey, count(*) as n from orders group by 1 having count(*) filter (where o_orderstatus='F') > count(*) filter (where o_orderstatus='O') and not bool_or(o_orderpriority='1-URGENT') order by n desc, o_custkey limit 40")
def ent_13(spark, d):
    s = F.col("o_orderstatus")
    per = Tables(spark, d).orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(s == "F").alias("f"), F.count_if(s == "O").alias("o"), F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("settled"))
    return per.where("f > o and not settled").orderBy(F.desc("n"), "o_custkey").limit(40).select("o_custkey", "n")


@query("ent_14_next_item", "select s_suppkey, n from (select s_suppkey, s_nationkey, count(*) as n, row_number() over (partition by s_nationkey order by (s_acctbal < 0), (count(*) filter (where l_returnflag='R') > 180), count(*) desc, s_suppkey) as k from supplier join lineitem on l_suppkey = s_suppkey group by s_suppkey, s_nationkey, s_acctbal) where k = 1")
def ent_14(spark, d):
    t = Tables(spark, d)
    per = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r")).join(t.supplier, "s_suppkey")
    return A.latest(per, ["s_nationkey"], F.col("s_acctbal") < 0, F.col("r") > 180, F.desc("n"), F.col("s_suppkey")).select("s_suppkey", "n")


@query("ent_15_intake", "select event_id, case when event_id < 4000 then 'seen' when value < 1 then 'too small' when event_type = 'error' then 'not an answer' else 'taken' end as outcome from events")
def ent_15(spark, d):
    e = Tables(spark, d).events
    seen = e.where("event_id < 4000").select("event_id", F.lit(True).alias("_seen"))
    outcome = F.when(F.col("_seen"), "seen").when(F.col("value") < 1, "too small").when(F.col("event_type") == "error", "not an answer").otherwise("taken")
    return e.join(seen, "event_id", "left").select("event_id", outcome.alias("outcome"))


@query("ent_16_partial", "select l_orderkey, bool_and(l_quantity > 10) as ingested from lineitem group by l_orderkey")
def ent_16(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_orderkey").agg(F.bool_and(F.col("l_quantity") > 10).alias("ingested"))


@query("ent_17_expand", "with c as (select c_nationkey, list(c_custkey order by c_custkey) as a from customer group by 1) select c_nationkey || '-' || (i - 1) as id, a[i] as hash from c, lateral (select unnest(range(1, len(a) + 1)) as i)")
def ent_17(spark, d):
    c = Tables(spark, d).customer.groupBy("c_nationkey").agg(F.array_sort(F.collect_list("c_custkey")).alias("a"))
    return c.select("c_nationkey", F.posexplode("a").alias("i", "hash")).select(F.concat_ws("-", F.col("c_nationkey").cast("string"), F.col("i").cast("string")).alias("id"), "hash")


@query("ent_18_personal", "select l_orderkey, count(*) filter (where l_suppkey < 20) >= 1 and count(*) filter (where l_suppkey >= 80) = 0 as personal from lineitem group by l_orderkey")
def ent_18(spark, d):
    s = F.col("l_suppkey")
    return Tables(spark, d).lineitem.groupBy("l_orderkey").agg(((F.count_if(s < 20) >= 1) & (F.count_if(s >= 80) == 0)).alias("personal"))


@query("ent_19_nearby", "select e.event_id from events e where e.event_type = 'click' and exists (select 1 from events p where p.event_type = 'signup' and p.user_id = e.user_id and abs(epoch_us(p.ts) - epoch_us(e.ts)) <= 3600000000)")
def ent_19(spark, d):
    e = Tables(spark, d).events
    return joins.near_in_time(e.where("event_type = 'click'"), e.where("event_type = 'signup'"), "user_id", "ts", 60).select("event_id")


PLAN = """with hide as (select o_orderkey from orders where o_totalprice > 450000 or o_orderpriority = '1-URGENT'), hidden as (select o_orderkey from orders where o_orderstatus = 'P')
select 'hide' as action, count(*) as n from hide where o_orderkey not in (select o_orderkey from hidden) union all select 'show', count(*) from hidden where o_orderkey not in (select o_orderkey from hide) union all select 'keep', count(*) from hidden where o_orderkey in (select o_orderkey from hide)"""


@query("ent_20_hide_plan", PLAN)
def ent_20(spark, d):
    o = Tables(spark, d).orders
    wanted, now = (F.col("o_totalprice") > 450000) | (F.col("o_orderpriority") == "1-URGENT"), F.col("o_orderstatus") == "P"
    counts = o.agg(F.count_if(wanted & ~now).alias("hide"), F.count_if(now & ~wanted).alias("show"), F.count_if(now & wanted).alias("keep"))
    return counts.selectExpr("stack(3, 'hide', hide, 'show', show, 'keep', keep) as (action, n)")


@query("ent_21_reconcile", "select doc_id, case when l.toxic = 1 and d.n_chars > 500 then 'hide' when l.toxic = 0 and d.n_chars <= 500 then 'show' else 'leave' end as action from documents d join labels l using (doc_id)")
def ent_21(spark, d):
    t = Tables(spark, d)
    toxic = F.col("toxic") == 1
    action = F.when(toxic & (F.col("n_chars") > 500), "hide").when(~toxic & (F.col("n_chars") <= 500), "show").otherwise("leave")
    return t.documents.join(t.labels, "doc_id").select("doc_id", action.alias("action"))


@query("ent_22_cover", "with auto as (select o_custkey, (array_agg(o_orderkey order by o_totalprice desc, o_orderkey))[1] as cover from orders group by 1), pins as (select c_custkey, c_custkey * 7 % 15000 as pin from customer where c_custkey % 5 = 0), ok as (select p.c_custkey, p.pin from pins p join orders o on o.o_orderkey = p.pin and o.o_orderstatus <> 'P') select a.o_custkey, coalesce(ok.pin, a.cover) as cover, ok.pin is not null as pinned from auto a left join ok on ok.c_custkey = a.o_custkey")
def ent_22(spark, d):
    t = Tables(spark, d)
    auto = t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("auto"))
    pins = t.customer.where("c_custkey % 5 = 0").select(F.col("c_custkey").alias("o_custkey"), (F.col("c_custkey") * 7 % 15000).alias("pin"))
    valid = pins.join(t.orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("pin")), "pin", "left_semi")
    return auto.join(valid, "o_custkey", "left").select("o_custkey", F.coalesce("pin", "auto").alias("cover"), F.col("pin").isNotNull().alias("pinned"))


TIERS = """with s as (select doc_id, n_chars, md5(length(text) || '|' || substr(text,1,32) || '|' || case when length(text) > 64 then substr(text, length(text) - 31) else '' end) as e, md5(text) as w, count(*) over (partition by n_chars) as n from documents),
c as (select *, count(*) over (partition by n_chars, e) as m, count(*) over (partition by w) as c from s)
select doc_id, case when n = 1 then 'unique size' when m = 1 then 'unique ends' when c > 1 then 'duplicate' else 'unique content' end as tier from c"""


@query("ded_01_tiers", TIERS)
def ded_01(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "n_chars", "text")
    return E.duplicate_tiers(docs, "doc_id", "n_chars", hashes.signature(F.col("text"), 32), F.md5(F.col("text").cast("binary")))


@query("ded_02_ingest", "select a.doc_id, case when not exists (select 1 from documents b where b.doc_id % 2 = 0 and b.n_chars = a.n_chars) then 'new' when a.n_chars < 60 then 'stale' when exists (select 1 from documents b where b.doc_id % 2 = 0 and b.n_chars = a.n_chars and md5(b.text) = md5(a.text)) then 'duplicate' else 'new' end as outcome from documents a where a.doc_id % 2 = 1")
def ded_02(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "n_chars", F.when(F.col("n_chars") >= 60, F.md5(F.col("text").cast("binary"))).alias("h"))
    held = docs.where("doc_id % 2 = 0")
    rows = docs.where("doc_id % 2 = 1").join(held.select("n_chars").distinct().withColumn("_s", F.lit(1)), "n_chars", "left").join(held.select("n_chars", "h").distinct().withColumn("_h", F.lit(1)), ["n_chars", "h"], "left")
    outcome = F.when(F.col("_s").isNull(), "new").when(F.col("h").isNull(), "stale").when(F.col("_h") == 1, "duplicate").otherwise("new")
    return rows.select("doc_id", outcome.alias("outcome"))


@query("ded_03_blocklist", "with b as (select n_chars, md5(text) as h from documents where source in ('src1','src2')), x as (select doc_id, n_chars, case when doc_id % 11 <> 0 then md5(text) end as h from documents where source not in ('src1','src2')) select doc_id, coalesce(exists (select 1 from b where b.n_chars = x.n_chars and b.h = x.h), false) or (h is null and exists (select 1 from b where b.n_chars = x.n_chars)) as blocked from x")
def ded_03(spark, d):
    docs = Tables(spark, d).documents
    h = F.md5(F.col("text").cast("binary"))
    block = docs.where(F.col("source").isin("src1", "src2")).select("n_chars", h.alias("h"))
    rows = docs.where(~F.col("source").isin("src1", "src2")).select("doc_id", "n_chars", F.when(F.col("doc_id") % 11 != 0, h).alias("h"))
    return E.blocked(rows, block, "n_chars", "h").select("doc_id", "blocked")


@query("ded_03_passages", "select d.doc_id from documents d where not exists (select 1 from benchmark b where position(b.text in d.text) > 0)")
def ded_03b(spark, d):
    t = Tables(spark, d)
    listed = t.benchmark.select(F.col("text").alias("passage"))
    return t.documents.join(listed, F.contains(F.col("text"), F.col("passage")), "left_anti").select("doc_id")


@query("ded_04_canonical", "select doc_id as keep_id, n from (select doc_id, row_number() over w as k, count(*) over (partition by md5(text)) as n from documents window w as (partition by md5(text) order by source, length(text), doc_id)) where k = 1 and n > 1")
def ded_04(spark, d):
    docs = Tables(spark, d).documents
    order = F.struct("source", F.length("text"), "doc_id")
    return docs.groupBy(F.md5(F.col("text").cast("binary")).alias("h")).agg(F.min_by("doc_id", order).alias("keep_id"), F.count("*").alias("n")).where("n > 1").select("keep_id", "n")


@query("ded_05_same_size", "select n_chars, count(*) as n, cast((count(*) - 1) * n_chars as bigint) as waste from documents group by n_chars having count(*) > 1")
def ded_05(spark, d):
    return Tables(spark, d).documents.groupBy("n_chars").agg(F.count("*").alias("n")).where("n > 1").withColumn("waste", (F.col("n") - 1) * F.col("n_chars"))


@query("ded_06_same_take", "select p_brand, p_size, count(*) as n, count(distinct regexp_extract(p_name, '^(\\w+) ', 1)) as chapters from part group by 1, 2 having count(*) > 1")
def ded_06(spark, d):
    chapter = F.regexp_extract("p_name", r"^(\w+) ", 1)
    return Tables(spark, d).part.groupBy("p_brand", "p_size").agg(F.count("*").alias("n"), F.count_distinct(chapter).alias("chapters")).where("n > 1")


@query("ded_07_downgrade", "with h as (select p_name, p_type, max(p_retailprice) as most, count(*) as n from part where p_partkey < 1000 group by 1, 2) select p.p_partkey, case when h.n is null then 'new' when h.n > 5 then 'ambiguous' when p.p_retailprice >= 1.1 * h.most then 'upgrade' when h.most >= 1.1 * p.p_retailprice then 'downgrade' else 'same' end as verdict from part p left join h on h.p_name = p.p_name and h.p_type = p.p_type where p.p_partkey >= 1000")
def ded_07(spark, d):
    p = Tables(spark, d).part
    held = p.where("p_partkey < 1000").groupBy("p_name", "p_type").agg(F.max("p_retailprice").alias("most"), F.count("*").alias("n"))
    own = F.col("p_retailprice")
    told = F.when(F.col("n").isNull(), "new").when(F.col("n") > 5, "ambiguous").when(own >= 1.1 * F.col("most"), "upgrade").when(F.col("most") >= 1.1 * own, "downgrade").otherwise("same")
    return p.where("p_partkey >= 1000").join(held, ["p_name", "p_type"], "left").select("p_partkey", told.alias("verdict"))


@query("ded_08_audit", "select a.doc_id, case when a.n_chars = 0 then 'UNREADABLE' when exists (select 1 from documents b where b.source = 'src3' and b.n_chars = a.n_chars and md5(b.text) = md5(a.text)) then 'HELD' else 'UNIQUE' end as verdict from documents a")
def ded_08(spark, d):
    docs = Tables(spark, d).documents
    held = joins.by_size_then_digest(docs, docs.where("source = 'src3'"), "n_chars", "text").select("doc_id", F.lit(1).alias("_held"))
    return docs.join(held, "doc_id", "left").select("doc_id", F.when(F.col("n_chars") == 0, "UNREADABLE").when(F.col("_held") == 1, "HELD").otherwise("UNIQUE").alias("verdict"))


@query("ded_09_still_held", "select p.p_partkey, case when exists (select 1 from part q where q.p_partkey = p.p_partkey + 1000) then 'partner' when exists (select 1 from part q where q.p_partkey < 900 and q.p_name = p.p_name and q.p_size = p.p_size) then 'name and size' when exists (select 1 from part q where q.p_partkey < 30 and q.p_name = p.p_name) then 'name' else 'none' end as proof from part p where p.p_partkey >= 900")
def ded_09(spark, d):
    p = Tables(spark, d).part
    rows = p.where("p_partkey >= 900").select("p_partkey", "p_name", "p_size")
    partner = p.select((F.col("p_partkey") - 1000).alias("p_partkey"), F.lit(1).alias("_p"))
    both = p.where("p_partkey < 900").select("p_name", "p_size").distinct().withColumn("_b", F.lit(1))
    name = p.where("p_partkey < 30").select("p_name").distinct().withColumn("_n", F.lit(1))
    rows = rows.join(partner, "p_partkey", "left").join(both, ["p_name", "p_size"], "left").join(name, "p_name", "left")
    return rows.select("p_partkey", F.when(F.col("_p") == 1, "partner").when(F.col("_b") == 1, "name and size").when(F.col("_n") == 1, "name").otherwise("none").alias("proof"))


@query("ded_10_why_new", "with k as (select p_name, bool_or(p_size is null) as unknown, list(distinct p_size) as sizes from part where p_partkey < 100 group by 1) select p.p_partkey, case when k.p_name is null then 'absent' when list_contains(k.sizes, p.p_size) then 'same size' else 'different size' end as why from part p left join k using (p_name) where p.p_partkey >= 100")
def ded_10(spark, d):
    p = Tables(spark, d).part
    known = p.where("p_partkey < 100").groupBy("p_name").agg(F.collect_set("p_size").alias("sizes"))
    why = F.when(F.col("sizes").isNull(), "absent").when(F.array_contains("sizes", F.col("p_size")), "same size").otherwise("different size")
    return p.where("p_partkey >= 100").join(known, "p_name", "left").select("p_partkey", why.alias("why"))


@query("ded_11_survivor", "with k as (select md5(text) as h, min(doc_id) as survivor from documents group by 1) select d.doc_id, k.survivor, s.n_chars = d.n_chars and md5(s.text) = md5(d.text) and s.doc_id <> d.doc_id as proven from documents d join k on md5(d.text) = k.h and k.survivor <> d.doc_id join documents s on s.doc_id = k.survivor")
def ded_11(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "n_chars", F.md5(F.col("text").cast("binary")).alias("h"))
    best = docs.groupBy("h").agg(F.min(F.struct("doc_id", "n_chars")).alias("s"))
    rows = docs.join(best, "h").where("s.doc_id <> doc_id")
    return rows.select("doc_id", F.col("s.doc_id").alias("survivor"), ((F.col("s.n_chars") == F.col("n_chars")) & (F.col("s.doc_id") != F.col("doc_id"))).alias("proven"))


@query("ded_12_verify_signature", "with g as (select n_chars, md5(substr(text,1,32)) as e, count(*) as n, count(distinct md5(text)) as contents from documents group by 1, 2 having count(*) > 1) select count(*) as groups, count(*) filter (where contents > 1) as wrong from g")
def ded_12(spark, d):
    docs = Tables(spark, d).documents
    g = docs.groupBy("n_chars", F.md5(F.substring("text", 1, 32).cast("binary")).alias("e")).agg(F.count("*").alias("n"), F.count_distinct(F.md5(F.col("text").cast("binary"))).alias("contents")).where("n > 1")
    return g.agg(F.count("*").alias("groups"), F.count_if(F.col("contents") > 1).alias("wrong"))


MOVES = """with m as (select doc_id, 'to/' || source || '/' || n_chars % 50 as dest, md5(text) as h from documents), r as (select *, row_number() over w as k, h = first_value(h) over w as same from m window w as (partition by dest order by doc_id)),
n as (select *, count(*) filter (where not same) over (partition by dest order by doc_id) as c from r)
select doc_id, case when k = 1 then 'move' when same then 'skip' else 'rename' end as action, case when k = 1 then dest when not same then dest || '-' || c end as "to" from n"""


@query("ded_13_move_plan", MOVES)
def ded_13(spark, d):
    m = Tables(spark, d).documents.select("doc_id", F.concat_ws("/", F.lit("to"), "source", (F.col("n_chars") % 50).cast("string")).alias("dest"), F.md5(F.col("text").cast("binary")).alias("h"))
    return E.move_plan(m, "dest", "h", "doc_id").select("doc_id", "action", "to")


QUERIES, SQL = query.queries, query.sql
