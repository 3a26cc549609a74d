"""Queries of sections CLS and QUA."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fernglass.operators import quality as Q
from fernglass.operators import rules as R
from fernglass.operators.aggregates import coverage
from fernglass.operators.filters import first_reason
from fernglass.plans.base import Family, Tables

query = Family()


@query("cls_01_router", "select page_id, case when regexp_matches(url, '^https?://blog\\.') then 'chronology' when regexp_matches(url, '/en/') then 'production' when regexp_matches(url, '#') then 'archive' else 'review' end as dest, case when regexp_matches(url, '^https?://blog\\.') then 'blog host' when regexp_matches(url, '/en/') then 'english' when regexp_matches(url, '#') then 'anchor' else 'no signal' end as why from pages")
def cls_01(spark, d):
    rules = [(r"^https?://blog\.", "chronology", "blog host"), ("/en/", "production", "english"), ("#", "archive", "anchor")]
    return Tables(spark, d).pages.select("page_id", R.route(F.col("url"), rules, ("review", "no signal")).alias("r")).select("page_id", "r.dest", "r.why")


@query("cls_02_side", "select o_custkey, case when bool_or(o_orderpriority='1-URGENT') then 'shared' when bool_or(o_orderstatus='P') then 'own' else 'unknown' end as side, case when bool_or(o_orderpriority='1-URGENT') then 'an urgent order' when bool_or(o_orderstatus='P') then 'a pending order' end as reason from orders group by 1")
def cls_02(spark, d):
    urgent, pending = F.bool_or(F.col("o_orderpriority") == "1-URGENT"), F.bool_or(F.col("o_orderstatus") == "P")
    o = Tables(spark, d).orders.groupBy("o_custkey")
    return o.agg(F.when(urgent, "shared").when(pending, "own").otherwise("unknown").alias("side"), F.when(urgent, "an urgent order").when(pending, "a pending order").alias("reason"))


@query("cls_03_file_side", "select l_orderkey, l_linenumber, case when l_returnflag='R' then 'shared' when l_suppkey < 10 then 'own' when l_tax = 0 then 'shared' when year(l_shipdate) < 1997 and l_discount = 0 then 'own' else 'undecided' end as side from lineitem")
def cls_03(spark, d):
    c = F.col
    side = F.when(c("l_returnflag") == "R", "shared").when(c("l_suppkey") < 10, "own").when(c("l_tax") == 0, "shared").when((F.year("l_shipdate") < 1997) & (c("l_discount") == 0), "own").otherwise("undecided")
    return Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", side.alias("side"))


@query("cls_04_signals", "with s as (select p_partkey, list_filter([case when p_size < 10 then 'small' end, case when p_type = 'PROMO' then 'promo' end, case when contains(p_name, 'red') then 'red' end], lambda x: x is not null) as signals from part) select p_partkey, array_to_string(signals, '+') as signals, case when len(signals) >= 2 then 'screenshot' when len(signals) = 1 then 'unsure' else 'memory' end as verdict from s")
def cls_04(spark, d):
    found = R.signals({"small": F.col("p_size") < 10, "promo": F.col("p_type") == "PROMO", "red": F.contains(F.col("p_name"), F.lit("red"))})
    rows = Tables(spark, d).part.select("p_partkey", found.alias("s"))
    return rows.select("p_partkey", F.array_join("s", "+").alias("signals"), F.when(F.size("s") >= 2, "screenshot").when(F.size("s") == 1, "unsure").otherwise("memory").alias("verdict"))


@query("cls_05_keep_or_noise", "select doc_id, case when n_chars < 100 then 'noise' when lang = 'en' or n_chars > 2000 then 'keep' else 'noise' end as verdict from documents")
def cls_05(spark, d):
    n = F.col("n_chars")
    return Tables(spark, d).documents.select("doc_id", F.when(n < 100, "noise").when((F.col("lang") == "en") | (n > 2000), "keep").otherwise("noise").alias("verdict"))


@query("cls_06_tiers", "select o_orderkey, case when o_totalprice > 400000 then 'tier 1' when o_totalprice > 200000 then 'tier 2' else 'tier 3' end as tier from orders")
def cls_06(spark, d):
    p = F.col("o_totalprice")
    return Tables(spark, d).orders.select("o_orderkey", F.when(p > 400000, "tier 1").when(p > 200000, "tier 2").otherwise("tier 3").alias("tier"))


HOLD = """with c as (select l_orderkey, l_linenumber, case l_suppkey % 4 when 0 then 'a' when 1 then 'b' when 2 then 'c' end as s, case l_partkey % 3 when 0 then 'none' when 1 then 'part' else 'full' end as e, case l_linenumber % 4 when 0 then 'child' when 1 then 'teen' when 2 then 'adult' end as a, l_tax > 0.05 as x, l_returnflag = 'R' as r from lineitem)
select l_orderkey, l_linenumber, case when s is null then 'unknown' when s = 'a' then 'class a' when a in ('child','teen') and (e <> 'none' or x) then 'minor' when a is null and e <> 'none' then 'age unknown' when (e <> 'none' or x) and not r then 'not released' when s = 'b' and not r then 'class b' end as reason from c"""


@query("cls_07_hold", HOLD)
def cls_07(spark, d):
    k = lambda c, n: F.pmod(F.col(c), F.lit(n))
    s = F.when(k("l_suppkey", 4) == 0, "a").when(k("l_suppkey", 4) == 1, "b").when(k("l_suppkey", 4) == 2, "c")
    e = F.when(k("l_partkey", 3) == 0, "none").when(k("l_partkey", 3) == 1, "part").otherwise("full")
    a = F.when(k("l_linenumber", 4) == 0, "child").when(k("l_linenumber", 4) == 1, "teen").when(k("l_linenumber", 4) == 2, "adult")
    return Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", R.hold(s, e, a, F.col("l_tax") > 0.05, F.col("l_returnflag") == "R").alias("reason"))


@query("cls_08_share_set", "with r as (select doc_id, case when l.doc_id is null then 'no label' when toxic = 1 then 'toxic' when quality = 0 then 'poor' end as reason from documents d left join labels l using (doc_id)) select count(*) filter (where reason is null) as shared, count(*) filter (where reason is not null) as held, count(*) as everything from r")
def cls_08(spark, d):
    t = Tables(spark, d)
    rows = t.documents.select("doc_id").join(t.labels.withColumn("_l", F.lit(True)), "doc_id", "left")
    reason = first_reason([(F.col("_l").isNull(), "no label"), (F.col("toxic") == 1, "toxic"), (F.col("quality") == 0, "poor")])
    return rows.select(reason.alias("reason")).agg(F.count_if(F.col("reason").isNull()).alias("shared"), F.count_if(F.col("reason").isNotNull()).alias("held"), F.count("*").alias("everything"))


@query("cls_09_categories", "select o_orderkey, case when starts_with(o_orderpriority, '1') or starts_with(o_orderpriority, '2') then 'fast' when starts_with(o_orderpriority, '5') then 'slow' else 'other' end as category from orders")
def cls_09(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", R.by_prefix(F.col("o_orderpriority"), {"1": "fast", "2": "fast", "5": "slow"}).alias("category"))


@query("cls_10_original", "select page_id, regexp_matches(url, '/[0-9]{2,5}$') or list_has_any(string_split(url, '/'), ['de', 'fr']) as original from pages")
def cls_10(spark, d):
    folders = F.arrays_overlap(F.split("url", "/"), F.array(F.lit("de"), F.lit("fr")))
    return Tables(spark, d).pages.select("page_id", (F.col("url").rlike("/[0-9]{2,5}$") | folders).alias("original"))


@query("cls_11_root", "select page_id, case when contains(url, '.example.com') then 'com' when contains(url, '.example.org') then 'org' when contains(url, '.example.net') then 'net' else 'other' end as root from pages")
def cls_11(spark, d):
    u = F.col("url")
    return Tables(spark, d).pages.select("page_id", F.when(F.contains(u, F.lit(".example.com")), "com").when(F.contains(u, F.lit(".example.org")), "org").when(F.contains(u, F.lit(".example.net")), "net").otherwise("other").alias("root"))


@query("cls_12_terms", "select doc_id from documents where contains(lower(text), 'moron') or contains(lower(text), 'scum')")
def cls_12(spark, d):
    return Tables(spark, d).documents.where(R.holds_term(F.col("text"), ["Moron", "scum"])).select("doc_id")


@query("cls_13_tripwire", "select doc_id, cast(len(regexp_extract_all(regexp_replace(text, '(?i)clown fish', '', 'g'), '(?i)(?:clown|idiot)')) as int) as hits from documents where len(regexp_extract_all(regexp_replace(text, '(?i)clown fish', '', 'g'), '(?i)(?:clown|idiot)')) > 0")
def cls_13(spark, d):
    return Tables(spark, d).documents.select("doc_id", R.tripwire(F.col("text"), ["clown", "idiot"], ["clown fish"]).alias("hits")).where("hits > 0")


@query("qua_01_coverage", "select 'lang' as field, count(*) filter (where lang <> '') as filled, count(*) as applicable, round(count(*) filter (where lang <> '') / count(*)::double, 4) as share from documents union all select 'text', count(*) filter (where text <> '' and n_chars > 100), count(*) filter (where n_chars > 100), round(count(*) filter (where text <> '' and n_chars > 100) / (count(*) filter (where n_chars > 100))::double, 4) from documents")
def qua_01(spark, d):
    return coverage(Tables(spark, d).documents, {"lang": None, "text": F.col("n_chars") > 100})


@query("qua_02_rederive", "with s as (select doc_id, n_chars, length(text) as again from documents) select count(*) as sampled, count(again) as checked, count(*) filter (where again <> n_chars) as wrong, case when count(*) = 0 then 'cannot tell' when count(again) = 0 or count(*) filter (where again <> n_chars) > 0 then 'wrong' else 'ok' end as verdict from s")
def qua_02(spark, d):
    s = Tables(spark, d).documents.select("n_chars", F.length("text").alias("again"))
    counts = s.agg(F.count("*").alias("sampled"), F.count("again").alias("checked"), F.count_if(F.col("again") != F.col("n_chars")).alias("wrong"))
    return counts.withColumn("verdict", Q.verdict(F.col("wrong"), F.col("checked"), F.col("sampled")))


@query("qua_03_alignment", "select count(*) as rows, count(*) filter (where list_cosine_similarity(a.embedding::double[], b.embedding::double[]) >= 0.99) as aligned from embeddings a join embeddings b on b.vec_id = case when a.vec_id % 50 = 49 then a.vec_id - 1 else a.vec_id end")
def qua_03(spark, d):
    from fernglass.functions.values import cosine

    e = Tables(spark, d).embeddings
    other = e.select(F.col("vec_id").alias("k"), F.col("embedding").alias("again"))
    pairs = e.withColumn("k", F.when(F.col("vec_id") % 50 == 49, F.col("vec_id") - 1).otherwise(F.col("vec_id"))).join(other, "k")
    return pairs.agg(F.count("*").alias("rows"), F.count_if(cosine(F.col("embedding"), F.col("again")) >= 0.99).alias("aligned"))


@query("qua_04_counts", "select (select count(*) from orders) as claimed, (select count(distinct o_orderkey) from orders) as found, (select count(*) from orders) = (select count(distinct o_orderkey) from orders) as publish")
def qua_04(spark, d):
    return Tables(spark, d).orders.agg(F.count("*").alias("claimed"), F.count_distinct("o_orderkey").alias("found")).withColumn("publish", F.col("claimed") == F.col("found"))


@query("qua_05_agreement", "with v as (select l_orderkey, l_suppkey % 4 as model, max(l_returnflag) as said from lineitem group by 1, 2), o as (select a.model, a.said, count(*) filter (where b.said = 'R') as r, count(*) filter (where b.said = 'N') as n, count(*) filter (where b.said = 'A') as a from v a join v b on a.l_orderkey = b.l_orderkey and a.model <> b.model group by a.l_orderkey, 1, 2) select model, count(*) as judged, count(*) filter (where (r >= 2 and said = 'R') or (n >= 2 and said = 'N') or (a >= 2 and said = 'A')) as agreed from o where r >= 2 or n >= 2 or a >= 2 group by model")
def qua_05(spark, d):
    v = Tables(spark, d).lineitem.groupBy("l_orderkey", (F.col("l_suppkey") % 4).alias("model")).agg(F.max("l_returnflag").alias("said"))
    w = Window.partitionBy("l_orderkey")
    others = {k: F.count_if(F.col("said") == k).over(w) - (F.col("said") == k).cast("int") for k in "RNA"}
    rows = v.withColumns(others).where("R >= 2 or N >= 2 or A >= 2")
    agreed = F.greatest(*[F.when((F.col(k) >= 2) & (F.col("said") == k), 1).otherwise(0) for k in "RNA"]) == 1
    return rows.groupBy("model").agg(F.count("*").alias("judged"), F.count_if(agreed).alias("agreed"))


@query("qua_06_stratified", "select doc_id, source from (select *, row_number() over (partition by source order by md5(cast(doc_id as varchar)), doc_id) as k from documents) where k <= 5")
def qua_06(spark, d):
    order = F.struct(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id")
    return Q.stratified(Tables(spark, d).documents, "source", order, 5).select("doc_id", "source")


@query("qua_07_every_nth", "select o_orderkey, o_orderpriority, o_totalprice from (select *, row_number() over (order by o_orderkey) as k from orders) where (k - 1) % 97 = 0")
def qua_07(spark, d):
    return Q.every_nth(Tables(spark, d).orders, "o_orderkey", 97).select("o_orderkey", "o_orderpriority", "o_totalprice")



@query("qua_08_removal_guard", "select (select count(*) from customer) as known, (select count(*) from customer where c_custkey % 4 = 0) as gone, false as allowed union all select (select count(*) from customer), (select count(*) from customer where c_custkey % 6 = 0), true union all select 15, (select count(*) from customer where c_custkey < 15 and c_custkey % 2 = 0), true")
def qua_08(spark, d):
    c = Tables(spark, d).customer.select("c_custkey")
    guards = [Q.removal_guard(known, known.where(F.col("c_custkey") % m != 0), "c_custkey") for known, m in ((c, 4), (c, 6), (c.where("c_custkey < 15"), 2))]
    return guards[0].unionByName(guards[1]).unionByName(guards[2])


@query("qua_09_floor", "select l_suppkey, count(*) filter (where l_returnflag <> 'R') as present, count(*) as expected, count(*) filter (where l_returnflag <> 'R') >= 0.66 * count(*) as allowed from lineitem group by 1")
def qua_09(spark, d):
    per = Tables(spark, d).lineitem.groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") != "R").alias("present"), F.count("*").alias("expected"))
    return per.withColumn("allowed", Q.floor_guard(F.col("present"), F.col("expected"), 0.66))


@query("qua_10_expected_count", "select source, count(*) as listed, count(distinct md5(text)) as distinct_listed, count(*) = count(*) filter (where n_chars > 100) and count(*) = count(distinct md5(text)) as allowed from documents group by source")
def qua_10(spark, d):
    """A list for each source, against the number that its longer texts lead one to expect; doubles refuse it too."""
    per = Tables(spark, d).documents.groupBy("source").agg(F.count("*").alias("listed"), F.count_distinct(F.md5(F.col("text").cast("binary"))).alias("distinct_listed"), F.count_if(F.col("n_chars") > 100).alias("expected"))
    return per.select("source", "listed", "distinct_listed", ((F.col("listed") == F.col("expected")) & (F.col("listed") == F.col("distinct_listed"))).alias("allowed"))


@query("qua_11_repeats", "select user_id, count(*) as shown_before from (select user_id, event_type from events where ts < timestamp '2024-01-02' intersect select user_id, event_type from events where ts >= timestamp '2024-01-29') group by 1")
def qua_11(spark, d):
    e = Tables(spark, d).events
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    both = e.where(F.col("ts") < at("2024-01-02")).select("user_id", "event_type").intersect(e.where(F.col("ts") >= at("2024-01-29")).select("user_id", "event_type"))
    return both.groupBy("user_id").agg(F.count("*").alias("shown_before"))


@query("qua_12_completeness", "with t as (select distinct l_suppkey as part, l_partkey as member from lineitem where l_suppkey < 60), h as (select distinct l_suppkey as part, l_partkey as member from lineitem where l_suppkey >= 20 and (l_suppkey < 40 or l_returnflag <> 'R')), m as (select part, count(*) as missing from (select * from t except select * from h) group by 1), p as (select part from t union select part from h) select p.part, coalesce(m.missing, 0) as missing, case when p.part >= 60 then 'cannot tell' when m.missing > 0 then 'incomplete' else 'complete' end as verdict from p left join m using (part)")
def qua_12(spark, d):
    li = Tables(spark, d).lineitem.select(F.col("l_suppkey").alias("part"), F.col("l_partkey").alias("member"), "l_returnflag")
    truth = li.where("part < 60").select("part", "member").distinct()
    handled = li.where("part >= 20 and (part < 40 or l_returnflag <> 'R')").select("part", "member").distinct()
    return Q.completeness(truth, handled, "part", "member")


@query("qua_13_straddling", "select p_brand, p_size, count(distinct p_type) as sides from part group by 1, 2 having count(distinct p_type) > 1")
def qua_13(spark, d):
    return Tables(spark, d).part.groupBy("p_brand", "p_size").agg(F.count_distinct("p_type").alias("sides")).where("sides > 1")


@query("qua_14_read_back", "select count(*) as rows, sum(('0x' || substr(md5(text), 1, 8))::bigint)::bigint as checksum from documents")
def qua_14(spark, d):
    part = F.conv(F.substring(F.md5(F.col("text").cast("binary")), 1, 8), 16, 10).cast("bigint")
    return Tables(spark, d).documents.agg(F.count("*").alias("rows"), F.sum(part).alias("checksum"))


QUERIES, SQL = query.queries, query.sql
