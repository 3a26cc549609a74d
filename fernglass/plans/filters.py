"""Queries of section FLT: filters, predicates and derived columns."""

from pyspark.sql import functions as F

from fernglass.functions import text, values
from fernglass.operators import filters
from fernglass.plans.base import Family, Tables

query = Family()


@query("flt_01_optional", "select o_orderkey, o_orderstatus, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice >= 300000")
def flt_01(spark, d):
    o = Tables(spark, d).orders
    status, least, most = "F", 300000.0, None
    kept = filters.optional(o, (status, F.col("o_orderstatus") == status), (least, F.col("o_totalprice") >= least), (most, F.col("o_totalprice") <= most))
    return kept.select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("flt_02_year_range", "select o_orderkey, cast(year(o_orderdate) as int) as y from orders where year(o_orderdate) between 1996 and 1998")
def flt_02(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", F.year("o_orderdate").alias("y")).where(F.col("y").between(1996, 1998))


@query("flt_03_half_open", "select o_orderkey from orders where o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1997-04-01'")
def flt_03(spark, d):
    at = F.col("o_orderdate")
    return Tables(spark, d).orders.where((at >= F.lit("1997-01-01").cast("timestamp_ntz")) & (at < F.lit("1997-04-01").cast("timestamp_ntz"))).select("o_orderkey")


@query("flt_04_substring", "select p_partkey from part where position('ue bolt' in lower(coalesce(p_name,'') || ' ' || coalesce(p_type,''))) > 0 or position('ring promo' in lower(coalesce(p_name,'') || ' ' || coalesce(p_type,''))) > 0")
def flt_04(spark, d):
    p = Tables(spark, d).part
    cols = [F.col("p_name"), F.col("p_type")]
    return p.where(filters.contains_text(cols, "UE Bolt") | filters.contains_text(cols, "ring promo")).select("p_partkey")


@query("flt_05_key_substring", "select p_partkey, p_brand from part where position('brand1' in nullif(regexp_replace(lower(p_brand), '[^\\p{L}\\p{N}]+', '', 'g'), '')) > 0")
def flt_05(spark, d):
    return Tables(spark, d).part.where(F.contains(text.place_key(F.col("p_brand")), F.lit("brand1"))).select("p_partkey", "p_brand")


@query("flt_06_any_regex", "select p_partkey from part where regexp_matches(p_name, '(?i)^RED .*(bolt|ring)$') or regexp_matches(p_type, '(?i)^eco')")
def flt_06(spark, d):
    p = Tables(spark, d).part
    return p.where(filters.any_matches([F.col("p_name")], "^RED .*(bolt|ring)$") | filters.any_matches([F.col("p_type")], "^eco")).select("p_partkey")


@query("flt_07_prefix", "select c_custkey from customer where starts_with(lower(c_name), 'customer#00000001')")
def flt_07(spark, d):
    return Tables(spark, d).customer.where(filters.has_prefix(F.col("c_name"), "CUSTOMER#00000001")).select("c_custkey")


@query("flt_08_non_empty", "select doc_id from documents where text is not null and text <> '' and n_chars < 1000")
def flt_08(spark, d):
    return Tables(spark, d).documents.where(filters.non_empty(F.col("text")) & (F.col("n_chars") < 1000)).select("doc_id")


@query("flt_09_three_way", "select event_id, case when event_type in ('click','view') then 'look' when event_type = 'purchase' then 'buy' else 'other' end as kind from events")
def flt_09(spark, d):
    t = F.col("event_type")
    return Tables(spark, d).events.select("event_id", F.when(t.isin("click", "view"), "look").when(t == "purchase", "buy").otherwise("other").alias("kind"))


@query("flt_10_first_reason", "select o_orderkey, case when o_orderstatus = 'P' then 'pending' when o_totalprice < 10000 then 'small' when o_orderpriority = '5-LOW' then 'low' end as reason from orders")
def flt_10(spark, d):
    rules = [(F.col("o_orderstatus") == "P", "pending"), (F.col("o_totalprice") < 10000, "small"), (F.col("o_orderpriority") == "5-LOW", "low")]
    return Tables(spark, d).orders.select("o_orderkey", filters.first_reason(rules).alias("reason"))


@query("flt_11_abroad", "select c_custkey, n.n_regionkey is not null and n.n_regionkey <> 2 as abroad from customer left join nation n on c_nationkey = n.n_nationkey and n.n_nationkey < 20")
def flt_11(spark, d):
    t = Tables(spark, d)
    n = t.nation.where("n_nationkey < 20")
    known = t.customer.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return known.select("c_custkey", (F.col("n_regionkey").isNotNull() & F.coalesce(F.col("n_regionkey") != 2, F.lit(False))).alias("abroad"))


@query("flt_12_first_year", "select o_orderkey, cast(coalesce(case when regexp_matches(o_orderpriority, '^[0-9]{4}') then cast(substr(o_orderpriority,1,4) as int) end, cast(substr(strftime(o_orderdate, '%Y-%m-%d'),1,4) as int)) as int) as y from orders")
def flt_12(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", values.first_year(F.col("o_orderpriority"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("y"))


@query("flt_13_visible", "select l.doc_id, l.quality = 1 and not l.toxic = 1 as visible from labels l")
def flt_13(spark, d):
    return Tables(spark, d).labels.select("doc_id", ((F.col("quality") == 1) & ~(F.col("toxic") == 1)).alias("visible"))


@query("flt_14_key_column", "select p_partkey, nullif(regexp_replace(lower(p_name), '[^\\p{L}\\p{N}]+', '', 'g'), '') as key from part")
def flt_14(spark, d):
    return Tables(spark, d).part.select("p_partkey", text.place_key(F.col("p_name")).alias("key"))


@query("flt_15_coalesce_source", "select p_partkey, coalesce(case when p_size > 40 then p_name end, case when p_size > 20 then p_brand end, p_type) as v, case when p_size > 40 then 'name' when p_size > 20 then 'brand' else 'type' end as source from part")
def flt_15(spark, d):
    size = F.col("p_size")
    value, source = values.first_with_source({"name": F.when(size > 40, F.col("p_name")), "brand": F.when(size > 20, F.col("p_brand")), "type": F.col("p_type")})
    return Tables(spark, d).part.select("p_partkey", value.alias("v"), source.alias("source"))


@query("flt_16_side", "select page_id, case when starts_with(url, 'https://') then 'secure' when starts_with(url, 'http://') then 'plain' else 'other' end as side from pages")
def flt_16(spark, d):
    u = F.col("url")
    return Tables(spark, d).pages.select("page_id", F.when(u.startswith("https://"), "secure").when(u.startswith("http://"), "plain").otherwise("other").alias("side"))


@query("flt_17_wanted_fields", "select event_id, event_type from events where event_type in ('purchase','signup')")
def flt_17(spark, d):
    return Tables(spark, d).events.select("event_id", "event_type").where(F.col("event_type").isin("purchase", "signup"))


@query("flt_18_any_all", "select o_orderkey from orders where o_custkey in (1,2,3,5,8,13,21,34,55,89) and o_orderpriority not in ('5-LOW','1-URGENT')")
def flt_18(spark, d):
    return Tables(spark, d).orders.where(F.col("o_custkey").isin(1, 2, 3, 5, 8, 13, 21, 34, 55, 89) & ~F.col("o_orderpriority").isin("5-LOW", "1-URGENT")).select("o_orderkey")


@query("flt_19_distinct_from", "select d.doc_id from documents d left join labels l using (doc_id) where l.quality is distinct from 1")
def flt_19(spark, d):
    t = Tables(spark, d)
    return t.documents.join(t.labels.dropDuplicates(["doc_id"]), "doc_id", "left").where(~F.col("quality").eqNullSafe(F.lit(1))).select("doc_id")


@query("flt_20_valid_point", "select c_custkey from customer where c_acctbal / 100 between -90 and 90 and (c_custkey % 400 - 200) between -180 and 180 and not (c_acctbal = 0 and c_custkey % 400 = 200)")
def flt_20(spark, d):
    lat, lon = (F.col("c_acctbal") / 100).cast("string"), (F.col("c_custkey") % 400 - 200).cast("string")
    return Tables(spark, d).customer.where(filters.valid_point(lat, lon)).select("c_custkey")


@query("flt_21_size_limits", "select doc_id, n_chars, case when n_chars < 200 then 'too small' when n_chars > 9000 then 'too large' else 'kept' end as outcome from documents")
def flt_21(spark, d):
    n = F.col("n_chars")
    kept, rest = filters.split_by(Tables(spark, d).documents.select("doc_id", "n_chars"), n.between(200, 9000))
    told = rest.withColumn("outcome", F.when(n < 200, "too small").otherwise("too large"))
    return kept.withColumn("outcome", F.lit("kept")).unionByName(told)


@query("flt_22_value_by_shape", "select o_orderkey, case when regexp_matches(o_orderpriority, '^[0-9]-(HIGH|LOW)$') then o_orderpriority when regexp_matches(o_orderstatus, '^[0-9]-(HIGH|LOW)$') then o_orderstatus end as found from orders")
def flt_22(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", filters.pick_by_shape([F.col("o_orderpriority"), F.col("o_orderstatus")], "[0-9]-(?:HIGH|LOW)").alias("found"))


@query("flt_23_validation", "select conv_id, turn, case when role not in ('user','assistant') then 'unknown role' when text is null or length(text) = 0 then 'empty' when length(text) > 600 then 'too long' when turn > 5 then 'too late' else 'ok' end as verdict from conversations")
def flt_23(spark, d):
    rules = [(~F.col("role").isin("user", "assistant"), "unknown role"), (~filters.non_empty(F.col("text")), "empty"), (F.length("text") > 600, "too long"), (F.col("turn") > 5, "too late")]
    return Tables(spark, d).conversations.select("conv_id", "turn", F.coalesce(filters.first_reason(rules), F.lit("ok")).alias("verdict"))


QUERIES, SQL = query.queries, query.sql
