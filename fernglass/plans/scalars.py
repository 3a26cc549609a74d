"""Queries of sections SET, STR, DAT, MTH, ARR, JSN and HSH."""

from pyspark.sql import functions as F

from fernglass.functions import hashes, text, values
from fernglass.operators import aggregates as A
from fernglass.plans.base import Family, Tables

query = Family()
KEY = "trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
FOLD = "regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"


@query("set_01_union", "select c_name as name from customer union select s_name from supplier union select p_name from part")
def set_01(spark, d):
    t = Tables(spark, d)
    return t.customer.select(F.col("c_name").alias("name")).union(t.supplier.select("s_name")).union(t.part.select("p_name")).distinct()


@query("set_02_union_all", "select 'status' as facet, o_orderstatus as v, count(*) as n from orders group by 2 union all select 'priority', o_orderpriority, count(*) from orders group by 2")
def set_02(spark, d):
    o = Tables(spark, d).orders
    branch = lambda f, c: o.groupBy(F.col(c).alias("v")).agg(F.count("*").alias("n")).select(F.lit(f).alias("facet"), "v", "n")
    return branch("status", "o_orderstatus").unionByName(branch("priority", "o_orderpriority"))


@query("set_03_difference", "select o_custkey, 'lost' as side from (select o_custkey from orders where year(o_orderdate) = 1995 except select o_custkey from orders where year(o_orderdate) = 1996) union all select o_custkey, 'kept' from (select o_custkey from orders where year(o_orderdate) = 1995 intersect select o_custkey from orders where year(o_orderdate) = 1996)")
def set_03(spark, d):
    o = Tables(spark, d).orders
    old, new = (o.where(F.year("o_orderdate") == y).select("o_custkey") for y in (1995, 1996))
    return old.subtract(new).withColumn("side", F.lit("lost")).unionByName(old.intersect(new).withColumn("side", F.lit("kept")))


@query("set_04_bucket_union", "select p_size, list_sort(list(distinct p_brand)) as brands from part group by p_size")
def set_04(spark, d):
    buckets = Tables(spark, d).part.groupBy("p_size", "p_type").agg(F.collect_set("p_brand").alias("own"))
    return buckets.groupBy("p_size").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("own")))).alias("brands"))


@query("str_01_name_key", f"select doc_id, {KEY.format('text')} as key from documents")
def str_01(spark, d):
    return Tables(spark, d).documents.select("doc_id", text.name_key(F.col("text")).alias("key"))


@query("str_02_name_key_composed")
def str_02(spark, d):
    """name_key after NFKC, for which DuckDB has no function."""
    return Tables(spark, d).documents.select("doc_id", text.name_key(F.col("text"), compose=True).alias("key"))


@query("str_03_fold", f"select c_custkey, {FOLD.format('c_name')} as folded from customer")
def str_03(spark, d):
    return Tables(spark, d).customer.select("c_custkey", text.fold(F.col("c_name")).alias("folded"))


@query("str_04_place_key", f"select p_partkey, nullif({FOLD.format('p_brand')}, '') as key from part")
def str_04(spark, d):
    return Tables(spark, d).part.select("p_partkey", text.place_key(F.col("p_brand")).alias("key"))


OSA = """with recursive n as (select distinct p_name as s from part), t as (select 'rde wigdet' as t, 10 as m),
c as (select s, 0 as k, [0] as d from n
  union all
  select s, q, list_append(d, case when i = 0 then j when j = 0 then i else least(d[q] + 1, d[q - m] + 1, d[q - m - 1] + (s[i] <> t[j])::int,
    case when i > 1 and j > 1 and s[i] = t[j - 1] and s[i - 1] = t[j] then d[q - 2 * m - 3] + 1 else 999 end) end)
  from (select *, k + 1 as q, (k + 1) // (m + 1) as i, (k + 1) % (m + 1) as j from c, t where k < (length(s) + 1) * (m + 1) - 1))
select s as p_name, d[len(d)]::int as distance from c, t where k = (length(s) + 1) * (m + 1) - 1"""


@query("str_05_osa", OSA)
def str_05(spark, d):
    """Restricted edit distances between part names and one typed name; the SQL fills the table cell by cell."""
    names = Tables(spark, d).part.select("p_name").distinct()
    return names.select("p_name", text.osa_distance(F.col("p_name"), F.lit("rde wigdet")).alias("distance"))


@query("str_06_slack", "select distinct p_name, case when length(p_name) >= 9 then 3 when length(p_name) >= 5 then 2 when length(p_name) >= 3 then 1 else 0 end as slack from part")
def str_06(spark, d):
    return Tables(spark, d).part.select("p_name", text.slack(F.col("p_name")).alias("slack")).distinct()


@query("str_07_close_names")
def str_07(spark, d):
    """The three closest known names to typed ones."""
    import pandas as pd

    typed = ["rde bolt", "smal rign", "blue widgte"]
    known = Tables(spark, d).part.select(F.col("p_name").alias("known")).distinct()

    def scored(batches):
        for pdf in batches:
            rows = [(t, k, s) for k in pdf["known"] for t in typed if (s := text.close_score(t, k)) is not None]
            yield pd.DataFrame(rows, columns=["typed", "known", "score"])

    found = known.mapInPandas(scored, "typed string, known string, score double")
    best = A.F.row_number().over(A.Window.partitionBy("typed").orderBy("score", "known"))
    return found.withColumn("k", best).where("k <= 3").select("typed", "known", "score")


@query("str_08_canonical", f"with k as (select c_custkey, c_name, {FOLD.format('c_mktsegment')} as key from customer), s as (select key, max(c_custkey) as last from k group by key) select k.c_custkey, s.last from k join s using (key) where k.c_custkey <> s.last")
def str_08(spark, d):
    k = Tables(spark, d).customer.select("c_custkey", text.fold(F.col("c_mktsegment")).alias("key"))
    return k.join(k.groupBy("key").agg(F.max("c_custkey").alias("last")), "key").where("c_custkey <> last").select("c_custkey", "last")


SHAPE = "case when regexp_matches(url, '^https?://m\\.') then 'mobile' when regexp_matches(url, '^https?://blog\\.') then 'blog' when regexp_matches(url, '#[a-z]+$') then 'anchor' else 'plain' end"


@query("str_09_shape_class", f"select page_id, {SHAPE} as shape from pages")
def str_09(spark, d):
    u = F.col("url")
    shape = F.when(u.rlike(r"^https?://m\."), "mobile").when(u.rlike(r"^https?://blog\."), "blog").when(u.rlike("#[a-z]+$"), "anchor").otherwise("plain")
    return Tables(spark, d).pages.select("page_id", shape.alias("shape"))


@query("str_10_digit_shape", "select regexp_replace(url, '\\d+', '#', 'g') as shape, count(*) as n from pages group by 1")
def str_10(spark, d):
    return Tables(spark, d).pages.groupBy(text.digit_shape(F.col("url")).alias("shape")).agg(F.count("*").alias("n"))


@query("str_11_path_parts", "select page_id, string_split(url, '/')[-1] as base, regexp_replace(url, '/?[^/]*$', '') as folder, string_split(regexp_replace(url, '/?[^/]*$', ''), '/')[-1] as leaf, lower(regexp_extract(string_split(url, '/')[-1], '\\.([A-Za-z0-9]+)$', 1)) as ext from pages")
def str_11(spark, d):
    u = F.col("url")
    return Tables(spark, d).pages.select("page_id", text.basename(u).alias("base"), text.dirname(u).alias("folder"), text.leaf_folder(u).alias("leaf"), text.extension(u).alias("ext"))


@query("str_12_longest_first", "select p_partkey, regexp_replace(regexp_replace(regexp_replace(p_name, '(?i)red widget', '***', 'g'), '(?i)widget', '***', 'g'), '(?i)red', '***', 'g') as masked from part")
def str_12(spark, d):
    return Tables(spark, d).part.select("p_partkey", text.mask(F.col("p_name"), ["red", "widget", "red widget"]).alias("masked"))


@query("str_13_split_part", "select o_orderkey, split_part(o_orderpriority, '-', 1) as level, split_part(o_orderpriority, '-', 2) as word, substr(strftime(o_orderdate, '%Y-%m-%d'), 1, 4) as y from orders")
def str_13(spark, d):
    p = F.col("o_orderpriority")
    return Tables(spark, d).orders.select("o_orderkey", F.split_part(p, F.lit("-"), F.lit(1)).alias("level"), F.split_part(p, F.lit("-"), F.lit(2)).alias("word"), F.substring(F.date_format("o_orderdate", "yyyy-MM-dd"), 1, 4).alias("y"))


@query("str_16_word_frequency", "select w, count(*) as n from (select unnest(regexp_extract_all(lower(text), '[\\p{L}]{4,}')) as w from documents) group by w having count(*) >= 20")
def str_16(spark, d):
    words = Tables(spark, d).documents.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]{4,}"), F.lit(0))).alias("w"))
    return words.groupBy("w").agg(F.count("*").alias("n")).where("n >= 20")


@query("str_17_clock", "select doc_id, case when n_chars >= 3600 then printf('%d:%02d:%02d', n_chars // 3600, n_chars // 60 % 60, n_chars % 60) else printf('%d:%02d', n_chars // 60, n_chars % 60) end as clock from documents")
def str_17(spark, d):
    return Tables(spark, d).documents.select("doc_id", text.clock(F.col("n_chars")).alias("clock"))


@query("str_18_normalise", "select c_custkey, lower(trim(c_name)) as mail, regexp_replace(upper(c_name), '[^A-Z0-9]', '', 'g') as code from customer")
def str_18(spark, d):
    return Tables(spark, d).customer.select("c_custkey", F.lower(F.trim("c_name")).alias("mail"), F.regexp_replace(F.upper("c_name"), "[^A-Z0-9]", "").alias("code"))


NAME = "case o_orderkey % 4 when 0 then 'IMG_' || strftime(o_orderdate, '%Y%m%d') || '_101500.jpg' when 1 then 'scan ' || strftime(o_orderdate, '%Y-%m-%d') || '.png' when 2 then strftime(o_orderdate, '%d.%m.%Y') || ' trip.mov' else 'note' || o_orderkey || '.txt' end"


def _named(o):
    k = F.col("o_orderkey") % 4
    at = F.col("o_orderdate")
    name = F.when(k == 0, F.concat(F.lit("IMG_"), F.date_format(at, "yyyyMMdd"), F.lit("_101500.jpg"))).when(k == 1, F.concat(F.lit("scan "), F.date_format(at, "yyyy-MM-dd"), F.lit(".png"))).when(k == 2, F.concat(F.date_format(at, "dd.MM.yyyy"), F.lit(" trip.mov")))
    return o.withColumn("name", name.otherwise(F.concat(F.lit("note"), F.col("o_orderkey").cast("string"), F.lit(".txt"))))


@query("dat_01_from_name", f"select o_orderkey, case when o_orderkey % 4 < 3 then cast(o_orderdate as date) end as day from (select *, {NAME} as name from orders)")
def dat_01(spark, d):
    return _named(Tables(spark, d).orders).select("o_orderkey", values.date_in_name(F.col("name")).alias("day"))


@query("dat_02_precedence", "select o_orderkey, case when o_orderkey % 4 < 3 then strftime(o_orderdate, '%Y-%m-%d') when o_orderstatus = 'F' then '1990-01-01' end as day, case when o_orderkey % 4 < 3 then 'filename' when o_orderstatus = 'F' then 'folder' end as source from orders")
def dat_02(spark, d):
    folder = F.when(F.col("o_orderstatus") == "F", "1990-01-01")
    day, source = values.first_with_source({"filename": values.date_in_name(F.col("name")).cast("string"), "folder": folder})
    return _named(Tables(spark, d).orders).select("o_orderkey", day.alias("day"), source.alias("source"))


@query("dat_03_epoch", "select event_id, cast(year(to_timestamp(epoch(ts)::bigint)) as int) as y, cast(month(to_timestamp(epoch(ts)::bigint)) as int) as m from events")
def dat_03(spark, d):
    seconds = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    at = F.timestamp_seconds(seconds)
    return Tables(spark, d).events.select("event_id", F.year(at).alias("y"), F.month(at).alias("m"))


@query("dat_04_year_segment", "select page_id, cast(nullif(regexp_extract(url, '/([12][0-9]{3})[0-9]*(?:#|$)', 1), '') as int) as y from pages")
def dat_04(spark, d):
    return Tables(spark, d).pages.select("page_id", F.nullif(F.regexp_extract("url", "/([12][0-9]{3})[0-9]*(?:#|$)", 1), F.lit("")).cast("int").alias("y"))


@query("dat_05_moment", "select o_orderkey, case when o_orderkey % 4 = 0 then date_trunc('day', o_orderdate)::timestamp + interval '10 hours 15 minutes' end as at from orders")
def dat_05(spark, d):
    return _named(Tables(spark, d).orders).select("o_orderkey", values.moment_in_name(F.col("name")).alias("at"))


@query("dat_06_day_text", "select event_id, strftime(ts, '%Y-%m-%d') as day from events")
def dat_06(spark, d):
    return Tables(spark, d).events.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))


@query("dat_07_span", "select user_id, cast(max(ts)::date - min(ts)::date + 1 as int) as days from events group by user_id")
def dat_07(spark, d):
    return Tables(spark, d).events.groupBy("user_id").agg(values.day_span(F.min("ts"), F.max("ts")).alias("days"))


@query("dat_08_relative", "select event_id from events where ts > timestamp '2024-01-20' - interval 3 day and ts <= timestamp '2024-01-20'")
def dat_08(spark, d):
    now = F.lit("2024-01-20").cast("timestamp_ntz")  # given, so that the answer does not depend on the clock
    return Tables(spark, d).events.where((F.col("ts") > now - F.expr("interval 3 days")) & (F.col("ts") <= now)).select("event_id")


@query("dat_09_display", "select o_orderkey, coalesce(case when o_orderstatus='F' then strftime(o_orderdate, '%d/%m/%Y') end, case when o_orderstatus='O' then 'about ' || year(o_orderdate) end, 'undated') as shown from orders")
def dat_09(spark, d):
    s, at = F.col("o_orderstatus"), F.col("o_orderdate")
    shown = F.coalesce(F.when(s == "F", F.date_format(at, "dd/MM/yyyy")), F.when(s == "O", F.concat(F.lit("about "), F.year(at).cast("string"))), F.lit("undated"))
    return Tables(spark, d).orders.select("o_orderkey", shown.alias("shown"))


@query("dat_10_decade_words", "select word, cast(case when regexp_matches(word, '^[0-9]{4}s?$') then substr(word,1,3) || '0' when regexp_matches(word, '^[0-9]0s$') and word >= '30s' then '19' || substr(word,1,2) when regexp_matches(word, '^[0-2]0s$') then '20' || substr(word,1,2) end as int) as decade from (values ('1987'),('1990s'),('80s'),('30s'),('00s'),('20s'),('x')) t(word)")
def dat_10(spark, d):
    from fernglass.operators.search import decade_word

    words = ["1987", "1990s", "80s", "30s", "00s", "20s", "x"]
    return spark.createDataFrame([(w, decade_word(w)) for w in words], "word string, decade int")


@query("mth_01_share", "select source, round(sum(n_chars) / 1e9, 9) as gb, round(count(*) / (select count(*) from documents)::double, 6) as share from documents group by source")
def mth_01(spark, d):
    docs = Tables(spark, d).documents
    per = docs.groupBy("source").agg(F.round(F.sum("n_chars") / 1e9, 9).alias("gb"), F.count("*").alias("n"))
    return per.crossJoin(docs.agg(F.count("*").alias("all"))).select("source", "gb", F.round(values.share(F.col("n"), F.col("all")), 6).alias("share"))


@query("mth_02_turn", "select p_partkey, (p_size * 30 - 450 + 3600) % 360 as angle from part")
def mth_02(spark, d):
    return Tables(spark, d).part.select("p_partkey", values.turned(F.col("p_size") * 30, F.lit(-450)).alias("angle"))


@query("mth_03_turn_box", "select l_orderkey, l_linenumber, round(case l_linenumber % 4 when 0 then l_discount when 1 then 1 - l_tax - 0.3 when 2 then 1 - l_discount - 0.2 else l_tax end, 6) as x, round(case l_linenumber % 4 when 0 then l_tax when 1 then l_discount when 2 then 1 - l_tax - 0.3 else 1 - l_discount - 0.2 end, 6) as y from lineitem")
def mth_03(spark, d):
    box = values.turned_box(F.array(F.col("l_discount"), F.col("l_tax"), F.lit(0.2), F.lit(0.3)), F.col("l_linenumber"))
    rows = Tables(spark, d).lineitem.withColumn("box", box)
    return rows.select("l_orderkey", "l_linenumber", F.round(F.col("box")[0], 6).alias("x"), F.round(F.col("box")[1], 6).alias("y"))


@query("mth_04_iou", "with b as (select l_orderkey, l_linenumber, l_discount as x, l_tax as y, 0.1 + l_quantity / 500 as w from lineitem), p as (select *, greatest(0, least(x + w, 0.25) - greatest(x, 0.05)) * greatest(0, least(y + w, 0.25) - greatest(y, 0.05)) as i from b) select l_orderkey, l_linenumber, round(i / (w * w + 0.04 - i), 6) as iou from p")
def mth_04(spark, d):
    w = 0.1 + F.col("l_quantity") / 500
    iou = values.overlap([F.col("l_discount"), F.col("l_tax"), w, w], [F.lit(0.05), F.lit(0.05), F.lit(0.2), F.lit(0.2)])
    return Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", F.round(iou, 6).alias("iou"))


@query("mth_05_aspect", "select l_orderkey, l_linenumber from lineitem where abs(ln((l_quantity / (l_linenumber * 8.0)) / (16.0 / 9.0))) <= 0.03")
def mth_05(spark, d):
    same = values.same_shape(F.col("l_quantity"), F.col("l_linenumber") * 8.0, F.lit(16.0), F.lit(9.0))
    return Tables(spark, d).lineitem.where(same).select("l_orderkey", "l_linenumber")


@query("mth_06_offsets", "with n as (select doc_id, n_chars / 10.0 as s, case when n_chars / 10.0 < 10 then 1 when n_chars / 10.0 < 60 then 3 when n_chars / 10.0 < 600 then 5 else 8 end as n from documents) select doc_id, cast(k as int) as k, round(s * (2 * k - 1) / (2 * n), 6) as at from n, lateral (select unnest(range(1, n + 1)) as k)")
def mth_06(spark, d):
    rows = Tables(spark, d).documents.select("doc_id", F.posexplode(values.sample_offsets(F.col("n_chars") / 10.0)).alias("p", "at"))
    return rows.select("doc_id", (F.col("p") + 1).alias("k"), "at")


@query("mth_07_segments", "select doc_id, unnest(range(0, n_chars, 1200)) as start from documents where n_chars > 0")
def mth_07(spark, d):
    return Tables(spark, d).documents.select("doc_id", F.explode(values.segments(F.col("n_chars"))).alias("start"))


@query("mth_08_subject_share", "select p_partkey, coalesce(case when p_size > 5 then least(p_size, 20) / 100.0 end >= 0.12, true) as subject from part")
def mth_08(spark, d):
    size = F.col("p_size")
    share = F.when(size > 5, F.least(size, F.lit(20)) / 100.0)  # an unknown frame keeps
    return Tables(spark, d).part.select("p_partkey", F.coalesce(share >= 0.12, F.lit(True)).alias("subject"))


@query("arr_01_explode", "select doc_id, unnest(regexp_extract_all(text, '[0-9]{3,}')) as number from documents")
def arr_01(spark, d):
    return Tables(spark, d).documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[0-9]{3,}"), F.lit(0))).alias("number"))


@query("arr_02_contains", "with a as (select o_custkey, list(distinct o_orderpriority) as p from orders group by 1) select o_custkey, list_contains(p, '1-URGENT') as urgent, list_has_any(p, ['4-NOT SPECIFIED','5-LOW']) as low, list_has_all(p, ['2-HIGH','3-MEDIUM']) as both from a")
def arr_02(spark, d):
    a = Tables(spark, d).orders.groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("p"))
    both = F.size(F.array_intersect("p", F.array(F.lit("2-HIGH"), F.lit("3-MEDIUM")))) == 2
    return a.select("o_custkey", F.array_contains("p", "1-URGENT").alias("urgent"), F.arrays_overlap("p", F.array(F.lit("4-NOT SPECIFIED"), F.lit("5-LOW"))).alias("low"), both.alias("both"))


@query("arr_03_ordered_first", "select o_custkey, list(o_orderkey order by o_orderdate, o_orderkey)[1] as first_order from orders group by o_custkey")
def arr_03(spark, d):
    return Tables(spark, d).orders.groupBy("o_custkey").agg(F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("first_order"))


@query("arr_04_to_string", "select conv_id, string_agg(role, '>' order by turn) as roles from conversations group by conv_id")
def arr_04(spark, d):
    rows = Tables(spark, d).conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("a"))
    return rows.select("conv_id", F.array_join("a.role", ">").alias("roles"))


@query("arr_05_sorted_set", "select l_partkey, list_sort(list(distinct l_suppkey)) as suppliers from lineitem group by l_partkey")
def arr_05(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_partkey").agg(F.array_sort(F.collect_set("l_suppkey")).alias("suppliers"))


@query("jsn_01_outermost", "select event_id, cast(json_extract_string(regexp_extract('said: ' || props || ' end', '(?s)\\{.*\\}', 0), '$.k') as int) as k from events")
def jsn_01(spark, d):
    said = F.concat(F.lit("said: "), F.col("props"), F.lit(" end"))
    return Tables(spark, d).events.select("event_id", F.from_json(text.outermost_json(said), "k int")["k"].alias("k"))


@query("jsn_02_double_encoded", "select event_id, cast(json_extract_string(props, '$.k') as int) as k from events")
def jsn_02(spark, d):
    stored = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.concat(F.lit('"'), F.regexp_replace("props", '"', r'\\"'), F.lit('"')))
    once = F.from_json(stored, "k int")["k"]
    twice = F.from_json(F.from_json(F.concat(F.lit('{"s":'), stored, F.lit("}")), "s string")["s"], "k int")["k"]
    return Tables(spark, d).events.select("event_id", F.coalesce(once, twice).alias("k"))


@query("jsn_03_counts", "select event_type, cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as k from events group by event_type")
def jsn_03(spark, d):
    counts = F.explode(F.from_json("props", "map<string,bigint>")).alias("name", "v")
    return Tables(spark, d).events.select("event_type", counts).where("name = 'k'").groupBy("event_type").agg(F.sum("v").alias("k"))


@query("hsh_01_content", "select doc_id, sha256(text) as whole, md5(length(text) || '|' || substr(text, 1, 64) || '|' || case when length(text) > 128 then substr(text, length(text) - 63) else '' end) as ends from documents")
def hsh_01(spark, d):
    return Tables(spark, d).documents.select("doc_id", F.sha2("text", 256).alias("whole"), hashes.signature(F.col("text"), 64).alias("ends"))


@query("hsh_02_digests", "select doc_id, md5(text) as m, sha256(text) as s2, sha1(text) as s1 from documents")
def hsh_02(spark, d):
    return Tables(spark, d).documents.select("doc_id", F.md5(F.col("text").cast("binary")).alias("m"), F.sha2("text", 256).alias("s2"), F.sha1(F.col("text").cast("binary")).alias("s1"))


@query("hsh_03_keyed", "select c_custkey, sha256('pepper|' || c_name || '|' || c_mktsegment) as h from customer")
def hsh_03(spark, d):
    return Tables(spark, d).customer.select("c_custkey", hashes.keyed("pepper", F.col("c_name"), F.col("c_mktsegment")).alias("h"))


@query("hsh_04_uuid5", """with h as (select c_custkey, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(c_name || '|' || c_mktsegment)) as h from customer)
select c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr(h, 17, 1)), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) as id from h""")
def hsh_04(spark, d):
    """Name-based ids, which neither engine has a function for."""
    return Tables(spark, d).customer.select("c_custkey", hashes.uuid5(F.concat_ws("|", "c_name", "c_mktsegment")).alias("id"))


QUERIES, SQL = query.queries, query.sql
