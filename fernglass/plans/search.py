"""Queries of sections SRH, CLU, GEO and the query parser (STR-14, STR-15)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fernglass.functions import values
from fernglass.operators import aggregates as A
from fernglass.operators import clusters as C
from fernglass.operators import search as S
from fernglass.plans.base import Family, Tables

query = Family()

PEOPLE, PLACES, COUNTRIES = ["Asha Lane", "Ben Cole", "Cleo Park"], ["Alder Bay", "Birch Hill"], ["Norland"]
TYPED = ["asha lane alder bay 1998", "cole videos from the 90s", "norland photos sunset", "park birch hill 2001", "ben cole asha lane dinner"]


@query("str_14_parse", """select * from (values
('asha lane alder bay 1998', ['Asha Lane'], 'Alder Bay', null, 1998::int, 1998::int, null, ''),
('cole videos from the 90s', ['Ben Cole'], null, null, 1990, 1999, 'video', ''),
('norland photos sunset', []::varchar[], null, 'Norland', null, null, 'photo', 'sunset'),
('park birch hill 2001', ['Cleo Park'], 'Birch Hill', null, 2001, 2001, null, ''),
('ben cole asha lane dinner', ['Asha Lane', 'Ben Cole'], null, null, null, null, null, 'dinner')) v(typed, people, place, country, year_from, year_to, media, rest)""")
def str_14(spark, d):
    """Typed queries as filters; the parser runs on the driver, as a query is one line."""
    rows = [(t, list(s.people), s.place, s.country, s.year_from, s.year_to, s.media, s.rest) for t in TYPED for s in [S.parse(t, PEOPLE, PLACES, COUNTRIES)]]
    return spark.createDataFrame(rows, "typed string, people array<string>, place string, country string, year_from int, year_to int, media string, rest string")


@query("str_15_compose", """select * from (values
('Asha Lane Alder Bay 1998', 'Everything with Asha Lane in Alder Bay from 1998.'),
('Ben Cole 1990s video', 'Videos with Ben Cole from 1990 to 1999.'),
('Norland photo sunset', 'Photos in Norland about sunset.'),
('Cleo Park Birch Hill 2001', 'Everything with Cleo Park in Birch Hill from 2001.'),
('Asha Lane Ben Cole dinner', 'Everything with Asha Lane and Ben Cole about dinner.')) v(text, sentence)""")
def str_15(spark, d):
    rows = [(S.compose(s), S.describe(s)) for t in TYPED for s in [S.parse(t, PEOPLE, PLACES, COUNTRIES)]]
    return spark.createDataFrame(rows, "text string, sentence string")


SEARCH = """with wanted as (select l_orderkey from lineitem where l_suppkey in (3, 7, 12) group by 1 having count(distinct l_suppkey) >= 2)
select o_orderkey, year(o_orderdate)::int as y, count(*) over () as total from orders where o_orderkey in (select l_orderkey from wanted) and year(o_orderdate) between 1995 and 2000 and o_orderstatus <> 'P' order by o_orderdate desc, o_orderkey limit 60"""


@query("srh_01_search", SEARCH)
def srh_01(spark, d):
    t = Tables(spark, d)
    wanted = t.lineitem.where(F.col("l_suppkey").isin(3, 7, 12)).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count_distinct("l_suppkey").alias("n")).where("n >= 2")
    shown = t.orders.join(wanted, "o_orderkey", "left_semi").withColumn("y", F.year("o_orderdate")).where(F.col("y").between(1995, 2000) & (F.col("o_orderstatus") != "P"))
    return shown.orderBy(F.desc("o_orderdate"), "o_orderkey").limit(60).select("o_orderkey", "y").crossJoin(shown.agg(F.count("*").alias("total")))


FACETS = """with o as (select o_orderkey, o_orderstatus as s, cast(year(o_orderdate) as varchar) as y, o_orderpriority as p from orders)
select 'status' as facet, s as v, count(*) as n from o where y = '1998' and p = '2-HIGH' group by s
union all select 'year', y, count(*) from o where s = 'F' and p = '2-HIGH' group by y
union all select 'priority', p, count(*) from o where s = 'F' and y = '1998' group by p"""


@query("srh_02_facets", FACETS)
def srh_02(spark, d):
    o = Tables(spark, d).orders.select("o_orderstatus", F.year("o_orderdate").alias("year"), "o_orderpriority")
    dims = {"status": ("o_orderstatus", F.col("o_orderstatus") == "F"), "year": ("year", F.col("year") == 1998), "priority": ("o_orderpriority", F.col("o_orderpriority") == "2-HIGH")}
    return S.facets(o, dims)


NESTED = """with c as (select c_custkey, c_mktsegment as seg, n_name as place, r_name as country from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
select 'segment' as facet, seg as v, count(*) as n from c where place = 'NATION_3' and country = 'AMERICA' group by seg
union all select 'place', place, count(*) from c where seg = 'BUILDING' and country = 'AMERICA' group by place
union all select 'country', country, count(*) from c where seg = 'BUILDING' group by country"""


@query("srh_02_facets_nested", NESTED)
def srh_02b(spark, d):
    """Counts by country leave out the place filter as well as their own."""
    t = Tables(spark, d)
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    dims = {"segment": ("c_mktsegment", F.col("c_mktsegment") == "BUILDING"), "place": ("n_name", F.col("n_name") == "NATION_3"), "country": ("r_name", F.col("r_name") == "AMERICA")}
    return S.facets(c, dims, {"country": ("place",)})


RANK = """with t as (select doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') as w from documents),
f as (select doc_id, len(w) as n, len(list_filter(w, lambda x: x = 'the')) as a, len(list_filter(w, lambda x: x = 'idiot')) as b from t)
select doc_id, round((2 + ln(a) + ln(b)) / sqrt(n), 9) as score from f where a > 0 and b > 0 order by score desc, doc_id limit 50"""


@query("srh_03_text_rank", RANK)
def srh_03(spark, d):
    """Documents with both words, ranked by term frequency; a rank of this repository's own."""
    ranked = S.text_rank(Tables(spark, d).documents, "doc_id", "text", ["the", "idiot"])
    return ranked.withColumn("score", F.round("score", 9)).orderBy(F.desc("score"), "doc_id").limit(50)


POSTINGS = "with t as (select doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) as term from documents) select term, doc_id, count(*) as tf from t group by 1, 2"


@query("srh_04_postings", POSTINGS)
def srh_04(spark, d):
    return S.postings(Tables(spark, d).documents, "doc_id", ["text"]).select("term", "doc_id", "tf")


@query("srh_05_cosine", "select v.vec_id, round(list_cosine_similarity(v.embedding::double[], q.embedding::double[]), 4) as sim from embeddings v, (select embedding from embeddings where vec_id = 0) q")
def srh_05(spark, d):
    e = Tables(spark, d).embeddings
    q = e.where("vec_id = 0").select(F.col("embedding").alias("q"))  # one row
    return e.crossJoin(q).select("vec_id", F.round(values.cosine(F.col("embedding"), F.col("q")), 4).alias("sim"))


KNN = """with q as (select vec_id as query, embedding::double[] as e from embeddings where vec_id % 20 = 0),
s as (select q.query, v.vec_id as key, list_cosine_similarity(v.embedding::double[], q.e) as sim from embeddings v, q),
r as (select *, row_number() over (partition by query order by sim desc, key) as rank from s) select query, key, round(sim, 4) as sim, cast(rank as int) as rank from r where rank <= 10"""


@query("srh_06_knn", KNN)
def srh_06(spark, d):
    """The ten nearest vectors to every vector whose id is divisible by 20, among all."""
    e = Tables(spark, d).embeddings
    found = S.nearest(e, "vec_id", "embedding", e.where("vec_id % 20 = 0"), "vec_id", "embedding", 10)
    return found.select("query", "key", F.round("sim", 4).alias("sim"), "rank")


CENTRE = """with c as (select label, i, avg(embedding[i]::double) as x from embeddings, range(1, 65) t(i) group by label, i), m as (select label, list(x order by i) as c from c group by label),
s as (select vec_id, m.label as name, list_cosine_similarity(embedding::double[], m.c) as sim, row_number() over (partition by vec_id order by list_cosine_similarity(embedding::double[], m.c) desc, m.label) as k from embeddings, m)
select vec_id, name, round(sim, 4) as sim from s where k = 1 and sim >= 0.3"""


@query("srh_07_nearest_centre", CENTRE)
def srh_07(spark, d):
    e = Tables(spark, d).embeddings
    centres = A.mean_vectors(e, ["label"], "embedding")
    return S.nearest_centre(e, "vec_id", "embedding", centres, "label", "centre", 0.3).select(F.col("key").alias("vec_id"), "name", F.round("sim", 4).alias("sim"))


SUGGEST = """with c as (select label, i, avg(embedding[i]::double) as x from embeddings, range(1, 65) t(i) group by label, i), m as (select label, list(x order by i) as c from c group by label),
s as (select a.label as grp, b.label as name, list_cosine_similarity(a.c, b.c) as sim from m a, m b where a.label <> b.label), r as (select *, row_number() over (partition by grp order by sim desc, name) as k from s)
select grp, name, round(sim, 4) as score from r where k <= 4 and sim >= -0.05"""


@query("srh_08_suggestions", SUGGEST)
def srh_08(spark, d):
    """Up to four names for each group: pairs of centres, of which there are as many as labels."""
    m = A.mean_vectors(Tables(spark, d).embeddings, ["label"], "embedding").select("label", "centre")
    pairs = m.crossJoin(m.toDF("name", "other")).where("label <> name").withColumn("sim", values.cosine(F.col("centre"), F.col("other"))).where("sim >= -0.05")
    w = Window.partitionBy("label").orderBy(F.desc("sim"), "name")
    return pairs.withColumn("k", F.row_number().over(w)).where("k <= 4").select(F.col("label").alias("grp"), "name", F.round("sim", 4).alias("score"))


FILTERED = """with q as (select embedding::double[] as e from embeddings where vec_id = 7) select vec_id, round(list_cosine_similarity(embedding::double[], e), 4) as sim from embeddings, q where label in (1, 3, 5) and vec_id % 3 = 0 order by list_cosine_similarity(embedding::double[], e) desc, vec_id limit 15"""


@query("srh_09_filtered_ranking", FILTERED)
def srh_09(spark, d):
    e = Tables(spark, d).embeddings
    q = e.where("vec_id = 7").select(F.col("embedding").alias("q"))
    kept = e.where(F.col("label").isin(1, 3, 5) & (F.col("vec_id") % 3 == 0)).crossJoin(q).withColumn("s", values.cosine(F.col("embedding"), F.col("q")))
    return kept.orderBy(F.desc("s"), "vec_id").limit(15).select("vec_id", F.round("s", 4).alias("sim"))


@query("srh_10_vocabulary", "select distinct 'place' as kind, n_name as word from nation union select distinct 'segment', c_mktsegment from customer")
def srh_10(spark, d):
    t = Tables(spark, d)
    return t.nation.select(F.lit("place").alias("kind"), F.col("n_name").alias("word")).union(t.customer.select(F.lit("segment"), "c_mktsegment")).distinct()


@query("srh_11_browse", "select 'segment' as list, c_mktsegment as v, count(*) as n from customer group by 2 union all select 'nation', n_name, count(*) from customer join nation on c_nationkey = n_nationkey group by 2")
def srh_11(spark, d):
    t = Tables(spark, d)
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    lists = F.explode(F.array(F.struct(F.lit("segment").alias("list"), F.col("c_mktsegment").alias("v")), F.struct(F.lit("nation").alias("list"), F.col("n_name").alias("v")))).alias("p")
    return named.select(lists).groupBy("p.list", "p.v").agg(F.count("*").alias("n"))


@query("clu_01_greedy")
def clu_01(spark, d):
    """Vectors of a label folded into running means; every row may start a cluster."""
    e = Tables(spark, d).embeddings
    return C.greedy(e, "vec_id", "embedding", F.col("vec_id") % 7, join=0.55, seed=-1.0, block=F.col("label"))


@query("clu_02_seeded")
def clu_02(spark, d):
    """The same, but a row of a low score starts none."""
    e = Tables(spark, d).embeddings
    return C.greedy(e, "vec_id", "embedding", (F.col("vec_id") % 10) / 10.0, join=0.55, seed=0.6, block=F.col("label"))


def _groups(spark, d):
    m = A.mean_vectors(Tables(spark, d).embeddings.withColumn("cluster", F.col("label") * 10 + F.col("vec_id") % 10), ["cluster"], "embedding")
    named = m.withColumn("name", F.when(F.col("cluster") % 3 == 0, F.concat(F.lit("n"), (F.col("cluster") % 5).cast("string"))))
    return named, C.merge(named, "cluster", "centre", "n", "name", 0.4)


@query("clu_03_merge")
def clu_03(spark, d):
    return _groups(spark, d)[1]


@query("clu_04_conflicts", "select l_partkey as grp, count(distinct l_returnflag) as names from lineitem where l_quantity > 45 group by 1 having count(distinct l_returnflag) > 1")
def clu_04(spark, d):
    """Groups whose members have several names. (That a merge leaves none is for the tests.)"""
    name = F.when(F.col("l_quantity") > 45, F.col("l_returnflag"))
    return C.conflicts(Tables(spark, d).lineitem.select(F.col("l_partkey").alias("grp"), name.alias("name")), "grp", "name")


@query("clu_05_spread_names", "with m as (select l_suppkey, l_partkey % 40 as grp, case when l_partkey % 40 < 20 and l_suppkey = 5 then 'only' when l_partkey % 40 >= 20 and l_suppkey in (6, 7) then 'n' || l_suppkey end as name from lineitem group by all), o as (select grp, min(name) as name from m where name is not null group by 1 having min(name) = max(name)) select m.l_suppkey, m.grp, o.name from m join o using (grp) where m.name is null")
def clu_05(spark, d):
    s = F.col("l_suppkey")
    g = F.col("l_partkey") % 40
    name = F.when((g < 20) & (s == 5), "only").when((g >= 20) & s.isin(6, 7), F.concat(F.lit("n"), s.cast("string")))
    m = Tables(spark, d).lineitem.select("l_suppkey", g.alias("grp"), name.alias("name")).distinct().withColumn("key", F.struct("l_suppkey", "grp"))
    return C.spread_names(m, "grp", "key", "name").select("key.l_suppkey", "key.grp", "name")


@query("clu_06_next_id", "select greatest((select max(s_suppkey) from supplier), (select max(l_suppkey) from lineitem), 57) + 1 as next_id")
def clu_06(spark, d):
    t = Tables(spark, d)
    tops = t.supplier.agg(F.max("s_suppkey").alias("a")).crossJoin(t.lineitem.agg(F.max("l_suppkey").alias("b")))
    return tops.select(C.next_id(F.lit(57).cast("long"), F.col("a"), F.col("b")).alias("next_id"))


@query("clu_07_kept_ids", "select vec_id, vec_id % 9 as prior, cast(label as bigint) as cluster from embeddings where vec_id % 2 = 0 and vec_id % 9 <> label")
def clu_07(spark, d):
    e = Tables(spark, d).embeddings.select("vec_id", F.col("label").cast("long").alias("cluster"))
    prior = e.where("vec_id % 2 = 0").select("vec_id", (F.col("vec_id") % 9).alias("cluster"))
    return C.kept_ids(e, prior, "vec_id", "cluster")[1]


@query("clu_08_provenance", "select p_partkey, exists (select 1 from lineitem where l_partkey = p_partkey and l_quantity > 49) as from_video from part")
def clu_08(spark, d):
    t = Tables(spark, d)
    members = t.lineitem.where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey")).distinct().withColumn("_in", F.lit(True))
    return t.part.join(members, "p_partkey", "left").select("p_partkey", F.coalesce("_in", F.lit(False)).alias("from_video"))


@query("clu_09_backfill", "select distinct l_orderkey, l_suppkey from lineitem where l_returnflag = 'R' except select l_orderkey, l_suppkey from lineitem where l_returnflag = 'A'")
def clu_09(spark, d):
    li = Tables(spark, d).lineitem
    pairs = lambda flag: li.where(F.col("l_returnflag") == flag).select("l_orderkey", "l_suppkey").distinct()
    return pairs("R").join(pairs("A"), ["l_orderkey", "l_suppkey"], "left_anti")


GEO = """with p as (select s_suppkey as id, (s_suppkey * 37 % 120 - 60) + 0.5 as lat, (s_suppkey * 101 % 300 - 150) + 0.25 as lon from supplier),
c as (select c_custkey, (c_custkey * 37 % 120 - 60) + 0.5 + (c_custkey % 13) * 0.02 as lat, (c_custkey * 101 % 300 - 150) + 0.25 + (c_custkey % 7) * 0.03 as lon from customer),
m as (select c_custkey, id, 2 * 6371.0 * asin(least(1.0, sqrt(pow(cos(radians(c.lat))*cos(radians(c.lon)) - cos(radians(p.lat))*cos(radians(p.lon)), 2) + pow(cos(radians(c.lat))*sin(radians(c.lon)) - cos(radians(p.lat))*sin(radians(p.lon)), 2) + pow(sin(radians(c.lat)) - sin(radians(p.lat)), 2)) / 2)) as km from c, p),
r as (select *, row_number() over (partition by c_custkey order by km, id) as k from m where km <= 25)
select c_custkey, id as place, round(km, 4) as km, round(greatest(0.5, 1 - km / 50), 4) as confidence from r where k = 1"""


def _near(spark, d):
    t = Tables(spark, d)
    at = lambda k: ((F.col(k) * 37 % 120 - 60 + 0.5), (F.col(k) * 101 % 300 - 150 + 0.25))
    lat, lon = at("s_suppkey")
    places = t.supplier.select(F.col("s_suppkey").alias("id"), lat.alias("lat"), lon.alias("lon"))
    lat, lon = at("c_custkey")
    points = t.customer.select("c_custkey", (lat + (F.col("c_custkey") % 13) * 0.02).alias("lat"), (lon + (F.col("c_custkey") % 7) * 0.03).alias("lon"))
    return points, S.nearest_place(points, "c_custkey", places)


@query("geo_01_nearest", GEO)
def geo_01(spark, d):
    return _near(spark, d)[1].select("c_custkey", "place", F.round("km", 4).alias("km"), F.round("confidence", 4).alias("confidence"))


@query("geo_02_radius_rule", GEO.replace("select c_custkey, id as place, round(km, 4) as km, round(greatest(0.5, 1 - km / 50), 4) as confidence from r where k = 1", "select c.c_custkey, case when r.km <= 10 then 'at ' || r.id when r.id is not null then 'near ' || r.id else 'nowhere' end as place from c left join r on r.c_custkey = c.c_custkey and r.k = 1"))
def geo_02(spark, d):
    points, near = _near(spark, d)
    rows = points.select("c_custkey").join(near, "c_custkey", "left")
    said = F.when(F.col("km") <= 10, F.concat(F.lit("at "), F.col("place").cast("string"))).when(F.col("place").isNotNull(), F.concat(F.lit("near "), F.col("place").cast("string"))).otherwise("nowhere")
    return rows.select("c_custkey", said.alias("place"))


@query("geo_03_learn_country", "with seen as (select c_nationkey as place, c_mktsegment as country from customer), m as (select place, country from (select place, country, row_number() over (partition by place order by count(*) desc, country) as k from seen group by 1, 2) where k = 1) select n_nationkey as place, case when n_nationkey % 6 = 0 then 'by hand' else m.country end as country from nation left join m on m.place = n_nationkey")
def geo_03(spark, d):
    t = Tables(spark, d)
    learnt = A.mode_of(t.customer, ["c_nationkey"], "c_mktsegment", "country")
    hand = F.when(F.col("n_nationkey") % 6 == 0, "by hand")
    return t.nation.join(learnt, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(F.col("n_nationkey").alias("place"), F.coalesce(hand, F.col("country")).alias("country"))


@query("geo_04_country_precedence", "select c_custkey, coalesce(case when c_acctbal > 9000 then 'family' end, case when c_custkey % 3 = 0 then r_name end, n_name) as country from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def geo_04(spark, d):
    t = Tables(spark, d)
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return c.select("c_custkey", F.coalesce(F.when(F.col("c_acctbal") > 9000, "family"), F.when(F.col("c_custkey") % 3 == 0, F.col("r_name")), F.col("n_name")).alias("country"))


@query("geo_05_folder_guess", "select p_partkey, case when regexp_matches(p_name, '(?i)\\bred\\b') then 'Redland' when regexp_matches(p_name, '(?i)\\bblue\\b') then 'Blueland' end as place from part")
def geo_05(spark, d):
    p = F.col("p_name")
    return Tables(spark, d).part.select("p_partkey", F.when(p.rlike(r"(?i)\bred\b"), "Redland").when(p.rlike(r"(?i)\bblue\b"), "Blueland").alias("place"))


QUERIES, SQL = query.queries, query.sql
