"""Queries that write files from the tables, in the shared folder, and read them back by the readers and sinks."""

import io
import tarfile
import zipfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernglass.operators import intake
from fernglass.operators.storage import mounted, place
from fernglass.plans.base import Family, Tables
from fernglass.sources import archives, exif, files, paged, sinks

query = Family()


@query("src_02_csv", "select c_custkey, c_name, round(c_acctbal, 2) as c_acctbal, c_mktsegment from customer")
def src_02(spark, d):
    at = place(spark, "csv")
    Tables(spark, d).customer.select("c_custkey", "c_name", F.round("c_acctbal", 2).alias("c_acctbal"), "c_mktsegment").write.csv(at, header=True)
    return files.csv(spark, at, "c_custkey long, c_name string, c_acctbal double, c_mktsegment string")


@query("src_03_positional_csv", "select c_custkey, c_name from customer where c_custkey % 3 <> 0")
def src_03(spark, d):
    """Every third line is short and is skipped."""
    at = place(spark, "lines")
    line = F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey").cast("string")).otherwise(F.concat_ws(",", "c_custkey", "c_name"))
    Tables(spark, d).customer.select(line.alias("value")).write.text(at)
    return files.positional_csv(spark, at, "c_custkey long, c_name string", ["c_name"])


@query("src_04_nested_json", "select n_name as start, c_custkey as hash from customer join nation on n_nationkey = c_nationkey")
def src_04(spark, d):
    """One document for each nation, {events: [{start, hash: [...]}]}."""
    t = Tables(spark, d)
    at = place(spark, "json")
    rows = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).groupBy("n_name").agg(F.collect_list("c_custkey").alias("hash"))
    rows.select(F.array(F.struct(F.col("n_name").alias("start"), "hash")).alias("events")).repartition(5).write.option("maxRecordsPerFile", 1).json(at)
    return files.nested_json(spark, at, "events array<struct<start: string, hash: array<bigint>>>", "events", "hash").select("start", "hash")


@query("src_06_sqlite", "select n_nationkey, n_name, n_regionkey from nation")
def src_06(spark, d):
    """A SQLite file of nations, opened read-only by ranges of rowid."""
    import os
    import sqlite3

    at = mounted(place(spark, "sqlite"))
    os.makedirs(at)
    rows = Tables(spark, d).nation.select("n_nationkey", "n_name", "n_regionkey").collect()  # 25 rows at every scale
    con = sqlite3.connect(f"{at}/nations.db")
    con.execute("create table nation (n_nationkey integer, n_name text, n_regionkey integer)")
    con.executemany("insert into nation values (?, ?, ?)", [tuple(r) for r in rows])
    con.commit()
    con.close()
    spark.dataSource.register(paged.SqliteSource)
    return spark.read.format("sqlite").options(path=f"{at}/nations.db", table="nation", columns="n_nationkey,n_name,n_regionkey", parts="4", schema="n_nationkey int, n_name string, n_regionkey int").load()


@query("src_09_listing", "select cast(n_regionkey as varchar) as root, cast(n_nationkey as bigint) as id, n_name as value from nation")
def src_09(spark, d):
    """Nations listed region by region, two a page, each page with the token of the next."""
    at = place(spark, "listing")
    Tables(spark, d).nation.select("n_regionkey", F.col("n_nationkey").cast("long").alias("id"), "n_name").coalesce(1).write.parquet(at)
    spark.dataSource.register(paged.ListedSource)
    roots = ",".join(str(r[0]) for r in Tables(spark, d).region.select("r_regionkey").collect())  # five rows at every scale
    return spark.read.format("listed").options(table=mounted(at), roots=roots, transport="fernglass.sources.paged:parquet_pages").load()


def _archives(spark, d) -> str:
    """A zip with a member for each nation and a tar of the same, in one folder."""
    import os

    at = mounted(place(spark, "archives"))
    os.makedirs(at)
    rows = Tables(spark, d).nation.select("n_nationkey", "n_name").collect()  # 25 rows at every scale
    with zipfile.ZipFile(f"{at}/part-001.zip", "w", zipfile.ZIP_DEFLATED) as z, tarfile.open(f"{at}/part-002.tar.gz", "w:gz") as t:
        for key, name in rows:
            z.writestr(f"in/{key}.txt", name)
            info = tarfile.TarInfo(f"in/{key}.txt")
            info.size = len(name.encode())
            t.addfile(info, io.BytesIO(name.encode()))
    with open(f"{at}/part-004.zip", "wb") as f:
        f.write(b"PK broken")
    return at


def _archive():
    return F.element_at(F.split("path", "/"), -1).alias("archive")


@query("src_10_member_streams", "select a as archive, concat('in/', n_nationkey, '.txt') as member, n_name as said from nation, (values ('part-001.zip'), ('part-002.tar.gz')) v(a) where n_nationkey % 2 = 1")
def src_10(spark, d):
    """Contents of members that an earlier run has not taken."""
    at = _archives(spark, d)
    whole = archives.members(spark, at, "part-00[12].*")
    done = whole.where(F.regexp_extract("member", r"(\d+)", 1).cast("int") % 2 == 0).select("path", "member")
    return archives.members(spark, at, "part-00[12].*", content_to=1 << 20, done=done).select(_archive(), "member", F.col("content").cast("string").alias("said"))


@query("src_11_directory", "select 'part-001.zip' as archive, concat('in/', n_nationkey, '.txt') as member, strlen(n_name) as bytes from nation union all select 'part-004.zip', null, null")
def src_11(spark, d):
    """Names and sizes from the directories of zips alone; the broken one has none."""
    return archives.members(spark, _archives(spark, d), "*.zip").select(_archive(), "member", "bytes")


@query("src_12_member_digests", "select a as archive, concat('in/', n_nationkey, '.txt') as member, sha256(n_name) as sha256 from nation, (values ('part-001.zip'), ('part-002.tar.gz')) v(a)")
def src_12(spark, d):
    return archives.members(spark, _archives(spark, d), "part-00[12].*", digest=True).select(_archive(), "member", "sha256")


@F.pandas_udf(T.StringType())
def _as_float16(vectors: pd.Series) -> pd.Series:
    import base64

    return vectors.map(lambda v: base64.b64encode(np.array(v, "<f2").tobytes()).decode())


@query("src_14_half_floats", "select vec_id, label::double as a, (vec_id % 1000)::double as b, 0.5::double as c from embeddings")
def src_14(spark, d):
    """Vectors in CSV cells, base64 of half-precision numbers."""
    at = place(spark, "half")
    vectors = F.array(F.col("label").cast("float"), (F.col("vec_id") % 1000).cast("float"), F.lit(0.5).cast("float"))
    Tables(spark, d).embeddings.select("vec_id", _as_float16(vectors).alias("cell")).write.csv(at, header=True)
    read = files.csv(spark, at, "vec_id long, cell string").withColumn("v", files.float16_base64("cell"))
    return read.select("vec_id", *[F.col("v")[i].cast("double").alias(n) for i, n in enumerate("abc")])


@F.pandas_udf(T.BinaryType())
def _as_float32(vectors: pd.Series) -> pd.Series:
    return vectors.map(lambda v: np.array(v, "<f4").tobytes())


@query("src_15_float_blobs", "select vec_id, case when vec_id % 7 <> 0 then round(embedding[2]::double, 5) end as x from embeddings")
def src_15(spark, d):
    """Blobs of 64 numbers; those of another length read as null."""
    v = F.when(F.col("vec_id") % 7 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    rows = Tables(spark, d).embeddings.select("vec_id", _as_float32(v).alias("blob"))
    return rows.select("vec_id", F.round(files.float32_blob(64)("blob")[1].cast("double"), 5).alias("x"))


@F.pandas_udf(T.BinaryType())
def _photo(key: pd.Series, priority: pd.Series, when: pd.Series) -> pd.Series:
    return pd.Series([exif.write(t, "Maker " + p[0], p, (k % 170 - 85) + 0.5, (k % 340 - 170) + 0.25, int(k % 4000) + 1, int(k % 3000) + 1, "<>"[k % 2]) for k, p, t in zip(key, priority, when)])


@query("src_17_exif", "select o_orderkey, date_trunc('second', o_orderdate)::timestamp as taken, 'Maker ' || o_orderpriority[1] as make, o_orderpriority as model, round(o_orderkey % 170 - 85 + case when o_orderkey % 170 - 85 + 0.5 < 0 then 0.5 else 0.5 end, 4)::double as lat, round(o_orderkey % 340 - 170 + 0.25, 4)::double as lon, (o_orderkey % 4000 + 1)::int as width, (o_orderkey % 3000 + 1)::int as height from orders")
def src_17(spark, d):
    """Headers of invented photographs, in both byte orders."""
    photo = _photo(F.col("o_orderkey"), F.col("o_orderpriority"), F.date_format("o_orderdate", "yyyy:MM:dd HH:mm:ss"))
    rows = Tables(spark, d).orders.select("o_orderkey", exif.exif(photo).alias("e"))
    return rows.select("o_orderkey", "e.taken", "e.make", "e.model", F.round("e.lat", 4).alias("lat"), F.round("e.lon", 4).alias("lon"), "e.width", "e.height")


@query("src_18_dimensions", "select p_partkey, case when p_partkey % 3 = 2 then null else p_size end as width, case when p_partkey % 3 = 2 then null else (p_partkey % 500 + 1)::int end as height, case p_partkey % 3 when 0 then 'png' when 1 then 'jpeg' end as kind from part")
def src_18(spark, d):
    """Headers of PNG and JPEG files, and of files that are neither."""
    def number(c, digits):
        return F.unhex(F.lpad(F.hex(c.cast("bigint")), digits, "0"))

    w, h = F.col("p_size"), F.col("p_partkey") % 500 + 1
    png = F.concat(F.unhex(F.lit("89504E470D0A1A0A0000000D49484452")), number(w, 8), number(h, 8))
    jpeg = F.concat(F.unhex(F.lit("FFD8FFE000044A46FFC0000B08")), number(h, 4), number(w, 4), F.unhex(F.lit("01011100")))
    content = F.when(F.col("p_partkey") % 3 == 0, png).when(F.col("p_partkey") % 3 == 1, jpeg).otherwise(F.lit(b"GIF89a"))
    return Tables(spark, d).part.select("p_partkey", files.image_size(content).alias("s")).select("p_partkey", "s.width", "s.height", "s.kind")


@query("src_20_sidecar", "select event_id, 'img_' || event_id || '.jpg' as title, user_id * 1000 as taken from events where event_id % 4 <> 0")
def src_20(spark, d):
    """Every fourth sidecar says no time, and is none."""
    at = place(spark, "sidecar")
    stamp = F.when(F.col("event_id") % 4 != 0, F.struct((F.col("user_id") * 1000).cast("string").alias("timestamp")))
    body = F.to_json(F.struct(F.concat(F.lit("IMG_"), F.col("event_id"), F.lit(".JPG")).alias("title"), stamp.alias("photoTakenTime"), F.lit("x").alias("other")))
    Tables(spark, d).events.select("event_id", body.alias("body")).write.parquet(at)
    rows = spark.read.parquet(at).select("event_id", files.sidecar(F.col("body")).alias("s")).where("s is not null")
    return rows.select("event_id", "s.title", "s.taken")


@query("src_22_protective_terms", "select n_nationkey, n_name from nation where n_nationkey in (select n_nationkey from nation, region where r_regionkey = n_regionkey and r_regionkey < 2)")
def src_22(spark, d):
    """Nations that a profile's terms protect: the profile lists those of two regions."""
    t = Tables(spark, d)
    at = place(spark, "profile")
    named = t.nation.where("n_regionkey < 2").agg(F.array_sort(F.collect_list("n_name")).alias("a"))
    named.select(F.concat(F.lit("# who is protected\nother:\n  - nobody\nprotect:\n  - "), F.array_join("a", "\n  - ")).alias("value")).coalesce(1).write.text(at)
    terms = files.protective_terms(spark, at)
    return t.nation.where(F.lower("n_name").isin(terms)).select("n_nationkey", "n_name")


@query("src_23_line_list", "select md5(c_name) as line from customer")
def src_23(spark, d):
    """Digests, one a line, between comments and blank lines."""
    at = place(spark, "list")
    Tables(spark, d).customer.select(F.concat(F.lit("# comment\n\n  "), F.md5("c_name"), F.lit("  # name")).alias("value")).write.text(at)
    return files.lines(spark, at)


@query("src_27_gzip_csv", "select count(*) as rows, sum(o_orderkey)::bigint as keys from orders")
def src_27(spark, d):
    at = place(spark, "gzip")
    sinks.export_csv(Tables(spark, d).orders.select("o_orderkey", "o_orderpriority"), at, ["o_orderkey"])
    return files.csv(spark, at, "o_orderkey long, o_orderpriority string").agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys"))


@query("src_28_numbered", "select 'part' as stem, n::int as number, 1::bigint as missing from (values (1), (2), (4)) v(n)")
def src_28(spark, d):
    """Archives by their numbers; the third is missing."""
    found = files.numbered(files.tree(spark, _archives(spark, d)), r"^(.*)-(\d+)\.(?:zip|tar\.gz)$")
    return found.select("stem", "number", "missing")


@query("src_07_jdbc", "select n_nationkey, n_name from nation")
def src_07(spark, d):
    """A database table written over JDBC and read by ranges of its key, in as many JVMs as read it: the database is a file in the shared folder."""
    url = sinks.database(Tables(spark, d).nation.select("n_nationkey", "n_name"), "NATION", place(spark, "database"))
    read = files.jdbc(spark, url, "NATION", "n_nationkey", 0, 25, 4, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    return read.toDF("n_nationkey", "n_name")


@query("snk_01_publish", "select c_custkey, c_mktsegment from customer where c_custkey % 2 = 0")
def snk_01(spark, d):
    """A second version fails its check, so that the first stays current."""
    root, c = place(spark, "published"), Tables(spark, d).customer.select("c_custkey", "c_mktsegment")
    sinks.publish(c.where("c_custkey % 2 = 0"), root)
    try:
        sinks.publish(c, root, sinks.same_count(-1))
    except ValueError:
        pass
    return sinks.current(spark, root)


@query("snk_02_append", "select c_custkey from customer union all select c_custkey from customer where c_custkey < 20")
def snk_02(spark, d):
    at, c = place(spark, "appended"), Tables(spark, d).customer.select("c_custkey")
    sinks.append(c, at)
    sinks.append(c.where("c_custkey < 20"), at)
    return spark.read.parquet(at)


@query("snk_04_refill", "select 'nation' as part, cast(c_nationkey as varchar) as k, count(*) as n from customer group by c_nationkey union all select 'segment', c_mktsegment, count(*) from customer group by c_mktsegment")
def snk_04(spark, d):
    """Two derived tables that change together: a refill whose check fails leaves both as they were."""
    root, c = place(spark, "derived"), Tables(spark, d).customer

    def derived(rows):
        return {"nation": rows.groupBy(F.col("c_nationkey").cast("string").alias("k")).agg(F.count("*").alias("n")), "segment": rows.groupBy(F.col("c_mktsegment").alias("k")).agg(F.count("*").alias("n"))}

    def no_rows_lost(tables):
        if tables["nation"].agg(F.sum("n")).first()[0] != c.count():
            raise ValueError("rows were lost")

    sinks.refill(derived(c), root, no_rows_lost)
    try:
        sinks.refill(derived(c.where("c_custkey > 10")), root, no_rows_lost)
    except ValueError:
        pass
    parts = [sinks.current(spark, root, name).select(F.lit(name).alias("part"), "k", "n") for name in ("nation", "segment")]
    return parts[0].unionByName(parts[1])


@query("snk_05_same_bytes", "select count(*) as rows, true as same from customer")
def snk_05(spark, d):
    """Two exports of the same rows, dealt differently, have the same bytes."""
    c = Tables(spark, d).customer.select("c_custkey", "c_name", "c_mktsegment")
    a = sinks.export_one(c, place(spark, "export"), ["c_custkey"])
    b = sinks.export_one(c.repartition(7, "c_name"), place(spark, "export"), ["c_custkey"])
    return spark.createDataFrame([(a["rows"], a == b)], "rows long, same boolean")


@query("snk_07_bundle", "select 'customer' as name, count(*) as rows from customer union all select 'nation', count(*) from nation")
def snk_07(spark, d):
    t = Tables(spark, d)
    root = place(spark, "bundle")
    sinks.bundle({"customer": t.customer, "nation": t.nation}, root)
    return spark.read.schema("name string, rows long").json(f"{root}/manifest")


@query("snk_08_shards", "select count(*) as rows, sum(vec_id)::bigint as ids, true as within from embeddings")
def snk_08(spark, d):
    """Vectors in files of at most 100 rows."""
    at = place(spark, "shards")
    sinks.shards(Tables(spark, d).embeddings.select("vec_id", "embedding"), at, 100)
    per = spark.read.parquet(at).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"), F.sum("vec_id").alias("ids"))
    return per.agg(F.sum("n").alias("rows"), F.sum("ids").alias("ids"), (F.max("n") <= 100).alias("within"))


@query("snk_12_placement", """
with f as (select event_id, strftime(ts, '%Y/%m/%Y%m%d') || '_' || event_type as dest, md5(cast(user_id % 3 as varchar)) as h from events),
r as (select *, row_number() over (partition by dest order by event_id) as k, first_value(h) over (partition by dest order by event_id) as f from f),
n as (select *, sum(case when h <> f then 1 else 0 end) over (partition by dest order by event_id) as m from r)
select event_id, case when k = 1 then 'move' when h = f then 'skip' else 'rename' end as action, case when k = 1 then dest when h <> f then dest || '-' || m end as "to" from n""")
def snk_12(spark, d):
    e = Tables(spark, d).events.withColumn("h", F.md5((F.col("user_id") % 3).cast("string")))
    return sinks.placement(e, "event_id", "event_type", "ts", "h")


@query("snk_16_view", "select c_nationkey, count(*) as n, round(sum(c_acctbal), 2) as balance from customer group by c_nationkey")
def snk_16(spark, d):
    """A view by nation, built twice; a third build with a doubled key is refused."""
    root, c = place(spark, "view"), Tables(spark, d).customer
    view = c.groupBy("c_nationkey").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    sinks.refresh(view.where("c_nationkey < 5"), root, ["c_nationkey"])
    found = sinks.refresh(view, root, ["c_nationkey"])
    try:
        sinks.refresh(view.unionByName(view), root, ["c_nationkey"])
    except ValueError:
        pass
    return found


@query("clu_10_reread", """
with recursive b as (select l_orderkey as photo, l_linenumber as k, l_suppkey as c, l_discount as x, l_tax as y, 0.05 + l_quantity / 500 as w, 0.05 + l_quantity / 400 as h from lineitem),
p as (select n.photo, n.k as i, o.k as j, o.c, greatest(0, least(n.x+n.w, o.x+o.w) - greatest(n.x, o.x)) * greatest(0, least(n.y+n.h, o.y+o.h) - greatest(n.y, o.y)) as shared, n.w*n.h + o.w*o.h as area from b n join b o on n.photo = o.photo and n.k > 3 and o.k <= 3),
f as (select photo, i, list({'far': -iou, 'j': j, 'c': c} order by -iou, j, c) as found from (select *, round(shared / (area - shared), 9) as iou from p) where iou >= 0.3 group by photo, i),
s as (select photo, 3::int as i, []::int[] as used, null::bigint as cluster from (select distinct photo from b where k > 3)
  union all
  select s.photo, s.i + 1, case when g.one is null then s.used else list_append(s.used, g.one.j) end, g.one.c from s
  join lateral (select list_filter(coalesce((select found from f where f.photo = s.photo and f.i = s.i + 1), []), lambda q: not list_contains(s.used, q.j))[1] as one) g on true where s.i < 7)
select b.photo, b.k as i, s.cluster from b join s on s.photo = b.photo and s.i = b.k where b.k > 3""")
def clu_10(spark, d):
    q = F.col("l_quantity")
    box = F.array(F.col("l_discount"), F.col("l_tax"), 0.05 + q / 500, 0.05 + q / 400)
    b = Tables(spark, d).lineitem.select(F.col("l_orderkey").alias("photo"), F.col("l_linenumber").alias("k"), F.col("l_suppkey").alias("cluster"), box.alias("box"))
    return intake.reread(b.where("k > 3").select("photo", F.col("k").alias("i"), "box"), b.where("k <= 3").withColumnRenamed("k", "j"), "photo")


@query("cls_14_deletion_guard", """
select doc_id, case when source = 'src0' then 'protected root'
  when doc_id % 4 = 0 then case when source = 'src1' then 'allowed' else 'not in scratch' end
  when doc_id % 4 = 1 then case when doc_id not in (select doc_id from labels where quality = 1) then 'no proof' when lang = 'de' then 'camera original' else 'allowed' end
  when doc_id % 4 = 2 then case when n_chars > 500 then 'allowed' else 'members not accounted for' end else 'unknown reason' end as verdict from documents""")
def cls_14(spark, d):
    t = Tables(spark, d)
    docs = t.documents.join(t.labels.where("quality = 1").select("doc_id").distinct().withColumn("proven", F.lit(True)), "doc_id", "left")
    reason = F.element_at(F.array(*[F.lit(r) for r in ("scratch", "verified-duplicate", "consumed-archive", "other")]), (F.col("doc_id") % 4 + 1).cast("int"))
    path = F.concat(F.lit("/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"))
    return docs.select("doc_id", intake.deletion_verdict(path, reason, ["/src0"], "/src1", F.col("proven"), F.col("n_chars") > 500, F.col("lang") == "de").alias("verdict"))


@query("msc_21_descriptions", """
with r as (select * from documents order by doc_id desc limit 60), w as (select len(regexp_split_to_array(trim(text, ' '), '\\s+')) as n from r where trim(text, ' ') <> '')
select (select count(*) from r) as rows, (select list(n order by n)[len(list(n)) // 2 + 1]::bigint from w) as median, (select count(*) from w where n < 12) as short,
  case when (select list(n order by n)[len(list(n)) // 2 + 1] from w) < 12 then 1 else 0 end::int as code""")
def msc_21(spark, d):
    return intake.described(Tables(spark, d).documents, "text", ["lang", "source"], ["doc_id"], 60, 12, 0.5)


@query("msc_21_sideways", "select p_partkey, case when p_partkey % 8 + 1 between 5 and 8 then (p_size > p_partkey % 40) <> (p_partkey % 30 > p_size) end as sideways from part")
def msc_21_sideways(spark, d):
    k = F.col("p_partkey")
    return Tables(spark, d).part.select("p_partkey", intake.still_sideways(F.col("p_size"), k % 40, k % 8 + 1, F.col("p_size"), k % 30).alias("sideways"))


@query("msc_21_stale", "select c_custkey, case when o.t is null then 'no source' else 'older than its source' end as reason from customer left join (select o_custkey, max(o_orderdate) as t from orders group by o_custkey) o on o_custkey = c_custkey where o.t is null or timestamp '1996-01-01' < o.t")
def msc_21_stale(spark, d):
    t = Tables(spark, d)
    made = t.customer.select("c_custkey", F.expr("timestamp_ntz'1996-01-01 00:00:00'").alias("made"))
    changed = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("changed"))
    return intake.stale_assets(made, changed, "c_custkey", "made", "changed")


@query("msc_24_rederive", """
with a as (select vec_id, row_number() over (order by vec_id) as k, count(*) over () as n from embeddings), s as (select vec_id from a where k <= 10 or k > n - 30)
select count(*) as sampled, count(*) filter (where vec_id % 6 <> 0) as checked, count(*) filter (where vec_id % 6 = 3) as wrong, 1::int as code from s""")
def msc_24(spark, d):
    """Second vectors: none for every sixth, the opposite for as many, else the same but for a factor."""
    e = Tables(spark, d).embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    again = e.where("vec_id % 6 <> 0").withColumn("v", F.transform("v", lambda x: x * F.when(F.col("vec_id") % 6 == 3, -1.0).otherwise(2.0)))
    return intake.rederived(e, again, "vec_id", "v", ["vec_id"], 40)


@query("msc_27_sheet_answers", """
with f as (select c_custkey, min(case when trim(c_mktsegment) <> '' then c_mktsegment end) as said from (select c_custkey, case c_custkey % 5 when 0 then ' ' when 1 then '?' when 2 then 'x' else c_mktsegment end as c_mktsegment from customer where c_custkey % 7 <> 0) group by c_custkey)
select c.c_custkey, o.outcome, case when o.outcome = 'named' then f.said end as name from customer c left join f on f.c_custkey = c.c_custkey,
lateral (select case when c.c_custkey not in (select o_custkey from orders) then 'refused' when f.said is null then 'declined' when f.said = '?' then 'asked' when f.said = 'x' then 'unidentifiable' else 'named' end as outcome) o""")
def msc_27(spark, d):
    t = Tables(spark, d)
    k = F.col("c_custkey")
    filled = t.customer.where(k % 7 != 0).select(k, F.when(k % 5 == 0, " ").when(k % 5 == 1, "?").when(k % 5 == 2, "x").otherwise(F.col("c_mktsegment")).alias("said"))
    return intake.sheet_answers(t.customer, filled, t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "said")


@query("msc_27_sheet", "select s_suppkey, n from (select l_suppkey as s_suppkey, count(*) as n from lineitem where l_suppkey % 3 <> 0 group by l_suppkey) order by n desc, s_suppkey limit 20")
def msc_27_sheet(spark, d):
    groups = Tables(spark, d).lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n"))
    return intake.sheet(groups, "s_suppkey", [F.desc("n")], groups.where("s_suppkey % 3 = 0"), 20)


@query("msc_27_sheet_check", """
with c as (select l_orderkey as face, l_linenumber as k, l_suppkey as row_, l_partkey as content from lineitem), a as (select l_orderkey as face, l_linenumber as k, case when l_partkey % 5 = 0 then l_suppkey + 1 else l_suppkey end as owner from lineitem where l_partkey % 11 <> 0),
m as (select c.row_, case when a.owner is null then 'unassigned' when a.owner <> c.row_ then 'another row' end as problem from c left join a on a.face = c.face and a.k = c.k),
t as (select row_, count(*) - 1 as more from c group by row_, content having count(*) > 1)
select row_ as row, problem, count(*) as n from m where problem is not null group by 1, 2 union all select row_, 'shown twice', sum(more)::bigint from t group by row_""")
def msc_27_check(spark, d):
    li = Tables(spark, d).lineitem
    crops = li.select(F.col("l_suppkey").alias("row"), F.col("l_orderkey").alias("face"), F.col("l_linenumber").alias("k"), F.col("l_partkey").alias("content"))
    assigned = li.where("l_partkey % 11 <> 0").select(F.col("l_orderkey").alias("face"), F.col("l_linenumber").alias("k"), (F.col("l_suppkey") + F.when(F.col("l_partkey") % 5 == 0, 1).otherwise(0)).alias("owner"))
    return intake.sheet_problems(crops, assigned, "row", ["face", "k"], "content")


@query("inc_06_budget", "select event_id, user_id from (select *, sum(1 + event_id % 5) over (order by event_id) - (1 + event_id % 5) as before from events) where before < 1000")
def inc_06(spark, d):
    """Work is taken on while the spend before it is below the cap."""
    e = Tables(spark, d).events.withColumn("cost", 1 + F.col("event_id") % 5)
    return intake.budgeted(e, "cost", 1000, "event_id").select("event_id", "user_id")


@query("inc_07_in_flight", "select event_id, user_id * 2 as answer from events")
def inc_07(spark, d):
    """A call for each row, by a pool of four in each task, eight under way at most."""

    def call(row: dict) -> tuple:
        return int(row["event_id"]), int(row["user_id"]) * 2

    return intake.in_flight(Tables(spark, d).events.select("event_id", "user_id"), call, "event_id long, answer long")


@query("inc_15_memo", "select c_mktsegment, count(*) as n from customer group by c_mktsegment")
def inc_15(spark, d):
    """A list made once and read three times; what is asked for within the minute is not made anew."""
    memo, made = intake.Memo(60), []

    def make():
        made.append(1)
        return Tables(spark, d).customer.groupBy("c_mktsegment").agg(F.count("*").alias("n"))

    for _ in range(3):
        found = memo.get("segments", make)
    if len(made) != 1:
        raise RuntimeError("the list was made anew")
    return found


QUERIES, SQL = query.queries, query.sql
