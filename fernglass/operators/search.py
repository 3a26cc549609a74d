"""Search: typed text to a filter, filters to rows and facets, text rank, vectors and places."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernglass.functions import values

# Words that a query may hold besides names and years.
STOP_WORDS = frozenset("a an and at by for from in of on or the to with".split())
MEDIA_WORDS = {"photo": "photo", "photos": "photo", "picture": "photo", "pictures": "photo", "video": "video", "videos": "video", "film": "video", "films": "video"}


@dataclass(frozen=True)
class Spec:
    """What a typed query asks for."""

    people: tuple[str, ...] = ()
    place: str | None = None
    country: str | None = None
    year_from: int | None = None
    year_to: int | None = None
    media: str | None = None
    rest: str = ""
    unused: tuple[str, ...] = field(default=(), compare=False)


def decade_word(word: str) -> int | None:
    """The first year of a decade's name: 1987 and 1980s are 1980, 80s is 1980, 00s to 20s are in the 2000s."""
    if m := re.fullmatch(r"(\d{3})\ds?", word):
        return int(m[1]) * 10
    if m := re.fullmatch(r"(\d)0s", word):
        return (1900 if int(m[1]) >= 3 else 2000) + 10 * int(m[1])
    return None


def parse(typed: str, people: list[str], places: list[str], countries: list[str]) -> Spec:
    """Longest known names first, then a name's part if it is no one else's, then years, media words; the rest is text."""
    left = f" {' '.join(typed.lower().split())} "

    def take(known: list[str]) -> list[str]:
        nonlocal left
        found = []
        for name in sorted(known, key=lambda s: (-len(s), s)):
            if f" {name.lower()} " in left:
                left = left.replace(f" {name.lower()} ", " ", 1)
                found.append(name)
        return found

    named = take(people)
    place = (take(places) or [None])[0]
    country = (take(countries) or [None])[0]
    parts: dict[str, list[str]] = {}
    for name in people:
        for part in name.lower().split():
            parts.setdefault(part, []).append(name)
    spec, rest = Spec(), []
    for word in left.split():
        if len(owners := parts.get(word, [])) == 1:
            if owners[0] not in named:
                named.append(owners[0])
        elif word in MEDIA_WORDS:
            spec = replace(spec, media=MEDIA_WORDS[word])
        elif re.fullmatch(r"(1[89]|20)\d\d", word):
            spec = replace(spec, year_from=int(word), year_to=int(word))
        elif word.endswith("s") and (start := decade_word(word)) is not None:
            spec = replace(spec, year_from=start, year_to=start + 9)
        elif word not in STOP_WORDS:
            rest.append(word)
    return replace(spec, people=tuple(sorted(named)), place=place, country=country, rest=" ".join(rest))


def compose(spec: Spec) -> str:
    """Text that parse() reads as the same spec."""
    words = [*spec.people, spec.place, spec.country]
    if spec.year_from is not None:
        words.append(str(spec.year_from) if spec.year_from == spec.year_to else f"{spec.year_from}s")
    return " ".join(w for w in (*words, spec.media, spec.rest) if w)


def describe(spec: Spec) -> str:
    """A sentence that says what is shown."""
    said = {"photo": "Photos", "video": "Videos"}.get(spec.media or "", "Everything")
    if spec.people:
        said += " with " + " and ".join(spec.people)
    where = ", ".join(w for w in (spec.place, spec.country) if w)
    said += f" in {where}" if where else ""
    if spec.year_from is not None:
        said += f" from {spec.year_from}" + (f" to {spec.year_to}" if spec.year_to != spec.year_from else "")
    return said + (f" about {spec.rest}" if spec.rest else "") + "."


def facets(df: DataFrame, dimensions: dict[str, tuple[str, Column | None]], ignoring: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """facet, v, n: for each dimension, counts of its column under the filters of the others.

    dimensions: name -> (column, filter or None). ignoring: further filters that a dimension's counts leave out. Each
    row says once which filters it meets, and one aggregation over exploded (facet, value) pairs counts them all.
    """
    ok = {n: F.lit(True) if f is None else F.coalesce(f, F.lit(False)) for n, (_, f) in dimensions.items()}
    cells = []
    for name, (column, _) in dimensions.items():
        out = {name, *(ignoring or {}).get(name, ())}
        counted = F.lit(True)
        for other, test in ok.items():
            if other not in out:
                counted = counted & test
        cells.append(F.when(counted & F.col(column).isNotNull(), F.struct(F.lit(name).alias("facet"), F.col(column).cast("string").alias("v"))))
    pairs = df.select(F.explode(F.array_compact(F.array(*cells))).alias("p")).select("p.facet", "p.v")
    return pairs.groupBy("facet", "v").agg(F.count("*").alias("n"))


def terms(text: Column) -> Column:
    """Words as a search index holds them: lower case, letters and digits, no stemming."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def text_rank(df: DataFrame, key: str, text: str, wanted: list[str]) -> DataFrame:
    """key, score of the rows that hold all wanted terms: the sum of 1 + ln(tf) over the length's root, best first by score and key."""
    rows = df.select(key, terms(F.col(text)).alias("_t")).withColumn("_n", F.size("_t"))
    tf = [_times("_t", x) for x in wanted]
    kept = rows.where(F.lit(True) if not wanted else _all([n > 0 for n in tf]))
    return kept.select(key, (sum((1 + F.log(n.cast("double")) for n in tf), F.lit(0.0)) / F.sqrt("_n")).alias("score"))


def _times(words: str, term: str) -> Column:
    return F.size(F.filter(words, lambda w: w == term))


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def postings(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """term, key, column, tf: an inverted index of several text columns."""
    per = [df.select(F.explode(terms(F.col(c))).alias("term"), key, F.lit(c).alias("column")) for c in columns]
    out = per[0]
    for p in per[1:]:
        out = out.unionByName(p)
    return out.groupBy("term", key, "column").agg(F.count("*").alias("tf"))


#: Bytes of query vectors that one scan of the searched table answers, and queries that a task compares at a time.
QUERY_BYTES, QUERY_TILE = 64 << 20, 512


def nearest(df: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str, query_vector: str, k: int, least: float = -2.0) -> DataFrame:
    """query, key, sim, rank: the k most similar rows of each query by cosine, least key first on ties.

    queries is a stated set. It is taken in blocks of QUERY_BYTES, each of which is broadcast and answered by one scan of
    df, in which a task keeps k rows for each query. Null and zero vectors are never found, nor those of another length.
    """
    context = df.sparkSession.sparkContext
    source = df.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector")).where(F.col("vector").isNotNull())
    asked = queries.select(F.col(query_key).cast("long").alias("q"), F.col(query_vector).cast("array<double>").alias("v")).where(F.col("v").isNotNull())
    out, names, block, size = None, [], [], 0

    def scan() -> DataFrame:
        shared = context.broadcast((np.array(names, np.int64), np.array(block, np.float64)))
        return source.mapInArrow(_best_of(shared, k, least), "query long, key long, sim double")

    for r in asked.toLocalIterator():  # a block of them at a time
        v = np.array([np.nan if x is None else x for x in r["v"]], np.float64)
        n = np.linalg.norm(v) if v.size else 0.0
        if not n > 0 or block and len(v) != len(block[0]):
            continue
        names.append(r["q"])
        block.append(v / n)
        size += v.nbytes
        if size >= QUERY_BYTES:
            out = scan() if out is None else out.unionByName(scan())
            names, block, size = [], [], 0
    if block or out is None:
        out = scan() if out is None else out.unionByName(scan())
    w = Window.partitionBy("query").orderBy(F.desc("sim"), "key")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _best_of(shared, k: int, least: float):
    def run(batches):
        names, matrix = shared.value
        if not len(names):
            return
        held = np.zeros((0, 3))  # rows of (query's place, sim, batch row's key), k a query at most
        keys_held = np.zeros(0, np.int64)
        floor = np.full(len(names), -np.inf)
        for batch in batches:
            rows = [np.array(x, np.float64) if x is not None and None not in x else np.zeros(0) for x in batch.column("vector").to_pylist()]
            keep = [i for i, x in enumerate(rows) if len(x) == matrix.shape[1] and np.linalg.norm(x) > 0]
            if not keep:
                continue
            x = np.stack([rows[i] / np.linalg.norm(rows[i]) for i in keep])
            keys = batch.column("key").to_numpy()[keep]
            found, found_keys = [held], [keys_held]
            for lo in range(0, len(names), QUERY_TILE):
                sims = matrix[lo : lo + QUERY_TILE] @ x.T
                bound = np.maximum(floor[lo : lo + QUERY_TILE], least)
                if sims.shape[1] > k:
                    bound = np.maximum(bound, np.partition(sims, sims.shape[1] - k, axis=1)[:, sims.shape[1] - k])
                q, j = np.nonzero(sims >= bound[:, None])  # all that tie with the k-th too
                found.append(np.column_stack([q + lo, sims[q, j], j]))
                found_keys.append(keys[j])
            held, keys_held = np.concatenate(found), np.concatenate(found_keys)
            order = np.lexsort((keys_held, -held[:, 1], held[:, 0]))
            held, keys_held = held[order], keys_held[order]
            first = np.searchsorted(held[:, 0], held[:, 0], "left")
            rank = np.arange(len(held)) - first
            last = rank == k - 1
            floor[held[last, 0].astype(np.int64)] = held[last, 1]
            held, keys_held = held[rank < k], keys_held[rank < k]
        yield pa.RecordBatch.from_arrays([pa.array(names[held[:, 0].astype(np.int64)]), pa.array(keys_held), pa.array(held[:, 1])], names=["query", "key", "sim"])

    return run


def nearest_centre(df: DataFrame, key: str, vector: str, centres: DataFrame, name: str, centre: str, least: float) -> DataFrame:
    """key, name, sim of the most similar centre, if it is similar enough. Centres go to all tasks: a table that is checked to be small."""
    held = [(r[name], np.array(r[centre], np.float64)) for r in centres.select(name, centre).limit(100_001).collect()]
    if len(held) > 100_000:
        raise ValueError("more than 100,000 centres: cluster them first, or join by blocks")
    held = sorted((n, v / np.linalg.norm(v)) for n, v in held if np.linalg.norm(v) > 0)
    matrix = np.array([v for _, v in held])

    def run(batches):
        for pdf in batches:
            if not len(pdf) or not held:
                continue
            x = np.stack([np.array(v, np.float64) for v in pdf["v"]])
            size = np.linalg.norm(x, axis=1)
            sims = (x / np.where(size > 0, size, 1)[:, None]) @ matrix.T
            at = sims.argmax(axis=1)
            top = sims[np.arange(len(x)), at]
            keep = (top >= least) & (size > 0)
            yield pd.DataFrame({"key": pdf["key"][keep], "name": [held[i][0] for i in at[keep]], "sim": top[keep]})

    kinds = dict(df.dtypes)
    names = dict(centres.dtypes)
    return df.select(F.col(key).alias("key"), F.col(vector).alias("v")).where(F.col("v").isNotNull()).mapInPandas(run, f"key {kinds[key]}, name {names[name]}, sim double")


EARTH_KM = 6371.0


def xyz(lat: Column, lon: Column) -> list[Column]:
    """A point of the unit sphere."""
    a, o = F.radians(lat), F.radians(lon)
    return [F.cos(a) * F.cos(o), F.cos(a) * F.sin(o), F.sin(a)]


def km_between(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the chord."""
    d = sum((a - b) * (a - b) for a, b in zip(xyz(lat1, lon1), xyz(lat2, lon2)))
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(d) / 2))


def nearest_place(points: DataFrame, key: str, places: DataFrame, within_km: float = 25.0) -> DataFrame:
    """key, place, km, confidence: the nearest place (id, lat, lon) to each point (key, lat, lon) within a radius.

    Points meet places by grid cell of one radius (latitude bands, longitude scaled by the band): each place stands in
    its own cell and those around it, an equi join. confidence is 1 - km / 50, 0.5 at least.
    """
    step = within_km / 111.0

    def band(lat: Column) -> Column:
        return F.floor(lat / step)

    def column(lon: Column, b: Column) -> Column:
        worst = F.least(F.lit(89.0), F.greatest(F.abs(b * step), F.abs((b + 1) * step)))
        return F.floor(F.pmod(lon, F.lit(360.0)) * F.cos(F.radians(worst)) / step), F.floor(360.0 * F.cos(F.radians(worst)) / step)

    own = points.select(F.col(key).alias("_key"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon")).withColumn("_b", band(F.col("_lat")))
    c, _ = column(F.col("_lon"), F.col("_b"))
    own = own.withColumn("_c", c)
    spread = places.select("id", "lat", "lon", F.explode(F.array(*[band(F.col("lat")) + i for i in (-1, 0, 1)])).alias("_b"))
    c, most = column(F.col("lon"), F.col("_b"))
    spread = spread.withColumn("_c", F.explode(F.array_distinct(F.array(*[F.pmod(c + i, most + 1) for i in (-2, -1, 0, 1, 2)]))))
    km = km_between(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon"))
    met = own.join(spread, ["_b", "_c"]).withColumn("km", km).where(F.col("km") <= within_km)
    best = met.groupBy("_key").agg(F.min(F.struct("km", "id")).alias("best"))
    return best.select(F.col("_key").alias(key), F.col("best.id").alias("place"), F.col("best.km").alias("km"), F.greatest(F.lit(0.5), 1 - F.col("best.km") / 50).alias("confidence"))


def cosine_to(df: DataFrame, vector: str, query: list[float]) -> Column:
    return values.cosine(F.col(vector), F.array(*[F.lit(float(x)) for x in query]))
