"""Readers: trees of files, delimited and JSON text, archives, vectors in several encodings, HTML ids."""

from __future__ import annotations

import base64
import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tree(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """path, bytes, modified of all files below a root; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def csv(spark: SparkSession, path: str, schema: str, header: bool = True, sep: str = ",") -> DataFrame:
    """Delimited text of a declared schema; what can't be read is null, short rows are filled with nulls."""
    return spark.read.schema(schema).csv(path, header=header, sep=sep, mode="PERMISSIVE")


def positional_csv(spark: SparkSession, path: str, schema: str, needed: list[str]) -> DataFrame:
    """Delimited text without a header; rows without the needed columns are skipped."""
    return csv(spark, path, schema, header=False).dropna(subset=needed)


def nested_json(spark: SparkSession, path: str, schema: str, outer: str, inner: str) -> DataFrame:
    """One JSON document {outer: [{inner: [...]}]} as a row for each inner value, with the outer item's fields."""
    items = spark.read.schema(schema).json(path, multiLine=True).select(F.explode(outer).alias("_o"))
    return items.select("_o.*").withColumn(inner, F.explode(inner))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines without comments (#) and blank ones, trimmed."""
    rows = spark.read.text(path).select(F.trim(F.regexp_replace("value", "#.*$", "")).alias("line"))
    return rows.where("line <> ''")


def jdbc(spark: SparkSession, url: str, table: str, column: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A database table, read by ranges of a numeric column. Needs the database's driver on the class path."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts), **options)
    return reader.load()


@F.pandas_udf(T.ArrayType(T.FloatType()))
def float16_base64(cells: pd.Series) -> pd.Series:
    """Vectors stored as base64 of half-precision numbers."""
    return cells.map(lambda s: None if s is None else np.frombuffer(base64.b64decode(s), "<f2").astype(np.float32).tolist())


def float32_blob(dim: int):
    """A function of a binary column: little-endian single-precision vectors of exactly this length, else null."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def read(blobs: pd.Series) -> pd.Series:
        return blobs.map(lambda b: None if b is None or len(b) != 4 * dim else list(struct.unpack(f"<{dim}f", bytes(b))))

    return read


def vector_literal(cell: Column) -> Column:
    """[a,b,...] as text."""
    return F.from_json(cell, "array<float>")


def ids_in_html(html: Column, attribute: str) -> Column:
    """All values of an attribute of a page's elements."""
    return F.regexp_extract_all(html, F.lit(attribute + r'="([^"]*)"'), F.lit(1))


#: Characters of an export's sidecar beyond which it is none.
SIDECAR_CHARS = 4 << 20


def sidecar(content: Column) -> Column:
    """title (lower case) and taken (epoch seconds) of an export's JSON sidecar; null if it is too long, or says neither."""
    said = F.from_json(F.when(F.length(content) <= SIDECAR_CHARS, content), "title string, photoTakenTime struct<timestamp: string>")
    taken = said["photoTakenTime"]["timestamp"].try_cast("bigint")
    return F.when(said["title"].isNotNull() & taken.isNotNull(), F.struct(F.lower(said["title"]).alias("title"), taken.alias("taken")))


def protective_terms(spark: SparkSession, path: str, section: str = "protect") -> list[str]:
    """The terms of a profile, `section:` and then a line `- term` for each; raises if the file or the section is missing or empty.

    Without them nothing may go on: a run that protects nobody looks like one that found nothing to protect.
    """
    rows = spark.read.text(path, wholetext=True).collect()  # a profile that people write by hand
    terms, inside = [], False
    for line in "\n".join(r[0] for r in rows).splitlines():
        line = line.split("#")[0].rstrip()
        if line and not line[0].isspace() and not line.startswith("-"):
            inside = line.rstrip(":") == section and line.endswith(":")
        elif inside and line.strip().startswith("- "):
            terms.append(line.strip()[2:].strip().strip("\"'"))
    if not [t for t in terms if t]:
        raise ValueError(f"no terms under {section}: in {path}")
    return sorted({t.lower() for t in terms if t})


def numbered(files: DataFrame, pattern: str) -> DataFrame:
    """stem, number, path of the files whose name matches a pattern of two groups, and how many numbers of a stem are missing below its highest."""
    name = F.element_at(F.split("path", "/"), -1)
    found = files.select("path", F.regexp_extract(name, pattern, 1).alias("stem"), F.regexp_extract(name, pattern, 2).try_cast("int").alias("number")).where("number is not null")
    per = found.groupBy("stem").agg((F.max("number") - F.count_distinct("number")).cast("bigint").alias("missing"))
    return found.join(per, "stem").select("stem", "number", "missing", "path")


def gazetteer(places: DataFrame, admin: DataFrame, countries: DataFrame) -> DataFrame:
    """Places with the names of their region and country, looked up by code."""
    return places.join(admin, "admin_code", "left").join(countries, "country_code", "left")


@F.pandas_udf(T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("kind", T.StringType())]))
def image_size(content: pd.Series) -> pd.DataFrame:
    """Width, height and kind of PNG and JPEG files from their headers; nulls for anything else."""
    return pd.DataFrame([_image_size(bytes(b or b"")) for b in content], columns=["width", "height", "kind"]).astype({"width": "Int32", "height": "Int32"})


def _image_size(b: bytes) -> tuple[int | None, int | None, str | None]:
    if b[:8] == b"\x89PNG\r\n\x1a\n" and len(b) >= 24:
        return (*struct.unpack(">II", b[16:24]), "png")
    if b[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(b) and b[at] == 0xFF:
            marker, size = b[at + 1], struct.unpack(">H", b[at + 2 : at + 4])[0]
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                height, width = struct.unpack(">HH", b[at + 5 : at + 9])
                return width, height, "jpeg"
            at += 2 + size
    return None, None, None
