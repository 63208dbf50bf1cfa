"""Readers of lexicons, gold standards and annotation formats.

All give DataFrames with fixed columns; rows that don't fit a format are left
out, missing optional fields are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def json_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """(key, form, canonical): a JSON object of entries with optional ``canonical`` and ``variants``."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,struct<canonical:string,canonical_expansion:string,variants:array<string>>>").alias("m"))
    rows = raw.select(F.explode("m").alias("key", "e"))
    canonical = F.coalesce("e.canonical", "e.canonical_expansion", "key")
    forms = F.array_distinct(F.concat(F.array("key"), F.coalesce("e.variants", F.array().cast("array<string>"))))
    return rows.select("key", F.explode(forms).alias("form"), canonical.alias("canonical")).where("form IS NOT NULL AND form <> ''")


def tsv_lexicon(spark: SparkSession, path: str, bad_pairs: DataFrame | None = None, bad_long: DataFrame | None = None) -> DataFrame:
    """(short_form, long_form, source) of a tab-separated file, without blacklisted pairs and long forms."""
    t = spark.read.csv(path, sep="\t", header=True).toDF("short_form", "long_form", "source")
    if bad_pairs is not None:
        t = t.join(bad_pairs.select("short_form", "long_form"), ["short_form", "long_form"], "left_anti")
    if bad_long is not None:
        t = t.join(bad_long.select("long_form"), "long_form", "left_anti")
    return t.select("short_form", "long_form", "source")


def term_set(spark: SparkSession, terms: list[str], name: str) -> DataFrame:
    """(set_name, term) of a list of terms."""
    return spark.createDataFrame([(name, t) for t in terms], "set_name string, term string")


def first_of(df: DataFrame, names: list[str]) -> Column:
    """The first of the named columns that exists and isn't null, as text."""
    have = [F.col(n).cast("string") for n in names if n in df.columns]
    return F.coalesce(*have, F.lit(None).cast("string"))


def gold(df: DataFrame, strict: bool = False) -> DataFrame:
    """(doc_id, short_form, long_form) of a gold table with any of the usual column names.

    Short forms in upper case, long forms with single spaces, document names
    without their folder; one row per triple.  ``strict`` fails on rows without
    a document or short form, which are left out otherwise.
    """
    doc = F.regexp_extract(first_of(df, ["doc_id", "filename", "document", "doc", "file"]), r"([^/\\]+)$", 1)
    out = df.select(doc.alias("doc_id"), F.upper(F.trim(first_of(df, ["short_form", "sf", "abbreviation"]))).alias("short_form"), F.trim(F.regexp_replace(first_of(df, ["long_form", "lf", "expansion"]), r"\s+", " ")).alias("long_form"))
    whole = (F.coalesce("doc_id", F.lit("")) != "") & (F.coalesce("short_form", F.lit("")) != "")
    if strict:
        return out.where(F.when(whole, F.lit(True)).otherwise(F.raise_error("a gold row has no document or short form").cast("boolean"))).distinct()
    return out.where(whole).distinct()


def _file_name() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.[^.]+$", 1)


def brat(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Spans (doc_id, tid, type, start, end, text) and relations (doc_id, rid, rel, arg1, arg2) of ``.ann`` files."""
    lines = spark.read.text(path).select(_file_name().alias("doc_id"), "value")
    t = r"^(T\d+)\t(\S+) (\d+) (?:\d+;\d+ )*(\d+)\t(.*)$"
    r = r"^(R\d+)\t(\S+) Arg1:(\S+) Arg2:(\S+)\s*$"
    g = lambda rx, i: F.regexp_extract("value", rx, i)
    spans = lines.where(F.col("value").rlike(t)).select("doc_id", g(t, 1).alias("tid"), g(t, 2).alias("type"), g(t, 3).cast("int").alias("start"), g(t, 4).cast("int").alias("end"), g(t, 5).alias("text"))
    relations = lines.where(F.col("value").rlike(r)).select("doc_id", g(r, 1).alias("rid"), g(r, 2).alias("rel"), g(r, 3).alias("arg1"), g(r, 4).alias("arg2"))
    return spans, relations


def acronym_pairs(spans: DataFrame, relations: DataFrame, kind: str = "Is_acron") -> DataFrame:
    """(doc_id, short_form, long_form) of acronym relations; the shorter end is the short form."""
    a = spans.select("doc_id", F.col("tid").alias("arg1"), F.col("text").alias("x"))
    b = spans.select("doc_id", F.col("tid").alias("arg2"), F.col("text").alias("y"))
    both = relations.where(F.col("rel") == kind).join(a, ["doc_id", "arg1"]).join(b, ["doc_id", "arg2"])
    swap = F.length("x") > F.length("y")
    return both.select("doc_id", F.when(swap, F.col("y")).otherwise(F.col("x")).alias("short_form"), F.when(swap, F.col("x")).otherwise(F.col("y")).alias("long_form"))


def pubtator(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Documents (pmid, title, abstract) and annotations (pmid, start, end, text, type, concept)."""
    lines = spark.read.text(path)
    rx = r"^(\d+)\|([ta])\|(.*)$"
    parts = lines.where(F.col("value").rlike(rx)).select(F.regexp_extract("value", rx, 1).alias("pmid"), F.regexp_extract("value", rx, 2).alias("k"), F.regexp_extract("value", rx, 3).alias("v"))
    docs = parts.groupBy("pmid").agg(F.max(F.when(F.col("k") == "t", F.col("v"))).alias("title"), F.max(F.when(F.col("k") == "a", F.col("v"))).alias("abstract"))
    f = F.split("value", "\t")
    notes = lines.where(F.col("value").rlike(r"^\d+\t\d+\t\d+\t")).select(f[0].alias("pmid"), f[1].cast("int").alias("start"), f[2].cast("int").alias("end"), f[3].alias("text"), F.get(f, F.lit(4)).alias("type"), F.get(f, F.lit(5)).alias("concept"))
    return docs, notes


def bio_entities(tokens: DataFrame) -> DataFrame:
    """(doc_id, type, text, first, last) of BIO-tagged tokens (doc_id, position, token, tag)."""
    order = W.partitionBy("doc_id").orderBy("position")
    kind = F.regexp_extract("tag", "^[BI]-(.*)$", 1)
    tagged = tokens.withColumn("kind", kind).withColumn("starts", ((F.col("kind") != "") & (F.col("tag").startswith("B-") | (F.lag(kind, 1, "").over(order) != F.col("kind")))).cast("int"))
    numbered = tagged.withColumn("no", F.sum("starts").over(order.rowsBetween(W.unboundedPreceding, 0))).where("kind <> ''")
    words = F.transform(F.array_sort(F.collect_list(F.struct("position", "token"))), lambda x: x["token"])
    return numbered.groupBy("doc_id", "no", F.col("kind").alias("type")).agg(F.array_join(words, " ").alias("text"), F.min("position").alias("first"), F.max("position").alias("last")).drop("no")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text) of a folder of plain-text files."""
    return spark.read.text(folder, wholetext=True).select(_file_name().alias("doc_id"), F.col("value").alias("text"))


def tables(cells: DataFrame, kind: str | None = None) -> DataFrame:
    """Tables (doc_id, page, table_no, table_type) in page order, of one type if it is given."""
    out = cells if kind is None else cells.where(F.col("table_type") == kind)
    return out.orderBy("doc_id", "page", "table_no")
