"""Entities recovered, corrected and compared through reference lists.

All joins are equi-joins on normalised names; reference lists are broadcast
only behind their size.  Nulls meet nothing; repeated rows count once where
sets are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.session import broadcast_if_small


def term_forms(terms: DataFrame) -> DataFrame:
    """(term_id, kind, form): preferred labels and synonyms in lower case."""
    labels = terms.select("term_id", "kind", F.lower("preferred_label").alias("form"))
    synonyms = terms.select("term_id", "kind", F.explode("synonyms").alias("form")).select("term_id", "kind", F.lower("form").alias("form"))
    return labels.union(synonyms).where("form IS NOT NULL").distinct()


def recovered(mentions: DataFrame, forms: DataFrame, detected: DataFrame, guards: DataFrame | None = None) -> DataFrame:
    """(doc_id, term_id, mentions): entries that long forms name and that their document hasn't yet.

    ``mentions``: doc_id, short (the mention), form (its long form);
    ``detected``: doc_id, term_id; ``guards``: names of short forms that stand
    for something else.
    """
    hit = mentions.join(broadcast_if_small(forms.select("term_id", "form")), "form")
    if guards is not None:
        hit = hit.join(broadcast_if_small(guards.select(F.col("name").alias("short")).distinct()), "short", "left_anti")
    return hit.groupBy("doc_id", "term_id").agg(F.count("*").alias("mentions")).join(detected, ["doc_id", "term_id"], "left_anti")


def bounded(inner: Column, outer: Column) -> Column:
    """Whether one text holds another at word borders."""
    squeeze = lambda c: F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")), F.lit(" "))
    return F.instr(squeeze(outer), squeeze(inner)) > 0


def words_of(text: Column, least: int) -> Column:
    """Distinct lower-case words of at least so many characters."""
    return F.array_distinct(F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: F.length(w) >= least))


def linked(values: DataFrame, registry: DataFrame, least: int = 6) -> DataFrame:
    """(value, term_id, rule): the entry of each value: 1 equal, 2 one holds the other, 3 a shared significant word.

    ``registry``: term_id, label.  Candidates share a word; of equally good
    entries the one with the smaller id wins.
    """
    v = values.where("value IS NOT NULL").select("value").distinct().select("value", F.explode(words_of(F.col("value"), least)).alias("word"))
    r = registry.select("term_id", "label", F.explode(words_of(F.col("label"), least)).alias("word"))
    pairs = v.join(broadcast_if_small(r), "word").select("value", "term_id", "label").distinct()
    rule = F.when(F.lower("value") == F.lower("label"), 1).when(bounded(F.col("label"), F.col("value")) | bounded(F.col("value"), F.col("label")), 2).otherwise(3)
    best = pairs.groupBy("value").agg(F.min(F.struct(rule.alias("rule"), "term_id")).alias("m"))
    return best.select("value", "m.term_id", "m.rule")


def compared_in_passes(system: DataFrame, gold: DataFrame, aliases: DataFrame) -> DataFrame:
    """(doc_id, tp_exact, tp_alias, fp, fn) of two sets of (doc_id, name): equal names first, then equal entries.

    ``aliases``: name, entry.  A name that the first pass matched isn't asked
    again; the second pass compares the entries that are left.
    """
    s, g = system.select("doc_id", "name").dropna().distinct(), gold.select("doc_id", "name").dropna().distinct()
    exact = s.join(g, ["doc_id", "name"])
    entry = broadcast_if_small(aliases.groupBy("name").agg(F.min("entry").alias("entry")))
    left = lambda df: df.join(exact, ["doc_id", "name"], "left_anti").join(entry, "name", "left").select("doc_id", F.coalesce("entry", "name").alias("entry")).distinct()
    s2, g2 = left(s), left(g)
    both = s2.withColumn("s", F.lit(1)).join(g2.withColumn("g", F.lit(1)), ["doc_id", "entry"], "full")
    second = both.groupBy("doc_id").agg(F.count_if(F.col("s").isNotNull() & F.col("g").isNotNull()).alias("tp_alias"), F.count_if(F.col("g").isNull()).alias("fp"), F.count_if(F.col("s").isNull()).alias("fn"))
    first = exact.groupBy("doc_id").agg(F.count("*").alias("tp_exact"))
    return first.join(second, "doc_id", "full").fillna(0, ["tp_exact", "tp_alias", "fp", "fn"])
