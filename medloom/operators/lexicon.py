"""Dictionary joins of texts with lexicons.

Texts become token n-grams, so a dictionary of any size is met by an equi-join
on the normalised n-gram instead of a nested loop over its entries; the
longest, leftmost, non-overlapping hits are then kept per text.

Defined results: null and empty texts have no hits; equal spans keep the entry
with the smaller priority, then the smaller key.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """Lower-case word tokens of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def ngrams(df: DataFrame, key: str, text: str, sizes: list[int]) -> DataFrame:
    """(key, start, n, gram) of every run of as many tokens as one of ``sizes``; ``start`` counts tokens from 0."""
    t = df.select(key, tokens(F.col(text)).alias("t"))
    at = t.select(key, "t", F.posexplode(F.transform("t", lambda x: F.lit(0))).alias("start", "z"))
    fitting = F.filter(F.array(*map(F.lit, sizes)).cast("array<int>"), lambda n: n <= F.size("t") - F.col("start"))
    sized = at.select(key, "t", "start", F.explode(fitting).alias("n"))
    return sized.select(key, "start", "n", F.array_join(F.slice("t", F.col("start") + 1, F.col("n")), " ").alias("gram"))


def entries(lexicon: DataFrame, entry: str, forms: list[Column]) -> DataFrame:
    """(gram, entry, priority, n) of the lexicon's forms, in the order given; equal forms keep the first."""
    every = lexicon.select(F.col(entry).alias("entry"), F.explode(F.flatten(F.array(*[F.transform(f, _at(i)) for i, f in enumerate(forms)]))).alias("f"))
    keyed = every.select("entry", "f.priority", F.array_join(tokens(F.col("f.form")), " ").alias("gram")).where("gram <> ''")
    best = keyed.groupBy("gram").agg(F.min(F.struct("priority", "entry")).alias("m"))
    return best.select("gram", "m.entry", "m.priority", F.size(F.split("gram", " ")).alias("n"))


def _at(i: int):
    return lambda x: F.struct(F.lit(i).alias("priority"), x.alias("form"))


def sizes_of(grams: DataFrame) -> list[int]:
    """The different numbers of tokens of ``gram``, one number each for the driver."""
    return sorted(r[0] for r in grams.select(F.size(F.split("gram", " ")).alias("n")).distinct().collect())


def hits(df: DataFrame, key: str, text: str, forms: DataFrame) -> DataFrame:
    """(key, start, n, entry, priority): every n-gram that is a form, overlapping ones included.

    N-grams are as long as the lexicon's own forms, whatever their length.
    """
    return ngrams(df, key, text, sizes_of(forms)).join(forms.select("gram", "entry", "priority"), "gram").select(key, "start", "n", "entry", "priority")


def longest_leftmost(found: DataFrame, key: str) -> DataFrame:
    """Non-overlapping hits: from the left, the longest at each place; the rest of its tokens are skipped.

    Only hits that overlap others need the sequential step: they are grouped
    by runs of overlapping hits, which windows find first.
    """
    once = found.withColumn("r", F.row_number().over(W.partitionBy(key, "start").orderBy(F.desc("n"), "priority", "entry"))).where("r = 1").drop("r")
    order = W.partitionBy(key).orderBy("start")
    reach = F.max(F.col("start") + F.col("n")).over(order.rowsBetween(W.unboundedPreceding, -1))
    runs = once.withColumn("new", (F.coalesce(reach, F.lit(0)) <= F.col("start")).cast("int")).withColumn("run", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    sized = runs.withColumn("many", F.count("*").over(W.partitionBy(key, "run"))).drop("new")
    alone = sized.where("many = 1").select(key, "start", "n", "entry", "priority")
    types = dict(found.dtypes)

    def greedy(pdf: pd.DataFrame) -> pd.DataFrame:
        kept, end = [], -1
        pdf = pdf.sort_values("start", kind="stable").reset_index(drop=True)
        for i, (s, n) in enumerate(zip(pdf["start"], pdf["n"], strict=True)):
            if s >= end:
                kept.append(i)
                end = s + n
        return pdf.loc[kept, [key, "start", "n", "entry", "priority"]]

    schema = f"{key} {types[key]}, start int, n int, entry {types['entry']}, priority int"
    return alone.unionByName(sized.where("many > 1").groupBy(key, "run").applyInPandas(greedy, schema))


def contained(df: DataFrame, key: str, text: str, forms: DataFrame) -> DataFrame:
    """(key, entry): the longest form contained in each text, by whole tokens."""
    found = hits(df, key, text, forms)
    return found.groupBy(key).agg(F.max_by("entry", F.struct("n", F.negative("priority"), "entry")).alias("entry"))
