"""Matching of system output with a gold standard, and its scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from medloom.functions.scores import f1, matcher_ratio, safe_ratio


def compare_sets(system: DataFrame, gold: DataFrame, by: str, keys: list[str]) -> DataFrame:
    """(by, tp, fp, fn) of distinct keys per document: one full outer join, no UDF."""
    s = system.select(by, *keys).distinct().withColumn("in_system", F.lit(True))
    g = gold.select(by, *keys).distinct().withColumn("in_gold", F.lit(True))
    both = s.join(g, [by, *keys], "full_outer")
    return both.groupBy(by).agg(
        F.count_if(F.col("in_system") & F.col("in_gold")).alias("tp"), F.count_if(F.col("in_system") & F.col("in_gold").isNull()).alias("fp"), F.count_if(F.col("in_gold") & F.col("in_system").isNull()).alias("fn")
    )


def micro(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 of the summed counts; null without gold or output."""
    t = counts.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    p, r = safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")), safe_ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return t.select("tp", "fp", "fn", p.alias("precision"), r.alias("recall"), f1(p, r).alias("f1"))


def macro(counts: DataFrame) -> DataFrame:
    """Means over the documents that have gold."""
    scored = counts.where(F.col("tp") + F.col("fn") > 0)
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(0.0))
    r = F.col("tp").cast("double") / (F.col("tp") + F.col("fn"))
    return scored.agg(F.count("*").alias("docs"), F.round(F.avg(p), 4).alias("precision"), F.round(F.avg(r), 4).alias("recall"))


def one_to_one(pairs: DataFrame) -> DataFrame:
    """Greedy one-to-one matching of (by, s, g, score): best score first, ties to smaller ids.

    A document's pairs stream in that order through one task, which keeps a
    pair while both its ends are free: the whole greedy result, however many
    pairs tie. Only the matched ids of one document are in memory.
    """

    def free_ends(parts):
        """Keeps each pair whose ends are both free, of pairs in order; a document's pairs are adjacent."""
        doc, used_s, used_g = None, set(), set()
        for part in parts:
            keep = []
            for by, s, g in zip(part["by"], part["s"], part["g"], strict=True):
                if by != doc:
                    doc, used_s, used_g = by, set(), set()
                keep.append(free := s not in used_s and g not in used_g)
                if free:
                    used_s.add(s)
                    used_g.add(g)
            yield part[keep]

    ordered = pairs.select("by", "s", "g", "score").where("by IS NOT NULL").repartition("by").sortWithinPartitions("by", F.desc("score"), "s", "g")
    return ordered.mapInPandas(free_ends, ordered.schema)


def match_texts(system: DataFrame, gold: DataFrame, by: str, text: str, least: float = 0.8) -> DataFrame:
    """``one_to_one`` of ``fuzzy_pairs``, without pairing equal texts with each other.

    The i-th copy of a text meets the i-th copy of the other side, as the
    greedy order has it; only the rest is compared, so k copies give k rows
    and not k^2.
    """
    side = lambda df, n: df.select(F.col(by).alias("by"), F.col("id").alias(n), F.lower(text).alias("t")).withColumn("r", F.row_number().over(W.partitionBy("by", "t").orderBy(n)))
    equal = side(system, "s").join(side(gold, "g"), ["by", "t", "r"]).select("by", "s", "g", F.lit(1.0).alias("score"))
    rest = lambda df, n: df.join(equal.select(F.col(n).alias("id")), "id", "left_anti")
    return equal.unionByName(one_to_one(fuzzy_pairs(rest(system, "s"), rest(gold, "g"), by, text, least)))


def _numbered_grams(df: DataFrame, keys: list[str], text: str, q: int) -> DataFrame:
    """(keys, text, gram, nth): padded q-grams of distinct texts, repeated ones numbered."""
    padded = F.concat(F.lit("\x02" * (q - 1)), F.col(text), F.lit("\x03" * (q - 1)))
    rows = df.where(F.length(text) > 0).select(*keys, text, padded.alias("_p"), F.explode(F.sequence(F.lit(1), F.length(text) + (q - 1))).alias("_i"))
    counted = rows.select(*keys, text, F.substring(F.col("_p"), F.col("_i"), F.lit(q)).alias("gram")).groupBy(*keys, text, "gram").agg(F.count("*").alias("_n"))
    return counted.select(*keys, text, "gram", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("nth"))


def similar_texts(left: DataFrame, right: DataFrame, keys: list[str], least: float) -> DataFrame:
    """(keys, l, r, score) of the differing texts ``l`` and ``r`` of equal keys with a matcher ratio of ``least`` or more, without loss.

    Of S characters in both texts, a ratio of R leaves M >= R S / 2 matched, in
    order, and D = S - 2 M not. Hence the longer text has at most (2 - R) / R
    times the characters of the other, their edit distance is D at most, and
    they share at least M - (q - 1) (D - 1) padded q-grams, since a character
    left out breaks q of them and one put in q - 1. Texts that share so many
    share one of the rarest of either (all but that number less one), which is
    the join's key.
    """
    q = 3 if least >= 0.85 else 2 if least >= 2 / 3 else 1
    shared = lambda n: n * (least / 2 - (q - 1) * (1 - least)) + (q - 1)
    near = 1e-9
    gl, gr = (_numbered_grams(df.select(*keys, c).distinct(), keys, c, q) for df, c in ((left, "l"), (right, "r")))
    often = gl.select("gram", "nth").unionByName(gr.select("gram", "nth")).groupBy("gram", "nth").agg(F.count("*").alias("often"))

    def rarest(g: DataFrame, c: str) -> DataFrame:
        must = F.greatest(F.ceil(shared(F.length(c) * 2 / (2 - least)) - near), F.lit(1))
        ranked = g.join(often, ["gram", "nth"]).withColumn("_k", F.row_number().over(W.partitionBy(*keys, c).orderBy("often", "gram", "nth")))
        return ranked.where(F.col("_k") <= F.length(c) + q - must).select(*keys, c, "gram", "nth")

    a, b = F.length("l"), F.length("r")
    fits = (F.greatest(a, b) * least <= F.least(a, b) * (2 - least) + near) & (F.col("l") != F.col("r"))
    pairs = rarest(gl, "l").join(rarest(gr, "r"), [*keys, "gram", "nth"]).where(fits).select(*keys, "l", "r").distinct()
    edits = F.expr(f"levenshtein(l, r, cast(floor((length(l) + length(r)) * {1 - least!r}D + {near!r}D) as int))")
    return pairs.where(edits >= 0).withColumn("score", matcher_ratio("l", "r")).where(F.col("score") >= least)


def fuzzy_pairs(system: DataFrame, gold: DataFrame, by: str, text: str, least: float = 0.8) -> DataFrame:
    """Pairs (by, s, g, score) of similar texts of a document, all of them; each two texts are compared once."""
    side = lambda df, n, t: df.select(F.col(by).alias("by"), F.col("id").alias(n), F.lower(text).alias(t))
    s, g = side(system, "s", "l"), side(gold, "g", "r")
    equal = s.join(g.withColumnRenamed("r", "l"), ["by", "l"]).select("by", "s", "g", F.lit(1.0).alias("score"))
    near = similar_texts(s, g, ["by"], least).join(s, ["by", "l"]).join(g, ["by", "r"]).select("by", "s", "g", "score")
    return equal.unionByName(near)
