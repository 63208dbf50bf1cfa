"""Texts cut off before their end, and how often each source cuts.

Two kinds of evidence are added as log odds.

* Length: each source's lengths follow a log-normal distribution, fitted by
  maximum likelihood with the texts that look cut as right-censored
  observations.  At a limit (in characters or UTF-8 bytes) far more texts pile
  up than the distribution expects there; the ratio is the posterior that a
  text of this length is censored.
* Ending: a text whose last sentence has no end is cut if sentences that start
  alike normally have one, and complete if such lines normally have none
  (headings, key words, signatures).  Both rates are counted over all
  sentences of all texts.  A last word that is only the beginning of a usual
  first word counts as that one.

Defined results: null, empty and blank texts are never cut; texts whose last
sentence is complete aren't either, whatever their length; a null source is a
source of its own.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.session import materialize

#: Texts cut at a character or word border end up to so many units before the limit.
SLACK = 8
#: Log odds that a reported length above the text's own gives.
REPORTED = 2.5
_CLOSERS = r"[\"'”’»)\]\s]*"
#: A full stop with closers, a reference mark after it, or a quotation that trails off.
_ENDED = rf"(?:[.!?。！？]|…(?=[\"'”’»])){_CLOSERS}(?:\[\d+\]\s*)?$"


def ended(unit: Column) -> Column:
    """Whether a sentence has an end; a decimal point inside an open bracket is none."""
    inside = unit.rlike(r"[(\[][^)\]]*\d\.\s*$") | unit.rlike(r"\.\.\.\s*$")
    return unit.rlike(_ENDED) & ~inside


def starter(unit: Column, words: int = 2) -> Column:
    """The first words of a sentence, digits masked."""
    return F.regexp_replace(F.regexp_replace(F.regexp_extract(unit, r"^\s*(\S+(?:\s+\S+){0,%d})" % (words - 1), 1), r"\d+", "9"), r"\s+", " ")


def endings(docs: DataFrame) -> DataFrame:
    """Each text's last sentence: has_end, starter, one_word, and its lengths; ``text`` is dropped."""
    # the last line is cut off by position: a regular expression would search it from every character
    text = F.rtrim(F.translate("text", "\r\t\u00a0", "\n  "), F.lit(" \n\u3000\u2028"))
    line = F.substring_index(text, "\n", -1)
    unit = F.regexp_extract(line, r"^(?:.*[.!?。]\s+)?(\S.*)$", 1)
    return docs.where(F.trim(F.regexp_replace("text", r"\s+", " ")) != "").select(
        "doc_id", "source", "n_chars", F.length("text").alias("chars"), F.octet_length("text").alias("bytes"), ended(unit).alias("has_end"), starter(unit).alias("starter"), (~unit.rlike(r"\S\s+\S+\s+\S")).alias("brief")
    )


def starters(docs: DataFrame) -> DataFrame:
    """(starter, closed, open): how many sentences of all texts start so, with and without an end."""
    units = docs.select(F.explode(F.split("text", r"[\r\n]+|(?<=[.!?。])\s+")).alias("u")).where(F.trim("u") != "")
    counted = units.groupBy(starter(F.col("u")).alias("starter")).agg(F.count("*").alias("n"), F.count_if(ended(F.col("u"))).alias("closed"))
    return counted.select("starter", "closed", (F.col("n") - F.col("closed")).alias("open"))


def with_ending_odds(ends: DataFrame, stats: DataFrame) -> DataFrame:
    """The texts without an end, with ``ending``: the log odds that it was cut off.

    The first two words decide; where they are rarer than three times, the
    first one does.  Where there are no more than two, they may be cut
    themselves and also count as the beginning of usual ones.
    """
    first = F.split(F.col("starter"), " ")[0]
    single = stats.groupBy(first.alias("word")).agg(F.sum("closed").alias("closed1"), F.sum("open").alias("open1"))
    # beginnings are cut at the lengths that brief texts have, and only those that such a text has are counted
    brief = materialize(ends.where("brief AND NOT has_end").select("starter").distinct())
    lengths = brief.agg(F.array_sort(F.collect_set(F.length("starter")))).first()[0] or []
    cut_at = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n < F.greatest(F.length("starter"), F.lit(2)))
    prefixes = stats.where("closed > open").select(F.explode(F.transform(cut_at, lambda n: F.substring(F.col("starter"), F.lit(1), n))).alias("starter"), "closed")
    longer = prefixes.join(brief, "starter", "left_semi").groupBy("starter").agg(F.sum("closed").alias("as_prefix"))
    open_ = ends.where(~F.col("has_end")).withColumn("word", first).join(stats, "starter", "left").join(single, "word", "left").join(longer, "starter", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    pair = F.col("brief") | (n("closed") + n("open") >= 3)
    closed = F.when(pair, n("closed") + F.when(F.col("brief"), n("as_prefix")).otherwise(F.lit(0))).otherwise(n("closed1"))
    odds = F.log((closed + 0.5) / (F.when(pair, n("open")).otherwise(n("open1")) + 0.5))
    # where the first word alone says the same, the better founded of the two counts
    alone = F.log((n("closed1") + 0.5) / (n("open1") + 0.5))
    odds = F.when((odds * alone > 0) & (F.abs(alone) > F.abs(odds)), alone).otherwise(odds)
    return open_.withColumn("ending", odds).select("doc_id", "source", "n_chars", "chars", "bytes", "ending")


def fit_censored(log_length: np.ndarray, count: np.ndarray, censored: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Mean and deviation of the log length by maximum likelihood with right-censored observations."""
    n = count.sum()
    mu = float((count * log_length).sum() / n)
    sigma = max(0.05, math.sqrt(float((count * (log_length - mu) ** 2).sum() / n)))
    for _ in range(rounds):
        z = (log_length - mu) / sigma
        density = np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)
        tail = np.maximum(1e-12, 0.5 * np.array([math.erfc(x / math.sqrt(2)) for x in z]))
        hazard = density / tail
        first = np.where(censored, mu + sigma * hazard, log_length)
        second = np.where(censored, sigma**2 * (1 + z * hazard - hazard**2) + first**2, log_length**2)
        new_mu = float((count * first).sum() / n)
        new_sigma = math.sqrt(max(0.0025, float((count * second).sum() / n) - new_mu**2))
        moved = abs(new_mu - mu) + abs(new_sigma - sigma)
        mu, sigma = new_mu, new_sigma
        if moved < 1e-6:
            break
    return mu, sigma


def _cdf(x: float, mu: float, sigma: float) -> float:
    return 0.5 * math.erfc(-(math.log(max(x, 0.5)) - mu) / (sigma * math.sqrt(2)))


def limits_of(pdf: pd.DataFrame, least: int = 3, excess: float = 4.0) -> pd.DataFrame:
    """Limits of one source from its histogram: measure, value, censored, count.

    One row for each length that belongs to a limit, with the posterior that a
    text without an end that has it was censored there.
    """
    out = []
    for measure, h in pdf.groupby("measure"):
        mu, sigma = fit_censored(np.log(np.maximum(1, h["value"].to_numpy("float64"))), h["count"].to_numpy("float64"), h["censored"].to_numpy(bool))
        total = float(h["count"].sum())
        cut = h[h["censored"]].groupby("value")["count"].sum().sort_index()
        values, counts = cut.index.to_numpy(), cut.to_numpy("float64")
        if not len(values):
            continue
        sums = np.concatenate([[0.0], np.cumsum(counts)])
        pile = sums[1:] - sums[np.searchsorted(values, values - SLACK)]
        expected = total * np.array([_cdf(v + 0.5, mu, sigma) - _cdf(v - SLACK - 0.5, mu, sigma) for v in values])
        # the highest piles first; a pile belongs to one limit
        used: list[int] = []
        for i in np.argsort(-pile, kind="stable"):
            v = int(values[i])
            if pile[i] < least or pile[i] < excess * expected[i]:
                continue
            if any(abs(v - u) <= 2 * SLACK for u in used):
                continue
            used.append(v)
            p = pile[i] / (pile[i] + expected[i])
            at = (values >= v - SLACK) & (values <= v)
            limit = int(values[at][np.argmax(counts[at])])
            out += [(measure, limit, x, p) for x in range(v - SLACK, v + 2)]
    return pd.DataFrame(out, columns=["measure", "limit", "value", "posterior"])


def censoring(ends: DataFrame, odds: DataFrame) -> DataFrame:
    """(source, measure, limit, value, posterior) of every length at which a source cuts.

    Each source's histogram, not its texts, comes into one task: its size is
    bounded by the number of different lengths.
    """
    looks_cut = odds.where("ending > 0").select("source", "chars", "bytes", F.lit(True).alias("censored"))
    rest = ends.where("has_end").select("source", "chars", "bytes", F.lit(False).alias("censored")).unionByName(odds.where("ending <= 0").select("source", "chars", "bytes", F.lit(False).alias("censored")))
    # complete lengths only shape the fit: hundredths of their logarithm are fine enough
    both = looks_cut.unionByName(rest).select("source", "censored", F.explode(F.create_map(F.lit("chars"), F.col("chars"), F.lit("bytes"), F.col("bytes"))).alias("measure", "exact"))
    value = F.when(F.col("censored"), F.col("exact")).otherwise(F.exp(F.round(F.log("exact"), 2)).cast("int"))
    hist = both.groupBy("source", "measure", value.alias("value"), "censored").agg(F.count("*").alias("count"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return limits_of(pdf).assign(source=pdf["source"].iloc[0])[["source", "measure", "limit", "value", "posterior"]]

    return hist.groupBy("source").applyInPandas(run, "source string, measure string, limit int, value int, posterior double")


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, source, is_cut, score, limit): every text that isn't blank.

    ``docs`` has doc_id, text, source and n_chars.
    """
    docs = docs.select("doc_id", "text", "source", "n_chars")
    ends = materialize(endings(docs))
    odds = materialize(with_ending_odds(ends, materialize(starters(docs))))
    limits = censoring(ends, odds)
    best = limits.groupBy("source", "measure", "value").agg(F.max("posterior").alias("p"), F.max_by("limit", "posterior").alias("limit"))
    for m in ("chars", "bytes"):
        side = best.where(F.col("measure") == m).select(F.col("source").alias("s"), F.col("value").alias(m), F.col("p").alias(f"p_{m}"), F.col("limit").alias(f"limit_{m}"))
        odds = odds.join(side, F.col("source").eqNullSafe(F.col("s")) & (odds[m] == side[m]), "left").drop("s", side[m])
    p = F.greatest(F.coalesce("p_chars", F.lit(0.0)), F.coalesce("p_bytes", F.lit(0.0)))
    at_limit = F.when(p > 0, F.log(F.least(p, F.lit(0.999)) / (1 - F.least(p, F.lit(0.999))))).otherwise(F.lit(0.0))
    reported = F.when(F.col("n_chars") > F.col("bytes") + 1, F.lit(REPORTED)).otherwise(F.lit(0.0))
    score = F.col("ending") + F.greatest(at_limit, F.lit(0.0)) + reported
    cut = odds.select("doc_id", "source", (score > 0).alias("is_cut"), score.alias("score"), F.when(p > 0, F.when(F.coalesce("p_chars", F.lit(0.0)) == p, F.col("limit_chars")).otherwise(F.col("limit_bytes"))).alias("limit"))
    return cut.unionByName(ends.where("has_end").select("doc_id", "source", F.lit(False).alias("is_cut"), F.lit(None).cast("double").alias("score"), F.lit(None).cast("int").alias("limit")))


def source_report(judged: DataFrame) -> DataFrame:
    """Each source's texts, cut texts, their share, and its commonest limit."""
    by = judged.groupBy("source", "limit").agg(F.count("*").alias("n"), F.count_if("is_cut").alias("c"))
    return by.groupBy("source").agg(
        F.sum("n").alias("texts"), F.sum("c").alias("cut_texts"), F.round(F.sum("c") / F.sum("n"), 6).alias("cut_share"), F.max_by("limit", F.when(F.col("limit").isNotNull() & (F.col("c") > 0), F.struct("c", "limit"))).alias("main_limit")
    )
