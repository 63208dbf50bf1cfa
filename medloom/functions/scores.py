"""Scores and geometry as column functions, and text similarity."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clamp(x: Column, lo: float = 0.1, hi: float = 0.95) -> Column:
    return F.least(F.lit(hi), F.greatest(F.lit(lo), x))


def unified_confidence(section: Column, pattern: Column, in_table: Column, in_lexicon: Column, external: Column, negated: Column) -> Column:
    """Base .5 with additive evidence, clamped to [.1, .95]; flags are booleans, ``pattern`` is a number up to .3."""
    flag = lambda c, w: F.when(c, w).otherwise(0.0)
    return clamp(F.lit(0.5) + flag(section, 0.15) + F.least(pattern, F.lit(0.3)) + flag(in_table, 0.15) + flag(in_lexicon, 0.1) + flag(external, 0.15) - flag(negated, 0.2))


def verified_penalty(quote_ok: Column, unverified: Column) -> Column:
    """.5 if the quote fails, times .7 for each number that isn't found."""
    return F.when(quote_ok, 1.0).otherwise(0.5) * F.pow(F.lit(0.7), unverified)


def safe_ratio(a: Column, b: Column, digits: int = 4) -> Column:
    return F.round(F.try_divide(a.cast("double"), b.cast("double")), digits)


def f1(p: Column, r: Column, digits: int = 4) -> Column:
    return F.round(F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)), digits)


def overlap_of_shorter(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.try_divide(F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2)), F.least(e1 - s1, e2 - s2))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes (x0, y0, x1, y1)."""
    w = F.greatest(F.lit(0.0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))
    h = F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
    area = lambda r: (r["x1"] - r["x0"]) * (r["y1"] - r["y0"])
    return F.try_divide(w * h, area(a) + area(b) - w * h)


def compare(op: Column, value: Column, bound: Column, upper: Column) -> Column:
    """Evaluate ``value op bound`` (``between`` takes ``upper``)."""
    return F.when(op == "<", value < bound).when(op == "<=", value <= bound).when(op == ">", value > bound).when(op == ">=", value >= bound).when(op == "=", value == bound).when(op == "between", value.between(bound, upper))


@F.pandas_udf(T.DoubleType())
def matcher_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Sequence-matcher ratio of two texts; null if one is null."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")
