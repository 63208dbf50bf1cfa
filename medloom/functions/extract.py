"""Extraction of typed mentions by patterns: arrays of matches as column functions."""

from __future__ import annotations

import math
import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Typed patterns in rank order; each has one capturing group.
PATTERNS = {
    "trial_id": r"\b(NCT[0-9]{8})\b",
    "doi": r"\b(10\.[0-9]{4,9}/[A-Za-z0-9._/-]+[A-Za-z0-9])",
    "pmid": r"PMID:? ?([0-9]{6,9})",
    "pmcid": r"\b(PMC[0-9]{5,8})\b",
    "url": r"(https?://[A-Za-z0-9./_-]+[A-Za-z0-9])",
    "orcid": r"\b([0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X])\b",
    "email": r"\b([A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[a-z]{2,})\b",
    "dose": r"\b([0-9]+(?:\.[0-9]+)? ?(?:mg|mcg|g|kg|mL))\b",
    "concentration": r"\b([0-9]+(?:\.[0-9]+)? ?(?:mg|g)/(?:mL|kg|L))\b",
    "percent": r"\b([0-9]+(?:\.[0-9]+)? ?%)",
    "p_value": r"(p ?[=<] ?0\.[0-9]+)",
    "iso_date": r"\b([12][0-9]{3}-[01][0-9]-[0-3][0-9])\b",
    "compound": r"\b([A-Z]{2,4}-[0-9]{3,6})\b",
    "age": r"\b([0-9]{1,3}-year-old)\b",
    "duration": r"\b([0-9]+ (?:days|weeks|months|years))\b",
}
GENETIC = {
    "hgvs_c": r"\b(c\.[0-9]+[ACGT]>[ACGT])",
    "hgvs_p": r"\b(p\.[A-Z][a-z]{2}[0-9]+(?:[A-Z][a-z]{2}|\*))",
    "rsid": r"\b(rs[0-9]{3,9})\b",
    "hpo": r"\b(HP:[0-9]{7})\b",
    "orpha": r"\b(ORPHA:[0-9]{1,6})\b",
    "hgnc": r"\b(HGNC:[0-9]{1,6})\b",
}


def all_matches(text: Column, patterns: dict[str, str]) -> Column:
    """Array of (kind, rank, nth, value) over all patterns, in rank order."""
    return F.flatten(F.array(*[F.transform(F.regexp_extract_all(text, F.lit(p), 1), _tagged(kind, rank)) for rank, (kind, p) in enumerate(patterns.items())]))


def _tagged(kind: str, rank: int):
    return lambda v, i: F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), i.cast("int").alias("nth"), v.alias("value"))


def typed_mentions(df: DataFrame, key: str, text: str, patterns: dict[str, str] | None = None) -> DataFrame:
    """(key, kind, rank, nth, value): one row for each match, one pass over the text."""
    return df.select(key, F.explode(all_matches(F.col(text), patterns or PATTERNS)).alias("m")).select(key, "m.*")


def definitions(text: Column, styles: tuple[str, ...] = ("parenthetical", "equals", "spoken")) -> Column:
    """Array of (style, long_form, short_form): parenthetical, ``SF = long form`` and spoken definitions; only the asked styles are searched."""
    word = r"[A-Za-z][a-z]+"
    paren = rf"((?:{word} ){{1,6}}{word}) \(([A-Z][A-Za-z0-9-]{{1,9}})\)"
    equals = rf"\b([A-Z][A-Z0-9-]{{1,9}}) ?[=:] ?((?:{word} ){{1,6}}{word})"
    spoken = rf"\b([A-Z][A-Z0-9-]{{1,9}}) stands for ((?:{word} ){{1,6}}{word})"

    def pairs(style: str, rx: str, long_at: int, short_at: int) -> Column:
        return F.transform(F.arrays_zip(F.regexp_extract_all(text, F.lit(rx), long_at).alias("l"), F.regexp_extract_all(text, F.lit(rx), short_at).alias("s")), lambda p: F.struct(F.lit(style).alias("style"), p["l"].alias("long_form"), p["s"].alias("short_form")))

    found = {"parenthetical": (paren, 1, 2), "equals": (equals, 2, 1), "spoken": (spoken, 2, 1)}
    return F.concat(*[pairs(style, *found[style]) for style in styles])


def initial_words(short: Column, before: Column) -> Column:
    """The last run of words before a short form whose initials spell it, else null."""
    words = F.filter(F.split(F.trim(before), r"[\s-]+"), lambda w: w != "")
    n = F.length(short)
    tail = F.slice(words, F.greatest(F.size(words) - n + 1, F.lit(1)), n)
    spelled = F.array_join(F.transform(tail, lambda w: F.upper(F.substring(w, 1, 1))), "")
    return F.when((F.size(words) >= n) & (spelled == F.upper(short)), F.array_join(tail, " "))


@F.pandas_udf(T.StringType())
def aligned_long_form(short: pd.Series, before: pd.Series) -> pd.Series:
    """Backward alignment of a short form's letters in the text before it; null without one.

    Each letter is found right to left; the first one must start a word.
    """

    def one(sf: str | None, text: str | None) -> str | None:
        if not sf or not text:
            return None
        low, at = text.lower(), len(text)
        letters = [c for c in sf.lower() if c.isalnum()]
        for i in range(len(letters) - 1, -1, -1):
            at -= 1
            while at >= 0 and (low[at] != letters[i] or (i == 0 and at > 0 and low[at - 1].isalnum())):
                at -= 1
            if at < 0:
                return None
        found = text[at:].strip()
        return found if len(found) <= 120 and len(found) > len(sf) else None

    return pd.Series([one(a, b) for a, b in zip(short, before, strict=True)], dtype=object)


@F.udtf(returnType="kind: string, span_start: int, span_end: int, value: string")
class MentionSpans:
    """Table function: typed mentions of a text with their offsets (from 0, end exclusive)."""

    def eval(self, text: str):
        for kind, rx in {**PATTERNS, **GENETIC}.items():
            for m in re.finditer(rx, text or "", re.ASCII):
                yield kind, m.start(1), m.end(1), m[1]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def quote_ratios(texts: pd.Series, quotes: pd.Series) -> pd.Series:
    """For each of a text's quotes 1.0 if the text has it, else its best window's ratio, null below 0.9 or for less than 10 characters."""
    import numpy as np

    def trigrams(t: str) -> np.ndarray:
        c = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype="uint32").astype("int64")
        return (c[:-2] << 42) | (c[1:-1] << 21) | c[2:]

    def best_window(quote: str, text: str, grams: tuple, least: float) -> float | None:
        """Highest matcher ratio of ``quote`` and a window of ``text`` of its length or a tenth less or more, if ``least`` or more.

        Only windows that share as many trigrams with the quote as the ratio
        guarantees are compared, so none is lost.
        """
        n, best = len(quote), None
        codes, order = grams
        hits = np.zeros(len(text) + 1, dtype="int64")
        of = np.unique(trigrams(quote))
        for a, b in zip(np.searchsorted(codes, of), np.searchsorted(codes, of, "right"), strict=True):
            hits[order[a:b] + 1] = 1
        total = np.cumsum(hits)
        for w in sorted({n, int(n * 0.9), int(n * 1.1)}):
            if w < 10 or w > len(text):
                continue
            matched = math.ceil(least * (n + w) / 2 - 1e-9)
            must = w - 2 - 3 * (w - matched) - 2 * (n - matched)
            for i in np.flatnonzero(total[w - 2 : len(text) - 1] - total[: len(text) - w + 1] >= must):
                m = SequenceMatcher(None, quote, text[i : i + w])
                if m.real_quick_ratio() >= least and m.quick_ratio() >= least and (r := m.ratio()) >= least and r > (best or 0):
                    best = r
        return best

    out = []
    for text, of in zip(texts, quotes, strict=True):
        codes = trigrams(text)
        order = np.argsort(codes, kind="stable")
        grams = codes[order], order
        out.append([None if not q else 1.0 if q in text else best_window(q, text, grams, 0.9) if len(q) >= 10 else None for q in of])
    return pd.Series(out)


def reference_keys(text: Column) -> Column:
    """Keys ``type:number`` of the figures, tables and exhibits a text names, one per number of a range.

    "Figs. 2-4" are three; a number after a dot is a part of its figure
    ("Figure 2.1"). What can't be a range, as it falls or spans over a
    thousand, gives the keys of its two numbers.
    """
    rx = F.lit(r"(?i)\b(fig|table|exhibit)(?:ure)?s?\.?\s*([0-9]{1,9})(?![0-9])(?:\s*[-\u2010-\u2015]\s*([0-9]{1,9})(?![0-9]))?")
    m = F.arrays_zip(*[F.regexp_extract_all(text, rx, i).alias(n) for i, n in ((1, "k"), (2, "a"), (3, "b"))])

    def keys(x: Column) -> Column:
        a = x["a"].cast("int")
        b = F.coalesce(F.nullif(x["b"], F.lit("")).cast("int"), a)
        numbers = F.when((b >= a) & (b - a <= 1000), F.sequence(a, F.greatest(a, F.least(b, a + 1000)))).otherwise(F.array(a, b))
        kind = F.when(F.lower(x["k"]) == "fig", "figure").otherwise(F.lower(x["k"]))
        return F.transform(numbers, lambda n: F.concat_ws(":", kind, n.cast("string")))

    return F.flatten(F.transform(m, keys))
