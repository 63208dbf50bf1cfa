"""Text normalisation as column functions: built-in expressions, one per rule.

All give null for null and an empty text for an empty one unless stated.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters that are written alike.
DASHES = "‐‑‒–—−"
CURLY, STRAIGHT = "‘’“”", "''\"\""
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñç"
UNACCENTED = "aaaaaaeeeeiiiiooooouuuunc"
NBSP = chr(0xA0)
#: American stems and their British spellings.
BRITISH = {"anemia": "anaemia", "edema": "oedema", "tumor": "tumour", "hemo": "haemo", "estrogen": "oestrogen", "esoph": "oesoph"}


def places(text: Column, part: str) -> Column:
    """Where a part stands in a text, from 0; places don't overlap."""
    pieces = F.split(text, rf"\Q{part}\E")
    before = lambda k: F.aggregate(F.slice(pieces, F.lit(1), k), F.lit(0), lambda n, p: n + F.length(p)) + (k - 1) * len(part)
    return F.when(F.size(pieces) > 1, F.transform(F.sequence(F.lit(1), F.size(pieces) - 1), before))


def clean_whitespace(x: Column) -> Column:
    """Runs of white space become one space; both ends are trimmed."""
    return F.trim(F.regexp_replace(x, rf"[\s{NBSP}]+", " "))


def unify_dashes(x: Column) -> Column:
    return F.translate(x, DASHES, "-" * len(DASHES))


def dehyphenate(x: Column, keep: tuple[str, ...] = ("anti", "non", "self", "long", "double", "dose", "low", "high")) -> Column:
    """A hyphen before a space goes; one inside a word goes unless its prefix makes compounds."""
    joined = F.regexp_replace(x, r"([a-z])- ([a-z])", "$1$2")
    return F.regexp_replace(joined, rf"(?<!\b(?:{'|'.join(keep)}))(?<=[a-z]{{2}})-(?=[a-z]{{2}})", "")


def truncate_at_clause(x: Column) -> Column:
    """Text before the first clause break (stop, bracket, relative pronoun or auxiliary), without trailing connectors."""
    head = F.regexp_extract(x, r"^(.*?)(?:[,;:.()]| which | that | who | was | were | is | are |$)", 1)
    return F.trim(F.regexp_replace(head, r"(?: (?:and|or|of|the|with|in))+ *$", ""))


def long_form(x: Column) -> Column:
    """White space, clause cut (kept if three characters remain) and hyphens in turn."""
    ws = clean_whitespace(x)
    cut = truncate_at_clause(ws)
    return dehyphenate(F.when(F.length(cut) >= 3, cut).otherwise(ws))


def dedup_key(x: Column) -> Column:
    """Dashes unified and tight, white space single, lower case."""
    return F.lower(clean_whitespace(F.regexp_replace(unify_dashes(x), r" *- *", "-")))


def mask_digits(x: Column) -> Column:
    """Lower case, single spaces, digit runs as ``#``."""
    return F.regexp_replace(clean_whitespace(F.lower(x)), r"[0-9]+", "#")


def straight_quotes(x: Column) -> Column:
    return F.translate(x, CURLY, STRAIGHT)


def strip_accents(x: Column) -> Column:
    """Length-preserving: one letter for one letter."""
    return F.translate(x, ACCENTED + ACCENTED.upper(), UNACCENTED + UNACCENTED.upper())


def british(x: Column) -> Column:
    for us, uk in BRITISH.items():
        x = F.regexp_replace(x, rf"\b{us}", uk)
    return x


def plural(x: Column) -> Column:
    """Plural of the last word; null under five characters and for acronyms."""
    last = F.when(x.rlike("[^aeiou]y$"), F.concat(F.regexp_replace(x, "y$", ""), F.lit("ies"))).when(x.rlike("(s|x|ch|sh)$"), F.concat(x, F.lit("es"))).otherwise(F.concat(x, F.lit("s")))
    return F.when((F.length(x) >= 5) & ~x.rlike("^[A-Z0-9-]+$"), last)


def term_key(x: Column) -> Column:
    """Lower case, single spaces, no punctuation round it."""
    return F.regexp_replace(clean_whitespace(F.lower(x)), r"^[^a-z0-9]+|[^a-z0-9]+$", "")


def balance_brackets(x: Column) -> Column:
    """Trailing closing brackets go while more are closed than open."""
    opened = F.length(x) - F.length(F.replace(x, F.lit("("), F.lit("")))
    closed = F.length(x) - F.length(F.replace(x, F.lit(")"), F.lit("")))
    trailing = F.length(x) - F.length(F.regexp_replace(x, r"\)+$", ""))
    surplus = F.greatest(F.lit(0), F.least(trailing, closed - opened))
    return F.substring(x, F.lit(1), F.length(x) - surplus)


def per_million(x: Column) -> Column:
    """``a in b``, ``a per b``, ``a/b`` and percentages as a rate per million; null for others."""
    plain = F.regexp_replace(x, r"(?<=[0-9]),(?=[0-9]{3})", "")
    a, b = F.regexp_extract(plain, r"([0-9.]+) ?(?:in|per|/) ?([0-9]+)", 1), F.regexp_extract(plain, r"([0-9.]+) ?(?:in|per|/) ?([0-9]+)", 2)
    pct = F.regexp_extract(plain, r"([0-9.]+) ?%", 1)
    return F.when((a != "") & (b != "") & (b.try_cast("double") > 0), F.round(a.try_cast("double") / b.try_cast("double") * 1e6, 4)).when(pct != "", F.round(pct.try_cast("double") * 1e4, 4))


def country(x: Column) -> Column:
    key = F.lower(F.regexp_replace(x, r"[. ]", ""))
    return F.when(key.isin("us", "usa", "unitedstates"), "United States").when(key.isin("uk", "greatbritain", "unitedkingdom"), "United Kingdom").otherwise(F.initcap(F.lower(F.trim(x))))


def grade(x: Column) -> Column:
    """A grade as a whole number, from digits or Roman numerals."""
    roman = F.create_map(*[F.lit(v) for kv in {"I": 1, "II": 2, "III": 3, "IV": 4, "V": 5}.items() for v in kv])
    return F.coalesce(F.trim(x).try_cast("int"), F.try_element_at(roman, F.upper(F.trim(x))))


def hgvs(x: Column) -> Column:
    """``c.`` forms upper-cased after the prefix; ``p.`` forms as they are."""
    return F.when(F.lower(x).startswith("c."), F.concat(F.lit("c."), F.upper(F.substring(x, 3, 1000)))).otherwise(F.concat(F.lower(F.substring(x, 1, 2)), F.substring(x, 3, 1000)))


def repair_doi(x: Column) -> Column:
    return F.regexp_replace(x, r"(10\.[0-9]{4,9}/) +([^ ]+)", "$1$2")


def file_name(x: Column) -> Column:
    """Safe part of a file name: word characters joined by single underscores, 60 at most."""
    return F.substring(F.regexp_replace(F.regexp_replace(x, r"[^A-Za-z0-9]+", "_"), "^_+|_+$", ""), 1, 60)


def short_hash(x: Column, n: int = 16) -> Column:
    return F.substring(F.sha2(x, 256), 1, n)


def cache_key(prefix: str, x: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.md5(F.lower(F.trim(x))), 1, 12))


@F.pandas_udf(T.StringType())
def _compat(x: pd.Series) -> pd.Series:
    return x.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def short_form(x: Column) -> Column:
    """Compatibility form, dashes unified, white space single, upper case; only non-ASCII texts leave the JVM."""
    plain = x.rlike(r"^[\x00-\x7f]*$")
    return F.upper(clean_whitespace(unify_dashes(F.when(plain | x.isNull(), x).otherwise(_compat(F.when(~plain, x))))))


def window_around(text: Column, start: Column, length: Column, width: int) -> Column:
    """``width`` characters on both sides of a match; ``start`` counts from 0."""
    lo = F.greatest(start - width, F.lit(0))
    return F.substring(text, lo + 1, (start - lo + length + width).cast("int"))
