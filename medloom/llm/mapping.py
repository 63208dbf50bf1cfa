"""Freely typed values mapped to the entries of a canonical list.

Values and the list's surface forms are read alike: one squashed form for
codes and whole names, word tokens, and number tokens (with a letter after
them) that must agree exactly.  Values whose squashed form is listed are done.
For the rest, each distinct token is joined to the vocabulary by equi-joins that
miss no pair within the edits allowed: up to two edits through keys with as
many characters left out, three edits through halves, one of which has at most
one of them.  Pairs are verified by edit distance.  The rarest words name an
entry and must all be met; entries whose naming words are met are ranked by
soft TF-IDF over all their words.  Codes (values without a long word) are
ranked against codes only and must score ``LEAST_CODE``: where three or four
letters make an entry, another letter is another entry.

Only distinct values and tokens are compared; rows are joined back at the end.

Defined results: null, blank and placeholder values, values without an entry
above ``least`` and values whose numbers no entry has are mapped to ``NONE``;
of equally good entries the one with the smaller form rank, then the smaller
key, wins.
"""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.llm.lookalikes import canonical
from medloom.session import materialize

# Words that don't tell entries apart, and values that mean none.
NOISE = "gene genes protein locus human homo sapiens the a an of nos unspecified disorder confirmed suspected possible probable see note type".split()
PLACEHOLDERS = "unknown none null na not mapped see text tbd pending unclear other missing".split()
GREEK = {"α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "ε": "epsilon", "κ": "kappa"}
ROMAN = {"i": 1, "v": 5, "x": 10}
READ = T.StructType().add("squash", T.StringType()).add("code", T.StringType()).add("is_name", T.BooleanType()).add("words", T.ArrayType(T.StringType())).add("numbers", T.StringType())
NONE = "NONE"
#: Least score of a code.
LEAST_CODE = 0.83


def _roman(t: str) -> str | None:
    """``ix`` -> ``9``; a letter a or b may follow."""
    m = re.fullmatch(r"((?:x{0,3})(?:ix|iv|v?i{0,3}))([ab]?)", t)
    if not m or not m[1]:
        return None
    v = [ROMAN[c] for c in m[1]]
    return str(sum(-a if a < b else a for a, b in zip(v, [*v[1:], 0], strict=True))) + m[2]


def read(value: str | None) -> dict:
    """Squashed form, code form (look-alike digits repaired), words and numbers of a value."""
    none = {"squash": None, "code": None, "is_name": False, "words": [], "numbers": ""}
    if value is None:
        return none
    t = canonical(value)
    for g, name in GREEK.items():
        t = t.replace(g, name)
    raw = t
    # letters typed for digits at the end of an upper-case code
    code = re.search(r"(?<![A-Za-z0-9])[A-Z]{2,7}[-_/ ]?[0-9lIOo]*[lIOo][0-9lIOo]*[A-Z]?(?![A-Za-z0-9])", raw)
    t = re.sub(r"[\[(][^\])]*[\])]", " ", t) if re.match(r"\s*[^\[(]*[A-Za-z0-9]", re.sub(r"[\[(].*", "", t)) else t
    t = "".join(c for c in unicodedata.normalize("NFKD", t.casefold()) if not unicodedata.combining(c))
    tokens = re.findall(r"[a-z]+|[0-9]+[a-z]?(?![a-z])|[0-9]+", t)
    spaced = re.findall(r"[a-z0-9]+", t)
    if not tokens or " ".join(spaced) in PLACEHOLDERS or all(w in PLACEHOLDERS for w in spaced):
        return none
    words, numbers = [], []
    for i, w in enumerate(tokens):
        if w[0].isdigit() or w in GREEK.values():
            numbers.append(w)
        elif (i == len(tokens) - 1 or tokens[i - 1] == "type") and i and (r := _roman(w)):
            numbers.append(r)
        elif w not in NOISE:
            words.append(w)
    kept = [w for w in spaced if w not in NOISE] or spaced
    fixed = None
    if code:
        flat = re.sub(r"[-_/ ]", "", code[0])
        m = re.fullmatch(r"([A-Z]+?)([0-9lIOo]*[lo0-9][0-9lIOo]*|[IO]+)([A-Z]?)", flat)
        fixed = (m[1] + m[2].translate(str.maketrans("lIOo", "1100")) + m[3]).lower() if m else None
    # codes and abbreviations are too short to be repaired: another letter is another entry
    is_name = any(len(w) >= 7 for w in words) or sum(len(w) >= 4 for w in words) >= 2
    return {"squash": "".join(kept), "code": fixed, "is_name": is_name, "words": words, "numbers": " ".join(sorted(numbers))}


@F.pandas_udf(READ)
def _read(values: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read(v) for v in values], columns=["squash", "code", "is_name", "words", "numbers"])


def osa(a: str, b: str, most: int) -> int:
    """Edit distance with neighbouring transpositions, or ``most`` + 1 above ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            c = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if before and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                c = min(c, before[j - 2] + 1)
            row.append(c)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


def allowed(length: int) -> int:
    """Edits that a token of this length may have."""
    return 0 if length < 3 else 1 if length < 6 else 2 if length < 10 else 3


def left_out(token: str, most: int) -> set[str]:
    """The token and all its forms with up to ``most`` characters left out."""
    keys = level = {token}
    for _ in range(most):
        level = {t[:i] + t[i + 1 :] for t in level for i in range(len(t))}
        keys = keys | level
    return keys


#: Tokens of this length may have three edits; keys of two characters left out reach two letters further.
LONG = 10


def _halves(token: str, prefixes, suffixes) -> set[str]:
    """Keys of beginnings and ends of the given lengths with up to one character left out."""
    out = {f"<{k}" for n in prefixes if 0 < n <= len(token) for k in left_out(token[:n], 1)}
    return out | {f">{k}" for n in suffixes if 0 < n <= len(token) for k in left_out(token[-n:], 1)}


def asked_keys(token: str) -> list[str]:
    """Keys of a typed token: one is shared with every word within the edits allowed.

    A long one is split at its middle and one further: no transposition crosses
    both places, so of three edits one half at one of them has at most one.
    """
    n = len(token)
    keys = left_out(token, min(2, allowed(n))) if n < LONG + 2 else set()
    if n >= LONG:
        keys |= _halves(token, (n // 2, n // 2 + 1), (n - n // 2, n - n // 2 - 1))
    return sorted(keys)


def known_keys(word: str) -> list[str]:
    """Keys of a vocabulary word, of which there are fewer: the halves of every token it may be typed as."""
    n = len(word)
    keys = left_out(word, min(2, allowed(n))) if n < LONG + 2 else set()
    if n >= LONG:
        lengths = range((n - 3) // 2 - 2, (n + 3) // 2 + 3)
        keys |= _halves(word, lengths, lengths)
    return sorted(keys)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _known_keys(tokens: pd.Series) -> pd.Series:
    return tokens.map(known_keys)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _asked_keys(tokens: pd.Series) -> pd.Series:
    return tokens.map(asked_keys)


def _edits(length: Column) -> Column:
    """``allowed`` as an expression."""
    return F.when(length < 3, 0).when(length < 6, 1).when(length < LONG, 2).otherwise(3)


@F.pandas_udf(T.DoubleType())
def _alike(a: pd.Series, b: pd.Series, plain: pd.Series) -> pd.Series:
    """Likeness by edit distance; ``plain`` is the distance without transpositions."""

    def one(x: str, y: str, d: int) -> float:
        most = allowed(min(len(x), len(y)))
        if d > 1 and (swaps := sum(x[i + 1] + x[i] in y for i in range(len(x) - 1))):
            # each transposition saves one edit at most
            d = osa(x, y, most) if d - swaps <= most else most + 1
        return 1 - d / (max(len(x), len(y)) + 1) if d <= most else 0.0

    return pd.Series([one(x, y, d) for x, y, d in zip(a, b, plain, strict=True)], dtype="float64")


def forms(lists: list[tuple[str, DataFrame]]) -> DataFrame:
    """(kind, entry_key, form_rank, form, squash, is_name, words, numbers) of every surface form of the entries.

    Each list is (kind, frame with entry_key, form, form_rank).
    """
    every = reduce(DataFrame.unionByName, [df.select(F.lit(kind).alias("kind"), "entry_key", "form", "form_rank") for kind, df in lists])
    return every.where("form IS NOT NULL").withColumn("r", _read("form")).select("kind", "entry_key", "form_rank", "form", "r.squash", "r.is_name", "r.words", "r.numbers")


def map_values(values: DataFrame, surface: DataFrame, least: float = 0.72) -> DataFrame:
    """(kind, value, entry_key, score) of each distinct value of (kind, value); unmapped ones are left out."""
    distinct = values.where("value IS NOT NULL").select("kind", "value").distinct()
    readings = materialize(distinct.withColumn("r", _read("value")).select("kind", "value", "r.*").where("squash IS NOT NULL"))
    listed = surface.groupBy("kind", "squash").agg(F.min(F.struct("form_rank", "entry_key")).alias("hit"))
    by_code = listed.select("kind", F.col("squash").alias("code"), F.col("hit").alias("hit2"))
    exact = readings.join(listed, ["kind", "squash"], "left").join(by_code, ["kind", "code"], "left")
    exact = exact.withColumn("entry_key", F.coalesce("hit.entry_key", "hit2.entry_key")).drop("hit", "hit2")
    done = exact.where("entry_key IS NOT NULL").select("kind", "value", "entry_key", F.lit(1.0).alias("score"))
    rest = exact.where("entry_key IS NULL").select("kind", "is_name", "value", "words", "numbers")
    return done.unionByName(_rank(rest, surface, least))


def _rank(rest: DataFrame, surface: DataFrame, least: float) -> DataFrame:
    # vocabulary with document frequencies; a form is known by its key, rank and text
    form = surface.select("kind", "is_name", "entry_key", "form_rank", "numbers", F.xxhash64("kind", "entry_key", "form").alias("form_id"), F.array_distinct("words").alias("words"))
    posting = materialize(form.select("kind", "is_name", "entry_key", "form_rank", "numbers", "form_id", F.explode("words").alias("known")))
    # rarity is that of a word among names, whatever their number: a family of types is one name
    per = posting.where("is_name").join(form.select("form_id", F.concat_ws(" ", F.array_sort("words")).alias("name")), "form_id")
    df = per.groupBy("kind", "known").agg(F.count_distinct("name").alias("df"))
    names = materialize(per.groupBy("kind").agg(F.count_distinct("name").alias("names")))
    idf = df.join(names, "kind").select("kind", F.lit(True).alias("is_name"), "known", F.log(1 + F.col("names") / F.col("df")).alias("w"))
    # the parts of a code weigh alike
    codes = posting.where("NOT is_name").select("kind", "is_name", "known", F.lit(1.0).alias("w")).distinct()
    words = materialize(idf.unionByName(codes))
    asked = materialize(rest.select("kind", "is_name", "value", "numbers", F.explode(F.array_distinct("words")).alias("token")))
    tokens = asked.select("kind", "is_name", "token").distinct().select("kind", "is_name", "token", F.explode(_asked_keys("token")).alias("key"))
    known = words.select("kind", "is_name", "known", "w", F.explode(_known_keys("known")).alias("key"))
    pairs = tokens.join(known, ["kind", "is_name", "key"]).select("kind", "is_name", "token", "known", "w").distinct()
    # a transposition is two plain edits: most pairs are dropped before the exact distance
    most = _edits(F.least(F.length("token"), F.length("known")))
    pairs = pairs.where(F.abs(F.length("token") - F.length("known")) <= most).withColumn("plain", F.levenshtein("token", "known")).where(F.col("plain") <= 2 * most)
    pairs = materialize(pairs.withColumn("sim", _alike("token", "known", "plain")).drop("plain").where("sim > 0"))
    best = pairs.groupBy("kind", "is_name", "token").agg(F.max_by("w", F.struct("sim", "w")).alias("w_q"))
    w_new = names.select("kind", F.log(1 + F.col("names")).alias("w_new"))
    weighed = asked.join(best, ["kind", "is_name", "token"], "left").join(w_new, "kind", "left").withColumn("w_q", F.coalesce("w_q", F.when(F.col("is_name"), F.col("w_new")), F.lit(1.0))).drop("w_new")
    weighed = materialize(weighed)
    norm_q = weighed.groupBy("kind", "value").agg(F.sqrt(F.sum(F.col("w_q") * F.col("w_q"))).alias("norm_q"))
    weights = posting.join(words, ["kind", "is_name", "known"])
    norm_f = weights.groupBy("form_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm_f"), F.max("w").alias("top"))
    # the rarest words of a form are what names it: all of them must be there
    naming = materialize(weights.join(norm_f.select("form_id", "top"), "form_id").where(F.col("w") >= F.col("top") - 1e-9).select("kind", "is_name", "form_id", "entry_key", "form_rank", "numbers", "known"))
    norm_f = norm_f.join(naming.groupBy("form_id").agg(F.count("*").alias("naming")), "form_id")
    # values meet entries through naming words only, which are rare, never through words that many entries share
    met = weighed.join(pairs.select("kind", "is_name", "token", "known"), ["kind", "is_name", "token"]).join(naming, ["kind", "is_name", "known", "numbers"])
    met = met.groupBy("kind", "is_name", "value", "form_id", "entry_key", "form_rank").agg(F.count_distinct("known").alias("named")).join(norm_f, "form_id").where("named = naming")
    hits = met.join(weighed.select("kind", "is_name", "value", "token", "w_q"), ["kind", "is_name", "value"]).join(pairs.select("kind", "is_name", "token", "known", "w", "sim"), ["kind", "is_name", "token"])
    hits = hits.join(posting.select("form_id", "known"), ["form_id", "known"]).join(naming.select("form_id", "known", F.lit(True).alias("names")), ["form_id", "known"], "left")
    # each token of the value counts once in a form, with its most similar word
    group = ["kind", "is_name", "value", "form_id", "entry_key", "form_rank", "norm_f", "naming"]
    per_token = hits.groupBy(*group, "token").agg(F.max(F.struct((F.col("sim") * F.col("w_q") * F.col("w")).alias("part"), F.when(F.col("names"), F.col("known")).alias("name"))).alias("h"))
    score = per_token.groupBy(*group).agg(F.sum("h.part").alias("dot"), F.count_distinct("h.name").alias("named"))
    score = score.join(norm_q, ["kind", "value"]).withColumn("score", F.least(F.lit(1.0), F.col("dot") / (F.col("norm_q") * F.col("norm_f"))))
    enough = F.col("score") >= F.when(F.col("is_name"), least).otherwise(LEAST_CODE)
    top = score.where(enough & (F.col("named") == F.col("naming"))).groupBy("kind", "value").agg(F.min(F.struct((-F.col("score")).alias("neg"), "form_rank", "entry_key")).alias("m"))
    return top.select("kind", "value", F.col("m.entry_key").alias("entry_key"), (-F.col("m.neg")).alias("score"))


def map_rows(rows: DataFrame, mapped: DataFrame) -> DataFrame:
    """(row_id, entry_key, score) of rows (row_id, kind, value, place): the first place that is mapped, or NONE."""
    hit = rows.join(mapped, ["kind", "value"], "left")
    first = F.min(F.when(F.col("entry_key").isNotNull(), F.struct("place", "entry_key", "score")))
    return hit.groupBy("row_id").agg(first.alias("m")).select("row_id", F.coalesce("m.entry_key", F.lit(NONE)).alias("entry_key"), F.col("m.score").alias("score"))
