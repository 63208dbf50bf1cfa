"""Quantities written in different units and scales, converted to common units.

Every text is read into candidate readings (number reading x unit reading).
Where a text has only a number, its unit is taken from the surrounding text at
the same place.  A comma before three digits may separate thousands or
decimals; such readings are decided together over the physical identities that
tie the columns of a record: the dose equals a small multiple of the strength
it is given in, and a dose of mass equals concentration times volume.  The
combination with the least log residual plus the cost of an unusual spelling
wins; ``is_unique`` is false where another one is as good, or where no partner
tests them.

Slices of the context are cut by built-in expressions; the grammar itself runs
in an Arrow UDF, as its alternatives nest too deeply for one generated
expression.  It is one narrow pass; nothing is shuffled.

Defined results: null, empty and blank texts, ranges, alternatives, upper
limits and wording without an amount give no row; null elements count in
``item_pos``; readings that aren't whole in the common unit are dropped.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unit spellings (lower case) and their size in the common unit.
MASS = {"kg": 1e9, "kilograms": 1e9, "kilogram": 1e9, "grams": 1e6, "gram": 1e6, "gms": 1e6, "gm": 1e6, "g": 1e6, "milligrams": 1e3, "milligram": 1e3, "mgs": 1e3, "mg": 1e3, "micrograms": 1.0, "microgram": 1.0, "mcg": 1.0, "ug": 1.0, "nanograms": 1e-3, "nanogram": 1e-3, "ng": 1e-3}
VOLUME = {"millilitres": 1e3, "millilitre": 1e3, "milliliters": 1e3, "milliliter": 1e3, "ml": 1e3, "cc": 1e3, "centilitres": 1e4, "centilitre": 1e4, "centiliters": 1e4, "cl": 1e4, "decilitres": 1e5, "decilitre": 1e5, "deciliters": 1e5, "dl": 1e5, "microlitres": 1.0, "microlitre": 1.0, "microliters": 1.0, "ul": 1.0, "litres": 1e6, "litre": 1e6, "liters": 1e6, "liter": 1e6, "l": 1e6}
INTERNATIONAL = {"kiu": 1e3, "miu": 1e6, "i.u": 1.0, "international units": 1.0, "international unit": 1.0, "iu": 1.0}
SCALE = {"hundred": 1e2, "thousand": 1e3, "million": 1e6, "billion": 1e9}
WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()

NUM = r"(?:[1-9]\d{0,2}(?:[ ,]\d{3})+(?!\d)(?:\.\d+)?|\d*[.,]\d+|\d+)"
SCI = r"(?: ?x ?10\^\d+|e\d+)?"
DEN = r"(?:10\^\d+|" + NUM + r")"


def _any(names) -> str:
    return "(?:" + "|".join(sorted((n.replace(".", r"\.") for n in names), key=len, reverse=True)) + ")"


_M, _V, _I = _any(MASS) + r"\.?", _any(VOLUME), _any(INTERNATIONAL) + r"\.?"
PER_KG = rf"{_M} ?(?:(?:/|per) ?kg(?: ?(?:body ?weight|bw))?|kg-1)"
PER_VOLUME = rf"{_M} ?(?:/|per|in) ?(?:{NUM} ?)?{_V}"
PERCENT_WV = r"% ?\(?w/v\)?"
IU = rf"(?:(?:thousand|million|billion) ?)?{_I}"
DRUG = rf"(?:{PER_KG}|{PER_VOLUME}|{PERCENT_WV}|{IU}|{_M}|{_V})"
PEOPLE = r"(?: (?:inhabitants|persons|people|births|live births|population))?"
SHARE = rf"(?:(?: ?cases)? ?(?:/|:|per|in) ?(?:million|billion|thousand|hundred|mille|{DEN}){PEOPLE}| ?p\.m\. \(per million\)| ?per ?cent| ?percent| ?%| ?‰)"
AGE = r"(?: ?-? ?(?:year\(s\)|years|year|yrs|yr|y|month\(s\)|months|month|mos\.|mos|mo))"
EPI = rf"(?:{SHARE}|{AGE})"


_CHARS = str.maketrans({" ": " ", " ": " ", " ": " ", " ": " ", "　": " ", "µ": "u", "μ": "u", "×": "x", "⁻": "-", "−": "-"})
_RAISED = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹", "0123456789")
_FULL = {k: re.compile(f"(?:{v})") for k, v in {"kg": PER_KG, "wv": PERCENT_WV, "conc": PER_VOLUME, "iu": IU, "mass": _M, "vol": _V, "age": AGE, "share": SHARE}.items()}
_STATEMENT = re.compile(rf"({NUM})({SCI}) ?(.*)", re.S)
_AHEAD = re.compile(rf"({NUM}{SCI} ?{DRUG})(?![a-z0-9^])(?! ?(?:to|or|–|-) ?\d)")
_BARE = re.compile(rf"{NUM}{SCI}")
_LIMIT = re.compile(r"(?:up to|at most|maximum|max\.?|less than|between|<|≤|\d ?(?:to|or|–|-)) ?$")
_EPI = re.compile(rf"(?<![\d.,^<–])({NUM}{SCI}{EPI})(?![a-z0-9^])(?! ?(?:to|or|–) ?\d)")
_DRUGS = re.compile(rf"(?<![\d.,])({NUM}{SCI} ?{DRUG})(?![a-z0-9^])")
_SIZES = {w: i for i, w in enumerate(WORDS, 1)} | {w: 10 * i for i, w in enumerate(TENS, 2)}
_WORD = re.compile(rf"\b(?:{'|'.join(_SIZES)})(?:(?: and)?[ -](?:{'|'.join(_SIZES)}|hundred|thousand|million))*\b")


def _number_words(m: re.Match) -> str:
    total = part = 0
    for w in re.split(r"(?: and)?[ -]", m[0]):
        if w in _SIZES:
            part += _SIZES[w]
        elif w == "hundred":
            part *= 100
        else:
            total, part = total + part * int(SCALE[w]), 0
    return str(total + part)


_MULTIPLES = (0.25, 0.5, 1.0, 2.0, 3.0, 4.0)


def tidy(text: str | None) -> str:
    """One writing of the characters and number words of an amount."""
    t = (text or "").translate(_CHARS).lower()
    t = re.sub("-?[⁰¹²³⁴⁵⁶⁷⁸⁹]+", lambda m: (m[0] if m[0][0] == "-" else "^" + m[0]).translate(_RAISED), t)
    return _WORD.sub(_number_words, t)


def amount_text(text: str | None) -> str:
    """``tidy`` without words of approximation and a closing full stop."""
    t = re.sub(r"^\s*(?:approximately|approx\.?|about|around|circa|ca\.?|roughly|≈|~)\s*", "", tidy(text))
    return re.sub(r"\s*\((?:estimated|approximately)\)|(?<=[a-z0-9)%‰])\.+\s*$", "", t).strip()


def _value(num: str, decimal_comma: bool) -> float | None:
    if decimal_comma:
        return float(num.replace(",", ".")) if re.fullmatch(r"[1-9]\d{0,2},\d{3}", num) else None
    if re.fullmatch(r"[1-9]\d{0,2}(?:[ ,]\d{3})+(?:\.\d+)?", num):
        return float(re.sub("[ ,]", "", num))
    return float(num.replace(" ", "").replace(",", "."))


def _find(sizes: dict[str, float], name: str) -> float:
    return sizes[name] if name in sizes else sizes[name.rstrip(".")]


@lru_cache(100_000)
def readings(statement: str) -> tuple[tuple[float, int, str], ...]:
    """Candidate readings of ``number unit``: (penalty, amount, unit)."""
    m = _STATEMENT.fullmatch(statement)
    if not m:
        return ()
    num, sci, u = m.groups()
    is_ = lambda k: _FULL[k].fullmatch(u)
    power = 10.0 ** int(re.search(r"\d+$", sci)[0]) if sci else 1.0
    mass = lambda: MASS[re.match(_any(MASS), u)[0]]
    if is_("kg"):
        unit, size = "ug/kg", mass()
    elif is_("wv"):
        unit, size = "ug/mL", 1e4
    elif is_("conc"):
        d = re.search(rf"(?:/|per|in) ?(?:({NUM}) ?)?({_V})$", u)
        den = (_value(d[1], False) if d[1] else 1.0) * _find(VOLUME, d[2]) / 1e3
        if not den:
            return ()
        unit, size = "ug/mL", mass() / den
    elif is_("iu"):
        many = re.match("thousand|million|billion", u)
        unit, size = "IU", (SCALE[many[0]] if many else 1.0) * _find(INTERNATIONAL, re.search(f"{_I}$", u)[0])
    elif is_("mass"):
        unit, size = "ug", mass()
    elif is_("vol"):
        unit, size = "uL", _find(VOLUME, u)
    elif is_("age"):
        unit, size = "month", 12.0 if re.match(r" ?-? ?y", u) else 1.0
    elif is_("share"):
        named, out_of = re.search(r"(hundred|thousand|million|billion)\)?$", u), re.search(rf"(?:/|:|per|in) ?({DEN}){PEOPLE}$", u)
        if re.search(r"(?:%|per ?cent)$", u):
            size = 1e7
        elif re.search("(?:‰|mille)$", u):
            size = 1e6
        elif named:
            size = 1e9 / SCALE[named[1]]
        else:
            n = 10.0 ** int(out_of[1][3:]) if out_of[1].startswith("10^") else _value(out_of[1], False)
            if not n:
                return ()
            size = 1e9 / n
        unit = "per_billion"
    else:
        return ()
    out = []
    for decimal, penalty in ((False, 0.0), (True, 5.0 if num.endswith("0") else 2.0)):
        value = _value(num, decimal)
        if value is not None and math.isfinite(amount := value * power * size) and amount < 9e18:
            if abs(amount - round(amount)) <= 1e-6 * max(1.0, amount) and round(amount) > 0:
                out.append((penalty, round(amount), unit))
    return tuple(out)


#: Residual of a reading that no identity reaches, and the difference below which two readings are as good.
FAR, SAME = 3.0, 0.1


def residual(c: tuple, partners: list) -> float:
    """Least absolute log residual of a reading over the identities of a record.

    An amount is a small multiple of another of its kind; mass = concentration
    x volume, whichever of the three the reading is; a share or a time is the
    other statement of it.  ``partners`` are readings (penalty, amount, unit).
    """
    _, amount, unit = c
    out = [abs(math.log(amount / (n * p[1]))) + p[0] for p in partners if p[2] == unit for n in ((1.0,) if unit in ("per_billion", "month") else _MULTIPLES)]
    parts = {"ug": ("ug/mL", "uL"), "ug/mL": ("ug", "uL"), "uL": ("ug", "ug/mL")}.get(unit)
    if parts:
        for p in partners:
            for q in partners:
                if (p[2], q[2]) == parts:
                    # ug = ug/mL x uL / 1000
                    expected = p[1] * q[1] / 1e3 if unit == "ug" else 1e3 * p[1] / q[1]
                    out.append(abs(math.log(amount / expected)) + p[0] + q[0])
    return min([FAR, *out])


def pick(cands: tuple, partners: list) -> dict | None:
    """The reading with the least log residual against the partners' readings, plus its penalty.

    ``is_unique`` is false where several readings are whole and no identity
    tells them apart.
    """
    if not cands:
        return None
    tested = [(residual(c, partners) if len(cands) > 1 else 0.0, c) for c in cands]
    costs = sorted((c[0] + r, c[1], c[2]) for r, c in tested)
    told = len(cands) < 2 or (min(r for r, _ in tested) < FAR and costs[1][0] - costs[0][0] > SAME)
    return {"common_amount": costs[0][1], "common_unit": costs[0][2], "is_unique": told, "log_residual": costs[0][0]}


def read_drug(text: str | None, ahead: str | None, before: str | None, around: str | None, columns: list | None = None) -> dict | None:
    """The drug amount that ``text`` states.

    ``ahead`` is the context from its place on; its partners are the amounts
    of the record's other columns (``columns``) and those written ``around`` it.
    """
    t = amount_text(text)
    if _BARE.fullmatch(t):
        m = _AHEAD.match(tidy(ahead)) if ahead and ahead.startswith(text) and not _LIMIT.search(tidy(before)) else None
        if not m or t not in (_BARE.match(m[1])[0], re.match(NUM, m[1])[0]):
            return None
        t = m[1]
    cands = readings(t)
    others = []
    if len(cands) > 1:
        found = _DRUGS.findall(tidy(around))
        if t in found:  # the amount itself
            found.remove(t)
        found += [amount_text(x) for x in (columns if columns is not None else [])]
        others = [r for x in dict.fromkeys(found) for r in readings(x)]
    return pick(cands, others)


def read_population(value: str | None, context: str | None) -> dict | None:
    """The population share or time that ``value`` states, its unit looked up in ``context``; partners are the others stated there."""
    t = amount_text(value)
    found = None
    if _BARE.fullmatch(t):
        found = _EPI.findall(tidy(context))
        t = next((x for x in found if t in (_BARE.match(x)[0], re.match(NUM, x)[0])), "")
    cands = readings(t)
    others = []
    if len(cands) > 1:
        found = _EPI.findall(tidy(context)) if found is None else found
        others = [r for x in found if x.strip() != t.strip() for r in readings(x)]
    return pick(cands, others)


READ = T.StructType().add("common_amount", T.LongType()).add("common_unit", T.StringType()).add("is_unique", T.BooleanType()).add("log_residual", T.DoubleType())


@F.pandas_udf(READ)
def _read_drug(text: pd.Series, ahead: pd.Series, before: pd.Series, around: pd.Series, columns: pd.Series) -> pd.DataFrame:
    return _frame(map(read_drug, text, ahead, before, around, columns))


@F.pandas_udf(READ)
def _read_population(value: pd.Series, context: pd.Series) -> pd.DataFrame:
    return _frame(map(read_population, value, context))


def _frame(rows) -> pd.DataFrame:
    none = {"common_amount": None, "common_unit": None, "is_unique": None, "log_residual": None}
    out = pd.DataFrame([r or none for r in rows], columns=list(none))
    return out.astype({"common_amount": "Int64", "is_unique": "boolean", "log_residual": "float64"})


COLUMNS = ["row_id", "field_name", "item_pos", "common_amount", "common_unit", "is_unique", "log_residual"]


#: Characters that an amount may reach beyond its number: more than the longest unit of the grammar has.
LONGEST_UNIT = 60


def array_quantities(df: DataFrame, key: str, fields: list[str], context: str, partners: list[str] | None = None, near: int = 90) -> DataFrame:
    """Amounts of the elements of entity arrays (``text``, ``start_pos``).

    Columns: row_id, field_name, item_pos, common_amount, common_unit,
    is_unique, log_residual.  An element that has several readings is tied to
    the elements nearest to it in each of the record's other columns
    (``partners``; the fields themselves unless given) and to the amounts
    written within ``near`` characters of it.
    """
    partners = fields if partners is None else partners
    items = F.flatten(F.array(*[F.transform(F.coalesce(F.col(f), F.array()), _item(f)) for f in fields]))
    flat = df.select(F.col(key).alias("row_id"), F.col(context).alias("_context"), *[F.col(p).alias(f"_p_{p}") for p in partners], F.explode(items).alias("_e"))
    flat = flat.where(F.col("_e.text").isNotNull())
    several = F.col("_e.text").contains(",")
    nearest = [_nearest(F.col(f"_p_{p}"), F.col("_e.start_pos"), F.col("_e.field") != p) for p in partners]
    columns = F.when(several, F.filter(F.array(*nearest), lambda x: x.isNotNull())) if partners else F.lit(None).cast("array<string>")
    start, n = F.col("_e.start_pos"), F.length("_e.text")
    ahead = F.substring(F.col("_context"), start + 1, n + LONGEST_UNIT)
    before = F.substring(F.col("_context"), F.greatest(start - 14, F.lit(1)), F.least(F.lit(15), start))
    around = F.when(several, F.substring(F.col("_context"), F.greatest(start - near, F.lit(1)), F.lit(2 * near)))
    read = flat.select("row_id", F.col("_e.field").alias("field_name"), F.col("_e.pos").alias("item_pos"), _read_drug(F.col("_e.text"), ahead, before, around, columns).alias("_r"))
    return read.where(F.col("_r.common_amount").isNotNull()).select("row_id", "field_name", "item_pos", "_r.*")


def _nearest(array: Column, start: Column, other: Column) -> Column:
    """The text of the element that starts nearest to ``start``, of another column only."""
    away = F.transform(F.filter(F.coalesce(array, F.array()), lambda x: x["text"].isNotNull()), lambda x: F.struct(F.abs(F.coalesce(x["start_pos"], F.lit(1 << 30)) - F.coalesce(start, F.lit(0))).alias("d"), x["text"].alias("t")))
    return F.when(other, F.array_min(away)["t"])


def _item(field: str):
    return lambda x, i: F.struct(F.lit(field).alias("field"), i.cast("int").alias("pos"), x["text"].alias("text"), x["start_pos"].alias("start_pos"))


def value_quantities(df: DataFrame, key: str, value: Column, context: str, field: str) -> DataFrame:
    """Amounts of a scalar value; same columns as ``array_quantities``."""
    rows = df.select(F.col(key).alias("row_id"), value.alias("_v"), F.col(context).alias("_context")).where(F.col("_v").isNotNull())
    read = rows.select("row_id", F.lit(field).alias("field_name"), F.lit(0).alias("item_pos"), _read_population("_v", "_context").alias("_r"))
    return read.where(F.col("_r.common_amount").isNotNull()).select("row_id", "field_name", "item_pos", "_r.*")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
