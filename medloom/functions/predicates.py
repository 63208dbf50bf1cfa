"""Predicates over texts and candidates as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words the rules look for.
NEGATIONS = ["no", "not", "without", "never", "denied", "absence"]
HYPOTHETICAL = ["possible", "suspected", "probable", "may", "might"]
FAMILY = ["sibling", "siblings", "mother", "father", "family", "families"]
STOP_STARTS = ["the", "a", "an", "and", "or", "of", "in"]
INSTITUTIONS = ["university", "hospital", "institute", "department", "center", "centre"]


def looks_like_short_form(x: Column, least: int = 2, most: int = 10) -> Column:
    """2 to 10 characters, an upper-case letter, not all digits, one token (or three)."""
    return (F.length(x).between(least, most)) & x.rlike("[A-Z]") & ~x.rlike("^[0-9]+$") & x.rlike(r"^[A-Za-z0-9-]+(?: [A-Za-z0-9-]+){0,2}$")


def looks_like_measurement(x: Column) -> Column:
    """Ends in a number with a unit, or holds at least as many digits as letters."""
    digits, letters = F.length(F.regexp_replace(x, "[^0-9]", "")), F.length(F.regexp_replace(x, "[^A-Za-z]", ""))
    return x.rlike(r"[0-9] ?(?:mg|g|kg|mL|L|weeks|days|months|years|%)$") | ((digits >= letters) & (digits > 0))


def is_subsequence(short: Column, long: Column) -> Column:
    """First letters agree and the letters of ``short`` come in order in ``long``, whatever the case."""
    a, b = F.lower(short), F.lower(long)
    # the place after the last letter found, or -1 once one is missing
    end = F.aggregate(F.filter(F.split(a, ""), lambda c: c != ""), F.lit(0), lambda at, c: _next(at, c, b))
    return (F.substring(a, 1, 1) == F.substring(b, 1, 1)) & (end > 0)


def _next(at: Column, c: Column, text: Column) -> Column:
    rest = F.substring(text, at + 1, F.length(text))
    found = F.instr(rest, c)
    return F.when(at < 0, F.lit(-1)).when(found > 0, at + found).otherwise(F.lit(-1))


def initials(x: Column) -> Column:
    return F.array_join(F.transform(F.filter(F.split(F.trim(x), r"[ -]+"), lambda w: w != ""), lambda w: F.upper(F.substring(w, 1, 1))), "")


def numeric_evidence(context: Column) -> Column:
    return context.rlike(r"[0-9%=]")


def near(text: Column, start: Column, pattern: str, before: int = 100, after: int = 50) -> Column:
    """Whether an anchor stands within the given reach of a place."""
    lo = F.greatest(start - before, F.lit(0))
    return F.substring(text, lo + 1, (start - lo + after).cast("int")).rlike(pattern)


def identifier_kind(x: Column) -> Column:
    """Kind of a valid identifier, else null."""
    return (
        F.when(x.rlike(r"^NCT[0-9]{8}$"), "NCT").when(x.rlike(r"^PMC[0-9]{5,8}$"), "PMCID").when(x.rlike(r"^[1-9][0-9]{5,8}$"), "PMID").when(x.rlike(r"^10\.[0-9]{4,9}/[^ ]+$"), "DOI").when(x.rlike(r"^https?://[A-Za-z0-9.-]+\.[a-z]{2,}(?:/.*)?$"), "URL")
    )


def person_name(x: Column) -> Column:
    """Two to five capitalised words, 5 to 60 characters, none of an institution."""
    words = F.split(F.trim(x), r"\s+")
    return F.length(x).between(5, 60) & F.size(words).between(2, 5) & F.forall(words, lambda w: w.rlike(r"^[A-Z][A-Za-z.'-]*$")) & ~F.arrays_overlap(F.transform(words, F.lower), F.array(*map(F.lit, INSTITUTIONS)))


def any_word(context: Column, words: list[str]) -> Column:
    return F.lower(context).rlike(r"(?:^|[^a-z])(?:" + "|".join(words) + r")(?:[^a-z]|$)")


#: A denied family history is a negation.
NO_FAMILY = "(?:^|[^a-z])(?:no|without|denied) (?:known )?family history"
#: A clause ends the reach of the words before it: what follows its last end.
SCOPE = r"([^.;:]*)$"


def assertion(before: Column) -> Column:
    """Class of a mention by the text before it in its clause: family, possible, negated or present."""
    before = F.regexp_extract(F.lower(before), SCOPE, 1)
    return F.when(before.rlike(NO_FAMILY), "negated").when(any_word(before, FAMILY), "family").when(any_word(before, HYPOTHETICAL), "possible").when(any_word(before, NEGATIONS), "negated").otherwise("present")


def section_of(header: Column) -> Column:
    """Section a header opens, else null."""
    key = F.lower(F.regexp_replace(header, r"^[0-9.]+ *|[: ]+$", ""))
    return (
        F.when(key.rlike("^(abstract|summary)$"), "abstract").when(key.rlike("^(background|introduction)$"), "introduction").when(key.rlike("^(methods?|materials and methods)$"), "methods")
        .when(key.rlike("^(results?|findings)$"), "results").when(key.rlike("^(discussion|conclusions?)$"), "discussion").when(key.rlike("^eligibility"), "eligibility").when(key.rlike("^(references|bibliography)$"), "references")
    )


def is_header(line: Column) -> Column:
    """All capitals, ending in a colon, numbered, or at most five capitalised words without a stop."""
    t = F.trim(line)
    return (F.length(t).between(3, 60)) & ~t.rlike("[.;,]$") & (t.rlike("^[A-Z0-9 &-]{3,}$") | t.rlike("^[A-Z][^.]*:$") | t.rlike(r"^[0-9]+\.? [A-Z][a-z]+$") | t.rlike(r"^(?:[A-Z][a-z]+)(?: [A-Z][a-z]+){0,4}$"))


def garbled(x: Column) -> Column:
    """Less than half of the visible characters are letters, in texts of ten or more."""
    seen, letters = F.length(F.regexp_replace(x, r"\s", "")), F.length(F.regexp_replace(x, r"[^A-Za-z]", ""))
    return (seen >= 10) & (letters * 2 < seen)
