from pyspark.sql import functions as F

from medloom.functions import extract as E
from medloom.functions import predicates as P
from medloom.functions import scores as S
from medloom.functions import text as X


def value(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_text_rules(spark):
    t = lambda f, x: value(spark, f(F.lit(x)))
    assert t(X.clean_whitespace, " a \t b c ") == "a b c"
    assert t(X.balance_brackets, "f(x))") == "f(x)"
    assert t(X.plural, "biopsy") == "biopsies" and t(X.plural, "ABCDE") is None
    assert t(X.per_million, "1 in 2,000") == 500.0 and t(X.per_million, "2%") == 20000.0 and t(X.per_million, "none") is None
    assert t(X.grade, "IV") == 4 and t(X.grade, "3") == 3 and t(X.grade, "x") is None
    assert t(X.hgvs, "C.123a>g") == "c.123A>G"
    assert t(X.repair_doi, "10.1000/ abc") == "10.1000/abc"
    assert t(X.short_form, "ｆｖｃ – x") == "FVC - X"
    for f in (X.clean_whitespace, X.dedup_key, X.mask_digits, X.term_key, X.short_form, X.balance_brackets):
        assert value(spark, f(F.lit(None).cast("string"))) is None and value(spark, f(F.lit(""))) == ""


def test_predicates(spark):
    t = lambda f, *x: value(spark, f(*map(F.lit, x)))
    assert t(P.looks_like_short_form, "TNF") and not t(P.looks_like_short_form, "123")
    assert t(P.is_subsequence, "TNF", "tumor necrosis factor") and not t(P.is_subsequence, "TNZ", "tumor necrosis factor")
    assert t(P.identifier_kind, "NCT01234567") == "NCT" and t(P.identifier_kind, "x") is None
    assert t(P.person_name, "Jane Doe") and not t(P.person_name, "Harvard University")
    assert t(P.assertion, "there was no ") == "negated" and t(P.assertion, "diagnosis of ") == "present"


def test_scores(spark):
    assert value(spark, S.clamp(F.lit(2.0))) == 0.95
    assert value(spark, S.safe_ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, S.overlap_of_shorter(F.lit(0), F.lit(10), F.lit(5), F.lit(15))) == 0.5
    assert value(spark, S.verified_penalty(F.lit(False), F.lit(1))) == 0.35


def test_definitions_and_alignment(spark):
    df = spark.createDataFrame([("the Tumor Necrosis Factor (TNF) and BMI: body mass index",), (None,), ("",)], "t string")
    got = {(r.x.style, r.x.short_form) for r in df.select(F.explode(E.definitions(F.col("t"))).alias("x")).collect()}
    assert got == {("parenthetical", "TNF"), ("equals", "BMI")}
    a = spark.createDataFrame([("TNF", "the tumor necrosis factor"), ("XYZ", "nothing here"), (None, "a")], "s string, b string")
    assert [r.v for r in a.select(E.aligned_long_form("s", "b").alias("v")).collect()] == ["tumor necrosis factor", None, None]


def test_quote_windows_against_all_windows(spark):
    import random
    from difflib import SequenceMatcher

    rng = random.Random(4)
    text = "the patient had recurrent muscle wasting and autoimmune neuropathy of type 3, " + "".join(rng.choice("abcde ") for _ in range(300))
    quotes = ["muscle wasting", "muscle wastong and", "autoimmun neuropathy", "had reccurrent muscle", "entirely other words", "short", "", "autoimune neuropathi"]
    for _ in range(25):
        i, n = rng.randrange(300), rng.randrange(10, 50)
        q = list(text[i : i + n])
        for _ in range(rng.randrange(5)):
            q[rng.randrange(len(q))] = rng.choice(["", "x", "ab"])
        quotes.append("".join(q))

    def best(q):
        if not q or q in text:
            return 1.0 if q else None
        sizes = [w for w in (len(q), int(len(q) * 0.9), int(len(q) * 1.1)) if w >= 10 and len(q) >= 10]
        r = max((SequenceMatcher(None, q, text[i : i + w]).ratio() for w in sizes for i in range(len(text) - w + 1)), default=0)
        return r if r >= 0.9 else None

    got = spark.createDataFrame([(text, quotes)], "t string, q array<string>").select(E.quote_ratios("t", "q").alias("r")).first().r
    assert got == [best(q) for q in quotes] and got[1] is not None and got[4] is None


def test_reference_keys(spark):
    k = lambda x: value(spark, E.reference_keys(F.lit(x)))
    assert k("See Tables 2-4, Fig. 1 and (Exhibit 7).") == ["table:2", "table:3", "table:4", "figure:1", "exhibit:7"]
    assert k("figures 3–5 and Figure 2.1, Table 9-3, tablet 4") == ["figure:3", "figure:4", "figure:5", "figure:2", "table:9", "table:3"]
    assert k("Table 2-20190101") == ["table:2", "table:20190101"] and k("none") == [] and k(None) is None
