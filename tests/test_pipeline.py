import pytest
from pyspark.sql import functions as F

from medloom.functions.ladders import first_reason, first_reason_sql, matches, rule, stepped
from medloom.operators import expressions as E
from medloom.operators import recovery as R


def test_ladder_order_and_nulls(spark):
    rules = [rule("empty", "t IS NULL OR t = ''"), matches("t", "^[0-9]+$", "number"), rule("long", "length(t) > 3")]
    df = spark.createDataFrame([(None,), ("",), ("12345",), ("abcd",), ("ab",)], "t string")
    assert [r[0] for r in df.select(first_reason(rules)).collect()] == ["empty", "empty", "number", "long", "keep"]
    assert first_reason_sql(rules).startswith("CASE WHEN t IS NULL") and "regexp_matches(t, '^[0-9]+$')" in first_reason_sql(rules)
    assert df.limit(0).select(first_reason([], "x")).count() == 0


def test_steps_are_bounded_one_by_one(spark):
    steps = [(F.lit(True), 0.5, 0.0, 0.9), (F.lit(False), -1.0, 0.0, 1.0), (F.lit(True), -0.2, 0.8, 1.0)]
    assert spark.range(1).select(stepped(F.lit(0.6), steps)).first()[0] == 0.8


def test_expressions(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (2, None, 7.0), (3, "o'b", None)], "id int, s string, x double")
    tree = ("OR", ("AND", ("s", "=", "a"), ("x", ">", 1)), ("NOT", ("x", "<", 100)), ("s", "like", "o'%"))
    got = [r[0] for r in df.select(E.to_column(tree)).collect()]
    assert got == [True, False, True]
    assert [r[0] for r in df.selectExpr(E.to_sql(tree)).collect()] == got
    assert df.where(E.to_column(("AND",))).count() == 3 and df.where(E.to_sql(("OR",))).count() == 0
    with pytest.raises(ValueError):
        E.to_column(("s", "~", "a"))


def test_recovered(spark):
    terms = spark.createDataFrame([("T1", "drug", "Aspir", ["ASA x", None]), ("T2", "drug", "B", None)], "term_id string, kind string, preferred_label string, synonyms array<string>")
    forms = R.term_forms(terms)
    m = spark.createDataFrame([("d", "a", "aspir"), ("d", "a", "asa x"), ("d", "g", "b"), ("e", None, "b"), (None, "a", "aspir"), ("d", "x", None)], "doc_id string, short string, form string")
    seen = spark.createDataFrame([("d", "T9")], "doc_id string, term_id string")
    guards = spark.createDataFrame([("g",), ("g",)], "name string")
    got = {(r.doc_id, r.term_id): r.mentions for r in R.recovered(m, forms, seen, guards).collect()}
    assert got == {("d", "T1"): 2, ("e", "T2"): 1, (None, "T1"): 1}
    assert R.recovered(m, forms, m.select("doc_id", F.lit("T1").alias("term_id")), None).where("term_id = 'T1' AND doc_id IS NOT NULL").count() == 0
    assert R.recovered(m.limit(0), forms, seen).count() == 0


def test_linked(spark):
    reg = spark.createDataFrame([("T1", "familial lymnatrin edema"), ("T2", "lymnatrin syndrome"), ("T3", "other disease")], "term_id string, label string")
    v = spark.createDataFrame([("Familial lymnatrin EDEMA",), ("the lymnatrin syndrome, twice",), ("lymnatrin",), ("zz",), (None,), ("lymnatrin",)], "value string")
    got = {r.value: (r.term_id, r.rule) for r in R.linked(v, reg).collect()}
    assert got == {"Familial lymnatrin EDEMA": ("T1", 1), "the lymnatrin syndrome, twice": ("T2", 2), "lymnatrin": ("T1", 2)}


def test_comparison_in_passes(spark):
    s = spark.createDataFrame([("d", "a"), ("d", "a"), ("d", "b1"), ("d", "x"), ("e", None), ("f", "q")], "doc_id string, name string")
    g = spark.createDataFrame([("d", "a"), ("d", "b2"), ("d", "y")], "doc_id string, name string")
    al = spark.createDataFrame([("b1", "B"), ("b2", "B"), ("b2", "C")], "name string, entry string")
    got = {r.doc_id: (r.tp_exact, r.tp_alias, r.fp, r.fn) for r in R.compared_in_passes(s, g, al).collect()}
    assert got == {"d": (1, 1, 1, 1), "f": (0, 0, 1, 0)}
    assert R.compared_in_passes(s.limit(0), g.limit(0), al).count() == 0
