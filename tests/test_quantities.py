import pytest
from pyspark.sql import functions as F

from medloom.operators.quantities import array_quantities, read_drug, read_population, value_quantities

DRUG = {
    "5 mg": (5000, "ug"), "0,25litre": (250000, "uL"), "2,000 mg": (2000000, "ug"), "1 250 mg": (1250000, "ug"), ".5 g": (500000, "ug"), "200 mcg/2 mL": (100, "ug/mL"), "0.9 % w/v": (9000, "ug/mL"),
    "5 mg kg-1": (5000, "ug/kg"), "2 mg/kg body weight": (2000, "ug/kg"), "4 x 10^5 IU": (400000, "IU"), "1.5 million IU": (1500000, "IU"), "500 I.U.": (500, "IU"), "five hundred µg": (500, "ug"), "1e6 ng": (1000, "ug"), "about 5 mg.": (5000, "ug"),
}
POPULATION = {"1 in 5,000": (200000, "per_billion"), "one in 2 500": (400000, "per_billion"), "0.5 %": (5000000, "per_billion"), "3/10⁵": (30000, "per_billion"), "2 per million": (2000, "per_billion"), "~4.5-year": (54, "month"), "six mos.": (6, "month"), "0.4‰": (400000, "per_billion"), "7 p.m. (per million)": (7000, "per_billion"), "1:80 000": (12500, "per_billion")}
NONE = ["5 to 10 mg", "20 or 40 mg", "up to 5 drops", "two tablets", "half a sachet", "", " ", None, "not stated", "5", "between 2 and 4 years", "<1 to 3 per million", "1–9 / 100 000", "several hundred cases", "10 mg/0 mL"]


@pytest.mark.parametrize("text", DRUG)
def test_drug_amounts(text):
    got = read_drug(text, None, None, None)
    assert (got["common_amount"], got["common_unit"]) == DRUG[text]


@pytest.mark.parametrize("text", POPULATION)
def test_population_amounts(text):
    got = read_population(text, None)
    assert (got["common_amount"], got["common_unit"]) == POPULATION[text]


@pytest.mark.parametrize("text", NONE)
def test_no_amount(text):
    assert read_drug(text, None, None, None) is None and read_population(text, None) is None


def test_comma_is_decided_by_the_strength_beside_it():
    got = read_drug("1,125 mg", "1,125 mg daily", "strength 1.125 mg) ", "(strength 1.125 mg) 1,125 mg daily")
    assert got["common_amount"] == 1125 and got["is_unique"]
    assert read_drug("1,125 mg", "1,125 mg daily", "", "1,125 mg daily")["common_amount"] == 1125000


def test_unit_from_context_and_nulls(spark):
    rows = [(1, "took 50 mg/kg daily", [("50", 5), None, ("9", 17)]), (2, None, [("5 mg", None)]), (3, "up to 5 mg", [("5", 6)]), (4, "x", None), (5, "5 to 10 mg", [("5", 0)])]
    df = spark.createDataFrame(rows, "id bigint, src string, d array<struct<text:string,start_pos:int>>")
    got = sorted(tuple(r)[:5] for r in array_quantities(df, "id", ["d"], "src").collect())
    assert got == [(1, "d", 0, 50000, "ug/kg"), (2, "d", 0, 5000, "ug")]
    assert array_quantities(df.limit(0), "id", ["d"], "src").count() == 0


def test_value_from_text(spark):
    df = spark.createDataFrame([(1, "2,5", "type 2 was 2,5 per 100,000 in X."), (2, None, "x"), (3, "7", None)], "id bigint, v string, t string")
    assert [tuple(r)[:5] for r in value_quantities(df, "id", F.col("v"), "t", "v").collect()] == [(1, "v", 0, 25000, "per_billion")]


def test_mass_is_concentration_times_volume():
    # 1,126 mg are 1.126 g or 1.126 mg; 2 mL of 0.563 mg/mL make 1.126 mg
    alone = read_drug("1,126 mg", None, None, None)
    assert alone["common_amount"] == 1126000 and not alone["is_unique"]
    tied = read_drug("1,126 mg", None, None, None, ["0.563 mg/mL", "2 mL"])
    assert tied["common_amount"] == 1126 and tied["is_unique"] and tied["log_residual"] < alone["log_residual"] + 3


def test_other_columns_of_the_record_decide(spark):
    ent = "array<struct<text:string,start_pos:int>>"
    rows = [(1, "x", [("1,125 mg", 0)], [("1.125 mg", 300), ("7 mg", 900)]), (2, "x", [("1,125 mg", 0)], None)]
    df = spark.createDataFrame(rows, f"id bigint, src string, d {ent}, s {ent}")
    got = {r.row_id: (r.common_amount, r.is_unique) for r in array_quantities(df, "id", ["d", "s"], "src").where("field_name = 'd'").collect()}
    assert got == {1: (1125, True), 2: (1125000, False)}
