import random

from medloom.llm import mapping as M


def test_osa_against_reference_cases():
    assert M.osa("abc", "abc", 3) == 0 and M.osa("abc", "acb", 3) == 1 and M.osa("abcd", "ab", 3) == 2 and M.osa("abc", "xyz", 2) == 3


def edited(rng, w, edits, letters):
    v = list(w)
    for _ in range(edits):
        i, op = rng.randrange(len(v)), rng.randrange(4)
        if op == 0:
            v[i] = rng.choice(letters)
        elif op == 1:
            del v[i]
        elif op == 2:
            v.insert(i, rng.choice(letters))
        elif i + 1 < len(v):
            v[i], v[i + 1] = v[i + 1], v[i]
    return "".join(v)


def test_words_within_the_edits_allowed_always_share_a_key():
    rng = random.Random(4)
    checked = 0
    for _ in range(4000):
        w = "".join(rng.choice("abcd") for _ in range(rng.randrange(6, 19)))
        v = edited(rng, w, 3, "abcd")
        most = M.allowed(min(len(w), len(v)))
        if M.osa(w, v, most) <= most:
            checked += len(w) >= 10
            assert set(M.known_keys(w)) & set(M.asked_keys(v)), (w, v)
    assert checked > 1000
    assert set(M.known_keys("hypertension")) & set(M.asked_keys("hxpertxnsixn"))


def run(spark, values):
    lex = spark.createDataFrame([("T1", "familial lymnatrinum edema type 4", 0), ("T2", "familial lymnatrinum edema type 6", 0), ("T3", "Lymnatrinum syndrome 4", 1), ("T4", "mild headache", 0), ("T5", "rixgenorstat", 0), ("T5", "MK-2483", 1)] + [(f"U{i}", f"familial {w} edema type 4", 0) for i, w in enumerate(["mulnexruard", "sessarpleen", "hoxvileamum", "skafaltraen"])], "entry_key string, form string, form_rank int")
    surface = M.forms([("term", lex)])
    v = spark.createDataFrame([("term", x) for x in values], "kind string, value string")
    return {r.value: r.entry_key for r in M.map_values(v, surface).collect()}


def test_mapping(spark):
    got = run(spark, ["familial lymnatrinum oedema type 4", "edema, familial lymnatrinum, type VI", "familial lymnatrinum edema type 5", "familial lymnatrinum edema", "midl headache", "rigxenorsat", "mk 2483", "MK-2484", "RIXGENORSTAT [confirmed]", "unknown", "n/a", "", " ", None, "familial qqqqqqqqq edema type 4"])
    assert got == {"familial lymnatrinum oedema type 4": "T1", "edema, familial lymnatrinum, type VI": "T2", "midl headache": "T4", "rigxenorsat": "T5", "mk 2483": "T5", "RIXGENORSTAT [confirmed]": "T5"}


def test_rows_without_entry_are_none(spark):
    rows = spark.createDataFrame([(1, "term", 0, None), (1, "term", 1, "mild headache"), (2, "term", 0, "zzz"), (3, "term", 0, None)], "row_id bigint, kind string, place int, value string")
    mapped = spark.createDataFrame([("term", "mild headache", "T4", 1.0)], "kind string, value string, entry_key string, score double")
    assert {r.row_id: r.entry_key for r in M.map_rows(rows, mapped).collect()} == {1: "T4", 2: "NONE", 3: "NONE"}


def test_typed_digits():
    assert M.read("GZVPll")["code"] == "gzvp11" and M.read("ZKXlO")["code"] == "zkx10" and M.read("kinase II")["numbers"] == "2"


def test_three_edits_and_codes(spark):
    assert run(spark, ["rixgxnxrstaz", "mk 2483", "mk 2484"]) == {"rixgxnxrstaz": "T5", "mk 2483": "T5"}
    lex = spark.createDataFrame([("G1", "ABQX7", 0), ("G2", "TRPVX4", 0)], "entry_key string, form string, form_rank int")
    v = spark.createDataFrame([("gene", x) for x in ("ABQY7", "TPRVX4", "TRPVX5", "TRPVZ4")], "kind string, value string")
    got = {r.value: r.entry_key for r in M.map_values(v, M.forms([("gene", lex)])).collect()}
    # five letters with one edit are the entry's; four are another entry; another number always is
    assert got == {"TPRVX4": "G2", "TRPVZ4": "G2"}
