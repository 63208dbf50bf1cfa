import pytest

from medloom.llm.lookalikes import Trie, by_table, canonical, canonical_fields, vocabulary, vocabulary_word

ZW, NB = chr(0x200B), chr(0xA0)
TRIE = Trie(["anemia", "ANEMIA", "qtt2", "QTT2", "thb1", "THB1"])

CHANGED = {
    f"an{ZW}emia": "anemia", f"a{NB}b": "a b", "ＱＴＴ２": "QTT2", "аnеmia": "anemia", "ТНВ1": "THB1", "QΤT2": "QTT2", "café": "café", "deﬁciency": "deficiency", "\U0001d5b0TT2": "QTT2", "a‐b": "a-b", "37 °С": "37 °C", "αnemia": "anemia",
}
SAME = ["", "plain", "a  b", "GRENB-α", "TNFα", "пациент выздоровел", "ο ασθενής ανέρρωσε", "患者は回復した", "12–18 “x” ’y’", "m² °C", "Ålvik naïve", "β-thing"]


@pytest.mark.parametrize("text", CHANGED)
def test_changed(text):
    assert canonical(text, TRIE) == CHANGED[text]


@pytest.mark.parametrize("text", SAME)
def test_same(text):
    assert canonical(text, TRIE) == text


def test_null_and_idempotent():
    assert canonical(None, TRIE) is None
    for t in CHANGED.values():
        assert canonical(t, TRIE) == t


def test_automaton_costs():
    assert TRIE.find("аnеmia", 0) == (0, "anemia") and TRIE.find("anmia", 0) is None
    assert TRIE.find("anmia", 1) == (1, "anemia") and TRIE.find("anemiaa", 1) == (1, "anemia") and TRIE.find("xnexia", 1) is None


def test_invisible_characters_and_forms_cost_nothing():
    assert TRIE.find(f"an{ZW}em{chr(0xAD)}ia", 0) == (0, "anemia") and TRIE.find("ＱＴＴ２", 0) == (0, "QTT2")
    assert Trie(["fibrosis"]).find("ﬁbrosis", 0) == (0, "fibrosis")


def test_the_entry_is_the_spelling():
    # the word stands among plainly Cyrillic ones: only the vocabulary knows that it is meant in Latin
    text = "ген ТНВ1 СОРА найден"
    assert by_table("ген РАХ найден") == "ген РАХ найден"
    assert canonical("ген РАХ найден", Trie(["pax", "PAX"])) == "ген PAX найден"
    assert vocabulary_word(f"Аn{ZW}еmia", TRIE) == "Anemia" and canonical(text, TRIE).split()[1] == "THB1"


def test_large_vocabulary_is_taken_in_parts(spark):
    words = spark.range(300_000).selectExpr("concat('w', cast(id as string), 'x') as word").union(spark.createDataFrame([("pax",), ("cop",)], "word string"))
    df = spark.createDataFrame([(1, "ген РАХ СОР найден"), (2, "ген РАТ найден")], "id bigint, x string")
    got = {r.row_id: r.canonical for r in canonical_fields(df, "t", "id", ["x"], words, most=100_000).collect()}
    assert got == {1: "ген PAX COP найден"}


def test_fields(spark):
    df = spark.createDataFrame([(1, f"a{NB}b", None, "z"), (2, None, "", "z"), (3, "GRENB-α", "ＱＴＴ２" * 5000, "z")], "id bigint, x string, y string, row_id string")
    words = vocabulary([spark.createDataFrame([("QTT2 of",)], "t string"), spark.createDataFrame([(["qtt2", None],)], "t array<string>")])
    assert sorted(r.word for r in words.collect()) == ["of", "qtt2"]
    got = canonical_fields(df, "t", "id", ["x", "y"], words)
    assert sorted((r.row_id, r.field_name) for r in got.collect()) == [(1, "x"), (3, "y")]
    assert canonical_fields(df.limit(0), "t", "id", ["x"]).count() == 0
