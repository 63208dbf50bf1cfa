import json

import pytest
from pyspark.sql import functions as F

from medloom.sources import readers as R
from medloom.sources import writers as Wr
from medloom.streaming import incremental as I


def test_lexicons(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"TNF": {"canonical": "tumor necrosis factor", "variants": ["tnf-a"]}, "X": {}}))
    got = {(r.key, r.form, r.canonical) for r in R.json_lexicon(spark, str(tmp_path / "a.json")).collect()}
    assert got == {("TNF", "TNF", "tumor necrosis factor"), ("TNF", "tnf-a", "tumor necrosis factor"), ("X", "X", "X")}
    (tmp_path / "b.tsv").write_text("Abbreviation\tExpansion\tTopSource\nAB\talpha beta\tS\nCD\tbad\tS\n")
    bad = spark.createDataFrame([("bad",)], "long_form string")
    assert [r.short_form for r in R.tsv_lexicon(spark, str(tmp_path / "b.tsv"), bad_long=bad).collect()] == ["AB"]


def test_gold_aliases_and_strict(spark):
    df = spark.createDataFrame([("x/y.pdf", "tnf", " a  b "), ("x/y.pdf", "TNF", "a b"), (None, "Q", None)], "filename string, sf string, lf string")
    assert [tuple(r) for r in R.gold(df).collect()] == [("y.pdf", "TNF", "a b")]
    with pytest.raises(Exception, match="no document"):
        R.gold(df, strict=True).collect()


def test_brat_and_acronyms(spark, tmp_path):
    (tmp_path / "d1.ann").write_text("T1\tDIS 0 3\tTNF\nT2\tDIS 5 26\ttumor necrosis factor\nR1\tIs_acron Arg1:T1 Arg2:T2\nbroken\n")
    spans, rel = R.brat(spark, str(tmp_path / "*.ann"))
    assert spans.count() == 2 and rel.count() == 1
    assert tuple(R.acronym_pairs(spans, rel).first()) == ("d1", "TNF", "tumor necrosis factor")


def test_pubtator_and_bio(spark, tmp_path):
    (tmp_path / "p.txt").write_text("1|t|Title\n1|a|Abstract\n1\t0\t5\tTitle\tDisease\tD1\n\n")
    docs, notes = R.pubtator(spark, str(tmp_path / "p.txt"))
    assert tuple(docs.first()) == ("1", "Title", "Abstract") and notes.first().concept == "D1"
    toks = [("d", i, t, g) for i, (t, g) in enumerate([("renal", "B-DIS"), ("failure", "I-DIS"), ("and", "O"), ("x", "B-DRUG"), ("y", "B-DRUG")])]
    got = sorted((r.type, r.text) for r in R.bio_entities(spark.createDataFrame(toks, "doc_id string, position int, token string, tag string")).collect())
    assert got == [("DIS", "renal failure"), ("DRUG", "x"), ("DRUG", "y")]


def test_sinks(spark, tmp_path):
    e = spark.createDataFrame([("drug", "VALIDATED", "a"), ("drug", "REJECTED", "b")], "entity_type string, status string, text string")
    Wr.export_entities(e, str(tmp_path / "o"))
    assert [r.text for r in spark.read.json(str(tmp_path / "o")).collect()] == ["a"]
    for n in (1, 2):
        Wr.append_usage(spark.createDataFrame([("d", n)], "doc string, n bigint"), str(tmp_path / "u"))
    assert Wr.read_usage(spark.read.parquet(str(tmp_path / "u")), ["doc"], ["n"]).first().n == 3
    cache = spark.createDataFrame([("k", "v", "2024-01-01 00:00:00"), ("z", "v", "2020-01-01 00:00:00")], "key string, value string, cached_at string")
    assert [r.key for r in Wr.fresh(cache, "2024-01-01 01:00:00", 7200).collect()] == ["k"]


def test_stream_drops_duplicates_and_goes_on(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("s", "o", "c"))
    rows = lambda *ids: spark.createDataFrame([(i, f"text {i} PMID: 12345678") for i in ids], "doc_id bigint, text string").withColumn("received_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    rows(1, 2, 2).write.mode("append").parquet(src)
    I.run_to_table(I.deduplicated(I.document_stream(spark, src)), out, ck).awaitTermination()
    rows(2, 3).write.mode("append").parquet(src)
    I.run_to_table(I.deduplicated(I.document_stream(spark, src)), out, ck).awaitTermination()
    assert sorted(r.doc_id for r in spark.read.parquet(out).collect()) == [1, 2, 3]
