import os
import random

import pytest
from pyspark.sql import functions as F

from medloom.llm.encode import chunks, decoded, encode, encode_corpus, encoding
from medloom.session import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary file here")


def test_chunks_give_the_same_ids():
    enc, rng = encoding(PATH), random.Random(5)
    alphabet = " \n\t\r ab1'st,.é漢　s🙂"
    for _ in range(4000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(30)))
        k = rng.randrange(1, 7)
        assert "".join(chunks(t, k)) == t and encode(t, enc, k) == enc.encode_ordinary(t)


def test_long_texts_without_spaces():
    enc = encoding(PATH)
    for t in ("x" * 5000, " " * 3000 + "a", "word " * 2000, "é" * 1000):
        assert encode(t, enc, 100) == enc.encode_ordinary(t)


def test_defined_results_and_round_trip(spark):
    rows = [(1, None), (2, ""), (3, "<|endoftext|> is ordinary"), (4, "naïve 漢字 🙂\n\n end "), (5, "a" * 300000)]
    ids = encode_corpus(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text")
    got = {r.doc_id: r for r in ids.withColumn("back", decoded(F.col("ids"))).collect()}
    assert got[1].ids == [] and got[2].ids == [] and 50256 not in got[3].ids
    assert all(got[i].back == t for i, t in rows if t)
    assert ids.schema["ids"].dataType.simpleString() == "array<int>"
