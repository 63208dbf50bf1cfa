import numpy as np

from medloom.llm import truncation as T

STARTS = ["The delay between symptoms and diagnosis was long", "Patients with renal failure were included here", "Treatment was stopped after some days again"]


def corpus():
    rows = []
    for i in range(300):
        body = " ".join(f"{STARTS[(i + k) % 3]}{' indeed' * (i % 5)}." for k in range(2 + i % 4))
        if i % 3 == 0:
            body += f"\n\nKeywords: thing {i}; registry"
        rows.append((i, body, "a" if i % 2 else "b", len(body)))
    long = " ".join(f"{s}." for s in STARTS * 4)
    rows += [(1000 + i, long[: 200], "c", 200) for i in range(20) if not long[:200].endswith(".")]
    rows += [(2000, STARTS[0][:30], "a", 500), (2001, "Patie", "a", None), (2002, None, "a", None), (2003, "  \n ", "a", 3), (2004, "", None, 0), (2005, "He said: “better…”", None, 5), (2006, "It was 5 (p = 0.", "a", None)]
    return rows


def test_cut_texts(spark):
    df = spark.createDataFrame(corpus(), "doc_id bigint, text string, source string, n_chars bigint")
    got = {r.doc_id: r for r in T.judge(df).collect()}
    assert {i for i, r in got.items() if r.is_cut} >= {*range(1000, 1020), 2000, 2001}
    assert not any(got[i].is_cut for i in range(300)) and not got[2005].is_cut
    assert {2002, 2003, 2004}.isdisjoint(got)
    assert got[1003].limit == 200
    report = {r.source: r for r in T.source_report(T.judge(df)).collect()}
    assert report["c"].cut_share == 1.0 and report["c"].main_limit == 200
    assert T.judge(df.limit(0)).count() == 0


def test_censored_fit_beats_the_plain_mean():
    rng = np.random.default_rng(0)
    x = rng.normal(6.0, 0.7, 20000)
    seen, cens = np.minimum(x, 6.2), x > 6.2
    mu, sigma = T.fit_censored(seen, np.ones(len(x)), cens, rounds=500)
    assert abs(mu - 6.0) < 0.03 and abs(sigma - 0.7) < 0.03 and seen.mean() < 5.9


def test_a_text_without_spaces_is_one_word(spark):
    # a starter of 100,000 characters must not be taken apart into all its beginnings
    rows = [(i, "A" * 100_000 + ".", "s", None) for i in range(3)] + [(9, "Complete sentence here.", "s", None), (10, "AAA", "s", None)]
    got = {r.doc_id: r.is_cut for r in T.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint")).collect()}
    assert len(got) == 5 and not got[0] and not got[9]
