import random
from datetime import datetime, timedelta

import numpy as np

from medloom.llm import survivors as S

SCHEMA = "span_id bigint, doc_id string, text string, category string, confidence double, source string, span_start int, span_end int, entity_type string, extracted_at timestamp"


def run(spark, rows):
    cats = spark.createDataFrame([("c1", "g"), ("c2", "g"), ("d1", "h")], "category_label string, category_group string")
    src = spark.createDataFrame([("Alpha-v2", 1, "v2"), ("Beta", 2, "v1")], "source_name string, trust_rank int, current_version string")
    return S.resolve(spark.createDataFrame(rows, SCHEMA), cats, src)


def rec(i, text, s, e, doc="d", cat="c1", conf=0.5, src="Beta"):
    return (i, doc, text, cat, conf, src, s, e, None, datetime(2024, 1, 1) + timedelta(minutes=i))


def test_grouping_against_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for i in range(1, 260):
        loose = rng.random() < 0.15
        s = rng.randrange(0, 600)
        rows.append(rec(i, rng.choice(["aa", "A a", "b", "c!", None, ""]), None if loose else s, None if loose else s + rng.choice([0, 5, 20, 21, 60, 300]), rng.choice(["d", "e", None]), rng.choice(["c1", "c2", "d1", "zz"])))
    grp = {"c1": "g", "c2": "g", "d1": "h"}
    norm = lambda t: ("".join(c for c in (t or "").lower() if c.isalnum())) or None
    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ranged = lambda r: r[6] is not None and r[7] > r[6]
    for a in rows:
        for b in rows:
            if a[0] < b[0] and a[1] is not None and a[1] == b[1] and grp.get(a[3]) and grp.get(a[3]) == grp.get(b[3]):
                if ranged(a) and ranged(b):
                    link = 2 * (min(a[7], b[7]) - max(a[6], b[6])) >= min(a[7] - a[6], b[7] - b[6])
                else:
                    link = norm(a[2]) is not None and norm(a[2]) == norm(b[2])
                if link:
                    x, y = find(a[0]), find(b[0])
                    parent[max(x, y)] = min(x, y)
    got = {r.span_id: r.first_span_id for r in run(spark, rows).collect()}
    assert got == {r[0]: find(r[0]) for r in rows}


def test_best_record_order(spark):
    rows = [rec(1, "x", 0, 10, conf=None), rec(2, "x", 0, 10, conf=0.9, src="Beta"), rec(3, "x", 0, 10, conf=0.9, src="ALPHA_V2"), rec(4, "x", 0, 10, conf=0.9, src="alpha-v2/v2"), rec(5, "y", 50, 60)]
    got = {r.first_span_id: r for r in S.survivors(run(spark, rows)).collect()}
    assert got[1].best_span_id == 4 and got[1].records == 4 and got[5].records == 1


def test_empty_table(spark):
    assert S.survivors(run(spark, [])).count() == 0


def test_em_recovers_source_quality(spark):
    rng = np.random.default_rng(1)
    sens, spec = np.array([0.95, 0.6, 0.8]), np.array([0.9, 0.95, 0.6])
    truth = rng.random(20000) < 0.5
    pos = np.where(truth[:, None], rng.random((20000, 3)) < sens, rng.random((20000, 3)) > spec)
    values, counts = np.unique(pos, axis=0, return_counts=True)
    df = spark.createDataFrame([([(f"s{i}", bool(x)) for i, x in enumerate(v)], int(n)) for v, n in zip(values, counts)], "c array<struct<s:string,v:boolean>>, n bigint")
    model, p = S.fit_sources(df, rounds=60, tolerance=1e-3)
    a, b = (np.array([model[f"s{i}"][j] for i in range(3)]) for j in (0, 1))
    assert np.abs(a - sens).max() < 0.08 and np.abs(b - spec).max() < 0.08 and abs(p - 0.5) < 0.08


def test_seventy_sources_all_count(spark):
    # every mention has one text by 69 sources and another by one of them; each source is judged
    rows = [rec(100 * m + i, "right" if i != m else "wrong", 1000 * m, 1000 * m + 10, src=f"Source number {i:02d}x") for m in range(70) for i in range(70)]
    values, (model, _) = S.judged_values(run(spark, rows))
    assert len(model) == 70
    got = [(r.text, r.reports, r.is_true) for r in values.collect()]
    assert sorted(set(got)) == [("right", 69, True), ("wrong", 1, False)] and len(got) == 140


def test_repeated_row_counts_once(spark):
    rows = [rec(1, "x", 0, 10), rec(1, "x", 0, 10), rec(2, "x", 0, 10)]
    assert [(r.first_span_id, r.records) for r in S.survivors(run(spark, rows)).collect()] == [(1, 2)]
