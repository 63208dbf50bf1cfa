import random

from pyspark.sql import functions as F

from medloom.operators import dedup as D
from medloom.operators import lexicon as L
from medloom.operators import matching as M
from medloom.operators import spans as SP
from medloom.plans.components import connected_components
from medloom.plans.presets import chosen


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_longest_leftmost(spark):
    lex = spark.createDataFrame([("k1", ["renal failure"]), ("k2", ["acute renal failure"]), ("k3", ["failure"]), ("k4", [None, ""])], "k string, f array<string>")
    docs = spark.createDataFrame([(1, "Acute renal failure, renal failure; FAILURE"), (2, None), (3, "")], "doc bigint, t string")
    forms = L.entries(lex, "k", [F.col("f")])
    got = sorted((r.doc, r.start, r.entry) for r in L.longest_leftmost(L.hits(docs, "doc", "t", forms), "doc").collect())
    assert got == [(1, 0, "k2"), (1, 3, "k1"), (1, 5, "k3")]


def test_nearest_and_overlap_against_brute_force(spark):
    rng = random.Random(1)
    a = [(i, rng.randrange(3), rng.randrange(2000)) for i in range(60)]
    b = [(i, rng.randrange(3), rng.randrange(2000)) for i in range(60)]
    da, db = (spark.createDataFrame(x, "id bigint, d int, pos int") for x in (a, b))
    got = {r.left_id: (r.distance, r.right_id) for r in SP.nearest(da, db, "d", 100).collect()}
    want = {}
    for i, d, p in a:
        near = [(abs(p - q), q, j) for j, e, q in b if e == d and abs(p - q) <= 100]
        if near:
            m = min(near)
            want[i] = (m[0], m[2])
    assert got == want
    spans = [(i, 0, s, s + rng.randrange(5, 400)) for i, s in enumerate(rng.sample(range(3000), 60))]
    got = {tuple(r) for r in SP.overlapping(spark.createDataFrame(spans, "id bigint, d int, start int, end int"), ["d"]).collect()}
    want = {(x[0], y[0]) for x in spans for y in spans if x[0] < y[0] and 2 * (min(x[3], y[3]) - max(x[2], y[2])) >= min(x[3] - x[2], y[3] - y[2])}
    assert got == want


def test_greedy_spans(spark):
    rows = [(1, "d", 0, 10, 0.5), (2, "d", 5, 15, 0.9), (3, "d", 14, 20, 0.7), (4, "d", 30, 40, 0.1), (5, "d", 30, 40, 0.1)]
    assert sorted(r.id for r in SP.greedy_spans(spark.createDataFrame(rows, "id bigint, doc string, start int, end int, score double"), ["doc"]).collect()) == [2, 4]


def test_matching(spark):
    s = spark.createDataFrame([(1, "d", "abcdefgh"), (2, "d", "abcdefgx"), (3, "e", "zz")], "id bigint, doc string, text string")
    g = spark.createDataFrame([(10, "d", "abcdefgh"), (11, "e", "yy")], "id bigint, doc string, text string")
    assert [(r.s, r.g) for r in M.one_to_one(M.fuzzy_pairs(s, g, "doc", "text")).collect()] == [(1, 10)]
    c = M.compare_sets(s, g, "doc", ["text"])
    m = M.micro(c).first()
    assert (m.tp, m.fp, m.fn, m.precision, m.recall) == (1, 2, 1, 0.3333, 0.5)
    assert M.macro(c.limit(0)).first().docs == 0


def test_fingerprint_ignores_order_and_partitions(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    a = D.fingerprint(df, ["id", "x"]).first()
    assert a == D.fingerprint(df.orderBy(F.desc("id")).repartition(13), ["id", "x"]).first()
    assert a != D.fingerprint(df.where("id <> 5"), ["id", "x"]).first()


def test_presets():
    assert chosen(["ag15_x", "ex01_y"], "usage") == ["ag15_x"]


def test_shared_stretches_link_every_overlap_of_20(spark):
    rng = random.Random(5)
    stretches = ["".join(rng.choice("abcdef ") for _ in range(rng.randrange(17, 24))) for _ in range(12)]
    texts = [(i, rng.choice("XYZ") * i + rng.choice(stretches) + "|" * (i % 2) + rng.choice(stretches)) for i in range(40)] + [(90, None), (91, ""), (92, "short"), (93, stretches[0])]
    got = [tuple(r) for r in D.shared_stretches(spark.createDataFrame(texts, "id bigint, t string"), "id", "t", 20).collect()]
    grams = {i: {t[j : j + 20] for j in range(len(t) - 19)} for i, t in texts if t}
    pairs = {(max(a, b), min(a, b)) for a in grams for b in grams if a != b and grams[a] & grams[b]}
    assert len(got) == len(set(got)) and set(got) <= pairs

    def linked(edges):
        group = {i: {i} for i in grams}
        for a, b in edges:
            if group[a] is not group[b]:
                group[a] |= group[b]
                for x in group[b]:
                    group[x] = group[a]
        return {frozenset(g) for g in group.values()}

    assert linked(got) == linked(pairs)


def stretches_by_hand(rows, n):
    """{(key, rep)} as the SQL has it: stretches of at least two different keys, null among them, with their first key."""
    keys = {}
    for k, t in rows:
        for j in range(len(t or "") - n + 1):
            keys.setdefault(t[j : j + n], set()).add(k)
    return {(k, min(x for x in ks if x is not None)) for ks in keys.values() if len(ks) > 1 for k in ks}


def test_stretches_keep_to_the_sql_on_odd_rows(spark):
    rng = random.Random(11)
    part = lambda: "".join(rng.choice("ab é𝛽\n") for _ in range(rng.randrange(0, 30)))
    parts = [part() for _ in range(9)]
    rows = [(i, rng.choice(parts) + part() + rng.choice(parts)) for i in range(150)] + [(i, part()) for i in range(150)]
    rows += [(500, "x" * 400), (501, "y" + "x" * 300), (502, "z" * 20), (502, "z" * 20), (None, "q" * 25), (None, "q" * 22), (503, "v" * 19), (504, "v" * 19), (505, None), (506, "")]
    rows += [(None, "x" * 20), (507, "w" * 30), (None, "w" * 21), (508, "".join(chr(0x100 + i) for i in range(250))), (509, "".join(chr(0x100 + i) for i in range(60, 90)))]
    df = spark.createDataFrame(rows, "id bigint, t string").repartition(5)
    for n in (1, 2, 20):
        want = stretches_by_hand(rows, n)
        assert {tuple(r) for r in D.firsts_of_stretches(df, "id", "t", n).collect()} == want
        got = [tuple(r) for r in D.shared_stretches(df, "id", "t", n).collect()]
        assert len(got) == len(set(got)) and set(got) == {(k, r) for k, r in want if k is not None and k != r}
    assert D.shared_stretches(df.limit(0), "id", "t", 20).count() == 0


def test_stretches_of_long_texts_go_in_parts(spark):
    rng = random.Random(13)
    long = "".join(rng.choice("abcdefgh é") for _ in range((1 << 19) + 700))
    rows = [(1, long)] + [(i, long[a : a + 25]) for i, a in enumerate(range((1 << 19) - 40, (1 << 19) + 40, 3), 2)] + [(90, long[-20:]), (91, long[:20]), (92, "no such stretch is in it")]
    got = {tuple(r) for r in D.shared_stretches(spark.createDataFrame(rows, "id bigint, t string"), "id", "t", 20).collect()}
    assert got == {(k, r) for k, r in stretches_by_hand(rows, 20) if k != r} and {k for k, _ in got} >= {*range(2, 28), 90, 91}

    import pyarrow as pa

    # each stretch comes once, and no run has more than 64
    runs = [r for b in D._runs(20)(iter([pa.RecordBatch.from_pydict({"k": [1], "t": [long]})])) for r in b.column(2).to_pylist()]
    assert sum(len(r) - 19 for r in runs) == len(long) - 19 and max(map(len, runs)) <= 83


def test_context_links_are_never_broadcast(spark, tmp_path):
    from medloom.queries_relational import QUERIES

    # the estimate of a few hundred bytes doesn't know that each text has 41 stretches
    rows = [(i, f"{i:030d}{i % 7:030d}") for i in range(20)]
    spark.createDataFrame(rows, "candidate_id bigint, context_text string").write.parquet(f"{tmp_path}/gene_candidates.parquet")
    df = QUERIES["jn15_context_links"](spark, str(tmp_path))
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in df.collect()} == {(k, r) for k, r in stretches_by_hand(rows, 20) if k != r}


def test_shared_contexts_keep_to_the_sql_without_a_broadcast(spark, tmp_path):
    from medloom.queries_relational import QUERIES

    rng = random.Random(12)
    parts = ["".join(rng.choice("ab é") for _ in range(rng.randrange(40, 70))) for _ in range(30)]
    rows = [(i, rng.choice(parts) + rng.choice(parts)) for i in range(80)] + [(80, None), (81, ""), (82, "a" * 59), (83, "a" * 59)]
    rows += [(90, "one" * 30), (90, "one" * 30), (91, "two" * 30), (None, "two" * 30)]
    spark.createDataFrame(rows, "candidate_id bigint, context_text string").write.parquet(f"{tmp_path}/gene_candidates.parquet")
    df = QUERIES["jn15_shared_context"](spark, str(tmp_path))
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    want = {}
    for k, rep in stretches_by_hand(rows, 60):
        want[k] = min(rep, want.get(k, rep))
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(want) and dict(got) == want and 90 not in want and want[None] == want[91] == 91


def test_matching_keeps_all_copies_of_a_text(spark):
    rng = random.Random(8)
    names = ["renal failure", "renal failures", "renal failurs", "heart block"]
    side = lambda at: [(at + i, "hot", "acute pain") for i in range(60)] + [(at + 100 + i, f"d{i % 2}", rng.choice(names)) for i in range(70)]
    s, g = side(0), side(1000)
    ds, dg = (spark.createDataFrame(x, "id bigint, doc string, text string") for x in (s, g))
    pairs = M.fuzzy_pairs(ds, dg, "doc", "text")
    used, want = set(), set()
    for r in sorted(pairs.collect(), key=lambda r: (-r.score, r.s, r.g)):
        if not {r.s, r.g} & used:
            used |= {r.s, r.g}
            want.add((r.by, r.s, r.g))
    assert sum(by == "hot" for by, _, _ in want) == 60
    assert {(r.by, r.s, r.g) for r in M.one_to_one(pairs).collect()} == want
    assert {(r.by, r.s, r.g) for r in M.match_texts(ds, dg, "doc", "text").collect()} == want


def test_similar_texts_against_brute_force(spark):
    from difflib import SequenceMatcher

    rng = random.Random(11)

    def typo(t):
        t = list(t)
        for _ in range(rng.randrange(6)):
            i = rng.randrange(len(t) + 1)
            t[i : i + rng.randrange(2)] = rng.choice(["", "x", " ", "é", "ab"])
        return "".join(t)

    terms = ["ab", "abc", "bcd", "", "aaaaaaaa", "gospelsuros anemia type 5 nos", "autoimmune vumissioric neuropathy type 3", "congenital siofiorziolen deficiency", "xutoimmune", "autoimmune"] + ["".join(rng.choice("abc ") for _ in range(rng.randrange(1, 14))) for _ in range(40)]
    left = sorted({typo(t) for t in terms * 6} | {"guspelsurös anemia type 5 nos", "autoimmune  vumissioric  neuropathy  type  3", "ac", "a" * 9})
    dl, dr = spark.createDataFrame([(t,) for t in left], "l string"), spark.createDataFrame([(t,) for t in terms], "r string")
    for least in (0.9, 0.8, 0.6):
        want = {(a, b): r for a in left for b in terms if a != b and (r := SequenceMatcher(None, a, b).ratio()) >= least}
        assert {(x.l, x.r): x.score for x in M.similar_texts(dl, dr, [], least).collect()} == want
    s, g = dl.selectExpr("hash(l) AS id", "'d' AS doc", "l AS text"), dr.distinct().selectExpr("hash(r) AS id", "'d' AS doc", "r AS text")
    want = sum(SequenceMatcher(None, a, b).ratio() >= 0.8 for a in left for b in set(terms))
    assert M.fuzzy_pairs(s, g, "doc", "text", 0.8).count() == want
