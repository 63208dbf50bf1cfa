from medloom.llm import scanned as S

SENTENCES = ["The committee recommends yearly audiometry for everybody with proven anemia", "Median follow-up was long and no dose-limiting toxicity occurred in any patient", "Among carriers most remained without clinical manifestations until adulthood", "Treatment was stopped because of moderate burning after some days in the study"]


def text(doc, pages=4):
    out, title = [], f"Report number {doc % 7} of the study: final report"
    for p in range(pages):
        body = [s + "." for s in SENTENCES] + ["Week 4", "78", "n = 5"]
        k = (3 * doc + 2 * p) % len(body)
        body = body[k:] + body[:k]
        lines = [title if p % 2 else f"Acta of Medicine {doc}(3)", *body, f"- {doc + p} -"]
        out.append(f"--- Page {p + 1} ---\n\n" + "\n".join(lines) + "\n")
    return "\n".join(out)


def found(spark, rows):
    df = spark.createDataFrame(rows, "state_id bigint, t string")
    return df, {(r.doc, r.no, r.noise_kind) for r in S.noise_lines(df, "state_id", "t").collect()}


def test_noise_kinds(spark):
    rows = [(i, text(i * 100)) for i in range(12)]
    bad = text(1200).replace("yearly audiometry", "yearly audio-\nmetry", 1).replace("clinical", "c1inical", 1).replace("burning after", "burningafter", 1).replace("no dose-limiting", "no dose-\nlimiting", 1)
    rows += [(50, bad), (51, None), (52, ""), (53, "no pages\nhere at all"), (54, "--- Page 1 ---\r\n\r\nonly c1inical text.\r\n")]
    _, got = found(spark, rows)
    lines = bad.split("\n")
    where = lambda part: next(i + 1 for i, l in enumerate(lines) if part in l)
    mine = {(n, k) for d, n, k in got if d == 50}
    assert {(where("audio-"), "hyphen"), (where("c1inical"), "misread"), (where("burningafter"), "misread")} <= mine
    assert not any(k == "hyphen" and n == where("dose-") for n, k in mine)
    furniture = {n for n, k in mine if k == "furniture"}
    assert furniture == {i + 1 for i, l in enumerate(lines) if l.startswith(("Acta", "Report number", "- "))}
    assert (54, 3, "misread") in got and not any(d in (51, 52, 53) for d, _, _ in got)
    clean = {(d, n, k) for d, n, k in got if d < 12 and k != "furniture"}
    assert not clean


def test_paragraphs_are_repaired(spark):
    rows = [(i, text(i * 100)) for i in range(12)] + [(50, text(1200).replace("yearly audiometry", "yearly audio-\nmetry", 1).replace("clinical", "c1inical", 1))]
    df = spark.createDataFrame(rows, "state_id bigint, t string")
    out = " ".join(r.text for r in S.paragraphs(df, "state_id", "t").where("doc = 50").orderBy("paragraph_no").collect())
    assert "yearly audiometry" in out and "without clinical manifestations" in out and "Acta of" not in out


def test_empty_table(spark):
    assert found(spark, [])[1] == set()


def test_headers_of_any_number_of_lines(spark):
    # every line of a header of five lines is furniture; the body below it isn't
    head = ["Institute for Rare Disorders", "Department of Trials", "Confidential working copy", "Please do not distribute", "Version of the sponsor"]
    rows = []
    for doc in range(30):
        pages = []
        for p in range(3):
            word = lambda x: "".join(chr(97 + 7919 * x // 26**k % 26) for k in range(4))
            body = [f"{word(doc * 100 + p * 10 + i)} {SENTENCES[(doc + p + i) % 4]} {word(doc * 77 + p * 31 + i * 5)}." for i in range(8)]
            pages.append(f"--- Page {p + 1} ---\n\n" + "\n".join([*head, *body]) + "\n")
        rows.append((doc, "\n".join(pages)))
    _, got = found(spark, rows)
    for doc, text_ in rows:
        lines = text_.split("\n")
        assert {n for d, n, k in got if d == doc and k == "furniture"} == {i + 1 for i, l in enumerate(lines) if l in head}


def test_texts_that_come_again_change_nothing(spark):
    bad = text(1200).replace("clinical", "c1inical", 1).replace("yearly audiometry", "yearly audio-\nmetry", 1)
    rows = [(i, text(i * 100)) for i in range(12)] + [(50, bad)]
    _, once = found(spark, rows)
    _, often = found(spark, rows + [(i + 1000 * k, t) for k in range(1, 12) for i, t in rows])
    assert {r for r in often if r[0] < 1000} == once
    assert {(d % 1000, n, k) for d, n, k in often if d >= 1000} == once and len(often) == 12 * len(once)


def test_filter_misses_nothing(spark):
    keys = spark.range(-5000, 5000).selectExpr("id * 7919 AS k")
    f = S.Filter(keys)
    assert all(i * 7919 in f for i in range(-5000, 5000)) and sum(k in f for k in range(1, 20000, 2) if k % 7919) < 1500
    assert 5 not in S.Filter(keys.limit(0))
