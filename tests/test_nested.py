import json

from medloom.operators.nested import child_links, child_tables, infer_levels, json_levels


def links(spark, texts, levels=None):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id bigint, j string, label string")
    return sorted((r.row_id, r.label, tuple(r.path)) for r in child_links(df, "id", "j", levels).collect())


def test_json_edge_cases(spark):
    texts = [None, "", " ", "null", "3", '"x"', "[]", "{}", '[{"a":1}] tail', '{"a":1},{"a":2}', '[{"a":1}', "{'a':1}"]
    assert links(spark, texts) == [(7, "j", (0,))]


def test_positions_nulls_and_lone_objects(spark):
    got = links(spark, ['[{"a":1},null,3,{"b":[{"c":1},null,{"c":2}]}]', '{"b":{"c":1}}', '[{"b":null},{"b":[]},{"b":5}]'])
    assert got == [(0, "j", (0,)), (0, "j", (3,)), (0, "j.b", (3, 0)), (0, "j.b", (3, 2)), (1, "j", (0,)), (1, "j.b", (0, 0)), (2, "j", (0,)), (2, "j", (1,)), (2, "j", (2,))]


def test_levels_are_inferred_at_any_depth(spark):
    deep = json.dumps([{"a": [{"b": [{"c": 1}, None, {"c": [{"d": 2}]}]}]}])
    got = links(spark, [deep, None])
    assert got == [(0, "j", (0,)), (0, "j.a", (0, 0)), (0, "j.a.b", (0, 0, 0)), (0, "j.a.b", (0, 0, 2)), (0, "j.a.b.c", (0, 0, 2, 0))]
    schema = "id bigint, g array<struct<s:struct<i:array<struct<c:int,e:array<struct<x:int>>>>>,n:array<int>>>"
    df = spark.createDataFrame([(1, [(([(7, [(1,), None])],), [1])])], schema)
    assert sorted((r.label, tuple(r.path)) for r in child_links(df, "id", "g").collect()) == [("g", (0,)), ("g.s.i", (0, 0)), ("g.s.i.e", (0, 0, 0))]


def test_struct_arrays_and_empty_table(spark):
    schema = "id bigint, g array<struct<n:string,i:array<struct<c:int>>>>, path string"
    df = spark.createDataFrame([(1, [("a", [(1,), None]), None, ("b", None)], "z"), (2, None, None), (3, [], None)], schema)
    got = sorted((r.row_id, r.label, tuple(r.path)) for r in child_links(df, "id", "g").collect())
    assert got == [(1, "g", (0,)), (1, "g", (2,)), (1, "g.i", (0, 0))]
    assert child_links(df.limit(0), "id", "g").count() == 0
    assert links(spark, []) == []


def test_child_tables_keep_parent_path(spark):
    df = spark.createDataFrame([(1, [("a", [(1, [("x",)])])])], "id bigint, g array<struct<n:string,i:array<struct<c:int,d:array<struct<e:string>>>>>>")
    t = child_tables(df, "id", "g")
    assert sorted(t) == ["g", "g.i", "g.i.d"]
    r = t["g.i.d"].first()
    assert (r.parent_key, r.parent_path, r.pos, r.f_e) == (1, "0.0", 0, "x")


def test_merged_schema_round_trip(spark):
    records = [[{"w": "a", "s": 1, "span": {"x": 1}}, {"w": "b", "s": "2"}], [{"w": "c", "k": [{"n": 1}]}, {"k": {"n": 2}}]]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "id bigint, j string")
    t = infer_levels(df, "id", "j")
    assert sorted(r.f_w or "" for r in t["j"].collect()) == ["", "a", "b", "c"]
    assert sorted(r.f_n for r in t["j.k"].collect()) == [1, 2]


def test_child_tables_have_the_rows_that_p6_found_lists(spark):
    import __spark_entry__ as entry

    q, d = entry.queries(), "/root/testdata/sf0.001"
    listed = {r.child_kind: r["count"] for r in q["p6_found"](spark, d).groupBy("child_kind").count().collect()}
    for kind, name in (("identifier", "p6_candidate_identifiers"), ("gene_identifier", "p6_gene_identifiers"), ("gene_disease", "p6_gene_diseases")):
        t = q[name](spark, d)
        assert t.count() == listed.get(kind, 0) > 0 and any(c.startswith("f_") for c in t.columns)


def test_levels_take_one_pass_whatever_their_number(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    # a field that is an array in one row only, fields of lone objects, an array below one that never repeats
    records = [[{"a": {"b": {"c": [{"d": []}]}}}], {"a": [{"b": [None]}]}, [{"s": {"n": [1]}, "a": None}], [{"a": [{"b": {"c": 3}}]}]]
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "j string").repartition(3).mapInArrow(counted, "j string")
    assert json_levels(df, "j") == {("a",): {("b",): {("c",): {("d",): {}}}}}
    assert read.value == len(records)


def test_text_that_closes_the_bracket_is_no_json(spark):
    assert links(spark, ['{"a":1}] tail', '[{"a":[{"b":1}]}],[0]', '{"a":1},null', '{"a":1},', '{"a":1}\n']) == [(4, "j", (0,))]


def test_fields_of_any_name_are_levels(spark):
    names = ["a,b: c", "it's", "who?", "", 'q"', "`x`", "$[0]", "a.b"]
    got = links(spark, [json.dumps({n: [{"k": 1}, None, {"k": [{}]}]}) for n in names])
    assert got == sorted(x for i, n in enumerate(names) for x in ((i, "j", (0,)), (i, f"j.{n}", (0, 0)), (i, f"j.{n}", (0, 2)), (i, f"j.{n}.k", (0, 2, 0))))


def test_levels_of_deep_and_broken_text(spark):
    deep = '{"a":' * 990 + "[]" + "}" * 990
    df = spark.createDataFrame([(deep,), ("[" * 200_000,), ('[{"b":[],"n":' + "9" * 5000 + "}]",)], "j string")
    assert json_levels(df, "j") == {("b",): {}}
    broken = spark.sql("SELECT 1 AS id, CAST(CONCAT(CAST('[{\"w\":\"' AS BINARY), X'ff', CAST('\",\"b\":[{}]}]' AS BINARY)) AS STRING) AS j")
    assert sorted((r.label, tuple(r.path)) for r in child_links(broken, "id", "j").collect()) == [("j", (0,)), ("j.b", (0, 0))]
