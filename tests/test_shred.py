"""Shredding and assembly against a plain walk, and their levels by hand."""

import json

from pyspark.sql import functions as F

from corpusloom.operators import shred as S


def frame(spark, payloads):
    return spark.createDataFrame([(i, p, "k", "x") for i, p in enumerate(payloads)], "raw_id long, payload string, key string, path string")


def found(spark, *payloads):
    return sorted(tuple(r) for r in S.found(frame(spark, payloads)).collect())


def test_levels_by_hand():
    record = {"entries": [{"t": 1, "children": [{"t": 2}, None]}, None, {"children": []}]}
    cols = S.shred_record(record, S.BOOK_TOC, True)
    assert cols["entries", "@"][:2] == ([0, 1, 1], [2, 1, 2])
    assert cols["entries", "t"] == ([0, 1, 1], [3, 1, 2], ["1", None, None])
    assert cols["entries/children", "@"][:2] == ([0, 2, 1, 1], [4, 3, 1, 2])
    assert S.positions(__import__("numpy").array([0, 2, 1, 1]), 2).tolist() == [[0, 0], [0, 1], [1, 0], [2, 0]]


def test_kinds_and_positions(spark):
    curriculum = {"learning_pathways": [None, {"topic_sequence": ["a", None, "b"], "checkpoints": json.dumps([{"assessments": {"type": "quiz"}}]), "adaptive_branching": {"easy": ["x"], "hard.er": "y", "none": []}}]}
    assert found(spark, json.dumps({"status": "ok", "result": {"curriculum": curriculum}})) == [
        (0, "assessment", "1.0.0", "1.0"), (0, "branch", "1.easy.0", "1"), (0, "branch", "1.hard.er.0", "1"), (0, "checkpoint", "1.0", "1"), (0, "pathway", "1", ""), (0, "topic", "1.0", "1"), (0, "topic", "1.2", "1"),
    ]


def test_nested_entries_lone_elements_and_strings(spark):
    toc = {"entries": {"title": "only", "children": json.dumps([None, {"title": "c", "children": {"title": "g"}}])}}
    assert found(spark, json.dumps(toc)) == [(0, "entry", "0", ""), (0, "entry", "0.1", "0"), (0, "entry", "0.1.0", "0.1")]


def test_unreadable_empty_and_repeated(spark):
    good = json.dumps({"entries": [{"title": "a"}]})
    assert found(spark, None, "", "Error", "[1]", good[:-3], '{"entries": NaN}', '{"entries": []}', good, good) == [(7, "entry", "0", ""), (8, "entry", "0", "")]
    assert found(spark) == []


def test_deep_and_wide(spark):
    deep = None
    for i in range(300):
        deep = [{"title": str(i), **({"children": deep} if deep else {})}]
    rows = found(spark, json.dumps({"entries": deep}), json.dumps({"entries": [{}] * 3000}))
    assert sum(r[0] == 0 for r in rows) == 300 and sum(r[0] == 1 for r in rows) == 3000
    assert max(r[2].count(".") for r in rows) == 299


def test_tables_keep_fields_and_parents(spark):
    p = json.dumps({"learning_pathways": [{"pathway_id": 7, "checkpoints": [{"title": "c", "assessments": [{"type": "quiz", "weight": 0.5}, {"type": "oral", "weight": "much"}]}]}]})
    cols = S.shred(frame(spark, [p]), "raw_id", "payload")
    rows = [tuple(r) for r in S.table(cols, "assessment", {"type": "string", "weight": "double"}).orderBy("pos").collect()]
    assert rows == [(0, "0.0.0", "0.0", None, "quiz", 0.5), (0, "0.0.1", "0.0", None, "oral", None)]
    assert [tuple(r) for r in S.table(cols, "pathway", {"pathway_id": "string", "missing": "int"}).collect()] == [(0, "0", "", None, "7", None)]


def test_odd_values(spark):
    odd = '{"learning_pathways": [{"topic_sequence": ["\\ud800x", 12345678901234567890123456789, true, ""], "adaptive_branching": {"\\ud800": ["a"]}, "checkpoints": 5}]}'
    rows = found(spark, odd)
    assert [r[1] for r in rows].count("topic") == 4 and (0, "branch", "0.?.0", "0") in rows and (0, "checkpoint", "0.0", "0") in rows
    huge = '{"entries": [{"level": ' + "9" * 5000 + '}]}'
    assert found(spark, huge) == [(0, "entry", "0", "")]
    assert found(spark, "[" * 200_000, '{"entries": ' + "[" * 200_000) == []


def test_nesting_beyond_the_recursion_of_the_parser(spark):
    n = 6_000
    text = '{"entries": ' + '[{"title": "t", "children": ' * n + "[]" + "}]" * n + "}"
    df = S.found(frame(spark, [text, text[:-1], '{"x": ' + "[" * 100_000 + "]" * 100_000 + ', "entries": [{"a": 1}]}']))
    got = df.groupBy("raw_id").agg(F.count("*"), F.max(F.length("pos")), F.max(F.length("parent_pos"))).collect()
    assert {tuple(r) for r in got} == {(0, n, 2 * n - 1, 2 * n - 3), (2, 1, 1, 0)}


def test_deep_parser_agrees_with_the_plain_one():
    cases = ['{"a": [1, -2.5e3, "x\\u00e9", null, true, {"b": []}], "": {}}', "[]", " 5 ", '"s"', '{"a":1,}', "[1 2]", "[1,]", "{1:2}", '{"a" 1}', "tru", "01", "", "[", '{"a": NaN}', "[1]]", '"\n"']
    for c in cases:
        try:
            deep = S._parse_deep(c)
        except ValueError:
            deep = None
        assert deep == S.parse(c), c
    value = {"a": [1, 2.5, "é\n", None, True, {"b": [], "c": {}}], "": {}}
    assert S._dump_deep(value) == json.dumps(value, ensure_ascii=False)
