"""Tool calls: links, order, schema errors and canonical JSON, case by case."""

import json

from pyspark.sql import functions as F

from eventbase.llm import toolcalls

SCHEMAS = {
    "f": {
        "type": "object", "required": ["q"], "additionalProperties": False,
        "properties": {
            "q": {"type": "string", "minLength": 2, "enum": ["ab", "cd", "a"]}, "n": {"type": "integer", "minimum": 1, "maximum": 9},
            "x": {"type": "number"}, "o": {"type": "object"}, "b": {"type": "boolean"}, "after": {"type": "array"},
        },
    }
}
CALLS = "conv_id long, turn long, call_id string, name string, arguments string, level int"
RESULTS = "conv_id long, turn long, call_id string, content string, json int"


def run(spark, calls, results=()):
    calls = spark.createDataFrame([(*c, 0) for c in calls], CALLS)
    results = spark.createDataFrame([(*r, 0) for r in results], RESULTS)
    return {(r.conv_id, r.call_id): r for r in toolcalls.link(calls, results, SCHEMAS).collect()}


def test_links_and_canonical_json(spark):
    calls = [(1, 1, "a", "f", ' { "q" : "ab", "n": 3, "o": {"z": [1, {"b": 1, "a": "é"}], "a": null} } '), (1, 3, "b", "f", '{"q":"cd"}'), (1, 5, "a", "f", "{}")]
    results = [(1, 4, "a", "later"), (1, 2, "a", 'first "x"\n'), (2, 2, "a", "elsewhere"), (1, 9, None, "none")]
    got = run(spark, calls, results)
    a = got[1, "a"]
    assert (a.status, a.turn, a.result_turn, a.n_calls, a.n_results, a.errors, a.level) == ("linked", 1, 2, 2, 2, "", 0)
    want = {"arguments": {"n": 3, "o": {"a": None, "z": [1, {"a": "é", "b": 1}]}, "q": "ab"}, "id": "a", "name": "f", "result": 'first "x"\n'}
    assert a.json == json.dumps(want, ensure_ascii=False, separators=(",", ":"), sort_keys=True)
    assert got[1, "b"].status == "no result" and got[2, "a"].status == "orphan" and got[1, None].status == "orphan"
    assert got[2, "a"].errors is None and len(got) == 4


def test_schema_errors(spark):
    wrong = {
        '{"q":"a"}': "q: too short", '{"n":1}': "q: missing", '{"q":"zz"}': "q: not allowed", '{"q":5}': "q: not allowed; q: not string",
        '{"q":"ab","n":0}': "n: below minimum", '{"q":"ab","n":10}': "n: above maximum", '{"q":"ab","n":1.5}': "n: not integer",
        '{"q":"ab","n":"3"}': "n: not integer", '{"q":"ab","x":"1"}': "x: not number", '{"q":"ab","x":1e3}': "", '{"q":"ab","x":2}': "",
        '{"q":"ab","o":[]}': "o: not object", '{"q":"ab","b":1}': "b: not boolean", '{"q":"ab","b":true}': "", '{"q":"ab","more":1}': "unknown fields",
        "[]": "no object; q: missing", "{": "no object; q: missing", "": "no object; q: missing", '{"q":null}': "q: not allowed; q: not string",
    }
    calls = [(1, i, str(i), "f", a) for i, a in enumerate(wrong)] + [(1, 99, "u", "g", "{}"), (1, 98, "v", None, None)]
    got = run(spark, calls)
    for i, (a, errors) in enumerate(wrong.items()):
        assert got[1, str(i)].errors == errors, a
    assert got[1, "u"].errors == "unknown tool" and got[1, "v"].errors == "no object; unknown tool"


def test_topological_levels(spark):
    def needing(*ids):
        return json.dumps({"q": "ab", "after": ids})

    chain = [(1, i, f"c{i}", "f", needing(f"c{i + 1}") if i < 5 else needing()) for i in range(6)]
    rest = [
        (1, 10, "both", "f", needing("c0", "c5", "c5")), (1, 11, "x", "f", needing("y")), (1, 12, "y", "f", needing("x")),
        (1, 13, "z", "f", needing("x")), (1, 14, "self", "f", needing("self")), (1, 15, "lost", "f", needing("nowhere")), (2, 1, "c0", "f", needing("c1")),
    ]
    got = run(spark, chain + rest)
    assert [got[1, f"c{i}"].level for i in range(6)] == [5, 4, 3, 2, 1, 0] and got[1, "both"].level == 6
    assert all(got[1, k].level is None and got[1, k].errors == "circle" for k in ("x", "y", "z", "self"))
    assert got[1, "lost"].errors == got[2, "c0"].errors == "unknown reference" and got[1, "lost"].level == 0


def test_no_rows(spark):
    assert run(spark, []) == {}
    assert toolcalls.errors_of(F.lit("f"), F.lit("{}"), {}) is not None
