"""Tool calls: SQL parity, linking, order, schemas, canonical JSON."""

import json

import pytest

from ordermill.llm import tool_calls as t
from tests.conftest import SF_SMALL
from tests.oracle_check import compare

SCHEMA = "conv_id bigint, turn bigint, role string, tool_calls string, tool_call_id string, content string, level string, salt int"
TOOLS = {"add": {"type": "object", "required": ["a"], "properties": {"a": {"type": ["number", "string"]}, "tags": {
    "type": "array", "items": {"type": "string", "maxLength": 3}}, "mode": {"enum": ["x", "y"]}}, "additionalProperties": False}}


def call(conv, turn, ident, arguments, name="add"):
    raw = arguments if isinstance(arguments, str) or arguments is None else json.dumps(arguments)
    calls = json.dumps([{"id": ident, "function": {"name": name, "arguments": raw}}])
    return (conv, turn, "assistant", calls, None, None, "x", 1)


def result(conv, turn, ident, content):
    return (conv, turn, "tool", None, ident, content, "x", 1)


def linked(spark, rows):
    return t.link_tool_calls(spark.createDataFrame(rows, SCHEMA), TOOLS)


def test_query_equals_sql(spark):
    assert compare(spark, SF_SMALL, ["op5_tool_calls"], verbose=False) == []


def test_linking_and_order(spark):
    rows = [call(1, 5, "late", {"a": "$call:mid"}), call(1, 3, "mid", {"a": "$call:first"}), call(1, 1, "first", {"a": 1.0}),
            result(1, 9, "first", "second answer"), result(1, 2, "first", "answer"),
            call(1, 6, "first", {"a": 2}), call(1, 7, "p", {"a": "$call:q"}), call(1, 8, "q", {"a": "$call:p"}),
            call(1, 10, "gone", {"a": "$call:nobody"}), result(1, 11, "alone", "ö"), call(2, 1, "mid", {"a": "$call:first"})]
    got = {(r.conv_id, r.turn): r for r in linked(spark, rows).collect()}
    assert len(got) == 9
    assert [got[1, n].level for n in (1, 3, 5, 7, 8, 10)] == [0, 1, 2, None, None, 0]
    assert [got[1, n].status for n in (1, 3, 6, 11)] == ["linked", "no_result", "repeated", "no_call"]
    assert got[1, 1].json == '{"arguments":{"a":1},"id":"first","name":"add","result":"answer"}'
    assert got[1, 11].json == '{"arguments":null,"id":"alone","name":null,"result":"ö"}'
    assert got[1, 7].errors == "cycle" and got[1, 10].errors == "no call nobody" and got[2, 1].errors == "no call first"
    assert got[1, 3].valid and not got[1, 7].valid


def test_levels_of_long_chains_and_joins(spark):
    refs = lambda *ids: {"a": 1, "tags": [t.REFERENCE + i for i in ids]}
    rows = [call(1, i, f"c{i}", refs(*([f"c{i - 1}"] if i else []))) for i in range(70)]
    rows += [call(1, 100, "two", refs("c69", "c3")), call(1, 101, "three", refs("two", "c1")), call(1, 102, "after", refs("three")),
             call(1, 103, "x", refs("y")), call(1, 104, "y", refs("z")), call(1, 105, "z", refs("x")), call(1, 106, "tail", refs("x")),
             call(1, 107, "both", refs("x", "c0")), call(1, 108, "self", refs("self"))]
    rows += [call(None, i, f"c{i}", refs(*([f"c{i - 1}"] if i else []))) for i in range(3)]
    got = {(r.conv_id, r.call_id): (r.level, r.errors) for r in linked(spark, rows).collect()}
    assert [got[1, f"c{i}"][0] for i in range(70)] == list(range(70))
    assert [got[1, i][0] for i in ("two", "three", "after")] == [70, 71, 72]
    for i in ("x", "y", "z", "tail", "both", "self"):
        assert got[1, i][0] is None and got[1, i][1].endswith("cycle")
    assert [got[None, f"c{i}"][0] for i in range(3)] == [0, 1, 2]


@pytest.mark.parametrize("arguments,errors", [
    ({"a": 1}, ""), ({}, "/a: required"), ({"a": True}, "/a: type"), ([], "/: type"), ("{", "/: not JSON"), (None, "/: not JSON"),
    ('{"a":1,"a":2}', "/: not JSON"), ('{"a":NaN}', "/: not JSON"), ('{"a":1e999}', "/: not JSON"),
    ({"a": 1, "b": 2}, "/b: unknown"), ({"a": 1, "tags": ["abcd", 3], "mode": "z"}, "/mode: enum; /tags/0: maxLength; /tags/1: type")])
def test_validation(arguments, errors):
    raw = arguments if isinstance(arguments, str) or arguments is None else json.dumps(arguments)
    assert t.check_arguments("add", raw, TOOLS)[1] == errors


def test_canonical_json():
    assert t.canonical(t.strict('{"b": [1.50, 2.0, "\\u00e9\\n"], "a": {"z": null, "ä": true, "Z": -0.0}}')) == \
        '{"a":{"Z":0,"z":null,"ä":true},"b":[1.5,2,"é\\n"]}'
    assert t.check_arguments("none", "{}", TOOLS)[1] == "/: unknown tool"


def test_odd_rows(spark):
    long = "w " * 200_000
    rows = [(None, None, None, None, None, None, None, None), (1, 1, "assistant", "no json", None, None, "x", 1),
            (1, 2, "assistant", None, None, None, "x", 1), call(None, 1, "n", {"a": 1}), result(None, 2, "n", "found"),
            call(3, 1, None, {"a": 1}), result(3, 2, None, "lost"), call(4, 1, "c", {"a": long}), result(4, 2, "c", None),
            call(5, 1, "r", {"a": 1}), call(5, 1, "r", {"a": 1})]
    got = linked(spark, rows).collect()
    by = {}
    for r in got:
        by.setdefault((r.conv_id, r.turn), []).append(r)
    assert by[None, 1][0].status == "linked" and '"result":"found"' in by[None, 1][0].json
    assert by[3, 1][0].status == "no_result" and by[3, 2][0].status == "no_call"
    assert by[4, 1][0].status == "linked" and len(by[4, 1][0].json) > 400_000
    assert [r.status for r in by[5, 1]] == ["no_result", "no_result"]
    assert linked(spark, []).collect() == []


@pytest.mark.parametrize("raw,text", [
    ("1e-7", "1e-7"), ("0.00001", "0.00001"), ("1E-05", "0.00001"), ("0.000001", "0.000001"), ("1e16", "10000000000000000"),
    ("10000000000000000", "10000000000000000"), ("1e20", "100000000000000000000"), ("1e21", "1e+21"), ("1000000000000000000000", "1e+21"),
    ("123456789012345678901234", "123456789012345678901234"), ("-0.0", "0"), ("-1.50", "-1.5"), ("100", "100"), ("1e2", "100"), ("12.5e1", "125"),
    ("5e-324", "5e-324"), ("1.7976931348623157e308", "1.7976931348623157e+308"), ("333333333.33333329", "333333333.3333333")])
def test_equal_numbers_have_one_text(raw, text):
    assert t.canonical(t.strict(raw)) == text


@pytest.mark.parametrize("schema,good,bad", [
    ({"pattern": "^a+$"}, ["aa", 1], ["ab"]), ({"const": 1}, [1, 1.0], [True, 2]), ({"enum": [False, None]}, [False, None], [0]),
    ({"anyOf": [{"type": "string"}, {"minimum": 3}]}, ["x", 3], [2]), ({"oneOf": [{"minimum": 3}, {"maximum": 5}]}, [2, 6], [4]),
    ({"allOf": [{"minimum": 3}, {"maximum": 5}]}, [4], [2, 6]), ({"not": {"type": "null"}}, [1], [None]),
    ({"exclusiveMinimum": 1, "exclusiveMaximum": 2}, [1.5], [1, 2]), ({"multipleOf": 0.1}, [0.3, 2], [0.25]),
    ({"minItems": 1, "maxItems": 2, "uniqueItems": True}, [[1], [1, "1"], [True, 1]], [[], [1, 1.0], [1, 2, 3]]),
    ({"minProperties": 1, "maxProperties": 1}, [{"a": 1}], [{}, {"a": 1, "b": 1}]),
    ({"properties": {"a": True}, "additionalProperties": {"type": "integer"}}, [{"a": "x", "b": 1}], [{"b": "x"}]),
    ({"patternProperties": {"^n_": {"type": "number"}}, "additionalProperties": False}, [{"n_a": 1}], [{"n_a": "x"}, {"m": 1}]),
    ({"$ref": "#/$defs/tree", "$defs": {"tree": {"type": "object", "properties": {"next": {"$ref": "#/$defs/tree"}, "v": {"type": "integer"}}}}},
     [{"next": {"next": {"v": 1}}}], [{"next": {"next": {"v": "x"}}}, {"next": 1}])])
def test_schema_keywords(schema, good, bad):
    t.check_schema(schema)
    assert all(t.violations(v, schema) == [] for v in good) and all(t.violations(v, schema) for v in bad)


def test_unknown_keywords_are_refused(spark):
    for schema in ({"contains": {}}, {"properties": {"a": {"if": {}}}}, {"$ref": "#/nowhere"}, {"$ref": "http://other"}):
        with pytest.raises(ValueError):
            t.check_schema(schema)
