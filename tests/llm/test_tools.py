import json

import pytest

from termshard.llm import tool_calls

CALLS = "conv_id bigint, turn bigint, call_id string, name string, arguments string, needs array<string>"
RESULTS = "conv_id bigint, turn bigint, call_id string, content string"
SCHEMA = "name string, field string, type string, required boolean"


def call(conv, turn, id_, needs=(), name="f", arguments='{"x": 1}'):
    return (conv, turn, id_, name, arguments, list(needs))


@pytest.fixture(scope="module")
def schemas(spark):
    rows = [("f", "x", "integer", True), ("f", "s", "string", False), ("g", "n", "number", False), ("g", "a", "array", False),
            ("g", "o", "object", False), ("g", "b", "boolean", False)]
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return {(r["conv_id"], r["call_id"]): r for r in df.collect()}


def test_calls_meet_their_results(spark, schemas):
    calls = [call(1, 0, "a"), call(1, 2, "b"), call(1, 4, "a"), call(2, 0, "a"), call(None, 0, "a"), call(3, 0, None), call(1, 2, "b")]
    results = [(1, 1, "a", "first"), (1, 5, "a", "second"), (2, 1, "b", "stray"), (None, 1, "a", "none"), (1, 3, None, "none")]
    got = rows_of(tool_calls.tool_records(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), schemas))
    assert set(got) == {(1, "a"), (1, "b"), (2, "a")}
    assert (got[1, "a"]["result"], got[1, "a"]["n_calls"], got[1, "a"]["n_results"], got[1, "a"]["turn"]) == ("first", 2, 2, 0)
    assert (got[1, "b"]["result"], got[1, "b"]["n_calls"], got[1, "b"]["n_results"]) == (None, 2, 0)
    assert json.loads(got[1, "a"]["record"]) == {"arguments": {"x": 1}, "id": "a", "name": "f", "result": "first"}


def test_order_respects_needs(spark):
    calls = [call(1, i, f"c{i}", [f"c{i - 1}", f"c{i - 2}", "gone"]) for i in range(12)]  # already in order
    calls += [call(2, 0, "a", ["b"]), call(2, 1, "x", ["a"]), call(2, 5, "b", ["c"]), call(2, 5, "c"), call(2, 9, "z", ["x"])]
    calls += [call(3, 0, "p", ["q"]), call(3, 1, "q", ["p"]), call(3, 2, "r", ["q"]), call(3, 3, "s"), call(3, 4, "t", ["t"])]
    got = rows_of(tool_calls.ordered(spark.createDataFrame(calls, CALLS)))
    assert len(got) == len(calls)
    assert all((got[1, f"c{i}"]["position"], got[1, f"c{i}"]["hops"]) == (i, 0) for i in range(12))
    at = {k: (r["position"], r["hops"]) for k, r in got.items()}
    for conv, _, id_, _, _, needs in calls:
        for n in needs:
            if conv != 3 and (conv, n) in at:
                assert at[conv, n] < at[conv, id_]
    assert at[2, "z"] == (9, 0)
    assert {k for k, v in at.items() if v[0] is None} == {(3, "p"), (3, "q"), (3, "r"), (3, "t")}


@pytest.mark.parametrize(
    ("name", "arguments", "errors"),
    [
        ("f", '{"x": 3, "s": "t"}', []),
        ("f", '{"x": "3"}', ["type x"]),
        ("f", '{"s": 1, "y": 2}', ["missing x", "type s", "unknown y"]),
        ("f", None, ["no object"]),
        ("f", "", ["no object"]),
        ("f", "[1]", ["no object"]),
        ("f", '{"x": ', ["no object"]),
        ("h", '{"x": 3}', ["no schema"]),
        (None, '{"x": 3}', ["no schema"]),
        ("g", '{"n": 1.5, "a": [1], "o": {"k": 1}, "b": true}', []),
        ("g", '{"n": 2, "a": [], "o": {}, "b": 1}', ["type b"]),
        ("g", "{}", []),
    ],
)
def test_arguments_are_checked(spark, schemas, name, arguments, errors):
    calls = spark.createDataFrame([call(1, 0, "a", (), name, arguments)], CALLS)
    row = tool_calls.checked(calls, schemas).first()
    assert row["errors"] == errors and row["valid"] == (not errors)


def test_records_are_canonical(spark, schemas):
    texts = ['{"b": {"z": 1, "a": [1, 2.5, null]}, "a": "\\u00e9\\n"}', '{ "a":"é\\n" , "b":{"a":[1,2.5,null],"z":1} }', "no json"]
    calls = spark.createDataFrame([call(1, i, str(i), (), "f", t) for i, t in enumerate(texts)], CALLS)
    got = rows_of(tool_calls.tool_records(calls, spark.createDataFrame([], RESULTS), schemas))
    record = '{"arguments":{"a":"é\\n","b":{"a":[1,2.5,null],"z":1}},"id":"%s","name":"f","result":null}'
    assert got[1, "0"]["record"] == record % 0 and got[1, "1"]["record"] == record % 1
    assert json.loads(got[1, "2"]["record"])["arguments"] == "no json"


def test_no_calls(spark, schemas):
    none = spark.createDataFrame([], CALLS)
    assert tool_calls.tool_records(none, spark.createDataFrame([], RESULTS), schemas).count() == 0


def test_turns_with_nulls(spark, schemas):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", None), (1, None, "user", "x"), (None, 0, "user", "x"), (2, 0, None, "x")]
    calls, results = tool_calls.turns_as_calls(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string"))
    got = rows_of(tool_calls.tool_records(calls, results, schemas))
    assert set(got) == {(1, "c0"), (1, "c2")} and got[1, "c0"]["result"] == "a"
