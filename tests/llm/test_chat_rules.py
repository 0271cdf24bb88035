"""Validation, canonical JSON, levels and statuses of hand-made calls."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from helmtrack.llm import chat

SCHEMAS = {
    "tool": {
        "n": {"type": "integer", "minimum": 2, "maximum": 5},
        "x": {"type": "number", "minimum": 0.5},
        "s": {"type": "string", "required": True, "min_length": 2, "max_length": 3},
        "b.c": {"type": "string", "enum": ["x", "z"]},
        "f": {"type": "boolean"},
        "o": {"type": "object"},
        "a": {"type": "array"},
    },
    "bare": {},
}
CASES = [
    ('{"s": "ab"}', [], '{"s":"ab"}'),
    ('{"s": "ab", "n": 12.0e-1}', ["n: not integer", "n: too small"], '{"n":1.2,"s":"ab"}'),
    ('{"s": "ab", "n": 3.0}', [], '{"n":3,"s":"ab"}'),
    ('{"s": "ab", "n": 3e0}', [], '{"n":3,"s":"ab"}'),
    ('{"s": "ab", "n": 0.3E1, "x": 1}', [], '{"n":3,"s":"ab","x":1}'),
    ('{"s": "ab", "n": 6}', ["n: too large"], '{"n":6,"s":"ab"}'),
    ('{"s": "ab", "n": "3"}', ["n: not integer"], '{"n":"3","s":"ab"}'),
    ('{"s": "ab", "x": 0.25}', ["x: too small"], '{"s":"ab","x":0.25}'),
    ('{"s": "abcd"}', ["s: too long"], '{"s":"abcd"}'),
    ('{"s": "é"}', ["s: too short"], '{"s":"é"}'),
    ('{"n": 3}', ["s: missing"], '{"n":3}'),
    ('{"s": null}', ["s: not string"], '{"s":null}'),
    ('{"s": "ab", "b.c": "y"}', ["b.c: not allowed"], '{"b.c":"y","s":"ab"}'),
    ('{"s": "ab", "b.c": "z"}', [], '{"b.c":"z","s":"ab"}'),
    ('{"s": "ab", "b": {"c": "y"}}', [], '{"b":{"c":"y"},"s":"ab"}'),
    ('{"s": "ab", "f": 1, "o": [], "a": {}}', ["a: not array", "f: not boolean", "o: not object"], '{"a":{},"f":1,"o":[],"s":"ab"}'),
    ('{"s": "ab", "f": true, "o": {}, "a": [1.50, -0.0, 2E2, 1e-3]}', [], '{"a":[1.5,0,200,0.001],"f":true,"o":{},"s":"ab"}'),
    ('[1, 2]', ["arguments: not an object"], "[1,2]"),
    ('{"s": ', ["arguments: not an object"], None),
    (None, ["arguments: not an object"], None),
]


def test_each_rule_and_the_canonical_form(spark):
    calls = spark.createDataFrame([("c", f"k{i}", None, "tool", text, "clash") for i, (text, *_) in enumerate(CASES)], "conv_id string, call_id string, after_id string, name string, arguments string, parsed string")
    got = {r.call_id: r for r in chat.validated(calls, SCHEMAS).collect()}
    for i, (text, errors, canonical) in enumerate(CASES):
        row = got[f"k{i}"]
        assert sorted(row.errors) == sorted(errors), text
        assert row.canonical_arguments == canonical, text
    other = spark.createDataFrame([("c", "u", None, "what", "{}"), ("c", "n", None, None, "{}"), ("c", "e", None, "bare", '{"q": 1}')], "conv_id string, call_id string, after_id string, name string, arguments string")
    assert {r.call_id: r.errors for r in chat.validated(other, SCHEMAS).collect()} == {"u": ["unknown tool"], "n": ["unknown tool"], "e": []}


NUMBERS = ["1e0", "1.0", "1", "10.00", "1E1", "1e10", "10000000000", "12345678901234567890.0", "1e25", "0.1", "1e-1", "0.10", "1e-7", "0.0000001", "-2.50", "-25e-1", "0", "-0.0", "0e5", "1.5e300", "123456789.123456789"]


def test_equal_numbers_are_written_alike_and_keep_their_value(spark):
    texts = ['{"k":"1.0 \\" 2E5 {3.0}","v":[' + n + ',{"w":' + n + "}]}" for n in NUMBERS]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(2)
    got = {r.i: r.c for r in df.select("i", chat.canonical(F.col("t")).alias("c")).collect()}
    written = {}
    for i, n in enumerate(NUMBERS):
        assert json.loads(got[i], parse_int=float) == json.loads(texts[i], parse_int=float)
        assert got[i].startswith('{"k":"1.0 \\" 2E5 {3.0}","v":[')
        written.setdefault(float(n), set()).add(got[i])
    assert all(len(forms) == 1 for value, forms in written.items() if abs(value) < 1e19)


def test_levels_cycles_and_statuses(spark):
    good = '{"s": "ab"}'
    calls = [
        ("c", "a", None, "tool", good),
        ("c", "b", "a", "tool", good),
        ("c", "d", "b", "tool", '{"s": ""}'),
        ("c", "e", "gone", "tool", good),
        ("c", "l1", "l2", "tool", good),
        ("c", "l2", "l1", "tool", good),
        ("c", "after", "l1", "tool", good),
        ("c", "self", "self", "tool", good),
        ("c2", "b", "a", "tool", good),
        ("c", "b", "a", "tool", '{"s": "zz"}'),
        (None, "a", None, "tool", good),
        ("c", None, None, "tool", good),
        *[("long", f"n{i}", f"n{i - 1}" if i else None, "bare", "{}") for i in range(40)],
    ]
    results = [("c", "a", "first"), ("c", "a", "second"), ("c", "b", "x"), ("c", "d", "x"), ("c", "l1", "x"), ("c", "lost", None), (None, "a", "x")]
    found = chat.link_tool_calls(
        spark.createDataFrame(calls, "conv_id string, call_id string, after_id string, name string, arguments string").withColumn("level", F.lit("clash")).repartition(3),
        spark.createDataFrame(results, "conv_id string, call_id string, content string").withColumn("status", F.lit("clash")),
        SCHEMAS,
    )
    got = {(r.conv_id, r.call_id): r for r in found.collect()}
    assert len(got) == found.count() == 50
    say = lambda k, conv="c": (got[conv, k].level, got[conv, k].status, got[conv, k].n_calls, got[conv, k].n_results)
    assert say("a") == (0, "linked", 1, 2) and say("b") == (1, "linked", 2, 1) and say("d") == (2, "invalid", 1, 1) and say("e") == (0, "pending", 1, 0)
    assert say("l1")[:2] == say("l2")[:2] == say("self")[:2] == say("after")[:2] == (None, "cyclic") and say("lost") == (None, "orphan", 0, 1) and say("b", "c2") == (0, "pending", 1, 0)
    assert [got["long", f"n{i}"].level for i in range(40)] == list(range(40))
    assert json.loads(got["c", "a"].record) == {"after": None, "arguments": {"s": "ab"}, "id": "a", "level": 0, "name": "tool", "result": "first"}
    assert json.loads(got["c", "lost"].record)["result"] is None


@pytest.mark.parametrize("which", [0, 1])
def test_no_calls_or_no_results(spark, which):
    calls = spark.createDataFrame([("c", "a", None, "bare", "{}")], "conv_id string, call_id string, after_id string, name string, arguments string")
    results = spark.createDataFrame([("c", "a", "x")], "conv_id string, call_id string, content string")
    frames = [calls, results]
    frames[which] = frames[which].limit(0)
    assert [r.status for r in chat.link_tool_calls(*frames, SCHEMAS).collect()] == [["orphan"], ["pending"]][which]
    assert chat.link_tool_calls(calls.limit(0), results.limit(0), SCHEMAS).count() == 0
