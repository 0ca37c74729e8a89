import json
import random

import pytest

from offer_engine.llm import chat

EVENTS = (
    "conv_id long, position long, kind string, call_id string, name string, arguments string,"
    " needs array<string>, content string"
)
SCHEMAS = {
    "add": {
        "type": "object",
        "required": ["a", "b"],
        "properties": {"a": {"type": "number"}, "b": {"type": "integer", "minimum": 0}},
        "additionalProperties": False,
    }
}


def call(conv, at, i, args='{"a":1,"b":2}', needs=(), name="add"):
    return (conv, at, "call", i, name, args, list(needs), None)


def result(conv, at, i, content="3"):
    return (conv, at, "result", i, None, None, None, content)


def run(spark, events, schemas=SCHEMAS):
    df = spark.createDataFrame(events, EVENTS)
    return chat.linked_calls(df, schemas).orderBy("conv_id", "place").collect()


def test_links_order_and_json(spark):
    got = run(
        spark,
        [
            result(1, 9, "x"),
            call(1, 1, "z", needs=["x", "y"]),
            call(1, 2, "y", '{"b": 2, "a": 1.50}', needs=["x"]),
            call(1, 3, "x", '{"a": 1e2, "b": -1}'),
            call(2, 1, "x"),
        ],
    )
    assert [(r.conv_id, r.call_id, r.level, r.place, r.status) for r in got] == [
        (1, "x", 0, 0, "linked"),
        (1, "y", 1, 1, "no_result"),
        (1, "z", 2, 2, "no_result"),
        (2, "x", 0, 0, "no_result"),
    ]
    assert got[0].json == (
        '{"arguments":{"a":100,"b":-1},"id":"x","name":"add","needs":[],"result":"3","status":"linked"}'
    )
    assert not got[0].valid and got[0].errors == ["$.b: below 0"]
    assert got[1].valid and '"arguments":{"a":1.5,"b":2}' in got[1].json


def test_edges(spark):
    got = run(
        spark,
        [
            call(1, 1, "a", needs=["b"]),
            call(1, 2, "b", needs=["a"]),
            call(1, 3, "c", needs=["a"]),
            call(1, 4, "d", needs=["nowhere", None, "nowhere"]),
            call(1, 6, "e", None),
            call(1, 5, "e", "{"),
            call(1, 7, None),
            result(1, 8, "lost", None),
            result(1, 9, "d", ""),
            result(1, 10, "d", "later"),
            (None, None, "call", "n", "unknown", '{"a":1,"a":2}', None, None),
            (1, 11, "other", "k", None, None, None, None),
            (None, None, None, None, None, None, None, None),
        ],
    )
    by = {(r.conv_id, r.call_id): r for r in got if r.status not in ("conflict", "other")}
    assert len(got) == 12 and len(by) == 8
    assert sum(r.copies + r.result_copies for r in got) == 13
    assert [by[1, i].status for i in "abc"] == ["cycle"] * 3
    assert by[1, "d"].status == "linked" and by[1, "d"].missing == 1
    assert json.loads(by[1, "d"].json)["result"] == ""
    assert by[1, "e"].copies == 1 and not by[1, "e"].valid and by[1, "e"].position == 5
    assert by[1, None].status == "no_id"
    assert by[1, "lost"].status == "no_call" and json.loads(by[1, "lost"].json)["result"] is None
    assert not by[None, "n"].valid and by[None, "n"].place == 0
    conflicts = {(r.call_id, r.position, r.copies, r.result_copies) for r in got if r.status == "conflict"}
    assert conflicts == {("e", 6, 1, 0), ("d", 10, 0, 1)}
    others = {(r.conv_id, r.call_id): json.loads(r.json) for r in got if r.status == "other"}
    assert others[1, "k"] == {"id": "k", "status": "other", "name": None, "content": None}
    assert set(others) == {(1, "k"), (None, None)}


def test_copies_are_counted(spark):
    events = [call(1, i, "a") for i in range(40)] + [call(1, 3, "a", "{}")] + [result(1, 5, "a")] * 7
    got = run(spark, events + [(1, None, "note", None, "n", None, None, "same")] * 9)
    counts = [(r.status, r.position, r.copies, r.result_copies) for r in got]
    assert counts == [("linked", 0, 40, 7), ("conflict", 3, 1, 0), ("other", None, 9, 0)]


def brute_levels(needs):
    """Level of each call that no circle holds up."""
    found = {}
    while True:
        new = {
            i: 1 + max((found[n] for n in own if n in needs), default=-1)
            for i, own in needs.items()
            if i not in found and all(n in found for n in own if n in needs)
        }
        if not new:
            return found
        found |= new


def test_levels_like_brute_force(spark):
    rng = random.Random(3)
    needs = {}
    for i in range(400):
        # Chains, forks, and some needs that point ahead and close circles.
        own = [f"c{max(0, i - rng.randrange(1, 4))}" for _ in range(rng.choice((0, 1, 1, 1, 1, 2, 3)) if i else 0)]
        needs[f"c{i}"] = own + ([f"c{i + 5}"] if rng.random() < 0.01 else []) + (["none"] if i % 9 == 0 else [])
    needs["self"] = ["self"]
    rows = spark.createDataFrame(list(needs.items()), "id string, needs array<string>")
    got = {r.id: r.level for r in chat.levels(rows).collect()}
    assert got == brute_levels(needs)
    assert len(got) < len(needs)


def test_large_conversations_are_numbered_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(chat, "LARGE", 50)
    monkeypatch.setattr(chat, "CUTS", 8)
    rng = random.Random(4)
    events = [call(1, rng.randrange(20), f"a{i}") for i in range(300)]
    events += [call(1, None, f"n{i}") for i in range(200)]
    events += [call(1, i, f"b{i}", needs=[f"b{i - 1}"]) for i in range(1, 150)]
    events += [call(2, 5, f"x{i}") for i in range(10)]
    got = run(spark, events)
    for conv, n in ((1, 649), (2, 10)):
        own = [r for r in got if r.conv_id == conv]
        assert [r.place for r in own] == list(range(n))
        order = [(r.level, r.position is None, r.position or 0) for r in own]
        assert order == sorted(order)


def test_long_conversation_in_order(spark):
    n = 3000
    events = [call(7, i, str(i), needs=[str(i - 1)] if i % 3 else []) for i in range(n)]
    events += [result(7, n + i, str(i)) for i in range(n)]
    got = run(spark, events)
    assert [r.place for r in got] == list(range(n))
    seen = set()
    for r in got:
        needs = json.loads(r.json)["needs"]
        assert seen.issuperset(needs)
        seen.add(r.call_id)


def brute_lines(turns):
    """Lines of distinct turns (conv, turn, role, text): what is linked, and to what."""
    users = {(c, t): x for c, t, r, x in turns if r == "user" and t is not None}
    results = {}
    for c, t, r, x in sorted((x for x in turns if x[2] in ("assistant", "tool")), key=lambda x: (x[1], x[3] or "")):
        results.setdefault((c, t - 1), x)
    found = set()
    for c, t, r, x in turns:
        if r == "user":
            level, at = 0, t
            while (c, at - 2) in users:
                level, at = level + 1, at - 2
            found.add((c, f"{c}:user:{t}", "linked" if (c, t) in results else "no_result", level, results.get((c, t))))
        elif r == "system":
            found.add((c, f"{c}:system:{t}", "no_result", 0, None))
        elif r in ("assistant", "tool"):
            if (c, t - 1) not in users:
                found.add((c, f"{c}:user:{t - 1}", "no_call", None, x))
        else:
            found.add((c, None, "other", None, None))
    return found


def test_given_table_like_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    turns = [tuple(r) for r in df.collect()]
    lines = chat.linked_calls(chat.from_turns(df), chat.TURN_SCHEMAS).collect()
    got = {(r.conv_id, r.call_id, r.status, r.level, json.loads(r.json).get("result")) for r in lines}
    assert got == brute_lines(turns)
    assert sum(r.copies + r.result_copies for r in lines) == len(turns)


def test_no_turn_is_lost(spark):
    turns = [
        (1, 0, "system", "be kind"),
        (1, 0, "user", "at the same turn"),
        (1, 1, "user", "a  question é"),
        (1, 2, "assistant", "an answer"),
        (1, 3, "user", ""),
        (1, 3, "user", "another text at the same turn"),
        (1, 4, "assistant", None),
        (2, 0, "user", None),
        (2, 1, "tool", "x"),
        (2, 7, "tool", "of no call"),
        (2, 8, "critic", "y" * 200_000),
        (None, None, None, None),
        (None, None, "user", "z"),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    df = df.selectExpr("*", "'kept' AS place", "'kept' AS scope", "'kept' AS kind")
    lines = chat.linked_calls(chat.from_turns(df), chat.TURN_SCHEMAS).collect()
    assert sum(r.copies + r.result_copies for r in lines) == len(turns)
    got = {r.call_id: r for r in lines if r.status not in ("conflict", "other", "no_id")}
    assert set(got) == {"1:system:0", "1:user:0", "1:user:1", "1:user:3", "2:user:0", "2:user:6"}
    assert got["1:user:1"].valid and got["1:user:1"].status == "linked"
    assert json.loads(got["1:user:1"].json)["arguments"] == {"question": "a  question é", "turn": 1, "words": 3}
    assert got["1:user:3"].level == 1 and not got["1:user:3"].valid
    assert json.loads(got["1:user:3"].json)["result"] is None
    assert not got["2:user:0"].valid and json.loads(got["2:user:0"].json)["result"] == "x"
    assert got["2:user:6"].status == "no_call" and got["1:system:0"].valid
    assert sorted(r.status for r in lines if r.call_id not in got) == ["no_id", "other", "other"]
    assert [r.position for r in lines if r.status == "conflict"] == [3]


def test_empty(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize(
    ("value", "text"),
    [
        ({"b": 1, "a": [1.0, 0.1, -2.50]}, '{"a":[1,0.1,-2.5],"b":1}'),
        (1e21, "1e+21"),
        (1e-7, "1e-7"),
        (1.5e-5, "0.000015"),
        (1e20, "100000000000000000000"),
        ("é\n\" ", '"é\\n\\" "'),
        ({"\U0001f600": 1, "￿": 2}, '{"\U0001f600":1,"￿":2}'),
        ([True, None], "[true,null]"),
    ],
)
def test_canonical(value, text):
    assert chat.canonical(value) == text
    assert json.loads(text) == value


@pytest.mark.parametrize("text", ['{"a":1,"a":1}', "NaN", "[1e999]", "{", "[" * 100_000])
def test_refused_json(text):
    assert chat.checked("add", text, SCHEMAS)[1]
