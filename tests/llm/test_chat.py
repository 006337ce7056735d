"""Tool-call linking against the given dialogues and hand-made cases."""

import json

from llm_cases import SMALL

from stockledger.llm import chat, queries


def test_given_conversations(spark):
    turns = {(r.conv_id, r.turn): r for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()}
    got = {(r.conv, r.id): r for r in queries.op9_chat_formatting(spark, SMALL).collect()}
    want = set()
    for (c, t), r in turns.items():
        answer = turns.get((c, t + 1))
        linked = answer is not None and answer.role == "assistant"
        if r.role == "user":
            row = got[c, f"reply:{t}"]
            want.add((c, f"reply:{t}"))
            assert row.status == ("linked" if linked else "unanswered") and row.errors == [] and row.level == 0
            body = json.loads(row.json)
            assert body["arguments"] == {"prompt": r.text, "turn": t} and body.get("result") == (answer.text if linked else None)
            assert list(body) == sorted(body)
        if r.role == "assistant" and (before := turns.get((c, t - 1))) is not None and before.role != "user":
            want.add((c, f"reply:{t - 1}"))
            assert got[c, f"reply:{t - 1}"].status == "orphan"
        if r.role == "assistant" and (c, t - 1) not in turns:
            want.add((c, f"reply:{t - 1}"))
    assert set(got) == want


def call(i, name, arguments, **more):
    return "<tool_call>" + json.dumps({"id": i, "name": name, "arguments": arguments} | more) + "</tool_call>"


def response(i, content):
    return "<tool_response>" + json.dumps({"id": i, "content": content}) + "</tool_response>"


def test_tagged_calls(spark):
    rows = [
        (1, 0, "system", call("a", "find", {"q": "x", "n": 3}) + " and " + call("b", "find", {"n": "many"}, after=["a"])),
        (1, 1, "tool", response("a", "found") + response("z", "nobody asked")),
        (1, 2, "system", call("c", "find", {"q": 1, "extra": True}, after=["b", "a"]) + call("a", "find", {"q": "again"})),
        (1, 3, "system", call("d", "find", {"q": "x"}, after=["e"]) + call("e", "find", {"q": "x"}, after=["d"])),
        (1, 4, "system", call("f", "gone", {}) + "<tool_call>not json</tool_call>"),
        (2, 0, "tool", response("a", "other conversation")),
        (None, 0, "system", call("a", "find", {"z": {"b": 1, "a": [1.5]}, "q": "x"})),
        (3, None, "user", None), (3, 1, None, None), (3, 1, "user", None), (3, 1, "user", None),
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS id", "2 AS level")
    parameters = spark.createDataFrame([("find", "q", "string", True), ("find", "n", "integer", False), ("find", "z", "object", False)], "name string, parameter string, type string, required boolean")
    got = {(r.conv, r.id): r for r in chat.format_conversations(messages, parameters).collect()}
    assert (got[1, "a"].status, got[1, "a"].level, got[1, "a"].errors, got[1, "a"].repeated_calls) == ("linked", 0, [], 1)
    assert (got[1, "b"].status, got[1, "b"].level, got[1, "b"].errors) == ("unanswered", 1, ["missing q", "n is no integer"])
    assert (got[1, "c"].level, got[1, "c"].errors) == (2, ["q is no string", "unknown extra"])
    assert got[1, "d"].status == got[1, "e"].status == "cyclic" and got[1, "d"].level is None
    assert got[1, "f"].errors == ["unknown tool gone"]
    assert got[1, "z"].status == got[2, "a"].status == "orphan"
    assert got[None, "a"].json == '{"arguments":{"q":"x","z":{"a":[1.5],"b":1}},"id":"a","name":"find"}'
    assert got[3, "reply:1"].errors == ["missing prompt"] and got[3, "reply:1"].repeated_calls == 1
    assert chat.format_conversations(messages.limit(0)).collect() == []


def test_turns_of_other_roles_are_context(spark):
    rows = [
        (1, 0, "system", "Be brief."), (1, 1, "user", "Hi"), (1, 2, "assistant", "Hello"), (1, 3, "tool", response("a", "found")),
        (1, 4, None, "who said this"), (None, None, "system", None), (2, 0, "system", "Be kind."), (2, 0, "system", "Be kind."),
        (3, 0, "system", "x"), (3, 0, "system", "x"), (3, 0, "tool", None), (3, 1, "user", "Hi"), (3, 1, "user", "Hi"),
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chat.format_conversations(messages).collect()
    bodies = [(r, json.loads(r.json)) for r in found]
    held = [(r.conv, r.turn - 1, b["context"]) for r, b in bodies if r.status == "unanswered" and "context" in b]
    held += [(r.conv, r.turn - 1, b["context"]) for r, b in bodies if r.status == "linked" and "context" in b]
    assert sorted(h[:2] for h in held) == [(1, 0), (3, 0)]
    own = [(r.conv, r.turn, b["context"]) for r, b in bodies if r.status == "context"]
    got = sorted(((c, t, x.get("role"), x.get("text")) for c, t, x in held + own), key=str)
    assert got == sorted((r for r in rows if r[2] not in ("user", "assistant")), key=str)
    assert all(list(b) == sorted(b) for _, b in bodies)
