import json

from weblode.llm import chat

SCHEMAS = {"add": {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": ["number", "null"]}}, "additionalProperties": False}}
CALLS = [
    ("c1", 1, 0, "x1", "add", '{"b": 2.0, "a": 1}', None),
    ("c1", 2, 0, "x2", "add", '{"a": -1, "z": 0}', ["x3", "gone"]),  # needs a later one
    ("c1", 3, 0, "x3", "add", "not json", ["x1"]),
    ("c2", 1, 0, "y1", "sub", "{}", ["y2"]),  # a circle
    ("c2", 1, 1, "y2", "add", '{"a": true}', ["y1"]),
    ("c2", 1, 2, "y3", "add", '{"a": 3}', ["y3"]),
    ("c3", 1, 0, "z1", "add", '{"a": 1}', []),
    ("c3", 2, 0, "z2", "add", '{"a": 1e400}', ["z1", "z1"]),
    ("c3", 2, 0, "z1", "add", '{"a": 9}', None),
    ("c3", 1, 0, "z1", "add", '{"a": 1}', []),
    ("c3", None, None, None, None, None, None),
]
RESULTS = [("x1", 2, "one"), ("x1", 1, "first"), ("x1", 1, "first"), ("z2", 3, None), ("who", 1, "lost"), (None, 1, "no id"), ("y1", 2, "é")]


def frames(spark, calls=CALLS, results=RESULTS):
    messages = spark.createDataFrame([("c1", 0, "user", 'say "é"', 1), ("c1", None, None, None, 2)], "conv_id string, turn int, role string, content string, level int")
    return (
        messages,
        spark.createDataFrame(calls, "conv_id string, turn int, position int, call_id string, name string, arguments string, needs array<string>"),
        spark.createDataFrame(results, "call_id string, turn int, content string"),
    )


def test_links_order_and_faults(spark):
    rows = chat.chat_lines(*frames(spark), SCHEMAS).collect()
    assert len(rows) == 2 + len(CALLS) + len(RESULTS)
    calls = {r.call_id: r for r in rows if r.kind == "call" and r.status not in ("repeated", "no id")}
    assert {k: r.status for k, r in calls.items()} == {"x1": "linked", "x2": "unanswered", "x3": "unanswered", "y1": "cycle", "y2": "cycle", "y3": "cycle", "z1": "unanswered", "z2": "linked"}
    assert [calls[k].level for k in ("x1", "x3", "x2")] == [0, 1, 2] and calls["z2"].level == 0
    assert calls["x1"].errors == [] and calls["x2"].errors == ["$.a: out of bounds", "$.z: not known"] and calls["x3"].errors == ["$: not JSON"]
    assert calls["y1"].errors == ["$: no such tool"] and calls["y2"].errors == ["$.a: not integer"] and calls["z2"].errors != []
    assert calls["x1"].line == '{"role":"assistant","tool_calls":[{"function":{"arguments":"{\\"a\\":1,\\"b\\":2}","name":"add"},"id":"x1","type":"function"}]}'
    assert sorted(r.status for r in rows if r.kind == "call" and r.call_id in ("z1", None)) == ["no id", "repeated", "repeated", "unanswered"]
    results = sorted((str(r.call_id), json.loads(r.line)["content"], r.status) for r in rows if r.kind == "result")
    want = [("None", "no id", "orphan"), ("who", "lost", "orphan"), ("x1", "first", "linked"), ("x1", "first", "repeated"), ("x1", "one", "repeated"), ("y1", "é", "linked"), ("z2", "", "linked")]
    assert results == want
    assert {r.line for r in rows if r.kind == "message"} == {'{"content":"say \\"é\\"","role":"user"}', '{"content":"","role":"user"}'}


def test_long_forward_chain_and_empty_tables(spark):
    chain = [("c", i, 0, f"k{i}", "add", '{"a":0}', [f"k{i + 1}"]) for i in range(12)] + [("c", 12, 0, "k12", "add", '{"a":0}', None)]
    rows = chat.chat_lines(*frames(spark, chain, [("k0", 0, "x")]), SCHEMAS).where("kind = 'call'").collect()
    assert {r.call_id: r.level for r in rows} == {f"k{i}": 12 - i for i in range(13)}
    messages, calls, results = frames(spark, [], [("k0", 0, "x")])
    assert chat.chat_lines(messages.limit(0), calls, results.limit(0), SCHEMAS).count() == 0


def test_query_equals_plain_version(spark):
    import pyarrow.dataset as ds

    from weblode.llm import queries

    base = "/root/testdata/sf0.001"
    turns = ds.dataset(f"{base}/conversations.parquet").to_table().to_pylist()
    answered = {(t["conv_id"], t["turn"] - 1) for t in turns if t["role"] == "assistant"}
    asked = {(t["conv_id"], t["turn"]) for t in turns if t["role"] == "user"}
    want = []
    for t in turns:
        key, text = (t["conv_id"], t["turn"]), t["text"]
        if t["role"] != "assistant":
            want.append((str(key[0]), key[1], "message", "kept", chat.canonical({"role": t["role"], "content": text})))
        if t["role"] == "user":
            call = {"id": f"{key[0]}-{key[1]}", "type": "function", "function": {"name": "answer", "arguments": chat.canonical({"turn": key[1], "text": text})}}
            want.append((str(key[0]), key[1], "call", "linked" if key in answered else "unanswered", chat.canonical({"role": "assistant", "tool_calls": [call]})))
        if t["role"] == "assistant":
            of = (key[0], key[1] - 1)
            line = chat.canonical({"role": "tool", "tool_call_id": f"{of[0]}-{of[1]}", "content": text})
            want.append((str(key[0]) if of in asked else None, key[1], "result", "linked" if of in asked else "orphan", line))
    got = [(r.conv_id, r.turn, r.kind, r.status, r.line) for r in queries.op8(spark, base).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
