import json

from pyspark.sql import functions as F

from tidemark.llm import chat, queries

TOOLS = [("f", "a", "integer", True, None), ("f", "b", "string", False, ["x", "y"]), ("f", "c", "object", False, None), ("f", "d", "number", False, None)]


def link(spark, calls, results=()):
    out = chat.link_calls(
        spark.createDataFrame(list(calls), chat.CALLS), spark.createDataFrame(list(results), chat.RESULTS), spark.createDataFrame(TOOLS, chat.TOOLS)
    )
    return out.collect()


def call(call_id, arguments='{"a":1}', after=None, turn=1, name="f", conv=1):
    return (conv, call_id, turn, name, arguments, after)


def test_arguments_against_schemas(spark):
    cases = {
        "ok": ('{"a":1}', ""),
        "all": ('{"d":1.5,"c":{"z":1,"y":[1,{"k":2,"j":null}]},"b":"x","a":2}', ""),
        "missing": ("{}", "missing a"),
        "type": ('{"a":"1","b":2}', "type a; type b"),
        "null": ('{"a":null}', "type a"),
        "choice": ('{"a":1,"b":"z"}', "choice b"),
        "extra": ('{"a":1,"q":1,"p":2}', "extra p; extra q"),
        "broken": ('{"a":', "not an object"),
        "array": ("[1]", "not an object"),
        "twice": ('{"a":1,"a":2}', "not an object"),
        "none": (None, "not an object"),
    }
    got = {r.call_id: r for r in link(spark, [call(k, v[0]) for k, v in cases.items()] + [call("tool", name="g")])}
    assert {k: got[k].errors for k in cases} == {k: v[1] for k, v in cases.items()}
    assert got["tool"].errors == "unknown tool"
    assert got["all"].json == '{"arguments":{"a":2,"b":"x","c":{"y":[1,{"j":null,"k":2}],"z":1},"d":1.5},"id":"all","name":"f","type":"call"}'


def test_links_and_order(spark):
    n = 300
    calls = [call(f"k{i}", after=f"k{i - 1}" if i else None, turn=n - i) for i in range(n)]
    calls += [call("x", after="y"), call("y", after="z"), call("z", after="y"), call("w", after="gone"), call("k0", '{"a":9}', turn=9999), call("own", after="own")]
    calls += [call(None), call("x", after="y")]
    results = [(1, "k5", 2, "r"), (1, "k5", 3, "r2"), (1, "k5", 2, "r"), (2, "k5", 1, "other"), (1, None, 1, None), (1, "x", 4, "late")]
    rows = link(spark, calls, results)
    level = {r.call_id: r.level for r in rows if r.kind == "call" and r.status != "duplicate"}
    assert all(level[f"k{i}"] == i for i in range(n))
    assert all(level[c] is None for c in ("x", "y", "z", "own")) and level["w"] == 0
    errors = {r.call_id: r.errors for r in rows if r.kind == "call"}
    assert errors["x"] == errors["own"] == "cycle" and errors["w"] == "dangling"
    status = sorted((r.call_id or "", r.status) for r in rows if r.kind == "result")
    assert status == [("", "orphan"), ("k5", "linked"), ("k5", "linked"), ("k5", "orphan"), ("x", "linked")]
    assert {r.status for r in rows if r.call_id == "k0"} == {"duplicate", "unanswered"}
    assert [r.status for r in rows if r.call_id == "k5" and r.kind == "call"] == ["answered"]
    linked = [r for r in rows if r.call_id == "k5" and r.status == "linked"]
    assert all(r.level == 5 and json.loads(r.json)["id"] == "k5" for r in linked)


def test_conversations(spark):
    text = "x" * 200_000 + '"\n\té\u0001'
    rows = [(1, 0, "system", "s"), (1, 1, "user", text), (1, 2, "assistant", None), (1, 3, "user", ""), (1, 3, "user", ""), (1, 5, "assistant", "o")]
    rows += [(2, 0, None, "t"), (None, 1, "user", "u"), (3, None, "user", "v")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("level", F.lit(1))
    calls, results = chat.from_conversations(turns)
    got = {(r.conv_id, r.turn): r for r in chat.link_calls(calls, results, spark.createDataFrame(chat.CONVERSATION_TOOLS, chat.TOOLS)).collect()}
    assert len(got) == 8
    assert [got[1, t].level for t in (0, 1, 2, 3)] == [0, 1, 1, 2] and got[1, 5].status == "orphan"
    assert json.loads(got[1, 1].json)["arguments"] == {"prompt": text, "turn": 1} and got[1, 1].errors == ""
    assert got[None, 1].status == "unanswered" and got[3, None].status == "orphan"
    empty = turns.limit(0)
    calls, results = chat.from_conversations(empty)
    assert chat.link_calls(calls, results, spark.createDataFrame(chat.CONVERSATION_TOOLS, chat.TOOLS)).count() == 0


def test_query_counts(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet").count()
    assert queries.op4_tool_calls(spark, sf).count() == turns


def test_no_python_in_the_plan(spark, sf, capsys):
    queries.op4_tool_calls(spark, sf).explain()
    assert "Python" not in capsys.readouterr().out
