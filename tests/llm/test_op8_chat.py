import json
import random

from sluicebox.llm import chat, queries
from sluicebox.llm.chat import link_tool_calls

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id long, call_id string, turn long, content string"
KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict}


def errors_of(name, text, tools):
    try:
        arguments = json.loads(text)
    except (TypeError, ValueError):
        return ["not JSON"]
    if not isinstance(arguments, dict):
        return ["not an object"]
    if name not in tools:
        return ["unknown tool"]
    found = []
    for field, (kind, required) in sorted(tools[name].items()):
        if field not in arguments:
            found += [f"{field}: missing"] * required
        elif not isinstance(arguments[field], KINDS[kind]) or (kind in ("integer", "number") and isinstance(arguments[field], bool)):
            found.append(f"{field}: not of kind {kind}")
    return found + [f"{field}: unknown" for field in sorted(arguments) if field not in tools[name]]


def levels_of(calls):
    """By key; None in a cycle and behind one."""
    needs = {(c, i): {(c, d) for d in deps or ()} for c, i, deps in calls}
    needs = {key: {d for d in deps if d in needs} for key, deps in needs.items()}
    found, level = {}, 0
    while ready := [key for key, deps in needs.items() if key not in found and deps <= set(found)]:
        found |= dict.fromkeys(ready, level)
        level += 1
    return {key: found.get(key) for key in needs}


def check(calls, results, found):
    tools = chat.TOOLS
    by_key = {}
    for conv, call, turn, name, arguments, deps in calls:
        by_key.setdefault((conv, call), []).append((turn, name, arguments, deps))
    answers = {}
    for conv, call, turn, content in results:
        answers.setdefault((conv, call), []).append((turn, content))
    level = levels_of([(*key, sorted(rows, key=str)[0][3]) for key, rows in by_key.items()])
    assert len(found) == len({(row.conv_id, row.call_id) for row in found}) and {(r.conv_id, r.call_id) for r in found} == by_key.keys() | answers.keys()
    for row in found:
        key = row.conv_id, row.call_id
        assert (row.n_calls, row.n_results) == (len(by_key.get(key, ())), len(answers.get(key, ())))
        record = json.loads(row.record)
        assert row.record == json.dumps(record, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        answer = min(answers[key]) if key in answers else (None, None)
        assert (record.get("result_turn"), record.get("result")) == answer
        if key not in by_key:
            assert (row.status, row.level, row.errors) == ("orphan", None, None)
            continue
        turn, name, arguments, _ = sorted(by_key[key], key=str)[0]
        assert (row.turn, row.name, row.level) == (turn, name, level[key])
        assert row.errors == errors_of(name, arguments, tools)
        if row.errors == ["not JSON"]:
            assert record.get("arguments_text") == arguments
        else:
            assert record["arguments"] == json.loads(arguments)
        late = answer[0] is not None and answer[0] < turn
        expected = "cycle" if level[key] is None else "unanswered" if answer[0] is None else "early" if late else "answered"
        assert row.status == expected


def test_query_equals_brute_force(spark):
    found = queries.op8_tool_calls(spark, "/root/testdata/sf0.01").collect()
    calls, results = chat.calls_of(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))
    check([tuple(row) for row in calls.collect()], [tuple(row) for row in results.collect()], found)
    assert {row.level for row in found} == {None, 0, 1, 2, 3} and {"cycle", "orphan", "answered"} <= {row.status for row in found}
    assert {len(row.depends_on) for row in calls.collect()} == {1, 2, 3}
    messages = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").groupBy("role").count().collect()
    # Every message is in a record: calls, their results, and those of other roles on their own.
    kept = {row.role: row["count"] for row in messages}
    assert sum(row.n_calls for row in found) == kept["user"] and sum(row.n_results for row in found) == sum(kept.values()) - kept["user"]
    wrong = {error for row in found for error in row.errors or ()}
    assert wrong == {"not JSON", "query: missing", "limit: not of kind integer"}


def test_links_orders_and_errors(spark):
    good = '{"turn": 3, "query": "q\\u00e9 \\"x\\"", "limit": 5}'
    calls = [
        (1, "a", 1, "search", good, ["c"]),
        (1, "b", 1, "search", '{"query": 5, "limit": 1.5, "z": null}', []),
        (1, "c", 2, "translate", '{"query": "", "target": true}', ["b", "b", "nowhere"]),
        (1, "d", 3, "search", "[1]", ["a", "c"]),
        (1, "x", 4, "search", good, ["y"]),
        (1, "y", 4, "search", good, ["z"]),
        (1, "z", 4, "search", good, ["x"]),
        (1, "behind", 5, "summarise", '{"query":"q","limit":null}', ["x"]),
        (2, "a", 9, "unheard", "{}", ["a"]),
        (3, "a", 7, None, None, None),
        (3, "twice", 8, "search", good, []),
        (3, "twice", 6, "search", "{", []),
    ]
    results = [(1, "a", 5, "first"), (1, "a", 7, "second"), (1, "b", 0, "early"), (2, "a", 10, ""), (4, "none", 1, "orphan"), (3, "a", 9, None)]
    found = link_tool_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS)).collect()
    check(calls, results, found)
    assert {row.call_id: row.level for row in found if row.conv_id == 1} == {
        "b": 0, "c": 1, "a": 2, "d": 3, "x": None, "y": None, "z": None, "behind": None
    }


def test_edges(spark):
    calls = spark.createDataFrame([(None, "a", 1, "search", "{}", []), (1, None, 1, "search", "{}", ["a"])], CALLS)
    results = spark.createDataFrame([(None, "a", 2, "x"), (1, None, 2, "y")], RESULTS)
    found = link_tool_calls(calls.selectExpr("*", "1 AS status"), results.selectExpr("*", "1 AS level"))
    assert sorted((row.status, row.level) for row in found.collect()) == [("orphan", None)] * 2 + [("unanswered", None)] * 2
    assert link_tool_calls(calls.limit(0), results.limit(0)).collect() == []
    assert [row.status for row in link_tool_calls(calls.limit(0), results.limit(1)).collect()] == ["orphan"]
    odd = spark.createDataFrame([(1, 0, None, None), (1, 1, "user", None), (1, 1, "user", None), (None, 3, "assistant", "x")], "conv_id long, turn long, role string, text string")
    assert link_tool_calls(*chat.calls_of(odd)).count() == 3


def test_no_python(spark):
    plan = queries.op8_tool_calls(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_chains_forks_and_cycles_are_ordered(spark):
    rows = [(1, f"c{i}", [f"c{i + 1}"]) for i in range(37)] + [(1, "x", ["c3", "c30"]), (1, "y", ["x"]), (1, "z", ["y", "c0", "c0"])]
    rows += [(2, f"r{i}", [f"r{(i + 1) % 5}"]) for i in range(5)] + [(2, "tail", ["r2"]), (2, "fork", ["tail", "end"]), (2, "end", []), (2, "self", ["self"])]
    random.seed(6)
    rows += [(3, f"n{i}", [f"n{k}" for k in random.sample(range(i), min(i, random.choice([0, 1, 1, 2, 3])))]) for i in range(60)]
    calls = spark.createDataFrame([(c, i, 0, "search", "{}", deps) for c, i, deps in rows], CALLS)
    assert {(row.conv_id, row.call_id): row.level for row in chat.levels(calls).collect()} == levels_of(rows)


def test_plans_and_rounds_do_not_grow_with_the_depth(spark, monkeypatch):
    """Dependencies that others imply take no rounds; where rounds are needed, their plans stay as large as they are."""
    written = []
    monkeypatch.setattr(chat, "stored", lambda df, name, store=chat.stored: written.append(name) or store(df, name))

    def found(rows):
        written.clear()
        calls = spark.createDataFrame([(c, i, turn, "search", "{}", deps) for c, i, turn, deps in rows], CALLS)
        level = chat.levels(calls)
        assert {(row.conv_id, row.call_id): row.level for row in level.collect()} == levels_of([(c, i, deps) for c, i, _, deps in rows])
        return len(written), level._jdf.queryExecution().optimizedPlan().toString().count("Relation")

    back = [(1, f"c{i}", i, [f"c{i - 1}", f"c{i - 3}", f"c{i - 4}"]) for i in range(130)] + [(2, f"c{i}", i, [f"c{(i + 1) % 9}", f"c{i - 2}"]) for i in range(9)]
    assert found(back)[0] < 100
    pairs = [(1, f"{side}{i}", i, [f"a{i - 1}", f"b{i - 1}"]) for side in "ab" for i in range(12)]
    (few, small), (many, large) = found([row for row in pairs if row[2] < 4]), found(pairs)
    assert 8 <= many - few < 16 and small == large  # a round writes once, each doubling a few times
