import json
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import chat as op

SCHEMAS = [("get", "id", "integer", True), ("get", "deep", "object", False), ("sum", "x", "number", True), ("sum", "tags", "array", False)]


@pytest.fixture(scope="module")
def schemas(spark):
    return spark.createDataFrame(SCHEMAS, "tool string, argument string, type string, required boolean")


def events(spark, rows):
    """Rows of conv, place, kind, call_id, tool, arguments, needs."""
    full = [(*r, {"call": "assistant", "result": "tool"}.get(r[2], "user"), f"text {i}") for i, r in enumerate(rows)]
    return spark.createDataFrame(full, op.EVENT)


def call(conv, place, name, needs=(), tool="get", arguments='{"id": 1}'):
    return conv, place, "call", name, tool, arguments, list(needs)


def result(conv, place, name):
    return conv, place, "result", name, None, None, []


def test_arguments_against_schemas(spark, schemas):
    cases = {
        '{"id": 7}': [], '{"deep": {"b": 1, "a": [1.5, null]}, "id": 7}': [], '{"id": "7"}': ["type:id"], '{"id": 7.5}': ["type:id"],
        '{"deep": 3}': ["missing:id", "type:deep"], '{"id": 1, "more": 2}': ["unknown:more"], "[1]": ["invalid"], "{": ["invalid"], "": ["invalid"], None: ["invalid"], '{"id": null}': ["type:id"],
    }
    rows = [call(1, k, f"c{k}", arguments=a) for k, a in enumerate(cases)] + [call(2, 0, "s", tool="sum", arguments='{"x": 3}'), call(2, 1, "t", tool="none")]
    got = {(r.conv_id, r.place): r for r in op.validate(events(spark, rows), schemas).collect()}
    assert [got[1, k].problems for k in range(len(cases))] == list(cases.values())
    assert got[2, 0].problems == [] and got[2, 1].problems == ["unknown_tool"]
    assert got[1, 1].arguments_json == '{"deep":{"a":[1.5,null],"b":1},"id":7}'


def test_links_and_states(spark, schemas):
    rows = [call(1, 0, "a"), result(1, 1, "a"), call(1, 2, "b"), result(1, 3, "x"), call(1, 4, "a"), result(2, 0, "a"), call(1, 5, None), result(1, 6, None)]
    out = {(r.conv_id, r.place): r for r in op.format_chats(events(spark, rows), schemas).collect()}
    assert [out[1, k].status for k in range(7)] == ["ok", "ok", "open", "orphan", "duplicate", "open", "orphan"]
    assert out[2, 0].status == "orphan" and out[1, 1].call_event == 1 and out[1, 0].result_event == 2


def respects(rows, out):
    at = {(r.conv_id, r.place): r.position for r in out}
    for r in rows:
        if r[2] == "result":
            assert at[r[0], next(x[1] for x in rows if x[:1] == r[:1] and x[2] == "call" and x[3] == r[3])] < at[r[0], r[1]]
        for need in r[6]:
            assert at[r[0], next(x[1] for x in rows if x[:1] == r[:1] and x[2] == "result" and x[3] == need)] < at[r[0], r[1]]


def test_shuffled_chains_and_diamonds_are_put_in_order(spark, schemas):
    rng, rows = random.Random(3), []
    for conv in range(8):
        names = [f"n{k}" for k in range(6)]
        places = rng.sample(range(40), 12) if conv else list(range(12))
        for k, name in enumerate(names):
            needs = rng.sample(names[:k], min(k, 2)) if conv % 2 else names[max(0, k - 1) : k]
            rows += [call(conv, places[2 * k], name, needs), result(conv, places[2 * k + 1], name)]
    out = op.format_chats(events(spark, rows), schemas).collect()
    respects(rows, out)
    assert not any(r.cyclic for r in out)
    for conv in range(8):
        assert sorted(r.position for r in out if r.conv_id == conv) == list(range(12))
    assert [r.place for r in sorted((r for r in out if r.conv_id == 0), key=lambda r: r.position)] == list(range(12))


def test_cycles_come_last_and_are_marked(spark, schemas):
    rows = [call(1, 0, "a", ["b"]), result(1, 1, "a"), call(1, 2, "b", ["a"]), result(1, 3, "b"), call(1, 4, "c"), result(1, 5, "c"), (1, 6, "message", None, None, None, [])]
    out = {r.place: r for r in op.format_chats(events(spark, rows), schemas).collect()}
    assert sorted(p for p, r in out.items() if r.cyclic) == [0, 1, 2, 3] and max(out[p].position for p in (4, 5, 6)) == 2


def longest_paths(links):
    """Level of every node by repeated relaxation; None for nodes on cycles and behind them."""
    nodes = {x for pair in links for x in pair}
    level = {}
    while True:
        free = {n for n in nodes - set(level) if all(b in level for b, a in links if a == n)}
        if not free:
            return {n: level.get(n) for n in nodes}
        level |= {n: 1 + max((level[b] for b, a in links if a == n), default=0) for n in free}


@pytest.mark.parametrize("seed", range(4))
def test_levels_are_longest_paths(spark, seed):
    rng, rows, want = random.Random(seed), [], {}
    for conv in range(12):
        order = rng.sample(range(30), 30)
        links = {(order[k], order[k + 1]) for k in range(29) if rng.random() < 0.8}
        links |= {tuple(order[i] for i in sorted(rng.sample(range(30), 2))) for _ in range(conv)}
        if conv % 4 == 3:
            links.add((order[rng.randrange(15, 30)], order[rng.randrange(15)]))
        rows += [(conv, b, a) for b, a in links]
        want |= {(conv, n): v for n, v in longest_paths(links).items()}
    found = op.levels(spark.createDataFrame(rows, "conv_id long, before long, after long")).collect()
    assert {(r.conv_id, r.event): r.level for r in found} == want and len(found) == len(want)


def test_a_long_chain_takes_few_rounds(spark, schemas, monkeypatch):
    rows = []
    for k in range(300):
        rows += [call(1, 1000 - 2 * k, f"c{k}", [f"c{k - 1}"]), result(1, 999 - 2 * k, f"c{k}")]
    written = []
    monkeypatch.setattr(op, "materialize", lambda df, name, made=op.materialize: written.append(name) or made(df, name))
    out = op.format_chats(events(spark, rows), schemas).orderBy("position").collect()
    assert [r.call_id for r in out] == [f"c{k // 2}" for k in range(600)] and [r.kind for r in out] == ["call", "result"] * 300
    assert written.count("pointers") <= 11


def test_json_is_canonical(spark, schemas):
    rows = [call(1, 0, "a", arguments=' {"id" : 2, "deep": {"z":"é\\n", "a":1}} '), result(1, 1, "a"), (1, 2, "message", None, None, None, []), call(1, 3, "b", arguments="{oops")]
    lines = [r.json for r in op.format_chats(events(spark, rows), schemas).orderBy("position").collect()]
    assert lines[0] == '{"arguments":{"deep":{"a":1,"z":"é\\n"},"id":2},"id":"a","role":"assistant","tool":"get"}'
    assert lines[3].startswith('{"arguments":"{oops"') and all(json.loads(x) is not None for x in lines)
    assert all(x == json.dumps(json.loads(x), sort_keys=True, separators=(",", ":"), ensure_ascii=False) for x in lines)


def test_ranks_do_not_depend_on_a_single_window(spark):
    rng = random.Random(1)
    rows = [(1, rng.randrange(5000), k) for k in range(3000)] + [(2, None, k) for k in range(50)] + [(None, 3, 0), (None, 3, 1)]
    frame = spark.createDataFrame(rows, "conv_id long, place long, k long")
    keys = {"r": F.floor(F.col("place") / 1024), "p": F.col("place"), "k": F.col("k")}
    got = op.ranked(frame, keys, "event").collect()
    want = {(c, p, k): at + 1 for c in (1, 2) for at, (c, p, k) in enumerate(sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] or -1, r[2])))}
    assert all(r.event == want.get((r.conv_id, r.place, r.k), 1) for r in got) and len(got) == len(rows)


def test_odd_turns(spark):
    turns = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", None), (None, None, None, None), (2, None, "user", "x"), (3, 1, "assistant", "y")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS event", "'x' AS json", "2 AS problems")
    out = op.report(frame)
    assert out.count() == len(turns) and out.filter("json IS NULL").count() == 0
    assert sorted(r.status for r in out.filter("conv_id = 1").collect()) == ["duplicate", "ok", "ok"]
    assert op.report(frame.limit(0)).count() == 0
