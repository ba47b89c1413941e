"""Levels of tool calls: the longest chain of references, on chains, branches and cycles, against a plain search."""

import json
import random

CALLS = "conv_id long, call_id string, turn long, name string, arguments string"


def expected(refers):
    """call -> list of calls; None where a cycle is reached."""
    known, open_ = {}, set()

    def depth(c):
        if c in known:
            return known[c]
        if c in open_:
            return None
        open_.add(c)
        below = [depth(x) for x in refers[c] if x in refers]
        open_.discard(c)
        level = None if None in below else max((b + 1 for b in below), default=0)
        if level is not None or not open_:
            known[c] = level
        return level

    return {c: depth(c) for c in refers}


def test_levels_equal_a_plain_search(spark):
    from yearweave.llm.tool_chat import link_calls
    r = random.Random(6)
    rows, want = [], {}
    for conv in range(25):
        n = r.choice([1, 3, 12, 40])
        most = r.choice([1, 1, 3])
        names = [f"c{i}" for i in range(n)]
        refers = {}
        for i, c in enumerate(names):
            pool = names if conv % 5 == 0 else names[:i]  # every fifth conversation may have cycles
            refers[c] = [x for x in r.sample(pool, min(len(pool), r.randint(0, most))) if x != c or conv % 10 == 0]
            if conv % 4 == 1 and i:
                refers[c] = [names[i - 1]]  # one long chain
        for i, c in enumerate(names):
            nested = [f"${{{x}}}" for x in refers[c]]
            shape = [{"a": nested}, {"a": {"b": [nested]}, "note": "say ${c0} here"}, {f"p{k}": v for k, v in enumerate(nested)}][i % 3]
            rows.append((conv, c, i, "add", json.dumps(shape)))
        want.update({(conv, c): v for c, v in expected(refers).items()})
    got = {(x.conv_id, x.call_id): x.level for x in link_calls(
        spark.createDataFrame(rows, CALLS), spark.createDataFrame([], "conv_id long, call_id string, turn long, content string"), {}).collect()}
    assert got == want and max(v for v in want.values() if v is not None) >= 39 and None in want.values()


def test_names_and_texts_are_no_references(spark):
    from yearweave.llm.tool_chat import link_calls
    rows = [(1, "x", 1, "add", "{}"), (1, "y", 2, "add", '{"${x}": 1, "t": "see \\"${x}\\" there", "u": "${x} "}'), (1, "z", 3, "add", '{"t": {"${y}": ["${x}"]}}')]
    got = {x.call_id: x.level for x in link_calls(
        spark.createDataFrame(rows, CALLS), spark.createDataFrame([], "conv_id long, call_id string, turn long, content string"), {}).collect()}
    assert got == {"x": 0, "y": 0, "z": 1}


def test_registered_query_orders_chains(spark):
    from yearweave.llm.registry import QUERIES
    assert max(x.level or 0 for x in QUERIES["op5_tool_calls"](spark, "/root/testdata/sf0.001").select("level").collect()) >= 1
