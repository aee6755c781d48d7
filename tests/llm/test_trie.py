"""The prefix trie against a plain walk over all prefixes."""

import hashlib
import zlib
from collections import defaultdict

import pytest

import __spark_entry__ as registry
from gaugeworks.llm import trie
from oracle_check import connect, differences

SCHEMA = "conv_id long, turn long, role string, text string, Place string"


def brute_force(rows, rebuild=True):
    turns = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        paths[c] = tuple(turns.get(c - c % 20, [])[:h] + own[h:])
    members = defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        children = [m for m in members if len(m) == len(node) + 1 and m[:-1] == node]
        leaves = sum(not any(len(x) == len(m) + 1 and x[:-1] == m for x in members) for m in below)
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode().split()) for m in below if m)
        ends = ",".join(str(c) for c in convs if len(paths[c]) == len(node))
        out.append((
            convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), len(children), leaves, saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(spark, rows, rebuild=True, block=trie.BLOCK):
    df = spark.createDataFrame(rows, SCHEMA)
    turns = trie.numbered_turns(df)
    turns = trie.rebuilt(turns) if rebuild else turns
    return sorted(map(tuple, trie.prefix_trie(turns, df, block).collect()), key=str)


def conversations():
    rows = []
    for c in range(0, 130):
        for t in range(c % 11):
            text = f"word\t{t // 2} shared words" if c % 3 else f"turn {t}" if t != c % 5 else f"own {c}"
            rows.append((c, t, "user" if t % 2 else None, text if t % 7 else None, "x"))
    return rows


@pytest.mark.parametrize("block", [1, 3, 4])
def test_equals_a_plain_walk(spark, block):
    rows = conversations()
    assert found(spark, rows, block=block) == brute_force(rows)


def test_nulls_repeats_and_long_conversations(spark):
    rows = [(7, t % 40 or None, "u", f"t {t}" if t % 40 else "same", None) for t in range(1, 400) if t % 40 or t < 90]
    rows = [r for r in rows if r[1] is None] + [(7, t, "u", f"t {t}", None) for t in range(1, 300)]
    rows += [(8, t, "u", f"t {t}", None) for t in range(1, 200)] + [(None, 1, "u", "lost", None)]
    rows += [(9, None, None, None, None)] * 5 + [(10, 1, "u", "", None)] * 2
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark, rows, rebuild=False) == brute_force(rows, rebuild=False)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_many_copies_and_ids(spark):
    rows = [(c, 0, "u", "hello there", None) for c in range(1, 3 * trie.IDS)]
    assert found(spark, rows, rebuild=False) == brute_force(rows, rebuild=False)
    # turnless after the rebuild: the family's first conversation is absent
    rows = [(41 + c, 0, "u", "only", None) for c in range(12)]
    assert found(spark, rows) == brute_force(rows)


def test_empty(spark):
    assert found(spark, []) == []


def test_equal_turn_numbers_have_one_order(spark):
    rows = [(1, 0, "u", t, None) for t in "abc"] + [(2, 0, "u", t, None) for t in "cab"]
    nodes = found(spark, rows, rebuild=False)
    assert [n[3] for n in nodes] == [2, 2, 2, 2]


def test_query(spark, small):
    assert differences(spark, connect(small), registry.queries()["op13_block_trie"], registry.oracle_sql()["op13_block_trie"], small) == []
