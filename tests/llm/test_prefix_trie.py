from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from martlet.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_rebuilt(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    said = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    out = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = said.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute_trie(said):
    members = defaultdict(list)
    for c, turns in said.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    rows = set()
    for node, of in members.items():
        below = [x for x in members if x[: len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        ends = ",".join(map(str, sorted(c for c in of if len(said[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        rows.add((min(of), len(node), parent, len(of), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def made(r, n):
    rows = []
    for c in range(n):
        c = c * 3 % (2 * n)
        for t in range(r.choice([0, 1, 2, 3, 5, 9, 12])):
            rows.append((c, t, r.choice(["user", "assistant", None]), r.choice(["é" * 3, "ok", "", None, "long words " * 3])))
    return rows


def trie(spark, rows, **kwargs):
    df = spark.createDataFrame(rows, SCHEMA)
    return T.prefix_trie(T.rebuilt(T.ordered_turns(df)), **kwargs)


@pytest.mark.parametrize("shard_rows", [1, 4, 40, T.SHARD_ROWS])
def test_nodes_match_brute_force(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(T, "CROWN_WIDTH", 10**9)  # the limit is the given one
    monkeypatch.setattr(T, "PIECE", 3)
    rows = made(random.Random(7), 90)
    got = [tuple(x) for x in trie(spark, rows, shard_rows=shard_rows).collect()]
    expected = brute_trie(brute_rebuilt(rows))
    assert len(got) == len(expected) and set(got) == expected


def test_many_conversations_end_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(T, "PIECE", 5)
    rows = [(c, t, "user", f"same {t}") for c in range(5, 400) for t in range(3)]
    expected = brute_trie(brute_rebuilt(rows))
    assert {tuple(x) for x in trie(spark, rows, shard_rows=10).collect()} == expected


def test_nulls_ties_repeats_long_texts_and_clashing_columns(spark):
    rows = [(1, None, "user", "first"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, None, None), (2, 1, "user", "x"), (2, 1, "user", "x")]
    rows += [(None, 0, "user", "nobody's"), (7, 0, "user", "y" * 2_000_000), (8, 0, "user", "y" * 2_000_000)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", depth long, pos long, hi long")
    got = {tuple(x) for x in T.prefix_trie(T.rebuilt(T.ordered_turns(df))).collect()}
    assert got == brute_trie(brute_rebuilt(rows))
    assert T.prefix_trie(T.rebuilt(T.ordered_turns(df.where("false")))).count() == 0


def test_a_conversation_of_many_turns(spark):
    rows = [(c, t, "user", f"turn {t if t < 3000 else c}") for c in (10, 20) for t in range(3001)]
    got = {(x["conv_id"], x["depth"]): x for x in trie(spark, rows, shard_rows=100).collect()}
    assert got[(10, 3000)]["n_convs"] == 2 and got[(10, 3000)]["n_children"] == 2
    assert got[(10, 0)]["saved_tokens"] == sum(len(f"turn {t}") for t in range(3000)) and got[(10, 0)]["n_leaves"] == 2
    assert got[(20, 3001)]["parent_conv_id"] == 10 and len(got) == 3003


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_node_table_is_minimal_perfect_and_verified(n):
    r = np.random.default_rng(n)
    hi, lo = (r.integers(-(2**63), 2**63, n, dtype=np.int64) for _ in range(2))
    table = T.NodeTable(hi, lo)
    assert sorted(table.slots(hi, lo)) == list(range(n))
    assert (table.slots(lo, hi) == -1).all()


def test_equal_digests_in_a_table_are_an_error():
    with pytest.raises(ValueError):
        T.NodeTable(np.array([1, 1], np.int64), np.array([2, 2], np.int64))
