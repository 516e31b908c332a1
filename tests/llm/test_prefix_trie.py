"""The trie against one built with plain dictionaries."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from retail_strata.llm import prefix_trie
from retail_strata.llm.prefix_trie import build_trie, graft, number_turns

TURNS = "conv_id bigint, turn bigint, role string, text string"


def sequences(rows, grafted):
    turns: dict = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(t, key=lambda x: x[:2])] for c, t in turns.items()}
    if not grafted:
        return turns
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = turns.get(c - c % 20, [])[:h] + turns[c][h:]
    return out


def expected(paths):
    members: dict = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    children: dict = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    sums: dict = {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves = sum(sums[k][0] for k in below) or 1
        sums[node] = leaves, (len(members[node]) - 1) * words + sum(sums[k][1] for k in below)
    rows = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(node))
        rows.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            len(children.get(node, [])), *sums[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def conversations(seed, n=60):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(3 * n), n):
        kind = rng.random()
        if kind < 0.2:  # copies of one conversation
            said = [("user", "hot"), ("assistant", "hot  answer"), ("user", "more")]
        elif kind < 0.6:  # a shared beginning
            said = [("user", "hot")] + [("user", rng.choice("ab c")) for _ in range(rng.randint(0, 5))]
        else:
            said = [(rng.choice(["user", None]), rng.choice(["x y", "", None, "z"])) for _ in range(rng.randint(1, 4))]
        rows += [(c, None if k == 0 and rng.random() < 0.3 else k, r, t) for k, (r, t) in enumerate(said)]
    rng.shuffle(rows)
    return rows


def trie(spark, rows, light, grafted=True):
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as depth", "'x' as conv", "2 as p1", "3 as words")
    turns = number_turns(df, "conv_id", "turn", "role", "text")
    heads = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    parts = graft(turns, 20, 3, heads) if grafted else (turns, turns.select("conv").distinct())
    return sorted((tuple(r) for r in build_trie(*parts, light=light).collect()), key=str)


@pytest.mark.parametrize("seed,light", [(1, 1), (2, 4), (3, 1000)])
def test_trie_of_rebuilt_conversations(spark, seed, light):
    rows = conversations(seed)
    assert trie(spark, rows, light) == expected(sequences(rows, True))


def test_long_copied_and_odd_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    long = [(7, k, "user", f"t{k % 3} w") for k in range(60)]
    rows = long + [(8, k, r, t) for _, k, r, t in long[:50]] + [(c, 0, "user", "same") for c in range(100, 120)]
    rows += [(None, 0, "user", "no id"), (30, None, None, None), (31, 4, "", "")]
    rows += [(40, 2, "a", "twice"), (40, 2, "a", "twice")]
    assert trie(spark, rows, 1, grafted=False) == expected(sequences(rows, False))


def test_no_conversations(spark):
    assert trie(spark, [(None, 0, "a", "b")], 4) == []


def test_conversations_left_without_turns(spark):
    rows = [(c, 0, "user", "only") for c in (1, 2, 3, 5, 41, 44)]
    assert any(not p for p in sequences(rows, True).values())
    for light in (1, 100):
        assert trie(spark, rows, light) == expected(sequences(rows, True))
