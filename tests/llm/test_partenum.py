"""The n-gram join against all pairs."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from retail_strata.llm import partenum
from retail_strata.llm.common import U64, mix

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * len(sets[i] | sets[j]):
            old, new = group[j], group[i]
            group = [new if g == old else g for g in group]
    out = []
    for (doc, _), found, g in zip(rows, sets, group, strict=True):
        ids = [rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None]
        out.append((doc, len(found), min(ids) if ids else doc))
    return sorted(out, key=lambda x: (x[0] is None, x))


def run(df):
    got = partenum.jaccard_components(df, "doc_id", "text").collect()
    return sorted(map(tuple, got), key=lambda x: (x[0] is None, x))


def changed(text, seed, times):
    rng = random.Random(seed)
    words = text.split()
    for _ in range(times):
        words[rng.randrange(len(words))] = f"w{rng.randrange(1000)}"
    return " ".join(words)


def test_components_as_by_all_pairs(documents, prose):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c d e"), (None, "a b")]
    rows += [(7, "a b c d e f"), (8, "z y x w v u t s r"), (8, "z y x w v u t s r")]
    base = prose(1, 200)
    rows += [(20 + k, changed(base, k, k % 6)) for k in range(25)]
    small = prose(2, 12)
    rows += [(60 + k, changed(small, k, 1)) for k in range(10)]
    rows += [(80 + k, prose(100 + k, 15 + k)) for k in range(10)]
    rows += [(95, prose(3, 9000)), (96, changed(prose(3, 9000), 1, 20))]
    random.Random(1).shuffle(rows)
    assert run(documents(rows, clash=True)) == expected(rows)


def test_blocks_and_groups_of_many(documents, prose, monkeypatch):
    monkeypatch.setattr(partenum, "BLOCK_MEMBERS", 7)
    monkeypatch.setattr(partenum, "BLOCK_ELEMENTS", 900)
    base = prose(5, 120)
    rows = [(k, changed(base, k, 2 + k % 5)) for k in range(60)]
    assert run(documents(rows)) == expected(rows)


def test_empty_table(documents):
    assert run(documents([])) == []


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 40, 200])
def test_linked_sets_share_a_signature(size):
    rng = np.random.default_rng(size)
    for trial in range(150):
        x = np.unique(mix(rng.integers(0, 2**62, size).astype(U64)))
        y = x.copy()
        for _ in range(60):  # change y as long as it stays linked
            new = y[rng.random(len(y)) > 0.08] if rng.random() < 0.5 else y
            if rng.random() < 0.7:
                new = np.union1d(new, mix(rng.integers(0, 2**62, 1).astype(U64)))
            both = len(np.intersect1d(x, new))
            if len(new) and 100 * both >= 80 * (len(x) + len(new) - both):
                y = new
        a, b = (np.concatenate(list(partenum.signatures(s, 80))) for s in (x, y))
        assert len(np.intersect1d(a, b)), (trial, len(x), len(y))


def test_members_are_compared_exactly():
    rng = np.random.default_rng(1)
    pool = np.sort(mix(np.arange(60, dtype=U64)))
    sets = [np.sort(rng.choice(pool, rng.integers(20, 50), replace=False)) for _ in range(40)]
    roots = np.arange(40) // 2
    sides = np.arange(40) % 2
    for both in (True, False):
        linked = {
            tuple(sorted((int(roots[i]), int(roots[j]))))
            for i, j in combinations(range(40), 2)
            if roots[i] != roots[j] and (both or sides[i] != sides[j])
            and 100 * len(np.intersect1d(sets[i], sets[j]))
            >= 50 * len(np.union1d(sets[i], sets[j]))
        }
        got = partenum.compare_members(sets, roots, sides, both, 50)
        assert set(got) <= linked
        assert partenum.forest(np.array(sorted(linked)).T.reshape(2, -1)) is not None
        joined = lambda pairs: {
            frozenset(c) for c in _components(pairs)
        }
        assert joined(got) == joined(linked)


def _components(pairs):
    groups: list[set] = []
    for u, v in pairs:
        touching = [g for g in groups if u in g or v in g]
        groups = [g for g in groups if g not in touching] + [set().union({u, v}, *touching)]
    return groups
