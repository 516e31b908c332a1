"""Groups, links and counts against both libraries and plain code."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from retail_strata.llm import tokenizer_alignment
from retail_strata.llm.tokenizer_alignment import align, align_texts, alignment, count_links, pair

PATHS = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
ODD = [
    "a\n\nb. c\n d.\n\n e", "<|endoftext|>x. y", "x  y   z.  w\n", "▁a b", " lead", "\n\nx", "trail ",
    "don't. I'll\tgo on　x", "...!? a.b,c", "<s> </s> <0x0A> hi", "\x00a b\x1f c", "emoji 😀😀 z​ b", ".", "\n", " ",
]


def expected(text):
    """Ids of A and B in groups, from the libraries on the whole text."""
    both, ends = pair(*PATHS), []
    if not text:
        return []
    a = both.a.encode(f" {text}", add_special_tokens=False).ids
    b = both.b.encode(text)
    for vocabulary, ids in ((both.a_vocabulary, a), (both.b_vocabulary, b)):
        if b"".join(vocabulary.entries[i] for i in ids) != f" {text}".encode():
            return []
        ends.append(np.cumsum([len(vocabulary.entries[i]) for i in ids]).tolist())
    groups, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        i_stop, j_stop = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append((a[i:i_stop], b[j:j_stop]))
        i, j = i_stop, j_stop
    return groups


def digest(groups):
    written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
    return hashlib.sha256(written.encode()).hexdigest() if groups else ""


def random_texts(seed, n):
    rng = random.Random(seed)
    letters = "aB é.,'!\n\t 9▁中​   s\r "
    return ["".join(rng.choices(letters, k=rng.randint(1, 40))) for _ in range(n)]


def test_texts_against_the_libraries(prose):
    texts = [*ODD, *random_texts(3, 1500), *[prose(s, 300) for s in range(20)]]
    for text, found in zip(texts, pair(*PATHS).texts(texts), strict=True):
        groups = expected(text)
        assert found[3] == digest(groups), text
        assert found[:3] == (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups))


def test_a_forgetful_memory_changes_nothing(monkeypatch, prose):
    texts = [prose(s, 200) for s in range(30)]
    want = list(pair(*PATHS).texts(texts))
    fresh = tokenizer_alignment.Pair(*PATHS)
    monkeypatch.setattr(tokenizer_alignment, "REMEMBERED", 100)
    monkeypatch.setattr(tokenizer_alignment, "LONGEST", 3)
    assert [x for t in texts for x in fresh.texts([t])] == want


@pytest.mark.parametrize("alike", [0.0, 0.5, 0.95, 1.0])
def test_diagonal_runs_find_every_common_end(alike):
    rng = random.Random(int(alike * 100))
    for _ in range(300):
        a, b, at = [], [], 0
        for _ in range(rng.randint(0, 60)):
            at += 1
            both = rng.random() < alike
            if both or rng.random() < 0.6:
                a.append(at)
            if both or rng.random() < 0.6:
                b.append(at)
        a.append(at + 1)
        b.append(at + 1)
        found = list(align(np.array(a), np.array(b)))
        ends = []
        for i, i_stop, j, j_stop, run in found:
            ends += a[i:i_stop] if run else [a[i_stop - 1]]
            assert b[j:j_stop] == a[i:i_stop] if run else b[j_stop - 1] == a[i_stop - 1]
        assert ends == sorted(set(a) & set(b))
        places = [0, *(x[1] for x in found)], [0, *(x[3] for x in found)]
        assert [x[0] for x in found] == places[0][:-1] and [x[2] for x in found] == places[1][:-1]


def test_counts_over_all_rows(spark, documents, prose):
    shared = prose(1, 150)
    rows = [(0, None), (1, ""), (2, shared), (3, shared), (3, shared), (4, "▁ no"), (None, "a b. c\n"),
            (6, shared + " more. " + prose(2, 40)), (7, "x" * 50_000), *[(10 + k, t) for k, t in enumerate(ODD)]]
    counts: Counter = Counter()
    for _, text in rows:
        counts.update((a[-1], b[-1]) for a, b in expected(text))
    highest: Counter = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    want = []
    for key, text in rows:
        groups = expected(text)
        links = [(a[-1], b[-1]) for a, b in groups]
        want.append((
            key, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), digest(groups),
        ))
    docs = documents(rows, clash=True).repartition(3)
    found = alignment(docs, "doc_id", "text", *PATHS).collect()
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert alignment(docs.limit(0), "doc_id", "text", *PATHS).count() == 0


def test_linked_pairs_are_bounded_by_the_vocabularies(spark, documents, prose):
    """The bytes of one token are the end of the other's, which bounds the broadcast table."""
    both = pair(*PATHS)
    docs = documents([(k, prose(k, 400)) for k in range(20)])
    found = count_links(align_texts(docs, "doc_id", "text", *PATHS)).collect()
    for link, _ in found:
        a = both.a_vocabulary.entries[link >> 32]
        b = both.b_vocabulary.entries[link & 0xFFFFFFFF]
        assert a.endswith(b) or b.endswith(a)
    assert len({r["link"] for r in found}) == len(found) <= both.bound()
