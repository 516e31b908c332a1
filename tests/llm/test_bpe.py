"""BPE tree concatenation against the library itself."""

from __future__ import annotations

import hashlib
import random
import unicodedata

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from retail_strata.llm import bpe


def ids_by_tree(path: str, text: str, leaf: int) -> list[int]:
    tokenizer, encoder = bpe.load(path), bpe.word_encoder(path)
    parts = bpe.cut(text, leaf)
    inner = [inside for _, inside in parts] + [False]
    leaves = []
    for (part, left), right in zip(parts, inner[1:], strict=True):
        head, ids, tail = bpe.encode_leaf(encoder, part, left, right)
        leaves.append({"inside": left, "size": len(part), "head": head, "ids": ids, "tail": tail})
    return np.frombuffer(bpe.concatenate(tokenizer, leaves), dtype="<u4").tolist()


PIECES = ["abcde", "the", "Ing", "é", "é", "ß", "'s", "'", "!!", "12", "<|endoftext|>", "漢字"]
PIECES += ["́", "😀", "THE", "İ", "Σς", "\x1c", "\xa0", " ", " ", "\n", "\t"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=60), st.sampled_from([7, 20, 64]))
def test_cut_and_joined_texts_encode_as_a_whole(pieces, leaf):
    import public_tokenizers

    path, text = public_tokenizers.path("word_bpe_49k.json"), "".join(pieces)
    assert ids_by_tree(path, text, leaf) == bpe.load(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [0, 1, 31, 32, 33, 500, 5000])
def test_unsplit_runs(tokenizer_path, size):
    rng = random.Random(size)
    text = "".join(rng.choice("abcdeinghtos") for _ in range(size))
    whole = bpe.load(tokenizer_path).encode(text, add_special_tokens=False).ids
    assert ids_by_tree(tokenizer_path, text, 32) == whole


def test_one_letter_over_and_over(tokenizer_path):
    text = "a" * 3000
    whole = bpe.load(tokenizer_path).encode(text, add_special_tokens=False).ids
    assert ids_by_tree(tokenizer_path, text, 100) == whole


def test_digests_of_all_cases(documents, tokenizer_path, prose):
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "It's the end."), (4, "It's the end."), (None, "x y")]
    rows += [(5, prose(1, 900)), (6, "q" * 700 + " " + prose(2, 300)), (7, "<|endoftext|> A")]
    got = bpe.digests(documents(rows, clash=True), "doc_id", "text", tokenizer_path, leaf=256)
    tokenizer = bpe.load(tokenizer_path)

    def expected(doc, text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        hexes = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]
        return (doc, len(ids), *hexes)

    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    order = lambda x: (x[0] is None, x)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(
        (expected(*r) for r in rows), key=order
    )


def test_empty_table(documents, tokenizer_path):
    assert bpe.digests(documents([]), "doc_id", "text", tokenizer_path).collect() == []


def test_bounded_memory(tokenizer_path, monkeypatch, prose):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    encoder = bpe.WordEncoder(tokenizer_path)
    texts = [prose(k, 50) + " " + "z" * 100 for k in range(20)]
    found = list(encoder.encode(t.encode() for t in texts))
    assert len(encoder.words) <= 5
    for text, ids in zip(texts, found, strict=True):
        whole = bpe.load(tokenizer_path).encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<u4").tolist() == whole


ODD = ["<|ENDOFTEXT|>", "<|EndOfText|>", "x<|EndOfText|>Y", "<|StartOfText|>", "J\u030cA", "j\u030ca"]
ODD += ["H\u0331", "T\u0308", "W\u030a", "Y\u030a", "H\u0331<|ENDOFTEXT|>", "\u00c9TE", "THE."]


@pytest.mark.parametrize("word", ODD)
def test_words_that_lowering_would_change(tokenizer_path, word):
    for text in (word, f"The {word} End.", f"{word} <|endoftext|> {word}"):
        whole = bpe.load(tokenizer_path).encode(text, add_special_tokens=False).ids
        (ids,) = bpe.WordEncoder(tokenizer_path).encode([text.encode()])
        assert np.frombuffer(ids, dtype="<u4").tolist() == whole


def test_words_of_other_case_are_new_once(tokenizer_path):
    encoder = bpe.WordEncoder(tokenizer_path)
    texts = ["The the THE tHe", "caf\u00e9 Caf\u00e9", "the <|endoftext|> The", "THE e\u0301 E\u0301"]
    for text, words in zip(texts, (1, 2, 4, 7), strict=True):
        whole = bpe.load(tokenizer_path).encode(text, add_special_tokens=False).ids
        (ids,) = encoder.encode([text.encode()])
        assert np.frombuffer(ids, dtype="<u4").tolist() == whole
        assert len(encoder.words) == words, list(encoder.words)


def test_ascii_letters_compose_with_marks_of_one_block_only():
    for code in range(0x80, 0x110000):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and parts[0].isascii() and parts[0].isalpha():
            assert parts[1].encode()[:1] in bpe._MARK_BYTES


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from([c for c in map(chr, range(0x180)) if bpe._PLAIN.fullmatch(c)])))
def test_plain_words_split_as_by_the_pattern(word):
    import public_tokenizers

    encoder = bpe.word_encoder(public_tokenizers.path("word_bpe_49k.json"))
    pattern = bpe._split_pattern(encoder.tokenizer)
    assert encoder.split(word) == regex.findall(pattern, word)
    whole = encoder.tokenizer.encode(word, add_special_tokens=False).ids
    (ids,) = encoder.encode([word.encode()])
    assert np.frombuffer(ids, dtype="<u4").tolist() == whole
