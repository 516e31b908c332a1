"""Packed ids: round trips, layout and random access."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from retail_strata.llm import bitpack, bpe


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 32), st.data())
def test_pack_and_unpack(width, data):
    ids = np.array(data.draw(st.lists(st.integers(0, 2**width - 1), max_size=70)), dtype="<u4")
    packed = bitpack.pack(ids, width)
    assert len(packed) == -(-len(ids) * width // 8)
    assert bitpack.unpack(packed, len(ids), width).tolist() == ids.tolist()


@pytest.mark.parametrize("width", [5, 8, 16, 17, 32])
def test_batches_pack_as_their_documents(width):
    rng = np.random.default_rng(width)
    documents = [rng.integers(0, 2**width, n).astype("<u4") for n in (0, 3, 64, 0, 1, 90, 0)]
    counts = np.array([len(d) for d in documents])
    packed = bitpack.pack_each(np.concatenate(documents), counts, width)
    assert packed == [bitpack.pack(d, width) for d in documents]
    assert bitpack.pack_each(np.zeros(0, dtype="<u4"), counts[:0], width) == []
    held = [bitpack.stored(x, n, width) for x, n in zip(packed, counts, strict=True)]
    assert all(d.itemsize == (width // 8 if width in bitpack.WHOLE else 4) for d in held)
    keys = list(range(len(held)))
    assert bitpack.write_shard(keys, held, width, 32) == bitpack.write_shard(keys, documents, width, 32)


def test_width_is_the_least():
    assert [bitpack.width_of(v) for v in (0, 1, 2, 3, 256, 257, 49_408, 65_536, 65_537)] == [
        1, 1, 1, 2, 8, 9, 16, 16, 17,
    ]
    with pytest.raises(ValueError):
        bitpack.pack(np.array([8], dtype="<u4"), 3)


@pytest.mark.parametrize("width", [5, 16, 17])
def test_random_access(width):
    rng = np.random.default_rng(width)
    documents = [rng.integers(0, 2**width, n).astype("<u4") for n in (0, 3, 64, 1, 300, 0)]
    shard = bitpack.Shard(bitpack.write_shard([1, 2, 3, 4, 5, 6], documents, width, block=32))
    whole = np.concatenate(documents)
    assert [shard.document(k).tolist() for k in range(6)] == [d.tolist() for d in documents]
    for a, b in ((0, 0), (0, 368), (31, 33), (100, 101), (360, 368)):
        assert shard.read(a, b).tolist() == whole[a:b].tolist()


def test_documents_read_back(spark, documents, tokenizer_path, tmp_path, prose, monkeypatch):
    monkeypatch.setattr(bitpack, "RANGE_ROWS", 3)
    rows = [(9, None), (3, ""), (3, "the cat"), (3, "the cat"), (-4, "Ünï cödé"), (None, "lost")]
    rows += [(100 + k, prose(k, 40 * k)) for k in range(12)]
    shards = bitpack.pack_documents(
        documents(rows, clash=True), "doc_id", "text", tokenizer_path, str(tmp_path / "p"), 2
    )
    got = [tuple(r) for r in bitpack.read_documents(shards, "doc_id").orderBy("start").collect()]
    tokenizer = bpe.load(tokenizer_path)
    encoded = [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for d, t in rows]
    encoded.sort(key=lambda x: (x[0] is not None, x[0] or 0, len(x[1])))
    start, expected = 0, []
    for doc, ids in encoded:
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert got == expected
    assert spark.read.parquet(str(tmp_path / "p")).count() > 1


def test_empty_table(documents, tokenizer_path, tmp_path):
    shards = bitpack.pack_documents(
        documents([]), "doc_id", "text", tokenizer_path, str(tmp_path / "p"), 2
    )
    assert bitpack.read_documents(shards, "doc_id").collect() == []
