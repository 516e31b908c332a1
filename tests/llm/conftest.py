from __future__ import annotations

import random

import public_tokenizers
import pytest

from retail_strata.llm.common import ship

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def tokenizer_path():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def prose():
    """Random words; the same seed gives the same text."""

    def make(seed: int, words: int) -> str:
        rng = random.Random(seed)
        parts = ["tion", "er", "the", "an", "ou", "st", "ré", "ly", "ha", "on", "be"]
        made = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(words)]
        return " ".join(w + ("." if rng.random() < 0.1 else "") for w in made)

    return make


@pytest.fixture
def documents(spark):
    """A frame of documents; columns besides id and text are there to be carried along."""

    def make(rows, clash: bool = False):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, DOCS)
        if clash:  # names that the operators use inside
            for name in ("key", "id", "ids", "row", "n", "words", "hash", "start", "text_key", "html"):
                df = df.selectExpr("*", f"'x' as `{name}`")
        return df

    return make
