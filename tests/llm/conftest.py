import random

import pytest

import public_tokenizers
from tidemark.llm.common import table

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Columns whose names the operators use themselves.
EXTRA = "kept boolean, keep_id long, key string, hash string, size string, target string, n string, words string, labels string, run string, rank string, __row string, __id string"


@pytest.fixture(scope="session")
def documents(spark, sf):
    return table(spark, sf, "documents")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


def odd_texts() -> list[str | None]:
    random.seed(7)
    long_one = " ".join(random.choice("the of and in lorem ipsum dolor a@b.org 10.0.0.1 x").strip() or "y" for _ in range(60_000))
    return [None, "", " \t\n\v\f\r ", "one", "Two Words", "a b c", "x" * 20_000, long_one, "é ﬁ 😀 ▁ a\u00a0b", "same text here twice", "same  text\nhere twice", "<|endoftext|> <s> it's"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing columns."""
    texts = odd_texts()
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 4 else None, 1) for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (None, "same text here twice", "en", "s1", None), (None, None, None, None, None), (3, "another text of id three", "en", "s1", 1)]
    names = [c.split()[0] for c in EXTRA.split(", ")]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    return spark.createDataFrame([(*r, *[None] * len(names)) for r in rows], schema)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
