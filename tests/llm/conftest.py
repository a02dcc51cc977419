from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("score", T.StringType()),
                     T.StructField("n", T.StringType()), T.StructField("pos", T.StringType()), T.StructField("size", T.StringType())])


def make(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, source), with extra columns whose names operators use inside."""
    full = [(*r, *([None] * (3 - len(r))), "extra", "extra", "extra", "extra") for r in rows]
    return spark.createDataFrame(full, DOCS)


@pytest.fixture
def make_docs(spark):
    return lambda rows: make(spark, rows)


@pytest.fixture(scope="session")
def odd_texts():
    """Texts at the edges: null, empty, blanks, no spaces, very long, beyond ASCII, control letters."""
    rng = random.Random(4)
    words = ["The", "idiot", "LICENSE", "café", "ß", "a", "token", "=", "x" * 40, "日本語", "\x0b", "🙂"]
    return [None, "", " ", "\n", "\n\n \t", "one", "x" * 300_000, " ".join(rng.choice(words) for _ in range(60_000)),
            "\n".join(" ".join(rng.choice(words) for _ in range(6)) for _ in range(20_000)), "no\x00nul", "ÀÉ İ ı ſ K",
            "a\r\nb\rc d\u0085e", "▁▁ ▁", "tail  ", "<s></s><0x41>"]
