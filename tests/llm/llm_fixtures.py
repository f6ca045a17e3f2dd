"""Fixtures of the tests beside this file."""

import public_tokenizers
import pytest

from shelfwise.llm.queries import tokenizer_file

SF_SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"word{k % 977}x{k}" for k in range(20_000))
COPY = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
EDGE_ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", "src0", 5),
    (2, None, "en", None, None),
    (3, "", None, "", 0),
    (4, LONG, "en", "src0", len(LONG)),
    (5, COPY, "en", "src1", 10),
    (5, COPY, "en", "src1", 10),
    (6, COPY, "de", "src0", 10),
    (None, COPY.upper(), "en", "src1", 10),
    (7, " \t\n \x0b\x0c\r ", "en", "src1", 6),
    (8, "One. two\nthree\n\nTHREE\nthree 4444 5555", "en", "src0", 3),
    (9, "mail a.b@c.example.com now, 10.0.0.300 and 10.0.0.255, +49 (30) 1234567!", "en", "src1", 3),
    (10, "idiot moron trash", "en", "src1", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns with the names of operators' own ones.
CLASHES = ["n_words", "kept", "base_failed", "host_ok", "n_tokens", "ids", "decoded", "n_bytes", "digest", "n_removed", "row", "key"]


@pytest.fixture
def edge_docs(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(EDGE_ROWS, SCHEMA).repartition(3)
    return docs.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def byte_vocabulary():
    return tokenizer_file("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="session")
def word_model():
    return tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="session")
def pattern():
    return public_tokenizers.PATTERN
