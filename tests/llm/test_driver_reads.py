"""What the operators read to the driver, each with its bound; long digit runs; plans of the native operators."""

import os
import re

import pytest
from llm_fixtures import SCHEMA, SF_SMALL, edge_docs  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
import shelfwise.llm
from shelfwise.llm import host_rules, pii, queries

#: Reads to the driver by file, in order, and what bounds them.
READS = {
    "centroids.py": ["k vectors", "k * dims sums", "k sums"],
    "common.py": ["2**BITMAP_WORDS_LOG2 words"],
    "conversation_trie.py": ["one number"],
    "decontaminate.py": ["the vocabulary of one block of items", "one matrix for each task of the sample", "block_items items"],
    "host_rules.py": ["one row"],
    "line_dedup.py": ["a fixed table of slots"],
    "mixing.py": ["one row", "one row", "one row"],
    "ngram_join.py": ["one row"],
    "pii.py": ["one row"],
    "pu_quality.py": ["the bounded labelled and unlabelled rows of the fit"],
    "toxicity.py": ["the bounded labelled rows of the fit", "one row", "the vocabulary's words"],
    "url_reputation.py": ["one row", "one row"],
}
READ = re.compile(r"\.collect\(\)|\.toPandas\(\)|\.toArrow\(\)|\.first\(\)|toLocalIterator")
NEVER = re.compile(r"\.rdd\b|localCheckpoint|crossJoin")


def test_reads_to_the_driver_are_the_listed_ones():
    folder = os.path.dirname(shelfwise.llm.__file__)
    texts = {n: open(os.path.join(folder, n)).read() for n in os.listdir(folder) if n.endswith(".py")}
    texts["corpus_pipeline.py"] = open(corpus_pipeline.__file__).read()
    found = {n: len(READ.findall(t)) for n, t in texts.items() if READ.search(t)}
    assert found == {n: len(bounds) for n, bounds in READS.items()}
    assert [n for n, t in texts.items() if NEVER.search(t)] == []


def test_long_runs_of_digits_in_an_address(spark):
    nines = "9" * 5000
    texts = ["0" * 5000 + ".1.1.1", nines + ".1.1.1", "1.2.3." + "0" * 5000 + "255", "1.2.3." + nines, "256.1.1.1 00.0.0.000"]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], SCHEMA)
    found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["base"] if s["kind"] == "ip"] for r in pii.find(docs).collect()}
    assert found[0] == [(0, 5006)] and found[1] == [] and found[2] == [(0, 6 + 5003)] and found[3] == []
    assert [texts[4][a:b] for a, b in found[4]] == ["00.0.0.000"]


@pytest.mark.parametrize("name", ["op9_host_rules", "op13_source_mix"])
def test_native_operators_run_no_python(spark, name):
    plan = queries.queries()[name](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_native_sources_use_no_python_on_executors():
    folder = os.path.dirname(host_rules.__file__)
    for name in ("host_rules.py", "mixing.py"):
        text = open(os.path.join(folder, name)).read()
        assert not re.search(r"map_arrow|mapIn|applyIn|udf|pandas|\.rdd", text), name
