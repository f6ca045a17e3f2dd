"""Tokenizers, host rules, URL reputation and sanitisation against plain Python."""

import hashlib
import random
import re

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import byte_vocabulary, edge_docs, no_docs, pattern, word_model  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwise.llm import bpe, host_rules, pii, token_counts, tokens, url_reputation
from shelfwise.session import scratch_path

SPECIAL = ["a", "the", " ", "  ", "\n", "é", "e\u0301", "ß", "日", "Σ", "\u0301", "😀", "1", "'s", "--", "\x85", "\x1c", "İ", "<|endoftext|>", "\t", "\U00018dc1"]
ANY_TEXT = st.text() | st.lists(st.sampled_from(SPECIAL)).map("".join)


@pytest.fixture(scope="module")
def encoder(byte_vocabulary, pattern):
    return bpe.Encoder(bpe.read_ranks(byte_vocabulary), pattern, bpe.newer_characters())


@pytest.fixture(scope="module")
def library(encoder, pattern):
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=encoder.ranks, special_tokens={})


def test_words_hash_alike_wherever_they_stand():
    import pyarrow as pa

    texts = ["Alpha beta", None, "", "beta  ALPHA\nalpha", "é"]
    chunk = next(tokens.chunks(pa.array(["skipped", *texts]).slice(1)))
    found = tokens.words(chunk.data, chunk.bounds, tokens.SPACED)
    assert found.ptr.tolist() == [0, 2, 2, 2, 5, 6]
    a, b = found.hash[:2].tolist()
    assert found.hash[2:5].tolist() == [b, a, a]
    assert found.hash.view(np.int64)[5] == tokens.hash_word("é", tokens.SPACED)


def test_encoder_equals_the_library(encoder, library):
    @settings(max_examples=400, deadline=None)
    @given(ANY_TEXT)
    def check(text):
        ids = encoder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()

    check()


def test_long_pieces_take_linear_time(encoder, library):
    random.seed(1)
    for text in ("a" * 30_000, "".join(random.choice("abcdefgh") for _ in range(30_000))):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_documents_round_trip(edge_docs, no_docs, byte_vocabulary, pattern, library):
    rows = bpe.encode_documents(edge_docs, byte_vocabulary, pattern).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        text = r["text"] or ""
        assert r["n_tokens"] == len(library.encode_ordinary(text)) == len(r["ids"]) // 4
        assert bytes(r["decoded"]) == text.encode()
    assert bpe.encode_documents(no_docs, byte_vocabulary, pattern).count() == 0


def test_word_sums_equal_the_library(word_model):
    counter, library = token_counts.WordCounter(word_model), Tokenizer.from_str(word_model.decode())
    spaces = str.maketrans("\t\n\x0b\f\r", "     ")

    @settings(max_examples=400, deadline=None)
    @given(ANY_TEXT)
    def check(text):
        plain = re.sub(" {2,}", " ", text.translate(spaces)).strip(" ")
        assert counter.count(plain) == len(library.encode(text, add_special_tokens=False).ids)

    check()


def test_cache_is_filled_once_and_used_after(spark, edge_docs, no_docs, word_model):
    library = Tokenizer.from_str(word_model.decode())
    cache = scratch_path(spark, "test-token-cache")
    rows = token_counts.count_tokens(edge_docs, word_model, cache, carry=("doc_id", "text")).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        text = r["text"] or ""
        assert r["n_bytes"] == len(text.encode())
        assert r["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)
    stored = spark.read.parquet(cache)
    # COPY and its repeats are one text; null, '' and white space are another.
    assert stored.count() == stored.select("digest").distinct().count() == 8
    # Counts that were changed by hand come back: a second run only reads the cache.
    other = scratch_path(spark, "test-token-cache")
    stored.withColumn("n_tokens", F.lit(7).cast("long")).write.parquet(other)
    again = token_counts.count_tokens(edge_docs, word_model, other)
    assert {r["n_tokens"] for r in again.collect()} == {7}
    assert spark.read.parquet(other).count() == 8
    assert token_counts.count_tokens(no_docs, word_model, scratch_path(spark, "test-token-cache")).count() == 0


def repeat_words(words):
    places = {}
    for k in range(len(words) - 4):
        places.setdefault(tuple(words[k : k + 5]), []).append(k)
    return len({k + d for at in places.values() if len(at) > 1 for k in at for d in range(5)})


def test_host_rules_edge_cases(edge_docs, no_docs):
    rows = host_rules.judge(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        text = r["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r["n_words"] == len(words)
        assert r["word_chars"] == sum(map(len, words))
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == repeat_words(words)
        assert r["base_failed"] == (len(words) < 10 or 100 * r["n_repeat_words"] > 20 * len(words))
        hinted = 100 * r["n_symbols"] > 50 * r["n_words"] or 100 * r["n_dup_lines"] > 50 * r["n_lines"]
        assert r["kept"] == (not r["base_failed"] and r["host_ok"] and (not hinted or r["host_trusted"]))
    assert host_rules.judge(no_docs).count() == 0


def test_repeated_windows(spark):
    @settings(max_examples=25, deadline=None)
    @given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=20))
    def check(texts):
        docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
        got = {r["doc_id"]: r["n_repeat_words"] for r in host_rules.with_counts(docs).collect()}
        assert got == {k: repeat_words(t) for k, t in enumerate(texts)}

    check()


def test_a_bad_host_goes_and_a_small_one_is_spared(spark):
    good = " ".join(f"w{k}" for k in range(20))
    rows = [(k, good, "good") for k in range(200)] + [(k, good if k % 10 == 0 else "x", "bad") for k in range(200)] + [(1, "x", "small")]
    judged = host_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    verdict = {r["source"]: r["host_ok"] for r in judged.select("source", "host_ok").distinct().collect()}
    assert verdict == {"good": True, "bad": False, "small": True}


def test_hints_count_unless_the_host_is_trusted(spark):
    clean = "one two three four five six seven eight nine ten eleven"
    bad = clean + " #*$%&|<>"
    rows = [(i, clean, "mixed") for i in range(300)] + [(1000 + i, bad, "mixed") for i in range(60)]
    rows += [(2000 + i, clean, "good") for i in range(4000)] + [(9000, bad, "good")]
    judged = host_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r["doc_id"] for r in judged.where("kept").select("doc_id").collect()}
    assert kept == {d for d, text, _ in rows if text == clean} | {9000}
    assert {r["source"] for r in judged.where("host_trusted").select("source").distinct().collect()} == {"good"}


def test_urls(spark):
    rules = [url_reputation.Rule("allow", "com/"), url_reputation.Rule("block", "example.com/en/"), url_reputation.Rule("allow", "www.example.com/en/")]
    cases = {
        "http://Example.COM/en/1?x": ("example.com", "/en/1", "example.com/en/", "block"),
        "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://notexample.com/en/1": ("notexample.com", "/en/1", "com/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://example.com?u=/en/": ("example.com", "", None, "allow"),
        "example.com/en/": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "x://y://z/a#b": ("y:", "//z/a", None, "allow"),
    }
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(cases)], "page_id long, url string").withColumn("bad", F.lit(None).cast("boolean"))
    rows = url_reputation.judge_urls(pages.withColumn("host", F.lit("clash")), rules).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in rows] == list(cases.values())
    assert url_reputation.judge_urls(pages.limit(0), rules).count() == 0


def test_reputation_shrinks_small_hosts(spark):
    rows = [("http://bad.net/", True)] * 60 + [("http://good.net/", k == 0) for k in range(60)] + [("http://once.net/", True)]
    rows += [("http://a.spam.org/", True)] * 60 + [("http://b.spam.org/", None)] + [("http://fine.org/", False)] * 60
    pages = spark.createDataFrame([(k, u, b) for k, (u, b) in enumerate(rows)], "page_id long, url string, bad boolean")
    out = {r["host"]: r for r in url_reputation.judge_urls(pages, []).dropDuplicates(["host"]).collect()}
    assert {h for h, r in out.items() if r["verdict"] == "block"} == {"bad.net", "a.spam.org", "b.spam.org"}
    assert out["good.net"]["rate"] < out["once.net"]["rate"] < out["bad.net"]["rate"]
    # Without labels of its own, a host takes its domain's rate.
    assert out["fine.org"]["rate"] < out["b.spam.org"]["rate"]


def test_registered_domains(spark):
    hosts = {"a.b.co.uk": ("b.co.uk", "co.uk"), "x.example.com": ("example.com", "com"), "localhost": ("localhost", "localhost"), "10.0.0.1:80": ("10.0.0.1", ""), "": ("", ""), "u@h.org:8": ("h.org", "org")}
    domain, suffix = url_reputation.host_levels(F.col("host"))
    got = spark.createDataFrame([(h,) for h in hosts], "host string").select("host", domain, suffix).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == hosts


PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    fits = {
        "email": lambda m: True,
        "ip": lambda m: all(int(p[-4000:]) <= 255 and not p[:-4000].strip("0") for p in m[0].split(".")),
        "card": lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m)),
        "phone": lambda m: 8 <= len(digits(m)) <= 15,
    }
    return [(k, *m.span()) for k, p in PATTERNS.items() for m in p.finditer(text) if fits[k](m)]


def luhn(number):
    total = 0
    for k, c in enumerate(number[::-1]):
        x = int(c) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def test_base_spans_equal_the_patterns():
    parts = ["a", "@", "@b.c", ".", "1", "23", "255", "256", ".1.2.3", "+4", " ", "-", "(", "4111 1111 1111 1111", "é", "\n", "_", "x.y"]

    @settings(max_examples=1500, deadline=None)
    @given(st.lists(st.sampled_from(parts), max_size=25).map("".join))
    def check(text):
        assert pii.base_spans(text) == plain_spans(text)

    check()


def test_disclosing_words(spark):
    # The name stands only beside the address; "mail" is as common elsewhere.
    rows = [(k, f"mail zyxgard at one@example.com today number{k}") for k in range(6)]
    rows += [(100 + k, "mail at today " + " ".join(f"w{j}" for j in range(40))) for k in range(40)]
    rows += [(999, None), (None, "mail zyxgard")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert len(found) == len(rows)
    text = rows[0][1]
    assert [text[s["start"] : s["end"]] for s in found[0]["terms"]] == ["zyxgard"]
    assert not found[100]["terms"] and not found[999]["base"] and not found[None]["terms"]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs.withColumn("row", F.lit(1))).collect()}
    assert clean[0] == "mail  at [EMAIL] today number0"
    assert clean[100] == rows[6][1] and clean[999] is None
    assert pii.find(docs.limit(0)).count() == 0


def test_sanitisation_edge_cases(edge_docs):
    rows = pii.find(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    nine = next(r for r in rows if r["doc_id"] == 9)
    text = next(r["text"] for r in edge_docs.where("doc_id = 9").collect())
    assert [(s["kind"], text[s["start"] : s["end"]]) for s in nine["base"]] == [("email", "a.b@c.example.com"), ("ip", "10.0.0.255"), ("phone", "+49 (30) 1234567")]


def test_a_worker_forgets_pairs_of_tokens(byte_vocabulary, pattern, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_PAIRS", 50)
    encoder = bpe.Encoder(bpe.read_ranks(byte_vocabulary), pattern)
    draw = random.Random(3)
    for _ in range(40):
        text = " ".join("".join(draw.choices("abcdefghé中", k=9)) for _ in range(5))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text)
        encoder.encode("")
        assert len(encoder._fits) <= 50
