"""One thin registered query per operator, each over its whole intended table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    bpe,
    centroids,
    conversation_trie,
    decontaminate,
    host_rules,
    line_dedup,
    mixing,
    ngram_join,
    pii,
    pu_quality,
    token_counts,
    toxicity,
    url_reputation,
)
from shelfwise.llm.common import documents, materialise, row_key
from shelfwise.session import scratch_path

BYTE_BPE = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
URL_RULES = [
    url_reputation.Rule("allow", "com/"),
    url_reputation.Rule("block", "example.com/en/"),
    url_reputation.Rule("allow", "www.example.com/en/"),
    url_reputation.Rule("block", "net/es/"),
    url_reputation.Rule("block", "net/fr/"),
]


def tokenizer_file(name: str) -> bytes:
    with open(public_tokenizers.path(name), "rb") as data:
        return data.read()


def op1_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the kinds of toxicity of every document, and whether it is toxic."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    kinds = materialise(toxicity.kinds_of_toxicity(docs, labels), "toxic-labels")
    chain = toxicity.fit_chain(docs, kinds, ("insult", "contempt", "toxic"))
    scored = toxicity.score_documents(docs, chain)
    return scored.withColumn("toxic", F.col("p_toxic") >= 0.5)


def _spans_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")


def op2_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, and the words that disclose it, as spans."""
    found = pii.find(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.transform("base", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    terms = F.transform("terms", lambda x: F.concat_ws(":", F.lit(pii.TERM), x["start"].cast("string"), x["end"].cast("string")))
    return found.select(
        "doc_id",
        *[_spans_of(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, terms), ",").alias("spans"),
        F.size("terms").cast("long").alias("n_terms"),
    )


def op3_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url; pages are labelled by their own text's symbols."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    pages = pages.select("page_id", "url", url_reputation.page_outcome(F.col("html")).alias("bad"))
    return url_reputation.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels no fit may see."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op4_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document from trusted positives and unlabelled documents."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = pu_quality.fit_model(docs, labels.where((F.col("quality") == 1) & ~held_out()))
    scored = pu_quality.score_documents(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document: 4-word shingles, Jaccard similarity of 85 % or more."""
    joined = ngram_join.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), size=4, percent=85)
    return joined.select("doc_id", "n_shingles", "component_id")


def op6_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a passage of a benchmark item, with the item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.leaks(documents(spark, sf_dir).select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id", "item_id", F.lit(True).alias("contaminated"), F.round("lcs", 4).alias("lcs"), F.round("answer", 4).alias("answer")
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and their decoded bytes, as digests."""
    coded = bpe.encode_documents(
        documents(spark, sf_dir).select("doc_id", "text"), tokenizer_file(BYTE_BPE), public_tokenizers.PATTERN
    )
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every document its number of lines and which of them (from 0) repeat an earlier line of the corpus."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    removed = materialise(line_dedup.removed_lines(docs), "line-removed")
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long")
    key = row_key(F.col("doc_id"), F.col("text"))
    counted = docs.select("doc_id", key.alias("row"), n_lines.alias("n_lines"))
    joined = counted.join(removed.withColumnRenamed("doc_id", "id"), (counted["row"] == removed["row"]) & counted["doc_id"].eqNullSafe(F.col("id")), "left")
    return joined.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.transform("removed", lambda k: k.cast("string")), ","), F.lit("")).alias("removed_lines"),
    )


def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdicts for every document; hosts are the sources."""
    judged = host_rules.judge(documents(spark, sf_dir).select("doc_id", "source", "text"), carry=("doc_id",))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document; each call starts an empty cache, so it encodes every distinct text."""
    counted = token_counts.count_tokens(
        documents(spark, sf_dir).select("doc_id", "text"), tokenizer_file(WORD_BPE), scratch_path(spark, "token-cache")
    )
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and squared distance of every vector after ten rounds over eight centroids."""
    return centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prefix that rebuilt conversations share or end with, as a node of their trie."""
    turns = conversation_trie.ranked(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    convs, rebuilt = conversation_trie.rebuild(turns)
    return conversation_trie.prefix_trie(convs, rebuilt)


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of sources takes of every document, repeats included."""
    return mixing.mix(documents(spark, sf_dir).select("doc_id", "source", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity_chain": op1_toxicity_chain,
        "op2_sanitisation": op2_sanitisation,
        "op3_url_reputation": op3_url_reputation,
        "op4_pu_quality": op4_pu_quality,
        "op5_ngram_join": op5_ngram_join,
        "op6_benchmark_leaks": op6_benchmark_leaks,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_line_dedup": op8_line_dedup,
        "op9_host_rules": op9_host_rules,
        "op10_token_cache": op10_token_cache,
        "op11_centroid_clustering": op11_centroid_clustering,
        "op12_conversation_trie": op12_conversation_trie,
        "op13_source_mix": op13_source_mix,
    }
