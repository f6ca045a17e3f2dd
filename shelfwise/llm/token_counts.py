"""Token counts through a cache keyed by content digest and tokenizer version.

The digest covers what the tokenizer sees (white space collapsed) and the
version covers the tokenizer's file, so a changed file never meets old counts. Counts
come from the cache by a join; only digests that it lacks are encoded, each once,
and appended to it.

Nulls and edges: a null text is empty, with 0 bytes and 0 tokens; repeated rows get
the same count and are encoded once; an empty table gives an empty result and appends
nothing; input columns with the name of an output column are replaced by it.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from shelfwise.llm.common import map_arrow, materialise, row_key

#: Distinct words whose counts a Python worker remembers; beyond that it forgets them.
MEMO_WORDS = 500_000
#: Words handed to the tokenizer at once.
WORD_BATCH = 4096
CACHE_SCHEMA = "digest string, version string, n_tokens long"


def tokenizer_version(model: bytes) -> str:
    return hashlib.sha256(model).hexdigest()[:16]


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space, none at the ends: the tokenizer drops it anyway."""
    spaced = F.translate(text, "\t\n\x0b\f\r", "     ")
    return F.trim(F.regexp_replace(spaced, " {2,}", " "))


class WordCounter:
    """Counts a text's tokens as the sum over its words, each word encoded by the library once.

    The tokenizer's own split never joins across white space, its normaliser
    treats words alone and special tokens hold no white space, so the sum is the count for the text.
    """

    def __init__(self, model: bytes) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(model.decode())
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._counts: dict[str, int] = {}

    def count(self, text: str) -> int:
        words = text.split(" ")
        if len(self._counts) > MEMO_WORDS:
            self._counts.clear()
        counts = self._counts
        new = list(set(words).difference(counts))
        for start in range(0, len(new), WORD_BATCH):
            batch = new[start : start + WORD_BATCH]
            for word, encoded in zip(batch, self._tokenizer.encode_batch_fast(batch, add_special_tokens=False)):
                counts[word] = len(encoded)
        return sum(map(counts.__getitem__, words))


@lru_cache(maxsize=2)
def _counter(model: bytes) -> WordCounter:
    """A worker's counter. Its task has one core: the library's own threads would only wait for each other."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordCounter(model)


def read_cache(docs: DataFrame, cache: str, version: str) -> DataFrame:
    """Stored (digest, n_tokens) of one version; empty where there is no cache yet."""
    spark = docs.sparkSession
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE_SCHEMA)
    return stored.where(F.col("version") == version).select("digest", "n_tokens").groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, model: bytes, cache: str, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``carry`` of ``docs`` with n_bytes, digest and n_tokens; misses are appended to ``cache``.

    ``cache`` is a folder that executors share. Rows without their texts are written once; each
    missing digest picks one row, and only a join on that row's id and key moves text. A
    digest that many rows share meets the counts in a join of plain scans, which Spark can split.
    """
    spark = docs.sparkSession
    version = tokenizer_version(model)
    shared = spark.sparkContext.broadcast(model)
    body = F.coalesce(F.col(text), F.lit(""))
    kept = [c for c in carry if c.lower() not in ("n_bytes", "digest", "n_tokens")]
    rows = docs.select(
        *kept,
        F.octet_length(body).cast("long").alias("n_bytes"),
        F.sha2(F.concat(F.lit(version), F.lit(":"), normalised(body)), 256).alias("digest"),
        F.col(doc_id).alias("_id"),
        row_key(F.col(doc_id), body).alias("_key"),
    )
    rows = materialise(rows, "token-digests")
    misses = (
        rows.groupBy("digest")
        .agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_key")).alias("_row"))
        .select("digest", "_row._id", "_row._key")
        .join(read_cache(docs, cache, version), "digest", "left_anti")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for batch in batches:
            counts = np.fromiter((counter.count(t.as_py()) for t in batch.column("_text")), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts)], names=["digest", "n_tokens"])

    texts = docs.select(F.col(doc_id).alias("_doc"), row_key(F.col(doc_id), body).alias("_row"), normalised(body).alias("_text"))
    same = (F.col("_key") == F.col("_row")) & F.col("_id").eqNullSafe(F.col("_doc"))
    schema = T.StructType([T.StructField("digest", T.StringType()), T.StructField("n_tokens", T.LongType())])
    counted = map_arrow(misses.join(texts, same).select("digest", "_text"), work, schema)
    counted.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")).select(
        "digest", F.lit(version).alias("version"), "n_tokens"
    ).write.mode("append").parquet(cache)
    counts = materialise(read_cache(docs, cache, version), "token-counts")
    return rows.drop("_id", "_key").join(counts, "digest")
