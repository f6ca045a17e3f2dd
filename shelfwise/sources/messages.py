"""Keyed JSON messages: encode rows for a topic, decode them back.

A Kafka broker is the production transport (``format("kafka")``); the
same key/value layout is written to JSON-line files when no broker is
configured, and the stream source decodes either the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.schemas import MESSAGE_SCHEMA, RAW_COLUMNS
from shelfwise.session import dropping_shuffles

#: Messages in a file unless told otherwise. Files are compressed, so one task reads each.
FILE_RECORDS = 1_000_000

MESSAGE_FILE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])
UNKNOWN_KEY = "unknown"


def encode(frame: DataFrame, key_column: str = "Item Identifier",
           extra: tuple[str, ...] = ()) -> DataFrame:
    """(key, value): key = item id or ``unknown``; value = the row as JSON.

    Nulls are omitted from the JSON (``to_json`` default) so they decode
    back to null; ``extra`` columns (e.g. a record id) ride along.
    """
    cols = [F.col(f"`{c}`") for c in RAW_COLUMNS if c in frame.columns]
    cols += [F.col(c) for c in extra if c in frame.columns]
    return frame.select(
        F.coalesce(F.col(f"`{key_column}`").cast("string"), F.lit(UNKNOWN_KEY)).alias("key"),
        F.to_json(F.struct(*cols)).alias("value"),
    )


def decode(frame: DataFrame, schema: T.StructType = MESSAGE_SCHEMA,
           value_column: str = "value", keep_rejects: bool = True) -> DataFrame:
    """Parse ``value`` (binary or text) against a fixed schema and flatten.

    Fields absent from the schema are ignored; ``""`` or quoted numbers
    for numeric fields, and unparseable messages, give nulls. A message
    whose every field is null is a reject; ``keep_rejects=False`` drops
    them (use :func:`rejects` to count them).
    """
    parsed = frame.select(
        F.from_json(F.col(value_column).cast("string"), schema).alias("data")
    ).select("data.*")
    if keep_rejects:
        return parsed
    return parsed.where(~all_null(schema))


def all_null(schema: T.StructType):
    """Whether every field of ``schema`` is null."""
    cond = F.lit(True)
    for f in schema.fields:
        cond = cond & F.col(f"`{f.name}`").isNull()
    return cond


def rejects(decoded: DataFrame, schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
    return decoded.where(all_null(schema))


def publish(frame: DataFrame, target: str, kafka_options: dict[str, str] | None = None,
            topic: str | None = None, file_records: int = FILE_RECORDS) -> None:
    """Write encoded messages to Kafka (when options are given) or to files.

    Each partition writes its own messages in parallel; nothing goes
    through the driver. Files are gzip-compressed JSON lines (the field names of every
    message make most of its bytes) of at most ``file_records`` messages.
    """
    if kafka_options:
        writer = frame.write.format("kafka")
        for k, v in kafka_options.items():
            writer = writer.option(k, v)
        writer.option("topic", topic or target).save()
        return
    with dropping_shuffles(frame.sparkSession):
        frame.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", file_records).json(target)


def read_message_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE_FILE_SCHEMA).json(path)
