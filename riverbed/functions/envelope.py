"""Change-event envelope handling.

Input: Kafka-shaped rows ``topic, partition, offset, key, value[, timestamp]``
where key/value are text or bytes.  Output adds the parsed envelope fields
as columns; nothing is dropped here so bad rows can be dead-lettered later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from . import variant as V


def decode_text(df: DataFrame, name: str) -> Column:
    """bytes -> text with U+FFFD for invalid UTF-8; text stays text."""
    if isinstance(df.schema[name].dataType, BinaryType):
        return F.make_valid_utf8(F.col(name).cast("string"))
    return F.col(name).cast("string")


def lenient_json(text: Column) -> Column:
    """JSON, else ``{"_raw": text}``; NULL stays NULL."""
    return F.when(text.isNotNull(),
                  F.coalesce(F.try_parse_json(text),
                             F.parse_json(F.to_json(F.struct(text.alias("_raw"))))))


def table_from_topic(topic: Column) -> Column:
    """Last dot-separated part of the topic."""
    return F.element_at(F.split(topic, r"\."), -1)


def parse_envelope(feed: DataFrame) -> DataFrame:
    """P1, P2 (tombstones flagged), op/before/after/ts_ms/source extraction.

    Adds: ``key_text, value_text, tombstone, malformed, op, before, after,
    ts_ms, source_db, source_collection, table_name``.

    The message is parsed once; the members of that parse (or of its payload
    when the envelope is wrapped) are then read in one pass.
    """
    df = feed.withColumns({"key_text": decode_text(feed, "key"),
                           "value_text": decode_text(feed, "value")})
    df = df.withColumn("_v", F.try_parse_json(F.col("value_text")))
    v = F.col("_v")
    # wrapped if the message has the member, whatever it holds
    df = df.withColumn("_p", V.field(v, "payload"))
    wrapped = F.col("_p").isNotNull()
    df = df.withColumn("_m", V.members(F.when(wrapped, F.col("_p")).otherwise(v), ["op", "before", "after", "ts_ms", "source"]))
    df = df.withColumn("_src", V.members(F.col("_m.source"), ["db", "collection"]))
    bad_payload = wrapped & F.col("_m").isNull()

    def get(member: str, dtype: str):
        return F.try_variant_get(F.col(member), "$", dtype)

    df = df.withColumns({
        "tombstone": F.col("value_text").isNull(),
        # json.loads succeeded but the value is not an object -> dead letter
        "malformed": F.col("value_text").isNotNull() & (
            v.isNull() | ~F.ltrim(F.col("value_text")).startswith("{") | bad_payload),
        "op": get("_m.op", "string"),
        "_before": F.col("_m.before"),
        "_after": F.col("_m.after"),
        "ts_ms": get("_m.ts_ms", "bigint"),
        "source_db": get("_src.db", "string"),
        "source_collection": get("_src.collection", "string"),
        "table_name": table_from_topic(F.col("topic")),
    })
    return (df.withColumns({"before": V.null_if_json_null(F.col("_before")),
                            "after": V.null_if_json_null(F.col("_after"))})
            .drop("_v", "_p", "_m", "_src", "_before", "_after"))


def relational_pk(df_after: Column, df_before: Column, key_text: Column, pk: str) -> Column:
    """Pk from after, else before, else the message key JSON; as text."""
    from_img = F.when(df_after.isNotNull(), F.try_variant_get(df_after, f"$.{pk}", "string")) \
        .otherwise(F.try_variant_get(df_before, f"$.{pk}", "string"))
    from_key = F.try_variant_get(F.try_parse_json(key_text), f"$.{pk}", "string")
    return F.when(df_after.isNotNull() | df_before.isNotNull(), from_img).otherwise(from_key)
