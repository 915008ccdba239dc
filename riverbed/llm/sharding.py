"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Each shard draws a number ``u`` in (0, 1) from a hash of (key, shard); the key
goes to the shard with the largest ``-weight / ln(u)``.  A shard's draws do
not depend on the other shards: adding one moves rows only into it, and a
change of one weight moves rows only to or from that shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riverbed.llm.common import free_name, written


def draw(key: Column, shard: int, seed: str = "rendezvous") -> Column:
    """A number in (0, 1) from the hash of (key, shard): the top 52 bits of
    the hash, so that it is exact in a double and never 0 or 1."""
    h = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard), F.lit(seed)), 12)
    return (h.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard (0 to len(weights) - 1) of ``key``; ties go to the lowest
    shard.  A null key has the hash of a null and so one shard.  Weights must
    not be negative; a shard of weight 0 gets no rows while another has a
    weight above 0."""
    if not weights or min(weights) < 0:
        raise ValueError("weights: at least one, none negative")
    # array_max compares (score, -shard)
    best = F.array_max(F.array(*[
        F.struct((F.lit(-float(w)) / F.log(draw(key, s))).alias("score"), F.lit(-s).alias("neg"))
        for s, w in enumerate(weights)]))
    return (-best["neg"]).cast("int")


def assign(docs: DataFrame, weights: list[float], key: str = "doc_id", text: str = "text",
           grown_weight: float = 1.0, block_rows: int = 1 << 16) -> DataFrame:
    """One row per row of ``docs``: the key, size (UTF-8 bytes of the text,
    0 for null, plus 1), text_crc32 (of the empty text for null), shard, slot
    (place in the shard, gapless from 0) and grown_shard (the shard once one
    more of ``grown_weight`` is there).

    Null and repeated keys are rows like any other: equal keys share a shard,
    each row has a slot of its own.  An empty table gives an empty result.
    Other columns of ``docs`` are ignored.

    Slots are numbered in blocks of at most ``block_rows`` rows of an input
    partition, then shifted by the counts of the blocks before, so no task
    holds a shard: a shard, source or key of any size is spread over blocks.
    The narrow rows (no texts) are written to the shared folder first, since
    the blocks follow the input's order, which must not change after that.
    """
    ident, words = F.col(f"`{key}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    body = F.encode(words, "UTF-8")
    narrow = written(docs.select(
        ident.alias("key"),
        (F.octet_length(words) + F.lit(1)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        rendezvous(ident, weights).alias("shard"),
        rendezvous(ident, [*weights, grown_weight]).alias("grown_shard"),
        F.monotonically_increasing_id().alias("row")), "shards")
    # a partition's row numbers start at a multiple of 2^33, which block_rows divides
    blocks = narrow.withColumn("block", F.floor(F.col("row") / F.lit(block_rows)))
    counts = blocks.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "block").orderBy("row")
    numbered = blocks.withColumn("place", F.row_number().over(inside) - F.lit(1))
    return numbered.join(starts, ["shard", "block"]).select(
        F.col("key").alias(key), "size", "text_crc32", "shard",
        (F.col("first") + F.col("place")).cast("long").alias("slot"), "grown_shard")


def moved(assigned: DataFrame) -> DataFrame:
    """Rows that change shard when one is added: per (shard, grown_shard) the
    number of rows and bytes."""
    n = free_name(assigned, "rows")
    return (assigned.where(F.col("shard") != F.col("grown_shard"))
            .groupBy("shard", "grown_shard").agg(F.count(F.lit(1)).alias(n), F.sum("size").alias("bytes")))
