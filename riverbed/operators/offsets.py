"""The ledger of handled messages as ranges of offsets.

The ledger is a row per run of handled offsets, so it grows with gaps, not with
messages.  To work out a batch's runs, to join runs, and to tell which messages
were handled before, offsets are cut into blocks: no window takes more than one
block of a partition into a group, or what touches the blocks' ends, and of the
ledger only what lies in the batch's blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import changes as CH

BLOCK_BITS = 16
BLOCK = 1 << BLOCK_BITS
LANE = ["topic", "partition", "block"]


def _block(offset: Column | str) -> Column:
    return F.shiftright(offset, BLOCK_BITS).cast("bigint")


def positions(feed: DataFrame) -> DataFrame:
    """(topic, partition, offset, block, times) of every message, each once."""
    return feed.groupBy(*CH.WHERE).agg(F.count(F.lit(1)).alias("times")).withColumn("block", _block("offset"))


def numbered(feed: DataFrame, name: str) -> DataFrame:
    """Messages numbered from 0 by offset in their partitions, block by block."""
    blocked = feed.withColumn("block", _block("offset"))
    upto = Window.partitionBy("topic", "partition").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocked.groupBy(*LANE).count().select(*[F.col(c).alias(f"_{c}") for c in LANE], F.sum("count").over(upto).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*LANE).orderBy("offset")) - 1
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LANE]
    return blocked.withColumn("_in", inside).join(before, same, "left").select(
        *feed.columns, (F.coalesce("_before", F.lit(0)) + F.col("_in")).alias(name))


def ranges_of(at: DataFrame) -> DataFrame:
    """Positions -> (topic, partition, first, last): runs without a gap inside
    a block."""
    run = F.col("offset") - F.row_number().over(Window.partitionBy(*LANE).orderBy("offset"))
    return (at.withColumn("_run", run).groupBy(*LANE, "_run")
            .agg(F.min("offset").alias("first"), F.max("offset").alias("last")).select("topic", "partition", "first", "last"))


def _cut(ranges: DataFrame) -> DataFrame:
    """Ranges cut at block ends, with ``block``."""
    cut = ranges.select("topic", "partition", "first", "last", F.explode_outer(F.sequence(_block("first"), _block("last"))).alias("block"))
    start = F.shiftleft("block", BLOCK_BITS)
    return cut.select(*LANE, F.greatest("first", start).alias("first"), F.least("last", start + (BLOCK - 1)).alias("last"))


def _joined(ranges: DataFrame, lane: list[str]) -> DataFrame:
    """Ranges of a lane that overlap or touch become one."""
    w = Window.partitionBy(*lane).orderBy("first", "last")
    before = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.when(before.isNull() | (F.col("first") > before + 1), 1).otherwise(0)
    return (ranges.withColumn("_open", opened).withColumn("_run", F.sum("_open").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy(*lane, "_run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_run"))


def inside_blocks(ranges: DataFrame | None, at: DataFrame | None = None) -> DataFrame:
    """Ranges, and the positions ``at`` beside them, joined inside blocks in one
    ordered pass; ``_ends`` tells the two runs at most of a block that touch its
    ends, so that only they can go on in another block."""
    rows = [] if ranges is None else [_cut(ranges)]
    if at is not None:
        rows.append(at.select(*LANE, F.col("offset").alias("first"), F.col("offset").alias("last")))
    inside = _joined(rows[0].unionByName(rows[-1]) if len(rows) > 1 else rows[0], LANE)
    start = F.shiftleft("block", BLOCK_BITS)
    return inside.withColumn("_ends", F.coalesce((F.col("first") == start) | (F.col("last") == start + (BLOCK - 1)), F.lit(False)))


def across_blocks(inside: DataFrame) -> DataFrame:
    """What ``inside_blocks`` gave, as ranges whose parts in several blocks are one."""
    columns = ["topic", "partition", "first", "last"]
    return inside.where(~F.col("_ends")).select(*columns).unionByName(
        _joined(inside.where("_ends").select(*columns), ["topic", "partition"]))


def merged(ranges: DataFrame) -> DataFrame:
    """Ranges that overlap or touch become one: as many rows as there are gaps.
    ``inside_blocks`` is read twice: a caller with many ranges writes it first."""
    return across_blocks(inside_blocks(ranges))


def handled(at: DataFrame, ranges: DataFrame) -> DataFrame:
    """The positions that lie in ``ranges`` (which do not overlap).  Ranges are
    clipped to the span of the positions and cut at block ends; in a block the
    range that begins last at or before a position decides, found by one
    ordered pass over positions and range starts."""
    span = at.groupBy("topic", "partition").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
    inside = (ranges.join(span, ["topic", "partition"]).where((F.col("last") >= F.col("low")) & (F.col("first") <= F.col("high")))
              .withColumns({"first": F.greatest("first", "low"), "last": F.least("last", "high")}))
    cut = inside.select("topic", "partition", "first", "last", F.explode(F.sequence(_block("first"), _block("last"))).alias("block"))
    start = F.shiftleft("block", BLOCK_BITS)
    cut = cut.select(*LANE, F.greatest("first", start).alias("offset"), F.least("last", start + (BLOCK - 1)).alias("_end"), F.lit(0).alias("_asks"))
    both = at.select(*LANE, "offset", F.lit(None).cast("bigint").alias("_end"), F.lit(1).alias("_asks")).unionByName(cut)
    end = F.last("_end", ignorenulls=True).over(Window.partitionBy(*LANE).orderBy("offset", "_asks")
                                                .rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("_end", end).where((F.col("_asks") == 1) & (F.col("offset") <= F.col("_end"))).select(*CH.WHERE)
