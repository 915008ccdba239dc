"""Best-fit packing of token sequences by the sum-of-squares rule: a piece goes
where the sum, over residual gaps, of the squared number of open bins with
that gap becomes smallest.

Pieces are packed in blocks of a bounded number of rows, so no task holds all.
The pieces in bins that a block leaves open are packed again in a second
round, over blocks of such pieces.

The rule wants gaps of every size open, so it does badly on items that come
sorted, and items that come at random leave large ones for the end.  Items
come by 64 classes of size, largest first, and in random order within.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import ship_package, utf8, written
from riverbed.llm.tokens import encoder


def cut(length: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all of ``most`` ids but the
    first, which may be shorter."""
    first = min(length, length % most or most)
    return [(0, first)] + [(s, most) for s in range(first, length, most)]


def _pieces(path: str, end_id: int, most: int, with_ids: bool):
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            row, piece, start, length, crc, body = [], [], [], [], [], []
            for i, t in enumerate(utf8(b.column(1))):
                ids = enc.encode(t.decode()) + end
                for k, (s, n) in enumerate(cut(len(ids) // 4, most)):
                    part = ids[4 * s:4 * (s + n)]
                    row.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    body.append(part if with_ids else None)
            arrays = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                      pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(body, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "piece", "start", "length", "ids_crc32", "ids"])
    return run


def pieces(docs: DataFrame, path: str, end_id: int = 2, most: int = 1024, id_col: str = "doc_id", text: str = "text",
           with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id``, piece, start, length, ids_crc32, and ids
    (little-endian unsigned 32-bit) if asked for.  A null or empty text is
    the end id alone."""
    ship_package(docs.sparkSession)
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    out = base.mapInArrow(_pieces(path, end_id, most, with_ids),
                          f"id {base.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, ids binary")
    return out if with_ids else out.drop("ids")


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, in their order.

    An item of size s in a bin with gap g changes the sum by
    2 - 2 N(g) + 2 N(g - s) (by 1 - 2 N(g) if it fills the bin) and a new bin
    by 1 + 2 N(capacity - s); of equal changes the smallest gap is taken, a
    new bin last.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    twice = np.zeros(capacity + 1, np.int64)            # 2 N(gap); gap 0 is no longer open
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    far, n = np.int64(1) << 60, 0
    for i, s in enumerate(sizes.tolist()):
        here = twice[s:capacity]
        change = np.where(here > 0, 2 - here + twice[:capacity - s], far)
        if len(change):
            change[0] -= 1
            g = int(np.argmin(change))
            old = int(change[g])
        else:
            g, old = 0, int(far)
        if old <= (int(twice[capacity - s]) + 1 if s < capacity else 0):
            g += s
            b = open_bins[g].pop()
            twice[g] -= 2
        else:
            b, g, n = n, capacity, n + 1
        bins[i], offsets[i] = b, capacity - g
        if g > s:
            open_bins[g - s].append(b)
            twice[g - s] += 2
    return bins, offsets


def _pack(most: int, classes: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.iloc[np.lexsort((block["luck"], -(block["size"] * classes // most)))]
        size = block["size"].to_numpy()
        bins, offsets = sum_of_squares(size, most)
        filled = np.bincount(bins, weights=size).astype(np.int64)
        return pd.DataFrame({"item": block["item"].to_numpy(), "bin": (block["block"].to_numpy() << 32) + bins,
                             "at": offsets, "filled": filled[bins]})
    return run


def _packed(items: DataFrame, most: int, block_rows: int, classes: int) -> DataFrame:
    """(item, bin, at, filled) for (item, size) rows, in blocks; ``classes`` of
    sizes, the largest first."""
    blocks = max(1, -(-items.count() // block_rows))
    luck = F.xxhash64("item")
    return (items.select("item", "size", luck.alias("luck"), F.pmod(luck, F.lit(blocks)).cast("long").alias("block"))
            .groupBy("block").applyInPandas(_pack(most, classes), "item long, bin long, at long, filled long"))


def pack(docs: DataFrame, path: str, end_id: int = 2, most: int = 1024, id_col: str = "doc_id", text: str = "text",
         block_rows: int = 100_000, with_ids: bool = False) -> DataFrame:
    """One row per piece: the id, piece, start, length, ids_crc32 (and ids),
    sequence_id and offset, its place there, gapless from 0.

    Every row of ``docs`` is a document, repeated and null ids too; a null
    text is an empty one; an empty table gives an empty result; other columns
    are ignored.  Pieces of ``most`` ids are sequences of their own.
    """
    cut_up = written(pieces(docs, path, end_id, most, id_col, text, with_ids)
                     .withColumn("item", F.monotonically_increasing_id()), "packing")
    part = cut_up.where(F.col("length") < most).select("item", F.col("length").alias("size"))
    first = written(_packed(part, most, block_rows, 64).join(part, "item"), "packing")
    left = written(first.where(F.col("filled") < most).select("item", "size"), "packing")
    again = _packed(left, most, block_rows, most)
    # three ranges of numbers: filled in the first round, packed again, whole pieces
    placed = first.where(F.col("filled") == most).select("item", (F.col("bin") * 4).alias("number"), "at").union(
        again.select("item", F.col("bin") * 4 + 1, "at"))
    number = F.coalesce(F.col("number"), F.col("item") * 4 + 2)
    at = F.coalesce(F.col("at"), F.lit(0)).cast("long")
    out = cut_up.join(placed, "item", "left")
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []),
                      number.alias("sequence_id"), at.alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): the packed sequences themselves, from
    ``pack(..., with_ids=True)``; a sequence has at most ``most`` ids."""
    id_col = packed.columns[0]
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", F.col(id_col).alias("doc"))))
    got = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return got.select("sequence_id", F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
                      F.transform("parts", lambda p: p["doc"]).alias("doc_ids"))
