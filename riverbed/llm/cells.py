"""All rows met by a stated query set, in bounded cells.

Rows are dealt evenly over row groups and queries over query groups; a cell is
one pair of groups.  A task takes a cell: its rows first, then its queries as
a stream.  Rows are dealt by a row number that is written with them, not by
their key, so a key that a third of the rows share spreads like any other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import ship_package, written

#: components of the vectors of a row group, and queries of a query group
GROUP_COMPONENTS = 1 << 23
GROUP_QUERIES = 1 << 18
LEAST = np.iinfo(np.int64).min
MOST = np.iinfo(np.int64).max


def quantized(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, x as double; null for a vector
    that is null or holds a null or non-finite component.  What a long cannot
    hold becomes the nearest long."""
    def fine(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.when(F.forall(vector, fine), F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


def numbered(rows: DataFrame, kind: str) -> DataFrame:
    """``rows`` with a unique ``row`` number, written to the shared folder, so
    that every later reading sees the same numbers."""
    ship_package(rows.sparkSession)
    return written(rows.withColumn("row", F.monotonically_increasing_id()), kind)


def meet(rows: DataFrame, queries: DataFrame, run: Callable, ddl: str, n_rows: int, components: int, n_queries: int,
         order: tuple[str, ...] = ()) -> DataFrame:
    """``run`` over every cell, by ``mapInArrow``.  Both sides have ``row``;
    columns of one side only are null in the other.  A cell's queries come
    sorted by ``order``.  Only the smaller side, the queries, is written out
    once per row group; rows are, once per query group of 262,144 queries."""
    spread = 2 * rows.sparkSession.sparkContext.defaultParallelism
    across = max(1, math.ceil(components / GROUP_COMPONENTS), min(spread, math.ceil(n_rows / 1024)))
    down = max(1, math.ceil(n_queries / GROUP_QUERIES))
    lane = F.pmod(F.xxhash64("row"), F.lit(across)) * down
    shelf = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(down))
    a = rows.select("*", F.lit(0).alias("kind"), F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(down - 1)), lambda s: lane + s)).alias("cell"))
    b = queries.select("*", F.lit(1).alias("kind"), F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(across - 1)), lambda r: r * down + shelf)).alias("cell"))
    both = a.unionByName(b, allowMissingColumns=True)
    placed = both.repartitionById(across * down, F.col("cell").cast("int")).sortWithinPartitions("cell", "kind", *order)
    return placed.mapInArrow(run, ddl)


def cell_runner(build: Callable[[pa.Table], object], answer: Callable[[object, pa.RecordBatch], Iterator[pa.RecordBatch]]):
    """A ``mapInArrow`` function: ``build`` makes an index of a cell's rows,
    ``answer`` is called with every batch of its queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, index = None, [], None
        for b in batches:
            at, kinds = (b.column(b.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in ("cell", "kind"))
            cuts = [0, *(np.flatnonzero((np.diff(at) != 0) | (np.diff(kinds) != 0)) + 1).tolist(), b.num_rows]
            for first, end in zip(cuts, cuts[1:]):
                if first == end:
                    continue
                part = b.slice(first, end - first)
                if at[first] != cell:
                    cell, held, index = at[first], [], None
                if kinds[first] == 0:
                    held.append(part)
                elif held or index is not None:
                    if index is None:
                        index, held = build(pa.Table.from_batches(held).combine_chunks()), []
                    yield from answer(index, part)
    return run


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(length of each vector, all components in a row)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    lengths = pc.list_value_length(col).to_numpy(zero_copy_only=False).astype(np.int64)
    return lengths, col.flatten().to_numpy(zero_copy_only=False)


def to_long(scores: np.ndarray) -> np.ndarray:
    """Exact scores as longs; Python integers beyond them become the nearest."""
    if scores.dtype == object:
        return np.clip(scores, int(LEAST), int(MOST)).astype(np.int64)
    return scores.astype(np.int64, copy=False)


class Best:
    """The ``k`` best (score, place) of each of ``n`` queries: higher scores
    first, ties by smaller place."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.q = self.s = self.i = np.empty(0, np.int64)
        self.full = np.zeros(n, bool)
        #: the score that a place must reach to enter
        self.least = np.full(n, LEAST)

    def offer(self, q: np.ndarray, s: np.ndarray, i: np.ndarray) -> None:
        if not len(q):
            return
        q, s, i = np.concatenate((self.q, q)), np.concatenate((self.s, s)), np.concatenate((self.i, i))
        order = np.lexsort((i, ~s, q))
        q, s, i = q[order], s[order], i[order]
        first = np.concatenate(([True], q[1:] != q[:-1]))
        rank = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
        stay = rank < self.k
        self.q, self.s, self.i = q[stay], s[stay], i[stay]
        last = rank == self.k - 1
        self.full[q[last]] = True
        self.least[q[last]] = s[last]


def kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest score of each row, by partition; the least long for a
    row of fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), LEAST)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k].astype(np.int64)
