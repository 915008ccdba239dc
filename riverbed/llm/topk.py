"""Exact top-k search by exhaustive term-at-a-time accumulation.

Each row group keeps an inverted index: for every component position (term),
postings of the rows whose component is not zero there, with the component as
weight.  A query scatters its weight times the postings of each of its terms
into a dense array of scores, a block of queries and a tile of rows at a time.
A partition of the scores selects each query's best of the tile, which merge
with the best so far; the row groups' answers merge by a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverbed.llm.cells import Best, cell_runner, flat, kth, meet, numbered, to_long

TILE_ROWS = 1024
BLOCK_QUERIES = 256


def _postings(lengths: np.ndarray, values: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """term -> (rows, ascending; weights) of the components that are not zero."""
    rows = np.repeat(np.arange(len(lengths)), lengths)
    terms = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    there = values != 0
    rows, terms, values = rows[there], terms[there], values[there]
    order = np.argsort(terms, kind="stable")
    rows, terms, values = rows[order], terms[order], values[order]
    cuts = np.flatnonzero(np.diff(terms)) + 1
    starts = [0, *cuts.tolist(), len(terms)] if len(terms) else [0]
    return {int(terms[a]): (rows[a:b], values[a:b]) for a, b in zip(starts, starts[1:])}


def _norm(lengths: np.ndarray, values: np.ndarray) -> float:
    """The largest Euclidean norm, rounded up."""
    if not len(values):
        return 0.0
    squares = np.concatenate(([0.0], np.cumsum(values.astype(np.float64) ** 2)))
    ends = np.cumsum(lengths)
    return float(np.sqrt(max(0.0, (squares[ends] - squares[ends - lengths]).max()))) * (1 + 1e-6) + 1


class Postings:
    """The inverted index of a row group, by tiles of rows in the order of
    their ids (null last), so that places break ties."""

    def __init__(self, rows: pa.Table):
        order = pc.sort_indices(rows["id"], null_placement="at_end")
        rows = rows.take(order).combine_chunks()
        self.ids, self.row = rows["id"].combine_chunks(), rows["row"].to_numpy()
        lengths, values = flat(rows["vector"])
        ends = np.concatenate(([0], np.cumsum(lengths)))
        self.tiles, self.norm = [], 0.0
        for a in range(0, len(lengths), TILE_ROWS):
            z = min(a + TILE_ROWS, len(lengths))
            part = lengths[a:z], values[ends[a]:ends[z]]
            self.norm = max(self.norm, _norm(*part))
            self.tiles.append((a, z - a, _postings(*part)))

    def scores(self, tile: tuple, query: dict, n: int, kind) -> np.ndarray:
        """(queries, rows of the tile): each shared term adds weight times
        weight, scattered over the rows of its postings."""
        _, size, postings = tile
        acc = np.zeros((n, size), kind)
        for term, (rows, weights) in postings.items():
            if term not in query:
                continue
            qs, qw = (x.astype(t) for x, t in zip(query[term], (np.int64, kind)))
            if 2 * len(rows) >= size:           # over most rows, one dense line of weights is scattered once for all queries
                line, rows = np.zeros(size, kind), slice(None)
                line[postings[term][0]] = weights
            else:
                line = weights.astype(kind)
            if 2 * len(qs) >= n:
                every, qs = np.zeros(n, kind), slice(None)
                every[query[term][0]] = qw
                acc[:, rows] += every[:, None] * line[None, :]
            elif isinstance(rows, slice):
                acc[qs] += qw[:, None] * line[None, :]
            else:
                acc[np.ix_(qs, rows)] += qw[:, None] * line[None, :]
        return acc


def _kind(bound: float):
    """The narrowest numbers that hold every partial sum: by Cauchy-Schwarz
    none exceeds the product of the two norms."""
    for kind, most in ((np.int16, 2.0 ** 15 - 1), (np.int32, 2.0 ** 31 - 1), (np.int64, 2.0 ** 62)):
        if bound < most:
            return kind
    return object


def _answer(k: int):
    def run(index: Postings, queries: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, queries.num_rows, BLOCK_QUERIES):
            block = pa.Table.from_batches([queries.slice(at, BLOCK_QUERIES)])
            n, own = block.num_rows, block["row"].to_numpy()
            vectors = flat(block["vector"])
            query, kind = _postings(*vectors), _kind(index.norm * _norm(*vectors))
            best = Best(n, k + 1)                      # the query's own row may be among them
            for tile in index.tiles:
                s = index.scores(tile, query, n, kind)
                if kind is object:
                    s = to_long(s)
                # later tiles have larger ids: an equal score no longer enters
                if kind is np.int16:
                    s = s.astype(np.int32)             # numpy partitions these faster
                take = ((s > best.least[:, None]) | ~best.full[:, None]) & (s >= kth(s, k + 1)[:, None])
                q, i = np.nonzero(take)
                best.offer(q, s[q, i].astype(np.int64), i + tile[0])
            other = index.row[best.i] != own[best.q]
            q, i, s = best.q[other], best.i[other], best.s[other]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[q]), block["id"].combine_chunks().take(pa.array(q)), index.ids.take(pa.array(i)), pa.array(s)],
                names=["row", "query_id", "id", "score"])
    return run


def top_k(rows: DataFrame, query: Column, k: int = 20, id_col: str = "vec_id", vector: str = "vector") -> DataFrame:
    """query_id, rank (int, from 1), the id column and score (long): for every
    row that satisfies ``query``, its ``k`` other rows of the highest inner
    product (all, if there are fewer), ties by smaller id.

    ``vector`` is an array of longs.  Rows whose vector is null or holds a null
    take no part.  A missing component counts as zero, so vectors may differ in
    length and an empty one scores 0.  Rows that repeat an id are candidates of
    their own, for each other too; a null id comes last among ties.  A score
    beyond a long becomes the nearest long.  An empty table, or no query, gives
    an empty result; other columns are ignored.
    """
    v = F.col(f"`{vector}`")
    base = numbered(rows.select(F.col(f"`{id_col}`").alias("id"), v.cast("array<long>").alias("vector"),
                                F.coalesce(query, F.lit(False)).alias("asks"))
                    .where(F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull())), "topk")
    n, size, asks = base.agg(F.count(F.lit(1)), F.sum(F.size("vector")), F.count_if("asks")).first()
    body = base.select("row", "id", "vector")
    id_type = base.schema["id"].dataType.simpleString()
    found = meet(body, base.where("asks").select("row", "id", "vector"), cell_runner(Postings, _answer(k)),
                 f"row long, query_id {id_type}, id {id_type}, score long", n, size or 0, asks)
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
