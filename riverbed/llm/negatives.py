"""Hard negatives by anchor-clustered shared lists.

Anchors are grouped into clusters of similar direction.  No member of a
cluster is further than the cluster's angle from its center, so a candidate's
product with any member, over the member's norm, is at most

    norm * cos(max(0, angle to the center - the cluster's angle)).

Every row group sorts its candidates by this bound once for each cluster;
every member walks the shared list from the top, and stops where the bound
certifies that nothing further down can enter its answer.  A first walk finds
each anchor's positives (best rows of its label), a second one the best rows
of other labels within each positive's window of scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverbed.llm.cells import LEAST, MOST, Best, cell_runner, flat, kth, meet, numbered, to_long
from riverbed.llm.common import written

#: the clusters' centers are fitted on at most so many anchors, and components
SAMPLE_ANCHORS = 2048
SAMPLE_COMPONENTS = 1 << 21
CLUSTER_ANCHORS = 256
MOST_CLUSTERS = 256
CHUNK = 1024
MEMBERS = 256


def _padded(lengths: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(lengths), width), values.dtype)
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


def _unit(m: np.ndarray) -> np.ndarray:
    """Rows of length 1; a zero row becomes the first axis."""
    m = m.astype(np.float64)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    axis = np.zeros_like(m)
    axis[:, :1] = 1.0
    return np.where(norm > 0, m / np.where(norm > 0, norm, 1), axis)


def fit_centers(vectors: list[list[int]], clusters: int, rounds: int = 8) -> np.ndarray:
    """Unit centers by spherical k-means, started from evenly spaced vectors."""
    width = max([1, *map(len, vectors)])
    m = _unit(np.array([[*v, *[0] * (width - len(v))] for v in vectors], np.float64).reshape(len(vectors), width))
    centers = m[np.linspace(0, len(m) - 1, min(clusters, len(m))).astype(int)] if len(m) else np.zeros((0, width))
    for _ in range(rounds if len(m) else 0):
        near = (m @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, m)
        centers = np.where(np.bincount(near, minlength=len(centers))[:, None] > 0, _unit(sums), centers)
    return centers


def _by_length(lengths: np.ndarray, values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the vectors of each length."""
    starts = np.cumsum(lengths) - lengths
    for width in np.unique(lengths):
        at = np.flatnonzero(lengths == width)
        yield at, values[starts[at][:, None] + np.arange(width)[None, :]]


def _angles(m: np.ndarray, norms: np.ndarray, center: np.ndarray) -> np.ndarray:
    """Angle of each row to a unit center; 0 for zero rows, which score 0."""
    width = min(m.shape[1], len(center))
    cos = m[:, :width].astype(np.float64) @ center[:width] / np.where(norms > 0, norms, 1)
    return np.where(norms > 0, np.arccos(np.clip(cos, -1, 1)), 0.0)


def _assign(centers: np.ndarray):
    """Adds each anchor's nearest center and the angle to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near, angle = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows)
            for at, m in _by_length(*flat(b.column(b.schema.get_field_index("vector")))):
                m = m.astype(np.float64)
                norms, width = np.linalg.norm(m, axis=1), min(m.shape[1], centers.shape[1])
                near[at] = (m[:, :width] @ centers[:, :width].T).argmax(axis=1)
                for c in np.unique(near[at]):
                    mine = near[at] == c
                    angle[at[mine]] = _angles(m[mine], norms[mine], centers[c])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near), pa.array(angle)], names=[*b.schema.names, "cluster", "angle"])
    return run


class Lists:
    """A row group's candidates, with one list sorted by bound for the cluster
    last asked for.  Places follow the ids (null last)."""

    def __init__(self, rows: pa.Table, centers: np.ndarray, spread: list[float]):
        rows = rows.take(pc.sort_indices(rows["id"], null_placement="at_end")).combine_chunks()
        self.ids, self.row = rows["id"].combine_chunks(), rows["row"].to_numpy()
        coded = rows["label"].combine_chunks().dictionary_encode()
        self.labels, self.codes = coded.indices.to_numpy(), {v: i for i, v in enumerate(coded.dictionary.to_pylist())}
        self.parts = [(at, m, np.linalg.norm(m.astype(np.float64), axis=1)) for at, m in _by_length(*flat(rows["vector"]))]
        self.centers, self.spread, self.cluster = centers, spread, None

    def of(self, cluster: int) -> list[tuple]:
        """Per vector length: places, vectors, and their bound, which falls."""
        if cluster != self.cluster:
            self.cluster, self.sorted = cluster, []
            for at, m, norms in self.parts:
                # 1e-6 rad more than any rounding of the angles
                gap = np.maximum(0.0, _angles(m, norms, self.centers[cluster]) - self.spread[cluster] - 1e-6)
                bound = norms * np.cos(np.minimum(gap, np.pi))
                order = np.argsort(-bound, kind="stable")
                self.sorted.append((at[order], m[order], bound[order], float(norms.max())))
        return self.sorted


def _products(a: np.ndarray, c: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products as longs; a missing component counts as zero."""
    width = min(a.shape[1], c.shape[1])
    a, c = a[:, :width], c[:, :width]
    if bound < 2.0 ** 52:                   # every partial sum is an integer that a double holds
        return (a.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if not width:
        return np.zeros((len(a), len(c)), np.int64)
    return to_long(a.astype(object) @ c.astype(object).T)


def _walk(index: Lists, cluster: int, members: np.ndarray, visit, need) -> None:
    """Every member walks the cluster's list by chunks until what it needs,
    ``need()``, is above the bound.  ``visit(active members, places, scores)``
    takes the scores of a chunk."""
    norms = np.linalg.norm(members.astype(np.float64), axis=1)
    for places, vectors, bound, longest in index.of(cluster):
        exact = float(norms.max(initial=0)) * longest * (1 + 1e-6) + 1
        for a in range(0, len(places), CHUNK):
            reach = norms * bound[a]
            reach += np.abs(reach) * 1e-9 + 1e-6
            active = np.flatnonzero(reach >= need())
            if not len(active):
                break
            z = a + CHUNK
            visit(active, places[a:z], _products(members[active], vectors[a:z], exact))


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Table, np.ndarray]]:
    """(cluster, rows, vectors): up to MEMBERS members of one cluster and
    vector length."""
    t = pa.Table.from_batches([batch])
    clusters, (lengths, values) = t["cluster"].to_numpy(), flat(t["vector"])
    starts = np.cumsum(lengths) - lengths
    cuts = [0, *(np.flatnonzero((np.diff(clusters) != 0) | (np.diff(lengths) != 0)) + 1).tolist(), t.num_rows]
    for first, end in zip(cuts, cuts[1:]):
        for a in range(first, end, MEMBERS):
            z = min(a + MEMBERS, end)
            yield int(clusters[a]), t.slice(a, z - a), values[starts[a]:starts[z - 1] + lengths[z - 1]].reshape(z - a, lengths[a])


def _labels(index: Lists, rows: pa.Table) -> np.ndarray:
    return np.array([index.codes.get(v, -1) for v in rows["label"].to_pylist()])


def _positives(k: int):
    def run(index: Lists, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for cluster, rows, members in _slices(batch):
            label, own, best = _labels(index, rows), rows["row"].to_numpy(), Best(rows.num_rows, k)

            def visit(active, places, s):
                fits = (label[active][:, None] == index.labels[places][None, :]) & (index.row[places][None, :] != own[active][:, None])
                fits &= s >= best.least[active][:, None]
                fits &= s >= kth(np.where(fits, s, LEAST), k)[:, None]
                q, i = np.nonzero(fits)
                best.offer(active[q], s[q, i], places[i])

            _walk(index, cluster, members, visit, lambda: np.where(best.full, best.least.astype(np.float64), -np.inf))
            yield pa.RecordBatch.from_arrays([pa.array(own[best.q]), index.ids.take(pa.array(best.i)), pa.array(best.s)],
                                             names=["row", "id", "score"])
    return run


def _window(p: int, low: tuple[int, int], high: tuple[int, int]) -> tuple[int, int]:
    """The scores n with low * p <= n <= high * p, as whole numbers."""
    lo, hi = -((-low[0] * p) // low[1]), (high[0] * p) // high[1]
    return max(int(LEAST) + 1, lo), min(int(MOST), hi)


def _negatives(k: int, slots: int, low: tuple[int, int], high: tuple[int, int]):
    def run(index: Lists, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for cluster, rows, members in _slices(batch):
            n, label, own = rows.num_rows, _labels(index, rows), rows["row"].to_numpy()
            lo, hi = np.full((slots, n), MOST), np.full((slots, n), LEAST)
            for r, scores in enumerate(rows["scores"].to_pylist()):
                for j, p in enumerate(scores):
                    lo[j, r], hi[j, r] = _window(p, low, high)
            open_, best = lo <= hi, [Best(n, k) for _ in range(slots)]

            def visit(active, places, s):
                other = label[active][:, None] != index.labels[places][None, :]
                for j, b in enumerate(best):
                    fits = other & (s <= hi[j, active][:, None]) & (s >= np.maximum(lo[j, active], b.least[active])[:, None])
                    if fits.any():
                        fits &= s >= kth(np.where(fits, s, LEAST), k)[:, None]
                        q, i = np.nonzero(fits)
                        b.offer(active[q], s[q, i], places[i])

            def need():
                return np.min([np.where(open_[j], np.maximum(lo[j], b.least).astype(np.float64), np.inf)
                               for j, b in enumerate(best)], axis=0)

            _walk(index, cluster, members, visit, need)
            for j, b in enumerate(best):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[b.q]), pa.array(np.full(len(b.q), j + 1, np.int32)), index.ids.take(pa.array(b.i)), pa.array(b.s)],
                    names=["row", "slot", "id", "score"])
    return run


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: tuple[int, int] = (50, 100),
         high: tuple[int, int] = (95, 100), id_col: str = "vec_id", label: str = "label", vector: str = "vector") -> DataFrame:
    """anchor_id, positive_id, rank (int), negative_id, positive_score and
    negative_score (long): for each row that satisfies ``anchor`` and each of
    its first ``positives`` other rows of the same label, the first
    ``negatives`` rows of another label whose score lies between ``low`` and
    ``high`` (fractions) of the positive's; higher inner products come first,
    ties by smaller id.

    ``vector`` is an array of longs; labels are compared by their text.  Rows
    with a null label, a null vector or a null component take no part.  A
    missing component counts as zero.  Rows that repeat an id are rows of their
    own: an anchor may be another anchor's positive under the same id, and
    repeated positives each have their negatives.  A null id comes last among
    ties.  A score beyond a long becomes the nearest long.  A positive without
    fitting negatives, and an anchor without positives, give no rows; an empty
    table gives none; other columns are ignored.
    """
    v = F.col(f"`{vector}`")
    base = numbered(rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("string").alias("label"),
                                v.cast("array<long>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("asks"))
                    .where(F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull())),
                    "negatives")
    n, size, asks, widest = base.agg(F.count(F.lit(1)), F.sum(F.size("vector")), F.count_if("asks"),
                                     F.max(F.when(F.col("asks"), F.size("vector")))).first()
    body, ask = base.select("row", "id", "label", "vector"), base.where("asks").select("row", "id", "label", "vector")
    most = max(1, min(SAMPLE_ANCHORS, SAMPLE_COMPONENTS // max(1, widest or 1)))
    sample = ask.orderBy(F.xxhash64("row")).limit(most).select("vector").collect()
    centers = fit_centers([r[0] for r in sample], max(1, min(MOST_CLUSTERS, -(-asks // CLUSTER_ANCHORS))))
    id_type = base.schema["id"].dataType.simpleString()
    ask = written(ask.mapInArrow(_assign(centers), f"row long, id {id_type}, label string, vector array<long>, cluster int, angle double"),
                  "negatives")
    spread = [0.0] * len(centers)
    for r in ask.groupBy("cluster").agg(F.max("angle")).collect():        # at most MOST_CLUSTERS rows
        spread[r[0]] = r[1]

    def walk(queries: DataFrame, answer, ddl: str) -> DataFrame:
        runner = cell_runner(lambda t: Lists(t, centers, spread), answer)
        return meet(body, queries.withColumn("width", F.size("vector")), runner, ddl, n, size or 0, asks, ("cluster", "width", "row"))

    def ranked(found: DataFrame, *keys: str) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(
            Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))))

    first = ranked(walk(ask, _positives(positives), f"row long, id {id_type}, score long"), "row").where(F.col("rank") <= positives)
    chosen = written(first.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("chosen")), "negatives")
    found = walk(ask.join(chosen, "row").withColumn("scores", F.col("chosen.score")).drop("chosen"),
                 _negatives(negatives, positives, low, high), f"row long, slot int, id {id_type}, score long")
    kept = ranked(found, "row", "slot").where(F.col("rank") <= negatives)
    named = ask.select("row", F.col("id").alias("anchor_id")).join(chosen, "row").select(
        "row", "anchor_id", F.posexplode("chosen").alias("slot", "p")).withColumn("slot", F.col("slot") + 1)
    return kept.join(named, ["row", "slot"]).select(
        "anchor_id", F.col("p.id").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))
