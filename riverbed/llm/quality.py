"""Quality rules: counts of fixed rules, and an isolation forest over their
statistics whose threshold is calibrated from labelled rows.

The forest grows from labelled good documents: each tree takes a small random
set of them and splits it at random values of random statistics, drawn over
the range that all labelled documents span.  A document unlike the good ones
soon falls into a part that holds none of them, so its path is short.  A
statistic is drawn as often as it tells labelled good from bad rows apart.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import free_name, ship_package, utf8, written

_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"                  # fixed values: the rule's symbols
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATS = ["mean_word", "symbols", "dup_lines", "repeats", "capitals", "exclaims"]


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _repeated(words: list[bytes]) -> int:
    """Words in a 3-word window that occurs twice or more."""
    ids = _Ids()
    x = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    if len(x) < 3:
        return 0
    if len(ids) < 1 << 21:
        grams = (x[:-2] << 42) | (x[1:-1] << 21) | x[2:]
    else:                               # two ids that stand for the pairs, then for the pairs and the third
        _, pair = np.unique((x[:-2] << 32) | x[1:-1], return_inverse=True)
        grams = (pair << 32) | x[2:]
    _, back, n = np.unique(grams, return_inverse=True, return_counts=True)
    twice = n[back] > 1
    mark = np.zeros(len(x), bool)
    for k in range(3):
        mark[k:k + len(twice)] |= twice
    return int(mark.sum())


def measure(text: bytes) -> tuple[list[int], list[float]]:
    """The rule counts of a text (as in COUNTS) and its statistics (STATS)."""
    words = text.split()
    n = len(words)
    solid = text.translate(None, _SPACE)
    chars = len(solid.decode())
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeat = _repeated(words)
    count = lambda drop: len(solid) - len(solid.translate(None, drop))
    symbols = count(_SYMBOLS)
    counts = [n, chars, symbols, dup, repeat]
    # shares, the middle two drawn to 0 where a few lines or words say little
    stats = [chars / max(n, 1), min(symbols / max(n, 1), 4.0), dup / (len(lines) + 5), repeat / (n + 50),
             count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / max(chars, 1), min(solid.count(b"!") / max(n, 1), 4.0)]
    return counts, stats


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [measure(t) for t in utf8(b.column(b.num_columns - 1))]
        arrays = list(b.columns[:-1])
        arrays += [pa.array([g[0][i] for g in got], pa.int64()) for i in range(len(COUNTS))]
        arrays.append(pa.array([g[1] for g in got], pa.list_(pa.float64())))
        yield pa.RecordBatch.from_arrays(arrays, names=[f"c{i}" for i in range(len(arrays))])


def measures(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns under names c0.., then COUNTS and ``stats``."""
    ship_package(docs.sparkSession)
    base = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("t"))
    types = [f.dataType.simpleString() for f in base.schema.fields[:-1]] + ["long"] * len(COUNTS) + ["array<double>"]
    out = base.mapInArrow(_measured, ", ".join(f"c{i} {t}" for i, t in enumerate(types)))
    return out.toDF(*[f"c{i}" for i in range(len(keep))], *COUNTS, "stats")


def base_failed():
    """The fixed rules: under 50 words, or over half of the words in repeated
    windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


# ------------------------------------------------------------------ forest

def _mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n points."""
    return 0.0 if n < 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


class Forest:
    """Isolation trees as arrays: feature, split value, children, and at
    leaves the path length (with the mean of the points left there)."""

    def __init__(self, good: np.ndarray, low: np.ndarray, high: np.ndarray, weights: np.ndarray, trees: int = 100,
                 points: int = 256, depth: int = 12, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.weights = weights
        self.threshold = math.inf
        self.norm = _mean_path(min(points, len(good))) or 1.0
        self.trees = []
        for _ in range(trees):
            mine = good[rng.choice(len(good), min(points, len(good)), replace=False)]
            nodes: list[list[float]] = []
            self._grow(mine, low.copy(), high.copy(), 0, depth, rng, nodes)
            t = np.array(nodes)
            self.trees.append((t[:, 0].astype(np.int32), t[:, 1], t[:, 2].astype(np.int32), t[:, 3].astype(np.int32), t[:, 4]))

    def _grow(self, x: np.ndarray, low: np.ndarray, high: np.ndarray, at: int, most: int, rng, nodes: list) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, me, me, at + _mean_path(len(x))])
        wide = np.flatnonzero((high > low) & (self.weights > 0))
        if len(x) <= 1 or at >= most or not len(wide):
            return me
        f = int(rng.choice(wide, p=self.weights[wide] / self.weights[wide].sum()))
        v = float(rng.uniform(low[f], high[f]))
        left = x[:, f] < v
        cut = low.copy(), high.copy()
        cut[1][f] = v
        a = self._grow(x[left], low, cut[1], at + 1, most, rng, nodes)
        cut[0][f] = v
        b = self._grow(x[~left], cut[0], high, at + 1, most, rng, nodes)
        nodes[me] = [f, v, a, b, 0.0]
        return me

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path): near 1 is anomalous."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, value, left, right, path in self.trees:
            at = np.zeros(len(x), np.int32)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                less = x[rows, np.maximum(f, 0)] < value[at]
                at = np.where(inner, np.where(less, left[at], right[at]), at)
            total += path[at]
        return 2.0 ** (-total / len(self.trees) / self.norm)


def separation(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """For each statistic the square of 2 * AUC - 1, the share of (good, bad)
    pairs it puts in one order less that in the other; all 1 without bad rows
    or if none tells them apart."""
    out = np.ones(good.shape[1])
    if len(bad):
        for f in range(good.shape[1]):
            x = np.sort(good[:, f])
            less, same = np.searchsorted(x, bad[:, f], "left"), np.searchsorted(x, bad[:, f], "right")
            out[f] = ((less + same).mean() / len(x) - 1) ** 2
    return out if out.max() > 0 else np.ones(good.shape[1])


_STEPS = 2000


def _scored(bc, width: int):
    """Adds the score to batches whose last column is ``stats``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column(width).to_pylist(), float).reshape(b.num_rows, len(STATS))
            arrays = [*b.columns[:width], pa.array(bc.value.scores(x))]
            yield pa.RecordBatch.from_arrays(arrays, names=[f"c{i}" for i in range(width + 1)])
    return run


def _with_score(df: DataFrame, forest: Forest) -> DataFrame:
    """``df`` (last column ``stats``) with ``score`` in place of ``stats``."""
    bc = df.sparkSession.sparkContext.broadcast(forest)
    width = len(df.columns) - 1
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-1]] + ["score double"])
    return df.mapInArrow(_scored(bc, width), ddl)


def fit(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", sample_rows: int = 20_000,
        most_lost: float = 0.002, seed: int = 7) -> Forest | None:
    """A forest with its threshold, or None without labelled good rows.

    ``measured`` has the id as c0.  Trees and weights take a bounded sample:
    the ``sample_rows`` good rows, and bad rows, with the smallest hashes of
    their ids.  Ranges
    come from all labelled rows.  So does the threshold, from those that pass
    the fixed rules: the sum of the shares of bad rows rejected and good rows
    kept is largest while at most ``most_lost`` of the good rows go; of a run
    of equals the middle.
    """
    spark = measured.sparkSession
    marks = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull()).groupBy(
        F.col(id_col).alias("c0")).agg(F.min("quality").alias("quality"))
    rows = written(measured.join(marks, "c0").select("c0", "quality", "stats", base_failed().alias("failed")), "quality")
    good, bad = (np.array([r[0] for r in rows.where(which).orderBy(F.xxhash64("c0", F.lit(seed)), "c0").limit(sample_rows)
                           .select("stats").collect()], float).reshape(-1, len(STATS))
                 for which in ("quality = 1 and not failed", "quality <> 1"))
    if not len(good):
        return None
    ends = rows.select(*[f(F.get("stats", F.lit(i))).alias(f"{n}{i}") for i in range(len(STATS))
                         for n, f in (("low", F.min), ("high", F.max))]).first()
    low = np.array([ends[f"low{i}"] for i in range(len(STATS))])
    high = np.array([ends[f"high{i}"] for i in range(len(STATS))])
    forest = Forest(good, low, high, separation(good, bad), seed=seed)
    step = F.floor(F.col("score") * _STEPS).cast("int").alias("step")
    tally = _with_score(rows.where("not failed").select("quality", "stats"), forest).groupBy("quality", step).count().collect()
    good, bad = np.zeros(_STEPS + 2), np.zeros(_STEPS + 2)
    for r in tally:
        (good if r["quality"] == 1 else bad)[r["step"]] += r["count"]
    # shares at or above each step
    lost = np.cumsum(good[::-1])[::-1] / max(good.sum(), 1)
    caught = np.cumsum(bad[::-1])[::-1] / max(bad.sum(), 1)
    fine = np.flatnonzero(lost <= most_lost)
    gain = (caught - lost)[fine]
    best = fine[gain >= gain.max() - 1e-12]
    best = best[best - np.arange(len(best)) == best[0]]         # the first run of equals
    forest.threshold = float(best[0] + best[-1]) / 2 / _STEPS
    return forest


def judge(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id",
          text: str = "text", **how) -> DataFrame:
    """``keep`` columns of ``docs`` (the id by default), COUNTS, ``score``,
    ``base_failed`` and ``kept``; names that clash get underscores before
    them.

    Null and empty texts have no words and fail the fixed rules; repeated rows
    are judged alike; without labelled good rows the fixed rules alone decide
    (score 0); an empty table gives an empty result.
    """
    keep = [id_col] if keep is None else keep
    got = written(measures(docs, [id_col, *keep], text), "quality")
    forest = fit(got, labels, id_col, **how)
    cols = [c for c in got.columns if c != "stats"]
    scored = _with_score(got.select(*cols, "stats"), forest) if forest else got.select(*cols, F.lit(0.0).alias("score"))
    least = forest.threshold if forest else math.inf
    own = docs.select(*[f"`{c}`" for c in keep])
    names = {c: free_name(own, c) for c in [*COUNTS, "score", "base_failed", "kept"]}
    return scored.select(
        *[F.col(f"c{i + 1}").alias(c) for i, c in enumerate(keep)],
        *[F.col(c).alias(names[c]) for c in [*COUNTS, "score"]],
        base_failed().alias(names["base_failed"]),
        (~base_failed() & (F.floor(F.col("score") * _STEPS) / _STEPS < F.lit(least))).alias(names["kept"]))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are.  The
    statistics of the rows decide, so they are measured again beside the
    text rather than joined by id: null and repeated ids are no matter."""
    got = written(measures(docs, [id_col], text), "quality")
    forest = fit(got, labels, id_col, **how)
    cols = docs.columns
    base = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)])
    bc = docs.sparkSession.sparkContext.broadcast(forest)
    ok = base.mapInArrow(_kept(bc, cols.index(text)), ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(base.schema.fields)))
    return ok.toDF(*cols)


def _kept(bc, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [measure(t) for t in utf8(b.column(text_at))]
            ok = np.array([g[0][0] >= 50 and 100 * g[0][4] <= 50 * g[0][0] for g in got], bool)
            if bc.value is not None and ok.any():
                ok[ok] = np.floor(bc.value.scores(np.array([g[1] for g in got])[ok]) * _STEPS) / _STEPS < bc.value.threshold
            yield b.filter(pa.array(ok))
    return run
