"""Secret scans: fixed patterns, and character Markov models of random strings
and of ordinary identifiers compared by log-likelihood ratio.

Everything is DataFrame functions.  Positions come from splitting a text at a
pattern: the pieces between matches and the matches give the offsets by
running sums of their lengths in code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import free_name, written

# fixed values: the kinds, in their order, with pattern and least length
ASSIGN = "(" + "|".join(["password", "passwd", "secret", "token", "api_?key"]) + ")"
ASSIGN = f"(?i:{ASSIGN})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"      # a shorter run holds no other match, so the least length can stand in the pattern
HEX = "[0-9a-f]{24,}"             # likewise
VALUE_LEAST = 6
KINDS = ["assign", "access", "hex", "random"]

# candidates of the Markov models
LEAST = 16
TOKEN = "[A-Za-z0-9+/_=-]{%d,}" % LEAST
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(ALPHABET)
SPAN = "array<struct<start:int,kind:int,end:int>>"


_FOUND = "array<struct<start:int,kind:int,end:int,match:string>>"


def _parts(size: Column) -> Column:
    """0, 1, ... for the parts that an array of ``size`` is cut into: about as
    many as each has entries, so that work inside parts and over them grows
    with size * sqrt(size), not with its square."""
    return F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(size / _part(size)).cast("int") - 1))


def _part(size: Column) -> Column:
    """How many entries a part has."""
    return F.greatest(F.lit(1), F.ceil(F.sqrt(size.cast("double"))).cast("int"))


def spans_of(text: Column, pattern: str, kind: int) -> Column:
    """The leftmost non-overlapping matches of ``pattern`` as an array of
    (start, kind, end, match), offsets in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(
        F.char_length(g).alias("gap"), F.char_length(m).alias("size"), m.alias("match")))

    def step(acc: Column, pair: Column) -> Column:
        a = acc["at"] + pair["gap"]
        b = a + pair["size"]
        return F.struct(b.alias("at"), F.concat(acc["spans"], F.array(F.struct(
            a.alias("start"), F.lit(kind).alias("kind"), b.alias("end"), pair["match"].alias("match")))).alias("spans"))

    def placed(pairs: Column, at: Column) -> Column:
        """Spans of some pairs, the first of which begins at ``at``."""
        return F.aggregate(pairs, F.struct(at.alias("at"), F.array().cast(_FOUND).alias("spans")), step)["spans"]

    def cut(pairs: Column) -> Column:
        """Where each part begins, then the spans part by part."""
        size = F.size(pairs)
        part = lambda i: F.slice(pairs, i * _part(size) + 1, _part(size))
        starts = F.aggregate(_parts(size), F.array(F.lit(0)), lambda acc, i: F.concat(acc, F.array(F.aggregate(
            part(i), F.element_at(acc, -1), lambda n, p: n + p["gap"] + p["size"]))))
        # one-element arrays bind a value once for the functions under them
        return F.flatten(F.flatten(F.transform(F.array(starts), lambda s: F.transform(
            _parts(size), lambda i: placed(part(i), F.get(s, i))))))

    whole = F.get(F.transform(F.array(pairs), lambda p: F.when(F.size(p) <= 64, placed(p, F.lit(0))).otherwise(cut(p))), F.lit(0))
    return F.when(F.rlike(text, F.lit(pattern)), whole).otherwise(F.array().cast(_FOUND))


def base_spans(text: Column) -> list[Column]:
    """The spans of the kinds assign, access and hex."""
    assign = F.filter(spans_of(text, ASSIGN, 0), lambda s: F.char_length(
        F.regexp_extract(s["match"], f"^{ASSIGN}", 2)) >= VALUE_LEAST)
    return [assign, spans_of(text, ACCESS, 1), spans_of(text, HEX, 2)]


# ------------------------------------------------------------------ models


def transitions(strings: DataFrame, weight: str = "n") -> DataFrame:
    """(code, n): how often each pair of following characters occurs in
    ``s``, each string counted ``n`` times; characters outside the alphabet
    do not occur in candidates."""
    pairs = F.transform(F.sequence(F.lit(1), F.char_length("s") - 1), lambda i: F.struct(
        F.substring(F.col("s"), i, F.lit(1)).alias("x"), F.substring(F.col("s"), i + 1, F.lit(1)).alias("y")))
    return (strings.where(F.char_length("s") > 1).select(F.col(weight).alias("n"), F.explode(pairs).alias("p"))
            .groupBy(F.col("p.x").alias("x"), F.col("p.y").alias("y")).agg(F.sum("n").alias("n")))


def log_probs(counts: DataFrame, smooth: float = 0.5) -> list[float]:
    """log P(y | x) as a flat table of SIZE * SIZE cells, each count raised by
    ``smooth``; the counts are at most that many rows."""
    table = [[smooth] * SIZE for _ in range(SIZE)]
    for r in counts.collect():
        i, j = ALPHABET.find(r["x"]), ALPHABET.find(r["y"])
        if i >= 0 and j >= 0:
            table[i][j] += float(r["n"])
    return [math.log(v / sum(row)) for row in table for v in row]


def train(docs: DataFrame, text: str = "text", least: int = 6) -> list[float]:
    """The cells log P_random(y | x) - log P_ordinary(y | x).

    Labelled samples come from all texts: random strings are the values of
    the fixed patterns that mix digits and letters; ordinary identifiers are
    whole runs of ``least`` or more letters and ``_``, with up to four digits
    after them.  A value
    occurs once however often it is repeated; an identifier counts as often
    as the square root of its occurrences, so a very common word does not
    make the model.  Without any random sample the random model is uniform
    over the alphabet, by its smoothing.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    values = F.filter(F.concat(
        F.transform(F.regexp_extract_all(body, F.lit(ASSIGN), F.lit(2)), lambda v: v),
        F.regexp_extract_all(body, F.lit(ACCESS), F.lit(0)), F.regexp_extract_all(body, F.lit(HEX), F.lit(0))),
        lambda v: (F.char_length(v) >= 16) & F.rlike(v, F.lit("[0-9]")) & F.rlike(v, F.lit("[A-Za-z]")))
    random = docs.select(F.explode(values).alias("s")).distinct().withColumn("n", F.lit(1.0))
    # whole runs only: no letter, digit or other character beyond ASCII beside them
    words = F.regexp_extract_all(body, F.lit("(?<![A-Za-z0-9+/_=-])[A-Za-z][A-Za-z_]{%d,}[0-9]{0,4}(?![A-Za-z0-9+/_=-])" % (least - 1)), F.lit(0))
    ordinary = (docs.select(F.explode(words).alias("s")).groupBy("s").agg(F.sqrt(F.count(F.lit(1))).alias("n")))
    p, q = log_probs(transitions(random)), log_probs(transitions(ordinary))
    return [a - b for a, b in zip(p, q)]


def ratio(match: Column, cells: Column) -> Column:
    """Mean log-likelihood ratio of a candidate's transitions."""
    code = lambda i: F.instr(F.lit(ALPHABET), F.substring(match, i, F.lit(1))) - F.lit(1)
    return F.aggregate(F.sequence(F.lit(1), F.char_length(match) - 1), F.lit(0.0),
                       lambda acc, i: acc + F.get(cells, code(i) * F.lit(SIZE) + code(i + 1))) / (F.char_length(match) - 1)


def left_of(run: Column, base: Column) -> Column:
    """The pieces of a run between the spans of ``base``, those of 16 or more
    characters."""
    over = F.array_sort(F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"])))
    piece = lambda a, b: F.struct(a.alias("start"), F.lit(3).alias("kind"), b.alias("end"), F.substring(
        run["match"], a - run["start"] + 1, b - a).alias("match"))
    start = F.struct(run["start"].alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>").alias("pieces"))
    cut = F.aggregate(over, start, lambda acc, b: F.struct(
        F.greatest(acc["at"], b["end"]).alias("at"), F.concat(acc["pieces"], F.array(piece(acc["at"], b["start"]))).alias("pieces")),
        lambda acc: F.concat(acc["pieces"], F.array(piece(acc["at"], run["end"]))))
    return F.when(F.size(over) == 0, F.array(run)).otherwise(F.filter(cut, lambda p: p["end"] - p["start"] >= LEAST))


def rests(runs: Column, base: Column) -> Column:
    """``left_of`` over all runs; of many runs, part by part against the base
    spans near the part only."""
    def near(part: Column) -> Column:
        first, last = F.get(part, F.lit(0)), F.element_at(part, -1)
        return F.filter(base, lambda b: (b["start"] < last["end"]) & (first["start"] < b["end"]))

    def cut(runs: Column) -> Column:
        size = F.size(runs)
        parts = F.transform(_parts(size), lambda i: F.slice(runs, i * _part(size) + 1, _part(size)))
        return F.flatten(F.flatten(F.transform(parts, lambda p: F.flatten(F.transform(
            F.array(near(p)), lambda b: F.transform(p, lambda s: left_of(s, b)))))))

    return (F.when(F.size(base) == 0, runs).when(F.size(runs) <= 64, F.flatten(F.transform(runs, lambda s: left_of(s, base))))
            .otherwise(cut(runs)))


def find(docs: DataFrame, model: list[float] | None = None, text: str = "text", least_ratio: float = 0.5) -> DataFrame:
    """``docs`` with a column ``spans``: (start, kind, end), by start, then
    kind; kinds are numbered as in KINDS.

    The fixed patterns give assign, access and hex spans.  What is left of a
    run of token characters when these are cut out of it, if it is 16 or more
    characters with a letter and its mean ratio is at least ``least_ratio``,
    is a span of kind random; shorter runs (LEAST) and runs of digits and signs
    only say too little for the models and are not scored.  A null text is empty; a clash of names puts underscores before
    ``spans``.  ``model`` is trained on ``docs`` if not given.
    """
    cells = model if model is not None else train(docs, text)
    name = free_name(docs, "spans")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    named = [free_name(docs, f"__{k}") for k in ("assign", "access", "hex", "base", "runs", "extra")]
    assign, access, hexes, all_base, all_runs, more = named
    found = docs.withColumns(dict(zip((assign, access, hexes), base_spans(body))))
    found = found.withColumns({all_base: F.concat(F.col(assign), F.col(access), F.col(hexes)), all_runs: spans_of(body, TOKEN, 3)})
    table = F.split(F.lit(",".join(map(repr, cells))), ",").cast("array<double>")      # one folded literal
    extra = F.filter(rests(F.col(all_runs), F.col(all_base)),
                     lambda s: F.rlike(s["match"], F.lit("[A-Za-z]")) & (ratio(s["match"], table) >= F.lit(least_ratio)))
    out = found.withColumn(more, extra)
    narrow = F.transform(F.concat(F.col(all_base), F.col(more)),
                         lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return out.withColumn(name, F.array_sort(narrow)).select(*[F.col(f"`{c}`") for c in docs.columns], name)


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: list[float] | None = None, text: str = "text", mark: str = "[SECRET]", **how) -> DataFrame:
    """``docs`` with every span of the text replaced by ``mark`` (one for
    spans that overlap or touch); ``n_chars``, if there, follows the text."""
    spans = free_name(docs, "spans")
    found = find(docs, model, text, **how)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    body = F.col(f"`{text}`")

    def step(acc: Column, s: Column) -> Column:
        cut = F.substring(body, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when((s["start"] > acc["at"]) | (acc["out"] == ""), F.concat(acc["out"], cut, F.lit(mark)))
                        .otherwise(acc["out"]).alias("out"))

    done = F.aggregate(F.col(spans), start, step,
                       lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.char_length(body))))
    out = found.withColumn(text, F.when(F.size(F.col(spans)) > 0, done).otherwise(body))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(F.col(spans)) > 0, F.char_length(F.col(f"`{text}`")).cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
