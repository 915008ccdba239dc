"""Audit of how filters interact, by forward-backward path counting.

A state is the set of filters already applied; an edge applies one filter
more.  Counting paths forward from the empty set and backward from the full
one gives the number of orders that reach a state and that go on from it, so
an edge lies on (forward at its start) x (backward at its end) orders.  What
an edge removes, weighted by that number, sums to the filter's Shapley total;
every step of every order is one edge, read from the same table.

A document enters only through the set of conditions that it fails, so the
audit works on counts per part and set; texts are read once and never cross a
shuffle.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: orders grow with the factorial of the filters
MOST_FILTERS = 7
FILTERS = "ABCDE"


# ------------------------------------------------------------ path counting


def path_counts(n: int) -> list[tuple[int, int, int, int]]:
    """(state, filter, forward, backward) of every edge of the lattice of
    subsets of ``n`` filters: the orders that reach the state, and those that
    go on from it with the filter applied."""
    full = (1 << n) - 1
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    free = lambda s: [f for f in range(n) if not s >> f & 1]
    for s in range(full + 1):                  # a state comes after all of its subsets
        for f in free(s):
            forward[s | 1 << f] += forward[s]
    for s in range(full - 1, -1, -1):
        backward[s] = sum(backward[s | 1 << f] for f in free(s))
    return [(s, f, forward[s], backward[s | 1 << f]) for s in range(full + 1) for f in free(s)]


def order_steps(letters: str) -> list[tuple[str, int, int, int]]:
    """(order, step, state, filter) of every step of every order."""
    out = []
    for order in permutations(range(len(letters))):
        state, name = 0, "".join(letters[f] for f in order)
        for step, f in enumerate(order, 1):
            out.append((name, step, state, f))
            state |= 1 << f
    return out


# --------------------------------------------------------------- conditions


def text_conditions(text: Column) -> dict[str, Column]:
    """Failure conditions of a text by itself; words are maximal runs without
    ASCII white space.  A: under 50 words; B: under 65 % of the words are
    distinct; C: over 5 % of the code points are A-Z; D: a symbol of #$%&*|."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    caps = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    long = lambda c: c.cast("long")
    return {"A": F.size(words) < 50, "B": 100 * long(F.size(F.array_distinct(words))) < 65 * long(F.size(words)),
            "C": 100 * long(caps) > 5 * long(F.char_length(text)), "D": F.rlike(text, F.lit("[#$%&*|]"))}


def fail_counts(docs: DataFrame, labels: DataFrame, conditions=text_conditions, part: str = "source", id_col: str = "doc_id",
                text: str = "text") -> DataFrame:
    """part, mask, n, good and toxic: how many documents of a part fail exactly
    the conditions of the bits of ``mask``, and how many of them are labelled
    quality 1 and toxic 1.  The bit after those of ``conditions`` says that a
    document with a smaller id has the same text.

    A null text is empty and equals other empty ones; a null part is the empty
    string.  A null id is smaller than no other and has none before it.  Rows
    that repeat an id are documents of their own, neither before the other.
    A label counts if any of the id's label rows has it; null labels do not.
    Equal texts are those of equal SHA-256 and length.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    bits = conditions(F.col("t"))
    mask = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(bits.values())), F.lit(0))
    rows = (docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                        body.alias("t"))
            .select("id", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("t"), 256)).alias("digest"), F.octet_length("t").alias("size")))
    known = (labels.select(F.col(f"`{id_col}`").alias("id"), (F.col("quality") == 1).cast("int").alias("q"),
                           (F.col("toxic") == 1).cast("int").alias("t")).where(F.col("id").isNotNull())
             .groupBy("id").agg(F.coalesce(F.max("q"), F.lit(0)).alias("q"), F.coalesce(F.max("t"), F.lit(0)).alias("t")))
    # rows of one id and text count together from here on, so that no group holds a document twice
    copies = (rows.groupBy("digest", "size", "mask", "part", "id").agg(F.count(F.lit(1)).alias("n"))
              .join(known, "id", "left").na.fill(0, ["q", "t"]))
    group = ["digest", "size", "mask", "part", "q", "t"]
    # per text and part: the smallest id, its rows, all rows, and those without an id
    held = copies.groupBy(*group).agg(F.min("id").alias("least"), F.sum("n").alias("n"),
                                      F.min_by("n", "id").alias("n_least"),
                                      F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    first = F.min("least").over(Window.partitionBy("digest", "size"))
    early = F.col("n_null") + F.when(F.col("least") == first, F.col("n_least")).otherwise(0)
    split = held.withColumn("early", early)
    later = 1 << len(bits)
    both = F.array(F.struct(F.col("mask").alias("mask"), F.col("early").alias("n")),
                   F.struct((F.col("mask") + later).alias("mask"), (F.col("n") - F.col("early")).alias("n")))
    return (split.select("part", "q", "t", F.explode(both).alias("x")).where("x.n > 0")
            .groupBy("part", F.col("x.mask").alias("mask"))
            .agg(F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("q")).alias("good"), F.sum(F.col("x.n") * F.col("t")).alias("toxic")))


# -------------------------------------------------------------------- audit


def edges(counts: DataFrame, n: int) -> DataFrame:
    """Per part and edge of the lattice of ``n`` filters: state, filter,
    orders (on how many orders it lies), and the documents kept, removed,
    redundant, failing only this filter, and removed good and toxic ones."""
    if not 0 < n <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters")
    lattice = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(1 << f).alias("bit"), F.lit(a * b).cast("long").alias("orders"))
                        for s, f, a, b in path_counts(n)])
    bit = F.col("e.bit")
    out = F.col("mask").bitwiseAND(F.col("e.state")) != 0            # removed before this edge
    fails = F.col("mask").bitwiseAND(bit) != 0
    total = lambda c, of="n": F.sum(F.when(c, F.col(of)).otherwise(0))
    return (counts.select("*", F.explode(lattice).alias("e"))
            .groupBy("part", F.col("e.state").alias("state"), F.col("e.filter").alias("filter"), F.col("e.orders").alias("orders"))
            .agg(total(~out & ~fails).alias("kept"), total(~out & fails).alias("removed"), total(out & fails).alias("redundant"),
                 total(F.col("mask") == bit).alias("unique_fails"), total(~out & fails, "good").alias("good_lost"),
                 total(~out & fails, "toxic").alias("toxic_lost")))


def audit(counts: DataFrame, letters: str = FILTERS) -> DataFrame:
    """part, filter_order, step and the counts of ``edges`` for every step of
    every order of the filters, and ``shapley``: the documents that the step's
    filter removes summed over all orders.  ``counts`` is part, mask, n, good
    and toxic with one bit of ``mask`` per letter.  Zeros are included; a part
    without documents has no rows."""
    lattice = edges(counts, len(letters))
    shapley = F.sum(F.col("orders") * F.col("removed")).over(Window.partitionBy("part", "filter"))
    # a fixed table: n! x n rows
    steps = counts.sparkSession.createDataFrame(order_steps(letters), "filter_order string, step int, state int, filter int")
    return (lattice.withColumn("shapley", shapley).join(F.broadcast(steps), ["state", "filter"])
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
