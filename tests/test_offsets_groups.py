"""The ledger of offset ranges, groups by pointer jumping, the listing stream."""

import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from riverbed.operators import groups as G
from riverbed.operators import offsets as OF
from riverbed.streaming import streams as ST


def at(spark, rows):
    return OF.positions(spark.createDataFrame(rows, "topic string, partition int, offset bigint"))


def runs(offsets):
    out = []
    for o in sorted(offsets):
        if out and out[-1][1] == o - 1:
            out[-1][1] = o
        else:
            out.append([o, o])
    return [tuple(r) for r in out]


@pytest.mark.parametrize("bits", [3, 16])
def test_ranges_follow_batches(spark, monkeypatch, bits):
    """Random batches that overlap: each message is new once, and the ledger is the runs of all so far."""
    monkeypatch.setattr(OF, "BLOCK_BITS", bits)
    monkeypatch.setattr(OF, "BLOCK", 1 << bits)
    rng, seen, ranges = random.Random(bits), {}, None
    for _ in range(4):
        batch = [(t, p, o) for t in "ab" for p in (0, 1) for o in rng.sample(range(60), 25)]
        pos = at(spark, batch + batch[:5]).checkpoint()
        if ranges is not None:
            known = {tuple(r) for r in OF.handled(pos, ranges).collect()}
            assert known == {(t, p, o) for t, p, o in batch if o in seen[t, p]}
        for t, p, o in batch:
            seen.setdefault((t, p), set()).add(o)
        new = OF.ranges_of(pos)
        ranges = OF.merged(new if ranges is None else new.unionByName(ranges)).checkpoint()
        got = {(r["topic"], r["partition"], r["first"], r["last"]) for r in ranges.collect()}
        assert got == {(t, p, a, b) for (t, p), o in seen.items() for a, b in runs(o)}


def test_the_ledger_grows_with_gaps_not_messages(spark):
    pos = spark.range(300_000).select(F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"),
                                      F.floor(F.col("id") / 2).cast("bigint").alias("offset")).where("offset <> 777")
    ranges = OF.merged(OF.ranges_of(OF.positions(pos))).checkpoint()
    want = [(p, a, b) for p in (0, 1) for a, b in ((0, 776), (778, 149_999))]
    assert sorted((r["partition"], r["first"], r["last"]) for r in ranges.collect()) == want
    more = at(spark, [("t", 0, 777), ("t", 1, 776), ("t", 1, 777), ("t", 0, 149_999), ("t", 0, 150_000), ("u", 0, 5)])
    assert {tuple(r) for r in OF.handled(more, ranges).collect()} == {("t", 1, 776), ("t", 0, 149_999)}
    big = at(spark, [("t", 0, 2 ** 60 + k) for k in (0, 1, 65_535, 65_536)])
    assert sorted((r["first"] - 2 ** 60, r["last"] - 2 ** 60) for r in OF.merged(OF.ranges_of(big)).collect()) == [(0, 1), (65_535, 65_536)]


class Ledger(ST.Pipeline):
    def _process(self, feed, batch_id, tag, before, doc):
        self.got = sorted(r["offset"] for r in feed.collect())


def test_messages_come_through_once_over_batches(spark, tmp_root):
    def feed(offsets):
        return spark.createDataFrame([("t", 0, o, "k", "v") for o in offsets], "topic string, partition int, offset bigint, key string, value string")
    pipe = Ledger(spark, tmp_root)
    pipe.process(feed([1, 2, 3, 3, 7]), 0)
    assert pipe.got == [1, 2, 3, 7]
    pipe.process(feed([2, 3, 4, 5]), 1)
    assert pipe.got == [4, 5]
    again = Ledger(spark, tmp_root)
    again.process(feed([1, 2, 3, 4, 5, 7]), 2)
    assert again.got == []
    again.process(feed([9]), 2)                                    # committed already
    assert again.got == []
    assert [(r["first"], r["last"]) for r in again.handled_offsets().orderBy("first").collect()] == [(1, 5), (7, 7)]
    assert again.commits.fs.list_names(f"{tmp_root}/_work") == []


def components(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("order", ["rising", "falling", "random"])
def test_a_long_chain_takes_few_rounds(spark, order):
    names = [f"{n:05d}" for n in range(1025)]
    if order == "falling":
        names.reverse()
    if order == "random":
        random.Random(4).shuffle(names)
    edges = list(zip(names, names[1:]))
    got, rounds = G.connected(spark.createDataFrame(edges, "a string, b string"))
    assert rounds <= 25 and {r["group"] for r in got.collect()} == {"00000"} and got.count() == 1025


@pytest.mark.parametrize("seed", range(2))
def test_groups_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(str(rng.randrange(200)), str(rng.randrange(200))) for _ in range(120)] + [("hub", str(n)) for n in range(0, 200, 9)] + [("x", "x")]
    got = {r["node"]: r["group"] for r in G.connected(spark.createDataFrame(edges, "a string, b string"))[0].collect()}
    assert got == components(edges)


def scan(spark, n, objects):
    when = datetime(2024, 1, 1, tzinfo=timezone.utc)
    return spark.createDataFrame([(n, "b", k, 1, e, None, when) for k, e in objects.items()], ST.LISTING_SCHEMA)


def test_change_detection_over_restarts(spark, tmp_root):
    """Objects that vanish and come back, scans that come twice, two scans in a batch, a killed batch."""
    def take(scans, batch_id, pipe=None):
        df = scans[0]
        for s in scans[1:]:
            df = df.unionByName(s)
        pipe = pipe or ST.ListingPipeline(spark, tmp_root)
        pipe.process(df, batch_id)
        return sorted((r["scan"], r["object_key"], r["change_kind"]) for r in pipe.changes().collect())

    one = scan(spark, 1, {"a": "1", "b": "1", "c": "1"})
    seen = take([one, one], 0)
    assert seen == [(1, k, "new") for k in "abc"]
    dying = ST.ListingPipeline(spark, tmp_root)

    def kill(step):
        raise RuntimeError(step)
    dying.after = kill
    with pytest.raises(RuntimeError):
        take([scan(spark, 2, {"a": "2", "b": "1"})], 1, dying)
    assert take([scan(spark, 2, {"a": "2", "b": "1"})], 1) == (seen := seen + [(2, "a", "changed")])
    two = [scan(spark, 3, {"a": "2", "b": "9", "c": "1"}), scan(spark, 4, {"b": "1", "d": "1"})]
    assert take(two, 2) == (seen := sorted(seen + [(3, "b", "changed"), (4, "b", "changed"), (4, "d", "new")]))
    assert take([one, scan(spark, 4, {"b": "5"})], 3) == seen           # old scans again
    pipe = ST.ListingPipeline(spark, tmp_root)
    assert {r["value"][:1] for r in pipe.messages().collect()} == {"{"} and pipe.messages().count() == len(seen)


def test_ranges_join_across_blocks_without_a_window_over_a_partition(spark):
    B = OF.BLOCK
    rows = [("t", 0, B - 3, B - 1), ("t", 0, B, B + 4), ("t", 0, B - 2, B + 1), ("t", 0, 5, 7), ("t", 0, 8, 8), ("t", 0, 2 * B + 1, 5 * B),
            ("t", 0, 3 * B + 9, 3 * B + 11), ("t", 0, 5 * B + 2, 5 * B + 2), ("t", 1, B, B)]
    got = OF.merged(spark.createDataFrame(rows, "topic string, partition int, first bigint, last bigint"))
    assert sorted(map(tuple, got.select("topic", "partition", "first", "last").collect())) == [
        ("t", 0, 5, 8), ("t", 0, B - 3, B + 4), ("t", 0, 2 * B + 1, 5 * B), ("t", 0, 5 * B + 2, 5 * B + 2), ("t", 1, B, B)]
    many = spark.createDataFrame([("t", 0, 4 * B + 2 * n, 4 * B + 2 * n) for n in range(50)], "topic string, partition int, first bigint, last bigint")
    assert OF.merged(many).count() == 50
    plan = OF.merged(many)._jdf.queryExecution().optimizedPlan().toString()
    assert "[topic#" in plan and any("Window" in line and "block" in line.split("],")[-2] for line in plan.splitlines() if "Window" in line)


def test_numbering_by_blocks(spark):
    rows = [("t", p, o, "k", "v") for p in (0, 1) for o in (3, 70_000, 70_001, 200_000, 5)] + [("t", None, None, "k", "v")]
    got = OF.numbered(spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string, value string"), "n")
    assert got.columns == ["topic", "partition", "offset", "key", "value", "n"]
    found = {(r["partition"], r["offset"]): r["n"] for r in got.collect()}
    assert found == {(p, o): n for p in (0, 1) for n, o in enumerate((3, 5, 70_000, 70_001, 200_000))} | {(None, None): 0}
