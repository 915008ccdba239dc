"""What a micro-batch of the pipelines parses, writes and sorts."""

import json
import os

import pytest

from riverbed.operators import changes as CH
from riverbed.operators import offsets as OF
from riverbed.sources.feeds import FEED_SCHEMA
from riverbed.streaming import streams as ST

NAMES = ["customer_profiles", "click_events", "product_reviews"]


def _messages():
    """Three collections in one topic, some told by the topic only, and what belongs to none of them."""
    one = lambda n, name, doc: ("shop.reviewsdb.all", 0, n, None, json.dumps(
        {"op": "c", "after": json.dumps(doc), "source": {"db": "d", "collection": name}, "ts_ms": n}))
    return [one(0, "customer_profiles", {"_id": "p", "customer_id": 1}), one(1, "click_events", {"_id": "c", "event_id": "1"}),
            one(2, "product_reviews", {"_id": "r", "review_id": "1"}), one(3, "orders", {"_id": "o"}), one(4, None, {"_id": "n"}),
            ("shop.reviewsdb.click_events", 0, 5, None, "{no json"), ("shop.reviewsdb.click_events", 0, 6, None, None),
            ("shop.reviewsdb.product_reviews", 0, 7, None, json.dumps({"op": "c", "after": {"_id": "s", "review_id": "2"}})),
            (None, 0, 8, None, json.dumps({"op": "c", "after": {"_id": "x"}}))]


def test_messages_are_parsed_for_their_own_collection(spark, tmp_root, monkeypatch):
    pipe, asked, real = ST.DocumentPipeline(spark, tmp_root, NAMES), {}, CH.parse_documents

    def parse(feed, name):
        asked[name] = sorted(r["offset"] for r in feed.select("offset").collect())
        return real(feed, name)
    monkeypatch.setattr(ST.CH, "parse_documents", parse)
    parsed, wrote = [], ST.Pipeline._parsed
    monkeypatch.setattr(ST.Pipeline, "_parsed", lambda self, rows, name, tag: parsed.append(name) or wrote(self, rows, name, tag))
    pipe.process(spark.createDataFrame(_messages(), FEED_SCHEMA), 0)
    assert asked == {"customer_profiles": [0], "click_events": [1, 5, 6], "product_reviews": [2, 7]}
    assert not any(n.endswith("-checked") for n in parsed)          # no key is contended: nothing is written again
    assert {n: sorted(r["pk"] for r in pipe.clean(n).collect()) for n in NAMES} == {
        "customer_profiles": ["p"], "click_events": ["c"], "product_reviews": ["r", "s"]}
    dead = spark.read.parquet(os.path.join(tmp_root, "ops/failed_events"))
    assert [(r["source_offset"], r["error_message"]) for r in dead.collect()] == [(5, "malformed JSON value")]
    assert sorted((r["first"], r["last"]) for r in pipe.handled_offsets().collect()) == [(0, 4), (5, 6), (7, 7), (8, 8)]


def test_rows_with_a_lost_claim_are_written_again(spark, tmp_root):
    pipe = ST.DocumentPipeline(spark, tmp_root)
    rows = [("shop.reviewsdb.product_reviews", 0, n, None, json.dumps({"op": "c", "after": {"_id": i, "review_id": "1"}})) for n, i in enumerate("ab")]
    pipe.process(spark.createDataFrame(rows, FEED_SCHEMA), 0)
    dead = spark.read.parquet(os.path.join(tmp_root, "ops/failed_events")).collect()
    assert [(r["source_offset"], r["error_message"], json.loads(r["message_value"])["after"]["_id"]) for r in dead] == [(1, "duplicate business key", "b")]
    assert [r["pk"] for r in pipe.clean("product_reviews").collect()] == ["a"]


@pytest.mark.parametrize("known", [None, [("t", 0, 1, 3), ("t", 0, 8, OF.BLOCK + 2), ("u", 0, 1, 1)]])
def test_positions_join_the_ledger_in_one_pass(spark, known):
    """One shuffle and one sort of positions and stored ranges, the same ranges as by two."""
    offsets = [0, 4, 6, 7, OF.BLOCK - 1, OF.BLOCK, OF.BLOCK + 3, 3 * OF.BLOCK]
    at = OF.positions(spark.createDataFrame([("t", 0, o, "", "") for o in offsets] + [("t", None, None, "", "")], FEED_SCHEMA)).localCheckpoint()
    ranges = None if known is None else spark.createDataFrame(known, "topic string, partition int, first bigint, last bigint")
    inside = OF.inside_blocks(ranges, at)
    told = OF.ranges_of(at)
    wanted = OF.merged(told if ranges is None else told.unionByName(ranges))
    key = lambda df: sorted(map(str, df.select("topic", "partition", "first", "last").collect()))
    assert key(OF.across_blocks(inside)) == key(wanted)
    plan = inside._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and len({line.split("windowspecdefinition")[1].split("specifiedwindow")[0]
                                             for line in plan.splitlines() if "windowspecdefinition" in line}) == 1


def test_ranges_of_a_batch_are_written_before_they_are_read_twice(spark, tmp_root, monkeypatch):
    wrote, real = [], ST.Pipeline._parsed
    monkeypatch.setattr(ST.Pipeline, "_parsed", lambda self, rows, name, tag: wrote.append(name) or real(self, rows, name, tag))
    pipe = ST.DocumentPipeline(spark, tmp_root)
    monkeypatch.setattr(pipe, "_process", lambda *a: None)
    for n, batch in enumerate(([1, 2, 4], [2, 3, 9])):
        pipe.process(spark.createDataFrame([("t", 0, o, "", "") for o in batch], FEED_SCHEMA), n)
    assert wrote == ["feed", "positions", "ranges"] * 2
    assert [(r["first"], r["last"]) for r in pipe.handled_offsets().orderBy("first").collect()] == [(1, 4), (9, 9)]
