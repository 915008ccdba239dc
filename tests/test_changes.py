"""Change application: dead letters, replay, ordering, store versions."""

import json
import random

import pytest
from pyspark.sql import functions as F

from riverbed.operators import changes as CH
from riverbed.operators import clean as C
from riverbed.operators.store import Commits, KeyedStore
from riverbed.sources.feeds import FEED_SCHEMA

T = "shop.public.orders"


def order(i, **kw):
    d = {"id": i, "customer_id": 1, "product_name": " p ", "quantity": 2, "unit_price": "1.50",
         "status": "new", "order_date": 1704067200000, "updated_at": 1704067200000}
    d.update(kw)
    return d


def msg(offset, op, after=None, before=None, pk=None, value=None, partition=0):
    v = value if value is not None else json.dumps({"op": op, "before": before, "after": after, "ts_ms": offset})
    key = json.dumps({"id": pk}) if pk is not None else None
    return (T, partition, offset, key, v)


def feed(spark, rows):
    return spark.createDataFrame(rows, FEED_SCHEMA)


def test_every_error_cause_dead_lettered_once(spark):
    rows = [msg(1, "c", order(1), pk=1),
            msg(2, None, value='{"op": "c", "after": {"id": 2'),                 # bad JSON
            msg(3, None, value=json.dumps({"after": order(3)})),                  # no op
            msg(4, "c", {k: v for k, v in order(4).items() if k != "id"}),        # no pk
            msg(5, "c", order(5, unit_price="99999999.99", quantity=2000000000), pk=5),   # overflow
            msg(6, "c", order(6, quantity=3000000000), pk=6),                     # int range
            msg(7, "c", order(7, order_date="not a time"), pk=7),                 # bad timestamp
            msg(8, "d", None, before=order(1), pk=1),
            (T, 0, 9, json.dumps({"id": 1}), None)]                                # tombstone: skipped
    parsed = CH.parse_relational(feed(spark, rows), CH.RELATIONAL["orders"])
    dead = {r["source_offset"]: r["error_message"] for r in CH.dead_letters(parsed).collect()}
    assert dead == {2: C.ERR_BAD_JSON, 3: C.ERR_NO_OP, 4: C.ERR_NO_PK, 5: C.ERR_NUMERIC_OVERFLOW,
                    6: C.ERR_INT_RANGE, 7: C.ERR_TIMESTAMP}
    raw = sorted(r["source_offset"] for r in CH.audit_log(parsed).collect())
    assert raw == [1, 8]                                    # Q8: raw holds accepted events only
    state = CH.current(CH.fold(CH.keyed_changes(parsed, CH.RELATIONAL["orders"])), CH.RELATIONAL["orders"])
    assert state.count() == 0                               # 1 inserted then deleted


def test_unknown_op_reaches_raw_only(spark):
    parsed = CH.parse_relational(feed(spark, [msg(1, "t", order(1), pk=1)]), CH.RELATIONAL["orders"])
    assert CH.audit_log(parsed).count() == 1
    assert CH.keyed_changes(parsed, CH.RELATIONAL["orders"]).count() == 0


def _state(spark, rows, prior=None):
    spec = CH.RELATIONAL["orders"]
    return CH.fold(CH.keyed_changes(CH.parse_relational(feed(spark, rows), spec), spec), prior)


def test_one_batch_equals_many(spark):
    rows = [msg(i, "c" if i < 6 else "u", order(i % 6, quantity=i), pk=i % 6) for i in range(12)]
    rows += [msg(12, "d", None, before=order(2), pk=2)]
    one = sorted(map(tuple, CH.current(_state(spark, rows), CH.RELATIONAL["orders"]).collect()))
    st = None
    for chunk in (rows[:4], rows[4:9], rows[9:]):
        st = _state(spark, chunk, st).checkpoint()
    many = sorted(map(tuple, CH.current(st, CH.RELATIONAL["orders"]).collect()))
    assert one == many


def test_older_event_never_overwrites_or_resurrects(spark):
    st = _state(spark, [msg(10, "c", order(1, quantity=5), pk=1), msg(20, "d", None, before=order(1), pk=1),
                        msg(30, "c", order(2, quantity=7), pk=2)])
    st = _state(spark, [msg(5, "u", order(1, quantity=9), pk=1), msg(25, "u", order(2, quantity=1), pk=2)], st)
    cur = {r["id"]: r["quantity"] for r in CH.current(st, CH.RELATIONAL["orders"]).collect()}
    assert cur == {2: 7}


def test_duplicate_delivery_dropped(spark):
    rows = [msg(1, "c", order(1), pk=1), msg(1, "c", order(1), pk=1)]
    parsed = CH.parse_relational(CH.dedupe_deliveries(feed(spark, rows)), CH.RELATIONAL["orders"])
    assert CH.audit_log(parsed).count() == 1


def _changes(spark, rows):
    spec = CH.RELATIONAL["orders"]
    return CH.keyed_changes(CH.parse_relational(feed(spark, rows), spec), spec)


def _quantities(state):
    return {r["id"]: r["quantity"] for r in CH.current(state, CH.RELATIONAL["orders"]).collect()}


def test_store_versions_stay_readable(spark, tmp_root):
    ch1 = _changes(spark, [msg(i, "c", order(i), pk=i) for i in range(20)])
    ch2 = _changes(spark, [msg(100, "d", None, before=order(3), pk=3), msg(101, "u", order(4, quantity=9), pk=4)])
    store = KeyedStore(spark, tmp_root, "orders", ch1.schema)
    one = store.merge(ch1, None, "b0")
    two = store.merge(ch2, one, "b1")
    now = _quantities(store.state(two))
    assert len(now) == 19 and 3 not in now and now[4] == 9 and two["rows"] == 20
    assert len(_quantities(store.state(one))) == 20            # the version before
    assert _quantities(store.near(two, ch2)) == {4: 9}
    assert store.state(None).count() == 0


def test_store_rewrites_only_touched_buckets(spark, tmp_root):
    ch1 = _changes(spark, [msg(i, "c", order(i), pk=i) for i in range(40)])
    store = KeyedStore(spark, tmp_root, "orders", ch1.schema, least_buckets=8)
    one = store.merge(ch1, None, "b0")
    two = store.merge(_changes(spark, [msg(100, "u", order(7, quantity=9), pk=7)]), one, "b1")
    assert len([b for b in two["paths"] if two["paths"][b] != one["paths"].get(b)]) == 1
    now = _quantities(store.state(two))
    assert len(now) == 40 and now[7] == 9


def test_buckets_grow_with_the_table(spark, tmp_root):
    ch1 = _changes(spark, [msg(i, "c", order(i), pk=i) for i in range(30)])
    store = KeyedStore(spark, tmp_root, "orders", ch1.schema, bucket_rows=5, least_buckets=2)
    one = store.merge(ch1, None, "b0")
    assert one["buckets"] == 8                                 # 30 rows, at most 5 a bucket on average
    two = store.merge(_changes(spark, [msg(100 + i, "c", order(30 + i), pk=30 + i) for i in range(20)]), one, "b1")
    three = store.merge(_changes(spark, [msg(200, "u", order(1, quantity=8), pk=1)]), two, "b2")
    assert three["buckets"] == 16 and three["rows"] == 50      # a merge after it has grown spreads the rows anew
    now = _quantities(store.state(three))
    assert len(now) == 50 and now[1] == 8


def test_commits(spark, tmp_root):
    c = Commits(spark, tmp_root, keep=2)
    assert c.latest() == Commits.NONE
    for b in range(4):
        path = f"mart/m/b{b}"
        spark.range(b + 1).write.parquet(f"{tmp_root}/{path}")
        c.write({"batch": b, "tables": {}, "marts": {"m": path}})
    assert c.latest()["batch"] == 3 and c.get(2)["marts"] == {"m": "mart/m/b2"}
    assert [c.fs.exists(f"{tmp_root}/mart/m/b{b}") for b in range(4)] == [False, False, True, True]
    with pytest.raises(Exception):                             # a batch is committed once
        c.write({"batch": 3, "tables": {}, "marts": {}})


def test_poison_values_are_dead_lettered(spark):
    bad = [order(1, order_date=9223372036854775807), order(2, order_date=1e30), order(3, unit_price="99999999999999999999"),
           order(4, unit_price="1e400"), order(5, updated_at=-1e18), order(6, customer_id=2 ** 63), order(7, quantity=1e30)]
    parsed = CH.parse_relational(feed(spark, [msg(i, "c", o, pk=o["id"]) for i, o in enumerate(bad)]), CH.RELATIONAL["orders"])
    dead = [r["error_message"] for r in CH.dead_letters(parsed).orderBy("source_offset").collect()]
    assert dead == [C.ERR_TIMESTAMP, C.ERR_TIMESTAMP, C.ERR_NUMERIC_OVERFLOW, C.ERR_NUMERIC_OVERFLOW, C.ERR_TIMESTAMP,
                    C.ERR_INT_RANGE, C.ERR_INT_RANGE]


def test_payload_member_decides_the_envelope(spark):
    inner = {"op": "c", "before": None, "after": order(1), "ts_ms": 5}
    rows = [msg(1, None, value=json.dumps({"payload": inner})), msg(2, None, value=json.dumps({"payload": {"after": order(2)}, "op": "c"})),
            msg(3, None, value=json.dumps({"payload": None, "op": "c", "after": order(3)}))]
    parsed = CH.parse_relational(feed(spark, rows), CH.RELATIONAL["orders"])
    assert {r["offset"]: r["_error"] for r in parsed.collect()} == {1: None, 2: C.ERR_NO_OP, 3: C.ERR_BAD_JSON}


def test_invalid_utf8_is_replaced_not_fatal(spark):
    value = json.dumps({"op": "c", "after": order(1), "ts_ms": 1}).encode().replace(b" p ", b" \xff ")
    df = spark.createDataFrame([(T, 0, 1, b"\xfe", value)], "topic string, partition int, offset bigint, key binary, value binary")
    row = CH.parse_relational(df, CH.RELATIONAL["orders"]).first()
    assert row["_error"] is None and row["product_name"] == "\ufffd" and row["key_text"] == "\ufffd"


def test_a_key_that_moved_to_a_lower_partition_is_updated(spark):
    st = _state(spark, [msg(100, "c", order(1, quantity=1), pk=1, partition=3)])
    st = _state(spark, [msg(200, "u", order(1, quantity=2), pk=1, partition=1)], st)
    assert _quantities(st) == {1: 2}


def timed(offset, ts, qty, partition=0, op="u", pk=1):
    after = None if op == "d" else order(pk, quantity=qty)
    return msg(offset, None, value=json.dumps({"op": op, "before": order(pk), "after": after, "ts_ms": ts}), pk=pk, partition=partition)


@pytest.mark.parametrize("later", [None, 0, 9, 10])
def test_offsets_decide_inside_a_partition(spark, later):
    """A later offset wins with a missing, smaller or equal time, in one batch or two."""
    rows = [timed(1, 10, 1, op="c"), timed(2, later, 2)]
    assert _quantities(_state(spark, rows)) == {1: 2}
    assert _quantities(_state(spark, rows[1:], _state(spark, rows[:1]))) == {1: 2}


def test_clock_decides_between_partitions_of_one_batch(spark):
    rows = [timed(1, 100, 1, 3), timed(2, 50, 2, 3),          # the clock of partition 3 stays at 100
            timed(1, 90, 3, 5), timed(2, None, 4, 5)]
    assert _quantities(_state(spark, rows)) == {1: 2}
    assert _quantities(_state(spark, rows + [timed(3, 101, 5, 5), timed(4, None, 6, 5)])) == {1: 6}
    assert _quantities(_state(spark, [timed(1, None, 1, 2), timed(1, None, 2, 4)])) == {1: 2}       # no times at all


def test_later_batches_come_later_and_old_positions_change_nothing(spark):
    st = _state(spark, [timed(5, 100, 1, 0), timed(6, 100, 2, 0)])
    st = _state(spark, [timed(1, 7, 3, 4)], st).checkpoint()                    # moved, its time fell
    assert _quantities(st) == {1: 3}
    row = st.first()
    assert (row["_pos"]["partition"], row["_pos"]["offset"]) == (4, 1)
    assert [(p["partition"], p["offset"]) for p in row["_past"]] == [(0, 6)]
    st = _state(spark, [timed(5, 900, 8, 0), timed(6, 900, 9, 0), timed(1, 900, 9, 4)], st).checkpoint()     # delivered again
    assert _quantities(st) == {1: 3}
    st = _state(spark, [timed(2, None, 0, 4, op="d")], st).checkpoint()
    assert _quantities(st) == {}
    assert _quantities(_state(spark, [timed(6, 900, 9, 0)], st)) == {}           # not back to life
    assert _quantities(_state(spark, [timed(7, None, 5, 0)], st)) == {1: 5}      # moved back


@pytest.mark.parametrize("seed", range(3))
def test_order_equals_event_at_a_time(spark, seed):
    """Random times over batches that are slices of each partition, each key in one partition."""
    rng = random.Random(seed)
    rows = [timed(n, rng.choice([None, rng.randrange(50)]), n + 1, partition=(pk := rng.randrange(6)) % 3, op=rng.choice("ccuud"), pk=pk)
            for n in range(60)]
    want = {}
    for r in rows:
        v = json.loads(r[4])
        key = json.loads(r[3])["id"]
        want.pop(key, None)
        if v["after"]:
            want[key] = v["after"]["quantity"]
    for cuts in ([60], [13, 40, 60]):
        state, at = None, 0
        for to in cuts:
            state, at = _state(spark, rows[max(0, at - 5):to], state).checkpoint(), to       # some are delivered again
        assert _quantities(state) == want


def test_documents_follow_offsets_too(spark):
    rows = [dmsg(1, "c", {"_id": {"$oid": "a" * 24}, "review_id": "r", "rating": 1}, "a" * 24),
            dmsg(2, "u", {"_id": {"$oid": "a" * 24}, "review_id": "r", "rating": 2}, "a" * 24)]
    rows[1] = (*rows[1][:4], rows[1][4].replace('"ts_ms": 2', '"ts_ms": null'))
    st, _ = CH.document_state(feed(spark, rows), "product_reviews", CH.REVIEW_COLUMNS)
    assert [r["rating"] for r in st.collect()] == [2]


def test_duplicate_keys_follow_offsets_with_falling_times(spark, monkeypatch):
    """Claims of several ids in one partition are judged by offset, over blocks of offsets."""
    monkeypatch.setattr(CH, "CLOCK_BLOCK", 7)
    rng = random.Random(1)
    events = [(n, rng.choice("ccud"), f"{rng.randrange(12):024x}", rng.choice(["r1", "r2", "r3", "r4", None])) for n in range(120)]
    rows = [("t", 0, n, rng.choice([None, rng.randrange(99)]), op, i, key, None) for n, op, i, key in events]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, ts_ms bigint, op string, _id string, review_id string, _error string")
    assert _rejected(df) == replayed(events)[0]


def test_partition_clocks(spark, monkeypatch):
    monkeypatch.setattr(CH, "CLOCK_BLOCK", 4)
    rng = random.Random(2)
    times = {p: [rng.choice([None, rng.randrange(100)]) for _ in range(30)] for p in (0, 1)}
    rows = [("i", "k", False, "t", p, o, t) for p, ts in times.items() for o, t in enumerate(ts)]
    rows += [(f"s{n}", f"k{n}", True, None, -1, -1, None) for n in range(3)]
    df = spark.createDataFrame(rows, "id string, key string, stored boolean, topic string, partition int, offset bigint, ts_ms bigint")
    got = CH._placed(df).collect()
    assert len(got) == 63 and sum(not r["pos"]["new"] for r in got) == 3
    for r in got:
        if r["pos"]["new"]:
            seen = [t for t in times[r["partition"]][:r["offset"] + 1] if t is not None]
            assert r["pos"]["clock"] == max(seen, default=None)


def dmsg(off, op, doc=None, oid=None):
    from riverbed.sources import feeds as FD
    key = json.dumps({"id": json.dumps({"$oid": oid})}) if oid else None
    return (FD.REVIEWS_TOPIC, 0, off, key, json.dumps({"op": op, "after": json.dumps(doc) if doc is not None else None, "ts_ms": off,
                                                       "source": {"db": "x", "collection": "product_reviews"}}))


def replayed(events):
    """Event-at-a-time processing: (offsets rejected, key of each live id)."""
    held, rejected = {}, []
    for off, op, i, key in events:
        if op == "d":
            held.pop(i, None)
        elif key is not None and any(k == key and j != i for j, k in held.items()):
            rejected.append(off)
        else:
            held[i] = key
    return rejected, held


@pytest.mark.parametrize("seed", range(3))
def test_duplicate_keys_do_not_depend_on_batches(spark, seed):
    rng = random.Random(seed)
    events = [(n, rng.choice("ccud"), rng.choice("abcde") * 24, rng.choice(["r1", "r2", "r3", None])) for n in range(40)]
    rows = [dmsg(n, op, None if op == "d" else {"_id": {"$oid": i}, "review_id": key}, i) for n, op, i, key in events]
    want = replayed(events)
    for cuts in ([40], [7, 18, 40]):
        state, dead, at = None, [], 0
        for to in cuts:
            parsed = CH.reject_duplicate_keys(CH.parse_documents(feed(spark, rows[at:to]), "product_reviews"), "product_reviews", state)
            dead += [r["source_offset"] for r in CH.dead_letters(parsed).collect()]
            state = CH.fold(CH.document_changes(parsed, CH.REVIEW_COLUMNS), state).checkpoint()
            at = to
        live = {r["pk"]: r["review_id"] for r in state.where(~F.col("_deleted")).collect()}
        assert (sorted(dead), live) == want


def _reviews(spark, events):
    """What parse_documents gives of these events, as far as keys go."""
    rows = [("t", 0, n, n, op, i, key, None) for n, op, i, key in events]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, ts_ms bigint, op string, _id string, review_id string, _error string")


def _rejected(parsed):
    done = CH.reject_duplicate_keys(parsed, "product_reviews")
    return sorted(r["offset"] for r in done.where(F.col("_error") == C.ERR_DUP_KEY).collect())


def test_a_hot_key_with_one_holder_is_settled_without_replay(spark, monkeypatch):
    """No group is formed for a key that its first holder keeps."""
    def fail(*_):
        raise AssertionError("replayed")
    events = [(n, "c", f"{n % 300:024x}", "n/a" if n % 3 == 0 else f"r{n % 300}") for n in range(600)]
    want = replayed(events)[0]
    monkeypatch.setattr(CH, "_contention_groups", fail)
    assert _rejected(_reviews(spark, events)) == want and len(want) == 198


@pytest.mark.parametrize("seed", range(3))
def test_hot_and_chained_keys_equal_event_at_a_time(spark, seed):
    rng = random.Random(seed)
    ids = [f"{k:024x}" for k in range(40)]
    events = [(n, rng.choice("ccuud"), rng.choice(ids), "n/a" if rng.random() < 1 / 3 else rng.choice([f"r{k}" for k in range(30)] + [None]))
              for n in range(800)]
    assert _rejected(_reviews(spark, events)) == replayed(events)[0]


def test_replay_streams_and_holds_live_holders_only():
    """Every batch is answered before the next is read, with state carried
    over: the rows of a group are never together."""
    import pyarrow as pa
    read = []

    def batches():
        for k in range(50):
            read.append(k)
            at = range(100 * k, 100 * k + 100)
            yield pa.RecordBatch.from_pydict({"group": ["g"] * 100, "id": [str(n) for n in at], "key": ["k"] * 100,
                                              "topic": ["t"] * 100, "partition": [0] * 100, "offset": list(at)})
    lost = []
    for n, b in enumerate(CH._replay_claims(batches())):
        assert len(read) == n + 1
        lost += b.column("offset").to_pylist()
    assert lost == list(range(1, 5000))


def test_documents_keep_what_no_cleaner_names(spark):
    doc = {"_id": {"$oid": "a" * 24}, "review_id": "r", "rating": 1, "votes": [1, 2], "nested": {"x": None}}
    parsed = CH.parse_documents(feed(spark, [dmsg(1, "c", doc, "a" * 24)]), "product_reviews")
    raw = CH.raw_documents(CH.fold(CH.document_changes(parsed, CH.REVIEW_COLUMNS))).first()
    assert json.loads(raw["document"]) == doc and raw["_cdc"]["op"] == "c"


def test_bad_document_values_are_dead_lettered(spark):
    def doc(**kw):
        return {"_id": {"$oid": "a" * 24}, "review_id": "r", **kw}
    docs = [doc(updated_at={"$date": 9223372036854775807}), doc(updated_at={"$date": {"$numberLong": "9" * 23}}),
            doc(updated_at={"$date": "no date"}), doc(rating=1e30), doc(rating=-1e30), doc(customer_id=1e30), doc(updated_at="no date")]
    parsed = CH.parse_documents(feed(spark, [dmsg(n, "u", d, "a" * 24) for n, d in enumerate(docs)]), "product_reviews")
    got = {r["offset"]: (r["_error"], r["rating"]) for r in parsed.collect()}
    assert got == {0: (C.ERR_DATE, 0), 1: (C.ERR_DATE, 0), 2: (C.ERR_DATE, 0), 3: (None, 5), 4: (None, 0), 5: (C.ERR_BIGINT, 0), 6: (None, 0)}


def test_document_rules(spark):
    a = {"_id": {"$oid": "a" * 24}, "review_id": "r1", "customer_id": {"$numberInt": "3"}, "rating": 9, "status": " approved "}
    b = {"_id": {"$oid": "b" * 24}, "review_id": "r1", "rating": 1}
    rows = [dmsg(1, "c", a, "a" * 24), dmsg(2, "c", b, "b" * 24), dmsg(3, "u", None, "a" * 24),
            dmsg(4, "d", None, None), dmsg(5, "x", a, "a" * 24)]
    st, parsed = CH.document_state(feed(spark, rows), "product_reviews", CH.REVIEW_COLUMNS)
    dead = {r["source_offset"]: r["error_message"] for r in CH.dead_letters(parsed).collect()}
    assert dead == {2: C.ERR_DUP_KEY, 3: C.ERR_NO_AFTER, 4: C.ERR_NO_DOC_ID}
    rows_ = st.where(~F.col("_deleted")).collect()
    assert [(r["pk"], r["rating"], r["status"], r["customer_id"]) for r in rows_] == [("a" * 24, 5, "APPROVED", 3)]


def test_members_are_read_in_one_pass(spark):
    """Absent members, wrapped envelopes and Extended JSON without a path lookup per member."""
    from riverbed.functions import envelope as EV
    from riverbed.functions import variant as V
    rows = spark.createDataFrame([('{"a":1,"b":null,"$oid":"x"}',), ("[1]",), ("7",), ("{}",), (None,)], "j string")
    got = rows.select(V.members(F.try_parse_json("j"), ["a", "b", "$oid"]).alias("m")).select(
        F.col("m").isNull(), F.to_json("m.a"), F.col("m.b").isNull(), F.to_json(F.col("m").getField("$oid"))).collect()
    assert [tuple(r) for r in got] == [(False, "1", False, '"x"'), (True, None, True, None), (True, None, True, None),
                                       (False, None, True, None), (True, None, True, None)]
    values = ['{"op":"u"}', '{"payload":{"op":"c","source":{"db":"d"}},"op":"x"}', '{"payload":3,"op":"u"}', '{"payload":null,"op":"u"}',
              '{"source":"s","ts_ms":5}']
    parsed = EV.parse_envelope(feed(spark, [msg(n, None, value=v) for n, v in enumerate(values)]))
    found = {r["offset"]: (r["op"], r["malformed"], r["source_db"], r["ts_ms"]) for r in parsed.collect()}
    assert found == {0: ("u", False, None, None), 1: ("c", False, "d", None), 2: (None, True, None, None), 3: (None, True, None, None),
                     4: (None, False, None, 5)}
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "$.payload" not in plan and "$.op" not in plan


def test_feed_from_few_row_groups_is_parsed_by_many_tasks(spark, monkeypatch):
    from riverbed.plans import catalog as Q
    from riverbed.sources import feeds as FD
    rows = [msg(n, "c", order(n), pk=n) for n in range(400)]
    one = feed(spark, rows).coalesce(1)
    monkeypatch.setattr(FD, "relational_feed", lambda s, sf: one)
    monkeypatch.setattr(Q, "FEEDS", None)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        made = Q.change_feed(spark, "none", "relational")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert made.count() == 400
    assert made.select(F.input_file_name()).distinct().count() > 1


def test_messages_move_only_if_one_came_twice(spark, tmp_path):
    from riverbed.streaming import streams as ST
    through = []

    class Intake(ST.Pipeline):
        def _process(self, feed, batch_id, tag, before, doc):
            through.append((sorted(r["offset"] for r in feed.collect()), feed.inputFiles()[0].split("/")[-2]))

    pipe = Intake(spark, str(tmp_path))
    pipe.process(feed(spark, [msg(n, "c", order(n), pk=n) for n in (1, 2, 3)]), 0)
    pipe.process(feed(spark, [msg(n, "c", order(n), pk=n) for n in (4, 5, 4, 2)]), 1)
    assert through == [([1, 2, 3], "feed"), ([4, 5], "feed-once")]
