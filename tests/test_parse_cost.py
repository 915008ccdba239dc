"""What parsing and the states of incremental jobs cost."""

import json
import re

from pyspark.sql import functions as F

from riverbed.functions import scalars as S
from riverbed.functions import variant as V
from riverbed.operators import changes as CH
from riverbed.operators import clean as C
from riverbed.plans import catalog as CT
from riverbed.sources.feeds import FEED_SCHEMA

T = "shop.reviewsdb.product_reviews"


def _message(offset, op, doc=None, key=None):
    value = {"op": op, "after": None if doc is None else json.dumps(doc),
             "source": {"db": "d", "collection": "product_reviews"}, "ts_ms": offset}
    return (T, 0, offset, key, json.dumps(value))


def test_methods_of_the_parse_are_compiled(spark):
    """The JVM never compiles a method of more than 8,000 bytes of bytecode."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        feed = spark.createDataFrame([_message(1, "d")], FEED_SCHEMA)
        plans = [CH.parse_documents(feed, c) for c in C.DOC_CLEANERS] + [CH.parse_relational(feed, s) for s in CH.RELATIONAL.values()]
        for df in plans:
            code = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
            assert sizes and max(sizes) <= 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_key_id_where_the_document_has_none(spark):
    key = lambda i: json.dumps({"id": json.dumps({"$oid": i})})
    rows = [_message(1, "c", {"_id": {"$oid": "a"}, "review_id": "1"}, key("x")), _message(2, "c", {"review_id": "2"}, key("b")),
            _message(3, "d", None, key("c")), _message(4, "d", None, None), _message(5, "c", {"_id": None, "review_id": "3"}, '"d"'),
            _message(6, "u", None, key("e")), _message(7, "c", {"_id": 7, "review_id": "4"}, "not json")]
    got = {r["offset"]: (r["_id"], r["_error"]) for r in CH.parse_documents(spark.createDataFrame(rows, FEED_SCHEMA), "product_reviews").collect()}
    assert got == {1: ("a", None), 2: ("b", None), 3: ("c", None), 4: (None, C.ERR_NO_DOC_ID), 5: ("d", None),
                   6: ("e", C.ERR_NO_AFTER), 7: ("7", None)}


def test_lists_of_any_elements(spark):
    text = json.dumps([" a ", "a", " b\t", "", "   ", None, 1, 2.5, True, {"x": 1}, [1], "é", "c d ", "\x7fz", "!"])
    got = spark.range(1).select(S.clean_list(V.str_list(F.parse_json(F.lit(text)))).alias("y")).first()["y"]
    assert got == ["a", "b", "1", "2.5", "true", '{"x":1}', "[1]", "é", "c d", "\x7fz", "!"]
    none = spark.range(1).select(S.clean_list(V.str_list(F.parse_json(F.lit('"a"')))).alias("y")).first()["y"]
    assert none == []


def test_layers_parse_each_document_once(spark, sf):
    """Metrics and marts read written clean rows, they do not parse anew."""
    for _, _, clean in CT._document_layers(spark, sf).values():
        assert "json" not in clean._jdf.queryExecution().analyzed().toString().lower()
    for df in CT._relational_layers(spark, sf)[1:3]:
        assert "Aggregate" not in df._jdf.queryExecution().analyzed().toString()


def test_states_hold_what_marts_read(spark, sf):
    old_orders, old_customers = CT._incremental_relational(spark, sf)[:2]
    assert "product_name" not in old_orders.columns and "email" not in old_customers.columns
    parsed = CH.parse_documents(spark.createDataFrame([_message(1, "c", {"_id": 1, "review_id": "r", "rating": 4})], FEED_SCHEMA), "product_reviews")
    changes = CH.document_changes(parsed, ["review_id", "rating"], raw=False)
    assert changes.columns == ["pk", "_pos", "_past", "_deleted", "_op", "review_id", "rating"]
    assert [tuple(r)[3:] for r in CH.fold(changes).collect()] == [(False, "c", "r", 4)]
