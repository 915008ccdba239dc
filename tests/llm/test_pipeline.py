import importlib.util

import pytest

import corpus_pipeline as P
from pyspark.sql import functions as F
from riverbed.llm import decontaminate, packing, quality, secrets, simhash
from test_decontaminate import brute as brute_hits
from test_packing import check as check_packing
from test_quality import brute as brute_counts
from test_quality import failed
from test_secrets import brute as brute_secrets
from test_simhash import brute_fp

SECRET = 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf, docs):
    """The documents before the first and after each stage, written and reread."""
    out, now = [docs], docs
    for k, (_, stage) in enumerate(P.STAGES):
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-test-{id(out)}-{k}"
        stage(spark, now, sf).write.parquet(path)
        now = spark.read.parquet(path)
        out.append(now)
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stage_names_and_columns(stages):
    assert len(P.STAGES) == 5 and all(df.columns == COLUMNS for df in stages[:-1])


def test_quality_stage(spark, sf, stages):
    before, after = rows(stages[0]), rows(stages[1])
    verdict = {r["doc_id"]: r["kept"] for r in quality.judge(stages[0], spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert set(after) == {d for d, k in verdict.items() if k}
    assert not any(failed(brute_counts(r["text"])) for r in after.values()) and len(after) < len(before)
    assert all(after[d] == before[d] for d in after)


def test_near_duplicate_stage(stages):
    before, after = rows(stages[1]), rows(stages[2])
    fps = {d: brute_fp(r["text"]) for d, r in before.items()}
    root = {d: d for d in fps}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert set(after) == {find(d) for d in ids} and all(after[d] == before[d] for d in after)


def test_decontamination_stage(spark, sf, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    before, after = rows(stages[2]), rows(stages[3])
    bad = {r["doc_id"] for r in decontaminate.scan(stages[2], spark.createDataFrame(items, "item_id long, text string")).where("n_hit > 0").collect()}
    assert set(after) == set(before) - bad
    for d in list(bad)[:10] + sorted(after)[:15]:
        assert bool(brute_hits(before[d]["text"], items)[1]) == (d in bad)


def test_secret_stage(spark, sf, stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(after) == set(before)
    planted = stages[3].withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" " + SECRET))).otherwise(F.col("text")))
    for was, now in ((before, after), (rows(planted), rows(P.STAGES[3][1](spark, planted, sf)))):
        for d, r in now.items():
            assert not brute_secrets(r["text"])
            if "[SECRET]" in r["text"]:
                assert r["n_chars"] == len(r["text"])
            else:
                assert r == was[d] and not brute_secrets(was[d]["text"])
    assert {d for d, r in now.items() if "[SECRET]" in r["text"]} >= {d for d in now if d % 3 == 0} != set()


def test_packing_stage(stages):
    check_packing([(r["doc_id"], r["text"]) for r in stages[4].collect()], stages[5])


def test_run_gives_the_stages_result(spark, sf, stages):
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(map(tuple, P.run(spark, sf).select(*key).collect())) == sorted(map(tuple, stages[5].select(*key).collect()))


def test_edge_rows_and_empty_tables(spark, sf, edge, empty):
    for docs in (edge, empty):
        now = docs
        for k, (_, stage) in enumerate(P.STAGES[:-1]):
            now = stage(spark, now, sf)
            assert now.columns == COLUMNS
        assert P.STAGES[-1][1](spark, now, sf).count() >= 0


def test_entry_registers_all_of_them():
    import __spark_entry__ as E
    assert importlib.util.find_spec("riverbed.llm") and {f"op{n}" for n in range(1, 11)} | {"pipeline"} <= {q.split("_")[0] for q in E.queries()}
    assert secrets and simhash and packing
