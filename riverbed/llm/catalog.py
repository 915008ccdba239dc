"""The queries of the training-data operators, with production parameters over
their whole tables, and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.llm import (ctw, decontaminate, edit_counts, interactions, negatives, packing, quality, secrets, sharding, simhash, topk, warc,
                          wavelet)
from riverbed.llm.cells import quantized
from riverbed.llm.common import table, vocabulary


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents").select("doc_id", "text"),
                               table(spark, sf_dir, "benchmark"), n=10, keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"), shingle=3, bits=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", "score")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find(docs, secrets.train(docs))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    n = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{secrets.KINDS[k]}")
    return found.select("doc_id", n(0), n(1), n(2), F.sha2(secrets.joined(base), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"), n(3))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2, most=1024)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"), least=1000)
    return warc.read_records(index, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"), depth=5)


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = wavelet.write_shards(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1)
    return wavelet.read_shards(files).withColumnRenamed("doc", "doc_id")


def op9_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign(table(spark, sf_dir, "documents"), [1.0] * 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def edits_of(text: Column, doc_id: Column) -> Column:
    """Three edits of a text, at places that a hash of the id draws: an
    insertion of a piece of the text, a deletion and a replacement."""
    size = F.char_length(text)
    at = lambda k: F.pmod(F.xxhash64(doc_id, F.lit(k)), (size + 1).cast("long")).cast("int")
    edit = lambda a, d, t: F.struct(a.alias("at"), F.lit(d).alias("drop"), t.alias("add"))
    return F.array(edit(at(1), 0, F.substring(text, at(2) + 1, F.lit(40))), edit(at(3), 25, F.lit("")),
                   edit(at(4), 5, F.lit(" edited text ")))


def op10_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents, then again after three edits of each."""
    path = vocabulary("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = edit_counts.build_trees(docs, path)
    edits = edits_of(F.coalesce("text", F.lit("")), F.col("doc_id"))
    done = edit_counts.apply_edits(counted, edits, path)
    return done.select("doc_id", "tokens_before", "n_tokens", F.char_length("text").cast("long").alias("n_chars"),
                       "chars_encoded", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"))


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(interactions.fail_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        quantized(F.col("embedding"), 256).alias("vector"))
    return negatives.mine(rows, F.col("vec_id") % 50 == 0, positives=5, negatives=3, low=(50, 100), high=(95, 100))


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", quantized(F.col("embedding"), 64).alias("vector"))
    return topk.top_k(rows, F.col("vec_id") % 20 == 0, k=20)


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_simhash_dedup, op3_quality_rules, op4_secret_scan, op5_best_fit_packing,
                                   op6_warc, op7_lm_score, op8_token_output, op9_rendezvous_shards, op10_edit_token_counts,
                                   op11_filter_interactions, op12_hard_negatives, op13_exact_topk)}

ORACLE = {
    "op6_warc": """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
         coalesce(html, '') AS html
  FROM pages),
f AS (SELECT html, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY html)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (html)
""",
    "op1_decontaminate": r"""
WITH ben AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, array_to_string(w[i : i + 9], ' ') AS g, least(len(w), 10) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM ben WHERE len(w) > 0)),
doc AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
sizes AS (SELECT DISTINCT n FROM win),
cand AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n)),
hit AS (SELECT c.r, c.i, c.n, win.item FROM cand c JOIN win ON win.g = c.g AND win.n = c.n),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l
          FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
""",
    "op11_filter_interactions": r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
      FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
          100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
          regexp_matches(text, '[#$%&*|]'),
          coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM d LEFT JOIN l USING (doc_id)),
counted AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
fs AS (SELECT unnest(range(1, 6)) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM fs a, fs b, fs c, fs d, fs e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (SELECT o, step, o[step] AS x, o[1 : step - 1] AS before FROM orders, (SELECT unnest(range(1, 6)) AS step)),
seen AS (
  SELECT part, o, step, x, n, good, toxic, fails[x] AS fails_it,
         len(list_filter(before, lambda i: fails[i])) > 0 AS gone,
         len(list_filter(fails, lambda v: v)) = 1 AS single
  FROM counted, steps),
per AS (
  SELECT part, o, step, x,
         coalesce(sum(n) FILTER (NOT gone AND NOT fails_it), 0) AS kept,
         coalesce(sum(n) FILTER (NOT gone AND fails_it), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND fails_it), 0) AS redundant,
         coalesce(sum(n) FILTER (fails_it AND single), 0) AS unique_fails,
         coalesce(sum(n) FILTER (NOT gone AND fails_it AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (NOT gone AND fails_it AND toxic), 0) AS toxic_lost
  FROM seen GROUP BY part, o, step, x)
SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, CAST(step AS INTEGER) AS step,
       CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM per
""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
""",
    "op13_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT q.vec_id AS query_id, CAST(row_number() OVER (PARTITION BY q.vec_id
         ORDER BY CAST(list_inner_product(q.e, c.e) AS BIGINT) DESC, c.vec_id) AS INTEGER) AS rank,
       c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
QUALIFY rank <= 20
""",
}
