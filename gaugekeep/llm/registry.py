"""Queries of this package and their SQL, for the driver's contract."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugekeep.llm import (ann, bpe, hard_negatives, jaccard_join, mixing, packing, pii, sharding, simhash, suffix_dedup,
                           toxicity, url_filter, whitening)

SHARDS = [f"shard-{i:02d}" for i in range(32)]
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
PACK_FILE, BPE_FILE = "word_bpe_49k.json", "byte_bpe_50k.json"


def tokenizer(name: str) -> str:
    return importlib.import_module("public_tokenizers").path(name)


def pre_tokens() -> str:
    return importlib.import_module("public_tokenizers").PATTERN


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def op3_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = _read(spark, d, "documents")
    return toxicity.scored(docs, toxicity.train(docs, _read(spark, d, "labels")))


def op4_url_filter(spark: SparkSession, d: str) -> DataFrame:
    pages = _read(spark, d, "pages")
    return url_filter.judge(pages, RULES, url_filter.labelled_by_rules(pages, RULES))


def op12_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    """Labels of every seventh row are moved on by one first."""
    label = F.col("label")
    return hard_negatives.mine(_read(spark, d, "embeddings"), F.col("vec_id") % 50 == 0,
                               relabel=F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))


def op13_mixing(spark: SparkSession, d: str) -> DataFrame:
    """Documents labelled good count four times those labelled poor; the others lie between."""
    quality = _read(spark, d, "labels").select("doc_id", (F.lit(0.5) + 1.5 * F.col("quality")).alias("quality"))
    return mixing.mix(_read(spark, d, "documents"), quality=quality)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    docs = lambda s, d: _read(s, d, "documents")
    return {
        "op1_packing": lambda s, d: packing.pack(docs(s, d), tokenizer(PACK_FILE)),
        "op2_suffix_dedup": lambda s, d: suffix_dedup.remove_repeats(docs(s, d)),
        "op3_toxicity": op3_toxicity,
        "op4_url_filter": op4_url_filter,
        "op5_simhash": lambda s, d: simhash.fingerprint_edits(docs(s, d)),
        "op6_pii": lambda s, d: pii.find_pii(docs(s, d)),
        "op7_sharding": lambda s, d: sharding.place(docs(s, d), SHARDS),
        "op8_jaccard_join": lambda s, d: jaccard_join.near_duplicates(docs(s, d)),
        "op9_bpe": lambda s, d: bpe.encode_decode(docs(s, d), tokenizer(BPE_FILE), pre_tokens()),
        "op10_hilbert_ann": lambda s, d: ann.neighbours(_read(s, d, "embeddings"), F.col("vec_id") % 20 == 0),
        "op11_whitening": lambda s, d: whitening.whiten(_read(s, d, "embeddings")),
        "op12_hard_negatives": op12_hard_negatives,
        "op13_mixing": op13_mixing,
    }


def _sharding_sql() -> str:
    """The same table by turns, one claim per step of a recursive query."""
    names = ", ".join(f"({i}, '{s}')" for i, s in enumerate(SHARDS))
    m, n = sharding.SLOTS, len(SHARDS)
    number = "CAST('0x' || substr(md5({}), 1, 8) AS BIGINT)"
    return f"""
WITH RECURSIVE shards(i, name) AS (VALUES {names}),
prefs AS (SELECT list({number.format("name || '#offset'")} % {m} ORDER BY i) AS o,
                 list({number.format("name || '#skip'")} % ({m} - 1) + 1 ORDER BY i) AS s FROM shards),
claims(step, slot, taken) AS (
  SELECT 0, -1::BIGINT, bitstring('0', {m}) UNION ALL
  SELECT step + 1, c.slot, set_bit(taken, CAST(c.slot AS INTEGER), 1)
  FROM (SELECT step, taken, list_extract(list_filter(list_transform(range({m}),
          lambda j: (o[step % {n} + 1] + j * s[step % {n} + 1]) % {m}), lambda x: get_bit(taken, CAST(x AS INTEGER)) = 0), 1) AS slot
        FROM claims, prefs WHERE step < {m}) c),
placed AS (SELECT slot, name AS shard FROM claims JOIN shards ON i = (step - 1) % {n} WHERE step > 0)
SELECT doc_id, k.slot, shard FROM (SELECT doc_id, {number.format("coalesce(CAST(doc_id AS VARCHAR), '')")} % {m} AS slot FROM documents) k
JOIN placed p ON p.slot = k.slot"""


NEGATIVES_SQL = """
WITH one AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, x) = 1),
r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, x FROM one),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
             CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score,
       s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 100 * s.score BETWEEN 50 * positive_score AND 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3"""

MIXING_SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{mixing.WORD}')), 0) AS BIGINT) AS size FROM documents),
q AS (SELECT doc_id, avg(0.5 + 1.5 * quality) AS q FROM labels GROUP BY doc_id),
n AS (SELECT d.*, CAST(floor(-ln((CAST('0x' || substr(md5('{mixing.SEED}' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5)
                 / 4503599627370496.0) / CASE WHEN q IS NULL THEN 1.0 WHEN q > {mixing.LEAST_QUALITY} AND isfinite(q) THEN q
                 ELSE {mixing.LEAST_QUALITY} END * 281474976710656.0) AS BIGINT) AS place
      FROM d LEFT JOIN q ON q.doc_id = d.doc_id),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w, 2.0::DOUBLE * source_size AS cap FROM s0),
s2 AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
          - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s1),
s3 AS (SELECT *, max(CASE WHEN cap / w > level THEN level END) OVER () AS top FROM s2),
s4 AS (SELECT source, source_size, CASE WHEN top IS NULL THEN cap ELSE least(cap, w * top) END AS target FROM s3),
s5 AS (SELECT *, CAST(round(target) AS BIGINT) AS words,
              CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM s4),
c AS (SELECT n.*, source_size, target, epochs, words - epochs * source_size AS rest,
             sum(size) OVER (PARTITION BY n.source ORDER BY place) AS upto, sum(size) OVER (PARTITION BY n.source, place) AS tied
      FROM n JOIN s5 ON n.source IS NOT DISTINCT FROM s5.source)
SELECT doc_id, size, source, source_size, target,
       CAST(epochs * size + CASE WHEN upto <= rest THEN size WHEN upto - tied <= rest AND tied > 0 THEN (rest - upto + tied) * size // tied ELSE 0 END AS BIGINT) AS taken
FROM c"""


def oracle_sql() -> dict[str, str]:
    return {"op7_sharding": _sharding_sql(), "op12_hard_negatives": NEGATIVES_SQL, "op13_mixing": MIXING_SQL}
