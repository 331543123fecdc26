"""Mining, neighbour search and whitening of ``embeddings`` as queries, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import block_search, hard_negatives, whitening


def _embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet")


def negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_embeddings(spark, folder), F.pmod("vec_id", F.lit(50)) == 0, moved)


def neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return block_search.nearest(_embeddings(spark, folder), F.pmod("vec_id", F.lit(20)) == 0)


def whitened(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_embeddings(spark, folder))


QUERIES = {
    "op11_hard_negatives": negatives,
    "op12_nearest_neighbours": neighbours,
    "op13_whitening": whitened,
}

_SOUND = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

ORACLES = {
    "op11_hard_negatives": f"""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings WHERE label IS NOT NULL AND {_SOUND}),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_sum(list_transform(list_zip(a.x, c.x), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same) WHERE r <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
    "op12_nearest_neighbours": f"""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE {_SOUND} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
}
