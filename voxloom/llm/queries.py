"""The operators of this subpackage as queries on the driver's tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vector_queries
from .bpe import encode_and_check
from .fingerprints import edited_fingerprints, to_text
from .licenses import TEMPLATES, WHOLE_TEXTS, find_licenses
from .mixing import mix
from .near_dedup import near_duplicates
from .secret_scan import BASE_RULES, RULES, find_secrets
from .sharding import place
from .substring_dedup import remove_repeats
from .topk import top_k
from .toxicity import fit, score

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = tuple(f"shard-{k:02d}" for k in range(64))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shard_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return place(table(spark, folder, "documents"), SHARDS).select("doc_id", "slot", "shard")


def spans_text(secrets: Column, kinds: tuple[str, ...] | None = None) -> Column:
    chosen = secrets if kinds is None else F.filter(secrets, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = find_secrets(table(spark, folder, "documents"))
    base = tuple(r.kind for r in BASE_RULES)

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(spans_text(F.col("secrets"), base), 256).alias("base_sha256"),
        spans_text(F.col("secrets")).alias("spans"),
    )


def mixture(spark: SparkSession, folder: str) -> DataFrame:
    rows = mix(table(spark, folder, "documents"))
    # What the mix takes is what its blocks bring to the shards: a copy without a shard would not count.
    taken = F.coalesce(F.sum(F.when(F.col("shard").isNotNull(), F.col("size"))), F.lit(0)).cast("bigint")
    return rows.groupBy("row", "doc_id", "size", "source_size", "target").agg(taken.alias("taken")).drop("row")


def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), width=4)


def held_out(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string")), F.lit(5)) == 0


def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = fit(documents, table(spark, folder, "labels"), ~held_out(F.col("doc_id")))
    return score(documents, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(table(spark, folder, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        to_text(F.col("lanes")).alias("fingerprint"),
        to_text(F.col("edited_lanes")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def rank_file() -> tuple[str, str]:
    """Path of the rank file and the pattern that cuts texts for it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def bpe_digests(documents: DataFrame) -> DataFrame:
    ranks, pattern = rank_file()
    ids = encode_and_check(documents, ranks, pattern)
    return ids.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), "decoded_sha256")


def bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digests(table(spark, folder, "documents"))


def vector_search(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.pmod("vec_id", F.lit(100)) == 0)


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = find_licenses(table(spark, folder, "documents"), {**TEMPLATES, **WHOLE_TEXTS})
    spans = F.transform("licenses", lambda m: F.concat_ws(":", m["license"], m["start"], m["end"]))
    return found.select(
        "doc_id",
        F.size("licenses").cast("bigint").alias("n_matches"),
        F.array_join(spans, ",").alias("spans"),
        F.coalesce(F.array_max(F.transform("licenses", lambda m: m["coverage"])), F.lit(0.0)).alias("best_coverage"),
    )


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES: dict[str, Query] = {
    "op1_shard_lookup": shard_lookup,
    "op2_secret_scan": secrets,
    "op3_source_mix": mixture,
    "op4_near_dedup": near_dedup,
    "op5_toxicity": toxicity,
    "op6_fingerprints": fingerprints,
    "op7_byte_bpe": bpe,
    "op8_vector_topk": vector_search,
    "op9_license_scan": license_scan,
    "op10_substring_dedup": substring_dedup,
    **vector_queries.QUERIES,
}


# --- SQL ---------------------------------------------------------------------------------------------------------

_SQL_RULES = {
    "assign": r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
    "hex": r"[0-9a-f]{24,}",
}


def _secrets_sql() -> str:
    parts, kinds = [], []
    for n, rule in enumerate(RULES):
        pattern = _SQL_RULES.get(rule.kind, rule.pattern.replace("'", "''"))
        group = f", {rule.group}" if rule.group else ""
        parts.append(
            f"SELECT doc_id, {n} AS k, '{rule.kind}' AS kind, {rule.least} AS least, regexp_extract_all(t, '{pattern}') AS m, "
            f"regexp_extract_all(t, '{pattern}'{group}) AS g, regexp_split_to_array(t, '{pattern}') AS s FROM d"
        )
        kinds.append(rule.kind)
    return (
        "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS ("
        + " UNION ALL ".join(parts)
        + """), e AS (SELECT doc_id, k, kind, least, m, g, s, unnest(range(len(m))) AS i FROM f WHERE len(m) > 0),
p AS (SELECT doc_id, k, kind, length(m[i + 1]) AS size,
  list_sum(list_transform(s[1:i + 1], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i], lambda x: length(x))), 0) AS a
  FROM e WHERE length(g[i + 1]) >= least),
q AS (SELECT doc_id, k, kind, a, kind || ':' || a::BIGINT || ':' || (a + size)::BIGINT AS w FROM p)
SELECT d.doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  sha256(coalesce(string_agg(w, ',' ORDER BY a, k) FILTER (k < 3), '')) AS base_sha256,
  coalesce(string_agg(w, ',' ORDER BY a, k), '') AS spans
FROM d LEFT JOIN q ON d.doc_id = q.doc_id GROUP BY d.doc_id"""
    )


_HASH60 = "('0x' || substr(md5({0}), 1, 15))::BIGINT"

_MIX_SQL = (
    r"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  """
    + _HASH60.format("'mix:0:' || doc_id")
    + r""" AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS words FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM s),
w AS (SELECT *, [1, 2, 3][(rk - 1) % 3 + 1] AS weight, words * 3 AS lim FROM r),
l AS (SELECT *, sum(words) OVER () - coalesce(sum(lim) OVER (ORDER BY lim / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
  sum(weight) OVER (ORDER BY lim / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavy,
  row_number() OVER (ORDER BY lim / weight, rk) AS place FROM w),
c AS (SELECT *, lim::HUGEINT * heavy <= weight::HUGEINT * lft AS capped FROM l),
f AS (SELECT min_by(lft, place) FILTER (NOT capped) AS fl, min_by(heavy, place) FILTER (NOT capped) AS fh FROM c),
t AS (SELECT source, words, CASE WHEN capped THEN lim::DOUBLE ELSE (weight * fl)::BIGINT::DOUBLE / fh::DOUBLE END AS target FROM c, f),
p AS (SELECT doc_id, d.source, size, words, target, h,
  coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
n AS (SELECT *, greatest(0, least(3, CASE WHEN words = 0 THEN 0 ELSE floor((target - pos - size) / words) + 1 END))::BIGINT AS copies FROM p),
m0 AS (SELECT source, max(target) - sum(copies * size)::BIGINT AS missing FROM n GROUP BY source),
c0 AS (SELECT source, doc_id, size, pos FROM n WHERE copies < 3 AND size > 0),
"""
    + "".join(
        f"""b{k} AS (SELECT c.source, min_by(c.doc_id, (abs(c.size - missing), pos, c.doc_id)) AS best,
  max(missing) - min_by(c.size, (abs(c.size - missing), pos, c.doc_id)) AS nxt
  FROM c{k} c JOIN m{k} m ON c.source IS NOT DISTINCT FROM m.source WHERE {test} GROUP BY c.source),
m{k + 1} AS (SELECT m.source, coalesce(nxt, missing) AS missing FROM m{k} m LEFT JOIN b{k} b ON m.source IS NOT DISTINCT FROM b.source),
c{k + 1} AS (SELECT * FROM c{k} WHERE doc_id NOT IN (SELECT best FROM b{k})),
"""
        for k, test in enumerate(["c.size <= missing"] * 3 + ["abs(c.size - missing) < missing"])
    )
    + """more AS (SELECT best FROM b0 UNION ALL SELECT best FROM b1 UNION ALL SELECT best FROM b2 UNION ALL SELECT best FROM b3)
SELECT n.doc_id, n.size, n.words AS source_size, n.target,
  (n.size * (n.copies + CASE WHEN n.doc_id IN (SELECT best FROM more) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM n"""
)

_FINGERPRINT_SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
nx AS (SELECT doc_id, t, length(t) AS n, coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS nt FROM d),
e AS (SELECT doc_id, n, t, nt, left(t, n - n // 2) || left(nt, n // 2) AS ed FROM nx),
x AS (SELECT doc_id, 1 AS which, t AS v FROM e UNION ALL SELECT doc_id, 2, ed FROM e UNION ALL SELECT doc_id, 3, nt FROM e),
h AS (SELECT doc_id, which, list_transform(list_filter(string_split(v, chr(10)), lambda p: p <> ''), lambda p: sha256(p)) AS hs FROM x),
dn AS (SELECT doc_id, which, list_transform(range(8), lambda k: (coalesce(list_sum(list_transform(hs, lambda q: ('0x' || substr(q, (8 * k + 1)::INT, 8))::BIGINT)), 0) % 4294967296)::BIGINT) AS dense FROM h),
un AS (SELECT doc_id, which, unnest(regexp_extract_all(regexp_replace(v, '([.,;:!?。，、！？；：] ?)', '\1' || chr(10), 'g'), '[^\n]{1,32}')) AS piece FROM x),
hx AS (SELECT doc_id, which, ('0x' || substr(md5(piece), 1, 15))::BIGINT AS h FROM un),
g AS (SELECT doc_id, which, k * 512 + h % 512 AS lane, (sum((h >> 39) % 65535 + 1) % 65536)::BIGINT AS val
  FROM hx, range(16) levels(k) WHERE (h >> 9) % (1::BIGINT << (2 * k)) = 0 GROUP BY ALL HAVING val <> 0),
sp AS (SELECT doc_id, which, string_agg(printf('%08x', lane * 65536 + val), '' ORDER BY lane) AS tail FROM g GROUP BY doc_id, which),
fp AS (SELECT dn.doc_id, dn.which, list_aggregate(list_transform(dense, lambda z: printf('%08x', z)), 'string_agg', '') || coalesce(tail, '') AS fp
  FROM dn LEFT JOIN sp ON dn.doc_id = sp.doc_id AND dn.which = sp.which),
pr AS (SELECT doc_id, other, lane, max(CASE WHEN which = 1 THEN val END) AS a, max(CASE WHEN which = other THEN val END) AS b
  FROM g, (VALUES (2), (3)) o(other) WHERE which IN (1, other) GROUP BY ALL),
lv AS (SELECT doc_id, other, lane // 512 AS level, count(a) AS na, count(b) AS nb, count(*) AS nu, count(*) FILTER (a = b) AS nc FROM pr GROUP BY ALL),
ok AS (SELECT doc_id, other, arg_min(na, level) AS na, arg_min(nb, level) AS nb, arg_min(nu - nc, level) AS nd FROM lv WHERE nu <= 360 GROUP BY ALL),
es AS (SELECT doc_id, other, -512 * ln(1 - least(na, 511) / 512) AS ea, -512 * ln(1 - least(nb, 511) / 512) AS eb, -512 * ln(1 - least(nd, 511) / 512) AS ed FROM ok),
lk AS (SELECT a.doc_id, b.which, CASE WHEN a.fp = b.fp THEN 1.0 ELSE round(least(greatest(coalesce((ea + eb - ed) / nullif(ea + eb + ed, 0), 0), 0), 1.0 - 1.0 / 512), 6) END::DOUBLE AS near
  FROM fp a JOIN fp b ON a.doc_id = b.doc_id AND a.which = 1 AND b.which > 1 LEFT JOIN es ON es.doc_id = b.doc_id AND es.other = b.which)
SELECT e.doc_id, e.n::BIGINT AS n_chars, sha256(e.ed) AS edited_sha256, f1.fp AS fingerprint, f2.fp AS edited_fingerprint, l2.near AS near_edited, l3.near AS near_next
FROM e JOIN fp f1 ON f1.doc_id = e.doc_id AND f1.which = 1 JOIN fp f2 ON f2.doc_id = e.doc_id AND f2.which = 2
JOIN lk l2 ON l2.doc_id = e.doc_id AND l2.which = 2 JOIN lk l3 ON l3.doc_id = e.doc_id AND l3.which = 3"""

_NEAR_SQL = r"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM d),
u AS (SELECT doc_id, unnest(g) AS x, len(g) AS n FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
reach(doc_id, to_id) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, l.b FROM reach r JOIN l ON r.to_id = l.a)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, min(r.to_id) AS component_id, s.doc_id = min(r.to_id) AS kept
FROM s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.g"""

_TOPK_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""

_REPEATS_SQL = r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
m AS (SELECT x, min(doc_id) AS low FROM g GROUP BY x),
c AS (SELECT DISTINCT g.doc_id, i + k AS i FROM g JOIN m ON g.x = m.x AND g.doc_id > m.low, (SELECT unnest(range(13)) AS k)),
r AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(gone, []), i)), ' '), '')) AS kept_sha256
FROM d LEFT JOIN r ON d.doc_id = r.doc_id"""

ORACLES: dict[str, str] = {
    "op2_secret_scan": _secrets_sql(),
    "op3_source_mix": _MIX_SQL,
    "op4_near_dedup": _NEAR_SQL,
    "op6_fingerprints": _FINGERPRINT_SQL,
    "op8_vector_topk": _TOPK_SQL,
    "op10_substring_dedup": _REPEATS_SQL,
    **vector_queries.ORACLES,
}
