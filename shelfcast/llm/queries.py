"""Named queries of the corpus operators, each over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.frames import table

SHARDS = 40
TOKEN_LIMIT = 1024
ACCEPTED = 0.3
SEQUENCE = 2048
EVERY, NEIGHBOURS = 50, 5


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_feistel_sharding(spark: SparkSession, folder: str) -> DataFrame:
    from shelfcast.llm.sharding import shard

    return shard(table(spark, folder, "documents"), SHARDS)


def op2_fourier_quality(spark: SparkSession, folder: str) -> DataFrame:
    from shelfcast.llm.quality import quality_scores

    scores = quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scores.withColumn("predicted", (F.col("score") >= ACCEPTED).cast("int"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    from shelfcast.llm.token_counts import token_counts

    counts = token_counts(table(spark, folder, "documents"), tokenizer_path())
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op4_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    from shelfcast.llm.revisits import page_records, resolved

    return resolved(page_records(table(spark, folder, "pages")))


def op5_circulant_minhash(spark: SparkSession, folder: str) -> DataFrame:
    from shelfcast.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, folder, "documents"))


def op6_multinomial_mixing(spark: SparkSession, folder: str) -> DataFrame:
    from shelfcast.llm.mixing import mixed_sizes

    return mixed_sizes(table(spark, folder, "documents"))


def op7_mtree_search(spark: SparkSession, folder: str) -> DataFrame:
    from shelfcast.llm.mtree import top_products

    return top_products(table(spark, folder, "embeddings"), EVERY, NEIGHBOURS)


def op8_ans_token_files(spark: SparkSession, folder: str) -> DataFrame:
    from shelfcast.llm.token_files import token_digests

    return token_digests(table(spark, folder, "documents"), tokenizer_path())


def op9_multiprobe_lsh(spark: SparkSession, folder: str) -> DataFrame:
    from shelfcast.llm.lsh import nearest

    return nearest(table(spark, folder, "embeddings"), EVERY, NEIGHBOURS)


def op10_vector_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    from shelfcast.llm.packing import packed

    return packed(table(spark, folder, "documents"), tokenizer_path(), SEQUENCE)


def op11_shallot_clusters(spark: SparkSession, folder: str) -> DataFrame:
    from shelfcast.llm.shallot import clustered

    return clustered(table(spark, folder, "embeddings"))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    from shelfcast.llm.alignment import aligned

    return aligned(table(spark, folder, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op13_t_occurrence_join(spark: SparkSession, folder: str) -> DataFrame:
    from shelfcast.llm.t_occurrence import similar_groups

    return similar_groups(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_feistel_sharding": op1_feistel_sharding,
    "op2_fourier_quality": op2_fourier_quality,
    "op3_token_counts": op3_token_counts,
    "op4_warc_revisits": op4_warc_revisits,
    "op5_circulant_minhash": op5_circulant_minhash,
    "op6_multinomial_mixing": op6_multinomial_mixing,
    "op7_mtree_search": op7_mtree_search,
    "op8_ans_token_files": op8_ans_token_files,
    "op9_multiprobe_lsh": op9_multiprobe_lsh,
    "op10_vector_best_fit": op10_vector_best_fit,
    "op11_shallot_clusters": op11_shallot_clusters,
    "op12_token_alignment": op12_token_alignment,
    "op13_t_occurrence_join": op13_t_occurrence_join,
}


def _clusters_sql(rounds: int = 3) -> str:
    """Assignments and floored means, one pair of CTEs for each round."""
    nearest = """a{n} AS (
  SELECT p.row, arg_min(c.cluster, [d, c.cluster]) AS cluster, min(d) AS distance FROM (
    SELECT v.row, c.cluster, list_sum(list_transform(list_zip(v.x, c.x),
      lambda z: (z[1] - z[2])::HUGEINT * (z[1] - z[2])))::HUGEINT AS d FROM v CROSS JOIN c{n} c
  ) p JOIN c{n} c USING (cluster) GROUP BY p.row)"""
    moved = """s{n} AS (
  SELECT cluster, pos, sum(x)::HUGEINT AS total, count(*) AS n FROM (
    SELECT cluster, unnest(x) AS x, unnest(range(len(x))) AS pos FROM v JOIN a{n} USING (row))
  GROUP BY ALL
), c{m} AS (
  SELECT c.cluster, coalesce(s.x, c.x) AS x FROM c{n} c LEFT JOIN (
    SELECT cluster, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY pos) AS x FROM s{n} GROUP BY cluster
  ) s USING (cluster))"""
    steps = []
    for n in range(rounds):
        steps += [nearest.format(n=n), moved.format(n=n, m=n + 1)]
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda e: floor(64 * e::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS cluster, x
  FROM v WHERE vec_id IS NOT NULL QUALIFY cluster < 16
), {", ".join(steps)}, {nearest.format(n=rounds)}
SELECT v.vec_id, a.cluster::INTEGER AS cluster, a.distance::BIGINT AS distance,
  (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
  (sum(a.distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (row) JOIN c{rounds} c ON a.cluster = c.cluster
"""


def _groups_sql(words: int, percent: int, more: str = "") -> str:
    """Components of all pairs of shingle sets at the similarity."""
    return rf"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < {words} THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - {words} + 2), lambda i: array_to_string(words[i:i + {words} - 1], ' ')) END) AS s
  FROM cut
), flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c
  FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (SELECT a, b FROM common WHERE 100 * c >= {percent} * (na + nb - c)),
reach AS (
  SELECT doc_id, doc_id AS r FROM sets
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a
), least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(s) AS n_shingles, component_id{more}
FROM sets JOIN least USING (doc_id)
"""


ORACLES: dict[str, str] = {
    "op11_shallot_clusters": _clusters_sql(),
    "op7_mtree_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5
""",
    "op5_circulant_minhash": _groups_sql(5, 75, ", doc_id = component_id AS kept"),
    "op13_t_occurrence_join": _groups_sql(3, 90),
}
