"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm import dart_minhash, embedding_dedup, exact_dedup, language_id, mixing, packing, personal_data, secrets, substring_dedup, token_counts
from quire.llm.common import documents
from quire.session import ship

Query = Callable[[SparkSession, str], DataFrame]


def _over_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return operator(documents(spark, sf_dir))

    return query


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return embedding_dedup.similar(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_chunk_recipes": _over_documents(exact_dedup.exact_groups),
        "op2_dart_minhash": _over_documents(dart_minhash.near_groups),
        "op3_prefix_counts": _over_documents(token_counts.token_counts),
        "op4_best_fit_packing": _over_documents(packing.pack_documents),
        "op5_nearest_centroid": _over_documents(language_id.predict),
        "op6_hierarchical_mix": _over_documents(mixing.select),
        "op7_secret_scan": _over_documents(secrets.secret_spans),
        "op8_gear_passages": _over_documents(substring_dedup.repeated_spans),
        "op9_cross_polytope": _embeddings,
        "op10_anchor_pii": _over_documents(personal_data.personal_spans),
        "pipeline": _pipeline,
    }


EXACT_SQL = """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(own) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS own FROM documents)
WINDOW same AS (PARTITION BY own)"""

# cosine over all pairs of a label; the components by recursion
EMBEDDINGS_SQL = """WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT a AS vec_id, b AS other FROM links UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
least_of AS (SELECT vec_id, min(other) AS least FROM reach GROUP BY vec_id),
degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, least(e.vec_id, coalesce(l.least, e.vec_id)) AS component_id, e.vec_id = least(e.vec_id, coalesce(l.least, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN degree d ON e.vec_id = d.vec_id LEFT JOIN least_of l ON e.vec_id = l.vec_id"""


def oracle_sql() -> dict[str, str]:
    return {"op1_chunk_recipes": EXACT_SQL, "op6_hierarchical_mix": mixing.sql(), "op9_cross_polytope": EMBEDDINGS_SQL}
