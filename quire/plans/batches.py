"""Queries over batches: documents stand for files and sources for workers."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import batch
from quire.plans.registry import query
from quire.sources import carriers as c


@query("SELECT doc_id AS input, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 7 AS INT) AS shard FROM documents")
def round_robin_shard(spark, sf_dir):
    files = c.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("input"))
    return batch.round_robin(files, "input", 7).select("input", "shard")


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'stored' ELSE 'new' END AS origin FROM documents")
def resume_incremental(spark, sf_dir):
    docs = c.table(spark, sf_dir, "documents").select("doc_id")
    finished = docs.where("doc_id % 2 = 0").withColumn("origin", F.lit("stored"))
    todo, stored = batch.resume(docs, finished, ["doc_id"])
    return todo.withColumn("origin", F.lit("new")).unionByName(stored)


PAGES = "pages_of AS (SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 9 = 0 THEN 'failed' END AS error, length(coalesce(text, '')) % 3 AS n_tables FROM conversations)"


def _summary(spark, sf_dir):
    p = c.table(spark, sf_dir, "conversations")
    pages = p.select("conv_id", F.when((F.col("conv_id") + F.col("turn")) % 9 == 0, "failed").alias("error"), (F.length(F.coalesce("text", F.lit(""))) % 3).alias("n_tables"))
    return batch.run_summary(pages, ["conv_id"])


@query(f"WITH {PAGES} SELECT conv_id, count(*) FILTER (WHERE error IS NULL) AS processed_pages, CAST(coalesce(sum(n_tables) FILTER (WHERE error IS NULL), 0) AS BIGINT) AS tables, count(error) AS errors, CASE WHEN count(error) > 0 THEN 'partial' ELSE 'ok' END AS status FROM pages_of GROUP BY conv_id")
def run_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@query(f"""WITH {PAGES}, s AS (SELECT conv_id, count(error) > 0 AS bad FROM pages_of GROUP BY conv_id)
SELECT 'worker-' || conv_id % 6 AS worker, max(CAST(bad AS INT)) AS exit_code FROM s GROUP BY 1""")
def run_exit(spark, sf_dir):
    worker = F.concat(F.lit("worker-"), (F.col("conv_id") % 6).cast("string"))
    return batch.exit_code(_summary(spark, sf_dir).withColumn("worker", worker), ["worker"])


@query(f"""WITH {PAGES}, s AS (SELECT 'conv-' || conv_id AS input, CASE WHEN count(error) > 0 THEN 'partial' ELSE 'ok' END AS status FROM pages_of GROUP BY conv_id)
SELECT input, status, row_number() OVER (ORDER BY input) - 1 AS place FROM s""")
def summary_order(spark, sf_dir):
    """Summaries with their places by input, as text."""
    own = _summary(spark, sf_dir).select(F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("input"), "status")
    return batch.places(own, "input")


@query(f"""WITH {PAGES}, s AS (SELECT conv_id, count(*) FILTER (WHERE error IS NULL) AS processed_pages, CAST(coalesce(sum(n_tables) FILTER (WHERE error IS NULL), 0) AS BIGINT) AS tables FROM pages_of GROUP BY conv_id),
sums AS (SELECT 'worker-' || conv_id % 6 AS worker, count(*) AS documents, CAST(sum(processed_pages) AS BIGINT) AS pages, CAST(sum(tables) AS BIGINT) AS tables FROM s GROUP BY 1), exits(worker, exit_code) AS (VALUES ('worker-0', 0), ('worker-1', 1), ('worker-2', 0), ('worker-3', 0), ('worker-7', 0))
SELECT worker, coalesce(exit_code, -99) AS exit_code, coalesce(documents, 0) AS documents, coalesce(pages, 0) AS pages, coalesce(tables, 0) AS tables, coalesce(exit_code <> 0, true) AS failed FROM sums FULL JOIN exits USING (worker)""")
def batch_rollup(spark, sf_dir):
    s = _summary(spark, sf_dir)
    worker = F.concat(F.lit("worker-"), (F.col("conv_id") % 6).cast("string"))
    exits = spark.createDataFrame([("worker-0", 0), ("worker-1", 1), ("worker-2", 0), ("worker-3", 0), ("worker-7", 0)], "worker string, exit_code int")
    out = batch.batch_rollup(s.select(worker.alias("worker"), F.col("processed_pages").alias("pages"), "tables"), exits)
    return out.withColumn("exit_code", F.coalesce("exit_code", F.lit(-99)))


@query("SELECT o_orderkey AS key, coalesce(o_orderstatus, 'old') AS status, CASE WHEN o_orderkey % 3 = 0 THEN 'P' || o_orderkey ELSE o_orderpriority END AS priority FROM orders")
def manifest_coalesce(spark, sf_dir):
    o = c.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    current = o.withColumn("priority", F.when(F.col("key") % 3 != 0, F.col("priority")))
    previous = o.select("key", F.lit("old").alias("status"), F.concat(F.lit("P"), F.col("key").cast("string")).alias("priority"))
    return batch.coalesce_manifest(current, previous, ["key"])
