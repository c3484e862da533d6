"""Batches of documents: shards, resuming, summaries, worker roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.tables import materialize


def places(rows: DataFrame, order: str, name: str = "place") -> DataFrame:
    """The place of each row in the sorted list, from 0.

    Places are computed without one global sort task: the list is ranged into parts once and written, parts are
    counted, and a row's place is its part's first place and its rank within.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(rows.repartitionByRange(parts, order).withColumn("part", F.spark_partition_id()), "ranged")
    within = ranged.withColumn("within", F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1)
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    first = sizes.withColumn("first", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    placed = within.join(first.select("part", F.coalesce("first", F.lit(0)).alias("first")), "part")
    return placed.withColumn(name, F.col("first") + F.col("within")).drop("part", "within", "first")


def round_robin(files: DataFrame, order: str, count: int) -> DataFrame:
    """shard: the file's place in the sorted list, modulo count."""
    if count < 1:
        raise ValueError("at least one shard")
    return places(files, order).withColumn("shard", F.pmod(F.col("place"), F.lit(count)).cast("int")).drop("place")


def launchable(files: DataFrame, workers: int, previous: DataFrame | None = None, previous_workers: int | None = None) -> None:
    """Refuse a batch with more workers than files, or one that resumes another with other workers or another list.

    files and previous: input. The lists are compared by their numbers and by what only one of them has.
    """
    n = files.count()
    if not 1 <= workers <= n:
        raise ValueError(f"{workers} workers for {n} files")
    if previous is not None:
        alike = previous.count() == n and files.select("input").exceptAll(previous.select("input")).isEmpty()
        if workers != previous_workers or not alike:
            raise ValueError("a batch is resumed with the same files and as many workers")


def exit_code(summaries: DataFrame, keys: list[str]) -> DataFrame:
    """keys, exit_code: 1 if any document did not end well, else 0. summaries: keys, status."""
    return summaries.groupBy(*keys).agg(F.max((F.coalesce("status", F.lit("")) != "ok").cast("int")).alias("exit_code"))


def resume(wanted: DataFrame, finished: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows still to do, rows that are stored). Failed work is not in finished and is done again."""
    return wanted.join(finished.select(*keys), keys, "left_anti"), wanted.select(*keys).join(finished, keys)


def coalesce_manifest(current: DataFrame, previous: DataFrame, keys: list[str]) -> DataFrame:
    """Values of the current manifest, else those of the previous run."""
    old = previous.select(*keys, *(F.col(c).alias(f"{c}_old") for c in previous.columns if c not in keys))
    both = current.join(old, keys, "left")
    return both.select(*keys, *(F.coalesce(c, f"{c}_old").alias(c) if f"{c}_old" in both.columns else F.col(c) for c in current.columns if c not in keys))


def run_summary(pages: DataFrame, keys: list[str]) -> DataFrame:
    """pages: keys, n_tables, error. Status is partial if a page failed; unresolved tables alone do not matter."""
    failed = F.col("error").isNotNull()
    out = pages.groupBy(*keys).agg(F.sum((~failed).cast("long")).alias("processed_pages"), F.sum(F.when(failed, 0).otherwise(F.col("n_tables"))).cast("long").alias("tables"), F.sum(failed.cast("long")).alias("errors"))
    return out.withColumn("status", F.when(F.col("errors") > 0, "partial").otherwise("ok"))


def batch_rollup(summaries: DataFrame, exits: DataFrame) -> DataFrame:
    """summaries: worker, input, status, pages, tables; exits: worker, exit_code. One row per worker known to either
    side; failed unless its exit code is 0."""
    sums = summaries.groupBy("worker").agg(F.count(F.lit(1)).alias("documents"), F.sum("pages").alias("pages"), F.sum("tables").alias("tables"))
    out = exits.join(sums, "worker", "full").fillna(0, ["documents", "pages", "tables"])
    return out.withColumn("failed", F.coalesce(F.col("exit_code") != 0, F.lit(True))).select("worker", "exit_code", "documents", "pages", "tables", "failed")


def unique_outputs(summaries: DataFrame, key: str = "output") -> DataFrame:
    """summaries, refusing two inputs that would be published under one name."""
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    return summaries.withColumn("n", n).withColumn(key, F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("conflicting output: "), F.col(key)))).otherwise(F.col(key))).drop("n")
