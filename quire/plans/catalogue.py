"""Every query of the library and its DuckDB counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.plans import batches, contents, flows, grids, pages, proposals  # noqa: F401  each registers its queries
from quire.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["page_content"](spark, sf_dir)
