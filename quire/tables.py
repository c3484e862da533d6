"""Tables written between the rounds of iterative operators.

They lie under the folder that the cluster names in ``spark.checkpoint.dir``, so a lost executor costs only the
tasks it ran, and lineage ends at a table that every executor can read.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only on one machine, as in tests, may it be unset: a temporary folder is taken then."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.gettempdir()}/quire-checkpoint"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back. The table is removed when it is released or the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quire/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _written:
        atexit.register(_remove_written)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._quire_path = path
    return out


def _remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release(*tables: DataFrame) -> None:
    """Remove written tables that nothing reads any more."""
    for path in (t._quire_path for t in tables):
        for entry in [e for e in _written if e[1] == path]:
            _written.remove(entry)
            _remove(*entry)


def release_since(mark: int, *kept: DataFrame) -> None:
    """Remove what was written since written_tables() was mark, but for the tables kept."""
    paths = {t._quire_path for t in kept}
    for entry in [e for e in _written[mark:] if e[1] not in paths]:
        _written.remove(entry)
        _remove(*entry)


def written_tables() -> int:
    return len(_written)


def _remove_written() -> None:
    for spark, path in _written:
        try:
            _remove(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone at exit; the folder is then the cluster's to clear
            return
