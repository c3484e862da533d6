"""Inputs and sinks: file listings, format dispatch, page selection, result trees, per-document text files."""

from __future__ import annotations

import json
import math
import platform
import sys
import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_PAGES = 100_000
FORMATS = {"pdf": "pdf", "docx": "word", "doc": "word"}


def input_files(spark: SparkSession, where: str, kind: str | None = None) -> DataFrame:
    """path, format, length, content of the PDF and word-processor files of a folder (not below it) or of one file.

    Suffixes are compared without case, on every way in. A folder without such files is refused; one that holds both
    kinds is refused when read, unless kind is given.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(where)
    suffix = F.lower(F.regexp_extract("path", "\\.([^./]+)$", 1))
    known = F.create_map(*[F.lit(x) for pair in FORMATS.items() for x in pair])
    own = files.withColumn("format", F.try_element_at(known, suffix)).where("format is not null")
    if own.where(F.lit(True) if kind is None else F.col("format") == kind).select("path").isEmpty():
        raise FileNotFoundError(f"no {kind or 'document'} files: {where}")
    if kind:
        return own.where(F.col("format") == kind).select("path", "format", "length", "content")
    kinds = own.agg(F.count_distinct("format").alias("kinds"))
    checked = own.join(F.broadcast(kinds))  # one row
    ok = F.when(F.col("kinds") > 1, F.raise_error(F.lit("mixed folder: choose a format"))).otherwise(F.col("format"))
    return checked.withColumn("format", ok).select("path", "format", "length", "content")


def page_selection(spec: Column) -> Column:
    """'1,3-5' to a sorted array of pages; null for what is no selector or names too many pages."""
    parts = F.transform(F.split(spec, ","), lambda p: F.trim(p))
    shaped = F.forall(parts, lambda p: p.rlike("^[0-9]+( *- *[0-9]+)?$"))
    bounds = F.transform(parts, lambda p: F.transform(F.split(p, "-"), lambda b: F.trim(b).try_cast("bigint")))
    first, last = (lambda b: F.get(b, F.lit(0))), (lambda b: F.get(b, F.size(b) - 1))
    sound = F.forall(bounds, lambda b: F.coalesce((first(b) >= 1) & (last(b) >= first(b)) & (last(b) - first(b) < MOST_PAGES), F.lit(False)))
    pages = F.array_sort(F.array_distinct(F.flatten(F.transform(bounds, lambda b: F.sequence(first(b), last(b))))))
    return F.when(F.coalesce(shaped, F.lit(False)), F.when(sound, F.when(F.size(pages) <= MOST_PAGES, pages)))


def probability(value: str) -> float:
    number = float(value)
    if not math.isfinite(number) or not 0 <= number <= 1:
        raise ValueError("must be between 0 and 1")
    return number


def result_documents(spark: SparkSession, where: str, schema: str) -> DataFrame:
    """Every document.json below a folder, once per file."""
    found = spark.read.schema(schema).option("multiLine", "true").option("pathGlobFilter", "document.json").option("recursiveFileLookup", "true").json(where)
    return found.withColumn("path", F.input_file_name()).dropDuplicates(["path"])


def selected_pages(pages: DataFrame, document: list[str], wanted: list[int] | None = None, most: int | None = None, page: str = "page") -> DataFrame:
    """The wanted pages, or the first ``most``, of every document; a wanted page that a document lacks is refused."""
    if wanted:
        short = pages.groupBy(*document).agg(F.max(page).alias("last")).where(F.col("last") < max(wanted)).first()
        if short:
            raise ValueError(f"page {max(wanted)} is beyond the {short['last']} pages of {[short[d] for d in document]}")
        return pages.where(F.col(page).isin(wanted))
    return pages if most is None else pages.where(F.col(page) <= most)


def write_texts(texts: DataFrame, where: str, key: str = "doc_id", buckets: int = 64) -> None:
    """key and text of many documents to a file, dealt to buckets by key, so that one document is found in one file."""
    dealt = texts.select(key, "text").withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    dealt.repartition(buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(where)


def write_documents(rows: DataFrame, where: str, folder: str, files: dict[str, str], indent: int | None = 2) -> int:
    """One folder per document: where/<folder>/<name> for each name and column of files; null columns give no file.

    where is a URI or an absolute path that every executor can write; an empty one means that folder holds whole
    paths. Each file is written under a temporary name and moved when whole, so a file that is there is complete and a
    task that runs again does no harm. Files named .json are indented, with letters of all scripts as they are. Gives
    the number of documents.
    """
    written = rows.sparkSession.sparkContext.accumulator(0)

    def run(part):
        from pyarrow import fs

        for row in part:
            store, root = fs.FileSystem.from_uri("/".join(x for x in (where.rstrip("/"), str(row[folder])) if x))
            store.create_dir(root, recursive=True)
            for name, column in files.items():
                value = row[column]
                if value is None:
                    continue
                if name.endswith(".json") and indent is not None:
                    value = json.dumps(json.loads(value), ensure_ascii=False, indent=indent) + "\n"
                temporary = f"{root}/.{name}.{uuid.uuid4().hex}"
                with store.open_output_stream(temporary) as out:
                    out.write(value.encode() if isinstance(value, str) else bytes(value))
                store.move(temporary, f"{root}/{name}")
            written.add(1)

    rows.select(folder, *dict.fromkeys(files.values())).foreachPartition(run)
    return written.value


def write_json(rows: DataFrame, where: str) -> None:
    rows.write.mode("errorifexists").option("ignoreNullFields", "false").json(where)


class Tee:
    """What is printed goes to a file as well: with Tee(path): ..."""

    def __init__(self, path: str):
        self.file = open(path, "a", encoding="utf-8", buffering=1)  # noqa: SIM115

    def __enter__(self) -> Tee:
        self.plain, sys.stdout = sys.stdout, self
        return self

    def __exit__(self, *_: object) -> None:
        sys.stdout = self.plain
        self.file.close()

    def write(self, text: str) -> int:
        self.file.write(text)
        return self.plain.write(text)

    def flush(self) -> None:
        self.file.flush()
        self.plain.flush()


def run_id() -> str:
    return datetime.now(UTC).strftime("%Y%m%dT%H%M%SZ")


def run_manifest(spark: SparkSession, run: str, config: dict, inputs: DataFrame, models: dict[str, dict] | None = None) -> DataFrame:
    """One row: run, config, models (whatever names their files, sizes and digests) and runtime as JSON, number and
    total size of the inputs."""
    as_json = lambda value: F.lit(json.dumps(value, ensure_ascii=False, sort_keys=True))
    runtime = {"spark": spark.version, "python": platform.python_version(), "java": spark.sparkContext._jvm.System.getProperty("java.version"), "system": platform.platform(), "parallelism": spark.sparkContext.defaultParallelism}
    return inputs.agg(F.count(F.lit(1)).alias("inputs"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).select(
        F.lit(run).alias("run_id"), as_json(config).alias("config"), as_json(models or {}).alias("models"), as_json(runtime).alias("runtime"), "inputs", "bytes"
    )
