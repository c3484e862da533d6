import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.operators import batch, content
from quire.sources import files, providers
from quire.streaming.resume import process_new, process_new_rows


def test_page_selectors(spark):
    specs = {"1,3-5": [1, 3, 4, 5], " 2 , 2": [2], "0": None, "5-3": None, "1,,2": None, "a": None, "1-2-3": None, "-1": None, "1-200000": None, "": None, "9999999999999999999": None}
    got = spark.createDataFrame([(s,) for s in specs], "s string").select("s", files.page_selection(F.col("s")).alias("p")).collect()
    assert {r.s: r.p for r in got} == specs


def test_probabilities():
    assert files.probability("0.5") == 0.5
    for bad in ("nan", "-0.1", "1.1", "inf", "x"):
        with pytest.raises(ValueError):
            files.probability(bad)


def test_listing_and_dispatch(spark, tmp_path):
    for name in ("b.pdf", "a.PDF", "c.txt", "sub.docx"):
        (tmp_path / name).write_bytes(name.encode())
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "d.pdf").write_bytes(b"d")
    pdf = files.input_files(spark, str(tmp_path), "pdf").orderBy("path").collect()
    assert [r.path.rsplit("/", 1)[1] for r in pdf] == ["a.PDF", "b.pdf"]
    with pytest.raises(Exception, match="mixed folder"):
        files.input_files(spark, str(tmp_path)).collect()
    manifest = files.run_manifest(spark, files.run_id(), {"dpi": 144}, files.input_files(spark, str(tmp_path), "pdf")).first()
    assert manifest.inputs == 2 and manifest.bytes == 10 and '"dpi": 144' in manifest.config and spark.version in manifest.runtime


def test_folders_without_documents_are_refused(spark, tmp_path):
    (tmp_path / "x.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        files.input_files(spark, str(tmp_path))
    (tmp_path / "x.pdf").write_bytes(b"x")
    with pytest.raises(FileNotFoundError):
        files.input_files(spark, str(tmp_path), "word")


def test_pages_beyond_a_document_are_refused(spark):
    pages = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 2), ("b", 3)], "doc string, page int")
    assert files.selected_pages(pages, ["doc"], [1, 2]).count() == 4 and files.selected_pages(pages, ["doc"], most=1).count() == 2
    assert files.selected_pages(pages, ["doc"]).count() == 5
    with pytest.raises(ValueError, match="beyond"):
        files.selected_pages(pages, ["doc"], [1, 3])


def test_documents_are_written_whole(spark, tmp_path):
    rows = spark.createDataFrame([("a", '{"k":"ü"}', "text"), ("b/c", "[1]", None)], "doc string, json string, text string")
    for _ in range(2):
        assert files.write_documents(rows, f"file://{tmp_path}", "doc", {"content.json": "json", "content.md": "text"}) == 2
    assert (tmp_path / "a" / "content.json").read_text() == '{\n  "k": "ü"\n}\n' and (tmp_path / "a" / "content.md").read_text() == "text"
    assert sorted(p.name for p in (tmp_path / "b" / "c").iterdir()) == ["content.json"]
    files.write_texts(spark.createDataFrame([(i, f"t{i}") for i in range(50)], "doc_id long, text string"), str(tmp_path / "texts"), buckets=3)
    assert len(list((tmp_path / "texts").glob("bucket=*/*.parquet"))) == 3 and spark.read.parquet(str(tmp_path / "texts")).count() == 50


def test_output_is_logged(tmp_path, capsys):
    with files.Tee(str(tmp_path / "log")):
        print("seen")
    print("not logged")
    assert (tmp_path / "log").read_text() == "seen\n" and capsys.readouterr().out == "seen\nnot logged\n"


def test_batches_that_cannot_be_launched(spark):
    own = spark.createDataFrame([("a",), ("b",)], "input string")
    batch.launchable(own, 2)
    batch.launchable(own, 2, own, 2)
    for workers, previous, before in ((3, None, None), (0, None, None), (2, own, 1), (2, own.limit(1), 2), (2, spark.createDataFrame([("a",), ("c",)], "input string"), 2)):
        with pytest.raises(ValueError):
            batch.launchable(own, workers, previous, before)


def test_one_range_exchange(spark):
    plan = batch.round_robin(spark.range(100), "id", 3)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_result_trees_are_read_once(spark, tmp_path):
    for d in ("x", "y/z"):
        (tmp_path / d).mkdir(parents=True)
        (tmp_path / d / "document.json").write_text('{"status":\n "ok"}')
    (tmp_path / "x" / "other.json").write_text("{}")
    got = files.result_documents(spark, str(tmp_path), "status string").collect()
    assert [r.status for r in got] == ["ok", "ok"]


def test_new_files_are_processed_once(spark, tmp_path):
    source, target, seen = (str(tmp_path / n) for n in ("in", "out", "seen"))
    (tmp_path / "in").mkdir()
    run = lambda: process_new(spark, source, target, seen, lambda f: f.select("path", "length"), "*.bin")
    for i in range(3):
        (tmp_path / "in" / f"{i}.bin").write_bytes(b"x" * (i + 1))
    run()
    run()
    assert spark.read.parquet(target).count() == 3
    (tmp_path / "in" / "9.bin").write_bytes(b"new")
    run()
    assert spark.read.parquet(target).count() == 4


def test_new_rows_are_processed_once(spark, tmp_path):
    source, target, seen = (str(tmp_path / n) for n in ("in", "out", "seen"))
    for i in range(2):
        spark.range(5).write.mode("append").parquet(source)
        process_new_rows(spark, source, "id long", target, seen, lambda r: r.withColumn("twice", F.col("id") * 2))
        assert spark.read.parquet(target).count() == 5 * (i + 1)


def test_resume_does_failed_work_again(spark):
    wanted = spark.createDataFrame([(i,) for i in range(4)], "page int")
    finished = spark.createDataFrame([(1, "stored"), (3, "stored")], "page int, origin string")
    todo, stored = batch.resume(wanted, finished, ["page"])
    assert sorted(r.page for r in todo.collect()) == [0, 2] and stored.count() == 2


@pytest.mark.parametrize("count", [1, 3, 50])
def test_shards_are_round_robin(spark, count):
    names = [f"{x:03d}" for x in range(37)]
    got = {r.f: r.shard for r in batch.round_robin(spark.createDataFrame([(n,) for n in names], "f string"), "f", count).collect()}
    assert got == {n: i % count for i, n in enumerate(names)}
    with pytest.raises(ValueError):
        batch.round_robin(spark.range(1), "id", 0)


def test_rollup_marks_missing_workers_failed(spark):
    sums = spark.createDataFrame([("w0", 2, 1), ("w0", 3, 0), ("w2", 1, 1)], "worker string, pages long, tables long")
    exits = spark.createDataFrame([("w0", 0), ("w1", 1)], "worker string, exit_code int")
    got = {r.worker: (r.documents, r.pages, r.failed) for r in batch.batch_rollup(sums, exits).collect()}
    assert got == {"w0": (2, 5, False), "w1": (0, 0, True), "w2": (1, 1, True)}


def test_conflicting_outputs_are_refused(spark):
    with pytest.raises(Exception, match="conflicting output"):
        batch.unique_outputs(spark.createDataFrame([("a",), ("a",)], "output string")).collect()


def test_providers_fall_back_and_isolate(spark):
    class Upper:  # local, so that it travels to the workers by value
        schema = "id long, text string"

        def __call__(self, frame: pd.DataFrame) -> pd.DataFrame:
            if frame["text"].isna().any():
                raise ValueError("no text")
            return frame.assign(text=frame["text"].str.upper())

    class Keep(Upper):
        def __call__(self, frame):
            return frame

    rows = spark.createDataFrame([(1, "a"), (2, None)], "id long, text string").coalesce(1)
    both = {r.id: (r.text, r.event) for r in providers.apply(rows, lambda: providers.WithFallback(Upper(), Keep())).collect()}
    assert both[1][0] == "a" and "no text" in both[1][1]
    alone = {r.id: (r.text, r.error) for r in providers.apply(rows, providers.isolated(Upper, "id")).collect()}
    assert alone == {1: ("A", None), 2: (None, "no text")}


def test_models_behind_providers(spark):
    """Stand-ins for a recogniser with a spare, a detector, a structure model and a model that writes HTML."""
    from quire.operators import models

    box = "struct<x0:double,y0:double,x1:double,y1:double>"

    def provider(schema_, rows_of):
        class Stub:
            schema = schema_

            def __call__(self, frame):
                return pd.DataFrame([r for k in frame["page"] for r in rows_of(k)], columns=[c.split()[0] for c in schema_.split(", ")])

        return Stub

    def broken(frame):
        raise ValueError("no device")

    corner = lambda *b: dict(zip(("x0", "y0", "x1", "y1"), map(float, b), strict=True))
    pages = spark.createDataFrame([(1,), (2,)], "page long").coalesce(1)
    words = provider("page long, word string, confidence double", lambda k: [(k, f"w{k}", 0.9), (k, " ", 0.1)])
    read = models.recognised_words(pages, provider("page long, word string, confidence double", broken), words).collect()
    assert sorted((r.page, r.word) for r in read) == [(1, "w1"), (2, "w2")] and all("no device" in r.event for r in read)
    found = models.detections(pages, provider("page long, label string, score double", lambda k: [(k, "table", 0.29), (k, "table rotated", 0.3), (k, "figure", 0.9)]))
    assert sorted((r.page, r.label) for r in found.collect()) == [(1, "table rotated"), (2, "table rotated")]
    objects = lambda k: [(k, "table row", 0.9, corner(0, 10 * i, 20, 10 * i + 10)) for i in range(2)] + [(k, "table column", 0.9, corner(10 * i, 0, 10 * i + 10, 20)) for i in range(k)]
    cells = models.structures(pages, provider(f"page long, label string, score double, box {box}", objects), "page").groupBy("page").count()
    assert {r.page: r["count"] for r in cells.collect()} == {1: 2, 2: 4}
    html = models.tables_from_html(pages, provider("page long, html string", lambda k: [(k, "<table><tr><td>x</td></tr></table>")] if k == 1 else broken(k)), "page").collect()
    assert {r.page: (r.text, r.error) for r in html} == {1: ("x", None), 2: (None, "no device")}


def test_overlay_of_a_page(spark):
    own = content.page_overlay(F.lit(200), F.lit(100), F.expr("array(named_struct('x0', 1.0D, 'y0', 2.0D, 'x1', 11.0D, 'y1', 22.0D))"), F.lit(None).cast("array<struct<x0:double,y0:double,x1:double,y1:double>>"), F.lit("a&b.png"))
    got = spark.range(1).select(own.alias("s")).first().s
    assert 'viewBox="0 0 200 100"' in got and '<rect class="table" x="1.0" y="2.0" width="10.0" height="20.0"/>' in got and "a&amp;b.png" in got and 'class="cell"' not in got


def test_rounding(spark):
    from quire.functions.numbers import rounded

    values = [n / m for m in (3, 7, 32, 160, 800) for n in range(m)] + [None]
    got = [r.y for r in spark.createDataFrame([(v,) for v in values], "x double").select(rounded(F.col("x")).alias("y")).collect()]
    assert got == [None if v is None else round(v, 4) for v in values]


def test_unsupported_documents_are_refused(spark):
    with pytest.raises(Exception, match="unsupported document"):
        spark.range(1).select(content.structure_of(F.lit(False), F.lit(False))).collect()
    page = spark.range(1).select(content.review_page(F.lit("<a>"), F.lit("ok"), F.lit("<p>x</p>"), F.lit(None).cast("string")).alias("h")).first().h
    assert "&lt;a&gt;" in page and "<p>x</p>" in page
