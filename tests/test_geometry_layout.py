from pyspark.sql import functions as F

from quire.functions import geometry as g
from quire.operators import layout, textlayer

WORD = "page int, word string, block int, line int, box struct<x0:double,y0:double,x1:double,y1:double>"
WORDS = [(1, "Seven ferries cross the sound before noon on weekdays", 0, 0, (0.0, 0.0, 100.0, 10.0)), (1, "cell", 1, 0, (0.0, 20.0, 20.0, 30.0)), (1, "value", 1, 0, (30.0, 20.0, 50.0, 30.0))]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def boxes(*values):
    return [g.box(*map(F.lit, v)) for v in values]


def test_reliable_layer_and_excluded_table(spark):
    words = spark.createDataFrame(WORDS, WORD)
    q = one(spark, textlayer.quality(F.array(*[F.lit(w[1]) for w in WORDS])))
    assert q.reliable and q.words == 3
    regions = spark.createDataFrame([(1, (0.0, 15.0, 60.0, 35.0))], "page int, region struct<x0:double,y0:double,x1:double,y1:double>")
    lines = layout.text_lines(layout.words_outside(words, regions, ["page"]), ["page"], ["block", "line"]).collect()
    assert [r.text for r in lines] == ["Seven ferries cross the sound before noon on weekdays"]
    assert lines[0].block_id == "text-0001"


def test_layer_gate_branches(spark):
    q = lambda *w: one(spark, textlayer.quality(F.array(*[F.lit(x) for x in w])))
    assert not q("short", "a", "b").reliable
    assert not q("abcdefghij" * 3).reliable  # one word
    assert not q("�" * 10, "abcdefghijkl", "x").reliable
    assert not q("....................", "....", "..").reliable
    assert not q("​" * 5, "abcdefghijklmnopqrst", "x").reliable
    assert q("abcdefghijklmnopqrst", "　", "b", "c").words == 3


def test_ocr_lines_follow_a_running_mean(spark):
    rows = [(1, i, (0.0, y, 5.0, y + 2)) for i, y in enumerate([0.0, 3.0, 6.0, 9.0, 30.0])]
    words = spark.createDataFrame(rows, "page int, id long, box struct<x0:double,y0:double,x1:double,y1:double>")
    got = {r.word: r.line for r in layout.cluster_lines(words, ["page"], "id").collect()}
    last, line, want = None, 0, {}
    for i, y in enumerate([1.0, 4.0, 7.0, 10.0, 31.0]):
        line += last is not None and abs(y - last) > 4
        want[i] = line
        last = y if last is None else (last + y) / 2
    assert got == want


def test_overlap_measures(spark):
    a, b, half = boxes((0.0, 0.0, 10.0, 10.0), (20.0, 20.0, 30.0, 30.0), (0.0, 0.0, 10.0, 5.0))
    assert one(spark, g.iou(a, a)) == 1.0
    assert one(spark, g.iou(a, b)) == 0.0
    assert one(spark, g.iou(a, half)) == one(spark, g.iou(half, a)) == 0.5
    assert one(spark, g.overlap_min(a, half)) == 1.0
    missing = F.lit(None).cast(g.BOX)
    assert one(spark, g.area(missing)) == 0.0 and one(spark, g.iou(missing, a)) == 0.0
    assert one(spark, g.center_in(missing, a)) is False


def test_rotation_is_undone(spark):
    (a,) = boxes((1.0, 2.0, 3.0, 5.0))
    back = one(spark, g.unrotate_ccw(g.rotate_ccw(a, F.lit(50.0)), F.lit(50.0)))
    assert tuple(back) == (1.0, 2.0, 3.0, 5.0)


def test_empty_crop_is_null(spark):
    size = F.struct(F.lit(100.0).alias("width"), F.lit(100.0).alias("height"))
    (off, inside) = boxes((200.0, 200.0, 210.0, 210.0), (10.5, 20.0, 30.0, 40.0))
    assert one(spark, g.pixel_crop(off, size, size)) is None
    assert tuple(one(spark, g.pixel_crop(inside, size, size))) == (0, 10, 40, 50)


def test_shared_edge_puts_a_word_in_both(spark):
    words = spark.createDataFrame([(1, "w", 0, 0, (8.0, 0.0, 12.0, 2.0))], WORD)
    two = spark.createDataFrame([(1, 0, (0.0, 0.0, 10.0, 5.0)), (1, 1, (10.0, 0.0, 20.0, 5.0))], "page int, cell int, region struct<x0:double,y0:double,x1:double,y1:double>")
    assert layout.words_in(words, two, ["page"]).count() == 2
