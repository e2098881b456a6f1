import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptoria.functions import distance
from scriptoria.functions import geometry as g
from scriptoria.functions import grammar as gr
from scriptoria.functions import text as t


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "expected"), [("\x1c a ", "a"), ("é\r\nb\t", "é b"), ("  ", ""), ("a\n", "a")])
def test_recognition_text(spark, raw, expected):
    assert one(spark, t.recognition_text(F.lit(None).cast("string"), F.lit(raw))) == expected


def test_target_text_keeps_outer_spaces(spark):
    assert one(spark, t.target_text(F.lit(" "), F.lit(" a\r\nb\r "))) == " a\nb\n "


def test_control_characters(spark):
    assert one(spark, t.has_control(F.lit("a\nb"))) and not one(spark, t.has_control(F.lit("a\nb"), True)) and one(spark, t.has_control(F.lit("a\tb"), True))


def test_unsupported(spark):
    assert one(spark, t.unsupported(F.lit("aΩb中Ω"), "ab")) == ["Ω", "中"]


def test_resize_golden(spark):
    size = one(spark, g.smart_resize(F.lit(100), F.lit(200), 50176, 451584))
    assert (size["height"], size["width"]) == (168, 336)
    assert one(spark, g.visual_tokens(F.lit(100), F.lit(200))) == 72
    assert one(spark, g.visual_tokens(F.lit(10), F.lit(9000))) is None


def test_area_and_crossing(spark):
    quad = F.lit([[0.0, 0.0], [10.0, 10.0], [10.0, 0.0], [0.0, 10.0]])
    assert one(spark, g.self_crossing(quad))
    assert one(spark, g.area(F.lit([[0.0, 0.0], [4.0, 0.0], [4.0, 3.0]]))) == 6.0
    assert one(spark, g.area(F.lit([[0.0, 0.0], [4.0, 0.0]]))) == 0.0


def test_crop_box_has_a_pixel(spark):
    assert one(spark, g.crop_box(F.lit([5.2, 5.0, 5.2, 5.0]), F.lit(10), F.lit(10))) == [5, 5, 6, 6]


@pytest.mark.parametrize("text, task, error", [
    ("<fcel>a<lcel><nl><ucel><xcel><nl>", "table", None),
    ("<fcel>a<lcel><nl><ucel><ecel><nl>", "table", "broken_rectangle"),
    ("<fcel>a<nl><fcel>b<ecel><nl>", "table", "ragged_rows"),
    ("<ecel><nl>", "table", "no_content"),
    ("<fcel>a<fcel>b", "table", "open_row"),
    ("x<fcel>a<nl>", "table", "text_before_cells"),
    ("<table></table>", "table", "html_table"),
    ("<fcel>a<xcel><nl>", "table", "both_of_nothing"),
    ("<fcel>a<nl> \n", "table", None),
    ("| a \\| b |\n|---|\n| c |", "chart", None),
    ("a|b\n---|---\nc|d\n", "chart", "blank_row"),
    ("| a |\n|--|\n| c |", "chart", "bad_separator"),
    ("<td>", "formula", "html_table"),
    (" ", "ocr", "empty"),
    ("a", "other", "unknown_task"),
])
def test_target_errors(text, task, error):
    assert gr.target_error(text, task) == error


@st.composite
def tables(draw):
    height, width = draw(st.integers(1, 4)), draw(st.integers(1, 4))
    free = {(r, c) for r in range(height) for c in range(width)}
    cells = []
    while free:
        r, c = min(free)
        wide = 1
        while (r, c + wide) in free and draw(st.booleans()):
            wide += 1
        high = 1
        while all((r + high, c + j) in free for j in range(wide)) and draw(st.booleans()):
            high += 1
        free -= {(r + i, c + j) for i in range(high) for j in range(wide)}
        cells.append({"row": r, "column": c, "rowspan": high, "colspan": wide, "text": draw(st.text("ab |\\", max_size=3)).strip()})
    return cells


@settings(max_examples=100, deadline=None)
@given(tables())
def test_otsl_round_trip(cells):
    built = gr.build_otsl(cells)
    assert gr.otsl_cells(built)[2] == sorted(cells, key=lambda x: (x["row"], x["column"]))
    split = cells
    for x in cells:
        split = gr.split_cell(split, x["row"], x["column"])
    assert all(x["rowspan"] == x["colspan"] == 1 for x in split)
    gr.build_otsl(split)
    for edge in ("row", "column"):
        gr.build_otsl(gr.resize_table(cells, edge, True))
        gr.build_otsl(gr.resize_table(cells, edge, False))


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 3).flatmap(lambda w: st.lists(st.lists(st.text("a|\\ b", max_size=4).map(str.strip), min_size=w, max_size=w), min_size=2, max_size=4)))
def test_markdown_round_trip(rows):
    model = {"headers": rows[0], "alignments": ["left"] * len(rows[0]), "rows": rows[1:]}
    assert gr.markdown_model(gr.build_markdown(model)) == model


def test_merge_and_chart_edits():
    cells = gr.otsl_cells("<fcel>a<fcel>b<nl><fcel>c<fcel>d<nl>")[2]
    right = gr.merge_cells(cells, 0, 0, "right")
    assert gr.build_otsl(right) == "<fcel>a\nb<lcel><nl><fcel>c<fcel>d<nl>"
    assert gr.merge_cells(right, 0, 0, "below") == right
    chart = gr.STARTERS["chart"]
    assert gr.resize_chart(gr.resize_chart(chart, "column", True), "column", False) == chart
    assert gr.resize_chart(chart, "row", False) == chart


def test_inspect_and_table_function(spark):
    assert gr.inspect("<ecel><nl>", "table")["parses"] and not gr.inspect("<ecel><nl>", "table")["valid"]
    spark.udtf.register("otsl_table", gr.OtslTable)
    assert spark.sql("select row, column, text from otsl_table('<fcel>a<ecel><nl>') order by column").collect() == [(0, 0, "a"), (0, 1, "")]


def test_token_limits_and_log(spark):
    assert t.token_limits("ocr=5, chart=7") == {"ocr": 5, "chart": 7}
    for bad in ("ocr=0", "x=1", "ocr=1,ocr=2"):
        with pytest.raises(ValueError):
            t.token_limits(bad)
    assert one(spark, t.log_counts(F.lit("total: 1.00e+09 x"), "total")) == 1_000_000_000


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(now[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.text("ab\U0001d522\u00e9", max_size=40), st.text("ab\U0001d522\u00e9", max_size=40), st.sampled_from([1, 2, 7, 64]), st.sampled_from([1, 5, 2048]))
def test_long_distance_against_the_table(a, b, band, columns):
    """Bands that must grow and masks made for few columns give what the whole table gives, on far texts and on close ones."""
    old = distance.BAND, distance.COLUMNS
    distance.BAND, distance.COLUMNS = band, columns
    try:
        for x, y in ((a, b), (a + b, b + a), (a + b + a, a + a)):
            assert distance.edit_distance(x, y) == plain_distance(x, y)
    finally:
        distance.BAND, distance.COLUMNS = old


def test_distances_of_long_and_short_texts(spark):
    """Both ways, on either side of the bound, are Spark's levenshtein; a long text is told in far less than the product of the lengths."""
    base = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(1500))
    pairs = [("kitten", "sitting"), (None, "x"), ("x", None), ("", ""), ("", base), (base, base), (base, base[::-1]), (base, base[100:] + "\U0001d522"), ("\U0001d522" * 900, "e" * 900)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select(distance.edits(F.col("a"), F.col("b")).alias("x"), F.levenshtein("a", "b").cast("long").alias("y")).collect()
    assert [r["x"] for r in got] == [r["y"] for r in got] and got[0]["x"] == 3
    began = time.thread_time()
    long = base * 100
    assert distance.edit_distance(long, long[:70_000] + "\u00e9" + long[70_010:]) == 10
    assert time.thread_time() - began < 3


def test_edit_distance_where_bounds_meet(monkeypatch):
    """Pieces left out or put in, and letters replaced one for one, are told without a table of the two texts."""
    text = " ".join("the other breathes with them %d" % i for i in range(5000))

    def none(*_):
        raise AssertionError("a band was made")

    monkeypatch.setattr(distance, "banded", none)
    assert distance.edit_distance(text, text.replace("th", "")) == 2 * text.count("th")
    assert distance.edit_distance("ß" + text.replace(" ", "  "), text) == 1 + text.count(" ")
    assert distance.edit_distance(text, text.replace("e", "\U0001d522")) == text.count("e")
    monkeypatch.undo()
    rng = random.Random(31)
    for _ in range(600):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 9))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [last := i, *(last := min(row[j] + 1, last + 1, row[j - 1] + (x != b[j - 1])) for j in range(1, len(b) + 1))]
        assert distance.edit_distance(a, b) == row[-1]
