"""Structured targets: table token streams (OTSL), Markdown tables, formulas. Arrow-batched, as they are no regular languages.

Each rule gives a code for what is wrong with a target, or none; models are plain dicts that match MODEL and CELLS.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

from scriptoria.dims import PROMPTS

# The tokens of the table language.
HEADS, LEFT, UP, BOTH, BREAK = ("<fcel>", "<ecel>"), "<lcel>", "<ucel>", "<xcel>", "<nl>"
_HTML_TABLE = re.compile(r"</?(?:table|thead|tbody|tfoot|tr|th|td)\b", re.IGNORECASE)
_TAG = re.compile(r"<[^<>\n]+>")
_TOKEN = re.compile(r"<(?:fcel|ecel|lcel|ucel|xcel|nl)>")
_RULE = re.compile(r"(:?)-{3,}(:?)")

CELL = T.StructType([*(T.StructField(n, T.IntegerType()) for n in ("row", "column", "rowspan", "colspan")), T.StructField("text", T.StringType())])
CELLS = T.ArrayType(CELL)
_STRINGS = T.ArrayType(T.StringType())
MARKDOWN = T.StructType([T.StructField("headers", _STRINGS), T.StructField("alignments", _STRINGS), T.StructField("rows", T.ArrayType(_STRINGS))])
INSPECTED = T.StructType([T.StructField("parses", T.BooleanType()), T.StructField("valid", T.BooleanType()), T.StructField("error", T.StringType()), T.StructField("model", T.StringType())])


class TargetError(ValueError):
    """A target that breaks a rule; its message is the rule's code."""


def _need(holds: object, code: str) -> None:
    if not holds:
        raise TargetError(code)


def otsl_cells(text: str) -> tuple[int, int, list[dict]]:
    """(rows, columns, cells) of a table target.

    Every token's owner is the head cell that it extends: a left token belongs to the owner on its left, an
    up token to the one above, a both token to either. The table is sound if each owner's tokens fill the box
    around them; as left tokens stand only in a head's row and up tokens only in its column, that is all.
    """
    _need(not _HTML_TABLE.search(text), "html_table")
    _need(all(_TOKEN.fullmatch(tag) for tag in _TAG.findall(text)), "unknown_tag")
    marks = list(_TOKEN.finditer(text))
    _need(marks, "no_cells")
    _need(marks[0].start() == 0, "text_before_cells")
    grid: list[list[tuple[str, str]]] = [[]]
    for mark, after in zip(marks, [*(m.start() for m in marks[1:]), len(text)], strict=True):
        inside = text[mark.end() : after]
        _need(mark[0] == "<fcel>" or not inside.strip(), "text_outside_cell")
        if mark[0] == BREAK:
            _need(grid[-1], "empty_row")
            grid.append([])
        else:
            grid[-1].append((mark[0], inside))
    _need(not grid.pop(), "open_row")
    _need(grid, "no_rows")
    width = len(grid[0])
    _need(all(len(row) == width for row in grid), "ragged_rows")
    owner: dict[tuple[int, int], tuple[int, int]] = {}
    boxes: dict[tuple[int, int], list[int]] = {}
    for r, row in enumerate(grid):
        for c, (token, _) in enumerate(row):
            left = row[c - 1][0] if c else ""
            above = grid[r - 1][c][0] if r else ""
            if token in HEADS:
                owner[r, c] = (r, c)
            elif token == LEFT:
                _need(left in (*HEADS, LEFT), "left_of_nothing")
                owner[r, c] = owner[r, c - 1]
            elif token == UP:
                _need(above in (*HEADS, UP), "up_of_nothing")
                owner[r, c] = owner[r - 1, c]
            else:
                _need(left in (UP, BOTH) and above in (LEFT, BOTH) and owner[r, c - 1] == owner[r - 1, c], "both_of_nothing")
                owner[r, c] = owner[r - 1, c]
            box = boxes.setdefault(owner[r, c], [r, c, 0])
            box[0], box[1], box[2] = max(box[0], r), max(box[1], c), box[2] + 1
    cells = []
    for (r, c), (bottom, right, n) in boxes.items():
        rowspan, colspan = bottom - r + 1, right - c + 1
        _need(n == rowspan * colspan, "broken_rectangle")
        cells.append({"row": r, "column": c, "rowspan": rowspan, "colspan": colspan, "text": grid[r][c][1]})
    return len(grid), width, cells


def check_otsl(text: str) -> tuple[int, int, list[dict]]:
    rows, columns, cells = otsl_cells(text)
    _need(any(cell["text"].strip() for cell in cells), "no_content")
    return rows, columns, cells


def build_otsl(cells: Iterable[dict]) -> str:
    """The canonical token stream of a cell model whose cells cover a rectangle once."""
    cells = sorted(cells, key=lambda x: (x["row"], x["column"]))
    _need(cells, "no_cells")
    height = max(x["row"] + x["rowspan"] for x in cells)
    width = max(x["column"] + x["colspan"] for x in cells)
    grid: dict[tuple[int, int], str] = {}
    for x in cells:
        _need(x["row"] >= 0 and x["column"] >= 0 and x["rowspan"] > 0 and x["colspan"] > 0, "bad_span")
        for i in range(x["rowspan"]):
            for j in range(x["colspan"]):
                at = x["row"] + i, x["column"] + j
                _need(at not in grid, "overlap")
                head = f"<fcel>{x['text']}" if x["text"] else "<ecel>"
                grid[at] = BOTH if i and j else UP if i else LEFT if j else head
    _need(len(grid) == height * width, "gap")
    return "".join("".join(grid[r, c] for c in range(width)) + BREAK for r in range(height))


def escape_html(text: str) -> str:
    for raw, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = text.replace(raw, name)
    return text


def cells_html(cells: Iterable[dict]) -> str:
    """The cell model as an HTML table."""
    rows: dict[int, list[str]] = {}
    for x in sorted(cells, key=lambda x: (x["row"], x["column"])):
        spans = "".join(f' {name}="{x[name]}"' for name in ("rowspan", "colspan") if x[name] > 1)
        rows.setdefault(x["row"], []).append(f"<td{spans}>{escape_html(x['text'])}</td>")
    return "<table>" + "".join(f"<tr>{''.join(tds)}</tr>" for _, tds in sorted(rows.items())) + "</table>"


_CELL_PART = re.compile(r"\\([|\\])|(\|)|([^\\|]+|\\)")


def markdown_row(line: str) -> list[str]:
    """The cells of a row; a backslash takes the meaning from a bar or a backslash."""
    line = line.strip()
    _need("|" in line, "no_bar")
    line = line.removeprefix("|")
    if line.endswith("|") and not line.endswith("\\|"):
        line = line[:-1]
    cells = [""]
    for escaped, bar, plain in _CELL_PART.findall(line):
        if bar:
            cells.append("")
        else:
            cells[-1] += escaped or plain
    return [x.strip() for x in cells]


def markdown_model(text: str) -> dict:
    """{headers, alignments, rows} of a Markdown table."""
    lines = text.split("\n")
    _need(all(line.strip() for line in lines), "blank_row")
    _need(len(lines) >= 3, "too_few_rows")
    rows = [markdown_row(line) for line in lines]
    _need(all(len(row) == len(rows[0]) for row in rows), "ragged_rows")
    rules = [_RULE.fullmatch(cell) for cell in rows[1]]
    _need(all(rules), "bad_separator")
    names = {("", ""): "none", (":", ""): "left", ("", ":"): "right", (":", ":"): "center"}
    return {"headers": rows[0], "alignments": [names[m.groups()] for m in rules], "rows": rows[2:]}


def check_markdown(text: str) -> dict:
    model = markdown_model(text)
    _need(any(cell for row in [model["headers"], *model["rows"]] for cell in row), "no_content")
    return model


def build_markdown(model: dict) -> str:
    """A Markdown table; markdown_model() gives the model back, but for outer spaces of cells."""
    width = len(model["headers"])
    _need(width and model["rows"] and len(model["alignments"]) == width and all(len(r) == width for r in model["rows"]), "ragged_rows")
    rules = {"none": "---", "left": ":---", "center": ":---:", "right": "---:"}
    line = lambda cells: "| " + " | ".join((x or "").replace("\\", "\\\\").replace("|", "\\|") for x in cells) + " |"
    return "\n".join([line(model["headers"]), "| " + " | ".join(rules.get(a, "---") for a in model["alignments"]) + " |", *map(line, model["rows"])])


def target_error(text: str | None, task: str | None) -> str | None:
    """The code of the first rule that a target of `task` breaks, null if it is sound."""
    if task not in PROMPTS:
        return "unknown_task"
    if not (text or "").strip():
        return "empty"
    try:
        if task == "table":
            check_otsl(text)
        elif task == "chart":
            check_markdown(text)
        elif task == "formula":
            _need(not _HTML_TABLE.search(text), "html_table")
    except TargetError as e:
        return str(e)
    return None


def inspect(text: str | None, task: str | None) -> dict:
    """{parses, valid, error, model}: the model as JSON where the target parses, even if it has no content yet."""
    text = re.sub(r"\r\n?", "\n", text or "")
    error, model = target_error(text, task), None
    try:
        if task == "table":
            rows, columns, cells = otsl_cells(text)
            model = {"rows": rows, "columns": columns, "cells": cells}
        elif task == "chart":
            model = markdown_model(text)
        elif task == "formula":
            _need(not _HTML_TABLE.search(text), "html_table")
            model = {"text": text}
        elif task == "ocr":
            model = {"lines": text.split("\n")}
    except TargetError:
        pass
    return {"parses": model is not None, "valid": error is None, "error": error, "model": None if model is None else json.dumps(model, ensure_ascii=False, sort_keys=True)}


#: What an editor starts from, by task.
STARTERS = {
    "ocr": {"lines": [""]},
    "formula": {"text": ""},
    "table": {"rows": 2, "columns": 2, "cells": [{"row": r, "column": c, "rowspan": 1, "colspan": 1, "text": ""} for r in (0, 1) for c in (0, 1)]},
    "chart": {"headers": ["1", "2"], "alignments": ["none", "none"], "rows": [["", ""]]},
}


# Editing of tables (cells) and charts (Markdown models). A step that does not apply gives the model unchanged.


def merge_cells(cells: list[dict], row: int, column: int, direction: str) -> list[dict]:
    """A cell joined with its neighbour of the same span on the right, or below; texts are joined by a line feed."""
    by_place = {(x["row"], x["column"]): x for x in cells}
    cell = by_place.get((row, column))
    if cell is None:
        return cells
    along, across = ("colspan", "rowspan") if direction == "right" else ("rowspan", "colspan")
    step = (0, cell["colspan"]) if direction == "right" else (cell["rowspan"], 0)
    other = by_place.get((row + step[0], column + step[1]))
    if other is None or other[across] != cell[across]:
        return cells
    joined = cell | {along: cell[along] + other[along], "text": "\n".join(t for t in (cell["text"], other["text"]) if t)}
    return [joined if x is cell else x for x in cells if x is not other]


def split_cell(cells: list[dict], row: int, column: int) -> list[dict]:
    """A cell of several places as single cells; its text stays at the top left."""
    out = []
    for x in cells:
        if (x["row"], x["column"]) != (row, column):
            out.append(x)
            continue
        places = [(i, j) for i in range(x["rowspan"]) for j in range(x["colspan"])]
        out += [{"row": row + i, "column": column + j, "rowspan": 1, "colspan": 1, "text": "" if i or j else x["text"]} for i, j in places]
    return out


def resize_table(cells: list[dict], edge: str, grow: bool) -> list[dict]:
    """One row or column ('row', 'column') more, of empty cells, or less, cutting spans; the last one stays."""
    place, span, other, other_span = ("row", "rowspan", "column", "colspan") if edge == "row" else ("column", "colspan", "row", "rowspan")
    size = max((x[place] + x[span] for x in cells), default=0)
    if grow:
        across = max((x[other] + x[other_span] for x in cells), default=0)
        return [*cells, *({place: size, other: i, "rowspan": 1, "colspan": 1, "text": ""} for i in range(across))]
    if size <= 1:
        return cells
    return [x | {span: min(x[span], size - 1 - x[place])} for x in cells if x[place] < size - 1]


def resize_chart(model: dict, edge: str, grow: bool) -> dict:
    """A chart with one row or column more or less; one of each stays."""
    headers, alignments, rows = model["headers"], model["alignments"], model["rows"]
    if edge == "row":
        rows = [*rows, [""] * len(headers)] if grow else rows[: max(1, len(rows) - 1)]
    elif grow:
        headers, alignments, rows = [*headers, ""], [*alignments, "none"], [[*r, ""] for r in rows]
    elif len(headers) > 1:
        headers, alignments, rows = headers[:-1], alignments[:-1], [r[:-1] for r in rows]
    return {"headers": headers, "alignments": alignments, "rows": rows}


def align_chart(model: dict, column: int, alignment: str) -> dict:
    """A chart with one column's alignment set: none, left, center or right."""
    if alignment not in ("none", "left", "center", "right"):
        raise ValueError(f"unknown alignment {alignment!r}")
    return model | {"alignments": [alignment if i == column else a for i, a in enumerate(model["alignments"])]}


# Column forms.


@F.pandas_udf(T.StringType())
def target_error_of(text: pd.Series, task: pd.Series) -> pd.Series:
    return pd.Series([target_error(t, k) for t, k in zip(text, task, strict=True)], dtype=object)


@F.pandas_udf(CELLS)
def otsl_cells_of(text: pd.Series) -> pd.Series:
    def cells(t: str | None) -> list[dict] | None:
        try:
            return None if t is None else otsl_cells(t)[2]
        except TargetError:
            return None

    return pd.Series([cells(t) for t in text], dtype=object)


@F.pandas_udf(T.StringType())
def build_otsl_of(cells: pd.Series) -> pd.Series:
    def built(x: object) -> str | None:
        try:
            return None if x is None else build_otsl([dict(c) for c in x])
        except TargetError:
            return None

    return pd.Series([built(x) for x in cells], dtype=object)


@F.pandas_udf(T.StringType())
def cells_html_of(cells: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else cells_html([dict(c) for c in x]) for x in cells], dtype=object)


@F.pandas_udf(CELLS)
def merged_cells_of(cells: pd.Series, row: pd.Series, column: pd.Series, direction: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else merge_cells([dict(c) for c in x], r, k, d) for x, r, k, d in zip(cells, row, column, direction, strict=True)], dtype=object)


@F.pandas_udf(CELLS)
def split_cells_of(cells: pd.Series, row: pd.Series, column: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else split_cell([dict(c) for c in x], r, k) for x, r, k in zip(cells, row, column, strict=True)], dtype=object)


@F.pandas_udf(CELLS)
def resized_cells_of(cells: pd.Series, edge: pd.Series, grow: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else resize_table([dict(c) for c in x], e, g) for x, e, g in zip(cells, edge, grow, strict=True)], dtype=object)


def _charts(models: pd.DataFrame, step: Callable[[dict, int], dict]) -> pd.DataFrame:
    """A step on each chart; rows without one stay without."""
    out = []
    for i, (headers, alignments, rows) in enumerate(zip(models["headers"], models["alignments"], models["rows"], strict=True)):
        known = headers is not None
        out.append(step({"headers": list(headers), "alignments": list(alignments), "rows": [list(r) for r in rows]}, i) if known else {})
    return pd.DataFrame({k: [m.get(k) for m in out] for k in ("headers", "alignments", "rows")})


@F.pandas_udf(MARKDOWN)
def resized_chart_of(models: pd.DataFrame, edge: pd.Series, grow: pd.Series) -> pd.DataFrame:
    return _charts(models, lambda m, i: resize_chart(m, edge[i], grow[i]))


@F.pandas_udf(MARKDOWN)
def aligned_chart_of(models: pd.DataFrame, column: pd.Series, alignment: pd.Series) -> pd.DataFrame:
    return _charts(models, lambda m, i: align_chart(m, column[i], alignment[i]))


@F.pandas_udf(MARKDOWN)
def markdown_of(text: pd.Series) -> pd.DataFrame:
    def model(t: str | None) -> dict:
        try:
            return markdown_model(t) if t is not None else {}
        except TargetError:
            return {}

    found = [model(t) for t in text]
    return pd.DataFrame({k: [m.get(k) for m in found] for k in ("headers", "alignments", "rows")})


@F.pandas_udf(INSPECTED)
def inspect_of(text: pd.Series, task: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([inspect(t, k) for t, k in zip(text, task, strict=True)], columns=["parses", "valid", "error", "model"])


@udtf(returnType=CELL)
class OtslTable:
    """SQL table function: the cells of a table target; no rows if it does not parse."""

    def eval(self, text: str) -> Iterable[tuple]:
        try:
            for x in otsl_cells(text)[2]:
                yield x["row"], x["column"], x["rowspan"], x["colspan"], x["text"]
        except TargetError:
            return


def record_error(image_info: Column, text_info: Column, prompts: tuple[str, ...]) -> Column:
    """What is wrong with the shape of a training record (arrays of structs), null if nothing; the target is checked by target_error_of()."""
    from scriptoria.functions.text import task_of_prompt

    image, prompt, target = image_info[0], text_info[0], text_info[1]
    masks = (image["matched_text_index"] == 0) & (prompt["tag"] == "mask") & prompt["text"].isin(*prompts) & (target["tag"] == "no_mask") & (target["text"] != "")
    return (
        F.when(image_info.isNull() | (F.size(image_info) != 1), "image_info")
        .when(text_info.isNull() | (F.size(text_info) != 2), "text_info")
        .when(~F.coalesce(masks, F.lit(False)) | task_of_prompt(prompt["text"]).isNull(), "task_mask")
        .when(F.coalesce(image["image_url"], F.lit("")) == "", "image_url")
    )
