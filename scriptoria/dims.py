"""Fixed dimensions: tasks with their prompts, layout labels, and what task a label has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Task -> prompt.
PROMPTS = {"ocr": "OCR:", "table": "Table Recognition:", "formula": "Formula Recognition:", "chart": "Chart Recognition:"}
# Layout labels in the order of their ids, from 1.
LABELS = (
    "abstract", "algorithm", "aside_text", "chart", "content", "display_formula", "doc_title", "figure_title", "footer", "footer_image",
    "footnote", "formula_number", "header", "header_image", "image", "inline_formula", "number", "paragraph_title", "reference",
    "reference_content", "seal", "table", "text", "vertical_text", "vision_footnote",
)
# Label -> task; labels that are not listed have none.
LABEL_TASK = {
    "abstract": "ocr",
    "aside_text": "ocr",
    "chart": "chart",
    "content": "ocr",
    "display_formula": "formula",
    "doc_title": "ocr",
    "footer": "ocr",
    "footnote": "ocr",
    "header": "ocr",
    "inline_formula": "formula",
    "paragraph_title": "ocr",
    "reference": "ocr",
    "reference_content": "ocr",
    "table": "table",
    "text": "ocr",
    "vertical_text": "ocr",
}


def lookup(values: dict[str, str], key: Column) -> Column:
    """The value of `key`, null if there is none: a literal map, folded into the plan."""
    return F.element_at(F.create_map(*(F.lit(x) for pair in values.items() for x in pair)), key)


def label_table(spark: SparkSession) -> DataFrame:
    """(label_id, label, task) of the layout taxonomy."""
    rows = [(i, label, LABEL_TASK.get(label)) for i, label in enumerate(LABELS, 1)]
    return spark.createDataFrame(rows, "label_id int, label string, task string")
