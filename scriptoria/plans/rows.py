"""Reading the driver's tables, and pieces that several queries and their SQL share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ALPHABET = "".join(chr(c) for c in range(33, 127)) + "".join(chr(c) for c in range(0xC0, 0x100))
#: The same as a class of RE2, with the space.
ALPHABET_CLASS = r"[\x20-\x7e\x{c0}-\x{ff}]"
#: What strip() takes off, for RE2.
SPACE_CLASS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE_CLASS}+|{SPACE_CLASS}+$', '', 'g')"
