"""Session settings that suit the engine; any session will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[*]", shuffle_partitions: int = 8, **more: str) -> SparkSession:
    """A session with adaptive execution, Arrow transfer and UTC; `more` are further settings (dots as underscores)."""
    builder = SparkSession.builder.master(master).config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    fixed = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    for key, value in fixed.items() | {(k.replace("_", "."), v) for k, v in more.items()}:
        builder = builder.config(key, value)
    return builder.getOrCreate()
