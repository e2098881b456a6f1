"""The queries over the driver's tables, gathered from the modules of `scriptoria.plans`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name, with the SQL that gives the same rows, if there is one."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add
