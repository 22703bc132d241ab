"""Checked queries: a Spark callable and, where SQL can say the same, its text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, rounded: str = "", digits: int = 8) -> Callable[[Query], Query]:
    """Registers a query. The ``rounded`` columns are rounded on both sides, so that the
    order in which doubles are added does not show."""
    columns = rounded.split()

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = build(spark, folder)
            plain = {c: F.col(c).cast("int") for c, t in df.dtypes if t == "tinyint"}
            return df.withColumns({**plain, **{c: F.round(F.col(c), digits) for c in columns}})

        QUERIES[name] = run
        if sql is not None:
            text = sql.strip()
            if columns:
                fixed = ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)
                text = f"SELECT * REPLACE ({fixed}) FROM (\n{text}\n) AS answer"
            ORACLES[name] = text
        return build

    return register
