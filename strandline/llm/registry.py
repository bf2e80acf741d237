"""Names, functions and SQL of the queries of this subpackage."""

from __future__ import annotations

ENTRIES: dict = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with DuckDB SQL for the same rows where there is any."""

    def add(fn):
        ENTRIES[fn.__name__] = (fn, sql)
        return fn

    return add


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
