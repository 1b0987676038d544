"""Named queries over a folder of Parquet tables, each with the SQL that checks it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its check in DuckDB SQL if there is one."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if check is not None:
            CHECKS[function.__name__] = check
        return function

    return add
