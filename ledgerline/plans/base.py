"""Registration of queries with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import columns as C

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r(x: Column | str, digits: int = 6) -> Column:
    return F.round(C.col(x), digits)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[r(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
