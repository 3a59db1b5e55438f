"""Named queries over the star-schema tables and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def rounded(column: Column | str, places: int = 4) -> Column:
    """Rounded away from exact halves, which engines round differently."""
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value.cast("double") + 1e-7, places)


def stamp(column: str) -> Column:
    """A timestamp as text, free of time zone types."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def joined(column: str) -> Column:
    """An array of strings as one text."""
    return F.concat_ws("|", F.col(column))
