"""Registry of queries and small helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.plans.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL that must give the same rows."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def instant(column: str | Column) -> Column:
    """A zone-less timestamp read as UTC, whatever zone the session has."""
    return F.col(column).cast("timestamp") if isinstance(column, str) else column.cast("timestamp")


def pairs(array: str) -> Column:
    """Observables or enrichments as ``name=value;...`` text."""
    return F.array_join(F.transform(array, lambda x: F.concat(x["name"], F.lit("="), x["value"])), ";")


def flat(df: DataFrame, paths: str, **more: Column) -> DataFrame:
    """Struct members as top-level columns: ``a.b`` becomes ``a_b``."""
    return df.select(*(F.col(p).alias(p.replace(".", "_")) for p in paths.split()), *(c.alias(n) for n, c in more.items()))
