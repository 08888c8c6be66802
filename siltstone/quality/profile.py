"""Full-table null profiles, their comparison, and field coverage of event classes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.fields import quoted
from siltstone.operators.ingest import LINEAGE_ID
from siltstone.plans.ocsf import REQUIRED_IN_ROWS, class_schema

# Outcomes of the checks.
OK = "ok"
MISSING = "missing from target"
NEW = "new in target"
HIGH_IN_TARGET = "high null rate in target"
INCREASED = "null rate increased in target"
REQUIRED_EMPTY = "required field empty"
EMPTY = "completely empty"
HIGH = "high null rate"

INCREASE_POINTS = 20.0


def leaf_paths(schema: T.StructType, prefix: str = "") -> dict[str, T.DataType]:
    """Dotted paths of all members that are not structs."""
    leaves: dict[str, T.DataType] = {}
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            leaves.update(leaf_paths(f.dataType, f"{prefix}{f.name}."))
        else:
            leaves[f"{prefix}{f.name}"] = f.dataType
    return leaves


def _path(path: str) -> Column:
    return reduce(lambda column, name: column.getField(name), path.split(".")[1:], quoted(path.split(".")[0]))


def null_profile(df: DataFrame, flatten: bool = False, sample_rows: int = 0) -> DataFrame:
    """Rows, nulls and null percentage of every column, in one pass over the table.

    One aggregate counts all columns at once, and its single result row is unpivoted.
    ``flatten`` profiles struct members; ``sample_rows`` limits the rows looked at.  An
    empty table has an empty profile.
    """
    paths = {p: _path(p) for p in leaf_paths(df.schema)} if flatten else {c: quoted(c) for c in df.columns}
    if sample_rows:
        df = df.limit(sample_rows)
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count(F.when(column.isNotNull(), 1)).alias(f"c{i}") for i, column in enumerate(paths.values())),
    )
    entries = F.array(
        *(F.struct(F.lit(p).alias("column"), F.col(f"c{i}").alias("present")) for i, p in enumerate(paths))
    )
    nulls = F.col("rows") - F.col("entry.present")
    return (
        counted.filter("rows > 0")
        .select("rows", F.explode(entries).alias("entry"))
        .select(
            F.col("entry.column").alias("column"),
            F.col("rows"),
            nulls.alias("null_count"),
            F.round(nulls * 100 / F.col("rows"), 1).alias("null_pct"),
        )
    )


def always_null(df: DataFrame, flatten: bool = False) -> DataFrame:
    """Columns without a single value: most likely a broken mapping."""
    profile = null_profile(df, flatten)
    return profile.filter((F.col("null_count") == F.col("rows")) & (F.col("column") != LINEAGE_ID)).select("column")


def compare_profiles(
    source: DataFrame, target: DataFrame, threshold: float = 80.0, ignore_case: bool = False, sample_rows: int = 0
) -> DataFrame:
    """Null rates of two tables side by side, with a status per column."""

    def rates(df: DataFrame, out: str) -> DataFrame:
        name = F.lower("column") if ignore_case else F.col("column")
        return null_profile(df, sample_rows=sample_rows).select(
            name.alias("column"), F.col("null_pct").alias(out)
        )

    before, after = F.col("null_pct_source"), F.col("null_pct_target")
    status = (
        F.when(after.isNull(), MISSING)
        .when(before.isNull(), NEW)
        .when(after >= threshold, HIGH_IN_TARGET)
        .when(after > before + INCREASE_POINTS, INCREASED)
        .otherwise(OK)
    )
    joined = rates(source, "null_pct_source").join(rates(target, "null_pct_target"), "column", "full")
    return joined.withColumn("status", status)


def class_coverage(
    df: DataFrame, threshold: float = 80.0, required: Iterable[str] = REQUIRED_IN_ROWS, sample_rows: int = 0
) -> DataFrame:
    """Population of every column of a mapped table, required ones marked."""
    needed = F.col("column").isin(*required)
    status = (
        F.when((F.col("null_pct") == 100) & needed, REQUIRED_EMPTY)
        .when(F.col("null_pct") == 100, EMPTY)
        .when(F.col("null_pct") >= threshold, HIGH)
        .otherwise(OK)
    )
    return null_profile(df, sample_rows=sample_rows).select(
        "*", F.when(needed, "yes").otherwise("").alias("required"), status.alias("status")
    )


def mapping_coverage(mapped: DataFrame, event_class: str) -> DataFrame:
    """Class columns with how far a mapping fills them.

    ``mapped`` is the mapping's own result, before it is conformed.  A column counts as
    mapped when any of its members is; ``filled_pct`` is the share of rows in which the
    column, or one of its mapped members, has a value.
    """
    schema = class_schema(event_class)
    members: dict[str, list[Column]] = {}
    for path in leaf_paths(mapped.schema):
        members.setdefault(path.split(".")[0], []).append(_path(path))
    filled = {
        name: reduce(Column.__or__, (column.isNotNull() for column in columns)) for name, columns in members.items()
    }
    counted = mapped.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count(F.when(filled[n], 1)).alias(f"c{i}") for i, n in enumerate(schema.names) if n in filled),
    )
    entries = F.array(
        *(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(name in filled).alias("mapped"),
                (F.col(f"c{i}") if name in filled else F.lit(0).cast("bigint")).alias("filled"),
            )
            for i, name in enumerate(schema.names)
        )
    )
    return counted.select("rows", F.explode(entries).alias("entry")).select(
        "entry.column",
        "entry.mapped",
        "rows",
        F.when(F.col("rows") > 0, F.round(F.col("entry.filled") * 100 / F.col("rows"), 1)).alias("filled_pct"),
    )


def problem_rows(mapped: DataFrame, problems: Mapping[str, list[str]]) -> DataFrame:
    """Per problem of a mapping (``mapping_problems``), all rows and those in which the column has a value."""
    found = [(problem, column) for problem, columns in problems.items() for column in columns]
    counts = mapped.agg(
        F.count(F.lit(1)).alias("rows"),
        *(
            (F.count(quoted(column)) if column in mapped.columns else F.lit(0).cast("bigint")).alias(f"c{i}")
            for i, (_, column) in enumerate(found)
        ),
    )
    entries = [
        F.struct(F.lit(problem).alias("problem"), F.lit(column).alias("column"), F.col("rows"), F.col(f"c{i}").alias("filled"))
        for i, (problem, column) in enumerate(found)
    ]
    kind = "array<struct<problem:string,column:string,rows:bigint,filled:bigint>>"
    return counts.select(F.inline(F.array(*entries).cast(kind)))


def issue_counts(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Per check, the number of rows whose status is not ok."""
    counts = [
        check.agg(F.count_if(F.col("status") != OK).alias("issues")).select(F.lit(name).alias("check"), "issues")
        for name, check in checks.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def by_status(result: DataFrame) -> DataFrame:
    """A check's result in reading order: by status, descending, then by column."""
    return result.orderBy(F.col("status").desc(), "column")
