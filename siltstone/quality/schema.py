"""Column-by-column comparison of two schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.quality.profile import MISSING, NEW, leaf_paths, null_profile

MATCH = "match"
MISMATCH = "type mismatch"


def _frame(spark: SparkSession, schema: T.StructType, out: str, flatten: bool, ignore_case: bool) -> DataFrame:
    columns = leaf_paths(schema) if flatten else {f.name: f.dataType for f in schema.fields}
    rows = {(name.lower() if ignore_case else name): kind.simpleString() for name, kind in columns.items()}
    return spark.createDataFrame(list(rows.items()), f"column string, {out} string")


def filled_diff(
    source: DataFrame, target: DataFrame, flatten: bool = False, ignore_case: bool = False
) -> DataFrame:
    """The schema comparison with the number of filled rows of every column on either side.

    Each table is read once, in a partially aggregated count of all its columns.
    """

    def filled(df: DataFrame, out: str) -> DataFrame:
        name = F.lower("column") if ignore_case else F.col("column")
        return null_profile(df, flatten).select(name.alias("column"), (F.col("rows") - F.col("null_count")).alias(out))

    return (
        schema_diff(source, target, flatten, ignore_case)
        .join(filled(source, "filled_source"), "column", "left")
        .join(filled(target, "filled_target"), "column", "left")
    )


def schema_diff(
    source: DataFrame, target: DataFrame, flatten: bool = False, ignore_case: bool = False
) -> DataFrame:
    """Per column: its type on either side and match, type mismatch, missing or new.

    Only the two schemas are looked at, so the size of the tables does not matter.
    """
    spark = source.sparkSession
    before, after = F.col("type_source"), F.col("type_target")
    status = (
        F.when(after.isNull(), MISSING)
        .when(before.isNull(), NEW)
        .when(before == after, MATCH)
        .otherwise(MISMATCH)
    )
    return (
        _frame(spark, source.schema, "type_source", flatten, ignore_case)
        .join(_frame(spark, target.schema, "type_target", flatten, ignore_case), "column", "full")
        .withColumn("status", status)
    )
