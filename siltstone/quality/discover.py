"""What an unknown source holds: sample rows, inferred schema, key population."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.fields import as_column
from siltstone.plans.spec import Expression


def rows_as_json(df: DataFrame, rows: int | None = None, where: Expression | None = None) -> DataFrame:
    """Rows as one JSON text each, filtered and limited on demand."""
    if where is not None:
        df = df.filter(as_column(where))
    df = df.select(F.to_json(F.struct("*")).alias("row"))
    return df if rows is None else df.limit(rows)


def read_records(spark: SparkSession, path: str, source: str = "json", **options: str) -> DataFrame:
    """All records under a path as variants, with the file each came from."""
    reader = spark.read.format(source).options(**options).option("singleVariantColumn", "data")
    return reader.load(path).select("data", F.col("_metadata.file_path").alias("file"))


def schema_by_file(records: DataFrame) -> DataFrame:
    """Rows and the merged record schema of every file.

    The schema is merged partially in each task, so one large file does not collect in
    one place.
    """
    return records.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.schema_of_variant_agg("data").alias("record_schema")
    )


def merged_schema(records: DataFrame, data: Column | str = "data") -> DataFrame:
    return records.agg(
        F.count(F.lit(1)).alias("rows"), F.schema_of_variant_agg(data).alias("record_schema")
    )


def key_population(records: DataFrame, data: str = "data") -> DataFrame:
    """Per top-level key of the records: how many hold it, and how many hold a value.

    Keys are counted in each task before the shuffle; the number of groups is the number
    of distinct keys.
    """
    members = records.sparkSession.tvf.variant_explode(F.col(data).outer())
    keys = records.select(data).lateralJoin(members.select("key", "value"))
    return keys.groupBy("key").agg(
        F.count(F.lit(1)).alias("present"),
        F.count_if(~F.is_variant_null("value")).alias("filled"),
    )
