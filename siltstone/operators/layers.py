"""The parse (silver) and map (gold) steps as frame-to-frame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.fields import as_column, output_columns, quoted, select_fields
from siltstone.operators.ingest import LINEAGE_ID
from siltstone.operators.lookups import apply_lookups
from siltstone.plans.spec import GoldSpec, SilverSpec, SpecError

EXPLODED = "_exploded"


def to_silver(df: DataFrame, spec: SilverSpec) -> DataFrame:
    """Lookups, filter, temporary fields, field list, filter over the result."""
    df = apply_lookups(df, spec.lookups)
    if spec.filter is not None:
        df = df.filter(as_column(spec.filter))
    inputs = df.columns
    if spec.temporary:
        df = df.select("*", *output_columns(spec.temporary))
    keep = [name for name in inputs if name not in spec.omit] if spec.preserve else []
    if LINEAGE_ID in inputs and LINEAGE_ID not in keep:
        keep.append(LINEAGE_ID)
    df = select_fields(df, spec.fields, keep)
    return df if spec.post_filter is None else df.filter(as_column(spec.post_filter))


def to_gold(df: DataFrame, spec: GoldSpec) -> DataFrame:
    """Filter, optional explode, temporary fields, field list, filter over the result."""
    if spec.filter is not None:
        df = df.filter(as_column(spec.filter))
    if spec.explode:
        df = explode_elements(df, spec.explode)
    if spec.temporary:
        df = df.select("*", *output_columns(spec.temporary))
    df = select_fields(df, spec.fields, [LINEAGE_ID] if LINEAGE_ID in df.columns else [])
    return df if spec.post_filter is None else df.filter(as_column(spec.post_filter))


def explode_elements(df: DataFrame, column: str) -> DataFrame:
    """One row per element in ``_exploded``; null or empty keeps one row with NULL.

    Arrays give the element, maps a (key, value) struct, variants the array element
    or object value.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.VariantType):
        elements = df.sparkSession.tvf.variant_explode_outer(quoted(column).outer())
        return df.lateralJoin(elements.select(F.col("value").alias(EXPLODED)), how="left")
    if isinstance(kind, T.MapType):
        return df.select("*", F.explode_outer(F.map_entries(quoted(column))).alias(EXPLODED))
    if isinstance(kind, T.ArrayType):
        return df.select("*", F.explode_outer(quoted(column)).alias(EXPLODED))
    raise SpecError(f"cannot explode {column!r} of type {kind.simpleString()}")


def rename_column(df: DataFrame, path: str, new_name: str) -> DataFrame:
    """Rename a column, or a struct member given by a dotted path, in place."""
    head, _, rest = path.partition(".")
    if not rest:
        return df.withColumnRenamed(head, new_name)
    renamed = _renamed(df.schema[head].dataType, rest, new_name)
    # Renaming keeps member order and types, so a cast by position is enough.
    return df.withColumn(head, quoted(head).cast(renamed))


def _renamed(kind: T.DataType, path: str, new_name: str) -> T.DataType:
    head, _, rest = path.partition(".")
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_renamed(kind.elementType, path, new_name), kind.containsNull)
    if not isinstance(kind, T.StructType) or head not in kind.names:
        raise SpecError(f"no struct member {head!r}")
    return T.StructType(
        [
            f
            if f.name != head
            else T.StructField(head, _renamed(f.dataType, rest, new_name), f.nullable)
            if rest
            else T.StructField(new_name, f.dataType, f.nullable)
            for f in kind.fields
        ]
    )
