"""Raw rows to the bronze layout, for batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.fields import as_column
from siltstone.operators.lookups import apply_lookups
from siltstone.plans.spec import Ingest

LINEAGE_ID = "dsl_id"
FILE_METADATA = "_metadata"


def lineage_id() -> Column:
    """Hex milliseconds plus 13 random hex digits, 24 characters in all.

    Random: it is fixed only once the bronze table is written.  The form is a fixed one;
    12 of its digits are random (the 13th marks the kind of UUID), and all rows of a batch
    have the same milliseconds, so of 10^9 rows in a batch over a thousand share an id.
    """
    millis = F.hex(F.unix_millis(F.current_timestamp()))
    random_part = F.substring(F.replace(F.expr("uuid()"), F.lit("-"), F.lit("")), 1, 13)
    return F.lower(F.concat(millis, random_part))


def record_id(payload: Column, file_name: Column) -> Column:
    """Content hash of one raw record in one file; the same in batch and stream."""
    return F.md5(F.concat_ws("_", payload, file_name))


def pre_transform(df: DataFrame, ingest: Ingest) -> DataFrame:
    """Select passes in order; the hidden file metadata is pinned in the first one."""
    if not ingest.pre:
        return df.select("*", FILE_METADATA) if FILE_METADATA not in df.columns else df
    first = list(ingest.pre[0])
    if not any(isinstance(e, str) and e.strip(' `"') == FILE_METADATA for e in first):
        first.append(FILE_METADATA)
    for expressions in (first, *ingest.pre[1:]):
        df = df.select(*(as_column(e) for e in expressions))
    return df


def standard_columns(df: DataFrame, ingest: Ingest) -> DataFrame:
    """Add record id, date, processing time and lineage id where not yet present."""
    payload = F.to_json("data") if ingest.single_variant else F.col("value")
    made = {
        "record_id": lambda: record_id(payload, F.col(f"{FILE_METADATA}.file_name")),
        "date": lambda: F.to_date("time"),
        "processed_time": F.current_timestamp,
        LINEAGE_ID: lineage_id,
    }
    return df.withColumns({name: build() for name, build in made.items() if name not in df.columns})


def ordered(df: DataFrame, ingest: Ingest) -> DataFrame:
    """Identity, routing, time, payload, provenance, lineage; then everything else."""
    standard = [
        "record_id",
        "source",
        "sourcetype",
        "time",
        "date",
        ingest.payload,
        FILE_METADATA,
        "processed_time",
        LINEAGE_ID,
    ]
    known = [name for name in standard if name in df.columns]
    return df.select(*known, *(f"`{name}`" for name in df.columns if name not in standard))


def to_bronze(df: DataFrame, ingest: Ingest) -> DataFrame:
    df = standard_columns(pre_transform(df, ingest), ingest)
    df = apply_lookups(df, ingest.lookups)
    if ingest.post:
        df = df.select(*(as_column(e) for e in ingest.post))
    if ingest.drop:
        df = df.drop(*ingest.drop)
    return ordered(df, ingest)
