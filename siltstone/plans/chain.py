"""Batch run of a flow: raw files (or a ready bronze frame) to silver and gold frames."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.ingest import to_bronze
from siltstone.operators.layers import to_gold, to_silver
from siltstone.plans.ocsf import conform
from siltstone.plans.spec import Flow, GoldSpec, SilverSpec, SpecError
from siltstone.sources.files import read_batch


@dataclass(frozen=True, eq=False)
class Layers:
    """The lazily built frames of one batch run."""

    bronze: DataFrame | None
    silver: dict[str, DataFrame] = field(default_factory=dict)
    gold: dict[str, DataFrame] = field(default_factory=dict)


def run_batch(
    spark: SparkSession,
    flow: Flow,
    bronze: DataFrame | None = None,
    silver: Mapping[str, DataFrame] | None = None,
    inputs: tuple[str, ...] | None = None,
    row_limit: int = 0,
    tables: Collection[str] = (),
    conformed: bool = True,
    call_options: Mapping[str, str] | None = None,
) -> Layers:
    """Build every layer of a flow.

    A given ``bronze`` frame or ``silver`` frames replace the layers up to that point.
    ``tables`` limits silver and gold to the named tables; a silver table that a named
    gold table reads is built as well.  Nothing runs until a frame is used.
    """
    if bronze is None and silver is None:
        bronze = to_bronze(read_batch(spark, flow.ingest, inputs, row_limit, call_options), flow.ingest)
    chosen = [m for m in flow.gold if not tables or m.name in tables]
    if silver is None:
        needed = {m.input for m in chosen}
        silver = {
            spec.name: to_silver(silver_input(spark, spec, bronze), spec)
            for spec in flow.silver
            if not tables or spec.name in tables or spec.name in needed
        }
    gold = {}
    for mapping in chosen:
        mapped = to_gold(gold_input(spark, mapping, silver), mapping)
        gold[mapping.name] = conform(mapped, mapping.name) if conformed else mapped
    return Layers(bronze, dict(silver), gold)


def silver_input(spark: SparkSession, spec: SilverSpec, bronze: DataFrame | None) -> DataFrame:
    """A dotted input is a table of its own; anything else reads the bronze frame."""
    if spec.input and "." in spec.input:
        return spark.read.table(spec.input)
    if bronze is None:
        raise SpecError(f"{spec.name!r} needs a bronze frame or a full table name as input")
    return bronze


def gold_input(spark: SparkSession, mapping: GoldSpec, silver: Mapping[str, DataFrame]) -> DataFrame:
    if "." in mapping.input:
        return spark.read.table(mapping.input)
    if mapping.input not in silver:
        raise SpecError(f"{mapping.name!r} reads unknown table {mapping.input!r}; known: {sorted(silver)}")
    return silver[mapping.input]


def union_by_class(runs: Collection[Layers]) -> dict[str, DataFrame]:
    """Rows of several sources in one frame per event class."""
    merged: dict[str, DataFrame] = {}
    for run in runs:
        for name, df in run.gold.items():
            merged[name] = merged[name].unionByName(df, allowMissingColumns=True) if name in merged else df
    return merged


def summary(run: Layers) -> DataFrame:
    """Rows and columns of every layer and table, counted where the data is."""
    named = [] if run.bronze is None else [("bronze", "bronze", run.bronze)]
    named += [("silver", name, df) for name, df in run.silver.items()]
    named += [("gold", name, df) for name, df in run.gold.items()]
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(layer).alias("layer"),
            F.lit(table).alias("table"),
            "row_count",
            F.lit(len(df.columns)).alias("col_count"),
        )
        for layer, table, df in named
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
