"""Streaming run of a flow: files -> bronze table -> silver tables -> class tables."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from siltstone.operators.ingest import to_bronze
from siltstone.operators.layers import to_gold, to_silver
from siltstone.plans.naming import gold_table, layer_table, query_name
from siltstone.plans.ocsf import class_schema, conform
from siltstone.plans.spec import Flow, GoldSpec, SpecError
from siltstone.sources.files import read_stream
from siltstone.streaming.shared import Lane, SharedTable, _delete

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class Placement:
    """Where a run keeps its checkpoints and tables, and how it is paced.

    ``batch_bytes`` bounds one micro-batch, so that draining a large backlog proceeds in
    steps that fit the cluster; every row is still processed.  A batch that feeds several
    classes is held on the executors' disks meanwhile, so the bound is also what they
    need together.  Without ``drain`` the streams run on, one micro-batch every
    ``interval`` (such as ``"1 minute"``) or as fast as they can.  Tables have a folder
    per day; with ``grain`` ``"month"`` class tables have one per month, and the others
    none, which suits few rows spread over many days.
    """

    checkpoints: str
    tables: str | None = None
    drain: bool = True
    batch_bytes: int = 2**36
    interval: str | None = None
    grain: str = "day"
    call_options: Mapping[str, str] = field(default_factory=dict)

    def checkpoint(self, layer: str, name: str) -> str:
        return f"{self.checkpoints}/{query_name(layer, name)}"

    def path(self, table: str) -> str | None:
        return f"{self.tables}/{table.replace('`', '')}" if self.tables else None


    def triggered(self, writer: DataStreamWriter) -> DataStreamWriter:
        if self.drain:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=self.interval) if self.interval else writer


def gold_checkpoint(flow: Flow, place: Placement, source: str) -> str:
    """Checkpoint of the stream that maps one parsed table of a flow."""
    lane = lane_of(flow)
    return place.checkpoint("gold", f"{source}-{lane.name}-{lane.version}")


def lane_of(flow: Flow) -> Lane:
    return Lane(flow.provider or flow.name, flow.log_name or flow.name, flow.version)


def _start(df: DataFrame, place: Placement, layer: str, name: str, table: str) -> StreamingQuery:
    """One query appending to a layer's table, a folder per day where there is a ``date``."""
    writer = df.writeStream.queryName(query_name(layer, name))
    writer = writer.option("checkpointLocation", place.checkpoint(layer, name))
    if "date" in df.columns and place.grain == "day":
        writer = writer.partitionBy("date")
    writer = place.triggered(writer)
    if place.path(table):
        writer = writer.option("path", place.path(table))
    return writer.toTable(table)


def _table_stream(spark: SparkSession, table: str, place: Placement) -> DataFrame:
    """Rows appended to a table; update and delete commits are passed over."""
    return (
        spark.readStream.option("skipChangeCommits", "true")
        .option("maxBytesPerTrigger", str(place.batch_bytes))
        .table(table)
    )


def start_bronze(
    spark: SparkSession, flow: Flow, place: Placement, inputs: tuple[str, ...] | None = None
) -> StreamingQuery:
    """All inputs of a flow in one query, appending to its bronze table."""
    options = {"maxBytesPerTrigger": str(place.batch_bytes), **place.call_options}
    df = to_bronze(read_stream(spark, flow.ingest, inputs, options), flow.ingest)
    table = layer_table(spark, "bronze", flow.ingest.name)
    return _start(df, place, "bronze", flow.ingest.name, table)


def start_silver(spark: SparkSession, flow: Flow, place: Placement, only: Collection[str] = ()) -> list[StreamingQuery]:
    queries = []
    for spec in flow.silver:
        if only and spec.name not in only:
            continue
        source = spec.input if spec.input and "." in spec.input else flow.ingest.name
        df = to_silver(_table_stream(spark, layer_table(spark, "bronze", source), place), spec)
        table = layer_table(spark, "silver", spec.name)
        queries.append(_start(df, place, "silver", spec.name, table))
    return queries


def start_gold(spark: SparkSession, flow: Flow, place: Placement, only: Collection[str] = ()) -> list[StreamingQuery]:
    """One query per parsed table; each batch is read once and feeds all its classes."""
    by_input: dict[str, list[GoldSpec]] = {}
    for mapping in flow.gold:
        if not only or mapping.name in only:
            by_input.setdefault(mapping.input, []).append(mapping)
    lane = lane_of(flow)
    queries = []
    for source, mappings in by_input.items():
        targets = {}
        for mapping in mappings:
            table = gold_table(spark, mapping)
            targets[mapping.name] = SharedTable(spark, table).create(class_schema(mapping.name), place.path(table), place.grain)
        name = f"{source}-{lane.name}-{lane.version}"
        writer = (
            _table_stream(spark, layer_table(spark, "silver", source), place)
            .writeStream.queryName(query_name("gold", name))
            .option("checkpointLocation", gold_checkpoint(flow, place, source))
            .foreachBatch(_class_writer(mappings, targets, lane))
        )
        queries.append(place.triggered(writer).start())
    return queries


def _class_writer(mappings: list[GoldSpec], targets: dict[str, SharedTable], lane: Lane):
    def write(df: DataFrame, batch: int) -> None:
        shared = len(mappings) > 1
        if shared:
            df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for mapping in mappings:
                rows = conform(to_gold(df, mapping), mapping.name)
                targets[mapping.name].write_batch(
                    rows, lane, batch, mapping.cluster_by or ("time",), rebalance=mapping.filter is not None
                )
        finally:
            if shared:
                df.unpersist()

    return write


def _await(queries: Collection[StreamingQuery]) -> None:
    """Wait for all; the first failure is raised."""
    for query in queries:
        query.awaitTermination()


def run_stream(
    spark: SparkSession,
    flow: Flow,
    place: Placement,
    inputs: tuple[str, ...] | None = None,
    layers: Collection[str] = LAYERS,
    tables: Collection[str] = (),
) -> list[StreamingQuery]:
    """Run the chosen layers.

    When draining, each layer ends before the next one starts, so one call carries all
    rows through.  Otherwise all queries are started and returned running.
    """
    unknown = set(layers) - set(LAYERS)
    if unknown:
        raise SpecError(f"unknown layers: {sorted(unknown)}")
    silver_names = [s.name for s in flow.silver if s.name in tables]
    gold_names = [m.name for m in flow.gold if m.name in tables]
    if gold_names:
        silver_names += [m.input for m in flow.gold if m.name in gold_names]
    starters = {
        "bronze": lambda: [start_bronze(spark, flow, place, inputs)],
        "silver": lambda: start_silver(spark, flow, place, silver_names),
        "gold": lambda: start_gold(spark, flow, place, gold_names),
    }
    queries: list[StreamingQuery] = []
    for layer in LAYERS:
        if layer not in layers:
            continue
        started = starters[layer]()
        queries += started
        if place.drain:
            _await(started)
    return queries


def replay_gold(
    spark: SparkSession, flow: Flow, place: Placement, replaced: str | None = None, tables: Collection[str] = ()
) -> list[StreamingQuery]:
    """Map the stored parsed rows again under ``flow.version``.

    The new version is written beside the one that readers see, which is ``replaced``
    from the start, shown when all its rows are there, and only then the old one is
    dropped.  A run that fails leaves the old version as it was, and is begun anew by the
    next call.  A running stream gives no such moment, so a replay drains.
    """
    if not place.drain:
        raise SpecError("a replay drains its input; run the stream afterwards")
    lane = lane_of(flow)
    if replaced == lane.version:
        raise SpecError(f"version {replaced!r} cannot replace itself; give the flow a new version")
    chosen = [m for m in flow.gold if not tables or m.name in tables]
    tables_of = {m.name: gold_table(spark, m) for m in chosen}
    targets = {
        name: SharedTable(spark, table).create(class_schema(name), place.path(table), place.grain)
        for name, table in tables_of.items()
    }
    old = Lane(lane.provider, lane.log_name, replaced) if replaced else None
    for target in targets.values():
        if target.live_version(lane) != lane.version:
            if old:
                target.set_live(old)
            # Of a run that failed; a new one may cut its batches differently.
            target.drop_version(lane)
    live = {name for name, target in targets.items() if target.live_version(lane) == lane.version}
    rest = [m.name for m in chosen if m.name not in live]
    for source in {m.input for m in chosen if m.name in rest}:
        _delete(spark, gold_checkpoint(flow, place, source))
    queries = start_gold(spark, flow, place, rest) if rest else []
    _await(queries)
    for target in targets.values():
        target.set_live(lane)
        if old:
            target.drop_version(old)
    return queries
