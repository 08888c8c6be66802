"""Many inputs into one bronze table: a stream each, remembered schemas, records that do not parse.

Every input has its own file stream and checkpoint, whatever store it lies in and whatever
its schema.  A micro-batch replaces exactly its own partitions (input, batch) of the bronze
table, so a batch that is repeated after a failure adds nothing, and inputs never touch
each other.  Records that do not parse go to a table of their own, in the same batch.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltstone.operators.ingest import to_bronze
from siltstone.plans.naming import layer_table, query_name
from siltstone.plans.spec import Ingest, SpecError
from siltstone.sources.files import declares, read_checked_stream, schema_of
from siltstone.streaming.chain import Placement

INPUT, BATCH = "input_id", "input_batch"
BROKEN = "_broken"
# Types a Parquet reader reads files of narrower ones as, without a rewrite.
WIDER = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.NullType: (T.DataType,),
}


# ---------------------------------------------------------------- schemas


def _wider(a: T.DataType, b: T.DataType, path: str) -> T.DataType:
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged_schema(a, b, f"{path}.")
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_wider(a.elementType, b.elementType, f"{path}[]"))
    if a == b:
        return a
    for narrow, wide in ((a, b), (b, a)):
        if any(isinstance(wide, w) for w in WIDER.get(type(narrow), ())):
            return wide
    raise SpecError(f"column {path} was {a.simpleString()} and is {b.simpleString()} now, which no type holds unchanged")


def merged_schema(old: T.StructType, new: T.StructType, path: str = "") -> T.StructType:
    """Columns of both, nested ones too; of two types the wider one; a clash raises.

    Names are compared without case, as Spark does; the old order stays.
    """
    added = {f.name.lower(): f for f in new.fields}
    if len(added) < len(new.fields):
        raise SpecError(f"columns of one name but for case: {new.names}")
    fields = []
    for f in old.fields:
        other = added.pop(f.name.lower(), None)
        kind = _wider(f.dataType, other.dataType, path + f.name) if other else f.dataType
        fields.append(T.StructField(f.name, kind))
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in added.values()])


class SchemaMemory:
    """The schema of an input, kept in a folder: one small JSON file per change."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def recall(self) -> tuple[T.StructType, str] | None:
        """The last schema, and up to when files were looked at for it."""
        try:
            rows = self.spark.read.schema("version int, as_of string, schema string").json(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        last = rows.orderBy(F.desc("version")).first()
        return (T.StructType.fromJson(json.loads(last["schema"])), last["as_of"]) if last else None

    def version(self) -> int:
        rows = self.spark.read.schema("version int").json(self.path) if self.recall() else None
        return rows.agg(F.max("version")).first()[0] if rows is not None else 0

    def keep(self, schema: T.StructType, as_of: str) -> None:
        row = [(self.version() + 1, as_of, schema.json())]
        self.spark.createDataFrame(row, "version int, as_of string, schema string").coalesce(1).write.mode("append").json(self.path)

    def _latest(self, ingest: Ingest) -> str | None:
        """When the newest file of the input changed; from the listing, no file is read."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(ingest.inputs))
        newest = files.agg(F.date_format(F.max("modificationTime"), "yyyy-MM-dd'T'HH:mm:ss.SSS")).first()[0]
        return newest

    def update(self, ingest: Ingest) -> T.StructType:
        """What is remembered, merged with the schema of files that changed since then.

        Only those files are looked at; the first time, all.  Parquet files may each have
        columns of their own.
        """
        known = self.recall()
        newest = self._latest(ingest)
        options = {"mergeSchema": "true"} if ingest.format == "parquet" else {}
        if known is None:
            schema = schema_of(self.spark, ingest, options)
            self.keep(schema, newest or "")
            return schema
        old, as_of = known
        if not newest or newest <= as_of:
            return old
        zone = self.spark.conf.get("spark.sql.session.timeZone")
        schema = merged_schema(old, schema_of(self.spark, ingest, options | {"modifiedAfter": as_of, "timeZone": zone}))
        self.keep(schema, newest)
        return schema


# ---------------------------------------------------------------- tables


def ensure_table(spark: SparkSession, table: str, schema: T.StructType, path: str, partitions: Sequence[str]) -> T.StructType:
    """Create a table over a folder, or let it take further columns and wider types; gives its schema.

    No file changes: wider types are a new definition over the same folder, and files
    written before are read as what the table says now.
    """
    known = spark.catalog.tableExists(table)
    if known:
        held = spark.table(table).schema
        parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
        if parts != list(partitions):
            raise SpecError(f"{table} is partitioned by {parts}, not by {list(partitions)}")
        old = T.StructType([T.StructField(f.name, f.dataType) for f in held.fields])
        both = merged_schema(old, schema)
        if both == old:
            return old
        spark.sql(f"DROP TABLE {table}")  # over a given folder, so its files stay
        schema = both
    last = [schema[p] for p in partitions]
    schema = T.StructType([f for f in schema.fields if f.name not in partitions] + last)
    empty = spark.createDataFrame([], schema)
    columns = ", ".join(f"`{f.name}` {kind}" for f, (_, kind) in zip(schema.fields, empty.dtypes, strict=True))
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({', '.join(partitions)}) LOCATION '{path}'")
    if known:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return schema


def _replace(spark: SparkSession, df: DataFrame, table: str, path: str, ident: str, batch: int) -> None:
    """Write one batch of one input in place of what it has; a batch that is all there stays.

    The writer moves its files at commit, so a lost executor leaves nothing half done; a
    reader that streams the table sees a batch's files once.
    """
    df = df.withColumns({INPUT: F.lit(ident), BATCH: F.lit(batch).cast("long")})
    partitions = [*(["date"] if "date" in df.columns else []), INPUT, BATCH]
    schema = ensure_table(spark, table, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]), path, partitions)
    here = spark.table(table).where((F.col(INPUT) == ident) & (F.col(BATCH) == batch))
    if not here.isEmpty() and here.count() == df.count():
        return
    stored = {c.lower() for c in df.columns}
    rows = df.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name.lower() in stored else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))
    # Only partitions the rows have are replaced; no other batch has them.
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")  # of the stream's own session
    rows.write.mode("overwrite").insertInto(table)


# ---------------------------------------------------------------- streams


def input_id(ingest: Ingest) -> str:
    """Names an input by a digest of its full paths; ends of paths could agree."""
    return hashlib.sha256("\n".join(ingest.inputs).encode()).hexdigest()[:16]


def quarantine_table(spark: SparkSession, ingest: Ingest) -> str:
    return layer_table(spark, "bronze", f"{ingest.name}_quarantine")


def start_input(spark: SparkSession, ingest: Ingest, place: Placement) -> StreamingQuery:
    """The stream of one input; ``ingest.name`` is the bronze table it shares with others.

    Without a declared schema, the one of the files is remembered beside the checkpoint:
    a start looks at files that came since the last one only, takes new columns and
    wider types, and refuses types that clash.  Rows that do not parse, such as broken
    JSON or short CSV lines, go to the quarantine table with file and text.
    """
    if not place.tables:
        raise SpecError("inputs that share a table need a folder for tables (Placement.tables)")
    ident = input_id(ingest)
    checkpoint = place.checkpoint("bronze", f"{ingest.name}-{ident}")
    schema = schema_of(spark, ingest) if declares(ingest) else SchemaMemory(spark, f"{checkpoint}-schema").update(ingest)
    options = {"maxBytesPerTrigger": str(place.batch_bytes), **place.call_options}
    stream = read_checked_stream(spark, ingest, schema, BROKEN, options)
    bronze, broken = layer_table(spark, "bronze", ingest.name), quarantine_table(spark, ingest)

    def write(df: DataFrame, batch: int) -> None:
        session = df.sparkSession
        df.persist(StorageLevel.MEMORY_AND_DISK)  # parsed once for both tables
        try:
            good = to_bronze(df.where(F.col(BROKEN).isNull()).drop(BROKEN), ingest)
            _replace(session, good, bronze, place.path(bronze), ident, batch)
            bad = df.where(F.col(BROKEN).isNotNull()).select(
                F.col("_metadata.file_path").alias("file"), F.col(BROKEN).alias("text"), F.current_timestamp().alias("processed_time")
            )
            _replace(session, bad, broken, place.path(broken), ident, batch)
        finally:
            df.unpersist()

    writer = stream.writeStream.queryName(query_name("bronze", f"{ingest.name}-{ident}"))
    return place.triggered(writer.option("checkpointLocation", checkpoint).foreachBatch(write)).start()


def run_inputs(spark: SparkSession, ingests: Sequence[Ingest], place: Placement) -> list[StreamingQuery]:
    """Streams of all inputs of one bronze table.

    When draining, one ends before the next begins, as each may add columns to the table;
    otherwise the table must hold all columns, which a drained run of each sees to.
    """
    names = {i.name for i in ingests}
    if len(names) != 1:
        raise SpecError(f"inputs of one table carry its name: {sorted(names)}")
    if len({input_id(i) for i in ingests}) < len(ingests):
        raise SpecError("an input is given twice")
    started = []
    for ingest in ingests:
        started.append(start_input(spark, ingest, place))
        if place.drain:
            started[-1].awaitTermination()
    return started


def quarantine_counts(spark: SparkSession, ingest: Ingest) -> DataFrame:
    """Records that did not parse, per input and file."""
    return spark.table(quarantine_table(spark, ingest)).groupBy(INPUT, "file").agg(F.count("*").alias("records"))
