"""Readers: raw log files as batch or stream, and lookup tables or files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.plans.spec import Ingest, LookupSource, SpecError

# Accepted format names and the Spark source that reads each.
FORMATS = {
    "json": "json",
    "jsonl": "json",
    "csv": "csv",
    "text": "text",
    "syslog": "text",
    "parquet": "parquet",
}
LOOKUP_FORMATS = ("csv", "parquet", "json", "jsonl")
# Spark sources whose whole record becomes one variant.
VARIANT_SOURCES = ("json", "csv")


def reader_options(ingest: Ingest, call_options: Mapping[str, str] | None = None) -> dict[str, str]:
    """Reader options; later ones win: defaults, format, variant column, spec, call."""
    options: dict[str, str] = {}
    if ingest.format == "csv" and not _whole_record(ingest):
        options.update(header="true", inferSchema="true")
    if ingest.format == "json":
        options["multiLine"] = str(ingest.multiline).lower()
    if _whole_record(ingest):
        if _source(ingest) == "json":
            options["singleVariantColumn"] = "data"
        else:
            # A file whose header differs from the first one's fails rather than shifts.
            options["enforceSchema"] = "false"
    options.update({k: str(v) for k, v in ingest.options.items()})
    options.update({k: str(v) for k, v in (call_options or {}).items()})
    return options


def _source(ingest: Ingest) -> str:
    if ingest.format not in FORMATS:
        raise SpecError(f"unknown format {ingest.format!r}; known: {sorted(FORMATS)}")
    return FORMATS[ingest.format]


def _whole_record(ingest: Ingest) -> bool:
    """Whether the reader itself makes the variant; other sources make it in a select pass."""
    return ingest.single_variant and _source(ingest) in VARIANT_SOURCES


def _text_record(ingest: Ingest) -> bool:
    """CSV records are read as text: Spark's own variant of a line turns 007 into 7."""
    return _whole_record(ingest) and _source(ingest) == "csv"


def _as_record(df: DataFrame, beside: str | None = None) -> DataFrame:
    """All columns as one variant object in ``data``, but for the one that stays ``beside`` it."""
    members = F.struct(*(F.col(f"`{name}`") for name in df.columns if name != beside))
    return df.select(F.to_variant_object(members).alias("data"), *([beside] if beside else []), "_metadata")


def _declared_schema(ingest: Ingest) -> str | None:
    if ingest.schema:
        return ingest.schema
    if _whole_record(ingest) and not _text_record(ingest):
        return "data variant"
    return "value string" if _source(ingest) == "text" else None


def with_hints(schema: T.StructType, hints: str | None) -> T.StructType:
    """Inferred schema with the hinted columns retyped, or added when absent."""
    if not hints:
        return schema
    hinted = {f.name: f for f in T.StructType.fromDDL(hints).fields}
    kept = [hinted.pop(f.name, f) for f in schema.fields]
    return T.StructType(kept + list(hinted.values()))


def read_batch(
    spark: SparkSession,
    ingest: Ingest,
    inputs: tuple[str, ...] | None = None,
    row_limit: int = 0,
    call_options: Mapping[str, str] | None = None,
) -> DataFrame:
    """All inputs in one batch frame; ``row_limit`` caps a trial run before any step."""
    paths = list(inputs or ingest.inputs)
    schema = _declared_schema(ingest) or _inferred(spark, ingest, paths, call_options)
    options = reader_options(ingest, call_options)
    df = spark.read.format(_source(ingest)).options(**options).schema(schema).load(paths)
    if _text_record(ingest):
        df = _as_record(df)
    elif row_limit > 0:
        # The hidden file metadata is lost behind a limit, so it is pinned first.
        df = df.select("*", "_metadata")
    return df.limit(row_limit) if row_limit > 0 else df


def read_stream(
    spark: SparkSession,
    ingest: Ingest,
    inputs: tuple[str, ...] | None = None,
    call_options: Mapping[str, str] | None = None,
) -> DataFrame:
    """All inputs as one file stream, so one query and one checkpoint feed the table.

    Declare a schema for a stream of typed CSV, JSON or Parquet: else it is taken from
    the files already there, which a start reads for it.
    """
    paths = list(inputs or ingest.inputs)
    schema = _declared_schema(ingest) or _inferred(spark, ingest, paths, call_options)
    options = reader_options(ingest, call_options)
    stream = spark.readStream.format(_source(ingest)).options(**options).schema(schema)
    df = stream.load(one_path(spark, paths))
    return _as_record(df) if _text_record(ingest) else df


def parses(ingest: Ingest) -> bool:
    """Whether records of this format can be broken, and come with the text that does not parse."""
    return _source(ingest) in ("json", "csv")


def read_checked_stream(
    spark: SparkSession, ingest: Ingest, schema: T.StructType, broken: str, call_options: Mapping[str, str] | None = None
) -> DataFrame:
    """A file stream of known schema with the file's metadata, and in ``broken`` the text of records that do not parse."""
    options = reader_options(ingest, call_options) | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    if parses(ingest):
        schema = T.StructType([*schema.fields, T.StructField(broken, T.StringType())])
    stream = spark.readStream.format(_source(ingest)).options(**options).schema(schema)
    df = stream.load(one_path(spark, list(ingest.inputs)))
    if _text_record(ingest):
        return _as_record(df, broken)
    df = df.select("*", "_metadata")
    return df if parses(ingest) else df.withColumn(broken, F.lit(None).cast("string"))


def schema_of(
    spark: SparkSession, ingest: Ingest, call_options: Mapping[str, str] | None = None
) -> T.StructType:
    """The declared schema, else the one of the files that ``call_options`` leave (see ``modifiedAfter``)."""
    declared = _declared_schema(ingest)
    if declared is None:
        return _inferred(spark, ingest, list(ingest.inputs), call_options)
    return T.StructType.fromDDL(declared) if isinstance(declared, str) else declared


def declares(ingest: Ingest) -> bool:
    """Whether the schema is known without a look at the files."""
    return _declared_schema(ingest) is not None


def one_path(spark: SparkSession, paths: list[str]) -> str:
    """One glob that covers several input paths of the same file system.

    A path without a scheme lies in the default file system, as Spark reads it.
    """
    if not paths:
        raise SpecError("no input path")
    if len(paths) == 1:
        return paths[0]
    stores, rest = set(), []
    for path in paths:
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not hadoop_path.toUri().getScheme():
            hadoop_path = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop_path)
        uri = hadoop_path.toUri()
        stores.add((uri.getScheme(), uri.getAuthority() or ""))
        rest.append(uri.getPath().lstrip("/"))
    if len(stores) > 1:
        raise SpecError(f"inputs of one stream lie in different stores, which needs a stream each: {sorted(stores)}")
    scheme, authority = stores.pop()
    return f"{scheme}://{authority}/{{{','.join(rest)}}}"


def _inferred(
    spark: SparkSession, ingest: Ingest, paths: list[str], call_options: Mapping[str, str] | None
) -> T.StructType:
    """Column types from the data; costs a pass, so large sources declare a schema.

    Of a CSV record only the names are taken, from one header line.
    """
    reader = spark.read.format(_source(ingest)).options(**reader_options(ingest, call_options))
    if _text_record(ingest):
        names = reader.option("inferSchema", "false").load(paths).columns
        return T.StructType([T.StructField(name, T.StringType()) for name in names])
    return with_hints(reader.load(paths).schema, ingest.schema_hints)


def read_lookup(spark: SparkSession, source: LookupSource) -> DataFrame:
    if source.frame is not None:
        return source.frame
    if not source.path:
        raise SpecError("a lookup source needs a path")
    if source.kind == "table":
        return spark.read.table(source.path)
    if source.kind not in LOOKUP_FORMATS:
        raise SpecError(f"unknown lookup source {source.kind!r}; known: table, {', '.join(LOOKUP_FORMATS)}")
    name = source.format or source.kind
    reader = spark.read.format(FORMATS.get(name, name)).options(**source.options)
    return (reader.schema(source.schema) if source.schema else reader).load(source.path)


def csv_to_table(
    spark: SparkSession, path: str, table: str, schema: str | None = None, replace: bool = False
) -> DataFrame:
    """Store a CSV file with a header line as a lookup table."""
    reader = spark.read.option("header", "true")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", "true")
    reader.csv(path).write.mode("overwrite" if replace else "errorifexists").saveAsTable(table)
    return spark.read.table(table)
