"""One table fed by many flows: idempotent batches, versions, compaction.

Plain file sinks of two streams in one directory lose rows, and plain tables have no
DELETE.  So a shared table is partitioned by lane (provider@log), lane version, batch and
day, and every write replaces exactly its own batch: a replayed batch gives the same
rows, lanes never touch each other, and an old mapping version is dropped as a folder.

What readers see is kept apart from what is stored.  Table properties name the live
version of a lane and the batches that merged files stand for; setting one is a single
catalog call, made when the new files are complete.  So a replay or a compaction changes
the rows of ``frame`` at one moment, whether it ends or fails.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.plans.naming import quote
from siltstone.plans.ocsf import CLASSES, class_schema
from siltstone.plans.spec import SpecError

LANE, VERSION, BATCH, DAY = "lane", "lane_version", "lane_batch", "lane_date"
LANE_COLUMNS = (LANE, VERSION, BATCH, DAY)
LIVE, MERGED, GRAIN = "siltstone.live", "siltstone.merged", "siltstone.grain"
# The day of rows without a time.
NO_DAY = "1970-01-01"
SPECS_PER_CALL = 200


@dataclass(frozen=True)
class Lane:
    """One source's share of a shared table, under one mapping version."""

    provider: str
    log_name: str
    version: str

    @property
    def name(self) -> str:
        return f"{self.provider}@{self.log_name}"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """Last batch a stream's checkpoint has committed, -1 if none; the stream repeats none up to it."""
    path, file_system = _file_system(spark, f"{checkpoint}/commits")
    if not file_system.exists(path):
        return -1
    names = (s.getPath().getName() for s in file_system.listStatus(path))
    return max((int(n) for n in names if n.isdigit()), default=-1)


class SharedTable:
    """Handle on one shared table of a session's catalog.

    Stream batches may run side by side on different lanes.  ``compact``,
    ``drop_version`` and ``set_live`` change table properties: run one of them at a time
    on a table.
    """

    def __init__(self, spark: SparkSession, table: str) -> None:
        self.spark, self.table = spark, table

    def create(self, schema: T.StructType, path: str | None = None, grain: str = "day") -> SharedTable:
        """Create the table if it is not there yet; an existing one must be laid out alike.

        ``grain`` is the span of time a folder holds: ``day``, or ``month`` where a batch
        spreads few rows over many days.  It is kept with the table.
        """
        if grain not in ("day", "month"):
            raise SpecError(f"unknown grain {grain!r}; known: day, month")
        if self.spark.catalog.tableExists(self.table):
            parts = [c.name for c in self.spark.catalog.listColumns(self.table) if c.isPartition]
            if sorted(parts) != sorted(LANE_COLUMNS):
                raise SpecError(f"{self.table} is partitioned by {parts}, a shared table by {list(LANE_COLUMNS)}")
            missing = set(schema.names) - set(self.spark.table(self.table).columns)
            if missing:
                raise SpecError(f"{self.table} lacks columns {sorted(missing)}")
            return self
        columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        kinds = dict(zip(LANE_COLUMNS, ("string", "string", "bigint", "date"), strict=True))
        empty = self.spark.range(0).select(*columns, *(F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()))
        writer = empty.write.format("parquet").partitionBy(*LANE_COLUMNS)
        (writer.option("path", path) if path else writer).saveAsTable(self.table)
        self.spark.sql(f"ALTER TABLE {self.table} SET TBLPROPERTIES ('{GRAIN}' = '{grain}')")
        return self

    @property
    def grain(self) -> str:
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.table}").filter(F.col("key") == GRAIN).first()
        return found["value"] if found else "day"

    @property
    def location(self) -> str:
        described = self.spark.sql(f"DESCRIBE FORMATTED {self.table}").filter("col_name = 'Location'")
        return described.first()["data_type"].rstrip("/")

    # -- reading ---------------------------------------------------------------------------

    def frame(self, with_lane: bool = False, since: str | None = None, until: str | None = None) -> DataFrame:
        """The live rows; ``since`` and ``until`` are days (inclusive) and prune partitions."""
        self.spark.catalog.refreshTable(self.table)
        df = self.spark.table(self.table).filter(self._live())
        grain = self.grain if since or until else ""
        for day, keep in ((since, Column.__ge__), (until, Column.__le__)):
            if day is not None:
                first = F.lit(day).cast("date")
                df = df.filter(keep(F.col(DAY), first if grain == "day" else F.trunc(first, grain)))
                if "time" in df.columns:
                    df = df.filter(keep(F.to_date("time"), first))
        return df if with_lane else df.drop(*LANE_COLUMNS)

    def _properties(self, kind: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.table}").filter(F.col("key").startswith(kind + ".")).collect()
        return {r["key"].removeprefix(kind + "."): r["value"] for r in rows}

    def _set(self, kind: str, key: str, value: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.table} SET TBLPROPERTIES ({_text(f'{kind}.{key}')} = {_text(value)})")

    def _unset(self, kind: str, key: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.table} UNSET TBLPROPERTIES IF EXISTS ({_text(f'{kind}.{key}')})")

    def _merged(self, lane: Lane) -> tuple[int, int]:
        """Last batch that merged files stand for, and the number of merges."""
        value = self._properties(MERGED).get(f"{lane.name}.{lane.version}", "-1:0")
        up_to, merges = value.split(":")
        return int(up_to), int(merges)

    def _live(self) -> Column:
        """Condition on partition columns; merges are numbered -1, -2, ..."""
        live = F.col(BATCH) >= 0
        for key, value in self._properties(MERGED).items():
            name, _, version = key.partition(".")
            up_to, merges = (int(x) for x in value.split(":"))
            here = (F.col(LANE) == name) & (F.col(VERSION) == version)
            live = (~here & live) | (here & (((F.col(BATCH) < 0) & (F.col(BATCH) >= -merges)) | (F.col(BATCH) > up_to)))
        for name, version in self._properties(LIVE).items():
            live &= ~((F.col(LANE) == name) & (F.col(VERSION) != version))
        return live

    def set_live(self, lane: Lane) -> None:
        """Show only this version of the lane from now on."""
        self._directory("", lane)
        self._set(LIVE, lane.name, lane.version)

    def live_version(self, lane: Lane) -> str | None:
        return self._properties(LIVE).get(lane.name)

    # -- writing ---------------------------------------------------------------------------

    def write_batch(
        self, df: DataFrame, lane: Lane, batch: int, sort_by: Iterable[str] = ("time",), rebalance: bool = False
    ) -> None:
        """Replace the rows of one batch of one lane, a folder per day of ``time``.

        The writer stages its files and moves them at commit, and only partitions present
        in ``df`` are replaced, so retries and lost executors leave no half batch.
        ``rebalance`` evens out file sizes at the cost of a shuffle; it pays where a
        filter leaves few rows per task.
        """
        location = self.location
        folder = self._directory(location, lane, batch)
        before = _days(self.spark, folder)
        day = F.to_date("time") if "time" in df.columns else F.lit(None).cast("date")
        day = day if self.grain == "day" else F.trunc(day, self.grain)
        columns = {
            LANE: F.lit(lane.name),
            VERSION: F.lit(lane.version),
            BATCH: F.lit(batch).cast("bigint"),
            DAY: F.coalesce(day, F.lit(NO_DAY).cast("date")),
        }
        df = df.withColumns(columns)
        if before:
            # A repeated batch; days it no longer has must not stay.
            before -= {str(r[0]) for r in df.select(DAY).distinct().collect()}
        df = df.hint("rebalance") if rebalance else df
        keys = [name for name in sort_by if name in df.columns]
        df = df.sortWithinPartitions(*LANE_COLUMNS, *keys)
        df.write.partitionBy(*LANE_COLUMNS).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(location)
        self._drop(lane, batch, before)
        self._add(lane, batch, _days(self.spark, folder))
        self.spark.catalog.refreshTable(self.table)

    def batches(self, lane: Lane) -> list[int]:
        """Numbers of the stored batches of one lane version, merged ones being negative."""
        path, file_system = _file_system(self.spark, self._directory(self.location, lane))
        if not file_system.exists(path):
            return []
        names = (s.getPath().getName() for s in file_system.listStatus(path))
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{BATCH}="))

    def drop_version(self, lane: Lane) -> None:
        """Remove all rows of one lane version."""
        for batch in self.batches(lane):
            self._drop(lane, batch, _days(self.spark, self._directory(self.location, lane, batch)))
        _delete(self.spark, self._directory(self.location, lane))
        self._unset(MERGED, f"{lane.name}.{lane.version}")
        if self.live_version(lane) == lane.version:
            self._unset(LIVE, lane.name)
        self.spark.catalog.refreshTable(self.table)

    def compact(self, lane: Lane, up_to: int | None = None, checkpoint: str | None = None) -> None:
        """Merge the batches since the last merge into one, a set of files per day.

        Only batches the stream has committed may be merged, since a stream repeats the
        others: ``checkpoint`` is the folder that tells, or the caller vouches for
        ``up_to``.  Rows are copied once in their life; a merge has a number of its own,
        which no batch has, and stands for its batches from the moment the property is
        set.  The batches are removed after that, by the next call if this one fails.
        """
        if up_to is None and checkpoint is None:
            raise SpecError("compaction needs the last committed batch, or the checkpoint that holds it")
        if checkpoint is not None:
            known = committed_batch(self.spark, checkpoint)
            up_to = known if up_to is None else min(up_to, known)
        done, merges = self._merged(lane)
        self._clear(lane, done)
        closed = [b for b in self.batches(lane) if done < b <= up_to]
        if len(closed) > 1:
            number = -(merges + 1)
            stale = self._directory(self.location, lane, number)
            self._drop(lane, number, _days(self.spark, stale))  # of a call that failed
            _delete(self.spark, stale)
            self.spark.catalog.refreshTable(self.table)
            here = (F.col(LANE) == lane.name) & (F.col(VERSION) == lane.version)
            rows = self.spark.table(self.table).filter(here & F.col(BATCH).between(closed[0], closed[-1]))
            self.write_batch(rows.drop(*LANE_COLUMNS), lane, number, rebalance=True)
            self._set(MERGED, f"{lane.name}.{lane.version}", f"{closed[-1]}:{merges + 1}")
            self._clear(lane, closed[-1])

    def _clear(self, lane: Lane, up_to: int) -> None:
        """Remove the batches that a merge stands for."""
        for batch in self.batches(lane):
            if 0 <= batch <= up_to:
                folder = self._directory(self.location, lane, batch)
                self._drop(lane, batch, _days(self.spark, folder))
                _delete(self.spark, folder)
        self.spark.catalog.refreshTable(self.table)

    def _add(self, lane: Lane, batch: int, days: Iterable[str]) -> None:
        for some in _chunks(sorted(days)):
            specs = " ".join(f"PARTITION ({self._spec(lane, batch, day)})" for day in some)
            self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {specs}")

    def _drop(self, lane: Lane, batch: int, days: Iterable[str]) -> None:
        days = sorted(days)
        for some in _chunks(days):
            specs = ", ".join(f"PARTITION ({self._spec(lane, batch, day)})" for day in some)
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS {specs}")
        for day in days:
            _delete(self.spark, f"{self._directory(self.location, lane, batch)}/{DAY}={day}")

    @staticmethod
    def _spec(lane: Lane, batch: int, day: str) -> str:
        return f"{LANE} = {_text(lane.name)}, {VERSION} = {_text(lane.version)}, {BATCH} = {batch}, {DAY} = DATE'{day}'"

    @staticmethod
    def _directory(location: str, lane: Lane, batch: int | None = None) -> str:
        for value in (lane.name, lane.version):
            if not value or any(c in value for c in "/\\:%='\"*?{}[]#^"):
                raise SpecError(f"provider, log name and version must be plain names: {value!r}")
        if "." in lane.name:
            raise SpecError(f"provider and log name must have no dots: {lane.name!r}")
        path = f"{location}/{LANE}={lane.name}/{VERSION}={lane.version}"
        return path if batch is None else f"{path}/{BATCH}={batch}"


def create_class_tables(
    spark: SparkSession,
    database: str | None = None,
    classes: tuple[str, ...] = tuple(CLASSES),
    replace: bool = False,
    location: str | None = None,
) -> list[str]:
    """Create the class tables as shared tables, empty; an existing one raises unless ``replace`` is given."""
    names = {event_class: quote(database or "", event_class) for event_class in classes}
    taken = [name for name in names.values() if spark.catalog.tableExists(name)]
    if taken and not replace:
        raise SpecError(f"tables exist already, nothing was created: {taken}")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(database)}")
    for event_class, name in names.items():
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        SharedTable(spark, name).create(class_schema(event_class), f"{location}/{event_class}" if location else None)
    return list(names.values())


def _chunks(items: list[str]) -> Iterator[list[str]]:
    for start in range(0, len(items), SPECS_PER_CALL):
        yield items[start : start + SPECS_PER_CALL]


def _days(spark: SparkSession, folder: str) -> set[str]:
    """Days a batch has folders for."""
    path, file_system = _file_system(spark, folder)
    if not file_system.exists(path):
        return set()
    names = (s.getPath().getName() for s in file_system.listStatus(path))
    return {n.partition("=")[2] for n in names if n.startswith(f"{DAY}=")}


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    hadoop_path, file_system = _file_system(spark, path)
    file_system.delete(hadoop_path, True)
