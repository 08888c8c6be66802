"""Helpers the operators share: staging, checked broadcasts, sorted group maps, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.plans.session import fresh_dir

# A table is broadcast only when it has been counted and has at most this many rows.
BROADCAST_ROWS = 100_000
# Texts are large rows: by default Spark hands a Python worker up to 64 MB of them at once,
# which it then holds several times over.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}
SALTS = 16
OUTPUT_ROWS = 20_000


def configure(spark: SparkSession) -> SparkSession:
    """Session settings that bound what the operators' Python workers hold; they can change at run time."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = fresh_dir(df.sparkSession, f"llm-{purpose}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def text_key(doc_id: str, text: str) -> list[Column]:
    """128 bits that tell one row's (id, text) from another's; equal rows share them."""
    c, t = F.col(doc_id).cast("string"), F.col(text).cast("string")
    marks = F.when(F.col(doc_id).isNull(), F.lit(1)).otherwise(F.lit(0))
    return [F.xxhash64(marks, c, t), F.xxhash64(t, marks, F.lit("second"), c)]


def attach(df: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a table of one row per key: broadcast if it was counted small, else a salted shuffle.

    ``small`` should be staged, since it is counted.  Beyond the bound every row of
    ``small`` is copied ``SALTS`` times and the rows of ``df`` are dealt over the copies,
    so that a key with a third of all rows is split.  The optimizer does not count the
    copies and would broadcast them all; they are shuffled whatever it thinks.
    """
    if small.count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(small), on, how)
    salt = free_name(df, "salt")
    rest = [c for c in df.columns if c not in on]
    dealt = df.withColumn(salt, F.pmod(F.xxhash64(*[F.col(c) for c in rest or on]), F.lit(SALTS)).cast("int"))
    copies = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return shuffled(dealt, copies, [*on, salt], how).drop(salt)


def shuffled(df: DataFrame, other: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join by shuffle and sort, neither side broadcast.

    The optimizer takes a stored table to be as large as its compressed files.  The driver
    would hold it decoded: ids come to ten times that, near copies of texts to more.
    """
    return df.join(other.hint("merge"), on, how)


def running_total(df: DataFrame, group: list[str], buckets: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the rows before each row of its group, in (buckets, order).

    ``buckets`` are integer columns, coarse to fine, that rise with the order.  Rows meet
    in one task only within a finest bucket; above that, sums of buckets are added up
    level by level, so a group with a third of all rows is split.
    """
    w = Window.partitionBy(*group, *buckets).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(value).over(w), F.lit(0))
    if not buckets:
        return df.withColumn(out, inside)
    totals = df.groupBy(*group, *buckets).agg(F.sum(value).alias("v"))
    before = None
    for depth in range(len(buckets)):
        within = [*group, *buckets[:depth]]
        level = totals.groupBy(*within, buckets[depth]).agg(F.sum("v").alias("v"))
        above = Window.partitionBy(*within).orderBy(buckets[depth]).rowsBetween(Window.unboundedPreceding, -1)
        level = level.select(*within, buckets[depth], F.coalesce(F.sum("v").over(above), F.lit(0)).alias(f"before_{depth}"))
        before = level if before is None else level.join(before, within)
    offset = sum((F.col(f"before_{d}") for d in range(1, len(buckets))), F.col("before_0"))
    before = before.select(*group, *buckets, offset.alias("before_bucket"))
    return df.join(before, [*group, *buckets]).withColumn(out, F.col("before_bucket") + inside).drop("before_bucket")


def split_pairs(df: DataFrame, key: str, row: str, size: Column, limit: int) -> DataFrame:
    """Split large groups for all-against-all work: adds ``chunk``, ``left``, ``right``.

    A group of ``size`` rows is dealt into ``ceil(size / limit)`` chunks by a hash of
    ``row``; each row goes once to every (left, right) pair its chunk is part of, so a
    task holds at most two chunks and every pair of rows meets exactly once.
    """
    chunks = F.greatest(F.ceil(size / F.lit(limit)), F.lit(1)).cast("int")
    dealt = df.withColumn("chunks", chunks)
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64(F.col(row), F.lit("chunk")), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return dealt.select(
        *df.columns, "chunk", F.least("chunk", "other").alias("left"), F.greatest("chunk", "other").alias("right")
    )


Columns = dict[str, np.ndarray]


def _groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[Columns]:
    held: list[Columns] = []
    last = None
    for frame in frames:
        if not len(frame):
            continue
        cols = {c: frame[c].to_numpy() for c in frame.columns}
        new = np.zeros(len(frame) - 1, bool)
        for k in keys:
            new |= cols[k][1:] != cols[k][:-1]
        bounds = [0, *(np.flatnonzero(new) + 1).tolist(), len(frame)]
        for start, end in zip(bounds, bounds[1:], strict=False):
            key = tuple(cols[k][start] for k in keys)
            if held and key != last:
                yield _joined(held)
                held = []
            held.append({c: v[start:end] for c, v in cols.items()})
            last = key
    if held:
        yield _joined(held)


def _joined(parts: list[Columns]) -> Columns:
    return parts[0] if len(parts) == 1 else {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def map_groups(df: DataFrame, keys: list[str], work: Callable[[Iterator[Columns]], Iterator[Columns]], schema: str) -> DataFrame:
    """Run ``work`` over all groups of a partition, one after the other.

    Rows are dealt by ``keys`` (non-null integers) and sorted, so one Python call serves a
    whole partition; a call per group would cost more than the work on small groups.
    ``work`` gets groups as column arrays and yields column arrays.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready: list[Columns] = []
        rows = 0
        for out in work(_groups(frames, keys)):
            n = len(next(iter(out.values())))
            if n:
                ready.append(out)
                rows += n
            if rows >= OUTPUT_ROWS:
                yield pd.DataFrame({c: list(v) if v.dtype == object else v for c, v in _joined(ready).items()})
                ready, rows = [], 0
        if ready:
            yield pd.DataFrame({c: list(v) if v.dtype == object else v for c, v in _joined(ready).items()})

    return df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys).mapInPandas(run, schema)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the links ``a[i] - b[i]``."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        np.minimum.at(root, before, root)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(root, before):
            break
    return root


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links ``a, b`` (long): one row ``node, component`` per node in a link.

    ``component`` is the smallest node reachable.  Rounds of large-star and small-star
    (Kiveris et al., "Connected Components in MapReduce and Beyond"); each round is two
    grouped minima, joined back on the node; these are written first, so that the join's
    sides are plain scans and AQE splits the tasks of a hub.
    A pair of numbers per round reaches the driver.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage(edges, "links")
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
        if not mark[0]:
            break
        both = edges.union(edges.select("b", "a"))
        low = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "low")
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stage(large, "links")
        low = stage(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stage(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "links")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select("b", "b")).distinct()


def as_documents(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Only the two columns an operator reads, under fixed names, whatever else the table holds."""
    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast(T.StringType()).alias("text"))
