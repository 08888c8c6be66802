"""Layout of stored rows by several columns at once.

Sorted by time alone, a filter on an address has to look into every file.  Here each column's
values are ranked among cut points, the bits of the ranks are interleaved to one number
(a Morton key), and rows are dealt to files by ranges of it: every file holds a short stretch
of each column, and the readers' minima and maxima rule most files out for a filter on any.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.fields import quoted
from siltstone.plans.spec import SpecError

BITS = 8  # of a column's rank: 256 stretches of about equal size
SAMPLE_TIMES = 64  # sampled values a cut point
MOST_BITS = 62  # of a key, a long without its sign
_KEY, _REST = "__morton", "__rest"
_UNORDERED = ("map", "variant")


def cut_points(df: DataFrame, columns: Sequence[str], bits: int = BITS, seed: int = 7) -> dict[str, list]:
    """Values that part each column into ``2 ** bits`` stretches of about as many rows.

    Taken from ``SAMPLE_TIMES * 2 ** bits`` random rows, as range partitioning does: cut
    points only decide where rows lie, never which there are.  Equal neighbours stay, so
    a value that fills several stretches leaves some empty.  Nulls come first.
    """
    cells = 2**bits
    some = df.select(*(quoted(c).alias(f"c{i}") for i, c in enumerate(columns)))
    some = some.orderBy(F.rand(seed)).limit(SAMPLE_TIMES * cells)
    values = some.agg(*(F.sort_array(F.collect_list(f"c{i}")).alias(f"c{i}") for i in range(len(columns)))).first()
    cuts = {}
    for column, held in zip(columns, values, strict=True):
        cuts[column] = [held[k * len(held) // cells] for k in range(1, cells)] if held else []
    return cuts


def _rank(column: Column, cuts: Sequence, kind, bits: int) -> Column:
    """Number of cut points up to the value, by halving; 0 for null."""
    held = F.array(*(F.lit(c).cast(kind) for c in cuts))
    steps = F.array(*(F.lit(2**b) for b in reversed(range(bits))))
    return F.aggregate(
        steps, F.lit(0), lambda low, step: low + F.when(F.get(held, low + step - 1) <= column, step).otherwise(0)
    )


def morton_key(df: DataFrame, cuts: dict[str, list], bits: int = BITS) -> Column:
    """The ranks of the columns with their bits interleaved, the first column's leading."""
    if len(cuts) * bits > MOST_BITS:
        raise SpecError(f"{len(cuts)} columns of {bits} bits do not fit a key of {MOST_BITS}")
    key = F.lit(0).cast("long")
    for j, (name, held) in enumerate(cuts.items()):
        rank = _rank(quoted(name), held, df.schema[name].dataType, bits).cast("long") if held else F.lit(0).cast("long")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(cuts) + len(cuts) - 1 - j))
    return key


def clustered(df: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """Rows dealt to ``files`` partitions by all ``columns`` alike, ready to be written.

    One column is plain range partitioning.  Ranges are cut within equal keys too, by a
    hash of the row, so a value that a third of the rows share is no single task; rows
    equal in all columns do stay together.  All rows and columns stay; nulls lie with the
    smallest values; an empty table stays empty.
    """
    if not columns or len(set(columns)) < len(columns):
        raise SpecError(f"a layout needs columns, each once: {list(columns)}")
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise SpecError(f"no columns {unknown} to lay out by; there are {df.columns}")
    hashed = [quoted(f.name) for f in df.schema.fields if not any(k in f.dataType.simpleString() for k in _UNORDERED)]
    outputs = [quoted(c) for c in df.columns]
    rest = F.xxhash64(*hashed)
    if len(columns) == 1:
        order = [quoted(columns[0])]
        dealt = df.withColumn(_REST, rest)
    else:
        order = [F.col(_KEY)]
        dealt = df.withColumns({_KEY: morton_key(df, cut_points(df, columns, bits), bits), _REST: rest})
    dealt = dealt.repartitionByRange(files, *order, _REST)
    return dealt.sortWithinPartitions(*order, *(quoted(c) for c in columns)).select(*outputs)


def file_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per file of a stored frame: rows, and the least and greatest value of each column."""
    bounds = [f(quoted(c)).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    file = F.col("_metadata.file_path").alias("file")
    return df.select(file, *map(quoted, columns)).groupBy("file").agg(F.count("*").alias("rows"), *bounds)


def files_touched(df: DataFrame, between: dict[str, tuple]) -> int:
    """Files whose ranges meet all of the given ones (inclusive): those a reader has to look into."""
    ranges = file_ranges(df, list(between))
    for name, (low, high) in between.items():
        ranges = ranges.filter((F.col(f"`min_{name}`") <= F.lit(high)) & (F.col(f"`max_{name}`") >= F.lit(low)))
    return ranges.count()
