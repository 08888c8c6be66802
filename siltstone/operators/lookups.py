"""Enrichment of a main frame from static lookup frames."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.fields import quoted
from siltstone.plans.spec import Lookup, SpecError
from siltstone.sources.files import read_lookup

log = logging.getLogger(__name__)

# A broadcast side is held by the driver and by every executor, decoded.  The optimizer's
# size of a file is the compressed one on disk, shared out over the columns that are
# read; decoded rows are taken to be so many times as large.
BROADCAST_LIMIT_CONF = "siltstone.lookup.broadcastLimitBytes"
BROADCAST_LIMIT = 256 * 1024 * 1024
EXPANSION_CONF = "siltstone.lookup.decodedTimes"
EXPANSION = 5
# A salted lookup is copied once per salt; one that Spark broadcasts anyway needs none.
SALT_ABOVE_CONF = "siltstone.lookup.saltAboveBytes"
SALT_ABOVE = 10 * 1024 * 1024

# A key is hot if its rows alone come to so many mean tasks of the join.
HOT_TASKS = 2
MOST_TRACKED = 1_000_000  # keys a sketch can hold

# Lookup rows of one key that main rows are joined with in turn, where they come out by their product.
RUN = 128

_SALT = "__salt"
_RUN = "__run"


def planned_size(df: DataFrame) -> int:
    """Bytes the optimizer expects from ``df``; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _setting(df: DataFrame, name: str, default: int) -> int:
    return int(df.sparkSession.conf.get(name, str(default)))


def may_broadcast(df: DataFrame) -> bool:
    """Whether the columns of ``df``, decoded, are within the broadcast limit."""
    limit = _setting(df, BROADCAST_LIMIT_CONF, BROADCAST_LIMIT)
    return planned_size(df) * _setting(df, EXPANSION_CONF, EXPANSION) <= limit


def repeated_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Key combinations held by more than one lookup row, with their row count."""
    keys = list(keys)
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def apply_lookups(df: DataFrame, lookups: Iterable[Lookup]) -> DataFrame:
    """Join the lookups in order; a later one may use columns of an earlier one."""
    return reduce(apply_lookup, lookups, df)


def apply_lookup(df: DataFrame, lookup: Lookup) -> DataFrame:
    frame = read_lookup(df.sparkSession, lookup.source)
    _check(df, frame, lookup)
    wanted = list(lookup.select) or frame.columns
    renamed = {name: f"{lookup.prefix}{name}" for name in wanted}
    repeated = {n.lower() for n in renamed.values()} & {n.lower() for n in df.columns}
    if repeated:
        raise SpecError(f"lookup {lookup.name!r} repeats columns {sorted(repeated)}; give a prefix or a select")

    # The lookup side is narrowed to its keys and wanted columns before the join.
    keys = [f"__key{i}" for i in range(len(lookup.on))]
    side = frame.select(
        *(quoted(right).alias(key) for key, (_, right) in zip(keys, lookup.on)),
        *(quoted(name).alias(out) for name, out in renamed.items()),
    )
    small = lookup.broadcast and may_broadcast(side)
    if lookup.broadcast and not small:
        log.warning("lookup %r is too large to broadcast; it is joined by shuffle", lookup.name)
    outputs = [*df.columns, *renamed.values()]
    left_keys = [left for left, _ in lookup.on]

    large = not small and planned_size(side) > _setting(df, SALT_ABOVE_CONF, SALT_ABOVE)
    salt, hot = lookup.salt if large else 0, None
    if large and lookup.hot_keys and not df.isStreaming:
        hot, salt = hot_keys(df, left_keys)
        hot = hot if _hash_alike(df, left_keys, side, keys) else None
    if lookup.how in ("left", "inner"):
        joined = _equi_join(df, side, left_keys, keys, lookup.how, small, salt, hot)
        return joined.select(*(quoted(name) for name in outputs))
    if df.isStreaming:
        raise SpecError(
            f"lookup {lookup.name!r}: a {lookup.how} join keeps unmatched lookup rows, "
            "which is only known once the stream has ended; run it as a batch"
        )
    spread, dealt, left_on, on = df, side, left_keys, keys
    asked = lookup.salt > 1 or lookup.hot_keys
    if asked and not small and not large and may_broadcast(side) and (lookup.salt > 1 or hot_keys(df, left_keys)[1] > 1):
        # An outer join does not broadcast its lookup, however small, and AQE packs its tasks by
        # input bytes, so few keys that repeat on both sides would make all rows in few tasks.
        small, spread = True, df.repartition(_setting(df, "spark.sql.shuffle.partitions", 200))
        if _hash_alike(df, left_keys, side, keys) and not _runs(side, keys).where("__runs > 1").isEmpty():
            spread, dealt = _in_runs(spread, side, left_keys, keys)
            left_on, on = [*left_keys, _RUN], [*keys, _RUN]
    if not small and salt < 2:
        joined = df.join(side, _equal(df, left_keys, side, keys), lookup.how)
        return joined.select(*(quoted(name) for name in outputs))
    # An outer join of that side can neither broadcast the lookup nor split a hot key of
    # the main side.  So unmatched lookup rows are added separately; the main side is read
    # again for that, its key columns only, reduced to the distinct keys.
    kept = "left" if lookup.how == "full" else "inner"
    joined = _equi_join(spread, dealt, left_on, on, kept, small, salt, hot).select(*(quoted(name) for name in outputs))
    return joined.unionByName(_unmatched(df, side, left_keys, keys, small).select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields),
        *(quoted(name) for name in renamed.values()),
    ))


def _equal(left: DataFrame, left_keys: list[str], right: DataFrame, right_keys: list[str]) -> Column:
    return reduce(
        Column.__and__,
        (left[f"`{a}`"] == right[f"`{b}`"] for a, b in zip(left_keys, right_keys)),
    )


def hot_keys(df: DataFrame, keys: list[str]) -> tuple[list[int], int]:
    """Hashes of the keys too frequent for one task each, and the salts that the most frequent needs.

    A mergeable sketch of frequent items reads the key columns once, in a Spark job while
    the plan is built; at most half as many keys as there are tasks can be hot, and only
    those reach the driver.  Its counts are estimates, on which only the tasks' sizes
    depend, never the result.
    """
    tasks = _setting(df, "spark.sql.shuffle.partitions", 200)
    most = max(tasks // HOT_TASKS, 1)
    tracked = min(max(16 * tasks, 10_000), MOST_TRACKED)
    hashed = df.select(F.xxhash64(*map(quoted, keys)).alias("k"))
    rows, top = hashed.agg(F.count("*"), F.expr(f"approx_top_k(k, {min(most, tracked)}, {tracked})")).first()
    hot = {r["item"]: r["count"] for r in top or () if r["count"] * tasks > HOT_TASKS * rows}
    salt = min(tasks, -(-max(hot.values()) * tasks // rows)) if hot else 0
    return sorted(hot), salt


def _equi_join(
    df: DataFrame, side: DataFrame, left_keys: list[str], keys: list[str], how: str, small: bool, salt: int, hot: list[int] | None = None
) -> DataFrame:
    """Join on the keys; with ``salt``, hot keys (all, if ``hot`` does not name them by hash) go to so many tasks."""
    if small:
        return df.join(F.broadcast(side), _equal(df, left_keys, side, keys), how)
    if salt > 1:
        # A lookup row is repeated once per salt, so rows of one hot main key
        # spread over `salt` tasks.  The salt does not change the result.
        salts, row_salt = F.sequence(F.lit(0), F.lit(salt - 1)), _row_salt(df, left_keys, salt)
        if hot is not None:
            # Rows of other keys all have salt 0, and their lookup rows are not repeated.
            salts = F.when(F.xxhash64(*map(quoted, keys)).isin(hot), salts).otherwise(F.array(F.lit(0)))
            row_salt = F.when(F.xxhash64(*map(quoted, left_keys)).isin(hot), row_salt).otherwise(0)
        side = side.withColumn(_SALT, F.explode(salts)).hint("merge")
        df = df.withColumn(_SALT, row_salt)
        left_keys, keys = [*left_keys, _SALT], [*keys, _SALT]
    return df.join(side, _equal(df, left_keys, side, keys), how)


def _runs(side: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, in how many runs of ``RUN`` its lookup rows come."""
    return side.groupBy(*keys).agg(F.ceil(F.count("*") / RUN).cast("int").alias("__runs"))


def _in_runs(df: DataFrame, side: DataFrame, left_keys: list[str], keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with a further key: lookup rows of a key in runs, main rows once per run, sorted by key and run.

    Where few keys repeat on both sides, the rows made are far more than the rows read.
    Neighbours among them then hold few values over and over, which columnar files store
    in a fraction of a byte a row; the whole lookup for each main row repeats too seldom
    for that.  Equal keys must have equal values (see ``_hash_alike``).
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    dealt = side.withColumn(_RUN, F.floor((number - 1) / RUN).cast("int"))
    names = [f"__run_key{i}" for i in range(len(keys))]
    runs = F.broadcast(_runs(side, keys).withColumnsRenamed(dict(zip(keys, names))))
    copies = df.join(runs, _equal(df, left_keys, runs, names), "left")
    copies = copies.withColumn(_RUN, F.explode(F.sequence(F.lit(0), F.coalesce("__runs", F.lit(1)) - 1))).drop("__runs", *names)
    copies = copies.sortWithinPartitions(*map(quoted, left_keys), _RUN)
    # The optimizer drops a sort right below a join, but not below a generator.
    return copies.withColumn("__held", F.explode(F.array(F.lit(0)))), dealt


def _hash_alike(left: DataFrame, left_keys: list[str], right: DataFrame, right_keys: list[str]) -> bool:
    """Whether keys that are equal have equal hashes: not if a join casts one, nor for -0.0 and 0.0."""
    plain = (T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
    kinds = [(left.schema[a].dataType, right.schema[b].dataType) for a, b in zip(left_keys, right_keys)]
    return all(a == b and (isinstance(a, plain) or a == T.StringType()) for a, b in kinds)


def _row_salt(df: DataFrame, keys: list[str], salt: int) -> Column:
    """From the values of a row that are not keys, so a repeated task deals it alike."""
    unhashed = ("map", "variant")
    rest = [
        quoted(f.name)
        for f in df.schema.fields
        if f.name not in keys and not any(kind in f.dataType.simpleString() for kind in unhashed)
    ]
    return F.pmod(F.xxhash64(*(rest or map(quoted, keys))), F.lit(salt)).cast("int")


def _unmatched(df: DataFrame, side: DataFrame, left_keys: list[str], keys: list[str], small: bool) -> DataFrame:
    seen_names = [f"__seen{i}" for i in range(len(keys))]
    main_keys = df.select(*(quoted(name).alias(seen) for name, seen in zip(left_keys, seen_names)))
    known = side.select(*keys)
    known = F.broadcast(known) if small else known
    if small:
        main_keys = main_keys.join(known, _equal(main_keys, seen_names, known, keys), "left_semi")
    seen = main_keys.distinct()
    return side.join(seen, _equal(side, keys, seen, seen_names), "left_anti")


def _check(df: DataFrame, frame: DataFrame, lookup: Lookup) -> None:
    for left, right in lookup.on:
        if left not in df.columns:
            raise SpecError(f"lookup {lookup.name!r}: no main column {left!r}; there are {df.columns}")
        if right not in frame.columns:
            raise SpecError(f"lookup {lookup.name!r}: no lookup column {right!r}; there are {frame.columns}")
    unknown = [name for name in lookup.select if name not in frame.columns]
    if unknown:
        raise SpecError(f"lookup {lookup.name!r}: no lookup columns {unknown}; there are {frame.columns}")
    if lookup.unique and not repeated_keys(frame, [right for _, right in lookup.on]).isEmpty():
        raise SpecError(f"lookup {lookup.name!r}: keys repeat, so the join would multiply rows")
