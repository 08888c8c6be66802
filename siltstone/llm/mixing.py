"""Mixing sources to target weights with a low-discrepancy schedule, in DataFrame operations only.

Slot ``i`` of the schedule takes the point ``frac((i + 1/2) * golden ratio)``, which falls
into one source's share of the interval from 0 to 1.  The slots of a source are ranked;
the slot of rank ``k`` takes the ``k``-th block of equally many words of that source's
shuffled documents, laid end to end and repeated.  Documents are cut at block borders.
A source gets exactly the slots its target needs: the few that the schedule is short of,
by its discrepancy, follow at the end, and the last block is cut at the target.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import attach, free_name, running_total, stage, text_key

WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = 0.6180339887498949
SHARE_BINS = 4096


@dataclass(frozen=True)
class Params:
    """``weights`` repeat over the sources in code point order; a source repeats ``repeats`` times at most."""

    weights: tuple[int, ...] = (5, 2, 1)
    repeats: int = 3
    block_words: int = 512
    bucket_docs: int = 128
    seed: str = "mix"


def count_words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Rows numbered from 0 in a total order, without bringing them into one task."""
    width = 1 << 33  # ids are partition * 2^33 + place in the partition
    placed = stage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("part", F.shiftright("id", 33)).withColumn("place", F.col("id") % width)
    parts = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = running_total(parts.withColumn("all", F.lit(0)), ["all"], [], ["part"], "n", "before").select("part", "before")
    return placed.join(F.broadcast(before), "part").withColumn(out, F.col("before") + F.col("place")).drop("id", "part", "place", "before")


def sized(documents: DataFrame, doc_id: str, source: str, text: str, params: Params, keys: bool) -> DataFrame:
    """Staged ``row, doc_id, source, size, shuffle`` (a hash of the id alone); with ``keys`` those of the text too."""
    salted = F.concat(F.lit(params.seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    shuffle = F.conv(F.substring(F.md5(salted), 1, 15), 16, 10).cast("long")
    return stage(
        documents.select(
            F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            count_words(F.col(text)).alias("size"), shuffle.alias("shuffle"),
            *[c.alias(n) for c, n in zip(text_key(doc_id, text), ("key_x", "key_y"), strict=True) if keys],
        ),
        "sizes",
    )


def targets(docs: DataFrame, params: Params) -> DataFrame:
    """Per source: ``sid, source, source_size, docs, weight, target``.

    Shares follow the weights; a share above ``repeats`` times the source's size stops
    there and the rest is shared anew, until none is above.  One pair of sums per round
    reaches the driver.
    """
    sources = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    sources = ranked(sources, [F.col("source").isNull(), F.col("source")], "sid")
    weight = F.element_at(F.array(*[F.lit(w) for w in params.weights]), (F.col("sid") % len(params.weights) + 1).cast("int"))
    sources = stage(sources.withColumn("weight", weight.cast("long")), "sources")
    most = F.col("source_size") * params.repeats
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    left, weights, seen = total, None, None
    while True:
        share = F.col("weight") * F.lit(left) / F.lit(weights) if weights else None
        above = (most < share) if weights else F.lit(False)
        full, rest = sources.agg(F.sum(F.when(above, most)), F.sum(F.when(~above, F.col("weight")))).first()
        if (full, rest) == seen or not rest:
            break
        seen = (full, rest)
        left, weights = total - (full or 0), rest
    share = F.col("weight") * F.lit(left) / F.lit(weights) if weights else F.lit(0.0)
    return sources.withColumn("target", F.least(most.cast("double"), share.cast("double")))


def schedule(spark: SparkSession, sources: DataFrame, params: Params) -> DataFrame:
    """Slots ``slot, sid, rank``: as many per source as its target takes blocks."""
    needs = sources.select(
        "sid", F.floor("target").alias("words"), F.ceil(F.floor("target") / params.block_words).alias("blocks")
    ).where("blocks > 0")
    needs = running_total(
        needs.withColumn("all", F.lit(0)).withColumn("bucket", F.floor(F.col("sid") / 1024)), ["all"], ["bucket"], ["sid"], "words", "low"
    )
    needs = stage(needs, "shares")
    total, slots = needs.agg(F.sum("words"), F.sum("blocks")).first()
    if not total:
        return spark.range(0).selectExpr("id AS slot", "id AS sid", "id AS rank")
    share = needs.select(
        "sid", "blocks", (F.col("low") / total).alias("low"), ((F.col("low") + F.col("words")) / total).alias("high")
    )
    bins = share.withColumn(
        "bin", F.explode(F.sequence(F.floor(F.col("low") * SHARE_BINS), F.least(F.floor(F.col("high") * SHARE_BINS), F.lit(SHARE_BINS))))
    )
    x = (F.col("id") + F.lit(0.5)) * F.lit(GOLDEN)
    points = spark.range(slots).select(F.col("id").alias("slot"), (x - F.floor(x)).alias("x"))
    points = points.withColumn("bin", F.floor(F.col("x") * SHARE_BINS))
    placed = points.join(bins, "bin").where("x >= low AND x < high").select("slot", "sid", "blocks")
    placed = placed.withColumn("stretch", F.floor(F.col("slot") / 4096)).withColumn("one", F.lit(1))
    placed = running_total(placed, ["sid"], ["stretch"], ["slot"], "one", "rank").where("rank < blocks").select("slot", "sid", "rank")
    placed = stage(placed, "slots")
    have = placed.groupBy("sid").agg(F.count("*").alias("have"))
    short = needs.join(have, "sid", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < blocks")
    added = short.withColumn("rank", F.explode(F.sequence(F.col("have"), F.col("blocks") - 1)))
    # Numbers beyond the schedule's own, the same in every run.
    number = F.lit(slots) + F.col("sid") + F.col("rank") * F.lit(sources.count())
    return placed.unionByName(added.select(number.alias("slot"), "sid", F.col("rank").cast("long").alias("rank")))


def plan(
    documents: DataFrame, doc_id: str, source: str, text: str, params: Params, keys: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged documents, sources, and the mix: pieces ``slot, rank, row, first_word, n_words``."""
    docs = sized(documents, doc_id, source, text, params, keys)
    sources = stage(targets(docs, params), "targets")
    known = sources.select(
        F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"), "sid", "source_size", "target",
        F.greatest(F.ceil(F.col("docs") / params.bucket_docs), F.lit(1)).alias("n_buckets"),
    )
    keyed = docs.withColumn("none", F.col("source").isNull()).withColumn("name", F.coalesce("source", F.lit("")))
    keyed = attach(keyed, known, ["none", "name"]).drop("none", "name")
    # The shuffle has 60 bits; its 28 leading ones are enough to deal the buckets in order.
    bucket = F.floor(F.shiftright("shuffle", 32) * F.col("n_buckets") / 2**28)
    laid = running_total(
        keyed.withColumn("bucket", bucket).withColumn("coarse", F.floor(bucket / 1024)),
        ["sid"], ["coarse", "bucket"], ["shuffle", "doc_id", "size", "row"], "size", "start",
    )
    laid = laid.where("size > 0").withColumn("words", F.floor("target"))
    epochs = laid.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(params.repeats - 1))))
    epochs = epochs.withColumn("from", F.col("start") + F.col("epoch") * F.col("source_size")).where("from < words")
    epochs = epochs.withColumn("to", F.least(F.col("from") + F.col("size"), F.col("words")))
    b = params.block_words
    blocks = epochs.withColumn("rank", F.explode(F.sequence(F.floor(F.col("from") / b), F.floor((F.col("to") - 1) / b))))
    first, last = F.greatest(F.col("from"), F.col("rank") * b), F.least(F.col("to"), (F.col("rank") + 1) * b)
    pieces = blocks.select("row", "sid", "rank", (first - F.col("from")).alias("first_word"), (last - first).alias("n_words"))
    slots = schedule(documents.sparkSession, sources, params)
    mix = pieces.join(slots, ["sid", "rank"]).select("slot", "rank", "row", "first_word", "n_words")
    return keyed, sources, mix


def mix(
    documents: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", params: Params = Params()
) -> DataFrame:
    """How much of each document the mix takes: ``doc_id, size, source_size, target, taken``.

    Sizes are words; sources in code point order, null last, get the weights in turn and
    share as many words as there are in all, none more than ``repeats`` times its own.
    ``taken`` adds up the document's pieces in the schedule.

    Defined cases: a null or empty text has size 0 and nothing is taken; a null source is
    a source of its own; rows that repeat an id are documents of their own, laid one after
    the other; a source without words has target 0; an empty table gives no rows; other
    columns are not looked at.
    """
    docs, _, pieces = plan(documents, doc_id, source, text, params)
    taken = pieces.groupBy("row").agg(F.sum("n_words").alias("taken"))
    return docs.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed(
    documents: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", params: Params = Params()
) -> DataFrame:
    """The documents as often as the mix takes them, whole: a document cut by a target's end counts as taken.

    Documents without words are in no block and drop out.  Rows that repeat id and text
    come out as often as all of them together are taken.
    """
    x, y, copies = (free_name(documents, n) for n in ("key_x", "key_y", "copies"))
    docs, _, pieces = plan(documents, doc_id, source, text, params, keys=True)
    taken = pieces.groupBy("row").agg(F.sum("n_words").alias("taken"))
    counts = docs.join(taken, "row").groupBy("key_x", "key_y").agg(
        F.sum(F.ceil(F.col("taken") / F.col("size"))).alias(copies), F.count("*").alias("rows")
    )
    counts = counts.select(F.col("key_x").alias(x), F.col("key_y").alias(y), copies)
    keyed = documents.withColumns(dict(zip((x, y), text_key(doc_id, text), strict=True))).join(counts, [x, y])
    # Equal rows share one count: it stays with the first of them.
    one = keyed.dropDuplicates([x, y])
    return one.withColumn(copies, F.explode(F.array_repeat(F.lit(True), F.col(copies).cast("int")))).drop(x, y, copies)
