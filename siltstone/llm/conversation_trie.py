"""The trie of conversation prefixes, by digests of blocks of turns.

A prefix is told by two sums of 64-bit hashes of (turn number, role, text) over its turns.
Sums can be taken in parts: a conversation's turns are summed up in blocks of ``block`` turns,
and running sums over blocks give its prefix at every block's edge.  Conversations are first
grouped by (block number, prefix before, prefix after): one class is one way through a block.
Where a prefix has a single class that fills the block, nobody diverges inside, and all its
turns' nodes have the class's members.  Only elsewhere is one member of each class taken turn
by turn, and the classes regrouped at every turn.

Sums over subtrees come from sums over members, so depth costs nothing.  A conversation owns
the nodes whose smallest member it is: those below some depth of its own path.  With T the
bytes of its turns, O those of the nodes it owns, and B the bytes before a node, the texts
below the node come to sum(T) - n * B counted once per member, and to
sum(O) - O(owner) + T(owner) - B counted once per node; a leaf belongs to one owner.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import stage


@dataclass(frozen=True)
class Params:
    """``block`` turns a block."""

    block: int = 4


TOTAL = "decimal(38,0)"
COPIES = 1024  # equal rows of a conversation that one row is unfolded into at once
IDS_BITS = 12  # ids are joined to strings in ranges of 2^12


def running_sums(df: DataFrame, group: list[str], buckets: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Sums ``before_<value>`` over the rows before each row of its group, in (buckets, order).

    ``buckets`` are columns without nulls that rise with the order, coarse to fine; rows
    meet in one task within a finest bucket only, above that sums of buckets do.
    """

    def up_to(keys: list[str], by: list[str]):
        return Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)

    totals = stage(df.groupBy(*group, *buckets).agg(*(F.sum(v).cast(TOTAL).alias(v) for v in values)), "bucket-sums")
    before = None
    for k, bucket in enumerate(buckets):
        keys = [*group, *buckets[:k]]
        level = totals.groupBy(*keys, bucket).agg(*(F.sum(v).cast(TOTAL).alias(v) for v in values))
        level = level.select(*keys, bucket, *(F.coalesce(F.sum(v).over(up_to(keys, [bucket])), F.lit(0)).cast(TOTAL).alias(f"{v}_{k}") for v in values))
        before = level if before is None else before.join(level, keys)
    offsets = [sum((F.col(f"{v}_{k}") for k in range(1, len(buckets))), F.col(f"{v}_0")).cast(TOTAL).alias(f"above_{v}") for v in values]
    before = stage(before.select(*group, *buckets, *offsets), "bucket-offsets")
    w = up_to([*group, *buckets], order)
    inside = df.withColumns({f"before_{v}": F.coalesce(F.sum(v).over(w), F.lit(0)).cast(TOTAL) for v in values})
    joined = inside.join(before, [*group, *buckets])
    sums = [(F.col(f"before_{v}") + F.col(f"above_{v}")).cast(TOTAL).alias(f"before_{v}") for v in values]
    return joined.select(*df.columns, *sums)


def _listed(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, pos, d1, d2, size``: turns numbered from 0 in each conversation, null turns first.

    Equal rows are counted before they are numbered, so copies of one turn are split too.
    """
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.xxhash64(r, t).alias("d1"), F.xxhash64(t, F.lit("second"), r).alias("d2"), F.octet_length(t).cast("long").alias("size"),
    )
    rows = rows.groupBy("conv", "turn", "d1", "d2", "size").agg(F.count("*").alias("copies"))
    least = F.lit(-(2**63))
    rows = rows.withColumns({
        "b0": F.coalesce(F.shiftright("turn", 10), F.lit(-(2**54))),
        "b1": F.coalesce("turn", least), "b2": F.shiftright("d1", 52),
    })
    rows = running_sums(stage(rows, "turns"), ["conv"], ["b0", "b1", "b2"], ["d1", "d2", "size"], ["copies"])
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    last = F.least(F.col("part") + COPIES, F.col("copies")) - 1
    rows = rows.withColumn("copy", F.explode(F.sequence(F.col("part"), last)))
    return rows.select("conv", (F.col("before_copies") + F.col("copy")).cast("long").alias("pos"), "d1", "d2", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations to make a trie of, as turns, and their ids.

    Conversation c starts with the first h turns of c - c % 5, h being the CRC-32 of c in
    decimal modulo 9, and goes on with its own turns after its first h.
    """
    ids = turns.groupBy("conv").agg(F.count("*").alias("n"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    ids = stage(ids.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % 5).alias("base")), "ids")
    bases = ids.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    led = stage(ids.join(bases, "base", "left").select("conv", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("led")), "led")
    rest = ["d1", "d2", "size"]
    own = turns.join(led, "conv").where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("led")).alias("pos"), *rest)
    heads = turns.where("pos < 8").withColumnRenamed("conv", "base")
    return own.unionByName(led.join(heads, "base").where("pos < h").select("conv", "pos", *rest)), ids.select("conv")


KEY = ["depth", "n1", "n2"]


def _steps(classes: DataFrame, block: int, *kept: str) -> DataFrame:
    """A row per turn of each class: the prefix up to it, the one before it, bytes before it and its own."""

    def upto(i: Column, start: str, field: str) -> Column:
        return F.aggregate(F.slice("turns", 1, i), F.col(start), lambda a, x: (a + x[field]).cast(TOTAL))

    def step(i: Column) -> Column:
        return F.struct(
            (F.col("k") * block + i).alias("depth"), upto(i, "p1", "f1").alias("n1"), upto(i, "p2", "f2").alias("n2"),
            upto(i - 1, "p1", "f1").alias("m1"), upto(i - 1, "p2", "f2").alias("m2"),
            upto(i - 1, "s", "size").cast("long").alias("before"),
        )

    steps = F.transform(F.sequence(F.lit(1), F.size("turns")), step)
    return classes.select(*kept, F.inline(steps))


def _ends(ids: DataFrame) -> DataFrame:
    """Per prefix at which conversations end, the SHA-256 of their ids in order, comma-joined.

    Ranges of ids are joined first; a prefix with many of them is digested as a stream,
    which a digest of one string cannot do in parts.
    """
    in_order = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    parts = ids.withColumn("range", F.shiftright("conv", IDS_BITS)).groupBy(*KEY, "range").agg(in_order.alias("ids"))
    parts = stage(parts, "ends")
    prefixes = parts.groupBy(*KEY).agg(F.count("*").alias("ranges"), F.any_value("ids").alias("ids"))
    one = prefixes.where("ranges = 1").select(*KEY, F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))
    many = parts.join(stage(prefixes.where("ranges > 1").select(*KEY), "long-ends"), KEY).select(*(F.col(k).cast("string").alias(k) for k in KEY), "range", "ids")

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, sha = None, hashlib.sha256()
        for frame in frames:
            done = []
            for *key, ids_ in zip(*(frame[c] for c in (*KEY, "ids")), strict=True):
                if last is not None and key != last:
                    done.append((*last, sha.hexdigest()))
                    sha = hashlib.sha256()
                sha.update(("," if key == last else "").encode() + ids_.encode())
                last = key
            yield pd.DataFrame(done, columns=[*KEY, "ends_sha256"])
        if last is not None:
            yield pd.DataFrame([(*last, sha.hexdigest())], columns=[*KEY, "ends_sha256"])

    dealt = many.repartition(*(F.col(k) for k in KEY)).sortWithinPartitions(*KEY, "range")
    long_ = dealt.mapInPandas(digest, "depth string, n1 string, n2 string, ends_sha256 string")
    return one.unionByName(long_.select(F.col("depth").cast("long"), *(F.col(k).cast(TOTAL).alias(k) for k in ("n1", "n2")), "ends_sha256"))


def trie(turns: DataFrame, ids: DataFrame, params: Params = Params()) -> DataFrame:
    """The trie of conversations given as ``conv, pos, d1, d2, size`` and their ids; see ``prefix_trie``."""
    b = params.block
    rows = turns.withColumns({
        "k": F.floor(F.col("pos") / b), "f1": F.xxhash64("pos", "d1", "d2").cast(TOTAL), "f2": F.xxhash64("d2", F.lit("second"), "pos", "d1").cast(TOTAL),
        "size": F.col("size").cast(TOTAL),
    })
    told = F.transform(F.sort_array(F.collect_list(F.struct("pos", "f1", "f2", "size"))), lambda x: x.dropFields("pos"))
    sums = [F.sum(c).cast(TOTAL).alias(c) for c in ("f1", "f2", "size")]
    blocks = stage(rows.groupBy("conv", "k").agg(told.alias("turns"), *sums), "blocks").withColumn("wide", F.shiftright("k", 10))
    blocks = running_sums(blocks, ["conv"], ["wide"], ["k"], ["f1", "f2", "size"])
    edges = [F.col(f"before_{c}").alias(a) for c, a in (("f1", "p1"), ("f2", "p2"), ("size", "s"))]
    after = [(F.col(f"before_{c}") + F.col(c)).cast(TOTAL).alias(a) for c, a in (("f1", "q1"), ("f2", "q2"))]
    blocks = stage(blocks.select("conv", "k", "turns", "size", *edges, *after), "prefixes")
    way = ["k", "p1", "p2", "q1", "q2"]

    # Classes of equal blocks after equal prefixes; an unfinished block has another sum.
    classes = blocks.groupBy(*way).agg(F.count("*").alias("n"), F.min("conv").alias("conv"), F.any_value("turns").alias("turns"), F.any_value("s").alias("s"))
    classes = stage(classes, "classes")
    single = classes.groupBy("k", "p1", "p2").agg(F.count("*").alias("ways"), *(F.any_value(c).alias(c) for c in ("q1", "q2")), F.any_value(F.size("turns")).alias("length"))
    single = stage(single.where((F.col("ways") == 1) & (F.col("length") == b)).select(*way), "undivided")

    ident = [*KEY, "m1", "m2", "before"]
    whole = _steps(classes.join(single, way, "left_semi"), b, "n", "conv")
    divided = _steps(classes.join(single, way, "left_anti"), b, "n", "conv")
    divided = divided.groupBy(*ident).agg(F.sum("n").alias("n"), F.min("conv").alias("conv"))
    root = ids.agg(F.count("*").alias("n"), F.min("conv").alias("conv")).where("n > 0")
    zero, none = F.lit(0).cast(TOTAL), F.lit(None).cast(TOTAL)
    root = root.select(F.lit(0).cast("long").alias("depth"), zero.alias("n1"), zero.alias("n2"), none.alias("m1"), none.alias("m2"), F.lit(0).cast("long").alias("before"), "n", "conv")
    nodes = stage(root.unionByName(whole.select(*root.columns)).unionByName(divided.select(*root.columns)), "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("m1").alias("n1"), F.col("m2").alias("n2")).agg(F.count("*").alias("n_children"))
    nodes = stage(nodes.join(children, KEY, "left").fillna(0, "n_children"), "counted-nodes")

    # What each conversation has: bytes in all, bytes of the nodes it owns, a leaf or none; where it ends.
    owned = nodes.groupBy("conv").agg(F.min("before").alias("first"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    ended = rows.groupBy("conv").agg(F.count("*").alias("depth"), *sums)
    ended = ids.join(ended, "conv", "left").select("conv", F.coalesce("depth", F.lit(0)).alias("depth"), *(F.coalesce(c, zero).alias(a) for c, a in (("f1", "n1"), ("f2", "n2"), ("size", "total"))))
    members = ended.join(owned, "conv", "left").select("conv", *KEY, F.col("total").cast("long").alias("total"), F.coalesce(F.col("total") - F.col("first"), F.lit(0)).cast("long").alias("own"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    members = stage(members, "members")

    below = [F.sum(c).alias(f"sum_{c}") for c in ("total", "own", "leaf")]
    again = blocks.select("conv", *way).join(members.select("conv", "total", "own", "leaf"), "conv").groupBy(*way).agg(*below)
    again = stage(classes.select(*way, "turns", "s").join(again, way), "class-sums")
    sums_ = [f"sum_{c}" for c in ("total", "own", "leaf")]
    parts = [_steps(again.join(single, way, how), b, *sums_).select(*KEY, *sums_) for how in ("left_semi", "left_anti")]
    divided = parts[1].groupBy(*KEY).agg(*(F.sum(c).alias(c) for c in sums_))
    top = members.agg(*below).select(F.lit(0).cast("long").alias("depth"), zero.alias("n1"), zero.alias("n2"), *sums_)
    subtrees = stage(top.unionByName(parts[0]).unionByName(divided), "subtrees")

    owner = members.select("conv", F.col("total").alias("owner_total"), F.col("own").alias("owner_own"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("n1").alias("m1"), F.col("n2").alias("m2"), F.col("conv").alias("parent_conv_id"))
    out = nodes.join(subtrees, KEY).join(_ends(members.select("conv", *KEY)), KEY, "left")
    out = stage(out, "summed-nodes").join(owner, "conv")
    out = stage(out, "owned-nodes").join(above, ["depth", "m1", "m2"], "left")
    once = F.col("sum_own") - F.col("owner_own") + F.col("owner_total") - F.col("before")
    return out.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", F.col("sum_leaf").alias("n_leaves"),
        (F.col("sum_total") - F.col("n") * F.col("before") - once).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def prefix_trie(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    params: Params = Params(), rebuild: bool = False,
) -> DataFrame:
    """A row per distinct sequence of first turns (role and text), down from the textless root.

    ``conv_id`` is the smallest conversation that starts with it (a member), ``depth`` its
    number of turns, ``parent_conv_id`` the same of the node above (null for the root), then
    ``n_convs`` members, ``n_children``, ``n_leaves`` (childless nodes of the subtree, itself
    included), ``saved_tokens`` (over the subtree, members but one times the bytes of the
    last text) and ``ends_sha256`` (of the ids that end here, ascending, comma-joined).
    ``rebuild`` makes the trie of conversations put together as ``rebuilt`` says.

    Prefixes are told apart by 128 bits, which are never reversed or cut.

    Defined cases: a null role or text is empty; null turns come first, turns of equal
    number in the order of their hashes; equal rows are as many turns; rows without a
    conversation id take no part; an empty table has no root; other columns are not
    looked at.
    """  # noqa: D205
    turns = stage(_listed(conversations, conv_id, turn, role, text), "listed")
    if rebuild:
        turns, ids = rebuilt(turns)
        return trie(stage(turns, "rebuilt"), ids, params)
    return trie(turns, turns.select("conv").distinct(), params)
