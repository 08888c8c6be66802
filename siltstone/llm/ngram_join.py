"""Near-duplicate texts by a MinHash-banded similarity join on word n-grams.

Every text becomes the set of its runs of five words (fewer words: one run of all).  Texts
with equal sets are one class.  The class's MinHash signature is cut into bands; the rows
and bands are chosen so that two sets of the threshold similarity share a band with the
wanted probability.  Classes that share a band are compared on their full sets, in blocks
of bounded size, and every link is counted in one block only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import Columns, as_documents, components, free_name, local_roots, map_groups, split_pairs, stage, text_key
from siltstone.llm.words import WordHashes, mix, words

ROW_BLOCK = 4096
UNION_BLOCK = 16_384


@dataclass(frozen=True)
class Params:
    """``n`` words a gram; link at Jaccard ``threshold``; share a band with probability ``recall``."""

    n: int = 5
    threshold: float = 0.8
    recall: float = 0.9999
    band_rows: int = 5
    block_classes: int = 512
    seed: int = 20_240

    @property
    def bands(self) -> int:
        """Fewest bands of ``band_rows`` minima that reach the recall at the threshold."""
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.threshold**self.band_rows))


def gram_set(text: bytes | None, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's n-grams; empty if it has no word."""
    found = hashes(words(text))
    if not len(found):
        return found
    with np.errstate(over="ignore"):
        if len(found) < n:
            found, n = found[None, :], len(found)
        else:
            found = np.lib.stride_tricks.sliding_window_view(found, n)
        grams = np.zeros(len(found), np.uint64)
        for k in range(n):
            grams = mix(grams + found[:, k] + np.uint64(k + 1))
    return np.unique(grams)


def signature(grams: np.ndarray, factors: np.ndarray, terms: np.ndarray, band_rows: int) -> np.ndarray:
    """One hash per band: ``band_rows`` minima of random linear maps of the set, mixed together."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for start in range(0, len(grams), ROW_BLOCK):
            part = mix(grams[start : start + ROW_BLOCK])
            np.minimum(least, (part[:, None] * factors + terms).min(axis=0), out=least)
        least = least.reshape(-1, band_rows)
        out = np.zeros(len(least), np.uint64)
        for k in range(band_rows):
            out = mix(out + least[:, k] + np.uint64(k + 1))
    return out.view(np.int64)


def _signatures(params: Params):
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng(params.seed)
        size = params.bands * params.band_rows
        factors = rng.integers(0, 2**63, size, np.uint64) * np.uint64(2) + np.uint64(1)
        terms = rng.integers(0, 2**64, size, np.uint64)
        hashes = WordHashes()
        for texts in parts:
            keys, counts, bands = [], [], []
            known: dict[bytes, np.ndarray] = {}
            for text in texts:
                grams = gram_set(text, params.n, hashes)
                counts.append(len(grams))
                key = xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None
                keys.append(key)
                if key is not None and key not in known:
                    known[key] = signature(grams, factors, terms, params.band_rows)
                bands.append(known.get(key))
            yield pd.DataFrame({"key": keys, "grams": counts, "bands": bands})

    return F.pandas_udf(run, "key binary, grams long, bands array<bigint>")


def _gram_sets(params: Params):
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = WordHashes()
        for texts in parts:
            yield pd.Series([gram_set(t, params.n, hashes).view(np.int64) for t in texts])

    return F.pandas_udf(run, "array<bigint>")


def overlaps(sets: list[np.ndarray], other: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of every set with every other, in slices of the joint vocabulary.

    Without ``other`` the sets are compared among themselves (the diagonal has no meaning).
    """
    listed = sets if other is None else [*sets, *other]
    flat = np.concatenate(listed)
    owner = np.repeat(np.arange(len(listed)), [len(s) for s in listed])
    _, ids, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = counts[ids] > 1  # an element of one set is in no intersection
    order = np.argsort(ids[shared], kind="stable")
    ids, owner = ids[shared][order], owner[shared][order]
    out = np.zeros((len(sets), len(sets if other is None else other)), np.int64)
    if not len(ids):
        return out
    ids = np.cumsum(np.r_[False, ids[1:] != ids[:-1]])
    width = min(UNION_BLOCK, int(ids[-1]) + 1)
    for start in range(0, int(ids[-1]) + 1, width):
        a, b = np.searchsorted(ids, [start, start + width])
        grid = np.zeros((len(listed), width), np.float32)
        grid[owner[a:b], ids[a:b] - start] = 1
        out += np.rint(grid @ grid.T if other is None else grid[: len(sets)] @ grid[len(sets) :].T).astype(np.int64)
    return out


def _first_shared(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray, bucket: int) -> np.ndarray:
    """Whether ``bucket`` is the smallest that both members of each pair are in."""
    lists_a, lists_b = [set(x[x < bucket].tolist()) for x in a], [set(x[x < bucket].tolist()) for x in b]
    return np.fromiter((lists_a[x].isdisjoint(lists_b[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True)), bool, len(i))


def _links(threshold: float):
    def work(groups: Iterator[Columns]) -> Iterator[Columns]:
        for g in groups:
            left, right, bucket = g["left"][0], g["right"][0], int(g["bucket"][0])
            first = np.flatnonzero(g["chunk"] == left)
            second = first if left == right else np.flatnonzero(g["chunk"] == right)
            if not len(first) or not len(second):
                continue
            sets = [g["grams"][k] for k in first], [g["grams"][k] for k in second]
            sizes = [np.array([len(x) for x in s]) for s in sets]
            met = overlaps(sets[0]) if left == right else overlaps(*sets)
            linked = met >= threshold * (sizes[0][:, None] + sizes[1] - met) - 1e-9
            if left == right:
                linked &= np.triu(np.ones(linked.shape, bool), 1)
            i, j = np.nonzero(linked)
            if not len(i):
                continue
            nodes = np.r_[g["node"][first], g["node"][second]].astype(np.int64)
            copies = np.r_[g["copies"][first], g["copies"][second]]
            own = _first_shared([g["buckets"][k] for k in first], [g["buckets"][k] for k in second], i, j, bucket)
            j = j + len(first)
            # Nodes in order of their ids, so that the smallest id of a component is its root.
            names, at = np.unique(nodes, return_inverse=True)
            root = local_roots(len(names), at[i], at[j])
            links = np.zeros(len(names), np.int64)
            np.add.at(links, at[i[own]], copies[j[own]])
            np.add.at(links, at[j[own]], copies[i[own]])
            some = np.unique(np.r_[at[i], at[j]])
            yield {"node": names[some], "root": names[root[some]], "links": links[some]}

    return work


def classes_and_links(rows: DataFrame, texts: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets, and for every linked class its number of linked documents and a root.

    ``rows`` holds ``x, y, doc_id, key, bands`` per document, ``texts`` holds ``x, y, text``.
    """
    grouped = rows.where("key is not null").groupBy("key").agg(
        F.count("*").alias("copies"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "x", "y")).alias("first"),
        F.any_value("bands").alias("bands"),
    )
    classes = stage(grouped.select(F.monotonically_increasing_id().alias("node"), "key", "copies", "first", "bands"), "classes")
    entries = classes.select("node", F.posexplode("bands").alias("band", "hash"))
    # Buckets with the same members give the same comparisons: one of them is kept.
    buckets = entries.groupBy("band", "hash").agg(
        F.count("*").alias("size"), F.min("node").alias("low"), F.bit_xor(F.xxhash64("node")).alias("members")
    )
    kept = buckets.where("size > 1").groupBy("size", "low", "members").agg(F.min(F.struct("band", "hash")).alias("at"))
    kept = stage(kept.select(F.monotonically_increasing_id().alias("bucket"), "at.*", "size"), "buckets")
    members = stage(entries.join(kept, ["band", "hash"]).select("node", "bucket", "size"), "members")
    lists = members.groupBy("node").agg(F.collect_list("bucket").alias("buckets"))  # at most one per band
    found = lists.join(classes.select("node", "copies", "first.x", "first.y"), "node").join(texts, ["x", "y"])
    found = found.dropDuplicates(["x", "y"]).withColumn("grams", _gram_sets(params)(F.col("text").cast("binary")))
    found = stage(found.select("node", "copies", "buckets", "grams"), "sets")
    sized = members.join(found, "node")
    dealt = split_pairs(sized, "bucket", "node", F.col("size"), params.block_classes).drop("size")
    links = map_groups(dealt, ["bucket", "left", "right"], _links(params.threshold), "node long, root long, links long")
    return classes, stage(links, "gram-links")


def join(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Params = Params()) -> DataFrame:
    """Near-duplicate groups: ``doc_id, class_id, n_links, n_copies, kept``, one row per document.

    Two documents are linked when the Jaccard similarity of their n-gram sets is at least
    the threshold.  ``class_id`` is the smallest doc_id reachable by links, the document's
    own if there is none; ``n_links`` counts the other documents linked directly, equal
    ones included; ``n_copies`` counts documents with the same set, itself included.
    ``kept`` marks documents whose id is their class_id.

    Defined cases: null text, empty text and text without words link with nothing (and
    n_copies is 1); a null doc_id is a member like any other and names a class only if
    all its members are null; repeated rows are copies of each other and each get a row;
    an empty table gives no rows; other columns are not looked at.
    """
    rows, _, per_class = grouped(documents, doc_id, text, params)
    # Written first, the classes are a plain scan, and AQE can split the tasks of a hot class.
    return rows.join(stage(per_class, "classes-named"), "key", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce(F.col("class_id").eqNullSafe(F.col("doc_id")), F.lit(True)).alias("kept"),
    )


def grouped(documents: DataFrame, doc_id: str, text: str, params: Params) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged rows, texts, and per class: copies, links, class_id and the one row (x, y) its group keeps."""
    docs = as_documents(documents, doc_id, text)
    texts = docs.select(*[c.alias(n) for c, n in zip(text_key("doc_id", "text"), "xy", strict=True)], "doc_id", "text")
    sketch = _signatures(params)(F.col("text").cast("binary"))
    rows = stage(texts.select("x", "y", "doc_id", sketch.alias("s")).select("x", "y", "doc_id", "s.key", "s.bands"), "rows")
    classes, links = classes_and_links(rows, texts.select("x", "y", "text"), params)
    sums = links.groupBy("node").agg(F.sum("links").alias("links"))
    groups = stage(components(links.select(F.col("node").alias("a"), F.col("root").alias("b"))), "groups")
    named = classes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    heads = named.groupBy("component").agg(F.min("first").alias("head"))
    per_class = named.join(heads, "component").join(sums, "node", "left").select(
        "key", "copies", F.coalesce("links", F.lit(0)).alias("links"),
        F.col("head.doc_id").alias("class_id"), F.col("head.x").alias("head_x"), F.col("head.y").alias("head_y"),
        (F.col("first") == F.col("head")).alias("is_head"),
    )
    return rows, texts, per_class


def one_of_each(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Params = Params()) -> DataFrame:
    """The documents with one left of each near-duplicate group: the one of the smallest doc_id.

    Documents without words all stay.  Of rows that repeat id and text one stays.
    """
    x, y = free_name(documents, "key_x"), free_name(documents, "key_y")
    _, _, per_class = grouped(documents, doc_id, text, params)
    heads = per_class.where("is_head").select(F.col("head_x").alias(x), F.col("head_y").alias(y))
    keyed = documents.withColumns(dict(zip((x, y), text_key(doc_id, text), strict=True)))
    has_words = F.coalesce(F.col(text).rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]"), F.lit(False))
    left = keyed.where(has_words).join(heads, [x, y], "left_semi").dropDuplicates([x, y])
    return left.unionByName(keyed.where(~has_words)).drop(x, y)
