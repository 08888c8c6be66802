"""Near-duplicate vectors: random-hyperplane hashing in several tables, exact cosine, components.

A vector's code in a table is the signs of its products with that table's random
hyperplanes.  Two vectors at angle t agree on a sign with probability 1 - t / pi, which
fixes the number of tables for a wanted recall at the threshold.  Vectors with the same
code are compared by their exact cosine in blocks of bounded size; a link is counted in
the first table in which both codes agree, so counts need no list of pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import Columns, attach, components, local_roots, map_groups, split_pairs, stage


@dataclass(frozen=True)
class Params:
    """Link at cosine ``threshold``; find a link with probability ``recall`` at the threshold.

    ``bucket_rows`` is the wanted number of rows a bucket of unrelated vectors holds, from
    which the number of hyperplanes follows; ``min_planes`` is the least number.
    """

    threshold: float = 0.9
    recall: float = 0.9999
    bucket_rows: int = 256
    min_planes: int = 8
    block_rows: int = 1024
    seed: int = 31

    def planes(self, rows: int) -> int:
        return max(self.min_planes, math.ceil(math.log2(max(rows, 1) / self.bucket_rows)) if rows else 0)

    def tables(self, planes: int) -> int:
        agree = (1 - math.acos(self.threshold) / math.pi) ** planes
        return math.ceil(math.log(1 - self.recall) / math.log(1 - agree))


def usable_vectors(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, v`` (floats if given as floats, else doubles) of vectors that take part, one row per id.

    Left out: null or empty vectors, vectors with null, NaN or infinite components, zero
    vectors, rows without an id.  Of rows that repeat an id the smallest vector stands.
    """
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kind = "array<float>" if dict(df.dtypes)[embedding] == "array<float>" else "array<double>"
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast(kind).alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & finite & F.exists(v, lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def hyperplanes(dims: int, tables: int, planes: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dims]).standard_normal((dims, tables * planes))


def codes(unit: np.ndarray, tables: int, planes: int, seed: int) -> np.ndarray:
    """One integer per row and table."""
    signs = (unit @ hyperplanes(unit.shape[1], tables, planes, seed)) > 0
    return signs.reshape(len(unit), tables, planes) @ (1 << np.arange(planes, dtype=np.int64))


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of equal length over their norms; scaled first, so that no square runs over or under."""
    rows = np.stack(vectors).astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _codes(tables: int, planes: int, seed: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            dims = frame["v"].map(len).to_numpy()
            for d in np.unique(dims):
                part = frame[dims == d]
                for start in range(0, len(part), 512):
                    rows = part.iloc[start : start + 512]
                    c = codes(units(rows["v"].to_numpy()), tables, planes, seed)
                    yield pd.DataFrame(
                        {
                            "vec_id": np.repeat(rows["vec_id"].to_numpy(), tables),
                            "dims": d,
                            "slot": np.tile(np.arange(tables), len(rows)),
                            "code": c.ravel(),
                        }
                    )

    return run


def _links(params: Params, tables: int, planes: int):
    def work(groups: Iterator[Columns]) -> Iterator[Columns]:
        for g in groups:
            left, right, slot = g["left"][0], g["right"][0], int(g["slot"][0])
            first = np.flatnonzero(g["chunk"] == left)
            second = first if left == right else np.flatnonzero(g["chunk"] == right)
            if not len(first) or not len(second):
                continue
            unit = units(g["v"])
            linked = unit[first] @ unit[second].T >= params.threshold
            if left == right:
                linked &= np.triu(np.ones(linked.shape, bool), 1)
            i, j = np.nonzero(linked)
            if not len(i):
                continue
            i, j = first[i], second[j]
            some = np.unique(np.r_[i, j])
            own = np.ones(len(i), bool)
            if slot:
                all_codes = np.zeros((len(unit), slot), np.int64)
                all_codes[some] = codes(unit[some], tables, planes, params.seed)[:, :slot]
                for t in range(slot):
                    own &= all_codes[i, t] != all_codes[j, t]
            names, at = np.unique(g["vec_id"], return_inverse=True)
            root = local_roots(len(names), at[i], at[j])
            links = np.bincount(np.r_[at[i[own]], at[j[own]]], minlength=len(names))
            some = np.unique(at[some])
            yield {"vec_id": names[some], "root": names[root[some]], "links": links[some]}

    return work


def links(vectors: DataFrame, params: Params) -> DataFrame:
    """Per block and vector with a link in it: ``vec_id, root, links`` (those first found there)."""
    planes = params.planes(vectors.count())
    tables = params.tables(planes)
    entries = vectors.mapInPandas(_codes(tables, planes, params.seed), "vec_id long, dims int, slot int, code long")
    entries = stage(entries, "codes")
    sizes = entries.groupBy("dims", "slot", "code").agg(F.count("*").alias("size"))
    sizes = stage(sizes.where("size > 1"), "buckets")  # a bucket with one row can hold no pair
    sized = attach(entries, sizes, ["dims", "slot", "code"])
    dealt = split_pairs(sized.join(vectors, "vec_id"), "code", "vec_id", F.col("size"), params.block_rows)
    dealt = dealt.drop("size")
    keys = ["dims", "slot", "code", "left", "right"]
    return stage(map_groups(dealt, keys, _links(params, tables, planes), "vec_id long, root long, links long"), "vector-links")


def dedup(
    embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", params: Params = Params()
) -> DataFrame:
    """Groups of near-equal vectors: ``vec_id, n_links, component_id, kept``, one row per id.

    Vectors are linked when their cosine, in double precision, is at least the threshold;
    only vectors of the same length are compared.  ``component_id`` is the smallest vec_id
    reachable by links; ``kept`` marks the row that names its component.

    Defined cases: a vector that is null, empty, zero or holds a null or non-finite
    component has no links and is its own component; rows that repeat an id are one
    vector, the smallest that can be used; rows with a null id are left out; an empty
    table gives no rows; other columns are not looked at.
    """
    vectors = stage(usable_vectors(embeddings, vec_id, embedding), "vectors")
    found = links(vectors, params)
    sums = found.groupBy("vec_id").agg(F.sum("links").alias("n_links"))
    groups = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    ids = embeddings.select(F.col(vec_id).cast("long").alias("vec_id")).where("vec_id is not null").distinct()
    out = ids.join(sums, "vec_id", "left").join(groups.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        (F.coalesce("component", "vec_id") == F.col("vec_id")).alias("kept"),
    )
