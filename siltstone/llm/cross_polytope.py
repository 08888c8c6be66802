"""Nearest neighbours by inner product with cross-polytope hashing.

A table applies three rounds of random signs and a fast Hadamard transform, a
pseudo-rotation, to every unit vector; its bucket is the signed axis the result is
nearest to.  A query probes, in each table, the buckets of its largest coordinates.
Candidates are ranked by the exact inner product of the original vectors.  Vectors of
unequal norms are split into bands of similar norm, each with rotations of its own.

The ``k``-th inner product a query has found and a band's largest norm bound the cosine of
what it may still miss there.  Where a vector of that cosine is not found with probability
``recall``, or fewer than ``k`` rows were found, the query is compared with the whole band.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import Columns, map_groups, stage
from siltstone.llm.embedding_dedup import usable_vectors


MOST_BANDS = 16
MOST_LENGTHS = 1000


@dataclass(frozen=True)
class Params:
    """``tables`` pseudo-rotations, ``probes`` buckets a query looks into in each, ``k`` neighbours.

    Unrelated vectors lie far apart, and the nearest of them are hardly nearer than the
    rest; queries whose probes do not give ``recall`` there are compared with all rows.
    Buckets above ``block_rows`` rows are searched in parts.
    """

    k: int = 20
    tables: int = 8
    probes: int = 16
    block_rows: int = 4096
    seed: int = 77
    recall: float = 0.95


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal Walsh-Hadamard transform of the rows; their length is a power of two."""
    rows, dims = x.shape
    step = 1
    while step < dims:
        x = x.reshape(rows, -1, 2, step)
        x = np.concatenate([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(rows, dims)
        step *= 2
    return x / np.sqrt(dims)


def rotations(unit: np.ndarray, tables: int, seed: int) -> Iterator[np.ndarray]:
    """The rows under each table's pseudo-rotation, zero-padded to a power of two."""
    dims = 1 << max(1, (unit.shape[1] - 1).bit_length())
    padded = np.zeros((len(unit), dims))
    padded[:, : unit.shape[1]] = unit
    signs = np.random.default_rng([seed, dims]).choice([-1.0, 1.0], (tables, 3, dims))
    for table in signs:
        x = padded
        for row in table:
            x = hadamard(x * row)
        yield x


def nearest_axes(rotated: np.ndarray, count: int) -> np.ndarray:
    """Codes 2 * axis + (1 if negative) of the ``count`` signed axes nearest to each row, nearest first."""
    both = np.stack([rotated, -rotated], axis=2).reshape(len(rotated), -1)
    count = min(count, both.shape[1])
    best = np.argpartition(-both, count - 1, axis=1)[:, :count]
    order = np.argsort(-np.take_along_axis(both, best, axis=1), axis=1, kind="stable")
    return np.take_along_axis(best, order, axis=1)


def sure_cosine(dims: int, params: Params) -> float:
    """The least cosine of a vector that the probes find with probability ``recall``.

    Found by simulation: a pseudo-rotation takes a query and a vector to a random pair of
    their cosine, anew in each table.  -inf if all buckets are probed, above 1 if none will do.
    """
    axes = 1 << max(1, (dims - 1).bit_length())
    if params.probes >= 2 * axes:
        return -np.inf
    rng = np.random.default_rng([params.seed, axes])
    pairs = max(256, min(4096, (1 << 21) // axes))
    y, z = rng.standard_normal((2, pairs, axes))
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    z -= np.sum(y * z, axis=1, keepdims=True) * y
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    probed = nearest_axes(y, params.probes)

    def found(cosine: float) -> float:
        code = nearest_axes(cosine * y + np.sqrt(1 - cosine**2) * z, 1)
        return 1 - (1 - np.mean((probed == code).any(axis=1))) ** params.tables

    if found(1.0) < params.recall:
        return 2.0
    low, high = 0.0, 1.0
    for _ in range(10):
        middle = (low + high) / 2
        low, high = (low, middle) if found(middle) >= params.recall else (middle, high)
    return high


@dataclass
class Band:
    """Vectors of one length and similar norm: how many, and their largest norm."""

    n: int
    top: float


def norm_bands(shapes: list) -> tuple[dict[tuple[int, int], int], dict[tuple[int, int], Band]]:
    """Bands of a factor of two, the last of ``MOST_BANDS`` without a lower end: (dims, level) to band, (dims, band) to Band."""
    number: dict[tuple[int, int], int] = {}
    bands: dict[tuple[int, int], Band] = {}
    last = {}
    for r in sorted(shapes, key=lambda r: (r.dims, -r.level)):
        b = last.get(r.dims, -1)
        if b < 0 or (r.low < bands[r.dims, b].top / 2 and b + 1 < MOST_BANDS):
            b += 1
            bands[r.dims, b] = Band(0, r.top)
        last[r.dims] = number[r.dims, r.level] = b
        bands[r.dims, b].n += r.n
    return number, bands


def _buckets(params: Params, number: dict[tuple[int, int], int], chunks: dict[tuple[int, int], int]):
    """Per vector its bucket in each table of its band, and as a query the buckets it probes in every band."""
    of_length: dict[int, list[int]] = {}
    for d, band in chunks:
        of_length.setdefault(d, []).append(band)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            dims = frame["dims"].to_numpy()
            for d in np.unique(dims):
                part = frame[dims == d]
                for start in range(0, len(part), 256):
                    yield from _bucket_rows(part.iloc[start : start + 256], int(d))

    def _bucket_rows(rows: pd.DataFrame, d: int) -> Iterator[pd.DataFrame]:
        v = np.stack(rows["v"].to_numpy()).astype(np.float64)
        unit = v / rows["norm"].to_numpy()[:, None]
        own = np.array([number[d, x] for x in rows["level"].tolist()])
        ids, asks = rows["vec_id"].to_numpy(), rows["asks"].to_numpy()
        for band in of_length[d]:
            member = own == band
            if not (member | asks).any():
                continue
            parts = chunks[d, band]
            for t, x in enumerate(rotations(unit[member | asks], params.tables, params.seed + band)):
                inside, asking = member[member | asks], asks[member | asks]
                if inside.any():
                    yield pd.DataFrame(
                        {
                            "dims": d, "band": band, "slot": t, "code": nearest_axes(x[inside], 1)[:, 0], "chunk": ids[member] % parts,
                            "asks": False, "vec_id": ids[member], "v": list(rows["v"][member]),
                        }
                    )
                if asking.any():
                    probes = nearest_axes(x[asking], params.probes)
                    n = probes.shape[1] * parts
                    yield pd.DataFrame(
                        {
                            "dims": d, "band": band, "slot": t, "code": np.repeat(probes.ravel(), parts),
                            "chunk": np.tile(np.arange(parts), probes.size), "asks": True,
                            "vec_id": np.repeat(ids[asks], n), "v": [x for x in rows["v"][asks] for _ in range(n)],
                        }
                    )

    return run


def _search(k: int):
    def work(groups: Iterator[Columns]) -> Iterator[Columns]:
        for g in groups:
            asks = g["asks"].astype(bool)
            if asks.all() or not asks.any():
                continue
            rows, queries = np.flatnonzero(~asks), np.flatnonzero(asks)
            index = np.stack(g["v"][rows]).astype(np.float64)
            ids = g["vec_id"][rows]
            for start in range(0, len(queries), 256):
                some = queries[start : start + 256]
                q, c, score = top_pairs(np.stack(g["v"][some]).astype(np.float64), g["vec_id"][some], index, ids, k)
                yield {"query_id": g["vec_id"][some][q], "vec_id": ids[c], "score": score}

    return work


def top_pairs(queries: np.ndarray, query_ids: np.ndarray, index: np.ndarray, ids: np.ndarray, k: int):
    """(query, row, inner product) of each query's ``k`` best rows; ties go to the smaller id.

    A matrix product finds them with some room for its rounding, which depends on the
    place in the matrix; the scores that count are summed row by row.
    """
    scores = queries @ index.T
    scores[query_ids[:, None] == ids[None, :]] = -np.inf
    if len(ids) > k:
        border = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        room = 1e-9 * np.linalg.norm(queries, axis=1, keepdims=True) * np.linalg.norm(index, axis=1).max()
        near = (scores >= border - room) & (scores > -np.inf)
    else:
        near = scores > -np.inf
    q, c = np.nonzero(near)
    score = np.einsum("ij,ij->i", queries[q], index[c])
    order = np.lexsort((ids[c], -score, q))
    q, c, score = q[order], c[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
    return q[place < k], c[place < k], score[place < k]


def neighbours(
    embeddings: DataFrame, every: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", params: Params = Params()
) -> DataFrame:
    """The ``k`` nearest rows found for every query: ``query_id, rank, vec_id, score``.

    Queries are the rows whose id is divisible by ``every``; all other rows are their
    candidates.  ``score`` is the inner product of the original vectors in double
    precision; rank 1 is the largest, ties go to the smaller vec_id.  Only vectors of the
    same length are compared.

    Defined cases: a vector that is null, empty, zero or holds a null or non-finite
    component takes no part; rows that repeat an id are one vector, the smallest that can
    be used; rows with a null id take no part; with fewer than ``k`` candidates all found
    come out; an empty table gives no rows; other columns are not looked at.
    """
    asks = (F.col("vec_id") % every == 0).alias("asks")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    vectors = usable_vectors(embeddings, vec_id, embedding).select("vec_id", "v", asks, F.size("v").alias("dims"), norm.alias("norm"))
    # Half a power of two off, so that unit vectors and their rounding share a level.
    level = F.greatest(F.lit(-64), F.least(F.lit(64), F.floor(F.log2("norm") + 0.5))).cast("int")
    vectors = stage(vectors.withColumn("level", level), "vectors")
    # One row per vector length and level: how many, and the range of their norms.
    found = vectors.groupBy("dims", "level").agg(F.count("*").alias("n"), F.max("norm").alias("top"), F.min("norm").alias("low"))
    shapes = found.limit(129 * MOST_LENGTHS + 1).collect()
    if len({r.dims for r in shapes}) > MOST_LENGTHS:
        raise ValueError(f"more than {MOST_LENGTHS} different vector lengths")
    number, bands = norm_bands(shapes)
    # Two signed axes per dimension share the rows of a table; a block holds some buckets' worth.
    chunks = {(d, b): max(1, round(x.n / (2 * d) / params.block_rows)) for (d, b), x in bands.items()}
    kind = dict(vectors.dtypes)["v"]
    entries = vectors.mapInPandas(
        _buckets(params, number, chunks), f"dims int, band int, slot int, code int, chunk int, asks boolean, vec_id long, v {kind}"
    )
    hits = map_groups(entries, ["dims", "band", "slot", "code", "chunk"], _search(params.k), HITS)
    ranked = _ranked(hits, params.k)
    if not bands:
        return ranked
    ranked = stage(ranked, "neighbours")
    rest = _unsure(vectors, ranked, number, bands, params)
    if rest is None:
        return ranked
    hits = map_groups(rest, ["dims", "band", "chunk", "part"], _search(params.k), HITS)
    return _ranked(ranked.select("query_id", "vec_id", "score").union(hits), params.k)


HITS = "query_id long, vec_id long, score double"


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    hits = hits.repartition("query_id").dropDuplicates(["query_id", "vec_id"])
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _unsure(vectors: DataFrame, ranked: DataFrame, number: dict, bands: dict, params: Params) -> DataFrame | None:
    """Queries with the whole bands in which their probes are not sure to have found all, in blocks; None if there are none."""
    spark = vectors.sparkSession
    sure = {axes: sure_cosine(axes, params) for axes in {1 << max(1, (d - 1).bit_length()) for d, _ in bands}}
    rows = [(d, b, x.top, sure[1 << max(1, (d - 1).bit_length())]) for (d, b), x in bands.items()]
    rows = [r for r in rows if r[3] > -np.inf]
    if not rows:
        return None
    whole = F.broadcast(spark.createDataFrame(rows, "dims int, band int, top double, sure double"))
    last = ranked.where(F.col("rank") == params.k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("last"))
    asking = vectors.where("asks").join(last, "vec_id", "left").join(whole, "dims")
    asking = asking.where(F.col("last").isNull() | (F.col("last") < F.col("sure") * F.col("norm") * F.col("top")))
    asking = stage(asking.select("dims", "band", "vec_id", "v"), "unsure")
    counts = asking.groupBy("dims", "band").count().collect()
    if not counts:
        return None
    # Blocks of rows against blocks of queries.
    sizes = {(r.dims, r.band): (-(-bands[r.dims, r.band].n // params.block_rows), -(-r["count"] // params.block_rows)) for r in counts}
    blocks = [(d, level, b, *sizes[d, b]) for (d, level), b in number.items() if (d, b) in sizes]
    levels = F.broadcast(spark.createDataFrame(blocks, "dims int, level int, band int, chunks int, parts int"))
    sizes = F.broadcast(spark.createDataFrame([(*k, *n) for k, n in sizes.items()], "dims int, band int, chunks int, parts int"))
    row = F.xxhash64("vec_id")

    def each(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    index = vectors.join(levels, ["dims", "level"]).withColumn("chunk", F.pmod(row, F.col("chunks")).cast("int")).withColumn("part", each("parts"))
    asking = asking.join(sizes, ["dims", "band"]).withColumn("part", F.pmod(row, F.col("parts")).cast("int")).withColumn("chunk", each("chunks"))
    columns = ["dims", "band", "chunk", "part", "asks", "vec_id", "v"]
    return index.withColumn("asks", F.lit(False)).select(columns).union(asking.withColumn("asks", F.lit(True)).select(columns))
