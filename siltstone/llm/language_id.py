"""Language identification with hyperdimensional profiles.

Every letter, and the gap between words, has a random vector of +1 and -1.  The vector of
a run of three is the product of the first, rotated twice, the second, rotated once, and
the third (binding keeps order apart).  A text's vector is the sum of its runs' vectors,
a language's prototype the sum over its labelled texts, and a text gets the language whose
prototype has the largest cosine with it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import free_name

UNKNOWN = "und"
GRAM = 3
BLOCK_GRAMS = 4096
BLOCK_CELLS = 1 << 21
BLOCK_TEXTS = 128
BLOCK_CHARS = 1 << 18
GAP = 0
# Standard errors of a cosine that noise may take, and more even runs than any language has.
MARGIN = 4
MOST_RUNS = 1 << 16


@dataclass(frozen=True)
class Params:
    """``dims`` of the vectors; more than ``most_languages`` learned values are an error, not cut off."""

    dims: int = 2048
    seed: int = 11
    most_languages: int = 1024


@cache
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(text: str | None) -> np.ndarray:
    """The runs of three of a lower-cased text as numbers; a gap stands for anything between letters."""
    if not text:
        return np.empty(0, np.uint64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.uint64)
    points = np.where(letter, points, GAP)
    keep = np.r_[True, letter[1:] | letter[:-1]] if len(points) > 1 else np.array([True])
    points = points[keep].astype(np.uint64)
    points = np.concatenate([[GAP] if points[0] else [], points, [GAP] if points[-1] else []]).astype(np.uint64)
    return (points[:-2] << np.uint64(42)) | (points[1:-1] << np.uint64(21)) | points[2:]


class Vectors:
    """Vectors of runs, from those of single letters, which a generator keyed by the letter gives."""

    def __init__(self, params: Params) -> None:
        self.params = params
        self.known: dict[int, int] = {}
        self.rows = np.empty((0, params.dims), np.int8)

    def _rows(self, letters: np.ndarray) -> np.ndarray:
        distinct, back = np.unique(letters, return_inverse=True)
        new = [c for c in distinct.tolist() if c not in self.known]
        if len(self.known) + len(new) > 8192:
            self.known, self.rows, new = {}, self.rows[:0], distinct.tolist()
        if new:
            made = [np.random.default_rng([self.params.seed, c]).integers(0, 2, self.params.dims, np.int8) * 2 - 1 for c in new]
            self.known.update({c: len(self.rows) + k for k, c in enumerate(new)})
            self.rows = np.concatenate([self.rows, np.array(made, np.int8)])
        return np.array([self.known[c] for c in distinct.tolist()])[back]

    def __call__(self, runs: np.ndarray) -> np.ndarray:
        mask = np.uint64((1 << 21) - 1)
        letters = np.concatenate([(runs >> np.uint64(s)) & mask for s in (42, 21, 0)]).astype(np.int64)
        places = self._rows(letters).reshape(3, -1)
        out = np.roll(self.rows, 2, axis=1)[places[0]]
        out *= np.roll(self.rows, 1, axis=1)[places[1]]
        out *= self.rows[places[2]]
        return out

    def sums(self, lists: list[np.ndarray]) -> np.ndarray:
        """The vector of each list of runs (float64; exact, being sums of whole numbers)."""
        total = np.zeros((len(lists), self.params.dims))
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        distinct, at = np.unique(np.concatenate(lists), return_inverse=True) if len(owner) else (np.empty(0, np.uint64), owner)
        # Counts of a run in a text stay exact in 32 bits below 2^24; so do the products' sums.
        kind = np.float32 if max(map(len, lists), default=0) < 1 << 24 else np.float64
        # Some texts at a time, so that the table of their counts stays small.
        step = max(1, BLOCK_CELLS // max(1, len(distinct)))
        for first in range(0, len(lists), step):
            some = slice(*np.searchsorted(owner, [first, first + step]))
            rows = min(step, len(lists) - first)
            cells = (owner[some] - first) * len(distinct) + at[some]
            counts = np.bincount(cells, minlength=rows * len(distinct)).reshape(rows, -1)
            for start in range(0, len(distinct), BLOCK_GRAMS):
                part = counts[:, start : start + BLOCK_GRAMS].astype(kind)
                total[first : first + rows] += part @ self(distinct[start : start + BLOCK_GRAMS]).astype(kind)
        return total


def _batches(texts: Iterable[str | None]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Runs of some texts at a time, with the place of the first text."""
    start, size, lists = 0, 0, []
    for text in texts:
        x = grams(text)
        if lists and (len(lists) >= BLOCK_TEXTS or size + len(x) > BLOCK_CHARS):
            yield start, lists
            start, size, lists = start + len(lists), 0, []
        lists.append(x)
        size += len(x)
    if lists:
        yield start, lists


def fit(documents: DataFrame, text: str, lang: str, params: Params = Params()) -> dict[str, np.ndarray]:
    """Prototype of every non-null ``lang``, from all rows given.

    A task sums up its rows; what reaches the driver is one vector per language, at most
    ``most_languages`` of them.
    """

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors = Vectors(params)
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            for value, texts in frame.groupby("lang", sort=False)["text"]:
                for _, lists in _batches(texts):
                    joint = np.concatenate(lists)
                    if len(joint):
                        sums[value] = sums.get(value, 0) + vectors.sums([joint])[0]
            if len(sums) > params.most_languages:
                raise ValueError(f"more than {params.most_languages} languages")
        for value, total in sums.items():
            yield pd.DataFrame({"lang": value, "dim": np.arange(params.dims), "v": total.astype(np.int64)})

    rows = documents.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null").mapInPandas(partial, "lang string, dim int, v long")
    sums = rows.groupBy("lang", "dim").agg(F.sum("v").alias("v"))
    lists = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "v"))).alias("v"))
    found = lists.select("lang", F.col("v.v").alias("v")).limit(params.most_languages + 1).collect()
    if len(found) > params.most_languages:
        raise ValueError(f"more than {params.most_languages} languages")
    return {r.lang: np.array(r.v, np.float64) for r in sorted(found, key=lambda r: r.lang)}


def predictor(prototypes: dict[str, np.ndarray], params: Params = Params()):
    """Column function: text to struct ``lang_pred, score, likely``; see ``recognised`` for the last."""
    names = sorted(k for k, v in prototypes.items() if np.linalg.norm(v) > 0)
    table = np.array([prototypes[k] / np.linalg.norm(prototypes[k]) for k in names]).reshape(len(names), params.dims)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vectors = Vectors(params)
        for texts in parts:
            pred, score, likely = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts)), np.zeros(len(texts), bool)
            for start, lists in _batches(texts):
                some = [start + k for k, x in enumerate(lists) if len(x)] if names else []
                if not some:
                    continue
                own = vectors.sums([x for x in lists if len(x)])
                norms = np.linalg.norm(own, axis=1)
                cosine = own @ table.T / np.where(norms == 0, 1, norms)[:, None]
                best = cosine.argmax(axis=1)  # of equal ones the first in code point order
                pred[some] = [names[b] for b in best]
                score[some] = np.clip(cosine[np.arange(len(some)), best], 0, 1)
                likely[some] = score[some] + MARGIN / np.sqrt(params.dims) >= least_likeness([len(x) for x in lists if len(x)], norms, params.dims)
            yield pd.DataFrame({"lang_pred": pred, "score": score, "likely": likely})

    return F.pandas_udf(run, "lang_pred string, score double, likely boolean")


def least_likeness(runs: list[int], norms: np.ndarray, dims: int) -> np.ndarray:
    """The cosine of texts with a language of ``MOST_RUNS`` equally frequent runs, that they are drawn from.

    Runs that repeat count for less: ``n`` runs with counts c are as good as n^2 / sum(c^2)
    different ones, and the squared norm is about ``dims`` times that sum.
    """
    n = np.array(runs, np.float64)
    n = np.minimum(n, n**2 * dims / np.maximum(norms, 1) ** 2)
    return np.sqrt(n / (n + MOST_RUNS))


def held_out(doc_id: str) -> Column:
    """Whether the CRC-32 of the id as text leaves 1 modulo 3 (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def learned(documents: DataFrame, doc_id: str, text: str, lang: str, params: Params = Params()):
    """Predictor learned from the rows that are not held out."""
    return predictor(fit(documents.where(~held_out(doc_id)), text, lang, params), params)


def identify(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", params: Params = Params()
) -> DataFrame:
    """Language of every whole text: ``doc_id, held_out, lang_pred, score``.

    Learned from the labelled texts of the rows not held out; ``score`` is the cosine with
    the language's prototype, not below 0.

    Defined cases: a null text or one without a letter is ``und`` with score 0, as is
    every text if nothing was learned; a null lang is not learned from; a null doc_id is
    not held out; of equal cosines the first language in code point order counts;
    repeated rows come out as often and count as often; an empty table gives no rows;
    other columns are not looked at.
    """
    predict = learned(documents, doc_id, text, lang, params)
    out = documents.select(
        F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), predict(F.col(text).cast("string")).alias("p")
    )
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")


def recognised(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", params: Params = Params()
) -> DataFrame:
    """The documents whose language can be told, columns as they are.

    Rejected are texts without letters, and those surely unlike every language learned:
    their score, with 4 standard errors of 1 / sqrt(dims) added, is below
    ``least_likeness`` of their number of runs.  With 2048 dimensions no text of under 500 runs is.
    """
    predict = learned(documents, doc_id, text, lang, params)
    guess = free_name(documents, "guess")
    marked = documents.withColumn(guess, predict(F.col(text).cast("string")))
    return marked.where((F.col(guess)["lang_pred"] != UNKNOWN) & F.col(guess)["likely"]).drop(guess)
