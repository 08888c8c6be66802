"""Runs of repeated words, found by suffix trees and Lyndon roots.

Per stretch of words: Ukkonen's suffix trees of the stretch and of its reversal; walked in
order they give the suffixes' ranks and, from the lowest node an Euler tour passes between
two leaves, the depth of any two leaves' common ancestor (range minima, constant time).  That
depth is how far two suffixes agree (LCE), forwards in one tree and backwards in the other.
By the runs theorem (Bannai et al., "The Runs Theorem") the root of every run is a longest
Lyndon word of some place in one of two alphabet orders; each such candidate is extended
in both directions by its LCEs, and kept if it spans its root often enough.

Trees are only built where a run can be.  Every word of a run of period q after its first q
stands again at most q words back, so a run of q in (2^(j-1), 2^j] lies in a stretch of over
3 * 2^(j-1) words each of which recurs within 2^j; all such stretches are searched.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Params:
    """A run has ``least`` words or more, and ``times`` its period or more (at least 2)."""

    least: int = 6
    times: int = 4


# ---------------------------------------------------------------- suffix tree


def suffix_tree(text: list[int]) -> tuple[dict[int, int], list[int], list[int]]:
    """Ukkonen's suffix tree of ``text``, whose last symbol occurs nowhere else.

    Edges are ``symbol * 2^32 + node -> child``; the label of a node's edge is
    ``text[begin[node] : end[node]]``.  Node 0 is the root.
    """
    n = len(text)
    begin, end, link = [0], [0], [0]
    edges: dict[int, int] = {}
    node, place, length, left = 0, 0, 0, 0
    for i, symbol in enumerate(text):
        made = 0
        left += 1
        while left:
            if not length:
                place = i
            key = (text[place] << 32) | node
            child = edges.get(key)
            if child is None:
                edges[key] = len(begin)
                begin.append(i)
                end.append(n)
                link.append(0)
                if made:
                    link[made] = node
                    made = 0
            else:
                start = begin[child]
                size = min(end[child], i + 1) - start
                if length >= size:
                    node, place, length = child, place + size, length - size
                    continue
                if text[start + length] == symbol:
                    if made and node:
                        link[made] = node
                    length += 1
                    break
                split = len(begin)
                begin += [start, i]
                end += [start + length, n]
                link += [0, 0]
                edges[key] = split
                edges[(symbol << 32) | split] = split + 1
                begin[child] = start + length
                edges[(text[start + length] << 32) | split] = child
                if made:
                    link[made] = split
                made = split
            left -= 1
            if not node and length:
                length -= 1
                place = i - left + 1
            else:
                node = link[node]
    return edges, begin, end


class Agreement:
    """Ranks of all suffixes of a text, and how many words any two of them agree in."""

    def __init__(self, text: np.ndarray) -> None:
        n = len(text)
        # The end is a symbol smaller than every word.
        edges, begin, end = suffix_tree([*(text + 1).tolist(), 0])
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        children = np.fromiter(edges.values(), np.int64, len(edges))
        del edges
        parents, symbols = keys & 0xFFFFFFFF, keys >> 32
        order = np.lexsort((-symbols, parents))
        first = np.searchsorted(parents[order], np.arange(len(begin) + 1)).tolist()
        listed = children[order].tolist()
        sizes = (np.minimum(end, n + 1) - np.array(begin)).tolist()
        places, lows = [], []
        # The tour goes up from a leaf to the common ancestor with the next one, and down again.
        stack, low = [(0, 0)], 0
        while stack:
            at, depth = stack.pop()
            above = depth - sizes[at]
            if above < low:
                low = above
            a, b = first[at], first[at + 1]
            if a == b:
                places.append(n + 1 - depth)
                lows.append(low)
                low = n
            for child in listed[a:b]:
                stack.append((child, depth + sizes[child]))
        self.rank = np.empty(n + 1, np.int64)
        self.rank[places] = np.arange(n + 1)
        self.least = [np.array(lows, np.int32)]
        while 2 << len(self.least) - 1 <= n + 1:
            half, row = 1 << len(self.least) - 1, self.least[-1]
            self.least.append(np.minimum(row[:-half], row[half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``i[k]`` and ``j[k]``, which differ."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level).tolist():
            some = level == k
            row = self.least[k]
            out[some] = np.minimum(row[low[some]], row[high[some] - (1 << k)])
        return out


def _next_beyond(rank: list[int], n: int) -> tuple[list[int], list[int]]:
    """Per place the next one of smaller rank, and the next one of greater rank (or the end)."""
    smaller, greater = [n] * n, [n] * n
    falling: list[int] = []
    rising: list[int] = []
    for i in range(n):
        r = rank[i]
        while rising and rank[rising[-1]] > r:
            smaller[rising.pop()] = i
        while falling and rank[falling[-1]] < r:
            greater[falling.pop()] = i
        rising.append(i)
        falling.append(i)
    return smaller, greater


def runs(text: np.ndarray, params: Params = Params()) -> np.ndarray:
    """Rows ``start, length, period`` of all runs of a stretch of word numbers, by start, then period."""
    n = len(text)
    if n < max(params.least, params.times):
        return np.empty((0, 3), np.int64)
    ahead = Agreement(text)
    place = np.arange(n)
    found = []
    # The longest Lyndon word of a place ends where a smaller suffix begins; in the opposite order, a greater one.
    # There the end is greater than every word, so a root up to the end is left to the first order.
    smaller, greater = (np.array(x) for x in _next_beyond(ahead.rank[:n].tolist(), n))
    nexts = [smaller, np.where(greater < n, greater, place + n + 1)]
    roots = [(place[some], (x - place)[some]) for x in nexts if (some := (x - place) * params.times <= n).any()]
    if not roots:
        return np.empty((0, 3), np.int64)
    at, period = (np.concatenate(x) for x in zip(*roots, strict=True))
    right = ahead(at, at + period)
    del ahead
    back = Agreement(text[::-1])
    left = back(n - at, n - at - period)
    start, length = at - left, left + period + right
    enough = length >= np.maximum(params.least, params.times * period)
    rows = np.stack([start, length, period], axis=1)[enough]
    return np.unique(rows[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]] if len(rows) else rows


# ---------------------------------------------------------------- stretches worth a tree


def stretches(words: np.ndarray, begins: np.ndarray, params: Params = Params()) -> list[tuple[int, int]]:
    """Parts of some texts, laid end to end, that hold all their runs and the words beside these.

    ``begins`` is where each text begins, and the end of the last.
    """
    n = len(words)
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    order = np.lexsort((words, owner))
    same = (words[order][1:] == words[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    back = np.full(n, n + 1)
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    most = int(np.diff(begins).max(initial=0))
    marks = np.zeros(n + 1, np.int64)
    j = 0
    while params.times * (least := (1 << j >> 1) + 1 if j else 1) <= most:
        wide = 1 << j
        need = max((params.times - 1) * least, params.least - wide, 1)
        edges = np.flatnonzero(np.diff(np.r_[False, back <= wide, False].astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        long_ = ends - starts >= need
        if long_.any():
            starts, ends = starts[long_], ends[long_]
            text = np.searchsorted(begins, starts, "right") - 1
            np.add.at(marks, np.maximum(starts - wide - 1, begins[text]), 1)
            np.add.at(marks, np.minimum(ends + 1, begins[text + 1]), -1)
        j += 1
    inside = np.r_[False, np.cumsum(marks)[:n] > 0, False]
    edges = np.flatnonzero(np.diff(inside.astype(np.int8)))
    out = []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        cuts = begins[(begins > a) & (begins < b)].tolist()
        out += zip([a, *cuts], [*cuts, b], strict=True)
    return out


def runs_of_texts(texts: list[list], params: Params = Params()) -> list[np.ndarray]:
    """The runs of each text, given as a list of words."""
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    words = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, sum(map(len, texts)))
    begins = np.cumsum([0, *map(len, texts)])
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for a, b in stretches(words, begins, params):
        k = int(np.searchsorted(begins, a, "right")) - 1
        part = np.unique(words[a:b], return_inverse=True)[1]
        if len(rows := runs(part, params)):
            out[k].append(rows + [a - begins[k], 0, 0])
    return [np.concatenate(x) if x else np.empty((0, 3), np.int64) for x in out]


# ---------------------------------------------------------------- documents


def made_periodic(words: list, h: int | None) -> list:
    """For ids whose hash is a multiple of 10, the words from some place on repeat those before (see ``collapse``)."""
    n = len(words)
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    root = words[a : a + p]
    return words[:a] + (root * (-(-(n - a) // p)))[: n - a]


def collapsed(words: list, rows: np.ndarray) -> list:
    """The words that no run holds after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 0] + rows[:, 1], -1)
    keep = np.cumsum(change[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


RESULT = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
BATCH_WORDS = 200_000


def _collapse(params: Params, with_text: bool):
    def result(words: list[bytes], rows: np.ndarray) -> tuple:
        best = None
        if len(rows):
            start, length, period = rows[np.lexsort((rows[:, 2], rows[:, 0], -rows[:, 1]))[0]].tolist()
            best = start, length, period, 1000 * length // period
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in rows.tolist())
        left = b" ".join(collapsed(words, rows) if len(rows) else words)
        out = (len(rows), *(best or (None,) * 4), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest())
        return (*out, left.decode()) if with_text else out

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RESULT.split(", ")] + ["collapsed"] * with_text
        for raw, hashes in batches:
            out: list[tuple] = []
            held: list[list[bytes]] = []
            size = 0
            for k, (text, h) in enumerate(zip(raw, hashes, strict=True)):
                # Of bytes, split() parts at 0x09 to 0x0D and the blank alone.
                held.append(made_periodic(bytes(text or b"").split(), None if pd.isna(h) else int(h)))
                size += len(held[-1])
                if size >= BATCH_WORDS or k == len(raw) - 1:
                    out += map(result, held, runs_of_texts(held, params))
                    held, size = [], 0
            frame = pd.DataFrame(out, columns=names)
            yield frame.astype({c: "Int64" for c in ("n_runs", "start", "length", "period", "exponent_milli")})

    return F.pandas_udf(run, RESULT + ", collapsed string" * with_text)


def crc(doc_id: str):
    """CRC-32 of the id in decimal, unsigned; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def collapse(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Params = Params(), planted: bool = False, with_text: bool = False
) -> DataFrame:
    """The runs of every whole text's words: ``doc_id`` and RESULT.

    Words are stretches without blanks or the control characters 9 to 13, numbered from 0.
    A run is a stretch of smallest period q and ``max(least, times * q)`` words or more that
    no word beside it extends.  ``start, length, period`` are those of the longest run (of
    equal ones the first, then the one of the shorter period); ``runs_sha256`` digests
    all runs, ``collapsed_sha256`` the words left when each run keeps its first period
    only, joined by blanks; ``with_text`` adds them as ``collapsed``.  ``planted`` first makes
    the tail of every text whose id's CRC-32 ends in 0 periodic, for trials with known runs.

    A text is one row's work: no shuffle; memory grows with the longest stretch in which
    runs can be, some 300 bytes a word of it.

    Defined cases: a null or blank text has no word, no run and the empty text's digests;
    a null doc_id is kept, and its text stays as it is; repeated rows come out as often; an
    empty table gives no rows; other columns are not looked at.
    """
    h = crc(doc_id) if planted else F.lit(None).cast("long")
    found = _collapse(params, with_text)(F.col(text).cast("string").cast("binary"), h)
    return documents.select(F.col(doc_id).alias("doc_id"), found.alias("r")).select("doc_id", "r.*")
