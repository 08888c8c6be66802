"""Removal of byte strings that repeat anywhere, through suffix arrays built by two-stage sorting.

Sorting all suffixes of a corpus together would ship every byte once per byte of context.
Instead each window of ``length`` bytes is given an anchor: the position of the smallest
hash among the ``gram``-byte strings in it (winnowing).  The anchor depends on the
window's bytes alone, so equal windows have equal anchors, and windows that share an
anchor form a run, its context.  Only anchors that occur twice go on:

1. anchors whose contexts are all equal: every window in them repeats, nothing to sort;
2. else one copy of each distinct context is fetched, and the suffixes of all contexts
   of an anchor are sorted together; neighbours in the suffix array with a common prefix
   of ``length`` bytes are repeats;
3. an anchor with more than ``group_contexts`` distinct contexts (a passage in very many
   documents, where it meets different surroundings) is not sorted in one task: its
   windows are compared by 128-bit digests, first in parts of many windows and then, where
   these differ, in smaller ones; a shuffle counts them wherever they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import Columns, as_documents, attach, free_name, map_groups, shuffled, stage, text_key

SPAN = 1 << 26  # bytes of one text looked at together; longer texts go on with an overlap
# What a passage of over 50 words comes to at least, at four letters and a blank a word.
PASSAGE = 250


@dataclass(frozen=True)
class Params:
    """``length`` bytes a repeat; ``gram`` bytes an anchor; see the module for the rest."""

    length: int = 400
    gram: int = 64
    group_contexts: int = 256
    block_bytes: int = 1 << 17
    widths: tuple[int, ...] = (64, 8, 1)


# ---------------------------------------------------------------- two-stage suffix sorting


def _sorted_directly(text: bytes, starts: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes: by eight bytes together, then ties by slices."""
    padded = np.frombuffer(text + bytes(7), np.uint8)
    heads = np.ndarray(len(text), ">u8", padded, strides=(1,))[starts].astype(np.uint64)
    order = np.argsort(heads, kind="stable")
    out, heads = starts[order].tolist(), heads[order]
    first = np.flatnonzero(np.r_[True, heads[1:] != heads[:-1]][: len(heads)])
    last = np.r_[first[1:], len(out)]
    ties = last - first > 1
    for a, b in zip(first[ties].tolist(), last[ties].tolist(), strict=True):
        out[a:b] = sorted(out[a:b], key=lambda i: text[i : i + depth])
    return np.array(out, np.int64)


def suffix_array(text: bytes, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first ``depth`` bytes.

    First stage: suffixes smaller than their successor are sorted directly, by at most
    ``depth`` bytes.  Second stage: one scan over the buckets of first bytes induces the
    others, each right after the suffix one byte on has its place.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    t = np.frombuffer(text, np.uint8)
    # A suffix compares with its successor as the first unequal byte of its run does with the
    # next; the run at the end is larger than what follows it, which is nothing.
    change = np.flatnonzero(t[1:] != t[:-1])
    ends = np.append(change, n - 1)
    rises = np.append(t[change] < t[change + 1], False)
    smaller = np.repeat(rises, np.diff(ends, prepend=-1))
    direct = _sorted_directly(text, np.flatnonzero(smaller), depth)
    starts = np.searchsorted(t[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[t[n - 1]].append(np.array([n - 1]))
    done = []
    for c in range(256):
        own = direct[starts[c] : starts[c + 1]]
        if not waiting[c] and not len(own):
            continue
        induced = []
        step = np.concatenate(waiting[c]) if waiting[c] else own[:0]
        while len(step):  # within a bucket, longer runs of its byte come after shorter ones
            induced.append(step)
            step = step[step > 0] - 1
            step = step[t[step] == c]
        bucket = np.concatenate([*induced, own])
        done.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[t[before] > c]
        if len(before):
            first = t[before]
            order = np.argsort(first, kind="stable")
            cuts = np.flatnonzero(np.diff(first[order])) + 1
            for part in np.split(before[order], cuts):
                waiting[t[part[0]]].append(part)
    return np.concatenate(done)


def common_prefixes(text: bytes, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length, up to ``most``, of the common prefix of the suffixes at ``a[i]`` and ``b[i]``."""
    padded = np.frombuffer(text + bytes(most + 8), np.uint8)
    words = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    out = np.zeros(len(a), np.int64)
    alive = np.arange(len(a))
    for at in range(0, most, 8):
        if not len(alive):
            break
        x = words[a[alive] + at] ^ words[b[alive] + at]
        same = x == 0
        ended = x[~same]
        # The lowest set bit of the difference names the first unequal byte.
        low = ended & (~ended + np.uint64(1))
        out[alive[~same]] = at + np.log2(low.astype(np.float64)).astype(np.int64) // 8
        alive = alive[same]
        out[alive] = at + 8
    limit = np.minimum(len(text) - a, len(text) - b)
    return np.minimum(np.minimum(out, most), limit)


def repeated_windows(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each context, which of its ``length``-byte windows occur more than once in the list."""
    text = b"\xff".join(contexts)  # no byte of UTF-8
    begins = np.cumsum([0, *(len(c) + 1 for c in contexts)])[:-1]
    counts = np.array([max(0, len(c) - length + 1) for c in contexts])
    window = np.zeros(len(text), bool)
    for start, count in zip(begins.tolist(), counts.tolist(), strict=True):
        window[start : start + count] = True
    order = suffix_array(text, length)
    order = order[window[order]]
    equal = common_prefixes(text, order[:-1], order[1:], length) >= length
    again = np.zeros(len(text), bool)
    again[order[:-1][equal]] = True
    again[order[1:][equal]] = True
    return [again[s : s + k] for s, k in zip(begins.tolist(), counts.tolist(), strict=True)]


# ---------------------------------------------------------------- anchors


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by prefix and suffix minima of blocks."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    top = np.iinfo(np.uint64).max
    padded = np.full(blocks * width, top, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


class Anchors:
    """Finds the anchors of texts; holds the tables of the rolling hash."""

    def __init__(self, params: Params) -> None:
        self.params = params
        rng = np.random.default_rng(5)
        self.bytes = rng.integers(0, 2**64, 256, np.uint64)
        base = 0x9E3779B97F4A7C15
        self.bases = base, pow(base, -1, 2**64)
        self.tables = [np.ones(1, np.uint64)] * 2

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers 0 to n - 1 of the base and of its inverse modulo 2^64."""
        if len(self.tables[0]) < n:
            for k, base in enumerate(self.bases):
                factors = np.full(max(n, 1 << 16), base, np.uint64)
                factors[0] = 1
                self.tables[k] = np.multiply.accumulate(factors)
        return self.tables[0][:n], self.tables[1][:n]

    def find(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor position, first and last window start of each context of a text."""
        found = []
        step = SPAN - self.params.length + 1
        for start in range(0, max(1, len(text) - self.params.length + 1), step):
            part = self._find(text[start : start + SPAN])
            found.append([x + start for x in part])
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _find(self, text: bytes) -> list[np.ndarray]:
        length, gram = self.params.length, self.params.gram
        if len(text) < length:
            return [np.empty(0, np.int64)] * 3
        t = np.frombuffer(text, np.uint8)
        with np.errstate(over="ignore"):
            # A running sum of byte values times rising powers; differences of it are the sums
            # over grams, which the inverse power of their start makes the same everywhere.
            powers, inverse = self._powers(len(t))
            total = np.zeros(len(t) + 1, np.uint64)
            np.cumsum(self.bytes[t] * powers, dtype=np.uint64, out=total[1:])
            count = len(t) - gram + 1
            grams = (total[gram:] - total[:-gram]) * inverse[:count]
            grams = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        # High bits of the hash, then the place: of equal hashes the first one counts.
        marked = (grams & ~np.uint64(SPAN - 1)) | np.arange(count, dtype=np.uint64)
        least = _sliding_min(marked, length - gram + 1) & np.uint64(SPAN - 1)
        at = least.astype(np.int64)
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        return [at[starts], starts, np.r_[starts[1:], len(at)] - 1]


def _occurrences(params: Params):
    """Arrow batches of contexts: anchor and context digests, the row's key, the window range and the anchor's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(params)
        digest = xxhash.xxh3_64_intdigest
        names = ["h", "context", "x", "y", "begin", "end", "at"]

        def batch(parts: list[tuple]) -> pa.RecordBatch:
            cols = [np.concatenate(c) for c in zip(*parts, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)

        for b in batches:
            parts, rows = [], 0
            for x, y, text in zip(b["x"].to_pylist(), b["y"].to_pylist(), b["text"], strict=True):
                text = text.as_py()
                if not text or len(text) < params.length:
                    continue
                at, first, last = anchors.find(text)
                n = len(at)
                h = np.fromiter((digest(text[i : i + params.gram]) for i in at.tolist()), np.uint64, n)
                ends = (last + params.length).tolist()
                c = np.fromiter((digest(text[i:j]) for i, j in zip(first.tolist(), ends, strict=True)), np.uint64, n)
                # Where in the context the anchor lies is part of what two contexts must share.
                parts.append((h.view(np.int64), (c ^ (at - first).astype(np.uint64)).view(np.int64), np.full(n, x), np.full(n, y), first, last, at - first))
                rows += n
                if rows > 20_000:
                    yield batch(parts)
                    parts, rows = [], 0
            if parts:
                yield batch(parts)

    return run


OCCURRENCE = "h long, context long, x long, y long, begin long, end long, at long"


PIECE = "h long, x long, y long, begin long, at long, copies long, contexts long, piece binary"
PIECE_COLUMNS = [c.split()[0] for c in PIECE.split(", ")]


def _contexts(length: int):
    """Cut the listed contexts out of each text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out: list[tuple] = []
            for x, y, text, wanted in zip(frame["x"], frame["y"], frame["text"], frame["wanted"], strict=True):
                for w in wanted:
                    piece = bytes(text[w["begin"] : w["end"] + length])
                    out.append((w["h"], x, y, w["begin"], w["at"], w["copies"], w["contexts"], piece))
                    if len(out) >= 5000:
                        yield pd.DataFrame(out, columns=PIECE_COLUMNS)
                        out = []
            if out:
                yield pd.DataFrame(out, columns=PIECE_COLUMNS)

    return run


def _sort_groups(params: Params):
    """Suffix arrays over the contexts of some anchors at a time; anchors are not split."""

    def work(groups: Iterator[Columns]) -> Iterator[Columns]:
        held: list[Columns] = []
        size = 0
        for g in groups:
            held.append(g)
            size += sum(map(len, g["piece"]))
            if size >= params.block_bytes:
                yield _repeats(held, params.length)
                held, size = [], 0
        if held:
            yield _repeats(held, params.length)

    return work


def _repeats(groups: list[Columns], length: int) -> Columns:
    """Spans of the repeated windows of contexts that occur once; the others are known to repeat."""
    cols = {c: np.concatenate([g[c] for g in groups]) for c in groups[0]}
    windows = repeated_windows([bytes(p) for p in cols["piece"]], length)
    x, y, begin, end = [], [], [], []
    for i, again in enumerate(windows):
        if cols["copies"][i] == 1 and again.any():
            edges = np.flatnonzero(np.diff(np.r_[False, again, False]))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                x.append(cols["x"][i])
                y.append(cols["y"][i])
                begin.append(cols["begin"][i] + a)
                end.append(cols["begin"][i] + b - 1 + length)
    return {"x": np.array(x, np.int64), "y": np.array(y, np.int64), "begin": np.array(begin, np.int64), "end": np.array(end, np.int64)}


def _parts(length: int, width: int):
    """Windows of a piece in parts of ``width`` starts, counted from the anchor.

    All windows of a part share a core of bytes; parts of two pieces hold equal windows
    only if the anchor, the part's number and the core are equal (digest ``c1, c2``).
    ``whole`` is a digest of all that the part's windows cover.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out: list[tuple] = []
            names = ("number", "h", "at", "open", "piece")
            for number, h, at, ranges, piece in zip(*(frame[n] for n in names), strict=True):
                piece, h = bytes(piece), int(h).to_bytes(8, "big", signed=True)
                for low, high in ((r["low"], r["high"]) for r in ranges):
                    # Window starts in the piece from ``low`` up to ``high`` lie at or before the anchor.
                    for k in range((at - high + 1) // width, (at - low) // width + 1):
                        first, last = at - (k + 1) * width + 1, at - k * width
                        a, b = max(first, low), min(last, high - 1)
                        core = piece[last : max(first + length, last)]
                        c1, c2 = (int.from_bytes(x, "big", signed=True) for x in _halves(h + k.to_bytes(4, "big") + core))
                        covered = (a - at).to_bytes(4, "big", signed=True) + piece[a : b + length]
                        w1, w2 = (int.from_bytes(x, "big", signed=True) for x in _halves(covered))
                        out.append((number, a, b + 1, c1, c2, w1, w2))
                if len(out) >= 20_000:
                    yield pd.DataFrame(out, columns=["number", "low", "high", "c1", "c2", "w1", "w2"])
                    out = []
            if out:
                yield pd.DataFrame(out, columns=["number", "low", "high", "c1", "c2", "w1", "w2"])

    return run


def _halves(data: bytes) -> tuple[bytes, bytes]:
    d = xxhash.xxh3_128_digest(data)
    return d[:8], d[8:]


def _union():
    """Maximal runs of a list of spans."""

    def run(spans: pd.Series) -> pd.Series:
        runs = (merged(np.array([s["begin"] for s in x]), np.array([s["end"] for s in x])) for x in spans)
        return pd.Series([[{"begin": int(a), "end": int(b)} for a, b in zip(*r, strict=True)] for r in runs], dtype=object)

    return F.pandas_udf(run, "array<struct<begin: long, end: long>>")


def _narrowed(pieces: DataFrame, length: int, widths: tuple[int, ...]) -> DataFrame:
    """Spans ``x, y, begin, end`` of the repeated windows of contexts that occur once, by digests.

    Windows are compared in ever smaller parts: a part whose core occurs once repeats
    nowhere; the windows of parts that are equal repeat; where parts of a core differ, one
    of each kind is parted again, down to single windows.  Rows meet in sums only, wherever
    they are.
    """
    pieces = stage(pieces.withColumn("number", F.monotonically_increasing_id()), "hot-pieces")
    every = F.struct(F.lit(0).cast("long").alias("low"), (F.octet_length("piece") - length + 1).cast("long").alias("high"))
    open_ = pieces.withColumn("open", F.array(every))
    spans = None
    for width in widths:
        parts = open_.repartition("number").mapInPandas(
            _parts(length, width), "number long, low long, high long, c1 long, c2 long, w1 long, w2 long"
        )
        parts = stage(parts, "parts")
        row = F.struct("number", "low", "high")
        wholes = stage(parts.groupBy("c1", "c2", "w1", "w2").agg(F.count("*").alias("n"), F.min(row).alias("one")), "wholes")
        mixed = stage(wholes.groupBy("c1", "c2").agg(F.count("*").alias("kinds")).where("kinds > 1").select("c1", "c2"), "cores")
        equal = stage(wholes.where("n > 1").select("c1", "c2", "w1", "w2"), "equal-parts")
        met = attach(parts, equal, ["c1", "c2", "w1", "w2"])
        # Ranges go back to their piece in one row, at most one range a window; the piece is not copied per range.
        listed_ = F.collect_list(F.struct("low", "high")).alias("open")
        ranges = met.groupBy("number").agg(listed_)
        covers = F.transform("open", lambda r: F.struct(r["low"].alias("begin"), (r["high"] - 1 + length).alias("end")))
        found = ranges.select("number", _union()(covers).alias("spans"))
        found = shuffled(found, pieces.where("copies = 1").select("number", "x", "y", "begin"), ["number"])
        found = found.select("x", "y", "begin", F.explode("spans").alias("s")).select(
            "x", "y", (F.col("begin") + F.col("s.begin")).alias("begin"), (F.col("begin") + F.col("s.end")).alias("end")
        )
        spans = found if spans is None else spans.unionByName(found)
        # Of equal parts one stands for all among the others of their core.
        open_ = shuffled(attach(wholes, mixed, ["c1", "c2"]).select("one.*").groupBy("number").agg(listed_), pieces, ["number"])
    return spans


def repeated_spans(texts: DataFrame, params: Params) -> DataFrame:
    """Spans ``x, y, begin, end`` of all bytes in windows that occur again; spans overlap.

    ``texts`` holds ``x, y, text`` (binary), keys that equal texts may share.
    """
    long_enough = texts.where(F.octet_length("text") >= params.length)
    occurrences = stage(long_enough.mapInArrow(_occurrences(params), OCCURRENCE), "anchors")
    anchors = occurrences.groupBy("h").agg(
        F.count("*").alias("n"), F.min("context").alias("low"), F.max("context").alias("high")
    )
    again = anchors.where("n > 1").select("h", (F.col("low") != F.col("high")).alias("mixed"))
    # Written first, both sides are plain scans, and AQE can split the tasks of a hot anchor.
    met = stage(shuffled(occurrences, stage(again, "anchors-again"), ["h"]), "repeated-anchors")
    span = ["x", "y", "begin", (F.col("end") + params.length).alias("end")]
    spans = met.where("NOT mixed").select(*span)

    mixed = met.where("mixed")
    distinct = mixed.groupBy("h", "context").agg(F.count("*").alias("copies"), F.min(F.struct("x", "y", "begin", "end", "at")).alias("one"))
    distinct = stage(distinct, "contexts")
    full = stage(distinct.where("copies > 1").select("h", "context"), "repeated-contexts")
    spans = spans.unionByName(attach(mixed, full, ["h", "context"]).select(*span))

    counts = stage(distinct.groupBy("h").agg(F.count("*").alias("contexts")), "context-counts")
    told = F.struct("h", "one.begin", "one.end", "one.at", "copies", "contexts").alias("w")
    wanted = shuffled(distinct, counts, ["h"]).select("one.x", "one.y", told)
    wanted = wanted.groupBy("x", "y").agg(F.collect_list("w").alias("wanted"))  # at most some per 100 bytes of one text
    fetched = shuffled(long_enough, wanted, ["x", "y"]).dropDuplicates(["x", "y"]).select("x", "y", "text", "wanted")
    pieces = stage(fetched.mapInPandas(_contexts(params.length), PIECE), "pieces")
    small = pieces.where(F.col("contexts") <= params.group_contexts).drop("contexts")
    spans = spans.unionByName(map_groups(small, ["h"], _sort_groups(params), "x long, y long, begin long, end long"))

    large = pieces.where(F.col("contexts") > params.group_contexts).drop("contexts")
    return spans.unionByName(_narrowed(large, params.length, params.widths))


# ---------------------------------------------------------------- cutting


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans as maximal runs; runs that touch are one."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.r_[True, begin[1:] > end[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(begin) - 1]
    return begin[new], end[last]


def cut(text: bytes, spans: np.ndarray | None) -> tuple[list[bytes], int]:
    """The pieces left of a text, and the number of runs removed."""
    if spans is None or not len(spans):
        return [text], 0
    begin, end = merged(np.array([s["begin"] for s in spans]), np.array([s["end"] for s in spans]))
    starts, stops = [0, *end.tolist()], [*begin.tolist(), len(text)]
    return [text[a:b] for a, b in zip(starts, stops, strict=True)], len(begin)


def _digests():
    def run(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, spans, passages in parts:
            rows = []
            for raw, s, q in zip(texts, spans, passages, strict=True):
                text = bytes(raw or b"")
                left, n = cut(text, s)
                kept = sum(map(len, left))
                clean, _ = cut(text, q)
                rows.append((
                    len(text), len(text) - kept, n, hashlib.sha256(b"".join(left)).hexdigest(), len(text) - sum(map(len, clean)),
                    None if raw is None else "".join(p.decode("utf-8", "ignore") for p in clean),
                ))
            yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_bytes", "text"])

    return F.pandas_udf(run, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_bytes long, text string")


def _remaining():
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, spans in parts:
            yield pd.Series([
                None if t is None else "".join(p.decode("utf-8", "ignore") for p in cut(bytes(t), s)[0])
                for t, s in zip(texts, spans, strict=True)
            ])

    return F.pandas_udf(run, "string")


SEGMENT = "x long, y long, at long, c1 long, c2 long, piece binary"


def _segments(length: int):
    """Runs of at least ``length`` bytes that the spans of a text make: start, digest ``c1, c2``, bytes."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SEGMENT.split(", ")]
        for frame in frames:
            out: list[tuple] = []
            for x, y, text, spans in zip(frame["x"], frame["y"], frame["text"], frame["passages"], strict=True):
                begin, end = merged(np.array([s["begin"] for s in spans]), np.array([s["end"] for s in spans]))
                for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                    if b - a >= length:
                        piece = bytes(text[a:b])
                        out.append((x, y, a, *(int.from_bytes(d, "big", signed=True) for d in _halves(piece)), piece))
                if len(out) >= 5000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    return run


def _within(keyed: DataFrame, passages: DataFrame, params: Params) -> DataFrame:
    """Spans ``x, y, begin, end`` of windows that occur again, looked for in ``passages`` only.

    ``passages`` lists per key the spans of repeated strings that are shorter than ``length``;
    a window that occurs again lies in one run of these.  A run that occurs twice repeats
    altogether; of the distinct runs one copy each is searched.
    """
    reach = F.array_max(F.col("passages.end")) - F.array_min(F.col("passages.begin"))
    texts = shuffled(keyed.select("x", "y", F.col("text").cast("binary").alias("text")), passages.where(reach >= params.length), ["x", "y"])
    runs = stage(texts.mapInPandas(_segments(params.length), SEGMENT), "runs")
    alike = runs.groupBy("c1", "c2").agg(F.count("*").alias("copies"), F.min(F.struct("x", "y", "at")).alias("one"))
    alike = stage(alike, "run-copies")
    many = alike.where("copies > 1").select("c1", "c2")
    whole = attach(runs.select("x", "y", "at", "c1", "c2", F.octet_length("piece").alias("n")), stage(many, "repeated-runs"), ["c1", "c2"])
    spans = whole.select("x", "y", F.col("at").alias("begin"), (F.col("at") + F.col("n")).alias("end"))
    ones = shuffled(alike.select("c1", "c2", "one.*"), runs, ["c1", "c2", "x", "y", "at"]).dropDuplicates(["c1", "c2"])
    found = repeated_spans(stage(ones.select(F.col("c1").alias("x"), F.col("c2").alias("y"), F.col("piece").alias("text")), "distinct-runs"), params)
    single = alike.where("copies = 1").select(F.col("c1"), F.col("c2"), "one.*")
    found = shuffled(found.withColumnsRenamed({"x": "c1", "y": "c2"}), single, ["c1", "c2"])
    return spans.unionByName(found.select("x", "y", (F.col("begin") + F.col("at")).alias("begin"), (F.col("end") + F.col("at")).alias("end")))


def removals(keyed: DataFrame, x: str, y: str, text: str, params: Params) -> DataFrame:
    """Per key ``x, y`` of a text with repeats, the list ``spans`` of what to remove."""
    plain = keyed.select(F.col(x).alias("x"), F.col(y).alias("y"), F.col(text).cast("binary").alias("text"))
    return listed(repeated_spans(plain, params))


def listed(spans: DataFrame) -> DataFrame:
    """Per key ``x, y`` the list of its spans."""
    return spans.groupBy("x", "y").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


def dedup(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Params = Params(), passage: int = PASSAGE
) -> DataFrame:
    """What is left without repeated strings: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else too,
    in the same document or another; all copies go.  Strings never run over a
    document's end, and are judged on the texts as given.  Two more columns tell the same
    of strings of ``passage`` bytes, at most ``length``: ``n_passage_bytes``, how many bytes
    they cover, and ``text``, what is left as text (see ``without_repeats``).

    A string of ``length`` bytes that repeats lies within one run of repeated strings of
    ``passage`` bytes, so only these runs, one copy of each, are searched for it.

    Defined cases: a null text counts as empty, and its ``text`` is null; texts shorter than
    ``passage`` stay whole; a null doc_id is kept as such; repeated rows are copies of each
    other, so long ones go altogether, and each gets its row; an empty table gives no rows;
    other columns are not looked at.
    """
    if not params.gram <= passage <= params.length:
        raise ValueError("passage must lie between gram and length")
    docs = as_documents(documents, doc_id, text)
    keyed = docs.withColumns(dict(zip("xy", text_key("doc_id", "text"), strict=True)))
    short = stage(removals(keyed, "x", "y", "text", replace(params, length=passage)).withColumnRenamed("spans", "passages"), "passages")
    long = listed(_within(keyed, short, params))
    out = shuffled(keyed, short, ["x", "y"], "left").join(long, ["x", "y"], "left")
    return out.select("doc_id", _digests()(F.col("text").cast("binary"), F.col("spans"), F.col("passages")).alias("d")).select("doc_id", "d.*")


def without_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Params = Params()) -> DataFrame:
    """The documents with repeated strings cut out of their texts, other columns as they are.

    Where a cut falls inside a character, what is left of the character goes too.  A null
    text stays null; a text that repeats altogether becomes empty.
    """
    x, y, spans = (free_name(documents, n) for n in ("key_x", "key_y", "spans"))
    keyed = documents.withColumns(dict(zip((x, y), text_key(doc_id, text), strict=True)))
    found = removals(keyed, x, y, text, params)
    found = found.select(F.col("x").alias(x), F.col("y").alias(y), F.col("spans").alias(spans))
    left = _remaining()(F.col(text).cast("binary"), F.col(spans))
    joined = keyed.join(found, [x, y], "left")
    return joined.withColumn(text, F.when(F.col(spans).isNull(), F.col(text)).otherwise(left)).select(*documents.columns)
