"""Scores of whole texts by a gated recurrent language model, learned from the corpus itself.

1. Every task counts its training tokens; a shuffle adds the counts up.  The most frequent
   words are the network's, all others share its symbol for the rest.
2. Every task trains a copy of the network on its training texts, by backpropagation
   truncated to windows of some words; copies are averaged by the tokens they saw, slot by
   slot in a shuffle, and the next round goes on from the average.  All training texts
   are used, a part of them in each round.
3. Every text is read word by word from its begin to its end token.  The state is carried
   from window to window, so the score is that of the complete text.

The softmax is factored: the class of the next symbol first, then the symbol within its class
(by frequency).  A word of the rest costs the rest's symbol and its share of the rest's counts.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import Columns, map_groups, stage

END = xxhash.xxh3_64_intdigest(b" ")  # the end token's key; no word holds a blank
WORD_TABLE = 300_000  # words a worker remembers at once


@dataclass(frozen=True)
class Params:
    """``words`` symbols of the network in classes of ``class_size``; ``known`` words counted in every task.

    Up to ``lanes`` texts are read side by side in windows of ``window`` words; a worker holds about
    ``group`` tokens at once, so that a long text does not leave the other lanes idle, and
    trains on parts of ``part`` tokens.
    """

    words: int = 512
    class_size: int = 16
    known: int = 65_536
    hidden: int = 16
    window: int = 16
    lanes: int = 512
    group: int = 1 << 22
    part: int = 1024
    rounds: int = 2
    rate: float = 0.1
    seed: int = 7


def words_of(text: bytes | None) -> list[bytes]:
    """Words with A-Z lower-cased; of bytes, split() parts at 0x09 to 0x0D and the blank alone."""
    return bytes(text).lower().split() if text else []


# ---------------------------------------------------------------- counts


def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: Counter = Counter()
    texts = 0

    def table() -> pd.DataFrame:
        keys = np.array([xxhash.xxh3_64_intdigest(w) for w in seen], np.uint64).view(np.int64)
        return pd.DataFrame({"h": keys, "n": np.fromiter(seen.values(), np.int64, len(seen))})

    for frame in frames:
        for text in frame["text"]:
            seen.update(words_of(text))
            texts += 1
            if len(seen) > WORD_TABLE:
                yield table()
                seen.clear()
    yield table()
    if texts:
        yield pd.DataFrame({"h": np.array([END], np.uint64).view(np.int64), "n": [texts]})


@dataclass
class Vocabulary:
    """Counts of the corpus: the most frequent words by key, and the sums over all."""

    keys: np.ndarray
    counts: np.ndarray
    ends: int
    tokens: int
    types: int
    words: int

    def __post_init__(self) -> None:
        self.own = min(self.words - 2, len(self.keys))
        self.size = self.own + 2  # symbols of the network: the end, the rest, and its words
        inside = int(self.counts[: self.own].sum()) + self.ends
        self.rest_tokens = self.tokens - inside
        self.rest_types = self.types - self.own - (self.ends > 0)
        #: By symbol, and beyond the network by place among the known words.
        self.logs = np.log10(np.r_[self.ends, 0, self.counts].astype(np.float64) + 1)
        self.mass = np.r_[self.ends + 1, self.rest_tokens + self.rest_types + 1, self.counts[: self.own] + 1].astype(np.float64)


class Symbols(dict):
    """Numbers of words: 0 the end, 2 and more the known words, beyond these the words met so far."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.known = {h: k + 2 for k, h in enumerate(vocabulary.keys.view(np.uint64).tolist())}
        self.first = len(self.known) + 2
        self.rare: list[int] = []

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        k = self.known.get(h)
        if k is None:
            k = self.first + len(self.rare)
            self.rare.append(h)
        self[word] = k
        return k

    def of(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The numbers of each text's words and its end; those of rare words hold until the next call."""
        if len(self) > WORD_TABLE:
            self.clear()
            self.rare = []
        out = []
        for text in texts:
            found = words_of(text)
            row = np.zeros(len(found) + 1, np.int64)
            row[:-1] = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
            out.append(row)
        return out


class Inputs:
    """Numbers of words as the network's symbols: 0 the end, 1 the rest, 2 and more its own words.

    Words are told apart by keys until all the network's own have been met; from then on
    any other word is of the rest, and none but the own ones are looked up.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.size, self.own = vocabulary.size, vocabulary.own
        self.symbols = Symbols(vocabulary)
        self.met: dict[bytes, int] = {}

    def of(self, texts: list[bytes | None]) -> list[np.ndarray]:
        return [self._row(text) for text in texts]

    def _row(self, text: bytes | None) -> np.ndarray:
        if len(self.met) < self.own:
            row = inside(self.symbols.of([text])[0], self.size)
            self.met |= {w: k for w, k in zip(words_of(text), row.tolist(), strict=False) if k > 1}
            return row
        found = words_of(text)
        row = np.zeros(len(found) + 1, np.int32)
        row[:-1] = np.fromiter(map(self.met.get, found, repeat(1)), np.int32, len(found))
        return row


# ---------------------------------------------------------------- network

PARTS = ("enter", "bias", "keep", "pick", "pick_bias", "word", "word_bias")


def _order(numbers: np.ndarray, size: int) -> np.ndarray:
    """Stable order of numbers below ``size``; those of 16 bits are sorted by their digits."""
    return np.argsort(numbers.astype(np.uint16) if size <= 1 << 16 else numbers, kind="stable")


def _one_over_one_and_exp(x: np.ndarray) -> None:
    """1 / (1 + exp(x)) in place; 0 where the exponential is beyond all numbers, for callers that ignore that."""
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)


class Network:
    """Gates of a recurrent layer over an input table, and two softmax layers."""

    def __init__(self, vocabulary: Vocabulary, params: Params, flat: np.ndarray | None = None) -> None:
        self.params, h, s = params, params.hidden, params.class_size
        self.classes = -(-vocabulary.size // s)
        size = self.classes * s
        shapes = [(size, 3 * h), (3 * h,), (h, 3 * h), (self.classes, h), (self.classes,), (size, h), (size,)]
        self.bounds = np.cumsum([0, *(math.prod(x) for x in shapes)])
        if flat is None:
            rng = np.random.default_rng(params.seed)
            flat = (rng.standard_normal(self.bounds[-1]) * 0.1).astype(np.float32)
        self.flat = flat
        for name, shape, a, b in zip(PARTS, shapes, self.bounds, self.bounds[1:], strict=False):
            setattr(self, name, flat[a:b].reshape(shape))
        self.unused = np.arange(size) >= vocabulary.size

    def start(self, mass: np.ndarray) -> Network:
        """Biases that give every symbol its share of the corpus."""
        padded = np.r_[mass, np.zeros(len(self.word_bias) - len(mass))].reshape(self.classes, -1)
        self.bias[:] = 0
        self.pick_bias[:] = np.log(padded.sum(axis=1) / padded.sum())
        self.word_bias[:] = np.where(self.unused, -1e4, np.log(np.maximum(padded / padded.sum(axis=1, keepdims=True), 1e-30)).ravel())
        return self

    @np.errstate(over="ignore")
    def forward(self, inputs: np.ndarray, carry: np.ndarray, state: np.ndarray, back: bool = True) -> tuple[np.ndarray, list[tuple]]:
        """States after each step of a window [steps, lanes], and with ``back`` what the way back needs."""
        h = self.params.hidden
        # Gates are 1 / (1 + exp(-x)), and tanh(x) is 2 / (1 + exp(-2 x)) - 1, with the signs put in beforehand.
        table = self.enter + self.bias
        table[:, : 2 * h] *= -1
        table[:, 2 * h :] *= -2
        # Lanes lie along the last axis, so that every operation runs over long rows.
        entered = np.ascontiguousarray(table[inputs].transpose(0, 2, 1))
        states = np.empty((len(inputs), h, inputs.shape[1]), entered.dtype)
        steps = []
        keep = self.keep.T.copy()
        keep[: 2 * h] *= -1
        state = np.ascontiguousarray(state.T)
        for t in range(len(inputs)):
            before = state * carry[t]
            kept = keep @ before
            gates = kept[: 2 * h] + entered[t, : 2 * h]
            _one_over_one_and_exp(gates)
            z, r, inner = gates[:h], gates[h:], kept[2 * h :]
            new = r * inner
            new *= -2
            new += entered[t, 2 * h :]
            _one_over_one_and_exp(new)
            new *= 2
            new -= 1
            state = states[t]
            np.subtract(before, new, out=state)
            state *= z
            state += new
            if back:
                steps.append((before, z, r, new, inner))
        return np.ascontiguousarray(states.transpose(0, 2, 1)), steps

    def log_softmax(
        self, states: np.ndarray, weights: np.ndarray, bias: np.ndarray, targets: np.ndarray, slopes: bool, most: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """Natural logarithms of the targets' shares; with ``slopes``, all shares less 1 at the targets.

        ``most`` is a bound of the scores: states lie within -1 and 1.
        """
        scores = states @ weights.T
        scores += bias
        if most > 60:  # only large ones need to be shifted
            scores -= scores.max(axis=1, keepdims=True)
        at = np.arange(len(targets)) * scores.shape[1] + targets
        chosen = scores.ravel()[at]
        shares = np.exp(scores, out=scores)
        sums = shares @ np.ones(shares.shape[1], np.float32)
        if slopes:
            shares *= (1 / sums)[:, None]
            shares.ravel()[at] -= 1
        return chosen - np.log(sums), shares

    def output(self, states: np.ndarray, targets: np.ndarray, grad: Network | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log probability of each target after its state; with ``grad``, the loss's slopes too."""
        s = self.params.class_size
        kind, place = targets // s, targets % s
        bounds = [np.abs(w).sum(axis=1) + b for w, b in ((self.pick, self.pick_bias), (self.word, self.word_bias))]
        most = bounds[1].reshape(self.classes, s).max(axis=1).tolist()
        logs, shares = self.log_softmax(states, self.pick, self.pick_bias, kind, grad is not None, bounds[0].max())
        back = None
        if grad is not None:
            grad.pick += shares.T @ states
            grad.pick_bias += shares.sum(axis=0)
            back = shares @ self.pick
        order = _order(kind, self.classes)
        cuts = np.searchsorted(kind[order], np.arange(self.classes + 1)).tolist()
        # Put in order once, so that each class is a stretch of rows.
        states, place = states[order], place[order]
        logs_there = np.empty(len(order), logs.dtype)
        back_there = None if grad is None else np.empty_like(states)
        for c in range(self.classes):
            some = slice(cuts[c], cuts[c + 1])
            if cuts[c] == cuts[c + 1]:
                continue
            own, at = states[some], slice(c * s, (c + 1) * s)
            logs_there[some], shares = self.log_softmax(own, self.word[at], self.word_bias[at], place[some], grad is not None, most[c])
            if grad is not None:
                grad.word[at] += shares.T @ own
                grad.word_bias[at] += shares.sum(axis=0)
                np.matmul(shares, self.word[at], out=back_there[some])
        logs[order] += logs_there
        if grad is not None:
            back[order] += back_there
        return logs, back

    def backward(self, inputs: np.ndarray, carry: np.ndarray, steps: list[tuple], back: np.ndarray, grad: Network) -> None:
        """Slopes of the recurrent part; ``back`` are those of the window's states."""
        h, (count, lanes) = self.params.hidden, inputs.shape
        entered = np.empty((count, 3 * h, lanes), back.dtype)
        kept = np.empty((3 * h, lanes), back.dtype)
        slopes = np.ascontiguousarray(back.transpose(0, 2, 1))
        later = np.zeros((h, lanes), back.dtype)
        for t in range(count - 1, -1, -1):
            before, z, r, new, inner = steps[t]
            d = slopes[t]
            d += later
            rise = new * new
            np.subtract(1, rise, out=rise)
            rise *= 1 - z
            rise *= d
            at = entered[t]
            np.multiply(d, before - new, out=at[:h])
            at[:h] *= z * (1 - z)
            np.multiply(rise, inner, out=at[h : 2 * h])
            at[h : 2 * h] *= r * (1 - r)
            at[2 * h :] = rise
            kept[: 2 * h] = at[: 2 * h]
            np.multiply(rise, r, out=kept[2 * h :])
            later = self.keep @ kept
            later += d * z
            later *= carry[t]
            grad.keep += before @ kept.T
        flat, words = entered.transpose(0, 2, 1).reshape(-1, 3 * h), inputs.ravel()
        grad.bias += flat.sum(axis=0)
        order = _order(words, len(self.enter))
        first = np.flatnonzero(np.r_[True, np.diff(words[order]) > 0])
        grad.enter[words[order][first]] += np.add.reduceat(flat[order], first, axis=0)


@dataclass
class Lanes:
    """Texts laid end to end in lanes of about equal length, longest lane first."""

    targets: np.ndarray
    first: np.ndarray
    sizes: np.ndarray
    place: np.ndarray  # of each text: its lane and where it begins

    @classmethod
    def of(cls, texts: list[np.ndarray], lanes: int) -> Lanes:
        order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
        # Few tokens are better learned from in many small steps.
        lanes = min(lanes, len(texts), 16 + math.isqrt(sum(map(len, texts))) // 2)
        sizes = np.zeros(lanes, np.int64)
        place = np.zeros((len(texts), 2), np.int64)
        shortest = [(0, lane) for lane in range(lanes)]
        for k in order:
            size, lane = shortest[0]
            place[k] = lane, size
            sizes[lane] = size + len(texts[k])
            heapq.heapreplace(shortest, (size + len(texts[k]), lane))
        rank = np.argsort(np.argsort(-sizes, kind="stable"), kind="stable")
        place[:, 0] = rank[place[:, 0]]
        sizes = -np.sort(-sizes)
        targets = np.zeros((int(sizes.max(initial=0)), len(sizes)), np.int64)
        first = np.zeros(targets.shape, bool)
        for (lane, at), text in zip(place.tolist(), texts, strict=True):
            targets[at : at + len(text), lane] = text
            first[at, lane] = True
        return cls(targets, first, sizes, place)

    def windows(self, length: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Steps, inputs, carry, targets and which of them are real, of the lanes not yet at their end."""
        for start in range(0, len(self.targets), length):
            steps = slice(start, min(start + length, len(self.targets)))
            active = int((self.sizes > start).sum())
            targets = self.targets[steps, :active]
            # A text begins after an end token, that of the text before it or none.
            above = self.targets[start - 1, :active] if start else np.zeros(active, np.int64)
            inputs = np.concatenate([above[None], targets[:-1]])
            real = np.arange(steps.start, steps.stop)[:, None] < self.sizes[:active]
            yield steps, inputs, (~self.first[steps, :active]).astype(np.float32), targets, real


def train(network: Network, texts: list[np.ndarray], sums: np.ndarray) -> int:
    """One pass of truncated backpropagation over some texts (numbers below the network's size); returns tokens."""
    params, h = network.params, network.params.hidden
    # Parts of long texts go side by side too; here alone, the state starts anew with each.
    lanes = Lanes.of([t[k : k + params.part] for t in texts for k in range(0, len(t), params.part)], params.lanes)
    state = np.zeros((len(lanes.sizes), h), np.float32)
    for _, inputs, carry, targets, real in lanes.windows(params.window):
        states, steps = network.forward(inputs, carry, state[: inputs.shape[1]])
        grad = Network.__new__(Network)
        grad.__dict__ |= network.__dict__
        flat = np.zeros_like(network.flat)
        for name, a, b in zip(PARTS, network.bounds, network.bounds[1:], strict=False):
            setattr(grad, name, flat[a:b].reshape(getattr(network, name).shape))
        whole = slice(None) if real.all() else real.ravel()
        _, slopes = network.output(states.reshape(-1, h)[whole], targets.ravel()[whole], grad)
        back = np.zeros_like(states)
        back.reshape(-1, h)[whole] = slopes
        network.backward(inputs, carry, steps, back, grad)
        flat /= params.window * len(lanes.sizes)  # so that the last windows, of few lanes, count for less
        flat[np.abs(flat) < 1e-12] = 0
        # Steps shrink as a weight's slopes add up (Adagrad).
        sums += flat * flat
        network.flat -= params.rate * flat / (np.sqrt(sums) + 1e-6)
        state = states[-1]
    return int(lanes.sizes.sum())


def log_likelihoods(network: Network, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each complete text."""
    params = network.params
    lanes = Lanes.of(texts, params.lanes)
    # Sums from each lane's begin; a lane is one long row.
    total = np.zeros((len(lanes.sizes), len(lanes.targets) + 1))
    found = total[:, 1:]
    state = np.zeros((len(lanes.sizes), params.hidden), np.float32)
    for steps, inputs, carry, targets, real in lanes.windows(params.window):
        states, _ = network.forward(inputs, carry, state[: inputs.shape[1]], back=False)
        if real.all():
            logs = network.output(states.reshape(-1, params.hidden), targets.ravel())[0]
            found[: targets.shape[1], steps] = logs.reshape(targets.shape).T
        else:
            found[: targets.shape[1], steps].T[real] = network.output(states[real], targets[real])[0]
        state = states[-1]
    np.cumsum(found, axis=1, out=found)
    lane, at = lanes.place.T
    return total[lane, at + [len(t) for t in texts]] - total[lane, at] if len(texts) else np.zeros(0)


# ---------------------------------------------------------------- over a corpus


def inside(text: np.ndarray, size: int) -> np.ndarray:
    """A text's numbers as the network's symbols: 1, the rest, for those it has none for."""
    return np.where(text < size, text, 1).astype(np.int32)


SLOT = 4096  # weights a row
SLOT_ROW = "slot int, part int, tokens long, weights binary"


def _averaged(copies: DataFrame, size: int) -> np.ndarray | None:
    """The mean of the copies by tokens; parts of a slot are added up before they meet."""

    def add(keys: list[str]):
        def work(groups: Iterator[Columns]) -> Iterator[Columns]:
            for g in groups:
                rows = [np.frombuffer(w, np.float64) for w in g["weights"]]
                out = np.empty(1, object)
                out[0] = np.sum(rows, axis=0).tobytes()
                yield {"slot": g["slot"][:1], "part": g["part"][:1], "tokens": np.array([g["tokens"].sum()]), "weights": out}

        return lambda df: map_groups(df, keys, work, SLOT_ROW)

    rows = add(["slot"])(add(["slot", "part"])(copies)).collect()  # as many as the network has slots
    if not rows:
        return None
    flat = np.empty(size, np.float32)
    for r in rows:
        flat[r.slot * SLOT : (r.slot + 1) * SLOT] = np.frombuffer(r.weights, np.float64) / r.tokens
    return flat


def _trained(vocabulary: Vocabulary, params: Params, flat: np.ndarray):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inputs = Inputs(vocabulary)
        network = Network(vocabulary, params, flat.copy())
        sums = np.full_like(flat, 1e-6)
        tokens = part = 0
        held: list[np.ndarray] = []
        for frame in frames:
            part = part or int(frame["part"].iloc[0])
            held += inputs.of(list(frame["text"]))
            if sum(map(len, held)) >= params.group:
                tokens += train(network, held, sums)
                held = []
        if held:
            tokens += train(network, held, sums)
        if tokens:
            weights = network.flat.astype(np.float64) * tokens
            slots = range(-(-len(flat) // SLOT))
            yield pd.DataFrame({"slot": slots, "part": part, "tokens": tokens, "weights": [weights[k * SLOT : (k + 1) * SLOT].tobytes() for k in slots]})

    return run


def held_out(doc_id: str) -> Column:
    """Whether the CRC-32 of the id as text leaves 2 modulo 7 (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def fit(texts: DataFrame, params: Params = Params()) -> tuple[DataFrame, Vocabulary, np.ndarray]:
    """Counts ``h, n`` of all words of ``text`` (binary), the vocabulary, and the network's weights."""
    counts = stage(texts.select("text").mapInPandas(_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "word-counts")
    end = int(np.array([END], np.uint64).view(np.int64)[0])
    sums = counts.agg(F.sum("n"), F.count("*"), F.sum(F.when(F.col("h") == end, F.col("n")))).first()
    top = counts.where(F.col("h") != end).orderBy(F.desc("n"), "h").limit(params.known).toPandas()
    vocabulary = Vocabulary(top["h"].to_numpy(np.int64), top["n"].to_numpy(np.int64), sums[2] or 0, sums[0] or 0, sums[1], params.words)
    network = Network(vocabulary, params).start(vocabulary.mass)
    flat = network.flat
    for k in range(params.rounds):
        dealt = F.xxhash64("text")
        some = texts.where(F.pmod(dealt, F.lit(params.rounds)) == k).select("text", (F.pmod(F.shiftright(dealt, 20), F.lit(16))).cast("int").alias("part"))
        copies = some.mapInPandas(_trained(vocabulary, params, flat), SLOT_ROW)
        mean = _averaged(copies, len(flat))
        flat = flat if mean is None else mean
    return counts, vocabulary, flat


SCORED = "n_tokens long, n_known long, logs double, inner double, rest long, rest_logs double, rare array<bigint>, rare_n array<bigint>"


def _scored(vocabulary: Vocabulary, params: Params, flat: np.ndarray):
    def counted(symbols: Symbols, text: np.ndarray) -> tuple:
        """A text's sums over known words, and its rare words."""
        known = text[text < symbols.first]
        logs = vocabulary.logs[known]
        beyond = known >= vocabulary.size
        keys, n = np.unique(text[text >= symbols.first], return_counts=True)
        rare = np.array([symbols.rare[k] for k in (keys - symbols.first).tolist()], np.uint64).view(np.int64)
        rest = int(beyond.sum()) + len(text) - len(known)
        return len(text), len(known) - (vocabulary.ends == 0), float(logs.sum()), rest, float(logs[beyond].sum()), rare, n

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        symbols = Symbols(vocabulary)
        network = Network(vocabulary, params, flat.copy())
        frames: list[pd.DataFrame] = []
        held: list[np.ndarray] = []

        def finished() -> Iterator[pd.DataFrame]:
            found, at = log_likelihoods(network, held), 0
            for frame in frames:
                frame.insert(3, "inner", found[at : at + len(frame)])
                at += len(frame)
                yield frame

        for batch in batches:
            texts = symbols.of(list(batch))
            rows = [counted(symbols, t) for t in texts]
            frames.append(pd.DataFrame(rows, columns=["n_tokens", "n_known", "logs", "rest", "rest_logs", "rare", "rare_n"]))
            held += [inside(t, vocabulary.size) for t in texts]
            if sum(map(len, held)) >= params.group:
                yield from finished()
                frames, held = [], []
        if frames:
            yield from finished()

    return F.pandas_udf(run, SCORED)


def score(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Params = Params()) -> DataFrame:
    """Log10 probability of every whole text: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are words (A-Z lower-cased, parted by blanks and the control characters 9 to
    13) and one end.  Learned from the rows not held out: ``train_tokens`` N of V kinds;
    ``n_known`` tokens of a text occur there.  ``base_score`` is that of single tokens, each
    (count + 1) / (N + V + 1); ``score`` the network's, in which all words never met share
    one place, as they do there.  Words are told apart by 64 bits.

    Defined cases: a null text counts as empty (one token, the end); a null doc_id is not
    held out; repeated rows come out as often and count as often; where nothing can be
    learned from, counts are 0 and the network stays as it starts; an empty table gives no
    rows; other columns are not looked at.
    """
    raw = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text")
    docs = documents.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), raw)
    counts, vocabulary, flat = fit(docs.where("NOT held_out").select("text"), params)
    scored = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", _scored(vocabulary, params, flat)("text").alias("s"))
    scored = stage(scored.select("row", "doc_id", "held_out", "s.*"), "scored")  # written, so that numbers of rows hold

    rare = scored.select("row", F.inline(F.arrays_zip(F.col("rare").alias("h"), F.col("rare_n").alias("n")))).join(counts.withColumnRenamed("n", "c"), "h", "left")
    rare = rare.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("rare_logs"), F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("rare_known"))
    out = scored.drop("rare", "rare_n").join(rare, "row", "left").fillna(0, ["rare_logs", "rare_known"])
    all_, rest = (F.lit(math.log10(x)) for x in (vocabulary.tokens + vocabulary.types + 1, vocabulary.rest_tokens + vocabulary.rest_types + 1))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("rare_known")).alias("n_known"), F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("rare_logs") - F.col("n_tokens") * all_).alias("base_score"),
        (F.col("inner") / math.log(10) + F.col("rest_logs") + F.col("rare_logs") - F.col("rest") * rest).alias("score"),
    )
