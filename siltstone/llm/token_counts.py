"""Token counts by rank-synchronous merging of ragged arrays.

Texts are normalised and parted into words as the tokenizer does; the new words of a
batch lie end to end in one array of symbols.  A round looks up the rank of every
neighbouring pair, takes each word's lowest, and merges that pair everywhere in the word;
all words go on together until none has a pair with a rank.  What survives is counted.

Merging all places of a word's lowest pair at once gives the library's result because no
two merges of the file make the same symbol (checked on loading): a pair with the new
symbol can then only have a higher rank.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

LIMIT = 2048
CACHE_WORDS = 250_000
LONG = 1024  # bytes from which on a word's places are indexed by rank
# All versions of Unicode class and lower-case these characters alike, and none is part of a composition.
SURE = re.compile("[^\t\n\r -~¡-įĲ-ɏ‐-‧€]")


def default_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


class Counter:
    """One tokenizer file of word BPE, its merges as sorted arrays, and the words counted so far."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        config["truncation"] = config["padding"] = None
        model = config["model"]
        vocab = model["vocab"]
        self.tokenizer = Tokenizer.from_str(json.dumps(config))
        suffix = model.get("end_of_word_suffix") or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [vocab[a + b] for a, b in merges]
        if len(set(made)) < len(made):
            raise ValueError("two merges make the same symbol")
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges])
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order, np.array(made)[order]
        self.made_by_rank = np.array(made)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        char = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.byte_of = {c: b for b, c in char.items()}
        self.inner = np.array([vocab[char[b]] for b in range(256)])
        self.last = np.array([vocab[char[b] + suffix] for b in range(256)])
        specials = sorted((t["content"] for t in config["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        split = config["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(split)
        self.counts: dict[str | bytes, int] = {}

    def merged(self, words: list[bytes]) -> np.ndarray:
        """Number of symbols left of each word (not empty), all merged in step."""
        lengths = np.array([len(w) for w in words])
        symbols = self.inner[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[np.frombuffer(b"".join(w[-1:] for w in words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        left = np.zeros(len(words), np.int64)
        none = len(self.keys)
        while len(symbols):
            pair = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), none - 1)
            ranked = (self.keys[at] == pair) & (word[:-1] == word[1:])
            rank = np.append(np.where(ranked, self.ranks[at], none), none)
            begins = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.minimum.reduceat(rank, begins)
            sizes = np.diff(np.append(begins, len(symbols)))
            open_ = low < none
            left[word[begins[~open_]]] = sizes[~open_]
            hit = (rank == np.repeat(low, sizes)) & (rank < none)
            # A run of one symbol, as in aaa, merges from the left: every second place of it.
            place = np.arange(len(hit))
            run = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], place, 0))
            hit &= (place - run) % 2 == 0
            first = np.flatnonzero(hit)
            symbols[first] = self.made[at[first]]
            stays = np.repeat(open_, sizes)
            stays[first + 1] = False
            symbols, word = symbols[stays], word[stays]
        return left

    def merged_long(self, word: bytes) -> int:
        """Number of symbols left of one long word; each round touches the merged places and their neighbours."""
        n, none = len(word), len(self.keys)
        symbols = np.append(self.inner[np.frombuffer(word, np.uint8)], 0)  # one more, for the word's end
        symbols[n - 1] = self.last[word[-1]]
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        rank = np.full(n + 1, none)
        waiting: dict[int, list[np.ndarray]] = {}
        lowest: list[int] = []

        def look(places: np.ndarray) -> None:
            """Rank the pairs that begin at some places, and note the places by rank."""
            pair = symbols[places] * self.size + symbols[after[places]]
            at = np.minimum(np.searchsorted(self.keys, pair), none - 1)
            found = np.where((self.keys[at] == pair) & (after[places] < n), self.ranks[at], none)
            rank[places] = found
            order = np.argsort(found, kind="stable")
            order = order[: np.searchsorted(found[order], none)]
            if not len(order):
                return
            ranks, places = found[order], places[order]
            cuts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
            for r, a, b in zip(ranks[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(ranks)], strict=True):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(lowest, r)
                waiting[r].append(places[a:b])

        look(np.arange(n))
        left = n
        while lowest:
            r = heapq.heappop(lowest)
            noted = waiting.pop(r)
            places = np.unique(np.concatenate(noted)) if len(noted) > 1 else noted[0]
            places = places[rank[places] == r]  # others were merged or have another neighbour since
            if not len(places):
                continue
            # A run of one symbol merges from the left, as above.
            k = np.arange(len(places))
            follows = np.r_[False, places[1:] == after[places[:-1]]]
            places = places[(k - np.maximum.accumulate(np.where(follows, 0, k))) % 2 == 0]
            gone = after[places]
            symbols[places] = self.made_by_rank[r]
            rank[gone] = none
            after[places] = after[gone]
            before[after[places]] = places
            left -= len(places)
            above = before[places]
            look(np.unique(np.concatenate([places, above[above >= 0]])))
        return left

    def _split(self, text: str) -> list[str] | list[bytes]:
        """The words of a part without special strings; those found by the library as bytes."""
        if SURE.search(text):
            normal = self.tokenizer.normalizer.normalize_str(text)
            found = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
            return [bytes(map(self.byte_of.__getitem__, w)) for w, _ in found]
        return self.pattern.findall(text.lower())

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        total, parted = [], []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            total.append(len(parts) - 1)
            words = self._split(parts[0]) if len(parts) == 1 else [w for p in parts for w in self._split(p)]
            parted.append(words)
        if len(self.counts) > CACHE_WORDS:
            self.counts.clear()
        new = [w for w in set().union(*parted) if w not in self.counts]
        raw = [w if isinstance(w, bytes) else w.encode() for w in new]
        # Long words take many rounds: they are merged among their like.
        order = sorted(range(len(new)), key=lambda k: len(raw[k]))
        while order and len(raw[order[-1]]) >= LONG:
            k = order.pop()
            self.counts[new[k]] = self.merged_long(raw[k])
        for start in range(0, len(order), 4096):
            some = order[start : start + 4096]
            for k, n in zip(some, self.merged([raw[k] for k in some]).tolist(), strict=True):
                self.counts[new[k]] = n
        known = self.counts
        return [n + sum(map(known.__getitem__, words)) for n, words in zip(total, parted, strict=True)]


def _counted(path: str):
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(path)
        for texts in parts:
            listed = [t or "" for t in texts]
            yield pd.Series([n for k in range(0, len(listed), 256) for n in counter.count(listed[k : k + 256])], dtype="int64")

    return F.pandas_udf(run, "long")


def token_counts(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, limit: int = LIMIT
) -> DataFrame:
    """Token count of every whole text: ``doc_id, n_bytes, n_tokens, over_limit``.

    Counts are those of the library for the file, without begin or end tokens; the
    strings of special tokens count as one token each.  Defined cases: a null text counts
    as empty (0 bytes, 0 tokens); a null doc_id is kept; repeated rows come out as often;
    an empty table gives no rows; other columns are not looked at; a text of any length
    is counted whole.
    """
    counted = _counted(path or default_path())(F.col(text).cast("string"))
    size = F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long")
    out = documents.select(F.col(doc_id).alias("doc_id"), size.alias("n_bytes"), counted.alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
