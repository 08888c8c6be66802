"""Byte-level BPE encoding by tree concatenation, and decoding.

A text is first parted at the strings of special tokens, where the tokenizer parts it
too.  A long part is halved until its leaves are short; the leaves are encoded on their
own, and neighbours are joined from the bottom up.  At a join, a window of some tokens of
both sides is encoded again, and grows until its first token and its last one are the
tokens the two sides have there.

That suffices: the tokenizer's words are runs found from left to right without looking
back, so the words of a window and of a side run alike once they share a border (only a
word of white space depends on what follows, so no window ends in one); and inside a word
a sequence is the encoding of its text exactly if each two neighbours are (tokens of a
left part, of the window and of a right part that overlap in a token are such a
sequence).

Leaves are encoded word by word through a table of words seen.  Words are told by the
library's own pattern where this module's classes are sure to agree with it, else the
library encodes the leaf.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltstone.llm.common import Columns, map_groups

DIGESTS = ["n_tokens", "ids_sha256", "decoded_sha256"]
LEAF_CHARS = 4096
SEGMENT_CHARS = 1 << 15  # a longer text is encoded by several tasks
FIRST_WINDOW = 8
CACHE_WORDS = 500_000
PATTERN = regex.compile(public_tokenizers.PATTERN)
# All versions of Unicode class these characters alike.
SURE = re.compile("[^\t\n\r -~¡-ɏ‐-‧€]")


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_characters() -> dict[int, str]:
    """The printable character the tokenizer writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Words(dict):
    """Ids of words seen, as bytes; a word asked for the first time is encoded."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        self.merged, self.characters = tokenizer.model.tokenize, byte_characters()

    def __missing__(self, word: str) -> bytes:
        written = word.encode().decode("latin-1").translate(self.characters)
        self[word] = ids = array("I", [t.id for t in self.merged(written)]).tobytes()
        return ids


class Encoder:
    """One tokenizer file, and what a task remembers of it."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        config["truncation"] = config["padding"] = None
        self.tokenizer = Tokenizer.from_str(json.dumps(config))
        specials = sorted((t["content"] for t in config["added_tokens"]), key=len, reverse=True)
        self.special_ids = {t["content"]: np.array([t["id"]], "<u4") for t in config["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        self.known = Words(self.tokenizer)
        self.pieces = self._pieces()

    def _pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all tokens end to end, where each begins, and their lengths."""
        byte_of = {c: b for b, c in byte_characters().items()}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        tokens: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            known = all(c in byte_of for c in token)
            tokens[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        lengths = np.array([len(t) for t in tokens])
        return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths

    def leaves(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts without special tokens."""
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        return [
            np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4")
            if SURE.search(t)
            else np.frombuffer(b"".join(map(known.__getitem__, PATTERN.findall(t))), "<u4")
            for t in texts
        ]

    def flat(self, text: str) -> np.ndarray:
        """Ids of a short text, special tokens told."""
        parts = self.special.split(text) if self.special else [text]
        if len(parts) == 1:
            return self.leaves(parts)[0]
        return np.concatenate([self.special_ids[p] if k % 2 else self.leaves([p])[0] for k, p in enumerate(parts)])

    def bytes_of(self, ids: np.ndarray) -> bytes:
        flat, begins, lengths = self.pieces
        n = lengths[ids]
        ends = np.cumsum(n)
        if not len(ids):
            return b""
        at = np.repeat(begins[ids] - (ends - n), n) + np.arange(ends[-1])
        return flat[at].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.bytes_of(ids).decode("utf-8", "replace")

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the joint text of two encoded parts; the border lies between characters."""
        if not len(left) or not len(right):
            return np.concatenate([left, right])
        size = FIRST_WINDOW
        while True:
            i, j = min(size, len(left)), min(size, len(right))
            # The window begins and ends between characters.
            while i < len(left) and self._inside(left[-i]):
                i += 1
            while j < len(right) and self._inside(right[j]):
                j += 1
            text = self.bytes_of(np.concatenate([left[len(left) - i :], right[:j]])).decode()
            again = self.flat(text)
            begins_alike = i == len(left) or again[0] == left[-i]
            # How a word of white space ends hangs on what follows it.
            ends_alike = j == len(right) or (len(again) > 1 and again[-1] == right[j - 1] and not text[-1].isspace())
            if begins_alike and ends_alike:
                return np.concatenate([left[: len(left) - i], again, right[j:]])
            size *= 2

    def _inside(self, token: int) -> bool:
        """Whether a token begins inside a character."""
        flat, begins, lengths = self.pieces
        return bool(lengths[token]) and (flat[begins[token]] & 0xC0) == 0x80

    def cuts(self, text: str, size: int) -> list[int]:
        """Borders of pieces of about ``size`` characters, a power of two of them, none inside a special token."""
        count = 1 << (-(-len(text) // size) - 1).bit_length() if len(text) > size else 1
        borders = [len(text) * k // count for k in range(count + 1)]
        if self.special and count > 1:
            inside = [m.span() for m in self.special.finditer(text)]
            starts = [a for a, _ in inside]
            for k, border in enumerate(borders):
                at = bisect_left(starts, border) - 1
                if at >= 0 and border < inside[at][1]:
                    borders[k] = inside[at][0]
        return borders

    def joined(self, level: list[np.ndarray]) -> np.ndarray:
        """Pieces joined pairwise until one is left."""
        while len(level) > 1:
            level = [self.join(*level[k : k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
        return level[0]

    def tree(self, text: str) -> np.ndarray:
        """Ids of a part without special tokens."""
        borders = self.cuts(text, LEAF_CHARS)
        return self.joined(self.leaves([text[a:b] for a, b in zip(borders, borders[1:], strict=False)]))

    def encode(self, text: str | None) -> np.ndarray:
        parts = self.special.split(text or "") if self.special else [text or ""]
        ids = [self.special_ids[p] if k % 2 else self.tree(p) for k, p in enumerate(parts)]
        return np.concatenate(ids)


def _coded(path: str):
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path)
        for texts in parts:
            yield pd.DataFrame({"ids": [encoder.encode(t).astype(np.int32) for t in texts]})

    return F.pandas_udf(run, "ids array<int>")


def _decoded(path: str):
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(path)
        for lists in parts:
            yield pd.Series([None if ids is None else encoder.decode(np.asarray(ids, np.int64)) for ids in lists])

    return F.pandas_udf(run, "string")


def _digests(encoder: Encoder, ids: np.ndarray) -> tuple[int, str, str]:
    back = encoder.decode(ids).encode()
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(back).hexdigest()


def _round_trip(path: str):
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path)
        for texts in parts:
            yield pd.DataFrame([_digests(encoder, encoder.encode(t)) for t in texts], columns=DIGESTS)

    return F.pandas_udf(run, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _segments(path: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path)
        for frame in frames:
            for row, doc_id, text in zip(frame["row"], frame["doc_id"], frame["text"], strict=True):
                borders = encoder.cuts(text, SEGMENT_CHARS)
                for start in range(0, len(borders) - 1, 64):
                    some = borders[start : start + 65]
                    yield pd.DataFrame(
                        {
                            "row": row, "doc_id": doc_id, "place": range(start, start + len(some) - 1),
                            "text": [text[a:b] for a, b in zip(some, some[1:], strict=False)],
                        }
                    )

    return run


def _segment_ids(path: str):
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(path)
        for texts in parts:
            yield pd.Series([encoder.encode(t).tobytes() for t in texts])

    return F.pandas_udf(run, "binary")


def _join_segments(path: str):
    def work(groups: Iterator[Columns]) -> Iterator[Columns]:
        encoder = Encoder(path)
        for g in groups:
            order = np.argsort(g["place"])
            ids = encoder.joined([np.frombuffer(bytes(b), "<u4") for b in g["ids"][order]])
            out = dict(zip(DIGESTS, _digests(encoder, ids), strict=True))
            yield {"doc_id": g["doc_id"][:1].astype(object)} | {k: np.array([v], object) for k, v in out.items()}

    return work


def encode(df: DataFrame, text: str = "text", out: str = "ids", path: str | None = None) -> DataFrame:
    """Adds ``out``: the ids of each text, special strings in it as special tokens (null text: no ids)."""
    return df.withColumn(out, _coded(path or default_path())(F.col(text).cast("string"))["ids"])


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """Adds ``out``: the text of each list of ids (null for a null list)."""
    return df.withColumn(out, _decoded(path or default_path())(F.col(ids).cast("array<int>")))


def round_trip(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Encodes and decodes every text: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    The digests are of the ids as little-endian unsigned 32-bit integers and of the
    decoded text in UTF-8.  Defined cases: a null or empty text has no ids, and the
    digests of nothing; a null doc_id is kept; repeated rows come out as often; an empty
    table gives no rows; other columns are not looked at; a text of any length is encoded
    whole, one of more than ``SEGMENT_CHARS`` characters by several tasks, which each
    encode some of its segments.
    """
    path = path or default_path()
    docs = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    is_long = F.coalesce(F.length("text") > SEGMENT_CHARS, F.lit(False))
    short = docs.where(~is_long).select("doc_id", _round_trip(path)(F.col("text")).alias("c")).select("doc_id", "c.*")
    # The id goes through pandas as text, where a null would make numbers inexact.
    rows = docs.where(is_long).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc_id"), "text")
    segments = rows.mapInPandas(_segments(path), "row long, doc_id string, place int, text string").repartition("row", "place")
    coded = segments.select("row", "doc_id", "place", _segment_ids(path)(F.col("text")).alias("ids"))
    long_ = map_groups(coded, ["row"], _join_segments(path), "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return short.unionByName(long_.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)))
