"""Small documents and vectors with everything a table may hold, and plain versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Names the operators use inside, as further columns of the input.
CLASHES = "x y key key_x key_y spans size row bucket bands node guess copies salt h context begin end slot code dims v asks label_ t c b".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def prose(rng, n, vocabulary=400, stem="w"):
    return " ".join(f"{stem}{rng.randrange(vocabulary)}" for _ in range(n))


def documents():
    """Rows of SCHEMA: copies, near copies, passages, null and empty values, long texts, ties."""
    rng = random.Random(3)
    base = prose(rng, 300)
    near = base.split()
    near[10] = "changed"
    passage = prose(rng, 90, 5000, "p")
    texts = [
        base, base, " ".join(near), base.upper(), prose(rng, 250) + " " + passage + " " + prose(rng, 60),
        prose(rng, 70) + " " + passage, passage, None, "", "   \n\t ", "!!! ??? 123", "one", "one", "one two three four",
        "one two three four", "äöü ßé " * 200, "aaaa" * 3000, "x" * 900 + " " + "x" * 900, prose(rng, 40_000),
        "<|endoftext|>", "a <|endoftext|>b<|endoftext|> <|endof", "don't we'll 'tis ''re it's", "tab\tand  two   spaces \n\n end  ",
        "日本語のテキスト と 漢字", "İstanbul ΣΑΣ ﬁ ½ é     x", "All rights reserved. CC BY; General Public-License",
        "cc by cc by general public license", "Released under the MIT License.", "the cat sat on the mat", "le chat est sur la table",
        "\x00\x1c ctrl \x85 \x7f", "😀 emoji 👩‍👩‍👧 done",
    ]
    rows = [(i, t, ["en", "fr", None][i % 3], ["a", "b", None, "ä"][i % 4], len(t) if t else None) for i, t in enumerate(texts)]
    rows += [(None, base, "en", "a", 5), (None, None, None, None, None), (3, rows[3][1], "en", "b", 1), (3, rows[3][1], "en", "b", 1)]
    return rows


def frame(spark, rows=None, clashes=False):
    df = spark.createDataFrame(documents() if rows is None else rows, SCHEMA)
    for name in CLASHES if clashes else ():
        df = df.selectExpr("*", f"'extra' AS `{name}`")
    return df


def key(row):
    return tuple((v is None, str(type(v)) if v is None else "", v if v is not None else 0) for v in row)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def gram_set(text, n=5):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def groups(count, linked):
    """Smallest member reachable from each of ``count`` nodes over the pairs ``linked``."""
    root = list(range(count))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(a) for a in range(count)]


def repeated_bytes(texts, length):
    """Per text a mask of the bytes in strings of ``length`` that start twice."""
    seen = {}
    for t in texts:
        for q in range(len(t) - length + 1):
            piece = t[q : q + length]
            seen[piece] = seen.get(piece, 0) + 1
    masks = []
    for t in texts:
        mask = np.zeros(len(t), bool)
        for q in range(len(t) - length + 1):
            if seen[t[q : q + length]] > 1:
                mask[q : q + length] = True
        masks.append(mask)
    return masks
