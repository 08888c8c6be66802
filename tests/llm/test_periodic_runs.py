"""Runs of repeated words against a plain search."""

import random
import zlib

import edge
import numpy as np
import pytest

from siltstone.llm import periodic_runs
from siltstone.llm.periodic_runs import Params


def plain_runs(words, least=6, times=4):
    """Every maximal stretch of each period; of equal stretches the smallest period counts."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            e = i
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e > i and e + q - i >= max(least, times * q):
                found.setdefault((i, e + q - i), q)
            i = max(e, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text, plant=True):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    words = planted(words, doc_id) if plant else words
    found = plain_runs(words)
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc_id, len(found), *told, edge.sha(listed.encode()), edge.sha(" ".join(w for k, w in enumerate(words) if k not in gone).encode()))


def test_agreement_of_suffixes():
    rng = random.Random(2)
    for _ in range(60):
        text = np.array([rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.choice([1, 2, 7, 40, 90]))])
        found, n = periodic_runs.Agreement(text), len(text)
        order = sorted(range(n + 1), key=lambda i: text[i:].tolist())
        assert found.rank[order].tolist() == list(range(n + 1))
        pairs = [(i, j) for i in range(n + 1) for j in range(n + 1) if i != j]
        for (i, j), length in zip(pairs, found(*np.array(pairs).T).tolist(), strict=True):
            k = 0
            while max(i, j) + k < n and text[i + k] == text[j + k]:
                k += 1
            assert k == length


@pytest.mark.parametrize(("least", "times"), [(6, 4), (2, 2), (9, 3)])
def test_runs_against_a_plain_search(least, times):
    rng = random.Random(5)
    texts = [[], [1], [1] * 5, [1] * 6, [1] * 7, [1, 2] * 4, [1, 2] * 4 + [1], [1, 1, 2] * 5, [0, *([1, 2, 3] * 4), 1, 4]]
    for _ in range(400):
        text = []
        while len(text) < rng.choice([5, 30, 120]):
            root = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 9))]
            text += root * rng.randrange(1, 7) + root[: rng.randrange(len(root) + 1)]
        texts.append(text)
    params = Params(least, times)
    for text, found in zip(texts, periodic_runs.runs_of_texts(texts, params), strict=True):
        assert [tuple(r) for r in found.tolist()] == plain_runs(text, least, times), text
    for text in texts:  # and with a tree over the whole text
        assert [tuple(r) for r in periodic_runs.runs(np.array(text, np.int64), params).tolist()] == plain_runs(text, least, times), text


def test_collapse_edges(spark):
    rows = [r for r in edge.documents() if len(r[1] or "") < 20_000]
    rows += [(k, edge.prose(random.Random(k), 40 + k % 90, 12), None, None, None) for k in range(100, 300)]
    rows += [(300, "go " * 500 + "stop " + "a b c " * 9, None, None, None), (301, "x\x1cx x\x1cx " * 9, None, None, None)]
    df = edge.frame(spark, rows, clashes=True)
    out = periodic_runs.collapse(df, planted=True)
    assert out.columns == ["doc_id", *(c.split()[0] for c in periodic_runs.RESULT.split(", "))]
    assert edge.rows_of(out) == sorted((expected(r[0], r[1]) for r in rows), key=repr)
    assert edge.rows_of(periodic_runs.collapse(df)) == sorted((expected(r[0], r[1], False) for r in rows), key=repr)
    (row,) = periodic_runs.collapse(df.where("doc_id = 300"), with_text=True).collect()
    assert row.collapsed == "go stop a b c" and row.n_runs == 2 and (row.start, row.length, row.period) == (0, 500, 1)
    assert periodic_runs.collapse(edge.frame(spark, []), planted=True).count() == 0


def test_a_very_long_text(spark):
    rng = random.Random(1)
    root = [f"w{rng.randrange(30_000)}" for _ in range(20_000)]
    words = [f"v{k}" for k in range(50_000)] + root * 4 + root[:99] + ["end"] + ["z"] * 3000
    (row,) = periodic_runs.collapse(edge.frame(spark, [(1, " ".join(words), None, None, None)])).collect()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (2, 50_000, 80_099, 20_000, 4004)
    left = words[:70_000] + ["end", "z"]
    assert row.collapsed_sha256 == edge.sha(" ".join(left).encode())
