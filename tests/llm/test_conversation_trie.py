"""The prefix trie of conversations against one built turn by turn."""

import random
import zlib
from collections import Counter, defaultdict

import edge
import pytest

from siltstone.llm import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, rebuild):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [(r, x) for *_, r, x in sorted(v, key=lambda v: v[:2])] for c, v in turns.items()}
    if rebuild:
        h = {c: zlib.crc32(str(c).encode()) % 9 for c in turns}
        base = {c: c - (abs(c) % 5) * (1 if c >= 0 else -1) for c in turns}
        turns = {c: turns.get(base[c], [])[: h[c]] + turns[c][h[c] :] for c in turns}
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in turns.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(own) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(
        (
            (min(own), len(p), min(members[p[:-1]]) if p else None, len(own), children[p], leaves[p], saved[p], edge.sha(",".join(map(str, sorted(ends[p]))).encode()))
            for p, own in members.items()
        ),
        key=repr,
    )


def conversations():
    """Shared starts of every length, copies, ends at every depth, null and equal values, ids below 0."""
    rng = random.Random(4)
    rows = []
    for c in [*range(-12, 90), 5000, 5001, 9007, 10**15 + 3]:
        starts = [("system", "be kind"), ("user", "hëllo"), ("assistant", ""), ("user", None), (None, "x"), ("user", "again")]
        turns = starts[: rng.randrange(7)] + [("user", f"q{rng.randrange(3)}") for _ in range(rng.randrange(1, 8))]
        rows += [(c, k * 3 - 2, r, t) for k, (r, t) in enumerate(turns)]
    rows += [(c, k, "user", f"same {k}") for c in range(200, 240) for k in range(9)]
    rows += [(c, 0, "user", "one") for c in range(20_000, 20_400)]  # more ids at an end than a range holds
    rows += [(301, None, "user", "first"), (301, -(2**63), "user", "second"), (301, 7, None, None)]
    rows += [(302, 5, "user", "copy")] * 150 + [(302, 6, "user", "last")]
    rows += [(303, 3000 - 20 * k, "user", f"t{k % 7}") for k in range(140)] + [(None, 1, "user", "lost"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rebuild", [True, False])
def test_trie_edges(spark, rebuild, monkeypatch):
    monkeypatch.setattr(conversation_trie, "COPIES", 64)
    monkeypatch.setattr(conversation_trie, "IDS_BITS", 6)
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'extra' AS pos", "1 AS k", "2 AS depth", "3 AS n", "4 AS conv")
    out = conversation_trie.prefix_trie(df, rebuild=rebuild)
    assert out.columns == COLUMNS
    assert edge.rows_of(out) == plain(rows, rebuild)


def test_block_size_does_not_matter(spark):
    rows = [r for r in conversations() if r[0] is not None and r[0] < 220]
    df = spark.createDataFrame(rows, SCHEMA)
    for block in (1, 7):
        assert edge.rows_of(conversation_trie.prefix_trie(df, params=conversation_trie.Params(block))) == plain(rows, False)


def test_no_conversation_and_conversations_without_turns(spark):
    assert conversation_trie.prefix_trie(spark.createDataFrame([], SCHEMA), rebuild=True).count() == 0
    alone = next(c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    rows = [(alone, 1, "user", "gone")]
    out = conversation_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), rebuild=True)
    assert edge.rows_of(out) == plain(rows, True) and out.first().n_leaves == 1
