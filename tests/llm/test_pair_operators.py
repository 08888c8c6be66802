"""Similarity joins, neighbours and suffix sorting against plain versions."""

import random
import re
from itertools import combinations

import edge
import numpy as np
import pytest

from siltstone.llm import common, cross_polytope, embedding_dedup, ngram_join, suffix_dedup

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_join(rows, threshold=0.8):
    sets = [edge.gram_set(r[1]) for r in rows]
    linked = [
        (a, b) for a, b in combinations(range(len(rows)), 2)
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9
    ]
    root = edge.groups(len(rows), linked)
    links = [sum(x in p for p in linked) for x in range(len(rows))]
    members = {r: [k for k in range(len(rows)) if root[k] == r] for r in set(root)}
    low = {r: min((rows[k][0] for k in some if rows[k][0] is not None), default=None) for r, some in members.items()}
    copies = [sum(bool(s) and s == t for t in sets) or 1 for s in sets]
    return [(r[0], low[root[k]], links[k], copies[k]) for k, r in enumerate(rows)]


@pytest.mark.parametrize("block", [512, 2])
def test_ngram_join_edges(spark, block):
    rows = edge.documents()
    out = ngram_join.join(edge.frame(spark, clashes=True), params=ngram_join.Params(block_classes=block))
    assert edge.rows_of(out.drop("kept")) == sorted(plain_join(rows), key=repr)
    assert ngram_join.join(edge.frame(spark, [])).count() == 0


def near_copies(n, changes, seed):
    rng = random.Random(seed)
    rows = []
    for g in range(3):
        base = [f"g{g}w{rng.randrange(10_000)}" for _ in range(120)]
        for k in range(n):
            text = list(base)
            for _ in range(rng.randrange(changes)):
                text[rng.randrange(len(text))] = f"new{rng.randrange(10_000)}"
            rows.append((1000 * g + k, " ".join(text), None, None, None))
    return rows


@pytest.mark.parametrize("block", [512, 7])
def test_ngram_join_of_groups_larger_than_a_block(spark, block):
    rows = near_copies(30, 6, 4)
    out = ngram_join.join(edge.frame(spark, rows), params=ngram_join.Params(block_classes=block))
    assert edge.rows_of(out.drop("kept")) == sorted(plain_join(rows), key=repr)


def test_one_of_each_group_stays(spark):
    rows = edge.documents()
    kept = ngram_join.one_of_each(edge.frame(spark, clashes=True))
    assert set(edge.CLASHES) < set(kept.columns)
    texts = [r.text for r in kept.collect()]
    expected = {(c if c is not None else f"none{k}") for k, (_, c, *_) in enumerate(plain_join(rows)) if edge.words(rows[k][1])}
    wordless = [r for r in rows if not edge.words(r[1])]
    assert len(texts) == len(expected) + len(wordless)
    assert ngram_join.one_of_each(edge.frame(spark, [])).count() == 0


def test_bands_reach_the_recall():
    p = ngram_join.Params()
    assert 1 - (1 - p.threshold**p.band_rows) ** p.bands >= p.recall > 1 - (1 - p.threshold**p.band_rows) ** (p.bands - 1)


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(8)
    pairs = [(k, k + 1) for k in range(100, 160)] + [(500, 500 + k) for k in range(1, 80)] + [(7, 7), (900, 901)]
    pairs += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(70)]
    root = edge.groups(3000, pairs)
    found = dict(map(tuple, common.components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert found == {x: root[x] for x in nodes}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(seed=0, n=300, dims=16):
    rng = np.random.default_rng(seed)
    rows = [(k, rng.standard_normal(dims).astype("f4").tolist(), k % 3) for k in range(n)]
    for k in range(0, 60, 3):
        v = np.array(rows[k][1]) + rng.standard_normal(dims) * 0.08
        rows.append((n + k, v.astype("f4").tolist(), 0))
    rows += [(n + 70 + k, rows[5][1], 1) for k in range(40)]  # a large group of copies
    rows += [(2000, None, None), (2020, [], 0), (2040, [0.0] * dims, 0), (2060, [float("nan")] * dims, 0), (2080, [None] * dims, 0)]
    rows += [(2100, [float("inf"), *[1.0] * (dims - 1)], 0), (None, rows[0][1], 0), (3, rows[3][1], 0), (2120, [1.0, 2.0], 0), (2121, [1.0, 2.25], 0)]
    return rows


def usable(rows):
    out = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            out[i] = np.array(v, np.float64)
    return out


def with_clashes(df):
    return df.selectExpr("*", *[f"'extra' AS `{n}`" for n in edge.CLASHES])


@pytest.mark.parametrize("block", [1024, 5])
def test_embedding_dedup_edges(spark, block):
    rows = vectors()
    some = usable(rows)
    ids = sorted(some)
    unit = {i: v / np.linalg.norm(v) for i, v in some.items()}
    linked = [(a, b) for a, b in combinations(range(len(ids)), 2) if len(some[ids[a]]) == len(some[ids[b]]) and unit[ids[a]] @ unit[ids[b]] >= 0.9]
    root = edge.groups(len(ids), linked)
    expected = {i: (i, 0, i, True) for i, *_ in rows if i is not None}
    for k, i in enumerate(ids):
        expected[i] = (i, sum(k in p for p in linked), ids[root[k]], root[k] == k)
    df = with_clashes(spark.createDataFrame(rows, VECTORS))
    out = embedding_dedup.dedup(df, params=embedding_dedup.Params(block_rows=block, recall=0.999999))
    assert edge.rows_of(out) == sorted(expected.values(), key=repr)
    assert embedding_dedup.dedup(spark.createDataFrame([], VECTORS)).count() == 0


def plain_neighbours(some, every=20, k=20):
    out = {}
    for q in some:
        if q % every == 0:
            scored = sorted((-float(some[q] @ v), i) for i, v in some.items() if i != q and len(v) == len(some[q]))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_neighbours_with_all_probes_are_exact(spark):
    rows = vectors()
    expected = plain_neighbours(usable(rows))
    df = with_clashes(spark.createDataFrame(rows, VECTORS))
    for block in (4096, 3):
        out = cross_polytope.neighbours(df, params=cross_polytope.Params(probes=64, tables=2, block_rows=block)).collect()
        found = {}
        for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
            found.setdefault(r.query_id, []).append((r.vec_id, r.score))
            assert r.rank == len(found[r.query_id])
        assert {q: [i for i, _ in v] for q, v in found.items()} == {q: [i for i, _ in v] for q, v in expected.items() if v}
        assert all(abs(s - t) < 1e-12 for q in found for (_, s), (_, t) in zip(found[q], expected[q], strict=True))
    assert cross_polytope.neighbours(spark.createDataFrame([], VECTORS)).count() == 0


def test_neighbours_recall_of_the_defaults(spark, small):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    some = usable([tuple(r) for r in df.collect()])
    expected = plain_neighbours(some)
    found = {(r.query_id, r.vec_id) for r in cross_polytope.neighbours(df).collect()}
    hits = sum((q, i) in found for q, v in expected.items() for i, _ in v)
    assert hits >= 0.9 * sum(map(len, expected.values()))


def test_pseudo_rotations_keep_products():
    x = np.random.default_rng(0).standard_normal((9, 50))
    for y in cross_polytope.rotations(x, 3, 1):
        assert np.allclose(y @ y.T, x @ x.T)
    assert cross_polytope.nearest_axes(np.array([[0.1, -0.9, 0.5]]), 3).tolist() == [[3, 4, 1 - 1]]


def test_two_stage_sorting_against_sorted_suffixes():
    rng = random.Random(6)
    for _ in range(200):
        letters = rng.choice(["ab", "abc", "\x00\xffz", "a"])
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 60))).encode("latin-1")
        order = suffix_dedup.suffix_array(text, len(text) + 1)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        if len(order) > 1:
            common_ = suffix_dedup.common_prefixes(text, order[:-1], order[1:], 20)
            for a, b, n in zip(order[:-1], order[1:], common_, strict=True):
                plain = 0
                while plain < 20 and max(a, b) + plain < len(text) and text[a + plain] == text[b + plain]:
                    plain += 1
                assert n == plain


def expected_cut(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    out = []
    for r, t, mask in zip(rows, texts, edge.repeated_bytes(texts, length), strict=True):
        runs = int((np.diff(np.r_[False, mask].astype(int)) == 1).sum())
        out.append((r[0], len(t), int(mask.sum()), runs, edge.sha(np.frombuffer(t, np.uint8)[~mask].tobytes())))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("length", "gram", "contexts"), [(400, 64, 256), (40, 8, 256), (40, 8, 2), (25, 5, 1)])
def test_suffix_dedup_edges(spark, length, gram, contexts):
    rows = [r for r in edge.documents() if length == 400 or len(r[1] or "") < 20_000]
    params = suffix_dedup.Params(length=length, gram=gram, group_contexts=contexts, block_bytes=5000)
    for passage in (length, max(gram, length * 5 // 8)):
        out = suffix_dedup.dedup(edge.frame(spark, rows, clashes=True), params=params, passage=passage)
        base = out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert edge.rows_of(base) == expected_cut(rows, length)
        texts = [(r[1] or "").encode() for r in rows]
        expected = []
        for r, t, mask in zip(rows, texts, edge.repeated_bytes(texts, passage), strict=True):
            runs = re.split(b"\xff+", bytes(np.where(mask, 255, np.frombuffer(t, np.uint8)).astype(np.uint8)))
            left = b"".join(p.decode("utf-8", "ignore").encode() for p in runs).decode()
            expected.append((r[0], int(mask.sum()), None if r[1] is None else left))
        assert edge.rows_of(out.select("doc_id", "n_passage_bytes", "text")) == sorted(expected, key=repr)
    assert suffix_dedup.dedup(edge.frame(spark, []), params=params, passage=length).count() == 0


def test_suffix_dedup_of_texts_longer_than_a_span(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(k, "".join(rng.choice("ab") for _ in range(700)), None, None, None) for k in range(8)]
    params = suffix_dedup.Params(length=16, gram=5)
    anchors = suffix_dedup.Anchors(params)
    text = rows[0][1].encode()
    at, first, last = anchors.find(text)
    assert np.array_equal(np.r_[first[1:], len(text) - 15], last + 1) and first[0] == 0
    monkeypatch.setattr(suffix_dedup, "SPAN", 128)
    at, first, last = anchors.find(text)
    covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last, strict=True)])
    assert np.array_equal(covered, np.arange(len(text) - 15)) and (at >= first).all() and (at <= first + 11).all()


def test_without_repeats_keeps_characters_whole(spark):
    rows = [(1, "ä" * 30 + "q" * 50 + "unlike", None, None, 3), (2, "zü" + "q" * 50 + "other", None, None, 3), (3, None, None, None, None)]
    out = suffix_dedup.without_repeats(edge.frame(spark, rows, clashes=True), params=suffix_dedup.Params(length=20, gram=5))
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[3] is None and texts[2] == "züother" and "unlike" in texts[1] and "q" not in texts[1]
    assert out.columns == edge.frame(spark, [], clashes=True).columns


def test_narrowing_parts_equal_stretches_once(spark, monkeypatch):
    """Near copies that differ before their anchor: only one of equal parts is parted again."""
    rng = random.Random(4)
    length, gram = 40, 8
    body = bytes(rng.randrange(97, 123) for _ in range(2 * length - gram))
    pieces = [bytes(rng.randrange(97, 123) for _ in range(6)) + body[6:] for _ in range(120)] + [body[:-3] + b"END"]
    schema = "h long, x long, y long, begin long, at long, copies long, piece binary"
    df = spark.createDataFrame([(7, k, 0, 100 * k, length - gram, 1, bytearray(p)) for k, p in enumerate(pieces)], schema)
    made = []
    plain = suffix_dedup.stage

    def counted(frame, name):
        out = plain(frame, name)
        made.extend([out.count()] if name == "parts" else [])
        return out

    monkeypatch.setattr(suffix_dedup, "stage", counted)
    found = suffix_dedup._narrowed(df, length, (16, 4, 1)).collect()
    covered = {k: set() for k in range(len(pieces))}
    for r in found:
        covered[r.x].update(range(r.begin - 100 * r.x, r.end - 100 * r.x))
    for k, again in enumerate(suffix_dedup.repeated_windows(pieces, length)):
        assert covered[k] == {i + d for i in np.flatnonzero(again).tolist() for d in range(length)}
    # A part of every piece goes on where they differ, of the others two: one of the copies and the last piece.
    assert sum(made) < 15 * len(pieces)


def test_salted_copies_are_not_broadcast(spark, monkeypatch):
    """The optimizer thinks of them as one copy, on disk; the driver would hold all."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", 100)
    small = common.stage(spark.range(0, 2000, 2).selectExpr("id AS k", "id * 7 AS v"), "small")
    rows = common.stage(spark.range(3000).selectExpr("id % 30 AS k", "id AS n"), "rows")
    out = common.attach(rows, small, ["k"])
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert edge.rows_of(out.select("k", "n", "v")) == sorted(((n % 30, n, n % 30 * 7) for n in range(3000) if n % 2 == 0), key=repr)


def test_tables_of_repeats_are_not_broadcast_by_their_size_on_disk(spark, monkeypatch):
    """Only what was counted small may be; salted copies and decoded pieces would all lie in the driver's memory."""
    plans = []
    plain = common.stage

    def seen(df, purpose):
        plans.append((purpose, df._jdf.queryExecution().executedPlan().toString()))
        return plain(df, purpose)

    monkeypatch.setattr(suffix_dedup, "stage", seen)
    monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    params = suffix_dedup.Params(length=40, gram=12, group_contexts=2)
    rows = [r for r in edge.documents() if len(r[1] or "") < 20_000]
    out = suffix_dedup.dedup(edge.frame(spark, rows), params=params, passage=25)
    plans.append(("result", out._jdf.queryExecution().executedPlan().toString()))
    assert len(plans) > 20
    assert [purpose for purpose, plan in plans if "Broadcast" in plan] == []
    assert edge.rows_of(out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == expected_cut(rows, 40)
