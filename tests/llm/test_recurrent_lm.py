"""Scores of the recurrent language model: its base against plain sums, its slopes and its score against plain steps."""

import math
import random
import re
import zlib
from collections import Counter

import edge
import numpy as np
import pytest

from siltstone.llm import recurrent_lm
from siltstone.llm.recurrent_lm import Network, Params, Vocabulary


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(edge.LOWER)) + [None]


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def base(rows):
    seen = Counter(t for r in rows if not is_held_out(r[0]) for t in tokens(r[1]))
    n, v = sum(seen.values()), len(seen)
    out = []
    for doc_id, text, *_ in rows:
        own = tokens(text)
        total = sum(math.log10((seen[t] + 1) / (n + v + 1)) for t in own)
        out.append((doc_id, is_held_out(doc_id), len(own), sum(seen[t] > 0 for t in own), n, round(total, 5)))
    return sorted(out, key=repr)


def small_network(words=40, **kw):
    params = Params(words=words, class_size=8, hidden=5, window=4, lanes=3, **kw)
    rng = np.random.default_rng(3)
    vocabulary = Vocabulary(np.arange(60), np.sort(rng.integers(1, 500, 60))[::-1].copy(), 90, 20_000, 400, words)
    network = Network(vocabulary, params).start(vocabulary.mass)
    network.flat[:] = network.flat + rng.standard_normal(len(network.flat)) * 0.3
    network.word_bias[network.unused] = -1e4
    return vocabulary, network


def plain_score(network, text):
    """A text alone, a step at a time, by the layer's equations."""
    p, h = network.params, network.params.hidden
    state, last, total, mass = np.zeros(h), 0, 0.0, []
    for t in text:
        x = network.enter[last].astype(float) + network.bias
        k = state @ network.keep
        z, r = (1 / (1 + np.exp(-(x[a : a + h] + k[a : a + h]))) for a in (0, h))
        new = np.tanh(x[2 * h :] + r * k[2 * h :])
        state = (1 - z) * new + z * state
        pick = np.exp(network.pick @ state + network.pick_bias)
        own = np.exp(network.word @ state + network.word_bias).reshape(network.classes, -1)
        shares = (pick / pick.sum())[:, None] * own / own.sum(axis=1, keepdims=True)
        mass.append(shares.sum())
        total += math.log(shares.ravel()[t])
        last = t
    assert np.allclose(mass, 1) and p.class_size == own.shape[1]
    return total


def test_windows_and_lanes_give_the_score_of_complete_texts():
    vocabulary, network = small_network()
    rng = np.random.default_rng(1)
    texts = [np.r_[rng.integers(1, vocabulary.size, n), 0] for n in (0, 1, 3, 4, 5, 30, 17, 0, 9)]
    found = recurrent_lm.log_likelihoods(network, texts)
    assert np.allclose(found, [plain_score(network, t) for t in texts], rtol=1e-4)
    assert len(recurrent_lm.log_likelihoods(network, [])) == 0


def test_large_scores_stay_finite():
    vocabulary, network = small_network()
    network.word *= 100
    network.pick *= 100
    text = np.r_[np.arange(1, vocabulary.size), 0]
    found = recurrent_lm.log_likelihoods(network, [text])
    assert np.isfinite(found).all() and found[0] < 0


def test_slopes_against_differences():
    vocabulary, network = small_network()
    rng = np.random.default_rng(2)
    inputs, targets = rng.integers(0, vocabulary.size, (2, 6, 3))
    carry = np.ones((6, 3), np.float32)
    carry[3, 1] = 0
    state = rng.standard_normal((3, 5)).astype(np.float32) * 0.5
    wide = Network(vocabulary, network.params, network.flat.astype(np.float64))
    grad = Network(vocabulary, network.params, np.zeros(len(network.flat)))

    def loss():
        states, steps = wide.forward(inputs, carry, state)
        return -wide.output(states.reshape(-1, 5), targets.ravel())[0].sum(), states, steps

    _, states, steps = loss()
    _, back = wide.output(states.reshape(-1, 5), targets.ravel(), grad)
    wide.backward(inputs, carry, steps, back.reshape(states.shape), grad)
    for k in [*rng.integers(0, len(wide.flat), 150), *rng.integers(wide.bounds[2], wide.bounds[3], 30)]:
        was = wide.flat[k]
        wide.flat[k] = was + 0.01
        up = loss()[0]
        wide.flat[k] = was - 0.01
        down = loss()[0]
        wide.flat[k] = was
        assert grad.flat[k] == pytest.approx((up - down) / 0.02, abs=2e-3)


def test_training_learns_an_order_of_words():
    params = Params(words=12, class_size=4, hidden=8, lanes=8, rate=0.1)
    vocabulary = Vocabulary(np.arange(10), np.full(10, 100), 100, 1100, 11, 12)
    network = Network(vocabulary, params).start(vocabulary.mass)
    rng = np.random.default_rng(0)
    texts = [np.r_[(np.arange(12) + rng.integers(10)) % 10 + 2, 0] for _ in range(80)]
    before, sums = recurrent_lm.log_likelihoods(network, texts).sum(), np.full_like(network.flat, 1e-6)
    for _ in range(30):
        assert recurrent_lm.train(network, texts, sums) == 80 * 13
    assert recurrent_lm.log_likelihoods(network, texts).sum() > 0.5 * before


@pytest.mark.parametrize("known", [65_536, 50])
def test_scores_of_edges(spark, known):
    rows = edge.documents() + [(k, edge.prose(random.Random(k), 60), None, None, None) for k in range(100, 160)]
    df = edge.frame(spark, rows, clashes=True).repartition(3)
    out = recurrent_lm.score(df, params=Params(words=32, class_size=8, known=known, group=5000))
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    found = out.collect()
    assert sorted(((*r[:5], round(r.base_score, 5)) for r in found), key=repr) == base(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    assert recurrent_lm.score(edge.frame(spark, [])).count() == 0


def test_nothing_to_learn_from(spark):
    doc_id = next(k for k in range(100) if is_held_out(k))
    (row,) = recurrent_lm.score(edge.frame(spark, [(doc_id, "a b", None, None, None)])).collect()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, 0) and row.score <= 0


def test_held_out_texts_are_told_better_than_by_counts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = recurrent_lm.score(docs).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_scoring_keeps_nothing_for_the_way_back_and_sums_each_lane():
    rng = np.random.default_rng(3)
    texts = [np.append(rng.integers(2, 40, n), 0) for n in (70, 1, 33, 5, 90, 16)]  # up to the end token
    vocabulary = recurrent_lm.Vocabulary(np.arange(38), np.arange(60, 22, -1), 6, 2000, 39, 40)
    network = recurrent_lm.Network(vocabulary, recurrent_lm.Params(words=40, lanes=2)).start(vocabulary.mass)
    inputs, carry = np.array([[1, 5], [6, 2]]), np.ones((2, 2, 1), np.float32)[..., 0]
    state = np.zeros((2, network.params.hidden), np.float32)
    states, steps = network.forward(inputs, carry, state, back=False)
    assert steps == [] and np.array_equal(states, network.forward(inputs, carry, state)[0])
    # Side by side or one at a time, a text's score is the same.
    alone = [recurrent_lm.log_likelihoods(network, [t])[0] for t in texts]
    assert np.allclose(recurrent_lm.log_likelihoods(network, texts), alone, atol=1e-4)
    numbers = rng.integers(0, 70_000, 500)
    assert np.array_equal(recurrent_lm._order(numbers, 70_000), np.argsort(numbers, kind="stable"))
    assert np.array_equal(recurrent_lm._order(numbers % 300, 300), np.argsort(numbers % 300, kind="stable"))


def test_training_looks_rare_words_up_only_until_the_network_s_own_are_met():
    key = recurrent_lm.xxhash.xxh3_64_intdigest
    keys = np.array([key(w) for w in (b"a", b"b", b"c", b"d")], np.uint64).view(np.int64)
    vocabulary = Vocabulary(keys, np.array([9, 8, 7, 6]), 5, 40, 10, 5)  # its own are a, b and c
    texts = [b"d B x", None, b"a  q", b"c\tx", b"a z d y b", b"", b"u v\x0bc"]
    symbols, inputs = recurrent_lm.Symbols(vocabulary), recurrent_lm.Inputs(vocabulary)
    want = [recurrent_lm.inside(t, vocabulary.size).tolist() for t in symbols.of(texts)]
    assert [t.tolist() for t in inputs.of(texts)] == want == [[1, 3, 1, 0], [0], [2, 1, 0], [4, 1, 0], [2, 1, 1, 1, 3, 0], [0], [1, 1, 4, 0]]
    assert b"z" in symbols and b"x" in inputs.symbols and not {b"z", b"y", b"u", b"v"} & inputs.symbols.keys()
    # Without a word of its own, the network has the rest alone.
    none = Vocabulary(keys[:0], np.zeros(0, np.int64), 0, 0, 0, 5)
    assert [t.tolist() for t in recurrent_lm.Inputs(none).of([b"a b", b""])] == [[1, 1, 0], [0]]
