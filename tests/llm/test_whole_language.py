"""Texts that the language stage keeps and rejects."""

import random

import edge

import corpus_pipeline
from siltstone.llm import language_id


def test_every_text_with_letters_stays_unless_surely_unlike(spark):
    rows = edge.documents()
    rng = random.Random(8)
    unlike = "".join(chr(rng.randrange(0xAC00, 0xD7A4)) for _ in range(6000))
    kept = corpus_pipeline.language(spark, edge.frame(spark, [*rows, (900, unlike, None, "a", 6000)]), "")
    expected = sorted((r[1] for r in rows if any(c.isalpha() for c in r[1] or "")), key=repr)
    assert sorted((r.text for r in kept.collect()), key=repr) == expected


def test_the_margin_follows_from_runs_and_dims():
    least = language_id.least_likeness([1, 20, 400, 5000], (2048 * 1.0) ** 0.5 * edge.np.sqrt([1, 20, 400, 5000]), 2048)
    assert (least[1:] > least[:-1]).all() and least[2] < language_id.MARGIN / 2048**0.5 < least[3]
    # A run 5,000 times over is as good as one.
    assert language_id.least_likeness([5000], edge.np.array([5000 * 2048**0.5]), 2048) < 0.01
