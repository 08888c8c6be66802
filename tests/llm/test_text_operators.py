"""Language ID, licence scan, BPE round trip, token counts and mixing against plain versions."""

import math
import random
import re
import string
import time
from collections import Counter

import edge
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from siltstone.llm import bpe_tree, language_id, license_scan, mixing, token_counts


@pytest.fixture(scope="module")
def library():
    return {n: Tokenizer.from_file(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}


def messy(rng, n):
    """Text of every kind of character a tokenizer treats in its own way."""
    kinds = [
        string.ascii_lowercase, string.ascii_uppercase, string.digits, "!?'\"-.,;:#&%$", " ", " \t\n\r", "éüñßøçžğ", "ΣσςΑαИжक日本語한",
        "  ́‍\u0085\x1c", "😀½²ﬁİıſ", "'s't're",
    ]
    out = []
    while len(out) < n:
        k = rng.choice(kinds)
        out += [rng.choice(k) for _ in range(rng.choice([1, 1, 2, 3, 9, 30]))]
    return "".join(out)[:n]


def test_bpe_round_trip_edges(spark, library):
    t = library["byte_bpe_50k.json"]
    expected = []
    for doc_id, text, *_ in edge.documents():
        ids = t.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, len(ids), edge.sha(np.array(ids, "<u4").tobytes()), edge.sha(t.decode(ids, skip_special_tokens=False).encode())))
    df = edge.frame(spark, clashes=True)
    assert edge.rows_of(bpe_tree.round_trip(df)) == sorted(expected, key=repr)
    assert bpe_tree.round_trip(edge.frame(spark, [])).count() == 0


def test_bpe_trees_of_any_leaf_size_give_the_library_ids(library, monkeypatch):
    t, encoder, rng = library["byte_bpe_50k.json"], bpe_tree.Encoder(bpe_tree.default_path()), random.Random(1)
    texts = [messy(rng, rng.choice([20, 200, 900])) for _ in range(40)]
    texts += ["a" * 700, "ab" * 400, " " * 500, "\n" * 300 + "x", "!" * 333 + "'ll", "thequickbrownfox" * 60, "é" * 300, "日本" * 200]
    texts += ["x" + " " * 40 + "y" + "'" * 30 + "s", "<|endoftext|>" * 5 + "a" * 50 + "<|endoftext|"]
    for leaf in (1, 2, 7, 33, 250):
        monkeypatch.setattr(bpe_tree, "LEAF_CHARS", leaf)
        for text in texts:
            ids = encoder.encode(text)
            assert ids.tolist() == t.encode(text, add_special_tokens=False).ids, (leaf, text)
            assert encoder.decode(ids) == text


def test_segments_of_a_text_are_encoded_apart_and_joined(spark, library, monkeypatch):
    rng, t = random.Random(4), library["byte_bpe_50k.json"]
    texts = [messy(rng, 3000), "a" * 2500, " " * 2000 + "x", "<|endoftext|>" * 200, "w" * 1999 + "<|endoftext|>" + "w" * 900, "日本語" * 800]
    monkeypatch.setattr(bpe_tree, "SEGMENT_CHARS", 700)
    encoder = bpe_tree.Encoder(bpe_tree.default_path())
    for text in texts:
        borders = encoder.cuts(text, 700)
        parts = [encoder.encode(text[a:b]) for a, b in zip(borders, borders[1:])]
        assert encoder.joined(parts).tolist() == t.encode(text, add_special_tokens=False).ids


def test_bpe_columns(spark):
    df = spark.createDataFrame([("a b <|endoftext|>",), (None,)], "text string")
    out = bpe_tree.decode(bpe_tree.encode(df)).collect()
    assert out[0].decoded == out[0].text and list(out[0].ids)[-1] == 50256 and list(out[1].ids) == []


def test_token_counts_edges(spark, library):
    t = library["word_bpe_49k.json"]
    expected = []
    for doc_id, text, *_ in edge.documents():
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 2048))
    df = edge.frame(spark, clashes=True)
    assert edge.rows_of(token_counts.token_counts(df)) == sorted(expected, key=repr)
    assert token_counts.token_counts(edge.frame(spark, [])).count() == 0


def test_token_counts_of_messy_texts(library):
    counter, rng = token_counts.Counter(token_counts.default_path()), random.Random(2)
    texts = [messy(rng, rng.choice([5, 50, 500])) for _ in range(400)] + ["a" * n for n in range(1, 40)] + ["ab" * 300, "o" * 1000, "lol" * 99]
    texts += [f"a{chr(c)}b {chr(c)}" for c in [*range(0x250), *range(0x2010, 0x2028), 0x20AC]] + ["<|startoftext|>hi<|endoftext|>", ""]
    expected = [len(library["word_bpe_49k.json"].encode(x, add_special_tokens=False).ids) for x in texts]
    assert counter.count(texts) == expected


def test_byte_words_agree_with_the_library_on_all_sure_characters(library):
    encoder, t = bpe_tree.Encoder(bpe_tree.default_path()), library["byte_bpe_50k.json"]
    for c in [*range(0x250), *range(0x2010, 0x2028), 0x20AC]:
        text = f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)} 1{chr(c)}"
        assert encoder.encode(text).tolist() == t.encode(text, add_special_tokens=False).ids, hex(c)


def plain_licenses(text):
    w = edge.words(text)
    found = [(k, label) for k in range(len(w)) for p, label in license_scan.PHRASES.items() if w[k : k + len(p.split())] == p.split()]
    starts = [k for k, _ in found]
    return len(w), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_license_scan_edges(spark):
    df = edge.frame(spark, clashes=True)
    got = edge.rows_of(license_scan.scan(df).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"))
    assert got == sorted(((r[0], *plain_licenses(r[1])) for r in edge.documents()), key=repr)
    labels = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(df).collect()}
    assert labels[27] == ("mit-notice", 1.0) and labels[7] == ("", 0.0)
    assert license_scan.scan(edge.frame(spark, [])).count() == 0


def test_matching_statistics_against_all_runs():
    rng = random.Random(5)
    for _ in range(60):
        sequences = [[rng.randrange(4) for _ in range(rng.randrange(1, 14))] for _ in range(rng.randrange(1, 5))]
        automaton = license_scan.Automaton()
        for number, s in enumerate(sequences):
            automaton.add(number, s)
        automaton.finish()
        text = [rng.randrange(-1, 5) for _ in range(40)]
        for at, (state, length) in enumerate(automaton.stream(text)):
            def ends(n, at=at):
                run = text[at + 1 - n : at + 1]
                return sorted((k, p + n - 1) for k, s in enumerate(sequences) for p in range(len(s) - n + 1) if s[p : p + n] == run)

            longest = max((n for n in range(1, at + 2) if ends(n)), default=0)
            assert length == longest
            if length:
                assert automaton.ends[state] == ends(length)


def test_license_templates_with_gaps_and_changes():
    scanner = license_scan.Scanner(license_scan.Params())
    mit = license_scan.TEMPLATES["mit"].split()
    text = ["before"] * 5 + mit[:20] + ["extra", "words"] + mit[20:25] + ["changed"] + mit[26:] + ["after"]
    found = scanner.scan(" ".join(text).encode())
    (span,) = [s for s in found["spans"] if s[0] == "mit"]
    assert span[1] == 5 and span[3] > 0.9 and found["score"] == span[3]
    assert not scanner.scan(" ".join(mit[:12]).encode())["spans"]
    assert scanner.scan(None)["n_words"] == 0


def test_phrases_of_own_choice_may_overlap():
    params = license_scan.Params(templates={}, phrases={"a b a": "one", "b a": "two", "a": "three"})
    found = license_scan.Scanner(params).scan(b"a b a b a")
    assert Counter(label for _, label in found["phrases"]) == {"one": 2, "two": 2, "three": 3}


def test_language_prototypes_against_a_plain_version(spark):
    params = language_id.Params(dims=256)
    vectors = language_id.Vectors(params)

    def letter(c):
        return np.random.default_rng([params.seed, c]).integers(0, 2, params.dims, np.int8) * 2 - 1

    def plain(text):
        chars = "".join(c if c.isalpha() else " " for c in text.lower())
        chars = f" {' '.join(chars.split())} "
        total = np.zeros(params.dims)
        for a, b, c in zip(chars, chars[1:], chars[2:]):
            a, b, c = (letter(0 if x == " " else ord(x)) for x in (a, b, c))
            total += np.roll(a, 2) * np.roll(b, 1) * c
        return total

    texts = ["Hello, world", "a", "  ÄÖ1ü!!x ", "日本 語", "aaa aaa"]
    for text in texts:
        assert np.array_equal(vectors.sums([language_id.grams(text)])[0], plain(text))
    df = spark.createDataFrame([("Hello", "en"), ("world", "en"), ("ÄÖ", "de"), (None, "de"), ("x", None)], "text string, lang string")
    found = language_id.fit(df, "text", "lang", params)
    assert sorted(found) == ["de", "en"] and np.array_equal(found["en"], plain("Hello") + plain("world"))


def test_language_id_edges(spark):
    out = language_id.identify(edge.frame(spark, clashes=True)).collect()
    expected = edge.documents()
    assert len(out) == len(expected)
    by_id = {r.doc_id: r for r in out}
    for doc_id, text, *_ in expected:
        r = by_id[doc_id]
        assert r.held_out == (doc_id is not None and language_id.is_held_out(doc_id))
        if doc_id is not None and not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        assert 0 <= r.score <= 1 and r.lang_pred in ("en", "fr", "und")
    assert language_id.identify(edge.frame(spark, [])).count() == 0
    nothing = language_id.identify(edge.frame(spark, [(0, "abc", None, None, 3)])).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]


def test_language_id_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = language_id.identify(docs).where("held_out").join(docs, "doc_id").where("lang is not null")
    right, n = out.selectExpr("sum(int(lang = lang_pred))", "count(*)").first()
    assert right / n >= 0.97
    kept = language_id.recognised(edge.frame(spark, clashes=True))
    assert set(edge.CLASHES) < set(kept.columns)
    texts = [r.text for r in kept.collect()]
    assert all(t and any(c.isalpha() for c in t) for t in texts)
    assert {r[1] for r in edge.documents() if len(edge.words(r[1])) > 50} <= set(texts)


def mixing_size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_mix(rows, weights=(5, 2, 1)):
    """Targets by sharing anew until none is above three times its size."""
    sizes = [(r[3], mixing_size(r[1])) for r in rows]
    names = sorted({s for s, _ in sizes}, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for t, n in sizes if t == s) for s in names}
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, set(names), sum(size.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * size[s]}
        if not above:
            target |= share
            break
        for s in above:
            target[s] = 3.0 * size[s]
            left -= 3 * size[s]
        free -= above
    return size, target


@pytest.mark.parametrize("clashes", [False, True])
def test_mix_edges(spark, clashes):
    rows = edge.documents()
    size, target = plain_mix(rows)
    out = [tuple(r) for r in mixing.mix(edge.frame(spark, rows, clashes)).collect()]
    assert len(out) == len(rows)
    again = [tuple(r) for r in mixing.mix(edge.frame(spark, rows, clashes).repartition(5)).collect()]
    assert sorted(out, key=repr) == sorted(again, key=repr)
    plain = sorted((r[0] or -1, mixing_size(r[1]), size[r[3]]) for r in rows)
    assert sorted((d or -1, n, s) for d, n, s, _, _ in out) == plain
    goals, taken = {size[s]: target[s] for s in size}, Counter()
    assert len(goals) == len(size)
    for _, n, source_size, goal, words in out:
        assert 0 <= words <= 3 * n and math.isclose(goal, goals[source_size], rel_tol=1e-12)
        taken[source_size] += words
    assert taken == {s: math.floor(t) for s, t in goals.items()}


def test_mix_of_little(spark):
    assert mixing.mix(edge.frame(spark, [])).count() == 0
    (row,) = mixing.mix(edge.frame(spark, [(1, None, None, None, None)])).collect()
    assert tuple(row) == (1, 0, 0, 0.0, 0)
    copies = mixing.mixed(edge.frame(spark, clashes=True))
    assert set(edge.CLASHES) < set(copies.columns) and "" not in [r.text for r in copies.collect()]
    assert mixing.mixed(edge.frame(spark, [])).count() == 0


def test_schedule_is_even_at_every_length(spark):
    from pyspark.sql import functions as F

    rows = [(i, edge.prose(random.Random(i), 200), None, "abcde"[i % 5], 0) for i in range(200)]
    params = mixing.Params(block_words=16)
    _, sources, pieces = mixing.plan(edge.frame(spark, rows), "doc_id", "source", "text", params)
    slots = pieces.select("slot", "row").distinct()
    target = {r.sid: r.target for r in sources.collect()}
    docs, _, _ = mixing.plan(edge.frame(spark, rows), "doc_id", "source", "text", params)
    by_slot = slots.join(docs.select("row", "sid"), "row").groupBy("slot").agg(F.min("sid").alias("sid")).orderBy("slot").collect()
    total, seen = sum(target.values()), Counter()
    for n, r in enumerate(by_slot, 1):
        seen[r.sid] += 1
        assert all(abs(seen[s] - n * t / total) < 6 for s, t in target.items())


def test_mix_is_data_frame_code_only(spark):
    plan = mixing.mix(edge.frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_long_unsplit_texts_are_counted_in_little_time(library):
    """Words of up to 200,000 letters, in far less time than a round over all of them per rank would take."""
    counter, rng = token_counts.Counter(token_counts.default_path()), random.Random(3)
    letters = ["abcdefghijklmnopqrstuvwxyz", "ab", "a", "éüa"]
    texts = ["".join(rng.choices(some, k=n)) for some in letters for n in (1023, 1024, 1025, 6000)]
    texts += ["".join(rng.choices(letters[0], k=200_000)), "a" * 100_001, "日本" * 3000, "ab" * 9999 + " short " + "c" * 2000]
    began = time.monotonic()
    found = counter.count(texts)
    assert time.monotonic() - began < 20
    assert found == [len(library["word_bpe_49k.json"].encode(t, add_special_tokens=False).ids) for t in texts]
