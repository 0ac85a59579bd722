"""The language model: words of one class are told apart by history, and probabilities sum to 1."""

from __future__ import annotations

import random

import numpy as np
from small_docs import documents

from lotwise.llm import lm
from lotwise.llm.words import U64, words_and_endings


def test_history_tells_words_of_a_class_apart(spark):
    fillers = " ".join(f"w{i}" for i in range(lm.SINGLES))
    # One in ten goes the other way, so that the ends of all four texts are learnt.
    ways = [("sun rising", "sun falling"), ("rain falling", "rain rising")]
    rows = [(i, f"{fillers} {ways[i % 2][i % 20 < 2]}", None, None, None) for i in range(1200)]
    model, counts = lm.learn(documents(spark, rows))
    texts = ["sun rising", "sun falling", "rain rising", "rain falling"]
    docs = documents(spark, [(i, f"{fillers} {t}", None, None, None) for i, t in enumerate(texts)])
    score = [r["score"] for r in lm.score(docs, model, counts).orderBy("doc_id").collect()]
    base = [r["base_score"] for r in lm.score(docs, model, counts).collect()]
    assert max(base) - min(base) < 1e-9
    assert score[0] > score[1] + 0.3 and score[3] > score[2] + 0.3


def test_probabilities_sum_to_one_and_make_the_score(spark, monkeypatch):
    # Words with less than a hundredth of all occurrences are joined, not broadcast.
    monkeypatch.setattr(lm, "COMMON", 100)
    draw = random.Random(7)
    vocabulary = [f"{draw.choice('abcdefgh')}{i}{draw.choice(['ing', 'ed', 'er', 'on'])}" for i in range(2500)]
    weights = [1 / (1 + i) for i in range(len(vocabulary))]
    rows = [(i, " ".join(draw.choices(vocabulary, weights, k=60)), None, None, None) for i in range(400)]
    model, counts = lm.learn(documents(spark, rows))
    known = {U64(r["word"] & (2**64 - 1)): (r["n"], r["group"]) for r in counts.collect()}
    tree = model.tree
    assert tree.levels > 1 and len(tree.words) < len(known) / 10 and np.abs(model.inner).max() > 0.1

    def logs(tokens, group, found, n):
        """log10 P of each token."""
        truth = model.classes(tokens, group)
        at, common = tree.find(tokens)
        shares = model.log_shares(lm.outer_rows(found))[np.arange(len(tokens)), truth]
        return (shares + model.log_words(tokens, truth, found, at, common)) / np.log(10) + np.log10(n + 0.5)

    words = np.array(list(known), U64)
    n, group = (np.array(c) for c in zip(*known.values()))
    # One unknown word for each leaf.
    bits = lm.HASH_BITS * tree.levels
    leaves = np.arange(lm.ENDINGS << bits)
    unknown = ((leaves & ((1 << bits) - 1)).astype(U64) << U64(64 - bits)) | U64(5)
    every = np.concatenate([words, unknown])
    groups = np.concatenate([group, (leaves >> bits) + 1 + lm.SINGLES])
    own_slots = 0.5 / model.class_mass[: 1 + lm.SINGLES]
    tokens, _, ends = lm.stream_of([rows[0][1]])
    for place in (0, 1, 5, 40):
        history = np.repeat(lm.features(tokens, ends)[:, [place]], len(every), axis=1)
        shares = np.exp(model.log_shares(lm.outer_rows(history[:, :1])))[0]
        total = (10 ** logs(every, groups, history, np.concatenate([n, np.zeros(len(leaves))]))).sum()
        assert abs(total + (shares[: 1 + lm.SINGLES] * own_slots).sum() - 1) < 1e-3

    texts = [rows[3][1], f"{rows[4][1]} neverseening other", "", None]
    found = lm.score(documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]), model, counts)
    for r in found.collect():
        tokens, group, ends = lm.stream_of([texts[r["doc_id"]] or ""])
        n = np.array([known.get(t, (0, 0))[0] for t in tokens])
        assert abs(r["score"] - logs(tokens, group, lm.features(tokens, ends), n).sum()) < 1e-3
    assert found.count() == 4


def test_steps_equal_plain_sums():
    draw = np.random.default_rng(3)
    for weights, kind in ((np.zeros((500, lm.CLASSES), np.float32), np.uint16), (np.zeros((500, lm.FAN), np.float32), np.uint32)):
        rows = (draw.zipf(1.4, (3, 900)) % 500).astype(kind)
        slope = draw.random((900, weights.shape[1]), dtype=np.float32)
        use, sums, n = np.zeros(500, np.float32), np.zeros(weights.shape), np.zeros(500)
        for at in rows:
            np.add.at(sums, at, slope)
            np.add.at(n, at, 1)
        lm._descend(weights, use, rows, slope)
        assert n.max() > lm.SHORT_RUN and (use == n).all()
        assert np.allclose(weights, -sums * (lm.RATE / np.sqrt(np.maximum(n, 1) * (1 + n)))[:, None], atol=1e-4)


def test_logits_out_of_range_are_shifted():
    logits = np.array([[200, 199, 0], [-300, -301, -302], [0, 1, 2]], np.float32)
    want = logits - np.log(np.exp(logits.astype(float)).sum(axis=1, keepdims=True))
    for truth in range(3):
        assert np.allclose(lm._log_share(logits.copy(), np.full(3, truth)), want[:, truth], atol=1e-4)


def test_rows_of_any_width_are_summed_in_the_order_of_tokens():
    draw = np.random.default_rng(5)
    rows = (draw.zipf(1.3, (3, 9000)) % 60000).astype(np.uint16)
    slope = draw.normal(size=(9000, lm.FAN)).astype(np.float32)
    found = []
    for kind, more in ((np.uint16, 0), (np.uint32, 0), (np.uint32, 70000)):
        weights, use = np.zeros((130000, lm.FAN), np.float32), np.zeros(130000, np.float32)
        lm._descend(weights, use, rows.astype(kind) + kind(more), slope)
        found.append((weights[more : more + 60000], use[more : more + 60000]))
        assert use.sum() == 27000
    for weights, use in found[1:]:
        assert (weights == found[0][0]).all() and (use == found[0][1]).all()


def test_common_words_are_found_at_their_places():
    draw = np.random.default_rng(6)
    every = np.unique(np.concatenate([draw.integers(0, 2**64, 3000, U64), U64(1 << 63) + np.arange(40, dtype=U64), np.array([0, 2**64 - 1], U64)]))
    for words in (every[:0], every[:1], every[-1:], every[:3], every):
        tree = lm.Tree(1, words, np.ones(len(words)), *[np.zeros(0)] * 5)
        asked = np.concatenate([every, every + U64(1), every - U64(1)])
        at, found = tree.find(asked)
        assert (found == np.isin(asked, words)).all()
        assert (words[at[found]] == asked[found]).all() and (not len(words) or (0 <= at.min() and at.max() < len(words)))


def test_words_are_hashed_alike_wherever_they_stand():
    long = "x" * 5000
    alone = [words_and_endings([w.encode()]) for w in ("ab", "é", long, "z")]
    blank = " " * 6000
    words, ends, endings = words_and_endings([t.encode() for t in ("", f"{blank}ab\t\né ", blank, f"{long}\x0b{blank}z", "")])
    assert (words == [a[0][0] for a in alone]).all() and (endings == [a[2][0] for a in alone]).all()
    assert ends.tolist() == [0, 2, 2, 4, 4]
