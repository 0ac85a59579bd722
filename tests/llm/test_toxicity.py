"""Segment search, chance and toxicity scores against plain versions and planted passages."""

from __future__ import annotations

import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from small_docs import documents, odd

from lotwise.llm import toxicity
from lotwise.llm.segments import Chance, chance_sums, fit_chance, maximal_segments

LABELS = "doc_id bigint, quality int, toxic int"
CLEAN = [f"plain{i}" for i in range(60)]
BAD = ["vile", "rotten", "foul"]


def plain_segments(scores):
    """The definition: the best segment, the shortest of equals, then both sides of it."""
    found = []

    def search(lo, hi):
        best = None
        for i in range(lo, hi):
            total = 0
            for j in range(i, hi):
                total += scores[j]
                if total > 0 and (best is None or total > best[0] or (total == best[0] and j - i < best[2] - best[1])):
                    best = (total, i, j)
        if best:
            search(lo, best[1])
            found.append((best[1], best[2], best[0]))
            search(best[2] + 1, hi)

    search(0, len(scores))
    return found


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-6, 6).filter(bool), max_size=24))
def test_maximal_segments_follow_the_definition(steps):
    # Different fractions keep sums from being equal by chance: ties have several right answers.
    scores = [s + (i * i % 97) / 1000003 for i, s in enumerate(steps)]
    listed = [i for i, s in enumerate(scores) if s != -1]
    got = maximal_segments(listed, [scores[i] for i in listed], -1.0)
    want = plain_segments(scores)
    assert [(listed[f], listed[t]) for f, t, _ in got] == [(f, t) for f, t, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_gaps_between_listed_items_count():
    assert maximal_segments([0, 4, 30], [2.0, 2.0, 3.0], -0.5) == [(0, 1, 2.5), (2, 2, 3.0)]
    assert maximal_segments([], [], -1.0) == []


def test_long_sequences_take_linear_time():
    rnd = random.Random(1)
    for scores in ([1.0, -1.5] * 200_000, [rnd.choice([1.0, -0.9]) for _ in range(400_000)], [float(i % 7 + 1) for i in range(400_000)]):
        began = time.time()
        maximal_segments(list(range(len(scores))), scores, -1.0)
        assert time.time() - began < 10


def test_chance_is_fitted_to_extreme_values():
    rng = np.random.default_rng(3)
    rate, scale, n = 1.7, 0.02, rng.integers(50, 3000, 40000).astype(float)
    best = np.maximum((np.log(scale * n) - np.log(-np.log(rng.random(len(n))))) / rate, 0.0)
    fitted = fit_chance(chance_sums(best[:20000], n[:20000]) + chance_sums(best[20000:], n[20000:]))
    assert fitted.rate == pytest.approx(rate, rel=0.07) and fitted.scale == pytest.approx(scale, rel=0.1)
    p = np.exp([-fitted.surprise(s, k) for s, k in zip(best[:5000], n[:5000]) if s > 0])
    assert abs((p < 0.1).sum() / 5000 - 0.1) < 0.02
    assert fit_chance(chance_sums(np.zeros(9), np.full(9, 100.0))).scale < 0.01
    assert Chance().evidence([], 10) == 0.0
    assert Chance(1.0, 0.01).evidence([5.0, 5.0], 100) > Chance(1.0, 0.01).evidence([5.0], 100)


def corpus(spark, n=240):
    """Every sixth text is toxic: three bad words, one behind the other, somewhere in it."""
    rnd, rows, labels = random.Random(5), [], []
    for i in range(n):
        words, toxic = [rnd.choice(CLEAN) for _ in range(80)], i % 6 == 0
        if toxic:
            at = rnd.randrange(60)
            words[at : at + 3] = rnd.sample(BAD, 3)
        rows.append((i, " ".join(words).capitalize() + ".", "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    return documents(spark, rows), spark.createDataFrame(labels, LABELS), rows


def test_passages_are_found_where_they_are(spark):
    docs, labels, rows = corpus(spark)
    model = toxicity.learn(docs, labels)
    found = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    for i, text, *_ in rows:
        cut = [text[p["start"] : p["end"]].lower() for p in found[i]["passages"]]
        want = re.findall(r"(?:\b(?:vile|rotten|foul)\b ?){3}", text, re.I)
        assert [c.strip() for c in cut] == [w.strip().lower() for w in want]
        assert found[i]["predicted"] == int(i % 6 == 0) == int(found[i]["score"] >= 0.5)


def test_held_out_documents_are_told_apart(spark):
    docs, labels, _ = corpus(spark)
    model = toxicity.learn(docs.filter("doc_id % 4 <> 0 OR doc_id % 3 <> 0"), labels)
    rows = toxicity.score(docs.filter("doc_id % 12 = 0 OR doc_id % 12 = 5"), model).collect()
    assert len(rows) == 40 and all(r["predicted"] == int(r["doc_id"] % 6 == 0) for r in rows)


def test_counts_and_lexicon_equal_a_plain_version(spark):
    docs, labels, rows = corpus(spark, 120)
    marks = toxicity.labelled(docs.repartition(5), labels)
    counts = {(r["toxic"], r["clean"]) for r in toxicity._token_counts(marks).collect()}
    toxic, clean = Counter(), Counter()
    for i, text, *_ in rows:
        (toxic if i % 6 == 0 else clean).update(set(re.findall("[a-z]+", text.lower())))
    assert counts == {(toxic[t], clean[t]) for t in toxic | clean}
    low = toxicity.log_odds(np.array([20.0, 20, 1]), np.array([0.0, 100, 0]), np.array([20 / 120, 1, 1 / 120]), 20, 100)
    assert low[0] > 1 and low[1] == low[2] == 0


def test_a_repeated_word_is_no_evidence_of_its_own():
    assert toxicity.repeats(np.array([4, 4, 9, 4, 9])).tolist() == [1, 2, 1, 3, 2]
    assert toxicity.repeats(np.zeros(0, int)).tolist() == []


def test_odd_rows_and_missing_labels(spark):
    _, labels, _ = corpus(spark, 60)
    for docs in (documents(spark), odd(spark), documents(spark, [])):
        for marks in (labels, labels.limit(0), spark.createDataFrame([(1, 1, None), (None, 1, 1)], LABELS)):
            model = toxicity.learn(docs, marks)
            found = toxicity.score(docs, model).collect()
            assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    docs, labels, _ = corpus(spark)
    twice = labels.unionByName(labels.withColumns({"toxic": F.lit(0)}))
    model, again = toxicity.learn(docs, labels), toxicity.learn(docs.repartition(7), twice)
    assert model.hashes.tolist() == again.hashes.tolist() and model.curve == again.curve
    nothing = {r["doc_id"]: r for r in toxicity.score(documents(spark), model).collect()}
    assert nothing[4]["score"] == nothing[5]["score"] == nothing[6]["score"] < 0.5
    assert toxicity.learn(docs, labels.limit(0)).probability(9.0) == 0.0


def test_very_long_text_and_wide_characters(spark):
    docs, labels, _ = corpus(spark)
    model = toxicity.learn(docs, labels)
    text = "\U0001f600 İ " + " ".join(CLEAN * 20000) + " “Vile”, FOUL ÷ rotten!"
    (row,) = toxicity.score(documents(spark, [(1, text, None, None, None)]), model).collect()
    (passage,) = row["passages"]
    assert text[passage["start"] : passage["end"]] == "Vile”, FOUL ÷ rotten" and row["n_tokens"] == 20000 * 60 + 4
