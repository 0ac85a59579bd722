"""Spelling variants against comparison of all words with all words, on small texts."""

from __future__ import annotations

import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from small_docs import documents, odd

from lotwise.llm import spelling
from lotwise.llm.queries import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows):
    words = plain_words(rows)
    out = {}
    for w, n in words.items():
        near = sorted((v for v in words if plain_near(w, v)), key=lambda v: (-words[v], v))
        form = near[0] if near and words[near[0]] >= 10 * n else None
        out[w] = (form, n, len(near), words[form] if form else None)

    def root(w):
        return root(out[w][0]) if out[w][0] else w

    return {(w, f, root(w), n, k, m) for w, (f, n, k, m) in out.items()}


def found(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def texts(seed, n, letters="abeu", accents="àÿÉ×"):
    """Words from few letters, so many are near each other, some of them very frequent."""
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(7, 10))) for _ in range(120)]
    base += ["".join(rnd.choice(letters + accents) for _ in range(9)) for _ in range(40)] + ["Abeuabeu", "abeuabeuabeu"]
    rows = []
    for i in range(n):
        words = [rnd.choice(base) for _ in range(30)] + [base[i % 3]] * (60 if i % 2 else 3)
        words += [w[:3] + rnd.choice(letters) + w[4:] for w in words[:6]] + [w[:-1] for w in words[:4]]
        rows.append((i if i else None, rnd.choice([" ", ", ", "-", "1"]).join(words)))
    return rows


@pytest.mark.parametrize("subtree", [spelling.SUBTREE, 40, 1])
def test_variants_equal_the_plain_version(spark, subtree):
    rows = texts(3, 40)
    docs = documents(spark, [(i, t, "en", "s", 1) for i, t in rows]).repartition(5)
    got = spelling.variants(docs, subtree)
    want = plain_variants(rows)
    assert found(got) == want and got.count() == len(want)
    assert any(f for _, f, *_ in want)


def test_chains_of_forms_lead_to_their_last(spark):
    counts = {"abcdefgh": 2, "abcdefgi": 20, "abcdefii": 300, "abcdeiii": 4000, "abciiiii": 2}
    rows = [(1, " ".join(w for w, n in counts.items() for _ in range(n)))]
    want = plain_variants(rows)
    got = found(spelling.variants(documents(spark, [(1, rows[0][1], None, None, None)])))
    assert got == want
    assert sum(r == "abcdeiii" for _, _, r, *_ in got) >= 4


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abqrpà", min_size=1, max_size=7), min_size=2, max_size=12, unique=True), st.integers(1, 15))
def test_every_near_pair_meets(words, depth):
    vectors = spelling.group_counts([w.encode("latin-1") for w in words])
    trunks = {w: tuple(v[:depth].tolist()) for w, v in zip(words, vectors)}
    met = Counter()
    for here in set(trunks.values()):
        rows = [(w, 1, 1, True) for w in words if trunks[w] == here]
        rows += [(w, s, d, False) for w in words for t, s, d in spelling.reachable(trunks[w]) if t == here]
        names, s, d, home = zip(*rows)
        some, times, _ = spelling.subtree_rows(list(names), np.ones(len(rows), int), np.array(s), np.array(d), np.array(home), depth)
        met.update({names[i]: k for i, k in zip(some.tolist(), times.tolist())})
    assert +met == +Counter({w: sum(plain_near(w, v) for v in words) for w in words})


def test_letter_comparison():
    words = ["abcdefg", "abcdefgh", "abXdefg", "abcdeg", "bacdefg", "a" * 300, "a" * 301, "a" * 150 + "b" + "a" * 150, "abcdefg"]
    letters = spelling.Letters([w.encode() for w in words])
    left, right = map(np.ravel, np.meshgrid(range(len(words)), range(len(words))))
    got = spelling.one_edit(letters, left, right)
    assert got.tolist() == [plain_near(words[a], words[b]) for a, b in zip(left, right)]
    assert spelling.one_edit(letters, left[:0], right[:0]).tolist() == []


def test_odd_rows(spark):
    for docs in (documents(spark), odd(spark), documents(spark, [])):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        assert found(spelling.variants(docs)) == plain_variants(rows)
    long = "x" * 200_000
    rows = [(i, f"{long} {long}y {long[:-1]}") for i in range(3)]
    docs = documents(spark, [(i, t, None, None, None) for i, t in rows])
    assert found(spelling.variants(docs)) == plain_variants(rows)


def test_many_near_words_take_seconds():
    rnd = random.Random(4)
    words = sorted({"".join(rnd.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rnd.randrange(4, 7))) for _ in range(30_000)})
    began = time.time()
    some, times, best = spelling.subtree_rows(words, np.ones(len(words), int), *np.ones((2, len(words)), int), np.ones(len(words), bool), 0)
    assert time.time() - began < 60 and len(some) > 100
    for i in some[:: len(some) // 20].tolist():
        near = [v for v in words if abs(len(v) - len(words[i])) <= 1 and plain_near(words[i], v)]
        assert times[np.searchsorted(some, i)] == len(near) and words[best[np.searchsorted(some, i)]] == min(near)


def test_query_over_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    words = plain_words([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    rows = QUERIES["op13_spelling"](spark, folder).collect()
    assert {r["word"]: r["n"] for r in rows} == words
    for r in rows[:: max(1, len(rows) // 60)]:
        near = sorted((v for v in words if plain_near(r["word"], v)), key=lambda v: (-words[v], v))
        assert r["n_near"] == len(near)
        assert r["form"] == (near[0] if near and words[near[0]] >= 10 * r["n"] else None)
