"""Operators against plain versions that follow the contracts word by word, and against long texts."""

from __future__ import annotations

import random
import re
import time
from collections import Counter
from math import log2

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from small_docs import COPY, ROWS, documents

import corpus_pipeline
from lotwise.llm import exact_dedup, language, near_dedup, pii, quality, secret_scan
from lotwise.llm.common import doc_remainder
from lotwise.llm.queries import QUERIES
from lotwise.llm.words import word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Quality: the counts


def plain_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    failed = n < 50 or 100 * len(repeated) > 50 * n
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), failed)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "cd", "é#", "\n", " ", "\t", "\x0b", "\x85", " ", "$|", "\U0001f600"]), max_size=60).map("".join))
def test_quality_counts_of_any_text(text):
    words, _ = word_hashes([text.encode()])
    assert quality.counts(text, words) == plain_counts(text)


def test_quality_counts_of_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = QUERIES["op6_quality"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[n] for n in names) == plain_counts(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_quality_threshold_is_that_of_the_trusted_scores(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, labels)
    good = {r["doc_id"] for r in labels.filter("quality = 1").collect()}
    texts = [r["text"] for r in docs.collect() if r["doc_id"] in good and r["text"] is not None]
    scores = model.scores([t.encode() for t in texts])
    mean = sum(scores) / len(scores)
    spread = (sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5
    assert model.threshold == pytest.approx(min(0.0, mean - quality.SPREADS * spread), abs=1e-4)


# Secrets: the windows


def plain_hot_part(value, bits):
    w = secret_scan.WINDOW
    hot = [
        i for i in range(len(value) - w + 1)
        if log2(w) - sum(c * log2(c) for c in Counter(value[i : i + w]).values()) / w >= bits - 1e-9
    ]
    return (hot[0], hot[-1] + w) if hot else None


def test_entropy_windows_equal_a_plain_sliding_window(spark):
    rnd = random.Random(5)
    values = []
    for n in [20, 21, 25, 40, 64, 200, 700]:
        for alphabet in ("ab1", "0123456789abcdef", secret_scan.ALPHABET):
            values.append("".join(rnd.choice(alphabet) for _ in range(n)))
    values += ["a1" * 30 + "".join(rnd.choice(secret_scan.ALPHABET) for _ in range(30)) + "b2" * 40]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    for bits in (secret_scan.HEX_BITS, secret_scan.MIXED_BITS):
        for r in df.select("v", secret_scan._hot_part(F.col("v"), bits).alias("p")).collect():
            want = plain_hot_part(r["v"], bits)
            assert (None if r["p"]["first"] is None else (r["p"]["first"], r["p"]["last"])) == want


def test_a_string_of_a_million_characters_is_scanned_in_seconds(spark):
    rnd = random.Random(6)
    text = "key: " + "".join(rnd.choices(secret_scan.ALPHABET[:-3], k=1_000_000))
    docs = documents(spark, [(1, text, None, None, None)]).select("doc_id", "text")
    began = time.time()
    [row] = secret_scan.scan(docs).collect()
    assert time.time() - began < 60
    assert [(s["start"], s["end"]) for s in row["spans"] if s["kind"] == "entropy"] == [(5, 1_000_005)]


# Personal data


def test_a_hundred_thousand_finds_take_seconds():
    own = pii.Pseudonyms(b"key")
    text = " ".join(f"m{i}@mail.example.com 415-555-{i % 10000:04d}" for i in range(50_000))
    began = time.time()
    new, spans = own.apply(text)
    assert time.time() - began < 60 and len(spans) == 100_000
    assert Counter(k for *_, k in spans) == {"email": 50_000, "phone": 50_000}
    # Every span stands where its value is in the new text, between the untouched spaces.
    assert [(a, b) for a, b, _ in spans] == [m.span() for m in re.finditer(r"\S+", new)]


def test_the_same_values_stay_linked_across_documents(spark):
    values = ["a.b@mail.example.com", "4111 1111 1111 1111", "2020-02-29", "10.0.0.1", "123-45-6789", "+1 415-555-2671"]
    rows = [(i, " and ".join(values[i % 3 :] + values[: i % 3]) + f" {i}th", None, None, None) for i in range(9)]
    found = pii.pseudonymise(documents(spark, rows), b"key").collect()
    seen = {}
    for r in found:
        order = values[r["doc_id"] % 3 :] + values[: r["doc_id"] % 3]
        cut = [r["text"][s["begin"] : s["end"]] for s in r["pii_spans"]]
        assert len(cut) == len(values)
        for value, other in zip(order, cut):
            assert value != other and seen.setdefault(value, other) == other
    assert len(set(seen.values())) == len(values)


# Language


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learn(docs.filter(doc_remainder(3) != 1))
    held = docs.filter((doc_remainder(3) == 1) & F.col("lang").isNotNull() & (F.length("text") > 200))
    rows = language.predict(held, model).join(held.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows) > 100


def test_decoding_takes_the_codeword_that_loses_least(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("text IS NOT NULL")
    model = language.learn(docs)
    rows = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    code = model.code.tolist()
    assert min(sum(a != b for a, b in zip(x, y)) for x in code for y in code if x is not y) >= len(code[0]) // 3
    for r in docs.collect():
        if not language.letters(r["text"]):
            continue
        [margins] = model.margins([r["text"].lower().encode()])
        bent = [max(-4.0, min(4.0, m / s)) for m, s in zip(margins, model.scale)]
        losses = [sum(t * 2.718281828459045 ** (-b * c) for b, c, t in zip(bent, word, trust)) for word, trust in zip(code, model.trust)]
        assert rows[r["doc_id"]]["lang_pred"] == model.languages[losses.index(min(losses))]


# Duplicates


def test_every_row_with_the_id_that_stays_is_kept(spark):
    docs = documents(spark, [(1, COPY, None, None, None), (1, COPY + " x", None, None, None), (2, COPY, None, None, None)])
    rows = near_dedup.near_duplicates(docs, n=4).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in rows) == [(1, 1, True), (1, 1, True), (2, 1, False)]
    assert near_dedup.one_of_each(docs, n=4).count() == 1


def test_near_pairs_around_the_limit_are_linked(spark):
    """Pairs whose similarity lies between 0.80 and 0.82: how many of them are found."""
    rnd, rows, pairs = random.Random(9), [], 120
    for i in range(pairs):
        words = [f"w{i}x{rnd.randrange(10**6)}" for _ in range(300)]
        other, k = [*words], 0
        shingles = lambda w: {tuple(w[j : j + 4]) for j in range(len(w) - 3)}
        alike = lambda a, b: len(a & b) / len(a | b)
        while True:
            changed = [*other]
            changed[(7 + 23 * k) % 300] = f"y{i}y{k}"
            if alike(shingles(words), shingles(changed)) < 0.8:
                break
            other, k = changed, k + 1
        assert 0.8 <= alike(shingles(words), shingles(other)) < 0.83
        rows += [(2 * i, " ".join(words), None, None, None), (2 * i + 1, " ".join(other), None, None, None)]
    found = near_dedup.near_duplicates(documents(spark, rows), n=4).collect()
    linked = sum(r["component_id"] == r["doc_id"] - 1 for r in found if r["doc_id"] % 2)
    assert linked == pairs


def test_columns_named_like_internal_ones_stay_as_they_are(spark):
    names = ["_scan_m0", "_scan_s3", "_scan_e", "_near_id", "_near_digest", "_dedup_id", "_dedup_no_id", "_dedup_digest", "__scan_m0"]
    docs = documents(spark).withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for result in (secret_scan.scan(docs), near_dedup.one_of_each(docs), exact_dedup.deduplicate(docs)):
        rows = result.collect()
        assert rows and all(r[n] == (None if r["doc_id"] is None else f"{n}{r['doc_id']}") for r in rows for n in names)


# The pipeline


def test_stages_of_the_pipeline_against_plain_versions(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = stages["quality_rules"](spark, docs, folder)
    verdict = {r["doc_id"]: r["kept"] for r in QUERIES["op6_quality"](spark, folder).collect()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, k in verdict.items() if k)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    exact = {}
    for i in sorted(i for i, k in verdict.items() if k):
        exact[texts[i].translate(lower)] = i
    once = stages["exact_dedup"](spark, kept, folder)
    assert once.columns == docs.columns and sorted(r["doc_id"] for r in once.collect()) == sorted(exact.values())

    def shingles(text):
        words = WORD.findall(text.translate(lower))
        return {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else set()

    sets = {i: shingles(texts[i]) for i in exact.values()}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    near = stages["near_dedup"](spark, once, folder)
    assert sorted(r["doc_id"] for r in near.collect()) == sorted({top(i) for i in sets})
    hidden = stages["pii"](spark, near, folder)
    own = pii.Pseudonyms(corpus_pipeline.PII_KEY)
    for r in hidden.collect():
        assert r["text"] == own.apply(texts[r["doc_id"]])[0] and r["n_chars"] == len(r["text"])
    packed = stages["packing"](spark, hidden, folder)
    rows = packed.collect()
    assert {r["doc_id"] for r in rows} == {top(i) for i in sets} and all(r["length"] <= 2048 for r in rows)


def test_the_pipeline_of_empty_and_odd_tables(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    for name, rows in (("empty", []), ("odd", ROWS)):
        folder = str(tmp_path / name)
        documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        packed = corpus_pipeline.run(spark, folder).collect()
        assert (len(packed) == 0) == (name == "empty")
