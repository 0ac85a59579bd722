from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from small_docs import COPY, ROWS, documents, odd

import corpus_pipeline
from lotwise.llm import components, exact_dedup, language, lm, near_dedup, packing, pii, quality, secret_scan
from lotwise.llm.near_dedup import CHUNKS, MORE, MOST_DIFFERENT, SYMBOLS, index_keys
from lotwise.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_exact_duplicates(spark):
    rows = exact_dedup.resolve(odd(spark)).collect()
    groups = {}
    for doc_id, text, *_ in ROWS:
        groups.setdefault((text or "").translate(LOWER), []).append(doc_id)
    want = Counter((i, max(v, key=lambda x: -1 if x is None else x), len(v)) for v in groups.values() for i in v)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in rows) == want
    kept = exact_dedup.deduplicate(odd(spark))
    assert kept.columns == odd(spark).columns and kept.count() == len(groups)
    assert exact_dedup.resolve(documents(spark, [])).count() == 0


def test_heavy_digests_take_the_same_rows(spark):
    rows = [(i, f"t{i % 5 if i < 300 else i}", None, None, None) for i in range(400)]
    found = exact_dedup.resolve(documents(spark, rows).repartition(7))
    assert Counter(r["group_size"] for r in found.collect()) == {60: 300, 1: 100}
    assert found.filter("kept").count() == 105


def test_one_row_stays_however_files_are_packed(spark):
    rows = [(None if i % 3 else 7, f"t{i % 4}", None, None, None) for i in range(400)]
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {name: spark.conf.get(name) for name in names}
    try:
        # Every file a task of its own in one job, all files in one task in the next.
        for name in names:
            spark.conf.set(name, "8k")
        found = exact_dedup.resolve(documents(spark, rows).repartition(6))
        spark.conf.set(names[0], "1g")
        kept = Counter(r["digest"] for r in found.collect() if r["kept"])
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted(kept.values()) == [1, 1, 1, 1]


def linked(rows, n, percent=80):
    sets = []
    for _, text, *_ in rows:
        words = WORD.findall((text or "").translate(LOWER))
        runs = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)] or ([tuple(words)] if words else [])
        sets.append(frozenset(runs))
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    ids = {}
    for r, (doc_id, *_) in zip(root, rows):
        ids.setdefault(r, []).append(doc_id)
    return [(rows[i][0], len(sets[i]), min((x for x in ids[root[i]] if x is not None), default=None)) for i in range(len(rows))]


def test_near_duplicates(spark):
    words = COPY.split()
    random = np.random.default_rng(3)
    rows = list(ROWS)
    for i in range(60):
        own = list(words)
        for at in random.integers(0, len(own), random.integers(0, 9)):
            own[at] = f"new{random.integers(1000)}"
        rows.append((100 + i, " ".join(own), "en", "z", None))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(documents(spark, rows), 4).collect()), key=repr)
    assert got == sorted(linked(rows, 4), key=repr)
    kept = near_dedup.one_of_each(odd(spark))
    assert kept.columns == odd(spark).columns
    assert {r["doc_id"] for r in kept.collect()} == {doc_id for doc_id, _, c in linked(ROWS, 5) if doc_id == c}
    assert near_dedup.near_duplicates(documents(spark, [])).count() == 0


def test_one_row_of_each_component_whatever_the_ids(spark):
    other = " ".join(f"other{i}" for i in range(40))
    rows = [(None, COPY, "a", None, None), (None, COPY + " tail", "b", None, None), (None, COPY, "c", None, None)]
    rows += [(5, other, "a", None, None), (5, other + " x", "b", None, None), (5, "alone in its words", "c", None, None)]
    rows += [(6, other, "a", None, None), (None, "", "a", None, None), (None, "", "b", None, None), (None, None, "c", None, None)]
    kept = near_dedup.one_of_each(documents(spark, rows)).collect()
    texts = Counter((r["text"] or "").split(" ")[0] for r in kept)
    assert texts == {"word0": 1, "other0": 1, "alone": 1, "": 3}
    assert {r["doc_id"] for r in kept if r["text"]} == {None, 5}


def test_links_that_only_the_search_finds(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "pivot_pairs", lambda shared: shared.select(F.col("class").alias("a"), F.col("pivot").alias("b")).limit(0))
    monkeypatch.setattr(near_dedup, "nearest_pairs", lambda shared, *_: shared.select(F.col("class").alias("a"), F.col("pivot").alias("b")).limit(0))
    monkeypatch.setattr(near_dedup, "SEARCH_ROWS", 8)
    random = np.random.default_rng(5)
    rows = list(ROWS)
    for i in range(40):
        own = COPY.split()
        for at in random.integers(0, len(own), random.integers(0, 12)):
            own[at] = f"new{random.integers(1000)}"
        rows.append((100 + i, " ".join(own), "en", "z", None))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(documents(spark, rows), 4).collect()), key=repr)
    want = sorted(linked(rows, 4), key=repr)
    assert got == want and len({c for _, _, c in want}) > 2


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, SYMBOLS - 1), max_size=MOST_DIFFERENT))
def test_signatures_under_the_threshold_share_a_key(places):
    one = np.arange(SYMBOLS, dtype="<u2")
    two = one.copy()
    two[list(places)] += 1000
    keys = index_keys(np.stack([one, two]))
    assert (keys[0] == keys[1]).any() and MOST_DIFFERENT == 2 * CHUNKS - 1 and MORE > 0


@pytest.mark.parametrize("most", [3, 1000])
def test_components(spark, monkeypatch, most):
    monkeypatch.setattr(components, "EDGES_PER_TASK", most)
    pairs = [(i, i + 1) for i in range(0, 20)] + [(30, 31), (31, 30), (40, 40)]
    found = components.components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").distinct().collect()
    want = {i: 0 for i in range(21)} | {30: 30, 31: 30, 40: 40}
    assert {r["node"]: r["component"] for r in found} == want


def test_secrets(spark):
    hidden = "x " + "Zm9vYmFyMTIzNDU2Nzg5MHF3ZXJ0" + " y aaaaaaaaaaaaaaaaaaaaaaaaaa1 and 123e4567-e89b-12d3-a456-426614174000"
    rows = [*ROWS, (20, hidden, None, None, None), (21, " ".join(["token=abcdef1"] * 600), None, None, None)]
    found = by_id(secret_scan.scan(documents(spark, rows)))
    for doc_id, text, *_ in rows:
        t = text or ""
        want = [("assign", m.start(), m.end()) for m in re.finditer(secret_scan.ASSIGN, t, re.A) if len(m[2]) >= 6]
        want += [("access", m.start(), m.end()) for m in re.finditer(secret_scan.ACCESS, t) if len(m[0]) >= 20]
        want += [("hex", m.start(), m.end()) for m in re.finditer(secret_scan.HEX, t) if len(m[0]) >= 24]
        want.sort(key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))
        assert [(s["kind"], s["start"], s["end"]) for s in found[doc_id]["base_spans"]] == want
    entropy = [s for s in found[20]["spans"] if s["kind"] == "entropy"]
    assert [hidden[s["start"] : s["end"]] for s in entropy] and all("Zm9v"[:1] <= hidden[s["start"]] for s in entropy)
    assert len(entropy) == 1 and 2 <= entropy[0]["start"] and entropy[0]["end"] <= 30
    assert secret_scan.scan(odd(spark)).count() == len(ROWS)


def test_secrets_beside_other_strings(spark):
    key = "q7Rk2ZtVb9XwLm4NcY8HsJd3FgPa6TeU"
    beside = [f"/sample-data/{key}", f"example_key={key}", f"--------{key}", f"{'0a1b2c3d4e' * 4}/{key}", f"{key}/{'0a1b2c3d4e' * 4}/{key}"]
    none = ["123e4567-e89b-12d3-a456-426614174000", "example/123e4567-e89b-12d3-a456-426614174000", "a" * 30 + "1", "sample-data/example_key1"]
    rows = [(100 + i, f"\u00e4 {text} x", None, None, None) for i, text in enumerate([*beside, *none])]
    found = by_id(secret_scan.scan(documents(spark, rows)))
    for i, text in enumerate([*beside, *none]):
        places = [m.span() for m in re.finditer(key, rows[i][1])]
        spans = [s for s in found[100 + i]["spans"] if s["kind"] == "entropy"]
        assert len(spans) == len(places), text
        # The hot part holds all of the key but characters at its ends that repeat others.
        assert all(s["start"] <= a + 4 and s["end"] >= b - 4 for s, (a, b) in zip(spans, places))


@settings(max_examples=300, deadline=None)
@given(st.integers(2, 5000), st.integers(0, 10**9))
def test_permutation_of_any_size_and_back(size, value):
    permute = pii.Permuter(b"key")
    value %= size
    other = permute(value, size, "t")
    assert 0 <= other < size and permute(other, size, "t", back=True) == value


def test_pseudonyms(spark):
    rows = [*ROWS, (30, "again a.b@mail5.example.com, 4111-1111-1111-1111 and 4111 1111 1111 1112; 2020-02-29", None, None, None)]
    found = by_id(pii.pseudonymise(documents(spark, rows), b"key"))
    one, two = found[12]["text"], found[30]["text"]
    assert not re.search("a\\.b@|4111 1111 1111 1111|2020-02-29|10\\.0\\.0\\.1", one) and "4111 1111 1111 1112" in two
    mail = re.search(r"\S+@\S+\.com", one)[0]
    assert mail in two and re.search(r"\d{4}-\d{2}-\d{2}", one)[0] in two
    card = re.search(r"\d{4} \d{4} \d{4} \d{4}", one)[0]
    assert card.replace(" ", "-") in two and pii.luhn_digit(card.replace(" ", "")[:-1]) == card[-1]
    assert [s["kind"] for s in found[12]["pii_spans"]] == ["email", "card", "date", "ip"]
    assert all(one[s["begin"] : s["end"]] for s in found[12]["pii_spans"])
    for doc_id in (1, 4, 5, 6, 7, 9):
        assert found[doc_id]["text"] == next(r[1] for r in ROWS if r[0] == doc_id)
    assert pii.pseudonymise(odd(spark), b"key", with_spans=False).columns == odd(spark).columns


@pytest.mark.parametrize("phone", ["+1 (017) 555-7713", "+1 (139) 555-2766", "+1 (415) 155-2671", "+1 (826) 555-4081"])
def test_phones_with_any_first_digit(phone):
    own = pii.Pseudonyms(b"key")
    text, spans = own.apply(f"call {phone} now")
    new = text[5:-4]
    assert text.startswith("call ") and text.endswith(" now") and spans == [(5, 5 + len(phone), "phone")]
    assert new != phone and re.sub("[0-9]", "9", new) == re.sub("[0-9]", "9", phone) and new.startswith("+1 (")
    before, after = (re.sub("[^0-9]", "", p)[1:] for p in (phone, new))
    assert pii.assignable(after) == pii.assignable(before)
    assert own.apply(f"{phone}, {phone}")[0] == f"{new}, {new}"


@pytest.mark.parametrize("text, values", [
    ("call 415-555-2671 415-555-2672", ["415-555-2671", "415-555-2672"]),
    ("call 415 555 2671 415 555 2672", ["415 555 2671", "415 555 2672"]),
    ("10012 123-45-6789", ["123-45-6789"]),
    ("415-555-2671 2024-01-05", ["415-555-2671", "2024-01-05"]),
    ("415-555-2671 365 days", ["415-555-2671"]),
    ("415-555-2671 2024.x@mail.com", ["415-555-2671", "2024.x@mail.com"]),
    ("AT61 1904 3002 3457 3201 EUR", ["AT61 1904 3002 3457 3201"]),
    ("AT61 1904 3002 3457 3201 PLEASE", ["AT61 1904 3002 3457 3201"]),
    ("+44 20 7946 0958 2024", ["+44 20 7946 0958"]),
    ("+44 20 7946 0958 12", ["+44 20 7946 0958"]),
    ("+1 (017) 555-7713 2024", ["+1 (017) 555-7713"]),
    ("7 4111 1111 1111 1111 5", ["4111 1111 1111 1111"]),
    ("4111 1111 1111 1112 and 2024-13-45 +12", []),
])
def test_values_beside_others_that_fail_their_check(text, values):
    own = pii.Pseudonyms(b"key")
    want = text
    for value in values:
        new, spans = own.apply(value)
        assert new != value and spans[0][:2] == (0, len(value))
        want = want.replace(value, new)
    new, spans = own.apply(text)
    assert new == want and [len(new[a:b]) for a, b, _ in spans] == [len(v) for v in values]


def test_languages(spark):
    de, en = "der die das und ist nicht von schön über ", "the and of is not with from this that "
    rows = [(i, (de if i % 2 else en) * (1 + i % 3), "de" if i % 2 else "en", None, None) for i in range(40)]
    model = language.learn(documents(spark, rows))
    found = by_id(language.predict(documents(spark, [(1, de, "en", None, None), (2, en, None, None, None), *ROWS[3:6], (9, "123 !", None, None, None)]), model))
    assert (found[1]["lang_pred"], found[2]["lang_pred"]) == ("de", "en")
    assert {found[i]["lang_pred"] for i in (4, 5, 6, 9)} == {"und"} and all(0 <= r["score"] <= 1 for r in found.values())
    nothing = language.learn(documents(spark, []))
    assert by_id(language.predict(odd(spark), nothing))[1]["lang_pred"] == "und"


def test_quality(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100, 130)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    clean = [(100 + i, " ".join(f"good{(i * 31 + j * 17) % 97} text{j % 7}" for j in range(60)), None, None, None) for i in range(40)]
    junk = [(200 + i, " ".join(f"WORD{(i * 7 + j) % 89}!!### $$$" for j in range(60)), None, None, None) for i in range(5)]
    docs = documents(spark, [*clean, *junk, *ROWS])
    model = quality.learn(docs, labels)
    found = by_id(quality.judge(docs, model))
    assert all(found[r[0]]["kept"] for r in clean) and not any(found[r[0]]["kept"] for r in junk)
    assert found[4]["n_words"] == 0 and found[4]["base_failed"] and not found[5]["kept"]
    assert quality.accepted(odd(spark), model).columns == odd(spark).columns
    only_rules = quality.learn(docs, labels.filter("false"))
    assert by_id(quality.judge(docs, only_rules))[200]["kept"]


def test_language_model(spark):
    rows = [(i, " ".join(["alpha beta gamma"] * (1 + i % 4)), None, None, None) for i in range(200)]
    docs = documents(spark, [*rows, *ROWS])
    model, counts = lm.learn(documents(spark, rows))
    found = lm.score(docs, model, counts).collect()
    train = Counter(w for _, t, *_ in rows for w in [*t.split(), "\n"])
    total, v = sum(train.values()), len(train)
    assert model.total == total and len(found) == len(rows) + len(ROWS)
    texts = {r[0]: r[1] or "" for r in [*rows, *ROWS]}
    for r in found:
        words = [*WORD.findall(texts[r["doc_id"]].translate(LOWER)), "\n"]
        base = sum(np.log10((train[w] + 0.5) / (total + 0.5 * (v + 1))) for w in words)
        if r["doc_id"] is None or r["doc_id"] >= 13:
            assert (r["n_tokens"], r["n_known"]) == (len(words), sum(w in train for w in words))
            assert abs(r["base_score"] - base) < 1e-6 * abs(base)
    own = [r for r in found if (r["doc_id"] or 0) >= 13]
    assert sum(r["score"] for r in own) > sum(r["base_score"] for r in own)
    shares = np.exp(model.log_shares(np.zeros((3, 5), np.int64)))
    assert np.allclose(shares.sum(axis=1), 1, atol=1e-4)
    empty, none = lm.learn(documents(spark, []))
    assert {r["score"] for r in lm.score(documents(spark, ROWS[:1]), empty, none).collect()} == {r["base_score"] for r in lm.score(documents(spark, ROWS[:1]), empty, none).collect()}


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "pii", "packing"]
    assert rows and len({(r["doc_id"], r["piece"]) for r in rows}) == len(rows)
    assert packing.configurations({}, 10) == [] and len(QUERIES) == 13
