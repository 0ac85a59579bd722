from __future__ import annotations

import json
import sys

import pandas as pd
import pytest
from pyspark import cloudpickle

from lotwise import schemas as V
from lotwise.checks import stub_labeler
from lotwise.functions.clean import text_digest
from lotwise.functions.rules import with_rule_labels
from lotwise.operators import labels
from lotwise.sources.label_store import LabelStore

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORM, TYPE = V.STANDARD, "conversion"


def fixed(batch):
    return json.dumps({"classifications": [{"permit_num": p, "unit_form": FORM, "construction_type": TYPE} for p, _ in batch]})


def texts(spark, rows):
    return spark.createDataFrame(rows, "permit_num string, description string")


@pytest.fixture
def store(spark, tmp_path):
    return LabelStore(spark, str(tmp_path / "labels"))


def test_only_new_and_changed_texts_are_labelled(spark, store):
    first = [(f"P{i}", f"text {i}") for i in range(50)]
    run = labels.refresh(texts(spark, first), store, fixed, "m")
    assert (run.in_scope, run.to_label, run.labelled, run.failed, run.cached) == (50, 50, 50, 0, 50)
    again = labels.refresh(texts(spark, first), store, fixed, "m")
    assert (again.to_label, again.cached) == (0, 50)
    changed = [("P0", "other text"), *first[1:], ("P1", " text 1 "), ("P2", "second text")]
    run = labels.refresh(texts(spark, changed), store, fixed, "m")
    assert (run.to_label, run.labelled, run.cached) == (2, 2, 52)
    assert store.latest().endswith("v00000002")


def test_without_a_labeler_nothing_happens(spark, store):
    assert labels.refresh(texts(spark, [("P", "t")]), store, None, "m") is None
    assert store.latest() is None and store.read().columns == V.CACHE_COLUMNS and store.read().count() == 0


def test_a_failing_call_leaves_its_batch_to_the_rules(spark, store):
    def sometimes(batch):
        if any(d == "bad" for _, d in batch):
            raise RuntimeError("no service")
        return fixed(batch)

    rows = [(f"P{i}", f"text {i}") for i in range(100)] + [("PX", "bad")]
    run = labels.refresh(texts(spark, rows), store, sometimes, "m")
    assert run.labelled + run.failed == 101 and 1 <= run.failed <= V.LABEL_BATCH
    later = labels.refresh(texts(spark, rows), store, fixed, "m")
    assert (later.to_label, later.cached) == (run.failed, 101)


def test_answers_are_checked(spark):
    answers = [
        {"permit_num": "a", "unit_form": FORM, "construction_type": TYPE},
        {"permit_num": "b", "unit_form": "castle", "construction_type": TYPE},
        {"permit_num": "c", "unit_form": FORM, "construction_type": "guess"},
        {"permit_num": "d", "unit_form": FORM},
        {"permit_num": "e", "unit_form": FORM, "construction_type": "guess"},
        {"permit_num": "e", "unit_form": FORM, "construction_type": TYPE, "more": 1},
        {"permit_num": "unasked", "unit_form": FORM, "construction_type": TYPE},
    ]
    asked = [{"permit_num": p, "description_hash": p} for p in "abcdef"]
    rows = [
        (asked, json.dumps({"classifications": answers})), ([{"permit_num": "g", "description_hash": "g"}], "not json"),
        ([{"permit_num": "h", "description_hash": "h"}], None),
    ]
    batches = spark.createDataFrame(
        rows, "requests array<struct<permit_num string, description_hash string>>, answer string"
    )
    matched = labels.match_answers(batches, "m")
    assert {r.permit_num: r.is_valid for r in matched.collect()} == {**dict.fromkeys("bcdfgh", False), "a": True, "e": True}
    assert {r.permit_num: r.construction_type for r in labels.accepted(matched).collect()} == {"a": TYPE, "e": TYPE}


def test_batches_are_full_and_hold_a_permit_once():
    frame = pd.DataFrame({"permit_num": ["a", "b", "b", *"cdefg"], "description": list("12345678")})
    made = [[row.permit_num for row in batch] for batch in labels.batches([frame.iloc[:5], frame.iloc[5:]], 3)]
    assert made == [["a", "b"], ["b", "c", "d"], ["e", "f", "g"]]


def test_cached_labels_win_for_the_same_permit_and_text_only(spark):
    scoped = with_rule_labels(texts(spark, [("a", " basement "), ("b", "basement"), ("c", None), (None, "basement")]))
    cached = texts(spark, [("a", "basement"), ("c", "x"), ("z", "basement")])
    cache = cached.select("permit_num", text_digest("description").alias("description_hash"))
    cache = cache.selectExpr("*", "'severance' as construction_type", "cast(null as string) as unit_form", "'m' as model")
    got = {r.permit_num: (r.unit_form, r.construction_type) for r in labels.with_labels(scoped, cache).collect()}
    suite = V.BASEMENT_SUITE
    assert got == {"a": (suite, "severance"), "b": (suite, "alteration"), "c": (V.STANDARD, "unclear"), None: (suite, "alteration")}


def test_upsert_replaces_by_permit_and_text(spark):
    old = spark.createDataFrame([("a", "1", "x", "f", "m"), ("a", "2", "x", "f", "m")], V.CACHE_SCHEMA)
    new = spark.createDataFrame([("a", "2", "y", "f", "n"), ("b", "1", "y", "f", "n")], V.CACHE_SCHEMA)
    got = sorted(tuple(r)[:3] for r in labels.upsert(old, new).collect())
    assert got == [("a", "1", "x"), ("a", "2", "y"), ("b", "1", "y")]


def test_a_version_without_marker_does_not_count(spark, store, tmp_path):
    one = spark.createDataFrame([("b", "1", "x", None, "m"), ("a", "1", "x", "f", "m")], V.CACHE_SCHEMA)
    store.write(one)
    (tmp_path / "labels" / "v00000002").mkdir()
    assert [r.permit_num for r in store.read().collect()] == ["a", "b"]
    assert store.read().filter("unit_form IS NULL").count() == 1
    assert store.write(one.limit(1)).endswith("v00000003") and store.read().count() == 1


def test_csv_import(spark, store, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_text('permit_num,description_hash,construction_type,unit_form,model\n"a, ""b""",h,x,f,m\nc,h,y,,m\nc,h,x,,m\n')
    store.import_csv(str(path))
    assert sorted(tuple(r) for r in store.read().collect()) == [('a, "b"', "h", "x", "f", "m"), ("c", "h", "x", None, "m")]


def test_stub_answers_are_json():
    answer = json.loads(stub_labeler.label([("p", "a suite."), ("q", "1234567"), ("r", "123456789")]))
    assert [a["permit_num"] for a in answer["classifications"]] == ["p", "r"]


def test_full_batches_and_one_request_per_key(spark, tmp_path):
    store = LabelStore(spark, str(tmp_path / "store"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        rows = [(f"p{i}", f"text {i}") for i in range(60)]
        run = labels.refresh(texts(spark, rows + [("p0", " text 0 ")]), store, fixed, "m")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert (run.to_label, run.labelled, run.cached) == (60, 60, 60)


def test_a_repeated_label_key_repeats_no_permit(spark):
    scoped = with_rule_labels(texts(spark, [("a", "basement")]))
    row = texts(spark, [("a", "basement")]).select("permit_num", text_digest("description").alias("description_hash"))
    cache = row.selectExpr("*", "'severance' as construction_type", "'x' as unit_form", "'m' as model")
    assert labels.with_labels(scoped, cache.unionByName(cache)).count() == 1
