"""Runs that die, readers that stay, label versions and answers that survive."""

from __future__ import annotations

import json
import os
import uuid
from collections import Counter
from pathlib import Path

import pytest
from frames import ADDRESS, PERMIT
from pyspark.sql import functions as F
from test_files import land

from lotwise import schemas as V
from lotwise.operators import labels
from lotwise.plans import daily
from lotwise.sources.label_store import LabelStore
from lotwise.sources.ledger import Ledger
from lotwise.sources.tables import Run, Warehouse, replace_table

TYPE = "conversion"


class Killed(BaseException):
    """Not an Exception: nothing handles it."""


def row(permit, digest="1", construction=TYPE, form="f"):
    return (permit, digest, construction, form, "m")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), V.CACHE_SCHEMA)


def test_tables_of_a_run_come_into_force_together(spark, tmp_path):
    root = str(tmp_path)
    run = Warehouse(spark, root).begin()
    run.save(spark.range(3), "a")
    run.save(spark.range(4).selectExpr("id", "id % 2 AS part"), "b", partition_by=("part",))
    assert Warehouse(spark, root).rows() == {} and run.read("a").count() == 3
    with pytest.raises(KeyError, match="no committed table a"):
        Warehouse(spark, root).read("a")
    assert run.publish().number == 1
    reader = Warehouse(spark, root)
    assert reader.rows() == {"a": 3, "b": 4} and sorted(reader.read("b").columns) == ["id", "part"]

    later = reader.begin()
    later.save(later.read("a").union(spark.range(1)), "a")  # a run may read what it replaces
    later.save_lines(spark.range(2).selectExpr("string(id) AS value"), "lines")
    later.publish()
    # The reader goes on with what it has begun with; a new one sees the later run.
    assert reader.read("a").count() == 3 and Warehouse(spark, root).read("a").count() == 4
    assert Warehouse(spark, root).read("b").count() == 4 and Warehouse(spark, root).read("lines").count() == 2


def test_old_folders_go_and_running_ones_stay(spark, tmp_path):
    root = str(tmp_path)
    dead = Warehouse(spark, root).begin()
    dead.save(spark.range(9), "t")
    for n in (1, 2, 3):
        replace_table(spark.range(n), f"{root}/t")
    running = Warehouse(spark, root).begin()
    running.save(spark.range(7), "t")
    before = Warehouse(spark, root)
    removed = before.remove_old()
    assert len(removed) == 2 and before.remove_old() == [] and not (tmp_path / "t" / dead.name).exists()
    assert [c.number for c in before.commits()] == [1, 2, 3] and before.read("t").count() == 3
    running.publish()
    assert Warehouse(spark, root).read("t").count() == 7
    assert len(list((tmp_path / "t").iterdir())) == 3


def test_two_runs_at_a_time_leave_one_of_them_in_force(spark, tmp_path):
    root = str(tmp_path)
    runs = [Warehouse(spark, root).begin() for _ in range(2)]
    for n, run in enumerate(runs):
        run.save(spark.range(n + 1), "a")
        run.save(spark.range(n + 1), "b")
    for run in runs:
        run.publish()
    seen = [Warehouse(spark, root) for _ in range(3)]
    assert len({(w.read("a").count(), w.read("b").count()) for w in seen}) == 1
    assert seen[0].read("a").count() == seen[0].read("b").count()


def landing_of(tmp_path, n, name):
    landing = tmp_path / name
    rows = [{k: v for k, v in {**PERMIT, "PERMIT_NUM": f"A{i}"}.items() if k != "source_status"} for i in range(n)]
    land(landing, "active_permits", rows, size=100)
    land(landing, "cleared_permits", [{**rows[0], "STATUS": "Closed"}])
    land(landing, "address_points", [ADDRESS])
    land(landing, "centreline", [{"LINEAR_NAME": "King", "LINEAR_NAME_TYPE": "St", "LINEAR_NAME_DIR": "W", "FEATURE_CODE_DESC": "Local"}])
    polygon = {"type": "Polygon", "coordinates": [[[1, 2], [3, 4], [1, 2]]]}
    land(landing, "city_wards", [{"AREA_SHORT_CODE": "01", "AREA_NAME": "Ward A", "DATE_EXPIRY": "3000-01-01T00:00:00", "geometry": polygon}])
    return str(landing)


def test_a_daily_run_killed_anywhere_leaves_all_old_tables(spark, tmp_path, monkeypatch):
    folders = [str(tmp_path / f) for f in ("warehouse", "labels", "export")]
    stamp = ("2024-01-01", "2024-01-01T00:00:00+00:00")
    daily.run(spark, daily.Folders(landing_of(tmp_path, 3, "first"), *folders), *stamp)
    second = daily.Folders(landing_of(tmp_path, 5, "second"), *folders)

    def state():
        tables, maps = Warehouse(spark, folders[0]), Warehouse(spark, folders[2])
        return tables.rows(), maps.read("permits.geojsonl").count(), tables.read("multiplex_permits").count()

    old = state()
    assert old[1:] == (4, 4)
    saves, real, publish = [], Run._add, Run.publish
    monkeypatch.setattr(Run, "_add", lambda self, name, table: saves.append(name) or real(self, name, table))
    daily.run(spark, daily.Folders(str(tmp_path / "first"), *folders), *stamp)
    assert state() == old and len(saves) == 18

    for step in (0, 6, 11, 17):
        done = []

        def killed(self, name, table):
            if len(done) == step:
                raise Killed
            done.append(name)
            return real(self, name, table)

        monkeypatch.setattr(Run, "_add", killed)
        with pytest.raises(Killed):
            daily.run(spark, second, *stamp)
        assert len(done) == step and state() == old
    monkeypatch.setattr(Run, "_add", real)

    def stopped(self):
        raise Killed

    monkeypatch.setattr(Run, "publish", stopped)
    with pytest.raises(Killed):
        daily.run(spark, second, *stamp)
    assert state() == old
    monkeypatch.setattr(Run, "publish", publish)
    daily.run(spark, second, *stamp)
    assert state()[1:] == (6, 6)
    assert all(len(list(Path(folders[0], t).iterdir())) == 2 for t in ("raw_active_permits", "quality_report"))


def test_one_new_label_writes_one_small_file(spark, tmp_path):
    store = LabelStore(spark, str(tmp_path))
    many = [row(f"P{i}", str(j)) for i in range(200) for j in range(2)]
    store.write(frame(spark, *many))
    path = Path(store.append(frame(spark, row("P7", "1", "severance")).coalesce(1)))
    assert len(list(path.glob("delta/part-*"))) == 1 and store.latest().endswith("v00000002") and store.deltas() == 1
    want = labels.upsert(frame(spark, *many), frame(spark, row("P7", "1", "severance")))
    assert Counter(map(tuple, store.read().collect())) == Counter(map(tuple, want.collect()))
    store.append(frame(spark, row("P7", "1", "addition"), row("new", "1", None)))
    got = {r.permit_num: r.construction_type for r in store.read().filter("permit_num IN ('P7', 'new') AND description_hash = '1'").collect()}
    assert got == {"P7": "addition", "new": None} and store.read().count() == 401


def test_reading_deltas_equals_one_upsert_after_the_other(spark, tmp_path):
    store, plain = LabelStore(spark, str(tmp_path)), frame(spark)
    for n in range(6):
        new = frame(spark, *[row(f"P{i}", "1", f"t{n}") for i in range(n, 20, n + 1)])
        store.append(new) if store.latest() else store.write(new)
        plain = labels.upsert(plain, new)
        assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, plain.collect()))
    assert store.compact(share=9.0, most=9) is False and store.deltas() == 5
    assert store.compact(share=9.0, most=4) is True and store.deltas() == 0
    assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, plain.collect()))
    assert store.compact() is False


def test_dead_versions_do_not_count_and_old_ones_go(spark, tmp_path):
    store = LabelStore(spark, str(tmp_path))
    store.write(frame(spark, row("a")))
    store.append(frame(spark, row("b")))
    (tmp_path / "v00000003" / "delta").mkdir(parents=True)
    (tmp_path / "v00000004" / "base").mkdir(parents=True)
    assert store.read().count() == 2 and store.append(frame(spark, row("c"))).endswith("v00000005")
    assert store.remove_old() == [] and store.compact() is True
    assert store.write(frame(spark, row("d"))).endswith("v00000007")
    assert store.remove_old() == [f"v0000000{i}" for i in range(1, 6)]
    assert [r.permit_num for r in store.read().collect()] == ["d"] and store.latest().endswith("v00000007")


def test_a_store_from_before_there_were_deltas_is_a_base(spark, tmp_path):
    frame(spark, row("a"), row("b")).write.parquet(str(tmp_path / "v00000004"))
    store = LabelStore(spark, str(tmp_path))
    assert store.read().count() == 2
    assert store.append(frame(spark, row("b", "1", "addition"))).endswith("v00000005")
    assert {r.permit_num: r.construction_type for r in store.read().collect()} == {"a": TYPE, "b": "addition"}


def test_batch_ids_follow_from_the_keys_alone(spark):
    rows = [(f"P{i}", f"h{i}", f"text {i}") for i in range(40)]
    made = lambda r, n: labels.form_batches(spark.createDataFrame(r, "permit_num string, description_hash string, description string").coalesce(n))
    one = made(rows, 1).collect()
    other = made(rows[:20][::-1] + rows[20:], 1).collect()
    assert len(one) == 2 and {r.batch_id for r in one} == {r.batch_id for r in other}
    assert {r.batch_id for r in made(rows[1:], 1).collect()}.isdisjoint({r.batch_id for r in one})


def population(spark, n):
    return spark.createDataFrame([(f"P{i}", f"text {i}") for i in range(n)], "permit_num string, description string")


def test_a_killed_run_repeats_no_answered_call(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    store = LabelStore(spark, str(tmp_path / "labels"))

    def labeler(batch):
        # The call that comes too late ends its worker without a word.
        if (tmp_path / "deadly").exists() and len(os.listdir(calls)) >= 6:
            os._exit(1)
        (calls / uuid.uuid4().hex).write_text("\n".join(p for p, _ in batch))
        return json.dumps({"classifications": [
            {"permit_num": p, "unit_form": V.STANDARD, "construction_type": TYPE} for p, _ in batch if p != "P3"
        ]})

    (tmp_path / "deadly").touch()
    with pytest.raises(Exception):
        labels.refresh(population(spark, 400), store, labeler, "m")
    assert store.latest() is None and 6 <= len(list(calls.iterdir())) < 12
    kept = Ledger(spark, f"{store.root}/ledger").answers()
    # Calls that had ended while another worker died are on record, but for those still in flight.
    answered = {r.permit_num for r in kept.select(F.inline("requests")).collect()}
    assert len(answered) == 20 * kept.count() and 2 <= kept.count() < 12

    (tmp_path / "deadly").unlink()
    before = Counter(p for c in calls.iterdir() for p in c.read_text().split())
    run = labels.refresh(population(spark, 401), store, labeler, "m")
    after = Counter(p for c in calls.iterdir() for p in c.read_text().split()) - before
    assert not answered & set(after) and set(after) | answered == {f"P{i}" for i in range(401)}
    assert max(after.values()) == 1 and run.resumed == len(answered)
    assert (run.to_label, run.labelled, run.failed, run.cached) == (401, 400, 1, 400)

    # The run has ended: what got no valid label is asked for again, and nothing else.
    again = labels.refresh(population(spark, 401), store, labeler, "m")
    assert (again.to_label, again.resumed, again.labelled) == (1, 0, 0)


def test_a_run_killed_after_its_labels_were_stored_adds_nothing_twice(spark, tmp_path, monkeypatch):
    store = LabelStore(spark, str(tmp_path / "labels"))

    def labeler(batch):
        return json.dumps({"classifications": [{"permit_num": p, "unit_form": V.STANDARD, "construction_type": TYPE} for p, _ in batch]})

    def stopped(self):
        raise Killed

    close = Ledger.close
    monkeypatch.setattr(Ledger, "close", stopped)
    with pytest.raises(Killed):
        labels.refresh(population(spark, 30), store, labeler, "m")
    monkeypatch.setattr(Ledger, "close", close)
    run = labels.refresh(population(spark, 31), store, labeler, "m")
    assert (run.to_label, run.labelled, run.cached) == (1, 1, 31) and store.read().count() == 31


def test_a_missing_permit_number_is_labelled_once(spark, tmp_path):
    store = LabelStore(spark, str(tmp_path / "labels"))
    texts = spark.createDataFrame([(None, "a suite"), ("P", "b")], "permit_num string, description string")

    def labeler(batch):
        return json.dumps({"classifications": [{"permit_num": p, "unit_form": V.STANDARD, "construction_type": TYPE} for p, _ in batch]})

    assert labels.refresh(texts, store, labeler, "m").labelled == 2
    assert labels.refresh(texts, store, labeler, "m").to_label == 0
    from lotwise.functions.rules import with_rule_labels

    got = {r.permit_num: r.construction_type for r in labels.with_labels(with_rule_labels(texts), store.read()).collect()}
    assert got == {None: TYPE, "P": TYPE}
