from __future__ import annotations

import json

import pytest
from frames import ADDRESS, PERMIT

from lotwise import schemas as V
from lotwise.functions.geojson import geometry, latitude, longitude
from lotwise.plans import daily
from lotwise.plans.staging import current_wards
from lotwise.session import scratch_path, shared_folder
from lotwise.sources import features, landed
from lotwise.sources.label_store import LabelStore
from lotwise.sources.tables import Warehouse, replace_table


def land(folder, name, records, size=2, **payload):
    folder = folder / name
    folder.mkdir(parents=True)
    for i in range(0, max(len(records), 1), size):
        page = {"help": "x", "success": True, **payload, "result": {"total": 1, "records": records[i : i + size]}}
        (folder / f"page-{i}.json").write_text(json.dumps(page))


def test_pages_become_text_columns(spark, tmp_path):
    records = [
        {"_id": 1, "PERMIT_NUM": "P1", "DWELLING_UNITS_CREATED": 2, "GEO_ID": 1.5, "DESCRIPTION": "ä\nb"},
        {"PERMIT_NUM": "P2", "STATUS": None, "WORK": True}, {"PERMIT_NUM": "P3"},
    ]
    land(tmp_path, "active", records)
    got = landed.read_pages(spark, str(tmp_path / "active"), V.PERMIT_COLUMNS)
    assert got.columns == V.PERMIT_COLUMNS and {t for _, t in got.dtypes} == {"string"}
    by_num = {r.PERMIT_NUM: r for r in got.collect()}
    assert by_num["P1"].DWELLING_UNITS_CREATED == "2" and by_num["P1"].GEO_ID == "1.5"
    assert by_num["P1"].DESCRIPTION == "ä\nb" and by_num["P2"].WORK == "true" and by_num["P3"].STATUS is None


def test_geometry_objects_and_texts_are_both_text(spark, tmp_path):
    point = {"type": "Point", "coordinates": [-79.4, 43.6]}
    land(tmp_path, "a", [{**ADDRESS, "geometry": point}, {**ADDRESS, "geometry": json.dumps(point)}])
    rows = landed.read_pages(spark, str(tmp_path / "a"), V.ADDRESS_COLUMNS)
    got = rows.select(longitude("geometry"), latitude("geometry")).collect()
    assert [tuple(r) for r in got] == [(-79.4, 43.6)] * 2


def test_pretty_printed_pages(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"success": True, "result": {"records": [{"PERMIT_NUM": "P"}]}}, indent=2))
    assert landed.read_pages(spark, str(tmp_path), ["PERMIT_NUM"], multi_line=True).count() == 1


@pytest.mark.parametrize("bad", ['{"success": false, "result": {"records": []}}', '{"error": "x"}', "<html>", '{"success": tr'])
def test_a_page_without_success_is_an_error(spark, tmp_path, bad):
    land(tmp_path, "a", [PERMIT])
    (tmp_path / "a" / "bad.json").write_text(bad)
    with pytest.raises(Exception, match="page without success.*bad.json"):
        landed.read_pages(spark, str(tmp_path / "a"), V.PERMIT_COLUMNS).count()


def test_replace_table_counts_what_it_wrote(spark, tmp_path):
    path = str(tmp_path / "t")
    assert replace_table(spark.range(10), path) == 10
    assert replace_table(spark.range(3), path) == 3
    assert Warehouse(spark, str(tmp_path) + "/").read("t").count() == 3


class Session:
    """A session of which only the folder settings matter."""

    def __init__(self, master, setting=None):
        self.master, self.setting, self.folder = master, setting, None
        self.conf = self.sparkContext = self

    def get(self, key, default):
        return self.setting or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}"


def test_shared_folder_is_the_one_the_cluster_names(spark):
    assert shared_folder(Session("yarn", "s3a://bucket/tmp/")) == "s3a://bucket/tmp"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("yarn"))
    local = Session("local[2]")
    assert shared_folder(local) == shared_folder(local) == local.folder
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared_folder(spark))


def test_features_keep_nulls_and_read_back(spark, tmp_path):
    text = 'say "hi"\nand bye'
    row = {
        "permit_num": "P", "status": "active", "description": text, "dwelling_units_lost": 0, "net_units_created": 2,
        "application_date": "2023-02-03", "geom": '{"type": "Point",\n "coordinates": [-79.10, 43.6]}',
    }
    df = spark.createDataFrame([row, {**row, "geom": None}], "geom string, " + ", ".join(
        f"{n} {'string' if t == 'date' else t}" for n, t in features.PERMIT_PROPERTIES.items()
    )).withColumn("geom", geometry("geom")).withColumn("application_date", __import__("pyspark").sql.functions.to_date("application_date"))
    path = str(tmp_path / "f")
    features.write_lines(features.permit_features(df), path)
    [line] = [r.value for r in spark.read.text(path).collect()]
    feature = json.loads(line)
    assert feature["type"] == "Feature" and feature["geometry"] == {"type": "Point", "coordinates": [-79.1, 43.6]}
    assert list(feature["properties"]) == list(features.PERMIT_PROPERTIES)
    assert feature["properties"]["dwelling_units_lost"] is None and feature["properties"]["issued_date"] is None
    assert feature["properties"]["application_date"] == "2023-02-03" and feature["properties"]["description"] == text
    [back] = features.read_features(spark, path, features.PERMIT_PROPERTIES).collect()
    assert back.description == text and json.loads(back.geom) == feature["geometry"] and str(back.application_date) == "2023-02-03"


def test_ward_features_of_any_nesting(spark, tmp_path):
    shapes = ['{"type":"Polygon","coordinates":[[[1,2],[3,4],[1,2]]]}', '{"type":"MultiPolygon","coordinates":[[[[1,2],[3,4],[1,2]]]]}', "x"]
    rows = [(str(i), f"W{i}", "3000-01-01", s) for i, s in enumerate(shapes)]
    wards = current_wards(spark.createDataFrame(rows, V.text_schema(V.WARD_COLUMNS)), "2024-01-01")
    features.write_lines(features.ward_features(wards), str(tmp_path / "w"))
    back = features.read_features(spark, str(tmp_path / "w"), features.WARD_PROPERTIES).orderBy("ward_code").collect()
    assert [json.loads(r.geom) if r.geom else None for r in back] == [json.loads(shapes[0]), json.loads(shapes[1]), None]


def test_daily_run(spark, tmp_path):
    active = [{**PERMIT, "PERMIT_NUM": f"A{i}", "DWELLING_UNITS_CREATED": 1 + i} for i in range(8)]
    cleared = [{**PERMIT, "PERMIT_NUM": f"C{i}", "STATUS": s} for i, s in enumerate(["Closed", "Cancelled", "Closed"])]
    for permit in [*active, *cleared]:
        del permit["source_status"]
    active.append({**active[0], "APPLICATION_DATE": "2021-06-01", "PERMIT_NUM": "old"})
    cleared.append({**cleared[0], "REVISION_NUM": "01", "GEO_ID": "404", "STREET_NUM": "404"})
    landing = tmp_path / "landing"
    land(landing, "active_permits", active)
    land(landing, "cleared_permits", cleared)
    land(landing, "address_points", [ADDRESS])
    land(landing, "centreline", [{"LINEAR_NAME": "King", "LINEAR_NAME_TYPE": "St", "LINEAR_NAME_DIR": "W", "FEATURE_CODE_DESC": "Minor Arterial"}])
    polygon = {"type": "Polygon", "coordinates": [[[1, 2], [3, 4], [1, 2]]]}
    land(landing, "city_wards", [{"AREA_SHORT_CODE": "01", "AREA_NAME": "Ward A", "DATE_EXPIRY": "3000-01-01T00:00:00", "geometry": polygon}])
    folders = daily.Folders(str(landing), *[str(tmp_path / f) for f in ("warehouse", "labels", "export")])

    def labeler(batch):
        return json.dumps({"classifications": [
            {"permit_num": p, "unit_form": V.STANDARD, "construction_type": "severance"} for p, _ in batch if p == "A0"
        ]})

    for _ in range(2):  # a second run replaces everything and gives the same
        rows, labelling = daily.run(spark, folders, "2024-01-01", "2024-01-01T00:00:00+00:00", labeler=labeler, model="m")
        assert rows == {"cleared_permits": 4, "active_permits": 8, "address_points": 1, "city_wards": 1, "centreline": 1}
        warehouse = Warehouse(spark, folders.warehouse)
        assert warehouse.read("permits_with_units").count() == 10
        housing = {r.permit_num: r for r in warehouse.read("multiplex_permits").collect()}
        assert sorted(housing) == ["A0", "A1", "A2", "A3", "A4", "A5", "C0", "C2"]
        assert (housing["A0"].exterior_visibility, housing["A1"].exterior_visibility) == ("conversion", "interior_only")
        assert housing["C0"].geom is None and housing["A5"].unit_bucket == "6+" and housing["A1"].road_class == "major"
        assert sum(r.net_units_created for r in warehouse.read("multiplex_by_ward").collect()) == 23
        maps = Warehouse(spark, folders.export)
        assert maps.read("permits.geojsonl").count() == 7
        summary = json.loads(maps.read("summary.json").first()[0])
        assert summary["unmatched_address_count"] == 1 and summary["earliest_application_date"] == "2023-02-03"
        back = features.read_summary(spark, maps.path("summary.json")).first()
        assert json.loads(json.dumps(summary)) == json.loads(json.dumps(back.asDict(recursive=True)))
        assert summary["totals_by_status"][0] == {"status": "active", "permit_count": 6, "net_units_created": 21}
    assert (labelling.to_label, labelling.labelled, labelling.reasons) == (9, 0, {})
    report = {(r.finding, r.detail): r.n for r in warehouse.read("quality_report").collect()}
    assert report["repeated permits", "all"] == 0 and report["geometry", "read"] == 1
    assert sum(n for (finding, _), n in report.items() if finding == "geocode") == 10

    def failing(batch):
        raise TimeoutError("no answer")

    seed = tmp_path / "seed.csv"
    seed.write_text("permit_num,description_hash,construction_type,unit_form,model\nP,1,addition,standard,old\n")
    fresh = daily.Folders(folders.landing, folders.warehouse, str(tmp_path / "other-labels"), folders.export)
    _, labelling = daily.run(spark, fresh, "2024-01-01", "2024-01-01T00:00:00+00:00", labeler=failing, label_seed=str(seed))
    assert labelling.failed == labelling.to_label == 10 and set(labelling.reasons) == {"TimeoutError: no answer"}
    assert LabelStore(spark, fresh.label_store).read().first().model == "old"
    assert LabelStore(spark, folders.label_store).read().count() == 1


@pytest.mark.parametrize(
    "page",
    [
        '{"success": true}',
        '{"success": true, "result": {"records": null}}',
        '{"success": true, "result": {"records": "text"}}',
        '{"success": true, "result": []}',
        '{"success": true, "result": {"records": [{"A": "1"}, 5, {"A": "2"}]}}',
    ],
)
def test_no_page_or_record_is_lost_in_silence(spark, tmp_path, page):
    (tmp_path / "p.json").write_text(page + "\n")
    with pytest.raises(Exception, match="p.json"):
        landed.read_pages(spark, str(tmp_path), ["A"]).collect()


def test_stored_empty_labels_fall_to_the_rules(spark, tmp_path):
    store = LabelStore(spark, str(tmp_path))
    store.write(spark.createDataFrame([("a", "1", "alteration", None, "m")], V.CACHE_SCHEMA))
    assert [tuple(r) for r in store.read().collect()] == [("a", "1", "alteration", None, "m")]
