from __future__ import annotations

from dataclasses import replace
from hashlib import md5

import pytest
from frames import addresses, permits
from pyspark.sql import functions as F

from lotwise import schemas as V
from lotwise.functions import categories
from lotwise.operators import geocode, scope
from lotwise.plans import core, marts, quality, staging


def raw_tables(spark, permit_rows, address_rows, streets=()):
    cache = spark.createDataFrame([], V.CACHE_SCHEMA)
    centreline = spark.createDataFrame(list(streets), V.text_schema(V.CENTRELINE_COLUMNS))
    wards = spark.createDataFrame([], V.text_schema(V.WARD_COLUMNS))
    return core.RawTables(permits(spark, *permit_rows), addresses(spark, *address_rows), centreline, wards, cache)


def test_latest_revision_per_source(spark):
    rows = permits(
        spark,
        {"REVISION_NUM": "9", "WORK": "old"}, {"REVISION_NUM": "10", "WORK": "new"},
        {"REVISION_NUM": None, "WORK": "none"}, {"REVISION_NUM": "x", "WORK": "text"},
        {"source_status": "cleared", "WORK": "cleared"},
        {"PERMIT_NUM": "P2", "REVISION_NUM": None, "WORK": "only"}, {"PERMIT_NUM": None, "WORK": "nobody"},
    )
    got = {(r.permit_num, r.source_status): r.work for r in staging.permits(rows).collect()}
    assert got == {
        ("P1", "active"): "new", ("P1", "cleared"): "cleared", ("P2", "active"): "only", (None, "active"): "nobody",
    }


@pytest.mark.parametrize("columns", [staging.SCOPE, staging.PLACE, staging.TEXT, staging.ALL])
def test_revision_ties_do_not_depend_on_order_or_on_the_columns_read(spark, columns):
    same = [
        {"DWELLING_UNITS_CREATED": str(1 + i % 3), "DESCRIPTION": f"text {i}", "GEO_ID": str(i % 5), "WORK": f"w{i}"}
        for i in range(40)
    ]
    want = {"dwelling_units_created": "1", "geo_id": 0, "description": "text 0", "work": "w0"}
    for parts in (1, 8):
        rows = permits(spark, *same).repartition(parts, F.rand(parts))
        [got] = staging.permits(rows, columns).collect()
        assert all(got[c] == v for c, v in want.items() if c in columns)


def test_scope(spark):
    cases = [
        ({}, True),
        ({"DWELLING_UNITS_CREATED": None}, False), ({"DWELLING_UNITS_CREATED": " "}, False),
        ({"DWELLING_UNITS_CREATED": "0"}, False), ({"DWELLING_UNITS_CREATED": "0.5"}, True),
        ({"STRUCTURE_TYPE": "SFD - Detached"}, False), ({"STRUCTURE_TYPE": "sfd"}, True),
        ({"STRUCTURE_TYPE": None}, True), ({"STRUCTURE_TYPE": " Hospital "}, False),
        ({"PROPOSED_USE": "New SFD"}, False), ({"PROPOSED_USE": "a Single house"}, False), ({"PROPOSED_USE": None}, True),
        ({"STATUS": None}, True), ({"STATUS": " Superseded "}, False), ({"STATUS": "Closed"}, True),
        ({"source_status": "cleared"}, False), ({"source_status": "cleared", "STATUS": "Closed "}, True),
        ({"source_status": "cleared", "STATUS": None}, False), ({"source_status": "other"}, False),
    ]
    rows = permits(spark, *[{"PERMIT_NUM": f"P{i}", **change} for i, (change, _) in enumerate(cases)])
    kept = {r.permit_num for r in scope.in_scope(staging.permits(rows)).collect()}
    assert kept == {f"P{i}" for i, (_, inside) in enumerate(cases) if inside}


def test_an_earlier_revision_in_scope_does_not_count(spark):
    rows = permits(spark, {"REVISION_NUM": "0"}, {"REVISION_NUM": "1", "STATUS": "Cancelled"})
    assert scope.in_scope(staging.permits(rows)).count() == 0


def test_net_units(spark):
    pairs = [("3", "1"), ("3", None), ("3", "x"), ("1", "2"), ("2147483647", "-1"), ("2.5", "0.4")]
    rows = permits(
        spark,
        *[{"PERMIT_NUM": str(i), "DWELLING_UNITS_CREATED": a, "DWELLING_UNITS_LOST": b} for i, (a, b) in enumerate(pairs)],
    )
    got = scope.with_units(staging.permits(rows)).orderBy("permit_num").collect()
    assert [r.net_units_created for r in got] == [2, 3, 3, -1, None, 3]


def test_minimum_date_compares_text_and_drops_missing(spark):
    rows = permits(spark, *[{"APPLICATION_DATE": d} for d in ("2021-12-31", "2022-01-01", "2022-01-01T00:00", None, "x")])
    assert scope.filed_since(rows, "2022-01-01").count() == 3


def test_streets_take_the_most_common_feature(spark):
    def feature(name, *kinds):
        return [(name, "St", None, kind) for kind in kinds]

    rows = [
        *feature("King", "Local", "Major Arterial", "Major Arterial", None, None, None),
        *feature(" king ", "Local", "Local"), *feature("Tie", "River", "Local"), *feature("None", None),
        *feature(None, "Laneway"), *feature("Ramp", "Expressway Ramp"),
    ]
    raw = spark.createDataFrame(rows, V.text_schema(V.CENTRELINE_COLUMNS))
    got = {r.street_name: (r.road_feature, r.road_class) for r in staging.streets(raw).collect()}
    assert got == {
        "KING": ("Local", "minor"), "TIE": ("Local", "minor"), None: ("Laneway", "minor"), "RAMP": ("Expressway Ramp", "major"),
    }


def test_current_wards(spark):
    expiry = ["3000-01-01T00:00:00", "2024-01-01", "2024-01-01T00:00:01", "2018-11-30", None, "open"]
    rows = [(str(i), f"W{i}", e, '{"type":"Polygon","coordinates":[]}') for i, e in enumerate(expiry)]
    raw = spark.createDataFrame(rows, V.text_schema(V.WARD_COLUMNS))
    assert {r.ward_code for r in staging.current_wards(raw, "2024-01-01").collect()} == {"0", "2"}


def test_bad_geometry_is_missing(spark):
    texts = ['{"type":"Point","coordinates":[1,2]}', "oops", '{"type":"Point"', "5", "{}", None, '{"type":"Thing"}']
    rows = addresses(spark, *[{"ADDRESS_POINT_ID": str(i), "geometry": t} for i, t in enumerate(texts)])
    staged = staging.addresses(rows)
    assert [r.geom is not None for r in staged.orderBy("address_point_id").collect()] == [True] + [False] * 6
    assert {r.detail: r.n for r in quality.bad_geometry(rows, staged).collect()} == {"given": 6, "read": 1}


def located(spark, permit_rows, address_rows):
    staged = staging.permits(permits(spark, *permit_rows))
    return geocode.locate(staged, staging.addresses(addresses(spark, *address_rows)))


def test_geocoding_fills_each_value_from_id_then_street(spark):
    got = located(
        spark,
        [
            {"PERMIT_NUM": "id"}, {"PERMIT_NUM": "mixed", "GEO_ID": "200"}, {"PERMIT_NUM": "street", "GEO_ID": None},
            {"PERMIT_NUM": "retired", "GEO_ID": "9"}, {"PERMIT_NUM": "none", "GEO_ID": "x", "STREET_NUM": "99"},
            {"PERMIT_NUM": "no key", "GEO_ID": None, "STREET_TYPE": None},
        ],
        [
            {"ADDRESS_FULL": "by id"}, {"ADDRESS_POINT_ID": "200", "ADDRESS_NUMBER": "2", "WARD_NAME": None, "ADDRESS_FULL": "two"},
            {"ADDRESS_POINT_ID": "50", "ADDRESS_FULL": "lowest", "WARD_NAME": "Ward B"},
            {"ADDRESS_POINT_ID": None, "ADDRESS_FULL": "no id"}, {"ADDRESS_POINT_ID": "7", "LINEAR_NAME_TYPE": None},
        ],
    )
    assert {r.permit_num: (r.full_address, r.ward, r.geocode_method) for r in got.collect()} == {
        "id": ("by id", "Ward A", "id"), "mixed": ("two", "Ward B", "id"), "street": ("lowest", "Ward B", "street"),
        "retired": ("lowest", "Ward B", "street"), "none": (None, None, "none"), "no key": (None, None, "none"),
    }


def test_a_repeated_address_id_repeats_the_permit(spark):
    twice = [{"ADDRESS_FULL": "a"}, {"ADDRESS_FULL": "b"}, {"ADDRESS_FULL": "b"}]
    got = located(spark, [{}], twice)
    assert sorted(r.full_address for r in got.collect()) == ["a", "b", "b"]
    assert [tuple(r) for r in quality.repeated_addresses(staging.addresses(addresses(spark, *twice))).collect()] == [(100, 3)]


def test_hot_keys_change_no_result(shuffled_joins):
    spark = shuffled_joins
    rows = [{"PERMIT_NUM": f"P{i}", "GEO_ID": "100" if i % 2 else None if i % 3 else str(i)} for i in range(60)]
    points = [{"ADDRESS_FULL": f"a{i % 4}"} for i in range(30)] + [
        {"ADDRESS_POINT_ID": str(i), "ADDRESS_NUMBER": str(i)} for i in range(60)
    ]
    staged, stored = staging.permits(permits(spark, *rows)), staging.addresses(addresses(spark, *points))
    hot = geocode.measure_hot_keys(staged, stored)
    assert hot.by_id == [100] and hot.repeated_ids == [100]
    plain = geocode.locate(staged, stored)
    assert sorted(geocode.locate(staged, stored, hot).collect()) == sorted(plain.collect())
    assert plain.count() == 30 * 30 + 30


def test_categories(spark):
    suite, plain = V.BASEMENT_SUITE, V.STANDARD
    cases = [
        ("Laneway / Rear Yard Suite", suite, V.LANEWAY_CATEGORY), ("2 Unit - Detached", suite, V.SUITE_CATEGORY),
        ("2 Unit - Detached", plain, V.DUPLEX_CATEGORY), ("Duplex/Semi", plain, V.DUPLEX_CATEGORY),
        ("3+ Unit - Detached", suite, V.TRIPLEX_CATEGORY), ("Triplex", plain, V.TRIPLEX_CATEGORY),
        ("Stacked Townhouses", plain, V.APARTMENT_CATEGORY), ("Boarding/Lodging House", plain, V.ROOMING_CATEGORY),
        ("Mixed Use/Res w Non Res", plain, V.MIXED_CATEGORY), (" Duplex", plain, V.OTHER_CATEGORY), (None, suite, V.OTHER_CATEGORY),
    ]
    df = spark.createDataFrame(cases, "structure string, form string, want string")
    assert df.filter(categories.structure_category("structure", "form") != F.col("want")).count() == 0
    df = spark.createDataFrame([(t,) for t in [*V.CONSTRUCTION_TYPES, "guess", None]], "t string")
    seen = {r.t: r.v for r in df.select("t", categories.exterior_visibility("t").alias("v")).collect()}
    assert seen == {**{t: V.VISIBILITY_OF_CONSTRUCTION.get(t, "unclear") for t in V.CONSTRUCTION_TYPES}, "guess": "unclear", None: "unclear"}


def test_marts_agree_with_each_other(spark):
    rows = [
        {"PERMIT_NUM": f"P{i}", "DWELLING_UNITS_CREATED": str(i), "GEO_ID": "100" if i % 2 else None, "STREET_NUM": "0",
         "source_status": "active" if i % 3 else "cleared", "STATUS": "Closed",
         "APPLICATION_DATE": f"2023-0{1 + i % 9}-01" if i != 2 else "soon", "COMPLETED_DATE": "2024-02-01" if i == 4 else None}
        for i in range(1, 9)
    ]
    raw = raw_tables(spark, rows, [{}])
    wide, narrow = core.multiplex(core.permits_core(raw)), core.placed_multiplex(raw)
    assert {r.permit_num: r.unit_bucket for r in wide.collect()} == {
        "P1": "1", "P2": "2", "P3": "3", "P4": "4", "P5": "5", "P6": "6+",
    }
    for mart in (marts.by_ward, marts.by_month, marts.totals_by_status):
        assert sorted(map(str, mart(wide).collect())) == sorted(map(str, mart(narrow).collect()))
    total = [sum(r.net_units_created for r in m.collect()) for m in (marts.by_ward(wide), marts.by_month(wide), marts.totals_by_status(wide))]
    assert total == [21, 21, 21]
    months = {(r.year_month, r.status): r.permit_count for r in marts.by_month(wide).collect()}
    assert months[("2024-02", "active")] == 1 and months[(None, "active")] == 1
    [row] = marts.summary(wide, "now").collect()
    assert [t.status for t in row.totals_by_status] == ["active", "cleared"]
    assert (row.unmatched_address_count, row.earliest_application_date, row.latest_application_date) == (3, "2023-02-01", "2023-07-01")


def test_shuffled_lookups_place_the_same_rows(shuffled_joins):
    spark = shuffled_joins
    rows = [{"PERMIT_NUM": n, "GEO_ID": g, "source_status": s} for n in ("a", "b", None) for g, s in (("100", "active"), (None, "active"))]
    rows += [{"PERMIT_NUM": "a", "STATUS": "Closed", "source_status": "cleared", "STREET_NUM": "9", "GEO_ID": "9"}]
    points = [{"ADDRESS_FULL": "x"}, {"ADDRESS_FULL": "y"}, {"ADDRESS_POINT_ID": "5", "ADDRESS_NUMBER": "1"}]
    raw = raw_tables(spark, [{**r, "REVISION_NUM": str(i)} for i, r in enumerate(rows)], points, [("King", "St", "W", "Local")])
    twice = replace(raw, labels=spark.createDataFrame([("a", text_digest_of(""), "alteration", f, "m") for f in ("x", "y")], V.CACHE_SCHEMA))
    columns = ["permit_num", "status", "full_address", "ward", "geom", "road_class", "description"]
    found = []
    for tables in (raw, replace(raw, measured=True), twice):
        for limit in ("-1", "10MB"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            found.append(sorted(map(str, core.permits_core(tables).select(*columns).collect())))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert len(found[0]) == 4 and all(rows == found[0] for rows in found)


def text_digest_of(text: str) -> str:
    return md5(text.strip(" ").encode()).hexdigest()


def test_summary_of_nothing(spark):
    [row] = marts.summary(core.placed_multiplex(raw_tables(spark, [{"STATUS": "Refused"}], [{}])), "now").collect()
    assert (row.totals_by_status, row.unmatched_address_count, row.earliest_application_date) == ([], 0, None)


def test_geometry_is_fetched_last_and_addresses_are_staged_once(shuffled_joins):
    spark = shuffled_joins
    raw = raw_tables(spark, [{"PERMIT_NUM": f"P{i}"} for i in range(5)], [{}], [("King", "St", "W", "Local")])
    lines = core.permits_core(raw)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    joins = [i for i, line in enumerate(lines) if "Join LeftOuter" in line]
    # Outermost first: two fetches, street, id, road class, cached labels.
    assert len(joins) == 6 and lines[joins[0]].count("_first") and lines[joins[1]].count("_second")
    end = next(i for i in range(joins[2] + 1, len(lines)) if depth[i] <= depth[joins[2]])
    look_ups = lines[joins[2] : end]
    assert not any("geom" in line for line in look_ups if "Relation" not in line)
    reads = [line for line in lines if "Relation [" in line and "address_row" in line]
    assert len(reads) == 4 and not any("parse_json" in line for line in lines)


def test_the_street_is_looked_up_for_unresolved_permits_only(spark):
    rows = [{"PERMIT_NUM": "whole"}, {"PERMIT_NUM": "partly", "GEO_ID": "7"}, {"PERMIT_NUM": "street", "GEO_ID": None}]
    points = [{}, {"ADDRESS_POINT_ID": "7", "WARD_NAME": None, "ADDRESS_NUMBER": "5"}]
    got = geocode.resolve(staging.permits(permits(spark, *rows)), staging.addresses(addresses(spark, *points)))
    assert {r.permit_num: (r.id_row is not None, r.street_row is not None, r.geocode_method) for r in got.collect()} == {
        "whole": (True, False, "id"), "partly": (True, True, "id"), "street": (False, True, "street"),
    }


def test_hot_addresses_are_fetched_alike(shuffled_joins):
    spark = shuffled_joins
    rows = [{"PERMIT_NUM": f"P{i}", "GEO_ID": "100" if i % 2 else "200" if i % 3 else None} for i in range(90)]
    points = [
        {}, {"ADDRESS_POINT_ID": "200", "WARD_NAME": None, "ADDRESS_NUMBER": "9"},
        {"ADDRESS_POINT_ID": "50", "WARD_NAME": "Ward B", "ADDRESS_FULL": "lowest"},
    ]
    staged, stored = staging.permits(permits(spark, *rows)), staging.addresses(addresses(spark, *points))
    hot = geocode.measure_hot_keys(staged, stored)
    assert hot.by_id == [100, 200] and len(hot.by_street) == 1 and max(hot.id_salts.values()) > 3
    plain = sorted(map(str, geocode.locate(staged, stored).collect()))
    assert sorted(map(str, geocode.locate(staged, stored, hot).collect())) == plain
    wild = geocode.HotKeys({100: 2, 7: 9}, {next(iter(hot.street_salts)): 5}, {}, {})
    assert sorted(map(str, geocode.locate(staged, stored, wild).collect())) == plain
