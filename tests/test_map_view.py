from __future__ import annotations

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from lotwise import schemas as V
from lotwise.functions import bins
from lotwise.functions.months import month_at
from lotwise.operators import facets
from lotwise.operators.facets import Facets
from lotwise.plans import map_view

SCHEMA = (
    "permit_num string, status string, road_class string, structure_category string, exterior_visibility string, "
    "application_date date, ward string, net_units_created int, geom string"
)
BASE = ("p", "active", "minor", V.DUPLEX_CATEGORY, "conversion", date(2023, 5, 1), "A", 2, '{"type":"Point","coordinates":[-79.4,43.6]}')


def rows(spark, *changes):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    made = [{**dict(zip(names, BASE)), "permit_num": f"p{i}", **change} for i, change in enumerate(changes)]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in made], SCHEMA)


def shown(df, choice=Facets()):
    return sorted(r.permit_num for r in facets.visible(df, choice).collect())


def test_facets(spark):
    df = rows(
        spark, {}, {"status": "cleared"}, {"status": "other"}, {"exterior_visibility": "interior_only"}, {"road_class": "major"},
        {"road_class": None}, {"structure_category": "Castle"}, {"application_date": None}, {"application_date": date(2022, 1, 31)},
    )
    assert shown(df) == ["p0", "p1", "p2", "p4", "p7", "p8"]
    assert shown(df, Facets(active=False)) == ["p1", "p2"]
    assert shown(df, Facets(active=False, cleared=False)) == ["p2"]
    assert shown(df, Facets(road_classes=("major",))) == ["p4"]
    assert shown(df, Facets(visibilities=("interior_only",))) == ["p3"]
    assert shown(df, Facets(months=("2022-01", "2022-12"))) == ["p7", "p8"]
    assert shown(df, Facets().with_slider("2022-01", 20, 1)) == ["p0", "p1", "p2", "p4", "p7"]
    assert shown(df, Facets(structures=())) == []


def test_slider_months():
    assert [month_at("2022-11", i) for i in (0, 1, 2, 14)] == ["2022-11", "2022-12", "2023-01", "2024-01"]


def test_layers_are_told_apart_by_status(spark):
    df = rows(spark, {"permit_num": "x"}, {"permit_num": "x", "status": "cleared"})
    only = facets.shown_layers(df, facets.visible(df, Facets(cleared=False)))
    assert [r.status for r in only.collect()] == ["active"]
    assert df.select(facets.feature_key()).distinct().count() == 2


def test_tiles(spark):
    df = rows(spark, {}, {"status": "cleared", "net_units_created": None}, {"status": "other"})
    assert tuple(map_view.stat_tiles(df).first()) == (4, 3, 1, 1)
    assert tuple(map_view.stat_tiles(df.limit(0)).first()) == (0, 0, 0, 0)


def expected_bins(values):
    values, cuts = sorted(values), []
    for q in (0, 0.2, 0.4, 0.6, 0.8):
        at = (len(values) - 1) * q
        low, high = math.floor(at), math.ceil(at)
        cut = values[low] + (values[high] - values[low]) * (at - low) if values else 0
        cuts.append(cut if not cuts or cut > cuts[-1] else cuts[-1] + 1)
    return cuts


@pytest.mark.parametrize(
    "values", [[], [0], [5] * 10, list(range(25)), [0] * 20 + [1, 2, 3, 40, 500], [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5], [0, 0, 0, 1]]
)
def test_bins(spark, values):
    df = spark.createDataFrame([(f"w{i}", v) for i, v in enumerate(values)], "ward_name string, net_units bigint")
    want = expected_bins(values)
    assert bins.cut_points(df, "net_units").first()["cuts"] == pytest.approx(want)
    for r in map_view.ward_bins(df).collect():
        assert r.bin == max([i for i, cut in enumerate(want) if r.net_units >= cut], default=0)
    legend = map_view.bin_legend(df).orderBy("bin").collect()
    round_up = lambda x: math.floor(x + 0.5)
    assert [r.low for r in legend] == [round_up(c) for c in want]
    assert [r.high for r in legend] == [*[round_up(c - 1) for c in want[1:]], max([1, *values])]
    assert [r.is_open for r in legend] == [False] * 4 + [True]


def test_ward_totals(spark):
    df = rows(spark, {}, {}, {"ward": None}, {"ward": ""}, {"ward": "gone"}, {"ward": "B", "net_units_created": None})
    wards = spark.createDataFrame([("A",), ("A",), ("B",), ("C",), ("",), (None,)], "ward_name string")
    got = {r.ward_name: r.net_units for r in map_view.ward_totals(df, wards).collect()}
    assert got == {"A": 4, "B": 0, "C": 0, "": 0, None: 0}


def test_histogram(spark):
    df = rows(
        spark, {"application_date": date(2022, 11, 30)}, {"application_date": date(2023, 2, 1)},
        {"application_date": date(2023, 2, 28)}, {"application_date": None},
    )
    histogram = map_view.month_histogram(df)
    assert [tuple(r) for r in histogram.orderBy("month_index").collect()] == [
        (0, "2022-11", 1), (1, "2022-12", 0), (2, "2023-01", 0), (3, "2023-02", 2),
    ]
    assert [r.share for r in map_view.bar_shares(histogram).orderBy("month_index").collect()] == [0.5, 0, 0, 1]
    assert map_view.month_histogram(df.filter("application_date is null")).count() == 0


def test_zoom_cells(spark):
    near = '{"type":"Point","coordinates":[-79.40001,43.60001]}'
    far = '{"type":"Point","coordinates":[-75.0,45.0]}'
    df = rows(spark, {}, {"geom": near}, {"geom": far})
    cells = map_view.zoom_cells(df, 10)
    assert sorted(r.permits for r in cells.collect()) == [1, 2]
    assert [(r.permits, r.bin) for r in map_view.cluster_bins(cells).collect()] == [(2, 0)]
    world = spark.createDataFrame([(0.0, 0.0), (-180.0, 0.0)], "lon double, lat double")
    from lotwise.functions.geojson import grid_cell

    x, y = grid_cell("lon", "lat", 0, 16)
    assert [tuple(r) for r in world.select(x, y).collect()] == [(8, 8), (0, 8)]
