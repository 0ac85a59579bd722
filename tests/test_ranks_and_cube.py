"""Exact ranks, the facet cube and the cell pyramid against plain versions."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F
from test_map_view import rows

from lotwise import schemas as V
from lotwise.functions.geojson import grid_cell
from lotwise.functions.morton import cell_of, coarser, morton_key
from lotwise.operators import facets, ranks
from lotwise.operators.facets import Facets
from lotwise.plans import cube, map_view


def test_ranks_of_any_whole_numbers(spark):
    rnd = random.Random(3)
    values = [rnd.randrange(-(2**63), 2**63) for _ in range(300)] + [rnd.randrange(-4, 4) for _ in range(300)]
    values += [2**63 - 1, -(2**63), 0, 65535, 65536, -65536, 2**32, 2**48 - 1]
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)] + [(None, 0), (5, None)], "v bigint, g int")
    every = F.sequence(F.lit(0).cast("bigint"), F.col("n"), F.lit(53).cast("bigint"))
    [got] = ranks.values_at(ranks.counted(df.filter("g IS NOT NULL"), "v", []), [], every).collect()
    ordered = sorted(values)
    assert {r["rank"]: r["value"] for r in got["found"]} == {k: ordered[k] for k in range(0, len(ordered), 53)}
    for group in range(3):
        mine = sorted(v for i, v in enumerate(values) if i % 3 == group)
        found = ranks.values_at(ranks.counted(df, "v", ["g"]), ["g"], F.array(F.lit(0).cast("bigint"), F.col("n") - 1, F.col("n")))
        [row] = found.filter(F.col("g") == group).collect()
        assert {r["rank"]: r["value"] for r in row["found"]} == {0: mine[0], len(mine) - 1: mine[-1]}


@pytest.mark.parametrize("values", [[7], [1, 1, 1], [3, 1, 2], list(range(101)), [-5, 10**12, 0, 0, 3]])
def test_quantiles_equal_the_built_in_exact_ones(spark, values):
    shares = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    [row] = ranks.quantiles(df, "v", shares).collect()
    assert row["quantiles"] == df.select(F.percentile(F.col("v").cast("double"), shares)).first()[0]


def test_quantiles_of_groups(spark):
    df = spark.range(300).selectExpr("id % 3 AS g", "id * id % 101 AS v")
    got = {r["g"]: r["quantiles"] for r in ranks.quantiles(df, "v", [0.25, 0.5], ["g"]).collect()}
    want = df.groupBy("g").agg(F.percentile(F.col("v").cast("double"), [0.25, 0.5]).alias("q")).collect()
    assert got == {r["g"]: r["q"] for r in want}


def test_bins_start_no_job_while_planning(spark):
    totals = spark.range(50).selectExpr("'w' || id AS ward_name", "id * 7 % 40 AS net_units")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "bins")
    try:
        planned = [map_view.ward_bins(totals), map_view.bin_legend(totals), map_view.cluster_bins(totals.withColumnRenamed("net_units", "permits"))]
        assert len(tracker.getJobIdsForGroup("planning")) == 0
    finally:
        spark.sparkContext.setJobGroup("rest", "rest")
    assert [p.count() for p in planned] == [50, 5, 47]


def test_no_window_holds_all_values(spark):
    df = spark.range(10).selectExpr("id AS v")
    plan = ranks.quantiles(df, "v", [0.5])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # Windows run over the sums below one prefix, 2^16 at most; the first step knows only one.
    assert windows and all("prefix" in w for w in windows) and "percentile" not in plan


def choices():
    yield Facets()
    yield Facets(active=False)
    yield Facets(active=False, cleared=False)
    yield Facets(road_classes=("major",), visibilities=tuple(V.VISIBILITIES))
    yield Facets(structures=())
    yield Facets(months=("2022-03", "2023-01"))
    yield Facets(cleared=False, structures=(V.DUPLEX_CATEGORY,), months=("2021-01", "2022-06"))


@pytest.fixture
def mapped(spark):
    rnd = random.Random(8)
    changes = [
        {
            "status": rnd.choice(["active", "cleared", "other"]), "road_class": rnd.choice(["major", "minor", "unknown", None]),
            "structure_category": rnd.choice([V.DUPLEX_CATEGORY, V.OTHER_CATEGORY]),
            "exterior_visibility": rnd.choice(V.VISIBILITIES), "ward": rnd.choice(["A", "B", "", None, "gone"]),
            "application_date": rnd.choice([None, date(2022, rnd.randrange(1, 13), 5), date(2023, 1, 31)]),
            "net_units_created": rnd.choice([None, 1, 2, 6]),
        }
        for _ in range(200)
    ]
    return rows(spark, *changes)


def test_every_choice_of_facets_follows_from_the_cube(spark, mapped):
    stored = cube.facet_cube(mapped)
    wards = spark.createDataFrame([("A",), ("B",), ("C",), ("",), (None,)], "ward_name string")
    for choice in choices():
        shown, cells = facets.visible(mapped, choice), cube.chosen(stored, choice)
        assert tuple(cube.stat_tiles(cells).first()) == tuple(map_view.stat_tiles(shown).first())
        assert Counter(map(tuple, cube.ward_totals(cells, wards).collect())) == Counter(map(tuple, map_view.ward_totals(shown, wards).collect()))
    assert sorted(map(tuple, cube.month_histogram(stored).collect())) == sorted(map(tuple, map_view.month_histogram(mapped).collect()))
    counts = {(r["facet"], r["value"]): (r["permits"], r["net_units"]) for r in cube.facet_counts(stored).collect()}
    for facet in cube.FACETS:
        for r in mapped.groupBy(facet).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("net_units_created"), F.lit(0)).alias("u")).collect():
            assert counts[facet, r[0]] == (r["n"], r["u"])
    assert tuple(cube.stat_tiles(cube.facet_cube(mapped.limit(0))).first()) == (0, 0, 0, 0)


def test_morton_keys(spark):
    pairs = [(0, 0), (1, 0), (0, 1), (5, 9), (2**31 - 1, 0), (0, 2**31 - 1), (123456789, 987654321 % 2**31)]
    df = spark.createDataFrame(pairs, "x bigint, y bigint").withColumn("k", morton_key(F.col("x"), F.col("y")))
    x, y = cell_of(F.col("k"))
    cx, cy = cell_of(coarser(F.col("k"), 3))
    for r in df.select("x", "y", "k", x.alias("bx"), y.alias("by"), cx.alias("cx"), cy.alias("cy")).collect():
        assert r.k == sum((r.x >> b & 1) << 2 * b | (r.y >> b & 1) << 2 * b + 1 for b in range(31))
        assert (r.bx, r.by, r.cx, r.cy) == (r.x, r.y, r.x >> 3, r.y >> 3)


def test_every_zoom_of_the_pyramid_equals_its_own_cells(spark):
    rnd = random.Random(2)
    places = [(rnd.uniform(-79.6, -79.1), rnd.uniform(43.5, 43.9)) for _ in range(150)] + [(-179.9, 86.0), (179.9, -88.0), (0.0, 0.0)]
    geoms = [f'{{"type":"Point","coordinates":[{lon},{lat}]}}' for lon, lat in places] + [None]
    shown = rows(spark, *[{"geom": g} for g in geoms])
    found = {}
    for r in cube.cell_pyramid(shown, 0, 19).collect():
        found.setdefault(r.zoom, Counter())[r.cell_x, r.cell_y] = r.permits
    assert sorted(found) == list(range(20))
    for zoom in (0, 5, 10, 12, 17, 19):
        want = Counter({(r.cell_x, r.cell_y): r.permits for r in map_view.zoom_cells(shown, zoom).collect()})
        assert found[zoom] == want
    scans = cube.cell_pyramid(shown)._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD")
    assert scans + cube.cell_pyramid(shown)._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation") == 1


def test_pyramid_bins_are_those_of_each_zoom(spark):
    rnd = random.Random(4)
    geoms = [f'{{"type":"Point","coordinates":[{-79.4 + rnd.gauss(0, 0.01)},{43.6 + rnd.gauss(0, 0.01)}]}}' for _ in range(200)]
    pyramid = cube.cell_pyramid(rows(spark, *[{"geom": g} for g in geoms]), 10, 14)
    got = sorted(map(tuple, cube.pyramid_bins(pyramid).collect()))
    want = []
    for zoom in range(10, 15):
        cells = pyramid.filter(F.col("zoom") == zoom).drop("zoom")
        want += [(zoom, *r) for r in map_view.cluster_bins(cells).collect()]
    assert got == sorted(want)
