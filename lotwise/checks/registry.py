"""Every registered query: a function of a session and a folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lotwise import schemas as V
from lotwise.checks import fixtures, stub_labeler
from lotwise.functions import categories, geojson
from lotwise.functions.rules import with_rule_labels
from lotwise.operators import facets, geocode, labels, scope
from lotwise.operators.facets import Facets
from lotwise.plans import core, cube, daily, map_view, marts, quality, staging
from lotwise.session import prepare, scratch_path
from lotwise.sources import features, landed
from lotwise.sources.label_store import LabelStore
from lotwise.sources.tables import Warehouse, stored

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# A narrower choice than the default facets.
SOME_FACETS = Facets(
    cleared=False,
    road_classes=("major", "unknown"),
    structures=(V.SUITE_CATEGORY, V.DUPLEX_CATEGORY, V.TRIPLEX_CATEGORY, V.OTHER_CATEGORY),
    visibilities=tuple(V.VISIBILITIES),
    months=("1996-03", "1999-10"),
)
ZOOM = 12
# Zooms of the pyramid: those at which the map draws clusters.
COARSEST, FINEST = 9, 16
# The stub answers at once, so a task may as well hold many calls.
CALLS_PER_COMMIT = 50


def query(make: Callable[[core.RawTables], DataFrame]) -> Callable[[core.RawTables], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return make(fixtures.ViewTables(prepare(spark), sf_dir))

    REGISTRY[make.__name__] = run
    return make


def located_query(make: Query) -> Query:
    """A query that also needs the session, for example to land or store files."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return make(prepare(spark), sf_dir)

    REGISTRY[make.__name__] = run
    return make


def as_point(df: DataFrame) -> DataFrame:
    """Geometry text as two numbers: its printing is not the same in all engines."""
    return df.withColumns({"lon": geojson.longitude("geom"), "lat": geojson.latitude("geom")}).drop("geom")


def mapped_multiplex(raw: core.RawTables) -> DataFrame:
    return facets.is_mapped(core.multiplex(core.permits_core(raw)))


def shown_ward_totals(raw: core.RawTables) -> DataFrame:
    shown = facets.visible(mapped_multiplex(raw))
    return map_view.ward_totals(shown, staging.current_wards(raw.city_wards, fixtures.AS_OF))


# Sources and staging


@located_query
def landed_permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permits landed as pages, read again and narrowed to the first date."""
    path = scratch_path(spark, "pages")
    rows = fixtures.view(spark, sf_dir, "fx_permits")
    number = F.substring("permit_num", 2, 20).cast("bigint")
    fixtures.land_pages(rows, path, V.PERMIT_COLUMNS, number)
    pages = scope.filed_since(landed.read_pages(spark, path, V.PERMIT_COLUMNS), fixtures.MIN_DATE)
    return pages.toDF(*[c.lower() for c in pages.columns])


@located_query
def landed_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "pages")
    rows = fixtures.view(spark, sf_dir, "fx_address_points")
    number = F.regexp_extract("address_full", "([0-9]+)", 1).cast("bigint")
    fixtures.land_pages(rows, path, V.ADDRESS_COLUMNS, number)
    pages = landed.read_pages(spark, path, V.ADDRESS_COLUMNS)
    return pages.toDF(*[c.lower() for c in pages.columns])


@query
def stg_permits(raw: core.RawTables) -> DataFrame:
    return staging.permits(raw.permits)


@query
def stg_addresses(raw: core.RawTables) -> DataFrame:
    return as_point(staging.addresses(raw.address_points))


@query
def first_addresses(raw: core.RawTables) -> DataFrame:
    return as_point(geocode.first_address_per_street_key(staging.addresses(raw.address_points)))


@query
def street_class(raw: core.RawTables) -> DataFrame:
    return staging.streets(raw.centreline)


@query
def current_wards(raw: core.RawTables) -> DataFrame:
    return staging.current_wards(raw.city_wards, fixtures.AS_OF)


# Scope and labels


@query
def scoped_permits(raw: core.RawTables) -> DataFrame:
    return core.scoped_permits(raw, staging.PLACE)


@query
def unit_buckets(raw: core.RawTables) -> DataFrame:
    few = scope.small_gain(core.scoped_permits(raw, staging.SCOPE))
    bucket = categories.unit_bucket("net_units_created").alias("unit_bucket")
    return few.groupBy(bucket, "source_status").agg(F.count(F.lit(1)).alias("permits"))


@query
def rule_labels(raw: core.RawTables) -> DataFrame:
    labelled = with_rule_labels(core.scoped_permits(raw, staging.TEXT))
    return labelled.select(
        "permit_num", "source_status", "description", "rule_unit_form", "rule_construction_type"
    )


@query
def population(raw: core.RawTables) -> DataFrame:
    return scope.texts_to_label(core.scoped_permits(raw, staging.TEXT))


@query
def resolved_labels(raw: core.RawTables) -> DataFrame:
    return core.labelled_permits(raw).select(
        "permit_num", "source_status", "unit_form", "construction_type",
        categories.exterior_visibility("construction_type").alias("exterior_visibility"),
    )


@query
def structure_category(raw: core.RawTables) -> DataFrame:
    category = categories.structure_category("structure_type", "unit_form")
    return core.labelled_permits(raw).select(
        "permit_num", "source_status", "structure_type", category.alias("structure_category")
    )


@query
def needs_label(raw: core.RawTables) -> DataFrame:
    texts = scope.texts_to_label(core.scoped_permits(raw, staging.TEXT))
    return labels.needs_label(texts, raw.labels)


@query
def cache_upsert(raw: core.RawTables) -> DataFrame:
    """Missing labels filled by the rules, in place of a labeler."""
    texts = scope.texts_to_label(core.scoped_permits(raw, staging.TEXT))
    new = with_rule_labels(labels.needs_label(texts, raw.labels)).select(
        *labels.CACHE_KEY,
        F.col("rule_construction_type").alias("construction_type"),
        F.col("rule_unit_form").alias("unit_form"),
        F.lit("rules").alias("model"),
    )
    return labels.upsert(raw.labels, new.dropDuplicates(labels.CACHE_KEY))


@located_query
def label_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels after a run with the stub labeler, read from the store it wrote."""
    return label_store_after(spark, sf_dir, stub_labeler.label)[0].read()


@query
def label_pairs(raw: core.RawTables) -> DataFrame:
    return quality.label_pairs(core.labelled_permits(raw))


# Place


@query
def geocoded(raw: core.RawTables) -> DataFrame:
    scoped = core.scoped_permits(raw, staging.PLACE)
    placed = geocode.locate(scoped, raw.address_rows, raw.place_keys)
    return as_point(
        placed.select("permit_num", "source_status", "full_address", "ward", "geom", "geocode_method")
    )


@query
def geocode_method(raw: core.RawTables) -> DataFrame:
    scoped = core.scoped_permits(raw, staging.PLACE)
    placed = geocode.resolve(scoped, raw.address_rows, raw.place_keys)
    return placed.groupBy("geocode_method").agg(F.count(F.lit(1)).alias("permits"))


@query
def permit_roads(raw: core.RawTables) -> DataFrame:
    scoped = core.scoped_permits(raw, staging.PLACE)
    classed = geocode.with_road_class(scoped, staging.streets(raw.centreline), raw.place_and_road_keys)
    return classed.select("permit_num", "source_status", "road_class")


# Marts and map files


@query
def permits_core(raw: core.RawTables) -> DataFrame:
    return as_point(core.permits_core(raw))


@query
def multiplex(raw: core.RawTables) -> DataFrame:
    return as_point(core.multiplex(core.permits_core(raw)))


@query
def totals_by_status(raw: core.RawTables) -> DataFrame:
    return marts.totals_by_status(core.placed_multiplex(raw))


@query
def by_ward(raw: core.RawTables) -> DataFrame:
    return marts.by_ward(core.placed_multiplex(raw))


@query
def by_month(raw: core.RawTables) -> DataFrame:
    return marts.by_month(core.placed_multiplex(raw))


@query
def summary(raw: core.RawTables) -> DataFrame:
    return features.summary_line(marts.summary(core.placed_multiplex(raw), fixtures.LAST_UPDATED))


@located_query
def permit_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written and read again."""
    path = scratch_path(spark, "features")
    housing = core.multiplex(core.permits_core(fixtures.ViewTables(spark, sf_dir)))
    features.write_lines(features.permit_features(housing), path)
    return as_point(features.read_features(spark, path, features.PERMIT_PROPERTIES))


@located_query
def ward_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "features")
    wards = staging.current_wards(fixtures.ViewTables(spark, sf_dir).city_wards, fixtures.AS_OF)
    features.write_lines(features.ward_features(wards), path)
    return features.read_features(spark, path, features.WARD_PROPERTIES)


# Map view


@query
def facet_view(raw: core.RawTables) -> DataFrame:
    return facets.visible(mapped_multiplex(raw)).select(
        facets.feature_key().alias("feature_key"), "structure_category", "road_class", "exterior_visibility"
    )


@query
def narrow_facet_view(raw: core.RawTables) -> DataFrame:
    return facets.visible(mapped_multiplex(raw), SOME_FACETS).select(
        facets.feature_key().alias("feature_key"), "application_date"
    )


@query
def shown_layers(raw: core.RawTables) -> DataFrame:
    layers = stored(mapped_multiplex(raw), "layers")
    shown = facets.shown_layers(layers, facets.visible(layers))
    return as_point(shown.select("permit_num", "status", "net_units_created", "geom"))


@query
def stat_tiles(raw: core.RawTables) -> DataFrame:
    return map_view.stat_tiles(facets.visible(mapped_multiplex(raw)))


@query
def ward_totals(raw: core.RawTables) -> DataFrame:
    return shown_ward_totals(raw)


@query
def ward_bins(raw: core.RawTables) -> DataFrame:
    return map_view.ward_bins(shown_ward_totals(raw))


@query
def bin_legend(raw: core.RawTables) -> DataFrame:
    return map_view.bin_legend(shown_ward_totals(raw))


@query
def month_histogram(raw: core.RawTables) -> DataFrame:
    return map_view.month_histogram(facets.is_mapped(core.placed_multiplex(raw)))


@query
def bar_shares(raw: core.RawTables) -> DataFrame:
    return map_view.bar_shares(map_view.month_histogram(facets.is_mapped(core.placed_multiplex(raw))))


@query
def zoom_cells(raw: core.RawTables) -> DataFrame:
    return map_view.zoom_cells(facets.visible(mapped_multiplex(raw)), ZOOM)


@query
def cluster_bins(raw: core.RawTables) -> DataFrame:
    return map_view.cluster_bins(map_view.zoom_cells(facets.visible(mapped_multiplex(raw)), ZOOM))


@query
def facet_cube(raw: core.RawTables) -> DataFrame:
    return cube.facet_cube(mapped_multiplex(raw))


@query
def cube_tiles(raw: core.RawTables) -> DataFrame:
    return cube.stat_tiles(cube.chosen(cube.facet_cube(mapped_multiplex(raw))))


@query
def narrow_cube_tiles(raw: core.RawTables) -> DataFrame:
    return cube.stat_tiles(cube.chosen(cube.facet_cube(mapped_multiplex(raw)), SOME_FACETS))


@query
def cube_ward_totals(raw: core.RawTables) -> DataFrame:
    shown = cube.chosen(cube.facet_cube(mapped_multiplex(raw)))
    return cube.ward_totals(shown, staging.current_wards(raw.city_wards, fixtures.AS_OF))


@query
def cube_histogram(raw: core.RawTables) -> DataFrame:
    return cube.month_histogram(cube.facet_cube(mapped_multiplex(raw)))


@query
def facet_counts(raw: core.RawTables) -> DataFrame:
    return cube.facet_counts(cube.facet_cube(mapped_multiplex(raw)))


@query
def cell_pyramid(raw: core.RawTables) -> DataFrame:
    return cube.cell_pyramid(facets.visible(mapped_multiplex(raw)), COARSEST, FINEST)


@query
def pyramid_bins(raw: core.RawTables) -> DataFrame:
    return cube.pyramid_bins(cube.cell_pyramid(facets.visible(mapped_multiplex(raw)), COARSEST, FINEST))


# Quality


@query
def quality_report(raw: core.RawTables) -> DataFrame:
    staged = stored(staging.permits(raw.permits, staging.TEXT), "staged")
    labelled = stored(core.labelled(staged, raw.labels), "labelled")
    keys = labelled.select(*geocode.PERMIT_ID, "geo_id", *geocode.STREET_KEY)
    placed = geocode.resolve(keys, raw.address_rows, raw.place_keys)
    return quality.report(raw.permits, staged, raw.address_rows.numbered, placed, labelled)


# What a run leaves behind


def landed_sources(spark: SparkSession, sf_dir: str) -> str:
    """All five sources as landed pages, in folders of their names."""
    path = scratch_path(spark, "landing")
    permits = fixtures.view(spark, sf_dir, "fx_permits")
    number = F.substring("permit_num", 2, 20).cast("bigint")
    for source, status in (("cleared_permits", V.CLEARED), ("active_permits", V.ACTIVE)):
        fixtures.land_pages(permits.filter(F.col("source_status") == status), f"{path}/{source}", V.PERMIT_COLUMNS, number)
    for source in ("address_points", "city_wards", "centreline"):
        rows = fixtures.view(spark, sf_dir, f"fx_{source}")
        fixtures.land_pages(rows, f"{path}/{source}", V.SOURCES[source], F.monotonically_increasing_id())
    return path


def loaded(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse with the raw tables of one run, opened again after the run."""
    root = scratch_path(spark, "warehouse")
    run = Warehouse(spark, root).begin()
    daily.load_raw(spark, landed_sources(spark, sf_dir), run, fixtures.MIN_DATE)
    run.publish()
    return Warehouse(spark, root)


@located_query
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per raw table, as the commit of the run says."""
    return spark.createDataFrame(sorted(loaded(spark, sf_dir).rows().items()), "name string, rows bigint")


@located_query
def loaded_permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both raw permit tables read back by their names."""
    tables = loaded(spark, sf_dir)
    both = staging.both_sources(*[tables.read(f"raw_{source}") for source in daily.PERMIT_SOURCES])
    return both.toDF(*[c.lower() for c in both.columns])


@located_query
def loaded_streets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The street table staged from its raw table, stored, and read back."""
    tables = loaded(spark, sf_dir)
    run = tables.begin()
    run.save(staging.streets(tables.read("raw_centreline")), "stg_centreline")
    run.publish()
    return Warehouse(spark, tables.root).read("stg_centreline")


def label_store_after(spark: SparkSession, sf_dir: str, labeler: labels.Labeler | None) -> tuple[LabelStore, labels.LabelRun | None]:
    raw = fixtures.ViewTables(spark, sf_dir)
    store = LabelStore(spark, scratch_path(spark, "labels"))
    store.write(raw.labels)
    texts = scope.texts_to_label(core.scoped_permits(raw, staging.TEXT))
    return store, labels.refresh(texts, store, labeler, stub_labeler.MODEL, CALLS_PER_COMMIT)


@located_query
def label_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of a labelling run."""
    run = label_store_after(spark, sf_dir, stub_labeler.label)[1]
    counted = {name: getattr(run, name) for name in ("in_scope", "to_label", "labelled", "failed", "cached", "resumed")}
    return spark.createDataFrame(sorted(counted.items()), "counter string, n bigint")


@located_query
def without_labeler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels after a run without a labeler: those of before."""
    return label_store_after(spark, sf_dir, None)[0].read()


@located_query
def merged_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base after a run's delta was merged into it, with the place of each row in its files."""
    store = label_store_after(spark, sf_dir, stub_labeler.label)[0]
    store.compact(share=0.0)
    rows = spark.read.schema(V.CACHE_SCHEMA).parquet(f"{store.latest()}/base")
    place = F.row_number().over(Window.orderBy("_metadata.file_name", "_metadata.row_index"))
    return rows.select("permit_num", "description_hash", place.alias("place"))
