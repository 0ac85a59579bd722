"""The daily run: land, label, model, export. Every model is stored once and read from there.

What a run stores comes into force together at its end, the tables first and then the map files:
until then, and if it dies, readers see all that the run before has left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lotwise import schemas as V
from lotwise.functions.rules import with_rule_labels
from lotwise.operators import facets, geocode, labels, scope
from lotwise.operators.labels import Labeler, LabelRun
from lotwise.plans import core, cube, marts, quality, staging
from lotwise.session import prepare
from lotwise.sources import features, landed
from lotwise.sources.label_store import LabelStore
from lotwise.sources.tables import Run, Warehouse

PERMIT_SOURCES = ["cleared_permits", "active_permits"]


@dataclass(frozen=True)
class Folders:
    """Where the landed pages are (one folder per source), and where results go."""

    landing: str
    warehouse: str
    label_store: str
    export: str


def load_raw(
    spark: SparkSession, landing: str, run: Run,
    first_date: str = V.MIN_APPLICATION_DATE, multi_line: bool = False,
) -> dict[str, int]:
    """Replace every raw table by the landed pages of its source; rows by source."""
    for source, columns in V.SOURCES.items():
        pages = landed.read_pages(spark, f"{landing}/{source}", columns, multi_line)
        if source in PERMIT_SOURCES:
            pages = scope.filed_since(pages, first_date, "APPLICATION_DATE")
        run.save(pages, f"raw_{source}")
    return {source: run.table(f"raw_{source}").rows for source in V.SOURCES}


def build_staging(run: Run, as_of: str) -> None:
    """Staging tables; permits of both sources in one table, a folder per source."""
    both = staging.both_sources(*[run.read(f"raw_{source}") for source in PERMIT_SOURCES])
    run.save(staging.permits(both), "stg_permits", partition_by=("source_status",))
    run.save(staging.addresses(run.read("raw_address_points")), "stg_address_points")
    run.save(staging.streets(run.read("raw_centreline")), "stg_centreline")
    run.save(staging.current_wards(run.read("raw_city_wards"), as_of), "stg_city_wards")


def build_marts(run: Run, cache: DataFrame) -> None:
    scoped = scope.with_units(scope.in_scope(run.read("stg_permits")))
    scoped = run.save(labels.with_labels(with_rule_labels(scoped), cache), "scoped_permits")
    addresses = run.read("stg_address_points")
    streets = run.read("stg_centreline")
    hot = geocode.measure_hot_keys(scoped, addresses, streets)
    permits = run.save(core.permits_with_units(scoped, addresses, streets, hot), "permits_with_units")
    housing = run.save(core.multiplex(permits), "multiplex_permits")
    run.save(marts.by_ward(housing), "multiplex_by_ward")
    run.save(marts.by_month(housing), "multiplex_by_month")
    run.save(cube.facet_cube(facets.is_mapped(housing)), "facet_cube")
    run.save(cube.cell_pyramid(facets.visible(facets.is_mapped(housing))), "cell_pyramid")


def build_quality(run: Run) -> DataFrame:
    """The quality report over what this run stored."""
    scoped = run.read("scoped_permits")
    rows = geocode.AddressIndex(staging.addresses(run.read("raw_address_points"), with_given=True))
    keys = scoped.select(*geocode.PERMIT_ID, "geo_id", *geocode.STREET_KEY)
    hot = geocode.measure_hot_keys(scoped, rows.numbered)
    report = quality.report(
        staging.both_sources(*[run.read(f"raw_{source}") for source in PERMIT_SOURCES]),
        run.read("stg_permits"), rows.numbered, geocode.resolve(keys, rows, hot), scoped,
    )
    return run.save(report, "quality_report")


def export(run: Run, maps: Run, run_stamp: str) -> None:
    """Map files, one JSON document per line."""
    housing = run.read("multiplex_permits")
    maps.save_lines(features.permit_features(housing), "permits.geojsonl")
    maps.save_lines(features.ward_features(run.read("stg_city_wards")), "wards.geojsonl")
    maps.save_lines(features.summary_line(marts.summary(housing, run_stamp)), "summary.json")


def run(
    spark: SparkSession, folders: Folders, as_of: str, run_stamp: str,
    first_date: str = V.MIN_APPLICATION_DATE, labeler: Labeler | None = None, model: str = "",
    multi_line: bool = False, label_seed: str | None = None,
) -> tuple[dict[str, int], LabelRun | None]:
    """The whole run; rows by source and the labelling counters.

    ``label_seed`` is a CSV file of earlier labels, taken over while the label store is empty.
    """
    warehouse, exports = Warehouse(prepare(spark), folders.warehouse), Warehouse(spark, folders.export)
    this, maps = warehouse.begin(), exports.begin()
    store = LabelStore(spark, folders.label_store)
    if label_seed and store.latest() is None:
        store.import_csv(label_seed)
    rows = load_raw(spark, folders.landing, this, first_date, multi_line)
    build_staging(this, as_of)
    population = scope.texts_to_label(scope.in_scope(this.read("stg_permits")))
    labelling = labels.refresh(population, store, labeler, model)
    build_marts(this, store.read())
    build_quality(this)
    export(this, maps, run_stamp)
    this.publish()
    maps.publish()
    warehouse.remove_old()
    exports.remove_old()
    return rows, labelling
