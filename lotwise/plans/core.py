"""Permits with units: scope, labels, place and road class in one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from lotwise.functions import categories, clean
from lotwise.functions.rules import with_rule_labels
from lotwise.operators import geocode, labels, scope
from lotwise.plans import staging


@dataclass(eq=False)
class RawTables:
    """Raw frames; ``permits`` holds both sources and their ``source_status``.

    ``measured`` asks for the hot keys of the lookups to be measured first, which pays where
    lookups shuffle. It changes the balance of tasks and never the rows.
    """

    permits: DataFrame
    address_points: DataFrame
    centreline: DataFrame
    city_wards: DataFrame
    labels: DataFrame
    measured: bool = False

    def _in_scope_revisions(self) -> DataFrame:
        """All in-scope revisions: a superset of the rows to be joined that needs no shuffle."""
        return scope.in_scope(staging.permit_rows(self.permits, staging.PLACE))

    @cached_property
    def address_rows(self) -> geocode.AddressIndex:
        """Staged addresses, numbered and stored once for all look-ups of a query."""
        return geocode.AddressIndex(staging.addresses(self.address_points, with_given=True))

    @cached_property
    def place_keys(self) -> geocode.HotKeys:
        if not self.measured:
            return geocode.HotKeys()
        return geocode.measure_hot_keys(self._in_scope_revisions(), staging.addresses(self.address_points))

    @cached_property
    def place_and_road_keys(self) -> geocode.HotKeys:
        if not self.measured:
            return geocode.HotKeys()
        return geocode.measure_hot_keys(
            self._in_scope_revisions(), staging.addresses(self.address_points), staging.streets(self.centreline)
        )


def scoped_permits(raw: RawTables, columns: list[str]) -> DataFrame:
    """Latest revisions in scope with typed units. The filter must follow the choice of the
    revision: a permit whose last revision is out of scope does not count with an earlier one."""
    return scope.with_units(scope.in_scope(staging.permits(raw.permits, columns)))


def labelled_permits(raw: RawTables) -> DataFrame:
    return labelled(staging.permits(raw.permits, staging.TEXT), raw.labels)


def labelled(staged: DataFrame, cache: DataFrame) -> DataFrame:
    """Staged permits in scope with typed units and labels."""
    return labels.with_labels(with_rule_labels(scope.with_units(scope.in_scope(staged))), cache)


def permits_core(raw: RawTables) -> DataFrame:
    streets = staging.streets(raw.centreline)
    return permits_with_units(labelled_permits(raw), raw.address_rows, streets, raw.place_and_road_keys)


def permits_with_units(
    labelled: DataFrame, addresses: DataFrame | geocode.AddressIndex, streets: DataFrame, hot: geocode.HotKeys
) -> DataFrame:
    """Address texts and geometries come last, so that no other join carries them."""
    placed = geocode.locate(geocode.with_road_class(labelled, streets, hot), addresses, hot)
    return placed.select(
        "permit_num",
        F.col("source_status").alias("status"),
        "description",
        "construction_type",
        "unit_form",
        categories.exterior_visibility("construction_type").alias("exterior_visibility"),
        "structure_type",
        categories.structure_category("structure_type", "unit_form").alias("structure_category"),
        "proposed_use",
        "dwelling_units_created",
        "dwelling_units_lost",
        "net_units_created",
        *[clean.day(c).alias(c) for c in ("application_date", "issued_date", "completed_date")],
        "full_address",
        "ward",
        "geom",
        "road_class",
    )


def multiplex(core: DataFrame) -> DataFrame:
    """Permits with one to six net new units, with the exact count as a bucket label."""
    return scope.small_gain(core).withColumn("unit_bucket", categories.unit_bucket("net_units_created"))


def placed_multiplex(raw: RawTables) -> DataFrame:
    """The rows of ``multiplex`` with dates and place only, for marts that count by them.

    Labels and road class have unique keys and change no row, so their joins, the text
    rules and the description column are left out.
    """
    few = scope.small_gain(scoped_permits(raw, staging.PLACE))
    return geocode.locate(few, raw.address_rows, raw.place_keys).select(
        F.col("source_status").alias("status"),
        "permit_num",
        "net_units_created",
        *[clean.day(c).alias(c) for c in ("application_date", "issued_date", "completed_date")],
        "ward",
        "geom",
        "geocode_method",
    )
