"""Facet filters of the map view."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lotwise import schemas as V
from lotwise.functions.months import month_at, year_month


@dataclass(frozen=True)
class Facets:
    """What is switched on. Interior-only work starts switched off.

    ``months`` are the first and last month shown, as yyyy-MM; None shows all.
    """

    active: bool = True
    cleared: bool = True
    road_classes: tuple[str, ...] = tuple(V.ROAD_CLASSES)
    structures: tuple[str, ...] = tuple(V.STRUCTURE_CATEGORIES)
    visibilities: tuple[str, ...] = tuple(v for v in V.VISIBILITIES if v != "interior_only")
    months: tuple[str, str] | None = None

    def with_slider(self, axis_start: str, low: int, high: int) -> Facets:
        """The same facets with slider positions, counted in months from the axis start."""
        months = (month_at(axis_start, min(low, high)), month_at(axis_start, max(low, high)))
        return Facets(
            self.active, self.cleared, self.road_classes, self.structures, self.visibilities, months
        )


def passes_layers(facets: Facets) -> Column:
    """Every facet but the dates. A status that is neither of the two is always shown."""
    hidden = [s for s, on in ((V.ACTIVE, facets.active), (V.CLEARED, facets.cleared)) if not on]
    shown = ~F.col("status").isin(hidden) if hidden else F.lit(True)
    return (
        F.coalesce(shown, F.lit(True))
        & F.col("road_class").isin(list(facets.road_classes))
        & F.col("structure_category").isin(list(facets.structures))
        & F.col("exterior_visibility").isin(list(facets.visibilities))
    )


def month_passes(month: Column, facets: Facets) -> Column:
    """Whether a month is shown; a missing one is not hidden."""
    if facets.months is None:
        return F.lit(True)
    return month.isNull() | month.between(*facets.months)


def passes_months(facets: Facets) -> Column:
    """A permit without an application date is not hidden."""
    return month_passes(year_month("application_date"), facets)


def visible(mapped: DataFrame, facets: Facets = Facets()) -> DataFrame:
    return mapped.filter(passes_layers(facets) & passes_months(facets))


def is_mapped(permits: DataFrame) -> DataFrame:
    return permits.filter(F.col("geom").isNotNull())


def feature_key() -> Column:
    """A permit number can occur as active and as cleared, so the status is part of the key."""
    return F.concat_ws("|", "permit_num", "status")


def shown_layers(layers: DataFrame, shown: DataFrame) -> DataFrame:
    """The map layers whose permit and status are among the visible ones."""
    return layers.join(shown.select("permit_num", "status"), ["permit_num", "status"], "left_semi")
