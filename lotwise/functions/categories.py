"""Closed classifications of structures, scope of work, roads and unit counts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lotwise import schemas as V
from lotwise.functions.clean import col


def exterior_visibility(construction_type: Column | str) -> Column:
    """What could be seen from the street; labels outside the list are unclear."""
    names = F.create_map(*[F.lit(x) for pair in V.VISIBILITY_OF_CONSTRUCTION.items() for x in pair])
    return F.coalesce(F.try_element_at(names, col(construction_type)), F.lit(V.UNCLEAR))


def structure_category(structure_type: Column | str, unit_form: Column | str) -> Column:
    structure, form = col(structure_type), col(unit_form)
    two_units = structure.startswith("2 Unit") | structure.startswith("Duplex")
    three_units = structure.startswith("3+ Unit") | structure.startswith("Triplex")
    return (
        F.when(structure == V.LANEWAY_STRUCTURE, V.LANEWAY_CATEGORY)
        .when(two_units & (form == V.BASEMENT_SUITE), V.SUITE_CATEGORY)
        .when(two_units, V.DUPLEX_CATEGORY)
        .when(three_units, V.TRIPLEX_CATEGORY)
        .when(structure.isin(V.APARTMENT_STRUCTURES), V.APARTMENT_CATEGORY)
        .when(structure == V.ROOMING_STRUCTURE, V.ROOMING_CATEGORY)
        .when(structure.isin(V.MIXED_STRUCTURES), V.MIXED_CATEGORY)
        .otherwise(V.OTHER_CATEGORY)
    )


def road_class(feature: Column | str) -> Column:
    return (
        F.when(col(feature).isin(V.MAJOR_ROADS), "major")
        .when(col(feature).isin(V.MINOR_ROADS), "minor")
        .otherwise("unknown")
    )


def unit_bucket(net_units: Column | str) -> Column:
    top = V.MAX_NET_UNITS
    return F.when(col(net_units) >= top, f"{top}+").otherwise(col(net_units).cast("string"))
