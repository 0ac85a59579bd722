"""Which permits count: housing that adds dwelling units and was not given up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise import schemas as V
from lotwise.functions.clean import has_text, whole_number


def filed_since(df: DataFrame, first_date: str, column: str = "application_date") -> DataFrame:
    """ISO dates compare as text; a missing date is dropped."""
    return df.filter(F.col(column) >= F.lit(first_date))


def creates_units() -> Column:
    return whole_number("dwelling_units_created") > 0


def is_not_single_family() -> Column:
    structure = F.coalesce("structure_type", F.lit(""))
    use = F.lower(F.coalesce("proposed_use", F.lit("")))
    return ~structure.startswith("SFD") & ~use.contains("sfd") & ~use.contains("single")


def is_housing_structure() -> Column:
    return ~F.trim(F.coalesce("structure_type", F.lit(""))).isin(V.NON_HOUSING_STRUCTURES)


def is_alive() -> Column:
    """Cleared permits must have been closed; active ones must not have come to an end."""
    status = F.trim(F.coalesce("permit_status", F.lit("")))
    finished = (F.col("source_status") == V.CLEARED) & (status == V.CLOSED_STATUS)
    ongoing = (F.col("source_status") == V.ACTIVE) & ~status.isin(V.DEAD_STATUSES)
    return finished | ongoing


def in_scope(permits: DataFrame) -> DataFrame:
    """The scope filter on staged permits; the only definition, also for labelling."""
    return permits.filter(
        creates_units() & is_not_single_family() & is_housing_structure() & is_alive()
    )


def with_units(permits: DataFrame) -> DataFrame:
    """Typed unit counts and the net gain; an unreadable number of lost units is none."""
    return permits.withColumns(
        {
            "dwelling_units_created": whole_number("dwelling_units_created"),
            "dwelling_units_lost": whole_number("dwelling_units_lost"),
        }
    ).withColumn(
        "net_units_created",
        F.try_subtract("dwelling_units_created", F.coalesce("dwelling_units_lost", F.lit(0))),
    )


def small_gain(permits: DataFrame) -> DataFrame:
    return permits.filter(F.col("net_units_created").between(V.MIN_NET_UNITS, V.MAX_NET_UNITS))


def texts_to_label(scoped: DataFrame) -> DataFrame:
    """Distinct (permit, description) pairs in scope that have a description."""
    return scoped.filter(has_text("description")).select("permit_num", "description").distinct()
