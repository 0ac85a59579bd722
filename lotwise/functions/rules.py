"""What a permit's free text says was built, by word rules.

Patterns are searched anywhere in the whole text, ignoring case. They are stated in plain
regular-expression syntax; ``searchable`` adapts the three things Java reads differently:
case folding beyond ASCII, word boundaries next to accented letters, and vertical tab.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions.clean import col
from lotwise.schemas import BASEMENT_SUITE, STANDARD, UNCLEAR

# Wording by group.
WORDING = {
    "basement": r"\bbasement\b|\bbaesment\b",
    "second_unit": r"second(ary)? (suite|unit|dwelling)|2nd (suite|unit|dwelling)",
    "demolition": r"demolish|raze|remove existing|removal of the existing",
    "fire_loss": r"burned down",
    "building": (
        r"construct a new|construct new|new construction|proposed ,?two-storey duplex"
        r"|build a (four|three|two)|houseplex|multiplex|fourplex|quadplex|triplex|duplex"
        r"|laneway suite|construct\s+(a\s+|an\s+)?\d+[\s-]?unit"
    ),
    "interior": r"interior (alteration|renovation)",
    "garden": r"garden suite|laneway suite",
    "conversion": r"convert|conversion|covert existing|change of use|legaliz",
    "severance": r"\bsever(ance|ed)?\b",
    "addition": (
        r"\baddition\b|\bextend\b|\benlarge\b|second storey addition|third storey"
        r"|rear addition|side addition"
    ),
}

ASCII_WORD_EDGE = r"(?:(?<!\w)(?=\w)|(?<=\w)(?!\w))"
ASCII_SPACE = r"[\t\n\f\r ]"


def searchable(pattern: str) -> str:
    return "(?iu)" + pattern.replace(r"\b", ASCII_WORD_EDGE).replace(r"\s", ASCII_SPACE)


def says(text: Column | str, group: str) -> Column:
    """Whether the text has the group's wording; a missing text says nothing."""
    return F.coalesce(col(text).rlike(searchable(WORDING[group])), F.lit(False))


def with_rule_labels(df: DataFrame, text: str = "description") -> DataFrame:
    """Add ``rule_unit_form`` and ``rule_construction_type``.

    Each group is searched once per row into one struct; the two labels only read it.
    """
    found = F.struct(*[says(text, group).alias(group) for group in WORDING])
    df = df.withColumn("_says", found)
    s = {group: F.col(f"_says.{group}") for group in WORDING}
    suite = s["basement"] | s["second_unit"]
    torn_down = s["demolition"] | s["fire_loss"]
    # First match wins: more specific wording comes before wording it may contain.
    ladder = [
        (torn_down & s["building"], "new_construction_teardown"),
        (s["interior"], "alteration"),
        (s["garden"], "garden_suite"),
        (s["conversion"] & ~s["demolition"], "conversion"),
        (s["severance"], "severance"),
        (s["building"], "new_construction"),
        (s["addition"], "addition"),
        (suite, "alteration"),
    ]
    construction = F.coalesce(*[F.when(test, F.lit(label)) for test, label in ladder], F.lit(UNCLEAR))
    return df.withColumns(
        {
            "rule_unit_form": F.when(suite, BASEMENT_SUITE).otherwise(STANDARD),
            "rule_construction_type": construction,
        }
    ).drop("_says")
