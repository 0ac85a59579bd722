from __future__ import annotations

import duckdb
import pytest

from lotwise.functions.rules import WORDING, says, with_rule_labels

SUITE, PLAIN = "basement_or_secondary_suite", "standard"
LABELLED = [
    (None, PLAIN, "unclear"),
    ("", PLAIN, "unclear"),
    ("Revision 01", PLAIN, "unclear"),
    ("demolish and construct a new house", PLAIN, "new_construction_teardown"),
    ("House burned down, build a three storey house", PLAIN, "new_construction_teardown"),
    ("burned down", PLAIN, "unclear"),
    ("burned down, convert remains", PLAIN, "conversion"),
    ("raze garage, convert house", PLAIN, "unclear"),
    ("Raze and rebuild triplex, interior alteration", PLAIN, "new_construction_teardown"),
    ("INTERIOR RENOVATION of garden suite", PLAIN, "alteration"),
    ("new GARDEN SUITE", PLAIN, "garden_suite"),
    ("covert existing house to duplex", PLAIN, "conversion"),
    ("legalizing the 2nd unit", SUITE, "conversion"),
    ("sever the lot and construct new", PLAIN, "severance"),
    ("several works", PLAIN, "unclear"),
    ("proposed two-storey duplex", PLAIN, "new_construction"),
    ("proposed ,two-storey duplex", PLAIN, "new_construction"),
    ("construct a 4-unit building", PLAIN, "new_construction"),
    ("construct\ta\t12 unit", PLAIN, "new_construction"),
    ("construct a\x0b12 unit", PLAIN, "unclear"),
    ("addition, basement", SUITE, "addition"),
    ("additional work", PLAIN, "unclear"),
    ("third storey", PLAIN, "addition"),
    ("enlarge the porch", PLAIN, "addition"),
    ("extended", PLAIN, "unclear"),
    ("baesment", SUITE, "alteration"),
    ("basements", PLAIN, "unclear"),
    ("secondary dwelling", SUITE, "alteration"),
    ("second house", PLAIN, "unclear"),
    ("x" * 20000 + " second suite", SUITE, "alteration"),
]
TRICKY = [
    "ébasement", "basementé", "bAſement", "ſever", "LEGALIſE", "addition_", "_addition", "re-extend", "extend-able",
    "construct 5 unit", "construct 5\nunit", "construct an5unit", "construct  an 5 - unit", "Kitchen conversion",
    "Konvert", "second\tsuite", "SECOND SUITE\n", "line\nbasement\nline", "2nd  unit", "severance.", "severed",
]


def test_labels(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(LABELLED)], "i int, description string")
    got = with_rule_labels(df).orderBy("i").collect()
    assert [(r.description, r.rule_unit_form, r.rule_construction_type) for r in got] == LABELLED
    assert got[0].asDict().keys() == {"i", "description", "rule_unit_form", "rule_construction_type"}


@pytest.mark.parametrize("group", WORDING)
def test_search_finds_what_another_engine_finds(spark, group):
    texts = TRICKY + [t for t, _, _ in LABELLED if t]
    df = spark.createDataFrame([(t,) for t in texts], "description string")
    ours = {r[0]: r[1] for r in df.select("description", says("description", group)).collect()}
    sql = f"SELECT regexp_matches(?, '{WORDING[group]}', 'i')"
    assert ours == {t: duckdb.execute(sql, [t]).fetchone()[0] for t in texts}
