"""Small hand-written raw tables."""

from __future__ import annotations

from lotwise import schemas as V

PERMIT = {
    "PERMIT_NUM": "P1", "REVISION_NUM": "00", "STRUCTURE_TYPE": "2 Unit - Detached", "STREET_NUM": "1",
    "STREET_NAME": "King", "STREET_TYPE": "St", "STREET_DIRECTION": "W", "GEO_ID": "100",
    "APPLICATION_DATE": "2023-02-03", "STATUS": "Permit Issued", "DESCRIPTION": "basement suite",
    "PROPOSED_USE": "Two unit", "DWELLING_UNITS_CREATED": "1", "DWELLING_UNITS_LOST": "0", "source_status": "active",
}
ADDRESS = {
    "ADDRESS_POINT_ID": "100", "ADDRESS_NUMBER": "1", "LINEAR_NAME": "King", "LINEAR_NAME_TYPE": "St",
    "LINEAR_NAME_DIR": "W", "WARD_NAME": "Ward A", "ADDRESS_FULL": "1 King St W",
    "geometry": '{"type": "Point", "coordinates": [-79.4, 43.6]}',
}


def permits(spark, *changes):
    schema = V.text_schema([*V.PERMIT_COLUMNS, "source_status"])
    rows = [{**PERMIT, **change} for change in changes]
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def addresses(spark, *changes):
    schema = V.text_schema(V.ADDRESS_COLUMNS)
    rows = [{**ADDRESS, **change} for change in changes]
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)
