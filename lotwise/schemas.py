"""Raw table columns and the fixed vocabularies the rules and filters compare with."""

from __future__ import annotations

from pyspark.sql import types as T


def text_schema(columns: list[str]) -> T.StructType:
    """Every raw column is nullable text; typing happens in staging."""
    return T.StructType([T.StructField(name, T.StringType(), True) for name in columns])


# Column names of the published source tables.
PERMIT_COLUMNS = [
    "PERMIT_NUM", "REVISION_NUM", "PERMIT_TYPE", "STRUCTURE_TYPE", "WORK",
    "STREET_NUM", "STREET_NAME", "STREET_TYPE", "STREET_DIRECTION", "GEO_ID",
    "APPLICATION_DATE", "ISSUED_DATE", "COMPLETED_DATE", "STATUS", "DESCRIPTION",
    "CURRENT_USE", "PROPOSED_USE", "DWELLING_UNITS_CREATED", "DWELLING_UNITS_LOST",
    "RESIDENTIAL",
]
ADDRESS_COLUMNS = [
    "ADDRESS_POINT_ID", "ADDRESS_NUMBER", "LINEAR_NAME", "LINEAR_NAME_TYPE",
    "LINEAR_NAME_DIR", "WARD_NAME", "ADDRESS_FULL", "geometry",
]
WARD_COLUMNS = ["AREA_SHORT_CODE", "AREA_NAME", "DATE_EXPIRY", "geometry"]
CENTRELINE_COLUMNS = [
    "LINEAR_NAME", "LINEAR_NAME_TYPE", "LINEAR_NAME_DIR", "FEATURE_CODE_DESC",
]

# Logical source name -> columns. The physical path is the caller's choice.
SOURCES = {
    "cleared_permits": PERMIT_COLUMNS,
    "active_permits": PERMIT_COLUMNS,
    "address_points": ADDRESS_COLUMNS,
    "city_wards": WARD_COLUMNS,
    "centreline": CENTRELINE_COLUMNS,
}

MIN_APPLICATION_DATE = "2022-01-01"

CLEARED = "cleared"
ACTIVE = "active"

# Structure names that are not private housing.
NON_HOUSING_STRUCTURES = [
    "Office", "Hospital", "Restaurant 30 Seats or Less", "Home for the Aged",
    "Motel/Hotel", "Place of Worship", "Apartment Hotel",
]
# The one finished status, and the statuses of permits that came to nothing.
CLOSED_STATUS = "Closed"
DEAD_STATUSES = [
    "Cancelled", "Refused", "Refusal Notice", "Abandoned", "Revocation Pending",
    "Revocation Notice Sent", "Pending Cancellation", "Superseded",
]
# Net new dwelling units of the housing this engine follows.
MIN_NET_UNITS = 1
MAX_NET_UNITS = 6

# Labels.
BASEMENT_SUITE = "basement_or_secondary_suite"
STANDARD = "standard"
UNIT_FORMS = [BASEMENT_SUITE, STANDARD]
CONSTRUCTION_TYPES = [
    "new_construction_teardown", "new_construction", "garden_suite", "conversion",
    "addition", "alteration", "severance", "unclear",
]
VISIBILITY_OF_CONSTRUCTION = {
    "new_construction_teardown": "new_construction",
    "new_construction": "new_construction",
    "garden_suite": "new_construction",
    "conversion": "conversion",
    "addition": "conversion",
    "severance": "conversion",
    "alteration": "interior_only",
}
VISIBILITIES = ["new_construction", "conversion", "interior_only", "unclear"]
UNCLEAR = "unclear"

# Structure categories and the structure names behind them.
LANEWAY_STRUCTURE = "Laneway / Rear Yard Suite"
APARTMENT_STRUCTURES = ["Apartment Building", "Multiple Unit Building", "Stacked Townhouses"]
ROOMING_STRUCTURE = "Boarding/Lodging House"
MIXED_STRUCTURES = ["Multiple Use/Non Residential", "Mixed Use/Res w Non Res"]
LANEWAY_CATEGORY = "Laneway / garden suite"
SUITE_CATEGORY = "House + secondary suite"
DUPLEX_CATEGORY = "Duplex (2 units)"
TRIPLEX_CATEGORY = "Triplex+ (3-6 units)"
APARTMENT_CATEGORY = "Multi-unit building"
ROOMING_CATEGORY = "Multi-tenant / rooming house"
MIXED_CATEGORY = "Mixed use"
OTHER_CATEGORY = "Other"
STRUCTURE_CATEGORIES = [
    LANEWAY_CATEGORY, DUPLEX_CATEGORY, SUITE_CATEGORY, TRIPLEX_CATEGORY,
    APARTMENT_CATEGORY, ROOMING_CATEGORY, MIXED_CATEGORY, OTHER_CATEGORY,
]

# Street feature names by road class.
MAJOR_ROADS = [
    "Expressway", "Expressway Ramp", "Major Arterial", "Major Arterial Ramp", "Minor Arterial",
]
MINOR_ROADS = ["Local", "Collector", "Laneway"]
ROAD_CLASSES = ["major", "minor", "unknown"]

# The columns of the label cache and the size of one labelling call.
CACHE_COLUMNS = ["permit_num", "description_hash", "construction_type", "unit_form", "model"]
CACHE_SCHEMA = text_schema(CACHE_COLUMNS)
LABEL_BATCH = 20
