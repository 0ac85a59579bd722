"""Permit-shaped views over the given tables, in SQL that both engines read alike.

``@name`` stands for a given table or another view. Every view grows with its table. Ward
names follow the customer key, 15 customers to a ward, as there are 15 customers per
supplier and the wards themselves are made from suppliers.
"""

from __future__ import annotations

import re
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lotwise.plans.core import RawTables

MIN_DATE = "1995-01-01"
AS_OF = "2024-01-01"
LAST_UPDATED = "2024-01-01T06:00:00+00:00"
TABLES = ["orders", "customer", "part", "supplier"]

VIEWS = {
    # One row per order, about three revisions per permit number, some of them with one number.
    "fx_permits": """
SELECT
  'P' || cast(o_orderkey - o_orderkey % 3 AS string) AS permit_num,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN '01'
    ELSE '0' || cast(o_orderkey % 3 AS string) END AS revision_num,
  CASE o_orderkey % 4 WHEN 0 THEN 'New Houses' WHEN 1 THEN 'New Building' ELSE 'Small Residential Projects' END AS permit_type,
  CASE o_custkey % 16
    WHEN 0 THEN 'SFD - Detached' WHEN 1 THEN '2 Unit - Detached' WHEN 2 THEN '2 Unit - Semi-detached'
    WHEN 3 THEN 'Duplex' WHEN 4 THEN '3+ Unit - Detached' WHEN 5 THEN 'Triplex'
    WHEN 6 THEN 'Laneway / Rear Yard Suite' WHEN 7 THEN 'Apartment Building'
    WHEN 8 THEN 'Boarding/Lodging House' WHEN 9 THEN 'Mixed Use/Res w Non Res'
    WHEN 10 THEN ' Office ' WHEN 11 THEN 'Motel/Hotel' WHEN 12 THEN NULL
    WHEN 13 THEN 'Stacked Townhouses' WHEN 14 THEN 'Multiple Use/Non Residential' ELSE 'Other Thing' END AS structure_type,
  CASE o_orderkey % 5 WHEN 0 THEN 'New Building' WHEN 1 THEN 'Interior Alterations' ELSE 'Addition(s)' END AS work,
  ' ' || cast(o_custkey % 40 AS string) || CASE WHEN o_custkey % 40 = 7 THEN ' A' ELSE '' END AS street_num,
  CASE o_custkey % 5 WHEN 0 THEN ' king' WHEN 1 THEN 'QUEEN ' WHEN 2 THEN 'Dufferin' WHEN 3 THEN 'Shaw' ELSE 'Nowhere' END AS street_name,
  CASE WHEN o_custkey % 19 = 0 THEN NULL WHEN o_custkey % 2 = 0 THEN 'st' ELSE 'Ave ' END AS street_type,
  CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'None' WHEN 2 THEN ' w' ELSE '' END AS street_direction,
  CASE WHEN o_orderkey % 10 < 3 THEN NULL WHEN o_orderkey % 10 = 3 THEN '999999999'
       WHEN o_orderkey % 10 = 4 THEN 'n/a' ELSE cast(o_custkey AS string) END AS geo_id,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN '1' || substr(cast(o_orderdate AS string), 1, 10)
    ELSE substr(cast(o_orderdate AS string), 1, 10) END AS application_date,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE substr(cast(o_orderdate AS string), 1, 10) END AS issued_date,
  CASE WHEN o_orderstatus = 'F' THEN substr(cast(o_orderdate AS string), 1, 10) WHEN o_orderkey % 7 = 0 THEN 'pending' END AS completed_date,
  CASE WHEN o_orderstatus = 'F' THEN (CASE o_orderkey % 5 WHEN 0 THEN 'Cancelled' WHEN 1 THEN NULL ELSE 'Closed ' END)
       ELSE (CASE o_orderkey % 12 WHEN 0 THEN 'Refused' WHEN 1 THEN 'Superseded' WHEN 2 THEN 'Abandoned' WHEN 3 THEN NULL
             WHEN 4 THEN 'Pending Cancellation' ELSE 'Permit Issued' END) END AS status,
  CASE o_orderkey % 23
    WHEN 0 THEN NULL WHEN 1 THEN ''
    WHEN 2 THEN 'Demolish existing dwelling and construct a new triplex'
    WHEN 3 THEN 'INTERIOR ALTERATIONS TO CREATE A BASEMENT UNIT'
    WHEN 4 THEN 'Construct laneway suite in rear yard'
    WHEN 5 THEN 'Convert single family dwelling to duplex'
    WHEN 6 THEN 'Lot severed, see file'
    WHEN 7 THEN 'Construct a new 2 storey detached dwelling with basement apartment'
    WHEN 8 THEN 'Rear addition with third storey'
    WHEN 9 THEN 'Proposed second suite in baesment'
    WHEN 10 THEN 'Raze garage only' WHEN 11 THEN 'Proposed 2nd unit'
    WHEN 12 THEN 'Build a four unit houseplex' WHEN 13 THEN 'construct  an 5-unit building'
    WHEN 14 THEN 'Change of use and removal of the existing porch' WHEN 15 THEN 'Legalize secondary dwelling'
    WHEN 16 THEN 'Interior renovation, demolish wall, new construction' WHEN 17 THEN 'basements everywhere'
    WHEN 18 THEN 'Extended hours permit' WHEN 19 THEN 'To extend the house'
    WHEN 20 THEN ' Garden suite, two storeys ' WHEN 21 THEN 'Convert duplex and remove existing stair'
    ELSE 'Construct new house where the old one burned down' END AS description,
  CASE o_orderkey % 6 WHEN 0 THEN NULL ELSE 'Residential' END AS current_use,
  CASE o_orderkey % 11 WHEN 0 THEN 'Sfd' WHEN 1 THEN 'SINGLE family' WHEN 2 THEN NULL WHEN 3 THEN 'Triplex' ELSE 'Two unit dwelling' END AS proposed_use,
  CASE o_custkey % 13 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '0' WHEN 3 THEN 'x' WHEN 4 THEN ' 2 '
    WHEN 5 THEN '6' WHEN 6 THEN '7' WHEN 7 THEN '12' WHEN 8 THEN '3' WHEN 9 THEN '1' ELSE '4' END AS dwelling_units_created,
  CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '1' WHEN 3 THEN '9' ELSE '0' END AS dwelling_units_lost,
  cast(o_custkey % 200 AS string) AS residential,
  CASE WHEN o_orderstatus = 'F' THEN 'cleared' ELSE 'active' END AS source_status
FROM @orders
""",
    # One row per customer; some share the id of the customer before.
    "fx_address_points": """
SELECT
  CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 101 = 0 THEN cast(c_custkey - 1 AS string)
    ELSE cast(c_custkey AS string) END AS address_point_id,
  cast(c_custkey % 40 AS string) || CASE WHEN c_custkey % 40 = 7 THEN 'A' ELSE '' END AS address_number,
  CASE c_custkey % 5 WHEN 0 THEN 'King' WHEN 1 THEN 'Queen' WHEN 2 THEN 'DUFFERIN' WHEN 3 THEN 'Shaw ' ELSE 'Elsewhere' END AS linear_name,
  CASE WHEN c_custkey % 2 = 0 THEN 'St' ELSE 'Ave' END AS linear_name_type,
  CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'none' WHEN 2 THEN 'W' ELSE ' ' END AS linear_name_dir,
  CASE c_custkey % 53 WHEN 0 THEN NULL WHEN 1 THEN ''
    ELSE 'Ward ' || cast(cast((c_custkey - c_custkey % 15) / 15 AS bigint) AS string) END AS ward_name,
  c_name || ' St' AS address_full,
  CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE '{"type": "Point", "coordinates": [-79.' || cast(100 + c_custkey % 500 AS string)
    || ', 43.' || cast(600 + c_custkey % 250 AS string) || ']}' END AS geometry
FROM @customer
""",
    # One row per part.
    "fx_centreline": """
SELECT
  CASE p_partkey % 4 WHEN 0 THEN 'King' WHEN 1 THEN 'Queen' WHEN 2 THEN 'Dufferin' ELSE 'Shaw' END AS linear_name,
  CASE WHEN p_size % 2 = 0 THEN 'St' ELSE 'Ave' END AS linear_name_type,
  CASE WHEN p_size % 3 = 0 THEN 'W' WHEN p_size % 3 = 1 THEN 'None' ELSE NULL END AS linear_name_dir,
  CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_size % 5 < 2 THEN 'Local' WHEN p_size % 5 = 2 THEN 'Major Arterial'
       WHEN p_size % 5 = 3 THEN 'Collector' ELSE 'River' END AS feature_code_desc
FROM @part
""",
    # One row per supplier.
    "fx_city_wards": """
SELECT
  cast(s_suppkey AS string) AS area_short_code,
  'Ward ' || cast(s_suppkey AS string) AS area_name,
  CASE WHEN s_suppkey % 6 = 0 THEN '2018-11-30T00:00:00' WHEN s_suppkey % 7 = 0 THEN NULL
    WHEN s_suppkey % 13 = 0 THEN 'open' ELSE '3000-01-01T00:00:00' END AS date_expiry,
  CASE WHEN s_suppkey % 11 = 0 THEN 'lost' ELSE '{"type": "Polygon", "coordinates": [[[-79.5, 43.6], [-79.4, 43.6], [-79.4, 43.'
    || cast(100 + s_suppkey % 900 AS string) || '1], [-79.5, 43.6]]]}' END AS geometry
FROM @supplier
""",
    # Earlier labels: permits filed before 1999, a part of them for an older text, some keys twice.
    "fx_scope_cache": """
SELECT permit_num, description_hash, construction_type, unit_form, model FROM (
  SELECT permit_num,
    CASE WHEN o % 2 = 0 THEN md5(trim(description)) ELSE md5('stale') END AS description_hash,
    CASE (o + copy) % 3 WHEN 0 THEN 'new_construction' WHEN 1 THEN 'addition' ELSE 'unclear' END AS construction_type,
    CASE WHEN o % 5 = copy THEN 'basement_or_secondary_suite' ELSE 'standard' END AS unit_form,
    'm1' AS model, copy, o,
    row_number() OVER (PARTITION BY permit_num, copy ORDER BY revision_num DESC NULLS LAST, description) AS rn
  FROM (SELECT p.*, cast(substr(permit_num, 2) AS bigint) AS o, 0 AS copy FROM @fx_permits p
    UNION ALL SELECT p.*, cast(substr(permit_num, 2) AS bigint) AS o, 1 AS copy FROM @fx_permits p) q
  WHERE description IS NOT NULL AND application_date < '1999-01-01' AND (copy = 0 OR o % 7 = 0)) z
WHERE rn = 1
""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the files of the given tables."""
    text = VIEWS[name]
    for other in VIEWS:
        text = text.replace(f"@{other} ", f"({VIEWS[other]}) ")
    for table in TABLES:
        text = re.sub(rf"@{table}\b", f"parquet.`{sf_dir}/{table}.parquet`", text)
    return spark.sql(text)


def view_ctes() -> list[str]:
    """The same views as the first common table expressions of a statement."""
    return [f"{name} AS ({re.sub(r'@(\w+)', r'\1', text)})" for name, text in VIEWS.items()]


class ViewTables(RawTables):
    """The views as raw tables, each made when a query first asks for it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._make = partial(view, spark, sf_dir)

    @cached_property
    def permits(self) -> DataFrame:
        return self._make("fx_permits")

    @cached_property
    def address_points(self) -> DataFrame:
        return self._make("fx_address_points")

    @cached_property
    def centreline(self) -> DataFrame:
        return self._make("fx_centreline")

    @cached_property
    def city_wards(self) -> DataFrame:
        return self._make("fx_city_wards")

    @cached_property
    def labels(self) -> DataFrame:
        return self._make("fx_scope_cache")


def land_pages(df: DataFrame, path: str, columns: list[str], number: Column, page_rows: int = 1000) -> None:
    """Write rows as API pages, one JSON document of about ``page_rows`` records per line.

    ``number`` counts the rows without large gaps or repeats, so a page, being a range of
    it, is bounded by its length. Fields get the names the API uses.
    """
    record = F.struct(*[F.col(c).alias(c) for c in columns])
    page = F.floor(number / page_rows)
    pages = df.groupBy(page.alias("page")).agg(F.collect_list(record).alias("records"))
    payload = F.struct(F.lit(True).alias("success"), F.struct("records").alias("result"))
    pages.select(F.to_json(payload).alias("value")).write.text(path)
