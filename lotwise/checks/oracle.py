"""SQL that computes what each registered query must give, straight from the given tables.

Written against the meaning of each model, not derived from the DataFrame code; only fixed
values (word lists, patterns, names) are shared.
"""

from __future__ import annotations

from lotwise import schemas as V
from lotwise.checks.fixtures import AS_OF, LAST_UPDATED, MIN_DATE, view_ctes
from lotwise.functions.rules import WORDING


def names(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def found(group: str) -> str:
    return f"coalesce(regexp_matches(description, '{WORDING[group]}', 'i'), false) AS {group}_said"


def street(text: str) -> str:
    return f"upper(trim({text}))"


def direction(text: str) -> str:
    return f"CASE WHEN {street(text)} = 'NONE' OR {text} IS NULL THEN '' ELSE {street(text)} END"


def geometry(kind: str) -> str:
    return f"CASE WHEN json_valid(geometry) AND geometry LIKE '%\"{kind}\"%' THEN geometry END"


def coordinate(geom: str, i: int) -> str:
    return f"cast(json_extract_string({geom}, '$.coordinates[{i}]') AS double)"


# What decides between rows of one revision, in this order.
TIES = [
    "dwelling_units_created", "dwelling_units_lost", "structure_type", "proposed_use", "status", "application_date",
    "issued_date", "completed_date", "try_cast(geo_id AS bigint)", "trim(street_num)", street("street_name"),
    street("street_type"), direction("street_direction"), "description", "permit_type", "work", "current_use", "residential",
]


def day(text: str) -> str:
    """A date of four-digit year; others are typing errors."""
    return f"CASE WHEN regexp_matches({text}, '^[0-9]{{4}}-') THEN try_cast({text} AS date) END"


POINT = f"{coordinate('geom', 0)} AS lon, {coordinate('geom', 1)} AS lat"

MODELS = [
    "raw_permits AS (SELECT * FROM fx_permits)",
    f"""staged AS (
  SELECT permit_num, source_status, revision_num, dwelling_units_created, dwelling_units_lost,
    structure_type, proposed_use, status AS permit_status, application_date, issued_date, completed_date,
    try_cast(geo_id AS bigint) AS geo_id, trim(street_num) AS street_num,
    {street('street_name')} AS street_name, {street('street_type')} AS street_type,
    {direction('street_direction')} AS street_direction,
    description, permit_type, work, current_use, residential AS residential_area
  FROM (
    SELECT r.*, row_number() OVER (
      PARTITION BY permit_num, source_status ORDER BY try_cast(revision_num AS integer) DESC NULLS LAST,
        {', '.join(f'{c} NULLS LAST' for c in TIES)}) AS age
    FROM raw_permits r) aged
  WHERE age = 1)""",
    f"""address_rows AS (
  SELECT try_cast(address_point_id AS bigint) AS address_point_id, trim(address_number) AS street_num,
    {street('linear_name')} AS street_name, {street('linear_name_type')} AS street_type,
    {direction('linear_name_dir')} AS street_direction,
    address_full AS full_address, ward_name AS ward, {geometry('Point')} AS geom
  FROM fx_address_points)""",
    """street_addresses AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT a.*, row_number() OVER (
      PARTITION BY street_num, street_name, street_type, street_direction
      ORDER BY address_point_id ASC NULLS LAST, full_address) AS place
    FROM address_rows a
    WHERE street_num IS NOT NULL AND street_name IS NOT NULL AND street_type IS NOT NULL) s
  WHERE place = 1)""",
    f"""street_counts AS (
  SELECT {street('linear_name')} AS street_name, {street('linear_name_type')} AS street_type,
    {direction('linear_name_dir')} AS street_direction, feature_code_desc AS road_feature, count(*) AS n
  FROM fx_centreline WHERE feature_code_desc IS NOT NULL GROUP BY ALL)""",
    f"""street_rows AS (
  SELECT street_name, street_type, street_direction, road_feature,
    CASE WHEN road_feature IN ({names(V.MAJOR_ROADS)}) THEN 'major'
      WHEN road_feature IN ({names(V.MINOR_ROADS)}) THEN 'minor' ELSE 'unknown' END AS road_class
  FROM (SELECT c.*, row_number() OVER (
      PARTITION BY street_name, street_type, street_direction ORDER BY n DESC, road_feature) AS place
    FROM street_counts c) p
  WHERE place = 1)""",
    f"""ward_rows AS (
  SELECT area_short_code AS ward_code, area_name AS ward_name, {geometry('Polygon')} AS geom
  FROM fx_city_wards WHERE try_cast(date_expiry AS timestamp) > timestamp '{AS_OF} 00:00:00')""",
    f"""scoped AS (
  SELECT s.* EXCLUDE (dwelling_units_created, dwelling_units_lost), u.*,
    u.dwelling_units_created - coalesce(u.dwelling_units_lost, 0) AS net_units_created
  FROM staged s, LATERAL (SELECT try_cast(s.dwelling_units_created AS integer) AS dwelling_units_created,
    try_cast(s.dwelling_units_lost AS integer) AS dwelling_units_lost) u
  WHERE u.dwelling_units_created > 0
    AND substr(coalesce(structure_type, ''), 1, 3) <> 'SFD'
    AND NOT regexp_matches(lower(coalesce(proposed_use, '')), 'sfd|single')
    AND coalesce(trim(structure_type), '') NOT IN ({names(V.NON_HOUSING_STRUCTURES)})
    AND CASE source_status WHEN 'cleared' THEN trim(coalesce(permit_status, '')) = '{V.CLOSED_STATUS}'
      WHEN 'active' THEN trim(coalesce(permit_status, '')) NOT IN ({names(V.DEAD_STATUSES)}) ELSE false END)""",
    f"said AS (SELECT scoped.*, {', '.join(found(g) for g in WORDING)} FROM scoped)",
    f"""ruled AS (
  SELECT said.*,
    CASE WHEN basement_said OR second_unit_said THEN '{V.BASEMENT_SUITE}' ELSE '{V.STANDARD}' END AS rule_unit_form,
    CASE WHEN building_said AND (demolition_said OR fire_loss_said) THEN 'new_construction_teardown'
      WHEN interior_said THEN 'alteration' WHEN garden_said THEN 'garden_suite'
      WHEN conversion_said AND NOT demolition_said THEN 'conversion'
      WHEN severance_said THEN 'severance' WHEN building_said THEN 'new_construction'
      WHEN addition_said THEN 'addition' WHEN basement_said OR second_unit_said THEN 'alteration'
      ELSE 'unclear' END AS rule_construction_type
  FROM said)""",
    """one_label AS (
  SELECT permit_num, description_hash, construction_type, unit_form FROM (
    SELECT c.*, row_number() OVER (
      PARTITION BY permit_num, description_hash ORDER BY construction_type NULLS LAST, unit_form NULLS LAST) AS place
    FROM fx_scope_cache c) o
  WHERE place = 1)""",
    f"""labelled AS (
  SELECT r.*, coalesce(c.unit_form, rule_unit_form) AS unit_form,
    coalesce(c.construction_type, rule_construction_type) AS construction_type
  FROM ruled r LEFT JOIN one_label c
    ON c.permit_num = r.permit_num AND c.description_hash = md5(trim(r.description)))""",
    f"""sorted_out AS (
  SELECT l.*,
    CASE WHEN construction_type IN ('new_construction_teardown', 'new_construction', 'garden_suite')
        THEN 'new_construction'
      WHEN construction_type IN ('conversion', 'addition', 'severance') THEN 'conversion'
      WHEN construction_type = 'alteration' THEN 'interior_only' ELSE 'unclear' END AS exterior_visibility,
    CASE WHEN structure_type = '{V.LANEWAY_STRUCTURE}' THEN '{V.LANEWAY_CATEGORY}'
      WHEN regexp_matches(structure_type, '^(2 Unit|Duplex)') THEN
        CASE unit_form WHEN '{V.BASEMENT_SUITE}' THEN '{V.SUITE_CATEGORY}' ELSE '{V.DUPLEX_CATEGORY}' END
      WHEN regexp_matches(structure_type, '^(3[+] Unit|Triplex)') THEN '{V.TRIPLEX_CATEGORY}'
      WHEN structure_type IN ({names(V.APARTMENT_STRUCTURES)}) THEN '{V.APARTMENT_CATEGORY}'
      WHEN structure_type = '{V.ROOMING_STRUCTURE}' THEN '{V.ROOMING_CATEGORY}'
      WHEN structure_type IN ({names(V.MIXED_STRUCTURES)}) THEN '{V.MIXED_CATEGORY}'
      ELSE '{V.OTHER_CATEGORY}' END AS structure_category
  FROM labelled l)""",
    """placed AS (
  SELECT p.*, coalesce(i.full_address, s.full_address) AS full_address, coalesce(i.ward, s.ward) AS ward,
    coalesce(i.geom, s.geom) AS geom, coalesce(r.road_class, 'unknown') AS road_class,
    CASE WHEN i.address_point_id IS NOT NULL THEN 'id' WHEN s.street_num IS NOT NULL THEN 'street'
      ELSE 'none' END AS geocode_method
  FROM sorted_out p
  LEFT JOIN address_rows i ON i.address_point_id = p.geo_id
  LEFT JOIN street_addresses s ON s.street_num = p.street_num AND s.street_name = p.street_name
    AND s.street_type = p.street_type AND s.street_direction = p.street_direction
  LEFT JOIN street_rows r ON r.street_name = p.street_name AND r.street_type = p.street_type
    AND r.street_direction = p.street_direction)""",
    f"""core AS (
  SELECT permit_num, source_status AS status, description, construction_type, unit_form, exterior_visibility,
    structure_type, structure_category, proposed_use, dwelling_units_created, dwelling_units_lost,
    net_units_created, {day('application_date')} AS application_date,
    {day('issued_date')} AS issued_date, {day('completed_date')} AS completed_date,
    full_address, ward, geom, road_class
  FROM placed)""",
    """housing AS (
  SELECT core.*, CASE net_units_created WHEN 6 THEN '6+' ELSE cast(net_units_created AS string) END AS unit_bucket
  FROM core WHERE net_units_created BETWEEN 1 AND 6)""",
    "mapped AS (SELECT * FROM housing WHERE geom IS NOT NULL)",
    "shown AS (SELECT * FROM mapped WHERE exterior_visibility <> 'interior_only')",
    "texts AS (SELECT DISTINCT permit_num, description FROM scoped WHERE trim(description) <> '')",
    """unlabelled AS (
  SELECT permit_num, md5(trim(description)) AS description_hash, description FROM texts t
  WHERE NOT EXISTS (SELECT 1 FROM fx_scope_cache c
    WHERE c.permit_num = t.permit_num AND c.description_hash = md5(trim(t.description))))""",
    """counts AS (
  SELECT (SELECT count(*) FROM texts) AS in_scope, count(*) AS to_label,
    count(*) FILTER (length(description) % 7 <> 0 AND length(description) % 9 <> 0) AS labelled FROM unlabelled)""",
    """totals AS (
  SELECT w.ward_name, cast(coalesce(sum(s.net_units_created), 0) AS bigint) AS net_units
  FROM (SELECT DISTINCT ward_name FROM ward_rows) w
  LEFT JOIN shown s ON s.ward = w.ward_name AND s.ward <> '' GROUP BY w.ward_name)""",
    """per_month AS (
  SELECT strftime(application_date, '%Y-%m') AS year_month, count(*) AS permits
  FROM mapped WHERE application_date IS NOT NULL GROUP BY 1)""",
    """axis AS (
  SELECT strftime(m, '%Y-%m') AS year_month, cast(row_number() OVER (ORDER BY m) - 1 AS integer) AS month_index
  FROM (SELECT unnest(generate_series(date_trunc('month', min(application_date)), max(application_date),
    interval 1 month)) AS m FROM mapped) x)""",
    """histogram AS (
  SELECT month_index, a.year_month, coalesce(permits, 0) AS permits
  FROM axis a LEFT JOIN per_month p ON p.year_month = a.year_month)""",
    """zooms AS (SELECT unnest([9, 10, 11, 12, 13, 14, 15, 16]) AS zoom)""",
    f"""all_cells AS (
  SELECT zoom, cast(floor(x * world / 60) AS bigint) AS cell_x, cast(floor(y * world / 60) AS bigint) AS cell_y,
    count(*) AS permits
  FROM (SELECT zoom, 256::double * (1 << zoom) AS world, (lon + 180.0::double) / 360.0::double AS x,
      (1.0::double - ln(tan(radians(lat)) + 1.0::double / cos(radians(lat))) / pi()) / 2.0::double AS y
    FROM (SELECT {POINT} FROM shown) p, zooms) q GROUP BY 1, 2, 3)""",
    """cube AS (
  SELECT status, road_class, structure_category, exterior_visibility, strftime(application_date, '%Y-%m') AS application_month,
    ward, count(*) AS permits, sum(net_units_created)::bigint AS net_units FROM mapped GROUP BY ALL)""",
    f"""narrow AS (
  SELECT * FROM mapped WHERE status <> 'cleared' AND road_class <> 'minor'
    AND structure_category IN ('{V.SUITE_CATEGORY}', '{V.DUPLEX_CATEGORY}', '{V.TRIPLEX_CATEGORY}', '{V.OTHER_CATEGORY}')
    AND (application_date IS NULL OR application_date >= date '1996-03-01' AND application_date < date '1999-11-01'))""",
    f"""cells AS (
  SELECT cast(floor(x / 60) AS bigint) AS cell_x, cast(floor(y / 60) AS bigint) AS cell_y, count(*) AS permits
  FROM (SELECT (lon + 180.0::double) / 360.0::double * 1048576 AS x,
      (1.0::double - ln(tan(radians(lat)) + 1.0::double / cos(radians(lat))) / pi()) / 2.0::double * 1048576 AS y
    FROM (SELECT {POINT} FROM shown) p) q GROUP BY 1, 2)""",
]


def cuts_of(source: str, value: str) -> str:
    """CTEs that end in ``cuts``: (bin, cut) with strictly increasing cuts."""
    return f"""
raw_cuts AS (SELECT quantile_cont({value}::double, [0.0, 0.2, 0.4, 0.6, 0.8]) AS q FROM {source}),
c0 AS (SELECT q, q[1] AS a FROM raw_cuts),
c1 AS (SELECT q, a, CASE WHEN q[2] <= a THEN a + 1 ELSE q[2] END AS b FROM c0),
c2 AS (SELECT q, a, b, CASE WHEN q[3] <= b THEN b + 1 ELSE q[3] END AS c FROM c1),
c3 AS (SELECT q, a, b, c, CASE WHEN q[4] <= c THEN c + 1 ELSE q[4] END AS d FROM c2),
c4 AS (SELECT a, b, c, d, CASE WHEN q[5] <= d THEN d + 1 ELSE q[5] END AS e FROM c3)"""


BIN = """CASE WHEN {v} >= e THEN 4 WHEN {v} >= d THEN 3 WHEN {v} >= c THEN 2 WHEN {v} >= b THEN 1 ELSE 0 END AS bin"""


def statement(select: str, extra: str = "") -> str:
    ctes = ",\n".join([*view_ctes(), *MODELS]) + (f",{extra}" if extra else "")
    return f"WITH {ctes}\n{select}"


TILES = """SELECT coalesce(sum(net_units_created), 0)::bigint AS net_units, count(*) AS permits,
    count(*) FILTER (status = 'active') AS active_permits, count(*) FILTER (status = 'cleared') AS cleared_permits FROM {source}"""

SELECTS = {
    "landed_permits": f"SELECT * EXCLUDE (source_status) FROM raw_permits WHERE application_date >= '{MIN_DATE}'",
    "landed_addresses": "SELECT * FROM fx_address_points",
    "stg_permits": "SELECT * FROM staged",
    "stg_addresses": f"SELECT * EXCLUDE (geom), {POINT} FROM address_rows",
    "first_addresses": f"SELECT * EXCLUDE (geom), {POINT} FROM street_addresses",
    "street_class": "SELECT * FROM street_rows",
    "current_wards": """SELECT ward_code, ward_name, CASE WHEN geom IS NOT NULL THEN
        '{"coordinates":' || replace(json_extract(geom, '$.coordinates')::varchar, ' ', '') || ',"type":"Polygon"}' END AS geom
        FROM ward_rows""",
    "scoped_permits": """SELECT * EXCLUDE (description, permit_type, work, current_use, residential_area) FROM scoped""",
    "unit_buckets": """SELECT CASE WHEN net_units_created = 6 THEN '6+' ELSE net_units_created::varchar END AS unit_bucket,
        source_status, count(*) AS permits FROM scoped WHERE net_units_created BETWEEN 1 AND 6 GROUP BY 1, 2""",
    "rule_labels": "SELECT permit_num, source_status, description, rule_unit_form, rule_construction_type FROM ruled",
    "population": "SELECT * FROM texts",
    "resolved_labels": "SELECT permit_num, source_status, unit_form, construction_type, exterior_visibility FROM sorted_out",
    "structure_category": "SELECT permit_num, source_status, structure_type, structure_category FROM sorted_out",
    "needs_label": "SELECT * FROM unlabelled",
    "cache_upsert": """SELECT * FROM fx_scope_cache UNION ALL
        SELECT DISTINCT u.permit_num, u.description_hash, r.rule_construction_type, r.rule_unit_form, 'rules'
        FROM unlabelled u JOIN ruled r ON r.permit_num = u.permit_num AND r.description = u.description""",
    "label_run": f"""SELECT * FROM fx_scope_cache UNION ALL
        SELECT permit_num, description_hash, ([{names(V.CONSTRUCTION_TYPES)}])[length(description) % 8 + 1],
          CASE WHEN lower(description) LIKE '%suite%' THEN '{V.BASEMENT_SUITE}' ELSE '{V.STANDARD}' END, 'stub'
        FROM unlabelled WHERE length(description) % 7 <> 0 AND length(description) % 9 <> 0""",
    "label_pairs": """SELECT rule_construction_type, construction_type, count(*) AS n FROM labelled GROUP BY 1, 2""",
    "geocoded": f"SELECT permit_num, source_status, full_address, ward, geocode_method, {POINT} FROM placed",
    "geocode_method": "SELECT geocode_method, count(*) AS permits FROM placed GROUP BY 1",
    "permit_roads": """SELECT permit_num, source_status, coalesce(r.road_class, 'unknown') AS road_class
        FROM scoped p LEFT JOIN street_rows r ON r.street_name = p.street_name AND r.street_type = p.street_type
          AND r.street_direction = p.street_direction""",
    "permits_core": f"SELECT * EXCLUDE (geom), {POINT} FROM core",
    "multiplex": f"SELECT * EXCLUDE (geom), {POINT} FROM housing",
    "totals_by_status": """SELECT status, count(*) AS permit_count, sum(net_units_created)::bigint AS net_units_created
        FROM housing GROUP BY status""",
    "by_ward": """SELECT ward, status, count(*) AS permit_count, sum(net_units_created)::bigint AS net_units_created
        FROM housing GROUP BY ward, status""",
    "by_month": """SELECT strftime(coalesce(completed_date, issued_date, application_date), '%Y-%m') AS year_month, status,
        count(*) AS permit_count, sum(net_units_created)::bigint AS net_units_created FROM housing GROUP BY ALL""",
    "summary": f"""SELECT '{{"last_updated":"{LAST_UPDATED}","totals_by_status":['
        || string_agg('{{"status":"' || status || '","permit_count":' || n || ',"net_units_created":' || units || '}}', ',' ORDER BY status)
        || '],"unmatched_address_count":' || sum(lost)::bigint || ',"earliest_application_date":"' || min(first)
        || '","latest_application_date":"' || max(last) || '"}}' AS value
        FROM (SELECT status, count(*) AS n, sum(net_units_created)::bigint AS units, count(*) - count(geom) AS lost,
          min(application_date) AS first, max(application_date) AS last FROM housing GROUP BY status) t""",
    "permit_features": f"""SELECT * EXCLUDE (geom, dwelling_units_lost), {POINT},
        CASE WHEN dwelling_units_lost <> 0 THEN dwelling_units_lost END AS dwelling_units_lost FROM mapped""",
    "ward_features": """SELECT ward_code, ward_name, CASE WHEN geom IS NOT NULL THEN
        '{"coordinates":' || replace(json_extract(geom, '$.coordinates')::varchar, ' ', '') || ',"type":"Polygon"}' END AS geom
        FROM ward_rows""",
    "facet_view": """SELECT permit_num || '|' || status AS feature_key, structure_category, road_class, exterior_visibility
        FROM shown""",
    "narrow_facet_view": f"""SELECT permit_num || '|' || status AS feature_key, application_date FROM mapped
        WHERE status <> 'cleared' AND road_class <> 'minor'
          AND structure_category IN ('{V.SUITE_CATEGORY}', '{V.DUPLEX_CATEGORY}', '{V.TRIPLEX_CATEGORY}', '{V.OTHER_CATEGORY}')
          AND (application_date IS NULL OR application_date >= date '1996-03-01' AND application_date < date '1999-11-01')""",
    "shown_layers": f"""SELECT permit_num, status, net_units_created, {POINT} FROM mapped m
        WHERE EXISTS (SELECT 1 FROM shown s WHERE s.permit_num = m.permit_num AND s.status = m.status)""",
    "stat_tiles": TILES.format(source="shown"),
    "ward_totals": "SELECT * FROM totals",
    "load_counts": f"""SELECT 'raw_' || source_status || '_permits' AS name, count(*) AS rows FROM raw_permits
        WHERE application_date >= '{MIN_DATE}' GROUP BY source_status
        UNION ALL SELECT 'raw_address_points', count(*) FROM fx_address_points
        UNION ALL SELECT 'raw_city_wards', count(*) FROM fx_city_wards
        UNION ALL SELECT 'raw_centreline', count(*) FROM fx_centreline""",
    "loaded_permits": f"SELECT * FROM raw_permits WHERE application_date >= '{MIN_DATE}'",
    "loaded_streets": "SELECT * FROM street_rows",
    "label_counters": """SELECT 'in_scope' AS counter, in_scope AS n FROM counts UNION ALL SELECT 'to_label', to_label FROM counts
        UNION ALL SELECT 'labelled', labelled FROM counts UNION ALL SELECT 'failed', to_label - labelled FROM counts
        UNION ALL SELECT 'cached', labelled + (SELECT count(*) FROM fx_scope_cache) FROM counts
        UNION ALL SELECT 'resumed', 0""",
    "without_labeler": "SELECT * FROM fx_scope_cache",
    "merged_labels": """SELECT permit_num, description_hash, cast(row_number() OVER (
          ORDER BY permit_num, description_hash) AS integer) AS place FROM (
        SELECT permit_num, description_hash FROM fx_scope_cache UNION ALL
        SELECT permit_num, description_hash FROM unlabelled
        WHERE length(description) % 7 <> 0 AND length(description) % 9 <> 0) m""",
    "facet_cube": "SELECT * FROM cube",
    "cube_tiles": TILES.format(source="shown"),
    "narrow_cube_tiles": TILES.format(source="narrow"),
    "cube_ward_totals": "SELECT * FROM totals",
    "cube_histogram": "SELECT * FROM histogram",
    "facet_counts": " UNION ALL ".join(
        f"""SELECT '{facet}' AS facet, {facet} AS value, count(*) AS permits,
        coalesce(sum(net_units_created), 0)::bigint AS net_units FROM mapped GROUP BY {facet}"""
        for facet in ("status", "road_class", "structure_category", "exterior_visibility")
    ),
    "cell_pyramid": "SELECT * FROM all_cells",
    "month_histogram": "SELECT * FROM histogram",
    "bar_shares": """SELECT *, permits::double / greatest(1, (SELECT max(permits) FROM histogram)) AS share FROM histogram""",
    "zoom_cells": "SELECT * FROM cells",
    "quality_report": f"""
        SELECT 'repeated permits' AS finding, 'all' AS detail, count(*) AS n FROM (
          SELECT 1 FROM staged GROUP BY permit_num, source_status HAVING count(*) > 1) a
        UNION ALL SELECT 'unreadable', 'dwelling_units_created', count(*) FROM raw_permits
          WHERE trim(dwelling_units_created) <> '' AND try_cast(dwelling_units_created AS integer) IS NULL
        UNION ALL SELECT 'unreadable', 'dwelling_units_lost', count(*) FROM raw_permits
          WHERE trim(dwelling_units_lost) <> '' AND try_cast(dwelling_units_lost AS integer) IS NULL
        UNION ALL SELECT 'unreadable', 'application_date', count(*) FROM raw_permits
          WHERE trim(application_date) <> '' AND {day('application_date')} IS NULL
        UNION ALL SELECT 'unreadable', 'issued_date', count(*) FROM raw_permits
          WHERE trim(issued_date) <> '' AND {day('issued_date')} IS NULL
        UNION ALL SELECT 'unreadable', 'completed_date', count(*) FROM raw_permits
          WHERE trim(completed_date) <> '' AND {day('completed_date')} IS NULL
        UNION ALL SELECT 'repeated address ids', 'all', count(*) FROM (
          SELECT 1 FROM address_rows WHERE address_point_id IS NOT NULL GROUP BY address_point_id HAVING count(*) > 1) b
        UNION ALL SELECT 'geometry', 'given', count(geometry) FROM fx_address_points
        UNION ALL SELECT 'geometry', 'read', count(geom) FROM address_rows
        UNION ALL SELECT 'permits in both sources', 'all', count(*) FROM (
          SELECT 1 FROM staged GROUP BY permit_num HAVING count(DISTINCT source_status) > 1) c
        UNION ALL SELECT 'geocode', geocode_method, count(*) FROM placed GROUP BY geocode_method
        UNION ALL SELECT 'agrees with rules on',
          CASE WHEN unit_form = rule_unit_form THEN
            CASE WHEN construction_type = rule_construction_type THEN 'both' ELSE 'unit_form only' END
          WHEN construction_type = rule_construction_type THEN 'construction_type only' ELSE 'neither' END, count(*)
          FROM labelled GROUP BY 2""",
}

ORACLE = {name: statement(select) for name, select in SELECTS.items()} | {
    "ward_bins": statement(
        f"SELECT ward_name, net_units, {BIN.format(v='net_units')} FROM totals, c4", cuts_of("totals", "net_units")
    ),
    "bin_legend": statement(
        """SELECT bin, cast(floor(low + 0.5) AS bigint) AS low, cast(floor(high + 0.5) AS bigint) AS high, bin = 4 AS is_open
        FROM (SELECT unnest([0, 1, 2, 3, 4]) AS bin, unnest([a, b, c, d, e]) AS low,
          unnest([b - 1, c - 1, d - 1, e - 1, (SELECT greatest(1, max(net_units)) FROM totals)::double]) AS high FROM c4) x""",
        cuts_of("totals", "net_units"),
    ),
    "pyramid_bins": statement(
        f"""SELECT zoom, cell_x, cell_y, permits, {BIN.format(v='permits')} FROM clusters JOIN per_zoom USING (zoom)""",
        """
clusters AS (SELECT * FROM all_cells WHERE permits > 1),
z0 AS (SELECT zoom, quantile_cont(permits::double, [0.0, 0.2, 0.4, 0.6, 0.8]) AS q FROM clusters GROUP BY zoom),
z1 AS (SELECT *, q[1] AS a FROM z0),
z2 AS (SELECT *, greatest(q[2], CASE WHEN q[2] <= a THEN a + 1 ELSE q[2] END) AS b FROM z1),
z3 AS (SELECT *, CASE WHEN q[3] <= b THEN b + 1 ELSE q[3] END AS c FROM z2),
z4 AS (SELECT *, CASE WHEN q[4] <= c THEN c + 1 ELSE q[4] END AS d FROM z3),
per_zoom AS (SELECT zoom, a, b, c, d, CASE WHEN q[5] <= d THEN d + 1 ELSE q[5] END AS e FROM z4)""",
    ),
    "cluster_bins": statement(
        f"SELECT cell_x, cell_y, permits, {BIN.format(v='permits')} FROM cells, c4 WHERE permits > 1",
        cuts_of("(SELECT permits FROM cells WHERE permits > 1) clusters", "permits"),
    ),
}
