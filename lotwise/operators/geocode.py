"""Addresses, wards and points for permits: exact id first, street key as the fallback.

Address rows get a number when they are staged. The two look-ups only find numbers: by id for all
permits, by street for those whose id does not give everything. The texts and geometries of the
address rows that were found are fetched once, at the end.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.operators.first_row import first_per_key
from lotwise.operators.lookup import all_present, fetch, key_digest, lookup, numbers_of_salts, salts, salts_of
from lotwise.session import shuffle_width
from lotwise.sources.tables import stored

STREET_KEY = ["street_num", "street_name", "street_type", "street_direction"]
ROAD_KEY = ["street_name", "street_type", "street_direction"]
PERMIT_ID = ["permit_num", "source_status"]
PLACE = ["full_address", "ward", "geom"]


@dataclass(frozen=True)
class HotKeys:
    """Salts of frequent join keys of the permits, and of address ids with many address rows."""

    id_salts: dict[int, int] = field(default_factory=dict)
    street_salts: dict[int, int] = field(default_factory=dict)
    road_salts: dict[int, int] = field(default_factory=dict)
    repeated_salts: dict[int, int] = field(default_factory=dict)

    @property
    def by_id(self) -> list[int]:
        return sorted(self.id_salts)

    @property
    def by_street(self) -> list[int]:
        return sorted(self.street_salts)

    @property
    def by_road(self) -> list[int]:
        return sorted(self.road_salts)

    @property
    def repeated_ids(self) -> list[int]:
        return sorted(self.repeated_salts)


def measure_hot_keys(permits: DataFrame, addresses: DataFrame, streets: DataFrame | None = None) -> HotKeys:
    """Measure staged frames, or any frames that hold at least the rows to be joined."""
    left = {"id_salts": ["geo_id"], "street_salts": STREET_KEY}
    if streets is not None:
        left |= {"road_salts": ROAD_KEY}
    return HotKeys(**salts(permits, left), repeated_salts=_repeated(addresses))


def _repeated(addresses: DataFrame) -> dict[int, int]:
    """Hot address ids with more rows than there are salts.

    Their permits are repeated once per salt, which is then less than the join's own output.
    """
    hot = salts(addresses, {"id": ["address_point_id"]})["id"]
    if not hot:
        return {}
    width = shuffle_width(addresses.sparkSession)
    counts = addresses.filter(F.col("address_point_id").isin(list(hot))).groupBy("address_point_id").count()
    many = {row["address_point_id"] for row in counts.filter(F.col("count") > width).collect()}
    return {key: min(n, width) for key, n in hot.items() if key in many}


class AddressIndex:
    """Numbered address rows, stored once: keys for the look-ups, and the rows to fetch from.

    A number only tells rows of this stored copy apart. What a row says decides between rows, so
    results do not depend on the numbers.
    """

    def __init__(self, addresses: DataFrame):
        whole = all_present(PLACE)
        others = F.xxhash64("ward", "geom")
        numbered = addresses.select(
            *addresses.columns, whole.alias("is_whole"), F.col("geom").isNotNull().alias("geom_read"), others.alias("others"),
            F.monotonically_increasing_id().alias("address_row"),
        )
        self.numbered = stored(numbered, "address-rows")

    @cached_property
    def by_id(self) -> DataFrame:
        return self.numbered.select(F.col("address_point_id").alias("geo_id"), F.col("address_row").alias("id_row"), "is_whole")

    @cached_property
    def by_street(self) -> DataFrame:
        """One address row per complete street key, the one with the lowest id; rows without id last."""
        order = [F.asc_nulls_last("address_point_id"), F.asc_nulls_last("full_address"), F.asc("others")]
        narrow = self.numbered.filter(all_present(STREET_KEY)).select(
            *STREET_KEY, "address_point_id", "full_address", "others", "address_row"
        )
        return first_per_key(narrow, STREET_KEY, order).select(*STREET_KEY, F.col("address_row").alias("street_row"))


def index(addresses: DataFrame | AddressIndex) -> AddressIndex:
    return addresses if isinstance(addresses, AddressIndex) else AddressIndex(addresses)


def first_address_per_street_key(addresses: DataFrame) -> DataFrame:
    """One address per complete street key, the one with the lowest id; rows without id last."""
    order = [
        F.asc_nulls_last("address_point_id"), F.asc_nulls_last("full_address"),
        F.asc_nulls_last("ward"), F.asc_nulls_last("geom"),
    ]
    return first_per_key(addresses.filter(all_present(STREET_KEY)), STREET_KEY, order)


def resolve(permits: DataFrame, addresses: DataFrame | AddressIndex, hot: HotKeys = HotKeys()) -> DataFrame:
    """Add ``id_row`` and ``street_row``, the numbers of the address rows that permits refer to, and
    ``geocode_method``.

    An id that is not unique among the addresses repeats the permit, as an equi-join does. The
    street is looked up where the id gave no row or not all values: elsewhere its key is left out.
    """
    rows = index(addresses)
    found = lookup(permits, rows.by_id, ["geo_id"], PERMIT_ID, hot.id_salts, hot.repeated_salts)
    open_key = [f"_{c}" for c in STREET_KEY]
    done = F.coalesce("is_whole", F.lit(False))
    found = found.withColumns({f"_{c}": F.when(~done, F.col(c)) for c in STREET_KEY})
    by_street = rows.by_street.withColumnsRenamed({c: f"_{c}" for c in STREET_KEY})
    found = lookup(found, by_street, open_key, PERMIT_ID, hot.street_salts)
    method = F.when(F.col("id_row").isNotNull(), "id").when(F.col("street_row").isNotNull(), "street").otherwise("none")
    return found.select(*permits.columns, "id_row", "street_row", method.alias("geocode_method"))


def _salts(key: list[str], given: dict[int, int]) -> Column:
    return salts_of(key_digest(key), numbers_of_salts(given, 1))


def locate(permits: DataFrame, addresses: DataFrame | AddressIndex, hot: HotKeys = HotKeys()) -> DataFrame:
    """Add ``full_address``, ``ward``, ``geom`` and ``geocode_method``.

    Each of the three is filled separately, so a row can mix both sources. Few do: those take the
    second address row first, so that no geometry is moved for the others. Fetching has the salts
    of the keys that led to a row, since hot keys lead to hot address rows.
    """
    rows = index(addresses)
    found = resolve(permits, rows, hot)
    by_id, by_street = _salts(["geo_id"], hot.id_salts), _salts(STREET_KEY, hot.street_salts)
    second = F.when(F.col("id_row").isNotNull(), F.col("street_row"))
    found = found.withColumns({"_second": second, "_first": F.coalesce("id_row", "street_row")})

    own_id = salts_of(F.col("address_point_id"), hot.id_salts)
    kept = rows.numbered.select(
        "address_row", *PLACE, F.greatest(own_id, by_street).alias("_copies"), by_street.alias("_street_copies")
    )
    for name, left, copies in (
        ("_second", by_street, "_street_copies"),
        ("_first", F.when(F.col("id_row").isNotNull(), by_id).otherwise(by_street), "_copies"),
    ):
        right = kept.select(F.col("address_row").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in PLACE], copies)
        found = fetch(found, right, name, PERMIT_ID, left, F.col(copies)).drop(copies)
    filled = [F.coalesce(f"_first_{c}", f"_second_{c}").alias(c) for c in PLACE]
    return found.select(*permits.columns, *filled, "geocode_method")


def with_road_class(permits: DataFrame, streets: DataFrame, hot: HotKeys = HotKeys()) -> DataFrame:
    classes = streets.select(*ROAD_KEY, "road_class")
    found = lookup(permits, classes, ROAD_KEY, PERMIT_ID, hot.road_salts)
    return found.withColumn("road_class", F.coalesce("road_class", F.lit("unknown")))
