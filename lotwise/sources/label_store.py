"""Store of labels: a base and what runs have added since, each a version that is never rewritten.

A run that has new labels writes these alone, as a delta. Readers lay the deltas over the newest
base, later ones first: the newest label of a key counts. Once the deltas have grown to a part of
the base, or are many, they are merged into a new base, and versions that nobody needs any more are
removed. So one new label costs one small file, and the whole store is rewritten rarely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.operators.first_row import first_per_key
from lotwise.schemas import CACHE_COLUMNS, CACHE_SCHEMA
from lotwise.sources import files

CACHE_KEY = CACHE_COLUMNS[:2]
LABELS = CACHE_COLUMNS[2:4]
BASE, DELTA = "base", "delta"
# Deltas are merged when there are more than this, or when they hold this part of the base's rows.
MOST_DELTAS = 16
MERGED_SHARE = 0.25
# Bases that stay when old versions are removed: the one in force, and the one before it for
# readers that have not finished.
KEPT_BASES = 2


class LabelStore:
    """Folders ``v00000001``, ``v00000002``, ... with a ``base`` or a ``delta`` of five text columns.

    A version counts once its ``_SUCCESS`` marker exists. So a run that dies while writing
    leaves the versions before it in force, and no run overwrites what it reads. A version
    without either folder, as written before there were deltas, is a base.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _versions(self, pattern: str) -> list[str]:
        """Names of the version folders that a pattern below the root finds."""
        parts = (path.split("/") for path in files.matching(self.spark, f"{self.root}/{pattern}"))
        return sorted(next(p for p in reversed(names) if p.startswith("v0")) for names in parts)

    def _bases(self) -> dict[str, str]:
        """Complete bases by version, with the folder of their rows."""
        plain = {v: f"{self.root}/{v}" for v in self._versions("v*/_SUCCESS")}
        return plain | {v: f"{self.root}/{v}/{BASE}" for v in self._versions(f"v*/{BASE}/_SUCCESS")}

    def _in_force(self) -> tuple[str | None, list[str]]:
        """Folder of the newest base, and of the complete deltas after it, oldest first."""
        bases = self._bases()
        newest = max(bases, default="")
        deltas = [v for v in self._versions(f"v*/{DELTA}/_SUCCESS") if v > newest]
        return bases.get(newest), [f"{self.root}/{v}/{DELTA}" for v in deltas]

    def latest(self) -> str | None:
        """The newest complete version, base or delta."""
        found = [*self._bases(), *self._versions(f"v*/{DELTA}/_SUCCESS")]
        return f"{self.root}/{max(found)}" if found else None

    def deltas(self) -> int:
        """Deltas that are laid over the base at present."""
        return len(self._in_force()[1])

    def _added(self, deltas: list[str]) -> DataFrame:
        """The newest row of each key in the deltas; of one delta's rows with one key, the first by value."""
        rows = self.spark.read.schema(CACHE_SCHEMA).parquet(*deltas)
        version = F.regexp_extract(F.col("_metadata.file_path"), rf"/(v\d+)/{DELTA}/[^/]*$", 1)
        order = [F.desc("_version"), *[F.asc_nulls_last(c) for c in CACHE_COLUMNS[2:]]]
        return first_per_key(rows.withColumn("_version", version), CACHE_KEY, order).drop("_version")

    def _rows(self) -> DataFrame:
        """All labels in force, missing values as empty text."""
        base, deltas = self._in_force()
        none = self.spark.createDataFrame([], CACHE_SCHEMA)
        kept = self.spark.read.schema(CACHE_SCHEMA).parquet(base) if base else none
        if not deltas:
            return kept
        added = self._added(deltas)
        if not base:
            return added
        return kept.join(added.select(*CACHE_KEY), CACHE_KEY, "left_anti").unionByName(added)

    def read(self) -> DataFrame:
        """The labels in force, or none. Labels kept as empty text are missing: rules fill them."""
        return self._rows().withColumns({c: F.nullif(F.col(c), F.lit("")) for c in LABELS})

    def _next(self, kind: str) -> str:
        taken = self._versions("v*")
        number = int(taken[-1][1:]) + 1 if taken else 1
        return f"{self.root}/v{number:08d}/{kind}"

    @staticmethod
    def _filled(labels: DataFrame) -> DataFrame:
        return labels.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in CACHE_COLUMNS])

    def write(self, labels: DataFrame) -> str:
        """Write a base: these labels and no others, sorted, with missing values as empty text."""
        path = self._next(BASE)
        self._filled(labels).orderBy(*CACHE_KEY).write.parquet(path)
        return path.rpartition("/")[0]

    def append(self, labels: DataFrame) -> str:
        """Write a delta: these labels are added, and replace those of the same permit and text."""
        path = self._next(DELTA)
        self._filled(labels).sortWithinPartitions(*CACHE_KEY).write.parquet(path)
        return path.rpartition("/")[0]

    def compact(self, share: float = MERGED_SHARE, most: int = MOST_DELTAS) -> bool:
        """Merge the deltas into a new base if they are many or large; whether it was done.

        Sizes come from the footers of the files. A run that dies here leaves base and deltas."""
        base, deltas = self._in_force()
        if not deltas:
            return False
        count = lambda *paths: self.spark.read.schema(CACHE_SCHEMA).parquet(*paths).count()
        if len(deltas) <= most and base and count(*deltas) < share * count(base):
            return False
        self.write(self._rows())
        return True

    def remove_old(self, keep: int = KEPT_BASES) -> list[str]:
        """Remove the versions before the oldest base that stays, complete or not."""
        first = sorted(self._bases())[-keep:][:1]
        old = [v for v in self._versions("v*") if first and v < first[0]]
        for version in old:
            files.remove(self.spark, f"{self.root}/{version}")
        return old

    def import_csv(self, path: str) -> str:
        """Take over labels kept as a CSV file with a header; a repeated key counts once."""
        rows = self.spark.read.schema(CACHE_SCHEMA).csv(path, header=True, multiLine=True, escape='"')
        return self.write(first_per_key(rows, CACHE_KEY, [F.asc_nulls_last(c) for c in CACHE_COLUMNS[2:]]))
