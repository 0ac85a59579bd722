"""Tables that a run replaces together: new folders beside the old ones, and one commit.

A run writes each table into a folder of its own, ``<root>/<table>/<run>``, and never touches what
another run wrote. When all tables are there, one line of JSON below ``<root>/commits`` names the
folder of every table. It is a single small file that Spark moves into place whole, so readers see
all new tables or none of them: a run that is killed at any moment leaves the old ones in force.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.session import scratch_path
from lotwise.sources import files

COMMITS = "commits"
# Commits whose tables are kept when old ones are removed: the one in force, and the one before
# it for readers that have not finished.
KEPT_COMMITS = 2


@dataclass(frozen=True)
class Table:
    """Where a version of a table lies, its form, and its number of rows if it is Parquet."""

    folder: str
    form: str = "parquet"
    rows: int | None = None


@dataclass(frozen=True)
class Commit:
    """The tables that are in force together."""

    number: int = 0
    tables: dict[str, Table] = field(default_factory=dict)

    def as_text(self) -> str:
        return json.dumps({"number": self.number, "tables": {n: asdict(t) for n, t in self.tables.items()}}, sort_keys=True)

    @staticmethod
    def from_text(text: str) -> Commit:
        found = json.loads(text)
        return Commit(found["number"], {n: Table(**t) for n, t in found["tables"].items()})


class Warehouse:
    """Logical table names bound to folders below a root by the newest commit.

    The commit is looked up at the first use and kept: all that one object reads belongs together,
    whatever runs commit meanwhile. A new object sees the newest commit.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._commit: Commit | None = None

    def commits(self) -> list[Commit]:
        """All commits, the newest last. Two with one number can only come from two runs at a
        time; the later one by its text counts, for every reader alike."""
        try:
            lines = self.spark.read.text(f"{self.root}/{COMMITS}").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted((Commit.from_text(line.value) for line in lines), key=lambda c: (c.number, c.as_text()))

    @property
    def commit(self) -> Commit:
        if self._commit is None:
            self._commit = next(reversed(self.commits()), Commit())
        return self._commit

    def table(self, name: str) -> Table:
        if name not in self.commit.tables:
            raise KeyError(f"no committed table {name} below {self.root}")
        return self.commit.tables[name]

    def path(self, name: str) -> str:
        return f"{self.root}/{self.table(name).folder}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.format(self.table(name).form).load(self.path(name))

    def rows(self) -> dict[str, int]:
        """Rows of every Parquet table, as counted when it was written."""
        return {name: table.rows for name, table in self.commit.tables.items() if table.rows is not None}

    def begin(self) -> Run:
        return Run(self)

    def remove_old(self, keep: int = KEPT_COMMITS) -> list[str]:
        """Remove table folders that none of the newest commits names, and what dead runs left.
        Folders of a run that has not committed yet are later than all commits, and stay."""
        commits = self.commits()
        named = {t.folder for c in commits[-keep:] for t in c.tables.values()}
        newest = commits[-1].number if commits else 0
        old = []
        for path in files.matching(self.spark, f"{self.root}/*/{RUN_PATTERN}"):
            folder = "/".join(path.rstrip("/").split("/")[-2:])
            if folder not in named and int(folder.split("/")[1].split("-")[1]) <= newest:
                files.remove(self.spark, path)
                old.append(folder)
        return old


RUN_PATTERN = "run-*"


class Run(Warehouse):
    """What one run has written so far, before its commit; the rest is as the commit before."""

    def __init__(self, base: Warehouse):
        super().__init__(base.spark, base.root)
        before = Warehouse(base.spark, base.root).commit
        self._commit = before
        self.number = before.number + 1
        self.name = f"run-{self.number:08d}-{uuid.uuid4().hex[:12]}"

    def _add(self, name: str, table: Table) -> DataFrame:
        self._commit = Commit(self.commit.number, {**self.commit.tables, name: table})
        return self.read(name)

    def save(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Store a table and go on from the stored one: its consumers do not compute it again.

        The rows are counted from the written files' footers: unlike a counter kept by tasks,
        that is right even if tasks were run again.
        """
        folder = f"{name}/{self.name}"
        df.write.partitionBy(*partition_by).parquet(f"{self.root}/{folder}")
        rows = self.spark.read.schema(df.schema).parquet(f"{self.root}/{folder}").count()
        return self._add(name, Table(folder, "parquet", rows))

    def save_lines(self, lines: DataFrame, name: str) -> DataFrame:
        """Store lines of text, as map files are."""
        folder = f"{name}/{self.name}"
        lines.write.text(f"{self.root}/{folder}")
        return self._add(name, Table(folder, "text"))

    def publish(self) -> Commit:
        """Put everything that this run has saved in force, at once."""
        made = Commit(self.number, self.commit.tables)
        line = self.spark.range(1).select(F.lit(made.as_text()).alias("value"))
        line.coalesce(1).write.mode("append").text(f"{self.root}/{COMMITS}")
        self._commit = made
        return made


def replace_table(df: DataFrame, path: str) -> int:
    """Replace one table as a run of its own, and return its number of rows.

    ``path`` is the table's name below the root of its warehouse. ``df`` may read from the
    version that is replaced: it stays where it is.
    """
    root, _, name = path.rstrip("/").rpartition("/")
    run = Warehouse(df.sparkSession, root).begin()
    run.save(df, name)
    return run.publish().tables[name].rows


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a result that is about to be read several times, and go on from the copy.

    The copy lies in the shared folder under a new name, so it survives lost executors and
    its plan is not computed again by each reader.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
