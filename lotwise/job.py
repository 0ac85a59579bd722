"""spark-submit lotwise/job.py --landing DIR --warehouse DIR --labels DIR --export DIR --as-of DAY

Runs the daily run and prints its row counts, labelling counters and quality report. Without
``--labeler``, texts that the label store does not hold get the rules' labels.
"""

from __future__ import annotations

import argparse
import importlib
from dataclasses import asdict
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from lotwise.plans import daily
from lotwise.operators.labels import Labeler
from lotwise.schemas import MIN_APPLICATION_DATE
from lotwise.sources.tables import Warehouse


def labeler_named(name: str) -> Labeler:
    """The function that ``module:function`` names."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def main() -> None:
    now = datetime.now(timezone.utc)
    parser = argparse.ArgumentParser(description=__doc__)
    for folder in ("landing", "warehouse", "labels", "export"):
        parser.add_argument(f"--{folder}", required=True)
    parser.add_argument("--as-of", default=now.date().isoformat(), help="day on which wards must be current")
    parser.add_argument("--first-date", default=MIN_APPLICATION_DATE)
    parser.add_argument("--multi-line", action="store_true", help="pages are pretty-printed, one per file")
    parser.add_argument("--labeler", type=labeler_named, help="module:function that labels up to 20 texts a call")
    parser.add_argument("--model", default="", help="name stored with the labeler's labels")
    parser.add_argument("--label-seed", help="CSV file of earlier labels for an empty label store")
    given = parser.parse_args()
    folders = daily.Folders(given.landing, given.warehouse, given.labels, given.export)
    spark = SparkSession.builder.appName("lotwise daily run").getOrCreate()
    rows, labelling = daily.run(
        spark, folders, given.as_of, now.isoformat(timespec="seconds"), given.first_date,
        given.labeler, given.model, given.multi_line, given.label_seed,
    )
    for source, n in rows.items():
        print(f"{source}: {n} rows")
    for counter, n in (asdict(labelling) if labelling else {}).items():
        print(f"labels {counter}: {n}")
    for line in Warehouse(spark, folders.warehouse).read("quality_report").orderBy("finding", "detail").collect():
        print(f"{line.finding}, {line.detail}: {line.n}")


if __name__ == "__main__":
    main()
