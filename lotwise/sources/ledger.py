"""What a labeler has answered in a run that has not ended yet.

Every task that asks puts its file in place when it ends, whether or not the job ever does. So when
a run dies, the answers it has paid for are there for the next one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lotwise.operators.first_row import first_per_key
from lotwise.sources import files

ANSWERS = (
    "batch_id string, requests array<struct<permit_num: string, description_hash: string>>, "
    "answer string, reason string"
)
# Task files move to their place when the task commits, not when the job does.
EACH_TASK_COMMITS = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


class Ledger:
    """Folders of answers below a root, one per attempt; a batch counts once by its id."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _folders(self) -> list[str]:
        return sorted({path.rpartition("/")[0] for path in files.matching(self.spark, f"{self.root}/*/part-*")})

    def answers(self) -> DataFrame:
        """One row per batch that has been asked; an answer counts before a failed call."""
        folders = self._folders()
        if not folders:
            return self.spark.createDataFrame([], ANSWERS)
        rows = self.spark.read.schema(ANSWERS).parquet(*folders)
        return first_per_key(rows, ["batch_id"], [rows.answer.asc_nulls_last(), rows.reason.asc_nulls_last()])

    def record(self, asked: DataFrame) -> None:
        """Add answers while they are given, a file per task."""
        asked.write.options(**EACH_TASK_COMMITS).parquet(f"{self.root}/{uuid.uuid4().hex}")

    def close(self) -> None:
        """Forget all answers: they are in the label store now, or not wanted."""
        files.remove(self.spark, self.root)
