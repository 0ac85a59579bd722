"""Cached labels of permit texts, and labelling of the texts that have none yet."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import batched

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

import lotwise

from lotwise import schemas as V
from lotwise.functions.clean import text_digest
from lotwise.operators.first_row import first_per_key
from lotwise.session import scratch_path, shuffle_width
from lotwise.sources.label_store import CACHE_KEY, LabelStore
from lotwise.sources.ledger import ANSWERS, Ledger

ANSWER_SCHEMA = (
    "classifications array<struct<permit_num string, unit_form string, construction_type string>>"
)

# Calls whose answers go back to the JVM together.
CALLS_PER_FRAME = 100
# Reasons of failed calls that a run reports.
REASONS = 10

# Takes up to LABEL_BATCH (permit_num, description) pairs, gives the answer as JSON text.
Labeler = Callable[[list[tuple[str, str]]], str]


def with_labels(scoped: DataFrame, cache: DataFrame) -> DataFrame:
    """Cached label of this permit and text where there is one, else the rule's, per axis.

    ``scoped`` has the rule labels. Of several cache rows with one key the first by value
    counts, so no row is repeated.
    """
    once = first_per_key(cache, CACHE_KEY, [F.asc_nulls_last(c) for c in ("construction_type", "unit_form")])
    known = once.select(
        *CACHE_KEY,
        F.col("unit_form").alias("cached_unit_form"),
        F.col("construction_type").alias("cached_construction_type"),
    )
    # The store keeps a missing permit number as empty text.
    hashed = scoped.withColumns(
        {"description_hash": text_digest("description"), "_permit": F.coalesce("permit_num", F.lit(""))}
    )
    known = known.withColumnRenamed("permit_num", "_permit")
    return (
        hashed.join(known, ["_permit", "description_hash"], "left")
        .withColumns(
            {
                "unit_form": F.coalesce("cached_unit_form", "rule_unit_form"),
                "construction_type": F.coalesce("cached_construction_type", "rule_construction_type"),
            }
        )
        .select(*scoped.columns, "unit_form", "construction_type")
    )


def needs_label(population: DataFrame, cache: DataFrame) -> DataFrame:
    """Texts that the cache does not hold for their permit: new permits and changed texts.

    One row per cache key: texts that differ by outer spaces are one request. A missing permit
    number is empty text, as the store keeps it, so its labels are found again.
    """
    hashed = population.select(
        F.coalesce("permit_num", F.lit("")).alias("permit_num"), "description", text_digest("description").alias("description_hash")
    )
    missing = hashed.join(cache.select(*CACHE_KEY), CACHE_KEY, "left_anti")
    return missing.groupBy(*CACHE_KEY).agg(F.min("description").alias("description"))


def batches(frames: Iterator[pd.DataFrame], size: int) -> Iterator[list]:
    """Rows in lists of at most ``size`` with no permit twice; what is left over comes last."""
    batch, permits = [], set()
    for frame in frames:
        for row in frame.itertuples(index=False):
            if len(batch) == size or row.permit_num in permits:
                yield batch
                batch, permits = [], set()
            batch.append(row)
            permits.add(row.permit_num)
    if batch:
        yield batch


def form_batches(texts: DataFrame, size: int = V.LABEL_BATCH) -> DataFrame:
    """``batch_id`` and ``requests`` (permit_num, description_hash, description), one row per call.

    The id follows from the keys in the batch alone. Answers name the permit, so a batch never
    holds two texts of one permit: the label of one text would be taken for the other's.
    """
    # Send this package's functions along: workers may not be able to import them.
    cloudpickle.register_pickle_by_value(lotwise)

    def form(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for several in batched(batches(frames, size), CALLS_PER_FRAME):
            rows = [[[row._asdict() for row in batch]] for batch in several]
            yield pd.DataFrame(rows, columns=["requests"])

    formed = texts.select(*CACHE_KEY, "description").mapInPandas(
        form, "requests array<struct<permit_num string, description_hash string, description string>>"
    )
    keys = F.transform("requests", lambda r: F.concat_ws("\x1f", r["permit_num"], r["description_hash"]))
    return formed.select(F.sha2(F.array_join(F.array_sort(keys), "\x1e"), 256).alias("batch_id"), "requests")


def ask(formed: DataFrame, labeler: Labeler) -> DataFrame:
    """Call the labeler for each batch; its id and requests with the answer or the failure's reason.

    A call that raises leaves its batch without an answer and does not stop the run. Record the
    result before reading it more than once: a second reading would ask again.
    """
    cloudpickle.register_pickle_by_value(lotwise)

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for batch in frame.itertuples(index=False):
                answer, reason = None, None
                try:
                    answer = labeler([(r["permit_num"], r["description"]) for r in batch.requests])
                except Exception as failure:  # the rules cover the batch until the next run
                    reason = f"{type(failure).__name__}: {failure}"
                requests = [{key: r[key] for key in CACHE_KEY} for r in batch.requests]
                rows.append((batch.batch_id, requests, answer, reason))
            yield pd.DataFrame(rows, columns=["batch_id", "requests", "answer", "reason"])

    return formed.mapInPandas(call, ANSWERS)


def match_answers(batches: DataFrame, model: str) -> DataFrame:
    """One row per requested text with its label, or ``is_valid`` false.

    The last answer for a permit counts; an answer with a label outside the lists does not.
    """
    parsed = batches.select(
        "requests", F.from_json("answer", ANSWER_SCHEMA)["classifications"].alias("answers")
    )
    asked = parsed.select("answers", F.explode("requests").alias("r"))
    mine = F.filter("answers", lambda a: a["permit_num"] == F.col("r.permit_num"))
    labelled = asked.select(
        F.col("r.permit_num").alias("permit_num"),
        F.col("r.description_hash").alias("description_hash"),
        F.try_element_at(mine, F.lit(-1)).alias("a"),
    )
    valid = F.col("a.unit_form").isin(V.UNIT_FORMS) & F.col("a.construction_type").isin(V.CONSTRUCTION_TYPES)
    return labelled.select(
        *CACHE_KEY,
        F.col("a.construction_type").alias("construction_type"),
        F.col("a.unit_form").alias("unit_form"),
        F.lit(model).alias("model"),
        F.coalesce(valid, F.lit(False)).alias("is_valid"),
    )


def accepted(matched: DataFrame) -> DataFrame:
    """Valid labels as cache rows, one per key; the store keeps missing values as empty text."""
    valid = matched.filter("is_valid")
    rows = valid.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in V.CACHE_COLUMNS])
    return rows.dropDuplicates(CACHE_KEY)


def upsert(cache: DataFrame, new: DataFrame) -> DataFrame:
    """The cache with new rows added; a new row replaces the one of the same permit and text."""
    return cache.join(new.select(*CACHE_KEY), CACHE_KEY, "left_anti").unionByName(new)


@dataclass(frozen=True)
class LabelRun:
    """Counters of one run, and the most frequent reasons of failed calls with their counts.

    ``resumed`` texts were answered for a run before, which did not come to its end."""

    in_scope: int
    to_label: int
    labelled: int
    failed: int
    cached: int
    reasons: dict[str, int] = field(default_factory=dict, compare=False)
    resumed: int = 0


def refresh(
    population: DataFrame, store: LabelStore, labeler: Labeler | None, model: str, calls_per_commit: int = 1
) -> LabelRun | None:
    """Label what the store does not hold yet, and add the new labels to the store.

    Population, requests and answers are written once. Answers go to a ledger beside the store, task
    by task, ``calls_per_commit`` calls each, and stay there if the run dies: the next run does not ask
    for the same texts again, but takes these answers. A run that ends adds its labels as one delta and
    closes the ledger, so texts without a valid label are asked for again by the next run. Without a
    labeler nothing happens.
    """
    if labeler is None:
        return None
    spark = population.sparkSession
    path = scratch_path(spark, "label-run")
    ledger = Ledger(spark, f"{store.root}/ledger")

    population.write.parquet(f"{path}/population")
    population = spark.read.parquet(f"{path}/population")
    needs_label(population, store.read()).write.parquet(f"{path}/todo")
    todo = spark.read.parquet(f"{path}/todo")
    in_scope, to_label = population.count(), todo.count()
    if to_label == 0:
        ledger.close()
        return LabelRun(in_scope, 0, 0, 0, store.read().count())

    answered = ledger.answers().dropna(subset=["answer"]).select(F.inline("requests"))
    missing = todo.join(answered, CACHE_KEY, "left_anti")
    # Few tasks form the batches, so that few of these are not full.
    forming = min(shuffle_width(spark), -(-to_label // (V.LABEL_BATCH * CALLS_PER_FRAME)))
    form_batches(missing.repartition(forming)).write.parquet(f"{path}/batches")
    formed = spark.read.parquet(f"{path}/batches")
    calls, asked = formed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("requests")), F.lit(0))).first()
    if calls:
        ledger.record(ask(formed.repartition(-(-calls // calls_per_commit)), labeler))

    wanted = todo.select(*CACHE_KEY)
    answers = ledger.answers()
    matched = match_answers(answers, model).join(wanted, CACHE_KEY, "left_semi")
    accepted(matched).write.parquet(f"{path}/labels")
    new = spark.read.parquet(f"{path}/labels")
    labelled = new.count()
    if labelled:
        store.append(new) if store.latest() else store.write(new)
    failures = answers.dropna(subset=["reason"]).groupBy("reason").count().orderBy(F.desc("count"), "reason")
    reasons = {row["reason"]: row["count"] for row in failures.limit(REASONS).collect()}
    ledger.close()
    if store.compact():
        store.remove_old()
    return LabelRun(in_scope, to_label, labelled, to_label - labelled, store.read().count(), reasons, to_label - asked)
