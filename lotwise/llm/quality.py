"""Quality rules: fixed counts, and a log-likelihood ratio of trusted text against the corpus.

Two multinomials over hashed byte n-grams are counted: one over the trusted documents, one over
the whole corpus. A text's score is the mean over its n-grams of log p(trusted) - log p(corpus),
so its length does not matter. The threshold is a fixed rule: a text is rejected if its score
lies below the trusted texts' mean by more than ``SPREADS`` of their standard deviations, and
below 0, where the corpus explains it better than the trusted texts do. Every document meets
the same threshold. Trusted texts are read in full; nothing is sampled.

Trusted texts are moved by one shuffle and stored, then counted and scored from the stored copy.
Else the shuffle holds a row per task and bucket, ``2 * 2**BITS`` sums reach the driver. Without any
trusted text only the fixed rules decide. A null text counts as none: no words, so it fails.
Rows with a null doc_id are never trusted. Repeated rows are each judged; ties cannot arise. An empty
table gives no rows. Very long texts are counted whole, one at a time. Other columns of the tables
are not looked at, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotwise.llm.common import id_filter, map_arrow, passing, written
from lotwise.llm.grams import codes, count_rows
from lotwise.llm.tokens import slices
from lotwise.llm.words import run_hashes, word_hashes

BITS = 15
SIZES = (2, 3, 4)
SMOOTHING = 0.5
SPREADS = 6.0
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
# Fixed values.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
WINDOW_WORDS = 3


@dataclass
class Model:
    """Weight per bucket, and the score below which a text is rejected."""

    weights: np.ndarray
    threshold: float

    def scores(self, texts: list[bytes]) -> list[float]:
        found: list[float] = []
        for counts in count_rows(texts, SIZES, BITS):
            found += (counts @ self.weights / np.maximum(counts.sum(axis=1), 1)).tolist()
        return found


def trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The texts of documents that some label row calls good, moved once and stored.

    The plan is the same at every size: a bitmap of the trusted ids lets few other texts through,
    and both sides of the join are shuffled.
    """
    good = written(labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct(), "trusted-ids")
    bits = id_filter(good)

    def pick(batches):
        for batch in batches:
            yield passing(batch, "hash", bits).select(["doc_id", "text"])

    rows = docs.filter("text IS NOT NULL").select(F.xxhash64("doc_id").alias("hash"), "doc_id", "text")
    likely = map_arrow(rows, pick, "doc_id long, text string")
    return written(likely.join(good.hint("merge"), "doc_id", "leftsemi").select("text"), "trusted-texts")


def _sums(texts: DataFrame) -> np.ndarray:
    """Count of each bucket over all texts."""

    def run(batches):
        total = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(codes(text.encode(), SIZES, BITS), minlength=1 << BITS)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], ["bucket", "n"])

    found = map_arrow(texts, run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.full(1 << BITS, SMOOTHING)
    out[found["bucket"].to_numpy(int)] += found["n"].to_numpy()
    return out


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    good = trusted(docs, labels)
    target = _sums(good)
    if target.sum() <= SMOOTHING * (1 << BITS):
        return Model(np.zeros(1 << BITS, np.float32), -np.inf)
    whole = _sums(docs.filter("text IS NOT NULL").select("text"))
    weights = (np.log(target / target.sum()) - np.log(whole / whole.sum())).astype(np.float32)
    model = Model(weights, -np.inf)

    def run(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in slices(texts):
                found = np.array(model.scores([t.encode() for t in texts[lo:hi]]))
                yield pa.RecordBatch.from_arrays([pa.array([len(found)], pa.int64()), pa.array([found.sum()]), pa.array([(found**2).sum()])], ["n", "s", "s2"])

    n, s, s2 = map_arrow(good, run, "n long, s double, s2 double").agg(F.sum("n"), F.sum("s"), F.sum("s2")).first()
    spread = max(0.0, s2 / n - (s / n) ** 2) ** 0.5
    return Model(weights, min(0.0, s / n - SPREADS * spread))


def counts(text: str, words: np.ndarray) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed of one text."""
    n_words = len(words)
    word_chars = len(text) - sum(text.count(c) for c in SPACES)
    n_symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    runs = run_hashes(words, WINDOW_WORDS)
    n_repeat = 0
    if len(runs):
        _, place, times = np.unique(runs, return_inverse=True, return_counts=True)
        covered = np.zeros(n_words, bool)
        again = np.flatnonzero(times[place] > 1)
        for offset in range(WINDOW_WORDS):
            covered[again + offset] = True
        n_repeat = int(covered.sum())
    failed = n_words < LEAST_WORDS or 100 * n_repeat > MOST_REPEATED_PERCENT * n_words
    return n_words, word_chars, n_symbols, len(lines) - len(set(lines)), n_repeat, failed


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
JUDGED = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double"


def _judgements(texts: list[str], model: Model) -> list[tuple]:
    data = [t.encode() for t in texts]
    words, ends = word_hashes(data)
    begins = np.concatenate([[0], ends[:-1]])
    out = []
    for text, begin, end, score in zip(texts, begins, ends, model.scores(data)):
        *numbers, failed = counts(text, words[begin:end])
        out.append((*numbers, failed, not failed and score >= model.threshold, score))
    return out


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, the fixed counts, base_failed, kept and score of every row."""

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in slices(texts):
                columns = zip(*_judgements(texts[lo:hi], model))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *[pa.array(c) for c in columns]], ["doc_id", *NAMES])

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id long, {JUDGED}")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns, in the pass that judges them."""
    where = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(where).to_pylist()]
            keep = [j[6] for lo, hi in slices(texts) for j in _judgements(texts[lo:hi], model)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return map_arrow(docs, run, docs.schema)
