"""Language of a text by error-correcting output codes.

Every learned language has a codeword of +1 and -1 bits. For each bit a linear classifier over
hashed byte n-grams of the lower-cased text tells the languages with +1 from those with -1:
its weights are log ratios of the two groups' mean n-gram frequencies. A text's bits are then
decoded to the language whose codeword loses least. The loss of a bit is exponential, and
weighted by how often that bit is right for that language on calibration rows, so unreliable
bits count less. A text whose two nearest codewords are almost equally near is ``ambiguous``.

Learning counts every labelled text once; one row of counts per task, language and bucket is
shuffled, and ``2**BITS`` buckets per language reach the driver. Scales and weights come from
about ``CALIBRATION_ROWS`` labelled rows, picked by hash of their id.

Null texts, and texts without a letter, are ``und`` with score 0, as is every text if there is
nothing to learn from. Rows without a language teach nothing. Ties go to the first name.
Repeated rows and other columns change nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotwise.llm.common import map_arrow
from lotwise.llm.grams import codes, count_rows
from lotwise.llm.tokens import slices

BITS = 15
SIZES = (2, 3, 4)
SMOOTHING = 0.5
CALIBRATION_ROWS = 2000
CODE_TRIES = 200
AMBIGUOUS_MARGIN = 0.1
UNKNOWN = "und"


def codewords(n: int) -> np.ndarray:
    """``n`` codewords far from each other: the best of seeded random codes, row by language."""
    if n < 2:
        return np.ones((n, 1), np.int8)
    length = max(15, 8 * int(np.ceil(np.log2(n))))
    random, best, widest = np.random.default_rng(7), None, -1
    for _ in range(CODE_TRIES):
        code = random.choice(np.array([-1, 1], np.int8), size=(n, length))
        flat = np.abs(code.sum(axis=0, dtype=int)) == n
        code[0, flat] *= -1
        distance = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if distance > widest:
            best, widest = code, distance
    return best


@dataclass
class Model:
    """Languages, codewords, n-gram weights per bit, scale per bit, weight per language and bit."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    trust: np.ndarray

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """Mean weight of a text's n-grams per bit."""
        parts = []
        for counts in count_rows(texts, SIZES, BITS):
            parts.append(counts @ self.weights / np.maximum(counts.sum(axis=1, keepdims=True), 1))
        return np.concatenate(parts) if parts else np.zeros((0, self.code.shape[1]))

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Weighted exponential loss of every codeword."""
        bent = np.clip(margins / self.scale, -4, 4)
        return (np.exp(-bent[:, None, :] * self.code) * self.trust).sum(axis=2)


def letters(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def _learnable(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())


def _counts(docs: DataFrame) -> DataFrame:
    def run(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = totals.setdefault(lang, np.zeros(1 << BITS, np.int64))
                own += np.bincount(codes(text.lower().encode(), SIZES, BITS), minlength=1 << BITS)
        for lang, own in totals.items():
            full = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(full), pa.string()), pa.array(full), pa.array(own[full])], ["lang", "bucket", "n"])

    rows = map_arrow(_learnable(docs).select("lang", "text"), run, "lang string, bucket long, n long")
    return rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame) -> Model:
    """A model from the rows that have a language."""
    found = _counts(docs).toPandas()
    languages = sorted(found["lang"].unique())
    code = codewords(len(languages))
    counts = np.full((len(languages), 1 << BITS), SMOOTHING)
    place = {lang: i for i, lang in enumerate(languages)}
    counts[found["lang"].map(place).to_numpy(int), found["bucket"].to_numpy(int)] += found["n"].to_numpy()
    shares = counts / counts.sum(axis=1, keepdims=True) if languages else counts
    bits = code.shape[1]
    weights = np.zeros((1 << BITS, bits), np.float32)
    for bit in range(bits if len(languages) > 1 else 0):
        up = code[:, bit] > 0
        weights[:, bit] = np.log(shares[up].mean(axis=0)) - np.log(shares[~up].mean(axis=0))
    model = Model(languages, code, weights, np.ones(bits), np.ones((len(languages), bits)))
    return _calibrated(model, docs) if len(languages) > 1 else model


def _calibrated(model: Model, docs: DataFrame) -> Model:
    rows = _learnable(docs)
    every = max(1, rows.count() // CALIBRATION_ROWS)
    sample = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("lang", "text")

    def run(batches):
        for batch in batches:
            langs, texts = (c.to_pylist() for c in batch.columns)
            for lo, hi in slices(texts):
                margins = model.margins([t.lower().encode() for t in texts[lo:hi]])
                yield pa.RecordBatch.from_arrays([pa.array(langs[lo:hi], pa.string()), pa.array(margins.tolist(), pa.list_(pa.float64()))], ["lang", "margins"])

    seen = map_arrow(sample, run, "lang string, margins array<double>").collect()
    if not seen:
        return model
    margins = np.array([r["margins"] for r in seen])
    truth = np.array([model.languages.index(r["lang"]) for r in seen])
    scale = np.maximum(np.abs(margins).mean(axis=0), 1e-9)
    right = (margins * model.code[truth] > 0).astype(float)
    trust = np.empty(model.code.shape)
    for i in range(len(model.languages)):
        own = right[truth == i]
        trust[i] = (own.sum(axis=0) + 1) / (len(own) + 2)
    trust /= trust.sum(axis=1, keepdims=True)
    return Model(model.languages, model.code, model.weights, scale, trust)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (share of the nearest codeword's likelihood), ambiguous."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in slices([t or "" for t in texts]):
                part = texts[lo:hi]
                known = [i for i, t in enumerate(part) if model.languages and letters(t)]
                names, scores, doubt = [UNKNOWN] * len(part), [0.0] * len(part), [True] * len(part)
                losses = model.losses(model.margins([part[i].lower().encode() for i in known])) if known else []
                for i, loss in zip(known, losses):
                    best = int(np.argmin(loss))
                    chance = np.exp(-4 * (loss - loss[best]))
                    names[i], scores[i] = model.languages[best], float(1 / chance.sum())
                    others = np.delete(loss, best)
                    doubt[i] = bool(len(others)) and bool(others.min() - loss[best] < AMBIGUOUS_MARGIN * others.min())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(doubt, pa.bool_())],
                    ["doc_id", "lang_pred", "score", "ambiguous"],
                )

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double, ambiguous boolean")
