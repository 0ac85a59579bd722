"""Toxic passages by maximum-scoring segments over token log-odds.

Tokens are maximal runs of letters, lower-cased, told apart by 64-bit hashes. From labelled texts
a token gets the log-odds of toxic against clean texts that hold it, under a Dirichlet prior of
as many texts as there are toxic ones, spread over the tokens as in all labelled texts. It scores
the lower end of its log-odds, ``SURENESS`` standard deviations down, so rare tokens score little.
Tokens whose lower end is at least ``LEAST`` form the lexicon; at most ``LEXICON`` of them, the
best, are the model that every task holds. All other tokens share one score below 0: a passage
survives about ``GAP`` of them per lexicon token. The k-th time that a text uses a lexicon token,
that token scores a k-th part, so a text that repeats one word is no evidence of its own.

A linear scan finds every maximal scoring segment of a text. The segments of clean labelled texts
give the constants of the extreme-value distribution, by which a segment has the probability that
a clean text of the same length holds one as good. A passage is significant, and returned, at
``SIGNIFICANT`` or less. The evidence of all segments of a text together (sum statistics) becomes
the score, a probability, by a logistic curve fitted on the labelled texts. Wherever a labelled
text is itself scored for these fits, its own share is taken out of the token counts.

Work. Labelled texts are joined with their labels by a shuffle whatever the sizes, and stored once.
Token counts, fits and scoring are passes in Arrow batches. The shuffle of counts holds a row per
batch and distinct token. What reaches the driver is the lexicon, the sums behind the two constants
and a histogram of ``BINS`` bins, whatever the size of the corpus.

Defined results. Null, empty and letterless texts have no token and no passage; their score is the
curve's value at no evidence. A document with several label rows is toxic if any says so; null
labels and null ids teach nothing. Repeated rows are each learned and scored. Without a toxic or
without a clean text there is no lexicon, and every score is the share of toxic texts, 0 if there
are no labels at all. Very long texts are scanned whole, in linear time. Ties of the lexicon's last
place go to the smaller hash. Other columns of the given tables are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotwise.llm.common import map_arrow, written
from lotwise.llm.segments import SUMS, Chance, chance_sums, fit_chance, maximal_segments
from lotwise.llm.tokens import slices
from lotwise.llm.words import BYTE_VALUE, U64, _place_factor, mix

SURENESS = 2.0
LEAST = 0.5
LEXICON = 1 << 18
GAP = 12
SIGNIFICANT = 0.01
BINS, BIN_WIDTH = 256, 0.25
SLICE_CHARS = 1 << 19

LETTER = np.zeros(256, bool)
LETTER[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
# Texts whose characters beyond ASCII are all Latin letters need no search for other characters.
PLAIN = re.compile(r"[\x00-\x7FÀ-ÖØ-öø-ɏ]*")
NO_LETTER = re.compile(r"[\W\d_]")


def lowered(text: str) -> bytes:
    """Lower case, character by character, with a space for what is no letter beyond ASCII."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    if not PLAIN.fullmatch(low):
        low = NO_LETTER.sub(" ", low)
    return low.encode()


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all tokens in order: hash, first byte and byte behind the last one; and where the tokens
    and the bytes of each text begin, the end of the last included. Texts are one byte apart."""
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    buffer = np.frombuffer(b" ".join(texts), np.uint8)
    at = np.flatnonzero(LETTER[buffer])
    if not len(at):
        none = np.zeros(0, np.int64)
        return np.zeros(0, U64), none, none, np.zeros(len(starts), np.int64), starts
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    lengths = np.diff(first, append=len(at))
    place = np.arange(len(at)) - np.repeat(first, lengths)
    sums = np.add.reduceat(BYTE_VALUE[buffer[at]] * _place_factor(place), first)
    begin = at[first]
    return mix(sums + lengths.astype(U64)), begin, begin + lengths, np.searchsorted(begin, starts), starts


def log_odds(toxic: np.ndarray, clean: np.ndarray, share: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """The lower end of the log-odds of tokens in so many toxic and clean texts; 0 if it is below
    ``LEAST`` or no toxic text holds the token. ``share`` is the tokens' share of all labelled texts."""
    prior = n_toxic * share
    a, b = toxic + prior, clean + prior
    with np.errstate(divide="ignore", invalid="ignore"):
        odds = np.log(a / (2 * n_toxic - a + 1)) - np.log(b / (n_clean + n_toxic - b + 1))
        low = odds - SURENESS * np.sqrt(1 / a + 1 / b)
    return np.where((toxic > 0) & (b > 0) & (low >= LEAST), low, 0.0)


def repeats(items: np.ndarray) -> np.ndarray:
    """For each item, how often it has occurred so far, itself included."""
    order = np.argsort(items, kind="stable")
    ordered = items[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    times = np.empty(len(items), np.int64)
    times[order] = np.arange(len(items)) - np.repeat(first, np.diff(first, append=len(items))) + 1
    return times


@dataclass
class Model:
    """Lexicon (hashes in order, their counts and scores), chance, and the score's curve."""

    n_toxic: int = 0
    n_clean: int = 0
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    clean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    gap_score: float = -1.0
    chance: Chance = Chance()
    curve: tuple[float, float] | None = None

    def __post_init__(self):
        self.share = (self.toxic + self.clean) / max(self.n_toxic + self.n_clean, 1)
        self.scores = self._scores(self.toxic, self.clean) if len(self.hashes) else np.zeros(0)

    def _scores(self, toxic: np.ndarray, clean: np.ndarray, at=slice(None)) -> np.ndarray:
        return log_odds(toxic, clean, self.share[at], self.n_toxic, self.n_clean)

    def without(self, at: np.ndarray, label: int) -> np.ndarray:
        """Scores of a labelled text's lexicon tokens with that text taken out of the counts."""
        return self._scores(self.toxic[at] - label, self.clean[at] - (1 - label), at)

    def probability(self, evidence: float) -> float:
        if self.curve is None:
            return self.n_toxic / max(self.n_toxic + self.n_clean, 1)
        base, slope = self.curve
        return 1.0 / (1.0 + exp(-max(-700.0, min(700.0, base + slope * evidence))))

    def segments(self, texts: list[bytes], labels: list[int] | None = None):
        """For each text: its number of tokens, its segments as (first byte, end byte, score) from
        the text's own start, and -ln of the probability of all of them together."""
        hashes, begin, end, bounds, starts = tokens(texts)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hits = np.flatnonzero(self.hashes[at] == hashes)
        else:
            at = hits = np.zeros(0, np.int64)
        cuts = np.searchsorted(hits, bounds)
        for i in range(len(texts)):
            n, mine = int(bounds[i + 1] - bounds[i]), hits[cuts[i] : cuts[i + 1]]
            if not len(mine):
                yield n, [], 0.0
                continue
            scores = self.scores[at[mine]] if labels is None else self.without(at[mine], labels[i])
            # A score of 0 may be the text's own token taken out: an ordinary token after all.
            scores = np.where(scores > 0, scores / repeats(at[mine]), self.gap_score)
            found = maximal_segments((mine - bounds[i]).tolist(), scores.tolist(), self.gap_score)
            spans = [(int(begin[mine[f]] - starts[i]), int(end[mine[t]] - starts[i]), s) for f, t, s in found]
            yield n, spans, self.chance.evidence([s for *_, s in found], n)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text`` and ``toxic`` (0 or 1) of every labelled row, stored. Only ids, labels and labelled
    texts are written; the join shuffles at every size."""
    marks = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
        .agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter("doc_id IS NOT NULL")
    return written(texts.join(marks.hint("merge"), "doc_id").select("text", "toxic"), "labelled-texts")


def _token_counts(rows: DataFrame) -> DataFrame:
    """Toxic and clean labelled texts by token."""

    def run(batches):
        for batch in batches:
            texts, toxic = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            parts = []
            for lo, hi in slices(texts, SLICE_CHARS):
                hashes, _, _, bounds, _ = tokens([lowered(t) for t in texts[lo:hi]])
                text = np.repeat(np.arange(hi - lo), np.diff(bounds))
                order = np.lexsort((text, hashes))
                hashes, text = hashes[order], text[order]
                once = np.concatenate([[True], (np.diff(hashes) != 0) | (np.diff(text) != 0)]) if len(hashes) else np.zeros(0, bool)
                parts.append((hashes[once], toxic[lo:hi][text[once]]))
            hashes = np.concatenate([h for h, _ in parts]) if parts else np.zeros(0, U64)
            marks = np.concatenate([m for _, m in parts]) if parts else np.zeros(0, np.int32)
            found, place = np.unique(hashes, return_inverse=True)
            n = np.bincount(place, minlength=len(found))
            y = np.bincount(place, weights=marks, minlength=len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(y), pa.array(n - y)], ["token", "toxic", "clean"])

    counts = map_arrow(rows, run, "token long, toxic long, clean long")
    return counts.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _lexicon(counts: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """The best tokens that have a score, or would without one of their clean texts."""

    def run(batches):
        for batch in batches:
            toxic, clean = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            share = (toxic + clean) / (n_toxic + n_clean)
            low = np.maximum(
                log_odds(toxic, clean, share, n_toxic, n_clean),
                log_odds(toxic, np.maximum(clean - 1, 0), share, n_toxic, n_clean),
            )
            keep = pa.array(low > 0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).filter(keep) for i in range(3)), pa.array(low[low > 0])], ["token", "toxic", "clean", "low"]
            )

    found = map_arrow(counts.filter("toxic > 0"), run, "token long, toxic long, clean long, low double")
    return found.orderBy(F.desc("low"), "token").limit(LEXICON).select("token", "toxic", "clean")


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the rows of ``docs`` that ``labels`` (doc_id, toxic) has a mark for."""
    rows = labelled(docs, labels)
    n, n_toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < n_toxic < n:
        return Model(n_toxic, n - n_toxic)
    found = _lexicon(_token_counts(rows), n_toxic, n - n_toxic).toPandas()
    found["hash"] = found["token"].to_numpy().view(U64)
    found = found.sort_values("hash")
    lexicon = [found[c].to_numpy(t) for c, t in (("hash", U64), ("toxic", float), ("clean", float))]
    model = Model(n_toxic, n - n_toxic, *lexicon)
    if not len(found):
        return model
    weight = (model.toxic + model.clean) * (model.scores > 0)
    mean = (weight * model.scores).sum() / weight.sum() if weight.any() else LEAST
    model.gap_score = -float(mean) / GAP
    model.chance = _fitted_chance(rows, model)
    model.curve = _fitted_curve(rows, model)
    return model


def _fitted_chance(rows: DataFrame, model: Model) -> Chance:
    """The extreme-value constants from the best segments of clean labelled texts."""

    def run(batches):
        total = np.zeros(SUMS)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in slices(texts, SLICE_CHARS):
                seen = list(model.segments([lowered(t) for t in texts[lo:hi]], [0] * (hi - lo)))
                best = np.array([max((s for *_, s in spans), default=0.0) for _, spans, _ in seen])
                total += chance_sums(best, np.array([max(n, 1) for n, *_ in seen], float))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"])

    sums = map_arrow(rows.filter("toxic = 0").select("text"), run, "place long, value double")
    sums = sums.groupBy("place").agg(F.sum("value").alias("value")).toPandas()
    total = np.zeros(SUMS)
    total[sums["place"].to_numpy(int)] = sums["value"]
    return fit_chance(total)


def _fitted_curve(rows: DataFrame, model: Model) -> tuple[float, float]:
    """The logistic curve from evidence to label, over a histogram of all labelled texts."""

    def run(batches):
        table = np.zeros((2, BINS), np.int64)
        for batch in batches:
            texts, toxic = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in slices(texts, SLICE_CHARS):
                seen = model.segments([lowered(t) for t in texts[lo:hi]], toxic[lo:hi])
                for label, (_, _, evidence) in zip(toxic[lo:hi], seen):
                    table[label, evidence_bin(evidence)] += 1
        place = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(table.ravel()[place])], ["place", "n"])

    counts = map_arrow(rows, run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(2 * BINS)
    table[counts["place"].to_numpy(int)] = counts["n"]
    return logistic(np.arange(BINS) * BIN_WIDTH, *table.reshape(2, BINS))


def evidence_bin(evidence: float) -> int:
    return min(int(evidence / BIN_WIDTH + 0.5), BINS - 1)


def logistic(x: np.ndarray, clean: np.ndarray, toxic: np.ndarray, weight: float = 0.5) -> tuple[float, float]:
    """Base and slope of the most likely curve through counted points, held by a weak prior: half a
    text of each label at both ends. A slope below 0 is taken as 0."""
    clean, toxic = clean.copy(), toxic.copy()
    clean[[0, -1]] += weight * 0.02, weight * 0.02
    toxic[[0, -1]] += weight * 0.02, weight * 0.02
    n, points = clean + toxic, np.stack([np.ones_like(x), x])
    at, step = np.zeros(2), np.zeros(2)

    def loss(b: np.ndarray) -> float:
        z = b @ points
        return float((n * np.logaddexp(0, z) - toxic * z).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(at @ points, -500, 500)))
        slope = points @ (toxic - n * p)
        bend = (points * (n * p * (1 - p))) @ points.T + 1e-9 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        while loss(at + step) > loss(at) + 1e-12 and np.abs(step).max() > 1e-12:
            step /= 2
        at = at + step
        if np.abs(step).max() < 1e-10:
            break
    if at[1] < 0:
        return float(np.log(toxic.sum() / clean.sum())), 0.0
    return float(at[0]), float(at[1])


PASSAGES = "array<struct<start: int, end: int, score: double, p_value: double>>"


def _characters(data: bytes, spans: list[tuple[int, int, float]]) -> list[tuple[int, int]]:
    """Byte places as places of characters."""
    if data.isascii():
        return [(b, e) for b, e, _ in spans]
    count = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
    return [(int(count[b]), int(count[e])) for b, e, _ in spans]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, evidence, score, predicted and passages of every row.

    A passage is a significant segment: its first character, the one behind its last, its score
    and the probability that a clean text of this length holds one as good."""

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in slices(texts, SLICE_CHARS):
                data = [lowered(t) for t in texts[lo:hi]]
                rows = []
                for text, (n, spans, evidence) in zip(data, model.segments(data)):
                    p_values = [exp(-model.chance.surprise(s, n)) for *_, s in spans]
                    telling = [(span, p) for span, p in zip(spans, p_values) if p <= SIGNIFICANT]
                    places = _characters(text, [span for span, _ in telling])
                    passages = [
                        {"start": b, "end": e, "score": span[2], "p_value": p} for (b, e), (span, p) in zip(places, telling)
                    ]
                    rows.append((n, evidence, model.probability(evidence), passages))
                n, evidence, chance, passages = map(list, zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(evidence, pa.float64()),
                        pa.array(chance, pa.float64()), pa.array([int(p >= 0.5) for p in chance], pa.int32()),
                        pa.array(passages, pa.list_(pa.struct(
                            [("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("p_value", pa.float64())]
                        ))),
                    ],
                    ["doc_id", "n_tokens", "evidence", "score", "predicted", "passages"],
                )

    columns = f"doc_id long, n_tokens long, evidence double, score double, predicted int, passages {PASSAGES}"
    return map_arrow(docs.select("doc_id", "text"), run, columns)
