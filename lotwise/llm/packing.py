"""Best-fit packing by a configuration linear program over the histogram of lengths.

A configuration is a multiset of lengths that fit into one sequence. The program asks for the
fewest configurations that cover every length as often as it occurs. It is solved approximately
by multiplicative weights: lengths that are covered too little so far gain weight, a knapsack
dynamic program prices the best configuration around every length under these weights, and
their average over all rounds is the fractional solution. Rounding takes whole copies of the
fullest configurations first, as long as lengths remain, and fits the rest best-fit decreasing.

All of that sees at most ``capacity`` lengths with counts, however many documents there are.
Pieces find their place by rank: the r-th piece of a length takes the r-th slot of that length.
Ranks come from counts per (length, bucket) and a row number within each, so a frequent length
is spread over as many groups as there are shuffle partitions.

A null text is empty and holds the end id alone. Rows that share an id are packed each for itself;
which of two equal pieces takes which slot does not show. Other columns are ignored. An empty
table gives no pieces.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lotwise.llm.common import map_arrow, width, written
from lotwise.llm.tokens import ENCODED_CHARS, encoder, end_marked, slices

# Texts that wait in a worker, and in the JVM beside it, for the encoder, which is large itself.
WAITING_BYTES = 2 * ENCODED_CHARS

ROUNDS = 40
STEP = 0.5
# A configuration emptier than this is left to best fit.
FULL = 0.998

Pattern = tuple[tuple[int, int], ...]


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best total price for each capacity with any number of each length, and the length last added (-1: none)."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(int(lengths[0]), capacity + 1):
        fit = np.searchsorted(lengths, room, side="right")
        value = best[room - lengths[:fit]] + prices[:fit]
        top = int(np.argmax(value))
        if value[top] > best[room - 1]:
            best[room], choice[room] = value[top], top
        else:
            best[room] = best[room - 1]
    return best, choice


def _traced(lengths: np.ndarray, choice: np.ndarray, best: np.ndarray, room: int) -> Counter:
    found: Counter = Counter()
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            length = int(lengths[choice[room]])
            found[length] += 1
            room -= length
    return found


def fractional(counts: dict[int, int], capacity: int) -> dict[Pattern, float]:
    """Copies of each configuration, by multiplicative weights on lengths."""
    lengths = np.array(sorted(counts))
    demand = np.array([counts[length] for length in lengths.tolist()], float)
    place = {length: i for i, length in enumerate(lengths.tolist())}
    # Prices start at the length: then a configuration's price is the room it uses.
    weight, covered, copies = lengths / capacity, np.zeros(len(lengths)), Counter()
    for done in range(1, ROUNDS + 1):
        best, choice = knapsack(lengths, weight, capacity)
        for i in np.argsort(covered / demand, kind="stable").tolist():
            missing = demand[i] * done - covered[i]
            if missing <= 0:
                continue
            items = _traced(lengths, choice, best, capacity - int(lengths[i]))
            items[int(lengths[i])] += 1
            pattern = tuple(sorted(items.items(), reverse=True))
            amount = min(missing / items[int(lengths[i])], min(2 * demand[place[x]] / k for x, k in pattern))
            copies[pattern] += amount
            for x, k in pattern:
                covered[place[x]] += amount * k
        weight = (lengths / capacity) * np.exp(-STEP * np.clip(covered / (demand * done) - 1, -2, 2))
    return {pattern: amount / ROUNDS for pattern, amount in copies.items()}


def best_fit(counts: dict[int, int], capacity: int) -> Counter:
    """Best-fit decreasing on counts: equal bins are filled together."""
    rooms: list[int] = []
    bins: dict[int, Counter] = {}

    def put(pattern: Pattern, number: int) -> None:
        room = capacity - sum(x * k for x, k in pattern)
        if room not in bins:
            bins[room] = Counter()
            insort(rooms, room)
        bins[room][pattern] += number

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                if left >= each:
                    put(((length, each),), left // each)
                    left %= each
                else:
                    put(((length, left),), 1)
                    left = 0
                continue
            room = rooms[at]
            pattern, number = bins[room].popitem()
            each = min(room // length, left)
            take = min(number, left // each)
            if number > take:
                bins[room][pattern] += number - take
            if not bins[room]:
                del bins[room]
                rooms.pop(at)
            put((*pattern, (length, each)), take)
            left -= take * each
    return sum((Counter(b) for b in bins.values()), Counter())


def rounded(counts: dict[int, int], solution: dict[Pattern, float], capacity: int) -> list[tuple[Pattern, int]]:
    """Whole configurations that hold every length exactly as often as it occurs."""
    left, chosen = Counter(counts), Counter()
    used = {pattern: sum(x * k for x, k in pattern) for pattern in solution}
    order = sorted(solution, key=lambda p: (-used[p], -solution[p], p))
    for bound in (True, False):
        for pattern in order:
            if used[pattern] < FULL * capacity:
                break
            most = min(left[x] // k for x, k in pattern)
            number = min(most, int(solution[pattern])) if bound else most
            if number:
                chosen[pattern] += number
                for x, k in pattern:
                    left[x] -= number * k
    chosen += best_fit({x: n for x, n in left.items() if n}, capacity)
    return sorted(chosen.items(), reverse=True)


def configurations(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """The chosen configurations and their numbers: the rounded program, or best fit if that is fewer."""
    if not counts:
        return []
    own = rounded(counts, fractional(counts, capacity), capacity)
    plain = sorted(best_fit(counts, capacity).items(), reverse=True)
    return min(own, plain, key=lambda chosen: sum(n for _, n in chosen))


def slots(chosen: list[tuple[Pattern, int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length, in order of rank: first rank, first sequence, pieces per sequence, first offset."""
    table: dict[int, list[list[int]]] = {}
    sequence = 0
    for pattern, number in chosen:
        offset = 0
        for length, each in pattern:
            rows = table.setdefault(length, [])
            first = rows[-1][0] + rows[-1][4] if rows else 0
            rows.append([first, sequence, each, offset, number * each])
            offset += length * each
        sequence += number
    return {length: tuple(np.array(rows).T) for length, rows in table.items()}


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids: 16-bit if all fit, else 32-bit. Only the first piece may be short."""

    def run(batches):
        encode = encoder(tokenizer).encode
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in slices(texts, ENCODED_CHARS, 2000):
                rows = []
                for doc_id, packed in zip(doc_ids[lo:hi], encode(texts[lo:hi])):
                    ids = np.frombuffer(end_marked(packed, end_id), "<u4")
                    ids = ids.astype("<u2") if ids.max() < 1 << 16 else ids
                    begin, end, number = 0, len(ids) % capacity or capacity, 0
                    while begin < len(ids):
                        rows.append((doc_id, number, begin, end - begin, ids[begin:end].tobytes()))
                        begin, end, number = end, end + capacity, number + 1
                columns = zip(*rows)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "piece", "start", "length", "ids"]
                )
            # Not beside the next batch.
            del batch, texts

    schema = "doc_id long, piece int, start long, length long, ids binary"
    return map_arrow(docs.select("doc_id", "text"), run, schema, remembers=True, batch_bytes=WAITING_BYTES)


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids (32-bit), sequence_id, offset."""
    spread = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(width(docs.sparkSession))).cast("int")
    rows = written(pieces(docs, tokenizer, end_id, capacity).withColumn("bucket", spread), "pieces")
    counted = written(rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(configurations(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # One shuffle of the ids, by (length, bucket), serves the row numbers and the join. The sums grow
    # with the width of the shuffle: they are shuffled too, not broadcast.
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids")
    ranked = (
        rows.withColumn("place", F.row_number().over(within) - 1)
        .join(bases.hint("merge"), ["length", "bucket"])
        .select("doc_id", "piece", "start", "length", "ids", (F.col("before") + F.col("place")).alias("rank"))
    )

    def run(batches):
        for batch in batches:
            lengths, ranks = (batch.column(c).to_pylist() for c in ("length", "rank"))
            sequences, offsets, ids = [], [], []
            for length, rank, packed in zip(lengths, ranks, batch.column("ids").to_pylist()):
                first, sequence, each, offset, _ = table[length]
                i = int(np.searchsorted(first, rank, side="right")) - 1
                whole, part = divmod(rank - int(first[i]), int(each[i]))
                sequences.append(int(sequence[i]) + whole)
                offsets.append(int(offset[i]) + part * length)
                ids.append(np.frombuffer(packed, f"<u{len(packed) // length}").astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(ids, pa.binary()), pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"],
            )

    schema = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
    return map_arrow(ranked, run, schema)
