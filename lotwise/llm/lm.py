"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history). Both factors are maximum-entropy
models (softmax) over the same hashed features of the history: the word before, the two words
before, and the word before the last one alone (a skip). Classes: the end of a text, the
``SINGLES`` most frequent words one by one, and the rest by hash of their last three bytes.

Within a class, a softmax over all its words would cost as many steps as it has words, so it is
factored again: each node tells ``FAN`` children apart. The ``SLOTS`` most frequent words of a
node are children by themselves; all its other words go on by the next bits of their hash, up to
``Tree.levels`` levels. A node's weights are hashed by feature and node; there are more of them,
and more levels, the larger the corpus, up to 2 ** ``INNER_BITS`` rows and ``LEVELS``. Words
that are rarer than all words with a place of their own meet in leaves; there they have their
smoothed share of the leaf, and each leaf has one slot for unknown words. So the probabilities
of all words of the vocabulary and the unknown slots sum to 1.

Training. Word counts cover every training text and give the biases of classes and nodes. The
weights start at zero and are trained in ``ROUNDS`` rounds, each over its share of the training
texts, which together are all of them: every task takes gradient steps over its texts, from the
weights of the round before, and the changes are averaged per feature, weighted by use. Task
results are summed by groups of tasks, level by level, each a limited number of bytes.

Scoring. Words with at least 1 of ``COMMON`` occurrences, so at most ``COMMON`` words, are broadcast
with their counts. Counts of all other words come from one join on the word; their rows carry a
word and a row number, and sums come back per row.

Words are told apart by 64-bit hashes; A-Z is lower-cased. A null text is empty and consists of
its end. Every text has an end, so no text is without a token. Repeated rows are each counted
and scored; other columns are ignored. Without training texts nothing is known: the base gives
each token the probability 1, as does the model.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotwise.llm.common import map_arrow, written
from lotwise.llm.tokens import slices
from lotwise.llm.words import U64, mix, words_and_endings

SINGLES = 31
ENDINGS = 32
CLASSES = 1 + SINGLES + ENDINGS
ROW_BITS = 13
ROWS = 1 << ROW_BITS
# Children of a node within a class: words of their own, and the rest by three bits of their hash.
SLOTS = 8
HASH_BITS = 3
FAN = SLOTS + (1 << HASH_BITS)
LEVELS = 5
INNER_BITS = 17
COMMON = 500_000
ROUNDS = 2
BATCH_TOKENS = 8192
# Equal rows of a batch that are summed step by step; longer runs are summed one by one.
SHORT_RUN = 24
RATE = 0.5
# Words counted by a task before it hands its counts on.
COUNT_WORDS = 1 << 20
FAN_IN = 16
# Tokens of a training task, at least, beyond so many tasks: its result is as large however few texts it has.
TASK_TOKENS = 4_000_000
FEW_TASKS = 8
END = U64(0x5E17D0C5)
BEFORE = U64(0xB0B0)
NODE = U64(0x9E3779B97F4A7C15)
BLOCK_CHARS = 1 << 19


def stream_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens with ends, their ending classes, and where texts end."""
    words, ends, endings = words_and_endings([t.encode().lower() for t in texts])
    tokens = np.insert(words, ends, END)
    group = np.insert((mix(endings.astype(U64)) % U64(ENDINGS)).astype(np.int64) + 1 + SINGLES, ends, 0)
    return tokens, group, ends + np.arange(1, len(ends) + 1)


def features(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of each token's features: word before, two words before, skipped word."""
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    one, two = np.roll(tokens, 1), np.roll(tokens, 2)
    one[begins] = BEFORE
    two[begins] = BEFORE
    second = begins + 1
    two[second[second < len(tokens)]] = BEFORE
    return np.stack([mix(one ^ U64(1)), mix(mix(one) + two), mix(two ^ U64(3))])


def outer_rows(found: np.ndarray) -> np.ndarray:
    """Rows of the class weights, by feature."""
    return (found >> U64(64 - ROW_BITS)).astype(np.uint16)


def _powers(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp of the logits, and its sum per token; where that leaves the range of floats, logits are shifted first."""
    ones = np.ones(logits.shape[1], np.float32)
    with np.errstate(over="ignore", invalid="ignore"):
        powers = np.exp(logits)
        sums = powers @ ones
    if len(sums) and not (sums.min() > 1e-30 and sums.max() < 1e30):
        logits -= logits.max(axis=1, keepdims=True)
        powers = np.exp(logits)
        sums = powers @ ones
    return powers, sums


def _true_powers(logits: np.ndarray, truth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The true one's logit, exp of the logits, and its sum per token; the logits are written over."""
    places = np.arange(len(logits))
    own = logits[places, truth]
    # Then sums lie between exp(-60) and 64 * exp(60).
    if len(own) and own.min() > -60 and logits.max() < 60:
        powers = np.exp(logits, out=logits)
        return own, powers, powers @ np.ones(logits.shape[1], np.float32)
    powers, sums = _powers(logits)
    return logits[places, truth], powers, sums


def _log_share(logits: np.ndarray, truth: np.ndarray) -> np.ndarray:
    """Natural log of the true one's probability, per token; the logits are written over."""
    own, _, sums = _true_powers(logits, truth)
    return own - np.log(sums)


def _slope(logits: np.ndarray, truth: np.ndarray) -> np.ndarray:
    """Probabilities, less 1 for the true one; the logits are written over."""
    _, slope, sums = _true_powers(logits, truth)
    slope *= (1 / sums)[:, None]
    slope[np.arange(len(slope)), truth] -= 1
    return slope


def _gathered(logits: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Logits with the weights of each feature's rows added."""
    part = np.empty_like(logits)
    for row in rows:
        logits += weights.take(row.astype(np.intp), 0, part, "clip")
    return logits


@dataclass
class Tree:
    """The words of the ending classes by levels of nodes.

    ``words``, sorted, are all common words, with counts ``n``. ``depth`` is how many nodes decide
    on the word, ``slot`` its place in the last one, -1 if its hash goes on to a leaf. ``bias``
    has the logs of the children's shares, nodes level by level; ``leaf`` the masses of the leaves.
    """

    levels: int
    words: np.ndarray
    n: np.ndarray
    depth: np.ndarray
    slot: np.ndarray
    bias: np.ndarray
    leaf: np.ndarray
    mass: np.ndarray

    def find(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of tokens among the common words, and whether they are there."""
        if not len(self.words):
            return np.zeros(len(tokens), np.int64), np.zeros(len(tokens), bool)
        # Words are hashes: their first bits nearly tell their places.
        at = self.starts.take((tokens >> U64(64 - self.start_bits)).astype(np.intp))
        left = np.flatnonzero(self.words.take(at) < tokens)
        while len(left):
            left = left[at.take(left) < len(self.words) - 1]
            at[left] += 1
            left = left[self.words.take(at.take(left)) < tokens.take(left)]
        return at, self.words.take(at) == tokens

    @property
    def start_bits(self) -> int:
        return max(1, len(self.words).bit_length())

    @cached_property
    def starts(self) -> np.ndarray:
        """Place of the first word, or of the last one, with at least these first bits."""
        prefixes = np.arange(1 << self.start_bits, dtype=U64) << U64(64 - self.start_bits)
        return np.minimum(np.searchsorted(self.words, prefixes), len(self.words) - 1)

    def paths(self, tokens: np.ndarray, at: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Depth and slot of each token."""
        if not len(self.words):
            return np.full(len(tokens), self.levels, np.int8), np.full(len(tokens), -1, np.int8)
        return np.where(common, self.depth[at], self.levels), np.where(common, self.slot[at], -1)

    def decisions(self, tokens: np.ndarray, ending: np.ndarray, depth: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, ...]:
        """All steps from classes down to words or leaves: places of the tokens, nodes and children."""
        here, steps, before = np.arange(len(tokens)), [], 0
        for level in range(self.levels):
            here = here[depth[here] > level]
            deeper = _node(tokens[here], ending[here], level + 1)
            own = (depth[here] == level + 1) & (slot[here] >= 0)
            child = np.where(own, slot[here], SLOTS + (deeper & (FAN - SLOTS - 1)))
            steps.append((here, before + (deeper >> HASH_BITS), child))
            before += ENDINGS << (HASH_BITS * level)
        return tuple(np.concatenate(c) for c in zip(*steps))


def _node(tokens: np.ndarray, ending: np.ndarray, level: int) -> np.ndarray:
    """Number of the node at a level, below the class and by the first bits of the hash."""
    if not level:
        return ending.astype(np.int64)
    bits = HASH_BITS * level
    return (ending.astype(np.int64) << bits) | (tokens >> U64(64 - bits)).astype(np.int64)


def _tree(words: np.ndarray, ending: np.ndarray, n: np.ndarray, levels: int, leaf: np.ndarray) -> Tree:
    """The tree of common words; ``ending`` is -1 for those that are classes. ``leaf``: masses of all other words."""
    depth, slot = np.zeros(len(words), np.int8), np.full(len(words), -1, np.int8)
    left, slots, leaf = np.flatnonzero(ending >= 0), [], leaf + 0.5
    left = left[np.argsort(-n[left], kind="stable")]
    for level in range(levels):
        children = np.zeros((ENDINGS << (HASH_BITS * level), SLOTS))
        node = _node(words[left], ending[left], level)
        order = np.argsort(node, kind="stable")
        first = np.flatnonzero(np.diff(node[order], prepend=-1))
        rank = np.empty(len(left), np.int64)
        rank[order] = np.arange(len(left)) - np.repeat(first, np.diff(first, append=len(left)))
        own = rank < SLOTS
        children[node[own], rank[own]] = n[left[own]] + 0.5
        depth[left], slot[left[own]] = level + 1, rank[own]
        slots.append(children)
        left = left[~own]
    leaf += np.bincount(_node(words[left], ending[left], levels), weights=n[left] + 0.5, minlength=len(leaf))
    mass, bias = leaf, []
    for children in reversed(slots):
        children = np.concatenate([children, mass.reshape(len(children), FAN - SLOTS)], axis=1)
        mass = children.sum(axis=1)
        # A slot without a word has no share.
        bias.insert(0, np.where(children > 0, np.log(np.maximum(children, 0.5) / mass[:, None]), -1e4).astype(np.float32))
    return Tree(levels, words, n, depth, slot, np.concatenate(bias), leaf, mass)


@dataclass
class Model:
    """Token and vocabulary counts, classes of single words, class sums, the tree, and the weights of classes and nodes."""

    total: int
    vocabulary: int
    singles: np.ndarray
    single_class: np.ndarray
    class_mass: np.ndarray
    tree: Tree
    weights: np.ndarray
    inner: np.ndarray

    def classes(self, tokens: np.ndarray, group: np.ndarray) -> np.ndarray:
        if not len(self.singles):
            return group
        at = np.minimum(np.searchsorted(self.singles, tokens), len(self.singles) - 1)
        return np.where((self.singles[at] == tokens) & (group > 0), self.single_class[at], group)

    def logits(self, rows: np.ndarray) -> np.ndarray:
        """Of every class, per token."""
        logits = np.empty((rows.shape[1], CLASSES), np.float32)
        logits[:] = self.bias
        return _gathered(logits, self.weights, rows)

    def log_shares(self, rows: np.ndarray) -> np.ndarray:
        """Natural log of every class's probability, per token."""
        logits = self.logits(rows)
        sums = _powers(logits)[1]
        return logits - np.log(sums)[:, None]

    @cached_property
    def bias(self) -> np.ndarray:
        return np.log(self.class_mass / self.class_mass.sum()).astype(np.float32)

    def inner_rows(self, found: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Rows of the nodes' weights, by feature."""
        bits = len(self.inner).bit_length() - 1
        return (((found ^ mix(node.astype(U64) + NODE)) * NODE) >> U64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)

    def inner_logits(self, node: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Of every child of the nodes."""
        return _gathered(self.tree.bias.take(node, 0), self.inner, rows)

    def log_words(self, tokens: np.ndarray, truth: np.ndarray, found: np.ndarray, at: np.ndarray, common: np.ndarray) -> np.ndarray:
        """Natural log of P(word | class, history), but for the word's own n + 0.5."""
        own = -np.log(self.class_mass[truth])
        inside = np.flatnonzero(truth > SINGLES)
        tokens, ending, found = tokens[inside], truth[inside] - 1 - SINGLES, found[:, inside]
        depth, slot = self.tree.paths(tokens, at[inside], common[inside])
        below = np.log(self.tree.leaf[_node(tokens, ending, self.tree.levels)])
        if len(self.tree.words):
            below = np.where(slot >= 0, np.log(self.tree.n[at[inside]] + 0.5), below)
        logs = -below
        here, node, child = self.tree.decisions(tokens, ending, depth, slot)
        shares = _log_share(self.inner_logits(node, self.inner_rows(found.take(here, 1), node)), child)
        logs += np.bincount(here, weights=shares, minlength=len(logs))
        own[inside] = logs
        return own


def _counted(docs: DataFrame) -> DataFrame:
    """word, group, n of all tokens of the texts."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged():
            words, group, n = (np.concatenate(c) for c in zip(*held))
            words, first, place = np.unique(words, return_index=True, return_inverse=True)
            return words, group[first], np.bincount(place, weights=n).astype(np.int64)

        def out(words, group, n):
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(group.astype(np.int32)), pa.array(n)], ["word", "group", "n"])

        size = 0
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for lo, hi in slices(texts, BLOCK_CHARS):
                tokens, group, _ = stream_of(texts[lo:hi])
                words, first, n = np.unique(tokens, return_index=True, return_counts=True)
                held.append((words, group[first], n))
                size += len(words)
                if size > COUNT_WORDS:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > COUNT_WORDS // 2:
                        yield out(*held[0])
                        held, size = [], 0
        if held:
            yield out(*merged())

    rows = map_arrow(docs.select("text"), run, "word long, group int, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"), F.min("group").alias("group"))


SUMS = "part int, at binary, use binary, change binary, scale double"


def _add(sums: list[tuple[np.ndarray, np.ndarray]], row: dict) -> None:
    use, change = sums[row["part"]]
    at = np.frombuffer(row["at"], "<u4")
    use[at] += np.frombuffer(row["use"], "<f4")
    change[at] += np.frombuffer(row["change"], "<f2").reshape(-1, change.shape[1]) * np.float32(row["scale"])


def _summed(df: DataFrame, tasks: int, shapes: list[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sums of all tasks' (row, use, change) vectors, by groups of ``FAN_IN`` tasks per level."""

    def zeros():
        return [(np.zeros(shape[0], np.float32), np.zeros(shape, np.float32)) for shape in shapes]

    def run(batches):
        sums = zeros()
        for batch in batches:
            for row in batch.to_pylist():
                _add(sums, row)
        yield from _updates(sums)

    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        df = map_arrow(df.repartition(tasks), run, SUMS)
    sums = zeros()
    for row in df.toLocalIterator():
        _add(sums, row)
    return sums


def _updates(sums: list[tuple[np.ndarray, np.ndarray]]):
    """The used rows of the sums of classes and nodes, in 16-bit floats with one scale each."""
    for part, (use, change) in enumerate(sums):
        at = np.flatnonzero(use)
        change = change[at]
        scale = float(np.abs(change).max()) if len(at) else 1.0
        scale = scale or 1.0
        columns = [at.astype("<u4").tobytes(), use[at].astype("<f4").tobytes(), (change / np.float32(scale)).astype("<f2").tobytes()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), *[pa.array([c], pa.binary()) for c in columns], pa.array([scale])],
            ["part", "at", "use", "change", "scale"],
        )


def _in_order(at: np.ndarray) -> np.ndarray:
    """Places of the values in ascending order, equal ones as they stand; numpy sorts sixteen bits by radix."""
    order = np.argsort(at.astype(np.uint16, copy=False), kind="stable")
    if at.dtype.itemsize > 2:
        order = order.take(np.argsort((at >> 16).astype(np.uint16).take(order), kind="stable"))
    return order


def _put(weights: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Rows of a table replaced, each moved as one item."""
    row = np.dtype((np.void, weights.strides[0]))
    np.put(weights.view(row)[:, 0], at, rows.view(row)[:, 0], "clip")


def _row_sums(slope: np.ndarray, order: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of the slopes of each run of ``order``, step by step for all runs that go on, longest first."""
    sums = slope.take(order.take(first), 0)
    many = np.flatnonzero(n > 1)
    many = many.take(np.argsort((SHORT_RUN - np.minimum(n.take(many), SHORT_RUN)).astype(np.uint8), kind="stable"))
    first, n = first.take(many), n.take(many)
    longer = np.searchsorted(-np.minimum(n, SHORT_RUN), -np.arange(SHORT_RUN))
    part = sums.take(many, 0)
    for step in range(1, SHORT_RUN):
        part[: longer[step]] += slope.take(order.take(first[: longer[step]] + step), 0)
    for run in range(longer[SHORT_RUN - 1]):
        part[run] += slope.take(order[first[run] + SHORT_RUN : first[run] + n[run]], 0).sum(axis=0)
    _put(sums, many, part)
    return sums


def _descend(weights: np.ndarray, use: np.ndarray, rows: np.ndarray, slope: np.ndarray) -> None:
    """One step down the slopes, for the rows of all features."""
    if not len(slope):
        return
    at = rows.ravel()
    order = _in_order(at)
    at = at.take(order)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    n = np.diff(first, append=len(order))
    at = at.take(first).astype(np.intp)
    order %= len(slope)
    sums = _row_sums(slope, order, first, n)
    n = n.astype(np.float32)
    used = use.take(at) + n
    use[at] = used
    # A row's mean slope, with a rate that falls as the row is used.
    sums *= (np.float32(RATE) / np.sqrt(n * (1 + used)))[:, None]
    _put(weights, at, np.subtract(weights.take(at, 0), sums, out=sums))


def _round(docs: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Weights after one pass: the mean of the tasks' changes per row, weighted by use."""

    def run(batches):
        own = replace(model, weights=model.weights.copy(), inner=model.inner.copy())
        use, inner_use = np.zeros(len(own.weights), np.float32), np.zeros(len(own.inner), np.float32)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for lo, hi in slices(texts, BLOCK_CHARS):
                tokens, group, ends = stream_of(texts[lo:hi])
                found, truth = features(tokens, ends), own.classes(tokens, group)
                depth, slot = own.tree.paths(tokens, *own.tree.find(tokens))
                for begin in range(0, len(tokens), BATCH_TOKENS):
                    part = slice(begin, begin + BATCH_TOKENS)
                    rows = outer_rows(found[:, part])
                    _descend(own.weights, use, rows, _slope(own.logits(rows), truth[part]))
                    inside = begin + np.flatnonzero(truth[part] > SINGLES)
                    here, node, child = own.tree.decisions(tokens[inside], truth[inside] - 1 - SINGLES, depth[inside], slot[inside])
                    rows = own.inner_rows(found.take(inside[here], 1), node)
                    _descend(own.inner, inner_use, rows, _slope(own.inner_logits(node, rows), child))
        changes = [(use, (own.weights - model.weights) * use[:, None]), (inner_use, (own.inner - model.inner) * inner_use[:, None])]
        yield from _updates(changes)

    changes = written(map_arrow(docs.select("text"), run, SUMS), "gradients")
    sums = _summed(changes, changes.count() // 2, [model.weights.shape, model.inner.shape])
    return tuple(w + change / np.maximum(use, 1)[:, None] for w, (use, change) in zip((model.weights, model.inner), sums))


def learn(docs: DataFrame) -> tuple[Model, DataFrame]:
    """A model of the texts, and the stored counts of their words."""
    counts = written(_counted(docs), "word-counts")
    whole = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, vocabulary = int(whole[0] or 0), int(whole[1])
    is_common = (F.col("n") * COMMON >= total) | (F.col("group") == 0)
    common = counts.filter(is_common).select("word", "n", "group").toArrow()
    words, n, group = (common.column(i).to_numpy() for i in range(3))
    order = np.argsort(words.view(U64))
    words, n, group = words.view(U64)[order], n[order], group[order].astype(np.int64)
    # At most 1000 words hold a thousandth of all tokens each.
    top = np.flatnonzero((group > 0) & (n * 1000 >= total))
    top = top[np.lexsort((words[top].view(np.int64), -n[top]))][:SINGLES]
    single_class = np.arange(1, len(top) + 1)
    by_hash = np.argsort(words[top])
    ending = np.where(group > SINGLES, group - 1 - SINGLES, -1)
    ending[top] = -1
    # As many leaves as words at most; the tree of a larger vocabulary is deeper.
    levels = 1
    while levels < LEVELS and ENDINGS << (HASH_BITS * (levels + 1)) <= vocabulary:
        levels += 1
    bits = HASH_BITS * levels
    leaf = np.zeros(ENDINGS << bits)
    place = F.shiftleft(F.col("group").cast("long") - 1 - SINGLES, bits) + F.shiftrightunsigned("word", 64 - bits)
    others = counts.filter(~is_common).groupBy(place.alias("leaf")).agg(F.sum(F.col("n") + 0.5).alias("mass")).toArrow()
    leaf[others.column("leaf").to_numpy()] = others.column("mass").to_numpy()
    tree = _tree(words, ending, n.astype(float), levels, leaf)
    mass = np.full(CLASSES, 0.5)
    mass[single_class] += n[top] + 0.5
    mass[0] += (n[group == 0] + 0.5).sum()
    mass[1 + SINGLES :] = tree.mass
    # A row of weights for every 64 tokens, in powers of two.
    rows = 1 << min(INNER_BITS, max(10, (total >> 6).bit_length()))
    model = Model(
        total, vocabulary, words[top][by_hash], single_class[by_hash], mass, tree,
        np.zeros((ROWS, CLASSES), np.float32), np.zeros((rows, FAN), np.float32),
    )
    if total:
        tasks = max(FEW_TASKS, total // (ROUNDS * TASK_TOKENS))
        for number in range(ROUNDS):
            part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)) == number
            model.weights, model.inner = _round(docs.filter(part).coalesce(tasks), model)
    return model, counts


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every row (log10)."""
    log_known = np.log10(model.tree.n + 0.5)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for lo, hi in slices(texts, BLOCK_CHARS):
                tokens, group, ends = stream_of(texts[lo:hi])
                found, truth = features(tokens, ends), model.classes(tokens, group)
                at, is_common = model.tree.find(tokens)
                own = np.empty(len(tokens))
                for begin in range(0, len(tokens), BATCH_TOKENS):
                    part = slice(begin, begin + BATCH_TOKENS)
                    own[part] = _log_share(model.logits(outer_rows(found[:, part])), truth[part])
                    own[part] += model.log_words(tokens[part], truth[part], found[:, part], at[part], is_common[part])
                own /= np.log(10)
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                sums = np.add.reduceat(np.where(is_common, log_known[at] if len(log_known) else 0.0, 0.0), begins)
                known = np.add.reduceat(is_common.astype(np.int64), begins)
                rare = [tokens[a:b][~is_common[a:b]].view(np.int64) for a, b in zip(begins, ends)]
                lengths = np.cumsum([0] + [len(r) for r in rare]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(lo, hi - lo), batch.column("doc_id").slice(lo, hi - lo),
                        pa.array(ends - begins), pa.array(known), pa.array(sums), pa.array(np.add.reduceat(own, begins)),
                        pa.ListArray.from_arrays(lengths, pa.array(np.concatenate(rare))),
                    ],
                    ["row", "doc_id", "n_tokens", "known", "logs", "class_logs", "rare"],
                )

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    schema = "row long, doc_id long, n_tokens long, known long, logs double, class_logs double, rare array<bigint>"
    scored = written(map_arrow(numbered, run, schema), "scores")
    rare = scored.select("row", F.explode("rare").alias("word")).join(counts.select("word", "n"), "word", "left")
    sums = rare.groupBy("row").agg(F.count("n").alias("rare_known"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_logs"))
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    nothing = log10(model.total + 0.5 * (model.vocabulary + 1))
    base = logs - F.col("n_tokens") * F.lit(nothing)
    return scored.drop("rare").join(sums, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        base.alias("base_score"), (logs + F.col("class_logs") if model.total else base).alias("score"),
    )
