"""Spelling variants of words by a trie of letter-group counts, searched with a budget of one each.

Letters are put in ``GROUPS`` groups by code point. A word's vector says how often it uses each
group. Inserting a letter adds one to one count, deleting takes one, replacing does both or neither:
two words that differ by one edit have vectors with a surplus of at most one and a deficit of at most
one. The trie arranges words by their counts, one group per level. A word is looked up depth-first
from the root: at every level it follows its own count, or the next higher one for the surplus, or
the next lower one for the deficit, and both are spent at most once. The words at the leaves it
reaches are compared letter by letter.

Work. Words are counted in the tasks that read the texts, then by a shuffle. The trie is shared out by
its first ``depth`` levels: each of its subtrees, named by these counts, belongs to one group of a
shuffle. A word is sent to its own subtree, as a resident, and to those subtrees behind it in order
that it can reach, as a visitor with what it has left to spend. Every near pair meets exactly once,
or twice if both live in one subtree, where each looks for the other. A subtree is searched for many
words at a time, level by level, in slices. ``depth`` is the least at which no subtree has more words
than an even share of the shuffle's partitions, or than ``SUBTREE``; it is measured, so subtrees stay
small however large the vocabulary. What leaves a
subtree is a row per word with the number of its near words there and the most frequent of them:
pairs are never listed. Forms are followed by joins of words that have one; each form is ten times as
frequent as the word before, so their number is bounded by the logarithm of the largest count.

Defined results. Null and empty texts have no words. Repeated rows count twice, each with its own id; a
null id counts as the empty text. Words of any length are handled; very long words are compared one
by one. Ties between equally frequent near words go to the smallest word in code-point order. An empty
table gives no rows. Other columns of the table are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from math import ceil, log2
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

import lotwise
from lotwise.llm.common import LETTERS_LOW, LETTERS_UP, map_arrow, width, written

# What a run of letters is, and which runs lose a letter.
RUN_LETTERS = "A-Za-zÀ-ÿ"
DAMAGED_OF = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
TIMES_AS_FREQUENT = 10

GROUPS = 16
# Levels of the trie, groups that vary most from word to word first: e u, a q, i y, n, c s, ...
LEVELS = (5, 1, 9, 14, 3, 4, 2, 15, 12, 8, 13, 7, 11, 0, 6, 10)
SUBTREE = 50_000
# Subtrees of fewer words than this are not divided for the sake of even shares.
SMALL_SUBTREE = 1_000
SLICE = 4096
SHORT = 32
# Letters compared at once.
COMPARED = 1 << 23
LOWER = str.maketrans(LETTERS_UP, LETTERS_LOW)


# Words and their counts


def runs_of(text: str, doc_id: str, pattern: re.Pattern):
    """The words that a text adds, one by one: its runs, some with a letter missing."""
    begin = crc32(f"{doc_id}:".encode())
    for run in pattern.findall(text.translate(LOWER)):
        h = crc32(run.encode(), begin)
        if h % DAMAGED_OF == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        yield run


def counted_words(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of every word that is long and frequent enough."""
    pattern = re.compile(f"[{RUN_LETTERS}]{{{LEAST_LENGTH},}}")

    def run(batches):
        for batch in batches:
            counts: Counter[str] = Counter()
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.update(runs_of(text, "" if doc_id is None else str(doc_id), pattern))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )

    rows = docs.filter("text IS NOT NULL").select("doc_id", "text")
    return map_arrow(rows, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


# The trie


def group_counts(words: list[bytes]) -> np.ndarray:
    """Letter-group counts of words in Latin-1, a row per word, in the order of the levels."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer(b"".join(words), np.uint8)
    row = np.repeat(np.arange(len(words)), lengths)
    flat = np.bincount(row * GROUPS + letters % GROUPS, minlength=len(words) * GROUPS)
    return flat.reshape(-1, GROUPS)[:, list(LEVELS)]


def reachable(trunk: tuple[int, ...]) -> list[tuple[tuple[int, ...], int, int]]:
    """The subtrees behind a word's own that it can reach, with the surplus and deficit left."""
    out = []
    for i in range(len(trunk)):
        one = [*trunk]
        one[i] += 1
        out.append((tuple(one), 0, 1))
        if trunk[i]:
            one[i] -= 2
            for j in range(len(trunk)):
                if j != i:
                    two = [*one]
                    two[j] += 1
                    out.append((tuple(two), 0, 0))
            out.append((tuple(one), 1, 0))
    return [o for o in out if o[0] > trunk]


class Subtree:
    """Sorted vectors of the words of a subtree, and for each level the nodes below every node."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.lexsort(vectors.T[::-1]) if vectors.shape[1] else np.arange(len(vectors))
        rows = vectors[self.order]
        node, self.levels = np.zeros(len(rows), np.int64), []
        for level in range(rows.shape[1]):
            counts = rows[:, level]
            width = int(counts.max(initial=0)) + 3
            keys = node * width + counts + 1
            fresh = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
            self.levels.append((width, keys[fresh]))
            node = np.cumsum(fresh) - 1
        leaves = int(node[-1]) + 1 if len(node) else 0
        self.leaf_begin = np.searchsorted(node, np.arange(leaves + 1))

    def search(self, vectors: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``vectors``, word of the subtree) whose vectors lie within the budget."""
        who, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        for level, (width, keys) in enumerate(self.levels):
            count = vectors[who, level]
            parts = []
            for change, may in ((0, None), (1, surplus), (-1, deficit)):
                pick = np.arange(len(who)) if may is None else np.flatnonzero(may > 0)
                wanted = count[pick] + change
                # Counts beyond the level's own stand for no child, and must not reach the next node's.
                inside = (wanted >= 0) & (wanted <= width - 3)
                pick, wanted = pick[inside], wanted[inside]
                key = node[pick] * width + wanted + 1
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                pick, at = pick[hit], at[hit]
                parts.append((who[pick], at, surplus[pick] - (change == 1), deficit[pick] - (change == -1)))
            who, node, surplus, deficit = (np.concatenate(p) for p in zip(*parts))
        begin = self.leaf_begin[node]
        size = self.leaf_begin[node + 1] - begin
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return np.repeat(who, size), self.order[np.repeat(begin, size) + inside]


class Letters:
    """Words in Latin-1 as rows of letters; those up to ``SHORT`` letters lie ready."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.short = np.array([w[:SHORT] for w in words], dtype=f"S{SHORT}").view(np.uint8).reshape(len(words), SHORT)

    def rows(self, at: np.ndarray, width: int) -> np.ndarray:
        if width <= SHORT:
            return self.short[at, :width]
        return np.array([self.words[i] for i in at.tolist()], dtype=f"S{width}").view(np.uint8).reshape(len(at), width)


def one_edit(words: Letters, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of words differ by exactly one letter put in, taken out or replaced."""
    gap = words.lengths[left] - words.lengths[right]
    near = np.zeros(len(left), bool)
    todo = np.flatnonzero(np.abs(gap) <= 1)
    # Pairs of similar lengths together, as wide as the longest of them.
    widths = np.maximum(words.lengths[left[todo]], words.lengths[right[todo]])
    order = np.argsort(widths, kind="stable")
    todo, widths = todo[order], widths[order]
    while len(todo):
        many = max(1, int(np.searchsorted(widths * np.arange(1, len(widths) + 1), COMPARED)))
        part, width = todo[:many], int(widths[min(many, len(widths)) - 1])
        todo, widths = todo[many:], widths[many:]
        x, y, g = words.rows(left[part], width), words.rows(right[part], width), gap[part]
        replaced = g == 0
        near[part[replaced]] = (x[replaced] != y[replaced]).sum(axis=1) == 1
        for sign, longer, shorter in ((1, x, y), (-1, y, x)):
            rows = g == sign
            lo, sh = longer[rows], shorter[rows]
            if len(lo):
                head = np.argmax(lo != sh, axis=1)
                moved = (lo[:, 1:] == sh[:, :-1]) | (np.arange(width - 1) < head[:, None])
                near[part[rows]] = moved.all(axis=1)
    return near


def _best(n: np.ndarray, rank: np.ndarray, who: np.ndarray, near: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Per word the number of its near words, and the most frequent of them, the first on ties."""
    times = np.bincount(who, minlength=size)
    best = np.full(size, -1)
    order = np.lexsort((rank[near], -n[near], who))
    first = np.unique(who[order], return_index=True)[1]
    best[who[order][first]] = near[order][first]
    return times, best


def subtree_rows(words: list[str], n: np.ndarray, surplus: np.ndarray, deficit: np.ndarray, resident: np.ndarray, depth: int):
    """(index of a word, number of near words found here, index of the best of them) of one subtree."""
    data = [w.encode("latin-1") for w in words]
    vectors = group_counts(data)[:, depth:]
    at_home = np.flatnonzero(resident)
    tree = Subtree(vectors[at_home])
    letters, pairs = Letters(data), []
    # Neighbours in the trie's own order walk the same branches.
    order = np.lexsort(vectors.T[::-1]) if vectors.shape[1] else np.arange(len(words))
    for begin in range(0, len(order), SLICE):
        part = order[begin : begin + SLICE]
        who, found = tree.search(vectors[part], surplus[part], deficit[part])
        left, right = part[who], at_home[found]
        near = one_edit(letters, left, right)
        pairs.append(np.stack([left[near], right[near]]))
    left, right = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
    # Residents find each other from both sides; what visitors find counts for both ends.
    visit = ~resident[left]
    who, other = np.concatenate([left, right[visit]]), np.concatenate([right, left[visit]])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    times, best = _best(n, rank, who, other, len(words))
    some = np.flatnonzero(times)
    return some, times[some], best[some]


def _trunk(word: Column, depth: int) -> Column:
    """The counts of the first levels, as an array, by Spark's own functions."""
    members = {g: "".join(chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)) if c % GROUPS == g) for g in LEVELS[:depth]}
    return F.array(*[F.length(word) - F.length(F.translate(word, members[g], "")) for g in LEVELS[:depth]])


def fitting_depth(words: DataFrame, subtree: int) -> int:
    """The least number of levels after which no subtree holds more than ``subtree`` words or an
    even share; all but one level if none does. One row per level and round is read."""
    total = words.count()
    subtree = min(subtree, max(SMALL_SUBTREE, total // width(words.sparkSession)))
    depth = 2
    while depth < GROUPS - 1 and total > subtree:
        largest = words.groupBy(_trunk(F.col("word"), depth).alias("trunk")).count().agg(F.max("count")).first()[0]
        if largest <= subtree:
            break
        depth += 1
    return depth


def near_words(words: DataFrame, subtree: int = SUBTREE) -> DataFrame:
    """word, n_near, best_n and best of every word of ``words`` (word, n; stored) with near words."""
    cloudpickle.register_pickle_by_value(lotwise)
    depth = fitting_depth(words, subtree)

    def share_out(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            trunks, kind = np.unique(batch.column(2).flatten().to_numpy().reshape(-1, depth), axis=0, return_inverse=True)
            ways = [[(t, 1, 1), *reachable(t)] for t in map(tuple, trunks.tolist())]
            size = np.array([len(w) for w in ways])
            begin, mine = np.cumsum(size) - size, size[kind.ravel()]
            row = np.repeat(np.arange(batch.num_rows), mine)
            step = np.arange(mine.sum()) - np.repeat(np.cumsum(mine) - mine, mine)
            at = pa.array(begin[kind.ravel()][row] + step)
            names, surplus, deficit = zip(*((".".join(map(str, t)), s, d) for way in ways for t, s, d in way))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()).take(at), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)),
                    pa.array(surplus, pa.int8()).take(at), pa.array(deficit, pa.int8()).take(at), pa.array(step == 0),
                ],
                ["trunk", "word", "n", "surplus", "deficit", "resident"],
            )

    def search(key, table):
        columns = table.combine_chunks()
        resident = columns["resident"].to_numpy(zero_copy_only=False)
        if not resident.any():
            return empty
        words, n = columns["word"].to_pylist(), columns["n"].to_numpy()
        spend = [columns[c].to_numpy().astype(np.int64) for c in ("surplus", "deficit")]
        some, times, best = subtree_rows(words, n, *spend, resident, depth)
        return pa.table(
            {"word": columns["word"].take(some), "n_near": times, "best_n": n[best], "best": columns["word"].take(best)},
            schema=empty.schema,
        )

    empty = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]).empty_table()
    placed = map_arrow(
        words.select("word", "n", _trunk(F.col("word"), depth).alias("trunk")), share_out,
        "trunk string, word string, n long, surplus tinyint, deficit tinyint, resident boolean",
    )
    found = placed.groupBy("trunk").applyInArrow(search, "word string, n_near long, best_n long, best string")
    best = F.min_by(F.struct("best_n", "best"), F.struct(-F.col("best_n"), "best"))
    return (
        found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", "best.best_n", "best.best")
    )


def roots(forms: DataFrame, rounds: int) -> DataFrame:
    """word and root of every row of ``forms`` (word, form; stored): where its forms lead at last.
    Every round doubles the number of steps that are known."""
    known = forms.select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = known.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        known = written(step, "spelling-roots")
    return known


def variants(docs: DataFrame, subtree: int = SUBTREE) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the texts."""
    words = written(counted_words(docs), "spelling-words")
    near = written(near_words(words, subtree), "spelling-near")
    frequent = F.col("best_n") >= TIMES_AS_FREQUENT * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, F.col("best")).alias("form"), F.when(frequent, F.col("best_n")).alias("form_n"),
    )
    joined = written(joined, "spelling-forms")
    forms = joined.dropna(subset=["form"]).select("word", "form")
    most = joined.agg(F.max("form_n")).first()[0]
    # n >= 2 and every form is ten times its word: so many steps from the rarest word to the last form.
    steps = 0 if most is None else len(str(most // LEAST_COUNT)) - 1
    found = roots(forms, ceil(log2(max(steps, 1))))
    return joined.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
