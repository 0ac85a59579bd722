"""Near-duplicates: a multi-index Hamming join of b-bit MinHash signatures, confirmed exactly.

Signatures. Each distinct shingle set, a *class*, has ``SYMBOLS`` MinHash values cut to 16 bits,
which are indexed, and ``MORE`` cut to 8 bits. Two sets of similarity s differ in a share 1 - s of
the symbols on average.

Candidates. The signature is split into ``CHUNKS`` chunks of five symbols. Signatures that differ
in at most ``MOST_DIFFERENT`` = 2 * CHUNKS - 1 symbols have, by the pigeonhole principle, a chunk
with at most one difference. So each chunk is indexed five times, with each of its symbols left
out in turn: one of these keys is then equal. No pair under the threshold is missed. At
similarity 0.8 a pair lies above it with a probability of about 0.0005, and far less for
closer pairs; that chance of the hash functions is the only source of a lost link. Over all
symbols, ``MOST_OF_ALL`` may differ: four standard deviations above the mean at 0.8.

Links. Pairs of classes that share a key are never all listed. First, each class is tested
against the pivots of its keys (a pseudo-random member each), the ``PIVOTS`` with the most shared
keys. Confirmed links give components. Then every key whose classes still lie in more than one
component is searched: classes outside the key's main component are tested against their nearest
class of another one. After that, all pairs in different components under both thresholds are
tested, in the tasks that find them and without a list of them. Pairs inside a component are not:
they cannot change it. Large keys are searched in parts: classes outside the main component go to
each part.

Confirmation counts the common shingles of the full sets, read again from the texts of the
candidates alone: a bitmap of fixed size picks them before the shuffle.

Null and empty texts, and texts without words, have no shingles and link with nothing. A row
with a null doc_id takes part in links; the smallest id that is not null names the component,
null if there is none. Repeated rows fall into one class. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.llm.common import free_prefix, id_filter, map_arrow, passing, width, written
from lotwise.llm.components import components
from lotwise.llm.tokens import slices
from lotwise.llm.words import U64, mix, shingle_sets, stream

CHUNKS, CHUNK = 15, 5
SYMBOLS = CHUNKS * CHUNK
MOST_DIFFERENT = 2 * CHUNKS - 1
MORE = 181
MOST_OF_ALL = 77
PIVOTS = 2
# Fewer shared keys than this are no reason to test a pivot: the search finds those pairs.
LEAST_SHARED = 5
# Rows of a key searched by one group; a key has as many groups as it needs.
SEARCH_ROWS = 512

MULTIPLY = stream(0, SYMBOLS + MORE, 44) | U64(1)
ADD = stream(0, SYMBOLS + MORE, 55)


def signature(shingles: np.ndarray) -> bytes:
    """``SYMBOLS`` MinHash values of 16 bits each and ``MORE`` of 8 bits."""
    least = np.full(len(MULTIPLY), np.iinfo(U64).max, U64)
    for start in range(0, len(shingles), 1024):
        part = shingles[start : start + 1024, None] * MULTIPLY
        part += ADD
        np.minimum(least, part.min(axis=0), out=least)
    least = mix(least)
    return (least[:SYMBOLS] >> U64(48)).astype("<u2").tobytes() + (least[SYMBOLS:] >> U64(56)).astype("u1").tobytes()


def symbols_of(signatures: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Indexed and further symbols, a row per signature."""
    rows = np.frombuffer(b"".join(signatures), "u1").reshape(-1, 2 * SYMBOLS + MORE)
    return np.ascontiguousarray(rows[:, : 2 * SYMBOLS]).view("<u2"), rows[:, 2 * SYMBOLS :]


def index_keys(signatures: np.ndarray) -> np.ndarray:
    """All keys of each row of symbols: per chunk and left-out place the other four symbols."""
    chunks = signatures.reshape(len(signatures), CHUNKS, CHUNK).astype(U64)
    keys = np.empty((len(signatures), CHUNKS, CHUNK), U64)
    for out in range(CHUNK):
        packed = np.zeros(chunks.shape[:2], U64)
        for place in range(CHUNK):
            if place != out:
                packed = (packed << U64(16)) | chunks[:, :, place]
        keys[:, :, out] = packed
    slots = stream(0, SYMBOLS, 66).reshape(CHUNKS, CHUNK)
    return mix(keys ^ slots).reshape(len(signatures), SYMBOLS).view(np.int64)


def sketches(docs: DataFrame, n: int) -> DataFrame:
    """Per row: doc_id, a number, the text's digest, n_shingles, a 128-bit fingerprint of the set
    (fp_a, fp_b), signature. Numbers hold once they are written."""

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in slices(texts):
                sets = shingle_sets(texts[lo:hi], n)
                sums = [[int((mix(s ^ U64(c))).sum(dtype=U64).view(np.int64)) for s in sets] for c in (77, 88)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(lo, hi - lo) for c in (0, 2, 3)], pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(sums[0], pa.int64()), pa.array(sums[1], pa.int64()),
                        pa.array([signature(s) if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["doc_id", "row", "digest", "n_shingles", "fp_a", "fp_b", "signature"],
                )

    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"), text_digest().alias("digest"))
    return map_arrow(numbered, run, "doc_id long, row long, digest binary, n_shingles long, fp_a long, fp_b long, signature binary")


def text_digest() -> Column:
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))


SET = ["n_shingles", "fp_a", "fp_b"]


def classes(rows: DataFrame) -> DataFrame:
    """One row per distinct non-empty set: class (a number), smallest doc_id, its first row, keys."""
    grouped = (
        rows.filter("n_shingles > 0").groupBy(*SET)
        .agg(
            F.min("doc_id").alias("first_doc"),
            F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first_row"),
            F.first("signature").alias("signature"),
        )
        .withColumn("class", F.monotonically_increasing_id())
    )

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            symbols, _ = symbols_of(batch.column("signature").to_pylist())
            keys = pa.ListArray.from_arrays(
                np.arange(len(symbols) + 1, dtype=np.int32) * SYMBOLS, pa.array(index_keys(symbols).ravel())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], [*batch.schema.names, "keys"])

    schema = "n_shingles long, fp_a long, fp_b long, first_doc long, first_row long, signature binary, class long, keys array<bigint>"
    return written(map_arrow(grouped, run, schema), "classes")


def shared_keys(known: DataFrame) -> DataFrame:
    """(key, class, pivot) of all keys that several classes have; the pivot varies with the key."""
    rows = known.select("class", F.explode("keys").alias("key"))
    mask = F.col("key").bitwiseAND(F.lit((1 << 62) - 1))
    pivots = (
        rows.groupBy("key").agg(F.min(F.col("class").bitwiseXOR(mask)).alias("p"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("key", F.col("p").bitwiseXOR(mask).alias("pivot"))
    )
    return written(rows.join(pivots, "key"), "shared-keys")


def pivot_pairs(shared: DataFrame) -> DataFrame:
    """Each class with the pivots that it shares most keys with."""
    pairs = shared.filter("class != pivot").groupBy("class", "pivot").count().filter(F.col("count") >= LEAST_SHARED)
    best = Window.partitionBy("class").orderBy(F.desc("count"), "pivot")
    top = pairs.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= PIVOTS)
    return top.select(F.least("class", "pivot").alias("a"), F.greatest("class", "pivot").alias("b")).distinct()


def members(shared: DataFrame, known: DataFrame, parts: DataFrame) -> DataFrame:
    """The classes of every key that has several components, with the groups that search the key."""
    placed = shared.select("key", "class").join(parts.withColumnRenamed("node", "class"), "class", "left")
    placed = placed.withColumn("component", F.coalesce("component", "class"))
    sizes = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = (
        sizes.groupBy("key")
        .agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("rows"), F.count(F.lit(1)).alias("k"))
        .filter("k > 1").select("key", "main", F.ceil(F.col("rows") / SEARCH_ROWS).alias("groups"))
    )
    own = F.pmod(F.xxhash64("class"), F.col("groups"))
    return (
        placed.join(mixed, "key")
        .withColumns({"own": own, "major": F.col("component") == F.col("main")})
        .withColumn("group", F.explode(F.when(F.col("major"), F.array("own")).otherwise(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))))
        .join(known.select("class", "n_shingles", "signature"), "class")
        .select("key", "group", "class", "component", "n_shingles", "signature", "major", (F.col("group") == F.col("own")).alias("owned"))
    )


MEMBER = "key long, group long, class long, component long, n_shingles long, signature binary, major boolean, owned boolean"


def by_group(rows: DataFrame, work: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on the rows of whole groups, and where these begin and end."""
    cluster = rows.repartition(width(rows.sparkSession), "key", "group").sortWithinPartitions("key", "group")

    def run(batches):
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([rest, rows]) if rest is not None else rows
            cuts = _group_begins(rows)
            rest = rows.slice(cuts[-1]) if len(cuts) else rows
            if len(cuts) > 1:
                yield from work(rows, cuts)
        if rest is not None and rest.num_rows:
            yield from work(rest, np.array([0, rest.num_rows]))

    return map_arrow(cluster, run, schema)


def _group_begins(rows: pa.Table) -> np.ndarray:
    """Where groups begin; the last one may go on."""
    key, group = (rows.column(c).to_numpy() for c in ("key", "group"))
    return np.flatnonzero(np.concatenate([[True], (np.diff(key) != 0) | (np.diff(group) != 0)])) if len(key) else np.zeros(0, int)


def _near(rows: pa.Table, cuts: np.ndarray, percent: int, nearest: bool) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """A group's begin and end, a row outside the main component, and the rows owned by the group
    that are near it, with their distances."""
    number, component, size, key = (rows.column(c).to_numpy() for c in ("class", "component", "n_shingles", "key"))
    major, owned = (rows.column(c).to_numpy().astype(bool) for c in ("major", "owned"))
    symbols, more = symbols_of(rows.column("signature").to_pylist())
    keys = index_keys(symbols)
    for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        here = np.arange(begin, end)
        mine = here[owned[begin:end]]
        for i in here[~major[begin:end]]:
            # A pair of two classes outside the main component is listed by its larger one.
            other = mine[(component[mine] != component[i]) & (major[mine] | (number[mine] < number[i]) | nearest)]
            other = other[100 * np.minimum(size[other], size[i]) >= percent * np.maximum(size[other], size[i])]
            if not len(other):
                continue
            first = (symbols[other] != symbols[i]).sum(axis=1)
            distance = first + (more[other] != more[i]).sum(axis=1)
            good = (first <= MOST_DIFFERENT) & (distance <= MOST_OF_ALL)
            other, distance = other[good], distance[good]
            if not len(other):
                continue
            if nearest:
                at = np.lexsort((number[other], distance))[:1]
                other, distance = other[at], distance[at]
            # The first key that both have reports the pair.
            at = keys[i][np.argmax(keys[other] == keys[i], axis=1)] == key[i]
            if len(other[at]):
                yield begin, end, i, other[at], distance[at]


def nearest_pairs(shared: DataFrame, known: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """One pair (a, b) for each class outside a key's main component: it and the nearest class of
    another component under the signature thresholds.

    The nearest class of all is also the nearest in each key that it shares, so its first shared
    key reports it alone. Should the searching class lie in that key's main component, the
    pair is left to the search for crossing links.
    """

    def work(rows, cuts):
        number = rows.column("class").to_numpy()
        found = [(number[i], number[other[0]], distance[0]) for _, _, i, other, distance in _near(rows, cuts, percent, True)]
        if found:
            a, b, distance = np.array(found, np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(distance.astype(np.int32))], ["a", "b", "distance"])

    found = by_group(members(shared, known, parts), work, "a long, b long, distance int")
    best = found.groupBy("a").agg(F.min(F.struct("distance", "b")).alias("best")).select("a", "best.b")
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def crossing_links(shared: DataFrame, known: DataFrame, parts: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) between components: all pairs under the signature thresholds are tested on
    their full sets, where they meet.

    No pair is listed. The members of a group that are part of some pair fetch their texts, and
    the group's search is done again over these, with the test. Of the links found together one is
    reported for each two components: more would join nothing.
    """

    def take(rows, cuts):
        part = np.zeros(rows.num_rows, bool)
        for _, _, i, other, _ in _near(rows, cuts, percent, False):
            part[i] = part[other] = True
        if part.any():
            yield from rows.filter(pa.array(part)).to_batches()

    taking = written(by_group(members(shared, known, parts), take, MEMBER), "near-members")
    texts = texts_of(taking.select("class").distinct(), known, docs, n)

    def test(rows, cuts):
        number, component = (rows.column(c).to_numpy() for c in ("class", "component"))
        links, sets, of = [], [], None
        for begin, end, i, other, _ in _near(rows, cuts, percent, False):
            if of != begin:
                texts, of = rows.column("text").slice(begin, end - begin).to_pylist(), begin
                sets = [s for lo, hi in slices(texts) for s in shingle_sets(texts[lo:hi], n)]
            own, theirs = sets[i - begin], [sets[j - begin] for j in other]
            lengths = np.array([len(s) for s in theirs])
            every = np.concatenate(theirs)
            hit = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
            common = np.add.reduceat(hit.astype(np.int64), np.cumsum(lengths) - lengths)
            linked = other[100 * common >= percent * (len(own) + lengths - common)]
            _, first = np.unique(component[linked], return_index=True)
            for j in linked[first]:
                two = (component[i], component[j])
                links.append(((min(two), max(two)), (number[i], number[j])))
        if links:
            a, b = np.array(list({between: link for between, link in links}.values()), np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return written(by_group(taking.join(texts, "class"), test, "a long, b long"), "crossing-links")


def texts_of(classes: DataFrame, known: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """``class`` and a text of each of the given classes, read again from the documents."""
    nodes = written(known.join(classes, "class", "leftsemi").select("class", "first_doc", *SET), "candidate-classes")
    bits = id_filter(nodes.select("first_doc"))

    def pick(batches):
        for batch in batches:
            batch = passing(batch, "hash", bits)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in slices(texts):
                sets = shingle_sets(texts[lo:hi], n)
                sums = [[int((mix(s ^ U64(c))).sum(dtype=U64).view(np.int64)) for s in sets] for c in (77, 88)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(s) for s in sets], pa.int64()), pa.array(sums[0], pa.int64()), pa.array(sums[1], pa.int64()), pa.array(texts[lo:hi])],
                    [*SET, "text"],
                )

    picked = map_arrow(docs.select(F.xxhash64("doc_id").alias("hash"), "text"), pick, "n_shingles long, fp_a long, fp_b long, text string")
    return written(
        picked.join(nodes.select("class", *SET), SET).groupBy("class").agg(F.min("text").alias("text")), "candidate-texts"
    )


def confirmed(pairs: DataFrame, known: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    pairs = written(pairs, "candidates")
    nodes = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    texts = texts_of(nodes, known, docs, n)
    both = (
        pairs.join(texts.select(F.col("class").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("class").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )

    def check(batches):
        for batch in batches:
            a, b, left, right = (c.to_pylist() for c in batch.columns)
            good_a, good_b, last, set_b = [], [], None, None
            for i in range(len(a)):
                if b[i] != last:
                    last, set_b = b[i], shingle_sets([right[i]], n)[0]
                set_a = shingle_sets([left[i]], n)[0]
                common = len(set_a) + len(set_b) - len(np.union1d(set_a, set_b))
                if 100 * common >= percent * (len(set_a) + len(set_b) - common):
                    good_a.append(a[i])
                    good_b.append(b[i])
            yield pa.RecordBatch.from_arrays([pa.array(good_a, pa.int64()), pa.array(good_b, pa.int64())], ["a", "b"])

    return written(map_arrow(both, check, "a long, b long"), "links")


def decided(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """All rows: doc_id, digest of the text, n_shingles, component_id, kept."""
    rows = written(sketches(docs, n), "sketches")
    known = classes(rows)
    shared = shared_keys(known)
    links = confirmed(pivot_pairs(shared), known, docs, n, percent)
    parts = written(components(links, "a", "b"), "components")
    links = links.unionByName(confirmed(nearest_pairs(shared, known, parts, percent), known, docs, n, percent))
    parts = written(components(links, "a", "b"), "components")
    links = links.unionByName(crossing_links(shared, known, parts, docs, n, percent))
    parts = written(components(links, "a", "b"), "components")
    of = parts.withColumnRenamed("node", "class")
    numbered = known.select("class", *SET, "first_doc", "first_row").join(of, "class", "left").withColumn("component", F.coalesce("component", "class"))
    numbered = written(numbered.select("component", *SET, "first_doc", "first_row"), "class-components")
    first = numbered.groupBy("component").agg(
        F.min("first_doc").alias("component_id"),
        F.min_by("first_row", F.struct(F.col("first_doc").isNull(), "first_doc", "first_row")).alias("kept_row"),
    )
    named = numbered.join(first, "component").select(*SET, "component_id", "kept_row")
    joined = rows.select("doc_id", "row", "digest", *SET).join(named, SET, "left")
    linked = F.col("n_shingles") > 0
    return joined.select(
        "doc_id", "digest", "n_shingles", F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        (~linked | (F.col("row") == F.col("kept_row"))).alias("kept"),
    )


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """All rows: doc_id, n_shingles, component_id, kept.

    Rows with the component's id are ``kept``: several, if several rows share that id. Of a component
    in which no row has an id, one row is. Rows without shingles are components of their own.
    """
    rows = decided(docs, n, percent).drop("digest")
    by_id = F.col("doc_id") == F.col("component_id")
    return rows.withColumn("kept", F.when(F.col("doc_id").isNotNull(), by_id).otherwise(F.col("kept")))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of ``docs``, with all columns.

    Rows come back by (doc_id, digest of the text); of equal rows with one id, one is taken. Rows
    without words have no component and all stay.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    on = [f"{free_prefix(docs.columns, '_near')}_{name}" for name in ("id", "no_id", "digest")]
    keys = [F.coalesce("doc_id", F.lit(0)).alias(on[0]), F.col("doc_id").isNull().alias(on[1]), F.col(on[2])]
    kept = decided(docs, n, percent).filter("kept AND n_shingles > 0").select("doc_id", F.col("digest").alias(on[2])).select(*keys)
    has_words = F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    marked = docs.filter(has_words).withColumn(on[2], text_digest()).select(*names, *keys)
    chosen = marked.join(kept, on, "leftsemi").dropDuplicates(on).select(*names)
    return chosen.unionByName(docs.filter(~has_words).select(*names))
