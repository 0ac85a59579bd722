"""Secrets in whole texts: patterns, and strings whose characters look random.

Four kinds of spans, begin and end in code points:

* ``assign``: a name such as password, then ``:`` or ``=``, then a value of six characters or more;
* ``access``: access key ids;
* ``hex``: long lower-case hexadecimal runs;
* ``entropy``: other strings of key characters. A window of ``WINDOW`` characters slides over the
  string; character counts follow by one in and one out, and with them the window's Shannon
  entropy. Hexadecimal and mixed strings have a threshold each; strings of letters or digits
  alone are never taken. The span goes from the first window above the threshold to the last.

Spans of the other kinds, and placeholder words and runs of one character, cut a string: what is
left on both sides is judged by itself. A UUID gives no entropy span. The first three kinds are
always reported. DataFrame functions only.

A null or empty text has no spans, an empty table gives no rows. Repeated rows are each scanned; other
columns stay as they are, whatever their names, but columns named like the two results are replaced.
A very long string takes time in proportion to its length.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.llm.common import free_prefix

KINDS = ("assign", "access", "hex", "entropy")
# The patterns of the first three kinds and their least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LEAST = 20
HEX = r"[0-9a-f]+"
HEX_LEAST = 24

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
ONLY_HEX = r"^([0-9a-f]+|[0-9A-F]+)$"
# Bits per character. Random strings lie near 3.4 (16 characters) and 4.0 (64) in windows of 20.
HEX_BITS = 3.0
MIXED_BITS = 3.7
# Allowed strings: a UUID, alone or between separators; words and repeated characters within others.
UUID = r"(?i)^[+/_=-]*[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}[+/_=-]*$"
ALLOWED_WORDS = ("example", "sample", "dummy", "placeholder", "changeme")
REPEATED = r"(?i)(.)\1{7}"
# Matches are placed in blocks of so many: within a block the work grows with its square.
BLOCK = 256

SPAN = "array<struct<start: long, rank: int, end: long, kind: string, value: string>>"


def _whole(pattern: str, least: int) -> str:
    """The pattern for runs that pass: a run's leftmost match is its longest."""
    return f"{pattern[:-1]}{{{least},}}"


def _gap_matches(text: Column, pattern: str, groups: tuple[int, ...] = (0,)) -> Column:
    """Per match the text before it since the last one, the match, and other groups of it."""
    found = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in groups]
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), *[f.alias(f"g{g}") for f, g in zip(found, groups)])
    fields = ", ".join(["gap: string", *[f"g{g}: string" for g in groups]])
    return F.when(text.rlike(pattern), pairs).otherwise(F.array()).cast(f"array<struct<{fields}>>")


def _placed(matches: str | Column, rank: int) -> Column:
    """Spans of all matches of a ``_gap_matches`` column: lengths summed per block, then within it."""
    total = lambda m: F.char_length(m["gap"]).cast("long") + F.coalesce(F.char_length(m["g0"]), F.lit(0))
    block = lambda b: F.slice(matches, b * BLOCK + 1, F.lit(BLOCK))
    blocks = F.when(F.size(matches) > 0, F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / BLOCK).cast("int")))
    sums = F.transform(blocks, lambda b: F.aggregate(block(b), F.lit(0).cast("long"), lambda acc, m: acc + total(m)))
    begins = F.aggregate(
        sums, F.array(F.lit(0).cast("long")), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n))
    )

    def within(begin: Column, of_block: Column) -> Column:
        def step(acc: Column, m: Column) -> Column:
            start = acc["at"] + F.char_length(m["gap"])
            end = start + F.char_length(m["g0"])
            span = F.struct(
                start.cast("long").alias("start"), F.lit(rank).alias("rank"), end.cast("long").alias("end"),
                F.lit(KINDS[rank]).alias("kind"), m[VALUE_OF[rank]].alias("value"),
            )
            return F.struct(
                F.coalesce(end, start).cast("long").alias("at"),
                F.when(m["g0"].isNull(), acc["spans"]).otherwise(F.concat(acc["spans"], F.array(span))).alias("spans"),
            )

        empty = F.struct(begin.alias("at"), F.array().cast(SPAN).alias("spans"))
        return F.aggregate(of_block, empty, step, lambda acc: acc["spans"])

    each = F.transform(F.arrays_zip(blocks.alias("b"), F.slice(begins, 1, F.size(blocks)).alias("at")), lambda z: within(z["at"], block(z["b"])))
    return F.coalesce(F.flatten(each), F.array().cast(SPAN))


VALUE_OF = ("g2", "g0", "g0", "g0")


def _hot_part(value: Column, bits: float) -> Column:
    """First and last window of the string above ``bits`` per character, as (first, last) or null.

    The entropy of a window is log2(n) - sum(c log2 c) / n over its character counts c.
    """
    steps = [0.0] + [c * log2(c) for c in range(1, WINDOW + 1)]
    gain = F.array(*[F.lit(b - a) for a, b in zip(steps, steps[1:])])
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    # Each character with the one that leaves the window for it: the state holds no string.
    leaving = F.concat(F.array_repeat(F.lit(0), WINDOW), codes)
    moves = F.arrays_zip(codes.alias("code"), F.slice(leaving, F.lit(1), F.char_length(value)).alias("out"))

    def step(acc: Column, move: Column) -> Column:
        code, out, i = move["code"], move["out"], acc["i"] + 1
        left = F.when(
            out > 0, acc["sum"] - F.element_at(gain, F.greatest(F.element_at(acc["counts"], out + 1), F.lit(1)))
        ).otherwise(acc["sum"])
        had = F.element_at(acc["counts"], code + 1) - F.when(out == code, 1).otherwise(0)
        total = left + F.element_at(gain, had + 1)
        counts = F.transform(
            acc["counts"], lambda c, j: c + F.when(j == code, 1).otherwise(0) - F.when(j == out, 1).otherwise(0)
        )
        hot = (i >= WINDOW) & (F.lit(log2(WINDOW)) - total / WINDOW >= bits)
        return F.struct(
            i.alias("i"), counts.alias("counts"), total.alias("sum"),
            F.when(hot & acc["first"].isNull(), i - WINDOW).otherwise(acc["first"]).alias("first"),
            F.when(hot, i).otherwise(acc["last"]).alias("last"),
        )

    start = F.struct(
        F.lit(0).alias("i"), F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"),
        F.lit(0.0).alias("sum"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"),
    )
    return F.aggregate(moves, start, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def _pieces(s: Column, base: Column) -> Column:
    """What is left of a candidate span without ``base`` spans and allowed strings, as spans."""
    clashes = F.filter(base, lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"]))
    blanks = lambda n: F.repeat(F.lit(" "), n.cast("int"))

    def blanked(value: Column, b: Column) -> Column:
        start, end = F.greatest(b["start"], s["start"]), F.least(b["end"], s["end"])
        return F.overlay(value, blanks(end - start), (start - s["start"] + 1).cast("int"), (end - start).cast("int"))

    left = F.aggregate(clashes, s["value"], blanked)
    for word in ALLOWED_WORDS:
        left = F.regexp_replace(left, f"(?i){word}", " " * len(word))
    left = F.regexp_replace(left, REPEATED, " " * 8)

    def moved(p: Column) -> Column:
        return F.struct(
            (s["start"] + p["start"]).alias("start"), p["rank"].alias("rank"), (s["start"] + p["end"]).alias("end"),
            p["kind"].alias("kind"), p["value"].alias("value"),
        )

    cut = F.transform(_placed(_gap_matches(left, CANDIDATE), KINDS.index("entropy")), moved)
    whole = (F.size(clashes) == 0) & ~s["value"].rlike("(?i)" + "|".join([*ALLOWED_WORDS, r"(.)\1{7}"]))
    return F.when(whole, F.array(s)).otherwise(cut).cast(SPAN)


def _entropy_spans(candidates: Column, base: Column) -> Column:
    """Entropy spans of candidate spans, around allowed strings and what ``base`` holds."""

    def keep(s: Column) -> Column:
        mixed = s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")
        return mixed & ~s["value"].rlike(UUID)

    def narrowed(s: Column) -> Column:
        part = F.when(s["value"].rlike(ONLY_HEX), _hot_part(s["value"], HEX_BITS)).otherwise(_hot_part(s["value"], MIXED_BITS))
        return F.struct(s.alias("s"), part.alias("part"))

    pieces = F.flatten(F.transform(candidates, lambda s: _pieces(s, base)))
    found = F.filter(F.transform(F.filter(pieces, keep), narrowed), lambda x: x["part"]["first"].isNotNull())
    return F.transform(
        found,
        lambda x: F.struct(
            (x["s"]["start"] + x["part"]["first"]).alias("start"), x["s"]["rank"].alias("rank"),
            (x["s"]["start"] + x["part"]["last"]).alias("end"), x["s"]["kind"].alias("kind"), x["s"]["value"].alias("value"),
        ),
    ).cast(SPAN)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans`` (all kinds), by start, then kind as listed."""
    docs = docs.drop("base_spans", "spans")
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    plans = (
        (ASSIGN, (0, 2)), (_whole(ACCESS, ACCESS_LEAST - len("AKIA")), (0,)), (_whole(HEX, HEX_LEAST), (0,)), (CANDIDATE, (0,)),
    )
    # One step per column: what several later expressions read is computed once.
    own = free_prefix(docs.columns, "_scan")
    rows = docs.select("*", *[_gap_matches(t, p, groups).alias(f"{own}_m{i}") for i, (p, groups) in enumerate(plans)])
    rows = rows.select("*", *[_placed(f"{own}_m{i}", i).alias(f"{own}_s{i}") for i in range(len(plans))])
    long_enough = F.filter(f"{own}_s0", lambda s: F.char_length(s["value"]) >= ASSIGN_LEAST)
    rows = rows.select("*", F.sort_array(F.concat(long_enough, f"{own}_s1", f"{own}_s2")).alias("base_spans"))
    rows = rows.select("*", _entropy_spans(F.col(f"{own}_s3"), F.col("base_spans")).alias(f"{own}_e"))
    rows = rows.select("*", F.sort_array(F.concat("base_spans", f"{own}_e")).alias("spans"))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], "base_spans", "spans")


def as_text(spans: str) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
