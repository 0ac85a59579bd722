"""64-bit hashes of words and of runs of words, for many texts at once in numpy.

Words are runs of anything but ASCII white space. A word's hash is a sum of products: one
random value per byte times one random odd number per place in the word, then mixed.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def stream(begin: int, end: int, seed: int) -> np.ndarray:
    """Random 64-bit integers number ``begin`` to ``end`` of a seed."""
    return mix(np.arange(begin, end, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


BYTE_VALUE = stream(1, 257, 11)
# Nothing for white space.
INSIDE, INSIDE_VALUE = ~SPACE, np.where(SPACE, U64(0), BYTE_VALUE)
PLACE_TABLE = stream(0, 1 << 12, 22) | U64(1)


def _place_factor(place: np.ndarray) -> np.ndarray:
    if len(place) and place.max() >= len(PLACE_TABLE):
        return mix(place.astype(U64) * U64(0x9E3779B97F4A7C15) + U64(22)) | U64(1)
    return PLACE_TABLE[place]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words end among them."""
    return words_and_endings(texts)[:2]


def words_and_endings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``word_hashes``, and each word's last three bytes as a number, shorter ones with zeros."""
    buffer = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    inside = np.concatenate([[False], INSIDE.take(buffer), [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(first):
        return np.zeros(0, U64), np.zeros(len(texts), np.int64), np.zeros(0, np.int64)
    # White space after a word has the value 0, so it may count as part of it.
    place = np.arange(first[0], len(buffer))
    place -= np.repeat(first, np.diff(first, append=len(buffer)))
    values = INSIDE_VALUE.take(buffer[first[0] :])
    values *= PLACE_TABLE.take(place, mode="clip") if lengths.max() <= len(PLACE_TABLE) else _place_factor(place)
    sums = np.add.reduceat(values, first - first[0])
    last, ending = edges[1::2] - 1, np.zeros(len(first), np.int64)
    for back in range(3):
        ending = ending * 256 + np.where(lengths > back, buffer.take(np.maximum(last - back, 0)), 0)
    return mix(sums + lengths.astype(U64)), np.searchsorted(first, ends), ending


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, by the run's first word."""
    if len(words) < n:
        return np.zeros(0, U64)
    factors = stream(0, n, 33) | U64(1)
    total = np.zeros(len(words) - n + 1, U64)
    for j in range(n):
        total += words[j : j + len(total)] * factors[j]
    return mix(total)


def shingle_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``n``-word shingles of each text, A-Z lower-cased.

    A text of fewer words has its whole sequence as its only shingle; without words, none.
    """
    words, ends = word_hashes([t.encode().lower() for t in texts])
    runs, sets, begin = run_hashes(words, n), [], 0
    for end in ends.tolist():
        if end - begin >= n:
            sets.append(np.unique(runs[begin : end - n + 1]))
        elif end > begin:
            # Shorter runs have their own length in the hash: they equal no full shingle.
            sets.append(mix(run_hashes(words[begin:end], end - begin) + U64(end - begin)))
        else:
            sets.append(np.zeros(0, U64))
        begin = end
    return sets
