"""All maximal scoring segments of a sequence in linear time, and what chance makes of them.

A sequence holds scored items at known places and, between them, gaps of items that all have the
same negative score. A maximal scoring segment is what remains if the best segment is taken out
and the parts on both sides are searched in the same way: no segment of the result can be made
better by a longer or shorter one.

The best segment of a random sequence of n items has an extreme-value distribution:
P(best > s) = 1 - exp(-K n exp(-lambda s)). ``Chance`` holds the two constants.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, expm1, lgamma, log

import numpy as np


def maximal_segments(places: list[int], scores: list[float], gap_score: float) -> list[tuple[int, int, float]]:
    """(first, last, score) of each maximal segment, by index of the scored items, in order.

    ``places`` rise; each item that is not listed has ``gap_score``, which is below 0. Every
    candidate remembers the nearest earlier one that starts from a lower sum, so a search for
    such a one jumps over all that cannot be it: the whole scan is linear.
    """
    first, last, low, high, lower = [], [], [], [], []
    total, before = 0.0, -1
    for item, (place, score) in enumerate(zip(places, scores)):
        total += (place - before - 1) * gap_score
        before = place
        start, total = total, total + score
        if score <= 0:
            continue
        begin = item
        while True:
            at = len(low) - 1
            while at >= 0 and low[at] >= start:
                at = lower[at]
            if at < 0 or high[at] >= total:
                break
            begin, start = first[at], low[at]
            del first[at:], last[at:], low[at:], high[at:], lower[at:]
        first.append(begin)
        last.append(item)
        low.append(start)
        high.append(total)
        lower.append(at)
    return [(f, t, h - lo) for f, t, lo, h in zip(first, last, low, high)]


@dataclass(frozen=True)
class Chance:
    """The constants of the extreme-value distribution of best segments in clean texts."""

    rate: float = 1.0
    scale: float = 1.0

    def standing(self, score: float, n: int) -> float:
        """A segment's score in units in which chance does not depend on the length."""
        return self.rate * score - log(self.scale * max(n, 1))

    def surprise(self, score: float, n: int) -> float:
        """-ln of the probability of a best segment this good in a clean text of n items."""
        standing = self.standing(score, n)
        return standing if standing > 30 else -log(-expm1(-exp(-max(standing, -6.0))))

    def evidence(self, scores: list[float], n: int) -> float:
        """-ln of the probability of the best r segments together, for the most telling r.

        The sum of the r best standings has the tail exp(-t) t^(r-1) / (r! (r-1)!); looking at
        every r costs a factor of 2^r.
        """
        if not scores:
            return 0.0
        ordered = sorted(scores, reverse=True)
        best, total = self.surprise(ordered[0], n) - log(2), 0.0
        for r, score in enumerate(ordered, 1):
            standing = self.standing(score, n)
            if standing <= 0:
                break
            total += standing
            if r > 1:
                best = max(best, total - (r - 1) * log(total) + lgamma(r + 1) + lgamma(r) - r * log(2))
        return max(best, 0.0)


# Values of lambda that are tried.
RATES = np.geomspace(0.05, 20.0, 96)


def chance_sums(best: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What a fit needs of clean texts, to be added up over any number of them: the number of
    texts and their items, those with a segment and their scores' sum, the items of texts without
    one, and for each rate the sum of n exp(-rate * score)."""
    found = best > 0
    damped = [(n[found] * np.exp(-rate * best[found])).sum() for rate in RATES]
    return np.array([len(n), n.sum(), found.sum(), best[found].sum(), n[~found].sum(), *damped], float)


SUMS = 5 + len(RATES)


def fit_chance(sums: np.ndarray) -> Chance:
    """The most likely constants; a text without a segment says that its best was not above 0.
    Half a text of mean length without a segment is added, so equal scores give no certainty."""
    texts, items, found, total, without = sums[:5]
    without += 0.5 * max(items, 1.0) / max(texts, 1.0)
    if found == 0:
        return Chance(1.0, 0.5 / without)
    scale = found / (sums[5:] + without)
    likelihood = found * (np.log(scale) + np.log(RATES)) - RATES * total
    at = int(np.argmax(likelihood))
    return Chance(float(RATES[at]), float(scale[at]))
