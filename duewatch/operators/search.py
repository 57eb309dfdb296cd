"""Points of a search space, drawn by what earlier trials have shown.

Tree-structured Parzen estimation (Bergstra et al., 2011): after some random trials, the best quarter of the points and the
others each give a density, a mixture of normals around the points and one around the middle of the space. Candidates are
drawn from the density of the good ones, and the one with the largest ratio of the two densities is tried next.
"""

from __future__ import annotations

import math
import random
from collections import Counter

RANDOM_TRIALS = 10
GOOD_SHARE = 0.25
CANDIDATES = 24


class Sampler:
    """Draws points of ``space`` (name: kind, low, high; or "choice", values) and is told how good they were.

    Kinds are ``even``, ``log`` and ``whole``. The same seed and the same answers give the same points. A point whose value is
    unknown (None) counts as the worst.
    """

    def __init__(self, space: dict, seed: int, random_trials: int = RANDOM_TRIALS):
        self.space, self.source, self.random_trials = space, random.Random(seed), random_trials
        self.told: list[tuple[float, dict]] = []

    def tell(self, point: dict, value: float | None) -> None:
        """Larger values are better."""
        self.told.append((-math.inf if value is None or math.isnan(value) else value, point))

    def draw(self) -> dict:
        if len(self.told) < self.random_trials:
            return {name: self._random(name) for name in self.space}
        ranked = sorted(self.told, key=lambda t: -t[0])
        count = max(1, math.ceil(GOOD_SHARE * len(ranked)))
        good, bad = [p for _, p in ranked[:count]], [p for _, p in ranked[count:]]
        return {name: self._likely(name, good, bad) for name in self.space}

    def _random(self, name: str):
        kind, *rest = self.space[name]
        return self.source.choice(rest[0]) if kind == "choice" else self._value(name, self.source.random())

    def _unit(self, name: str, value: float) -> float:
        kind, low, high = self.space[name]
        if kind == "log":
            return (math.log(value) - math.log(low)) / (math.log(high) - math.log(low))
        return (value - low + 0.5) / (high - low + 1) if kind == "whole" else (value - low) / (high - low)

    def _value(self, name: str, unit: float):
        kind, low, high = self.space[name]
        if kind == "whole":
            return min(high, low + int(unit * (high - low + 1)))
        if kind == "log":
            return min(high, max(low, math.exp(math.log(low) + unit * (math.log(high) - math.log(low)))))
        return low + unit * (high - low)

    def _likely(self, name: str, good: list[dict], bad: list[dict]):
        kind, *rest = self.space[name]
        if kind == "choice":
            shares = [Counter(p[name] for p in side) for side in (good, bad)]
            ratio = {v: (shares[0][v] + 1) / (len(good) + len(rest[0])) / ((shares[1][v] + 1) / (len(bad) + len(rest[0]))) for v in rest[0]}
            drawn = [self.source.choice([p[name] for p in good] + list(rest[0])) for _ in range(CANDIDATES)]
            return max(drawn, key=lambda v: (ratio[v], str(v)))
        sides = [self._mixture([self._unit(name, p[name]) for p in side]) for side in (good, bad)]
        drawn = [self._near(sides[0]) for _ in range(CANDIDATES)]
        return self._value(name, max(drawn, key=lambda u: _density(sides[0], u) - _density(sides[1], u)))

    def _mixture(self, points: list[float]) -> list[tuple[float, float]]:
        """Centres with widths: the distance to the farther neighbour, within bounds, and a wide one in the middle."""
        centres = sorted([*points, 0.5])
        edges = [0.0, *centres, 1.0]
        least = 1.0 / min(100, 1 + len(centres))
        return [
            (c, 1.0 if c == 0.5 else min(1.0, max(least, c - edges[n], edges[n + 2] - c))) for n, c in enumerate(centres)
        ]

    def _near(self, mixture: list[tuple[float, float]]) -> float:
        centre, width = self.source.choice(mixture)
        for _ in range(100):
            unit = self.source.gauss(centre, width)
            if 0 <= unit < 1:
                return unit
        return min(max(centre, 0.0), 1 - 1e-12)


def _density(mixture: list[tuple[float, float]], unit: float) -> float:
    """Log of the mean of normals cut to [0, 1]."""
    total = 0.0
    for centre, width in mixture:
        inside = 0.5 * (math.erf((1 - centre) / width / math.sqrt(2)) - math.erf(-centre / width / math.sqrt(2)))
        total += math.exp(-0.5 * ((unit - centre) / width) ** 2) / width / inside
    return math.log(total / len(mixture) + 1e-300)
