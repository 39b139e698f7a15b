"""Adaptive parameter search: a tree of Parzen estimators proposes trials, halving ends poor ones early.

Trials come in batches that run side by side. A batch is proposed from the results of earlier batches
only (its own open trials count as poor, so that they spread), so the same seed gives the same trials
however long each one takes. A trial is judged step by step, fold after fold: at each rung only the
better half of all trials that came so far goes on. Bergstra et al. 2011, Jamieson and Talwalkar 2016.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np

#: Trials drawn without regard to earlier ones, and draws among which each proposal is the best.
STARTUP = 10
CANDIDATES = 24
#: Trials that run side by side.
BATCH = 5
#: Share of finished trials that count as good, and their largest number.
GOOD_SHARE, GOOD_MOST = 0.1, 25
COMPLETE, ENDED = "COMPLETE", "PRUNED"

Space = Mapping[str, tuple]


def _inner(value: float, scale: str) -> float:
    return math.log(value) if scale == "log" else float(value)


def _range(low: float, high: float, scale: str) -> tuple[float, float]:
    """Bounds on the scale that is searched; whole numbers get half a step on both sides."""
    return (low - 0.5, high + 0.5) if scale == "int" else (_inner(low, scale), _inner(high, scale))


def _outer(x: float, low: float, high: float, scale: str) -> float | int:
    if scale == "int":
        return int(min(high, max(low, math.floor(x + 0.5))))
    return float(min(high, max(low, math.exp(x) if scale == "log" else x)))


_erf = np.vectorize(math.erf, otypes=[float])


def _below(x: np.ndarray | float) -> np.ndarray:
    """Normal distribution function."""
    return 0.5 * (1.0 + _erf(np.asarray(x, dtype=float) / math.sqrt(2.0)))


class Parzen:
    """Density of one parameter: a normal cut to the range around each observation and one over the whole range."""

    def __init__(self, seen: Sequence[float], low: float, high: float):
        self._low, self._high = low, high
        width = high - low
        middle = (low + high) / 2
        order = np.sort(np.array([*seen, middle]))
        edges = np.concatenate(([low], order, [high]))
        spread = np.maximum(order - edges[:-2], edges[2:] - order)  # distance to the farther neighbour
        spread = np.clip(spread, width / min(100.0, 1.0 + order.size), width)
        spread[np.searchsorted(order, middle)] = width
        self._at, self._spread = order, spread
        self._inside = _below((high - order) / spread) - _below((low - order) / spread)

    def draw(self, rng: np.random.Generator, n: int) -> np.ndarray:
        out = np.empty(0)
        while out.size < n:
            which = rng.integers(0, self._at.size, size=n)
            x = rng.normal(self._at[which], self._spread[which])
            out = np.concatenate((out, x[(x >= self._low) & (x <= self._high)]))
        return out[:n]

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (np.asarray(x)[:, None] - self._at) / self._spread
        each = np.exp(-0.5 * z * z) / (self._spread * math.sqrt(2 * math.pi) * self._inside)
        return np.log(each.mean(axis=1) + 1e-300)


@dataclass
class Trial:
    """One set of parameters with its score at each rung reached."""

    number: int
    params: dict
    scores: list[float] = field(default_factory=list)
    state: str = ENDED

    @property
    def value(self) -> float:
        return float(np.mean(self.scores)) if self.scores else -math.inf


class ParzenSampler:
    """Proposes parameters from a space of name -> (low, high, "int" | "linear" | "log"); higher scores are better."""

    def __init__(self, space: Space, seed: int = 42, startup: int = STARTUP, candidates: int = CANDIDATES):
        self.space, self._seed, self._startup, self._candidates = space, seed, startup, candidates

    def propose(self, done: Sequence[Trial], pending: Sequence[Trial], number: int) -> dict:
        """Parameters of the trial of that number; they depend on the seed, the number and the trials given alone."""
        rng = np.random.default_rng([self._seed, number])
        if len(done) < self._startup:
            return {n: _outer(rng.uniform(*_range(*r)), *r) for n, r in self.space.items()}
        # trials that got further come first, then the higher mean; ties by number
        ranked = sorted(done, key=lambda t: (t.state != COMPLETE, -len(t.scores), -t.value, t.number))
        n_good = min(GOOD_MOST, max(1, math.ceil(GOOD_SHARE * len(done))))
        good, poor = ranked[:n_good], [*ranked[n_good:], *pending]
        out = {}
        for name, (low, high, scale) in self.space.items():
            span = _range(low, high, scale)
            near = Parzen([_inner(t.params[name], scale) for t in good], *span)
            far = Parzen([_inner(t.params[name], scale) for t in poor], *span)
            x = near.draw(rng, self._candidates)
            out[name] = _outer(float(x[int(np.argmax(near.log_density(x) - far.log_density(x)))]), low, high, scale)
        return out


def optimise(
    scores: Callable[[list[tuple[dict, int]]], list[float]], space: Space, trials: int = 50, rungs: int = 5, seed: int = 42,
    batch: int = BATCH, halving: bool = True, startup: int = STARTUP,
) -> list[Trial]:
    """All trials in order. ``scores`` gets a list of (parameters, rung) and returns their scores; it may run them side by side.

    With ``halving``, after each rung but the last a trial goes on if it is in the upper half, by mean so far, of all
    trials that have reached that rung. The first trial to reach a rung always goes on, so at least one is complete.
    """
    sampler = ParzenSampler(space, seed, startup)
    done: list[Trial] = []
    at_rung: list[list[float]] = [[] for _ in range(rungs)]
    while len(done) < trials:
        fresh: list[Trial] = []
        for number in range(len(done), min(trials, len(done) + batch)):
            fresh.append(Trial(number, sampler.propose(done, fresh, number)))
        alive = fresh
        for rung in range(rungs):
            for trial, score in zip(alive, scores([(t.params, rung) for t in alive]), strict=True):
                trial.scores.append(float(score))
            at_rung[rung].extend(t.value for t in alive)
            if halving and rung < rungs - 1:
                limit = sorted(at_rung[rung], reverse=True)[(len(at_rung[rung]) - 1) // 2]
                alive = [t for t in alive if t.value >= limit]
            if not alive:
                break
        for trial in alive:
            trial.state = COMPLETE
        done.extend(fresh)
    return done


def best_of(trials: Sequence[Trial]) -> Trial:
    """The complete trial with the highest mean score; ties by number."""
    return min((t for t in trials if t.state == COMPLETE), key=lambda t: (-t.value, t.number))
