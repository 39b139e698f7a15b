"""The adaptive sampler on objectives made for the purpose."""

import math

import numpy as np
import pytest

from leadloom.operators import search
from leadloom.operators.modelling import SEARCH_SPACE


def bowl(params, space):
    """1 at a point inside every range, falling with the distance from it on the searched scale."""
    far = 0.0
    for i, (name, (low, high, scale)) in enumerate(space.items()):
        a, b = search._range(low, high, scale)
        goal = a + (0.2 + 0.08 * i) * (b - a)
        far += ((search._inner(params[name], scale) - goal) / (b - a)) ** 2
    return math.exp(-4 * far)


def run(seed, trials=60, space=SEARCH_SPACE, **more):
    return search.optimise(lambda jobs: [bowl(p, space) - 0.001 * r for p, r in jobs], space, trials=trials, seed=seed, **more)


def test_all_eight_ranges_are_drawn_and_kept():
    assert len(SEARCH_SPACE) == 8
    for trial in run(1):
        assert set(trial.params) == set(SEARCH_SPACE)
        for name, (low, high, scale) in SEARCH_SPACE.items():
            assert low <= trial.params[name] <= high and isinstance(trial.params[name], int if scale == "int" else float)


def test_the_seed_decides():
    plain = [(t.params, t.scores, t.state) for t in run(3)]
    assert plain == [(t.params, t.scores, t.state) for t in run(3)]
    assert plain != [(t.params, t.scores, t.state) for t in run(4)]


def test_later_trials_are_better_than_chance():
    """Over several seeds: the last third beats the first draws, and the best beats random search of the same size."""
    wins = 0
    for seed in range(8):
        adaptive = [t.scores[0] for t in run(seed, halving=False)]
        chance = [t.scores[0] for t in run(seed, halving=False, startup=10**9)]
        assert np.mean(adaptive[40:]) > np.mean(adaptive[:10])
        wins += max(adaptive) > max(chance)
    assert wins >= 6


def test_halving_ends_poor_trials_and_saves_judgements():
    trials = run(5)
    complete = [t for t in trials if t.state == search.COMPLETE]
    assert all(len(t.scores) == 5 for t in complete) and all(len(t.scores) < 5 for t in trials if t.state == search.ENDED)
    assert 0 < len(complete) < 60 and sum(len(t.scores) for t in trials) < 0.7 * 5 * 60
    assert search.best_of(trials).value == max(t.value for t in complete)
    assert len(search.optimise(lambda jobs: [0.0] * len(jobs), {"x": (0, 1, "linear")}, trials=7, rungs=2)) == 7  # ties go on


@pytest.mark.parametrize("seen", [[], [0.0], [1.0, 1.0, 2.5], list(np.linspace(-1, 4, 40))])
def test_a_density_is_one_in_all(seen):
    density = search.Parzen(seen, -1.0, 4.0)
    at = np.linspace(-1, 4, 20_001)
    assert np.trapezoid(np.exp(density.log_density(at)), at) == pytest.approx(1.0, abs=1e-3)
    drawn = density.draw(np.random.default_rng(0), 500)
    assert drawn.size == 500 and drawn.min() >= -1 and drawn.max() <= 4
