"""Sequential parameter search by tree-structured Parzen proposals.

Finished trials are split into the better quarter (by the square root rule: the best
``ceil(gamma * sqrt(n))``) and the rest. Each parameter's values get a density in both
groups, counts with one pseudo-count spread over its values; a proposal is drawn from
the better group's densities, and of ``draws`` such draws the one with the largest
ratio of the two densities is tried next. Several proposals are evaluated at a time:
each runs its own Spark jobs from its own thread, so their stages share the cluster.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Params = dict[str, object]
#: a finished trial: parameters and the metric (larger is better)
Trial = tuple[Params, float]


def split_trials(history: Sequence[Trial], gamma: float = 0.25) -> tuple[list[Params], list[Params]]:
    """The better trials and the rest; earlier trials win ties."""
    done = [(p, m) for p, m in history if m is not None]
    order = sorted(range(len(done)), key=lambda i: (-done[i][1], i))
    k = min(math.ceil(gamma * math.sqrt(len(done))), 25)
    return [done[i][0] for i in order[:k]], [done[i][0] for i in order[k:]]


def densities(trials: Sequence[Params], name: str, values: Sequence, prior: float = 1.0) -> list[float]:
    """Share of each value among the trials, with ``prior`` pseudo-counts in all."""
    total = len(trials) + prior
    return [(sum(t[name] == v for t in trials) + prior / len(values)) / total for v in values]


def gain(params: Params, good: Sequence[Params], rest: Sequence[Params], space: dict[str, list]) -> float:
    """Log ratio of the two densities of a point, parameters apart."""
    out = 0.0
    for name, values in space.items():
        at = values.index(params[name])
        out += math.log(densities(good, name, values)[at]) - math.log(densities(rest, name, values)[at])
    return out


def propose(history: Sequence[Trial], space: dict[str, list], k: int = 1, startup: int = 2, draws: int = 24,
            seed: int = 2018) -> list[Params]:
    """The next ``k`` points, none tried before while the space has others. Points are
    random until ``startup`` trials are finished."""
    tried = [p for p, _ in history]
    r = random.Random(f"{seed}/{len(history)}")
    size = math.prod(len(v) for v in space.values())
    out: list[Params] = []
    good, rest = split_trials(history)
    while len(out) < k:
        taken = [*tried, *out]
        fresh = len({tuple(p.items()) for p in taken}) < size
        if len(history) < startup:
            points = [{n: r.choice(v) for n, v in space.items()}]
        else:
            points = [{n: r.choices(v, densities(good, n, v))[0] for n, v in space.items()} for _ in range(draws)]
        points = [p for p in points if not fresh or p not in taken]
        if points:
            out.append(max(points, key=lambda p: gain(p, good, rest, space)))
        elif fresh:
            # the densities have run dry: any untried point
            points = [{n: r.choice(v) for n, v in space.items()} for _ in range(draws)]
            out += [p for p in points if p not in taken][:1]
    return out


def _in_session(evaluate: Callable[[Params], float]) -> Callable[[Params], float]:
    """The evaluation with the session's job properties in its thread."""
    spark = SparkSession.getActiveSession()
    return inheritable_thread_target(spark)(evaluate) if spark else evaluate


def run(evaluate: Callable[[Params], float], space: dict[str, list], evals: int = 4, parallel: int = 2,
        startup: int = 2, seed: int = 2018) -> list[Trial]:
    """``evals`` finished trials in the order they were proposed, ``parallel`` at a time.
    The proposals of a round only know the rounds before, so the result does not depend
    on which of them ends first."""
    history: list[Trial] = []
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        while len(history) < evals:
            points = propose(history, space, min(parallel, evals - len(history)), startup, seed=seed)
            history += list(zip(points, pool.map(_in_session(evaluate), points)))
    return history

