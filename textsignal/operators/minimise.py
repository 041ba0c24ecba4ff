"""Limited-memory quasi-Newton minimisers as generators, with the steps and stops of those that MLlib calls.

A generator yields the point whose value and gradient it needs and is sent both, so the caller can ask one pass over
its rows for the points of many models.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Generator

import numpy as np

PAIRS = 10  # steps and changes of the gradient that are remembered
KEPT_VALUES = 20
Search = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


class SearchFailure(Exception):
    pass


def _direction(grad: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Minus the approximate inverse Hessian times the gradient; the newest pair comes first."""
    d, scale, used = grad.copy(), 1.0, []
    if pairs:
        step, change = pairs[0]
        along = float(step @ change)
        if along < 0 or math.isnan(along):
            raise SearchFailure
        scale = along / float(change @ change) if along else math.nan
    for step, change in pairs:
        along = float(step @ change)
        a = float(step @ d) / along if along else math.nan
        if math.isnan(a):
            raise SearchFailure
        used.append((a, along))
        d -= a * change
    d *= scale
    for (step, change), (a, along) in zip(reversed(pairs), reversed(used)):
        d += (a - float(change @ d) / along) * step
    return np.negative(d, out=d)


def _between(left: tuple, right: tuple) -> float:
    """Minimum of the cubic through two (t, slope, value), kept away from both ends."""
    (lt, ls, lv), (rt, rs, rv) = left, right
    d1 = ls + rs - 3 * (lv - rv) / (lt - rt)
    inner = d1 * d1 - ls * rs
    d2 = math.sqrt(inner) if inner >= 0 else math.nan
    bottom = rs - ls + 2 * d2
    t = rt - (rt - lt) * (rs + d2 - d1) / bottom if bottom else math.nan
    low, high = lt + 0.1 * (rt - lt), lt + 0.9 * (rt - lt)
    return low if t < low else high if t > high else t


def _strong_wolfe(phi: Callable, t: float, start: tuple, c1: float = 1e-4, c2: float = 0.9):
    (_, slope, value), low = start, start
    if slope > 0:
        raise SearchFailure

    def zoom(low: tuple, high: tuple):
        for _ in range(10):
            t = _between(high, low) if low[0] > high[0] else _between(low, high)
            c = yield from phi(t)
            if c[2] > value + c1 * c[0] * slope or c[2] >= low[2]:
                high = c
            else:
                if abs(c[1]) <= c2 * abs(slope):
                    return c[0]
                if c[1] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise SearchFailure

    for i in range(10):
        c = yield from phi(t)
        if not math.isfinite(c[2]):
            t /= 2
            continue
        if c[2] > value + c1 * t * slope or (c[2] >= low[2] and i > 0):
            return (yield from zoom(low, c))
        if abs(c[1]) <= c2 * abs(slope):
            return c[0]
        if c[1] >= 0:
            return (yield from zoom(c, low))
        low, t = c, t * 1.5
    raise SearchFailure


def _backtracking(phi: Callable, t: float, start: tuple, shrink: float, grow: float = 2.1, c1: float = 1e-4, c2: float = 0.9):
    _, slope, value = start
    c = t, slope, value  # the first length is not tried: it counts as no progress and is shortened
    for _ in range(19):
        if c[2] > value + c[0] * slope * c1:
            by = shrink
        elif c[1] < c2 * slope:
            by = grow
        elif c[1] > -c2 * slope:
            by = shrink
        else:
            return c[0]
        if not 1e-10 <= c[0] * by <= 1e10:
            raise SearchFailure
        c = yield from phi(c[0] * by)
    return c[0]


def minimise(x: np.ndarray, max_iter: int = 100, tol: float = 1e-6, in_orthant: bool = False) -> Search:
    """Returns the last point.  ``in_orthant`` takes the steps of the orthant-wise method (without a penalty on sizes)."""
    value, grad = yield x
    first, values, pairs, failed, n = value, [math.inf], [], False, 0
    while True:
        size = float(np.linalg.norm(grad))
        flat = len(values) > 1 and abs(value - max(values)) <= tol * abs(first)
        if n >= max_iter or flat or size <= max(tol * value, 1e-8):
            return x
        try:
            d = _direction(grad, pairs)
            if in_orthant:
                d = np.where(d * grad < 0, d, 0.0)
                orthant = np.where(x != 0, np.sign(x), np.sign(-grad))
            seen = {}

            def phi(t: float):
                at = x + d * t
                if in_orthant:
                    at = np.where(np.sign(at) == orthant, at, 0.0)
                found = yield at
                seen.clear()
                seen[t] = at, *found
                return t, float(found[1] @ d), found[0]

            start = 0.0, float(grad @ d), value
            if in_orthant:
                t = yield from _backtracking(phi, 0.5 / size if n < 1 else 1.0, start, 0.1 if n < 1 else 0.5)
            else:
                t = yield from _strong_wolfe(phi, 1 / float(np.linalg.norm(d)) if n == 0 else 1.0, start)
                if t * size < 1e-10:
                    raise SearchFailure
            if t not in seen:
                yield from phi(t)
        except SearchFailure:
            if failed:
                return x
            failed, pairs = True, []
            continue
        new, value, new_grad = seen[t]
        pairs = [(new - x, new_grad - grad), *pairs][:PAIRS]
        x, grad, failed, n = new, new_grad, False, n + 1
        values = [*values, value][-KEPT_VALUES:]


def side_by_side(searches: dict, evaluate: Callable[[dict], dict]) -> dict:
    """Runs searches by name; ``evaluate`` gets the points of all that go on and gives their values and gradients."""
    asked, found = {name: next(search) for name, search in searches.items()}, {}
    while asked:
        answers, going = evaluate(asked), {}
        for name in asked:
            try:
                going[name] = searches[name].send(answers[name])
            except StopIteration as end:
                found[name] = end.value
        asked = going
    return found
