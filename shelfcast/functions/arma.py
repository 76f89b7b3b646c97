"""An autoregressive moving-average model with given coefficients as expressions over the array of a series' values.

A model is a struct column of const, phi, theta and sigma2; phi and theta are arrays of TERMS coefficients, 0 behind the order. A
recursion is a fold whose state holds the values so far; an array has at most one value per day of a series. Arguments name columns;
each function is one SQL expression, since a column built call by call takes longer to build than to run.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TERMS = 3
MOST_DIFFERENCES = 2
_LAGS = range(1, TERMS + 1)
_ZEROS = f"array({', '.join(['0D'] * TERMS)})"


def _sum(parts) -> str:
    return f"({' + '.join(parts)})"


def _step(values: str) -> str:
    return f"zip_with(slice({values}, 2, greatest(size({values}) - 1, 0)), slice({values}, 1, greatest(size({values}) - 1, 0)), (a, b) -> a - b)"


def _running(values: str, start: str) -> str:
    """Start plus the sums so far."""
    return f"slice(aggregate({values}, array({start}), (s, x) -> concat(s, array(element_at(s, -1) + x))), 2, size({values}))"


def _level(model: str) -> str:
    """The mean that stands for the values before the first one."""
    return f"({model}.const / (1D - aggregate({model}.phi, 0D, (s, x) -> s + x)))"


def differences(y: str, d: str) -> Column:
    """The d-th differences, d of 0 to 2."""
    return F.expr(f"case {d} when 0 then {y} when 1 then {_step(y)} else {_step(_step(y))} end")


def shocks(w: str, model: str, q: str) -> Column:
    """One-step errors, after TERMS zeros that stand for those before the first value."""
    past = _sum(f"get({model}.phi, {j - 1}) * coalesce(get({w}, i - {j}), {_level(model)})" for j in _LAGS)
    base = f"transform({w}, (x, i) -> x - {model}.const - {past})"
    moved = "b - " + _sum(f"get({model}.theta, {j - 1}) * element_at(e, -{j})" for j in _LAGS)
    return F.expr(f"if({q} = 0, concat({_ZEROS}, {base}), aggregate({base}, {_ZEROS}, (e, b) -> concat(e, array({moved}))))")


def one_step(y: str, d: str, errors: str) -> Column:
    """Prediction of each value from those before it; the first d values stand for themselves."""
    return F.expr(f"zip_with({y}, concat(array_repeat(0D, {d}), slice({errors}, {TERMS + 1}, size({errors}))), (a, e) -> a - e)")


def ahead(w: str, errors: str, model: str, horizon: int) -> Column:
    """Mean differences of the next `horizon` days."""
    known = f"concat(array_repeat({_level(model)}, {TERMS}), {w})"
    last = lambda values: f"slice({values}, size({values}) - {TERMS - 1}, {TERMS})"
    start = f"named_struct('w', {last(known)}, 'e', {last(errors)})"
    value = f"{model}.const + " + _sum(f"get({model}.phi, {j - 1}) * element_at(s.w, -{j}) + get({model}.theta, {j - 1}) * element_at(s.e, -{j})" for j in _LAGS)
    step = f"named_struct('w', concat(s.w, array({value})), 'e', concat(s.e, array(0D)))"
    return F.expr(f"aggregate(sequence(1, {horizon}), {start}, (s, i) -> {step}, s -> slice(s.w, {TERMS + 1}, {horizon}))")


def integrated(y: str, flat: str, d: str) -> Column:
    """Mean values of the next days from their d-th differences."""
    once = lambda values: _running(values, f"element_at({y}, -1)")
    twice = _running(flat, f"element_at({y}, -1) - element_at({y}, -2)")
    return F.expr(f"case {d} when 0 then {flat} when 1 then {once(flat)} else {once(twice)} end")


def spread_ahead(d: str, model: str, horizon: int) -> Column:
    """Standard errors of the next `horizon` days, from the weights of the shocks in them."""
    width = TERMS + MOST_DIFFERENCES
    ar = [f"get({model}.phi, {j})" for j in range(TERMS)] + ["0D"] * MOST_DIFFERENCES
    for times in range(1, MOST_DIFFERENCES + 1):
        once = [f"({ar[0]} + 1D)", *(f"({b} - {a})" for a, b in zip(ar, ar[1:]))]
        ar = [f"if({d} >= {times}, {x}, {y})" for x, y in zip(once, ar)]
    weight = f"coalesce(get({model}.theta, j - 1), 0D) + " + _sum(f"{a} * element_at(s, -{i})" for i, a in enumerate(ar, 1))
    first = f"array({', '.join(['0D'] * (width - 1))}, 1D)"
    weights = f"aggregate(sequence(1, {horizon - 1}), {first}, (s, j) -> concat(s, array({weight})))" if horizon > 1 else first
    squares = f"transform(slice({weights}, {width}, {horizon}), x -> x * x)"
    return F.expr(f"transform(aggregate({squares}, array(0D), (s, x) -> concat(s, array(element_at(s, -1) + x))), x -> sqrt({model}.sigma2 * x))")
