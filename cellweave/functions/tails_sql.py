"""Tail probabilities as SQL expressions, by Simpson's rule, for the SQL of queries that give p values.

They share nothing with `tails`, so that the two check each other. Absolute errors lie far below the digits that queries keep.
"""

from __future__ import annotations


def _simpson(value: str, a: str, b: str, steps: int) -> str:
    """Integral of `value`, an expression in x, from a to b."""
    weight = f"CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    at = f"(({a}) + i * (({b}) - ({a})) / {steps}.0::DOUBLE)"
    return f"((({b}) - ({a})) / {3 * steps}.0::DOUBLE * list_sum(list_transform(range({steps + 1}), lambda i: ({weight}) * ({value.replace('{x}', at)}))))"


def t_upper(t: str, df: str) -> str:
    """P(T > t): with T = sqrt(df) tan(angle) the density is a power of the cosine."""
    df = f"({df})::DOUBLE"
    low = f"atan(abs({t}) / sqrt({df}))"
    high = f"least(pi() / 2, {low} + 14 / sqrt({df}))"
    tail = f"exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt(pi()) * {_simpson(f'pow(greatest(cos({{x}}), 0.0), {df} - 1)', low, high, 600)}"
    return f"(CASE WHEN {df} > 0 THEN CASE WHEN ({t}) >= 0 THEN {tail} ELSE 1 - {tail} END END)"


def normal_upper(z: str) -> str:
    """P(Z > z)."""
    low = f"least(abs({z}), 30.0::DOUBLE)"
    tail = f"{_simpson('exp(-({x}) * ({x}) / 2)', low, low + ' + 14', 600)} / sqrt(2 * pi())"
    return f"(CASE WHEN ({z}) >= 0 THEN {tail} ELSE 1 - {tail} END)"


def chi2_upper(x: str, df: str) -> str:
    """P(X > x) of chi-squared with at least 2 degrees of freedom."""
    k = f"({df})::DOUBLE"
    high = f"greatest(({x}), {k}) + 80 + 14 * sqrt(2 * {k})"
    return f"exp(-lgamma({k} / 2)) * {_simpson(f'exp(({k} / 2 - 1) * ln(greatest({{x}}, 1e-300)) - {{x}})', f'({x}) / 2', f'({high}) / 2', 4000)}"


def normal_quantile(p: str) -> str:
    """Inverse of the normal distribution function, by the rational formula of `tails`."""
    from .tails import CENTRE, EDGE, LOW_P

    poly = lambda cs, v: "(" + "(" * (len(cs) - 1) + f"{cs[0]!r}::DOUBLE" + "".join(f" * {v} + {c!r}::DOUBLE)" for c in cs[1:]) + ")"
    q, r = f"(({p}) - 0.5)", f"((({p}) - 0.5) * (({p}) - 0.5))"
    edge = lambda u: f"({poly(EDGE[0], u)} / {poly([*EDGE[1], 1.0], u)})"
    low, high = f"sqrt(-2 * ln({p}))", f"sqrt(-2 * ln(1 - ({p})))"
    return f"(CASE WHEN ({p}) < {LOW_P} THEN {edge(low)} WHEN ({p}) > 1 - {LOW_P} THEN -{edge(high)} ELSE {poly(CENTRE[0], r)} * {q} / {poly([*CENTRE[1], 1.0], r)} END)"
