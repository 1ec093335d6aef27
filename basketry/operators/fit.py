"""Maximum-likelihood fits whose sums are taken by Spark.

The driver holds only the parameter vector.  A round is one Spark job: the
objective, its gradient and its matrix of second derivatives are aggregate
columns of one pass over the data, from analytic formulas.  A damped Newton
step in log-parameters follows.  Only a step that does not lower the objective
costs further jobs, one per shorter step.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: value, gradient and second derivatives of a mean log-likelihood at a point
Derivatives = tuple[float, np.ndarray, np.ndarray]

STEP_LENGTHS = (1.0, 0.5, 0.25, 0.1, 0.03, 0.01)


def mean_derivatives(terms: DataFrame, value: str, first: list[str], second: dict[tuple[int, int], str],
                     weight: str = "n") -> Derivatives:
    """Means over the rows of ``terms`` of SQL texts, weighted by ``weight``, in one job."""
    texts = {"v": value, **{f"g{i}": g for i, g in enumerate(first)}, **{f"h{i}_{j}": h for (i, j), h in second.items()}}
    row = terms.agg(F.expr(f"sum({weight}) AS total"), *[F.expr(f"sum(({t}) * {weight}) AS {k}") for k, t in texts.items()]).first()
    number = lambda name: math.nan if row[name] is None else row[name] / row["total"]
    hessian = np.zeros((len(first), len(first)))
    for i, j in second:
        hessian[i, j] = hessian[j, i] = number(f"h{i}_{j}")
    return number("v"), np.array([number(f"g{i}") for i in range(len(first))]), hessian


class Fit:
    """Result of ``maximise``: parameters, penalised objective (to be lowered),
    rounds (jobs), largest slope in log-parameters, standard errors."""

    def __init__(self, params, value, converged, rounds, slope, errors):
        self.params, self.value, self.converged = params, value, converged
        self.rounds, self.slope, self.errors = rounds, slope, errors


def maximise(mean: Callable[[np.ndarray], Derivatives], k: int, ridge: float, n: float, max_rounds: int = 60,
             grad_tol: float = 1e-7, max_step: float = 2.0) -> Fit:
    """Minimise ``-mean + ridge * sum(theta^2)`` over k positive parameters,
    starting from 1, by Newton steps in their logarithms.

    Directions of negative curvature are turned round, long steps cut, and a step
    that does not lower the objective is shortened.  Where slopes fall slowly (a
    parameter on its way to 0) the next step is stretched.  Standard errors are those
    of the sandwich H^-1 I H^-1 with the information I of the ``n`` observations
    and the curvature H of the penalised objective (without ridge: I^-1)."""

    def penalised(phi):
        theta = np.exp(phi)
        value, g, h = mean(theta)
        g, h_pen = -g + 2 * ridge * theta, -h + 2 * ridge * np.eye(k)
        return (-value + ridge * float(theta @ theta), theta * g, np.diag(theta * g) + np.outer(theta, theta) * h_pen, h)

    phi, jobs = np.zeros(k), 1
    at = penalised(phi)
    if not _finite(at):
        return Fit(np.exp(phi), at[0], False, 1, math.inf, [math.nan] * k)
    converged, stretch = False, 1.0
    while True:
        slope = float(np.max(np.abs(at[1])))
        if slope < grad_tol:
            converged = True
            break
        curves, axes = np.linalg.eigh(at[2])
        curves = np.maximum(np.abs(curves), 1e-8 * max(1.0, float(np.abs(curves).max())))
        step = -axes @ ((axes.T @ at[1]) / curves)
        step *= min(1.0, max_step / float(np.linalg.norm(step)))
        gain = float(-step @ at[1])
        for length in STEP_LENGTHS if stretch == 1.0 else (stretch, *STEP_LENGTHS):
            if jobs >= max_rounds:
                break
            new, jobs = penalised(phi + length * step), jobs + 1
            if _finite(new) and new[0] < at[0]:
                phi, at = phi + length * step, new
                slow = float(np.max(np.abs(new[1]))) > 0.3 * slope
                stretch = min(2 * stretch, 8.0) if slow and length >= 1.0 else 1.0
                break
        else:
            # no lower value: the expected gain is below what a double can show
            converged = slope < 1e-4 and gain < 1e-9 * max(1.0, abs(at[0]))
            break
        if jobs >= max_rounds:
            break
    theta = np.exp(phi)
    return Fit(theta, at[0], converged, jobs, float(np.max(np.abs(at[1]))), _errors(at[3], ridge, n))


def _finite(at) -> bool:
    return all(np.all(np.isfinite(x)) for x in at)


def _errors(hessian: np.ndarray, ridge: float, n: float) -> list[float]:
    information = -n * hessian
    try:
        inverse = np.linalg.inv(information + 2 * n * ridge * np.eye(len(hessian)))
    except np.linalg.LinAlgError:
        return [math.nan] * len(hessian)
    variance = np.diag(inverse @ information @ inverse)
    return [math.sqrt(v) if v > 0 else math.nan for v in variance]
