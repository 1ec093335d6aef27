"""Special functions as column expressions: log-gamma and its derivatives, the
regularised incomplete gamma and beta functions, and the tail probabilities of
test statistics built on them.

The log-gamma family shifts its argument by 8 and sums an asymptotic series (no
loop, so it stays in generated code).  The incomplete functions run their
series or continued fraction inside ``aggregate``; the number of steps follows
from the arguments.  They are meant for rows of statistics, not for raw data.
A null argument gives null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SHIFT = 8
#: coefficients of the asymptotic series of ln Gamma (powers w^-1, w^-3, ...), from
#: the Bernoulli numbers B_2k / (2k (2k - 1)) (fixed values)
BERNOULLI = (1 / 6, -1 / 30, 1 / 42, -1 / 30, 5 / 66, -691 / 2730, 7 / 6)


def _column(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (c if isinstance(c, Column) else F.lit(float(c))).cast("double")


def _horner(w: Column, coefficients: list[float]) -> Column:
    """Sum of coefficient[k] * w^-2k."""
    inverse = 1.0 / (w * w)
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * inverse + F.lit(c)
    return out


def _tail(w: Column) -> Column:
    return _horner(w, [b / (2 * k * (2 * k - 1)) for k, b in enumerate(BERNOULLI, 1)]) / w


def log_gamma(z) -> Column:
    """ln Gamma(z) for z > 0 (absolute error near 1e-14, relative for large z)."""
    z = _column(z)
    w = z + F.lit(float(SHIFT))
    product = z
    for k in range(1, SHIFT):
        product = product * (z + F.lit(float(k)))
    # the product overflows only where the plain series is exact anyway
    series = lambda v: (v - 0.5) * F.log(v) - v + F.lit(0.5 * math.log(2 * math.pi)) + _tail(v)
    return F.when(z < 1e6, series(w) - F.log(product)).otherwise(series(z))


def log_gamma_ratio(a, b) -> Column:
    """ln(Gamma(a + b) / Gamma(a)), without taking the difference of two large numbers."""
    a, b = _column(a), _column(b)
    w = a + F.lit(float(SHIFT))
    shifted = (w - 0.5) * F.log1p(b / w) + b * F.log(w + b) - b + _tail(w + b) - _tail(w)
    for k in range(SHIFT):
        shifted = shifted - F.log1p(b / (a + F.lit(float(k))))
    return shifted


def _double(v: float) -> str:
    return f"{float(v)!r}D"


def _horner_text(w: str, coefficients: list[float]) -> str:
    out = _double(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = f"({out} / ({w} * {w}) + {_double(c)})"
    return out


def log_gamma_text(z: str) -> str:
    """``log_gamma`` as SQL text of the column ``z`` (moderate values): the fits
    build their expressions as text, which plans much faster than columns."""
    w = f"({z} + {_double(SHIFT)})"
    series = _horner_text(w, [b / (2 * k * (2 * k - 1)) for k, b in enumerate(BERNOULLI, 1)])
    product = " * ".join([z, *(f"({z} + {_double(k)})" for k in range(1, SHIFT))])
    half = _double(0.5 * math.log(2 * math.pi))
    return f"(({w} - 0.5D) * ln({w}) - {w} + {half} + {series} / {w} - ln({product}))"


def digamma_text(z: str) -> str:
    """Derivative of ln Gamma as SQL text, z > 0."""
    w = f"({z} + {_double(SHIFT)})"
    series = _horner_text(w, [b / (2 * k) for k, b in enumerate(BERNOULLI, 1)])
    shifted = " - ".join(f"1D / ({z} + {_double(k)})" for k in range(SHIFT))
    return f"(ln({w}) - 0.5D / {w} - {series} / ({w} * {w}) - {shifted})"


def trigamma_text(z: str) -> str:
    """Second derivative of ln Gamma as SQL text, z > 0."""
    w = f"({z} + {_double(SHIFT)})"
    shifted = " + ".join(f"1D / (({z} + {_double(k)}) * ({z} + {_double(k)}))" for k in range(SHIFT))
    return f"(1D / {w} + 0.5D / ({w} * {w}) + {_horner_text(w, list(BERNOULLI))} / ({w} * {w} * {w}) + {shifted})"


def digamma(z: str) -> Column:
    return F.expr(digamma_text(z))


def trigamma(z: str) -> Column:
    return F.expr(trigamma_text(z))


def _steps(size: Column, base: int, factor: float) -> Column:
    """1, 2, ... up to a number that grows with the square root of ``size``."""
    return F.sequence(F.lit(1), (base + factor * F.sqrt(F.greatest(size, F.lit(1.0)))).cast("int"))


def gamma_tail(a, x) -> Column:
    """Regularised upper incomplete gamma function Q(a, x), a > 0, x >= 0."""
    a, x = _column(a), _column(x)
    front = F.exp(a * F.log(x) - x - log_gamma(a))
    # below a + 1 the series of P, else the continued fraction of Q (modified Lentz)
    series = F.aggregate(
        _steps(a, 100, 12.0), F.struct((1.0 / a).alias("term"), (1.0 / a).alias("total")),
        lambda s, k: F.struct((s["term"] * x / (a + k)).alias("term"), (s["total"] + s["term"] * x / (a + k)).alias("total")),
        lambda s: s["total"])
    start = F.struct(F.lit(1e300).alias("c"), (1.0 / (x + 1.0 - a)).alias("d"), (1.0 / (x + 1.0 - a)).alias("h"))

    def step(s, i):
        n = -i * (i - a)
        b = x + 1.0 - a + 2.0 * i
        c, d = b + n / s["c"], 1.0 / (n * s["d"] + b)
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    fraction = F.aggregate(_steps(a, 200, 12.0), start, step, lambda s: s["h"])
    return F.when(x <= 0, F.when(a.isNotNull(), 1.0)).when(x < a + 1.0, 1.0 - front * series).otherwise(front * fraction)


def _beta_fraction(x: Column, a: Column, b: Column) -> Column:
    """Continued fraction of the incomplete beta function, quick for x < (a + 1) / (a + b + 2)."""
    d0 = 1.0 / (1.0 - (a + b) * x / (a + 1.0))
    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))

    def step(s, m):
        m2 = 2.0 * m
        even = m * (b - m) * x / ((a - 1.0 + m2) * (a + m2))
        odd = -(a + m) * (a + b + m) * x / ((a + m2) * (a + 1.0 + m2))
        c1, d1 = 1.0 + even / s["c"], 1.0 / (1.0 + even * s["d"])
        c2, d2 = 1.0 + odd / c1, 1.0 / (1.0 + odd * d1)
        return F.struct(c2.alias("c"), d2.alias("d"), (s["h"] * c1 * d1 * c2 * d2).alias("h"))

    return F.aggregate(_steps(F.greatest(a, b), 100, 8.0), start, step, lambda s: s["h"])


def beta_part(x, a, b, rest=None) -> Column:
    """Regularised incomplete beta function I_x(a, b), a, b > 0.  ``rest`` is
    1 - x where the caller knows it better than the difference."""
    x, a, b = _column(x), _column(a), _column(b)
    rest = 1.0 - x if rest is None else _column(rest)
    log_x = F.when(x < 0.5, F.log(x)).otherwise(F.log1p(-rest))
    log_rest = F.when(rest < 0.5, F.log(rest)).otherwise(F.log1p(-x))
    front = F.exp(log_gamma_ratio(F.greatest(a, b), F.least(a, b)) - log_gamma(F.least(a, b)) + a * log_x + b * log_rest)
    low = front * _beta_fraction(x, a, b) / a
    high = 1.0 - front * _beta_fraction(rest, b, a) / b
    return F.when(x <= 0, 0.0).when(rest <= 0, 1.0).when(x < (a + 1.0) / (a + b + 2.0), low).otherwise(high)


def normal_two_sided(z) -> Column:
    """Probability that a standard normal variable is at least |z| away from 0."""
    z = _column(z)
    return gamma_tail(F.when(z.isNotNull(), 0.5), z * z / 2.0)


def t_two_sided(t, dof) -> Column:
    """The same for Student's t with ``dof`` degrees of freedom (null unless dof > 0)."""
    t, dof = _column(t), _column(dof)
    p = beta_part(dof / (dof + t * t), dof / 2.0, F.lit(0.5), t * t / (dof + t * t))
    # with very many degrees of freedom a corrected normal value is exact to their square
    near = normal_two_sided(t * (1.0 - 0.25 / dof) / F.sqrt(1.0 + t * t / (2.0 * dof)))
    return F.when(t.isNotNull() & (dof > 0), F.when(dof > 1e6, near).otherwise(p))


def chi_square_tail(x, dof) -> Column:
    """Probability of a chi-square value of at least ``x`` (null unless dof > 0)."""
    x, dof = _column(x), _column(dof)
    return F.when(dof > 0, gamma_tail(dof / 2.0, x / 2.0))
