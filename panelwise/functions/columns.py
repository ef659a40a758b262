"""Column expressions used by the operators.

Everything here composes built-in functions, so it stays inside whole-stage
code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
NAN = float("nan")


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` with NULL where ``den`` is 0 or either side is NULL.

    This is the cleaned form of the reference's ratio: x/0 gives inf and 0/0
    NaN there, and its filter turns both into null afterwards."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ieee_ratio(num: Column, den: Column) -> Column:
    """``num / den`` with IEEE results for a zero denominator: +-inf for
    x/0 and NaN for 0/0 (the raw ratio before any cleaning)."""
    n, d = num.cast("double"), den.cast("double")
    zero = (F.when(n > 0, F.lit(INF)).when(n < 0, F.lit(-INF))
            .when(n == 0, F.lit(NAN)).otherwise(F.lit(NAN)))
    return F.when(d == 0, zero).otherwise(F.try_divide(n, d))


def transition(current: Column, previous: Column) -> Column:
    """``"current->previous"``; NULL when either side is NULL."""
    return F.concat(current.cast("string"), F.lit("->"), previous.cast("string"))


def hash_or_null(c: Column) -> Column:
    """64-bit hash of a value; NULL stays NULL (``xxhash64(NULL)`` is 42)."""
    return F.when(c.isNotNull(), F.xxhash64(c))


def hex_tail_to_uint64(c: Column, digits: int = 16) -> Column:
    """Last ``digits`` hexadecimal characters as an unsigned integer
    (full 64-bit range, so the result is ``decimal(20,0)``)."""
    return F.conv(F.substring(c, -digits, digits), 16, 10).cast("decimal(20,0)")


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c.cast("double")))


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.least(c, F.lit(hi)), F.lit(lo))


# These closed forms must equal the reference's.
# Binary cross-entropy with an epsilon, as a log-likelihood (positive sign):
#   t*log(p+e) + (1-t+e)*log(1-p+e)
# and its first and second derivative in p.

def cross_entropy(t: Column, p: Column, eps: float = 1e-7) -> Column:
    e = F.lit(eps)
    return t * F.log(p + e) + (F.lit(1.0) - t + e) * F.log(F.lit(1.0) - p + e)


def cross_entropy_grad(t: Column, p: Column, eps: float = 1e-7) -> Column:
    e = F.lit(eps)
    return t / (p + e) - (F.lit(1.0) - t + e) / (F.lit(1.0) - p + e)


def cross_entropy_hess(t: Column, p: Column, eps: float = 1e-7) -> Column:
    e = F.lit(eps)
    return -t / F.pow(p + e, 2) - (F.lit(1.0) - t + e) / F.pow(F.lit(1.0) - p + e, 2)


def logistic_grad(t: Column, raw: Column) -> Column:
    """Gradient of the log-loss in the raw score: sigmoid(s) - t."""
    return sigmoid(raw) - t


def logistic_hess(t: Column, raw: Column) -> Column:
    p = sigmoid(raw)
    return p * (F.lit(1.0) - p)


def beta_grad(t: Column, raw: Column, beta: float) -> Column:
    """Gradient of the beta-weighted log-loss: p*(b - b*t + t) - t."""
    p, b = sigmoid(raw), F.lit(float(beta))
    return p * (b - b * t + t) - t


def beta_hess(t: Column, raw: Column, beta: float) -> Column:
    p, b = sigmoid(raw), F.lit(float(beta))
    return (t + b - b * t) * p * (F.lit(1.0) - p)
