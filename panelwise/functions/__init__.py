"""Scalar Column functions (all built-in Spark expressions, no Python UDF)."""

from .columns import (  # noqa: F401
    clip,
    cross_entropy,
    cross_entropy_grad,
    cross_entropy_hess,
    beta_grad,
    beta_hess,
    hash_or_null,
    hex_tail_to_uint64,
    ieee_ratio,
    logistic_grad,
    logistic_hess,
    safe_ratio,
    sigmoid,
    transition,
)
