"""Privacy formulas as column expressions and, for parameters, as plain numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SMALLEST_RHO = 1e-12


def rho_column(epsilon: Column, delta: Column) -> Column:
    """Zero-concentrated budget whose (epsilon, delta) guarantee is epsilon = rho + 2 sqrt(rho ln(1/delta))."""
    log_term = F.ln(F.lit(1.0) / delta)
    root = F.sqrt(log_term + epsilon) - F.sqrt(log_term)
    return F.greatest(root * root, F.lit(SMALLEST_RHO))


def sigma_column(rho: Column, queries: Column) -> Column:
    """Noise scale when ``queries`` counts of sensitivity 1 share ``rho`` equally."""
    return F.sqrt(queries.cast("double") / (F.lit(2.0) * rho))


def rho_for(epsilon: float, delta: float) -> float:
    if not epsilon > 0:
        raise ValueError("epsilon has to be positive")
    if not 0 < delta < 1:
        raise ValueError("delta has to lie strictly between 0 and 1")
    log_term = math.log(1.0 / delta)
    return max((math.sqrt(log_term + epsilon) - math.sqrt(log_term)) ** 2, SMALLEST_RHO)


def sigma_for(epsilon: float, delta: float, queries: int) -> float:
    return math.sqrt(queries / (2.0 * rho_for(epsilon, delta)))
