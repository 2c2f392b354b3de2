"""Calibrated Gaussian noise on cell tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabveil.functions.accounting import rho_column, rho_for, sigma_column
from tabveil.functions.keyed import gaussian, key_of
from tabveil.spec import PrivacyBudget


def _budget_rows(budgets: Sequence[PrivacyBudget]):
    return F.array(*[
        F.struct(
            F.lit(b.budget_id).alias("budget_id"), F.lit(b.epsilon).alias("epsilon"),
            F.lit(b.delta).alias("delta"),
        )
        for b in budgets
    ])


def budget_table(spark: SparkSession, budgets: Sequence[PrivacyBudget]) -> DataFrame:
    df = spark.createDataFrame(
        [(b.budget_id, b.epsilon, b.delta) for b in budgets],
        "budget_id int, epsilon double, delta double",
    )
    return df.withColumn("rho", rho_column(F.col("epsilon"), F.col("delta")))


def measure(
    cells: DataFrame,
    budgets: Sequence[PrivacyBudget],
    queries: int,
    seed: str,
    clip: bool = True,
    spent: float = 0.0,
) -> DataFrame:
    """Noisy counts of every cell under every budget, from one table of exact counts.

    The budget is part of the noise key: with one draw shared by two budgets, their two releases
    would give the exact count away. ``clip`` sets negative results to zero. ``spent``: what each budget has already paid (rho).
    """
    if queries < 1:
        raise ValueError("at least one marginal has to be measured")
    # A handful of budgets per cell, written out by an explode of a constant list.
    wide = cells.withColumn("b", F.explode(_budget_rows(budgets)))
    if spent >= min(rho_for(b.epsilon, b.delta) for b in budgets):
        raise ValueError("nothing is left of the budget")
    rho = rho_column(F.col("b.epsilon"), F.col("b.delta"))
    sigma = sigma_column(rho - F.lit(spent) if spent else rho, F.lit(queries))
    key = key_of(seed, "noise", F.col("b.budget_id"), F.col("marginal_id"), F.col("cell"))
    noisy = F.col("n").cast("double") + sigma * gaussian(key)
    return wide.select(
        F.col("b.budget_id").alias("budget_id"), F.col("b.epsilon").alias("epsilon"),
        "marginal_id", "cell", "n", sigma.alias("sigma"),
        (F.greatest(noisy, F.lit(0.0)) if clip else noisy).alias("noisy"),
    )


def released(measured: DataFrame) -> DataFrame:
    """Drop everything that may not leave the job: the exact count."""
    return measured.drop("n")


# What the data is used for, and whether the budget pays for it.
_USES = (
    ("bin edges", False), ("vocabularies", False), ("column ranking", False),
    ("row count", False), ("marginals", True),
)


def privacy_ledger(
    spark: SparkSession, budgets: Sequence[PrivacyBudget], queries: int, ranked: int = 0, spent: float = 0.0
) -> DataFrame:
    """Every use of the data per budget, and the share of rho charged for it; ``ranked`` choices may have been paid with ``spent``."""
    rows = []
    for b in budgets:
        rho = rho_for(b.epsilon, b.delta)
        for use, charged in _USES:
            paid = (ranked, spent) if use == "column ranking" and spent else (queries, rho - spent) if charged else (0, 0.0)
            rows.append((b.budget_id, b.epsilon, use, paid[0] > 0, *paid))
    return spark.createDataFrame(
        rows, "budget_id int, epsilon double, used_for string, charged boolean, queries int, rho double"
    )
