"""Stratified splits, resampling to an exact size, and training batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabveil.functions.keyed import key_of, uniform
from tabveil.operators.ranks import (
    buckets_for,
    largest_remainder_quotas,
    pick_smallest,
    rank_rows,
)

# Even small tables use a few buckets, so that tests take the same path as large runs.
FEWEST_BUCKETS = 16


def stratified_split(
    df: DataFrame, target: str, row_key: str, test_share: float, seed: str
) -> DataFrame:
    """Add ``is_test``: exactly ceil(share * N) rows, spread over the classes by largest remainder.

    ``row_key`` has to be unique. ``df`` is read several times: stage it first.
    """
    if not 0 < test_share < 1:
        raise ValueError("test_share has to lie strictly between 0 and 1")
    rows, classes = df.agg(F.count(F.lit(1)), F.countDistinct(target)).first()
    keyed = df.withColumn("_u", uniform(key_of(seed, "split", F.col(row_key))))
    return pick_smallest(
        keyed, [target], "_u", row_key,
        lambda totals: largest_remainder_quotas(totals, [target], test_share),
        groups=classes, buckets=max(FEWEST_BUCKETS, buckets_for(rows)), out="is_test",
    ).drop("_u")


def resample(
    df: DataFrame, row_key: str, have: int, want: int, seed: str, out: str = "row_id"
) -> DataFrame:
    """Exactly ``want`` rows: a subset if there are enough, draws with replacement if not.

    The result carries a new dense ``row_id``. ``df`` is read several times: stage it first.
    """
    if have < 1:
        raise ValueError("cannot resample an empty table")
    keyed = df.withColumn("_all", F.lit(0)).withColumn(
        "_u", uniform(key_of(seed, "resample", F.col(row_key)))
    )
    if have >= want:
        picked = pick_smallest(
            keyed, ["_all"], "_u", row_key,
            lambda totals: totals.withColumn("quota", F.lit(want).cast("long")),
            groups=1, buckets=max(FEWEST_BUCKETS, buckets_for(have)),
        ).filter("picked")
        return rank_rows(picked, ["_all"], "_u", row_key, want, out).drop("_u", "_all", "picked")
    numbered = rank_rows(keyed, ["_all"], "_u", row_key, have, "_number").drop("_u", "_all")
    draws = df.sparkSession.range(want).withColumnRenamed("id", out).withColumn(
        "_number",
        F.floor(uniform(key_of(seed, "draw", F.col(out))) * F.lit(have)).cast("long"),
    )
    return draws.join(numbered, "_number").drop("_number")


def fixed_batches(
    df: DataFrame, row_key: str, rows: int, batch_size: int, seed: str, epoch: int = 0,
    drop_last: bool = True,
) -> DataFrame:
    """Shuffle by key and number the batches; the last partial batch is left out unless asked for."""
    batches = batches_in(rows, batch_size, drop_last)
    keyed = df.withColumn("_all", F.lit(0)).withColumn(
        "_u", uniform(key_of(seed, "batch", epoch, F.col(row_key)))
    )
    ranked = rank_rows(keyed, ["_all"], "_u", row_key, rows, "_rank")
    return (
        ranked.withColumn("batch", F.floor(F.col("_rank") / F.lit(batch_size)).cast("long"))
        .withColumn("place", F.pmod(F.col("_rank"), F.lit(batch_size)).cast("long"))
        .filter(F.col("batch") < batches)
        .drop("_u", "_all", "_rank")
    )


def poisson_batch(df: DataFrame, row_key: str, rate: float, seed: str, step: int) -> DataFrame:
    """Each row joins the step's batch independently with probability ``rate``: a filter, no shuffle."""
    if not 0 < rate <= 1:
        raise ValueError("rate has to lie in (0, 1]")
    return df.filter(uniform(key_of(seed, "poisson", step, F.col(row_key))) < F.lit(rate))


def batches_in(rows: int, batch_size: int, drop_last: bool = True) -> int:
    return rows // batch_size if drop_last else -(-rows // batch_size)
