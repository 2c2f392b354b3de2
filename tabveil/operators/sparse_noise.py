"""Noisy counts of marginals whose domain is too large to write out.

Every cell gets noise, also an empty one, or the released cells would tell which are not empty. But only cells whose noisy count reaches a threshold
are released, and of a hundred million empty cells few do. So their noise is drawn lazily (Cormode et al. 2012): how many reach the
threshold is one binomial draw, which ones they are is a keyed sample of the empty cells, and each one's count is a draw from the noise's
tail. The result is distributed as if all cells had been written, noised and cut at the threshold, which depends on the
size of the domain and the noise alone.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from functools import reduce
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabveil.functions.accounting import sigma_for
from tabveil.functions.cells import cell_of, table_size
from tabveil.functions.keyed import RANGE, gaussian, key_of, uniform
from tabveil.operators.ranks import buckets_for, pick_smallest
from tabveil.session import stage
from tabveil.spec import Marginal, PrivacyBudget

# So many empty cells are expected among the released ones.
MOST_EMPTY = 100_000
STANDARD = NormalDist()


def threshold_for(size: int, sigma: float, most_empty: int = MOST_EMPTY) -> float:
    """The count that ``most_empty`` of ``size`` empty cells are expected to reach; zero at least."""
    return sigma * max(0.0, -STANDARD.inv_cdf(min(0.5, most_empty / size)))


def empty_survivors(empty: int, sigma: float, threshold: float, *key) -> int:
    """How many of the empty cells reach the threshold."""
    seed = int(hashlib.sha256("|".join(map(str, key)).encode()).hexdigest()[:32], 16)
    return int(np.random.default_rng(seed).binomial(empty, 0.5 * math.erfc(threshold / (sigma * math.sqrt(2)))))


def sampled_empty(held: DataFrame, size: int, filled: int, wanted: int, *key) -> DataFrame:
    """``wanted`` distinct cells that are not in ``held`` (cell): the first ones of a keyed sequence of cells."""
    spark, draws = held.sparkSession, wanted
    while True:
        # Repeated and filled cells don't count, so more are drawn until there are enough.
        draws = math.ceil(draws * 1.1 * size / max(size - filled - wanted, 1)) + 64
        drawn = spark.range(draws).select("id", F.floor(uniform(key_of(*key, F.col("id"))) * F.lit(size)).cast("long").alias("cell"))
        fresh = stage(drawn.groupBy("cell").agg(F.min("id").alias("id")).join(held.select("cell"), "cell", "left_anti"), "empty-cells")
        if fresh.count() >= wanted:
            break
    if not wanted:
        return fresh.select("cell").limit(0)
    placed = fresh.withColumn("_all", F.lit(0)).withColumn("_u", F.col("id") / F.lit(float(draws)))
    return pick_smallest(
        placed, ["_all"], "_u", "id", lambda totals: totals.withColumn("quota", F.lit(wanted).cast("long")), groups=1, buckets=buckets_for(draws) * 4
    ).filter("picked").select("cell")


def tail_draws(cells: DataFrame, sigma: float, threshold: float, *key) -> DataFrame:
    """(cell, noisy): noise of the cells, given that it reaches the threshold."""
    share = 0.5 * math.erfc(threshold / (sigma * math.sqrt(2)))
    # 52 bits of a cryptographic hash, in (0, 1].
    digits = F.conv(F.substring(F.sha2(key_of(*key, F.col("cell")), 256), 1, 13), 16, 10).cast("double")
    drawn = cells.select("cell", ((digits + 1) / F.lit(RANGE)).alias("u"))

    def tail(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            noise = [-sigma * STANDARD.inv_cdf(u * share) for u in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(noise, pa.float64())], ["cell", "noisy"])

    return drawn.mapInArrow(tail, "cell long, noisy double")


def measure_sparse(
    coded: DataFrame, m: Marginal, sizes, budgets: Sequence[PrivacyBudget], queries: int, seed: str, most_empty: int = MOST_EMPTY
) -> DataFrame:
    """(budget_id, epsilon, marginal_id, cell, sigma, threshold, noisy) of the cells that reach each budget's threshold.

    The work follows the filled cells and the released ones, not the domain. Codes outside the domain are an error.
    """
    size = table_size(m.attrs, sizes)
    bad = [(F.col(a).isNull() | (F.col(a) < 0) | (F.col(a) >= sizes[a])) for a in m.attrs]
    checked = F.when(reduce(lambda x, y: x | y, bad), F.raise_error(F.lit("a code is missing or outside its domain")).cast("long"))
    filled = stage(coded.select(checked.otherwise(cell_of(m.attrs, sizes)).alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n")), "filled")
    n_filled = filled.count()
    parts = []
    for b in budgets:
        sigma = sigma_for(b.epsilon, b.delta, queries)
        threshold = threshold_for(size, sigma, most_empty)
        key = (seed, "sparse", b.budget_id, m.marginal_id)
        noise = F.lit(sigma) * gaussian(key_of(seed, "noise", b.budget_id, m.marginal_id, F.col("cell")))
        seen = filled.select("cell", (F.col("n") + noise).alias("noisy")).filter(F.col("noisy") >= threshold)
        wanted = empty_survivors(size - n_filled, sigma, threshold, *key, "number")
        places = sampled_empty(filled, size, n_filled, wanted, *key, "place")
        unseen = tail_draws(places, sigma, threshold, *key, "tail")
        parts.append(seen.unionByName(unseen).select(
            F.lit(b.budget_id).alias("budget_id"), F.lit(b.epsilon).alias("epsilon"), F.lit(m.marginal_id).alias("marginal_id"), "cell",
            F.lit(sigma).alias("sigma"), F.lit(threshold).alias("threshold"), "noisy",
        ))
    return reduce(DataFrame.unionByName, parts)
