"""Exact ranks and exact quotas without sorting a whole group in one task.

Rows are ranked by a keyed uniform number ``u``. Its value range is cut into buckets; a count per
(group, bucket) gives each bucket's first rank, and only rows of the same bucket are sorted
together. The bucket count follows the number of rows, so a bucket stays small however large a
group is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabveil.session import lookup_side

ROWS_PER_BUCKET = 100_000
RANGE_CHUNK = 4096


def buckets_for(rows: int) -> int:
    return max(1, math.ceil(rows / ROWS_PER_BUCKET))


def bucket_of(u: Column, buckets: int) -> Column:
    return F.floor(u * F.lit(buckets)).cast("long")


def bucket_starts(counts: DataFrame, group: Sequence[str], bucket: str, n: str) -> DataFrame:
    """Running start of each bucket in its group; ``counts`` has one row per (group, bucket)."""
    before = W.partitionBy(*group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("start", F.coalesce(F.sum(n).over(before), F.lit(0)).cast("long"))


def rank_rows(
    df: DataFrame, group: Sequence[str], u: str, tie: str, rows: int, out: str = "rank"
) -> DataFrame:
    """0-based rank of each row in its group by (u, tie). ``df`` is read twice: stage it first."""
    buckets = buckets_for(rows)
    order = [F.col(u), F.col(tie)]
    if buckets == 1:
        window = W.partitionBy(*group).orderBy(*order)
        return df.withColumn(out, F.row_number().over(window).cast("long") - 1)
    marked = df.withColumn("_bucket", bucket_of(F.col(u), buckets))
    keys = [*group, "_bucket"]
    counts = marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    starts = bucket_starts(counts, group, "_bucket", "_n").select(*keys, "start")
    window = W.partitionBy(*keys).orderBy(*order)
    local = marked.withColumn("_local", F.row_number().over(window).cast("long") - 1)
    return (
        local.join(starts, keys)
        .withColumn(out, F.col("_local") + F.col("start"))
        .drop("_local", "start", "_bucket")
    )


def pick_smallest(
    df: DataFrame,
    group: Sequence[str],
    u: str,
    tie: str,
    quota_of,
    groups: int,
    buckets: int,
    out: str = "picked",
) -> DataFrame:
    """Flag the ``quota`` rows of each group with the smallest (u, tie).

    ``quota_of(group_counts)`` takes one row per group (group columns, n) and adds ``quota``;
    ``groups`` is the number of groups. Only rows of the bucket that straddles a group's quota are
    shuffled; all others are decided where they lie. ``df`` is read three times: stage it first.
    """
    marked = df.withColumn("_bucket", bucket_of(F.col(u), buckets))
    keys = [*group, "_bucket"]
    counts = marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.groupBy(*group).agg(F.sum("_n").alias("n"))
    starts = bucket_starts(counts, group, "_bucket", "_n")
    quotas = quota_of(totals).select(*group, "quota")
    plan = starts.join(lookup_side(quotas, groups), list(group)).select(
        *keys, (F.col("quota") - F.col("start")).alias("_left"), "_n"
    )
    decided = marked.join(lookup_side(plan, groups * buckets), keys).withColumn(
        "_straddles", (F.col("_left") > 0) & (F.col("_left") < F.col("_n"))
    )
    whole = decided.filter(~F.col("_straddles")).withColumn(out, F.col("_left") >= F.col("_n"))
    window = W.partitionBy(*keys).orderBy(u, tie)
    part = decided.filter("_straddles").withColumn(
        out, F.row_number().over(window) <= F.col("_left")
    )
    columns = [*df.columns, out]
    return whole.select(*columns).unionByName(part.select(*columns))


def largest_remainder_quotas(totals: DataFrame, group: Sequence[str], share: float) -> DataFrame:
    """Split ceil(share * N) over the groups in proportion to their size.

    ``totals`` has one row per class of the target, so windows over it are small.
    """
    everything = W.partitionBy()
    total = F.sum("n").over(everything)
    wanted = F.ceil(total * F.lit(share))
    exact = F.col("n") * wanted / total
    base = F.floor(exact)
    shares = totals.select(
        *group, "n", wanted.alias("_wanted"), base.alias("_base"), (exact - base).alias("_rest")
    )
    order = W.partitionBy().orderBy(F.desc("_rest"), *group)
    spare = F.col("_wanted") - F.sum("_base").over(everything)
    return shares.select(
        *group, (F.col("_base") + (F.row_number().over(order) <= spare).cast("long")).alias("quota")
    )


def expand_ranges(df: DataFrame, low: Column, high: Column, out: str) -> DataFrame:
    """One row per integer in [low, high). Long ranges are cut into chunks that are spread first."""
    chunk = F.lit(RANGE_CHUNK).cast("long")
    ranges = df.withColumn("_low", low).withColumn("_high", high).filter("_low < _high")
    chunks = ranges.withColumn(
        "_from", F.explode(F.sequence(F.col("_low"), F.col("_high") - 1, chunk))
    )
    long_ranges = chunks.filter(F.col("_high") - F.col("_low") > chunk).repartition(
        *[F.col(c) for c in ("_low", "_high", "_from")]
    )
    short_ranges = chunks.filter(F.col("_high") - F.col("_low") <= chunk)
    last = F.least(F.col("_from") + chunk, F.col("_high")) - 1
    return (
        short_ranges.unionByName(long_ranges)
        .withColumn(out, F.explode(F.sequence(F.col("_from"), last)))
        .drop("_low", "_high", "_from")
    )
