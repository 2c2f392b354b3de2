"""Exact linear-interpolation quantiles of many columns at once.

Every wanted order statistic lies in an interval of values. A scan cuts all open intervals into
equal bins (equal in the ordering of floating-point numbers, so that any distribution narrows at
the same rate), counts them, and keeps the bin that holds the wanted rank, shrunk to its values. When few values are left
in the open intervals, only those are ranked. A scan returns bin counts, never values.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Bins per open interval and scan.
BINS = 1024
# Open intervals holding at most this many values in total are ranked.
RANKED_VALUES = 1_000_000


@dataclass
class _Open:
    """An interval [low, high] of positions that holds ranks ``first`` and ``second`` of a column."""

    column: int
    ranks: tuple[int, ...]
    low: int
    high: int
    below: int
    inside: int


def positions(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in the same order as the numbers."""
    bits = (values + 0.0).view(np.int64)
    flipped = np.where(bits < 0, ~bits, bits | np.int64(-(2**63)))
    return flipped.view(np.uint64)


def number_at(position: int) -> float:
    bits = position - 2**63 if position >= 2**63 else ~position
    return float(np.array([bits], dtype=np.int64).view(np.float64)[0])


def _signed(unsigned: np.ndarray) -> np.ndarray:
    """Positions as signed integers of the same order, the type a table can hold."""
    return (unsigned ^ np.uint64(2**63)).view(np.int64)


def _usable(column: str):
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    bins: int = BINS,
    ranked_values: int = RANKED_VALUES,
) -> dict[str, list[float]]:
    """Quantiles per column, nulls ignored. The result is one short list per column."""
    values = df.select(*[_usable(c).alias(c) for c in columns])
    summary = values.agg(*[
        F.struct(
            F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high")
        ).alias(c)
        for c in columns
    ]).first()
    found: dict[tuple[int, int], float] = {}
    open_: list[_Open] = []
    for i, c in enumerate(columns):
        n, low, high = summary[c]["n"], summary[c]["low"], summary[c]["high"]
        if n == 0:
            raise ValueError(f"{c} has no values")
        ranks = sorted({r for p in probs for r in _ranks(n, p)[:2]})
        first, last = positions(np.array([low, high]))
        open_.append(_Open(i, tuple(ranks), int(first), int(last), 0, n))
    while True:
        for o in open_:
            if o.low == o.high:
                found |= {(o.column, r): number_at(o.low) for r in o.ranks}
        open_ = [o for o in open_ if o.low != o.high]
        if not open_ or sum(o.inside for o in open_) <= ranked_values:
            break
        open_ = _narrow(values, open_, bins)
    if open_:
        found |= _ranked(values, columns, open_)
    return {
        c: [_interpolated(found, i, summary[c]["n"], p) for p in probs] for i, c in enumerate(columns)
    }


def _ranks(n: int, prob: float) -> tuple[int, int, float]:
    position = (n - 1) * prob
    first = math.floor(position)
    return first, min(first + 1, n - 1) if position > first else first, position - first


def _interpolated(found, column: int, n: int, prob: float) -> float:
    first, second, weight = _ranks(n, prob)
    low, high = found[column, first], found[column, second]
    return low + (high - low) * weight


def _narrow(values: DataFrame, open_: list[_Open], bins: int) -> list[_Open]:
    """One scan: count the bins of every open interval and keep those that hold a rank."""
    plans = [(o.column, o.low, o.high, -(-(o.high - o.low + 1) // bins)) for o in open_]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(plans), bins), dtype=np.int64)
        lowest = np.full((len(plans), bins), np.iinfo(np.uint64).max, dtype=np.uint64)
        highest = np.zeros((len(plans), bins), dtype=np.uint64)
        for batch in batches:
            placed = [positions(_present(batch.column(i))) for i in range(batch.num_columns)]
            for i, (column, low, high, width) in enumerate(plans):
                p = placed[column]
                p = p[(p >= np.uint64(low)) & (p <= np.uint64(high))]
                index = ((p - np.uint64(low)) // np.uint64(width)).astype(np.int64)
                totals[i] += np.bincount(index, minlength=bins)
                np.minimum.at(lowest[i], index, p)
                np.maximum.at(highest[i], index, p)
        interval, place = np.nonzero(totals)
        at = (interval, place)
        yield pa.RecordBatch.from_arrays(
            [pa.array(interval), pa.array(place), pa.array(totals[at]),
             pa.array(_signed(lowest[at])), pa.array(_signed(highest[at]))],
            names=["interval", "bin", "n", "low", "high"],
        )

    counted = values.mapInArrow(count, "interval long, bin long, n long, low long, high long")
    counts = counted.groupBy("interval", "bin").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    upto = W.partitionBy("interval").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    running = counts.withColumn("end", F.sum("n").over(upto))
    wanted = values.sparkSession.createDataFrame(
        [(i, r - o.below) for i, o in enumerate(open_) for r in o.ranks], "interval long, rank long"
    )
    hits = running.join(F.broadcast(wanted), "interval").filter(
        (F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n"))
    )
    kept: dict[tuple[int, int], _Open] = {}
    for r in hits.collect():  # one row per wanted rank
        o = open_[r["interval"]]
        entry = kept.setdefault((r["interval"], r["bin"]), _Open(
            o.column, (), r["low"] + 2**63, r["high"] + 2**63, o.below + r["end"] - r["n"], r["n"]
        ))
        entry.ranks = tuple(sorted({*entry.ranks, r["rank"] + o.below}))
    return list(kept.values())


def _present(column: pa.Array) -> np.ndarray:
    return column.drop_null().to_numpy(zero_copy_only=False)


def _ranked(values: DataFrame, columns: Sequence[str], open_: list[_Open]) -> dict:
    """Order statistics of the few values that lie in open intervals."""
    plans = [(o.column, o.low, o.high) for o in open_]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            present = [_present(batch.column(i)) for i in range(batch.num_columns)]
            placed = [positions(v) for v in present]
            for i, (column, low, high) in enumerate(plans):
                p = placed[column]
                inside = present[column][(p >= np.uint64(low)) & (p <= np.uint64(high))]
                value, n = np.unique(inside, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(value), i)), pa.array(value), pa.array(n)],
                    names=["interval", "value", "n"],
                )

    inside = values.mapInArrow(pick, "interval long, value double, n long")
    counts = inside.groupBy("interval", "value").agg(F.sum("n").alias("n"))
    upto = W.partitionBy("interval").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    wanted = values.sparkSession.createDataFrame(
        [(i, r, r - o.below) for i, o in enumerate(open_) for r in o.ranks],
        "interval long, rank long, place long",
    )
    placed = counts.withColumn("end", F.sum("n").over(upto)).join(F.broadcast(wanted), "interval")
    hits = placed.filter(
        (F.col("place") < F.col("end")) & (F.col("place") >= F.col("end") - F.col("n"))
    )
    # One row per wanted rank.
    return {(open_[r["interval"]].column, r["rank"]): r["value"] for r in hits.collect()}
