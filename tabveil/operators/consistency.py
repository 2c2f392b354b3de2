"""Making noisy marginals agree with each other."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabveil.operators.marginals import projected_cell, projection_table
from tabveil.session import Journal, fingerprint, lookup_side, stage
from tabveil.spec import Marginal

# Rounds between two writes of the cell table; keeps plans short.
ROUNDS_PER_STAGE = 4


def normalise(cells: DataFrame, total, value: str = "value") -> DataFrame:
    """Non-negative counts that sum to ``total`` per table; an empty table becomes uniform.

    A window holds one marginal's cells, which ``check_tables`` bounds.
    """
    table = W.partitionBy("budget_id", "marginal_id")
    kept = F.greatest(F.col(value), F.lit(0.0))
    mass = F.sum(kept).over(table)
    goal = total if not isinstance(total, (int, float)) else F.lit(float(total))
    scaled = F.when(mass <= 0, goal / F.count(F.lit(1)).over(table)).otherwise(kept * (goal / mass))
    return cells.withColumn(value, scaled)


def projections(marginals: Sequence[Marginal]) -> list[tuple[Marginal, Marginal]]:
    """(longer, shorter) for every shorter marginal of the workload inside a longer one."""
    by_attrs = {m.attrs: m for m in marginals}
    found = []
    for m in marginals:
        for ways in range(1, len(m.attrs)):
            for attrs in combinations(m.attrs, ways):
                if attrs in by_attrs:
                    found.append((m, by_attrs[attrs]))
    return found


def pull_together(cells: DataFrame, marginals: Sequence[Marginal], sizes, value: str = "value") -> DataFrame:
    """Move every shorter marginal half-way to the mean of what the longer ones imply.

    All projections use the tables as they were before the step. One cell sends its own value and
    its share of each projection; one aggregate combines them.
    """
    found = projections(marginals)
    if not found:
        return cells
    sources = Counter(short.marginal_id for _, short in found)
    table = projection_table(
        cells.sparkSession, [(m, m) for m in marginals] + found, sizes
    )
    shares = F.create_map(*[F.lit(v) for i, k in sources.items() for v in (i, 1.0 / k)])
    own = F.col("to_id") == F.col("marginal_id")
    pieces = cells.join(lookup_side(table, len(marginals) + len(found)), "marginal_id").select(
        "budget_id", F.col("to_id").alias("marginal_id"), projected_cell(table).alias("cell"),
        F.when(own, F.col(value)).alias("own"),
        F.when(~own, F.col(value) * F.try_element_at(shares, F.col("to_id"))).alias("implied"),
    )
    # One shuffle by table serves this aggregate and the next round's window over the table.
    by_table = pieces.repartition("budget_id", "marginal_id")
    combined = by_table.groupBy("budget_id", "marginal_id", "cell").agg(
        F.sum("own").alias("own"), F.sum("implied").alias("implied")
    )
    moved = F.when(
        F.col("implied").isNotNull(), F.lit(0.5) * F.col("own") + F.lit(0.5) * F.col("implied")
    ).otherwise(F.col("own"))
    return combined.select(
        "budget_id", "marginal_id", "cell", F.greatest(moved, F.lit(0.0)).alias(value)
    )


def make_consistent(
    noisy: DataFrame, marginals: Sequence[Marginal], sizes, total, rounds: int = 8, journal: str | None = None
) -> DataFrame:
    """``rounds`` rounds of normalising and pulling together; ``noisy`` has a column ``value``.

    With a ``journal`` folder a run that was stopped goes on after the last rounds it wrote there.
    """
    cells = noisy.select("budget_id", "marginal_id", "cell", "value")
    begin, book = 0, None
    if journal:
        tables = [(m.marginal_id, m.attrs) for m in marginals]
        book = Journal(noisy.sparkSession, journal, "consistency", tables, sorted(sizes.items()), total, fingerprint(cells))
        if found := book.last(rounds - 1, cells.schema):
            begin, cells = found
    for done in range(begin + 1, rounds + 1):
        cells = pull_together(normalise(cells, total), marginals, sizes)
        if done % ROUNDS_PER_STAGE == 0 and done < rounds:
            cells = book.write(cells, done) if book else stage(cells, "cells")
    return normalise(cells, total)
