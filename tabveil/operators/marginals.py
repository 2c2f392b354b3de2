"""Contingency tables of many marginals in one pass, as long cell tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabveil.functions.cells import CELL_BITS, cell_of, code_in, strides, table_size, unpack
from tabveil.session import lookup_side
from tabveil.spec import Marginal

# A marginal beyond this many cells is refused: every cell, also an empty one, has to get noise.
LARGEST_TABLE = 10_000_000
# Up to this many cells in all, a task adds up its rows in arrays (8 bytes per cell).
ARRAY_CELLS = 4_000_000


def check_tables(marginals: Iterable[Marginal], sizes: Mapping[str, int]) -> None:
    for m in marginals:
        cells = table_size(m.attrs, sizes)
        if cells > LARGEST_TABLE:
            raise ValueError(f"marginal {m.attrs} has {cells} cells, more than {LARGEST_TABLE}")


def count_cells(
    coded: DataFrame,
    marginals: Sequence[Marginal],
    sizes: Mapping[str, int],
    weight: str | None = None,
    array_cells: int = ARRAY_CELLS,
) -> DataFrame:
    """Non-empty cells of every marginal: (marginal_id, cell, n), from one scan.

    Each task adds up its own rows first, so the shuffle carries at most one partial count per cell
    and task, however the rows are distributed over the cells.
    """
    if not marginals:
        raise ValueError("no marginals to count")
    if any(table_size(m.attrs, sizes) >= 1 << CELL_BITS for m in marginals):
        raise ValueError("a cell number does not fit the packed key")
    total = sum(table_size(m.attrs, sizes) for m in marginals)
    if total <= array_cells:
        partial = _array_counts(coded, marginals, sizes, weight)
    else:
        partial = _exploded(coded, marginals, sizes, weight)
    kind = "double" if weight else "long"
    marginal_id, cell = unpack(F.col("packed"))
    return (
        partial.groupBy("packed").agg(F.sum("n").cast(kind).alias("n"))
        .select(marginal_id.alias("marginal_id"), cell.alias("cell"), "n")
    )


def _attributes(marginals: Sequence[Marginal]) -> list[str]:
    return list(dict.fromkeys(a for m in marginals for a in m.attrs))


def _checked(attr: str, size: int) -> Column:
    """The code; a missing one or one outside the domain fails the job, however cells are counted."""
    code = F.col(attr).cast("long")
    wrong = F.raise_error(F.lit(f"a code of {attr} is missing or not in 0 .. {size - 1}"))
    return F.when((code >= 0) & (code < size), code).otherwise(wrong.cast("long"))


def _array_counts(coded, marginals, sizes, weight) -> DataFrame:
    attrs = _attributes(marginals)
    plans = [
        (m.marginal_id << CELL_BITS, table_size(m.attrs, sizes),
         [(attrs.index(a), s) for a, s in zip(m.attrs, strides(m.attrs, sizes))])
        for m in marginals
    ]
    columns = [F.col(a).cast("long").alias(a) for a in attrs]
    if weight:
        columns.append(F.col(weight).cast("double").alias("_weight"))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(size) for _, size, _ in plans]
        seen = [np.zeros(size, dtype=bool) for _, size, _ in plans] if weight else None
        for batch in batches:
            codes = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(attrs))]
            for i, (attr, code) in enumerate(zip(attrs, codes)):
                # As ``_checked``, once for a batch.
                if batch.column(i).null_count or (len(code) and (code.min() < 0 or code.max() >= sizes[attr])):
                    raise ValueError(f"a code of {attr} is missing or not in 0 .. {sizes[attr] - 1}")
            w = batch.column(len(attrs)).to_numpy() if weight else None
            for i, (_, size, terms) in enumerate(plans):
                cell = sum(codes[a] * s for a, s in terms)
                totals[i] += np.bincount(cell, weights=w, minlength=size)
                if seen is not None:
                    seen[i][cell] = True
        for i, (base, _, _) in enumerate(plans):
            filled = np.nonzero(totals[i] if seen is None else seen[i])[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(filled + base), pa.array(totals[i][filled])], names=["packed", "n"]
            )

    return coded.select(*columns).mapInArrow(add_up, "packed long, n double")


def _exploded(coded, marginals, sizes, weight) -> DataFrame:
    """One row per row and marginal; the terms are data, so the generated code stays short."""
    attrs = _attributes(marginals)
    width = max(len(m.attrs) for m in marginals)
    plans = []
    for m in marginals:
        terms = list(zip((attrs.index(a) for a in m.attrs), strides(m.attrs, sizes)))
        terms += [(0, 0)] * (width - len(terms))
        plans.append(F.struct(
            F.lit(m.marginal_id << CELL_BITS).cast("long").alias("base"),
            *[F.lit(a).alias(f"a{i}") for i, (a, _) in enumerate(terms)],
            *[F.lit(s).cast("long").alias(f"s{i}") for i, (_, s) in enumerate(terms)],
        ))
    n = F.col(weight).cast("double") if weight else F.lit(1).cast("long")
    rows = coded.select(
        F.array(*[_checked(a, sizes[a]) for a in attrs]).alias("codes"),
        n.alias("n"), F.explode(F.array(*plans)).alias("p"),
    )
    packed = F.col("p.base")
    for i in range(width):
        packed = packed + F.get(F.col("codes"), F.col(f"p.a{i}")) * F.col(f"p.s{i}")
    return rows.select(packed.alias("packed"), "n")


def marginal_table(spark: SparkSession, marginals: Sequence[Marginal], sizes) -> DataFrame:
    """The workload as a table: one row per marginal."""
    rows = [
        (m.marginal_id, i, list(m.attrs), m.kind, m.score, table_size(m.attrs, sizes))
        for i, m in enumerate(marginals)
    ]
    schema = "marginal_id int, ord int, attrs array<string>, kind string, score double, size long"
    return spark.createDataFrame(rows, schema)


def with_empty_cells(counts: DataFrame, marginals: Sequence[Marginal], sizes) -> DataFrame:
    """Every cell of every marginal; noising only the observed ones would reveal which are empty."""
    check_tables(marginals, sizes)
    total = sum(table_size(m.attrs, sizes) for m in marginals)
    tables = marginal_table(counts.sparkSession, marginals, sizes).select("marginal_id", "size")
    grid = tables.select(
        "marginal_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1)).alias("cell")
    )
    # Counts have at most one row per grid cell, so the grid's size bounds them.
    return grid.join(lookup_side(counts, total), ["marginal_id", "cell"], "left").select(
        "marginal_id", "cell", F.coalesce(F.col("n"), F.lit(0)).cast(counts.schema["n"].dataType).alias("n")
    )


def dense_cells(coded: DataFrame, marginals: Sequence[Marginal], sizes) -> DataFrame:
    return with_empty_cells(count_cells(coded, marginals, sizes), marginals, sizes)


def grouping_set_counts(coded: DataFrame, marginals: Sequence[Marginal], sizes) -> DataFrame:
    """The same counts as one GROUPING SETS aggregate; wide workloads are faster in count_cells."""
    attrs = _attributes(marginals)
    grouped = coded.groupingSets(
        [[F.col(a) for a in m.attrs] for m in marginals], *[F.col(a) for a in attrs]
    ).agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("n"))
    marginal_id, cell = F.lit(None).cast("int"), F.lit(None).cast("long")
    for m in marginals:
        bits = sum(1 << (len(attrs) - 1 - i) for i, a in enumerate(attrs) if a not in m.attrs)
        chosen = F.col("_set") == bits
        marginal_id = F.when(chosen, F.lit(m.marginal_id)).otherwise(marginal_id)
        cell = F.when(chosen, cell_of(m.attrs, sizes)).otherwise(cell)
    return grouped.select(marginal_id.alias("marginal_id"), cell.alias("cell"), "n")


def tuple_counts(coded: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """Observed combinations of a few columns."""
    return coded.groupBy(*attrs).agg(F.count(F.lit(1)).alias("n"))


def projection_table(
    spark: SparkSession, found: Sequence[tuple[Marginal, Marginal]], sizes
) -> DataFrame:
    """How cells of one marginal map to cells of another: one row per (source, kept) pair.

    The kept cell is the sum over terms of ((cell div step) mod size) * stride.
    """
    width = max(len(short.attrs) for _, short in found)
    rows = []
    for long, short in found:
        steps = dict(zip(long.attrs, strides(long.attrs, sizes)))
        terms = [
            (steps[a], sizes[a], stride)
            for a, stride in zip(short.attrs, strides(short.attrs, sizes))
        ]
        terms += [(1, 1, 0)] * (width - len(terms))
        rows.append((long.marginal_id, short.marginal_id, *[v for t in terms for v in t]))
    terms_schema = ", ".join(f"step{i} long, size{i} long, stride{i} long" for i in range(width))
    return spark.createDataFrame(rows, f"marginal_id int, to_id int, {terms_schema}")


def projected_cell(table: DataFrame) -> Column:
    """The kept cell of a row of cells joined with ``projection_table``."""
    width = sum(c.startswith("step") for c in table.columns)
    return F.expr(" + ".join(f"((cell div step{i}) % size{i}) * stride{i}" for i in range(width)))


def project_cells(
    cells: DataFrame, found: Sequence[tuple[Marginal, Marginal]], sizes, value: str = "n"
) -> DataFrame:
    """Sum tables down to subsets of their attributes: (marginal_id of the subset, cell, value)."""
    kind = cells.schema[value].dataType
    table = projection_table(cells.sparkSession, found, sizes)
    return (
        cells.join(lookup_side(table, len(found)), "marginal_id")
        .groupBy(F.col("to_id").alias("marginal_id"), projected_cell(table).alias("cell"))
        .agg(F.sum(value).cast(kind).alias(value))
    )


def cells_from_pairs(
    pair_counts: DataFrame, pairs: Sequence[Marginal], wanted: Sequence[Marginal], sizes
) -> DataFrame:
    """1- and 2-way counts taken from an existing table of pair counts, without reading rows again."""
    found = []
    for m in wanted:
        source = next((p for p in pairs if set(m.attrs) <= set(p.attrs)), None)
        if source is None:
            raise ValueError(f"{m.attrs} is not contained in a counted pair")
        found.append((source, m))
    return project_cells(pair_counts, found, sizes)


def cell_codes(cells: DataFrame, m: Marginal, sizes) -> DataFrame:
    """One code column per attribute for the cells of one marginal."""
    return cells.filter(F.col("marginal_id") == m.marginal_id).select(
        *[code_in(F.col("cell"), a, m.attrs, sizes).alias(a) for a in m.attrs], "n"
    )
