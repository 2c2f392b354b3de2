"""Column helpers and staging that the operators of this package share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabveil.session import BROADCAST_ROWS, drop, let_go, stage

SPACES = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it as often as ``body`` likes.

    A plain reference inside a lambda may be inlined by the optimiser and then run per element.
    """
    return F.transform(F.array(value), body).getItem(0)


def content(text: str | Column) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(slow)


def pieces(text: Column, separator: str) -> Column:
    """The non-empty parts of the text between separators (a pattern)."""
    return F.array_remove(F.split(text, separator), "")


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def small_side(df: DataFrame, label: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Write a side of a join, and mark it for broadcast only if its counted rows are at most ``rows``.

    Beyond the bound Spark shuffles both sides.
    """
    kept = stage(df, label)
    if kept.count() > rows:
        return kept
    marked = F.broadcast(kept)
    marked.staged_path = kept.staged_path
    return marked


def once_per_worker(name: str, make: Callable[[], object]) -> object:
    """An object that a Python worker makes once and keeps for its later tasks.

    Task code travels by value, so its globals don't outlive a task; the worker's module table does.
    """
    import sys
    import types

    kept = sys.modules.setdefault("tabveil_worker_objects", types.ModuleType("tabveil_worker_objects"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


__all__ = [
    "SPACES", "content", "drop", "let", "let_go", "lower_ascii", "once_per_worker", "pieces", "read", "small_side", "stage", "total",
]
