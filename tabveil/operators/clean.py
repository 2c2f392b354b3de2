"""Clean-up of raw tables, row keys and stratified splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabveil.functions.keyed import key_of
from tabveil.operators.ranks import expand_ranges
from tabveil.spec import MicrodataSpec


def strip_text(df: DataFrame) -> DataFrame:
    """Trim every text column."""
    return df.select(*[
        F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def drop_incomplete(df: DataFrame, marker: str = "?") -> DataFrame:
    """Treat the marker as missing and keep only complete rows."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    marked = df.replace(marker, None, subset=texts) if texts else df
    return marked.na.drop("any")


def normalise_labels(df: DataFrame, column: str, aliases: Sequence[tuple[str, str]]) -> DataFrame:
    return df.replace(dict(aliases), subset=[column]) if aliases else df


def clean(df: DataFrame, spec: MicrodataSpec) -> DataFrame:
    """Trim, drop rows with missing values, unify target labels."""
    complete = drop_incomplete(strip_text(df.select(*spec.columns)), spec.missing_marker)
    return normalise_labels(complete, spec.target, spec.label_aliases)


def target_flag(df: DataFrame, spec: MicrodataSpec, out: str = "label") -> DataFrame:
    return df.withColumn(out, (F.col(spec.target) == spec.positive_label).cast("int"))


def _printable(field: T.StructField, places: int | None) -> Column:
    column = F.col(field.name)
    if places is not None and isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return column.cast(T.DecimalType(18, places)).cast("string")
    return column.cast("string")


def content_key(df: DataFrame, columns: Sequence[str], places: int | None = None) -> Column:
    """Hash of a row's printed values; numbers in full, or with ``places`` decimals if they have no more.

    Each value stands behind its length, a null as ``n``, so different rows never print alike.
    """
    fields = {f.name: f for f in df.schema.fields}
    printed = [_printable(fields[c], places) for c in columns]
    return F.md5(F.concat_ws("|", *[
        F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("n")) for p in printed
    ]))


def with_row_key(
    df: DataFrame, columns: Sequence[str], out: str = "row_key", places: int | None = None
) -> DataFrame:
    """Give each row a key that depends on its content only, copies included.

    Copies are counted (equal rows collapse before the shuffle, so a row that makes up a third of
    the table is no hot group) and then written out again as copy 0, 1, 2, ... in chunks.
    """
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    counted = counted.withColumn("_content", content_key(df, columns, places))
    rows = expand_ranges(counted, F.lit(0).cast("long"), F.col("_copies"), "_copy")
    return rows.withColumn(out, F.md5(key_of(F.col("_content"), F.col("_copy")))).drop(
        "_copy", "_copies", "_content"
    )
