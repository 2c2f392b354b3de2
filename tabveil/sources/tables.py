"""Readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabveil.session import in_parallel
from tabveil.spec import MicrodataSpec


def named(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Name columns by position; the count has to match."""
    if len(df.columns) != len(columns):
        raise ValueError(f"expected {len(columns)} columns, found {len(df.columns)}: {df.columns}")
    return df.toDF(*columns)


def csv_schema(spec: MicrodataSpec) -> T.StructType:
    return T.StructType([
        T.StructField(c, T.DoubleType() if c in spec.numeric else T.StringType())
        for c in spec.columns
    ])


def read_microdata_csv(
    spark: SparkSession, path: str, spec: MicrodataSpec, header: bool = False
) -> DataFrame:
    """Scan a CSV file or folder with a declared schema.

    Numbers are parsed after reading, so that the missing marker in a numeric column becomes null
    instead of failing the parse. The first line has to have as many fields as the table has columns; any other line with
    a wrong number fails the read.
    """
    width = csv_width(spark, path)
    if width != len(spec.columns):
        raise ValueError(f"expected {len(spec.columns)} columns, found {width} in {path}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in spec.columns])
    raw = (
        spark.read.schema(text)
        .option("header", header)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    parsed = [
        F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in csv_schema(spec).fields
    ]
    return raw.select(*parsed)


def csv_width(spark: SparkSession, path: str) -> int:
    """Number of fields in the first line."""
    return len(spark.read.option("header", False).csv(path).columns)


def read_table(spark: SparkSession, folder: str, name: str, columns: Sequence[str] = ()) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_fact(spark: SparkSession, folder: str, name: str, columns: Sequence[str]) -> DataFrame:
    """A large table, spread over all cores even when it came as a single small file."""
    return in_parallel(read_table(spark, folder, name, columns))


def write_coded(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def write_by_budget(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One write for all budgets, one sub-folder per epsilon."""
    writer = df.write.mode("overwrite").partitionBy("epsilon")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Metrics have one row per setting and model, so one file is enough."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_run_record(spark: SparkSession, path: str, **values) -> None:
    """Settings and workload of a run as one JSON document."""
    fields = []
    for name, value in values.items():
        if name == "workload":
            kind: T.DataType = T.ArrayType(T.ArrayType(T.StringType()))
            value = [list(v) for v in value]
        elif isinstance(value, bool):
            kind = T.BooleanType()
        elif isinstance(value, int):
            kind = T.LongType()
        elif isinstance(value, float):
            kind = T.DoubleType()
        elif isinstance(value, (list, tuple)):
            kind, value = T.ArrayType(T.DoubleType()), [float(v) for v in value]
        else:
            kind = T.StringType()
        fields.append((T.StructField(name, kind), value))
    schema = T.StructType([f for f, _ in fields])
    row = tuple(v for _, v in fields)
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").json(path)
