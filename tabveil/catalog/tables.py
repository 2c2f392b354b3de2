"""The standard test table: line items with their order, customer, part and place."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabveil.operators.clean import with_row_key
from tabveil.operators.codebook import Codebook, encode, fit_codebook
from tabveil.session import stage
from tabveil.sources.tables import read_fact, read_table
from tabveil.spec import Marginal, MicrodataSpec, budgets_for

NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice", "p_retailprice")
CATEGORICAL = (
    "l_returnflag", "o_orderstatus", "o_orderpriority", "c_mktsegment", "p_brand", "p_type",
    "n_name", "r_name",
)
MICRODATA = MicrodataSpec(
    columns=(*NUMERIC, *CATEGORICAL, "target"), numeric=NUMERIC, categorical=CATEGORICAL,
    target="target", positive_label=">T",
)
COLUMNS = MICRODATA.coded_order

SEED = "42"
DELTA = 1e-5
EPSILONS = (0.1, 0.5, 1.0, 2.0, 5.0)
BUDGETS = budgets_for(EPSILONS, DELTA)

# A workload that the schema alone determines, for the queries on counting and noise.
WORKLOAD = [
    Marginal(i, attrs) for i, attrs in enumerate([
        *[(c,) for c in COLUMNS],
        ("n_name", "r_name"), ("l_quantity", "target"), ("l_discount", "target"),
        ("l_extendedprice", "p_retailprice"), ("l_quantity", "l_extendedprice"),
        ("p_brand", "p_type"), ("l_returnflag", "o_orderstatus"), ("c_mktsegment", "target"),
        ("l_quantity", "l_discount", "target"), ("n_name", "r_name", "target"),
        ("o_orderstatus", "o_orderpriority", "c_mktsegment"),
    ])
]


def microdata(spark: SparkSession, folder: str) -> DataFrame:
    """15 columns per line item; the target is planted on quantity and discount."""
    places = read_table(spark, folder, "nation", ["n_nationkey", "n_name", "n_regionkey"]).join(
        read_table(spark, folder, "region", ["r_regionkey", "r_name"]),
        F.col("n_regionkey") == F.col("r_regionkey"),
    )
    customers = read_table(spark, folder, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"]).join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = read_table(
        spark, folder, "orders",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"],
    ).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    parts = read_table(spark, folder, "part", ["p_partkey", "p_brand", "p_type", "p_retailprice"])
    items = read_fact(
        spark, folder, "lineitem",
        ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
         "l_returnflag"],
    )
    large = F.col("l_quantity") * (F.lit(1) - F.col("l_discount")) > 24
    return (
        items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("target", F.when(large, ">T").otherwise("<=T"))
        .select(*COLUMNS)
    )


def keyed_microdata(spark: SparkSession, folder: str) -> DataFrame:
    return with_row_key(microdata(spark, folder), COLUMNS, places=2)


@dataclass
class Prepared:
    raw: DataFrame
    coded: DataFrame
    book: Codebook

    @property
    def sizes(self) -> dict[str, int]:
        return self.book.sizes


def prepared(spark: SparkSession, folder: str, keyed: bool = False) -> Prepared:
    """Staged microdata, its codebook and the coded table."""
    source = keyed_microdata(spark, folder) if keyed else microdata(spark, folder)
    raw = stage(source, "microdata")
    book = fit_codebook(raw, MICRODATA)
    return Prepared(raw, encode(raw, book, keep=["row_key"] if keyed else []), book)
