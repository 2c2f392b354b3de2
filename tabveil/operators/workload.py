"""Choosing which marginals to measure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabveil.functions.keyed import key_of
from tabveil.operators.marginals import count_cells
from tabveil.operators.selection import TRIPLE_WEIGHT, PaidSelection, information_sensitivity, noisy_best
from tabveil.spec import Marginal

# Scores are compared at this precision, so that rounding noise cannot change a ranking.
SCORE_PLACES = 9


def one_way(columns: Sequence[str], first_id: int = 0) -> list[Marginal]:
    return [Marginal(first_id + i, (c,), "one") for i, c in enumerate(columns)]


def all_sets(columns: Sequence[str], ways: int, kind: str, first_id: int = 0) -> list[Marginal]:
    """All ordered subsets of the columns: metadata that depends on the schema only."""
    return [
        Marginal(first_id + i, attrs, kind) for i, attrs in enumerate(combinations(columns, ways))
    ]


def candidate_sets(spark: SparkSession, columns: Sequence[str], ways: int) -> DataFrame:
    """Ordered subsets as a table: (ord, attrs)."""
    rows = [(i, list(a)) for i, a in enumerate(combinations(columns, ways))]
    return spark.createDataFrame(rows, "ord int, attrs array<string>")


def pair_information(
    pair_counts: DataFrame, pairs: Sequence[Marginal], sizes: Mapping[str, int]
) -> DataFrame:
    """Mutual information (natural log) of every counted pair: (pair_ord, a, b, mi).

    Works on the cell counts, never on rows; all pairs share one pass.
    """
    spark = pair_counts.sparkSession
    described = spark.createDataFrame(
        [(p.marginal_id, i, p.attrs[0], p.attrs[1], sizes[p.attrs[1]]) for i, p in enumerate(pairs)],
        "marginal_id int, pair_ord int, a string, b string, _size int",
    )
    cells = pair_counts.join(F.broadcast(described), "marginal_id").select(
        "pair_ord", "a", "b", "n",
        F.floor(F.col("cell") / F.col("_size")).alias("x"), F.pmod("cell", F.col("_size")).alias("y"),
    )
    total = F.sum("n").over(W.partitionBy("pair_ord"))
    of_x = F.sum("n").over(W.partitionBy("pair_ord", "x"))
    of_y = F.sum("n").over(W.partitionBy("pair_ord", "y"))
    parts = cells.select(
        "pair_ord", "a", "b", "n", total.alias("all"), of_x.alias("nx"), of_y.alias("ny")
    )
    n, every = F.col("n").cast("double"), F.col("all").cast("double")
    term = n / every * F.ln(n * every / (F.col("nx").cast("double") * F.col("ny").cast("double")))
    return parts.groupBy("pair_ord", "a", "b").agg(
        F.round(F.greatest(F.sum(term), F.lit(0.0)), SCORE_PLACES).alias("mi")
    )


def top_pairs(information: DataFrame, k: int) -> DataFrame:
    """The k most informative pairs; equal scores keep enumeration order."""
    return (
        information.orderBy(F.desc("mi"), "pair_ord").limit(k)
        .select("pair_ord", F.array("a", "b").alias("attrs"), F.col("mi").alias("score"))
    )


def triple_scores(information: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """MI(a, target) + MI(b, target) + MI(a, b) / 2 for every pair of non-target columns."""
    spark = information.sparkSession
    others = [c for c in columns if c != target]
    triples = spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(combinations(others, 2))],
        "triple_ord int, a string, b string",
    )
    # One row per pair of columns: bounded by the schema.
    mi = F.broadcast(information.select("a", "b", "mi"))
    with_target = F.broadcast(
        information.filter((F.col("a") == target) | (F.col("b") == target)).select(
            F.when(F.col("a") == target, F.col("b")).otherwise(F.col("a")).alias("c"),
            F.col("mi").alias("to_target"),
        )
    )
    left = with_target.select(F.col("c").alias("a"), F.col("to_target").alias("ma"))
    right = with_target.select(F.col("c").alias("b"), F.col("to_target").alias("mb"))
    score = F.round(F.col("ma") + F.col("mb") + F.lit(0.5) * F.col("mi"), SCORE_PLACES)
    return (
        triples.join(mi, ["a", "b"]).join(left, "a").join(right, "b")
        .select("triple_ord", F.array("a", "b", F.lit(target)).alias("attrs"), score.alias("score"))
    )


def top_triples(scores: DataFrame, k: int) -> DataFrame:
    return scores.orderBy(F.desc("score"), "triple_ord").limit(k)


def random_sets(
    candidates: DataFrame, chosen: DataFrame, k: int, seed: str, purpose: str
) -> DataFrame:
    """k sets in keyed random order among those not chosen yet."""
    draw = F.md5(key_of(seed, purpose, F.col("ord")))
    return (
        candidates.join(F.broadcast(chosen.select("attrs")), "attrs", "left_anti")
        .withColumn("draw", draw).orderBy("draw", "ord").limit(k)
    )


def concatenate(parts: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Join lists of sets in order; a set that occurs twice keeps its first place."""
    total = None
    for place, (kind, df) in enumerate(parts):
        part = df.select(
            F.lit(place).alias("place"), "ord", "attrs", F.lit(kind).alias("kind"), "score"
        )
        total = part if total is None else total.unionByName(part)
    first = total.groupBy("attrs").agg(
        F.min(F.struct("place", "ord", "kind", "score")).alias("first")
    )
    order = W.partitionBy().orderBy("first.place", "first.ord")  # a workload has few rows
    return first.select(
        (F.row_number().over(order) - 1).cast("int").alias("marginal_id"),
        "attrs", F.col("first.kind").alias("kind"), F.col("first.score").alias("score"),
    )


def select_workload(
    information: DataFrame,
    columns: Sequence[str],
    target: str,
    pairs: int = 20,
    triples: int = 8,
    extra_pairs: int = 0,
    extra_triples: int = 0,
    seed: str = "0",
    paid: PaidSelection | None = None,
) -> DataFrame:
    """All 1-way marginals, the strongest pairs and target triples, and random extras.

    With ``paid`` the strongest ones are chosen by noisy scores and listed without their scores; pairs and triples
    share its budget by their numbers.
    """
    spark = information.sparkSession
    no_score = F.lit(None).cast("double").alias("score")
    ranked = lambda df, *order: df.withColumn(
        "ord", F.row_number().over(W.partitionBy().orderBy(*order))
    )
    singles = candidate_sets(spark, columns, 1).select("ord", "attrs", no_score)
    if paid is None:
        strong_pairs = ranked(top_pairs(information, pairs), F.desc("score"), "pair_ord")
        strong_triples = ranked(
            top_triples(triple_scores(information, columns, target), triples),
            F.desc("score"), "triple_ord",
        )
    else:
        strong_pairs, strong_triples = (
            ranked(df, F.desc("noisy"), order).select("ord", "attrs", no_score)
            for df, order in zip(paid_sets(information, columns, target, pairs, triples, paid), ("pair_ord", "triple_ord"))
        )
    parts = [("one", singles), ("pair", strong_pairs), ("triple", strong_triples)]
    if extra_pairs:
        drawn = random_sets(
            candidate_sets(spark, columns, 2), strong_pairs, extra_pairs, seed, "pairs"
        ).drop("ord")
        parts.append(("random pair", ranked(drawn, "draw").select("ord", "attrs", no_score)))
    if extra_triples:
        drawn = random_sets(
            candidate_sets(spark, columns, 3), strong_triples, extra_triples, seed, "triples"
        ).drop("ord")
        parts.append(("random triple", ranked(drawn, "draw").select("ord", "attrs", no_score)))
    return concatenate(parts)


def paid_sets(
    information: DataFrame, columns: Sequence[str], target: str, pairs: int, triples: int, paid: PaidSelection
) -> tuple[DataFrame, DataFrame]:
    """Pairs and target triples with the largest noisy scores; ``noisy`` must not leave the job."""
    change = information_sensitivity(paid.rows)
    each = paid.rho / (pairs + triples)
    scored = information.select("pair_ord", F.array("a", "b").alias("attrs"), F.col("mi").alias("score"))
    of_triples = triple_scores(information, columns, target)
    return (
        noisy_best(scored, "score", "pair_ord", pairs, each * pairs, change, paid.seed, "pairs"),
        noisy_best(of_triples, "score", "triple_ord", triples, each * triples, TRIPLE_WEIGHT * change, paid.seed, "triples"),
    )


def as_marginals(workload: DataFrame) -> list[Marginal]:
    """The workload as metadata: at most a few hundred entries."""
    rows = workload.orderBy("marginal_id").collect()
    return [Marginal(r["marginal_id"], tuple(r["attrs"]), r["kind"], r["score"]) for r in rows]


def count_pairs(coded: DataFrame, columns: Sequence[str], sizes) -> tuple[DataFrame, list[Marginal]]:
    """All pair tables of a coded table in one scan."""
    pairs = all_sets(columns, 2, "pair")
    return count_cells(coded, pairs, sizes), pairs
