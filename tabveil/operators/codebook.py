"""Coding a mixed table to a finite integer domain, and back."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabveil.operators.quantiles import exact_quantiles
from tabveil.session import lookup_side, stage
from tabveil.spec import UNKNOWN, MicrodataSpec

# Vocabularies up to this size are compared inline; larger ones are joined.
INLINE_LABELS = 64
# Vocabularies up to this many entries in total are kept as metadata; larger ones stay a table.
KEPT_LABELS = 50_000
# Above this many values a column is an identifier: its marginals cannot be dense tables.
LARGEST_DOMAIN = 10_000_000

CODEBOOK_SCHEMA = (
    "attr string, pos int, code int, label string, lo double, hi double, warning string"
)


def bin_edges(quantiles: Sequence[float]) -> list[float]:
    """Distinct quantiles with open ends; one closed bin when there are fewer than three."""
    distinct = sorted(set(quantiles))
    if len(distinct) == 1:
        return [distinct[0] - 0.5, distinct[0] + 0.5]
    if len(distinct) == 2:
        return distinct
    return [-math.inf, *distinct[1:-1], math.inf]


def interval_label(low: float, high: float) -> str:
    return f"({_edge_text(low)}, {_edge_text(high)}]"


def _edge_text(edge: float) -> str:
    if math.isinf(edge):
        return "-inf" if edge < 0 else "inf"
    nearest = round(edge)
    return f"{nearest}" if math.isclose(edge, nearest, rel_tol=0.0, abs_tol=1e-9) else f"{edge:.2f}"


def bin_code(column: Column, edges: Sequence[float]) -> Column:
    """Right-closed bins: the code is the number of inner edges below the value; missing is 0.

    The edges are one constant array. Spelled out per edge, fifteen coded columns make a generated
    method too long for the JVM's compiler, which is several times slower.
    """
    inner = [float(e) for e in edges[1:-1]]
    if not inner:
        return F.lit(0)
    value = column.cast("double")
    below = F.filter(F.array(*[F.lit(e) for e in inner]), lambda e: e < value)
    return F.when(value.isNull() | F.isnan(value), F.lit(0)).otherwise(F.size(below))


@dataclass
class Codebook:
    """Learned domain. Edges are short lists; vocabularies are lists only while they are small."""

    spec: MicrodataSpec
    edges: dict[str, list[float]]
    labels: dict[str, list[str]]
    vocabulary: DataFrame | None
    sizes: dict[str, int]
    unknown: dict[str, int]

    def labels_of(self, attr: str) -> list[str] | None:
        if attr in self.edges:
            e = self.edges[attr]
            return [interval_label(a, b) for a, b in zip(e, e[1:])]
        return self.labels.get(attr)

    def lookup(self, spark: SparkSession, attr: str) -> DataFrame:
        """(code, label) of one attribute."""
        known = self.labels_of(attr)
        if known is None:
            return self.vocabulary.filter(F.col("attr") == attr).select("code", "label")
        return spark.createDataFrame(list(enumerate(known)), "code int, label string")

    def table(self, spark: SparkSession) -> DataFrame:
        """The whole codebook as one long table."""
        rows = []
        for pos, attr in enumerate(self.spec.coded_order):
            known = self.labels_of(attr)
            if known is None:
                continue
            e = self.edges.get(attr)
            single = "one bin" if e is not None and len(e) == 2 else None
            for code, label in enumerate(known):
                low, high = (e[code], e[code + 1]) if e is not None else (None, None)
                rows.append((attr, pos, code, label, low, high, single))
        local = spark.createDataFrame(rows, CODEBOOK_SCHEMA)
        if self.vocabulary is None:
            return local
        others = self.vocabulary.filter(~F.col("attr").isin(list(self.labels))) if self.labels else self.vocabulary
        stored = others.select(
            "attr", "pos", "code", "label", F.lit(None).cast("double").alias("lo"),
            F.lit(None).cast("double").alias("hi"), F.lit(None).cast("string").alias("warning"),
        )
        return local.unionByName(stored)


def vocabulary_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values per column, counted in one pass; frequent values collapse before the shuffle."""
    entries = F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(c).alias("attr"), F.col(c).cast("string").alias("label"))
        for i, c in enumerate(columns)
    ])
    return (
        df.select(F.explode(entries).alias("e")).select("e.*")
        .groupBy("pos", "attr", "label").agg(F.count(F.lit(1)).alias("n"))
    )


def vocabulary_codes(counts: DataFrame) -> DataFrame:
    """Codes in binary text order; the unknown label comes last unless it is itself a value."""
    known = counts.filter(F.col("label").isNotNull())
    order = W.partitionBy("attr").orderBy("label")
    coded = known.withColumn("code", (F.row_number().over(order) - 1).cast("int"))
    ends = known.groupBy("pos", "attr").agg(
        F.count(F.lit(1)).cast("int").alias("code"),
        F.max((F.col("label") == UNKNOWN).cast("int")).alias("has"),
    ).filter("has = 0").select("pos", "attr", F.lit(UNKNOWN).alias("label"), "code")
    return coded.select("pos", "attr", "label", "code").unionByName(ends)


def fit_codebook(train: DataFrame, spec: MicrodataSpec, n_bins: int = 8) -> Codebook:
    """Learn bins and vocabularies from the training rows. Reads ``train`` a few times."""
    if n_bins < 1:
        raise ValueError("n_bins has to be at least 1")
    spark = train.sparkSession
    edges = {}
    if spec.numeric:
        probs = [i / n_bins for i in range(n_bins + 1)]
        quantiles = exact_quantiles(train, spec.numeric, probs)
        edges = {c: bin_edges(q) for c, q in quantiles.items()}
    counts = vocabulary_counts(train, spec.vocabulary_columns)
    first = counts.filter("label is not null").limit(KEPT_LABELS + 1).collect()
    sizes = {c: len(e) - 1 for c, e in edges.items()}
    if len(first) <= KEPT_LABELS:
        labels = {c: sorted({r["label"] for r in first if r["attr"] == c}) for c in spec.vocabulary_columns}
        for values in labels.values():
            if UNKNOWN not in values:
                values.append(UNKNOWN)
        sizes |= {c: len(v) for c, v in labels.items()}
        unknown = {c: v.index(UNKNOWN) for c, v in labels.items()}
        return Codebook(spec, edges, labels, None, sizes, unknown)
    return _large_codebook(spark, spec, edges, sizes, stage(counts, "vocabulary"))


def _large_codebook(spark, spec, edges, sizes, counts) -> Codebook:
    per_column = counts.groupBy("attr").count().collect()  # one row per column
    for r in per_column:
        if r["count"] > LARGEST_DOMAIN:
            raise ValueError(f"{r['attr']} has {r['count']} values: an identifier, not a category")
    offset = len(spec.numeric)
    vocabulary = stage(
        vocabulary_codes(counts).withColumn("pos", F.col("pos") + offset), "codes"
    )
    facts = vocabulary.groupBy("attr").agg(
        F.count(F.lit(1)).alias("size"),
        F.max(F.when(F.col("label") == UNKNOWN, F.col("code"))).alias("unknown"),
    ).collect()  # one row per column
    sizes = sizes | {r["attr"]: r["size"] for r in facts}
    unknown = {r["attr"]: r["unknown"] for r in facts}
    # The target's labels are needed as metadata whatever the size of the other vocabularies.
    target = vocabulary.filter(F.col("attr") == spec.target)
    kept = {}
    if sizes[spec.target] <= KEPT_LABELS + 1:
        kept[spec.target] = [r["label"] for r in sorted(target.collect(), key=lambda r: r["code"])]
    return Codebook(spec, edges, kept, vocabulary, sizes, unknown)


def _inline(book: Codebook, attr: str) -> list[str] | None:
    known = book.labels_of(attr)
    return known if known is not None and len(known) <= INLINE_LABELS else None


def encode(df: DataFrame, book: Codebook, keep: Sequence[str] = ()) -> DataFrame:
    """Integer codes in coded order, plus the columns named in ``keep``."""
    joined = df
    codes: list[Column] = [F.col(c) for c in keep]
    for attr in book.spec.coded_order:
        if attr in book.edges:
            codes.append(bin_code(F.col(attr), book.edges[attr]).alias(attr))
            continue
        unknown = F.lit(book.unknown[attr])
        text = F.col(attr).cast("string")
        labels = _inline(book, attr)
        if labels is not None:
            place = F.array_position(F.array(*[F.lit(v) for v in labels]), text).cast("int")
            codes.append(F.when(place > 0, place - 1).otherwise(unknown).alias(attr))
            continue
        side = book.lookup(df.sparkSession, attr).select(
            F.col("label").alias(f"_label_{attr}"), F.col("code").alias(f"_code_{attr}")
        )
        joined = joined.join(
            lookup_side(side, book.sizes[attr]), text == F.col(f"_label_{attr}"), "left"
        )
        codes.append(F.coalesce(F.col(f"_code_{attr}"), unknown).alias(attr))
    return joined.select(*codes)


def decode(coded: DataFrame, book: Codebook, keep: Sequence[str] = ()) -> DataFrame:
    """Labels for codes; a code outside the domain becomes null."""
    joined = coded
    texts: list[Column] = [F.col(c) for c in keep]
    for attr in book.spec.coded_order:
        labels = _inline(book, attr)
        if labels is not None:
            texts.append(F.get(F.array(*[F.lit(v) for v in labels]), F.col(attr)).alias(attr))
            continue
        side = book.lookup(coded.sparkSession, attr).select(
            F.col("code").alias(f"_code_{attr}"), F.col("label").alias(f"_label_{attr}")
        )
        joined = joined.join(
            lookup_side(side, book.sizes[attr]), F.col(attr) == F.col(f"_code_{attr}"), "left"
        )
        texts.append(F.col(f"_label_{attr}").alias(attr))
    return joined.select(*texts)


def observed_sizes(coded: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Largest code seen plus one, per column: a domain without the unknown label."""
    row = coded.agg(*[F.max(c).alias(c) for c in columns]).first()
    return {c: int(row[c]) + 1 for c in columns}


def observed_domain(coded: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same as a table (attr, pos, size)."""
    top = coded.agg(*[(F.max(c) + 1).cast("long").alias(c) for c in columns])
    entries = F.array(*[
        F.struct(F.lit(c).alias("attr"), F.lit(i).alias("pos"), F.col(c).alias("size"))
        for i, c in enumerate(columns)
    ])
    return top.select(F.explode(entries).alias("e")).select("e.*")


def clip_to_domain(coded: DataFrame, sizes: dict[str, int], rounded: bool = False) -> DataFrame:
    """Codes forced into 0 .. size-1, rounded half to even first where asked."""
    def fix(c: str) -> Column:
        value = F.bround(F.col(c).cast("double"), 0) if rounded else F.col(c)
        return F.least(F.greatest(value, F.lit(0)), F.lit(sizes[c] - 1)).cast("int").alias(c)

    return coded.select(*[fix(c) if c in sizes else F.col(c) for c in coded.columns])


def force_binary(
    coded: DataFrame, column: str, positive_code: int = 1, negative_code: int = 0
) -> DataFrame:
    """The positive code stays, every other becomes the negative one."""
    flag = F.when(F.col(column) == positive_code, F.lit(positive_code)).otherwise(F.lit(negative_code))
    return coded.withColumn(column, flag.cast("int"))
