"""Queries on scores, metrics, classifiers and private training."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tabveil.catalog import oracle as O
from tabveil.catalog.synthesis import REPAIR
from tabveil.catalog.tables import MICRODATA, NUMERIC, SEED, microdata
from tabveil.operators import clean, features, metrics, training
from tabveil.plans import utility as utility_plan
from tabveil.plans.common import prepare
from tabveil.plans.private_training import private_training
from tabveil.plans.repair_synthesis import repair_synthesis
from tabveil.session import stage
from tabveil.sources.tables import read_fact

# A rule-based score for the metric queries; two decimals make ties.
SCORE = "floor((l_quantity * (1 - l_discount) / 60 + l_tax) * 100) / 100"
WEIGHTS = (0.3, -0.2, 0.5, 0.1, -0.4, 0.2, 0.05)
CLIP = 1.0


def _scored(spark, folder):
    rows = clean.target_flag(microdata(spark, folder), MICRODATA)
    return rows.select("r_name", "label", F.expr(SCORE).alias("score"))


SCORED = f"WITH {O.MICRODATA}, sc AS MATERIALIZED (SELECT r_name, CAST(target = '>T' AS INTEGER) AS label, {SCORE} AS score FROM md)"


def confusion_metrics(spark, folder):
    rows = _scored(spark, folder).withColumn("prediction", metrics.predicted(F.col("score")))
    return metrics.confusion_metrics(rows, "label", "prediction", ["r_name"])


def _confusion(prediction: str) -> str:
    hit = f"(label = ({prediction}))"
    return (
        f"round(avg({hit}::INTEGER), 4) AS accuracy, round(1 - avg({hit}::INTEGER), 4) AS misclassification_rate, "
        f"round(coalesce(count(*) FILTER (label = 1 AND {hit}) / nullif(count(*) FILTER (({prediction}) = 1), 0), 0), 4) AS precision, "
        f"round(coalesce(count(*) FILTER (label = 1 AND {hit}) / nullif(count(*) FILTER (label = 1), 0), 0), 4) AS recall"
    )


AUC = """
au AS (SELECT r_name, sum(p * (below + q / 2)) / (sum(p) * sum(q)) AS auc FROM (
  SELECT r_name, p, q, coalesce(sum(q) OVER (PARTITION BY r_name ORDER BY score
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (
      SELECT r_name, score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q FROM sc GROUP BY ALL))
  GROUP BY r_name)"""


def roc_auc(spark, folder):
    return metrics.area_under_curve(_scored(spark, folder), "label", "score", ["r_name"], places=6)


def evaluate_scores(spark, folder):
    return metrics.evaluate_scores(_scored(spark, folder), "label", "score", ["r_name"])


CLEANED = "CASE WHEN isnan(score) THEN 0.5 ELSE least(greatest(score, 0), 1) END"
EVALUATE_SQL = SCORED.replace(f"{SCORE} AS score", f"least(greatest({SCORE}, 0), 1) AS score") + f""",{AUC}
SELECT r_name, {_confusion("(score >= 0.5)::INTEGER")}, round(any_value(auc), 4) AS auc FROM sc JOIN au USING (r_name) GROUP BY r_name"""


def _broken(spark, folder):
    """Order totals with unusable values planted."""
    orders = read_fact(spark, folder, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"])
    key = F.col("o_orderkey") % 50
    score = (
        F.when(key == 0, F.lit(float("nan"))).when(key == 1, F.lit(float("inf")))
        .when(key == 2, F.lit(float("-inf"))).otherwise(F.col("o_totalprice") / 250000 - 0.1)
    )
    return orders.select("o_orderkey", "o_orderstatus", score.alias("score"))


BROKEN = """WITH br AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 50 = 0 THEN 'nan'::DOUBLE
WHEN o_orderkey % 50 = 1 THEN 'inf'::DOUBLE WHEN o_orderkey % 50 = 2 THEN '-inf'::DOUBLE
ELSE o_totalprice / 250000 - 0.1 END AS score FROM orders)"""


def score_cleanup(spark, folder):
    fixed = _broken(spark, folder).withColumn("score", metrics.cleaned_score(F.col("score")))
    return fixed.select(
        "o_orderkey", F.round("score", 9).alias("score"), metrics.predicted(F.col("score")).alias("prediction")
    )


def score_diagnostics(spark, folder):
    out = metrics.score_diagnostics(_broken(spark, folder), "score", ["o_orderstatus"])
    return out.select("o_orderstatus", "has_nan", "has_inf", "low", "high")


def minmax_score(spark, folder):
    rows = microdata(spark, folder).select(
        "r_name", "l_extendedprice", (F.col("l_extendedprice") - 100 * F.col("l_quantity")).alias("raw")
    )
    scaled = metrics.scaled_score(rows, "raw", keys=["r_name"])
    return scaled.select("r_name", "l_extendedprice", F.round("score", 9).alias("score"))


MINMAX_SQL = f"""WITH {O.MICRODATA}, rw AS (SELECT r_name, l_extendedprice, l_extendedprice - 100 * l_quantity AS raw FROM md)
SELECT r_name, l_extendedprice, round((raw - min(raw) OVER w) / (max(raw) OVER w - min(raw) OVER w + 1e-12::DOUBLE), 9) AS score
FROM rw WINDOW w AS (PARTITION BY r_name)"""


def results_union(spark, folder):
    rows = stage(_scored(spark, folder), "scored")
    plain = metrics.with_setting(metrics.area_under_curve(rows, "label", "score"), "area", None)
    predicted = rows.withColumn("prediction", metrics.predicted(F.col("score")))
    counted = metrics.with_setting(metrics.confusion_metrics(predicted, "label", "prediction"), "counts", 1.0)
    return metrics.union_results([plain, counted])


UNION_SQL = SCORED.replace("SELECT r_name,", "SELECT 'x' AS r_name,") + f""",{AUC}
SELECT 'area' AS setting, NULL::DOUBLE AS epsilon, round(auc, 4) AS auc, NULL::DOUBLE AS accuracy,
  NULL::DOUBLE AS misclassification_rate, NULL::DOUBLE AS precision, NULL::DOUBLE AS recall FROM au
UNION ALL SELECT 'counts', 1.0, NULL, accuracy, misclassification_rate, precision, recall
FROM (SELECT {_confusion("(score >= 0.5)::INTEGER")} FROM sc)"""


def _standard_rows(spark, folder):
    rows = stage(clean.target_flag(microdata(spark, folder), MICRODATA), "microdata")
    scaled = features.standardised(rows, features.fit_scaling(rows, NUMERIC))
    return scaled.select("label", *NUMERIC)


def clipped_gradient_step(spark, folder):
    total = training.logistic_step(_standard_rows(spark, folder), NUMERIC, "label", WEIGHTS, CLIP)
    return total.withColumn("total", F.round("total", 6))


def gradient_sum(spark, folder):
    """The same step through the network code, whose tasks add up their own rows."""
    rows = _standard_rows(spark, folder).select(
        "label", F.array(*NUMERIC).alias("features"), F.lit(0).alias("place")
    )
    settings = training.TrainingSettings(batch_size=1, microbatches=1, clip_norm=CLIP, hidden=())
    total = training.gradient_sum(rows, np.array(WEIGHTS), settings, len(NUMERIC))
    names = [*NUMERIC, "intercept"]
    out = spark.createDataFrame(
        [(n, float(v)) for n, v in zip(names, total)], "coordinate string, total double"
    )
    return out.withColumn("total", F.round("total", 6))


_LOGIT = " + ".join(f"{w}::DOUBLE * {c}" for w, c in zip(WEIGHTS, NUMERIC)) + f" + {WEIGHTS[-1]}::DOUBLE"
GRADIENT_SQL = f"""WITH {O.MICRODATA}, st AS MATERIALIZED (SELECT CAST(target = '>T' AS INTEGER) AS label, {", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in NUMERIC)} FROM md),
er AS (SELECT *, 1 / (1 + exp(-({_LOGIT}))) - label AS e, sqrt(1 + {" + ".join(f"{c} * {c}" for c in NUMERIC)}) AS len FROM st),
sc AS (SELECT *, e / greatest(len * abs(e) / {CLIP}, 1) AS s FROM er)
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS coordinate, round(sum(s * {v}), 6) AS total FROM sc"
    for c, v in [*((c, c) for c in NUMERIC), ("intercept", "1")]
)


def dp_train_sweep(spark, folder):
    """20 epochs in batches of 250, the baseline and five noise levels."""
    return private_training(microdata(spark, folder), MICRODATA, training.TrainingSettings(seed=SEED))


def dp_train_poisson(spark, folder):
    """The same sweep on batches that rows join by chance, with the privacy cost of that sampler."""
    return private_training(microdata(spark, folder), MICRODATA, training.TrainingSettings(seed=SEED, sampler=training.POISSON))


def _real_utility(model: str, **options):
    def run(spark, folder):
        source = prepare(microdata(spark, folder), MICRODATA, REPAIR)
        return utility_plan.real_baseline(source, MICRODATA, models=[model], **options)
    return run


def utility_of_synthetic(spark, folder):
    made = repair_synthesis(microdata(spark, folder), MICRODATA, REPAIR)
    return utility_plan.synthetic_utility(made, MICRODATA, REPAIR, "repair")


QUERIES = {
    "confusion_metrics": (
        confusion_metrics, SCORED + f" SELECT r_name, {_confusion('(score >= 0.5)::INTEGER')} FROM sc GROUP BY r_name",
    ),
    "roc_auc": (roc_auc, SCORED + f",{AUC} SELECT r_name, round(auc, 6) AS auc FROM au"),
    "evaluate_scores": (evaluate_scores, EVALUATE_SQL),
    "score_cleanup": (
        score_cleanup,
        BROKEN + f" SELECT o_orderkey, round({CLEANED}, 9) AS score, ({CLEANED} >= 0.5)::INTEGER AS prediction FROM br",
    ),
    "score_diagnostics": (
        score_diagnostics,
        BROKEN + """ SELECT o_orderstatus, bool_or(isnan(score)) AS has_nan, bool_or(isinf(score)) AS has_inf,
min(score) FILTER (NOT isnan(score)) AS low, max(score) FILTER (NOT isnan(score)) AS high FROM br GROUP BY ALL""",
    ),
    "minmax_score": (minmax_score, MINMAX_SQL),
    "results_union": (results_union, UNION_SQL),
    "clipped_gradient_step": (clipped_gradient_step, GRADIENT_SQL),
    "gradient_sum": (gradient_sum, GRADIENT_SQL),
    "dp_train_sweep": (dp_train_sweep, None),
    "dp_train_poisson": (dp_train_poisson, None),
    "utility_logistic": (_real_utility("LogisticRegression"), None),
    "utility_forest": (_real_utility("RandomForest"), None),
    "utility_svm": (_real_utility("SVM"), None),
    "utility_network": (_real_utility("MLP"), None),
    "utility_of_synthetic": (utility_of_synthetic, None),
}
