"""Metrics, classifiers, private training, and the end-to-end jobs."""

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabveil.catalog import synthesis
from tabveil.catalog import utility as queries
from tabveil.catalog.tables import MICRODATA, SEED, microdata
from tabveil.operators import metrics, models, training
from tabveil.operators.split import fixed_batches
from tabveil.plans import private_training, utility
from tabveil.plans.common import prepare, save
from tabveil.plans.model_synthesis import model_synthesis
from tabveil.plans.private_training import feature_tables
from tabveil.plans.repair_synthesis import repair_synthesis
from tabveil.session import stage
from tabveil.spec import SynthesisSettings


def _pairs_won(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    won = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return won / (len(pos) * len(neg))


def test_area_equals_counting_pairs(spark):
    rng = np.random.default_rng(2)
    rows = [(int(rng.random() < 0.4), float(np.round(rng.random(), 2))) for _ in range(400)]
    rows += [(1, 0.5)] * 100
    df = spark.createDataFrame(rows, "y int, s double")
    got = metrics.area_under_curve(df, "y", "s", places=None).first()["auc"]
    assert got == pytest.approx(_pairs_won(rows), abs=1e-12)
    single = metrics.area_under_curve(df.filter("y = 1"), "y", "s").first()["auc"]
    assert math.isnan(single)


def test_metrics_without_positives_are_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    row = metrics.confusion_metrics(df, "y", "p").first()
    assert (row["accuracy"], row["precision"], row["recall"]) == (1.0, 0.0, 0.0)


def test_scores_are_cleaned(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (-2.0,), (0.3,), (None,)], "s double")
    got = [r[0] for r in df.select(metrics.cleaned_score(F.col("s"))).collect()]
    assert got == [0.5, 1.0, 0.0, 0.3, 0.5]
    seen = metrics.score_diagnostics(df, "s").first()
    assert seen["has_nan"] and seen["has_inf"] and seen["low"] == -2.0


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    shapes = training.layer_shapes(5, (4, 3))
    w = training.first_weights(5, (4, 3), "s")
    x, y = rng.normal(size=(6, 5)), rng.integers(0, 2, 6).astype(float)

    def loss(weights, i):
        p = training.forward(weights, shapes, x[i:i + 1])[1][0]
        return -(y[i] * np.log(p) + (1 - y[i]) * np.log(1 - p))

    got = training.row_gradients(w, shapes, x, y)
    for i in range(6):
        for k in range(0, len(w), 5):
            step = np.zeros_like(w)
            step[k] = 1e-6
            assert got[i, k] == pytest.approx((loss(w + step, i) - loss(w - step, i)) / 2e-6, abs=1e-5)
    assert np.all(np.linalg.norm(training.clipped(got, 0.1), axis=1) <= 0.1 + 1e-12)


def test_settings_are_checked():
    with pytest.raises(ValueError):
        training.TrainingSettings(batch_size=10, microbatches=3)
    with pytest.raises(ValueError):
        training.TrainingSettings(clip_norm=None, noise_multiplier=1.0)


@pytest.mark.parametrize("microbatches", [40, 10])
def test_gradient_sum_equals_one_machine(spark, microbatches):
    rng = np.random.default_rng(7)
    x, y = rng.normal(size=(40, 3)), rng.integers(0, 2, 40).astype(float)
    rows = [(i, [float(v) for v in x[i]], float(y[i])) for i in range(40)]
    df = spark.createDataFrame(rows, "place long, features array<double>, label double").repartition(5)
    settings = training.TrainingSettings(batch_size=40, microbatches=microbatches, clip_norm=0.3, hidden=(4,))
    w = training.first_weights(3, (4,), "s")
    single = training.row_gradients(w, training.layer_shapes(3, (4,)), x, y)
    per = 40 // microbatches
    means = single.reshape(microbatches, per, -1).mean(axis=1)
    expected = training.clipped(means, 0.3).sum(axis=0)
    assert np.allclose(training.gradient_sum(df, w, settings, 3), expected, atol=1e-9)


def _numpy_training(x, y, settings, epochs_batches):
    """The same steps on one machine, with every single gradient."""
    shapes = training.layer_shapes(x.shape[1], settings.hidden)
    w = training.first_weights(x.shape[1], settings.hidden, settings.seed)
    for step, places in enumerate(epochs_batches):
        g = training.row_gradients(w, shapes, x[places], y[places])
        per = settings.batch_size // settings.microbatches
        if settings.clip_norm is None:
            total = g.sum(axis=0) / max(len(places), 1)
        else:
            g = g.reshape(-1, per, g.shape[1]).mean(axis=1)
            units = settings.microbatches
            total = (training.clipped(g, settings.clip_norm).sum(axis=0) + training.noise_draw(settings, step, len(w))) / units
        w = w - settings.learning_rate * total
    return w


@pytest.mark.parametrize("microbatches", [300, 50])
def test_runs_that_train_together_equal_numpy(spark, microbatches):
    rng = np.random.default_rng(3)
    n, size = 1000, 300
    x, y = rng.normal(size=(n, 4)).astype("f4").astype("f8"), rng.integers(0, 2, n).astype(float)
    rows = spark.createDataFrame([(str(i), [float(v) for v in x[i]], float(y[i])) for i in range(n)], "row_key string, features array<float>, label double")
    base = training.TrainingSettings(epochs=2, batch_size=size, microbatches=microbatches, learning_rate=0.3, clip_norm=0.4, hidden=(5, 3), seed="q")
    runs = [replace(base, clip_norm=None, drop_last=False), base, replace(base, noise_multiplier=1.5)]
    got, _ = training.train_together(stage(rows, "rows"), n, 4, runs)
    for drop_last, one, weights in zip((False, True, True), runs, got):
        steps = []
        for epoch in range(2):
            placed = fixed_batches(rows, "row_key", n, size, "q", epoch, drop_last).orderBy("batch", "place").collect()
            steps += [[int(r["row_key"]) for r in placed if r["batch"] == b] for b in range(4 if not drop_last else 3)]
        assert np.allclose(weights, _numpy_training(x, y, one, steps), atol=1e-9)


def test_rows_join_by_chance(spark):
    n, size = 3000, 100
    rows = stage(spark.range(n).select(F.col("id").cast("string").alias("row_key"), F.array(F.lit(1.0).cast("float")).alias("features"), F.lit(1.0).alias("label")), "rows")
    joins = [training.poisson_batches(rows, "row_key", n, size, "s", e) for e in range(6)]
    sizes = [r["count"] for j in joins for r in j.groupBy("batch").count().collect()]
    # 180 batches of Binomial(3000, 1/30): mean 100, deviation 9.8.
    assert len(sizes) == 180 and abs(np.mean(sizes) - size) < 4 and 8 < np.std(sizes) < 11.7
    per_row = joins[0].groupBy("row_key").count().groupBy("count").count().collect()
    found = {r[0]: r[1] for r in per_row}
    # A row joins 0, 1, 2, ... of 30 batches; a batch has a row once.
    expected = [n * math.comb(30, k) * (1 / 30) ** k * (29 / 30) ** (30 - k) for k in range(5)]
    assert all(abs(found.get(k, 0) - expected[k]) < 5 * expected[k] ** 0.5 for k in range(1, 5))
    assert joins[0].groupBy("row_key", "batch").count().filter("count > 1").isEmpty()
    again = training.poisson_batches(rows.repartition(7), "row_key", n, size, "s", 0)
    assert again.exceptAll(joins[0]).isEmpty() and joins[0].exceptAll(again).isEmpty()
    base = training.TrainingSettings(epochs=1, batch_size=size, microbatches=size, clip_norm=0.5, hidden=(), sampler="poisson", seed="s")
    weights, _ = training.train(rows, n, 1, base)
    steps = [[int(r["row_key"]) for r in joins[0].where(F.col("batch") == b).collect()] for b in range(30)]
    x, y = np.ones((n, 1)), np.ones(n)
    w = training.first_weights(1, (), "s")
    for places in steps:
        g = training.clipped(training.row_gradients(w, training.layer_shapes(1, ()), x[places], y[places]), 0.5)
        w = w - base.learning_rate * g.sum(axis=0) / size
    assert np.allclose(weights, w, atol=1e-9)
    with pytest.raises(ValueError):
        replace(base, microbatches=50)


SMALL = SynthesisSettings(
    epsilons=(0.2, 50.0), top_pairs=5, top_triples=2, random_pairs=1, random_triples=0,
    consistency_rounds=2, repair_passes=1, fit_rounds=2, seed="s",
)


@pytest.fixture(scope="module")
def raw(spark, folder):
    return stage(microdata(spark, folder), "raw")


def test_training_learns_without_noise(raw):
    train, test, rows, width = feature_tables(raw, MICRODATA, 0.2, "s")
    settings = training.TrainingSettings(
        epochs=1, batch_size=600, microbatches=600, learning_rate=2.0, clip_norm=None, hidden=()
    )
    weights, _ = training.train(train, rows, width, settings)
    scored = training.predict(test, weights, (), width)
    assert metrics.evaluate_scores(scored, "label", "score").first()["auc"] > 0.9


def test_repair_synthesis_end_to_end(raw):
    made = repair_synthesis(raw, MICRODATA, SMALL)
    sizes = made.measured.sizes
    counts = {r["epsilon"]: r["count"] for r in made.coded.groupBy("epsilon").count().collect()}
    assert counts == {0.2: made.source.train_rows, 50.0: made.source.train_rows}
    for c in MICRODATA.coded_order:
        low, high = made.coded.agg(F.min(c), F.max(c)).first()
        assert 0 <= low and high < sizes[c]
    assert made.coded.filter("target > 1").count() == 0
    assert made.measured.ledger.filter("charged").count() == 2
    report = utility.synthetic_utility(made, MICRODATA, SMALL, "repair", models=["LogisticRegression"])
    auc = {(r["setting"], r["epsilon"]): r["auc"] for r in report.collect()}
    assert auc["real", None] > 0.9
    assert auc["repair", 50.0] > auc["repair", 0.2] - 0.05
    assert auc["repair", 50.0] > 0.6


def test_model_synthesis_end_to_end(spark, raw, tmp_path):
    made = model_synthesis(raw, MICRODATA, SMALL)
    save(made, str(tmp_path), SMALL, made.measured.ledger)
    assert spark.read.parquet(f"{tmp_path}/synthetic").count() == made.coded.count()
    assert spark.read.parquet(f"{tmp_path}/train").count() == made.source.train_rows
    record = spark.read.json(f"{tmp_path}/run").first()
    assert len(record["workload"]) == len(made.measured.workload) and "seed" not in record
    counts = {r["epsilon"]: r["count"] for r in made.coded.groupBy("epsilon").count().collect()}
    assert counts == {0.2: made.source.train_rows, 50.0: made.source.train_rows}
    assert made.readable.filter(F.col("n_name").isNull()).count() == 0


def test_all_classifiers_beat_chance(raw):
    source = prepare(raw, MICRODATA, SMALL)
    report = models.utility_report(
        source.train, source.test, MICRODATA.features, "target", trees=10, depth=6,
        network_iterations=30, iterations=50,
    )
    got = {r["model"]: r["auc"] for r in report.collect()}
    assert set(got) == {"LogisticRegression", "RandomForest", "SVM", "MLP"}
    assert all(v > 0.8 for v in got.values())


@pytest.mark.parametrize("model, estimator", [("SVM", "LinearSVC"), ("LogisticRegression", "LogisticRegression")])
def test_feature_vectors_are_not_kept_twice(spark, monkeypatch, model, estimator):
    """A fit keeps its blocks of rows: beside them only the codes are kept, neither kernel features nor one-hot vectors."""
    rows = stage(spark.range(200).selectExpr("cast(id % 3 as int) AS a", "cast(id % 5 as int) AS b", "cast(id % 3 > 0 as int) AS t"), "rows")
    levels, persisted, kind = [], [], getattr(models, estimator)
    fit, kept = kind.fit, type(rows).persist
    monkeypatch.setattr(kind, "fit", lambda self, df, params=None: (levels.append(df.storageLevel), fit(self, df, params))[1])
    monkeypatch.setattr(type(rows), "persist", lambda self, *level: (persisted.append(self.columns), kept(self, *level))[1])
    fitted = models.fit_classifiers(rows, ["a", "b"], "t", models=[model])
    assert len(levels) == 1 and not levels[0].useDisk and not levels[0].useMemory
    assert persisted == [["a", "b", "label"]]
    assert models.score_classifiers(fitted, rows, "t").filter("prediction = label").count() == 200


def test_registered_jobs_run_on_the_published_settings(monkeypatch):
    whole, seen = SynthesisSettings(seed=SEED), []

    class Made:
        readable = None

    def record(*args, **options):
        seen.append((args[2:], options))
        return Made

    for module in (synthesis, queries):
        monkeypatch.setattr(module, "microdata", lambda spark, folder: None)
        monkeypatch.setattr(module, "repair_synthesis", record)
    monkeypatch.setattr(synthesis, "model_synthesis", record)
    monkeypatch.setattr(queries, "prepare", record)
    monkeypatch.setattr(queries.utility_plan, "synthetic_utility", record)
    monkeypatch.setattr(queries.utility_plan, "real_baseline", record)
    synthesis.QUERIES["synthesise_repair"][0](None, "")
    synthesis.QUERIES["synthesise_model"][0](None, "")
    assert seen == [((whole,), {}), ((SynthesisSettings.for_model(seed=SEED),), {})]
    seen.clear()
    queries.QUERIES["utility_of_synthetic"][0](None, "")
    queries.QUERIES["utility_forest"][0](None, "")
    assert seen == [
        ((whole,), {}), ((whole, "repair"), {}), ((whole,), {}), ((), {"models": ["RandomForest"]})
    ]


def test_private_sweep_is_whole_and_its_baseline_keeps_all_rows(spark, monkeypatch):
    runs = []
    table = spark.createDataFrame([(1.0, [0.2] * 6), (0.0, [0.1] * 6)], "label double, scores array<double>")

    def record(rows, n, width, settings):
        runs.extend(settings)
        return None, 0.0

    monkeypatch.setattr(queries, "microdata", lambda spark, folder: None)
    monkeypatch.setattr(private_training, "feature_tables", lambda *args: (table, table, 48_123, 3))
    monkeypatch.setattr(private_training, "train_together", record)
    monkeypatch.setattr(private_training, "predict_all", lambda test, *args: test)
    assert queries.QUERIES["dp_train_sweep"][0](spark, "").count() == 6
    assert [r.noise_multiplier for r in runs] == [0.0, 0.5, 1.0, 1.5, 2.0, 3.0]
    assert {(r.epochs, r.batch_size) for r in runs} == {(20, 250)}
    assert [r.drop_last for r in runs] == [False] + [True] * 5


@pytest.mark.parametrize("hidden", [(), (4,), (5, 3)])
def test_runs_share_their_products(hidden):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(30, 6)), (rng.random(30) < 0.4).astype(float)
    shapes, norms = training.layer_shapes(6, hidden), [None, 0.3, 5.0]
    weights = np.array([training.first_weights(6, hidden, s) for s in "abc"])
    expected = [training.clipped(training.row_gradients(w, shapes, x, y), norm).sum(axis=0) for w, norm in zip(weights, norms)]
    assert np.allclose(training.clipped_sums(weights, shapes, x, y, norms), expected, atol=1e-12)


def test_batches_are_packed_in_pieces(spark, monkeypatch):
    # Batches larger than a piece, one of them over two shares: all rows come, in order.
    monkeypatch.setattr(training, "ROWS_AT_ONCE", 4)
    rows = [(b, s, u, f"k{u}", [float(u), float(b)], float(u % 2)) for b, s, n in ((0, 0, 9), (0, 1, 3), (2, 0, 4)) for u in range(n)]
    df = spark.createDataFrame(rows[::-1], "batch long, share int, unit long, row_key string, features array<float>, label double")
    made = sorted(training.packed(df.repartition(3), "row_key").collect(), key=lambda r: (r["batch"], r["share"], r["piece"]))
    assert [(r["batch"], r["share"], len(r["label"]) // 8) for r in made] == [(0, 0, 4), (0, 0, 4), (0, 0, 1), (0, 1, 3), (2, 0, 4)]
    units = [u for r in made for u in np.frombuffer(r["unit"], "i8")]
    assert units == [r[2] for r in rows]
    assert np.concatenate([np.frombuffer(r["features"], "f4") for r in made]).reshape(-1, 2)[:, 0].tolist() == [float(u) for u in units]
