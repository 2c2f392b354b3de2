"""Marginals, workload, noise, consistency and accounting."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabveil.functions.accounting import rho_for, sigma_for
from tabveil.functions.keyed import gaussian, key_of
from tabveil.operators import accountant, consistency, marginals, noise, selection, sparse_noise, workload
from tabveil.session import stage
from tabveil.spec import Marginal, PrivacyBudget, budgets_for

SIZES = {"a": 3, "b": 4, "c": 2, "t": 3}
COLUMNS = list(SIZES)
CHOSEN = [
    Marginal(0, ("a",)), Marginal(1, ("b",)), Marginal(2, ("t",)), Marginal(3, ("a", "b")),
    Marginal(4, ("a", "b", "t")), Marginal(5, ("c",)),
]


@pytest.fixture(scope="module")
def coded(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 3).cast("int").alias("a"),
        (F.col("id") % 7 % 4).cast("int").alias("b"), (F.col("id") % 2).cast("int").alias("c"),
        (F.col("id") % 3 % 2).cast("int").alias("t"),
    )
    return stage(df, "coded")


# Golden numbers: epsilon, rho, noise scale for 43 and for 73 marginals at delta 1e-5.
GOLDEN = [
    (0.1, 0.000216, 315.342186, 410.874583), (0.5, 0.005314, 63.608092, 82.878059),
    (1.0, 0.020820, 32.135089, 41.870362), (2.0, 0.080045, 16.388949, 21.353954),
    (5.0, 0.449623, 6.915041, 9.009941),
]


@pytest.mark.parametrize("epsilon, rho, s43, s73", GOLDEN)
def test_noise_scales(spark, epsilon, rho, s43, s73):
    assert rho_for(epsilon, 1e-5) == pytest.approx(rho, abs=1e-6)
    assert sigma_for(epsilon, 1e-5, 43) == pytest.approx(s43, rel=1e-6)
    assert sigma_for(epsilon, 1e-5, 73) == pytest.approx(s73, rel=1e-6)
    table = noise.budget_table(spark, [PrivacyBudget(0, epsilon, 1e-5)]).first()
    assert table["rho"] == pytest.approx(rho_for(epsilon, 1e-5), rel=1e-9)


def test_bad_budgets():
    for epsilon, delta in ((0, 1e-5), (-1, 1e-5), (1, 0), (1, 1)):
        with pytest.raises(ValueError):
            PrivacyBudget(0, epsilon, delta)
        with pytest.raises(ValueError):
            rho_for(epsilon, delta)


def test_three_ways_of_counting_agree(coded):
    arrays = marginals.count_cells(coded, CHOSEN, SIZES)
    exploded = marginals.count_cells(coded, CHOSEN, SIZES, array_cells=0)
    sets = marginals.grouping_set_counts(coded, CHOSEN, SIZES)
    assert arrays.exceptAll(exploded).count() == 0 and exploded.exceptAll(arrays).count() == 0
    assert arrays.exceptAll(sets).count() == 0 and sets.exceptAll(arrays).count() == 0
    assert marginals.count_cells(coded.repartition(11), CHOSEN, SIZES).exceptAll(arrays).count() == 0


def test_weighted_counts(coded):
    weighted = coded.withColumn("w", F.lit(0.5))
    for limit in (0, 10**6):
        got = marginals.count_cells(weighted, CHOSEN, SIZES, weight="w", array_cells=limit)
        assert got.agg(F.sum("n")).first()[0] == pytest.approx(0.5 * 4000 * len(CHOSEN))


def test_dense_tables_sum_to_the_rows(coded):
    cells = marginals.dense_cells(coded, CHOSEN, SIZES)
    totals = cells.groupBy("marginal_id").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()
    assert {r["n"] for r in totals} == {4000}
    assert {r["marginal_id"]: r["k"] for r in totals}[4] == 36


def test_oversized_marginals_are_refused(coded, monkeypatch):
    monkeypatch.setattr(marginals, "LARGEST_TABLE", 30)
    with pytest.raises(ValueError):
        marginals.dense_cells(coded, CHOSEN, SIZES)


def test_singles_from_pairs(coded):
    counts, pairs = workload.count_pairs(coded, COLUMNS, SIZES)
    wanted = [CHOSEN[0], CHOSEN[3]]
    got = marginals.cells_from_pairs(counts, pairs, wanted, SIZES).filter("n > 0")
    assert got.exceptAll(marginals.count_cells(coded, wanted, SIZES)).count() == 0


def test_information_and_workload(coded):
    counts, pairs = workload.count_pairs(coded, COLUMNS, SIZES)
    info = stage(workload.pair_information(counts, pairs, SIZES), "info")
    best = workload.top_pairs(info, 1).first()
    assert list(best["attrs"]) == ["a", "t"]
    chosen = workload.as_marginals(workload.select_workload(info, COLUMNS, "t", 2, 1, 2, 1, "s"))
    assert [m.attrs for m in chosen[:4]] == [("a",), ("b",), ("c",), ("t",)]
    assert len({m.attrs for m in chosen}) == len(chosen)
    assert all("t" in m.attrs for m in chosen if m.kind == "triple")


def test_noise_has_the_right_spread(spark):
    draws = spark.range(40_000).select(gaussian(key_of("s", F.col("id"))).alias("g"))
    mean, std, corr = draws.agg(F.avg("g"), F.stddev_pop("g"), F.max(F.abs("g"))).first()
    assert abs(mean) < 0.02 and abs(std - 1) < 0.02 and 3 < corr < 6


def test_budgets_do_not_share_noise(coded):
    cells = marginals.dense_cells(coded, CHOSEN, SIZES)
    noisy = noise.measure(cells, budgets_for((1.0, 1.0), 1e-5), len(CHOSEN), "s", clip=False)
    per_cell = noisy.groupBy("marginal_id", "cell").agg(F.countDistinct("noisy").alias("d"))
    assert per_cell.filter("d = 1").count() == 0
    assert "n" not in noise.released(noisy).columns
    clipped = noise.measure(cells, budgets_for((0.01,), 1e-5), len(CHOSEN), "s")
    assert clipped.filter("noisy < 0").count() == 0


def test_normalise_empty_tables_become_uniform(spark):
    cells = spark.createDataFrame(
        [(0, 0, 0, -1.0), (0, 0, 1, 0.0), (0, 1, 0, 3.0), (0, 1, 1, 1.0)],
        "budget_id int, marginal_id int, cell long, value double",
    )
    got = {(r["marginal_id"], r["cell"]): r["value"] for r in consistency.normalise(cells, 8).collect()}
    assert got == {(0, 0): 4.0, (0, 1): 4.0, (1, 0): 6.0, (1, 1): 2.0}


def test_consistency_closes_the_gap(coded):
    cells = marginals.dense_cells(coded, CHOSEN, SIZES)
    noisy = stage(
        noise.measure(cells, budgets_for((0.2,), 1e-5), len(CHOSEN), "s").withColumnRenamed("noisy", "value"),
        "noisy",
    )

    def gap(table):
        implied = marginals.project_cells(
            table.filter("marginal_id = 3"), [(CHOSEN[3], CHOSEN[0])], SIZES, "value"
        ).withColumnRenamed("value", "implied")
        return table.join(implied, ["marginal_id", "cell"]).agg(
            F.sum(F.abs(F.col("value") - F.col("implied")))
        ).first()[0]

    start = consistency.normalise(noisy, 4000)
    done = stage(consistency.make_consistent(noisy, CHOSEN, SIZES, 4000, 8), "done")
    assert gap(done) < 0.2 * gap(start)
    sums = [r[1] for r in done.groupBy("marginal_id").agg(F.sum("value")).collect()]
    assert all(abs(s - 4000) < 1e-6 for s in sums)


def test_training_epsilon(spark):
    levels = spark.createDataFrame([(0, 1.0), (1, 3.0)], "setting_id int, noise_multiplier double")
    got = accountant.training_epsilon(levels, 24_129, 250, 20, 1e-5).orderBy("setting_id").collect()
    assert got[0]["epsilon_poisson"] < got[0]["epsilon_per_epoch"]
    assert got[1]["epsilon_per_epoch"] < got[0]["epsilon_per_epoch"]
    full = accountant.training_epsilon(levels, 250, 250, 20, 1e-5).orderBy("setting_id").collect()
    assert full[0]["epsilon_poisson"] == pytest.approx(full[0]["epsilon_per_epoch"], rel=1e-9)
    by_hand = min(
        20 * a / (2 * 0.25) + math.log((a - 1) / a) - (math.log(1e-5) + math.log(a)) / (a - 1)
        for a in range(2, 257)
    )
    assert got[0]["epsilon_per_epoch"] == pytest.approx(by_hand, rel=1e-9)


def test_number_after(spark):
    df = spark.createDataFrame([("cost once: 3.25 then",), ("none",)], "s string")
    got = [r[0] for r in df.select(accountant.number_after(F.col("s"), "once:")).collect()]
    assert got[0] == 3.25 and math.isnan(got[1])


def test_sparse_noise_is_distributed_as_the_dense_one(spark):
    """A domain that can be written out: what is released, how often and how large, filled and empty cells apart."""
    sizes, m = {"a": 40, "b": 50}, Marginal(3, ("a", "b"))
    rows = [(i % 40, (i * 7) % 50) for i in range(600)] + [(5, 6)] * 300
    coded = stage(spark.createDataFrame(rows, "a int, b int"), "coded")
    budgets = [PrivacyBudget(i, 1.0, 1e-5) for i in range(10)]
    got = sparse_noise.measure_sparse(coded, m, sizes, budgets, 4, "s", most_empty=60).collect()
    sigma = sigma_for(1.0, 1e-5, 4)
    threshold = sparse_noise.threshold_for(2000, sigma, 60)
    assert threshold > 0 and all(r["noisy"] >= threshold and r["threshold"] == threshold for r in got)
    counts = Counter(a * 50 + b for a, b in rows)
    dense = noise.measure(
        spark.createDataFrame([(3, c, n) for c, n in counts.items()], "marginal_id int, cell long, n long"), budgets, 4, "s", clip=False
    ).filter(F.col("noisy") >= threshold).collect()
    have = {(r["budget_id"], r["cell"]): r["noisy"] for r in got if r["cell"] in counts}
    assert have.keys() == {(r["budget_id"], r["cell"]) for r in dense}
    assert all(abs(have[r["budget_id"], r["cell"]] - r["noisy"]) < 1e-9 for r in dense)
    empty = [r for r in got if r["cell"] not in counts]
    assert all(0 <= r["cell"] < 2000 for r in empty) and len({(r["budget_id"], r["cell"]) for r in empty}) == len(empty)
    n, share = 2000 - len(counts), 0.5 * math.erfc(threshold / sigma / 2**0.5)
    per = Counter(r["budget_id"] for r in empty)
    assert abs(len(empty) / 10 - n * share) < 5 * (n * share / 10) ** 0.5
    assert 0.1 < np.var([per[i] for i in range(10)]) / (n * share * (1 - share)) < 3
    # Mean of a normal's tail, and cells all over the domain.
    tail = sigma * math.exp(-((threshold / sigma) ** 2) / 2) / (share * math.sqrt(2 * math.pi))
    assert abs(np.mean([r["noisy"] for r in empty]) - tail) < 5 * sigma / len(empty) ** 0.5
    assert len({r["cell"] for r in empty}) > 0.2 * n
    with pytest.raises(Exception, match="outside its domain"):
        sparse_noise.measure_sparse(spark.createDataFrame([(40, 0)], "a int, b int"), m, sizes, budgets[:1], 1, "s").collect()


def _information(rows):
    n, pairs = len(rows), Counter(rows)
    left, right = Counter(r[0] for r in rows), Counter(r[1] for r in rows)
    return sum(c / n * math.log(c * n / (left[a] * right[b])) for (a, b), c in pairs.items())


def test_selection_is_paid_from_the_budget(spark):
    rng = np.random.default_rng(8)
    for n in (4, 10, 40):
        most = selection.information_sensitivity(n)
        for _ in range(300):
            rows = [(int(rng.integers(0, 3)) * (i % 2), int(rng.integers(0, 3))) for i in range(n)]
            other = [*rows[1:], (int(rng.integers(0, 4)), int(rng.integers(0, 4)))]
            assert abs(_information(rows) - _information(other)) <= most + 1e-12
    budgets = budgets_for((0.5, 2.0), 1e-5)
    spent = selection.selection_rho(budgets, 0.25)
    assert spent == pytest.approx(rho_for(0.5, 1e-5) / 4)
    ledger = noise.privacy_ledger(spark, budgets, 10, 7, spent).collect()
    for b in budgets:
        charged = {r["used_for"]: r["rho"] for r in ledger if r["budget_id"] == b.budget_id and r["charged"]}
        assert charged.keys() == {"column ranking", "marginals"}
        assert sum(charged.values()) == pytest.approx(rho_for(b.epsilon, b.delta))
    cells = spark.createDataFrame([(0, 0, 5)], "marginal_id int, cell long, n long")
    whole, less = (noise.measure(cells, budgets[:1], 1, "s", spent=s).first()["sigma"] for s in (0.0, spent))
    assert less == pytest.approx(whole / 0.75**0.5)
    with pytest.raises(ValueError):
        noise.measure(cells, budgets, 1, "s", spent=rho_for(0.5, 1e-5))
    # The best of well-separated scores is nearly always found, of equal ones each about as often.
    scores = spark.createDataFrame([(i, 10.0 * (i == 3)) for i in range(5)], "o int, score double")
    clear = [selection.noisy_best(scores, "score", "o", 1, 8.0, 0.05, f"s{i}", "p").first()["o"] for i in range(3)]
    assert clear == [3, 3, 3]
    with pytest.raises(ValueError):
        selection.selection_rho(budgets, 1.0)
