"""Draws, repair, tree model, re-weighting."""

import hashlib
import re
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabveil.catalog import synthesis
from tabveil.functions.keyed import key_of, uniform, uniform_pair
from tabveil.operators import draws, ranks, repair, repair_blocks, reweight, tree
from tabveil.operators.marginals import count_cells
from tabveil.session import stage
from tabveil.spec import Marginal

SIZES = {"a": 3, "b": 4, "t": 2}
COLUMNS = list(SIZES)
ALL = [
    Marginal(0, ("a",)), Marginal(1, ("b",)), Marginal(2, ("t",)), Marginal(3, ("a", "t")),
    Marginal(4, ("b", "t")), Marginal(5, ("a", "b", "t")),
]
N = 2000


@pytest.fixture(scope="module")
def joint():
    """A full joint table with an empty cell and strong dependence."""
    rng = np.random.default_rng(4)
    table = rng.random((3, 4, 2))
    table[0, :, 1] = 0.0
    table[1, 2] = 0.0
    return table * (N / table.sum())


@pytest.fixture(scope="module")
def targets(spark, joint):
    rows = []
    for m in ALL:
        keep = [COLUMNS.index(c) for c in m.attrs]
        summed = joint.sum(axis=tuple(i for i in range(3) if i not in keep))
        rows += [(0, m.marginal_id, i, float(v)) for i, v in enumerate(summed.ravel())]
    df = spark.createDataFrame(rows, "budget_id int, marginal_id int, cell long, value double")
    return stage(df, "targets")


def _counts(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def test_independent_draws_match_single_columns(targets, joint):
    got = draws.sample_independent(targets, ALL, COLUMNS, SIZES, N, [0], "s")
    assert got.count() == N
    share = got.groupBy("b").count().collect()
    for r in share:
        assert abs(r["count"] - joint.sum(axis=(0, 2))[r["b"]]) < 120


ORDER = tree.sampling_order([("a", "t"), ("b", "t")], COLUMNS, "t")


def test_arrays_and_joins_draw_the_same(targets):
    cuts = stage(draws.intervals(draws.conditional_masses(targets, ALL, ORDER, SIZES)), "cuts")
    by_array = draws.draw_rows(cuts, ORDER, SIZES, N, [0], "s", "tree")
    by_join = draws.draw_rows(cuts, ORDER, SIZES, N, [0], "s", "tree", array_ends=0)
    assert by_array.count() == by_join.count() == N
    assert by_array.exceptAll(by_join).count() == 0


def test_draws_are_searched_in_batches(spark, targets):
    """No plan that walks through a column's interval ends, or parses a hash as text, for every row."""
    cuts = stage(draws.intervals(draws.conditional_masses(targets, ALL, ORDER, SIZES)), "cuts")
    plan = draws.draw_rows(cuts, ORDER, SIZES, N, [0], "s", "tree")._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "conv(" not in plan and "Join" not in plan
    rows = spark.range(300).select(key_of("s", "tree", F.lit(0), 1, F.col("id")).alias("k"))
    both = rows.select(F.md5("k").alias("m"), uniform(F.col("k")).alias("a"), uniform(F.col("k"), 1).alias("b")).toArrow().combine_chunks()
    part = both.column("m").chunk(0)
    for cut in (part, part[7:50], part[:0]):
        at = slice(7, 50) if len(cut) == 43 else slice(0, len(cut))
        first, second = uniform_pair(cut)
        assert first.tolist() == both.column("a").to_pylist()[at] and second.tolist() == both.column("b").to_pylist()[at]


def test_ends_are_counted_up_to_the_draw():
    """A draw on an end belongs to the next code; codes without mass, and a draw below all ends."""
    table = np.sort(np.array([[[0.25, 0.25, 1.0, np.inf, np.inf, np.inf, np.inf]], [[0.0, 0.5, 0.75, 1.0, 1.0, np.inf, np.inf]]]), axis=2)
    u = np.array([0.0, 0.2, 0.25, 0.99, 0.0, 0.5, 0.74, 0.999])
    given = np.array([0, 0, 0, 0, 1, 1, 1, 1])
    assert draws._ends_passed(table, given, u).tolist() == [0, 0, 2, 2, 1, 2, 2, 3]


def test_tree_keeps_dependence_and_zero_cells(targets, joint):
    got = tree.sample_tree(targets, ALL, ORDER, COLUMNS, SIZES, N, [0], "s")
    pair = got.groupBy("a", "t").count().collect()
    assert not any(r["a"] == 0 and r["t"] == 1 for r in pair)
    for r in pair:
        assert abs(r["count"] - joint.sum(axis=1)[r["a"], r["t"]]) < 120


def test_order_has_parents_first():
    order = tree.sampling_order([("x", "y"), ("y", "z")], ["w", "x", "y", "z"], "z")
    assert order == [("z", None), ("y", "z"), ("x", "y"), ("w", None)]
    assert tree.spanning_edges([("a", "b", 3), ("b", "c", 2), ("a", "c", 1)]) == [("a", "b"), ("b", "c")]


def _greedy(rows, target, attrs, order, limit):
    """One visit, record by record."""
    rows = dict(rows)
    have = Counter(tuple(r[a] for a in attrs) for r in rows.values())
    cells = list(product(*[range(SIZES[a]) for a in attrs]))
    diff = {c: round(target[i], 6) - have[c] for i, c in enumerate(cells)}
    need = sorted([c for c in cells if diff[c] > 0.5], key=lambda c: (-diff[c], c))
    room = {c: diff[c] for c in need}
    moved = 0
    for source in sorted([c for c in cells if diff[c] < -0.5], key=lambda c: (diff[c], c)):
        members = [i for i in order if tuple(rows[i][a] for a in attrs) == source and i not in room]
        for i in members[: int(np.ceil(-diff[source]))]:
            if moved >= limit or not need:
                return rows
            rows[i] = rows[i] | dict(zip(attrs, need[0])) | {"moved": True}
            room[need[0]] -= 1
            moved += 1
            if room[need[0]] <= 0.5:
                need.pop(0)
    return rows


@pytest.mark.parametrize("limit", [2000, 37])
def test_repair_step_equals_moving_one_by_one(spark, targets, limit, monkeypatch):
    monkeypatch.setattr(repair, "ROWS_PER_BLOCK", 300)
    start = stage(draws.sample_independent(targets, ALL, COLUMNS, SIZES, N, [0], "s"), "start")
    step = [repair.Visit(0, ALL[5])]
    got = repair.repair_step(start, targets, step, SIZES, [0], N, limit, "s")
    got = {r["row_id"]: tuple(r[c] for c in COLUMNS) for r in got.collect()}
    drawn = repair.with_visit_draws(start, step, repair.blocks_for(N), "s").collect()
    assert len({r["_bucket_5"] for r in drawn}) == 7
    order = [r["row_id"] for r in sorted(drawn, key=lambda r: (r["_bucket_5"], r["_u_5"], r["row_id"]))]
    rows = {r["row_id"]: {c: r[c] for c in COLUMNS} for r in drawn}
    target = [
        r["value"] for r in targets.filter("marginal_id = 5").orderBy("cell").collect()
    ]
    expected = _greedy(rows, target, ALL[5].attrs, order, limit)
    assert got == {i: tuple(r[c] for c in COLUMNS) for i, r in expected.items()}


def test_registered_repair_moves_all_records(spark, monkeypatch):
    """6,000 records in one cell, of which 5,000 have to move: more than any fixed number of moves per visit."""
    m, n = Marginal(9, ("a", "b", "t")), 6000
    start = stage(spark.range(n).selectExpr("0 AS budget_id", "id AS row_id", "0 AS a", "0 AS b", "0 AS t"), "start")
    target = [1000.0, 0.0, 3000.0, 0.0, 0.0, 1999.4, 0.6, 0.0] + [0.0] * 16
    rows = [(0, 9, i, v) for i, v in enumerate(target)]
    goals = stage(spark.createDataFrame(rows, "budget_id int, marginal_id int, cell long, value double"), "goals")
    prepared = type("Prepared", (), {"sizes": SIZES})
    monkeypatch.setattr(synthesis, "_independent", lambda spark, folder: (start, goals, prepared, n))
    monkeypatch.setattr(synthesis, "STEP", [repair.Visit(0, m)])
    monkeypatch.setattr(synthesis, "TRIPLE", m)
    monkeypatch.setattr(synthesis, "IDS", [0])
    assert synthesis.QUERIES["repair_slots"][0](spark, "").count() == 5000
    assert [r["keep"] for r in synthesis.QUERIES["repair_surpluses"][0](spark, "").collect()] == [5000]
    drawn = repair.with_visit_draws(start, synthesis.STEP, 1, synthesis.SEED).collect()
    order = [r["row_id"] for r in sorted(drawn, key=lambda r: (r["_u_9"], r["row_id"]))]
    expected = _greedy({i: dict.fromkeys(COLUMNS, 0) for i in order}, target, m.attrs, order, n)
    for name in ("repair_step", "repair_step_stored"):
        got = {r["row_id"]: tuple(r[c] for c in COLUMNS) for r in synthesis.QUERIES[name][0](spark, "").collect()}
        assert got == {i: tuple(r[c] for c in COLUMNS) for i, r in expected.items()}


def test_repair_reaches_the_target_and_keeps_other_columns(targets):
    start = stage(draws.sample_independent(targets, ALL, COLUMNS, SIZES, N, [0], "s"), "start")
    done = stage(
        repair.repair_step(start, targets, [repair.Visit(0, ALL[3])], SIZES, [0], N, N, "s"), "done"
    )
    assert done.count() == N
    left = count_cells(done, [ALL[3]], SIZES).join(
        targets.withColumnRenamed("value", "goal"), ["marginal_id", "cell"]
    ).agg(F.max(F.abs(F.col("n") - F.col("goal")))).first()[0]
    assert left <= 1.0
    same = done.join(start.withColumnRenamed("b", "old"), "row_id")
    assert same.filter("b <> old").count() == 0


def test_steps_respect_shared_attributes():
    steps = repair.visit_steps(ALL, 2, "s")
    assert sum(len(s) for s in steps) == 2 * len(ALL)
    for step in steps:
        used = [a for v in step for a in v.marginal.attrs]
        assert len(used) == len(set(used))


def test_repair_loop_improves_all_marginals(targets):
    start = stage(draws.sample_independent(targets, ALL, COLUMNS, SIZES, N, [0], "s"), "start")
    done = repair.repair(start, targets, ALL, SIZES, [0], N, passes=2, max_moves=2000, seed="s")

    def error(df):
        n = count_cells(df, ALL, SIZES)
        return targets.join(n, ["marginal_id", "cell"], "left").agg(
            F.sum(F.abs(F.col("value") - F.coalesce("n", F.lit(0))))
        ).first()[0]

    assert done.count() == N
    assert error(done) < 0.5 * error(start)


@pytest.fixture(scope="module")
def two_budgets(targets):
    other = targets.withColumn("budget_id", F.lit(3)).withColumn("value", F.col("value") * 0.5 + 40)
    return stage(targets.unionByName(other), "targets")


@pytest.mark.parametrize("size, max_moves", [(10**6, None), (300, 37)])
def test_passes_by_blocks_equal_steps_from_storage(two_budgets, monkeypatch, size, max_moves):
    for module in (repair, repair_blocks):
        monkeypatch.setattr(module, "ROWS_PER_BLOCK", size)
    start = stage(draws.sample_independent(two_budgets, ALL, COLUMNS, SIZES, N, [0, 3], "s"), "start")
    want = repair.repair(start, two_budgets, ALL, SIZES, [0, 3], N, passes=2, max_moves=max_moves, seed="s")
    got = repair_blocks.repair_records(start, two_budgets, ALL, SIZES, [0, 3], N, passes=2, max_moves=max_moves, seed="s")
    assert got.columns == want.columns and got.count() == 2 * N
    assert got.exceptAll(want).isEmpty()
    assert not got.exceptAll(start).isEmpty()


def test_a_stopped_repair_goes_on_after_its_last_pass(two_budgets, monkeypatch, tmp_path):
    start = stage(draws.sample_independent(two_budgets, ALL, COLUMNS, SIZES, N, [0, 3], "s"), "start")
    want = repair_blocks.repair_records(start, two_budgets, ALL, SIZES, [0, 3], N, passes=4, seed="s")
    whole, ran, stop_at = repair_blocks.repair_pass, [], [2]

    def watched(synth, goals, steps, *args):
        ran.append(steps[0][0].sweep)
        if ran[-1] == stop_at[0]:
            raise InterruptedError
        return whole(synth, goals, steps, *args)

    monkeypatch.setattr(repair_blocks, "repair_pass", watched)

    def run(**more):
        return repair_blocks.repair_records(start, two_budgets, ALL, SIZES, [0, 3], N, **({"passes": 4, "seed": "s"} | more), journal=str(tmp_path))

    with pytest.raises(InterruptedError):
        run()
    stop_at[0] = None
    got = run()
    assert ran == [0, 1, 2, 2, 3]
    assert got.exceptAll(want).isEmpty() and got.count() == 2 * N
    ran.clear()
    assert run().exceptAll(want).isEmpty() and ran == []
    stop_at[0] = 0
    with pytest.raises(InterruptedError):
        run(seed="other")


def test_draws_in_tasks_equal_those_in_columns(spark):
    rows = spark.range(500).select("id", uniform(key_of("s", "move", 2, 7, F.lit(3), F.col("id"))).alias("u")).collect()
    got = repair_blocks.uniforms("s|move|2|7|3", np.array([r["id"] for r in rows]))
    assert got.tolist() == [r["u"] for r in rows]


def test_two_parents_follow_a_triple(two_budgets, joint):
    order = tree.two_parent_order({("a", "t"): 0.5, ("b", "t"): 0.2, ("a", "b"): 0.1}, [m.attrs for m in ALL], COLUMNS, "t")
    assert order == [("t", None), ("a", "t"), ("b", ("t", "a"))]
    one = stage(tree.sample_tree(two_budgets, ALL, ORDER, COLUMNS, SIZES, 20 * N, [0], "s"), "one")
    two = stage(tree.sample_tree(two_budgets, ALL, order, COLUMNS, SIZES, 20 * N, [0], "s"), "two")
    goal = joint / joint.sum()

    def distance(df):
        have = _counts(df)
        return sum(abs(have[c] / (20 * N) - goal[c]) for c in product(*[range(SIZES[x]) for x in COLUMNS]))

    assert distance(two) < 0.05 < distance(one)
    by_join = draws.draw_rows(
        draws.intervals(draws.conditional_masses(two_budgets, ALL, order, SIZES)), order, SIZES, N, [0, 3], "s", "tree", array_ends=0
    )
    by_array = tree.sample_tree(two_budgets, ALL, order, COLUMNS, SIZES, N, [0, 3], "s")
    assert by_join.select(*by_array.columns).exceptAll(by_array).isEmpty() and by_join.count() == 2 * N
    # A pair of codes that has no mass takes the first parent's table, and that the column's own.
    bare = two_budgets.withColumn("value", F.when((F.col("marginal_id") == 5) & (F.col("cell") < 8), 0.0).otherwise(F.col("value")))
    masses = draws.conditional_masses(bare, ALL, order, SIZES).filter("attr = 'b' and budget_id = 0 and given = 3").orderBy("code")
    pair = bare.filter("marginal_id = 4 and budget_id = 0 and cell % 2 = 1").orderBy("cell")
    assert [r["value"] for r in masses.collect()] == [r["value"] for r in pair.collect()]


def test_fit_ends_within_its_bound_or_says_why(two_budgets):
    pool = stage(tree.sample_tree(two_budgets, ALL, ORDER, COLUMNS, SIZES, 4 * N, [0, 3], "s"), "pool")
    fit = reweight.fit_potentials(pool, two_budgets.filter("budget_id = 0"), ALL, SIZES, [0], bound=0.005)
    assert fit.ends[0][0] <= 1 and fit.ends[0][2] == "bound"
    assert fit.residuals.agg(F.max("residual")).first()[0] <= 0.005
    weighted = reweight.with_log_weight(pool.filter("budget_id = 0"), fit.potentials, ALL, SIZES, 1).withColumn("weight", F.exp("log_weight"))
    cells = reweight.weighted_cells(weighted, ALL, SIZES, [0]).withColumn("share", F.col("current") / F.sum("current").over(W.partitionBy("marginal_id")))
    off = cells.join(two_budgets.filter("budget_id = 0"), ["marginal_id", "cell"]).groupBy("marginal_id").agg(
        (F.sum(F.abs(F.col("share") - F.col("value") / N)) / 2).alias("off")
    )
    assert off.agg(F.max("off")).first()[0] <= 0.0051
    # Targets that contradict each other cannot be met; noise of that size makes the bound wider.
    wrong = two_budgets.filter("budget_id = 0").withColumn("value", F.when(F.col("marginal_id") == 0, F.lit(N / 3.0)).otherwise(F.col("value")))
    left = reweight.fit_potentials(pool, wrong, ALL, SIZES, [0], bound=0.001)
    assert left.ends[0][0] > 1 and left.ends[0][2] == "no step makes it smaller"
    assert all(r["most"] == 0.001 for r in left.residuals.collect())
    state = pool.sparkSession.createDataFrame([(3, 4, 1000.0)], "budget_id int, cells long, value double")
    most = state.select(reweight.residual_bound(F.col("cells"), F.col("value"), 0.001, {0: 1.0, 3: 50.0})).first()[0]
    assert abs(most - 2 * 50 * 4 * 0.5 * (2 / np.pi) ** 0.5 / 1000) < 1e-12


def test_reweighting_fits_what_a_tree_cannot(targets):
    pool = stage(tree.sample_tree(targets, ALL, ORDER, COLUMNS, SIZES, 4 * N, [0], "s"), "pool")
    potentials = reweight.fit_potentials(pool, targets, ALL, SIZES, [0], most_rounds=8, step_size=2.0).potentials
    by_array = reweight.with_log_weight(pool, potentials, ALL, SIZES, 1)
    by_join = reweight.with_log_weight(pool, potentials, ALL, SIZES, 1, array_potentials=0)
    gap = by_array.join(by_join.withColumnRenamed("log_weight", "other"), "row_id").agg(
        F.max(F.abs(F.col("log_weight") - F.col("other")))
    ).first()[0]
    assert gap < 1e-9
    got = stage(reweight.draw_records(pool, potentials, ALL, SIZES, [0], N, 4 * N, "s"), "got")
    assert got.count() == N
    goal = {r["cell"]: r["value"] for r in targets.filter("marginal_id = 5").collect()}

    def error(df, scale):
        have = {r["cell"]: r["n"] for r in count_cells(df, [ALL[5]], SIZES).collect()}
        return sum(abs(v - have.get(c, 0) * scale) for c, v in goal.items())

    assert error(got, 1.0) < 0.8 * error(pool, 0.25)


def test_copies_are_exact_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(ranks, "ROWS_PER_BUCKET", 40)
    df = spark.range(700).select(
        F.lit(0).alias("budget_id"), F.col("id").alias("row_id"), (F.rand(5) * 3).alias("weight")
    )
    df = stage(df, "weights")
    total = df.agg(F.sum("weight")).first()[0]
    got = reweight.whole_copies(df, 1500, 700, "s").collect()
    assert sum(r["copies"] for r in got) == 1500
    assert all(abs(r["copies"] - r["weight"] / total * 1500) <= 1.0 + 1e-9 for r in got)


@pytest.mark.parametrize("prefix", ["", "42|move|0|1|2", "é" * 27, "b" * 54, "f" * 64, "g" * 130])
def test_draws_of_a_batch_are_those_of_single_keys(prefix, monkeypatch):
    # All widths of numbers, and keys of one, two and three blocks of the hash; several parts of a batch.
    monkeypatch.setattr(repair_blocks, "DRAWS_AT_ONCE", 7)
    numbers = np.r_[0:30, 10 ** np.arange(1, 18), 10 ** np.arange(1, 18) - 1]
    digests = [hashlib.md5(f"{prefix}|{i}".encode()).digest() for i in numbers]
    expected = [(int.from_bytes(d[:8], "big") >> 12) / 2.0**52 for d in digests]
    assert repair_blocks.uniforms(prefix, numbers).tolist() == expected


def test_records_are_dealt_with_their_codes_in_words(spark):
    """A pass without visits gives back all records, largest codes and many columns included; few columns are shuffled."""
    sizes = {"a": 1, "b": 2, "c": 32_768, "d": 32_769, "e": 10_000_000} | {f"f{i}": 200 for i in range(6)}
    codes = list(sizes)
    made = [(b, i, *[(z - 1 - i) % z for z in sizes.values()]) for b in (0, 3) for i in range(50)]
    synth = spark.createDataFrame(made, ", ".join(f"{c} {'long' if c == 'row_id' else 'int'}" for c in ("budget_id", "row_id", *codes)))
    out = repair_blocks.repair_pass(synth, {}, [], sizes, [0, 3], 50, None, "s")
    assert out.schema == synth.schema and sorted(map(tuple, out.collect())) == sorted(made)
    places = repair_blocks.word_places(codes, sizes)
    assert 1 + max(word for word, _, _ in places.values()) == 2
    assert all(first + bits <= 63 and sizes[c] <= 1 << bits for c, (_, first, bits) in places.items())
    sent = re.search(r"MapInArrow run\(([^)]*)\)", out._jdf.queryExecution().sparkPlan().toString()).group(1)
    assert re.findall(r"(\w+)#", sent) == ["budget_id", "row_id", "_block", "_word0", "_word1"]


def test_differences_are_counted_without_writing_the_records(spark, folder, monkeypatch):
    """The records are read once; beside them only small tables are staged, and those of the rows go when the targets are there."""
    from tabveil.catalog import synthesis

    labels, stage = [], synthesis.stage
    monkeypatch.setattr(synthesis, "stage", lambda df, label: labels.append(label) or stage(df, label))
    assert synthesis.repair_surpluses(spark, folder).count() > 0
    assert "records" not in labels


def test_coded_rows_are_all_that_preparing_leaves(spark, folder):
    from pathlib import Path

    from tabveil.catalog.tables import MICRODATA, microdata
    from tabveil.plans import common
    from tabveil.session import scratch_folder
    from tabveil.spec import SynthesisSettings

    tables = Path(scratch_folder(spark)) / "tabveil"
    before = set(tables.iterdir()) if tables.exists() else set()
    source = common.prepare(microdata(spark, folder), MICRODATA, SynthesisSettings(seed="s"))
    assert [x.name.split("-")[0] for x in set(tables.iterdir()) - before] == ["coded"]
    assert source.train.count() == source.train_rows and source.test.count() > 0
