"""Queries on synthetic records: sampling, repair, tree model, re-weighting."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabveil.catalog import oracle as O
from tabveil.catalog.measuring import BY_ATTRS, TRIPLE, information
from tabveil.catalog.tables import BUDGETS, COLUMNS, MICRODATA, SEED, WORKLOAD, microdata, prepared
from tabveil.functions.accounting import sigma_for
from tabveil.operators import consistency, draws, marginals, noise, repair, repair_blocks, reweight, tree
from tabveil.plans.model_synthesis import model_synthesis
from tabveil.plans.repair_synthesis import repair_synthesis
from tabveil.session import drop, stage
from tabveil.spec import SynthesisSettings

IDS = [b.budget_id for b in BUDGETS]
ROUNDS = 8
DISJOINT = [
    TRIPLE, BY_ATTRS["n_name", "r_name"], BY_ATTRS["o_orderstatus", "o_orderpriority", "c_mktsegment"],
]
STEP = [repair.Visit(0, m) for m in DISJOINT]
# A forest that the schema alone determines.
EDGES = [m.attrs for m in WORKLOAD if len(m.attrs) == 2 and m.attrs not in [("l_quantity", "l_extendedprice")]]
ORDER = tree.sampling_order(EDGES, COLUMNS, "target")
# Every measured pair counts alike, so that the schema alone determines the two parents as well.
TWO_PARENTS = tree.two_parent_order(dict.fromkeys(EDGES, 1.0), [m.attrs for m in WORKLOAD], COLUMNS, "target")
SIGMAS = {b.budget_id: sigma_for(b.epsilon, b.delta, len(WORKLOAD)) for b in BUDGETS}


def _targets(spark, folder):
    p = prepared(spark, folder)
    coded = stage(p.coded, "coded")
    cells = marginals.dense_cells(coded, WORKLOAD, p.sizes)
    noisy = noise.measure(cells, BUDGETS, len(WORKLOAD), SEED).withColumnRenamed("noisy", "value")
    n = coded.count()
    targets = stage(consistency.make_consistent(noisy, WORKLOAD, p.sizes, n, ROUNDS), "targets")
    # From here on only the domain sizes of ``p`` are used.
    drop(coded, p.raw)
    return targets, p, n


TARGETS = O.measured(WORKLOAD) + "," + O.consistent(WORKLOAD, ROUNDS)


def _table_sql(column: str, parents: tuple[str, ...]) -> str:
    """(budget_id, given, code, value) of a column's table over its parents, with the stand-ins for codes without mass."""
    m = next(m for m in WORKLOAD if len(m.attrs) == len(parents) + 1 and set(m.attrs) == {column, *parents})
    if not parents:
        return f"SELECT budget_id, 0 AS given, cell::INTEGER AS code, value FROM fin WHERE marginal_id = {m.marginal_id}"
    return f"""SELECT t.budget_id, t.given, t.code, CASE WHEN sum(t.value) OVER (PARTITION BY t.budget_id, t.given) > 0
  THEN t.value ELSE o.value END AS value FROM (
  SELECT budget_id, {O.projected(m.attrs, parents)}::INTEGER AS given, z_{parents[-1]} AS width,
    {O.projected(m.attrs, (column,))}::INTEGER AS code, value FROM fin, dom WHERE marginal_id = {m.marginal_id}) t
  JOIN ({_table_sql(column, parents[:-1])}) o ON o.budget_id = t.budget_id AND o.given = t.given // t.width AND o.code = t.code"""


def _cuts_sql(column: str, parents: tuple[str, ...]) -> str:
    """Intervals of one column, per code of its parents."""
    return f"""
cu_{column} AS MATERIALIZED (SELECT budget_id, given, code,
  coalesce(sum(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    / sum(value) OVER (PARTITION BY budget_id, given) AS low,
  CASE WHEN lead(code) OVER w IS NULL THEN 1 ELSE sum(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    / sum(value) OVER (PARTITION BY budget_id, given) END AS high
  FROM ({_table_sql(column, parents)}) WHERE value > 0 WINDOW w AS (PARTITION BY budget_id, given ORDER BY code))"""


def _sample_sql(order, purpose: str, name: str) -> str:
    """Rows drawn column by column."""
    order = [(c, draws.parents_of((c, p))) for c, p in order]
    text = ",".join(_cuts_sql(c, p) for c, p in order)
    text += f""",
s0 AS MATERIALIZED (SELECT budget_id, r AS row_id FROM bu, (SELECT unnest(range((SELECT count(*) FROM cd))) AS r))"""
    for i, (c, p) in enumerate(order):
        u = O.uniform(O.key(f"'{SEED}'", f"'{purpose}'", "s.budget_id", str(i // 2), "s.row_id"), i % 2)
        given = "0" if not p else O.cell(p, "s.")
        text += f""",
s{i + 1} AS MATERIALIZED (SELECT s.* EXCLUDE (u), code AS {c} FROM (SELECT s.*, {u} AS u FROM s{i} s) s {"CROSS JOIN dom" if len(p) > 1 else ""}
  JOIN cu_{c} c ON c.budget_id = s.budget_id AND c.given = {given} AND s.u >= c.low AND s.u < c.high)"""
    return text + f", {name} AS MATERIALIZED (SELECT * FROM s{len(order)})"


INDEPENDENT = _sample_sql([(c, None) for c in COLUMNS], "independent", "sy")


def _independent(spark, folder):
    targets, p, n = _targets(spark, folder)
    rows = draws.sample_independent(targets, WORKLOAD, COLUMNS, p.sizes, n, IDS, SEED)
    return rows, targets, p, n


def sample_independent(spark, folder):
    return _independent(spark, folder)[0]


def _differences(spark, folder):
    rows, targets, p, n = _independent(spark, folder)
    visit = STEP[:1]
    # Read once, for the counts: the records need not be written.
    drawn = repair.with_visit_draws(rows, visit, 1, SEED)
    counts = repair.bucket_counts(drawn, visit, p.sizes, IDS, 1)
    wanted = targets.filter(F.col("marginal_id") == TRIPLE.marginal_id)
    return stage(repair.cell_differences(wanted, counts), "differences")


def repair_diffs(spark, folder):
    return _differences(spark, folder).withColumn("diff", F.round("diff", 6))


def repair_slots(spark, folder):
    return repair.move_slots(_differences(spark, folder))[0]


def repair_surpluses(spark, folder):
    return repair.move_slots(_differences(spark, folder))[1]


def repair_step(spark, folder):
    """One step that visits three marginals without a common attribute, by blocks of records."""
    rows, targets, p, n = _independent(spark, folder)
    goals = repair_blocks.goal_tables(targets, [v.marginal for v in STEP], p.sizes, IDS)
    return repair_blocks.repair_pass(rows, goals, [STEP], p.sizes, IDS, n, None, SEED)


def repair_step_stored(spark, folder):
    """The same step from storage, the way larger tables are repaired."""
    rows, targets, p, n = _independent(spark, folder)
    return repair.repair_step(stage(rows, "records"), targets, STEP, p.sizes, IDS, n, None, SEED)


def _visit_sql(m, source: str = "sy") -> str:
    i = m.marginal_id
    u = O.uniform(O.key(f"'{SEED}'", "'move'", "0", str(i), "budget_id", "row_id"))
    return f"""
df{i} AS MATERIALIZED (SELECT f.budget_id, f.cell, round(f.value, 6) - coalesce(n, 0) AS diff FROM fin f LEFT JOIN (
    SELECT budget_id, {O.cell(m.attrs)} AS cell, count(*) AS n FROM {source}, dom GROUP BY ALL) c
  ON c.budget_id = f.budget_id AND c.cell = f.cell WHERE f.marginal_id = {i}),
de{i} AS MATERIALIZED (SELECT budget_id, cell, (sum(ceil(diff - 0.5)) OVER w - ceil(diff - 0.5))::BIGINT AS low,
  (sum(ceil(diff - 0.5)) OVER w)::BIGINT AS high FROM df{i} WHERE diff > 0.5
  WINDOW w AS (PARTITION BY budget_id ORDER BY diff DESC, cell ROWS UNBOUNDED PRECEDING)),
su{i} AS MATERIALIZED (SELECT budget_id, cell, (sum(ceil(-diff)) OVER w - ceil(-diff))::BIGINT AS start, ceil(-diff)::BIGINT AS quota
  FROM df{i} WHERE diff < -0.5 WINDOW w AS (PARTITION BY budget_id ORDER BY diff, cell ROWS UNBOUNDED PRECEDING)),
rk{i} AS MATERIALIZED (SELECT s.budget_id, row_id, quota, start + row_number() OVER (PARTITION BY s.budget_id, s.cell ORDER BY u, row_id) - 1 AS slot,
  row_number() OVER (PARTITION BY s.budget_id, s.cell ORDER BY u, row_id) - 1 AS k
  FROM (SELECT budget_id, row_id, {O.cell(m.attrs)} AS cell, {u} AS u FROM {source}, dom) s
  JOIN su{i} ON su{i}.budget_id = s.budget_id AND su{i}.cell = s.cell),
mv{i} AS MATERIALIZED (SELECT r.budget_id, r.row_id, d.cell AS to_cell FROM rk{i} r
  ASOF JOIN de{i} d ON d.budget_id = r.budget_id AND r.slot >= d.low WHERE k < quota AND r.slot < d.high)"""


def _step_sql() -> str:
    owner = {a: m for m in DISJOINT for a in m.attrs}
    columns = []
    for c in COLUMNS:
        if c not in owner:
            columns.append(f"sy.{c}")
            continue
        m = owner[c]
        code = O.projected(m.attrs, (c,)).replace("cell", f"mv{m.marginal_id}.to_cell")
        columns.append(f"CASE WHEN mv{m.marginal_id}.to_cell IS NULL THEN sy.{c} ELSE {code}::INTEGER END AS {c}")
    joins = " ".join(
        f"LEFT JOIN mv{m.marginal_id} ON mv{m.marginal_id}.budget_id = sy.budget_id "
        f"AND mv{m.marginal_id}.row_id = sy.row_id" for m in DISJOINT
    )
    return (
        TARGETS + "," + INDEPENDENT + "," + ",".join(_visit_sql(m) for m in DISJOINT)
        + f" SELECT sy.budget_id, sy.row_id, {', '.join(columns)} FROM sy {joins} CROSS JOIN dom"
    )


VISIT = TARGETS + "," + INDEPENDENT + "," + _visit_sql(TRIPLE)
T = TRIPLE.marginal_id


def tree_edges(spark, folder):
    edges = tree.tree_edges(information(spark, folder))
    return spark.createDataFrame(edges, "a string, b string")


# An edge belongs to the heaviest forest if heavier edges alone do not connect its ends.
EDGES_SQL = O.base().replace("WITH ", "WITH RECURSIVE ", 1) + "," + O.information() + """,
rk AS MATERIALIZED (SELECT a, b, row_number() OVER (ORDER BY mi DESC, pair_ord) AS r FROM mi),
bo AS MATERIALIZED (SELECT a AS x, b AS y, r FROM rk UNION ALL SELECT b, a, r FROM rk),
rc AS (SELECT r AS edge, a AS node FROM rk UNION
  SELECT edge, y FROM rc JOIN bo ON bo.x = rc.node AND bo.r < rc.edge)
SELECT a, b FROM rk WHERE NOT EXISTS (SELECT 1 FROM rc WHERE rc.edge = rk.r AND rc.node = rk.b)"""


def tree_cpt(spark, folder):
    targets, p, _ = _targets(spark, folder)
    cuts = draws.intervals(draws.conditional_masses(targets, WORKLOAD, ORDER, p.sizes))
    return cuts.filter("low < high").select(
        "attr", "budget_id", "given", "code", F.round("low", 9).alias("low"),
        F.round("high", 9).alias("high"),
    )


CPT_SQL = TARGETS + "," + ",".join(_cuts_sql(c, draws.parents_of((c, p))) for c, p in ORDER) + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS attr, budget_id, given, code, round(low, 9) AS low, round(high, 9) AS high FROM cu_{c}"
    for c, _ in ORDER
)


def tree_sample(spark, folder):
    targets, p, n = _targets(spark, folder)
    return tree.sample_tree(targets, WORKLOAD, ORDER, COLUMNS, p.sizes, n, IDS, SEED)


def tree2_sample(spark, folder):
    """Records drawn with two parents where a triple was measured."""
    targets, p, n = _targets(spark, folder)
    return tree.sample_tree(targets, WORKLOAD, TWO_PARENTS, COLUMNS, p.sizes, n, IDS, SEED)


def _reweighted(spark, folder):
    """Log-linear fit on a pool drawn from the tree model, and whole records drawn from it."""
    targets, p, n = _targets(spark, folder)
    pool = stage(
        tree.sample_tree(targets, WORKLOAD, TWO_PARENTS, COLUMNS, p.sizes, n, IDS, SEED), "pool"
    )
    fit = reweight.fit_potentials(pool, targets, WORKLOAD, p.sizes, IDS, sigmas=SIGMAS)
    drawn = reweight.draw_records(pool, fit.potentials, WORKLOAD, p.sizes, IDS, n, n, SEED)
    drop(pool)
    return drawn, fit, targets, p


def reweight_synth(spark, folder):
    return _reweighted(spark, folder)[0]


def reweight_fit(spark, folder):
    """Per marginal its target's cells, total and bound, and whether the records drawn from the fitted model keep to the bound.

    Whole records instead of weights add up to half a record per cell and square root of its count.
    """
    drawn, _, targets, p = _reweighted(spark, folder)
    counts = reweight.weighted_cells(stage(drawn, "drawn").withColumn("weight", F.lit(1.0)), WORKLOAD, p.sizes, IDS)
    both = targets.join(counts, ["budget_id", "marginal_id", "cell"], "left")
    off = F.sum(F.abs(F.coalesce("current", F.lit(0.0)) - F.col("value"))) / (2 * F.sum("value"))
    most = reweight.residual_bound(F.count(F.lit(1)), F.sum("value"), reweight.RESIDUAL, SIGMAS)
    rounding = F.sum(F.sqrt("value")) / (2 * F.sum("value"))
    return both.groupBy("budget_id", "marginal_id").agg(
        F.count(F.lit(1)).alias("cells"), F.round(F.sum("value"), 4).alias("total"), F.round(most, 9).alias("most"),
        (off <= most + rounding).alias("within"),
    )


FIT_SQL = TARGETS + f""",
sg AS (SELECT budget_id, max(sigma) AS sigma FROM ns GROUP BY budget_id)
SELECT budget_id, marginal_id, count(*) AS cells, round(sum(value), 4) AS total,
round(greatest({reweight.RESIDUAL}::DOUBLE, {reweight.NOISE_FACTOR}::DOUBLE * any_value(sigma) * count(*) * sqrt(0.5::DOUBLE / pi()) / sum(value)), 9) AS most, true AS within
FROM fin JOIN sg USING (budget_id) GROUP BY budget_id, marginal_id"""


# The published budgets, workload sizes, rounds and passes.
REPAIR = SynthesisSettings(seed=SEED)
MODEL = SynthesisSettings.for_model(seed=SEED)


def synthesise_repair(spark, folder):
    return repair_synthesis(microdata(spark, folder), MICRODATA, REPAIR).readable


def synthesise_model(spark, folder):
    return model_synthesis(microdata(spark, folder), MICRODATA, MODEL).readable


QUERIES = {
    "sample_independent": (sample_independent, TARGETS + "," + INDEPENDENT + " SELECT * FROM sy"),
    "repair_diffs": (
        repair_diffs,
        VISIT + f" SELECT budget_id, {T} AS marginal_id, cell, round(diff, 6) AS diff FROM df{T}",
    ),
    "repair_slots": (
        repair_slots,
        VISIT + f" SELECT budget_id, {T} AS marginal_id, slot, cell AS to_cell FROM "
        f"(SELECT *, unnest(range(low, high)) AS slot FROM de{T})",
    ),
    "repair_surpluses": (
        repair_surpluses,
        VISIT + f""" SELECT budget_id, {T} AS marginal_id, cell, start,
least(quota, room - start) AS keep FROM su{T} JOIN (SELECT budget_id, max(high) AS room FROM de{T} GROUP BY budget_id) USING (budget_id)
WHERE room > start""",
    ),
    "repair_step": (repair_step, _step_sql()),
    "repair_step_stored": (repair_step_stored, _step_sql()),
    "tree_edges": (tree_edges, EDGES_SQL),
    "tree_cpt": (tree_cpt, CPT_SQL),
    "tree_sample": (tree_sample, TARGETS + "," + _sample_sql(ORDER, "tree", "sy") + " SELECT * FROM sy"),
    "tree2_sample": (tree2_sample, TARGETS + "," + _sample_sql(TWO_PARENTS, "tree", "sy") + " SELECT * FROM sy"),
    "reweight_synth": (reweight_synth, None),
    "reweight_fit": (reweight_fit, FIT_SQL),
    "synthesise_repair": (synthesise_repair, None),
    "synthesise_model": (synthesise_model, None),
}
