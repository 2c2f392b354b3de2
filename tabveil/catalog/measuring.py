"""Queries on counting, workload choice, noise and consistency."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabveil.catalog import oracle as O
from tabveil.catalog.tables import (
    BUDGETS, COLUMNS, DELTA, EPSILONS, NUMERIC, SEED, WORKLOAD, microdata, prepared,
)
from tabveil.functions.accounting import sigma_column
from tabveil.functions.cells import cell_of
from tabveil.operators import accountant, consistency, marginals, noise, selection, sparse_noise, workload
from tabveil.session import stage
from tabveil.sources.tables import read_fact
from tabveil.spec import Marginal

BY_ATTRS = {m.attrs: m for m in WORKLOAD}
PAIR = BY_ATTRS["n_name", "r_name"]
TRIPLE = BY_ATTRS["l_quantity", "l_discount", "target"]
# A connected part of the workload for the queries that iterate.
SMALL = [
    BY_ATTRS[a] for a in [
        ("l_quantity",), ("l_discount",), ("n_name",), ("r_name",), ("target",),
        ("n_name", "r_name"), ("l_quantity", "target"), ("l_discount", "target"),
        ("l_quantity", "l_discount", "target"), ("n_name", "r_name", "target"),
    ]
]
K = len(WORKLOAD)


def _dense(marginal):
    def run(spark, folder):
        p = prepared(spark, folder)
        return marginals.dense_cells(p.coded, [marginal], p.sizes)
    return run


def _dense_sql(chosen) -> str:
    return ",".join([O.base(), O.counts(chosen), O.grid(chosen), O.FULL]) + " SELECT * FROM fc"


def marginals_batch(spark, folder):
    p = prepared(spark, folder)
    return marginals.dense_cells(p.coded, WORKLOAD, p.sizes)


def marginals_all_pairs(spark, folder):
    p = prepared(spark, folder)
    return workload.count_pairs(p.coded, COLUMNS, p.sizes)[0]


def marginals_exploded(spark, folder):
    """The same counts without task-side arrays, the way larger domains are counted."""
    p = prepared(spark, folder)
    return marginals.count_cells(p.coded, WORKLOAD, p.sizes, array_cells=0)


def marginals_grouping_sets(spark, folder):
    p = prepared(spark, folder)
    return marginals.grouping_set_counts(p.coded, WORKLOAD, p.sizes)


def marginal_projection(spark, folder):
    p = prepared(spark, folder)
    counts = marginals.count_cells(p.coded, [TRIPLE], p.sizes)
    found = [(TRIPLE, m) for m in SMALL if set(m.attrs) < set(TRIPLE.attrs)]
    return marginals.project_cells(counts, found, p.sizes)


def pairs_to_singles(spark, folder):
    """1-way tables taken from the pair tables instead of from the rows."""
    p = prepared(spark, folder)
    counts, pairs = workload.count_pairs(p.coded, COLUMNS, p.sizes)
    singles = [m for m in WORKLOAD if len(m.attrs) == 1]
    return marginals.cells_from_pairs(counts, pairs, singles, p.sizes)


def tuple_counts(spark, folder):
    return marginals.tuple_counts(prepared(spark, folder).coded, TRIPLE.attrs)


def cell_codes(spark, folder):
    p = prepared(spark, folder)
    counts = marginals.dense_cells(p.coded, [TRIPLE], p.sizes)
    return marginals.cell_codes(counts, TRIPLE, p.sizes)


def value_summary(spark, folder):
    events = read_fact(spark, folder, "events", ["event_type", "value"])
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"),
        F.round(F.avg("value"), 6).alias("mean"), F.min("value").alias("low"),
        F.max("value").alias("high"), F.bool_or(F.col("value") > 100).alias("any_large"),
    )


SUMMARY_SQL = """SELECT event_type, count(*) AS n, round(sum(value), 4) AS total,
round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high,
bool_or(value > 100) AS any_large FROM events GROUP BY event_type"""


def information(spark, folder):
    p = prepared(spark, folder)
    counts, pairs = workload.count_pairs(p.coded, COLUMNS, p.sizes)
    return workload.pair_information(stage(counts, "pairs"), pairs, p.sizes)


INFO = O.base() + "," + O.information()


def _listed(df):
    """Attribute lists as text, the form both engines print alike."""
    return df.withColumn("attrs", F.array_join("attrs", ","))


def top_pairs(spark, folder):
    return _listed(workload.top_pairs(information(spark, folder), 25))


PAIRS_SQL = INFO + " SELECT pair_ord, a || ',' || b AS attrs, mi AS score FROM mi ORDER BY mi DESC, pair_ord LIMIT 25"


def top_triples(spark, folder):
    scores = workload.triple_scores(information(spark, folder), COLUMNS, "target")
    return _listed(workload.top_triples(scores, 10))


TRIPLES_SQL = INFO + "," + O.triples() + " SELECT triple_ord, array_to_string(attrs, ',') AS attrs, score FROM ts ORDER BY score DESC, triple_ord LIMIT 10"


def random_pairs(spark, folder):
    chosen = workload.top_pairs(information(spark, folder), 25)
    return _listed(workload.random_sets(
        workload.candidate_sets(spark, COLUMNS, 2), chosen, 15, SEED, "pairs"
    ).select("ord", "attrs"))


def _draw(purpose: str) -> str:
    return f"md5(concat_ws('|', '{SEED}', '{purpose}', ord))"


RANDOM_SQL = INFO + f""",
tp AS (SELECT [a, b] AS attrs FROM mi ORDER BY mi DESC, pair_ord LIMIT 25),{O.sets(2, 'c2')}
SELECT ord, array_to_string(attrs, ',') AS attrs FROM c2 WHERE attrs NOT IN (SELECT attrs FROM tp) ORDER BY {_draw('pairs')}, ord LIMIT 15"""


def _workload_sql(pairs: int, triples: int, more_pairs: int, more_triples: int) -> str:
    parts = [
        "SELECT 0 AS p, ord, attrs, 'one' AS kind, NULL::DOUBLE AS score FROM c1",
        "SELECT 1, r, attrs, 'pair', score FROM tp",
        "SELECT 2, r, attrs, 'triple', score FROM tt",
    ]
    if more_pairs:
        parts.append(
            f"SELECT 3, row_number() OVER (ORDER BY {_draw('pairs')}), attrs, 'random pair', NULL FROM "
            f"(SELECT * FROM c2 WHERE attrs NOT IN (SELECT attrs FROM tp) ORDER BY {_draw('pairs')} LIMIT {more_pairs})"
        )
        parts.append(
            f"SELECT 4, row_number() OVER (ORDER BY {_draw('triples')}), attrs, 'random triple', NULL FROM "
            f"(SELECT * FROM c3 WHERE attrs NOT IN (SELECT attrs FROM tt) ORDER BY {_draw('triples')} LIMIT {more_triples})"
        )
    return INFO + "," + O.triples() + f""",{O.sets(1, 'c1')},{O.sets(2, 'c2')},{O.sets(3, 'c3')},
tp AS (SELECT [a, b] AS attrs, mi AS score, row_number() OVER (ORDER BY mi DESC, pair_ord) AS r FROM mi QUALIFY r <= {pairs}),
tt AS (SELECT attrs, score, row_number() OVER (ORDER BY score DESC, triple_ord) AS r FROM ts QUALIFY r <= {triples}),
al AS ({' UNION ALL '.join(parts)}),
fi AS (SELECT * FROM al QUALIFY row_number() OVER (PARTITION BY attrs ORDER BY p, ord) = 1)
SELECT (row_number() OVER (ORDER BY p, ord) - 1)::INTEGER AS marginal_id, array_to_string(attrs, ',') AS attrs, kind, score FROM fi"""


def workload_model(spark, folder):
    return _listed(workload.select_workload(information(spark, folder), COLUMNS, "target", 20, 8))


def workload_repair(spark, folder):
    return _listed(workload.select_workload(
        information(spark, folder), COLUMNS, "target", 25, 10, 15, 8, SEED
    ))


def rho_budget(spark, folder):
    """Budget and noise scale for the number of marginals the line-item table's columns allow."""
    table = noise.budget_table(spark, BUDGETS)
    width = len(microdata(spark, folder).columns)
    queries = F.explode(F.array(F.lit(width), F.lit(width * (width - 1) // 2)))
    return table.withColumn("queries", queries).select(
        "budget_id", "epsilon", F.round("rho", 9).alias("rho"), "queries",
        F.round(sigma_column(F.col("rho"), F.col("queries")), 6).alias("sigma"),
    )


RHO_SQL = f"""WITH {O.BUDGETS}, w AS (SELECT unnest([15, 105]) AS queries)
SELECT budget_id, epsilon, round({O.RHO}, 9) AS rho, queries,
round(sqrt(queries::DOUBLE / (2 * {O.RHO})), 6) AS sigma FROM bu, w"""


def _noisy(chosen, clip, budgets, queries):
    def run(spark, folder):
        p = prepared(spark, folder)
        cells = marginals.dense_cells(p.coded, chosen, p.sizes)
        out = noise.measure(cells, budgets, queries, SEED, clip)
        return out.withColumn("sigma", F.round("sigma", 6)).withColumn("noisy", F.round("noisy", 6))
    return run


def _noisy_sql(chosen, clip, where, queries) -> str:
    return O.measured(chosen, queries, clip, where) + (
        " SELECT budget_id, epsilon, marginal_id, cell, n, round(sigma, 6) AS sigma, round(noisy, 6) AS noisy FROM ns"
    )


def privacy_ledger(spark, folder):
    information_ = information(spark, folder)
    chosen = workload.as_marginals(workload.select_workload(information_, COLUMNS, "target", 20, 8))
    ledger = noise.privacy_ledger(spark, BUDGETS, len(chosen))
    return ledger.withColumn("rho", F.round("rho", 9))


LEDGER_SQL = _workload_sql(20, 8, 0, 0).replace("SELECT (row_number()", "SELECT * FROM (SELECT (row_number()", 1)
LEDGER_SQL = LEDGER_SQL[:LEDGER_SQL.index("SELECT * FROM (SELECT (row_number()")].rstrip() + f""",{O.BUDGETS},
us AS (SELECT * FROM (VALUES ('bin edges', false), ('vocabularies', false), ('column ranking', false),
  ('row count', false), ('marginals', true)) t(used_for, charged))
SELECT budget_id, epsilon, used_for, charged,
CASE WHEN charged THEN (SELECT count(*) FROM fi) ELSE 0 END::INTEGER AS queries,
CASE WHEN charged THEN round({O.RHO}, 9) ELSE 0 END AS rho FROM bu, us"""


# 116 million cells at 8 bins.
LARGE = Marginal(K, ("l_quantity", "l_extendedprice", "o_totalprice", "p_retailprice", "c_mktsegment", "p_brand", "p_type", "n_name"))


def noisy_large_marginal(spark, folder):
    """Released cells of a marginal that can't be written out, per budget."""
    p = prepared(spark, folder)
    return sparse_noise.measure_sparse(stage(p.coded, "coded"), LARGE, p.sizes, BUDGETS, 1, SEED)


def noisy_large_filled(spark, folder):
    """Of these the cells that hold rows, with their counts and noise: all others come from the draws for empty cells."""
    p = prepared(spark, folder)
    coded = stage(p.coded, "coded")
    released = sparse_noise.measure_sparse(coded, LARGE, p.sizes, BUDGETS, 1, SEED)
    filled = coded.groupBy(cell_of(LARGE.attrs, p.sizes).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    return released.join(filled, "cell").select(
        "budget_id", "cell", "n", F.round("threshold", 6).alias("threshold"), F.round("noisy", 6).alias("noisy")
    )


LARGE_SQL = O.base() + f""",{O.BUDGETS},
ct AS MATERIALIZED (SELECT {O.cell(LARGE.attrs)} AS cell, count(*) AS n FROM cd, dom GROUP BY ALL),
sg AS (SELECT budget_id, sqrt(1::DOUBLE / (2 * {O.RHO})) AS sigma FROM bu),
nz AS (SELECT budget_id, cell, n, sigma, n + sigma * {O.GAUSS} AS noisy FROM (
  SELECT *, sha256({O.key(f"'{SEED}'", "'noise'", "budget_id", str(LARGE.marginal_id), "cell")}) AS dg FROM ct, sg))
SELECT budget_id, cell, n, round(sigma * {{quantile}}::DOUBLE, 6) AS threshold, round(noisy, 6) AS noisy FROM nz
WHERE noisy >= sigma * {{quantile}}::DOUBLE"""
# Domain sizes of these columns are the same at every scale: 8 bins each, and 6, 26, 7 and 26 labels.
LARGE_SQL = LARGE_SQL.format(quantile=repr(sparse_noise.threshold_for(8**4 * 6 * 26 * 7 * 26, 1.0)))

SHARE = 0.25
PAID_PAIRS, PAID_TRIPLES = 20, 8


def _paid(spark, folder):
    rows = microdata(spark, folder).count()
    return selection.PaidSelection(selection.selection_rho(BUDGETS[2:], SHARE), rows, SEED)


def paid_sets(spark, folder):
    """Pairs and target triples chosen by noisy scores; the scores are shown here for the comparison only."""
    chosen = workload.paid_sets(information(spark, folder), COLUMNS, "target", PAID_PAIRS, PAID_TRIPLES, _paid(spark, folder))
    parts = [
        df.select(F.lit(kind).alias("kind"), "attrs", F.round("noisy", 6).alias("noisy")) for kind, df in zip(("pair", "triple"), chosen)
    ]
    return _listed(parts[0].unionByName(parts[1]))


def paid_workload(spark, folder):
    """The workload of the model job, its ranking paid for."""
    return _listed(workload.select_workload(
        information(spark, folder), COLUMNS, "target", PAID_PAIRS, PAID_TRIPLES, paid=_paid(spark, folder)
    ))


def paid_ledger(spark, folder):
    paid = _paid(spark, folder)
    chosen = workload.as_marginals(workload.select_workload(
        information(spark, folder), COLUMNS, "target", PAID_PAIRS, PAID_TRIPLES, paid=paid
    ))
    ledger = noise.privacy_ledger(spark, BUDGETS[2:], len(chosen), PAID_PAIRS + PAID_TRIPLES, paid.rho)
    return ledger.withColumn("rho", F.round("rho", 9))


_SPENT = f"(SELECT {SHARE}::DOUBLE * min({O.RHO}) FROM bu WHERE budget_id >= 2)"


def _gumbel(purpose: str, order: str) -> str:
    k = O.key(f"'{SEED}'", "'select'", f"'{purpose}'", order)
    return f"(-ln(-ln(({O.hash52(f'sha256({k})')} + 0.5::DOUBLE) / 4503599627370496::DOUBLE)))"


PAID = INFO + "," + O.triples() + f""",{O.BUDGETS},
ch AS (SELECT 2 / n * ln((n + 1) / 2) + (n - 1) / n * ln((n + 1) / (n - 1)) AS d,
  2::DOUBLE / sqrt(8 * {_SPENT} / {PAID_PAIRS + PAID_TRIPLES}) AS s FROM (SELECT count(*)::DOUBLE AS n FROM cd)),
np AS (SELECT [a, b] AS attrs, round(mi + s * d * {_gumbel('pairs', 'pair_ord')}, 9) AS noisy, pair_ord AS o FROM mi, ch),
nt AS (SELECT attrs, round(score + s * 2.5::DOUBLE * d * {_gumbel('triples', 'triple_ord')}, 9) AS noisy, triple_ord AS o FROM ts, ch),
tp AS (SELECT *, row_number() OVER (ORDER BY noisy DESC, o) AS r FROM np QUALIFY r <= {PAID_PAIRS}),
tt AS (SELECT *, row_number() OVER (ORDER BY noisy DESC, o) AS r FROM nt QUALIFY r <= {PAID_TRIPLES}),{O.sets(1, 'c1')},
fi AS (SELECT 0 AS p, ord, attrs, 'one' AS kind FROM c1 UNION ALL SELECT 1, r, attrs, 'pair' FROM tp UNION ALL SELECT 2, r, attrs, 'triple' FROM tt)"""
PAID_SETS_SQL = PAID + """ SELECT 'pair' AS kind, array_to_string(attrs, ',') AS attrs, round(noisy, 6) AS noisy FROM tp
UNION ALL SELECT 'triple', array_to_string(attrs, ','), round(noisy, 6) FROM tt"""
PAID_WORKLOAD_SQL = PAID + """ SELECT (row_number() OVER (ORDER BY p, ord) - 1)::INTEGER AS marginal_id,
array_to_string(attrs, ',') AS attrs, kind, NULL::DOUBLE AS score FROM fi"""
PAID_LEDGER_SQL = PAID + f""",
us AS (SELECT * FROM (VALUES ('bin edges', 0, 0), ('vocabularies', 0, 0), ('column ranking', {PAID_PAIRS + PAID_TRIPLES}, 1),
  ('row count', 0, 0), ('marginals', (SELECT count(*) FROM fi)::INTEGER, 2)) t(used_for, queries, kind))
SELECT budget_id, epsilon, used_for, queries > 0 AS charged, queries,
round(CASE us.kind WHEN 0 THEN 0 WHEN 1 THEN {_SPENT} ELSE {O.RHO} - {_SPENT} END, 9) AS rho FROM bu, us WHERE budget_id >= 2"""


def _cells_in(spark, folder):
    p = prepared(spark, folder)
    coded = stage(p.coded, "coded")
    cells = marginals.dense_cells(coded, WORKLOAD, p.sizes)
    noisy = noise.measure(cells, BUDGETS, K, SEED)
    total = float(coded.count())
    return noisy.select("budget_id", "marginal_id", "cell", F.col("noisy").alias("value")), p, total


def _rounded(df):
    return df.withColumn("value", F.round("value", 6)).select("budget_id", "marginal_id", "cell", "value")


MEASURED = O.measured(WORKLOAD)
ROUNDED = "SELECT budget_id, marginal_id, cell, round(value, 6) AS value FROM "


def normalise_marginals(spark, folder):
    cells, _, total = _cells_in(spark, folder)
    return _rounded(consistency.normalise(cells, total))


NORMAL_SQL = (
    MEASURED + ",\nr0 AS (SELECT budget_id, marginal_id, cell, noisy AS value FROM ns),"
    + O.normalised("r0", "fin", "(SELECT count(*) FROM cd)::DOUBLE") + ROUNDED + "fin"
)


def consistency_round(spark, folder):
    cells, p, total = _cells_in(spark, folder)
    return _rounded(consistency.pull_together(consistency.normalise(cells, total), WORKLOAD, p.sizes))


ROUND_SQL = (
    MEASURED + ",\nr0 AS (SELECT budget_id, marginal_id, cell, noisy AS value FROM ns),"
    + O.normalised("r0", "n1", "(SELECT count(*) FROM cd)::DOUBLE") + "," + O.pulled("n1", "r1", WORKLOAD)
    + ROUNDED + "r1"
)


def _rounds(rounds):
    def run(spark, folder):
        cells, p, total = _cells_in(spark, folder)
        return _rounded(consistency.make_consistent(cells, WORKLOAD, p.sizes, total, rounds))
    return run


def dpsgd_epsilon(spark, folder):
    rows = microdata(spark, folder).count()
    settings = [(i, z) for i, z in enumerate((0.5, 1.0, 1.5, 2.0, 3.0))]
    table = spark.createDataFrame(settings, "setting_id int, noise_multiplier double")
    out = accountant.training_epsilon(table, rows, batch_size=250, epochs=20, delta=DELTA)
    return out.select(
        "setting_id", "noise_multiplier", F.round("epsilon_per_epoch", 6).alias("epsilon_per_epoch"),
        F.round("epsilon_poisson", 6).alias("epsilon_poisson"),
    )


EPSILON_SQL = f"""WITH {O.MICRODATA},
st AS (SELECT * FROM (VALUES (0, 0.5::DOUBLE), (1, 1.0::DOUBLE), (2, 1.5::DOUBLE), (3, 2.0::DOUBLE), (4, 3.0::DOUBLE)) t(setting_id, noise_multiplier)),
al AS (SELECT *, noise_multiplier / 2 AS z FROM st, (SELECT unnest(range(2, 257)) AS a)),
fa AS (SELECT i, sum(CASE WHEN i = 0 THEN 0 ELSE ln(i) END) OVER (ORDER BY i) AS lf FROM (SELECT unnest(range(0, 257)) AS i)),
qq AS (SELECT 250.0::DOUBLE / count(*) AS q, 20.0::DOUBLE AS epochs, 20 * (count(*) // 250) AS steps FROM md),
tm AS (SELECT setting_id, noise_multiplier, a, z, k.i AS j,
  fa1.lf - k.lf - r.lf + k.i * ln(q) + (a - k.i) * ln(1 - q) + (k.i * k.i - k.i) / (2 * z * z) AS lt
  FROM al, qq, fa k JOIN fa fa1 ON fa1.i = a JOIN fa r ON r.i = a - k.i WHERE k.i <= a),
sm AS (SELECT setting_id, noise_multiplier, a, z, max(lt) AS mx FROM tm GROUP BY ALL),
ls AS (SELECT setting_id, noise_multiplier, a, z, mx + ln(sum(exp(lt - mx))) AS lse FROM tm JOIN sm USING (setting_id, noise_multiplier, a, z) GROUP BY setting_id, noise_multiplier, a, z, mx),
ep AS (SELECT setting_id, noise_multiplier,
  epochs * a / (2 * z * z) + ln((a - 1) / a::DOUBLE) - (ln({DELTA}::DOUBLE) + ln(a)) / (a - 1) AS e1,
  steps * lse / (a - 1) + ln((a - 1) / a::DOUBLE) - (ln({DELTA}::DOUBLE) + ln(a)) / (a - 1) AS e2 FROM ls, qq)
SELECT setting_id, noise_multiplier, round(greatest(min(e1), 0), 6) AS epsilon_per_epoch,
round(greatest(min(e2), 0), 6) AS epsilon_poisson FROM ep GROUP BY ALL"""


def number_in_text(spark, folder):
    """The number after a label in free text, over whole documents."""
    docs = read_fact(spark, folder, "documents", ["doc_id", "text"])
    number = accountant.number_after(F.col("text"), r"[A-Za-z]+ ")
    return docs.select("doc_id", F.when(~F.isnan(number), number).alias("number"))


NUMBER_SQL = r"""SELECT doc_id, TRY_CAST(regexp_extract(text, '[A-Za-z]+ \s*([0-9]+(?:\.[0-9]+)?)', 1) AS DOUBLE)
AS number FROM documents"""


QUERIES = {
    "marginal_1way": (_dense(BY_ATTRS["c_mktsegment",]), _dense_sql([BY_ATTRS["c_mktsegment",]])),
    "marginal_2way_dense": (_dense(PAIR), _dense_sql([PAIR])),
    "marginal_3way": (_dense(TRIPLE), _dense_sql([TRIPLE])),
    "marginals_batch": (marginals_batch, _dense_sql(WORKLOAD)),
    "marginals_all_pairs": (
        marginals_all_pairs, ",".join([O.base(), O.counts(O.PAIRS)]) + " SELECT * FROM ct",
    ),
    "marginals_exploded": (
        marginals_exploded, ",".join([O.base(), O.counts(WORKLOAD)]) + " SELECT * FROM ct",
    ),
    "marginals_grouping_sets": (
        marginals_grouping_sets, ",".join([O.base(), O.counts(WORKLOAD)]) + " SELECT * FROM ct",
    ),
    "marginal_projection": (
        marginal_projection,
        ",".join([O.base(), O.counts([m for m in SMALL if set(m.attrs) < set(TRIPLE.attrs)])])
        + " SELECT * FROM ct",
    ),
    "pairs_to_singles": (
        pairs_to_singles,
        ",".join([O.base(), O.counts([m for m in WORKLOAD if len(m.attrs) == 1])]) + " SELECT * FROM ct",
    ),
    "tuple_counts": (
        tuple_counts,
        O.base() + f" SELECT {', '.join(TRIPLE.attrs)}, count(*) AS n FROM cd GROUP BY ALL",
    ),
    "cell_codes": (
        cell_codes,
        O.base() + f""", g AS (SELECT a.i::INTEGER AS l_quantity, b.i::INTEGER AS l_discount, c.i::INTEGER AS target
FROM (SELECT unnest(range(z_l_quantity)) AS i FROM dom) a, (SELECT unnest(range(z_l_discount)) AS i FROM dom) b,
(SELECT unnest(range(z_target)) AS i FROM dom) c)
SELECT g.l_quantity, g.l_discount, g.target, count(cd.target) AS n FROM g LEFT JOIN cd
ON cd.l_quantity = g.l_quantity AND cd.l_discount = g.l_discount AND cd.target = g.target GROUP BY ALL""",
    ),
    "value_summary": (value_summary, SUMMARY_SQL),
    "mutual_information": (information, INFO + " SELECT * FROM mi"),
    "top_pairs": (top_pairs, PAIRS_SQL),
    "top_triples": (top_triples, TRIPLES_SQL),
    "random_pairs": (random_pairs, RANDOM_SQL),
    "workload_model": (workload_model, _workload_sql(20, 8, 0, 0)),
    "workload_repair": (workload_repair, _workload_sql(25, 10, 15, 8)),
    "sigma_table": (rho_budget, RHO_SQL),
    "noisy_marginal_pair": (_noisy([PAIR], True, [BUDGETS[2]], 1), _noisy_sql([PAIR], True, "budget_id = 2", 1)),
    "noisy_marginals_clipped": (
        _noisy(WORKLOAD, True, [BUDGETS[2]], K), _noisy_sql(WORKLOAD, True, "budget_id = 2", K),
    ),
    "noisy_measurements": (
        _noisy(WORKLOAD, False, [BUDGETS[2]], K), _noisy_sql(WORKLOAD, False, "budget_id = 2", K),
    ),
    "epsilon_sweep": (_noisy(WORKLOAD, True, BUDGETS, K), _noisy_sql(WORKLOAD, True, "true", K)),
    "privacy_ledger": (privacy_ledger, LEDGER_SQL),
    "noisy_large_marginal": (noisy_large_marginal, None),
    "noisy_large_filled": (noisy_large_filled, LARGE_SQL),
    "paid_sets": (paid_sets, PAID_SETS_SQL),
    "paid_workload": (paid_workload, PAID_WORKLOAD_SQL),
    "paid_ledger": (paid_ledger, PAID_LEDGER_SQL),
    "dpsgd_epsilon": (dpsgd_epsilon, EPSILON_SQL),
    "number_in_text": (number_in_text, NUMBER_SQL),
    "normalise_marginals": (normalise_marginals, NORMAL_SQL),
    "consistency_round": (consistency_round, ROUND_SQL),
    "consistency_2rounds": (_rounds(2), MEASURED + "," + O.consistent(WORKLOAD, 2) + ROUNDED + "fin"),
    "consistency_8rounds": (_rounds(8), MEASURED + "," + O.consistent(WORKLOAD, 8) + ROUNDED + "fin"),
}
