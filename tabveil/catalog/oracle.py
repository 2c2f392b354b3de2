"""Plain SQL for the registered queries, written from the definitions."""

from __future__ import annotations

from itertools import combinations

from tabveil.catalog.tables import CATEGORICAL, COLUMNS, DELTA, EPSILONS, NUMERIC, SEED, WORKLOAD
from tabveil.spec import Marginal

VOCAB = (*CATEGORICAL, "target")
STEPS = "[0.0, 0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875, 1.0]"

MICRODATA = """
md AS MATERIALIZED (
  SELECT l_quantity, l_extendedprice, l_discount, l_tax, o_totalprice, p_retailprice,
         l_returnflag, o_orderstatus, o_orderpriority, c_mktsegment, p_brand, p_type, n_name, r_name,
         CASE WHEN l_quantity * (1 - l_discount) > 24 THEN '>T' ELSE '<=T' END AS target
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""


def printed(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR)" if c in NUMERIC else c


def measured(c: str) -> str:
    return f"coalesce(length({printed(c)}) || ':' || {printed(c)}, 'n')"


CONTENT = f"md5(concat_ws('|', {', '.join(measured(c) for c in COLUMNS)}))"
KEYED = f"""
kd AS MATERIALIZED (
  SELECT *, md5(concat_ws('|', content, copy)) AS row_key FROM (
    SELECT *, row_number() OVER (PARTITION BY content) - 1 AS copy FROM (
      SELECT *, {CONTENT} AS content FROM md))
)"""


def edge_list(source: str = "md") -> str:
    cols = ", ".join(f"list_sort(list_distinct(quantile_cont({c}, {STEPS}))) AS e_{c}" for c in NUMERIC)
    vocs = ", ".join(f"list_sort(list_distinct(list({c}))) AS v_{c}" for c in VOCAB)
    return f"\nbook AS MATERIALIZED (SELECT {cols}, {vocs} FROM {source})"


def size_of(c: str) -> str:
    return f"(len(e_{c}) - 1)" if c in NUMERIC else f"(len(v_{c}) + 1)"


DOMAIN = "\ndom AS MATERIALIZED (SELECT " + ", ".join(f"{size_of(c)}::BIGINT AS z_{c}" for c in COLUMNS) + " FROM book)"


def code_of(c: str) -> str:
    if c in NUMERIC:
        return (
            f"coalesce(list_sum([CASE WHEN {c} > x THEN 1 ELSE 0 END "
            f"FOR x IN e_{c}[2:len(e_{c}) - 1]]), 0)::INTEGER"
        )
    return f"(coalesce(list_position(v_{c}, {c}), len(v_{c}) + 1) - 1)::INTEGER"


def coded(source: str = "md", extra: str = "") -> str:
    codes = ", ".join(f"{code_of(c)} AS {c}" for c in COLUMNS)
    return f"\ncd AS MATERIALIZED (SELECT {extra}{codes} FROM {source}, book)"


def base(keyed: bool = False) -> str:
    """The coded microdata with its domain."""
    parts = [MICRODATA, *([KEYED] if keyed else []), edge_list(), DOMAIN,
             coded("kd", "row_key, ") if keyed else coded()]
    return "WITH " + ",".join(parts)


def cell(attrs, prefix: str = "") -> str:
    text = f"{prefix}{attrs[0]}"
    for a in attrs[1:]:
        text = f"({text}) * z_{a} + {prefix}{a}"
    return f"({text})::BIGINT"


def table_cells(attrs) -> str:
    return " * ".join(f"z_{a}" for a in attrs)


def counts(marginals, source: str = "cd", name: str = "ct", extra: str = "") -> str:
    body = " UNION ALL ".join(
        f"SELECT {m.marginal_id} AS marginal_id, {extra}{cell(m.attrs)} AS cell, count(*)::BIGINT AS n "
        f"FROM {source}, dom GROUP BY ALL"
        for m in marginals
    )
    return f"\n{name} AS MATERIALIZED ({body})"


def grid(marginals, name: str = "gr") -> str:
    body = " UNION ALL ".join(
        f"SELECT {m.marginal_id} AS marginal_id, unnest(range({table_cells(m.attrs)})) AS cell FROM dom"
        for m in marginals
    )
    return f"\n{name} AS MATERIALIZED ({body})"


FULL = "\nfc AS MATERIALIZED (SELECT marginal_id, cell, coalesce(n, 0)::BIGINT AS n FROM gr LEFT JOIN ct USING (marginal_id, cell))"

BUDGETS = "\nbu AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {e}::DOUBLE, {DELTA}::DOUBLE)" for i, e in enumerate(EPSILONS)
) + ") t(budget_id, epsilon, delta))"

RHO = "greatest(pow(sqrt(ln(1 / delta) + epsilon) - sqrt(ln(1 / delta)), 2), 1e-12::DOUBLE)"


def hash52(digest: str, start: int = 1) -> str:
    return f"CAST(('0x' || substr({digest}, {start}, 13)) AS BIGINT)::DOUBLE"


def uniform(key: str, index: int = 0) -> str:
    return f"({hash52(f'md5({key})', 1 + 13 * index)} / 4503599627370496::DOUBLE)"


def key(*parts: str) -> str:
    return f"concat_ws('|', {', '.join(parts)})"


GAUSS = (
    f"(sqrt(-2.0::DOUBLE * ln(({hash52('dg')} + 1) / 4503599627370497::DOUBLE)) "
    f"* cos(2.0::DOUBLE * pi() * ({hash52('dg', 14)} / 4503599627370496::DOUBLE)))"
)


def noisy(queries: int, clip: bool, where: str = "true") -> str:
    value = f"n + sigma * {GAUSS}"
    value = f"greatest({value}, 0)" if clip else value
    k = key(f"'{SEED}'", "'noise'", "budget_id", "marginal_id", "cell")
    return (
        f"{BUDGETS},\nns AS MATERIALIZED (SELECT budget_id, epsilon, marginal_id, cell, n, sigma, {value} AS noisy FROM ("
        f"SELECT *, sqrt({queries}::DOUBLE / (2 * {RHO})) AS sigma, sha256({k}) AS dg "
        f"FROM fc, bu WHERE {where}))"
    )


PAIRS = [Marginal(i, attrs) for i, attrs in enumerate(combinations(COLUMNS, 2))]


def information() -> str:
    """Mutual information of all pairs."""
    body = " UNION ALL ".join(
        f"SELECT {p.marginal_id} AS pair_ord, '{p.attrs[0]}' AS a, '{p.attrs[1]}' AS b, "
        f"{p.attrs[0]} AS x, {p.attrs[1]} AS y, count(*) AS n FROM cd GROUP BY ALL"
        for p in PAIRS
    )
    return f"""
pc AS MATERIALIZED ({body}),
mi AS MATERIALIZED (SELECT pair_ord, a, b, round(greatest(sum(n / t * ln(n * t / (nx * ny))), 0), 9) AS mi FROM (
  SELECT pair_ord, a, b, n::DOUBLE AS n, (sum(n) OVER (PARTITION BY pair_ord))::DOUBLE AS t,
         (sum(n) OVER (PARTITION BY pair_ord, x))::DOUBLE AS nx,
         (sum(n) OVER (PARTITION BY pair_ord, y))::DOUBLE AS ny FROM pc) GROUP BY ALL)"""


def triples() -> str:
    others = [c for c in COLUMNS if c != "target"]
    values = ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(combinations(others, 2)))
    return f"""
tr AS (SELECT * FROM (VALUES {values}) t(triple_ord, a, b)),
ts AS MATERIALIZED (SELECT triple_ord, [tr.a, tr.b, 'target'] AS attrs,
  round(pa.mi + pb.mi + 0.5::DOUBLE * ab.mi, 9) AS score FROM tr
  JOIN mi ab ON ab.a = tr.a AND ab.b = tr.b
  JOIN mi pa ON pa.a = tr.a AND pa.b = 'target' JOIN mi pb ON pb.a = tr.b AND pb.b = 'target')"""


def sets(ways: int, name: str) -> str:
    values = ", ".join(
        f"({i}, [{', '.join(repr(c) for c in attrs)}])"
        for i, attrs in enumerate(combinations(COLUMNS, ways))
    )
    return f"\n{name} AS (SELECT * FROM (VALUES {values}) t(ord, attrs))"


def projected(from_attrs, to_attrs) -> str:
    """Cell of ``to_attrs`` from a cell of ``from_attrs``."""
    codes = {}
    for i, a in enumerate(from_attrs):
        step = " * ".join([f"z_{x}" for x in from_attrs[i + 1:]]) or "1"
        codes[a] = f"((cell // ({step})) % z_{a})"
    text = codes[to_attrs[0]]
    for a in to_attrs[1:]:
        text = f"({text}) * z_{a} + {codes[a]}"
    return f"({text})::BIGINT"


def normalised(source: str, name: str, total: str) -> str:
    return f"""
{name} AS MATERIALIZED (SELECT budget_id, marginal_id, cell,
  CASE WHEN s <= 0 THEN {total} / k ELSE v * ({total} / s) END AS value FROM (
    SELECT budget_id, marginal_id, cell, greatest(value, 0) AS v,
           sum(greatest(value, 0)) OVER w AS s, count(*) OVER w AS k
    FROM {source} WINDOW w AS (PARTITION BY budget_id, marginal_id)))"""


def pulled(source: str, name: str, marginals) -> str:
    by = {m.attrs: m for m in marginals}
    parts = []
    for m in marginals:
        for r in range(1, len(m.attrs)):
            for sub in combinations(m.attrs, r):
                if sub in by:
                    parts.append(
                        f"SELECT budget_id, {by[sub].marginal_id} AS marginal_id, {projected(m.attrs, sub)} AS cell, "
                        f"{m.marginal_id} AS source_id, sum(value) AS p FROM {source}, dom "
                        f"WHERE marginal_id = {m.marginal_id} GROUP BY ALL"
                    )
    return f"""
{name}_p AS (SELECT budget_id, marginal_id, cell, avg(p) AS p FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL),
{name} AS MATERIALIZED (SELECT budget_id, marginal_id, cell,
  greatest(CASE WHEN p IS NULL THEN value ELSE 0.5::DOUBLE * value + 0.5::DOUBLE * p END, 0) AS value
  FROM {source} LEFT JOIN {name}_p USING (budget_id, marginal_id, cell))"""


def consistent(marginals, rounds: int, total: str = "(SELECT count(*) FROM cd)::DOUBLE") -> str:
    """Consistency rounds on ns(noisy), result in table fin."""
    text = "\nr0 AS (SELECT budget_id, marginal_id, cell, noisy AS value FROM ns)"
    last = "r0"
    for i in range(1, rounds + 1):
        text += "," + normalised(last, f"n{i}", total) + "," + pulled(f"n{i}", f"r{i}", marginals)
        last = f"r{i}"
    return text + "," + normalised(last, "fin", total)


def measured(marginals, queries: int | None = None, clip: bool = True, where: str = "true") -> str:
    return ",".join([
        base(), counts(marginals), grid(marginals), FULL, noisy(queries or len(marginals), clip, where)
    ])


__all__ = ["MICRODATA", "WORKLOAD"]
