"""Queries on sources, clean-up, splits and coding."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabveil.catalog import oracle as O
from tabveil.catalog.tables import (
    CATEGORICAL, COLUMNS, EPSILONS, MICRODATA, NUMERIC, SEED, WORKLOAD, keyed_microdata, microdata, prepared,
)
from tabveil.functions.keyed import key_of, uniform
from tabveil.operators import clean, codebook, features, split
from tabveil.session import scratch_folder, stage
from tabveil.sources.tables import (
    named, read_fact, read_microdata_csv, read_table, write_by_budget, write_coded, write_metrics, write_run_record,
)
from tabveil.spec import MicrodataSpec

PART = MicrodataSpec(
    columns=("size", "brand", "type"), numeric=("size",), categorical=("brand",), target="type",
    positive_label="SMALL",
)
TEST_SHARE = 0.2
BATCH = 250


def _planted_parts(spark: SparkSession, folder: str) -> DataFrame:
    parts = read_table(spark, folder, "part", ["p_partkey", "p_size", "p_brand", "p_type"])
    planted = (
        F.when(F.col("p_size") % 10 == 0, F.lit("?"))
        .when(F.col("p_size") % 10 == 1, F.concat(F.lit("  "), F.col("p_type"), F.lit(" ")))
        .when(F.col("p_size") % 10 == 2, F.lit(None).cast("string"))
        .otherwise(F.col("p_type"))
    )
    return named(parts.select("p_partkey", "p_size", "p_brand", planted), ["id", *PART.columns])


def clean_strip_missing(spark, folder):
    stripped = clean.strip_text(_planted_parts(spark, folder))
    return clean.drop_incomplete(stripped)


CLEAN_SQL = """
SELECT p_partkey AS id, p_size AS size, trim(p_brand) AS brand, trim(t) AS type FROM (
  SELECT *, CASE WHEN p_size % 10 = 0 THEN '?' WHEN p_size % 10 = 1 THEN '  ' || p_type || ' '
                 WHEN p_size % 10 = 2 THEN NULL ELSE p_type END AS t FROM part)
WHERE t IS NOT NULL AND trim(t) <> '?'"""


def label_normalise(spark, folder):
    orders = read_fact(spark, folder, "orders", ["o_orderkey", "o_orderstatus"])
    dotted = orders.select("o_orderkey", F.concat(
        F.col("o_orderstatus"), F.when(F.col("o_orderkey") % 2 == 0, ".").otherwise("")
    ).alias("status"))
    same = clean.normalise_labels(dotted, "status", [("O.", "O"), ("F.", "F"), ("P.", "P")])
    return same.withColumn("label", (F.col("status") == "O").cast("int"))


LABEL_SQL = """
SELECT o_orderkey, o_orderstatus AS status, CAST(o_orderstatus = 'O' AS INTEGER) AS label FROM orders"""


def target_flag(spark, folder):
    return clean.target_flag(microdata(spark, folder), MICRODATA).groupBy("target", "label").agg(
        F.count(F.lit(1)).alias("n")
    )


TARGET_SQL = f"""WITH {O.MICRODATA}
SELECT target, CAST(target = '>T' AS INTEGER) AS label, count(*) AS n FROM md GROUP BY ALL"""


def csv_scan(spark, folder):
    """The whole table written as CSV and read back with the declared schema."""
    path = f"{scratch_folder(spark)}/tabveil/csv-{uuid.uuid4().hex}"
    table = microdata(spark, folder)
    table.write.mode("overwrite").csv(path)
    return clean.clean(read_microdata_csv(spark, path, MICRODATA), MICRODATA)


CSV_SQL = f"WITH {O.MICRODATA} SELECT * FROM md"


def row_key(spark, folder):
    return keyed_microdata(spark, folder).select("row_key", "target")


ROW_KEY_SQL = f"WITH {O.MICRODATA}, {O.KEYED} SELECT row_key, target FROM kd"


def quantile_edges(spark, folder):
    raw = stage(microdata(spark, folder).select(*COLUMNS), "microdata")
    book = codebook.fit_codebook(raw, MICRODATA)
    table = book.table(spark).filter(F.col("attr").isin(*NUMERIC))
    return table.select(
        "attr", "code", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi")
    )


def _edges_sql(columns: str) -> str:
    body = " UNION ALL ".join(
        f"SELECT '{c}' AS attr, i - 1 AS code, "
        f"CASE WHEN len(e_{c}) > 2 AND i = 1 THEN '-inf'::DOUBLE ELSE e_{c}[i] END AS lo, "
        f"CASE WHEN len(e_{c}) > 2 AND i = len(e_{c}) - 1 THEN 'inf'::DOUBLE ELSE e_{c}[i + 1] END AS hi "
        f"FROM (SELECT *, unnest(range(1, len(e_{c}))) AS i FROM book)"
        for c in NUMERIC
    )
    return f"WITH {O.MICRODATA}, {O.edge_list()} SELECT {columns} FROM ({body})"


EDGES_SQL = _edges_sql("attr, code::INTEGER AS code, round(lo, 6) AS lo, round(hi, 6) AS hi")


def interval_labels(spark, folder):
    raw = stage(microdata(spark, folder), "microdata")
    table = codebook.fit_codebook(raw, MICRODATA).table(spark)
    return table.filter(F.col("attr").isin(*NUMERIC)).select("attr", "code", "label")


def _text_sql(x: str) -> str:
    return (
        f"CASE WHEN isinf({x}) THEN CASE WHEN {x} < 0 THEN '-inf' ELSE 'inf' END "
        f"WHEN abs({x} - round({x})) < 1e-9 THEN CAST(CAST(round({x}) AS BIGINT) AS VARCHAR) "
        f"ELSE printf('%.2f', {x}) END"
    )


LABELS_SQL = _edges_sql(
    f"attr, code::INTEGER AS code, '(' || {_text_sql('lo')} || ', ' || {_text_sql('hi')} || ']' AS label"
)


def bin_codes(spark, folder):
    raw = stage(keyed_microdata(spark, folder), "microdata")
    book = codebook.fit_codebook(raw, MICRODATA)
    return raw.select("row_key", *[
        codebook.bin_code(F.col(c), book.edges[c]).alias(c) for c in NUMERIC
    ])


def vocab_codes(spark, folder):
    counts = codebook.vocabulary_counts(microdata(spark, folder), MICRODATA.vocabulary_columns)
    return codebook.vocabulary_codes(stage(counts, "vocabulary")).select("attr", "code", "label")


VOCAB_SQL = f"WITH {O.MICRODATA}, {O.edge_list()} " + " UNION ALL ".join(
    f"SELECT '{c}' AS attr, (i - 1)::INTEGER AS code, coalesce(v_{c}[i], '<UNK>') AS label "
    f"FROM (SELECT v_{c}, unnest(range(1, len(v_{c}) + 2)) AS i FROM book)"
    for c in O.VOCAB
)


def encode_table(spark, folder):
    return prepared(spark, folder, keyed=True).coded


def decode_table(spark, folder):
    p = prepared(spark, folder, keyed=True)
    shifted = p.coded.withColumn("l_returnflag", F.col("l_returnflag") + 1)
    return codebook.decode(shifted, p.book, keep=["row_key"])


def _label_of(c: str, code: str) -> str:
    if c in NUMERIC:
        lo = f"CASE WHEN {code} = 0 AND len(e_{c}) > 2 THEN '-inf'::DOUBLE ELSE e_{c}[{code} + 1] END"
        hi = f"CASE WHEN {code} = len(e_{c}) - 2 AND len(e_{c}) > 2 THEN 'inf'::DOUBLE ELSE e_{c}[{code} + 2] END"
        return f"'(' || {_text_sql(f'({lo})')} || ', ' || {_text_sql(f'({hi})')} || ']'"
    return f"CASE WHEN {code} = len(v_{c}) THEN '<UNK>' ELSE v_{c}[{code} + 1] END"


DECODE_SQL = O.base(keyed=True) + " SELECT row_key, " + ", ".join(
    f"{_label_of(c, f'(cd.{c} + 1)' if c == 'l_returnflag' else f'cd.{c}')} AS {c}" for c in COLUMNS
) + " FROM cd, book"


def domain_sizes(spark, folder):
    p = prepared(spark, folder)
    declared = p.book.table(spark).groupBy("attr", "pos").agg(F.count(F.lit(1)).alias("declared"))
    observed = codebook.observed_domain(p.coded, COLUMNS).select("attr", F.col("size").alias("observed"))
    return declared.join(observed, "attr")


DOMAIN_SQL = O.base() + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS attr, {i} AS pos, z_{c} AS declared, (SELECT max({c}) + 1 FROM cd)::BIGINT AS observed FROM dom"
    for i, c in enumerate(COLUMNS)
)


def clip_codes(spark, folder):
    """Codes pushed out of range, rounded and clipped back, and the target forced to 0/1."""
    p = prepared(spark, folder, keyed=True)
    pushed = p.coded.select("row_key", *[
        (F.col(c) * F.lit(1.5) - 1).alias(c) for c in COLUMNS
    ])
    fixed = codebook.clip_to_domain(pushed, p.sizes, rounded=True)
    return codebook.force_binary(fixed, "target")


CLIP_SQL = O.base(keyed=True) + " SELECT row_key, " + ", ".join(
    f"least(greatest(round_even({c} * 1.5::DOUBLE - 1, 0), 0), z_{c} - 1)::INTEGER AS {c}"
    for c in COLUMNS[:-1]
) + ", CASE WHEN least(greatest(round_even(target * 1.5::DOUBLE - 1, 0), 0), z_target - 1) = 1 " \
    "THEN 1 ELSE 0 END::INTEGER AS target FROM cd, dom"


def standardise(spark, folder):
    raw = stage(keyed_microdata(spark, folder), "microdata")
    scaling = features.fit_scaling(raw, NUMERIC)
    scaled = features.standardised(raw, scaling)
    return scaled.select("row_key", *[F.round(c, 6).alias(c) for c in NUMERIC])


STANDARD_SQL = f"WITH {O.MICRODATA}, {O.KEYED} SELECT row_key, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 "
    f"ELSE stddev_pop({c}) OVER () END, 6) AS {c}" for c in NUMERIC
) + " FROM kd"


def one_hot_width(spark, folder):
    """Columns of the assembled feature vector, and how many ones each row has."""
    p = prepared(spark, folder)
    model = features.fit_one_hot(p.coded, MICRODATA.features)
    vectors = model.transform(p.coded)
    return vectors.select(
        features.vector_width(F.col("features")).alias("width"),
        features.vector_filled(F.col("features")).alias("ones"),
    ).groupBy("width", "ones").agg(F.count(F.lit(1)).alias("n"))


# One slot per observed code and feature.
ONE_HOT_SQL = O.base() + " SELECT (" + " + ".join(
    f"(SELECT max({c}) + 1 FROM cd)" for c in COLUMNS[:-1]
) + f")::INTEGER AS width, {len(COLUMNS) - 1} AS ones, count(*) AS n FROM cd"


def stratified_split(spark, folder):
    keyed = stage(keyed_microdata(spark, folder).select("row_key", "target"), "keyed")
    return split.stratified_split(keyed, "target", "row_key", TEST_SHARE, SEED)


SPLIT_SQL = f"""WITH {O.MICRODATA}, {O.KEYED},
cl AS (SELECT target, count(*) AS n, sum(count(*)) OVER () AS t FROM kd GROUP BY target),
ex AS (SELECT *, ceil(t * {TEST_SHARE}::DOUBLE) AS w, n * ceil(t * {TEST_SHARE}::DOUBLE) / t AS x FROM cl),
qt AS (SELECT target, floor(x) + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, target)
       <= w - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS quota FROM ex)
SELECT row_key, target, row_number() OVER (PARTITION BY target
  ORDER BY {O.uniform(O.key(f"'{SEED}'", "'split'", "row_key"))}, row_key) <= quota AS is_test
FROM kd JOIN qt USING (target)"""


def resample_down(spark, folder):
    keyed = stage(keyed_microdata(spark, folder).select("row_key"), "keyed")
    have = keyed.count()
    return split.resample(keyed, "row_key", have, have // 3, SEED)


DOWN_SQL = f"""WITH {O.MICRODATA}, {O.KEYED}
SELECT row_key, r - 1 AS row_id FROM (SELECT row_key, row_number() OVER (
  ORDER BY {O.uniform(O.key(f"'{SEED}'", "'resample'", "row_key"))}, row_key) AS r FROM kd)
WHERE r <= (SELECT count(*) // 3 FROM kd)"""


def resample_up(spark, folder):
    keyed = stage(keyed_microdata(spark, folder).select("row_key"), "keyed")
    have = keyed.count()
    return split.resample(keyed, "row_key", have, have + have // 2, SEED)


UP_SQL = f"""WITH {O.MICRODATA}, {O.KEYED},
nm AS (SELECT row_key, row_number() OVER (
  ORDER BY {O.uniform(O.key(f"'{SEED}'", "'resample'", "row_key"))}, row_key) - 1 AS number FROM kd),
dr AS (SELECT row_id, floor({O.uniform(O.key(f"'{SEED}'", "'draw'", "row_id"))} * (SELECT count(*) FROM kd)) AS number
  FROM (SELECT unnest(range((SELECT count(*) + count(*) // 2 FROM kd))) AS row_id))
SELECT row_id, row_key FROM dr JOIN nm USING (number)"""


def batches_drop_last(spark, folder):
    keyed = stage(keyed_microdata(spark, folder).select("row_key"), "keyed")
    return split.fixed_batches(keyed, "row_key", keyed.count(), BATCH, SEED)


def batches_keep_last(spark, folder):
    keyed = stage(keyed_microdata(spark, folder).select("row_key"), "keyed")
    return split.fixed_batches(keyed, "row_key", keyed.count(), BATCH, SEED, drop_last=False)


BATCH_SQL = f"""WITH {O.MICRODATA}, {O.KEYED}
SELECT row_key, r // {BATCH} AS batch, r % {BATCH} AS place FROM (SELECT row_key, row_number() OVER (
  ORDER BY {O.uniform(O.key(f"'{SEED}'", "'batch'", "0", "row_key"))}, row_key) - 1 AS r FROM kd)
WHERE r // {BATCH} < (SELECT count(*) // {BATCH} FROM kd)"""


KEEP_LAST_SQL = f"""WITH {O.MICRODATA}, {O.KEYED}
SELECT row_key, r // {BATCH} AS batch, r % {BATCH} AS place FROM (SELECT row_key, row_number() OVER (
  ORDER BY {O.uniform(O.key(f"'{SEED}'", "'batch'", "0", "row_key"))}, row_key) - 1 AS r FROM kd)"""


def poisson_batch(spark, folder):
    keyed = keyed_microdata(spark, folder).select("row_key", "target")
    return split.poisson_batch(keyed, "row_key", 0.05, SEED, step=3)


POISSON_SQL = f"""WITH {O.MICRODATA}, {O.KEYED}
SELECT row_key, target FROM kd WHERE {O.uniform(O.key(f"'{SEED}'", "'poisson'", "3", "row_key"))} < 0.05::DOUBLE"""


def keyed_draws(spark, folder):
    """The random streams themselves, one draw per order."""
    orders = read_fact(spark, folder, "orders", ["o_orderkey"])
    k = key_of(SEED, "stream", F.col("o_orderkey"))
    return orders.select(
        "o_orderkey", F.round(uniform(k), 9).alias("u0"), F.round(uniform(k, 1), 9).alias("u1")
    )


DRAWS_SQL = f"""SELECT o_orderkey, round({O.uniform(O.key(f"'{SEED}'", "'stream'", "o_orderkey"))}, 9) AS u0,
round({O.uniform(O.key(f"'{SEED}'", "'stream'", "o_orderkey"), 1)}, 9) AS u1 FROM orders"""


def sinks(spark, folder):
    """What each writer wrote, as its files say: coded tables in two formats, tables by budget, metrics, the run record."""
    base = f"{scratch_folder(spark)}/tabveil/sinks-{uuid.uuid4().hex}"
    p = prepared(spark, folder)
    coded = stage(p.coded, "coded")
    write_coded(coded, f"{base}/parquet")
    write_coded(coded, f"{base}/csv", "csv")
    kinds = ", ".join(f"{c} int" for c in coded.columns)
    total = sum((F.col(c) for c in COLUMNS), F.lit(0)).cast("long")
    parts = [
        df.groupBy(F.lit(sink).alias("sink"), F.col("target").cast("string").alias("part")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(total).alias("total")
        ) for sink, df in (
            ("coded parquet", spark.read.parquet(f"{base}/parquet")),
            ("coded csv", spark.read.schema(kinds).option("header", True).csv(f"{base}/csv")),
        )
    ]
    by_budget = coded.withColumn("epsilon", F.element_at(F.array(*[F.lit(e) for e in EPSILONS]), F.col("l_quantity") % len(EPSILONS) + 1))
    write_by_budget(by_budget, f"{base}/budgets")
    parts.append(spark.read.parquet(f"{base}/budgets").groupBy(
        F.lit("by budget").alias("sink"), F.col("epsilon").cast("string").alias("part")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(total).alias("total")))
    write_metrics(coded.groupBy("r_name").agg(F.count(F.lit(1)).alias("rows"), F.sum("l_tax").alias("tax")), f"{base}/metrics")
    metrics = spark.read.schema("r_name string, rows long, tax long").option("header", True).csv(f"{base}/metrics")
    parts.append(metrics.select(F.lit("metrics").alias("sink"), F.col("r_name").alias("part"), F.col("rows").alias("n"), F.col("tax").alias("total")))
    write_run_record(spark, f"{base}/run", workload=[m.attrs for m in WORKLOAD], epsilons=EPSILONS, n_bins=8, rows=coded.count())
    record = spark.read.json(f"{base}/run")
    parts.append(record.select(
        F.lit("run record").alias("sink"), F.element_at(F.element_at("workload", -1), -1).alias("part"),
        F.size("workload").cast("long").alias("n"), F.col("rows").alias("total"),
    ))
    return reduce(DataFrame.unionByName, parts)


_CODES = " + ".join(COLUMNS)
SINKS_SQL = O.base() + "".join(
    f" {'UNION ALL' if i else ''} SELECT '{sink}' AS sink, target::VARCHAR AS part, count(*) AS n, sum({_CODES})::BIGINT AS total FROM cd GROUP BY target"
    for i, sink in enumerate(("coded parquet", "coded csv"))
) + f""" UNION ALL SELECT 'by budget', list_extract({list(EPSILONS)}::DOUBLE[], l_quantity % {len(EPSILONS)} + 1)::VARCHAR, count(*), sum({_CODES})::BIGINT FROM cd GROUP BY ALL
UNION ALL SELECT 'metrics', r_name::VARCHAR, count(*), sum(l_tax)::BIGINT FROM cd GROUP BY ALL
UNION ALL SELECT 'run record', '{WORKLOAD[-1].attrs[-1]}', {len(WORKLOAD)}, count(*) FROM cd"""


QUERIES = {
    "sinks": (sinks, SINKS_SQL),
    "clean_strip_missing": (clean_strip_missing, CLEAN_SQL),
    "label_normalise": (label_normalise, LABEL_SQL),
    "target_flag": (target_flag, TARGET_SQL),
    "csv_scan": (csv_scan, CSV_SQL),
    "row_key": (row_key, ROW_KEY_SQL),
    "quantile_edges": (quantile_edges, EDGES_SQL),
    "interval_labels": (interval_labels, LABELS_SQL),
    "bin_codes": (bin_codes, O.base(keyed=True) + f" SELECT row_key, {', '.join(NUMERIC)} FROM cd"),
    "vocab_codes": (vocab_codes, VOCAB_SQL),
    "encode_table": (encode_table, O.base(keyed=True) + " SELECT * FROM cd"),
    "decode_table": (decode_table, DECODE_SQL),
    "domain_sizes": (domain_sizes, DOMAIN_SQL),
    "clip_codes": (clip_codes, CLIP_SQL),
    "standardise": (standardise, STANDARD_SQL),
    "one_hot_width": (one_hot_width, ONE_HOT_SQL),
    "stratified_split": (stratified_split, SPLIT_SQL),
    "resample_down": (resample_down, DOWN_SQL),
    "resample_up": (resample_up, UP_SQL),
    "batches_drop_last": (batches_drop_last, BATCH_SQL),
    "batches_keep_last": (batches_keep_last, KEEP_LAST_SQL),
    "poisson_batch": (poisson_batch, POISSON_SQL),
    "keyed_draws": (keyed_draws, DRAWS_SQL),
}
