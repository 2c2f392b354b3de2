"""Sources, clean-up, keys, splits and coding."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabveil.operators import clean, codebook, quantiles, ranks, split
from tabveil.session import stage
from tabveil.sources import tables
from tabveil.spec import CENSUS, MicrodataSpec


@pytest.fixture(scope="module")
def census(spark, census_csv):
    return clean.clean(tables.read_microdata_csv(spark, census_csv, CENSUS), CENSUS)


def test_csv_is_trimmed_and_completed(census):
    assert census.count() == 10
    assert {r[0] for r in census.select("income").distinct().collect()} == {"<=50K", ">50K"}
    assert census.filter(F.col("workclass") != F.trim("workclass")).count() == 0


def test_header_line_is_an_option(spark, tmp_path, census_csv):
    path = tmp_path / "headed.csv"
    path.write_text(",".join(CENSUS.columns) + "\n" + open(census_csv).read())
    headed = clean.clean(tables.read_microdata_csv(spark, str(path), CENSUS, header=True), CENSUS)
    assert headed.count() == 10


def test_wrong_width_is_an_error(spark, tmp_path):
    path = tmp_path / "narrow.csv"
    path.write_text("1,2,3\n")
    with pytest.raises(Exception):
        tables.read_microdata_csv(spark, str(path), CENSUS).collect()
    with pytest.raises(ValueError):
        tables.named(spark.range(3), ["a", "b"])


def test_nulls_and_markers_are_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "?"), (3.0, None), (None, "b")], "x double, t string")
    assert [r["x"] for r in clean.drop_incomplete(df).collect()] == [1.0]


def test_row_keys_are_unique_for_copies(spark):
    df = spark.range(20_000).select(F.when(F.col("id") < 12_000, 7).otherwise(F.col("id")).alias("a"))
    keyed = clean.with_row_key(df, ["a"])
    again = clean.with_row_key(df.repartition(7), ["a"])
    assert keyed.select("row_key").distinct().count() == 20_000
    assert keyed.filter("a = 7").count() == 12_000
    assert keyed.exceptAll(again).count() == 0


def test_expand_ranges_covers_long_and_short(spark):
    df = spark.createDataFrame([(0, 3), (3, 3), (10, 20_000)], "low long, high long")
    got = sorted(r["k"] for r in ranks.expand_ranges(df, F.col("low"), F.col("high"), "k").collect())
    assert got == [0, 1, 2, *range(10, 20_000)]


@pytest.mark.parametrize("bins, ranked", [(1024, 1_000_000), (16, 50), (4, 1)])
def test_quantiles_equal_pandas(spark, bins, ranked):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({
        "x": rng.normal(size=3000) * 1e6, "z": rng.integers(-3, 3, 3000).astype(float),
        "hot": np.where(rng.random(3000) < 0.8, 0.0, rng.random(3000)), "one": 5.0,
    })
    df = stage(spark.createDataFrame(pdf), "q")
    probs = [i / 8 for i in range(9)]
    got = quantiles.exact_quantiles(df, list(pdf), probs, bins, ranked)
    for c in pdf:
        assert np.allclose(got[c], pdf[c].quantile(probs), rtol=1e-12, atol=0)


def test_positions_keep_order():
    values = np.array([-math.inf, -1e300, -2.5, -1e-300, 0.0, 1e-300, 1.0, 1e300, math.inf])
    p = quantiles.positions(values)
    assert list(p) == sorted(p)
    assert [quantiles.number_at(int(x)) for x in p] == list(values)


def test_bin_edges_and_labels():
    assert codebook.bin_edges([4, 4, 4]) == [3.5, 4.5]
    assert codebook.bin_edges([0, 0, 9]) == [0, 9]
    assert codebook.bin_edges([1, 2, 3, 4]) == [-math.inf, 2, 3, math.inf]
    assert codebook.interval_label(-math.inf, 2.0) == "(-inf, 2]"
    assert codebook.interval_label(2.126, math.inf) == "(2.13, inf]"


def test_bins_are_right_closed_and_missing_is_zero(spark):
    df = spark.createDataFrame(
        [(0, 1.0), (1, 2.0), (2, 2.1), (3, 99.0), (4, None), (5, float("nan"))], "i int, x double"
    )
    coded = df.withColumn("c", codebook.bin_code(F.col("x"), [-math.inf, 2.0, 3.0, math.inf]))
    assert [r["c"] for r in coded.orderBy("i").collect()] == [0, 0, 1, 2, 0, 0]
    single = df.withColumn("c", codebook.bin_code(F.col("x"), [0.0, 2.0]))
    assert {r["c"] for r in single.collect()} == {0}


SPEC = MicrodataSpec(("x", "c", "t"), ("x",), ("c",), "t", "yes")


def test_unseen_values_take_the_unknown_code_and_decode(spark):
    train = spark.createDataFrame([(1.0, "b", "no"), (2.0, "a", "yes"), (3.0, "a", "no")], "x double, c string, t string")
    book = codebook.fit_codebook(train, SPEC, 2)
    assert book.labels == {"c": ["a", "b", "<UNK>"], "t": ["no", "yes", "<UNK>"]}
    test = spark.createDataFrame([(9.0, "zzz", "yes")], train.schema)
    coded = codebook.encode(test, book)
    assert tuple(coded.first()) == (1, 2, 1)
    assert codebook.decode(coded, book).first()["c"] == "<UNK>"
    assert codebook.decode(coded.withColumn("c", F.lit(77)), book).first()["c"] is None


def test_large_vocabularies_stay_a_table(spark, monkeypatch):
    rows = [(float(i), f"v{i % 90:02d}", "yes" if i % 3 else "no") for i in range(300)]
    train = spark.createDataFrame(rows, "x double, c string, t string")
    small = codebook.fit_codebook(train, SPEC)
    expected = codebook.encode(train, small)
    monkeypatch.setattr(codebook, "KEPT_LABELS", 10)
    large = codebook.fit_codebook(train, SPEC)
    assert large.vocabulary is not None and large.sizes == small.sizes
    assert codebook.encode(train, large).exceptAll(expected).count() == 0
    assert codebook.decode(expected, large).exceptAll(codebook.decode(expected, small)).count() == 0
    monkeypatch.setattr("tabveil.session.BROADCAST_ROWS", 0)
    assert codebook.encode(train, large).exceptAll(expected).count() == 0
    monkeypatch.setattr(codebook, "LARGEST_DOMAIN", 50)
    with pytest.raises(ValueError):
        codebook.fit_codebook(train, SPEC)


def _keyed(spark, n, hot=0.4):
    df = spark.range(n).select(
        F.concat(F.lit("k"), F.col("id")).alias("row_key"),
        F.when(F.col("id") < n * hot, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 3)).alias("t"),
    )
    return stage(df, "keyed")


def test_split_sizes_and_independence_from_layout(spark):
    df = _keyed(spark, 5003)
    done = split.stratified_split(df, "t", "row_key", 0.2, "s")
    assert done.count() == 5003
    assert done.filter("is_test").count() == math.ceil(0.2 * 5003)
    shares = done.groupBy("t").agg(F.avg(F.col("is_test").cast("int")).alias("s")).collect()
    assert all(abs(r["s"] - 0.2) < 0.002 for r in shares)
    other = split.stratified_split(stage(df.repartition(9), "keyed"), "t", "row_key", 0.2, "s")
    assert done.exceptAll(other).count() == 0


def test_ranks_are_exact_over_many_buckets(spark, monkeypatch):
    df = _keyed(spark, 3000).withColumn("u", F.rand(3))
    df = stage(df, "ranked")
    single = ranks.rank_rows(df, ["t"], "u", "row_key", 3000)
    monkeypatch.setattr(ranks, "ROWS_PER_BUCKET", 50)
    many = ranks.rank_rows(df, ["t"], "u", "row_key", 3000)
    assert single.select("row_key", "rank").exceptAll(many.select("row_key", "rank")).count() == 0


def test_resample_gives_the_wanted_size(spark):
    df = _keyed(spark, 500)
    for want in (100, 500, 1300):
        got = split.resample(df, "row_key", 500, want, "s")
        assert got.count() == want
        assert sorted(r["row_id"] for r in got.collect()) == list(range(want))
    assert split.resample(df, "row_key", 500, 100, "s").select("row_key").distinct().count() == 100


def test_batches_are_full(spark):
    got = split.fixed_batches(_keyed(spark, 1003), "row_key", 1003, 100, "s")
    assert {r["count"] for r in got.groupBy("batch").count().collect()} == {100}
    assert got.count() == 1000


def test_run_record_and_budget_folders(spark, tmp_path):
    tables.write_run_record(
        spark, str(tmp_path / "run"), workload=[("a",), ("a", "b")], delta=1e-5, n_bins=8, name="x"
    )
    back = spark.read.json(str(tmp_path / "run")).first()
    assert [list(w) for w in back["workload"]] == [["a"], ["a", "b"]] and back["n_bins"] == 8
    df = spark.createDataFrame([(0.5, 1), (1.0, 2)], "epsilon double, a int")
    tables.write_by_budget(df, str(tmp_path / "synth"))
    assert spark.read.parquet(str(tmp_path / "synth")).count() == 2
    tables.write_metrics(df, str(tmp_path / "metrics"))
    tables.write_coded(df, str(tmp_path / "coded"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "coded")).columns == ["epsilon", "a"]


def test_row_keys_differ_with_separators_and_nulls(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), ("a", "n"), ("1:a", ""), ("a", None)]
    keyed = clean.with_row_key(spark.createDataFrame(rows, "x string, y string"), ["x", "y"])
    assert keyed.select("row_key").distinct().count() == len(rows)
