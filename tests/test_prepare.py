import math

import pytest
from pyspark.sql import functions as F

from outcomekit.operators import features, ranking
from outcomekit.operators import split as split_module
from outcomekit.operators.split import HashSplit, tail_split


def labeled(spark, n=2_000):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 10 < 3).cast("int").alias("y"))


@pytest.mark.parametrize("fractions", [{"test": 0.2}, {"test": 0.15, "validation": 0.15}, {"a": 0.5, "b": 0.4, "c": 0.3}])
def test_split_sizes_per_class(spark, fractions):
    df = labeled(spark, 997)
    out = HashSplit.fit(df, "k", fractions, "y").transform(df)
    for y in (0, 1):
        n = df.where(F.col("y") == y).count()
        left = n
        for part, f in fractions.items():
            want = min(left, math.floor(n * f + 0.5))
            assert out.where((F.col("y") == y) & (F.col("split") == part)).count() == want
            left -= want
    assert out.count() == 997


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_split_does_not_depend_on_partitions(spark, partitions):
    df = labeled(spark)
    first = HashSplit.fit(df, "k", {"test": 0.2}, "y").transform(df)
    again = df.repartition(partitions, "y")
    again = HashSplit.fit(again, "k", {"test": 0.2}, "y").transform(again)
    assert first.exceptAll(again).count() == 0


def test_split_handles_null_strata_and_tiny_classes(spark):
    df = spark.createDataFrame([(i, None if i < 10 else ("a" if i < 11 else "b")) for i in range(100)], "k int, y string")
    out = HashSplit.fit(df, "k", {"test": 0.2}, "y").transform(df)
    got = {(r.y, r.split): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert got == {(None, "test"): 2, (None, "train"): 8, ("a", "train"): 1, ("b", "test"): 18, ("b", "train"): 71}


def test_split_refines_full_buckets(spark, monkeypatch):
    df = labeled(spark, 3_000)
    first = HashSplit.fit(df, "k", {"test": 0.2, "validation": 0.15}, "y")
    for bits, rows in ((2, 30), (1, 1), (5, 4)):
        monkeypatch.setattr(split_module, "STEP_BITS", bits)
        monkeypatch.setattr(split_module, "RANKED_ROWS", rows)
        again = HashSplit.fit(df, "k", {"test": 0.2, "validation": 0.15}, "y")
        assert sorted(again.cuts, key=str) == sorted(first.cuts, key=str)


def test_split_of_many_strata(spark):
    df = spark.range(6_000).select(F.col("id").alias("k"), (F.col("id") % 60).cast("string").alias("y"))
    split = HashSplit.fit(df, "k", {"test": 0.25, "validation": 0.1}, "y")
    out = split.transform(df)
    assert out.columns == ["k", "y", "split"] and len(split.strata) == 60
    got = {(r.y, r.split): r["count"] for r in out.groupBy("y", "split").count().collect()}
    want = {"test": 25, "validation": 10, "train": 65}
    assert got == {(str(y), s): n for y in range(60) for s, n in want.items()}
    new = spark.createDataFrame([(1, "unknown")], "k bigint, y string")
    assert split.transform(new).first().split == "train"


def test_split_needs_no_shuffle_to_apply(spark):
    df = labeled(spark)
    plan = HashSplit.fit(df, "k", {"test": 0.2}, "y").transform(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_split_of_nothing(spark):
    df = labeled(spark, 0)
    assert HashSplit.fit(df, "k", {"test": 0.2}, "y").transform(df).count() == 0


def test_tail_split_takes_the_last_rows(spark):
    df = spark.range(0, 1_001).select((F.col("id") * 7).alias("k")).repartition(9)
    out = tail_split(df, "k", 0.1)
    tail = [r.k for r in out.where(F.col("split") == "validation").collect()]
    assert len(tail) == 1_001 - math.floor(1_001 * 0.9) and min(tail) == 7 * math.floor(1_001 * 0.9)
    assert tail_split(df, "k", 0.0).where(F.col("split") == "validation").count() == 0


@pytest.mark.parametrize("bucket_rows", [10_000, 37, 1])
def test_rank_is_dense_in_any_bucket_size(spark, bucket_rows):
    from outcomekit.functions import draw

    df = spark.range(500).withColumn("u", draw("id", 1, "t")).repartition(6)
    got = ranking.with_rank(df, "u", "id", 500, bucket_rows=bucket_rows).orderBy("u", "id").collect()
    assert [r["rank"] for r in got] == list(range(500))


def test_one_hot_drops_the_first_level(spark):
    df = spark.createDataFrame([(1, "Month"), (2, "One"), (3, "Two"), (4, None)], "k int, c string")
    enc = features.OneHot.fit(df, ["c"])
    assert enc.output_columns() == ["c_One", "c_Two"]
    new = spark.createDataFrame([(1, "Month"), (2, "One"), (3, "Two"), (4, None), (5, "Three")], "k int, c string")
    got = [tuple(r) for r in enc.transform(new).orderBy("k").collect()]
    assert got == [(1, 0.0, 0.0), (2, 1.0, 0.0), (3, 0.0, 1.0), (4, 0.0, 0.0), (5, 0.0, 0.0)]


def test_one_hot_vector_is_the_same_encoding(spark):
    df = spark.createDataFrame([(1, "Month", "x"), (2, "One", "x"), (3, "Two", "x"), (4, None, None)], "k int, c string, d string")
    enc = features.OneHotVector.fit(df, ["c", "d"])
    new = spark.createDataFrame([(1, "Month", "x"), (2, "One", "y"), (3, "Two", None), (4, None, "x"), (5, "Three", "x")], "k int, c string, d string")
    got = [(r.k, r.c_onehot.toArray().tolist(), r.d_onehot.size) for r in enc.transform(new).orderBy("k").collect()]
    zero = [0.0, 0.0]
    assert got == [(1, zero, 0), (2, [1.0, 0.0], 0), (3, [0.0, 1.0], 0), (4, zero, 0), (5, zero, 0)]
    assert enc.names("c") == ["c_One", "c_Two"] and enc.names("d") == []


def test_too_many_levels_are_refused(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="levels"):
        features.OneHot.fit(df, ["c"], max_levels=20)


def test_auto_encode_picks_by_domain(spark):
    rows = [("Yes", "Male", "x", None), ("No", "Female", "y", None), (None, None, "z", None)]
    df = spark.createDataFrame(rows, "a string, g string, c string, e string")
    out = features.AutoEncode.fit(df, ["a", "g", "c", "e"]).transform(df)
    assert out.columns == ["a", "g", "e", "c_y", "c_z"]
    assert [tuple(r) for r in out.collect()] == [(1, 1, None, 0.0, 0.0), (0, 0, None, 1.0, 0.0), (None, None, None, 0.0, 1.0)]


def test_standardize_uses_population_spread_and_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    got = features.Standardize.fit(df, ["x", "c"]).transform(df).orderBy("x").collect()
    assert [tuple(r) for r in got] == [(-1.0, 0.0), (1.0, 0.0)]


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    assert features.ClassWeights.fit(df, "y").weights == {0: 8 / 12, 1: 8 / 4}


def test_assemble_keeps_names(spark):
    df = spark.createDataFrame([(7, 1, 2.0, 3.0)], "k int, label int, `a.b` double, c double")
    names = features.feature_columns(df, "label", ["k"])
    out = features.assemble(df, names, keep=["k", "label"])
    assert out.first().features.toArray().tolist() == [2.0, 3.0]
    attrs = out.schema["features"].metadata["ml_attr"]["attrs"]["numeric"]
    assert [a["name"] for a in attrs] == ["a.b", "c"]
