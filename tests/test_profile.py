import numpy as np
import pytest

from outcomekit.operators import clean, profile, quantiles, topk


def test_medians_interpolate_and_pass_over_nulls(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (10.0, None), (None, None)], "x double, y double")
    assert quantiles.exact_medians(df, ["x", "y"]) == {"x": 2.5, "y": None}


@pytest.mark.parametrize("rows", [4_001, 10_000])
def test_medians_by_brackets_equal_numpy(spark, monkeypatch, rows):
    monkeypatch.setattr(quantiles, "BRACKET_VALUES", 40)
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 100)
    monkeypatch.setattr(quantiles, "BRACKET_SLACK", 0.02)
    rng = np.random.default_rng(7)
    even = rng.normal(size=rows)
    tied = rng.integers(0, 4, rows).astype(float)
    third = np.where(rng.random(rows) < 0.34, 0.0, rng.normal(size=rows))
    halves = np.where(np.arange(rows) % 2 == 0, -1.0, 1.0) * rng.integers(1, 3, rows)
    data = list(zip(even.tolist(), tied.tolist(), third.tolist(), halves.tolist()))
    df = spark.createDataFrame(data, "a double, b double, c double, d double").repartition(5)
    got = quantiles.exact_medians(df, ["a", "b", "c", "d"])
    want = {"a": np.median(even), "b": np.median(tied), "c": np.median(third), "d": np.median(halves)}
    assert got == want


def test_value_at_rank(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BRACKET_VALUES", 40)
    df = spark.range(0, 5_000).selectExpr("id * 3 AS k").repartition(7)
    for rank in (0, 1, 2_500, 4_998, 4_999):
        assert quantiles.value_at_rank(df, "k", rank, 5_000) == rank * 3


@pytest.mark.parametrize(
    "values",
    [
        [float(v) for v in range(73)] * 3,
        [5.0, 5.0, 5.0],
        list(np.random.default_rng(3).exponential(size=2_000)),
        [0.1 * i for i in range(301)],
        [-1e9, 0.0, 1e-9, 1e9],
    ],
)
def test_histogram_equals_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    got = profile.histogram(df, "x", 30).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=30)
    assert [r.n for r in got] == counts.tolist()
    assert [r.bin_lo for r in got] == pytest.approx(edges[:-1].tolist())
    assert got[-1].bin_hi == edges[-1]


def test_density_histogram_has_bins_per_group(spark):
    rows = [("a", float(i % 10)) for i in range(100)] + [("b", 100.0 + i) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = profile.histogram(df, "x", 30, by=["g"], density=True).orderBy("g", "bin").collect()
    for g in "ab":
        values = [x for k, x in rows if k == g]
        density, _ = np.histogram(values, bins=30, density=True)
        assert [r.density for r in got if r.g == g] == pytest.approx(density.tolist())


def test_groups_without_a_name_are_kept(spark):
    df = spark.createDataFrame([(None, 1.0, "a"), (None, 2.0, "b"), ("g", 5.0, "a")], "g string, x double, v string")
    shares = {(r.g, r.value): r.share for r in profile.value_shares(df, "v", ["g"]).collect()}
    assert shares == {(None, "a"): 0.5, (None, "b"): 0.5, ("g", "a"): 1.0}
    bins = profile.histogram(df, "x", 2, by=["g"]).orderBy("g", "bin").collect()
    assert [(r.g, r.n) for r in bins] == [(None, 1), (None, 1), ("g", 0), ("g", 1)]


def test_histogram_of_nothing_is_empty(spark):
    assert profile.histogram(spark.createDataFrame([], "x double"), "x").count() == 0


def test_dense_counts_fill_absent_classes(spark):
    df = spark.createDataFrame([(0,), (3,), (3,), (None,)], "y int")
    got = {r.label: r.n for r in profile.dense_class_counts(df, "y").collect()}
    assert got == {0: 1, 1: 0, 2: 0, 3: 2}


def test_null_counts_and_shapes(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "i int, x double, s string")
    assert {r.column: r.n_missing for r in profile.null_counts(df).collect()} == {"x": 2, "s": 1}
    assert profile.total_nulls(df).first().n_missing == 3
    assert tuple(profile.shape(df, "i").first()) == (2, 3, 2)
    listing = {r.column: (r.dtype, r.non_null) for r in profile.schema_listing(df).collect()}
    assert listing == {"i": ("int", 2), "x": ("double", 0), "s": ("string", 1)}


def test_value_shares_and_domains(spark):
    df = spark.createDataFrame([("Yes", "u"), ("No", "v"), ("No", None), (None, None)], "a string, b string")
    shares = {r.value: (r.n, r.share) for r in profile.value_shares(df, "a").collect()}
    assert shares == {"No": (2, pytest.approx(2 / 3)), "Yes": (1, pytest.approx(1 / 3))}
    tested = profile.domain_test(df, ["a", "b"], {"yes_no": ["Yes", "No"]})
    assert {r.column: r.yes_no for r in tested.collect()} == {"a": True, "b": False}


def test_matrix_moments_keep_small_spread_on_a_large_mean(spark):
    df = spark.createDataFrame([(1e9 + i, 1e9 - i) for i in range(4)], "a double, b double")
    row = profile.matrix_moments(df, ["a", "b"]).first()
    cells = np.array([[1e9 + i, 1e9 - i] for i in range(4)])
    assert (row.n_cells, row.mean) == (8, 1e9) and row["std"] == pytest.approx(cells.std(), rel=1e-9)


def test_vector_stats(spark):
    vectors = [[1.0, -2.0], [3.0, 2.0]]
    df = spark.createDataFrame([(v,) for v in vectors], "v array<float>")
    got = profile.vector_stats(df, "v").orderBy("pos").collect()
    assert [(r.mean, r["std"], r.mean_abs) for r in got] == [(2.0, 1.0, 2.0), (0.0, 2.0, 2.0)]


def test_median_fill_learns_from_the_rows_named(spark):
    df = spark.createDataFrame([(1.0, "train"), (3.0, "train"), (None, "train"), (99.0, "test"), (None, "test")], "x double, split string")
    filled = clean.MedianFill.fit(df, ["x"], df["split"] == "train").transform(df)
    assert sorted(r.x for r in filled.collect()) == [1.0, 2.0, 2.0, 3.0, 99.0]


def test_member_filter_by_list_and_by_table(spark):
    df = spark.range(0, 3_000).withColumnRenamed("id", "k")
    assert clean.member_filter(df, "k", [1, 2, 9_999]).count() == 2
    assert clean.member_filter(df, "k", list(range(1_500))).count() == 1_500
    assert clean.member_filter(df, "k", spark.range(10).union(spark.range(10))).count() == 10


# Published importances, 15 rows.
IMPORTANCES = [
    ("tenure", 0.17415777578419342),
    ("TotalCharges", 0.1288255055006415),
    ("Contract_Two year", 0.09711787317851735),
    ("MonthlyCharges", 0.09661604185275394),
    ("InternetService_Fiber optic", 0.07649305571362582),
    ("PaymentMethod_Electronic check", 0.0743256255241834),
    ("Contract_One year", 0.04112979488101289),
    ("PaperlessBilling_Yes", 0.03833671151597337),
    ("OnlineSecurity_Yes", 0.023524521209377564),
    ("TechSupport_Yes", 0.019890447780587853),
    ("DeviceProtection_No internet service", 0.01705549527361752),
    ("MultipleLines_Yes", 0.01602659079978924),
    ("StreamingTV_No internet service", 0.01527801390203126),
    ("gender_Male", 0.014800487119843851),
    ("Dependents_Yes", 0.013698238731952092),
]


def test_published_importances(spark):
    from outcomekit.functions import any_substring

    extra = [(f"minor_{i}", 0.001) for i in range(9)]
    df = spark.createDataFrame(IMPORTANCES[::-1] + extra, "feature string, importance double").repartition(4)
    top = topk.share_of_top(df, "feature", "importance", 3).first()
    assert top.head_total == pytest.approx(0.847276, abs=1e-6) and top.top_share == pytest.approx(0.472220, abs=1e-6)
    served = any_substring("feature", ["Internet", "Online", "Streaming", "Contract"])
    assert topk.top_k(df, "feature", "importance", 10).where(served).count() == 4
    person = any_substring("feature", ["gender", "Senior", "Partner", "Dependents"])
    assert topk.share_of_group(df, "feature", "importance", person).first().group_share == pytest.approx(0.033636, abs=1e-6)
    ranked = topk.numbered(df, "feature", "importance", 10).orderBy("position").collect()
    assert [r.feature for r in ranked] == [n for n, _ in IMPORTANCES[:10]]
    reverse = topk.top_k(df, "feature", "importance", 10, ascending_output=True).collect()
    assert [r.feature for r in reverse] == [n for n, _ in IMPORTANCES[:10]][::-1]
