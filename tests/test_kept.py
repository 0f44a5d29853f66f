"""Stored states against figures of the whole table."""

import numpy as np
import pytest

from outcomekit.operators import evaluate, kept


def rows_of(spark, values, period="d1", group="a"):
    return spark.createDataFrame([(group, period, v) for v in values], "g string, day string, x double")


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(5)
    values = rng.lognormal(size=30_000)
    rows = [("ab"[i % 3 == 0], f"d{i % 17}", float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "g string, day string, x double"), rows


def test_merged_quantiles_are_within_the_stated_rank_error(numbers):
    df, rows = numbers
    shares = [0.01, 0.25, 0.5, 0.9, 0.99]
    states = kept.number_states(df, "x", ["g"], "day")
    assert states.count() == 34
    for r in kept.merged_numbers(states, ["g"], shares).collect():
        values = np.sort([x for g, _, x in rows if g == r.g])
        assert r.n == len(values) and np.isclose(r["mean"], values.mean())
        assert (r.low, r.high) == (values[0], values[-1])
        for share, q in zip(shares, r.quantiles, strict=True):
            low, high = np.searchsorted(values, [q], "left")[0], np.searchsorted(values, [q], "right")[0]
            assert low / len(values) - kept.RANK_ERROR <= share <= high / len(values) + kept.RANK_ERROR


def test_a_period_written_again_is_replaced(spark, tmp_path):
    path = str(tmp_path / "states")
    first = kept.number_states(rows_of(spark, [1.0, 2.0]), "x", ["g"], "day")
    kept.save_states(first, path)
    kept.save_states(kept.number_states(rows_of(spark, [5.0], "d2"), "x", ["g"], "day"), path)
    kept.save_states(kept.number_states(rows_of(spark, [1.0, 2.0, 9.0]), "x", ["g"], "day"), path)
    states = kept.load_states(spark, path, first.schema)
    assert [(r.n, r.high) for r in kept.merged_numbers(states, ["g"]).collect()] == [(4, 9.0)]
    only = kept.load_states(spark, path, first.schema, ["d2"])
    assert kept.merged_numbers(only).first().quantiles == [5.0]
    plan = only._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_grid_merges_exactly_and_counts_what_lies_outside(spark):
    values = [-1.0, 0.0, 0.5, 1.0, 3.99, 4.0, 4.01, None, float("nan")]
    df = rows_of(spark, values).union(rows_of(spark, [0.25, 9.0], "d2"))
    states = kept.grid_states(df, "x", ["g"], "day", 0.0, 4.0, 4)
    got = {r.cell: (r.lower, r.upper, r.n, r.density) for r in kept.merged_grid(states, 0.0, 4.0, 4, ["g"]).collect()}
    assert got == {
        kept.BELOW: (None, 0.0, 1, None), 0: (0.0, 1.0, 3, 0.5), 1: (1.0, 2.0, 1, 1 / 6), 3: (3.0, 4.0, 2, 1 / 3),
        kept.ABOVE: (4.0, None, 2, None),
    }
    with pytest.raises(ValueError, match="low < high"):
        kept.grid_states(df, "x", ["g"], "day", 4.0, 4.0, 4)


def test_merged_auc_is_that_of_all_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(f"d{i % 5}", float(s), int(rng.random() < s)) for i, s in enumerate(rng.random(3_000))]
    df = spark.createDataFrame(rows, "day string, score double, label int")
    merged = kept.merged_auc(kept.score_states(df, [], "day")).first().grid_auc
    assert abs(merged - evaluate.grid_auc(df).first().grid_auc) < 1e-12


def test_null_groups_empty_tables_and_one_class(spark):
    df = spark.createDataFrame([(None, None, 1.0), (None, "d1", 3.0), ("a", "d1", None)], "g string, day string, x double")
    states = kept.number_states(df, "x", ["g"], "day")
    assert [(r.g, r.n, r["mean"]) for r in kept.merged_numbers(states, ["g"]).collect()] == [(None, 2, 2.0)]
    assert kept.merged_numbers(states.limit(0)).count() == 0
    one = spark.createDataFrame([("d1", 0.3, 1)], "day string, score double, label int")
    assert kept.merged_auc(kept.score_states(one, [], "day")).first().grid_auc is None
