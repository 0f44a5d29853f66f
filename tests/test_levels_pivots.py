"""Levels of wide columns, distinct counts, and neighbors in many dimensions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from outcomekit.operators import features, neighbors, pivots, profile
from outcomekit.operators.levels import LevelTable
from outcomekit.operators.neighbors import nearest_neighbors
from outcomekit.operators.resample import smote


def places(coded, vector):
    """Rows (id, place, size) of one-hot vectors; no place where the vector is zero."""
    parts = F.unwrap_udt(F.col(vector))
    return {r.id: (list(r.v.indices or []), r.v.size) for r in coded.select("id", parts.alias("v")).collect()}


@pytest.mark.parametrize("partitions", [1, 7])
def test_ranks_of_levels(spark, partitions):
    values = ["b", "a", None, "é", "Z", "b", "b", ""] * 40 + [f"x{i}" for i in range(900)]
    df = spark.createDataFrame([(i, v, v if i % 3 else None, i) for i, v in enumerate(values)], "id long, c string, `d.e` string, _rank long")
    table = LevelTable.fit(df.repartition(partitions), ["c", "d.e"])
    for column in ("c", "d.e"):
        levels = sorted({r[0] for r in df.select(f"`{column}`").collect()} - {None}, key=lambda v: v.encode())
        assert table.sizes[column] == len(levels)
        got = {r.id: r.at for r in table.rank_column(df, column, "at").collect()}
        want = {r.id: levels.index(r[column]) if r[column] is not None else None for r in df.collect()}
        assert got == want
    coded = table.one_hot(df.select("id", "c"), "c")
    levels = sorted({v for v in values if v is not None}, key=lambda v: v.encode())
    found = places(coded, "c_onehot")
    for i, v in enumerate(values):
        assert found[i] == ([levels.index(v) - 1] if v is not None and v != levels[0] else [], len(levels) - 1)


def test_unseen_and_few_levels(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None)], "id long, c string, d string")
    table = LevelTable.fit(df, ["c", "d"])
    assert table.sizes == {"c": 1, "d": 0}
    new = spark.createDataFrame([(1, "a", "x"), (2, "new", None)], "id long, c string, d string")
    for column in ("c", "d"):
        assert [p for p, _ in places(table.one_hot(new, column), f"{column}_onehot").values()] == [[], []]


def test_two_million_levels(spark):
    n = 2_000_000
    df = spark.range(n).select("id", F.format_string("level %07d", F.col("id") * 7919 % n).alias("c"))
    table = LevelTable.fit(df, ["c"])
    assert table.sizes == {"c": n}
    coded = table.one_hot(df, "c").select("id", F.unwrap_udt("c_onehot").alias("v"))
    wrong = coded.where(
        (F.col("v.size") != n - 1) | (F.coalesce(F.get("v.indices", F.lit(0)) + 1, F.lit(0)) != F.col("id") * 7919 % n)
    )
    assert wrong.count() == 0


def test_wide_columns_are_refused_before_their_values_are_collected(spark):
    df = spark.range(30_000).select(F.col("id").cast("string").alias("wide"), (F.col("id") % 5).cast("string").alias("narrow"))
    with pytest.raises(ValueError, match="wide"):
        features.column_levels(df, ["narrow", "wide"], 100)
    assert features.column_levels(df, ["narrow"], 5) == {"narrow": ["0", "1", "2", "3", "4"]}
    # A column that is named twice is one column.
    assert list(features.column_levels(df, ["narrow", "narrow"])) == ["narrow"]
    assert features.AutoEncode.fit(df, ["narrow", "narrow"]).one_hot.levels.keys() == {"narrow"}
    got = {r.column: r.n for r in profile.distinct_estimates(df, ["wide", "narrow"]).collect()}
    assert got["narrow"] == 5 and abs(got["wide"] / 30_000 - 1) < 0.05


def clustered(n, width, seed=1, centers=40, spread=0.02):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centers, width))
    return middle[rng.integers(0, centers, n)] + spread * rng.normal(size=(n, width))


def vectors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(rows)], "id long, vec array<double>")


def brute(queries, points, k):
    out = {}
    for i, q in enumerate(queries):
        gaps = np.zeros(len(points))
        for d in range(points.shape[1]):
            gaps += (q[d] - points[:, d]) ** 2
        near = sorted((g, j) for j, g in enumerate(gaps) if j != i)[:k]
        out[i] = [(float(g), j) for g, j in near]
    return out


@pytest.mark.parametrize("shape", ["clustered", "spread", "copies", "few"])
def test_pivots_give_exact_neighbors(spark, shape):
    rng = np.random.default_rng(2)
    rows = {
        "clustered": lambda: clustered(900, 32),
        "spread": lambda: rng.normal(size=(400, 24)),
        "copies": lambda: np.repeat(rng.normal(size=(6, 8)), 50, axis=0),
        "few": lambda: rng.normal(size=(3, 4)),
    }[shape]()
    df = vectors(spark, rows)
    got = pivots.nearest_by_pivots(df, df, 5, rows.shape[1], pivots=30)
    found = {r.id: [(n.distance, n.near_id) for n in r.neighbors] for r in got.collect()}
    assert found == brute(rows, rows, 5)


def test_pivots_compare_few_pairs_of_clustered_vectors(spark):
    df = vectors(spark, clustered(1_500, 64))
    assert pivots.compared_share(df, df, 64, pivots=64) < 0.1


def test_no_points(spark):
    df = vectors(spark, np.zeros((2, 3)))
    assert pivots.nearest_by_pivots(df, df.limit(0), 2, 3).collect() == []


def test_projections_recall(spark):
    rows = clustered(1_200, 48, seed=4)
    df = vectors(spark, rows)
    found = {
        r.id: {n.near_id for n in r.neighbors} for r in pivots.approximate_neighbors(df, df, 5, bucket_length=1.0, tables=6).collect()
    }
    want = brute(rows, rows, 5)
    hits = sum(len(found.get(i, set()) & {j for _, j in near}) for i, near in want.items())
    assert hits / (5 * len(want)) >= 0.9


def test_smote_by_pivots_equals_smote_by_boxes(spark):
    rows = clustered(300, 12, seed=3, centers=5)
    names = [f"f{i}" for i in range(12)]
    df = spark.createDataFrame(
        [(i, int(i % 4 == 0), *[float(x) for x in row]) for i, row in enumerate(rows)], ["id", "label", *names]
    )
    by = [sorted((tuple(r) for r in smote(df, "id", "label", names, index=kind).collect()), key=str) for kind in ("boxes", "pivots")]
    assert by[0] == by[1] and len(by[0]) == 450
    one = nearest_neighbors(*[vectors(spark, rows)] * 2, 3, 12).count()
    assert one == 300


def test_a_query_goes_once_to_a_group_of_cells(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(300, 16))
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], "id long, vec array<double>")
    sent, look = [], pivots._look

    def counted(visits, *rest):
        sent.append(visits.agg(F.count("*"), F.max(F.size("groups"))).first())
        return look(visits, *rest)

    monkeypatch.setattr(pivots, "_look", counted)
    monkeypatch.setattr(pivots, "GROUP_ROWS", 100)
    got = {r.id: [n.near_id for n in r.neighbors] for r in pivots.nearest_by_pivots(df, df, 5, 16, pivots=30).collect()}
    gap = ((rows[:, None] - rows[None]) ** 2).sum(axis=2)
    np.fill_diagonal(gap, np.inf)
    assert got == {i: list(np.argsort(gap[i], kind="stable")[:5]) for i in range(300)}
    # All 30 cells are near in this noise; they fill about four groups.
    assert [r[0] for r in sent] == [300, 300]
    assert max(r[1] for r in sent) <= 6


@pytest.mark.parametrize("offset", [0.0, 1e8])
def test_products_leave_all_nearest_points_as_candidates(offset):
    rng = np.random.default_rng(5)
    points = offset + np.round(rng.normal(size=(400, 12)), 2)
    points[200:] = points[:200]
    ids = np.arange(400)
    row, col, near = neighbors._nearest_in_tile(ids, points, np.full(400, np.inf), ids, points, 4)
    gap = np.zeros((400, 400))
    for d in range(12):
        gap += (points[:, d, None] - points[None, :, d]) ** 2
    np.fill_diagonal(gap, np.inf)
    order = np.argsort(gap, axis=1, kind="stable")[:, :4]
    assert col.reshape(400, 4).tolist() == order.tolist()
    assert near.reshape(400, 4).tolist() == np.take_along_axis(gap, order, axis=1).tolist()
