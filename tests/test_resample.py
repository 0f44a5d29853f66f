import numpy as np
import pytest
from pyspark.sql import functions as F

from outcomekit.operators import neighbors
from outcomekit.operators.neighbors import nearest_neighbors
from outcomekit.operators.resample import smote


def points_table(spark, matrix):
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "id bigint, vec array<double>").repartition(5)


def brute(matrix, ids, k):
    out = {}
    for i in ids:
        dist = np.zeros(len(matrix))
        for d in range(matrix.shape[1]):
            dist += (matrix[i, d] - matrix[:, d]) ** 2
        order = sorted((dist[j], j) for j in range(len(matrix)) if j != i)
        out[i] = order[:k]
    return out


def found(df):
    return {r.id: [(n.distance, n.near_id) for n in r.neighbors] for r in df.collect()}


@pytest.mark.parametrize("leaf_rows,tile_rows", [(10_000, 4_096), (16, 4_096), (64, 10), (10_000, 50)])
def test_neighbors_equal_brute_force(spark, monkeypatch, leaf_rows, tile_rows):
    monkeypatch.setattr(neighbors, "TILE_ROWS", tile_rows)
    rng = np.random.default_rng(5)
    matrix = np.column_stack([rng.normal(size=400), rng.integers(0, 3, 400), rng.integers(0, 2, 400)])
    matrix[:130] = matrix[0]  # a third of the rows are copies
    df = points_table(spark, matrix)
    got = found(nearest_neighbors(df, df, 5, 3, leaf_rows=leaf_rows))
    assert got == brute(matrix, range(400), 5)


def test_neighbors_of_some_rows_only(spark):
    rng = np.random.default_rng(6)
    matrix = rng.normal(size=(300, 4))
    df = points_table(spark, matrix)
    some = df.where(F.col("id") % 7 == 0)
    assert found(nearest_neighbors(some, df, 3, 4, leaf_rows=20)) == brute(matrix, range(0, 300, 7), 3)


def test_fewer_points_than_neighbors(spark):
    df = points_table(spark, np.array([[0.0], [1.0], [5.0]]))
    assert {k: [i for _, i in v] for k, v in found(nearest_neighbors(df, df, 5, 1)).items()} == {
        0: [1, 2], 1: [0, 2], 2: [1, 0],
    }


def classes(spark, rare, common=60, seed=9):
    rng = np.random.default_rng(seed)
    rows = [(i, 1, float(x), float(y)) for i, (x, y) in enumerate(rare)]
    rows += [(1_000 + i, 0, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(common, 2)))]
    return spark.createDataFrame(rows, "k bigint, y int, a double, b double")


def on_a_segment(point, rare, k):
    rare = np.asarray(rare, dtype=float)
    for i, start in enumerate(rare):
        dist = ((rare - start) ** 2).sum(axis=1)
        dist[i] = np.inf
        for j in np.argsort(dist, kind="stable")[:k]:
            step = rare[j] - start
            length = (step**2).sum()
            gap = 0.0 if length == 0 else float(np.dot(point - start, step) / length)
            if -1e-9 <= gap <= 1 and np.allclose(start + gap * step, point, atol=1e-9):
                return True
    return False


@pytest.mark.parametrize("rows", [2, 6, 25])
def test_smote_balances_and_stays_between_neighbors(spark, rows):
    rare = np.random.default_rng(rows).normal(size=(rows, 2)) + 5
    df = classes(spark, rare)
    out = smote(df, "k", "y", ["a", "b"])
    assert {r.y: r["count"] for r in out.groupBy("y").count().collect()} == {0: 60, 1: 60}
    kept = out.where(~F.col("is_synthetic")).drop("is_synthetic")
    assert kept.exceptAll(df).count() == 0 and kept.count() == df.count()
    made = out.where("is_synthetic").collect()
    assert all(r.y == 1 and r.k is None for r in made)
    assert all(on_a_segment(np.array([r.a, r.b]), rare, min(5, rows - 1)) for r in made)


def test_smote_refuses_a_single_row(spark):
    with pytest.raises(ValueError, match="one row"):
        smote(classes(spark, [(1.0, 2.0)]), "k", "y", ["a", "b"]).count()


def test_smote_does_not_depend_on_partitions_or_cells(spark):
    df = classes(spark, np.random.default_rng(1).normal(size=(40, 2)), common=120)
    first = smote(df, "k", "y", ["a", "b"])
    for again in (
        smote(df.repartition(64), "k", "y", ["a", "b"], leaf_rows=4),
        smote(df.coalesce(1), "k", "y", ["a", "b"], bucket_rows=5),
    ):
        assert first.exceptAll(again).count() == 0 and first.count() == again.count()


def test_copies_only_give_copies(spark):
    rare = [(2.0, 3.0)] * 30 + [(9.0 + i, 9.0) for i in range(10)]
    out = smote(classes(spark, rare, common=200), "k", "y", ["a", "b"]).where("is_synthetic")
    made = [(r.a, r.b) for r in out.collect()]
    assert len(made) == 160
    copies = [p for p in made if p == (2.0, 3.0)]
    assert 90 <= len(copies) <= 150
    # No row may lie between the copies and the other rows: those have nearer neighbors.
    assert all(p[1] == 9.0 for p in made if p != (2.0, 3.0))


def test_three_classes_all_grow(spark):
    rows = [(i, 0 if i < 30 else (1 if i < 40 else 2), float(i), float(i % 7)) for i in range(46)]
    df = spark.createDataFrame(rows, "k bigint, y int, a double, b double")
    assert {r.y: r["count"] for r in smote(df, "k", "y", ["a", "b"]).groupBy("y").count().collect()} == {0: 30, 1: 30, 2: 30}


def test_flags_are_parted(spark):
    """Flags that are mostly one, where a median separates nothing."""
    rng = np.random.default_rng(3)
    vectors = (rng.random((20_000, 20)) < rng.uniform(0.55, 0.9, 20)).astype(float)
    tree = neighbors.space_partition(vectors[rng.permutation(20_000)[:2_000]], 64)
    counts = np.bincount(neighbors.cell_of(vectors, tree), minlength=tree.leaves)
    assert tree.leaves == 64 and counts.min() > 0 and counts.max() <= 4 * 20_000 / 64
    few = vectors[:400]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(few)], "id long, vec array<double>")
    got = {r.id: [n.distance for n in r.neighbors] for r in nearest_neighbors(df, df, 3, 20, leaf_rows=16).collect()}
    for i, v in enumerate(few):
        gaps = np.sort(((np.delete(few, i, axis=0) - v) ** 2).sum(axis=1))[:3]
        assert got[i] == gaps.tolist()


def test_equal_vectors_stay_in_one_cell():
    tree = neighbors.space_partition(np.ones((50, 3)), 8)
    assert tree.leaves == 1 and set(neighbors.cell_of(np.ones((5, 3)), tree)) == {0}
    tree = neighbors.space_partition(np.array([[1.0, 1.0], [np.nextafter(1.0, 2.0), 1.0]]), 4)
    assert tree.leaves == 2
