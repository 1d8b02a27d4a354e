import numpy as np
import pytest

from millrace.operators import cluster
from millrace.operators.neighbours import Search
from tests.test_cluster import dbscan_labels, density_clusters

SCHEMA = "id long, x array<double>"


def frame(spark, x):
    return spark.createDataFrame([(i * 3, p.tolist()) for i, p in enumerate(x)], SCHEMA)


def blobs(seed, d, n=600, around=12):
    rng = np.random.default_rng(seed)
    centers = rng.uniform(-20, 20, (around, d))
    return np.concatenate([centers[rng.integers(0, around, n)] + rng.normal(0, 0.4, (n, d)), rng.uniform(-20, 20, (n // 10, d))])


def brute_near(x, k):
    return np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), axis=1)[:, :k]


@pytest.mark.parametrize(("d", "k"), [(1, 3), (8, 5), (18, 40)])
def test_nearest_against_all_pairs_with_blocks_skipped(spark, d, k):
    x = blobs(d, d)
    search = Search(frame(spark, x), block=50)
    got = {r.id: r.near for r in search.nearest(k).collect()}
    want = brute_near(x, k)
    assert len(got) == len(x)
    assert np.allclose([got[i * 3] for i in range(len(x))], want, rtol=0, atol=1e-12)
    assert 0 < search.examined < len(x) ** 2 / 2


def test_nearest_without_structure_with_copies_and_with_few_points(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(150, 12)), np.zeros((400, 12)), rng.normal(size=(5, 12)) * 50])
    search = Search(frame(spark, x), block=40)
    got = {r.id: r.near for r in search.nearest(6).collect()}
    assert np.allclose([got[i * 3] for i in range(len(x))], brute_near(x, 6), rtol=0, atol=1e-12)
    few = Search(frame(spark, x[:3])).nearest(5).collect()
    assert all(len(r.near) == 3 and r.near[0] == 0 for r in few)


def test_copies_of_one_point_are_not_compared_with_each_other(spark):
    x = np.concatenate([np.ones((3000, 4)), np.random.default_rng(1).normal(size=(300, 4)) + 30])
    search = Search(frame(spark, x), block=100)
    assert search.nearest(5).where("near[4] = 0").count() == 3000
    assert search.examined < 3300 * 400


@pytest.mark.parametrize("d", [8, 18])
def test_density_clusters_against_all_pairs(spark, d):
    x = blobs(100 + d, d, 400)
    x = np.concatenate([x, x[:40], np.repeat(x[-1:], 7, 0)])
    x = x[np.random.default_rng(2).permutation(len(x))]
    eps = 1.1 * d**0.5 * 0.4
    want = density_clusters(x, eps, 5)
    assert len(set(want)) > 5 and -1 in want
    assert dbscan_labels(spark, x, eps, 5) == want


def test_most_pairs_are_not_examined_and_none_is_refused(spark):
    """Clustered points, over a hundred thousand of them within eps of each other: links are as many as points."""
    rng = np.random.default_rng(3)
    centers = rng.uniform(-100, 100, (40, 6))
    x = centers[rng.integers(0, 40, 20_000)] + rng.normal(0, 0.3, (20_000, 6))
    search = Search(spark.createDataFrame([(i, p.tolist(), 1) for i, p in enumerate(x)], SCHEMA + ", weight long"), ("weight",))
    core, links, border = search.density(2.0, 10, "weight")
    assert search.examined < 20_000**2 / 8
    assert core.count() > 19_900 and links.count() < 10 * 20_000


def test_keys_of_text_and_points_without_features(spark):
    rows = [("b", [0.0] * 5), ("a", [0.0] * 5), ("c", [0.1] + [-0.0] * 4), ("d", [9.0] * 5), (None, [0.0] * 5), ("e", None)]
    df = spark.createDataFrame(rows, "k string, features array<double>")
    assert sorted((str(r.k), r.label) for r in cluster.dbscan(df, "k", 0.5, 3).collect()) == [("None", -1), ("a", 0), ("b", 0), ("c", 0), ("d", -1), ("e", -1)]
    near = {r.k: r.mean_distance for r in cluster.knn_distances(df.where("k is not null"), "k", 2).collect()}
    assert near["a"] == near["b"] == 0 and near["e"] is None and near["c"] == pytest.approx(0.05)
    with pytest.raises(ValueError):
        cluster.dbscan(df, "k", 0.5, 3, max_pairs=3)


def test_points_without_structure_are_not_sent_to_every_cell(spark, monkeypatch):
    x = np.random.default_rng(6).normal(size=(900, 24))
    x[:30] = x[0]
    search = Search(frame(spark, x))
    monkeypatch.setattr(search, "_asked", lambda *a, **k: pytest.fail("a copy of the points for each cell"))
    got = {r.id: r.near for r in search.nearest(5).collect()}
    assert np.allclose([got[i * 3] for i in range(len(x))], brute_near(x, 5), rtol=0, atol=1e-12)
