from functools import partial

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Observation
from pyspark.sql import functions as F

from millrace.operators import cluster, interpret, quality
from millrace.operators.graph import components

SIX = [(0, 0.0, 0.0, 0), (1, 0.0, 1.0, 0), (2, 1.0, 0.0, 0), (3, 5.0, 5.0, 1), (4, 5.0, 6.0, 1), (5, 9.0, 9.0, 2)]


def points(spark, rows=SIX):
    return spark.createDataFrame([(k, [x, y], c) for k, x, y, c in rows], "k long, features array<double>, label int")


def test_silhouette_by_hand_with_a_singleton(spark):
    x, c = np.array([r[1:3] for r in SIX]), [r[3] for r in SIX]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    s = []
    for i in range(6):
        own = [j for j in range(6) if c[j] == c[i] and j != i]
        if not own:
            s.append(0.0)
            continue
        a = d[i, own].mean()
        b = min(d[i, [j for j in range(6) if c[j] == o]].mean() for o in set(c) - {c[i]})
        s.append((b - a) / max(a, b))
    assert quality.silhouette(points(spark), key="k") == pytest.approx(np.mean(s))
    assert quality.silhouette(points(spark, [(i, 0.0, 1.0, 0) for i in range(3)]), key="k") is None


def test_adjusted_rand_of_equal_renamed_and_crossed(spark):
    df = spark.createDataFrame([(0, 1, 0), (0, 1, 1), (1, 0, 0), (1, 0, 1)], "a int, b int, c int")
    ari = lambda x, y: quality.adjusted_rand_table(df, x, y).first()[0]
    assert (ari("a", "a"), ari("a", "b")) == (1.0, 1.0) and ari("a", "c") == pytest.approx(-0.5)


def test_calinski_harabasz_of_points_on_their_means(spark):
    rows = [(0, 0.0, 0.0, 0), (1, 0.0, 0.0, 0), (2, 3.0, 0.0, 1), (3, 3.0, 0.0, 1)]
    assert quality.calinski_harabasz(points(spark, rows)) == 1.0


def density_clusters(x, eps, least):
    """Labels by comparing all points."""
    near = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) <= eps
    core, label, n = near.sum(1) >= least, np.full(len(x), -1), 0
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            stack = [i]
            while stack:
                j = stack.pop()
                if label[j] < 0:
                    label[j] = n
                    stack += [m for m in np.flatnonzero(near[j] & core) if label[m] < 0]
            n += 1
    return [int(label[i]) if core[i] else int(min(label[near[i] & core], default=-1)) for i in range(len(x))]


def dbscan_labels(spark, x, eps, least):
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], "k long, features array<double>")
    return [r.label for r in cluster.dbscan(df, "k", eps, least).orderBy("k").collect()]


@pytest.mark.parametrize("seed", range(2))
def test_dbscan_against_brute_force(spark, seed):
    x = np.random.default_rng(seed).uniform(0, 6, (80, 2))
    assert dbscan_labels(spark, x, 0.6, 4) == density_clusters(x, 0.6, 4)


@pytest.mark.parametrize(("d", "least"), [(1, 3), (2, 3), (3, 4), (4, 3)])
def test_dbscan_of_dense_cells(spark, d, least):
    """Blobs of many points, some of them a little more or less than eps apart, and points around them."""
    rng = np.random.default_rng(d)
    blobs = [rng.normal(rng.uniform(-4, 4, d), 0.15, (40, d)) for _ in range(9)]
    steps = np.arange(12)[:, None] * np.eye(d)[0] * np.where(np.arange(12) < 6, 0.5, 0.5000001)[:, None] + 9
    x = np.concatenate([*blobs, np.repeat(steps, least, 0), rng.uniform(-5, 5, (60, d))])
    x = x[rng.permutation(len(x))]
    assert dbscan_labels(spark, x, 0.5, least) == density_clusters(x, 0.5, least)


@pytest.mark.parametrize("few", [1e8, 0])
def test_dbscan_tells_dense_neighbours_apart(spark, monkeypatch, few):
    """Full cells that touch, with gaps just over and under eps that their outermost points do not show."""
    monkeypatch.setattr(cluster, "_by_cells", partial(cluster._by_cells, few=few))
    bar = [(0.0, y) for y in np.linspace(20, 23, 60)]
    other = [(1.02, y) for y in np.linspace(20, 23, 60)]
    hollow = [(0.5, 0.0), (0.499, 0.35), (0.5, 0.7)]
    tip = [(1.4985, 0.35)] * 3
    x = np.array([*bar, *other, *hollow, *tip])
    want = density_clusters(x, 1.0, 3)
    assert dbscan_labels(spark, x, 1.0, 3) == want and len(set(want)) == 3


def test_dbscan_of_one_crowded_place(spark):
    """A third of all points in one place, beside others that are far or null."""
    rows = [(i, [0.0, 0.0]) for i in range(3000)] + [(3000 + i, [float(i), 50.0]) for i in range(6000)] + [(9000, None), (9001, [0.0, 0.9])]
    df = spark.createDataFrame(rows, "k long, features array<double>")
    got = {r.label: r.n for r in cluster.dbscan(df, "k", 0.95, 5).groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert got == {0: 3001, -1: 6001}


def test_crowded_points_in_four_dimensions_do_not_make_more_pairs(spark, monkeypatch):
    """One region that fills up: only points outside dense cells are compared with others."""
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.uniform(0, 1, (1500, 4)), rng.uniform(-1.5, 3, (60, 4)), np.repeat([[9.0] * 4], 3, 0), [[-9.0] * 4]])
    x = x[rng.permutation(len(x))]
    searches, once = [], cluster.neighbours.Search.density
    monkeypatch.setattr(cluster.neighbours.Search, "density", lambda self, *a, **k: (once(self, *a, **k), searches.append(self))[0])
    want = density_clusters(x, 1.0, 3)
    assert dbscan_labels(spark, x, 1.0, 3) == want and -1 in want and len(set(want)) > 2
    assert sum(s.examined for s in searches) < len(x) ** 2 / 8


def test_dense_cells_in_four_dimensions_that_only_inner_points_connect(spark):
    """The nearest points of two cells are the outermost along no axis; a gap just under and one just over eps."""
    cell = [[0.45, 0, 0.1, 0.1], [0, 0.45, 0.1, 0.1], [0.4, 0.4, 0.1, 0.1], [0, 0, 0.05, 0.05], [0, 0, 0.15, 0.15]]
    made = []
    for at, gap in ((0.0, 0.999), (50.0, 1.001)):
        tip = 0.4 + gap / 2**0.5
        made += [np.array(cell) + [0, 0, at, 0], np.array([[tip, tip, 0.1, 0.1], [tip + 0.01, tip, 0.1, 0.1], [tip, tip + 0.01, 0.1, 0.1]]) + [0, 0, at, 0]]
    x = np.concatenate(made)
    want = density_clusters(x, 1.0, 3)
    assert want == [0] * 8 + [1] * 5 + [2] * 3 and dbscan_labels(spark, x, 1.0, 3) == want


@pytest.mark.parametrize("far", [1e9, 1e300, np.nan])
def test_dense_cells_where_the_grid_is_coarse(spark, far):
    """Coordinates beyond what a cell's number can tell apart, and some that are no numbers."""
    x = np.zeros((10, 4))
    x[:, 0] = [0, 0.1, 0.2, 0.3, 5, 5.1, 5.2, 0.25, 0.25, 0.25]
    x[:4, 1] = x[7:, 2] = far
    x[8, 2] += 4.0
    want = density_clusters(x, 0.5, 3)
    assert dbscan_labels(spark, x, 0.5, 3) == want and 0 in want


def test_dbscan_refuses_too_many_pairs(spark):
    with pytest.raises(ValueError):
        cluster.dbscan(points(spark), "k", 1.0, 2, max_pairs=3)


def test_grid_takes_the_direction_of_the_score(spark):
    rows = [(i, float(i % 2 * 10 + i / 100), 0.0, 0) for i in range(20)]
    for score in ("silhouette", "davies_bouldin"):
        got = cluster.grid(points(spark, rows), "k", "kmeans", {"k": [2, 4]}, score=score).where("best").collect()
        assert [r.parameters for r in got] == ["k=2"]


def test_knn_counts_the_point_itself(spark):
    got = cluster.knn_distances(points(spark), "k", 2).orderBy("k").collect()
    assert got[0].mean_distance == 0.5 and len(got) == 6
    with pytest.raises(ValueError):
        cluster.knn_distances(points(spark), "k", 0)


def test_registry(spark):
    cluster.register("clustering", "mine", dict)
    assert cluster.estimator("clustering", "mine") is dict
    with pytest.raises(ValueError):
        cluster.estimator("regression", "nope")


@pytest.mark.parametrize(("problem", "name"), [("clustering", "kmeans"), ("classification", "logistic_regression"), ("classification", "random_forest"), ("classification", "linear_svc"), ("regression", "ridge")])
def test_models_predict_in_a_session_with_observations(spark, problem, name):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    df = points(spark).select(array_to_vector("features").alias("vector"), (F.col("label") % 2).cast("double").alias("target"))
    extra = {"k": 2, "seed": 1} if problem == "clustering" else {"labelCol": "target"}
    made = cluster.fitted(problem, name, df, featuresCol="vector", **extra).transform(df)
    assert seen.get["n"] == 3 and made.where("prediction is not null").count() == 6 and made.select("prediction").distinct().count() > 1


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_readiness_reads_a_long_table(spark):
    rows = [("a", "adjusted_rand", 0.2), ("a", "silhouette", 0.1), ("a", "davies_bouldin", 1.0), ("a", "calinski_harabasz", 900.0), ("b", "adjusted_rand", 0.1)]
    row = interpret.readiness(spark.createDataFrame(rows, "model string, metric string, value double")).first()
    assert (row.winner, row.barriers, row.ready) == ("a", "silhouette", False)


def test_fingerprints_tell_changed_and_missing_tables(spark):
    df = points(spark)
    assert interpret.reproducible(df, df.orderBy("features"))
    assert not interpret.reproducible(df, df.where("k > 0")) and not interpret.reproducible(df, None)


def test_descriptions_name_unknown_features(spark):
    profile = quality.cluster_profile(points(spark), top=2)
    got = interpret.describe_clusters(profile, ["x"]).where("label = 2").first()
    assert got.description == "cluster 2: x=9.000, unknown_feature_1=9.000"
    with pytest.raises(ValueError):
        interpret.describe_clusters(profile.limit(0), [])


def test_silhouette_and_nearest_of_all_points(spark):
    """More points than silhouette() once took unasked."""
    n = 5200
    x = np.random.default_rng(1).normal(size=(n, 2))
    rows = [(i, x[i].tolist(), i % 3) for i in range(n)]
    given = spark.createDataFrame(rows, "k long, features array<double>, label int")
    labels, s = np.arange(n) % 3, []
    for i in range(n):
        means = [d.sum() / max(1, len(d) - (c == labels[i])) for c, d in ((c, np.sqrt(((x[labels == c] - x[i]) ** 2).sum(1))) for c in range(3))]
        a, b = means[labels[i]], min(m for c, m in enumerate(means) if c != labels[i])
        s.append((b - a) / max(a, b))
    assert quality.silhouette(given, key="k") == pytest.approx(np.mean(s), abs=1e-12)
    assert quality.silhouette(given, key="k", sample=100) != pytest.approx(np.mean(s), abs=1e-12)
    near = {r.k: r.mean_distance for r in cluster.knn_distances(given, "k", 4).collect()}
    assert len(near) == n
    for i in (0, 700, n - 1):
        assert near[i] == pytest.approx(np.sort(np.sqrt(((x - x[i]) ** 2).sum(1)))[:4].mean())


def test_distances_of_points_near_each_other_and_far_away():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(40, 8)), 1e6 + rng.normal(size=(40, 8)) * 1e-3, np.full((5, 8), 1e6)])
    want = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.allclose(quality.distances(x, x), want, rtol=1e-6, atol=0) and (np.diag(quality.distances(x, x)) == 0).all()


def test_labelings_share_one_comparison_of_two_blocks_at_a_time(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 3)) + rng.integers(0, 2, (1500, 1)) * 5
    rows = [(i, p.tolist(), int(p[0] > 2), i % 70, 0) for i, p in enumerate(x)]
    df = spark.createDataFrame(rows, "k long, features array<double>, a int, b int, c int")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))

    def brute(c):
        means = np.stack([d[:, c == v].sum(1) for v in np.unique(c)], 1)
        n, at = np.bincount(c), np.arange(len(c))
        a, means = means[at, c] / (n[c] - 1), means / n
        means[at, c] = np.inf
        return ((means.min(1) - a) / np.maximum(a, means.min(1))).mean()

    calls, once = [], quality.against_all
    monkeypatch.setattr(quality, "against_all", lambda *a, **k: calls.append(1) or once(*a, **k))
    got = {r.model: r.value for r in quality.evaluate(df, {"a": "a", "b": "b", "c": "c"}, ["silhouette"]).collect()}
    assert got["a"] == pytest.approx(brute(np.array([r[2] for r in rows])), abs=1e-9)
    assert got["b"] == pytest.approx(brute(np.array([r[3] for r in rows])), abs=1e-9)
    assert got["c"] is None and len(calls) == 1


def test_samples_of_a_search_do_not_meet_in_one_task(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=2) * 0.1 + 10 * (i % 3)).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, features array<double>")
    sizes, fitted = [], cluster.fit
    want = [sorted(r.k for r in df.orderBy(F.xxhash64("k", F.lit(7)), "k").limit(n).collect()) for n in (75, 150, 300)]
    monkeypatch.setattr(type(df), "limit", lambda *_: pytest.fail("limit"))
    monkeypatch.setattr(cluster, "fit", lambda a, data, key, **p: sizes.append(sorted(r.k for r in data.collect())) or fitted(a, data, key, **p))
    made = cluster.random_search(df, "k", "kmeans", {"k": [2, 3, 5, 8]}, draws=4, score="silhouette_squared", seed=7).collect()
    assert [r.parameters for r in made if r.best] == ["k=3"]
    assert sizes == [want[0]] * 4 + [want[1]] * 2 + [want[2]]
