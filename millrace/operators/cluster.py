"""Clusterings: k-means, bisecting k-means, DBSCAN, grids over them, and their tables.

Rows carry a key; a clustering is a DataFrame of key and integer label, -1 for noise.
Features are an array column.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import classification, clustering, regression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions import values
from millrace.sources.scratch import checkpoint, hot_join, hot_keys, scratch
from millrace.sources.tables import sample_stratified

from . import neighbours, quality
from .graph import components


def feature_frame(df: DataFrame, key: str, label: str | None = None, n: int | None = None, seed: int = 42) -> DataFrame:
    """``key, features``: numeric and boolean columns as an array of doubles, nulls 0; a seeded
    sample of ``n`` rows if asked."""
    from .prepare import Prepare

    made = Prepare("feature_vector", exclude=[key] + [label] * bool(label)).fit(df).transform(df)
    made = made.select(key, F.col("features").cast("array<double>").alias("features"))
    return made if n is None else made.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def _vectors(points: DataFrame, key: str) -> DataFrame:
    return points.select(key, array_to_vector(F.col("features").cast("array<double>")).alias("_vector"))


def kmeans(points: DataFrame, key: str, k: int, *, seed: int = 42, max_iter: int = 20):
    """Assignment and fitted model of k-means."""
    data = _vectors(points, key)
    model = clustering.KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="_vector", predictionCol="label").fit(data)
    return model.transform(data).select(key, "label"), model


def bisecting(points: DataFrame, key: str, k: int, *, seed: int = 42):
    """Top-down hierarchical clustering, in place of exact linkage, which is quadratic."""
    data = _vectors(points, key)
    model = clustering.BisectingKMeans(k=k, seed=seed, featuresCol="_vector", predictionCol="label").fit(data)
    return model.transform(data).select(key, "label"), model


def centroids(model) -> list[list[float]]:
    return [c.tolist() for c in model.clusterCenters()]


def centroid_table(points: DataFrame, model) -> DataFrame:
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return points.sparkSession.createDataFrame(rows, "label int, center array<double>")


def eps_pairs(points: DataFrame, key: str, eps: float, *, axes: int = 2, max_pairs: int = 2_000_000_000) -> DataFrame:
    """``a, b`` of all ordered pairs within ``eps``, a point with itself included.

    Points are put in cells of side eps along the ``axes`` coordinates of largest variance; a
    distance is never less than its projection, so neighbours are in cells that touch. The
    candidates are counted from the cell sizes first, and over ``max_pairs`` is refused.
    """
    pts = points.select(F.col(key).alias("id"), F.col("features").cast("array<double>").alias("x")).where("id is not null")
    spread = pts.select(F.posexplode("x").alias("d", "v")).groupBy("d").agg(F.var_pop("v").alias("s")).orderBy(F.desc("s"), "d").limit(axes).collect()
    dims = [r["d"] for r in spread]
    cell = [F.floor(F.get("x", d) / eps).cast("long") for d in dims]
    steps = list(itertools.product((-1, 0, 1), repeat=len(dims)))
    home = pts.select("id", "x", F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cell)]).alias("cell"))
    near = F.array(*[F.struct(*[(F.col(f"cell.c{i}") + s).alias(f"c{i}") for i, s in enumerate(step)]) for step in steps])
    reach = home.select("id", "x", F.explode(near).alias("cell"))
    sizes = home.groupBy("cell").agg(F.count("*").alias("n"))
    around = sizes.select("n", F.explode(near).alias("cell"))
    total = around.join(sizes.withColumnRenamed("n", "m"), "cell").agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0
    if total > max_pairs:
        raise ValueError(f"{total} candidate pairs within eps; take a smaller eps or a sample")
    other = reach.select(F.col("id").alias("b"), F.col("x").alias("y"), "cell")
    gap = F.aggregate(F.zip_with("x", "y", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v)
    return home.join(other, "cell").where(F.sqrt(gap) <= eps).select(F.col("id").alias("a"), "b")


#: Up to this many dimensions DBSCAN works by cells; beyond, each cell has too many neighbours.
CELL_DIMENSIONS = 3
#: Up to this many, dense cells are taken whole before the other points are compared by blocks.
GRID_DIMENSIONS = 16


def _gap(p, q):
    return F.sqrt(F.aggregate(F.zip_with(p, q, lambda u, v: (u - v) * (u - v)), F.lit(0.0), lambda s, v: s + v))


def _by_cells(points: DataFrame, eps: float, min_samples: int, d: int, max_pairs: int | None, few: float = 1e8):
    """Of the points ``id, x``, put in cells whose diagonal is just under eps: ``a, rep, dense, n`` (how
    many points near ``a`` are ``rep`` or in its dense cell), ``a, rep`` of the points in dense
    cells, the reps that hold very many, and links ``a, b`` between dense cells.

    A cell of ``min_samples`` points is dense: all of them are core points of one cluster, for which
    the smallest key stands. Only points of thin cells are compared with what is around them.
    Neighbouring dense cells are linked if their outermost points are near enough, else by the
    points of either that can reach the other; where over ``few`` comparisons could be left, cells
    already linked by way of others are left out first."""
    side = eps / math.sqrt(d) * (1 - 1e-9)
    axes = [f"c{i}" for i in range(d)]
    steps = [s for s in itertools.product(range(-2, 3), repeat=d) if sum(max(0, abs(v) - 1) ** 2 for v in s) <= d * (1 + 1e-8)]
    moved = lambda some: F.explode(F.array(*[F.struct(*[(F.col(f"cell.{c}") + v).alias(c) for c, v in zip(axes, s, strict=True)]) for s in some]))
    placed = checkpoint(points.select("id", "x", F.struct(*[F.floor(F.get("x", F.lit(i)) / side).alias(c) for i, c in enumerate(axes)]).alias("cell")))
    sizes = checkpoint(placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("id").alias("least")))
    if max_pairs is not None:
        around = sizes.where(F.col("n") < min_samples).select("n", moved(steps).alias("cell"))
        total = around.join(sizes.select("cell", F.col("n").alias("m")), "cell").agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0
        if total > max_pairs:
            raise ValueError(f"{total} candidate pairs within eps; take a smaller eps or a sample")
    hot = hot_keys(sizes, ["cell"])
    is_dense = F.col("n") >= min_samples
    known = hot_join(placed, sizes, ["cell"], hot)
    known = known.select("id", "x", "cell", is_dense.alias("dense"), F.when(is_dense, F.col("least")).otherwise(F.col("id")).alias("rep"))
    known = checkpoint(known)
    probes = known.where("not dense").select(F.col("id").alias("a"), F.col("x").alias("y"), moved(steps).alias("cell"))
    met = hot_join(known, probes, ["cell"], hot).where(_gap("x", "y") <= eps).groupBy("a", "rep").agg(F.count("*").alias("n"), F.max("dense").alias("dense"))

    full = known.where("dense")
    towards = [s for s in itertools.product((-1, 0, 1), repeat=d) if any(s)]
    outermost = [F.max_by("x", sum(F.get("x", F.lit(i)) * v for i, v in enumerate(s))) for s in towards]
    cells = checkpoint(full.groupBy("cell", "rep").agg(F.count("*").alias("n"), F.array_distinct(F.array(*outermost)).alias("ends")))
    mine = cells.select(F.col("rep").alias("a"), F.col("cell").alias("cell_a"), F.col("n").alias("n_a"), F.col("ends").alias("p"), moved([s for s in steps if s > (0,) * d]).alias("cell"))
    pairs = mine.join(cells.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("ends").alias("q"), "cell"), "cell")
    reached = F.exists("p", lambda u: F.exists("q", lambda v: _gap(u, v) <= eps))
    pairs = checkpoint(pairs.select("a", "b", "n_a", "n_b", "cell_a", F.col("cell").alias("cell_b"), reached.alias("near")))
    links, of_rep = pairs.where("near").select("a", "b"), hot_keys(cells, ["rep"])
    left = pairs.where("not near")
    work = left.agg(F.sum(F.col("n_a").cast("double") * F.col("n_b"))).first()[0] or 0
    if work > few:
        roots = checkpoint(components(links))
        root_of = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}"))
        apart = ~F.coalesce(F.col("root_a"), F.col("a")).eqNullSafe(F.coalesce(F.col("root_b"), F.col("b")))
        left = checkpoint(left.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left").where(apart).select(*left.columns))
    if work:

        def able(me: str, other: str, x: str) -> DataFrame:
            """Points of cell ``me`` within eps of the cube of cell ``other``."""
            beyond = [F.greatest(F.lit(0.0), F.col(f"cell_{other}.{c}") * side - F.get("x", F.lit(i)), F.get("x", F.lit(i)) - (F.col(f"cell_{other}.{c}") + 1) * side) for i, c in enumerate(axes)]
            met = hot_join(full.select("id", "x", "rep"), left.select("a", "b", "cell_a", "cell_b", F.col(me).alias("rep")), ["rep"], of_rep)
            return met.where(sum(v * v for v in beyond) <= eps * eps * (1 + 1e-6)).select("a", "b", "id", F.col("x").alias(x))

        one, two = checkpoint(able("a", "b", "x")), able("b", "a", "y").drop("id")
        often = hot_keys(one.groupBy("a", "b").agg(F.count("*").alias("n")), ["a", "b"])
        links = links.unionByName(hot_join(one, two, ["a", "b"], often).where(_gap("x", "y") <= eps).select("a", "b").distinct())
    return met, full.select(F.col("id").alias("a"), "rep"), of_rep, links


def _numbered(names: DataFrame, *by: str, at: str = "label") -> DataFrame:
    """``names`` with their number from 0 in the order of ``by``, range by range."""
    ranged = checkpoint(names.repartitionByRange(*by).withColumn("_p", F.spark_partition_id()))
    counts = sorted((r["_p"], r["count"]) for r in ranged.groupBy("_p").count().collect())  # one row a partition
    starts = [(p, sum(n for q, n in counts if q < p)) for p, _ in counts]
    starts = ranged.sparkSession.createDataFrame(starts, "_p int, _start long")
    number = F.row_number().over(Window.partitionBy("_p").orderBy(*by)) - 1 + F.col("_start")
    return ranged.join(F.broadcast(starts), "_p").select(*names.columns, number.alias(at))


def _dense_cells(places: DataFrame, eps: float, min_samples: int, d: int) -> tuple[DataFrame, DataFrame]:
    """``places`` with ``unit``, the least ``rep`` of their cell if that is dense, else null; and the dense cells
    ``unit, m, lo, hi, ends``: places, corners, and the outermost points along each axis.

    Cells have a diagonal of eps. One is dense if it weighs ``min_samples`` and its points are all within eps of each
    other, by their corners and not by the grid's, which rounding can move."""
    side, axes = eps / math.sqrt(d) * (1 - 1e-9), [F.get("x", F.lit(i)) for i in range(d)]
    placed = places.withColumn("cell", F.array(*[F.floor(v / F.lit(side)) for v in axes]))
    facts = [F.sum("n").alias("weight"), F.count("*").alias("m"), F.min("rep").alias("unit"), F.array(*map(F.min, axes)).alias("lo"), F.array(*map(F.max, axes)).alias("hi")]
    ends = F.flatten(F.array(*[by("x", v) for v in axes for by in (F.min_by, F.max_by)])).alias("ends")

    @F.pandas_udf("boolean")
    def tight(lo: pd.Series, hi: pd.Series) -> pd.Series:
        if not len(lo):
            return pd.Series([], dtype=bool)
        extent = np.stack(hi.to_numpy()).astype("f8") - np.stack(lo.to_numpy()).astype("f8")
        return pd.Series(np.sqrt((extent**2).sum(1)) <= eps)

    full = placed.groupBy("cell").agg(*facts, ends).where(F.col("weight") >= min_samples)
    dense = checkpoint(full.where(tight("lo", "hi")))
    known = hot_join(placed, dense.select("cell", "unit"), ["cell"], hot_keys(dense, ["cell"], "m"), "left")
    return checkpoint(known.drop("cell")), dense.drop("cell", "weight")


#: Points that are put together to be compared with those of another cell.
CHUNK = 512


def _links_of_cells(known: DataFrame, dense: DataFrame, more: DataFrame, eps: float, d: int) -> DataFrame:
    """``more`` and links ``a, b`` that connect the dense cells (of ``_dense_cells``) with points within eps.

    Their corners decide for most cells that all their points are or none is, outermost points for most others.
    What is left is compared point by point where the cells are not connected by way of others."""

    @F.pandas_udf("boolean")
    def touch(p: pd.Series, q: pd.Series) -> pd.Series:
        found, step = np.zeros(len(p), bool), max(1, (1 << 20) // (4 * d**3))
        for at in range(0, len(p), step):
            one, two = (np.stack(v.iloc[at : at + step].to_numpy()).reshape(-1, 2 * d, d) for v in (p, q))
            gap = np.sqrt(((one[:, :, None] - two[:, None]) ** 2).sum(-1))
            found[at : at + step] = (gap <= eps).any((1, 2))
        return pd.Series(found)

    @F.pandas_udf("boolean")
    def meet(p: pd.Series, q: pd.Series) -> pd.Series:
        def outside(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            return np.sqrt((np.maximum(0.0, np.maximum(y.min(0) - x, x - y.max(0))) ** 2).sum(1))

        def one(x: np.ndarray, y: np.ndarray) -> bool:
            x, y = x.reshape(-1, d), y.reshape(-1, d)
            x = x[outside(x, y) <= eps]
            y = y[outside(y, x) <= eps] if len(x) else x
            return any((neighbours.between(x[i : i + 64], y) <= eps).any() for i in range(0, len(x), 64)) if len(y) else False

        return pd.Series([one(x, y) for x, y in zip(p, q, strict=True)], dtype=bool)

    close = checkpoint(neighbours.near_boxes(dense.select(F.col("unit").alias("id"), "lo", "hi"), eps))
    ends = lambda x, p: dense.select(F.col("unit").alias(x), F.col("ends").alias(p))
    judged = checkpoint(close.where("not sure").join(ends("a", "p"), "a").join(ends("b", "q"), "b").select("a", "b", touch("p", "q").alias("linked")))
    links = checkpoint(more.unionByName(close.where("sure").select("a", "b")).unionByName(judged.where("linked").select("a", "b")))
    left = judged.where("not linked").select("a", "b")
    if left.isEmpty():
        return links
    roots = checkpoint(components(links))
    root_of = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}"))
    apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    left = checkpoint(left.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left").where(apart).select("a", "b"))
    if left.isEmpty():
        return links
    wanted = left.select(F.col("a").alias("unit")).unionByName(left.select(F.col("b").alias("unit"))).distinct()
    parts = checkpoint(dense.join(wanted, "unit", "left_semi").select("unit", "m", F.ceil(F.col("m") / CHUNK).alias("parts")))
    points = hot_join(known.select("rep", "x", "unit"), parts, ["unit"], hot_keys(parts, ["unit"], "m"))
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).alias("part")
    chunks = checkpoint(points.groupBy("unit", part).agg(F.flatten(F.collect_list("x")).alias("x")))
    some = lambda x, p: chunks.select(F.col("unit").alias(x), F.col("x").alias(p))
    met = left.join(some("a", "p"), "a").join(some("b", "q"), "b").where(meet("p", "q")).select("a", "b").distinct()
    return links.unionByName(checkpoint(met))


def _by_blocks(points: DataFrame, eps: float, min_samples: int, max_pairs: int | None, d: int) -> DataFrame:
    """``a, label`` of the points ``id, x`` in clusters, in any number of dimensions. Points in one place
    are one point with a weight, which stands for all of them in the end. Dense cells are taken whole; only
    points outside them are searched for, so points that crowd in one region do not make more pairs."""
    numbers = checkpoint(_numbered(points.select("id").distinct(), "id").withColumnRenamed("label", "no"))
    where = F.transform("x", lambda v: v + F.lit(0.0))  # -0.0 is 0.0
    placed = checkpoint(points.join(numbers, "id").select("id", "no", where.alias("x")).withColumns({"h1": F.xxhash64("x"), "h2": F.xxhash64(F.lit("x"), "x")}))
    places = checkpoint(placed.groupBy("h1", "h2").agg(F.min("no").alias("rep"), F.count("*").alias("n"), F.min_by("x", "no").alias("x")))
    dense = None
    if d <= GRID_DIMENSIONS and eps > 0:
        known, dense = _dense_cells(places, eps, min_samples, d)
        dense = None if dense.isEmpty() else dense
    if dense is None:
        known = places.withColumn("unit", F.lit(None).cast("long"))
    lone = F.col("unit").isNull()
    core, links, border = (points.sparkSession.createDataFrame([], t) for t in ("a long", "a long, b long", "a long, rep long"))
    if max_pairs is not None or not known.where(lone).isEmpty():
        search = neighbours.Search(known.select(F.col("rep").alias("id"), "x", F.col("n").alias("weight"), F.coalesce("unit", "rep").alias("unit"), lone.cast("long").alias("lone")), ("weight", "unit", "lone"))
        if max_pairs is not None and (total := search.candidates(eps)) > max_pairs:
            raise ValueError(f"{total} candidate pairs within eps; take a smaller eps or a sample")
        core, links, border = search.density(eps, min_samples, "weight") if dense is None else search.density(eps, min_samples, "weight", unit="unit", asks="lone")
    core = checkpoint(core)
    if dense is not None:
        core = checkpoint(core.unionByName(dense.select(F.col("unit").alias("a"))))
        links = _links_of_cells(known.where(~lone), dense, links, eps, d)
    roots = checkpoint(components(links))
    rooted = core.join(roots.withColumnRenamed("node", "a"), "a", "left").select("a", F.coalesce("root", "a").alias("root"))
    label_of = checkpoint(rooted.join(_numbered(rooted.select("root").distinct(), "root"), "root").select("a", "label"))
    often = hot_keys(border.groupBy("rep").agg(F.count("*").alias("n")), ["rep"])
    reached = hot_join(border, label_of.withColumnRenamed("a", "rep"), ["rep"], often).groupBy("a").agg(F.min("label").alias("label"))
    found = label_of.unionByName(reached).withColumnRenamed("a", "unit")
    crowded = None if dense is None else hot_keys(dense, ["unit"], "m")
    labels = checkpoint(hot_join(known.select("h1", "h2", F.coalesce("unit", "rep").alias("unit")), found, ["unit"], crowded).select("h1", "h2", "label"))
    return hot_join(placed.select(F.col("id").alias("a"), "h1", "h2"), labels, ["h1", "h2"], hot_keys(places, ["h1", "h2"])).select("a", "label")


def dbscan(points: DataFrame, key: str, eps: float, min_samples: int, *, max_pairs: int | None = None) -> DataFrame:
    """``key, label``: density clusters numbered from 0 in the order of their smallest core key,
    -1 for noise. A point counts itself; a border point in reach of several clusters takes
    the one of the smallest number. Null keys and features are noise.

    In up to three dimensions dense cells are taken whole, so pairs grow with the points. In up to sixteen they are too,
    and other points are compared with the blocks that eps reaches (``neighbours``), and no pairs are listed but
    those that connect; in more, all points are. With ``max_pairs`` more candidates are refused."""
    pts = points.select(F.col(key).alias("id"), F.col("features").cast("array<double>").alias("x")).where("id is not null and x is not null")
    d = pts.agg(F.max(F.size("x"))).first()[0] or 1
    if d > CELL_DIMENSIONS:
        found = points.select(F.col(key).alias("a")).join(_by_blocks(pts, eps, min_samples, max_pairs, d), "a", "left")
        return found.select(F.col("a").alias(key), F.coalesce("label", F.lit(-1)).cast("int").alias("label"))
    met, members, often, links = _by_cells(pts, eps, min_samples, d, max_pairs)
    met = checkpoint(met)
    core = checkpoint(met.groupBy("a").agg(F.sum("n").alias("n")).where(F.col("n") >= min_samples).select("a"))
    to_core = met.where("not dense").join(core.select(F.col("a").alias("rep")), "rep", "left_semi").select("a", "rep").unionByName(met.where("dense").select("a", "rep"))
    to_core = checkpoint(to_core)
    roots = checkpoint(components(to_core.join(core, "a", "left_semi").select("a", F.col("rep").alias("b")).unionByName(links)))
    nodes = members.select(F.col("rep").alias("node")).distinct().unionByName(core.select(F.col("a").alias("node"))).join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    numbered = _numbered(nodes.select("root").distinct(), "root")
    label_of = checkpoint(nodes.join(numbered, "root").select("node", "label"))
    reached = to_core.join(label_of.withColumnRenamed("node", "rep"), "rep").groupBy("a").agg(F.min("label").alias("reach"))
    own = hot_join(members, label_of.withColumnRenamed("node", "rep"), ["rep"], often).select("a", F.col("label").alias("own"))
    own = own.unionByName(core.join(label_of.withColumnRenamed("node", "a"), "a").select("a", F.col("label").alias("own")))
    found = points.select(F.col(key).alias("a")).join(own, "a", "left").join(reached, "a", "left")
    return found.select(F.col("a").alias(key), F.coalesce("own", "reach", F.lit(-1)).cast("int").alias("label"))


#: Scores that are better when smaller.
SMALLER = ("davies_bouldin",)


def _subsample(points: DataFrame, key: str, n: int | None, strata: str | None, seed: int) -> DataFrame:
    if n is None:
        return points
    if strata is not None:
        return sample_stratified(points, n, strata, key, seed)
    return points.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def grid(points: DataFrame, key: str, algorithm: str, parameters: Mapping[str, Sequence[object]], *, score: str = "silhouette", n: int | None = None, strata: str | None = None, seed: int = 42) -> DataFrame:
    """One row per combination: parameters, clusters, score, and whether it is the best.

    The loop is over parameters; each fit and score is a distributed job on the cached points.
    With ``n`` it runs on a seeded sample, in proportion to the values of ``strata`` if given.
    Fewer than two clusters score null.
    """
    rows = _grid(points, key, algorithm, parameters, score, n, strata, seed)
    known = [r[2] for r in rows if r[2] is not None]
    best = (min if score in SMALLER else max)(known, default=None)
    made = [(algorithm, ", ".join(f"{k}={v}" for k, v in chosen.items()), n_clusters, value, value is not None and value == best) for chosen, n_clusters, value in rows]
    return points.sparkSession.createDataFrame(made, "algorithm string, parameters string, n_clusters long, score double, best boolean")


def _grid(points, key, algorithm, parameters, score, n, strata, seed) -> list[tuple[dict, int, float | None]]:
    data = _subsample(points, key, n, strata, seed).cache()
    rows = []
    for options in itertools.product(*parameters.values()):
        chosen = dict(zip(parameters, options, strict=True))
        labels = fit(algorithm, data, key, **chosen).cache()
        n_clusters = labels.select("label").distinct().count()
        value = quality.METRICS[score](data.select(key, "features").join(labels, key), "label") if n_clusters > 1 else None
        rows.append((chosen, n_clusters, value))
        labels.unpersist()
    data.unpersist()
    return rows


def refit_best(points: DataFrame, key: str, algorithm: str, parameters: Mapping[str, Sequence[object]], *, score: str = "silhouette", n: int | None = None, strata: str | None = None, seed: int = 42) -> tuple[dict, DataFrame]:
    """The best combination of the grid (the first on a tie), searched on a sample if ``n`` is
    given, and its assignment after a fit on all points."""
    known = [(chosen, value) for chosen, _, value in _grid(points, key, algorithm, parameters, score, n, strata, seed) if value is not None]
    if not known:
        raise ValueError("no combination makes two clusters")
    best = (min if score in SMALLER else max)(known, key=lambda x: x[1])[0]
    return best, fit(algorithm, points, key, **best)


def _draw(rng: np.random.Generator, space: Mapping[str, object]) -> dict:
    """One value for each parameter: of a list one of it, of (low, high) a whole number or a fraction in
    between, of (low, high, "log") one that is even on a logarithmic scale."""
    made = {}
    for name, given in space.items():
        if isinstance(given, list):
            made[name] = given[int(rng.integers(len(given)))]
            continue
        low, high, *scale = given
        whole = isinstance(low, int) and isinstance(high, int)
        if scale:
            x = math.exp(rng.uniform(math.log(low), math.log(high + (1 if whole else 0))))
            made[name] = min(high, int(x)) if whole else x
        else:
            made[name] = int(rng.integers(low, high + 1)) if whole else float(rng.uniform(low, high))
    return made


SEARCHED = "rung int, candidate int, parameters string, n_points long, n_clusters long, score double, survives boolean, best boolean"


def random_search(points: DataFrame, key: str, algorithm: str, space: Mapping[str, object], *, draws: int = 16, eta: int = 2, least_points: int | None = None, score: str = "silhouette", seed: int = 42, **fixed) -> DataFrame:
    """Successive halving over ``draws`` different combinations drawn from ``space`` (see ``_draw``): all of them are
    fitted and scored on a small sample, the best of ``eta`` go on to one ``eta`` times as large, and so on; the last
    rung is all points. A row per fit: rung, candidate (its number in the draw), sample, score, and whether it
    goes on; ``best`` marks the winner (on a tie the first drawn).

    Samples are the first points by a seeded hash of the key, so each holds the one before. Draws depend on the
    seed only. ``least_points`` is the smallest sample (by default that of a geometric series to all points). Fits
    with fewer than two clusters have no score and rank last. ``fixed`` parameters are given to every fit.
    """
    if eta < 2:
        raise ValueError("eta: at least 2")
    rng, drawn = np.random.default_rng(seed), []
    for _ in range(100 * draws):  # a small space has fewer combinations than draws
        one = _draw(rng, space)
        if one not in drawn:
            drawn.append(one)
        if len(drawn) == draws:
            break
    rungs = 1
    while eta**rungs < len(drawn):
        rungs += 1
    rungs += len(drawn) > 1
    # Numbered once: a limit of so many rows would bring each sample into one task.
    ordered = checkpoint(_numbered(points.select("*", F.xxhash64(key, F.lit(seed)).alias("_mr_h")), "_mr_h", key, at="_mr_at").drop("_mr_h"))
    total = ordered.count()
    alive, rows, sign = list(range(len(drawn))), [], 1 if score in SMALLER else -1
    for rung in range(rungs):
        last = rung == rungs - 1
        n = total if last else min(total, max(least_points or 0, -(-total // eta ** (rungs - 1 - rung))))
        data = (checkpoint(ordered.where(F.col("_mr_at") < n)) if n < total else ordered).drop("_mr_at")
        found = []
        for i in alive:
            labels = checkpoint(fit(algorithm, data, key, **drawn[i], **fixed))
            n_clusters = labels.select("label").distinct().count()
            value = quality.METRICS[score](data.select(key, "features").join(labels, key), "label") if n_clusters > 1 else None
            found.append((i, n, n_clusters, value))
        ranked = sorted(found, key=lambda r: (r[3] is None, sign * (r[3] or 0.0), r[0]))
        alive = sorted(r[0] for r in ranked[: 1 if last else max(1, len(ranked) // eta)])
        rows += [(rung, i, ", ".join(f"{k}={v}" for k, v in drawn[i].items()), size, k, value, i in alive, last and i in alive and value is not None) for i, size, k, value in found]
    return points.sparkSession.createDataFrame(rows, SEARCHED)


def assignments(points: DataFrame, key: str, variants: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """One row per key and one label column per named variant ({"algorithm": ..., parameters})."""
    table = points.select(key)
    for name, variant in variants.items():
        given = dict(variant)
        labels = fit(str(given.pop("algorithm")), points, key, **given)
        table = table.join(labels.withColumnRenamed("label", name), key, "left")
    return table


def cluster_sizes(labels: DataFrame, label: str = "label") -> DataFrame:
    return labels.groupBy(label).agg(F.count("*").alias("n"))


def cluster_samples(df: DataFrame, key: str, label: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows of each cluster by a hash of the key."""
    order = Window.partitionBy(label).orderBy(F.xxhash64(key, F.lit(seed)), key)
    return df.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).drop("_r")


def knn_distances(points: DataFrame, key: str, k: int = 5, *, sample: int | None = None, seed: int = 42) -> DataFrame:
    """Mean distance of each point to its k nearest, itself included at distance 0; null for a point
    without features. All points, or a sample of at most ``sample`` if asked, are searched
    (``neighbours.Search.nearest``)."""
    if k < 1:
        raise ValueError("k: at least 1")
    if sample is not None:
        points = points.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(sample)
    data = checkpoint(points.select(F.monotonically_increasing_id().alias("id"), F.col(key), F.col("features").cast("array<double>").alias("x")))
    if data.isEmpty():
        raise ValueError("no points")
    near = neighbours.Search(data.where("x is not null")).nearest(k)
    mean = near.select("id", (F.aggregate("near", F.lit(0.0), lambda s, v: s + v) / F.size("near")).alias("mean_distance"))
    return data.select("id", key).join(mean, "id", "left").select(key, "mean_distance")


def knn_profile(distances: DataFrame) -> DataFrame:
    """Percentiles of the mean distances; the 95th is the suggested eps."""
    d = "mean_distance"
    facts = {"n": F.count(d), "mean": F.round(F.avg(d), 6), "std": F.round(F.stddev_pop(d), 6), "min": F.round(F.min(d), 6), "max": F.round(F.max(d), 6)}
    shares = (25, 50, 75, 90, 95, 99)
    found = values.quantiles(checkpoint(distances.select(d)), [d], [p / 100 for p in shares])  # one row
    rounded = found.select(*[F.round(f"q{i}", 6).alias(f"p{p}") for i, p in enumerate(shares)])
    return distances.agg(*[x.alias(n) for n, x in facts.items()]).crossJoin(F.broadcast(rounded)).withColumn("suggested_eps", F.col("p95"))


def fit(algorithm: str, points: DataFrame, key: str, **parameters) -> DataFrame:
    """Labels of a clustering by name: kmeans, bisecting, dbscan."""
    if algorithm == "dbscan":
        return dbscan(points, key, **parameters)
    if algorithm not in ("kmeans", "bisecting"):
        raise ValueError(f"algorithm: {algorithm}")
    return {"kmeans": kmeans, "bisecting": bisecting}[algorithm](points, key, **parameters)[0]


#: Estimators by problem type and name. Kernel machines and boosted trees of other engines have no Spark form.
ESTIMATORS: dict[str, dict[str, Callable]] = {
    "clustering": {"kmeans": clustering.KMeans, "bisecting": clustering.BisectingKMeans, "gaussian_mixture": clustering.GaussianMixture},
    "classification": {"random_forest": classification.RandomForestClassifier, "logistic_regression": classification.LogisticRegression, "linear_svc": classification.LinearSVC, "gradient_boosting": classification.GBTClassifier, "decision_tree": classification.DecisionTreeClassifier, "naive_bayes": classification.NaiveBayes},
    "regression": {
        "random_forest": regression.RandomForestRegressor, "linear_regression": regression.LinearRegression, "gradient_boosting": regression.GBTRegressor, "decision_tree": regression.DecisionTreeRegressor,
        "ridge": lambda **p: regression.LinearRegression(elasticNetParam=0.0, **p), "lasso": lambda **p: regression.LinearRegression(elasticNetParam=1.0, **p),
    },
}


def estimator(problem: str, name: str) -> Callable:
    try:
        return ESTIMATORS[problem][name]
    except KeyError:
        raise ValueError(f"{problem}/{name}: unknown; there are {sorted(ESTIMATORS.get(problem, {}))}") from None


def fitted(problem: str, name: str, data: DataFrame, **parameters):
    """The model of an estimator by name, without its training summary. The summary of a binary classifier
    holds the session, so such a model can't be sent to tasks once the session has seen an ``Observation``;
    a model that was written and read again has none."""
    model = estimator(problem, name)(**parameters).fit(data)
    if not getattr(model, "hasSummary", False):
        return model
    path = scratch(data.sparkSession, "model")
    model.write().save(path)
    return type(model).load(path)


def register(problem: str, name: str, factory: Callable) -> None:
    ESTIMATORS.setdefault(problem, {})[name] = factory
