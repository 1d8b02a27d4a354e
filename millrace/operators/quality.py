"""Cluster quality: silhouette, Davies-Bouldin, Calinski-Harabasz, adjusted Rand, profiles."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.sources.scratch import checkpoint, hot_join, hot_keys


def _long(points: DataFrame, label: str, keep: Sequence[str] = ()) -> DataFrame:
    return points.select(*keep, F.col(label).alias("label"), F.posexplode(F.col("features").cast("array<double>")).alias("dim", "v"))


def cluster_means(points: DataFrame, label: str = "label") -> DataFrame:
    """``label, n, center`` with the mean of every dimension."""
    dims = _long(points, label).groupBy("label", "dim").agg(F.avg("v").alias("m"), F.count("*").alias("n"))
    return dims.groupBy("label").agg(F.max("n").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("dim", "m"))), lambda x: x["m"]).alias("center"))


def _distance(a: str, b: str):
    return F.sqrt(_squares(a, b))


def _squares(a: str, b: str):
    return F.aggregate(F.zip_with(F.col(a).cast("array<double>"), b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v)


def against_all(data: DataFrame, schema: str, partial, combine, finish, *, block_bytes: int = 8 << 20, least: int = 512) -> DataFrame:
    """Every point against every point, in blocks that Spark deals out. ``data`` has ``id``
    (long, unique), ``code`` (array of longs) and ``features``. ``partial(x, y, codes of x, codes of y)`` gives
    two arrays, with one row per point of x and of y, ``combine`` makes one of several such arrays, and
    ``finish(ids, codes, array)`` the rows of the result.

    Two blocks meet once, for both of them, so blocks are as large as ``block_bytes`` and
    the number of cores allow, but of ``least`` points or more; inside a task 256 points of one
    are compared with 1,024 of the other at a time. Parts are combined in groups of 64 before a block's are all put together."""
    spark = data.sparkSession
    facts = data.agg(F.count("*").alias("n"), F.max(F.size("features")).alias("d")).first()
    cores = spark.sparkContext.defaultParallelism
    points = min(block_bytes // (8 * max(1, facts["d"] or 1)), -(-facts["n"] // max(1, math.isqrt(4 * cores))))
    n = max(1, -(-facts["n"] // max(least, points)))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        x, codes = np.stack(part["features"].to_numpy()).astype("f8"), np.stack(part["code"].to_numpy()).astype("i8")
        return pd.DataFrame({"b": [part["b"].iloc[0]], "ids": [part["id"].to_numpy("i8").tobytes()], "codes": [codes.tobytes()], "x": [x.tobytes()], "n": [len(part)]})

    def met(x, y, cx, cy, same: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """The arrays of two blocks, put together from small tiles, which stay in the cache."""
        mine, theirs = [], [None] * len(range(0, len(y), 1024))
        for i in range(0, len(x), 256):
            row = None
            for k, j in enumerate(range(0, len(y), 1024)):
                p, q = partial(x[i : i + 256], y[j : j + 1024], cx[i : i + 256], cy[j : j + 1024])
                row = p if row is None else combine([row, p])
                if not same:
                    theirs[k] = q if theirs[k] is None else combine([theirs[k], q])
            mine.append(row)
        return np.concatenate(mine), None if same else np.concatenate(theirs)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                r = {name: batch.column(i)[at].as_py() for i, name in enumerate(batch.schema.names)}
                x, y = np.frombuffer(r["x"]).reshape(r["n_x"], -1), np.frombuffer(r["y"]).reshape(r["n_y"], -1)
                cx, cy = np.frombuffer(r["codes_x"], "i8").reshape(r["n_x"], -1), np.frombuffer(r["codes_y"], "i8").reshape(r["n_y"], -1)
                for b, c, k, made in zip((r["b"], r["c"]), (r["c"], r["b"]), (r["n_x"], r["n_y"]), met(x, y, cx, cy, r["b"] == r["c"]), strict=True):
                    if made is not None:
                        yield pa.RecordBatch.from_pydict({"b": pa.array([b], pa.int32()), "c": pa.array([c], pa.int32()), "n_x": pa.array([k], pa.int32()), "part": pa.array([np.ascontiguousarray(made, "f8").tobytes()], pa.binary())})

    def arrays(rows: pd.DataFrame) -> np.ndarray:
        return combine([np.frombuffer(p).reshape(rows["n_x"].iloc[0], -1) for p in rows["part"]])

    def some(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"b": rows["b"].iloc[:1], "n_x": rows["n_x"].iloc[:1], "part": [np.ascontiguousarray(arrays(rows), "f8").tobytes()]})

    def all_of(key, rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(block["ids"].iloc[0], "i8")
        return finish(ids, np.frombuffer(block["codes"].iloc[0], "i8").reshape(len(ids), -1), arrays(rows))

    dealt = data.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    blocks = checkpoint(dealt.groupBy("b").applyInPandas(pack, "b int, ids binary, codes binary, x binary, n int"))
    mine = blocks.select("b", F.explode(F.sequence(F.col("b"), F.lit(n - 1))).alias("c"), F.col("n").alias("n_x"), F.col("codes").alias("codes_x"), "x")
    others = blocks.select(F.explode(F.sequence(F.lit(0), F.col("b"))).alias("b"), F.col("b").alias("c"), F.col("n").alias("n_y"), F.col("codes").alias("codes_y"), F.col("x").alias("y"))
    # Few bytes a pair, but work: each in a task of its own, as far as there are as many tasks.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(n * (n + 1) // 2, 16 * cores))
    pairs = mine.repartition(tasks, "b", "c").join(others.repartition(tasks, "b", "c").hint("shuffle_merge"), ["b", "c"])
    parts = checkpoint(pairs.mapInArrow(compare, "b int, c int, n_x int, part binary"))
    parts = parts.groupBy("b", F.floor(F.col("c") / 64).alias("part_of")).applyInPandas(some, "b int, n_x int, part binary")
    return parts.groupBy("b").cogroup(blocks.select("b", "ids", "codes").groupBy("b")).applyInPandas(all_of, schema)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of x to those of y, by a product of matrices; where that loses
    digits, because points are much nearer to each other than to the mean, by their differences."""
    middle = y.mean(0)
    x, y = x - middle, y - middle
    norms = (x * x).sum(1)[:, None] + (y * y).sum(1)
    d = norms - 2.0 * (x @ y.T)
    i, j = np.nonzero(d <= 1e-6 * norms)
    for at in range(0, len(i), 1 << 14):
        part = slice(at, at + (1 << 14))
        d[i[part], j[part]] = ((x[i[part]] - y[j[part]]) ** 2).sum(1)
    return np.sqrt(d, out=d)


def silhouette(points: DataFrame, label: str = "label", *, key: str | None = None, sample: int | None = None, seed: int = 42) -> float | None:
    """Mean Euclidean silhouette of all points, or of a sample of at most ``sample`` if asked
    (quadratic in the points); a point alone in its cluster scores 0. Points are compared in
    blocks. None for fewer than two clusters."""
    return silhouettes(points, [label], key=key, sample=sample, seed=seed)[0]


#: Clusters up to which sums by cluster are a product of matrices.
FEW_SUMS = 64


def silhouettes(points: DataFrame, labels: Sequence[str], *, key: str | None = None, sample: int | None = None, seed: int = 42) -> list[float | None]:
    """The ``silhouette`` of several label columns, from one comparison of all points."""
    if sample is not None:
        points = points.orderBy(F.xxhash64(key or "features", F.lit(seed)), F.col(key or "features")).limit(sample)
    data = checkpoint(points.select(F.monotonically_increasing_id().alias("id"), F.col("features").cast("array<double>").alias("features"), *[F.col(c).alias(f"l{i}") for i, c in enumerate(labels)]))
    counts = []
    for i in range(len(labels)):
        sizes = data.groupBy(f"l{i}").count().orderBy(f"l{i}").collect()
        names = points.sparkSession.createDataFrame([(r[0], k) for k, r in enumerate(sizes)], data.select(F.col(f"l{i}").alias("name"), F.lit(0).cast("long").alias(f"c{i}")).schema) if len(sizes) > 1 else None
        counts.append(np.array([r["count"] for r in sizes]))
        if names is not None:
            data = data.join(F.broadcast(names), F.col(f"l{i}").eqNullSafe(F.col("name"))).drop("name")
    used = [i for i, n in enumerate(counts) if len(n) > 1]
    if not used:
        return [None] * len(labels)
    sizes = [counts[i] for i in used]
    data = data.select("id", F.array(*[f"c{i}" for i in used]).alias("code"), "features")

    def sums(d: np.ndarray, codes: np.ndarray) -> np.ndarray:
        made = []
        for n, c in zip(sizes, codes.T, strict=True):
            made.append(d @ (c[:, None] == np.arange(len(n))).astype("f8") if len(n) <= FEW_SUMS else np.stack([np.bincount(c, row, len(n)) for row in d]))
        return np.concatenate(made, axis=1)

    def partial(x, y, cx, cy):
        d = distances(x, y)
        return sums(d, cy), sums(d.T, cx)

    def finish(ids, codes, whole):
        at, start, made = np.arange(len(ids)), 0, {}
        for i, n, c in zip(used, sizes, codes.T, strict=True):
            own = whole[:, start : start + len(n)]
            a = own[at, c] / np.maximum(n[c] - 1, 1)
            means = own / n
            means[at, c] = np.inf
            b = means.min(1)
            most = np.maximum(a, b)
            made[f"s{i}"] = np.where((n[c] > 1) & (most > 0), (b - a) / np.where(most > 0, most, 1), 0.0)
            start += len(n)
        return pd.DataFrame(made)

    found = against_all(data, ", ".join(f"s{i} double" for i in used), partial, lambda parts: np.sum(parts, 0), finish).agg(*[F.avg(f"s{i}").alias(f"s{i}") for i in used]).first().asDict()
    return [found.get(f"s{i}") for i in range(len(labels))]


def silhouette_squared(points: DataFrame, label: str = "label") -> float:
    """Silhouette by squared Euclidean distance over all points, in linear time."""
    data = points.select(F.col(label).cast("int").alias("prediction"), array_to_vector(F.col("features").cast("array<double>")).alias("features"))
    return ClusteringEvaluator().evaluate(data)


#: Clusters up to which their means are broadcast, and compared with each other in one join.
FEW_CLUSTERS = 2000


def davies_bouldin_table(points: DataFrame, label: str = "label") -> DataFrame:
    """Mean over clusters of the worst (s_i + s_j) / d_ij; lower is better. Means of many clusters meet the
    points in parts where a cluster is large, and each other in blocks."""
    means = checkpoint(cluster_means(points, label).where("label is not null"))
    few = means.count() <= FEW_CLUSTERS
    near = points.select(F.col(label).alias("label"), "features").where("label is not null")
    met = near.join(F.broadcast(means), "label") if few else hot_join(near, means.drop("n"), ["label"], hot_keys(means, ["label"]))
    # With the means known, the sum of distances is the only thing that is shuffled.
    spread = checkpoint(met.groupBy("label").agg(F.avg(_distance("features", "center")).alias("s")).join(means, "label"))
    if few:
        a, b = spread.select(F.col("label").alias("i"), F.col("s").alias("si"), F.col("center").alias("ci")), spread.select(F.col("label").alias("j"), F.col("s").alias("sj"), F.col("center").alias("cj"))
        ratios = a.join(F.broadcast(b), F.col("i") != F.col("j")).select("i", ((F.col("si") + F.col("sj")) / _distance("ci", "cj")).alias("r"))
        return ratios.groupBy("i").agg(F.max("r").alias("r")).agg(F.avg("r").alias("davies_bouldin"))
    number = F.monotonically_increasing_id()
    data = checkpoint(spread.select(number.alias("id"), F.array(F.lit(0).cast("long")).alias("code"), F.concat("center", F.array("s", number.cast("double"))).alias("features")))

    def partial(x, y, _cx, _cy):
        with np.errstate(divide="ignore", invalid="ignore"):
            r = (x[:, -2:-1] + y[:, -2]) / distances(x[:, :-2], y[:, :-2])
        r = np.where(x[:, -1:] == y[:, -1], -np.inf, r)
        return r.max(1)[:, None], r.max(0)[:, None]

    found = against_all(data, "r double", partial, lambda parts: np.max(parts, 0), lambda ids, codes, r: pd.DataFrame({"r": r[:, 0]}))
    return found.agg(F.avg("r").alias("davies_bouldin"))


def calinski_harabasz_table(points: DataFrame, label: str = "label") -> DataFrame:
    """Between over within sums of squares, each by its degrees of freedom; 1 if within is 0."""
    long = _long(points, label)
    dims = long.groupBy("label", "dim").agg(F.avg("v").alias("m"), F.count("*").alias("n"), F.var_pop("v").alias("var"))
    whole = long.groupBy("dim").agg(F.avg("v").alias("g"))
    sums = dims.join(F.broadcast(whole), "dim").agg(F.sum(F.col("n") * (F.col("m") - F.col("g")) ** 2).alias("b"), F.sum(F.col("n") * F.col("var")).alias("w"), F.countDistinct("label").alias("k"), F.sum(F.when(F.col("dim") == 0, F.col("n"))).alias("n"))
    score = F.when(F.col("w") == 0, 1.0).otherwise((F.col("b") / (F.col("k") - 1)) / (F.col("w") / (F.col("n") - F.col("k"))))
    return sums.select(score.alias("calinski_harabasz"))


def adjusted_rand_table(labels: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two label columns of the same rows."""
    cells = labels.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").cast("double").alias("n"))
    two = lambda n: n * (n - 1) / 2
    rows, cols = cells.groupBy("a").agg(F.sum("n").alias("n")), cells.groupBy("b").agg(F.sum("n").alias("n"))
    total = lambda df, name: df.agg(F.sum(two(F.col("n"))).alias(name), F.sum("n").alias(f"{name}_n"))
    row = total(cells, "c").crossJoin(F.broadcast(total(rows, "r"))).crossJoin(F.broadcast(total(cols, "s")))
    expected = F.col("r") * F.col("s") / two(F.col("c_n"))
    most = (F.col("r") + F.col("s")) / 2
    return row.select(F.when(most == expected, 1.0).otherwise((F.col("c") - expected) / (most - expected)).alias("adjusted_rand"))


def davies_bouldin(points: DataFrame, label: str = "label") -> float:
    return davies_bouldin_table(points, label).first()[0]


def calinski_harabasz(points: DataFrame, label: str = "label") -> float:
    return calinski_harabasz_table(points, label).first()[0]


METRICS = {"silhouette": silhouette, "silhouette_squared": silhouette_squared, "davies_bouldin": davies_bouldin, "calinski_harabasz": calinski_harabasz}


def cluster_profile(points: DataFrame, label: str = "label", *, top: int = 10) -> DataFrame:
    """Per cluster its size, share in percent and the ``top`` dimensions of the mean by absolute value."""
    means = cluster_means(points, label)
    total = means.agg(F.sum("n").alias("_total"))  # one row
    share = F.round(100.0 * F.col("n") / F.col("_total"), 4)
    dims = means.crossJoin(F.broadcast(total)).withColumn("pct", share).select("label", "n", "pct", F.posexplode("center").alias("feature_index", "value"))
    order = Window.partitionBy("label").orderBy(F.desc(F.abs("value")), "feature_index")
    return dims.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("value", F.round("value", 6))


def evaluate(points: DataFrame, labelings: Mapping[str, str], metrics: Sequence[str] = ("silhouette", "davies_bouldin", "calinski_harabasz"), truth: str | None = None) -> DataFrame:
    """``model, metric, value`` for each label column in ``labelings`` (name -> column)."""
    rows = []
    compared = dict(zip(labelings, silhouettes(points, list(labelings.values())), strict=True)) if "silhouette" in metrics and labelings else {}
    for model, column in labelings.items():
        rows += [(model, m, compared[model] if m == "silhouette" else METRICS[m](points, column)) for m in metrics]
        if truth:
            rows.append((model, "adjusted_rand", adjusted_rand_table(points, column, truth).first()[0]))
    return points.sparkSession.createDataFrame(rows, "model string, metric string, value double")


def metrics_summary(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """Model by metric."""
    return metrics.groupBy("model").pivot("metric", list(names)).agg(F.first("value"))
