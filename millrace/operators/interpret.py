"""Reading clusters: descriptions, agreement with known labels, readiness, fingerprints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.profile import full_grid


def describe_clusters(profile: DataFrame, names: Sequence[str], *, top: int = 3) -> DataFrame:
    """One line per cluster from a ``cluster_profile``: its ``top`` features by name and value."""
    if profile.isEmpty():
        raise ValueError("the profile is empty")
    known = F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")
    name = F.coalesce(F.get(known, F.col("feature_index")), F.concat(F.lit("unknown_feature_"), F.col("feature_index").cast("string")))
    parts = profile.where(F.col("rank") <= top).select("label", "n", "pct", "rank", F.concat(name, F.lit("="), F.format_string("%.3f", "value")).alias("part"))
    lines = parts.groupBy("label", "n", "pct").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "part"))), lambda x: x["part"]), ", ").alias("features"))
    return lines.withColumn("description", F.concat(F.lit("cluster "), F.col("label").cast("string"), F.lit(": "), "features"))


def knowledge_base(profiles: Mapping[str, DataFrame]) -> DataFrame:
    """All profiles in one table."""
    made = [p.withColumn("model", F.lit(m)) for m, p in profiles.items()]
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    return out


def confusion(df: DataFrame, truth: str, cluster: str, *, normalize: str | None = None, collapse: int | None = None) -> DataFrame:
    """``truth, cluster, n, value``: counts, or shares within a cluster ("pred"), a class ("true")
    or all; with ``collapse`` the clusters beyond the largest are one, numbered -1."""
    rows = df.where(F.col(truth).isNotNull() & F.col(cluster).isNotNull()).groupBy(F.col(truth).alias("truth"), F.col(cluster).alias("cluster")).agg(F.count("*").alias("n"))
    if collapse is not None:
        sizes = rows.groupBy("cluster").agg(F.sum("n").alias("s"))
        largest = sizes.orderBy(F.desc("s"), "cluster").limit(collapse).select("cluster", F.lit(True).alias("_top"))
        folded = F.when(F.col("_top"), F.col("cluster")).otherwise(F.lit(-1))
        rows = rows.join(largest, "cluster", "left").groupBy("truth", folded.alias("cluster")).agg(F.sum("n").alias("n"))
    over = {None: None, "pred": ["cluster"], "true": ["truth"], "all": []}[normalize]
    value = F.col("n").cast("double") if over is None else F.col("n") / F.sum("n").over(Window.partitionBy(*over))
    return rows.withColumn("value", F.round(value, 6))


def accuracy(table: DataFrame) -> DataFrame:
    """Diagonal over total of raw counts."""
    return table.agg(F.round(F.sum(F.when(F.col("truth") == F.col("cluster"), F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("accuracy"))


def alignment_share(df: DataFrame, truth: str, cluster: str) -> DataFrame:
    """Share of each cluster in each class, absent pairs 0 (``profile.full_grid``)."""
    full = full_grid(confusion(df, truth, cluster).select("truth", "cluster", "n"), "truth", "cluster")
    return full.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("truth")), 6))


def fingerprint(df: DataFrame) -> DataFrame:
    """Rows and two order-free hashes of all their values; equal tables have equal ones."""
    h = F.xxhash64(*df.columns)
    return df.agg(F.count("*").alias("n_rows"), F.bit_xor(h).alias("hash_xor"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("hash_sum"))


def reproducible(first: DataFrame | None, second: DataFrame | None) -> bool:
    """Whether two runs gave the same table; a missing one fails."""
    return first is not None and second is not None and fingerprint(first).first() == fingerprint(second).first()


#: Limits of a deployment: metric, limit, whether larger is better.
LIMITS = (("adjusted_rand", 0.05, True), ("silhouette", 0.25, True), ("davies_bouldin", 1.5, False), ("calinski_harabasz", 500.0, True))


def readiness(metrics: DataFrame) -> DataFrame:
    """From ``model, metric, value``: the model with the best adjusted Rand index, its metrics
    against the limits, the barriers and the decision."""
    best = metrics.where("metric = 'adjusted_rand'").agg(F.max_by("model", F.struct("value", "model")).alias("winner"))
    rules = metrics.sparkSession.createDataFrame(LIMITS, "metric string, threshold double, larger boolean")
    own = metrics.join(F.broadcast(best), F.col("model") == F.col("winner")).join(F.broadcast(rules), "metric")
    passed = F.when(F.col("larger"), F.col("value") >= F.col("threshold")).otherwise(F.col("value") <= F.col("threshold"))
    judged = own.select("winner", "metric", "value", F.coalesce(passed, F.lit(False)).alias("passed"))
    return judged.groupBy("winner").agg(F.count_if("passed").alias("n_passed"), F.count_if(~F.col("passed")).alias("n_barriers"), F.array_join(F.sort_array(F.collect_list(F.when(~F.col("passed"), F.col("metric")))), ",").alias("barriers"), F.bool_and("passed").alias("ready"))
