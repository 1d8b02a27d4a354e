"""Near-duplicate groups by SimHash and multi-index hashing.

A fingerprint is cut into two halves of 32 bits. Fingerprints that differ in at most three
bits differ in at most one bit in one of the halves, so every fingerprint looks its halves
up in a table of halves with zero or one bit changed (a small Hamming ball), and the
matches are verified on the full distance. Of two halves that differ in one bit, the one
with the 0 does the looking up, so a pair is found from one side.

Rows with equal fingerprints are one node. A half that very many different fingerprints
share would give all pairs among them; for those fingerprints the ball is spelled out
over all 64 bits and matches are exact, so the work stays in proportion to their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.graph import components

from .common import checkpoint, few, hot_join, hot_keys, modest_batches, row_ids


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of the ``size``-word shingles, words split at ASCII white space and
    A-Z lower-cased, space-joined, repeats included. Fewer words: the whole sequence.
    Null or no word: an empty array."""
    if not isinstance(text, str):
        return np.zeros(0, "u8")
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, "u8")
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([h(joined, 42)], "u8")
    ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-size] + 1)).tolist()
    return np.fromiter((h(joined[a:b], 42) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)), "u8", len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; no hashes give 0."""
    ones = np.zeros(64, "i8")
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8")
        ones += np.unpackbits(part.view("u1")).reshape(-1, 64).sum(0, dtype="i8")
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, *, text: str = "text", shingle: int = 3):
    """Column of 64-bit fingerprints (as signed longs) of whole texts."""

    modest_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            made = np.array([fingerprint(shingle_hashes(t, shingle)) for t in texts], "u8")
            yield pd.Series(made.view("i8"))

    return simhash(F.col(text))


def _half(fp, which: int):
    return F.shiftrightunsigned(fp, 32) if which == 0 else fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _distance(a, b):
    return F.bit_count(a.bitwiseXOR(b))


def links(nodes: DataFrame, *, radius: int = 2, hot: int = 1000) -> DataFrame:
    """Pairs ``a, b`` (a != b, each pair once) of the distinct longs in ``nodes.fp`` that
    differ in 1 to ``radius`` bits; ``radius`` is 3 at most. Halves shared by over ``hot``
    fingerprints take the exact ball; the result does not depend on ``hot``."""
    if not 1 <= radius <= 3:
        raise ValueError("radius: 1 to 3")
    fp = F.col("fp")
    halves = nodes.select("fp", F.explode(F.array(*[F.struct(F.lit(i).cast("byte").alias("seg"), _half(fp, i).alias("half")) for i in (0, 1)])).alias("x")).select("fp", "x.seg", "x.half")
    crowds = checkpoint(halves.groupBy("seg", "half").count().where(F.col("count") > hot).select("seg", "half"))
    flips = F.array(F.lit(-1), *[F.lit(i) for i in range(32)])
    balls = (
        halves.select("fp", "seg", "half", F.explode(flips).alias("bit"))
        .where("bit < 0 or (shiftrightunsigned(half, bit) & 1) = 0")
        .select("fp", "seg", F.when(F.col("bit") < 0, F.col("half")).otherwise(F.col("half").bitwiseOR(F.expr("shiftleft(1L, bit)"))).alias("half"), F.col("bit").alias("bit"))
    )
    # A half can be crowded; the probes into it and its own rows are left to the exact ball.
    table = halves.withColumnRenamed("fp", "other")
    if crowded := not crowds.isEmpty():
        balls = balls.join(crowds, ["seg", "half"], "left_anti")
        table = table.join(crowds, ["seg", "half"], "left_anti")
    found = balls.join(table, ["seg", "half"]).where((F.col("bit") >= 0) | (F.col("fp") < F.col("other")))
    found = found.where(_distance(F.col("fp"), F.col("other")).between(1, radius)).select("fp", "other")
    if crowded:
        found = found.unionByName(_exact_ball(nodes, halves, crowds, radius))
    pair = found.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b"))
    return pair.distinct()


def _exact_ball(nodes: DataFrame, halves: DataFrame, crowds: DataFrame, radius: int) -> DataFrame:
    """Pairs of which both sides have, in one segment, a half at most one bit from a crowded
    one. Each such fingerprint is looked up under all its changes of up to ``radius`` bits."""
    flips = F.array(F.lit(-1), *[F.lit(i) for i in range(32)])
    near = crowds.select("seg", F.explode(F.transform(flips, lambda i: F.when(i < 0, F.col("half")).otherwise(F.col("half").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))).alias("half")).distinct()
    probing = checkpoint(halves.join(near, ["seg", "half"], "left_semi").select("fp").distinct())

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = np.uint64(1) << np.arange(64, dtype="u8")
        masks = [one]
        for _ in range(radius - 1):
            wider = (masks[-1][:, None] | one[None, :]).ravel()
            masks.append(np.setdiff1d(wider, np.concatenate([*masks, [np.uint64(0)]])))
        masks = np.concatenate(masks)
        for batch in batches:
            for at in range(0, len(batch), 256):
                fps = batch["fp"].to_numpy()[at : at + 256].view("u8")
                other = fps[:, None] ^ masks[None, :]
                i, j = np.nonzero(other.view("i8") > fps[:, None].view("i8"))
                yield pd.DataFrame({"fp": fps[i].view("i8"), "other": other[i, j].view("i8")})

    return probing.mapInPandas(spell, "fp long, other long").join(nodes.select(F.col("fp").alias("other")), "other", "left_semi")


def simhash_groups(docs: DataFrame, *, text: str = "text", key: str = "doc_id", shingle: int = 3, radius: int = 2, hot: int = 1000) -> DataFrame:
    """``key, fingerprint, component_id``: one row per row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits. Rows whose fingerprints differ in at most
    ``radius`` bits are linked, and ``component_id`` is the smallest key that can be
    reached, the own one included. Text without a word (null, empty, blank) has fingerprint
    zero and links like any other. Repeated rows stay. Null keys take part; a component
    of null keys only has a null id. Texts of any length are hashed whole. Other columns are
    ignored, whatever their names. An empty table gives an empty result.
    """
    prints = checkpoint(docs.select(F.col(key).alias("k"), fingerprints(docs, text=text, shingle=shingle).alias("fp")))
    nodes = checkpoint(prints.groupBy("fp").agg(F.min("k").alias("least"), F.count("*").alias("n")))
    found = components(links(nodes, radius=radius, hot=hot))
    roots = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = checkpoint(roots.select("fp", "root").join(ids, "root").select("fp", "component_id"))
    rows = hot_join(prints, named, ["fp"], hot_keys(nodes, ["fp"]))  # empty texts, say, all have one fingerprint
    return rows.select(F.col("k").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _pairs_within(x: str, y: str, similarity: float):
    """Condition on two rows (n distinct shingles, position of a common one in the order of
    all shingles) under which their sets can still be as similar as asked, if that is the
    first common one: what follows it in either set must hold the overlap that this takes."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    overlap = similarity / (1 + similarity) * (n + m) - 1e-6
    return F.least(n - F.col(f"{x}.pos"), m - F.col(f"{y}.pos")) >= overlap


def near_copies(docs: DataFrame, *, text: str = "text", key: str = "doc_id", shingle: int = 5, similarity: float = 0.8, radius: int = 2, sample: int = 8_000_000, rounds: int = 4, dense: int = 20, least_gain: float = 0.005, crowd: int = 1000, busiest: int = 16) -> DataFrame:
    """``row_a, row_b, key, group, first``: every row with a 128-bit hash of its key and text, the
    key of the row that stands for its near-duplicate group (the smallest, nulls last), and
    whether it is that row (or repeats it).

    Equal sets of ``shingle``-word shingles are one class (texts without a word are one).
    Classes are linked if the Jaccard similarity of their sets is at least ``similarity``,
    computed exactly, and groups are the connected components of all links.

    The first candidates are classes whose SimHash fingerprints differ in at most ``radius``
    bits, by multi-index hashing. A fingerprint does not imply the similarity, nor the other way
    round, so prefix filtering completes them: shingles are put in one order, rare ones
    first, and two similar sets have a shingle in common among the first n - similarity * n +
    1 of both. The order counts shingles in about ``sample`` of them, without bearing on the result.

    What is linked is one component, whose members need not be compared with each other.
    While over ``dense`` pairs per class are left, in up to ``rounds`` rounds the classes under a
    shingle of over ``busiest`` are compared with one of them; rounds that link under ``least_gain``
    of the classes are the last. Then all pairs of different components are compared, shingles of
    over ``crowd`` classes in parts. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    modest_batches(spark)
    t = F.col(text)
    chars = docs.agg(F.sum(F.length(t))).first()[0] or 0
    share = min(1.0, sample * 6 / max(1, chars))

    @F.pandas_udf("cls binary, fp long, some array<bigint>")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            classes, prints, some = [], [], []
            for x in texts:
                s = np.unique(shingle_hashes(x, shingle))
                classes.append(xxhash.xxh3_128_digest(s.tobytes()))
                prints.append(fingerprint(s))
                some.append(s.view("i8") if int.from_bytes(classes[-1][:4], "big") < share * 2**32 else None)
            yield pd.DataFrame({"cls": classes, "fp": np.array(prints, "u8").view("i8"), "some": some})

    @F.pandas_udf("binary")
    def shingles(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: np.unique(shingle_hashes(x, shingle)).tobytes())

    @F.pandas_udf("double")
    def jaccard(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x, y):
            x, y = np.frombuffer(x, "u8"), np.frombuffer(y, "u8")
            both = len(np.intersect1d(x, y, assume_unique=True))
            return both / max(1, len(x) + len(y) - both)

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="f8")

    row_a, row_b = row_ids(F.col(key), t)
    rows = docs.select(row_a.alias("ra"), row_b.alias("rb"), F.col(key).alias("k"), t.alias("t"))
    made = checkpoint(rows.select("ra", "rb", "k", digest("t").alias("x")).select("ra", "rb", "k", "x.*"))
    place = F.struct(F.col("k").isNull().alias("none"), "k", "ra", "rb")
    grouped = made.groupBy("cls").agg(F.min(place).alias("rep"), F.first("fp").alias("fp"), F.first("some").alias("some"), F.count("*").alias("copies"))
    classes = checkpoint(grouped.select(F.monotonically_increasing_id().alias("node"), "cls", "rep", "rep.ra", "rep.rb", "fp", "some", "copies"))
    often = classes.select(F.explode("some").alias("h")).groupBy("h").count().where("count > 2").orderBy(F.desc("count"), "h").limit(500_000).toPandas()
    often = often.assign(h=often["h"].to_numpy("i8").view("u8")).sort_values("h")
    counted = spark.sparkContext.broadcast((often["h"].to_numpy("u8"), often["count"].to_numpy("i8")))

    @F.pandas_udf("n int, spread binary, prefix array<bigint>")
    def prefixes(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known, counts = counted.value
        for texts in batches:
            sizes, spreads, made = [], [], []
            for x in texts:
                s = np.unique(shingle_hashes(x, shingle))
                spreads.append(np.bincount(s >> np.uint64(56), minlength=256).clip(max=255).astype("u1").tobytes())
                weight = np.zeros(len(s), "i8")
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    weight = np.where(known[at] == s, counts[at], 0)
                sizes.append(len(s))
                made.append(s[np.lexsort((s, weight))][: len(s) - math.ceil(similarity * len(s) - 1e-6) + 1].view("i8"))
            yield pd.DataFrame({"n": np.array(sizes, "i4"), "spread": spreads, "prefix": made})

    @F.pandas_udf("long")
    def apart(a: pd.Series, b: pd.Series) -> pd.Series:
        a, b = (np.frombuffer(b"".join(x), "u1").reshape(-1, 256).astype("i2") for x in (a, b))
        return pd.Series(np.abs(a - b).sum(1, dtype="i8"))

    def of_nodes(nodes: DataFrame) -> DataFrame:
        """``node, t`` of the texts that stand for the nodes; equal rows can repeat."""
        return rows.join(few(nodes.select("node", "ra", "rb"), 1_000_000), ["ra", "rb"]).select("node", "t")

    def hopeful(pairs: DataFrame) -> DataFrame:
        """Without the pairs whose sets differ in more shingles than the similarity allows, as seen
        by how many shingles have each of 256 leading bytes: a bound that never drops a link."""
        side = lambda x: short.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("spread").alias(f"s{x}"))
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        allowed = (F.col("na") + F.col("nb")) * ((1 - similarity) / (1 + similarity)) + 1e-6
        return checkpoint(both.where(apart("sa", "sb") <= allowed).select("a", "b"))

    def verified(pairs: DataFrame) -> DataFrame:
        wanted = checkpoint(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        chosen = of_nodes(checkpoint(classes.select("node", "ra", "rb").join(few(wanted), "node", "left_semi")))
        sets = checkpoint(chosen.select("node", shingles("t").alias("s")).dropDuplicates(["node"]))
        both = pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
        return checkpoint(both.where(jaccard("sa", "sb") >= similarity).select("a", "b"))

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))

    def rooted(keys: DataFrame) -> DataFrame:
        return keys.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    single = checkpoint(of_nodes(classes).select("node", prefixes("t").alias("x")).select("node", "x.*"))
    short = single.dropDuplicates(["node"]) if not made.groupBy("ra", "rb").count().where("count > 1").isEmpty() else single

    # Fingerprints: classes of the same one meet the first of them, and so do those of linked ones.
    heads = checkpoint(classes.groupBy("fp").agg(F.min("node").alias("head")))
    same = classes.select("fp", "node").join(heads, "fp").where("node <> head").select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"))
    near = links(heads.select("fp"), radius=radius)
    near = near.join(heads.select(F.col("fp").alias("a"), F.col("head").alias("x")), "a").join(heads.select(F.col("fp").alias("b"), F.col("head").alias("y")), "b")
    edges = verified(hopeful(same.unionByName(near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))))
    roots = checkpoint(components(edges))

    shared = short.select("node", F.explode("prefix").alias("h")).groupBy("h").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    keys = checkpoint(short.select("node", "n", F.posexplode("prefix").alias("pos", "h")).join(shared.where("low <> high").select("h"), "h"))
    n_classes = classes.count()
    me = F.struct("node", "n", "pos", "root")

    def mixed(keys: DataFrame) -> DataFrame:
        """Shingles of classes of different components, how many classes and open pairs each has."""
        of_root = keys.groupBy("h", "root").agg(F.count("*").cast("double").alias("m"))
        of_key = of_root.groupBy("h").agg(F.sum("m").alias("all"), F.sum(F.col("m") * F.col("m")).alias("same"), F.count("*").alias("roots"))
        return checkpoint(of_key.where("roots > 1").select("h", F.col("all").cast("long").alias("all"), ((F.col("all") * F.col("all") - F.col("same")) / 2).alias("open")))

    def pairs_of(some: DataFrame) -> float:
        return some.agg(F.sum("open")).first()[0] or 0

    # All keys get their roots once. Rounds are for the shingles of very many classes, a small part of
    # the keys; an older root only means that a pair that is linked by now is compared again.
    left = checkpoint(rooted(keys))
    of_key = mixed(left)
    left = checkpoint(left.join(of_key.select("h", "all"), "h"))
    light, busy = left.where(F.col("all") <= busiest), left.where(F.col("all") > busiest)
    spare, n_open = pairs_of(of_key.where(F.col("all") <= busiest)), pairs_of(of_key)
    for n in range(rounds):
        if n_open <= dense * n_classes or n_open == spare:
            break
        pivots = busy.groupBy("h").agg(F.min_by(me, F.xxhash64("node", F.lit(n))).alias("x"))
        met = busy.select("h", me.alias("y")).join(pivots, "h").where((F.col("x.root") != F.col("y.root")) & _pairs_within("x", "y", similarity))
        met = met.groupBy(F.col("y.node").alias("y"), F.col("x.node").alias("x")).count()
        best = met.withColumn("r", F.row_number().over(Window.partitionBy("y").orderBy(F.desc("count"), "x"))).where("r <= 2")
        found = verified(hopeful(best.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()))
        edges = edges.unionByName(found)
        roots = checkpoint(components(edges))
        busy = checkpoint(rooted(busy.drop("root")))
        of_key = mixed(busy)
        busy = checkpoint(busy.join(of_key.select("h"), "h", "left_semi"))
        n_open = spare + pairs_of(of_key)
        if found.count() < least_gain * n_classes:
            break
    # The smaller set of a pair meets the larger one in a prefix that is shorter still.
    left = light.unionByName(busy.select(*light.columns)).withColumn("parts", F.ceil(F.col("all") / crowd).cast("int"))
    index = left.where(F.col("pos") <= F.col("n") - F.ceil(2 * similarity / (1 + similarity) * F.col("n") - 1e-6))
    index = index.select("h", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"), me.alias("x"))
    probe = left.select("h", me.alias("y"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    smaller = F.struct("x.n", "x.node") < F.struct("y.n", "y.node")
    close = index.alias("i").join(probe.alias("p"), (F.col("i.h") == F.col("p.h")) & (F.col("i.part") == F.col("p.part")) & (F.col("x.root") != F.col("y.root")) & smaller & _pairs_within("x", "y", similarity))
    edges = edges.unionByName(verified(hopeful(ordered(close).distinct())))
    roots = checkpoint(components(edges))
    whole = rooted(classes.select("node", "cls", "rep", "copies"))
    firsts = whole.groupBy("root").agg(F.min("rep").alias("best"))
    named = checkpoint(whole.select("cls", "root", "copies").join(firsts, "root").select("cls", "best", "copies"))
    first = (F.col("ra") == F.col("best.ra")) & (F.col("rb") == F.col("best.rb"))
    in_groups = hot_join(made.select("ra", "rb", "k", "cls"), named.drop("copies"), ["cls"], hot_keys(named, ["cls"], "copies"))
    return in_groups.select(F.col("ra").alias("row_a"), F.col("rb").alias("row_b"), F.col("k").alias(key), F.col("best.k").alias("group"), first.alias("first"))


def drop_near_copies(docs: DataFrame, *, text: str = "text", key: str = "doc_id", **settings) -> DataFrame:
    """``docs`` without all but one row of each group of ``near_copies``: the row with the
    smallest key stays, one without a key if none has one. Of equal rows one stays. Rows of
    the same key with different texts are different rows. Null and empty texts are one group;
    texts of any length are compared whole; all columns pass through, whatever their names;
    an empty table gives an empty result."""
    named = checkpoint(near_copies(docs, text=text, key=key, **settings).select(F.col("row_a").alias("_mr_a"), F.col("row_b").alias("_mr_b"), "first"))
    row = ["_mr_a", "_mr_b"]
    a, b = row_ids(F.col(key), F.col(text))
    tagged = docs.withColumns({"_mr_a": a, "_mr_b": b})
    kept = tagged.join(few(checkpoint(named.where(~F.col("first")).select(*row).distinct())), row, "left_anti")
    again = checkpoint(named.where("first").groupBy(*row).count().where("count > 1").select(*row))
    if again.isEmpty():
        return kept.select(*docs.columns)
    return kept.join(again, row, "left_anti").unionByName(kept.join(again, row, "left_semi").dropDuplicates(row)).select(*docs.columns)
