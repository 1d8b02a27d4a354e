"""Benchmark decontamination: which short test items are contained in which documents.

Containment search with MinHash over size partitions, in DataFrame functions only. The
hash space is cut into as many bins as a size partition needs and a set is sketched by
the smallest hash in each of its bins (MinHash by one permutation). A document of x
shingles in k bins keeps an item's shingle with probability p = (1 - exp(-x/k)) / (x/k),
so an item with c shingles in the document is missed with probability (1 - p) ** c.
Documents are partitioned by size, items by size, and each pair of partitions takes the
fewest bins (a power of two) that hold the miss rate under ``miss``; items so small that
no bin count does are searched by all their hashes. Candidates are verified on the exact
shingles. Items of fewer words than a shingle are searched by the hash of all their words,
among the documents' shingles of that length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, few, hot_join, hot_keys, row_ids

#: Upper ends of the size partitions are powers of this.
STEP = 2
#: Size partitions there are; the last one has no upper end that a text could reach.
PARTITIONS = 24
#: This many bits stand for a bin per hash, taken where bins would drop under a tenth.
MOST_BITS = 60
#: Rows of a key table that are broadcast; more are joined by shuffle.
MAX_BROADCAST = 200_000


def normal_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null gives none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` worked out once, however often it is used."""
    return F.transform(F.array(value), then)[0]


def shingle_set(words: Column, size: int) -> Column:
    """Distinct hashes of the ``size``-word shingles; fewer words: empty."""

    def hashes(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(size)]))
        return F.when(F.size(w) >= size, F.array_distinct(each)).otherwise(F.array().cast("array<bigint>"))

    return let(words, hashes)


def size_class(n: Column) -> Column:
    """Size partition: n in [STEP ** c, STEP ** (c + 1))."""
    return F.least(F.lit(PARTITIONS - 1), F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / math.log(STEP) + 1e-9)).cast("int")


def sketch(hashes: Column, bits: Column) -> Column:
    """The smallest hash of each of 2 ** bits bins, or all hashes at MOST_BITS. Bins are
    ranges of the hash, so in a sorted array each begins where the leading bits change."""
    lead = lambda h: F.call_function("shiftrightunsigned", h, F.lit(64) - bits)
    first = lambda o: F.filter(o, lambda h, i: (i == 0) | (lead(h) != lead(F.get(o, i - 1))))
    return F.when(bits >= MOST_BITS, hashes).when(bits <= 0, F.slice(F.sort_array(hashes), 1, 1)).otherwise(let(F.sort_array(hashes), first))


def kept_share(load: float) -> float:
    """Probability that a shingle is the smallest of its bin, at ``load`` shingles a bin."""
    return (1 - math.exp(-load)) / load if load > 0 else 1.0


def bin_bits(largest: int, least_common: int, miss: float) -> int:
    """log2 of the bins for documents of up to ``largest`` shingles that share at least
    ``least_common`` with an item; MOST_BITS where each hash must be kept."""
    for bits in range(0, MOST_BITS):
        if kept_share(largest / 2**bits) > 0.9:
            break
        if (1 - kept_share(largest / 2**bits)) ** least_common <= miss:
            return bits
    return MOST_BITS


def contained(docs: DataFrame, items: DataFrame, *, text: str = "text", key: str = "doc_id", item: str = "item_id", item_text: str = "text", shingle: int = 5, threshold: float = 0.8, miss: float = 1e-6, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``key, item, n_item_shingles, n_common, containment`` of the pairs in which the
    document holds at least ``threshold`` of the item's distinct shingles.

    Words are lower-cased runs of letters and digits. An item of fewer words than a shingle
    is one shingle of its own length, found wherever these words follow each other. Items and
    documents without a word, with null text or a null key are in no pair. Repeated rows of
    one key count as one document (their shingles add up). Texts of any length are searched
    whole. Other columns are ignored, whatever their names. An empty table gives no pairs.
    The sketches of the items, and the keys of candidate documents, are broadcast up to
    ``max_broadcast`` rows and joined by shuffle beyond.
    """
    spark = docs.sparkSession
    asked = checkpoint(items.select(F.col(item).alias("item"), normal_words(F.col(item_text)).alias("w")).where("item is not null and size(w) > 0"))
    tests = asked.select("item", F.explode(shingle_set(F.col("w"), shingle)).alias("h"))
    tests = tests.distinct().groupBy("item").agg(F.collect_list("h").alias("s"), F.count("*").alias("q"))
    tests = checkpoint(tests.withColumn("icls", size_class(F.col("q"))))
    known = docs.where(F.col(key).isNotNull())
    short = _short_items(known.select(F.col(key).alias("doc"), F.col(text).alias("t")), asked.where(F.size("w") < shingle), max_broadcast)
    smallest = {r["icls"]: r["q"] for r in tests.groupBy("icls").agg(F.min("q").alias("q")).collect()}
    sets = known.select(F.col(key).alias("doc"), shingle_set(normal_words(F.col(text)), shingle).alias("s"))
    bits = {(d, i): bin_bits(STEP ** (d + 1), math.ceil(threshold * q - 1e-9), miss) for d in range(PARTITIONS) for i, q in smallest.items()}
    schedule = spark.createDataFrame([(d, b, i) for (d, i), b in bits.items()], "dcls int, bits int, icls int")
    item_keys = tests.join(F.broadcast(schedule), "icls").select("item", "dcls", "bits", F.explode_outer(sketch(F.col("s"), F.col("bits"))).alias("h"))
    item_keys = checkpoint(item_keys.distinct())
    used = {d: sorted({b for (e, _), b in bits.items() if e == d}) for d in range(PARTITIONS)}
    used_bits = F.element_at(F.array(*[F.array(*map(F.lit, used[d] or [0])) for d in range(PARTITIONS)]), F.col("dcls") + 1)
    hashes = sets.select("doc", "s", size_class(F.size("s")).alias("dcls")).select("doc", "s", "dcls", F.explode_outer(used_bits).alias("bits"))
    hashes = hashes.select("doc", "dcls", "bits", F.explode_outer(sketch(F.col("s"), F.col("bits"))).alias("h"))
    candidates = checkpoint(hashes.join(few(item_keys, max_broadcast), ["dcls", "bits", "h"]).select("doc", "item").distinct())
    found = _verified(sets, tests, candidates, threshold, max_broadcast)
    if short is not None:
        found = found.unionByName(short)
    return found.select(F.col("doc").alias(key), F.col("item").alias(item), F.col("q").cast("long").alias("n_item_shingles"), "n_common", (F.col("n_common") / F.col("q")).alias("containment"))


def _short_items(texts: DataFrame, asked: DataFrame, max_broadcast: int) -> DataFrame | None:
    """Pairs of items of fewer words than a shingle and documents (``doc, t``) that hold them: all
    runs of as many words are looked up. Of repeated rows of an item with different words each
    is looked up; the rows of longer ones decide what is found besides."""
    made = []
    for n in sorted(r["n"] for r in asked.select(F.size("w").alias("n")).distinct().collect()):  # under the words of a shingle
        keys = few(checkpoint(asked.where(F.size("w") == n).select("item", F.explode(shingle_set(F.col("w"), n)).alias("h")).distinct()), max_broadcast)
        runs = texts.select("doc", F.explode(shingle_set(normal_words(F.col("t")), n)).alias("h"))
        made.append(runs.join(keys, "h").select("doc", "item"))
    if not made:
        return None
    found = made[0]
    for more in made[1:]:
        found = found.unionByName(more)
    return found.distinct().select("doc", "item", F.lit(1).cast("long").alias("q"), F.lit(1).cast("long").alias("n_common"))


def _verified(sets: DataFrame, tests: DataFrame, candidates: DataFrame, threshold: float, max_broadcast: int) -> DataFrame:
    """``doc, item, q, n_common`` of the candidates that hold enough. An item found in very many
    documents has its shingles joined in parts."""
    hit = few(checkpoint(candidates.select("doc").distinct()), max_broadcast)
    shingles = sets.join(hit, "doc", "left_semi").select("doc", F.explode_outer("s").alias("h")).distinct()
    items = tests.select("item", "q", F.explode_outer("s").alias("h"))
    often = hot_keys(candidates.groupBy("item").agg(F.count("*").alias("n")), ["item"])
    common = hot_join(candidates, items, ["item"], often).join(shingles, ["doc", "h"]).groupBy("doc", "item", "q").agg(F.count("*").alias("n_common"))
    return common.where(F.col("n_common") / F.col("q") >= threshold)


def drop_contaminated(docs: DataFrame, items: DataFrame, *, text: str = "text", key: str = "doc_id", max_broadcast: int = MAX_BROADCAST, **settings) -> DataFrame:
    """``docs`` without the rows that contain an item, told apart by a 128-bit hash of key and
    text: of rows that share a key, or have none, only those with the item in their own text
    go. Null and empty texts stay, and so do all columns; an empty table gives an empty result."""
    a, b = row_ids(F.col(key), F.col(text))
    name = F.concat_ws(":", a, b)
    named = docs.select(name.alias("_mr_row"), F.col(text).alias("_mr_text"))
    hit = contained(named, items, text="_mr_text", key="_mr_row", max_broadcast=max_broadcast, **settings).select("_mr_row").distinct()
    return docs.withColumn("_mr_row", name).join(few(checkpoint(hit), max_broadcast), "_mr_row", "left_anti").select(*docs.columns)
