"""Ranked lexical search over an index that is stratified by document length.

A document's length counts in its score through one integer, its normaliser m, so documents of
equal m form a stratum, within which what a term adds to a score depends on its frequency tf alone. The
index holds, for each stratum, postings by term and tf: an impact is computed once per (term, tf) and
added to all documents of that posting. The largest tf of a term in a stratum bounds what the term
can add there, and the sum over an item's terms bounds every score in the stratum.

Strata are visited in the order of their bounds, in two rounds. The first takes each item's
strata of the largest bounds; the 50th best score found there is a floor. The second takes
the strata whose bounds reach that floor. No other stratum can hold a result, so the ranking
is exact. A stratum of very many documents is dealt to blocks by a hash of the row; a block is a
row of the index of bounded size, and blocks are built, bounded and visited in parallel.

Only terms of the items are indexed. Items are the stated query set: they are taken in portions of
bounded size, each of which is sent to all tasks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpoint, few, modest_batches

#: Bytes that are part of a term, in lower case (A-Z only); the others are blanks.
ASCII_TERMS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
TERM_BYTES = bytes(ord(chr(b).lower()) if b in ASCII_TERMS else b if b >= 0x80 else 0x20 for b in range(256))
#: Documents in one block of the index.
BLOCK = 4096
#: Items, and characters of items, that are answered at once.
PORTION, PORTION_CHARS = 5000, 50_000_000


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


@dataclass
class Queries:
    """A portion of the items: their distinct terms in order, and per item its term numbers."""

    items: list[int]
    vocabulary: dict[bytes, int]
    starts: np.ndarray
    of_item: np.ndarray
    weights: np.ndarray | None = None

    @classmethod
    def of(cls, rows: list[tuple[int, bytes]]) -> Queries:
        vocabulary: dict[bytes, int] = {}
        each = [sorted({vocabulary.setdefault(t, len(vocabulary)) for t in terms(text)}) for _, text in rows]
        sizes = np.array([len(x) for x in each], "i8")
        return cls([i for i, _ in rows], vocabulary, np.concatenate(([0], np.cumsum(sizes))), np.array([x for e in each for x in e], "i8"))

    def bounds(self, impacts: np.ndarray) -> np.ndarray:
        """Sum of ``impacts`` (one per term, weighted) over the terms of each item."""
        total = np.concatenate(([0], np.cumsum(impacts[self.of_item])))
        return total[self.starts[1:]] - total[self.starts[:-1]]

    def item(self, i: int) -> np.ndarray:
        return self.of_item[self.starts[i] : self.starts[i + 1]]


def impact(tf, m):
    """What one unit of weight adds: 64-bit integers, rounded down."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _tallies(docs: DataFrame, queries: Queries) -> DataFrame:
    """``doc, n, terms, tfs``: of each document with a term, their number, and the items' terms."""
    spark, vocabulary = docs.sparkSession, queries.vocabulary
    out = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = ([], [], [], [])
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                found = terms(text.as_py())
                if not found:
                    continue
                known = sorted((i, tf) for t, tf in Counter(found).items() if (i := vocabulary.get(t)) is not None)
                for column, x in zip(made, (doc, len(found), [i for i, _ in known], [tf for _, tf in known]), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(made, out, strict=True)], schema=out)

    modest_batches(spark)
    return docs.where("text is not null").select("doc", F.col("text").cast("binary")).mapInArrow(tally, "doc long, n long, terms array<int>, tfs array<long>")


INDEX = "m long, block int, n int, docs array<long>, terms array<int>, most array<long>, p_term array<int>, p_tf array<long>, p_size array<int>, p_docs array<int>"


def _index(tallies: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """One row per block of a stratum: its ``n`` documents in order (null ones, at the end, left out), its
    terms and their largest tf, and the postings by (term, tf): how many documents, then their
    places."""
    placed = tallies.withColumn("m", F.expr(f"50L + (50L * n * {n_docs}L) div {n_terms}L"))
    large = checkpoint(placed.groupBy("m").agg(F.count("*").alias("_c")).where(F.col("_c") > BLOCK).select("m", F.ceil(F.col("_c") / BLOCK).cast("int").alias("_parts")), release=True)
    met = placed.join(few(large), "m", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    dealt = met.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_parts")).cast("int")).drop("_parts", "n")
    fields = pa.schema([("m", pa.int64()), ("block", pa.int32()), ("n", pa.int32()), ("docs", pa.list_(pa.int64())), ("terms", pa.list_(pa.int32())), ("most", pa.list_(pa.int64())), ("p_term", pa.list_(pa.int32())), ("p_tf", pa.list_(pa.int64())), ("p_size", pa.list_(pa.int32())), ("p_docs", pa.list_(pa.int32()))])

    def built(key, docs, lists) -> tuple:
        sizes = [len(t) for t, _ in lists]
        term = np.concatenate([t for t, _ in lists]) if docs else np.zeros(0, "i4")
        tf = np.concatenate([f for _, f in lists]) if docs else np.zeros(0, "i8")
        place = np.repeat(np.arange(len(docs), dtype="i4"), sizes)
        order = np.lexsort((place, tf, term))
        term, tf, place = term[order], tf[order], place[order]
        first = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])))) if len(term) else np.zeros(0, "i8")
        p_term, p_tf = term[first], tf[first]
        last = np.flatnonzero(np.concatenate((p_term[1:] != p_term[:-1], [True]))) if len(first) else np.zeros(0, "i8")
        return (*key, len(docs), [d for d in docs if d is not None], p_term[last], p_tf[last], p_term, p_tf, np.diff(np.append(first, len(term))).astype("i4"), place)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, docs, lists, made = None, [], [], []
        for b in batches:
            flat = [(c.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(c.value_lengths().to_numpy(zero_copy_only=False))))) for c in (b.column("terms"), b.column("tfs"))]
            for i, row in enumerate(zip(b.column("m").to_pylist(), b.column("block").to_pylist(), b.column("doc").to_pylist(), strict=True)):
                if row[:2] != key:
                    if docs:
                        made.append(built(key, docs, lists))
                    key, docs, lists = row[:2], [], []
                docs.append(row[2])
                lists.append(tuple(x[at[i] : at[i + 1]] for x, at in flat))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*made, strict=True), fields, strict=True)], schema=fields)
                made = []
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(built(key, docs, lists), fields, strict=True)], schema=fields)

    return dealt.repartition("m", "block").sortWithinPartitions("m", "block", F.asc_nulls_last("doc")).mapInArrow(build, INDEX)


def _bounds(index: DataFrame, queries: Queries) -> DataFrame:
    """``item, m, block, bound``: of the blocks in which an item can have a score above 0."""
    weights, n_terms = queries.weights, len(queries.vocabulary)

    def bound(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = []
            for m, block, found, most in f.itertuples(index=False):
                each = np.zeros(n_terms, "i8")
                each[found] = weights[found] * impact(most.astype("i8"), m)
                total = queries.bounds(each)
                at = np.flatnonzero(total)
                made.append(pd.DataFrame({"item": at, "m": m, "block": block, "bound": total[at]}))
            if made:
                yield pd.concat(made)

    return index.select("m", "block", "terms", "most").mapInPandas(bound, "item long, m long, block int, bound long")


def _visit(index: DataFrame, visits: DataFrame, queries: Queries, top: int) -> DataFrame:
    """``item, doc, score``: the ``top`` best of each block for each item that visits it (``m, block,
    items, floors``), with scores above 0 and not below the item's floor."""
    weights = queries.weights

    def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = []
            for m, n, docs, p_term, p_tf, p_size, p_docs, items, floors in f.itertuples(index=False):
                # Once per (term, tf) of the stratum, for all items.
                impacts = weights[p_term] * impact(p_tf.astype("i8"), m)
                ends = np.cumsum(p_size)
                spread = np.repeat(impacts, p_size)
                starts = np.concatenate(([0], ends))
                first, last = (np.searchsorted(p_term, np.arange(len(weights)), side) for side in ("left", "right"))
                for item, floor in zip(items, floors, strict=True):
                    score = np.zeros(n, "i8")
                    for t in queries.item(item):
                        a, b = starts[first[t]], starts[last[t]]
                        score[p_docs[a:b]] += spread[a:b]  # a document has one tf
                    good = np.flatnonzero((score > 0) & (score >= floor))
                    # Documents are in order, so a stable sort breaks ties by document.
                    best = good[np.argsort(-score[good], kind="stable")[:top]]
                    if len(best):
                        made.append(pd.DataFrame({"item": item, "doc": pd.array([docs[p] if p < len(docs) else None for p in best], dtype="Int64"), "score": score[best]}))
            if made:
                yield pd.concat(made)

    asked = index.join(visits, ["m", "block"])
    return asked.select("m", "n", "docs", "p_term", "p_tf", "p_size", "p_docs", "items", "floors").mapInPandas(visit, "item long, doc long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _portions(items: DataFrame, text: str) -> Iterator[list[tuple[int, bytes]]]:
    """Rows ``number, text`` of ``items``, in portions of bounded size."""
    portion, chars = [], 0
    for r in items.toLocalIterator():
        portion.append((r["_mr_item"], bytes(r[text] or b"")))
        chars += len(portion[-1][1])
        if len(portion) == PORTION or chars > PORTION_CHARS:
            yield portion
            portion, chars = [], 0
    if portion:
        yield portion


def search(docs: DataFrame, items: DataFrame, *, top: int = 50, key: str = "doc_id", item: str = "item_id", text: str = "text", rounds: int = 8) -> DataFrame:
    """``item, rank, key, score``: the ``top`` best documents of each item with a score above 0.

    Terms are the maximal runs of ASCII letters, digits and anything beyond ASCII, with A-Z
    lower-cased. With N documents that have a term, L terms in all of them, n in one and df
    documents with a term: the term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))), a document has m
    = 50 + (50 n N) div L, and scores the sum of w * ((10^9 tf) div (1000 tf + 20 m)) over the item's
    terms, once each. Equal scores go by ``key``, an integer, nulls last. Null texts have no term.
    Repeated documents are documents of their own; equal rows of ``items`` are one item, rows of
    one id with different texts are ranked apart. Texts of any length are counted whole. Empty tables
    give an empty result. Extra columns are ignored. ``rounds`` is the number of blocks that an item
    visits first; the result doesn't depend on it.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    asked = items.select(F.col(item).alias("_mr_id"), F.col(text).cast("binary").alias(text)).distinct()
    asked = checkpoint(asked.withColumn("_mr_item", F.monotonically_increasing_id()))
    out = None
    for portion in _portions(asked.select("_mr_item", text), text):
        made = _answered(read, Queries.of(portion), top, rounds)
        if made is not None:
            numbered = spark.createDataFrame(list(enumerate(i for i, _ in portion)), "item long, _mr_item long")
            made = made.join(F.broadcast(numbered), "item").drop("item")
            out = made if out is None else out.unionByName(made)
    if out is None:
        out = spark.createDataFrame([], "doc long, score long, rank int, _mr_item long")
    named = out.join(asked.select("_mr_item", "_mr_id"), "_mr_item")
    return named.select(F.col("_mr_id").alias(item), "rank", F.col("doc").alias(key), "score")


def _answered(docs: DataFrame, queries: Queries, top: int, rounds: int) -> DataFrame | None:
    tallies = checkpoint(_tallies(docs, queries), release=True)
    n_docs, n_terms = tallies.agg(F.count("*"), F.sum("n")).first()
    if not n_docs or not queries.vocabulary:
        return None
    df = np.zeros(len(queries.vocabulary), "i8")
    counted = tallies.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).toPandas()  # a row per term of the portion
    df[counted["t"].to_numpy()] = counted["n"].to_numpy()
    queries.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], "i8")
    queries = Queries(queries.items, dict.fromkeys(range(len(df))), queries.starts, queries.of_item, queries.weights)  # words stay here
    index = checkpoint(_index(tallies, n_docs, n_terms), release=True)
    bounds = checkpoint(_bounds(index, queries), release=True)
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "m", "block")
    first = checkpoint(bounds.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= rounds).drop("_r"), release=True)
    ask = lambda df: df.groupBy("m", "block").agg(F.collect_list("item").alias("items"), F.collect_list("floor").alias("floors"))
    found = checkpoint(_ranked(_visit(index, ask(first.withColumn("floor", F.lit(0).cast("long"))), queries, top), top), release=True)
    floors = found.where(F.col("rank") == top).select("item", F.col("score").alias("floor"))  # a row per item of the portion
    later = bounds.join(first.select("item", "m", "block"), ["item", "m", "block"], "left_anti").join(F.broadcast(floors), "item", "left").withColumn("floor", F.coalesce("floor", F.lit(0).cast("long")))
    more = _visit(index, ask(later.where(F.col("bound") >= F.col("floor"))), queries, top)
    return _ranked(found.select("item", "doc", "score").unionByName(more), top)
