"""Interleaving sources at target weights by a Pfair schedule.

The rows of each source are cut into blocks. With weight w (the weights add up to 1) the j-th
block of a source, from 0, is released at slot floor(j / w) and due by slot ceil((j + 1) / w);
every slot goes to the released block that is due first. So in each prefix of the
schedule each source has its target share of the slots to within less than one block.

Weights are taken exactly (floats are fractions), and each block is planned, not a period
that repeats: nothing is rounded, and no deviation builds up. The plan has one row per
block, made on the driver; where the rows would make more than ``max_blocks`` blocks, blocks
are made longer, so the plan stays small at any size. Rows only meet it in a join.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpoint

ADDED = ("block", "release", "deadline", "slot", "position")
PLAN = ("_mr_source", "block", "release", "deadline", "slot", "_mr_turn")


def exact_weights(weights: Mapping[str, float]) -> dict[str, int]:
    """Whole numbers in proportion to the weights, exactly."""
    if not weights or any(not 0 < w < float("inf") for w in weights.values()):
        raise ValueError("weights must be positive")
    parts = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*{p.denominator for p in parts.values()})  # of floats: a power of two
    return {s: int(p * scale) for s, p in parts.items()}


def pfair(weights: Mapping[str, int], blocks: Mapping[str, int]) -> list[tuple[str, int, int, int, int]]:
    """``source, block, release, deadline, slot`` of all blocks in the order of their slots.

    ``weights`` are whole numbers. Among equal deadlines the smaller j / w goes first, then the
    name. Slots of sources that have no blocks left stay free, and the others keep their own.
    """
    total = sum(weights.values())
    waiting = [(0, s, 0) for s, n in blocks.items() if n]
    heapq.heapify(waiting)
    ready: list = []
    made, slot = [], 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            release, s, j = heapq.heappop(waiting)
            due, over = divmod((j + 1) * total, weights[s])
            heapq.heappush(ready, (due + (over > 0), Fraction(over, weights[s]) if over else 1, s, j, release))
        due, _, s, j, release = heapq.heappop(ready)
        if due <= slot:
            raise RuntimeError("a block is late")  # cannot happen: a feasible schedule exists
        made.append((s, j, release, due, slot))
        if j + 1 < blocks[s]:
            heapq.heappush(waiting, (max((j + 1) * total // weights[s], slot + 1), s, j + 1))
        slot += 1
    return made


def smoothed_weights(counts: Mapping[str, int], alpha: float = 0.5) -> dict[str, float]:
    """Target weights in proportion to count ** alpha."""
    return {s: float(n) ** alpha for s, n in counts.items()}


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, *, source: str = "source", key: str = "doc_id", block_rows: int = 32, max_blocks: int = 500_000, max_sources: int = 1_000_000, seed: int = 7, bucket_rows: int = 1000, max_broadcast: int = 200_000) -> DataFrame:
    """``docs`` with its place in the mixture; sort by ``position`` to read it in order.

    Within a source rows are shuffled by a hash of the row and ``seed`` (then the key, then
    the other columns) and cut into blocks of ``block_rows``, or of as many rows as keep the
    plan at about ``max_blocks`` blocks; the last block of a source may be short. Adds block
    (from 0), release and deadline (slots, of the block's Pfair window), slot (one block each;
    slots of sources that have run out stay free), and position, which is unique and
    increases with the slot: the number of the block in the whole plan, times the rows of a
    block, plus the place in the block.

    Every row is kept once. While no source has run out, each has its target share of every
    prefix to within one block; afterwards the others keep their shares among themselves.
    ``weights`` defaults to ``smoothed_weights``. Sources it leaves out raise ValueError, as
    do more than ``max_sources`` sources: names, counts and plan are on the driver. A null
    source is the source ``""``; null keys and repeated rows are placed like others; texts of
    any length pass through; an empty table gives an empty result. Columns of the added names
    are replaced, others pass through. A source is ranked in hash buckets of about
    ``bucket_rows`` rows, with the offsets of the buckets from a table of counts, so no task
    gets a whole source. A plan of over ``max_broadcast`` blocks is joined by shuffle.
    """
    kept = [c for c in docs.columns if c not in ADDED and not c.startswith("_mr_")]
    docs = docs.select(*kept)
    spark = docs.sparkSession
    name = F.coalesce(F.col(source).cast("string"), F.lit(""))
    found = docs.groupBy(name.alias("s")).count().limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    counts = {r["s"]: r["count"] for r in found}
    if not counts:
        return docs.select(*kept, *[F.lit(0).cast("long").alias(c) for c in ADDED])
    given = weights or smoothed_weights(counts)
    if missing := set(counts) - set(given):
        raise ValueError(f"no weight for {sorted(missing)[:5]}")
    block_rows = max(block_rows, -(-sum(counts.values()) // max_blocks))
    of_plan = pfair(exact_weights({s: given[s] for s in counts}), {s: -(-n // block_rows) for s, n in counts.items()})
    frame = pd.DataFrame(of_plan, columns=PLAN[:-1]).assign(_mr_turn=np.arange(len(of_plan)))
    plan = checkpoint(spark.createDataFrame(frame, "_mr_source string, block long, release long, deadline long, slot long, _mr_turn long"))

    tied = [c for c in [key, *(c for c in kept if c != key)] if dict(docs.dtypes)[c].split("<")[0] not in ("map", "variant")]
    buckets = max(1, -(-max(counts.values()) // bucket_rows))
    tagged = docs.withColumns({"_mr_source": name, "_mr_h": F.xxhash64(*[F.col(c) for c in tied], F.lit(seed))})
    tagged = tagged.withColumn("_mr_bucket", F.floor((F.col("_mr_h") / F.lit(2.0**64) + 0.5) * buckets).cast("int"))
    sizes = checkpoint(tagged.groupBy("_mr_source", "_mr_bucket").agg(F.count("*").alias("_mr_size")))
    before = F.sum("_mr_size").over(Window.partitionBy("_mr_source").orderBy("_mr_bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_mr_source", "_mr_bucket", F.coalesce(before, F.lit(0)).alias("_mr_before"))
    order = Window.partitionBy("_mr_source", "_mr_bucket").orderBy("_mr_h", *tied)
    ranked = tagged.withColumn("_mr_rank", F.row_number().over(order) - 1).join(offsets, ["_mr_source", "_mr_bucket"])
    rank = F.col("_mr_before") + F.col("_mr_rank")
    ranked = ranked.withColumns({"block": F.floor(rank / block_rows), "_mr_in": rank % block_rows})
    placed = ranked.join(F.broadcast(plan) if len(of_plan) <= max_broadcast else plan, ["_mr_source", "block"], "left")
    turn = F.coalesce("_mr_turn", F.raise_error(F.lit("a block without a plan")).cast("long"))
    return placed.select(*kept, "block", "release", "deadline", "slot", (turn * block_rows + F.col("_mr_in")).alias("position"))
