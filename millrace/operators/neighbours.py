"""Exact nearest neighbours and neighbours within a distance, in any number of dimensions.

Points belong to the nearest of a bounded number of pivots and are packed, in the order of their
distance to it, into blocks of bounded size. By the triangle inequality a point q with reach r has
neighbours only in cells that its reach touches, and there only in blocks whose distances to
the pivot overlap [d(q, pivot) - r, d(q, pivot) + r]. So of each block only the points that a cell
may concern are sent to it, packed together, and what could not hold a neighbour is never
compared. A crowded cell makes more blocks, not larger ones.

Without any structure in the points (many dimensions, no clusters) every reach touches every cell and
the work is quadratic, as it must be. Nearest neighbours then come from ``quality.against_all``, which
does not send a copy of each point to each cell.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.scratch import checkpoint, hot_join, hot_keys

from .quality import against_all, distances

#: Pivots at most, which bounds what is collected and sent to all tasks; points of a block.
MOST_PIVOTS, BLOCK = 1024, 2048
#: Bounds are widened by this share, for the rounding of distances.
SLACK = 1e-9
#: Cells that a point is sent to, in the mean, from which on all points are compared with all; bytes of points sent from a task at once.
MANY_CELLS, ASKED_BYTES = 16, 16 << 20


def between(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of x to those of y."""
    return np.stack([np.sqrt(((y - p) ** 2).sum(1)) for p in x]) if len(x) else np.zeros((0, len(y)))


def _arrays(row) -> tuple[np.ndarray, np.ndarray]:
    """Points and their distances to the pivot of a packed row."""
    dp = np.frombuffer(row["dp"])
    return np.frombuffer(row["x"]).reshape(len(dp), -1), dp


class Search:
    """Blocks of the points ``id`` (long, unique), ``x`` (array of doubles, of one length), with further
    columns of longs in ``carry`` (of names that the blocks do not have), and the searches over them. ``examined`` is the number of
    distances that the last search computed (without those to pivots), of ``n * n``."""

    def __init__(self, points: DataFrame, carry: tuple[str, ...] = (), *, pivots: int | None = None, block: int = BLOCK, seed: int = 42, many_cells: float = MANY_CELLS):
        self.spark, self.carry, self.block, self.many_cells = points.sparkSession, carry, block, many_cells
        self.examined = 0
        given = points.select("id", "x", *carry)
        self.n = given.count()
        wanted = pivots or max(1, min(MOST_PIVOTS, math.isqrt(self.n)))
        some = given.select("id", "x").orderBy(F.xxhash64("id", F.lit(seed))).limit(wanted).collect()
        self.pivots = np.unique(np.array([r["x"] for r in some], "f8").reshape(len(some), -1), axis=0)
        self.blocks = checkpoint(self._packed(given))
        facts = self.blocks.groupBy("p").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).toPandas()  # a row per pivot
        self.cells = facts.sort_values("p").reset_index(drop=True)

    def _packed(self, points: DataFrame) -> DataFrame:
        """``block, p, n, lo, hi, ids, x, ...``: points of pivot ``p``, as bytes, by their distance to it."""
        pivots, carry, size = self.pivots, self.carry, self.block
        extra = "".join(f", {c} long" for c in carry)

        def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                if len(f):
                    d = between(np.stack(f["x"].to_numpy()).astype("f8"), pivots)
                    p = d.argmin(1)
                    yield f.assign(p=p.astype("i4"), dp=d[np.arange(len(f)), p])

        def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            number, left = 0, None

            def made(f: pd.DataFrame) -> pd.DataFrame:
                nonlocal number
                number += 1
                block = (TaskContext.get().partitionId() << 32) + number
                row = {"block": block, "p": f["p"].iloc[0], "n": len(f), "lo": f["dp"].iloc[0], "hi": f["dp"].iloc[-1], "ids": f["id"].to_numpy("i8").tobytes(), "x": np.stack(f["x"].to_numpy()).astype("f8").tobytes(), "dp": f["dp"].to_numpy("f8").tobytes()}
                return pd.DataFrame([row | {c: f[c].to_numpy("i8").tobytes() for c in carry}])

            for f in frames:
                f = f if left is None else pd.concat([left, f])
                groups = [g for _, g in f.groupby("p", sort=True)]
                left = groups.pop() if groups else None  # may go on in the next batch
                for g in groups:
                    for at in range(0, len(g), size):
                        yield made(g.iloc[at : at + size])
                while left is not None and len(left) >= 2 * size:
                    yield made(left.iloc[:size])
                    left = left.iloc[size:]
            if left is not None:
                for at in range(0, len(left), size):
                    yield made(left.iloc[at : at + size])

        placed = checkpoint(points.mapInPandas(place, f"id long, x array<double>{extra}, p int, dp double"))
        schema = "block long, p int, n int, lo double, hi double, ids binary, x binary, dp binary" + "".join(f", {c} binary" for c in carry)
        return placed.repartitionByRange("p", "dp", F.xxhash64("id")).sortWithinPartitions("p", "dp").mapInPandas(pack, schema)

    @staticmethod
    def _nearer(d: np.ndarray, dp: np.ndarray, apart: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Which cells can be in reach, as points of a cell are nearer to its pivot than to this one's."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return ~((d**2 - dp[:, None] ** 2) / (2 * apart) > r[:, None])

    def cells_asked(self, blocks: DataFrame) -> float:
        """How many cells a point of ``blocks`` (with ``r``) has to be sent to, in the mean."""
        pivots, cells = self.pivots, self.cells
        known, low, high = cells["p"].to_numpy(), cells["lo"].to_numpy(), cells["hi"].to_numpy()

        def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            gaps = between(pivots[known], pivots)
            for f in frames:
                n = 0
                for row in f.to_dict("records"):
                    x, dp = _arrays(row)
                    r = np.frombuffer(row["r"])
                    d = between(x, pivots[known])
                    may = (d - high <= r[:, None]) & (low - d <= r[:, None])
                    n += int((may & nearer(d, dp, gaps[:, row["p"]], r)).sum())
                yield pd.DataFrame({"n": [n]})

        nearer = self._nearer
        return (blocks.select("p", "x", "dp", "r").mapInPandas(count, "n long").agg(F.sum("n")).first()[0] or 0) / max(1, self.n)

    def _asked(self, blocks: DataFrame, own: bool, keep: tuple[str, ...] = ()) -> DataFrame:
        """Which points of ``blocks`` (with ``r``, the reach of each) may have neighbours in which blocks:
        ``block, at, q, d, r, ...`` (places in the block, points, distances to the pivot there) with the
        payload of that block in ``target, y, e, ...``. ``own``: a block is asked itself too."""
        pivots, cells = self.pivots, self.cells
        known, low, high = cells["p"].to_numpy(), cells["lo"].to_numpy(), cells["hi"].to_numpy()
        columns, nearer = ["at", "q", "d", "r", *keep], self._nearer

        def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            gaps = between(pivots[known], pivots)
            for f in frames:
                for row in f.to_dict("records"):
                    x, dp = _arrays(row)
                    r = np.frombuffer(row["r"]) * (1 + SLACK) + SLACK * (1 + dp)
                    d = between(x, pivots[known])
                    may = (d - high <= r[:, None]) & (low - d <= r[:, None])
                    may &= nearer(d, dp, gaps[:, row["p"]], r)
                    made, held = [], 0
                    for t in np.flatnonzero(may.any(0)):
                        at = np.flatnonzero(may[:, t])
                        at = at[np.argsort(d[at, t], kind="stable")]
                        kept = {c: np.frombuffer(row[c], "i8")[at].tobytes() for c in keep}
                        made.append({"block": row["block"], "t": known[t], "m": len(at), "reach_lo": (d[at, t] - r[at]).min(), "reach_hi": (d[at, t] + r[at]).max(), "at": at.astype("i4").tobytes(), "q": x[at].tobytes(), "d": d[at, t].tobytes(), "r": r[at].tobytes(), **kept})
                        held += x[at].nbytes
                        if held > ASKED_BYTES:
                            yield pd.DataFrame(made)
                            made, held = [], 0
                    if made:
                        yield pd.DataFrame(made)

        schema = "block long, t int, m int, reach_lo double, reach_hi double, " + ", ".join(f"{c} binary" for c in columns)
        asks = checkpoint(blocks.mapInPandas(ask, schema))
        rings = self.blocks.select(F.col("p").alias("t"), F.col("block").alias("target"), "lo", "hi", F.col("n").alias("size"))
        per = asks.groupBy("t").agg(F.count("*").alias("n"))
        wide = hot_join(asks, rings, ["t"], hot_keys(per, ["t"]))
        wide = wide.where((F.col("reach_lo") <= F.col("hi")) & (F.col("lo") <= F.col("reach_hi")))
        return wide if own else wide.where("target <> block")

    def candidates(self, reach: float) -> int:
        """How many distances a search within ``reach`` would compute at most."""
        wide = self._asked(self._with_reach(self.blocks, reach), True)
        return wide.agg(F.sum(F.col("m").cast("long") * F.col("size"))).first()[0] or 0

    def _with_reach(self, blocks: DataFrame, reach: float) -> DataFrame:
        @F.pandas_udf("binary")
        def fill(n: pd.Series) -> pd.Series:
            return n.map(lambda k: np.full(k, reach).tobytes())

        return blocks.withColumn("r", fill("n"))

    def _met(self, asked: DataFrame, payload: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
        """``asked`` with the points of the block asked, each block in as many tasks as it is asked in."""
        other = payload.select(F.col("block").alias("target"), F.col("ids").alias("y_ids"), F.col("x").alias("y"), F.col("dp").alias("e"), *[F.col(c).alias(f"y_{c}") for c in extra])
        # Few bytes a row, but work: not to be joined into few tasks.
        parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.spark.sparkContext.defaultParallelism)
        sent = asked.drop("t", "reach_lo", "reach_hi", "lo", "hi", "m", "size").repartition(parts, "target")
        return sent.join(other.hint("shuffle_merge"), "target")

    def _compared(self, met: DataFrame, schema: str, use: Callable) -> DataFrame:
        """Rows of ``use(row, chunks)`` for each row of ``met``, where chunks are (places among the
        asking points, places among the asked ones, distances)."""

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for at in range(b.num_rows):
                    row = {name: b.column(i)[at].as_py() for i, name in enumerate(b.schema.names)}
                    d, e, r = (np.frombuffer(row[c]) for c in ("d", "e", "r"))
                    q, y = np.frombuffer(row["q"]).reshape(len(d), -1), np.frombuffer(row["y"]).reshape(len(e), -1)

                    def chunks(d=d, e=e, r=r, q=q, y=y):
                        for i in range(0, len(d), 64):
                            part = slice(i, i + 64)
                            a, z = np.searchsorted(e, (d[part] - r[part]).min()), np.searchsorted(e, (d[part] + r[part]).max(), "right")
                            if z > a:
                                yield np.arange(len(d))[part], np.arange(a, z), between(q[part], y[a:z])

                    yield from use(row, chunks())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for frame in compare(batches):
                yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

        return met.mapInArrow(run, schema)

    def nearest(self, k: int) -> DataFrame:
        """``id, near``: the distances of each point to its ``k`` nearest (all, if there are fewer), in
        order; a point is its own nearest, at distance 0.

        First each point gets a reach from its own block, and from the pivots whose cells hold ``k`` points;
        then only the blocks within that reach are searched, and each keeps the ``k`` nearest."""
        pivots, cells = self.pivots, self.cells
        known, sizes, high = cells["p"].to_numpy(), cells["n"].to_numpy(), cells["hi"].to_numpy()

        def least(d: np.ndarray) -> np.ndarray:
            d = np.partition(d, k - 1, axis=1)[:, :k] if d.shape[1] > k else d
            return np.pad(d, ((0, 0), (0, k - d.shape[1])), constant_values=np.inf)

        def own(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for row in f.to_dict("records"):
                    x, dp = _arrays(row)
                    near = np.concatenate([least(between(x[i : i + 256], x)) for i in range(0, len(x), 256)])
                    # k points are within the largest distance of the cells that hold them.
                    far = between(x, pivots[known]) + high
                    order = np.argsort(far, axis=1)
                    enough = (np.cumsum(sizes[order], axis=1) >= k).argmax(1)
                    some = np.take_along_axis(far, order, 1)[np.arange(len(x)), enough]
                    some = np.where(sizes.sum() >= k, some, np.inf)
                    # Who has k at distance 0 needs no other.
                    r = np.where(near.max(1) > 0, np.minimum(near.max(1), some), -np.inf)
                    yield pd.DataFrame([row | {"near": near.tobytes(), "r": r.tobytes()}])

        def use(row, chunks):
            n, seen = len(row["d"]) // 8, 0
            near = np.full((n, k), np.inf)
            for i, j, d in chunks:
                near[i] = least(d)
                seen += d.size
            yield pd.DataFrame({"block": [row["block"]], "at": [row["at"]], "near": [near.tobytes()], "seen": [seen]})

        def merged(parts: pd.DataFrame, near: np.ndarray) -> np.ndarray:
            for at, found in zip(parts["at"], parts["near"], strict=True):
                at = np.frombuffer(at, "i4")
                near[at] = least(np.concatenate([near[at], np.frombuffer(found).reshape(len(at), k)], axis=1))
            return near

        def some(parts: pd.DataFrame) -> pd.DataFrame:
            n = max(np.frombuffer(at, "i4").max() for at in parts["at"]) + 1
            near = merged(parts, np.full((n, k), np.inf))
            return pd.DataFrame({"block": parts["block"].iloc[:1], "at": [np.arange(n, dtype="i4").tobytes()], "near": [near.tobytes()], "seen": [parts["seen"].sum()]})

        def all_of(key, parts: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
            near = np.frombuffer(block["near"].iloc[0]).reshape(-1, k).copy()
            near = np.sort(merged(parts, near), axis=1)
            return pd.DataFrame({"id": np.frombuffer(block["ids"].iloc[0], "i8"), "near": [x[np.isfinite(x)] for x in near]})

        columns = ", ".join(f"{n} {t}" for n, t in self.blocks.dtypes if n not in self.carry)
        first = checkpoint(self.blocks.drop(*self.carry).mapInPandas(own, columns.replace("bigint", "long") + ", near binary, r binary"))
        if self.cells_asked(first) > self.many_cells:
            self.examined = self.n * self.n
            return self._among_all(k)
        asked = self._asked(first.drop("near", "ids"), False)
        part = "block long, at binary, near binary, seen long"
        parts = self._compared(self._met(asked, self.blocks).drop("y_ids"), part, use)
        parts = checkpoint(parts)
        self.examined = (parts.agg(F.sum("seen")).first()[0] or 0) + (self.blocks.agg(F.sum(F.col("n").cast("long") * F.col("n"))).first()[0] or 0)
        # Put together in groups of about 64 before a block's are all put together.
        groups = max(1, self.blocks.count() // 64)
        fewer = parts.groupBy("block", F.pmod(F.xxhash64("at", "near"), F.lit(groups)).alias("part_of")).applyInPandas(some, part)
        return fewer.groupBy("block").cogroup(first.select("block", "ids", "near").groupBy("block")).applyInPandas(all_of, "id long, near array<double>")

    def _among_all(self, k: int) -> DataFrame:
        """``nearest`` for points without structure: all with all, by ``against_all``, in memory that depends
        on its blocks only."""

        def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for ids, x in zip(f["ids"], f["x"], strict=True):
                    ids = np.frombuffer(ids, "i8")
                    yield pd.DataFrame({"id": ids, "features": list(np.frombuffer(x).reshape(len(ids), -1))})

        def least(d: np.ndarray) -> np.ndarray:
            d = np.partition(d, k - 1, axis=1)[:, :k] if d.shape[1] > k else d
            return np.pad(d, ((0, 0), (0, k - d.shape[1])), constant_values=np.inf)

        def partial(x, y, _cx, _cy):
            d = distances(x, y)
            return least(d), least(d.T)

        def finish(ids, _codes, near):
            return pd.DataFrame({"id": ids, "near": [x[np.isfinite(x)] for x in np.sort(near, axis=1)]})

        points = self.blocks.select("ids", "x").mapInPandas(unpack, "id long, features array<double>")
        data = checkpoint(points.withColumn("code", F.array(F.lit(0).cast("long"))))
        return against_all(data, "id long, near array<double>", partial, lambda parts: least(np.concatenate(parts, axis=1)), finish)

    @staticmethod
    def _only(blocks: DataFrame, flag: str) -> DataFrame:
        """``blocks`` of the points alone whose ``flag`` (a carried column) is not 0."""
        eight = [c for c, kind in blocks.dtypes if kind == "binary" and c != "x"]

        def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                made = []
                for row in f.to_dict("records"):
                    some = np.frombuffer(row[flag], "i8") != 0
                    if some.any():
                        x = np.frombuffer(row["x"]).reshape(len(some), -1)[some]
                        made.append(row | {c: np.frombuffer(row[c], "i8")[some].tobytes() for c in eight} | {"n": int(some.sum()), "x": x.tobytes()})
                if made:
                    yield pd.DataFrame(made)

        return blocks.mapInPandas(keep, blocks.schema)

    def density(self, eps: float, least: int, weight: str, *, unit: str | None = None, asks: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Core points ``a``; links ``a, b`` that connect the core points within ``eps`` of each other; and
        ``a, rep`` of the other points and the core points within ``eps`` of them.

        A point is a core point if the ``weight`` (a carried column) of the points within ``eps``, its own
        included, is ``least`` or more. First the weights are summed, a row for each two blocks; then, with
        the core points known, each two blocks give as many links as connect what they connect.

        With ``asks`` (a carried column) only points where it is not 0 are searched for and listed; the others are
        known to be core points. With ``unit`` (another) the points met are named by their unit, whose points are
        connected; a point that is searched for is its own unit."""
        asking = self.blocks if asks is None else checkpoint(self._only(self.blocks, asks))
        reached = self._with_reach(asking, eps)

        def tally(row, chunks):
            n, seen = len(row["d"]) // 8, 0
            total, weights = np.zeros(n, "i8"), np.frombuffer(row[f"y_{weight}"], "i8")
            for i, j, d in chunks:
                total[i] = (d <= eps) @ weights[j]
                seen += d.size
            yield pd.DataFrame({"block": [row["block"]], "at": [row["at"]], "total": [total.tobytes()], "seen": [seen]})

        met = self._met(self._asked(reached, True), self.blocks, (weight,)).drop("y_ids")
        parts = checkpoint(self._compared(met, "block long, at binary, total binary, seen long", tally))

        def some(part: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros(max(np.frombuffer(at, "i4").max() for at in part["at"]) + 1, "i8")
            for at, found in zip(part["at"], part["total"], strict=True):
                total[np.frombuffer(at, "i4")] += np.frombuffer(found, "i8")
            return pd.DataFrame({"block": part["block"].iloc[:1], "at": [np.arange(len(total), dtype="i4").tobytes()], "total": [total.tobytes()], "seen": [part["seen"].sum()]})

        def flags(key, part: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
            core = np.ones(block["n"].iloc[0], "i8")
            asked = core != 0 if asks is None else np.frombuffer(block[asks].iloc[0], "i8") != 0
            total = np.zeros(asked.sum(), "i8")
            for at, found in zip(part["at"], part["total"], strict=True):
                total[np.frombuffer(at, "i4")] += np.frombuffer(found, "i8")
            core[asked] = total >= least
            return pd.DataFrame({"block": [key[0]], "core": [core.tobytes()]})

        groups = max(1, self.blocks.count() // 64)
        fewer = parts.groupBy("block", F.pmod(F.xxhash64("at", "total"), F.lit(groups)).alias("part_of")).applyInPandas(some, "block long, at binary, total binary, seen long")
        used = [c for c in (unit, asks) if c is not None]
        core = checkpoint(fewer.groupBy("block").cogroup(self.blocks.select("block", "n", *used).groupBy("block")).applyInPandas(flags, "block long, core binary"))
        known = checkpoint(self.blocks.drop(*[c for c in self.carry if c not in used]).join(core, "block"))
        asking = known if asks is None else checkpoint(self._only(known, asks))

        def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for ids, flag in zip(f["ids"], f["core"], strict=True):
                    yield pd.DataFrame({"a": np.frombuffer(ids, "i8")[np.frombuffer(flag, "i8") > 0]})

        def connect(row, chunks):
            ids, mine = np.frombuffer(row["q_ids"], "i8"), np.frombuffer(row["core"], "i8") > 0
            others, theirs = np.frombuffer(row["y_ids"], "i8"), np.frombuffer(row["y_core"], "i8") > 0
            one, group, found = asks is not None or row["block"] <= row["target"], np.unique(others, return_inverse=True)[1], ([], [], [])
            for i, j, d in chunks:
                near = (d <= eps) & theirs[j]
                for q, hits in zip(i, near, strict=True):
                    y = j[hits]
                    if not len(y):
                        continue
                    if not mine[q]:  # fewer than ``least`` of them
                        y, kind = y, True
                    elif one:
                        # One for each group of the others; what meets here is one group from now on.
                        meets, first = np.unique(group[y], return_index=True)
                        y, kind = y[first], False
                        group[np.isin(group, meets)] = meets[0]
                    else:
                        continue
                    found[0].append(np.full(len(y), ids[q]))
                    found[1].append(others[y])
                    found[2].append(np.full(len(y), kind))
            if found[0]:
                yield pd.DataFrame(dict(zip(("a", "b", "border"), map(np.concatenate, found), strict=True)))

        packed = asking.withColumn("q_ids", F.col("ids"))
        again = self._asked(self._with_reach(packed.drop("ids"), eps), True, ("q_ids", "core"))
        named = known if unit is None else known.withColumn("ids", F.col(unit))
        edges = checkpoint(self._compared(self._met(again, named, ("core",)), "a long, b long, border boolean", connect))
        self.examined = parts.agg(F.sum("seen")).first()[0] or 0
        links = edges.where("not border and a <> b").select("a", "b")
        return asking.mapInPandas(listed, "a long"), links, edges.where("border").select("a", F.col("b").alias("rep"))


def near_boxes(boxes: DataFrame, eps: float) -> DataFrame:
    """``a, b, sure`` with a < b of the boxes ``id, lo, hi`` (corners, a diagonal of ``eps`` at most) that are within
    ``eps`` of each other; ``sure`` if all of one is within ``eps`` of all of the other."""
    # Centres are within 2 eps, half diagonals differ by eps / 2; corners by the root of twice the sum of both squares.
    reach = eps * math.sqrt(8.5) * (1 + SLACK)
    search = Search(boxes.select("id", F.concat("lo", "hi").alias("x")))
    size = lambda v: np.sqrt((np.ascontiguousarray(v) ** 2).sum(1))

    def use(row, chunks):
        ids, others = np.frombuffer(row["q_ids"], "i8"), np.frombuffer(row["y_ids"], "i8")
        q, y = np.frombuffer(row["q"]).reshape(len(ids), -1), np.frombuffer(row["y"]).reshape(len(others), -1)
        d = q.shape[1] // 2
        for i, j, gaps in chunks:
            u, v = np.nonzero((gaps <= reach) & (ids[i][:, None] < others[j]))
            u, v = i[u], j[v]
            lo, hi, low, high = q[u, :d], q[u, d:], y[v, :d], y[v, d:]
            near = size(np.maximum(0.0, np.maximum(lo - high, low - hi))) <= eps
            sure = size(np.maximum(hi - low, high - lo)) <= eps
            yield pd.DataFrame({"a": ids[u][near], "b": others[v][near], "sure": sure[near]})

    packed = search.blocks.withColumn("q_ids", F.col("ids"))
    asked = search._asked(search._with_reach(packed.drop("ids"), reach), True, ("q_ids",))
    return search._compared(search._met(asked, search.blocks), "a long, b long, sure boolean", use)
