"""Removal of byte strings that repeat anywhere in a corpus, by suffix sorting.

Not every suffix is sorted. Each window of ``length`` bytes has an anchor, the place of its
smallest hash of ``GRAM`` bytes; equal windows have it at the same offset. So if two windows are
equal, their anchors start with the same bytes and go on alike to both sides. Anchors whose
gram is found once are dropped. The others are sorted by what follows them and by what
precedes them, group by group (anchors of equal gram), and from the common lengths L to the left
and R to the right of neighbours follow the repeated windows around each anchor: those of the
pairs with L + R >= length.

Groups are sorted deep-shallow: multikey quicksort goes a few bytes beyond the common gram;
what is still equal then has long common prefixes and is ordered by a blind trie, which
looks at branching bytes only and compares each string once.

Anchors with equal surroundings are one context with a count: they are found by a 128-bit hash,
and the sort orders the different contexts of each gram. A group of very many different
contexts is cut: the windows around an anchor are divided by offset, the windows of a part
share a longer core, and contexts are grouped anew by that core and cut to the span of the part.

No text, position or span passes through the driver: anchors, contexts and spans are written
tables, joined to the texts by a 128-bit id of the row.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, hot_join, hot_keys, modest_batches, row_ids, scratch

GRAM = 64
#: Bytes of one text that are scanned at once (positions are packed into 24 bits).
STRETCH = 1 << 23
#: Odd multipliers for mixing.
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position of a byte array."""
    v = data.astype("u8")
    for step in (1, 2, 4):  # eight bytes in a word
        v = v[:-step] | v[step:] << np.uint64(8 * step)
    h = v * M1
    h ^= h >> np.uint64(29)
    for step in (8, 16, 32):
        h = (h[:-step] * M2) ^ (h[step:] * M3)
        h ^= h >> np.uint64(31)
    return h * M1


def grams_at(data: np.ndarray, spots: np.ndarray) -> np.ndarray:
    """The hashes of ``gram_hashes`` at some positions only."""
    v = np.ascontiguousarray(data[spots[:, None] + np.arange(GRAM)]).view("<u8").astype("u8")
    h = v * M1
    h ^= h >> np.uint64(29)
    for step in (1, 2, 4):
        h = (h[:, :-step] * M2) ^ (h[:, step:] * M3)
        h ^= h >> np.uint64(31)
    return (h * M1)[:, 0]


def anchors(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors of all windows of ``length`` bytes, and their gram hashes."""
    found = []
    for at in range(0, max(1, len(data) - length + 1), STRETCH):
        part = np.frombuffer(data, "u1")[at : at + STRETCH + length - 1]
        if len(part) < length:
            break
        h, w = gram_hashes(part), length - GRAM + 1
        key = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype="u8")
        # Sliding minimum: of the rest of a block from the left, and the start of the next.
        n = len(key) - w + 1
        blocks = -(-len(key) // w)
        padded = np.full(blocks * w, np.uint64(2**64 - 1))
        padded[: len(key)] = key
        grid = padded.reshape(blocks, w)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])
        change = np.concatenate(([True], least[1:] != least[:-1]))
        spots = np.unique((least[change] & np.uint64(0xFFFFFF)).astype("i8"))
        found.append((spots + at, h[spots]))
    if not found:
        return np.zeros(0, "i8"), np.zeros(0, "u8")
    spots, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    spots, first = np.unique(spots, return_index=True)
    return spots, hashes[first]


def common_prefix(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix, known to be ``at`` at least."""
    n = min(len(a), len(b))
    if a[at:n] == b[at:n]:
        return n
    lo, step = at, 16
    while a[lo : lo + step] == b[lo : lo + step]:
        lo, step = lo + step, 2 * step
    while step > 1:
        step = (step + 1) // 2
        if a[lo : lo + step] == b[lo : lo + step]:
            lo += step
    return lo


def _blind_trie(strings: list[bytes], group: list[int], depth: int) -> tuple[list[int], list[int]]:
    """Order of the strings in ``group``, all alike for ``depth`` bytes, and the common lengths of
    neighbours. An inner node is [depth, {byte or -1 at the end: node}], a leaf a list of indices."""
    root: list | None = None
    leaves: dict[int, list[int]] = {}

    def byte(s: bytes, d: int) -> int:
        return s[d] if d < len(s) else -1

    for i in group:
        s = strings[i]
        if root is None:
            leaves[i] = [i]
            root = [-1, i]
            continue
        node = root
        while node[0] >= 0:  # down without looking at the bytes in between
            kids = node[1]
            node = kids.get(byte(s, node[0])) or next(iter(kids.values()))
        other = node[1]
        d = common_prefix(s, strings[other], depth)
        if d == len(s) == len(strings[other]):
            leaves[other].append(i)
            continue
        parent, node = None, root
        while 0 <= node[0] < d:
            parent, node = node, node[1][byte(s, node[0])]
        leaves[i] = [i]
        leaf = [-1, i]
        if node[0] == d:
            node[1][byte(s, d)] = leaf
            continue
        inner = [d, {byte(strings[other], d): node, byte(s, d): leaf}]
        if parent is None:
            root = inner
        else:
            parent[1][byte(s, parent[0])] = inner
    order: list[int] = []
    common: list[int] = []
    stack: list = [(root, depth)]
    while stack:
        node, before = stack.pop()
        if node[0] < 0:
            for n, i in enumerate(leaves[node[1]]):
                if order:
                    common.append(before if n == 0 else len(strings[i]))
                order.append(i)
        else:
            kids = sorted(node[1].items(), reverse=True)
            stack += [(kid, before if k == len(kids) - 1 else node[0]) for k, (_, kid) in enumerate(kids)]
    return order, common


def deep_shallow(strings: list[bytes], known: int = 0, shallow: int = 8) -> tuple[list[int], list[int]]:
    """Sorted order of the strings, alike for ``known`` bytes, and the common prefix lengths of
    neighbours. Ternary partitioning by one byte at a time, ``shallow`` bytes deep; then tries."""
    order: list[int] = []
    common: list[int] = []
    stack: list[tuple[list[int], int, int]] = [(list(range(len(strings))), known, known)]
    while stack:
        group, depth, before = stack.pop()
        if len(group) == 1 or depth >= known + shallow:
            if order:
                common.append(before)
            o, c = (group, []) if len(group) == 1 else _blind_trie(strings, group, depth)
            order += o
            common += c
            continue
        bytes_at = [strings[i][depth] if depth < len(strings[i]) else -1 for i in group]
        pivot = bytes_at[len(group) // 2]
        parts = ([], [], [])
        for i, x in zip(group, bytes_at, strict=True):
            parts[(x >= pivot) + (x > pivot)].append(i)
        pushed = []
        for which, part in enumerate(parts):
            if part:
                down = 1 if which == 1 else 0
                if down and pivot == -1:  # ended strings: all equal
                    pushed.append((part, known + shallow, depth))
                else:
                    pushed.append((part, depth + down, depth))
        pushed[0] = (pushed[0][0], pushed[0][1], before)
        stack += pushed[::-1]
    return order, common


def widest(lefts: list[bytes], rights: list[bytes], counts: list[int], length: int) -> list[tuple[int, int]]:
    """For each context the largest L and the largest R over the others (and its own copies) with
    L + R >= ``length``; (0, 0) if there is none. ``lefts`` are reversed.

    Neighbours in the order of ``rights`` are united from the longest common prefix down. When
    two sets meet at R, the best L of a string in the smaller set is that to its neighbours in
    the larger one, by the order of ``lefts``; further strings of the larger set are covered by
    those in between, with which they share as much on both sides.
    """
    n = len(lefts)
    best = [[len(x), len(y)] if c > 1 and len(x) + len(y) >= length else [0, 0] for x, y, c in zip(lefts, rights, counts, strict=True)]
    by_right, alike = deep_shallow(rights, GRAM if n > 1 and all(r[:GRAM] == rights[0][:GRAM] and len(r) >= GRAM for r in rights) else 0)
    by_left, _ = deep_shallow(lefts)
    rank = [0] * n
    for r, i in enumerate(by_left):
        rank[i] = r
    sets = [[rank[i]] for i in by_right]
    home = list(range(n))

    def find(x: int) -> int:
        while home[x] != x:
            home[x] = home[home[x]]
            x = home[x]
        return x

    def pair(i: int, j: int, right: int) -> None:
        left = common_prefix(lefts[i], lefts[j])
        if left + right >= length:
            for x in (i, j):
                best[x][0] = max(best[x][0], left)
                best[x][1] = max(best[x][1], right)

    for k in sorted(range(n - 1), key=lambda k: -alike[k]):
        a, b = find(k), find(k + 1)
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        big, right = sets[a], alike[k]
        at = [bisect_left(big, r) for r in sets[b]]
        for r, p in zip(sets[b], at, strict=True):
            for q in (p - 1, p):
                if 0 <= q < len(big):
                    pair(by_left[r], by_left[big[q]], right)
        sets[a] = sorted(big + sets[b])
        sets[b] = []
        home[b] = a
    return [(x, y) for x, y in best]


def _context(data: bytes, at: int, length: int) -> tuple[bytes, bytes]:
    """What the windows with this anchor can reach: to the left (reversed), to the right."""
    return data[max(0, at - length + GRAM) : at][::-1], data[at : at + length]


def _cid(left: bytes, right: bytes) -> bytes:
    return hashlib.blake2b(len(left).to_bytes(4, "big") + left + right, digest_size=16).digest()


def repeated_spans(rows: DataFrame, *, length: int = 400, crowd: int = 50_000, hot: int = 1000) -> DataFrame:
    """``a, b, spans``: for rows ``a, b, t`` (a 128-bit id and bytes) with repeated strings the
    byte ranges to remove, as start, end, start, end ..., not yet merged. Rows of equal id
    must have equal bytes; each counts as an occurrence. Grams and contexts that over ``hot``
    anchors have are joined in parts."""
    spark = rows.sparkSession

    modest_batches(spark)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = []
            for x, y, t in b.itertuples(index=False):
                spots, grams = anchors(t, length)
                if len(spots):
                    made.append((x, y, grams.view("i8"), spots.astype("i4")))
            yield pd.DataFrame(made, columns=["a", "b", "g", "pos"])

    scanned = checkpoint(rows.where(F.octet_length("t") >= length).mapInPandas(scan, "a long, b long, g array<long>, pos array<int>"))
    each = scanned.select("a", "b", F.explode(F.arrays_zip("g", "pos")).alias("x")).select("a", "b", "x.g", "x.pos")
    counts = checkpoint(each.groupBy("g").agg(F.count("*").alias("n")).where("n > 1"))
    found = hot_join(each, counts.select("g"), ["g"], hot_keys(counts, ["g"], least=hot), "left_semi")
    found = checkpoint(found.groupBy("a", "b").agg(F.sort_array(F.collect_set("pos")).alias("pos")))

    def surroundings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A context is written out where a task meets it first; the second meeting is marked."""
        seen: dict[bytes, bool] = {}
        for batch in batches:
            made = []
            for x, y, t, spots in batch.itertuples(index=False):
                grams = grams_at(np.frombuffer(t, "u1"), np.asarray(spots, "i8")).view("i8").tolist()
                for g, p in zip(grams, np.asarray(spots).tolist(), strict=True):
                    left, right = _context(t, p, length)
                    c = _cid(left, right)
                    met = seen.get(c)
                    if met is None:
                        seen[c] = False
                        made.append((g, c, x, y, p, left, right, False))
                    else:
                        made.append((g, c, x, y, p, None, None, not met))
                        seen[c] = True
            if len(seen) > 1_000_000:
                seen.clear()
            yield pd.DataFrame(made, columns=["g", "cid", "a", "b", "pos", "lefts", "rights", "again"])

    path = scratch(spark, "contexts")
    schema = "g long, cid binary, a long, b long, pos int, lefts binary, rights binary, again boolean"
    texts = rows.where(F.octet_length("t") >= length).join(found, ["a", "b"])
    texts.select("a", "b", "t", "pos").mapInPandas(surroundings, schema).write.option("compression", "zstd").parquet(path)
    met = spark.read.schema(schema).parquet(path)
    places = met.select("g", "cid", "a", "b", "pos")
    per = checkpoint(met.groupBy("g", "cid").agg(F.count("*").alias("n")))
    crowded = checkpoint(per.groupBy("g").agg(F.count("*").alias("contexts")).where(F.col("contexts") > crowd).select("g"))
    some = not crowded.isEmpty()
    bodies = met.where("lefts is not null or again").select("g", "cid", F.lit(1).cast("long").alias("n"), "lefts", "rights")
    made = _sorted(bodies.join(crowded, "g", "left_anti") if some else bodies, length)
    spans = [_placed(places, made, hot_keys(per, ["g", "cid"], least=hot))]
    if some:
        first = F.first("lefts", True).alias("lefts"), F.first("rights", True).alias("rights")
        level = met.join(crowded, "g").groupBy("g", "cid").agg(F.count("*").alias("n"), *first).withColumns({"o1": F.lit(0), "o2": F.lit(length - GRAM + 1)})
        spans += _crowd_spans(checkpoint(level), places, crowd, length)
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out.groupBy("a", "b").agg(F.flatten(F.collect_set(F.array("s", "e"))).alias("spans"))


def _crowd_spans(level: DataFrame, places: DataFrame, crowd: int, length: int) -> list[DataFrame]:
    """The spans of the anchors whose groups have too many contexts to be sorted in one task."""
    first = F.first("lefts", True).alias("lefts"), F.first("rights", True).alias("rights")
    spans = []
    for width in (43, 6, 1):
        # A context with a copy is repeated as far as it reaches; it is cut as a partner of others only.
        whole = level.where((F.col("n") > 1) & (F.octet_length("lefts") + F.octet_length("rights") >= length))
        spans.append(_placed(places, whole.select("g", "cid", F.octet_length("lefts").alias("l"), F.octet_length("rights").alias("r"))))
        cut = checkpoint(level.mapInPandas(_cut(width, length), "g long, cid binary, g2 long, cid2 binary, n long, lefts binary, rights binary, o1 int, o2 int, open boolean"))
        shared = cut.groupBy("g2").agg(F.sum("n").alias("all")).where("all > 1").select("g2")
        cut = checkpoint(cut.join(shared, "g2", "left_semi"))
        level = checkpoint(cut.groupBy(F.col("g2").alias("g"), F.col("cid2").alias("cid")).agg(F.sum("n").alias("n"), *first, F.first("o1").alias("o1"), F.first("o2").alias("o2")))
        places = places.join(cut.where("open").select("g", "cid", "g2", "cid2"), ["g", "cid"]).select(F.col("g2").alias("g"), F.col("cid2").alias("cid"), "a", "b", "pos")
        # With one window each (width 1) all contexts of a group are equal.
        crowded = checkpoint(level.groupBy("g").agg(F.count("*").alias("contexts")).where(F.col("contexts") > (crowd if width > 1 else 1 << 62)).select("g"))
        some = not crowded.isEmpty()
        fine = level.join(crowded, "g", "left_anti") if some else level
        spans.append(_placed(places, _sorted(fine.select("g", "cid", "n", "lefts", "rights"), length)))
        if not some:
            break
        level = checkpoint(level.join(crowded, "g"))
    return spans


def _placed(places: DataFrame, made: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Byte ranges of the anchors whose contexts reach ``l`` to the left and ``r`` to the right."""
    return hot_join(places, made, ["g", "cid"], hot).select("a", "b", (F.col("pos") - F.col("l")).alias("s"), (F.col("pos") + F.col("r")).alias("e"))


def _cut(width: int, length: int):
    """Contexts again, for each ``width`` offsets, grouped by the core that these windows share."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for c in b.itertuples(index=False):
                for a in range(c.o1, c.o2, width):
                    z = min(a + width, c.o2)
                    left, right = c.lefts[: z - 1], c.rights[: length - a]
                    if len(left) < a or len(right) < length - z + 1:
                        continue  # no window of these offsets fits in the text
                    core = hashlib.blake2b(a.to_bytes(4, "big") + left[:a] + b"|" + right[: length - z + 1], digest_size=8, key=c.g.to_bytes(8, "big", signed=True)).digest()
                    rows.append((c.g, c.cid, int.from_bytes(core, "big", signed=True), _cid(left, right), c.n, left, right, a, z, c.n < 2 or len(c.lefts) + len(c.rights) < length))
            yield pd.DataFrame(rows, columns=["g", "cid", "g2", "cid2", "n", "lefts", "rights", "o1", "o2", "open"])

    return run


def _sorted(contexts: DataFrame, length: int) -> DataFrame:
    """``g, cid, l, r`` of the contexts in repeated windows, from ``g, cid, n, lefts, rights``. Rows
    of one context add up their ``n``; one of them has the bytes."""

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, group = None, []

        def done():
            best = widest([x[2] for x in group], [x[3] for x in group], [x[1] for x in group], length)
            return [(at, x[0], *b) for x, b in zip(group, best, strict=True) if b[1]]

        for b in batches:
            rows = []
            for g, c, n, left, right in b.itertuples(index=False):
                if g != at:
                    if group:
                        rows += done()
                    at, group = g, []
                if group and group[-1][0] == c:
                    group[-1][1] += n
                else:
                    group.append([c, n, left, right])
            yield pd.DataFrame(rows, columns=["g", "cid", "l", "r"])
        if group:
            yield pd.DataFrame(done(), columns=["g", "cid", "l", "r"])

    return checkpoint(contexts.repartition("g").sortWithinPartitions("g", "cid", F.desc_nulls_last("lefts")).mapInPandas(sort, "g long, cid binary, l int, r int"))


def _without(data: bytes, spans) -> tuple[bytes, int, int]:
    kept, at, removed, runs, end = [], 0, 0, 0, -1
    for s, e in sorted(spans):
        if s > end:
            kept.append(data[at:s])
            runs += 1
        if e > end:
            removed += e - max(s, end) if end >= s else e - s
            at = end = e
    kept.append(data[at:])
    return b"".join(kept), removed, runs


RESULT = "kept binary, n_removed long, n_spans long"


def drop_repeats(docs: DataFrame, *, text: str = "text", key: str = "doc_id", length: int = 400, crowd: int = 50_000, hot: int = 1000) -> DataFrame:
    """``docs`` with ``kept`` (the remaining bytes), n_bytes, n_removed and n_spans (maximal runs).

    Texts are UTF-8; every byte covered by a string of ``length`` bytes that also starts
    anywhere else in the corpus goes, in the same row too, judged on the input. Null text is
    empty. Repeated rows are repeats of each other: all go. Keys may be null and of any type
    that Spark can hash. Texts of any length are read whole, one at a time. An empty table
    gives an empty result. Columns of the added names are replaced, others pass through.
    ``length`` must be over twice the gram of 64 bytes. Groups of over ``crowd`` contexts
    are cut; the result depends neither on ``crowd`` nor on ``hot``.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length: at least {2 * GRAM}")
    kept = [c for c in docs.columns if c not in ("kept", "n_bytes", "n_removed", "n_spans", "_mr_a", "_mr_b", "_mr_spans")]
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    a, b = row_ids(F.col(key), F.col(text))
    rows = docs.select(a.alias("a"), b.alias("b"), body.alias("t"))
    spans = checkpoint(repeated_spans(rows, length=length, crowd=crowd, hot=hot))

    @F.pandas_udf(RESULT)
    def remove(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, found in batches:
            made = [(None, 0, 0) if f is None else _without(t, np.asarray(f).reshape(-1, 2).tolist()) for t, f in zip(texts, found, strict=True)]
            yield pd.DataFrame(made, columns=["kept", "n_removed", "n_spans"])

    tagged = docs.select(*kept, a.alias("_mr_a"), b.alias("_mr_b")).join(spans.select(F.col("a").alias("_mr_a"), F.col("b").alias("_mr_b"), F.col("spans").alias("_mr_spans")), ["_mr_a", "_mr_b"], "left")
    # Only texts that lose something go through Python.
    touched = F.when(F.col("_mr_spans").isNotNull(), body)
    made = tagged.select(*kept, remove.asNondeterministic()(touched, F.col("_mr_spans")).alias("_mr_made"))
    return made.select(*kept, F.coalesce("_mr_made.kept", body).alias("kept"), F.octet_length(body).cast("long").alias("n_bytes"), "_mr_made.n_removed", "_mr_made.n_spans")
