"""Removal of passages that occur in an earlier document, by suffix automata of reference shards.

A window is ``n`` consecutive words; a word goes if a window that covers it also starts in a
document with a smaller key. Every document is a reference for the later ones, so the
reference is as large as the corpus and can't be broadcast whole. It is cut to what can matter
and sharded, so that a shard has a proven size and meets only the passages that it can match:

* Each window has an anchor, the place of its smallest hash of ``GRAM`` words; equal windows have it at
  the same offset. Windows whose anchor's gram is found in one document only can't repeat.
* The windows around one of the other anchors make a passage, told apart by a 128-bit hash: different
  passages are kept once, with the smallest key that has them. A gram with very many different
  passages is cut into its single windows, which are passages of their own.
* Grams of several passages are dealt to shards of about ``SHARD`` passages. The task of a shard builds the suffix automaton
  of its passages, whose states know the smallest key of a document that has their words, and streams the
  passages past it: the longest match that ends at each word, followed to the state of its last
  ``n`` words, tells where the window there was seen first. (A gram with one passage, as in exact
  copies, shares windows with no other: its automaton is a chain whose states all have that passage's
  key, which is written down without building it.)

Each shard's automaton is thus sent to the passages of its own shard and not to all documents. The
maximal spans covered by windows that were seen in a smaller key are cut out of the texts. Hashes
choose what is compared; words are compared by the automata.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import checkpoint, few, hot_join, hot_keys, modest_batches, scratch, workspace

GRAM = 4
#: Bytes of text, and words, that are looked at at once.
PIECE, STRETCH = 1 << 20, 1 << 22
#: Passages of a shard, on average.
SHARD = 4000
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 bits to 64 bits, every bit of the result depending on every bit given."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


BYTES = _mixed(np.arange(1, 257, dtype="u8") * np.uint64(0x9E3779B97F4A7C15))
BYTES[BLANK] = 0
PLACES = _mixed(np.arange(1, 4097, dtype="u8") * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def word_hashes(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a byte array start, and a hash of each. A text starts at each of ``breaks``."""
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and not BLANK[data[end]]:  # to the end of the word
            blank = np.flatnonzero(BLANK[data[end : end + PIECE]])
            end = end + int(blank[0]) if len(blank) else min(end + PIECE, len(data))
        part = data[at:end]
        word = ~BLANK[part]
        first = word.copy()
        first[1:] &= ~word[:-1]
        own = breaks[np.searchsorted(breaks, at) : np.searchsorted(breaks, end)] - at
        first[own] |= word[own]
        s = np.flatnonzero(first)
        if len(s):
            part = part[s[0] :]  # blanks before the first word
            place = np.arange(len(part)) - np.repeat(s - s[0], np.diff(np.append(s - s[0], len(part))))
            hashes.append(_mixed(np.add.reduceat(BYTES[part] * PLACES[place & 4095], s - s[0])))
            starts.append(s + at)
        at = end
    if not starts:
        return np.zeros(0, "i8"), np.zeros(0, "u8")
    return np.concatenate(starts), np.concatenate(hashes)


def anchored(words: np.ndarray, texts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For runs of windows with one anchor: the first window, how many, and the hash of the anchor's
    gram. ``texts`` are the numbers of the texts that the words belong to."""
    out = ([], [], [])
    for at in range(0, max(0, len(words) - n + 1), STRETCH):
        part, text = words[at : at + STRETCH + n - 1], texts[at : at + STRETCH + n - 1]
        gram = part[: len(part) - GRAM + 1]
        for i in range(1, GRAM):
            gram = _mixed(gram) + part[i : len(part) - GRAM + 1 + i]
        gram = _mixed(gram)
        # The 40 highest bits decide, then the place: the first of equal ones.
        rank = (gram & ~np.uint64(0xFFFFFF)) | np.arange(len(gram), dtype="u8")
        span = n - GRAM + 1
        least = np.lib.stride_tricks.sliding_window_view(rank, span).min(axis=1)
        windows = np.flatnonzero(text[: len(least)] == text[n - 1 : n - 1 + len(least)])
        if not len(windows):
            continue
        spot = (least[windows] & np.uint64(0xFFFFFF)).astype("i8")
        new = np.flatnonzero(np.concatenate(([True], (spot[1:] != spot[:-1]) | (windows[1:] != windows[:-1] + 1))))
        out[0].append(windows[new] + at)
        out[1].append(np.diff(np.append(new, len(windows))))
        out[2].append(gram[spot[new]])
    return tuple(np.concatenate(x) if x else np.zeros(0, kind) for x, kind in zip(out, ("i8", "i8", "u8"), strict=True))


class Shard:
    """Suffix automaton over the words of reference passages; each state has the smallest key of
    the passages in which its words occur."""

    def __init__(self, passages: list[tuple[object, list[bytes]]]):
        """Passages with their keys, in the order of the keys."""
        self.moves: list[dict[bytes, int]] = [{}]
        self.link, self.size, self.least = [-1], [0], [None]
        moves, link, size, least = self.moves, self.link, self.size, self.least
        for key, words in passages:
            last = 0
            for w in words:
                to = moves[last].get(w)
                if to is not None:
                    last = to if size[to] == size[last] + 1 else self._split(last, to, w)
                    if least[last] is None:
                        least[last] = key
                    continue
                new, p, up = len(moves), last, 0
                moves.append({})
                size.append(size[last] + 1)
                link.append(0)
                least.append(key)
                while p >= 0:
                    there = moves[p]
                    if w in there:
                        up = there[w]
                        if size[up] != size[p] + 1:
                            up = self._split(p, up, w)
                        break
                    there[w] = new
                    p = link[p]
                link[new], last = up, new
        # From the longest: the smallest key of a state is that of all states that end like it.
        for s in sorted(range(1, len(link)), key=size.__getitem__, reverse=True):
            key, up = least[s], link[s]
            if up and key is not None and (least[up] is None or key < least[up]):
                least[up] = key

    def _split(self, p: int, to: int, w: bytes) -> int:
        """The state of exactly the words up to ``p`` and ``w``, taken out of state ``to``."""
        moves, link = self.moves, self.link
        new = len(moves)
        moves.append(dict(moves[to]))
        self.size.append(self.size[p] + 1)
        link.append(link[to])
        self.least.append(None)
        while p >= 0 and moves[p].get(w) == to:
            moves[p][w] = new
            p = link[p]
        link[to] = new
        return new

    def statistics(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """For each word the length of the longest match that ends there, and its state."""
        moves, link, size = self.moves, self.link, self.size
        state, length = 0, 0
        for w in words:
            while state and w not in moves[state]:
                state = link[state]
                length = size[state]
            if w in moves[state]:
                state = moves[state][w]
                length += 1
            yield length, state

    def first_seen(self, words: list[bytes], n: int) -> list:
        """For each window of ``n`` words the smallest key that has it, or None."""
        moves, link, size, least = self.moves, self.link, self.size, self.least
        out, state, length = [], 0, 0
        for w in words:  # as in ``statistics``
            to = moves[state].get(w)
            while to is None and state:
                state = link[state]
                length = size[state]
                to = moves[state].get(w)
            if to is not None:
                state, length = to, length + 1
            if length < n:
                out.append(None)
                continue
            at = state
            while size[link[at]] >= n:
                at = link[at]
            out.append(least[at])
        return out[n - 1 :]


def _scan(rows: DataFrame, n: int) -> DataFrame:
    """``a, g, code`` of the texts ``a, t`` with a window: the gram of each anchor, and first window * n +
    number of windows - 1."""
    out = pa.schema([("a", pa.int64()), ("g", pa.list_(pa.int64())), ("code", pa.list_(pa.int64()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1)
            offsets = np.frombuffer(texts.buffers()[1], "i4" if pa.types.is_binary(texts.type) else "i8")[texts.offset : texts.offset + len(texts) + 1].astype("i8")
            data = np.frombuffer(texts.buffers()[2] or b"", "u1")[offsets[0] : offsets[-1]]
            offsets = offsets - offsets[0]
            starts, hashes = word_hashes(data, offsets[:-1])
            text = np.searchsorted(offsets, starts, "right") - 1
            window, many, gram = anchored(hashes, text, n)
            home = text[window]
            first = np.searchsorted(text, np.arange(len(texts)))  # of each text, its first word
            bounds = np.searchsorted(home, np.arange(len(texts) + 1)).astype("i4")
            lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x)) for x in (gram.view("i8"), (window - first[home]) * n + many - 1)]
            made = pa.RecordBatch.from_arrays([b.column(0), *lists], schema=out)
            yield made.filter(pa.array(np.diff(bounds) > 0))

    return rows.mapInArrow(scan, "a long, g array<long>, code array<long>")


def _passages(texts: DataFrame, n: int, key: pa.DataType, schema: str) -> DataFrame:
    """``g, cid, a, id, pos, body`` of the anchors of texts ``a, id, t, found``: the passage's gram and
    hash, its text and first word there; the words where a task meets the passage first."""
    out = pa.schema([("g", pa.int64()), ("cid", pa.binary()), ("a", pa.int64()), ("id", key), ("pos", pa.int64()), ("body", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            g, cid, at, pos, body = [], [], [], [], []
            for i, (t, grams, codes) in enumerate(zip(b.column(2), b.column(3), b.column(4), strict=True)):
                words, grams, codes = t.as_py().split(), grams.values.to_numpy(), codes.values.to_numpy()
                for gram, code in zip(grams.tolist(), codes.tolist(), strict=True):
                    p, more = divmod(code, n)
                    if p + more + n > len(words):
                        continue  # of another text with the same hash
                    passage = b" ".join(words[p : p + more + n])
                    c = hashlib.blake2b(passage, digest_size=16).digest()
                    g.append(gram)
                    cid.append(c)
                    at.append(i)
                    pos.append(p)
                    body.append(None if c in seen else passage)
                    seen.add(c)
            if len(seen) > 500_000:
                seen.clear()
            at = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(cid, pa.binary()), b.column(0).take(at), b.column(1).take(at), pa.array(pos, pa.int64()), pa.array(body, pa.binary())], schema=out)

    return texts.select("a", "id", "t", "g", "code").mapInArrow(cut, f"g long, cid binary, a long, id {schema}, pos long, body binary")


def _runs(firsts: list, most) -> list[tuple[int, int, object]]:
    """First place, number and key of the runs of windows with one key, below ``most``."""
    runs, at = [], 0
    for i in range(1, len(firsts) + 1):
        if i == len(firsts) or firsts[i] != firsts[at]:
            if firsts[at] < most:
                runs.append((at, i - at, firsts[at]))
            at = i
    return runs


def _seen_first(passages: DataFrame, n: int, schema: str, shard: int) -> DataFrame:
    """``g, cid, o, c, k``: of the passages ``g, cid, least, most, body`` the ``c`` windows from window ``o``
    were first seen with key ``k``, where some document of the passage has a larger one."""
    spark = passages.sparkSession
    parts = -(-passages.count() // shard)
    dealt = passages.withColumn("shard", F.pmod(F.xxhash64("g"), F.lit(max(1, parts))))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def done(rows: list[tuple]) -> pd.DataFrame:
        """Rows are in the order of their keys, so the first one of a gram has its smallest key."""
        met: dict[int, list] = {}
        for g, _, least, most, _ in rows:
            mine = met.setdefault(g, [least, most, 0])
            mine[1:] = max(mine[1], most), mine[2] + 1
        split, made = [], []
        for row in rows:
            least, most, passages = met[row[0]]
            if least < most and passages == 1:  # a chain
                made.append((row[0], row[1], 0, row[4].count(b" ") + 2 - n, least))
            elif least < most:  # one document alone makes no window of another
                split.append((*row[:4], row[4].split()))
        automaton = Shard([(least, words) for _, _, least, _, words in split])
        for g, c, _, most, words in split:
            made += [(g, c, *run) for run in _runs(automaton.first_seen(words, n), most)]
        return pd.DataFrame(made, columns=["g", "cid", "o", "c", "k"])

    def match(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, rows = None, []
        for f in frames:
            for s, *row in f.itertuples(index=False, name=None):
                if s != at and rows:
                    yield done(rows)
                    rows = []
                at = s
                rows.append(row)
        if rows:
            yield done(rows)

    read = dealt.select("shard", "g", "cid", "least", "most", "body")
    # Little to read, but work: not to be joined into few tasks.
    return read.repartition(max(tasks, -(-parts // 64)), "shard").sortWithinPartitions("shard", "least").mapInPandas(match, f"g long, cid binary, o int, c int, k {schema}")


def later_windows(rows: DataFrame, *, n: int = 13, crowd: int = 2000, hot: int = 1000, shard: int = SHARD) -> DataFrame:
    """``a, id, windows``: for rows ``a, id, t`` (a hash of the row, its key, its text as bytes) the
    windows that also start in a text with a smaller key, as runs: number of the first word of the first
    window, times ``n``, plus number of windows, less 1.

    Grams and passages of over ``hot`` rows are joined in parts; a gram of over ``crowd`` different passages
    is cut into windows. The result depends on neither, nor on ``shard``.
    """
    spark, kind = rows.sparkSession, rows.schema["id"].dataType
    schema, key = kind.simpleString(), to_arrow_type(kind)
    modest_batches(spark)
    scanned = checkpoint(_scan(rows.select("a", "t"), n))
    each = scanned.select("a", F.explode(F.arrays_zip("g", "code")).alias("x")).select("a", "x.g", "x.code")
    counts = scanned.select(F.explode(F.array_distinct("g")).alias("g")).groupBy("g").agg(F.count("*").alias("n"))
    counts = checkpoint(counts.where("n > 1"), release=True)
    found = hot_join(each, counts.select("g"), ["g"], hot_keys(counts, ["g"], least=hot), "left_semi")
    found = checkpoint(found.groupBy("a").agg(F.collect_set(F.struct("g", "code")).alias("x")).select("a", "x.g", "x.code"), release=True)

    met = checkpoint(_passages(rows.join(found, "a"), n, key, schema), release=True)
    passages = met.groupBy("g", "cid").agg(F.count("*").alias("n"), F.min("id").alias("least"), F.max("id").alias("most"), F.first("body", True).alias("body"))
    passages = checkpoint(passages, release=True)
    crowded = checkpoint(passages.groupBy("g").agg(F.count("*").alias("c")).where(F.col("c") > crowd).select("g"), release=True)
    some = not crowded.isEmpty()
    known = passages.join(few(crowded), "g", "left_anti") if some else passages
    places, known = met.select("g", "cid", "a", "id", "pos"), known.select("g", "cid", "least", "most", "body")
    often = hot_keys(passages, ["g", "cid"], least=hot)
    if some:
        body = F.split(F.col("body").cast("string"), " ")
        inner = F.transform(F.sequence(F.lit(0), F.size(body) - n), lambda i: F.array_join(F.slice(body, i + 1, n), " ").cast("binary"))
        cut = passages.join(few(crowded), "g", "left_semi").select("g", "cid", "n", "least", "most", F.posexplode(inner).alias("o", "body"))
        # A window's hash is its gram and, longer, its name.
        cut = checkpoint(cut.select("g", "cid", F.xxhash64("body").alias("g2"), F.unhex(F.md5("body")).alias("cid2"), "o", "n", "least", "most", "body"), release=True)
        single = cut.groupBy(F.col("g2").alias("g"), F.col("cid2").alias("cid")).agg(F.min("least").alias("least"), F.max("most").alias("most"), F.first("body").alias("body"), F.sum("n").alias("n"))
        single = checkpoint(single, release=True)
        known = known.unionByName(single.drop("n"))
        moved = hot_join(places, cut.select("g", "cid", "g2", "cid2", "o"), ["g", "cid"], often)
        moved = checkpoint(moved.select(F.col("g2").alias("g"), F.col("cid2").alias("cid"), "a", "id", (F.col("pos") + F.col("o")).alias("pos")), release=True)
        places = places.unionByName(moved)
        more = hot_keys(single, ["g", "cid"], least=hot)
        often = more if often is None else often if more is None else checkpoint(often.unionByName(more).groupBy("g", "cid").agg(F.max("parts").alias("parts")))
    firsts = checkpoint(_seen_first(known, n, schema, shard), release=True)
    seen = hot_join(places, firsts, ["g", "cid"], often)
    code = (F.col("pos") + F.col("o")) * n + F.col("c") - 1
    return seen.where(F.col("k") < F.col("id")).select("a", "id", code.alias("w")).groupBy("a", "id").agg(F.collect_set("w").alias("windows"))


RESULT = "kept binary, n_words long, n_removed long, n_spans long"


def _without(text: bytes, windows: np.ndarray | None, n: int) -> tuple[bytes, int, int, int]:
    words = text.split()
    if windows is None:
        return b" ".join(words), len(words), 0, 0
    first, more = np.divmod(np.asarray(windows, "i8"), n)
    change = np.zeros(len(words) + 1, "i8")
    np.add.at(change, first, 1)
    np.add.at(change, first + more + n, -1)
    gone = np.cumsum(change[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]), len(words), int(gone.sum()), spans


def drop_known_passages(docs: DataFrame, *, text: str = "text", key: str = "doc_id", n: int = 13, crowd: int = 2000, hot: int = 1000, shard: int = SHARD) -> DataFrame:
    """``docs`` with ``kept`` (the remaining words, joined by one space), n_words, n_removed (words) and
    n_spans (maximal runs of them).

    Words are the maximal runs of anything but ASCII white space. Each word that is covered by ``n``
    consecutive words which also start in a document with a smaller key goes; windows are judged on the
    input. Keys are of any type that Spark orders and Arrow knows. A document with a null key loses nothing
    and takes nothing from others; documents of one key, repeated rows among them, take nothing from each
    other. Null text is empty. Texts of any length are read whole, one at a time. An empty table gives an
    empty result. Columns of the added names are replaced, others pass through. ``n`` must be
    over the gram of 4 words. The result depends neither on ``crowd`` and ``hot`` nor on ``shard``.
    """
    if n <= GRAM:
        raise ValueError(f"n: over {GRAM}")
    added = ("kept", "n_words", "n_removed", "n_spans")
    kept = [c for c in docs.columns if c not in (*added, "_mr_a", "_mr_id", "_mr_windows")]
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    a: Column = F.xxhash64(F.col(key), F.col(text))
    rows = docs.select(a.alias("a"), F.col(key).alias("id"), body.alias("t")).where(F.col("id").isNotNull() & (F.octet_length("t") >= 2 * n - 1))
    path = scratch(docs.sparkSession, "windows")
    with workspace(docs.sparkSession):
        made = later_windows(rows, n=n, crowd=crowd, hot=hot, shard=shard)
        made.write.parquet(path)
    found = docs.sparkSession.read.schema(made.schema).parquet(path)

    @F.pandas_udf(RESULT)
    def remove(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, windows in batches:
            yield pd.DataFrame([_without(t, w, n) for t, w in zip(texts, windows, strict=True)], columns=["kept", "n_words", "n_removed", "n_spans"])

    mine = found.select(F.col("a").alias("_mr_a"), F.col("id").alias("_mr_id"), F.col("windows").alias("_mr_windows"))
    tagged = docs.select(*kept, a.alias("_mr_a"), F.col(key).alias("_mr_id")).join(mine, ["_mr_a", "_mr_id"], "left")
    made = tagged.select(*kept, remove.asNondeterministic()(body, F.col("_mr_windows")).alias("_mr_made"))
    return made.select(*kept, F.col("_mr_made.kept").cast("string").alias("kept"), "_mr_made.n_words", "_mr_made.n_removed", "_mr_made.n_spans")
