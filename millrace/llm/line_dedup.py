"""Corpus-wide removal of repeated lines.

Two Bloom filters tell which line hashes have been seen once and which twice. They are
filled per partition, as sorted bit positions, so what moves grows with the lines and not
with partitions times filter size, and merged in two levels: a bit is in the second
filter if one part has it there or two parts have it in the first. A line that repeats
has all its bits in the second filter; only lines that pass it are counted exactly.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, hot_join, hot_keys, modest_batches, row_ids

BLANKS = b" \t\n\x0b\x0c\r"
#: Bits of a filter that are merged as one row.
SEGMENT = 1 << 20
PROBES = 2
PARTS = "segment int, salt int, once binary, twice binary"


def line_key(line: bytes) -> bytes:
    """Stripped of ASCII white space at both ends, A-Z lower-cased."""
    return line.strip(BLANKS).lower()


def digest(key: bytes) -> bytes:
    """128 bits; used as the exact identity of a key."""
    return hashlib.blake2b(key, digest_size=16).digest()


def _lines(text) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split(b"\n") if isinstance(text, str) else [b""]


def _long(key: bytes, least: int) -> bool:
    """At least ``least`` code points."""
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def _digests(text, least: int) -> set[bytes]:
    return {digest(k) for k in set(map(line_key, _lines(text))) if _long(k, least)}


def _positions(digests: set[bytes], bits: int) -> np.ndarray:
    halves = np.frombuffer(b"".join(digests), "<u8")
    return (halves & np.uint64(bits - 1)).astype("u4")


def _pack(positions: np.ndarray) -> bytes:
    return zlib.compress(np.diff(positions, prepend=0).astype("<u4").tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(packed), "<u4"), dtype="i8")


def _fill(bits: int, least: int, salts: int):
    """Bit positions of each document's distinct line keys: once, and twice within these rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        salt = TaskContext.get().partitionId() % salts
        seen, again, kept = set(), set(), 0

        def parts():
            once, twice = (np.unique(_positions(x, bits)) for x in (seen, again))
            for s in np.unique(once // SEGMENT):
                a, b = (x[np.searchsorted(x, s * SEGMENT) : np.searchsorted(x, (int(s) + 1) * SEGMENT)] % SEGMENT for x in (once, twice))
                yield int(s), salt, _pack(a), _pack(b)

        for batch in batches:
            for text in batch["t"]:
                keys = _digests(text, least)
                again |= keys & seen
                seen |= keys
            if len(seen) > 500_000:
                yield pd.DataFrame(parts(), columns=["segment", "salt", "once", "twice"])
                seen, again = set(), set()
        yield pd.DataFrame(parts(), columns=["segment", "salt", "once", "twice"])

    return run


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come ordered by segment (and salt); one segment is in memory at a time."""
    at, once, twice = None, None, None

    def done():
        return pd.DataFrame([(*at, _pack(np.flatnonzero(once)), _pack(np.flatnonzero(twice)))], columns=["segment", "salt", "once", "twice"])

    for batch in batches:
        for segment, salt, a, b in batch.itertuples(index=False):
            if (segment, salt) != at:
                if at is not None:
                    yield done()
                at, once, twice = (segment, salt), np.zeros(SEGMENT, bool), np.zeros(SEGMENT, bool)
            a = _unpack(a)
            twice[a[once[a]]] = True
            twice[_unpack(b)] = True
            once[a] = True
    if at is not None:
        yield done()


def twice_seen(docs: DataFrame, *, text: str = "text", min_chars: int = 1, bits_per_line: int = 12, max_bytes: int = 128 << 20, salts: int = 32) -> np.ndarray:
    """The second filter as bytes. Its size follows the number of lines up to ``max_bytes``
    (90 million lines at 12 bits), the bound on what is built on the driver and broadcast;
    what the driver gets is the packed places of its set bits, so as many as lines that
    repeat. Beyond that it fills up, more lines are suspected and shuffle, and the result
    stays the same."""
    modest_batches(docs.sparkSession)
    t = F.col(text)
    n = docs.agg(F.sum(F.coalesce(F.length(t) - F.length(F.translate(t, "\n", "")), F.lit(0)) + 1)).first()[0] or 0
    bits = 1 << min(max(16, int(n * bits_per_line).bit_length()), max_bytes.bit_length() + 2)
    merged = docs.select(t.alias("t")).mapInPandas(_fill(bits, min_chars, salts), PARTS)
    for by in (["segment", "salt"], ["segment"]):
        merged = merged.select("segment", F.col("salt") if len(by) > 1 else F.lit(0).cast("int").alias("salt"), "once", "twice")
        merged = merged.repartition(*by).sortWithinPartitions("segment", "salt").mapInPandas(_merge, PARTS)
    out = np.zeros(bits // 8, "u1")
    for r in merged.select("segment", "twice").collect():
        on = np.zeros(min(SEGMENT, bits), bool)
        on[_unpack(bytes(r["twice"]))] = True
        at = r["segment"] * SEGMENT // 8
        out[at : at + len(on) // 8] = np.packbits(on, bitorder="little")
    return out


def _suspects(bloom: np.ndarray, digests: list[bytes]) -> list[bytes]:
    if not digests:
        return []
    at = (np.frombuffer(b"".join(digests), "<u8") & np.uint64(8 * len(bloom) - 1)).astype("i8")
    hit = (bloom[at >> 3] >> (at & 7).astype("u1") & 1).reshape(-1, PROBES).all(1)
    return [digests[i] for i in np.flatnonzero(hit)]


def _carried(docs: DataFrame, key: str) -> tuple:
    """The key as Python gets it (never null where it is a number, which pandas would make a
    float), whether there is one, and its type."""
    kind = docs.schema[key].dataType.simpleString()
    k = F.col(key)
    return F.coalesce(k, F.lit(0).cast(kind)) if kind in ("tinyint", "smallint", "int", "bigint") else k, k.isNotNull(), kind


def frequent_keys(docs: DataFrame, *, text: str = "text", key: str = "doc_id", min_docs: int = 10, min_chars: int = 1, **filters) -> DataFrame:
    """``digest, n_docs, first`` of the line keys in at least ``min_docs`` rows; ``first`` is
    the smallest key among those rows. Each task adds up its own suspects before they shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(twice_seen(docs, text=text, min_chars=min_chars, **filters))
    k, there, kind = _carried(docs, key)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[bytes, list] = {}
        for batch in batches:
            for t, k, has in zip(batch["t"], batch["k"], batch["has"], strict=True):
                for d in _suspects(shared.value, list(_digests(t, min_chars))):
                    if (old := found.get(d)) is None:
                        found[d] = [1, k if has else None]
                    else:
                        old[0] += 1
                        if has and (old[1] is None or k < old[1]):
                            old[1] = k
            if len(found) > 300_000:
                yield _counted(found)
                found = {}
        yield _counted(found)

    def _counted(found: dict) -> pd.DataFrame:
        made = pd.DataFrame([(d, n, k) for d, (n, k) in found.items()], columns=["digest", "n", "first"]).astype({"n": "i8"})
        return made.astype({"first": "Int64"}) if kind == "bigint" else made

    rows = docs.select(F.col(text).alias("t"), k.alias("k"), there.alias("has")).mapInPandas(count, f"digest binary, n long, first {kind}")
    return rows.groupBy("digest").agg(F.sum("n").alias("n_docs"), F.min("first").alias("first")).where(F.col("n_docs") >= min_docs)


def _drop(text, key, firsts: dict, min_chars: int, keep: str) -> tuple[str, int, int]:
    lines, kept, met = _lines(text), [], set()
    for line in lines:
        x = line_key(line)
        d = digest(x) if _long(x, min_chars) else None
        if d in firsts:
            if keep == "none" or d in met or key is None or key != firsts[d]:
                continue
            met.add(d)
        kept.append(line)
    return b"\n".join(kept).decode("utf-8", "surrogatepass"), len(lines), len(lines) - len(kept)


RESULT = "text string, n_lines long, n_dropped long"


def drop_frequent_lines(docs: DataFrame, *, text: str = "text", key: str = "doc_id", min_docs: int = 10, min_chars: int = 1, keep: str = "none", max_broadcast: int = 200_000, **filters) -> DataFrame:
    """``docs`` with ``text`` cleaned, and ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line stripped of ASCII white space with A-Z lower-cased. Lines
    whose key has ``min_chars`` code points and is found in ``min_docs`` rows go:
    ``keep="none"`` drops them everywhere, ``keep="first"`` leaves the first one in the row
    with the smallest ``key``. Each row counts as one document, repeated rows included.
    Null or empty text is one empty line; its result is ``""``, as it is where every line
    goes. A null ``key`` never holds the first occurrence; keys may be numbers or text. Columns
    named ``n_lines`` and ``n_dropped`` are replaced, others pass through. Texts of any
    length are read whole; an empty table gives an empty result. Up to ``max_broadcast``
    frequent keys are broadcast; more are joined to the rows they occur in.
    """
    if keep not in ("none", "first"):
        raise ValueError(f"keep: {keep}")
    spark = docs.sparkSession
    frequent = checkpoint(frequent_keys(docs, text=text, key=key, min_docs=min_docs, min_chars=min_chars, **filters))
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    t, (k, there, _) = F.col(text), _carried(docs, key)
    if frequent.count() <= max_broadcast:
        firsts = spark.sparkContext.broadcast({bytes(r["digest"]): r["first"] for r in frequent.collect()})

        @F.pandas_udf(RESULT)
        def clean(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            for ts, ks, has in batches:
                yield pd.DataFrame([_drop(x, y if h else None, firsts.value, min_chars, keep) for x, y, h in zip(ts, ks, has, strict=True)], columns=["text", "n_lines", "n_dropped"])

        # Not deterministic for Spark, or a filter on the result would clean twice.
        made = docs.select(*kept, clean.asNondeterministic()(t, k, there).alias("_mr_made"))
    else:
        made = _joined(docs, kept, t, k, there, frequent, min_chars, keep)
    return made.select(*[F.col("_mr_made.text").alias(c) if c == text else F.col(c) for c in kept], "_mr_made.n_lines", "_mr_made.n_dropped")


def _joined(docs: DataFrame, kept: list[str], t, k, there, frequent: DataFrame, min_chars: int, keep: str) -> DataFrame:
    """The same without a broadcast: rows of equal key and text share one list of their
    frequent lines, found by a join on the digest."""

    @F.pandas_udf("array<binary>")
    def digests(texts: pd.Series) -> pd.Series:
        return pd.Series([list(_digests(s, min_chars)) for s in texts])

    @F.pandas_udf(RESULT)
    def clean(ts: pd.Series, ks: pd.Series, has: pd.Series, found: pd.Series) -> pd.DataFrame:
        rows = []
        for x, y, h, f in zip(ts, ks, has, found, strict=True):
            firsts = {} if f is None else {bytes(z["digest"]): z["first"] for z in f}
            rows.append(_drop(x, y if h else None, firsts, min_chars, keep))
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

    a, b = row_ids(k, there, t)
    row = [a.alias("_mr_a"), b.alias("_mr_b")]
    lines = docs.select(*row, digests(t).alias("d")).distinct().select("_mr_a", "_mr_b", F.explode("d").alias("digest"))
    often = hot_keys(frequent.select("digest", F.col("n_docs").alias("n")), ["digest"])
    found = hot_join(lines, frequent.select("digest", "first"), ["digest"], often).groupBy("_mr_a", "_mr_b").agg(F.collect_list(F.struct("digest", "first")).alias("_mr_found"))
    wide = docs.select(*kept, *row).join(found, ["_mr_a", "_mr_b"], "left")
    return wide.select(*kept, clean.asNondeterministic()(t, k, there, F.col("_mr_found")).alias("_mr_made"))
