"""Language identification by cross-parsing against labelled text.

Every language gets a suffix automaton of the running text of a bounded sample of its
labelled documents. A new text is parsed greedily into the longest phrases that occur
somewhere in that sample; text of the same language needs few, long phrases. The phrases
per byte, times the logarithm of the size of the sample, estimate the cross entropy, and the
language with the smallest estimate wins.

Texts are what ``common.letters`` leaves of them, in UTF-8 bytes, in the sample as in the
parsed text; phrases go across words. An automaton is made into a table of moves, so that a
task parses all texts of a batch at once, a byte of each at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpoint, few, has_letters, letters, modest_batches

UNKNOWN = "und"
RESULT = "lang_pred string, score double"
#: Bytes after which a long text begins a new phrase, so that its parts are parsed side by side.
STRETCH = 2048
#: Bytes of texts that are laid out at once.
LAID_OUT = 16 << 20


class SuffixAutomaton:
    """All substrings of a set of texts; ``moves[state]`` maps a symbol to a state."""

    def __init__(self, texts: list):
        self.moves: list[dict] = [{}]
        self._link, self._size = [-1], [0]
        for text in texts:
            last = 0
            for ch in text:
                last = self._extend(last, ch)
        del self._link, self._size

    def _state(self, size: int, moves: dict, link: int) -> int:
        self._size.append(size)
        self.moves.append(moves)
        self._link.append(link)
        return len(self.moves) - 1

    def _split(self, p: int, q: int, ch) -> int:
        """The state for exactly what reads ``ch`` after ``p``, taken out of ``q`` if need be."""
        if self._size[q] == self._size[p] + 1:
            return q
        copy = self._state(self._size[p] + 1, dict(self.moves[q]), self._link[q])
        while p >= 0 and self.moves[p].get(ch) == q:
            self.moves[p][ch] = copy
            p = self._link[p]
        self._link[q] = copy
        return copy

    def _extend(self, last: int, ch) -> int:
        if (q := self.moves[last].get(ch)) is not None:
            return self._split(last, q, ch)
        new, p = self._state(self._size[last] + 1, {}, 0), last
        while p >= 0 and ch not in self.moves[p]:
            self.moves[p][ch] = new
            p = self._link[p]
        if p >= 0:
            self._link[new] = self._split(p, self.moves[p][ch], ch)
        return new


@dataclass
class Parser:
    """One language: ``symbols`` translates bytes to columns of ``table``; 0 stands for the end
    of a text, 1 for bytes that the sample does not have. ``table[state + symbol]`` is
    4 * next state + phrases that end, where a state is its row's place in the flat table."""

    size: int
    symbols: bytes
    table: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Parser:
        moves = SuffixAutomaton(texts).moves
        known = sorted(moves[0])
        symbols, width = bytearray([1] * 256), len(known) + 2
        column = {}
        for n, byte in enumerate(known):
            # A byte of UTF-8 is one of 243, so columns fit in a byte.
            symbols[byte] = column[byte] = n + 2
        table = np.zeros((len(moves), width), "i4")
        for ch, to in moves[0].items():
            table[:, column[ch]] = 4 * to * width
        ends = (np.arange(len(moves)) > 0).astype("i4")
        table += ends[:, None]  # no move: the phrase ends, and the next one starts from the root
        table[:, 1] += 1  # a byte that is nowhere in the sample is a phrase
        for state in range(1, len(moves)):
            for ch, to in moves[state].items():
                table[state, column[ch]] = 4 * to * width
        return cls(sum(map(len, texts)), bytes(symbols), table.ravel())


class LanguageModel:
    """One parser per language, in the order of their names."""

    def __init__(self, samples: dict[str, list[bytes]]):
        self.parsers = {lang: Parser.of(samples[lang]) for lang in sorted(samples)}

    @property
    def langs(self) -> list[str]:
        return list(self.parsers)

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text in each language: longest matches, one for an unseen byte, and
        a new one after every STRETCH bytes."""
        out = np.zeros((len(texts), len(self.parsers)), "i8")
        begin = 0
        while begin < len(texts):
            end, laid = begin, 0
            while end < len(texts) and (end == begin or laid + len(texts[end]) <= LAID_OUT):
                laid += len(texts[end])
                end += 1
            self._parse(texts[begin:end], out[begin:end])
            begin = end
        return out

    def _parse(self, texts: list[bytes], out: np.ndarray) -> None:
        lengths = np.array([len(t) for t in texts])
        pieces = -(-lengths // STRETCH)
        owner = np.repeat(np.arange(len(texts)), pieces)
        first = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(np.cumsum(lengths) - lengths, pieces) + first * STRETCH
        size = np.minimum(lengths[owner] - first * STRETCH, STRETCH)
        order = np.argsort(-size, kind="stable")
        owner, start, size = owner[order], start[order], size[order]
        if not len(size):
            return
        raw, n = b"".join(texts), int(size[0])
        going = len(size) - np.searchsorted(size[::-1], np.arange(n), side="right")  # pieces with a byte at each place
        for which, parser in enumerate(self.parsers.values()):
            symbols = np.frombuffer(raw.translate(parser.symbols), "u1")
            state, count = np.zeros(len(size), "i4"), np.zeros(len(size), "i4")
            for at in range(n):
                k = going[at]
                step = parser.table[state[:k] + symbols[start[:k] + at]]
                count[:k] += step & 3
                state[:k] = step >> 2
            count += parser.table[state] & 3  # the end
            out[:, which] = np.bincount(owner, count, len(texts))

    def predict(self, texts: list[bytes]) -> list[tuple[str, float]]:
        """For each text (``common.letters`` in UTF-8; empty: no letters) the language with the
        smallest estimate (the first name on a tie), and second / (best + second), 0.5 for a
        tie and 1 if there is one language. ``und`` and 0 without letters or languages."""
        if not self.parsers:
            return [(UNKNOWN, 0.0)] * len(texts)
        bits = np.array([math.log2(p.size + 1) for p in self.parsers.values()])
        estimates = self.phrases(texts) * bits
        best = estimates.argmin(1)
        ranked = np.sort(estimates, axis=1)
        langs, made = self.langs, []
        for i, t in enumerate(texts):
            if not t:
                made.append((UNKNOWN, 0.0))
            else:
                made.append((langs[best[i]], float(ranked[i, 1] / (ranked[i, 0] + ranked[i, 1])) if len(langs) > 1 else 1.0))
        return made


def fit(labelled: DataFrame, *, text: str = "text", lang: str = "lang", key: str = "doc_id", max_docs: int = 200, max_bytes: int = 64_000, max_total: int = 1_000_000, max_langs: int = 500) -> LanguageModel:
    """Learn from rows with a label, a key and letters.

    The fit is on a bounded sample of whole rows. Of each language the ``max_docs`` rows whose
    keys have the smallest hashes are looked at; in this order they teach as far as
    ``max_bytes`` hold (``max_total`` shared among the languages, if that is less), the first
    one in any case. Rows with null label or key are not looked at; text that is null or
    without a letter teaches nothing. More than ``max_langs`` labels raise ValueError. An
    empty table gives a model that answers ``und``. Extra columns are ignored.
    """
    rows = labelled.select(F.col(key).alias("k"), F.col(lang).alias("l"), F.col(text).alias("t")).where(F.col("k").isNotNull() & F.col("l").isNotNull())
    first = Window.partitionBy("l").orderBy(F.xxhash64("k"), "k")
    picked = checkpoint(rows.select("k", "l").withColumn("n", F.row_number().over(first)).where(F.col("n") <= max_docs).select("k", "l").distinct())
    n_langs = picked.select("l").distinct().limit(max_langs + 1).count()
    if n_langs > max_langs:
        raise ValueError(f"{lang} has more than {max_langs} values")
    bound = min(max_bytes, max_total // max(1, n_langs))
    texts = rows.join(few(picked), ["k", "l"]).where(has_letters(F.col("t"))).select("l", F.xxhash64("k").alias("h"), "k", letters(F.col("t")).cast("binary").alias("t"))
    order = Window.partitionBy("l").orderBy("h", "k", "t")
    before = F.sum(F.octet_length("t")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    taken = texts.withColumns({"used": before, "n": F.row_number().over(order)}).where((F.col("used") <= bound) | (F.col("n") == 1))
    samples: dict[str, list[bytes]] = {}
    for r in taken.select("l", "n", "t").orderBy("l", "n").collect():
        samples.setdefault(r["l"], []).append(bytes(r["t"]))
    return LanguageModel(samples)


def predictor(model: LanguageModel, df: DataFrame):
    """Column function text -> struct(lang_pred, score)."""
    modest_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            yield pd.DataFrame(m.predict([t or b"" for t in texts]), columns=["lang_pred", "score"])

    # Not deterministic for Spark, or a filter on its result would run it twice.
    return lambda text: predict.asNondeterministic()(F.when(has_letters(text), letters(text).cast("binary")))


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), one row in, one row out.

    Null text, and text without a letter (numbers are none), give ``und`` and 0. Columns of
    those two names are replaced; other columns pass through. Repeated rows are judged alike.
    Texts of any length are read whole; an empty table gives an empty result.
    """
    made = predictor(model, docs)(F.col(text))
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*kept, made.alias("_mr_made")).select(*kept, "_mr_made.lang_pred", "_mr_made.score")
