"""Chat formatting of reply trees.

Messages form trees by parent. Root-to-leaf paths are enumerated by self-joins that double
the distance to an ancestor in each round, so a path of n messages takes log2(n) rounds;
paths are ranked by their score and the chosen ones are formatted as conversations.

The format of a turn is ``### <role>: <text></turn>\\n``. Inside roles and texts a backslash is
put before each backslash, each ``###`` and each ``</turn>``, so marks are unambiguous and the
escape can be undone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpoint, hot_join, hot_keys, modest_batches

#: The marks of the template.
OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
_CONTROL = re.compile(r"\\|###|</turn>|:(?= )")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
#: What ends a role and a text; an escape pair is stepped over.
_ROLE_END = re.compile(r"\\(?:\\|###|</turn>|:)|: ")
_TEXT_END = re.compile(r"\\(?:\\|###|</turn>|:)|</turn>\n")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]], trained: str = "assistant") -> tuple[str, list[list[int]]]:
    """The formatted conversation, and the loss mask: [start, end) in code points around
    each escaped text of a ``trained`` turn."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role) + COLON, escape(text)
        at += len(head)
        if role == trained:
            mask.append([at, at + len(body)])
        at += len(body) + len(CLOSE)
        parts += [head, body, CLOSE]
    return "".join(parts), mask


def _until(pattern: re.Pattern, mark: str, formatted: str, at: int) -> int:
    """Place of the next unescaped ``mark`` from ``at`` on; one match is held at a time."""
    for m in pattern.finditer(formatted, at):
        if m[0] == mark:
            return m.start()
    raise ValueError(f"no turn at {at}")


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns of a formatted conversation; ValueError if it is not one."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError(f"no turn at {at}")
        colon = _until(_ROLE_END, COLON, formatted, at + len(OPEN))
        end = _until(_TEXT_END, CLOSE, formatted, colon + len(COLON))
        turns.append((unescape(formatted[at + len(OPEN) : colon]), unescape(formatted[colon + len(COLON) : end])))
        at = end + len(CLOSE)
    return turns


def _often(rows: DataFrame, key: str, least: int = 1000) -> DataFrame | None:
    return hot_keys(rows.groupBy(key).agg(F.count("*").alias("n")), [key], least=least)


def best_paths(messages: DataFrame, *, top: int = 1, max_rounds: int = 40) -> DataFrame:
    """``root, leaf, rank, node, depth`` for every message on the chosen paths.

    ``messages`` has ``node, parent, score`` (parent null or unknown: a root). A path's score
    is the mean of its messages' scores (null counts 0); the ``top`` leaves of each root are
    chosen by score, then the longer path, then the smallest leaf. Repeated nodes count once,
    with their smallest parent and largest score. A cycle has no root and raises RuntimeError.
    Other columns are ignored.
    """
    rows = checkpoint(messages.groupBy("node").agg(F.min("parent").alias("parent"), F.max(F.coalesce("score", F.lit(0.0))).alias("score")))
    answers, roots = rows.where("parent is not null"), rows.where("parent is null")
    known = rows.select(F.col("node").alias("parent"), F.lit(True).alias("there"))
    answers = hot_join(answers, known, ["parent"], _often(answers, "parent"), "left")
    rows = answers.unionByName(roots.withColumn("there", F.lit(None).cast("boolean"))).select("node", F.when(F.col("there"), F.col("parent")).alias("jump"), "score")
    now = checkpoint(rows.select("node", "jump", F.col("node").alias("top"), F.col("score").alias("total"), F.lit(1).cast("long").alias("n")))
    inner = now.where("jump is not null").select(F.col("jump").alias("node")).distinct()
    leaves = checkpoint(now.join(inner, "node", "left_anti").select("node"))
    tables = []
    for _ in range(max_rounds):
        going = now.where("jump is not null")  # the others have met their root and rest
        if going.isEmpty():
            break
        tables.append(going.select("node", "jump"))
        far = now.select(F.col("node").alias("jump"), F.col("jump").alias("j2"), F.col("top").alias("t2"), F.col("total").alias("s2"), F.col("n").alias("n2"))
        # All messages of a large tree meet its root in the end.
        met = hot_join(going, far, ["jump"], _often(going, "jump"))
        further = met.select("node", F.col("j2").alias("jump"), F.col("t2").alias("top"), (F.col("total") + F.col("s2")).alias("total"), (F.col("n") + F.col("n2")).alias("n"))
        now = checkpoint(now.where("jump is null").unionByName(further))
    else:
        raise RuntimeError("replies form a cycle")
    paths = now.select("node", F.col("top").alias("root"), F.col("n").alias("depth"), (F.col("total") / F.col("n")).alias("score"))
    ends = leaves.join(paths, "node")
    order = Window.partitionBy("root").orderBy(F.desc("score"), F.desc("depth"), "node")
    chosen = ends.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("root", F.col("node").alias("leaf"), "rank")
    on_path = checkpoint(chosen.withColumn("node", F.col("leaf")))
    for jumps in tables:  # ancestors at distance < 2 ** k, then those 2 ** k above them
        on_path = checkpoint(on_path.unionByName(on_path.join(jumps, "node").select("root", "leaf", "rank", F.col("jump").alias("node"))))
    return on_path.join(paths.select("node", "depth"), "node").select("root", "leaf", "rank", "node", "depth")


FORMATTED = "formatted string, loss_mask array<array<int>>"


def format_conversations(turns: DataFrame, *, by: str = "conv_id", order: str = "at", trained: str = "assistant") -> DataFrame:
    """``by, formatted, loss_mask``: one row per value of ``by``, from its rows ``order, role, text``.

    A conversation becomes one string, so its turns meet in one task; nothing else does.
    Null roles and texts are empty strings; a null ``by`` is a conversation; ties in ``order``
    go by role and text. Texts of any length are kept whole, in memory that grows with the
    conversation. Columns of other names are ignored.
    """
    modest_batches(turns.sparkSession)
    empty = F.lit("")
    turn = F.struct(order, F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))

    @F.pandas_udf(FORMATTED)
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for many in batches:
            yield pd.DataFrame([render([(t["role"], t["text"]) for t in one], trained) for one in many], columns=["formatted", "loss_mask"])

    grouped = turns.groupBy(by).agg(F.sort_array(F.collect_list(turn)).alias("_mr_turns"))
    return grouped.select(by, made("_mr_turns").alias("_mr_made")).select(by, "_mr_made.*")


def read_back(formatted: DataFrame, *, by: str = "conv_id") -> DataFrame:
    """Digest of what a reader of ``formatted`` and ``loss_mask`` gets: ``by, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars``."""

    @F.pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    def digest(texts: pd.Series, masks: pd.Series) -> pd.DataFrame:
        rows = []
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for text, mask in zip(texts, masks, strict=True):
            turns = parse(text)
            loss = "".join(unescape(text[a:b]) for a, b in mask)
            rows.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)))
        return pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select(by, digest("formatted", "loss_mask").alias("_mr_made")).select(by, "_mr_made.*")


def format_trees(messages: DataFrame, *, top: int = 1, trained: str = "assistant") -> DataFrame:
    """``conv_id, rank, leaf, formatted, loss_mask`` of the ``top`` root-to-leaf paths of every
    tree in ``messages`` (``conv_id, node, parent, role, text, score``), best first. Messages with
    a null node are left out; of repeated nodes one row gives the text. A null parent, or one
    that is not there, makes a root. Texts of any length are kept whole: a path becomes one
    string, in one task. Extra columns are ignored. An empty table gives an empty result."""
    rows = messages.where("node is not null")
    paths = best_paths(rows, top=top)
    body = rows.dropDuplicates(["node"]).select("node", "conv_id", "role", "text")
    turns = paths.join(body, "node").select(F.struct("conv_id", "root", "rank", "leaf").alias("path"), F.col("depth").alias("at"), "role", "text")
    made = format_conversations(turns, by="path", trained=trained)
    return made.select("path.conv_id", "path.rank", "path.leaf", "formatted", "loss_mask")


def as_trees(conversations: DataFrame) -> DataFrame:
    """Linear conversations (``conv_id, turn, role, text``) as reply trees: each turn answers
    the one before. A node is a struct of whether the id is null, the id as text, and the place; ties in
    ``turn`` go by role and text. Null ids form a conversation of their own, whatever texts other ids are. The
    turns of one conversation are numbered in one task, which its one string needs anyway. Extra columns are left
    out."""
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    at = conversations.withColumn("_mr_at", F.row_number().over(w))
    name = lambda i: F.struct(F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("id"), i.alias("place"))
    return at.select("conv_id", name(F.col("_mr_at")).alias("node"), F.when(F.col("_mr_at") > 1, name(F.col("_mr_at") - 1)).alias("parent"), "role", "text", F.lit(0.0).alias("score"))
