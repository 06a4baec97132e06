"""Reply trees to formatted conversations.

Messages point to the message they answer. Iterative self-joins double the
pointers: after k rounds every message knows the message 2^k replies above it
and the score of the stretch between, so root-to-leaf paths of depth d need
about 2 log2(d) joins. Each leaf ends one branch; the branches of a tree are
ranked by the summed score of their path, and each branch chosen is formatted
as one conversation with its loss mask.

Format: a turn is ``### <role>: <text></turn>`` and a line feed. In texts and
roles a backslash, ``#``, ``<`` and ``:`` (roles) get a backslash before them, so no
text can open or close a turn, and taking the backslashes away gives the text
back. The loss mask is a list of (start, end) spans of code points, end
exclusive, one for each turn by an assistant, around its escaped text.

Defined results: null texts and roles are empty; rows without a tree id form one
tree of their own (null id); a message whose parent is null, absent, itself or
in a cycle: null or absent parents make it a root; messages on cycles, and what
answers them, have no root and belong to no path. Repeated message ids within a
tree: all of them are answered, so a branch runs through each. Ties between
branches go to the smaller leaf id. Extra columns are not read.

One formatted conversation is one row; its turns are gathered in the task that
writes it, which is bounded by the conversation itself.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import pandas_udf, stored

ASSISTANT = "assistant"
# possessive runs: nothing is kept for each character of a long text
_TURN = re.compile(r"### ((?:[^\\#<:]++|\\.)*+): ((?:[^\\#<]++|\\.)*+)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: Column, marks: str = r"[\\#<]") -> Column:
    """Backslash before every character that could be part of a control string."""
    return F.regexp_replace(text, f"({marks})", r"\\$1")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def chain_messages(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """A plain turn table as reply trees: each row answers the row before it in
    its conversation (by turn, nulls first, then role and text)."""
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = turns.select(
        F.col(conv).cast("long").alias("tree"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    return rows.withColumn("id", F.row_number().over(order).cast("long")).select(
        "tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )


def branch_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The best ``branches`` root-to-leaf paths of every tree: one row for each
    message of a path, with ``tree``, ``branch`` (rank from 1), ``leaf``, ``id``
    and ``above`` (replies between the message and the leaf).

    ``messages``: stored table ``tree``, ``id``, ``parent``, ``score``.
    """
    nodes = messages.select("tree", "id", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    known = nodes.select(F.col("tree").alias("t"), F.col("id").alias("p")).distinct()
    # ``to``: the message 2^k above; ``sum``: score from the message up to just below ``to``,
    # or up to the root where there is none
    jump = stored(
        nodes.join(known, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("p")) & (F.col("parent") != F.col("id")), "left")
        .select("tree", "id", F.col("p").alias("to"), F.col("score").alias("sum")),
        "chat_jump",
    )
    rounds, rows = [], None
    while True:
        going = jump.where("to is not null")
        if going.agg(F.count(F.lit(1))).first()[0] == 0:
            break
        rounds.append(going)
        # a cycle never closes: no chain of distinct messages is longer than all rows
        rows = rows or nodes.count()
        if 1 << (len(rounds) - 1) > rows:
            break
        up = jump.select(F.col("tree").alias("t"), F.col("id").alias("i"), F.col("to").alias("next"), F.col("sum").alias("more"))
        # only pointers that have not reached the root go on
        moved = going.join(up, F.col("tree").eqNullSafe(F.col("t")) & (F.col("to") == F.col("i")), "left").select(
            "tree", "id", F.col("next").alias("to"), (F.col("sum") + F.coalesce("more", F.lit(0.0))).alias("sum")
        )
        jump = stored(moved.unionByName(jump.where("to is null")), "chat_jump")
    ends = jump.where("to is null")
    if rounds:
        answered = rounds[0].select(F.col("tree").alias("t"), F.col("to").alias("i")).distinct()
        ends = ends.join(answered, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("i")), "left_anti")
    ranked = Window.partitionBy("tree").orderBy(F.desc("sum"), "id")
    path = stored(
        ends.withColumn("branch", F.row_number().over(ranked)).where(F.col("branch") <= branches)
        .select("tree", "branch", F.col("id").alias("leaf"), "id", F.lit(0).cast("long").alias("above")),
        "chat_paths",
    )
    # every ancestor is reached once: by the binary digits of its distance
    for k, step in enumerate(rounds):
        up = step.select(F.col("tree").alias("t"), F.col("id").alias("i"), "to")
        higher = path.join(up, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("i"))).select(
            "tree", "branch", "leaf", F.col("to").alias("id"), (F.col("above") + (1 << k)).alias("above")
        )
        path = stored(path.unionByName(higher), "chat_paths")
    return path


def format_branches(messages: DataFrame, branches: int = 1) -> DataFrame:
    """One row for each chosen branch: ``tree``, ``branch``, ``leaf``,
    ``formatted`` and ``loss_spans`` (array of start, end in code points)."""
    messages = stored(messages.select("tree", "id", "parent", "role", "text", "score"), "chat_messages")
    path = branch_paths(messages, branches)
    body = messages.select(
        F.col("tree").alias("t"),
        F.col("id").alias("i"),
        F.concat(F.lit("### "), escaped(F.coalesce("role", F.lit("")), r"[\\#<:]"), F.lit(": ")).alias("head"),
        escaped(F.coalesce("text", F.lit(""))).alias("body"),
        (F.coalesce("role", F.lit("")) == ASSISTANT).alias("learn"),
    )
    turns = (
        path.join(body, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("i")))
        .groupBy("tree", "branch", "leaf")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("above")).alias("n"), "head", "body", "learn"))).alias("turns"))
    )
    return turns.select(
        "tree", "branch", "leaf", F.expr("concat_ws('', transform(turns, x -> concat(x.head, x.body, '</turn>\n')))").alias("formatted"),
        _loss_spans(F.col("turns")).alias("loss_spans"),
    )


def _loss_spans(turns: Column) -> Column:
    return pandas_udf(_spans_of, "array<struct<start:long,end:long>>")(turns)


def _spans_of(turns: pd.Series) -> pd.Series:
    out = []
    for row in turns:
        at, spans = 0, []
        for turn in row:
            start = at + len(turn["head"])
            at = start + len(turn["body"]) + len("</turn>\n")
            if turn["learn"]:
                spans.append({"start": start, "end": start + len(turn["body"])})
        out.append(spans)
    return pd.Series(out)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn; raises if the string is not well formed."""
    turns, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if not turn:
            raise ValueError(f"no turn at {at}")
        turns.append((unescaped(turn[1]), unescaped(turn[2])))
        at = turn.end()
    return turns


DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def conversation_digest(formatted: Column, loss_spans: Column) -> Column:
    """What the formatted conversations say, read back from them."""
    return pandas_udf(_digests, DIGEST)(formatted, loss_spans)


def _digests(formatted: pd.Series, loss_spans: pd.Series) -> pd.DataFrame:
    rows = []
    for text, spans in zip(formatted, loss_spans, strict=True):
        turns = read_back(text)
        learned = "".join(unescaped(text[s["start"] : s["end"]]) for s in spans)
        said = "".join(f"{role}\n{body}\n" for role, body in turns)
        rows.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(text)))
    return pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
