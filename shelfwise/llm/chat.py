"""Conversations from reply trees, in a chat template that can be read back.

Messages name the message they reply to. Self-joins that double their reach, so
as many rounds as the logarithm of the longest path, list for each leaf all messages from it up
to the root. Paths are ranked by the mean score of their messages, and every chosen path
is formatted as one conversation.

Template: ``[INST] user [/INST]``, `` assistant</s>``, ``<<SYS>>\\nsystem\\n<</SYS>>\\n\\n``, and
``<<ROLE role>>\\ntext\\n<</ROLE>>\\n`` for any other role; every formatted text opens with ``<s>``. A
backslash behind the first character of each of these marks in a text keeps it from being
one; a mark that has backslashes there gets one more, so taking one away restores any text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm.common import stored

MOST_DOUBLINGS = 40
_MARK = r"(/?s>|</?SYS>>|</?ROLE|/?INST\])"
_PLAIN = re.compile(r"([<\[])(\\*)" + _MARK)
_ESCAPED = re.compile(r"([<\[])\\(\\*)" + _MARK)
_FRAMES = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>"), "system": ("<<SYS>>\n", "\n<</SYS>>\n\n")}
_NEXT = re.compile(r"(\[INST\] )|(<<SYS>>\n)|(<<ROLE )|( )")


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _role(role: str) -> str:
    return escape(role).replace("\\", "\\\\").replace(">", "\\-")


def _role_back(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\\" if m[1] == "\\" else ">", role))


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans, in code points, that carry loss: the assistant's texts."""
    parts, at, loss = ["<s>"], 3, []
    for role, text in turns:
        opening, closing = _FRAMES.get(role) or (f"<<ROLE {_role(role)}>>\n", "\n<</ROLE>>\n")
        body = escape(text)
        if role == "assistant":
            loss.append((at + len(opening), at + len(opening) + len(body)))
        parts += [opening, body, closing]
        at += len(opening) + len(body) + len(closing)
    return "".join(parts), loss


def read_turns(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    at, turns = 3, []
    while at < len(text):
        found = _NEXT.match(text, at)
        if found[1] or found[4]:
            role = "user" if found[1] else "assistant"
            start, closing = found.end(), _FRAMES[role][1]
        elif found[2]:
            role, start, closing = "system", found.end(), _FRAMES["system"][1]
        else:
            end = text.index(">>\n", found.end())
            role, start, closing = _role_back(text[found.end():end]), end + 3, "\n<</ROLE>>\n"
        # Marks never occur inside a text, so the first closing mark ends it.
        end = text.index(closing.strip("\n "), start) - (len(closing) - len(closing.lstrip("\n ")))
        turns.append((role, unescape(text[start:end])))
        at = end + len(closing)
    return turns


def paths(messages: DataFrame) -> DataFrame:
    """``tree, leaf, message, up``: for each leaf its messages, ``up`` steps above it.

    ``messages`` has ``tree, message, parent``, ids unique in a tree; null trees are equal. A
    parent that is null or missing makes a root. A reply cycle is an error.
    """
    same = "tree <=> _tree"
    nodes = messages.select("tree", "message", "parent")
    parents = nodes.select(F.col("tree").alias("_tree"), F.col("parent").alias("_parent")).where("_parent IS NOT NULL").distinct()
    leafs = nodes.join(parents, F.expr(f"{same} AND message = _parent"), "left_anti")
    if leafs.isEmpty() and not nodes.isEmpty():
        raise ValueError("replies form a cycle")
    found = stored(leafs.select("tree", F.col("message").alias("leaf"), "message", F.lit(0).cast("bigint").alias("up")), "paths")
    known = nodes.select(F.col("tree").alias("_tree"), F.col("message").alias("_to"))
    jumps = (nodes.where("parent IS NOT NULL").join(known, F.expr(f"{same} AND parent = _to"), "left_semi")
             .select("tree", F.col("message").alias("source"), F.col("parent").alias("to")))
    for k in range(MOST_DOUBLINGS):
        jumps = stored(jumps, "jumps")
        if jumps.isEmpty():
            return found
        step = jumps.select(F.col("tree").alias("_tree"), F.col("source").alias("_source"), F.col("to").alias("_to"))
        further = (found.join(step, F.expr(f"{same} AND message = _source"))
                   .select("tree", "leaf", F.col("_to").alias("message"), (F.col("up") + 2 ** k).alias("up")))
        found = stored(found.unionByName(further), "paths")
        jumps = (jumps.join(step, F.expr(f"{same} AND to = _source"))
                 .select("tree", "source", F.col("_to").alias("to")))
    raise ValueError("replies form a cycle")


def conversations(messages: DataFrame, most: int | None = 1) -> DataFrame:
    """``tree, rank, leaf, score, formatted, loss``: the best paths of each tree, formatted.

    ``messages`` has ``tree, message, parent, role, text, score``. Paths rank by mean score (a
    null counts as 0), then by leaf id; ``most`` of each tree are kept, None for all. Null
    texts and roles count as empty. ``loss`` lists spans of code points. An empty table gives an
    empty one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for turns in batch.column("turns").to_pylist():
                text, loss = format_turns([(t["role"], t["text"]) for t in turns])
                made.append((text, [{"start": a, "end": b} for a, b in loss]))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("tree", "rank", "leaf", "score")]
                + [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], span)],
                names=["tree", "rank", "leaf", "score", "formatted", "loss"])

    texts = messages.select(
        F.col("tree").alias("_tree"), F.col("message").alias("_message"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    full = paths(messages).join(texts, F.expr("tree <=> _tree AND message = _message"))
    whole = full.groupBy("tree", "leaf").agg(
        F.avg("score").alias("score"),
        F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("place"), "role", "text"))).alias("turns"))
    best = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    ranked = whole.withColumn("rank", F.row_number().over(best))
    ranked = ranked.where(F.col("rank") <= most) if most else ranked
    return ranked.select("tree", "rank", "leaf", "score", "turns").mapInArrow(
        run, "tree bigint, rank int, leaf bigint, score double, formatted string, loss array<struct<start: bigint, end: bigint>>")


def as_messages(rows: DataFrame) -> DataFrame:
    """A table of turns as messages, each a reply to the turn before it in its conversation.

    Equal turn numbers follow each other by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    plain = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
    n = F.row_number().over(order).cast("bigint")
    return plain.withColumn("n", n).select(
        F.col("conv_id").alias("tree"), F.col("n").alias("message"), F.when(F.col("n") > 1, F.col("n") - 1).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, from text and spans alone."""
    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tree, text, loss in zip(*(batch.column(n).to_pylist() for n in ("tree", "formatted", "loss"))):
                turns = read_turns(text)
                learnt = "".join(unescape(text[s["start"]:s["end"]]) for s in loss)
                out.append((tree, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), sha(learnt), len(text)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, kinds)], names=names)

    return formatted.select("tree", "formatted", "loss").mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
