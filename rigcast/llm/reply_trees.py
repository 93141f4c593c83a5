"""Chat formatting of reply trees (operator 4).

Messages point to the message that they answer. Iterative self-joins with
doubling steps (parent, grandparent, fourth ancestor ...) enumerate every path
from a leaf to its root in about log2 of the deepest path rounds. Branches of
a tree are ranked by the sum of their messages' scores, and each chosen path
is formatted as one conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Inside texts and
roles a backslash is doubled and ``<|`` becomes ``<\\|``, in roles a line feed
becomes ``\\n``; so no control string stands in a text, and ``read_back``
restores every turn exactly. The loss mask covers the escaped texts of
assistant turns, as code point spans.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rigcast.llm.common import small_batches, stage, table

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m.group(1) == "n" else m.group(1), text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[dict]]:
    """The conversation and the code point spans under the loss mask."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = START + escape(role).replace("\n", "\\n") + "\n"
        body = escape(text)
        if role == LEARNED:
            spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError("not a formatted conversation")
        line = formatted.index("\n", at)
        stop = formatted.index(END + "\n", line + 1)
        turns.append((unescape(formatted[at + len(START):line]), unescape(formatted[line + 1:stop])))
        at = stop + len(END) + 1
    return turns


def paths(nodes: DataFrame) -> DataFrame:
    """``(leaf, node, dist)`` for every leaf and each message on its way to the
    root, from ``nodes(node, parent)``. Chains that never reach a root (cycles) are left out."""
    up = stage(nodes.where("parent is not null").select("node", "parent"), "parents")
    found = stage(nodes.select("node").join(up.select(F.col("parent").alias("node")).distinct(), "node", "left_anti")
                  .select(F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("dist")), "paths")
    jump, step, total = up, 1, nodes.count()
    while step <= total and not jump.isEmpty():
        further = found.join(jump, "node").select("leaf", F.col("parent").alias("node"), (F.col("dist") + step).alias("dist"))
        found = stage(found.union(further), "paths")
        jump = stage(jump.join(jump.select(F.col("node").alias("parent"), F.col("parent").alias("far")), "parent")
                     .select("node", F.col("far").alias("parent")), "jump")
        step *= 2
    if not jump.isEmpty():
        found = found.join(jump.select(F.col("node").alias("leaf")), "leaf", "left_anti")
    return found


def format_trees(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """``(tree, branch, formatted, loss)`` for the ``branches`` best paths of each tree (null: all).

    ``messages`` holds ``tree, msg, parent, role, text, score``; extra columns
    are ignored. ``msg`` names a message within its tree; where it repeats, the
    first row in the order of role and text answers for it as a parent and every
    row is a message. A parent that is null or missing makes a root. Null roles
    and texts are empty, null scores count 0, a null tree is a tree of its own.
    Ties between branches go to the longer path, then to the smaller leaf
    (``msg``, role, text). No messages: no rows.
    """
    small_batches(messages.sparkSession)
    rows = stage(messages.select(
        "tree", "msg", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")).withColumn("node", F.monotonically_increasing_id()), "messages")
    named = rows.where("msg is not null").groupBy("tree", "msg").agg(F.min(F.struct("role", "text", "node")).getField("node").alias("up"))
    links = rows.alias("r").join(named.alias("n"), F.expr("r.tree <=> n.tree and r.parent = n.msg"), "left") \
        .select("r.node", F.expr("if(n.up = r.node, null, n.up)").alias("parent"))
    way = paths(stage(links, "links"))
    scored = way.join(rows.select("node", "score"), "node").groupBy("leaf").agg(F.sum("score").alias("total"), F.max("dist").alias("depth"))
    leaves = scored.join(rows.select(F.col("node").alias("leaf"), "tree", "msg", "role", "text"), "leaf")
    order = Window.partitionBy("tree").orderBy(F.desc("total"), F.desc("depth"), "msg", "role", "text", "leaf")
    ranked = leaves.withColumn("branch", F.row_number().over(order))
    if branches is not None:
        ranked = ranked.where(F.col("branch") <= branches)
    chosen = way.join(ranked.select("leaf", "tree", "branch"), "leaf").join(rows.select("node", "role", "text"), "node") \
        .groupBy("leaf").agg(F.first("tree").alias("tree"), F.first("branch").alias("branch"),
                             F.sort_array(F.collect_list(F.struct((-F.col("dist")).alias("at"), "role", "text"))).alias("turns"))
    kind = dict(rows.dtypes)["tree"]

    def run(batches):
        for b in batches:
            made = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in b.column("turns").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("tree"), b.column("branch"), pa.array([m[0] for m in made], pa.string()),
                 pa.array([m[1] for m in made], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["tree", "branch", "formatted", "loss"])

    return chosen.select("tree", "branch", "turns").mapInArrow(
        run, f"tree {kind}, branch int, formatted string, loss array<struct<start: long, end: long>>")


def digest(formatted: DataFrame) -> DataFrame:
    """Figures read back from formatted conversations alone."""
    def sha(parts):
        h = hashlib.sha256()
        for p in parts:
            h.update(p.encode("utf-8", "surrogatepass"))
        return h.hexdigest()

    def run(batches):
        for b in batches:
            out = {c: [] for c in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for text, spans in zip(b.column("formatted").to_pylist(), b.column("loss").to_pylist()):
                turns = read_back(text)
                learned = [unescape(text[s["start"]:s["end"]]) for s in spans]
                out["n_turns"].append(len(turns))
                out["turns_sha256"].append(sha(f"{r}\n{t}\n" for r, t in turns))
                out["loss_chars"].append(sum(map(len, learned)))
                out["loss_sha256"].append(sha(learned))
                out["formatted_chars"].append(len(text))
            yield pa.RecordBatch.from_arrays([b.column("tree"), *[pa.array(v) for v in out.values()]], names=["conv_id", *out])

    kind = dict(formatted.dtypes)["tree"]
    return formatted.select("tree", "formatted", "loss").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def as_chain(conversations: DataFrame) -> DataFrame:
    """Linear conversations as trees of one branch: each turn answers the one before (ties by role and text)."""
    at = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.withColumn("msg", F.row_number().over(at).cast("long")) \
        .select(F.col("conv_id").cast("long").alias("tree"), "msg", F.expr("if(msg > 1, msg - 1, null)").alias("parent"),
                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"), F.lit(0.0).alias("score"))


def op4_reply_trees(spark, sf_dir):
    """Every conversation, and conversation -1 whose texts hold control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = END + START + "assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return digest(format_trees(as_chain(rows.union(extra))))


OP4_SQL = r"""
WITH rows AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n'))
                + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 24) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""
