"""Reply trees to chat texts.

Messages form trees by parent. Self-joins that double the reach of a pointer fold unbranched runs of replies into chains, so
that a long linear thread takes logarithmically many rounds; further self-joins over the chains enumerate the root-to-leaf
paths. Paths are ranked by the mean score of their messages and every chosen one becomes one conversation.

The template marks turns with control strings. Those that occur in a text or role are broken by an escape that reading back
undoes, so no text can open or close a turn.

Edge cases: rows without conv_id or msg_id belong to no tree and are left out; null text and role are empty; a message whose
parent is absent, null or itself is a root; of rows with equal (conv_id, msg_id) the smallest by parent, role and text
counts; messages on or below a cycle lie on no root-to-leaf path; paths of equal score rank by their leaf; an empty table
gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.runtime import stage

OPEN, CLOSE = "<|turn|>", "<|end|>"
#: Control strings of this and other common templates, none of which may appear from within a text.
CONTROL = [OPEN, CLOSE, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]


def _control_pattern() -> str:
    """Matches the first character of a control string, by looking ahead at the rest."""
    quoted = lambda s: "".join("\\" + c if not c.isalnum() else c for c in s)
    return "|".join(f"(?:{quoted(c[0])}(?={quoted(c[1:])}))" for c in CONTROL)


def escape(text: Column) -> Column:
    r"""A backslash becomes ``\s``; ``\e`` goes behind the first character of every control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\s")), f"({_control_pattern()})", r"$1\\e")


def unescape(text: Column) -> Column:
    """Undoes ``escape``: there, every backslash is followed by s or e, so the two replacements cannot meet."""
    return F.replace(F.replace(text, F.lit("\\e"), F.lit("")), F.lit("\\s"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def _chains(nodes: DataFrame) -> DataFrame:
    """conv_id, node, head, dist, up: the first message of the unbranched run a message lies in, and that one's parent."""
    known = nodes.select("conv_id", F.col("msg_id").alias("up"), F.lit(True).alias("known"))
    real = nodes.where("parent_id <> msg_id").select("conv_id", "msg_id", F.col("parent_id").alias("up")) \
                .join(known, ["conv_id", "up"])
    alone = real.groupBy("conv_id", "up").agg(F.count("*").alias("n")).where("n = 1")
    inner = real.join(alone, ["conv_id", "up"], "left_semi").select("conv_id", "msg_id", F.col("up").alias("ptr"))
    rows = nodes.select("conv_id", "msg_id", "score").join(inner, ["conv_id", "msg_id"], "left") \
                .join(real.select("conv_id", "msg_id", "up"), ["conv_id", "msg_id"], "left")
    rows = stage(rows.select("conv_id", F.col("msg_id").alias("node"), F.coalesce("ptr", "msg_id").alias("ptr"), "up", "score",
                             F.col("ptr").isNotNull().cast("long").alias("dist"), F.col("ptr").isNull().alias("done")), "chat-chains")
    left = rows.where("not done").count()
    while left:
        to = rows.select("conv_id", F.col("node").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("dist").alias("dist2"), F.col("done").alias("done2"))
        moved = rows.where("not done").join(to, ["conv_id", "ptr"]).select(
            "conv_id", "node", F.col("ptr2").alias("ptr"), "up", "score", (F.col("dist") + F.col("dist2")).alias("dist"), F.col("done2").alias("done"))
        rows = stage(rows.where("done").unionByName(moved), "chat-chains")
        before, left = left, rows.where("not done").count()
        if left == before:  # only cycles keep from reaching a head
            break
    return rows.where("done").drop("done").withColumnRenamed("ptr", "head")


def reply_paths(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """conv_id, path, score, place, msg_id, role, text: the messages of the ``top`` best root-to-leaf paths of every tree.

    ``messages`` has conv_id, msg_id, parent_id, role, text and score (null: 0); path counts from 1, by descending score.
    """
    first = F.min(F.struct(F.col("parent_id"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                           F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))).alias("m")
    nodes = stage(messages.where("conv_id is not null and msg_id is not null").groupBy("conv_id", "msg_id").agg(first)
                  .select("conv_id", "msg_id", "m.*"), "chat-nodes")
    rows = _chains(nodes.select("conv_id", "msg_id", "parent_id", "score"))
    sums = rows.groupBy("conv_id", "head").agg(F.count("*").alias("n"), F.sum("score").alias("s"))
    heads = rows.where("dist = 0").select("conv_id", "head", "up")
    above = rows.select("conv_id", F.col("node").alias("up"), F.col("head").alias("parent_head"))
    chains = stage(heads.join(above, ["conv_id", "up"], "left").join(sums, ["conv_id", "head"]).select(
        "conv_id", "head", "parent_head", "n", "s"), "chat-heads")
    inner = chains.where("parent_head is not null").select("conv_id", F.col("parent_head").alias("tail")).distinct()
    grown = chains.where("parent_head is null").select("conv_id", F.array("head").alias("heads"), F.col("head").alias("tail"), "n", "s")
    ended = None
    while True:
        grown = stage(grown, "chat-paths")
        leaves = grown.join(inner, ["conv_id", "tail"], "left_anti").select("conv_id", "heads", "tail", "n", "s")
        ended = leaves if ended is None else ended.unionByName(leaves)
        step = chains.where("parent_head is not null").select("conv_id", F.col("parent_head").alias("tail"), "head", F.col("n").alias("n2"), F.col("s").alias("s2"))
        grown = grown.join(step, ["conv_id", "tail"]).select(
            "conv_id", F.concat("heads", F.array("head")).alias("heads"), F.col("head").alias("tail"),
            (F.col("n") + F.col("n2")).alias("n"), (F.col("s") + F.col("s2")).alias("s"))
        if grown.isEmpty():
            break
    best = W.partitionBy("conv_id").orderBy(F.desc("score"), "tail")
    ranked = ended.withColumn("score", F.col("s") / F.col("n")).withColumn("path", F.row_number().over(best))
    if top is not None:
        ranked = ranked.where(F.col("path") <= top)
    parts = ranked.select("conv_id", "path", "score", F.posexplode("heads").alias("part", "head"))
    return (parts.join(rows.select("conv_id", "head", "node", "dist"), ["conv_id", "head"])
            .withColumnRenamed("node", "msg_id").join(nodes.select("conv_id", "msg_id", "role", "text"), ["conv_id", "msg_id"])
            .select("conv_id", "path", "score", F.struct("part", "dist").alias("place"), "msg_id", "role", "text"))


def format_paths(paths: DataFrame, learn: str = "assistant") -> DataFrame:
    """conv_id, path, score, formatted, loss_spans: one text per path; spans (start, end in code points) hold what is learnt.

    A conversation is one text, so its turns meet in one task; running offsets come from a window, not from a growing value.
    """
    head = F.concat(F.lit(OPEN), _escape_role(F.col("role")), F.lit("\n"))
    pieces = paths.select("conv_id", "path", "score", "place", head.alias("head"), escape(F.col("text")).alias("body"),
                          (F.col("role") == learn).alias("learn"))
    size = F.length("head") + F.length("body") + len(CLOSE)
    before = W.partitionBy("conv_id", "path").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    placed = pieces.withColumn("at", F.coalesce(F.sum(size.cast("long")).over(before), F.lit(0)) + F.length("head"))
    turn = F.struct("place", F.concat("head", "body", F.lit(CLOSE)).alias("piece"), "learn", F.col("at").alias("start"),
                    (F.col("at") + F.length("body")).alias("end"))
    whole = placed.groupBy("conv_id", "path").agg(F.first("score").alias("score"), F.sort_array(F.collect_list(turn)).alias("turns"))
    return whole.select("conv_id", "path", "score", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
                        F.transform(F.filter("turns", lambda t: t["learn"]), lambda t: F.struct(t["start"], t["end"])).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, path, turns (role, text) and learnt (texts) from formatted texts and their spans."""
    quoted = "".join("\\" + c if not c.isalnum() else c for c in CLOSE)
    raw = F.filter(F.split("formatted", quoted, -1), lambda x: x != "")
    role = lambda x: F.substring_index(x, "\n", 1)
    turns = F.transform(raw, lambda x: F.struct(_unescape_role(F.substr(role(x), F.lit(len(OPEN) + 1))).alias("role"),
                                                unescape(F.substr(x, F.length(role(x)) + 2)).alias("text")))
    learnt = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.select("conv_id", "path", turns.alias("turns"), learnt.alias("learnt"), "formatted")


def linear_messages(rows: DataFrame) -> DataFrame:
    """Rows of conv_id, turn, role, text as reply trees: every turn answers the one before it (null turns first, ties by role and text)."""
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.where("conv_id is not null").select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("msg_id"))
    return numbered.select("conv_id", "msg_id", (F.col("msg_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def chat_digests(formatted: DataFrame) -> DataFrame:
    """What reading back the formatted texts gives, as counts and digests."""
    back = read_back(formatted)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("learnt", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       F.length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
