"""Chat formatting: reply trees to conversations, one per root, with a loss mask.

Messages point to their parents. Runs of messages with one reply each are joined to segments by
pointer jumping, so the walk from leaves to roots takes one self-join per branching, not per message.
Every root-to-leaf path is a candidate conversation; the best by score is formatted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.sources.workspace import stored

# The template: each turn is OPEN role CLOSE text END. Texts and roles cannot contain "<".
OPEN, CLOSE, END = "<|turn|>", "<|text|>", "<|end|>"
LOSS_ROLE = "assistant"
# Escapes, in the order in which they are applied; undone in reverse.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"))


def escape(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def linear_replies(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Messages (tree, id, parent, role, text, score) of conversations given by turn: each replies to the one before.

    Equal turn numbers come in the order of role and text, null turns first. A null text is empty,
    a null role the role ''.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    order = Window.partitionBy(conv).orderBy(turn, role, text)
    numbered = turns.select(F.col(conv).alias("tree"), F.row_number().over(order).cast("long").alias("id"), role.alias("role"), text.alias("text"))
    return numbered.withColumn("parent", F.when(F.col("id") > 1, F.col("id") - 1)).withColumn("score", F.lit(0.0))


def paths(messages: DataFrame) -> DataFrame:
    """(tree, root, leaf, place, id) of the best path of each root.

    A message whose parent is null or not in its tree is a root. Paths are ranked by their mean score,
    then length, then by the smaller leaf. Messages on a cycle have no root and no path.
    """
    keys = ["tree", "id"]
    nodes = messages.select("tree", "id", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    present = nodes.select(F.col("tree").alias("_t"), F.col("id").alias("_i"))
    inside = F.col("tree").eqNullSafe(F.col("_t")) & (F.col("parent") == F.col("_i"))
    nodes = stored(nodes.join(present.distinct(), inside, "left").select(*keys, F.col("_i").alias("parent"), "score"), "messages")
    replies = nodes.filter("parent IS NOT NULL").groupBy("tree", F.col("parent").alias("_i")).agg(F.count("*").alias("_replies"))
    replies = replies.withColumnRenamed("tree", "_t")

    # Jump to the start of the run of only replies; `steps` is the place in it.
    only = F.col("tree").eqNullSafe(F.col("_t")) & (F.col("parent") == F.col("_i")) & (F.col("_replies") == 1)
    jumps = stored(
        nodes.join(replies, only, "left").select(
            *keys, "parent", "score", F.coalesce("_i", "id").alias("start"), F.when(F.col("_i").isNull(), 0).otherwise(1).cast("long").alias("steps")
        ), "jumps",
    )
    settled, moving = jumps.filter("steps = 0 AND start IS NOT NULL"), jumps.filter("steps > 0")
    while True:
        to = settled.unionByName(moving).select(
            F.col("tree").alias("_t"), F.col("id").alias("_i"), F.col("start").alias("_start"), F.col("steps").alias("_steps")
        )
        at = F.col("tree").eqNullSafe(F.col("_t")) & (F.col("start") == F.col("_i"))
        further = stored(
            moving.join(to, at).select(*keys, "parent", "score", F.col("_start").alias("start"), (F.col("steps") + F.col("_steps")).alias("steps"), (F.col("_steps") > 0).alias("moved")),
            "jumps",
        )
        settled = settled.unionByName(further.filter("NOT moved").drop("moved"))
        moving = further.filter("moved").drop("moved")
        # On a cycle of only replies there is no start: steps outgrow the number of messages, and its messages never settle.
        if moving.filter(F.col("steps") <= F.lit(nodes.count())).isEmpty():
            break
    jumps = settled
    segments = jumps.groupBy("tree", "start").agg(
        F.sum("score").alias("total"), F.count("*").alias("length"), F.max(F.struct("steps", "id"))["id"].alias("last"),
        F.max(F.when(F.col("steps") == 0, F.col("parent"))).alias("above"),
    )
    ends = jumps.select("tree", F.col("id").alias("above"), F.col("start").alias("upper"))
    segments = stored(_join_null_safe(segments, ends), "segments")

    # Leaves are segments that nothing hangs from; each step up is one self-join.
    used = segments.filter("upper IS NOT NULL").select(F.col("tree").alias("_t"), F.col("upper").alias("_s")).distinct()
    leaf = F.col("tree").eqNullSafe(F.col("_t")) & (F.col("start") == F.col("_s"))
    front = segments.join(used, leaf, "left_anti").select(
        "tree", F.col("last").alias("leaf"), F.col("start").alias("segment"), "upper", "total", "length", F.lit(0).cast("long").alias("depth")
    )
    walked = stored(front, "walk")
    done = walked
    while True:
        up = segments.select(
            F.col("tree").alias("_t"), F.col("start").alias("_s"), F.col("upper").alias("_upper"), F.col("total").alias("_total"), F.col("length").alias("_length")
        )
        at = F.col("tree").eqNullSafe(F.col("_t")) & (F.col("upper") == F.col("_s"))
        walked = stored(walked.join(up, at).select(
            "tree", "leaf", F.col("_s").alias("segment"), F.col("_upper").alias("upper"), (F.col("total") + F.col("_total")).alias("total"),
            (F.col("length") + F.col("_length")).alias("length"), (F.col("depth") + 1).alias("depth"),
        ), "walk")
        if walked.isEmpty():
            break
        done = done.unionByName(walked)
    rank = Window.partitionBy("tree", "segment").orderBy(F.desc(F.col("total") / F.col("length")), F.desc("length"), "leaf")
    best = done.filter("upper IS NULL").withColumn("_rank", F.row_number().over(rank)).filter("_rank = 1").select(
        F.col("tree").alias("_t"), F.col("segment").alias("root"), F.col("leaf").alias("_leaf"), F.col("depth").alias("_depth")
    )
    chosen = done.join(best, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("leaf") == F.col("_leaf"))).select(
        F.col("tree").alias("_t"), "root", "leaf", F.col("segment").alias("_s"), (F.col("_depth") - F.col("depth")).alias("_level")
    )
    return jumps.join(chosen, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("start") == F.col("_s"))).select(
        "tree", "root", "leaf", F.struct("_level", "steps").alias("place"), "id"
    )


def _join_null_safe(segments: DataFrame, ends: DataFrame) -> DataFrame:
    other = ends.select(F.col("tree").alias("_t"), F.col("above").alias("_a"), "upper")
    return segments.join(other, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("above") == F.col("_a")), "left").drop("_t", "_a")


def format_paths(messages: DataFrame) -> DataFrame:
    """(tree, root, formatted, loss_mask) of the best path of each root.

    loss_mask lists (start, end) in code points of `formatted`, one for each assistant text, from its
    first character to the end of its text, which trains on what the assistant says alone.
    """
    chosen = paths(messages).select(F.col("tree").alias("_t"), F.col("id").alias("_i"), "root", "place")
    same = F.col("tree").eqNullSafe(F.col("_t")) & (F.col("id") == F.col("_i"))
    turns = messages.select("tree", "id", escape("role").alias("role"), escape("text").alias("text")).join(chosen, same)
    grouped = turns.groupBy("tree", "root").agg(F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    formatted = F.array_join(
        F.transform("turns", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(END))), ""
    )
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(done: Column, t: Column) -> Column:
        start = done["at"] + len(OPEN) + F.length(t["role"]) + len(CLOSE)
        end = (start + F.length(t["text"])).cast("long")
        span = F.array(F.struct(start.cast("long").alias("start"), end.alias("end")))
        spans = F.when(t["role"] == LOSS_ROLE, F.concat(done["spans"], span)).otherwise(done["spans"])
        return F.struct((end + len(END)).cast("long").alias("at"), spans.alias("spans"))

    return grouped.select("tree", "root", formatted.alias("formatted"), F.aggregate("turns", empty, step)["spans"].alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The formatted conversations with `turns` (role, text) and `loss_text`, read from the formatted text and the mask."""
    body = F.filter(F.split("formatted", END.replace("|", r"\|")), lambda t: t != "")
    close = F.lit(CLOSE)

    def turn(t: Column) -> Column:
        at = F.call_function("locate", close, t)
        role = F.substring(t, F.lit(len(OPEN) + 1), at - 1 - len(OPEN))
        return F.struct(unescape(role).alias("role"), unescape(F.substring(t, at + len(CLOSE), F.length(t))).alias("text"))

    masked = F.array_join(
        F.transform("loss_mask", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), ""
    )
    return formatted.withColumns({"turns": F.transform(body, turn), "loss_text": masked})
