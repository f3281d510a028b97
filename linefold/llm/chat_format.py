"""Chat formatting with cumulative-snapshot collapse, in DataFrame functions only.

A log may hold a conversation again and again, each time with more turns.  The
turns of a conversation are numbered by (turn, role, content); a rolling hash
of each turn prefix is the XOR of hashes of (number, content) so far, twice
64 bits.  A conversation whose full hash is a proper prefix of another one is
dropped by an anti-join on (length, hashes); of equal conversations the
smallest id stays.  What remains is rendered, one text per conversation.

Only hashes take part in the windows and joins; texts are shuffled once, for
the kept conversations.  Prefixes and full hashes are made distinct, with
partial aggregation, before they are joined: a prefix that a third of all
conversations share is one row there.

Rows with a null conversation id belong to none and are left out.  A null turn
sorts last, a null role is rendered ``unknown`` and a null text as nothing (but
null and empty stay different for the comparison).  Repeated rows of a
conversation are turns of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: How a turn is written.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, n (turns so far), h1, h2 (rolling hashes), is_last."""
    content = F.md5(F.to_json(F.struct("role", "text")))
    t = turns.where("conv_id is not null").select("conv_id", "turn", "role", content.alias("content"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), "content")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumn("n", F.row_number().over(order)).withColumn("is_last", F.lead("content").over(order).isNull())
    t = t.withColumn("a", F.xxhash64("n", "content")).withColumn("b", F.xxhash64("content", "n", F.lit("second")))
    return t.select("conv_id", "n", F.bit_xor("a").over(so_far).alias("h1"), F.bit_xor("b").over(so_far).alias("h2"), "is_last")


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_same of the conversations that no longer one starts with."""
    p = prefixes(turns)
    full = p.where("is_last").groupBy("n", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_same"))
    inner = p.where("not is_last").select("n", "h1", "h2").distinct()
    return full.join(inner, ["n", "h1", "h2"], "left_anti").select("conv_id", F.col("n").cast("long").alias("n_turns"), "n_same")


def render(turns: DataFrame) -> DataFrame:
    """conv_id, chat: the turns in order, each in the turn's frame."""
    line = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("unknown")), F.lit(MIDDLE), F.coalesce("text", F.lit("")), F.lit(CLOSE))
    key = F.struct(F.col("turn").isNull().alias("late"), "turn", "role", F.md5(F.to_json(F.struct("role", "text"))).alias("content"), line.alias("line"))
    lines = F.transform(F.sort_array(F.collect_list(key)), lambda x: x["line"])
    return turns.groupBy("conv_id").agg(F.array_join(lines, "").alias("chat"))


def collapse(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_same, chat of each maximal conversation."""
    kept = maximal(turns)
    own = turns.select("conv_id", "turn", "role", "text").join(kept.select("conv_id"), "conv_id", "left_semi")
    return kept.join(render(own), "conv_id")
