r"""Chat formatting, in DataFrame expressions only.

The turns of a conversation are collected as structs, sorted, and adjacent
turns of one role are merged into one block by array functions:

    <turn:ROLE>text<next>text of a merged turn</turn>\n

``<``, ``>`` and ``&`` inside texts and roles become ``&lt;``, ``&gt;`` and
``&amp;``, so a ``<`` in the output always opens a mark, no text can forge
one, and every text comes back exactly. The loss mask is a list of runs
``(chars, loss)`` that covers the output: the escaped texts of the trained
role are under it, marks never are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "</turn>\n"
NEXT = "<next>"


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def unescape(c: Column) -> Column:
    c = F.replace(c, F.lit("&gt;"), F.lit(">"))
    c = F.replace(c, F.lit("&lt;"), F.lit("<"))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def format_conversations(turns: DataFrame, trained: str = "assistant", key: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """``(key, formatted, mask)`` per conversation, ``mask`` an array of ``(chars, loss)``.

    Turns are sorted by turn (null first), then role, then text, so ties and
    repeated rows have one defined order and are all kept. A null text or role
    is the empty one; a null key is a conversation of its own. An empty table
    gives an empty result. Other columns are not read.
    """
    row = turns.select(F.col(key).alias("key"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    conv = row.groupBy("key").agg(F.sort_array(F.collect_list("t")).alias("t"))

    def mark(i: Column, t: Column) -> Column:
        opened = F.concat(F.lit("<turn:"), escape(t["role"]), F.lit(">"))
        same = F.get(F.col("t"), i - 1)["role"] == t["role"]
        return F.when(i == 0, opened).when(same, F.lit(NEXT)).otherwise(F.concat(F.lit(END), opened))

    parts = conv.withColumn("p", F.transform("t", lambda t, i: F.struct(
        mark(i, t).alias("mark"), escape(t["text"]).alias("body"), (t["role"] == trained).alias("loss"))))
    runs = F.flatten(F.transform("p", lambda p: F.array(
        F.struct(F.length(p["mark"]).alias("chars"), F.lit(False).alias("loss")),
        F.struct(F.length(p["body"]).alias("chars"), p["loss"].alias("loss")))))
    last = F.array(F.struct(F.lit(len(END)).alias("chars"), F.lit(False).alias("loss")))
    whole = F.concat(F.array_join(F.transform("p", lambda p: F.concat(p["mark"], p["body"])), ""), F.lit(END))
    return parts.select(F.col("key").alias(key), whole.alias("formatted"), F.concat(runs, last).alias("mask"))


def read_turns(formatted: Column) -> Column:
    """The turns a formatted text holds: array of ``(role, text)``, merged turns apart again."""
    blocks = F.filter(F.split(formatted, END, -1), lambda b: b != "")
    return F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(F.substr(b, F.position(F.lit(">"), b) + 1), NEXT, -1),
        lambda body: F.struct(unescape(F.substr(F.substring_index(b, ">", 1), F.lit(len("<turn:") + 1))).alias("role"),
                              unescape(body).alias("text")))))


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, in order.

    The text is cut at its marks in one pass; the cuts must be the mask's runs
    (empty ones left out), otherwise the mask belongs to another text and the
    query fails.
    """
    cuts = F.regexp_extract_all(formatted, F.lit(r"((?:</turn>\n)?<turn:[^>]*>|<next>|</turn>\n|[^<]+)"), F.lit(1))
    runs = F.filter(mask, lambda m: m["chars"] > 0)
    joined = F.zip_with(cuts, runs, lambda c, m: F.struct(
        c.alias("c"), m["loss"].alias("loss"), F.length(c).eqNullSafe(m["chars"]).alias("ok")))
    under = F.array_join(F.transform(F.filter(joined, lambda j: j["loss"]), lambda j: j["c"]), "")
    fits = F.forall(joined, lambda j: j["ok"])
    return F.when(fits, unescape(under)).otherwise(F.raise_error(F.lit("the loss mask does not fit the text")))
