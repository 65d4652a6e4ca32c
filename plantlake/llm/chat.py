"""Chat formatting from an event log: fold streamed deltas, edits and regenerations into messages, then render.

Events are (conversation, sequence, kind, turn, role, text).  Kinds:

- ``delta``: appends its text to the turn (a whole message may be one delta);
- ``edit``: replaces the turn's text by its own;
- ``regenerate``: discards the turn and all later turns, as far as they were written before; a turn with no text
  event since then is absent.

The fold is declarative: an event counts unless a later event of its conversation has undone it, which two running
maxima over the sequence decide.  What is left is concatenated per turn in sequence order.

The template writes ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.  Inside roles and texts every ``<|`` and every
backslash before it is escaped, so a control string can only be the template's own and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sha256_hex

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"  # the role whose texts the loss mask covers


def escape(text: Column) -> Column:
    """A backslash goes before the bar of ``<|``, and one more where backslashes stand there already."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role is one line: its line ends (and the sign that writes them) are spelled out."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, seq, kind, turn, role, text) -> conv_id, turn, role, text: the final messages.

    Null texts are empty, null roles take the turn's last known role ('' if none).  Events with equal sequence numbers
    are ordered by kind, role and text.  A null conversation is a conversation of its own.
    """
    e = events.select("conv_id", "seq", F.coalesce("kind", F.lit("delta")).alias("kind"), "turn", "role", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = F.struct("seq", "kind", "role", "text")
    in_turn = Window.partitionBy("conv_id", "turn")
    up_to_turn = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("restart", F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(up_to_turn))
    e = e.where((F.col("kind") != "regenerate") & (F.col("restart").isNull() | (F.col("seq") > F.col("restart"))))
    e = e.withColumn("edited", F.max(F.when(F.col("kind") == "edit", F.col("seq"))).over(in_turn))
    e = e.where(F.col("edited").isNull() | (F.col("seq") > F.col("edited")) | ((F.col("seq") == F.col("edited")) & (F.col("kind") == "edit")))
    folded = e.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(order)).alias("log"))
    roles = F.filter(F.transform("log", lambda x: x["role"]), lambda r: r.isNotNull())
    return folded.select("conv_id", "turn", F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"), F.array_join(F.transform("log", lambda x: x["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, ``formatted``, ``loss_mask``.

    ``loss_mask`` has for each turn, in order, the start and end (code points, end exclusive) of the text that is trained
    on in ``formatted``, both null for other roles.  Rows that share a turn are ordered by role and text.
    """
    piece = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"), escape(F.col("text")), F.lit(END + "\n"))
    m = messages.select("conv_id", "turn", "role", "text", piece.alias("piece"))
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)))
    start = F.col("at") + F.length(F.lit(START)) + F.length(escape_role(F.col("role"))) + 1
    trained = F.col("role") == TRAINED
    m = m.withColumn("start", F.when(trained, start)).withColumn("end", F.when(trained, start + F.length(escape(F.col("text")))))
    whole = F.array_sort(F.collect_list(F.struct("at", "piece", "start", "end")))
    return m.groupBy("conv_id").agg(whole.alias("w")).select(
        "conv_id",
        F.array_join(F.transform("w", lambda x: x["piece"]), "").alias("formatted"),
        F.transform("w", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("loss_mask"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """conv_id, ``turns`` (role, text) and ``loss_texts``, parsed from ``formatted`` and ``loss_mask`` alone."""
    pieces = F.slice(F.split("formatted", r"<\|im_start\|>"), 2, F.size(F.split("formatted", r"<\|im_start\|>")))
    r = rendered.withColumn("pieces", pieces)
    body = lambda p: F.substring(p, F.lit(1), F.length(p) - len(END) - 1)
    turns = F.transform("pieces", lambda p: F.struct(unescape_role(F.substring_index(p, "\n", 1)).alias("role"), unescape(body(p).substr(F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p))).alias("text")))
    # the k-th span lies in the k-th piece; pieces start where the ones before them end
    ends = F.aggregate(
        "pieces",
        F.array(F.lit(0).cast("long")),
        lambda acc, p: F.array_append(acc, F.element_at(acc, -1) + F.length(p) + len(START)),
    )
    r = r.withColumn("turns", turns).withColumn("ends", ends)
    cut = lambda p, s, at: unescape(p.substr((s["start"] - at - len(START) + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    triples = F.arrays_zip(F.col("pieces").alias("p"), F.col("loss_mask").alias("s"), F.slice("ends", 1, F.size("pieces")).alias("at"))
    under = F.transform(F.filter(triples, lambda x: x["s"]["start"].isNotNull()), lambda x: cut(x["p"], x["s"], x["at"]))
    return r.withColumn("loss_texts", under).select("conv_id", "turns", "loss_texts", "formatted")


def digest(rendered: DataFrame) -> DataFrame:
    back = read_back(rendered)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha256_hex(said).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        sha256_hex(loss).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def events_of(conversations: DataFrame) -> DataFrame:
    """Each row of a finished conversation as one delta of a turn of its own: its place by turn, role and text.

    Rows that tie or repeat each other stay apart; null turns come first.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    place = (F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")) - 1).cast("long")
    return rows.withColumn("seq", place).select("conv_id", "seq", F.lit("delta").alias("kind"), F.col("seq").alias("turn"), "role", "text")
