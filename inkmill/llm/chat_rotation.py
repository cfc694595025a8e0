"""Chat transcripts from every speaker's point of view; built-in functions only.

For each participant of a conversation the dialogue is rendered with that speaker as the
assistant and all others as named users. The mask marks the assistant's words and end marks,
as character spans of the text. Roles in ``SYSTEM_ROLES`` keep their role and are no
participants.

Every conversation is one row per participant, however long it is. With ``segment_turns`` set, it
is cut into segments of that many consecutive turn numbers, each rendered for every participant
of the whole conversation, for readers that need a bound on the size of a row.

Defined cases: messages that agree in conversation, turn, role and text are one message. Within
a turn, messages are ordered by role, then text. A null or empty role is the participant
``unknown``; a null text is empty; a null turn comes first (in a segment of its own, if there are
several); rows with a null conv_id form one conversation. Conversations without participants give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYSTEM_ROLES = ("system",)
UNKNOWN = "unknown"
BEGIN, END = "<|{role}|>\n", "<|end|>\n"


def rotate(turns: DataFrame, segment_turns: int | None = None) -> DataFrame:
    """conv_id, speaker, segment, n_messages, n_own, messages, text, spans (of start, end)."""
    role = F.when(F.length("role") > 0, F.col("role")).otherwise(UNKNOWN)
    rows = turns.select(
        "conv_id", "turn", F.coalesce(role, F.lit(UNKNOWN)).alias("name"), F.coalesce("text", F.lit("")).alias("text")
    )
    people = rows.where(~F.col("name").isin(*SYSTEM_ROLES)).select("conv_id", F.col("name").alias("speaker")).distinct()
    segment = F.floor(F.col("turn") / segment_turns) if segment_turns else F.lit(0).cast("long")
    segments = rows.distinct().groupBy("conv_id", segment.alias("segment")).agg(
        F.sort_array(F.collect_list(F.struct("turn", "name", "text"))).alias("dialogue")
    )
    left, right = segments.alias("s"), people.alias("p")
    both = left.join(right, F.col("s.conv_id").eqNullSafe(F.col("p.conv_id")))
    both = both.select("s.conv_id", "p.speaker", "s.segment", "s.dialogue")

    def message(m):
        own, fixed = m["name"] == F.col("speaker"), m["name"].isin(*SYSTEM_ROLES)
        part = F.when(own, "assistant").when(fixed, m["name"]).otherwise("user")
        body = F.when(own | fixed, m["text"]).otherwise(F.concat(m["name"], F.lit(": "), m["text"]))
        head = F.concat(F.lit("<|"), part, F.lit("|>\n"))
        return F.struct(
            part.alias("role"), m["name"].alias("name"), body.alias("content"), own.alias("mask"),
            F.length(head).alias("lead"), F.concat(head, body, F.lit(END)).alias("rendered"),
        )

    rendered = both.withColumn("m", F.transform("dialogue", message))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def walk(state, m):
        end = state["at"] + F.length(m["rendered"])
        span = F.struct((state["at"] + m["lead"]).alias("start"), end.alias("end"))
        spans = F.when(m["mask"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    spans = F.aggregate("m", start, walk, lambda s: s["spans"])
    messages = F.transform("m", lambda m: F.struct(m["role"], m["name"], m["content"], m["mask"]))
    return rendered.select(
        "conv_id",
        "speaker",
        "segment",
        F.size("m").cast("long").alias("n_messages"),
        F.size(F.filter("m", lambda m: m["mask"])).cast("long").alias("n_own"),
        messages.alias("messages"),
        F.array_join(F.transform("m", lambda m: m["rendered"]), "").alias("text"),
        spans.alias("spans"),
    )
