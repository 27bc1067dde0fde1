"""Chat formatting by perspective rotation.

Each participant of a conversation is taken in turn as the assistant; the others become named
users. `rotate` has one row for one turn seen from one participant: its rendered segment and the span
of it to be learned. Segments of one (conv_id, speaker) in the order of `turn` are the rendered
dialogue; a row per segment keeps every task bounded however long a conversation is, and a
conversation with many turns is dealt to many tasks. `dialogues` puts them together, one row a perspective.

Cases: a null or empty role is the participant "unknown"; turns of the role "system" stay system turns
in every perspective and "system" is no perspective, so a conversation of system turns alone
has no rows; null text is empty; each row with a null conv_id is a conversation of its own, of one turn and one
perspective; the sign "<|" that opens every mark of the format is written "<\\|" in names and texts and line ends in
names become spaces, so that no turn can be forged; spans count the rendered characters. Repeated rows and
tied turns are all rendered; very long texts are one row's work; an empty table gives an empty result; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crestline.llm.common import hot_keys, joined

#: The marks of the chat format, the sign that opens them, and how it is written in names and texts.
BEGIN, END = "<|im_start|>", "<|im_end|>\n"
SIGN, WRITTEN = "<|", "<\\|"
SYSTEM = "system"


def _escaped(text: Column) -> Column:
    return F.replace(text, F.lit(SIGN), F.lit(WRITTEN))


def rotate(turns: DataFrame) -> DataFrame:
    """conv_id, speaker, turn, seat, name, segment, learned, span_start, span_end.

    span_start and span_end are offsets, in code points of the segment, of what the loss covers (the
    text and the end mark of the speaker's own turns); they are equal where nothing is learned.
    """
    name = F.when(F.trim(F.coalesce("role", F.lit(""))) == "", "unknown").otherwise(F.col("role"))
    said = turns.select("conv_id", "turn", name.alias("name"), F.coalesce("text", F.lit("")).alias("text"))
    known, alone = said.where(F.col("conv_id").isNotNull()), said.where(F.col("conv_id").isNull())
    sizes = known.groupBy("conv_id", "name").agg(F.count("*").alias("n"))
    who = sizes.where(F.col("name") != SYSTEM).select("conv_id", F.col("name").alias("speaker"))
    hot = hot_keys(sizes.groupBy("conv_id").agg(F.sum("n").alias("m")), ["conv_id"], turns.count())
    seen = joined(known, who, ["conv_id"], F.struct("turn", "name", "text"), hot)
    seen = seen.unionByName(alone.where(F.col("name") != SYSTEM).withColumn("speaker", F.col("name")))
    own = F.col("name") == F.col("speaker")
    seat = F.when(F.col("name") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user")
    seen = seen.withColumns({"seat": seat, "learned": own, "_t": _escaped(F.col("text"))})
    called = F.translate(_escaped(F.col("name")), "\n\r", "  ")
    head = F.concat(F.lit(BEGIN), "seat", F.when(F.col("seat") == "user", F.concat(F.lit(" name="), called)).otherwise(""), F.lit("\n"))
    seen = seen.withColumn("_head", head)
    start = F.length("_head")
    end = F.length("_head") + F.length("_t") + F.length(F.lit(END)) - 1
    return seen.select(
        "conv_id", "speaker", "turn", "seat", "name",
        F.concat("_head", "_t", F.lit(END)).alias("segment"), "learned",
        start.cast("long").alias("span_start"),
        F.when(F.col("learned"), end).otherwise(start).cast("long").alias("span_end"),
    )


def dialogues(turns: DataFrame) -> DataFrame:
    """conv_id, speaker, text (the rendered dialogue) and spans (learned, in code points of it) of each perspective.

    A dialogue is one value, so it is put together in one task: for conversations that fit into one. Tied turns
    stand in the order of name and segment; rows with a null conv_id are left out, since nothing tells them apart.
    """
    part = F.struct("turn", "name", "segment", "learned", "span_start", "span_end")
    told = rotate(turns.where(F.col("conv_id").isNotNull())).groupBy("conv_id", "speaker").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def follow(acc: Column, p: Column) -> Column:
        span = F.array(F.struct((acc["at"] + p["span_start"]).alias("start"), (acc["at"] + p["span_end"]).alias("end")))
        return F.struct((acc["at"] + F.length(p["segment"])).alias("at"), F.when(p["learned"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate("parts", start, follow, lambda acc: acc["spans"])
    return told.select("conv_id", "speaker", F.array_join("parts.segment", "").alias("text"), spans.alias("spans"))
