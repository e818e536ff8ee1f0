"""Chat formatting: one training example per assistant turn, with every earlier turn as its context.

Examples of a conversation are prefixes of one formatted text: example k is the
text up to the end of its assistant turn, and only that reply is trainable. So
the text is stored once, as one segment per turn with its place in the whole
text, and an example names its prefix and its trainable span. That is linear in
the conversation, where writing every prefix out would be quadratic;
``materialise`` writes them out for conversations of ordinary length.

A segment reads ``<turn>role NEWLINE text</turn> NEWLINE``. Inside roles and texts a
backslash is doubled, the ``<`` of a control string becomes ``\\l`` and a line
break in a role becomes ``\\n``, so control strings occur only as marks and
reading back is exact.

Defined cases: null role or text is empty; a null conversation id is one more
conversation; turns are ordered by turn (null first), role and text, and
repeated rows are repeated turns; a conversation without an assistant turn has
no example; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import map_rows, rows_in
from orderlens.session import keep

OPEN, CLOSE = "<turn>", "</turn>"
TRAINED_ROLE = "assistant"
SEGMENT = re.compile(r"<turn>([^\n]*)\n(.*?)</turn>\n", re.S)
ESCAPED = {"\\": "\\", "l": "<", "n": "\n"}


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit(OPEN), F.lit("\\l" + OPEN[1:]))
    return F.replace(text, F.lit(CLOSE), F.lit("\\l" + CLOSE[1:]))


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: ESCAPED[m[1]], text) if "\\" in text else text


def _placed(turns: DataFrame) -> DataFrame:
    """Segments in their order, with the place of each inside its slice of the conversation.

    Conversations are dealt out by range, so a very long one is split over
    several slices. The table is stored: range bounds are sampled and must not be drawn twice.
    """
    role = F.replace(escaped(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\n"))
    order = ["conv_id", "turn", "_role", "_text"]
    ordered = (
        turns.select("conv_id", "turn", role.alias("_role"), escaped(F.coalesce("text", F.lit(""))).alias("_text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("slice"), F.monotonically_increasing_id().alias("position"))
    )

    def place(batches: Iterator[pa.RecordBatch]):
        current, start = object(), 0
        for conv, turn, role, text, slice_no, position in rows_in(batches):
            if conv != current:
                current, start = conv, 0
            segment = f"{OPEN}{role}\n{text}{CLOSE}\n"
            yield conv, turn, position, slice_no, start, segment, role == TRAINED_ROLE
            start += len(segment)

    kind = turns.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, turn long, position long, slice int, start long, segment string, trained boolean"
    return keep(map_rows(ordered.withColumn("turn", F.col("turn").cast("long")), place, ddl), "segments")


def segments(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, position, start, segment, trained): one row per turn, ``start`` in code points."""
    placed = _placed(turns)
    ends = placed.groupBy("conv_id", "slice").agg(F.max(F.col("start") + F.length("segment")).alias("chars"))
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # A slice border cuts at most one conversation, so this has fewer rows than there are slices.
    moved = ends.withColumn("base", F.sum("chars").over(before)).filter("base is not null")
    moved = moved.select(F.col("conv_id").alias("_conv"), F.col("slice").alias("_slice"), "base")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("slice") == F.col("_slice"))
    return placed.join(F.broadcast(moved), same, "left").select(
        "conv_id", "turn", "position", (F.col("start") + F.coalesce("base", F.lit(0))).alias("start"), "segment", "trained"
    )


def examples(parts: DataFrame) -> DataFrame:
    """(conv_id, turn, position, chars, loss_start, loss_end): one example per assistant turn.

    Its text is the first ``chars`` characters of the conversation; the loss
    covers [loss_start, loss_end), which is the reply alone.
    """
    head = F.instr("segment", "\n")
    end = F.col("start") + F.length("segment")
    return parts.filter("trained").select(
        "conv_id", "turn", "position", end.alias("chars"), (F.col("start") + head).alias("loss_start"),
        (end - len(CLOSE) - 1).alias("loss_end"),
    )


def materialise(parts: DataFrame) -> DataFrame:
    """(conv_id, position, text, loss_start, loss_end): every example written out.

    The output is quadratic in the turns of a conversation by definition, and an
    example is one value; use it for conversations of ordinary length.
    """
    found = examples(parts).alias("e")
    earlier = parts.alias("p")
    on = F.col("e.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("p.position") <= F.col("e.position"))
    pieces = F.array_sort(F.collect_list(F.struct("p.position", "p.segment")))
    return (
        found.join(earlier, on)
        .groupBy("e.conv_id", "e.position", "e.loss_start", "e.loss_end")
        .agg(F.array_join(F.transform(pieces, lambda x: x["segment"]), "").alias("text"))
        .select("conv_id", "position", "text", "loss_start", "loss_end")
    )


def read_back(parts: DataFrame) -> DataFrame:
    """Digests per conversation, from the formatted segments and the trainable spans of the ``examples``.

    An example's span is looked up in the segment that ends it, which holds the whole span.

    A digest of a whole conversation is sequential, so a conversation passes
    through one task, but as a stream: no more than a batch of turns is held.
    """
    kind = parts.schema["conv_id"].dataType.simpleString()
    targets = examples(parts).select("position", "loss_start", "loss_end")  # positions are unique in the table
    spans = parts.join(targets, "position", "left").select(
        "conv_id", "position", "segment",
        (F.col("loss_start") - F.col("start")).alias("loss_start"), (F.col("loss_end") - F.col("start")).alias("loss_end"),
    )
    sorted_parts = spans.repartition("conv_id").sortWithinPartitions("conv_id", "position")

    def digest(batches: Iterator[pa.RecordBatch]):
        current, state = None, None

        def result():
            return current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        for conv, _, segment, loss_start, loss_end in rows_in(batches):
            if state is None or conv != current:
                if state is not None:
                    yield result()
                current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = map(unescaped, SEGMENT.fullmatch(segment).groups())
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            if loss_start is not None:
                reply = unescaped(segment[loss_start:loss_end])
                state[2] += len(reply)
                state[3].update(reply.encode())
            state[4] += len(segment)
        if state is not None:
            yield result()

    ddl = (
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    return map_rows(sorted_parts, digest, ddl)
