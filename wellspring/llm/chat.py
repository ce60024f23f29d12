"""Chat formatting: event-sourced reconstruction of conversations, then rendering.

A log has one event a row: conv_id, seq, kind, message, role, text. Kinds are ``message`` (begin
a message, with role and text), ``delta`` (append), ``edit`` (replace the text) and
``regenerate`` (empty the message and drop all later ones that began before). Events are folded
message by message, so a long conversation is many small groups; only the running cut-off of
regenerations is taken in order inside a conversation, by a window that can spill. The output
is one segment a message with its place in the conversation and the span under the loss mask,
both in code points; a conversation's formatted text is its segments in order.

A segment is ``<|turn|>role\\ntext<|end|>\\n``. In role and text a backslash, ``<`` and ``[`` are
written as ``\\\\``, ``\\l`` and ``\\b``, and in a role a line feed as ``\\n``: no control string of
this template or of one that uses angle or square brackets can come from a text, and reading
back gives the text again.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.common import shuffle_partitions
from wellspring.workspace import stage

TURN, END = "<|turn|>", "<|end|>\n"
TRAINED = "assistant"

_SEGMENT = re.compile(r"<\|turn\|>([^\n]*)\n(.*)<\|end\|>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
_MEANS = {"\\": "\\", "l": "<", "b": "[", "n": "\n"}


def escaped(text: Column) -> Column:
    for raw, written in (("\\", "\\\\"), ("<", "\\l"), ("[", "\\b")):
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: _MEANS[m[1]], text)


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text) of the messages that remain.

    Events of one message with equal seq are taken by kind, role and text. A null text is
    empty. Deltas without any beginning make a message without a role.
    """
    logs = events.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_list(F.struct("seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text")))).alias("log"),
        F.max(F.when(F.col("kind") == "message", F.col("seq"))).alias("begun"),
        F.max(F.when(F.col("kind") != "delta", F.col("seq"))).alias("base"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("redone"),
        F.min("seq").alias("seen"),
    )
    base = F.coalesce("base", "seen")
    last = F.filter("log", lambda e: (e["seq"] >= base) & (e["kind"] != "regenerate"))
    begins = F.filter("log", lambda e: e["kind"] == "message")
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    alive = logs.select(
        "conv_id",
        "message",
        F.when(F.size(begins) > 0, F.element_at(begins, -1)["role"]).alias("role"),
        F.array_join(F.transform(last, lambda e: e["text"]), "").alias("text"),
        F.coalesce("begun", "seen").alias("begun"),
        F.max("redone").over(before).alias("cut"),
    )
    return alive.where("cut is null or begun > cut").select("conv_id", "message", "role", "text")


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, message, segment, begin, loss_begin, loss_length), staged."""
    role = F.replace(escaped(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\n"))
    head = F.concat(F.lit(TURN), role, F.lit("\n"))
    body = escaped(F.coalesce("text", F.lit("")))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    trained = F.coalesce(F.col("role") == TRAINED, F.lit(False))
    parts = messages.select(
        "conv_id",
        "message",
        F.concat(head, body, F.lit(END)).alias("segment"),
        F.when(trained, F.length(head)).alias("loss_begin"),
        F.when(trained, F.length(body)).alias("loss_length"),
    )
    begin = F.coalesce(F.sum(F.length("segment")).over(before), F.lit(0))
    return stage(
        parts.withColumn("begin", begin.cast("long")).withColumn("loss_begin", F.col("begin") + F.col("loss_begin")),
        "chat-segments",
    )


class Reading:
    """What is read back from one conversation, segment after segment."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns = self.loss = self.chars = 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, begin: int, loss_begin: int | None, loss_length: int | None) -> None:
        role, text = _SEGMENT.fullmatch(segment).groups()
        self.turns += 1
        self.turns_hash.update(f"{unescaped(role)}\n{unescaped(text)}\n".encode())
        self.chars += len(segment)
        if loss_begin is not None:
            at = loss_begin - begin
            learnt = unescaped(segment[at : at + loss_length])
            self.loss += len(learnt)
            self.loss_hash.update(learnt.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.turns_hash.hexdigest(), self.loss, self.loss_hash.hexdigest(), self.chars


def read_back(segments: DataFrame) -> DataFrame:
    """One row per conversation of what its formatted text says.

    The segments of a conversation stream through one task in order, in constant memory: a
    digest over a conversation's text cannot be put together from parts.
    """
    kind = segments.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def read(batches):
        current = None
        ids = pa.int64()

        def batch_of(done):
            types = [ids, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = zip(*done) if done else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            ids, done = batch.schema.field("conv_id").type, []
            fields = ("conv_id", "segment", "begin", "loss_begin", "loss_length")
            for conv_id, *rest in zip(*(batch[f].to_pylist() for f in fields)):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        done.append(current.row())
                    current = Reading(conv_id)
                current.add(*rest)
            yield batch_of(done)
        if current is not None:
            yield batch_of([current.row()])

    wanted = segments.select("conv_id", "message", "segment", "begin", "loss_begin", "loss_length")
    in_order = wanted.repartition(shuffle_partitions(segments.sparkSession), "conv_id").sortWithinPartitions("conv_id", "message")
    return in_order.mapInArrow(read, schema)


def log_of(conversations: DataFrame, chunk: int = 400) -> DataFrame:
    """An event log that tells a table of finished turns (conv_id, turn, role, text).

    Turns are numbered by turn, then role and text, so that repeated turns and turns without a
    number are messages of their own. Assistant turns begin with a draft that is regenerated
    and then streamed in pieces of ``chunk`` characters; others begin empty and are edited.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("message", F.row_number().over(order).cast("long"))
    text, empty = F.col("text"), F.lit(None).cast("string")
    count = F.greatest(F.lit(1), F.ceil(F.length(text) / chunk)).cast("int")

    def event(step, kind, role, said):
        return F.struct(step.alias("step"), F.lit(kind).alias("kind"), role.alias("role"), said.alias("text"))

    streamed = F.transform(
        F.sequence(F.lit(1), count),
        lambda i: event(i + 1, "delta", empty, F.substring(text, (i - 1) * chunk + 1, F.lit(chunk))),
    )
    role = F.col("role")
    told = F.when(
        F.coalesce(role == TRAINED, F.lit(False)),
        F.concat(
            F.array(event(F.lit(0), "message", role, F.substring(text, 1, chunk)), event(F.lit(1), "regenerate", empty, empty)),
            streamed,
        ),
    ).otherwise(F.array(event(F.lit(0), "message", role, F.lit("")), event(F.lit(1), "edit", empty, text)))
    events = rows.select("conv_id", "message", F.explode(told).alias("e"))
    steps = F.lit(1 << 24)
    return events.select(
        "conv_id", (F.col("message") * steps + F.col("e.step")).alias("seq"), "e.kind", "message", "e.role", "e.text"
    )


def format_chats(events: DataFrame) -> DataFrame:
    """Fold and render a log; see ``fold`` and ``render``.

    Null conv_ids are one conversation; empty texts are turns; repeated events are applied as
    often as they occur; an empty log gives no segments; other columns are not looked at.
    """
    return render(fold(events))
