"""Operator 11: chat formatting by prefix-target expansion.

Every assistant turn of a conversation becomes a training example of its own: the
formatted text of all preceding turns as context, then the reply. Only the reply
(without its marks) lies under the loss mask, ``text[loss_start:loss_end]`` in code
points. Turns after the last reply are nobody's context; they end the conversation
as one more example without a target and with an empty mask, so that no turn is lost.

Template: ``<s>[INST]role[/INST]text</s>`` for each turn, nothing between turns. A
control string inside a role or text gets a backslash after its first character,
and one that already has some gets one more, so that formatted text holds no control
string but the template's own and ``unescape`` undoes it exactly.

``format_examples`` sorts the turns of a conversation on disk and walks through them
once. A task holds the formatted context and a batch of examples, whatever the
number of turns. Contexts repeat what precedes them, so output grows with the square
of a conversation's turns; beyond ``CONTEXT`` code points it does not: the next
example starts afresh and names the one whose text it continues in
``context_example``. Its full context is that example's (with that one's own context)
and then its own text. A conversation that holds a third of all rows so costs
``CONTEXT`` for each of its replies at most. Its order is one task's walk by nature,
as is the digest of all its turns; escaping, formatting and reading back are not.

Cases: a null role or text counts as empty; a null conversation id is a conversation
like others; a null turn comes last; rows of equal turn follow by role, then text,
and repeated rows are turns like others; only the role ``assistant`` is trained on; a
conversation without it gives one example without a target; an empty table gives
none. Further columns of the input, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: code points of formatted text that an example may repeat from those before it
CONTEXT = 4_000_000
TARGET = "assistant"
BATCH_CHARS = 4_000_000
_HEAD, _MID, _END = "<s>[INST]", "[/INST]", "</s>"
_CONTROL = r"([<\[])(\\{})(/?(?:s>|INST\]))"
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)
_ESCAPED = re.compile(_CONTROL.format("+"))

EXAMPLE_SCHEMA = ("example long, target_turn long, context_example long, text string, "
                  "loss_start long, loss_end long, complete boolean")


def escaped(col):
    """The column with its control strings escaped."""
    return F.regexp_replace(col, _CONTROL.format("*"), r"$1\\$2$3")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1] + m[2][1:] + m[3], text)


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns in formatted text; an error if it holds anything else."""
    turns, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            break
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError("not the template's text")
    return turns


def format_examples(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text", context: int = CONTEXT) -> DataFrame:
    """One row an example: ``conv_id``, ``example`` (from 0), ``target_turn`` (place of the
    reply among the conversation's turns, null for closing turns without one),
    ``context_example`` (the example that ``text`` continues; null: ``text`` starts with
    the conversation), ``text``, ``loss_start``, ``loss_end`` and ``complete`` (no later
    example repeats this text)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    turns = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("raw"),
        (role == TARGET).alias("target"),
        F.concat(F.lit(_HEAD), escaped(role), F.lit(_MID)).alias("head"), escaped(text).alias("body"))
    ordered = turns.repartition(F.col("conv_id")).sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_last(), "role", "raw").select("conv_id", "target", "head", "body")
    schema = T.StructType([T.StructField("conv_id", conversations.schema[conv_col].dataType),
                           *T.StructType.fromDDL(EXAMPLE_SCHEMA).fields])
    return ordered.mapInArrow(_walk(context), schema)


def _walk(context: int):
    """Task function: turns in order -> examples."""

    def examples(batches):
        """(conv_id, example, target_turn, context_example, text, loss_start, loss_end), and
        whether the text ends a stretch."""
        conv, parts, size, at, made, base, held = None, [], 0, 0, 0, None, None
        for batch in batches:
            for key, target, head, body in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if at == 0 or key != conv:
                    if at:
                        yield from _closed(conv, parts, made, base, held)
                    conv, parts, size, at, made, base, held = key, [], 0, 0, 0, None, None
                turn, loss = head + body + _END, (size + len(head), size + len(head) + len(body))
                parts.append(turn)
                size += len(turn)
                if target:
                    if held:
                        yield held, False
                    parts = ["".join(parts)]
                    held = (conv, made, at, base, parts[0], *loss)
                    made += 1
                    if size >= context:
                        yield held, True
                        parts, size, base, held = [], 0, made - 1, None
                at += 1
        if at:
            yield from _closed(conv, parts, made, base, held)

    def run(batches):
        rows, chars = [], 0
        for row, complete in examples(batches):
            rows.append((*row, complete))
            chars += len(row[4])
            if chars >= BATCH_CHARS or len(rows) >= 1000:
                yield _batch(rows)
                rows, chars = [], 0
        if rows:
            yield _batch(rows)

    conv_type = None

    def _batch(rows):
        columns = list(zip(*rows))
        kinds = [conv_type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
        names = ["conv_id", "example", "target_turn", "context_example", "text", "loss_start", "loss_end", "complete"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def typed(batches):
        nonlocal conv_type
        for batch in batches:
            conv_type = conv_type or batch.schema.field(0).type
            yield batch

    return lambda batches: run(typed(batches))


def _closed(conv, parts, made, base, held):
    """The last rows of a conversation."""
    if held and parts == [held[4]]:  # a reply came last
        yield held, True
        return
    if held:
        yield held, False
    if parts:
        yield (conv, made, None, base, "".join(parts), 0, 0), True


READ_SCHEMA = "example long, n_turns long, turns binary, loss string, chars long"


def read_back(examples: DataFrame) -> DataFrame:
    """One row a conversation, from the examples alone: ``n_turns``, ``turns_sha256`` (of
    role, line feed, text, line feed of each turn), ``loss_chars`` and ``loss_sha256`` (of
    all text under the masks, unescaped, in order), ``formatted_chars`` (code points of
    all its examples)."""
    conv = examples.schema["conv_id"]

    def read(batches):
        for batch in batches:
            get = {n: batch.column(n).to_pylist() for n in ("text", "loss_start", "loss_end", "complete")}
            turns, loss, chars = [], [], []
            for text, a, b, complete in zip(*get.values()):
                turns.append(read_turns(text) if complete else [])
                loss.append(unescape(text[a:b]))
                chars.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("example"), pa.array([len(t) for t in turns], pa.int64()),
                 pa.array(["".join(f"{r}\n{t}\n" for r, t in x).encode() for x in turns], pa.binary()),
                 pa.array(loss, pa.string()), pa.array(chars, pa.int64())],
                ["conv_id", "example", "n_turns", "turns", "loss", "chars"])

    def digest(batches):
        conv_id, have, started = None, None, False
        for batch in batches:
            kind, done = batch.schema.field(0).type, []
            for key, n, turns, loss, chars in zip(*(batch.column(c).to_pylist()
                                                    for c in ("conv_id", "n_turns", "turns", "loss", "chars"))):
                if not started or key != conv_id:
                    if started:
                        done.append((conv_id, *have))
                    conv_id, have, started = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0], True
                have[0] += n
                have[1].update(turns)
                have[2] += len(loss)
                have[3].update(loss.encode())
                have[4] += chars
            yield _digests(done, kind)
        if started:
            yield _digests([(conv_id, *have)], kind)

    small = examples.select("conv_id", "example", "text", "loss_start", "loss_end", "complete").mapInArrow(
        read, T.StructType([conv, *T.StructType.fromDDL(READ_SCHEMA).fields]))
    ordered = small.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "example")
    return ordered.mapInArrow(digest, T.StructType([conv, *T.StructType.fromDDL(
        "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").fields]))


def _digests(rows, conv_type):
    columns = list(zip(*rows)) if rows else [()] * 6
    columns[2] = [h.hexdigest() for h in columns[2]]
    columns[4] = [h.hexdigest() for h in columns[4]]
    kinds = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
