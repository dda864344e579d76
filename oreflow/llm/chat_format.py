"""Chat formatting by incremental black-box rendering.

A template is any function from a list of messages to text. The text is rendered
for successive turn prefixes; where one output starts with the one before, the
rest is the new turn's span, and where it does not, the template rewrites history
and the conversation is marked so. Spans need no knowledge of the template.

Every prefix of a conversation is rendered, so the work grows with the square of its
turns. A template may be declared ``turn_by_turn``: what it writes for a turn depends
on this turn and the one before alone. Its long conversations are rendered in
segments of ``SEGMENT_TURNS`` turns that begin with one turn of context; the pieces must
join to the whole rendering, otherwise every prefix is rendered after all.

Scale: one shuffle by conversation, sorted within partitions and read as a
stream, so a task holds one conversation at a time. A conversation is rendered
as one text; that text is the bound on memory.

Defined results: turns go by turn, then role, then text, nulls first; repeated
rows are turns of their own; a null text or role is empty; rows with a null
conv_id form one conversation without id; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Message = tuple[str, str]  # role, text
Template = Callable[[list[Message]], str]

START, END = "<|im_start|>", "<|im_end|>"
SEGMENT_TURNS = 64


def escape_text(text: str) -> str:
    """No ``<|`` is left: one more backslash goes between ``<`` and ``|`` and any backslashes there."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text) if "|" in text else text


def unescape_text(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    return escape_text(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape_text(role))


def turn_by_turn(template: Template) -> Template:
    """Declares that a turn's output depends on this turn and the one before alone."""
    template.turn_by_turn = True
    return template


@turn_by_turn
def marked_turns(messages: list[Message]) -> str:
    """The template of this library: marked turns with escaped texts."""
    return "".join(f"{START}{escape_role(role)}\n{escape_text(text)}{END}\n" for role, text in messages)


@dataclass
class Rendered:
    text: str
    spans: list[tuple[int, int]]  # of each turn, empty where history is rewritten
    rewrites: bool


def _prefix_spans(template: Template, messages: list[Message], known: int = 0) -> tuple[list[int], str] | None:
    """Lengths added by each message after the first ``known``, and the last output; None if an output is not kept."""
    before, sizes = template(messages[:known]) if known else "", []
    for count in range(known + 1, len(messages) + 1):
        after = template(messages[:count])
        if not after.startswith(before):
            return None
        sizes.append(len(after) - len(before))
        before = after
    return sizes, before


def render(template: Template, messages: list[Message], segment: int = SEGMENT_TURNS) -> Rendered:
    whole = template(messages)
    sizes = None
    if len(messages) > segment and getattr(template, "turn_by_turn", False):
        sizes, place = [], 0
        for low in range(0, len(messages), segment):
            context = min(low, 1)
            part = messages[low - context : low + segment]
            found = _prefix_spans(template, part, context)
            added = found[1][len(found[1]) - sum(found[0]) :] if found else None
            if added is None or not whole.startswith(added, place):
                sizes = None
                break
            sizes += found[0]
            place += len(added)
        if sizes is not None and place != len(whole):
            sizes = None
    if sizes is None:
        found = _prefix_spans(template, messages)
        if found is None or found[1] != whole:
            return Rendered(whole, [], True)
        sizes = found[0]
    spans, place = [], 0
    for size in sizes:
        spans.append((place, place + size))
        place += size
    return Rendered(whole, spans, False)


def read_turn(piece: str) -> tuple[str, str, int, int]:
    """Role and text of one turn of ``marked_turns`` and where its escaped text stands in the piece."""
    head = piece.index("\n")
    tail = len(piece) - len(END) - 1
    if not piece.startswith(START) or piece[tail:] != f"{END}\n":
        raise ValueError("not a turn of this template")
    return unescape_role(piece[len(START) : head]), unescape_text(piece[head + 1 : tail]), head + 1, tail


FORMAT_SCHEMA = (
    "conv_id long, formatted string, turn_starts array<long>, turn_ends array<long>, "
    "loss_starts array<long>, loss_ends array<long>, rewrites_history boolean"
)


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, list[Message]]]:
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))))
    for conv_id, turns in groupby(rows, key=lambda row: row[0]):
        yield conv_id, [(role, text) for _, role, text in turns]


def _format(batches: Iterable[pa.RecordBatch], template: Template, read: Callable, learn: str) -> Iterator[pa.RecordBatch]:
    out, size = [], 0

    def batch():
        columns = [list(values) for values in zip(*out)]
        kinds = [pa.int64(), pa.string(), *[pa.list_(pa.int64())] * 4, pa.bool_()]
        names = [x.split()[0] for x in FORMAT_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds)], names)

    for conv_id, messages in _conversations(batches):
        done = render(template, messages)
        loss = []
        for a, b in done.spans:
            role, _, start, end = read(done.text[a:b])
            if role == learn:
                loss.append((a + start, a + end))
        out.append((
            conv_id, done.text, [a for a, _ in done.spans], [b for _, b in done.spans],
            [a for a, _ in loss], [b for _, b in loss], done.rewrites,
        ))
        size += len(done.text)
        if size > 1 << 22:
            yield batch()
            out.clear()
            size = 0
    if out:
        yield batch()


def format_conversations(
    conversations: DataFrame, template: Template = marked_turns, read: Callable = read_turn, learn: str = "assistant"
) -> DataFrame:
    """One row per conversation: text, turn spans and loss spans in code points, and whether history is rewritten.

    ``read`` finds role and text in the piece of one turn; texts of role ``learn`` are under the loss mask.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(lambda batches: _format(batches, template, read, learn), FORMAT_SCHEMA)


DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            text, turns, loss = row["formatted"], hashlib.sha256(), hashlib.sha256()
            for a, b in zip(row["turn_starts"], row["turn_ends"]):
                role, said, _, _ = read_turn(text[a:b])
                turns.update(f"{role}\n{said}\n".encode())
            chars = 0
            for a, b in zip(row["loss_starts"], row["loss_ends"]):
                said = unescape_text(text[a:b])
                chars += len(said)
                loss.update(said.encode())
            out.append((row["conv_id"], len(row["turn_starts"]), turns.hexdigest(), chars, loss.hexdigest(), len(text)))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = [x.split()[0] for x in DIGEST_SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(zip(*out) if out else [()] * 6, kinds)], names)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted text says, read back from the text and its spans."""
    return formatted.mapInArrow(_digests, DIGEST_SCHEMA)
