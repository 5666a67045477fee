r"""Chat formatting with a grammar round trip.

    conversation := turn*
    turn         := "<<SYS>>" text "<</SYS>>"       role system
                  | "[INST]" text "[/INST]"         role user
                  | "<s>" text "</s>"               role assistant
                  | "[ROLE]" role "[/ROLE]" "[TURN]" text "[/TURN]"

The parser is deterministic and strict: a marker where the grammar has none is an error. A turn is
rendered as it stands, parsed again and compared with its source. Where the two differ, its text is
escaped and the comparison repeated; a whole segment is compared once more before it goes out.
Escaping puts a backslash behind the first character of what looks like a marker, with or without
backslashes there (``[INST]`` becomes ``[\INST]``, and that ``[\\INST]``); parsing takes one away.
Text that conflicts with nothing stays as it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.text import table

MARKERS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
NAME, OTHER = ("[ROLE]", "[/ROLE]"), ("[TURN]", "[/TURN]")
ROLES = {opened: role for role, (opened, _) in MARKERS.items()}
CONTROL = [marker for pair in (*MARKERS.values(), NAME, OTHER) for marker in pair]
MARK = re.compile("|".join(re.escape(marker) for marker in CONTROL))
LIKE = re.compile(r"([<\[])(\\*)(" + "|".join(sorted({re.escape(marker[1:]) for marker in CONTROL})) + ")")
SEGMENT_CHARS = 4_000_000

PREFIX = 32  # characters of a text that decide where rows of one turn are dealt

FORMATTED = "conv_id long, part int, segment int, formatted string, loss_starts array<long>, loss_ends array<long>"
DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def escape(text: str) -> str:
    return LIKE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return LIKE.sub(lambda found: found[1] + found[2][1:] + found[3], text)


def render(role: str, text: str, escaped: bool) -> tuple[str, int]:
    """The turn, and how many characters stand before its text."""
    if role in MARKERS:
        opened, closed = MARKERS[role]
    else:
        opened, closed = NAME[0] + escape(role) + NAME[1] + OTHER[0], OTHER[1]
    return opened + (escape(text) if escaped else text) + closed, len(opened)


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, text, and where the text lies. Raises ValueError at what the grammar does not allow."""
    at = 0

    def between(pair: tuple[str, str], start: int) -> tuple[int, int, int]:
        first = start + len(pair[0])
        if not formatted.startswith(pair[0], start):
            raise ValueError(f"no {pair[0]} at {start}")
        found = MARK.search(formatted, first)
        if not found or found[0] != pair[1]:
            raise ValueError(f"no {pair[1]} after {start}")
        return first, found.start(), found.end()

    while at < len(formatted):
        opened = MARK.match(formatted, at)
        role = ROLES.get(opened[0]) if opened else None
        if role is None:
            first, last, at = between(NAME, at)
            role = unescape(formatted[first:last])
            pair = OTHER
        else:
            pair = MARKERS[role]
        first, last, at = between(pair, at)
        yield role, unescape(formatted[first:last]), first, last


def recovered(formatted: str) -> list[tuple[str, str]] | None:
    try:
        return [(role, text) for role, text, _, _ in parse(formatted)]
    except ValueError:
        return None


def render_checked(role: str, text: str) -> tuple[str, int]:
    for escaped in (False, True):
        turn, before = render(role, text, escaped)
        if recovered(turn) == [(role, text)]:
            return turn, before
    raise ValueError("a turn does not survive its own grammar")


def render_segment(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """All turns as one text, and the spans of assistant texts in it."""
    pieces, loss, length = [], [], 0
    for role, text in turns:
        turn, before = render_checked(role, text)
        if role == "assistant":
            closed = len(MARKERS[role][1])
            loss.append((length + before, length + len(turn) - closed))
        pieces.append(turn)
        length += len(turn)
    formatted = "".join(pieces)
    if recovered(formatted) != turns:
        raise ValueError("a conversation does not survive its own grammar")
    return formatted, loss


def format_conversations(rows: DataFrame, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """Conversations of ``conv_id``, ``turn``, ``role``, ``text`` as formatted text with loss spans.

    Tasks hold ranges of conversations and turns (equal turns by role and text), so a conversation with very
    many rows is formatted by many of them. A segment closes with its conversation, with its task and beyond
    ``segment_chars``; ``part`` and ``segment`` order the segments of a conversation. A task holds one
    segment, so a very long text is held alone. NULL texts and roles are empty, rows with a NULL id form one
    conversation, NULL turns come first, other columns go. An empty table gives no rows.
    """

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, number, turns, chars = TaskContext.get().partitionId(), None, 0, [], 0

        def close() -> pa.RecordBatch:
            text, loss = render_segment(turns)
            starts, ends = [a for a, _ in loss], [b for _, b in loss]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            row = [conv, part, number, text, starts, ends]
            names = ["conv_id", "part", "segment", "formatted", "loss_starts", "loss_ends"]
            return pa.RecordBatch.from_arrays(
                [pa.array([value], kind) for value, kind in zip(row, kinds, strict=True)], names=names
            )

        for batch in batches:
            for own, role, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if turns and (own != conv or chars >= segment_chars):
                    yield close()
                    number = number + 1 if own == conv else 0
                    turns, chars = [], 0
                conv = own
                turns.append((role, text))
                chars += len(text)
        if turns:
            yield close()

    named = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    dealt = named.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, PREFIX))
    return dealt.sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn").mapInArrow(formatted, FORMATTED)


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """Per conversation, what a reader gets back from the formatted text alone.

    A digest of one text is sequential, so the segments of a conversation pass through one task, one by one.
    """

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, seen, done = None, False, []

        def fresh() -> dict:
            return {"turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}

        def row() -> tuple:
            return (conv, state["turns"], state["all"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [field.split()[0] for field in DIGEST.split(", ")]
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        state = fresh()
        for batch in batches:
            for own, _, _, text, starts, ends in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if seen and own != conv:
                    done.append(row())
                    state = fresh()
                conv, seen = own, True
                for role, said, _, _ in parse(text):
                    state["turns"] += 1
                    state["all"].update(f"{role}\n{said}\n".encode())
                for start, end in zip(starts, ends, strict=True):
                    masked = unescape(text[start:end])
                    state["loss"].update(masked.encode())
                    state["loss_chars"] += len(masked)
                state["chars"] += len(text)
                if len(done) >= 1000:
                    yield batch_of(done)
                    done = []
        if seen:
            yield batch_of([*done, row()])

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part", "segment")
    return ordered.mapInArrow(digested, DIGEST)


def op10_chat_formatting(spark, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digest_conversations(format_conversations(rows.unionByName(added)))
