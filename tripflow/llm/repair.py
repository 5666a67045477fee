"""Repair of a conversation's structure at least cost, by Four-Russians block tables.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles. A row may be kept (0), given
the role that is due (2) or deleted (3, and a blank or repeated row must be); an empty row of the role
that is due may be inserted anywhere (2); a truncated row that is not deleted costs 1.

What the rest of a conversation costs from each of the four states of that pattern is a vector. Less
its least entry it is one of a few dozen, so that for every such vector and every block of ``BLOCK``
rows (nine kinds of row) one table holds the vector before the block and what was taken off. The cost is found
from the end backwards, one lookup a block. For the edits, each block is then expanded backwards row
by row from the vector behind it and read forwards: of the edits that keep the cost the first by
letter (D, I, K, R) is taken, which gives the ASCII-least of all cheapest sequences.

Rows come in order through tasks that hold ranges of conversations and turns. A conversation inside one task
is solved there. One that crosses tasks, or is longer than a piece, goes out as pieces with the map
from every vector behind the piece to the one before it; maps are applied from the last piece to the
first, and one more pass in order traces the pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.text import bounded_batches, table
from tripflow.session import stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
DUE = (USER, USER, ASSISTANT, USER)  # by state: the role that may come next, but for a first system row
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
MUST_GO, KINDS = 0, "?sua"  # other symbols: 1 + 2 * kind + truncated
SYMBOLS = 1 + 2 * len(KINDS)
BLOCK = 4
SPACES = " \t\n\x0b\x0c\r"
PIECE_ROWS, PIECE_CHARS = 50_000, 4_000_000
PREFIX = 32  # characters of a text that decide where rows of one turn are dealt

COUNTS = ("blank", "duplicate", "truncated", "illegal")
RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
RESULT_NAMES = [column.split()[0] for column in RESULT.split(", ")]
SEGMENT = (
    "conv_id long, segment int, last boolean, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_roles array<string>, repaired_texts array<string>"
)
SEGMENT_NAMES = [column.split()[0] for column in SEGMENT.split(", ")]
PIECE = (
    "part int, seq int, symbols binary, extras array<long>, roles array<string>, texts array<string>, "
    "first_turn long, last_turn long, turns long, first_initial string, last_initial string, "
    "before array<int>, added array<long>"
)


def kept_state(state: int, kind: str) -> int | None:
    """The state after keeping a row of this initial, if it may be kept."""
    if kind == "s" and state == START:
        return SYSTEM
    return DUE[state] if kind in "ua" and kind == NAMES[DUE[state]][0] else None


def relaxed(costs: list[int]) -> tuple[int, ...]:
    for _ in range(2):
        costs = [min(cost, INSERT + costs[DUE[state]]) for state, cost in enumerate(costs)]
    return tuple(costs)


def end_costs() -> tuple[int, ...]:
    far = 10**6
    return relaxed([0, far, far, 0])


def one_row(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs before a row, from those behind it."""
    costs = [DELETE + cost for cost in after]
    if symbol != MUST_GO:
        kind, truncated = KINDS[(symbol - 1) // 2], (symbol - 1) % 2 * TRUNCATED
        for state in range(4):
            costs[state] = min(costs[state], REROLE + truncated + after[DUE[state]])
            to = kept_state(state, kind)
            if to is not None:
                costs[state] = min(costs[state], KEEP + truncated + after[to])
    return relaxed(costs)


@dataclass(frozen=True)
class Tables:
    """``vectors`` by number; for a row or a block of rows, the number before it and what was taken off."""

    vectors: list[tuple[int, ...]]
    row_before: np.ndarray
    row_added: np.ndarray
    before: np.ndarray
    added: np.ndarray
    end: int


@cache
def tables() -> Tables:
    known: dict[tuple[int, ...], int] = {}
    todo: list[tuple[int, ...]] = []

    def number(costs: tuple[int, ...]) -> tuple[int, int]:
        least = min(costs)
        vector = tuple(cost - least for cost in costs)
        if vector not in known:
            known[vector] = len(known)
            todo.append(vector)
        return known[vector], least

    end, _ = number(end_costs())
    rows = []
    while len(rows) < len(todo):
        rows.append([number(one_row(todo[len(rows)], symbol)) for symbol in range(SYMBOLS)])
    row = np.array(rows, dtype=np.int64)
    row_before, row_added = row[:, :, 0], row[:, :, 1]
    before, added = row_before, row_added
    for _ in range(BLOCK - 1):  # one more row in front
        more = row_added[before] + added[:, :, None]
        before, added = (each.transpose(0, 2, 1).reshape(len(rows), -1) for each in (row_before[before], more))
    return Tables(todo, row_before, row_added, before, added, end)


PLACES = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)


def blocks_of(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rows in front that fill no block, and codes of the blocks behind them with their rows."""
    loose = len(symbols) % BLOCK
    return symbols[:loose], list(symbols[loose:].reshape(-1, BLOCK))


def vectors_between(symbols: np.ndarray, end: int) -> tuple[list[int], int]:
    """Numbers of the vectors before the piece, before each block, and behind the last; and the cost taken off."""
    found, total, t = [end], 0, tables()
    loose, blocks = blocks_of(symbols)
    codes = (symbols[len(loose) :].reshape(-1, BLOCK).astype(np.int64) @ PLACES).tolist()
    for code in reversed(codes):
        total += int(t.added[found[-1], code])
        found.append(int(t.before[found[-1], code]))
    number = found[-1]
    for symbol in loose[::-1]:
        total += int(t.row_added[number, symbol])
        number = int(t.row_before[number, symbol])
    return [number, *found[::-1]], total


def whole_map(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every vector behind the rows, the one before them and the cost taken off."""
    t = tables()
    number, total = np.arange(len(t.vectors)), np.zeros(len(t.vectors), dtype=np.int64)
    loose, _ = blocks_of(symbols)
    for code in (symbols[len(loose) :].reshape(-1, BLOCK).astype(np.int64) @ PLACES)[::-1]:
        total += t.added[number, code]
        number = t.before[number, code]
    for symbol in loose[::-1]:
        total += t.row_added[number, symbol]
        number = t.row_before[number, symbol]
    return number, total


@lru_cache(maxsize=1 << 16)
def block_edits(symbols: bytes, end: int, state: int) -> tuple[tuple[str, ...], int]:
    """One string of letters per row (insertions before it, then its own edit), and the state behind them."""
    t = tables()
    numbers, offsets = [end], [0]
    for symbol in reversed(symbols):
        offsets.append(offsets[-1] + int(t.row_added[numbers[-1], symbol]))
        numbers.append(int(t.row_before[numbers[-1], symbol]))
    costs = [[offset + cost for cost in t.vectors[n]] for n, offset in zip(numbers[::-1], offsets[::-1], strict=True)]
    edits = []
    for k, symbol in enumerate(symbols):
        letters, here, after = "", costs[k], costs[k + 1]
        truncated = (symbol - 1) % 2 * TRUNCATED
        while True:
            if here[state] == DELETE + after[state]:
                letters += "D"
                break
            if here[state] == INSERT + here[DUE[state]]:
                letters, state = letters + "I", DUE[state]
                continue
            to = kept_state(state, KINDS[(symbol - 1) // 2])
            if to is not None and here[state] == KEEP + truncated + after[to]:
                letters, state = letters + "K", to
            else:
                letters, state = letters + "R", DUE[state]
            break
        edits.append(letters)
    return tuple(edits), state


def edits_of(symbols: np.ndarray, end: int, state: int) -> Iterator[str]:
    """Edits of every row in order."""
    between, _ = vectors_between(symbols, end)
    loose, blocks = blocks_of(symbols)
    for rows, behind in zip([loose, *blocks], between[1:], strict=True):
        edits, state = block_edits(rows.tobytes(), behind, state)
        yield from edits


@dataclass
class Repaired:
    """What comes out of a conversation's pieces, put in one after the other. Counts, cost, edits and rows are those
    since the last segment was taken."""

    state: int = START
    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0
    last_initial: str | None = None
    segments: int = 0

    def __post_init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.cost, self.counts = 0, dict.fromkeys(COUNTS, 0)
        self.audit: list[str] = []
        self.roles: list[str] = []
        self.texts: list[str] = []

    def write(self, role: str, text: str) -> None:
        self.roles.append(role)
        self.texts.append(text)

    def add(self, piece: dict, end: int) -> None:
        """One piece, before the vector of number ``end``."""
        for name in COUNTS:
            self.counts[name] += piece[name]
        if self.last_initial is not None and piece["first_initial"] is not None:
            self.counts["illegal"] += self.last_initial + piece["first_initial"] not in LEGAL
        if piece["last_initial"] is not None:
            self.last_initial = piece["last_initial"]
        if piece["turns"]:
            self.turns += piece["turns"] - (self.last_turn == piece["first_turn"])
            self.first_turn = piece["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = piece["last_turn"]
        symbols = np.frombuffer(piece["symbols"], dtype=np.uint8)
        for k, letters in enumerate(edits_of(symbols, end, self.state)):
            truncated = (int(symbols[k]) - 1) % 2 * TRUNCATED
            for letter in letters:
                if letter == "D":
                    self.cost += DELETE
                    continue
                due = DUE[self.state]
                if letter == "I":
                    self.write(NAMES[due], "")
                    self.cost += INSERT
                elif letter == "R":
                    self.write(NAMES[due], piece["texts"][k])
                    self.cost += REROLE + truncated
                else:
                    due = kept_state(self.state, KINDS[(int(symbols[k]) - 1) // 2])
                    self.write(piece["roles"][k], piece["texts"][k])
                    self.cost += KEEP + truncated
                self.state = due
            self.cost += DELETE * piece["extras"][k]
            self.audit.append(letters + "D" * piece["extras"][k])

    def segment(self, conv: int | None, last: bool) -> dict:
        """What has come out since the last one; the last also has the insertions at the end, and the gaps."""
        while last and self.state in (SYSTEM, USER):
            self.state = DUE[self.state]
            self.write(NAMES[self.state], "")
            self.cost += INSERT
            self.audit.append("I")
        gaps = self.last_turn - self.first_turn + 1 - self.turns if last and self.turns else 0
        row = {"conv_id": conv, "segment": self.segments, "last": last, "gaps": gaps, "cost": self.cost}
        row |= self.counts | {"audit": "".join(self.audit), "repaired_roles": self.roles, "repaired_texts": self.texts}
        self.segments += 1
        self.clear()
        return row


class Piece:
    """Rows of one conversation, in order."""

    def __init__(self) -> None:
        self.symbols, self.extras, self.roles, self.texts = bytearray(), [], [], []
        self.counts = dict.fromkeys(COUNTS, 0)
        self.first_turn = self.last_turn = self.first_initial = self.last_initial = None
        self.turns = self.chars = 0

    def full(self) -> bool:
        return len(self.symbols) >= PIECE_ROWS or self.chars >= PIECE_CHARS

    def add(self, turn: int | None, role: str, text: str, times: int, fresh: bool) -> None:
        """``times`` equal rows of one turn; 0 stands for rows that the damage dropped."""
        if not times:
            return
        initial, said = role[:1], text.rstrip(SPACES)
        self.counts["illegal"] += times - 1
        if self.last_initial is not None:
            self.counts["illegal"] += self.last_initial + initial not in LEGAL
        else:
            self.first_initial = initial
        self.last_initial = initial
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        symbol = MUST_GO
        if not said:
            self.counts["blank"] += times
        else:
            self.counts["duplicate"] += times - fresh
            if fresh:
                truncated = said[-1] not in ".!?"
                self.counts["truncated"] += truncated
                symbol = 1 + 2 * max(0, KINDS.find(initial) if initial else 0) + truncated
        self.symbols.append(symbol)
        self.extras.append(times - 1)
        self.roles.append(role if symbol else "")
        self.texts.append(text if symbol else "")
        self.chars += len(text) if symbol else 0

    def as_dict(self) -> dict:
        names = ("extras", "roles", "texts", "first_turn", "last_turn", "turns", "first_initial", "last_initial")
        return self.counts | {"symbols": bytes(self.symbols)} | {name: getattr(self, name) for name in names}


def arrow_schema(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def ordered(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one with their number, whether any is the first of its role and text, in
    order of conversation and turn over the tasks. ``rows`` has ``times``, 0 where a row only names its
    conversation."""
    keys = ["conv_id", "turn", "role", "text"]
    listed = rows.groupBy(*keys).agg(F.sum("times").alias("times")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    again = (
        listed.filter("times > 0").groupBy("conv_id", "role", "digest")
        .agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("held")).filter("held > 1")
        .toDF("conv", "said_by", "said", "first", "held")
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("role") == F.col("said_by")) & (F.col("digest") == F.col("said"))
    )
    fresh = F.col("first").isNull() | F.struct("turn").eqNullSafe(F.col("first"))
    marked = listed.join(again, same, "left").select(*keys, "times", fresh.alias("fresh"))
    dealt = marked.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, PREFIX))
    return dealt.sortWithinPartitions(*keys)


def solved(rows: DataFrame) -> DataFrame:
    """Repaired conversations that lie inside one task, and pieces of all others."""
    schema = arrow_schema(rows.sparkSession, f"{SEGMENT}, {PIECE}")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, done = TaskContext.get().partitionId(), 0, []
        conv, piece, at_edge, cut = None, None, True, False

        def closed(edge: bool) -> dict:
            nonlocal seq
            if not edge:
                repaired = Repaired()
                repaired.add(piece.as_dict(), tables().end)
                return repaired.segment(conv, last=True)
            seq += 1
            before, added = whole_map(np.frombuffer(bytes(piece.symbols), dtype=np.uint8))
            own = piece.as_dict() | {"conv_id": conv, "part": part, "seq": seq}
            return own | {"before": before.tolist(), "added": added.tolist()}

        for batch in batches:
            for own, turn, role, text, times, fresh in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if piece is not None and (own != conv or piece.full()):
                    cut = own == conv
                    large = piece.chars
                    done.append(closed(at_edge or cut))
                    at_edge = cut
                    piece = None
                    if large > PIECE_CHARS // 8 or len(done) >= 1000:
                        yield pa.RecordBatch.from_pylist(done, schema=schema)
                        done = []
                conv = own
                piece = Piece() if piece is None else piece
                piece.add(turn, role, text, times, fresh)
        if piece is not None:
            done.append(closed(True))
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)

    return rows.mapInArrow(made, f"{SEGMENT}, {PIECE}")


def ends_of(pieces: DataFrame) -> DataFrame:
    """Number of the vector behind each piece, from the last piece of a conversation to its first."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, end = None, tables().end
        fresh = True
        for batch in batches:
            ends = []
            for own, before in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if fresh or own != conv:
                    conv, end, fresh = own, tables().end, False
                ends.append(end)
                end = before[end]
            columns = [*(batch.column(k) for k in range(3)), pa.array(ends, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "seq", "behind"])

    names = ["conv_id", "part", "seq"]
    back = pieces.select(*names, "before").repartition("conv_id")
    back = back.sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq"))
    return back.mapInArrow(made, "conv_id long, part int, seq int, behind int").drop("conv_id")


def joined(pieces: DataFrame) -> DataFrame:
    """The conversations in pieces, a segment for each. Their texts pass through in order, one piece at a time."""
    schema = arrow_schema(pieces.sparkSession, SEGMENT)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, repaired = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                piece = batch.slice(k, 1).to_pylist()[0]
                if repaired is not None:
                    last = piece["conv_id"] != conv
                    yield pa.RecordBatch.from_pylist([repaired.segment(conv, last)], schema=schema)
                    repaired = None if last else repaired
                conv = piece["conv_id"]
                repaired = Repaired() if repaired is None else repaired
                repaired.add(piece, piece["behind"])
        if repaired is not None:
            yield pa.RecordBatch.from_pylist([repaired.segment(conv, True)], schema=schema)

    ended = pieces.join(ends_of(pieces), ["part", "seq"]).drop("before", "added")
    return ended.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(made, SEGMENT)


def repair(rows: DataFrame) -> DataFrame:
    """The least-cost repair of every conversation of ``conv_id``, ``turn``, ``role``, ``text``.

    The repaired rows of a conversation (``repaired_roles``, ``repaired_texts``), the letters of its edits, its faults
    and its cost; rows with a NULL id are one conversation. One row each, but for a conversation in pieces: that has
    a row per ``segment``, whose counts and costs add up, and ``gaps`` on the ``last``. NULL roles and texts read as one space; NULL turns come first, rows of one
    turn by role and text. A column ``times`` says how often a row stands (1 where there is none); 0 names
    the conversation only, so that one without rows still has its result. Other columns go. Of a row that
    stands several times one may be kept. An empty table gives no rows. Memory holds one piece
    (``PIECE_ROWS`` rows or ``PIECE_CHARS`` characters, and one row more) beside one audit.
    """
    bounded_batches(rows.sparkSession)
    times = F.col("times").cast("long") if "times" in rows.columns else F.lit(1).cast("long")
    space = F.lit(" ")
    plain = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), times.alias("times"),
    )
    found = stage(solved(ordered(plain)), "repair-solved")
    pieces = found.filter("part IS NOT NULL").drop(*[name for name in SEGMENT_NAMES if name not in ("conv_id", *COUNTS)])
    return found.filter("part IS NULL").select(*SEGMENT_NAMES).union(joined(pieces).select(*SEGMENT_NAMES))


def digests(segments: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost, all edits, and the SHA-256 of its repaired rows as ``role:text`` lines.

    A conversation of one segment is digested where it is; the segments of others come together in order, and a
    digest of one text is sequential, so they pass through one task.
    """
    lines = F.zip_with("repaired_roles", "repaired_texts", lambda role, text: F.concat(role, F.lit(":"), text))
    whole = F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256")
    single = segments.filter("segment = 0 AND last").select(*RESULT_NAMES[:-1], whole)
    schema = arrow_schema(segments.sparkSession, RESULT)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, total, audit, empty = hashlib.sha256(), {}, [], True
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                for role, text in zip(row["repaired_roles"], row["repaired_texts"], strict=True):
                    digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode(errors="surrogatepass"))
                    empty = False
                audit.append(row["audit"])
                for name in ("gaps", "cost", *COUNTS):
                    total[name] = total.get(name, 0) + row[name]
                if row["last"]:
                    done = total | {"conv_id": row["conv_id"], "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
                    yield pa.RecordBatch.from_pylist([done], schema=schema)
                    digest, total, audit, empty = hashlib.sha256(), {}, [], True

    several = segments.filter("NOT (segment = 0 AND last)").repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return single.union(several.mapInArrow(made, RESULT).select(*RESULT_NAMES))


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage; rows that it drops stay without a text, ``times`` 0."""
    space = F.lit(" ")
    named = F.concat(*[F.coalesce(F.col(c).cast("string"), space) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    kind = F.crc32(named.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return rows.select(
        "conv_id", "turn",
        F.when(kind == 0, "").when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return digests(repair(damaged(table(spark, sf_dir, "conversations"))))
