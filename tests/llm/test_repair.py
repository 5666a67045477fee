from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import repair

PATTERN = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(rows: list[tuple[str, str, bool, bool]]) -> tuple[int, str, list[tuple[str, str]]]:
    """All edits in order of (cost, letters), by the pattern's own rules; rows are role, text, must go, truncated."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, at, initials, kept = heapq.heappop(heap)
        key = (at, initials[:1] == "s", len(initials) > 0, initials[-1:])
        if at == len(rows) and PATTERN.match(initials):
            return cost, letters, list(kept)
        if (key, cost, letters) in seen or len(initials) > 2 * len(rows) + 4:
            continue
        seen.add((key, cost, letters))
        options = [("I", 2, role, "", 0) for role in ("user", "assistant")]
        if at < len(rows):
            role, text, gone, truncated = rows[at]
            options.append(("D", 3, None, None, 1))
            if not gone:
                options.append(("K", truncated, role, text, 1))
                options += [("R", 2 + truncated, other, text, 1) for other in ("user", "assistant")]
        for letter, price, role, text, step in options:
            new = initials + role[:1] if role is not None else initials
            if role is not None and (not role or not re.match(r"s?(ua)*u?\Z", new)):
                continue
            more = kept if role is None else (*kept, (role, text))
            heapq.heappush(heap, (cost + price, letters + letter, at + step, new, more))
    raise AssertionError


def brute(turns: list[tuple]) -> dict[int | None, tuple]:
    """The contract in plain Python."""
    found = {}
    for conv in {row[0] for row in turns}:
        own = []
        for _, turn, role, text in sorted(
            (row for row in turns if row[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " ")
        ):
            name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(name.encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        numbers = [turn for turn, _, _ in own if turn is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        counts, seen, marked = dict.fromkeys(("blank", "duplicate", "truncated"), 0), set(), []
        for _, role, text in own:
            said = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, rows = cheapest(marked)
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in rows).encode()).hexdigest()
        found[conv] = (conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)
    return found


def generated(n: int, longest: int = 7) -> list[tuple]:
    rng = random.Random(11)
    texts = ["Yes.", "No", "Why?", "", " \n", None, "a.b", "Ünï!", "x ", "ok. \t"]
    roles = ["system", "user", "user", "assistant", "assistant", "tool", None, ""]
    turns = []
    for conv in [None, *range(n)]:
        for turn in range(rng.randint(1, longest)):
            number = None if rng.random() < 0.08 else turn * rng.choice([1, 1, 1, 2])
            turns.append((conv, number, rng.choice(roles), rng.choice(texts)))
    turns += [turns[3], turns[3], (n, 1, "user", "same.")] + [(n, k, "user", "same.") for k in range(6)]
    return turns


def collected(frame) -> dict:
    rows = [tuple(row[name] for name in repair.RESULT_NAMES) for row in frame.collect()]
    assert len(rows) == len({row[0] for row in rows})
    return {row[0]: row for row in rows}


@pytest.mark.parametrize("rows, chars", [(50_000, 4_000_000), (1, 4_000_000), (3, 4_000_000), (50_000, 5)])
def test_equals_brute_force_whatever_the_pieces(spark, monkeypatch, rows, chars):
    monkeypatch.setattr(repair, "PIECE_ROWS", rows)
    monkeypatch.setattr(repair, "PIECE_CHARS", chars)
    turns = generated(120)
    frame = spark.createDataFrame(turns, SCHEMA).withColumns({n: F.lit("x") for n in ("part", "seq", "first", "digest", "cost")})
    assert collected(repair.digests(repair.repair(repair.damaged(frame)))) == brute(turns)


def test_block_tables_equal_single_rows():
    t = repair.tables()
    rng = np.random.default_rng(3)
    for n in (0, 1, 3, 4, 5, 17, 40):
        symbols = rng.integers(0, repair.SYMBOLS, n).astype(np.uint8)
        costs = repair.end_costs()
        for symbol in symbols[::-1]:
            costs = repair.one_row(costs, int(symbol))
        between, total = repair.vectors_between(symbols, t.end)
        assert tuple(total + cost for cost in t.vectors[between[0]]) == costs
        before, added = repair.whole_map(symbols)
        assert (before[t.end], added[t.end]) == (between[0], total)
    assert len(t.vectors) < 200


def test_one_conversation_over_many_tasks(spark):
    """A third of the rows and more in one conversation, many of them equal."""
    long = [(7, k, ["user", "assistant"][k % 2], f"said {k % 400}{'.' * (k % 3)}") for k in range(4000)]
    turns = [*generated(40), *long, *([(7, 5, "user", "again")] * 300)]
    frame = spark.createDataFrame(turns, SCHEMA).repartition(16)
    whole = collected(repair.digests(repair.repair(repair.damaged(frame))))
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")  # or AQE makes one task of so few rows
    try:
        found = collected(repair.digests(repair.repair(repair.damaged(frame))))
        solved = repair.solved(repair.ordered(repair.damaged(frame).withColumn("times", F.col("times").cast("long"))))
        assert solved.filter("part IS NOT NULL AND conv_id = 7").select("part").distinct().count() > 1
    finally:
        spark.conf.unset(merging)
    assert found == whole
    assert found[3] == brute([t for t in turns if t[0] == 3])[3]
    mine = [t for t in turns if t[0] == 7]
    kinds = [zlib.crc32(f"7:{t[1]}".encode()) % 20 for t in mine]
    kept = sum({0: 0, 3: 2}.get(kind, 1) for kind in kinds)
    assert sum(found[7][7].count(letter) for letter in "DKR") == kept


def test_clean_dropped_and_no_conversations(spark):
    clean = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Hello!")]
    found = collected(repair.digests(repair.repair(spark.createDataFrame(clean, SCHEMA))))
    digest = hashlib.sha256(b"system:Be kind.\nuser:Hi?\nassistant:Hello!").hexdigest()
    assert found[1] == (1, 0, 0, 0, 0, 0, 0, "KKK", digest)
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    found = collected(repair.digests(repair.repair(repair.damaged(spark.createDataFrame([(gone, 0, "user", "x")], SCHEMA)))))
    assert found[gone] == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.digests(repair.repair(spark.createDataFrame([], SCHEMA))).count() == 0


def test_repaired_rows_follow_the_pattern(spark):
    frame = spark.createDataFrame(generated(80), SCHEMA)
    for row in repair.repair(frame).collect():
        assert PATTERN.match("".join(role[:1] for role in row["repaired_roles"])) and row["segment"] == 0 and row["last"]
        kept = [text for text in row["repaired_texts"] if text]
        assert len(row["repaired_texts"]) == sum(row["audit"].count(letter) for letter in "KRI")
        assert len(kept) == sum(row["audit"].count(letter) for letter in "KR")


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    turns = [tuple(row) for row in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(repair.op13_conversation_repair(spark, folder)) == brute(turns)
