"""Static range asymmetric numeral system over numpy lanes, with checkpoints and checksums.

A block holds the ids of whole documents. Its lanes take turns, one id each, and share one stream of
32-bit words; every numpy operation moves all lanes one step. States stay in [2^31, 2^63). The encoder
walks the ids backwards, so the decoder reads the stream forwards. Every ``every`` steps the encoder
records all states and the place in the stream: decoding can start at any such checkpoint.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

LOW = np.uint64(2**31)
WORD = np.uint64(32)


@dataclass(frozen=True)
class Table:
    """Frequencies of ids, scaled to sum to ``2 ** bits``; every id that occurs has at least 1."""

    freq: np.ndarray
    start: np.ndarray
    symbol: np.ndarray
    bits: int

    @staticmethod
    def of(freq: np.ndarray) -> Table:
        bits = int(freq.sum()).bit_length() - 1
        start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
        return Table(freq.astype(np.uint64), start, symbol, bits)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a power of two that leaves each occurring id at least 1."""
    bits = max(18, int(np.count_nonzero(counts)).bit_length() + 2)
    total = int(counts.sum())
    freq = np.array([max(1, (int(n) << bits) // total) if n else 0 for n in counts], dtype=np.int64)
    excess = int(freq.sum()) - (1 << bits)
    for k in np.argsort(-freq, kind="stable"):
        if not excess:
            break
        cut = min(excess, int(freq[k]) - 1)  # negative: what is missing goes to the most frequent id
        freq[k] -= cut
        excess -= cut
    return freq


@dataclass(frozen=True)
class Block:
    n_ids: int
    lanes: int
    steps: list[int]
    places: list[int]
    states: bytes
    payload: bytes
    payload_crc: int
    ids_crc: int


def encode(ids: np.ndarray, table: Table, lanes: int = 1024, every: int = 256) -> Block:
    """``ids`` is not empty. Short blocks use fewer lanes."""
    lanes = max(1, min(lanes, len(ids) // 64))
    bits, room = np.uint64(table.bits), np.uint64(63 - table.bits)
    state = np.full(lanes, LOW, dtype=np.uint64)
    words: list[np.ndarray] = []
    written = 0
    marks: list[tuple[int, int, bytes]] = []
    for step in range((len(ids) - 1) // lanes, -1, -1):
        row = ids[step * lanes : (step + 1) * lanes]
        freq, x = table.freq[row], state[: len(row)]
        full = x >= (freq << room)
        out = x[full]
        if len(out):
            words.append(out.astype(np.uint32))
            written += len(out)
            x[full] = out >> WORD
        turns = x // freq
        state[: len(row)] = (turns << bits) + (x - turns * freq) + table.start[row]
        if step % every == 0:
            marks.append((step, written, state.tobytes()))
    payload = np.concatenate(words[::-1] or [np.zeros(0, np.uint32)]).astype("<u4").tobytes()
    marks.reverse()
    return Block(
        len(ids),
        lanes,
        [step for step, _, _ in marks],
        [written - after for _, after, _ in marks],
        b"".join(states for _, _, states in marks),
        payload,
        zlib.crc32(payload),
        zlib.crc32(ids.astype("<u4").tobytes()),
    )


def decode(block: Block, table: Table, mark: int = 0, until: int | None = None) -> np.ndarray:
    """Ids from checkpoint ``mark`` up to checkpoint ``until`` (None: the end)."""
    lanes, bits = block.lanes, np.uint64(table.bits)
    mask = np.uint64((1 << table.bits) - 1)
    words = np.frombuffer(block.payload, dtype="<u4")
    state = np.frombuffer(block.states, dtype=np.uint64)[mark * lanes : (mark + 1) * lanes].copy()
    place, first = block.places[mark], block.steps[mark]
    end = block.n_ids if until is None else block.steps[until] * lanes
    ids = np.empty(end - first * lanes, dtype=np.uint32)
    for at in range(0, len(ids), lanes):
        x = state[: len(ids) - at]
        slot = x & mask
        row = table.symbol[slot]
        ids[at : at + lanes] = row
        x = table.freq[row] * (x >> bits) + slot - table.start[row]
        low = np.flatnonzero(x < LOW)
        if len(low):
            x[low] = (x[low] << WORD) | words[place : place + len(low)]
            place += len(low)
        state[: len(x)] = x
    return ids


def check_payload(block: Block) -> None:
    if zlib.crc32(block.payload) != block.payload_crc:
        raise ValueError("a block's payload is damaged")


def decode_checked(block: Block, table: Table) -> np.ndarray:
    check_payload(block)
    ids = decode(block, table)
    if zlib.crc32(ids.tobytes()) != block.ids_crc:
        raise ValueError("a block does not decode to its ids")
    return ids
