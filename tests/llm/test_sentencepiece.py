"""The library itself is the oracle: the same pieces, typed as a unigram model with the same scores."""

from __future__ import annotations

import random
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

from tests.llm.cases import clashing, documents, frame, prose
from tripflow.llm import sentencepiece as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a  b\n\n c 漢字𐍈 é\t x", "▁a ▁▁ b", " ", "   ", "\n", "a", "...,,,!!! a.b,c;d 12.5%", "x" * 40]


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte, at = data[at], at + 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def as_varint(value: int) -> bytes:
    out = b""
    while value > 127:
        out, value = out + bytes([value & 127 | 128]), value >> 7
    return out + bytes([value])


def fields(data: bytes):
    at = 0
    while at < len(data):
        key, at = varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = varint(data, at)
        else:
            size, at = (4, at) if kind == 5 else (8, at) if kind == 1 else varint(data, at)
            value, at = data[at : at + size], at + size
        yield key >> 3, kind, value


def field(number: int, kind: int, value) -> bytes:
    body = as_varint(value) if kind == 0 else value if kind in (1, 5) else as_varint(len(value)) + value
    return as_varint(number << 3 | kind) + body


@pytest.fixture(scope="module")
def model():
    return sp.Unigram(PATH)


@pytest.fixture(scope="module")
def oracle(model):
    out = b""
    with open(PATH, "rb") as file:
        for number, kind, value in fields(file.read()):
            if number == 1:  # a piece: text 1, score 2
                own = list(fields(value))
                known = model.pieces.get(next(v for n, _, v in own if n == 1).decode())
                if known:
                    own = [f for f in own if f[0] != 2] + [(2, 5, struct.pack("<f", known[1] / sp.SCALE))]
                value = b"".join(field(*f) for f in own)
            elif number == 2:  # the trainer's settings: model type 3, of which 1 is unigram
                value = b"".join(field(*f) for f in fields(value) if f[0] != 3) + field(3, 0, 1)
            out += field(number, kind, value)
    return SentencePieceProcessor(model_proto=out)


def ids_of(data: bytes) -> list[int]:
    return np.frombuffer(data, dtype="<i4").tolist()


def texts():
    return [*ODD, *(text or "" for _, text, *_ in documents() if len(text or "") < 8000), prose(4, 800)]


def test_ids_are_those_of_the_library(model, oracle):
    for text in texts():
        assert ids_of(model.encode(text)) == oracle.encode(text)
    ids, ends = model.encode_batch(pa.array(texts()))
    assert [own.tolist() for own in np.split(ids, ends[:-1])] == [oracle.encode(text) for text in texts()]


def test_decoding_gives_the_text_back(model):
    for text in texts():
        if sp.SPACE not in text:
            assert model.decode(np.array(ids_of(model.encode(text)), dtype=int)) == text


def test_memory_of_stretches_may_be_cleared(model, monkeypatch):
    fresh = sp.Unigram(PATH)
    monkeypatch.setattr(sp, "CACHED", 3)
    assert [fresh.encode(text) for text in texts()] == [model.encode(text) for text in texts()]


def in_chunks(model, text: str, size: int) -> bytes:
    text = sp.SPACE + text.replace(" ", sp.SPACE)
    starts = range(0, len(text), size)
    chunks = [(text[max(at - model.reach + 1, 0) : at + size], min(at, model.reach - 1)) for at in starts]
    row = np.array([0] + [sp.NEVER] * (model.reach - 1), dtype=np.int64)
    entries = []
    for chunk in chunks:
        entries.append(row)
        row = sp.combined(row, model.matrix(*chunk))
    left, out = 0, []
    for chunk, entry in reversed(list(zip(chunks, entries, strict=True))):
        out.append(model.chunk_ids(*chunk, entry, left))
        left = model.exits(*chunk, entry)[left]
    return b"".join(reversed(out))


@pytest.mark.parametrize("size", [16, 17, 40, 333])
def test_chunks_give_the_same_ids(model, size):
    rng = random.Random(size)
    hard = ["".join(rng.choices("abcdeth inou", k=1500)), "x" * 1000, "addEventListener" * 40, "." * 300 + " " * 100,
            "".join(rng.choices("etaoin", k=2500)), prose(5, 200)]
    assert all(in_chunks(model, text, size) == model.encode(text) for text in hard)


def test_matrices_combine_in_any_order(model):
    rng = random.Random(3)
    text = "".join(rng.choices("etaoin", k=200))
    parts = [model.matrix(text[max(at - 15, 0) : at + 50], min(at, 15)) for at in range(0, 200, 50)]
    left = sp.combined(sp.combined(sp.combined(parts[0], parts[1]), parts[2]), parts[3])
    right = sp.combined(parts[0], sp.combined(parts[1], sp.combined(parts[2], parts[3])))
    assert (left[0] == right[0]).all()


@pytest.mark.parametrize("chunk", [40, 3000])
def test_documents_are_encoded_whole(spark, model, chunk):
    docs = clashing(frame(spark))
    rows = sp.encode(docs, PATH, chunk_chars=chunk, decoded=True).select("row.doc_id", "row.text", "ids", "decoded").collect()
    assert len(rows) == len(documents())
    for row in rows:
        assert row["ids"] == ids_of(model.encode(row["text"] or ""))
        assert row["decoded"] == (row["text"] or "")


def test_empty_table(spark):
    assert sp.decode(sp.encode(frame(spark, []), PATH), PATH).count() == 0
    assert sp.encode(frame(spark, []), PATH, decoded=True).count() == 0
