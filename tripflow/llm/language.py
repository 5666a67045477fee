"""Language identification by bit-sliced Bloom filters of byte n-grams.

Every language has a Bloom filter of the n-grams that are typical of it. The filters are stored
sliced: slot h holds one bit per language, so looking up an n-gram at all its hash positions and
taking the AND gives the mask of all languages that contain it. Over a document the bits are counted
per language; each count is corrected for the filter's own rate of false positives, and the language
with the highest corrected count wins.

The filters are fitted on a bounded sample of labelled rows: about ``sample_docs`` documents per language,
chosen by a hash of the id. All n-grams typical of a language in it are kept, and slots are as many as the largest
language needs. Prediction reads whole texts of all
documents and uses nothing but the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.text import bounded_batches, packed, table

UNKNOWN = "und"
N = 4
SAMPLE_DOCS = 3_000
SLOT_BITS = 20  # at least, and SPARE slots for each n-gram
SPARE = 16
HASHES = (0x9E3779B1, 0x85EBCA6B)  # odd multipliers; the top bits of the product choose the slot
MIN_COUNT = 3
TYPICAL = 0.25  # of the rate in the language that uses the n-gram most
PIECE = 1 << 20

# Everything in ASCII but letters separates words.
BLANKED = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def as_bytes(text: str) -> bytes:
    return b"  " + text.lower().encode(errors="replace").translate(BLANKED) + b"  "


def grams(data: np.ndarray) -> np.ndarray:
    """The code of the N bytes from every place on."""
    wide = data.astype(np.uint32)
    codes = wide[: len(wide) - N + 1].copy()
    for k in range(1, N):
        codes |= wide[k : len(wide) - N + 1 + k] << np.uint32(8 * k)
    return codes


def slots(codes: np.ndarray, multiplier: int, bits: int) -> np.ndarray:
    return (codes * np.uint32(multiplier)) >> np.uint32(32 - bits)


@dataclass(frozen=True)
class Model:
    """``sliced`` has one array per 64 languages; ``false_rate`` one number per language."""

    languages: list[str]
    sliced: list[np.ndarray]
    false_rate: np.ndarray
    slot_bits: int = SLOT_BITS

    @staticmethod
    def of(languages: list[str], typical: list[np.ndarray]) -> Model:
        sliced, rates = [], []
        largest = max((len(codes) for codes in typical), default=1)
        slot_bits = min(32, max(SLOT_BITS, (SPARE * max(largest, 1) - 1).bit_length()))
        for at in range(0, len(languages), 64):
            group = typical[at : at + 64]
            kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if len(group) <= 8 * k().itemsize)
            bits = np.zeros(1 << slot_bits, dtype=kind)
            for k, codes in enumerate(group):
                for multiplier in HASHES:
                    bits[slots(codes, multiplier, slot_bits)] |= kind(1 << k)
                filled = np.count_nonzero(bits & kind(1 << k)) / len(bits)
                rates.append(filled ** len(HASHES))
            sliced.append(bits)
        return Model(languages, sliced, np.array(rates), slot_bits)

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of each text (padded by ``as_bytes``), and how many of them each language contains."""
        lengths = np.array([len(text) for text in texts])
        starts = np.cumsum(lengths) - lengths
        codes = grams(np.frombuffer(b"".join(texts) + b" " * (N - 1), dtype=np.uint8))
        found = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        first, second = (slots(codes, multiplier, self.slot_bits) for multiplier in HASHES)
        ends = starts + lengths
        for group, bits in enumerate(self.sliced):
            mask = bits[first] & bits[second]
            for back in range(1, N):  # n-grams that reach into the next text
                mask[ends - back] = 0
            for k in range(min(64, len(self.languages) - 64 * group)):
                hit = (mask >> mask.dtype.type(k)) & mask.dtype.type(1)
                found[:, 64 * group + k] = np.add.reduceat(hit, starts, dtype=np.int64)
        return lengths - N + 1, found

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Counts per language without the hits that chance explains. Long texts go in overlapping pieces."""
        total = np.zeros(len(texts), dtype=np.int64)
        found = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        held, owners, size = [], [], 0

        def add() -> None:
            n, hits = self.counts(held)
            np.add.at(total, owners, n)
            np.add.at(found, owners, hits)

        for owner, text in enumerate(texts):
            for at in range(0, max(1, len(text) - N + 1), PIECE):
                piece = text[at : at + PIECE + N - 1]
                held.append(piece)
                owners.append(owner)
                size += len(piece)
                if size >= PIECE:
                    add()
                    held, owners, size = [], [], 0
        if held:
            add()
        return np.maximum(0, (found - total[:, None] * self.false_rate) / (1 - self.false_rate))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        sample_docs: int = SAMPLE_DOCS) -> Model:
    """Filters from labelled documents; those without language or text teach nothing. Texts are read whole."""
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {row[lang]: row["count"] for row in labelled.groupBy(lang).count().collect()}  # a row per language
    languages = sorted(sizes)
    if not languages:
        return Model([], [], np.zeros(0))
    share = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, sample_docs / sizes[name]))])
    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30)) / F.lit(1 << 30)
    sample = labelled.filter(place < F.element_at(share, F.col(lang))).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                own: dict[str, list[bytes]] = {}
                part = batch.slice(at, 200)
                for name, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    own.setdefault(name, []).append(as_bytes(value))
                for name, texts in own.items():
                    codes, n = np.unique(grams(np.frombuffer(b"".join(texts), dtype=np.uint8)), return_counts=True)
                    columns = [pa.array([name] * len(codes)), pa.array(codes.astype(np.int64)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "code", "n"])

    counts = sample.mapInArrow(counted, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rate = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
    rated = counts.withColumn("rate", rate).withColumn("most", F.max("rate").over(Window.partitionBy("code")))
    typical = rated.filter((F.col("n") >= MIN_COUNT) & (F.col("rate") >= TYPICAL * F.col("most")))
    codes: dict[str, list[int]] = {name: [] for name in languages}
    for row in typical.select("lang", "code").toLocalIterator():
        codes[row["lang"]].append(row["code"])
    return Model.of(languages, [np.array(codes[name], dtype=np.uint32) for name in languages])


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows as struct ``row`` with ``lang_pred`` and ``score``, the winner's part of all counts.

    NULL texts and those without a letter are ``und`` with score 0, and so is everything when the model
    has learned no language. A text none of whose n-grams any language has goes to the first one with
    score 0. Ties go to the first language by name. Very long texts go through in pieces. Other columns travel in
    ``row``. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    kept = packed(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # from 1 MB for each 8 languages on, by the n-grams of the sample

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column(0).field(text).to_pylist()
                known = [k for k, value in enumerate(texts) if learned.languages and has_letter(value)]
                names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                if known:
                    found = learned.scores([as_bytes(texts[k]) for k in known])
                    best, total = found.argmax(axis=1), found.sum(axis=1)
                    for k, winner, own, every in zip(known, best, found, total, strict=True):
                        names[k] = learned.languages[winner]
                        scores[k] = float(own[winner] / every) if every else 0.0
                columns = [part.column(0), pa.array(names), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "lang_pred", "score"])

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType(kept.schema.fields + added)
    return kept.mapInArrow(predicted, schema)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_unheld(docs: DataFrame) -> Model:
    return fit(docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # The identifier sees the text and, to hand it through, the id.
    marked = identify(docs.select("doc_id", "text"), fit_unheld(docs))
    return marked.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")
