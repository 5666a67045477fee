"""Token ids of documents in files of entropy-coded blocks, in ascending order of document id.

Texts are encoded once; ids are counted over all documents into one shared frequency table; then a
range sort by id deals the documents out to files, and each task codes its documents block by block.
A file is Parquet whose rows are blocks: the coded stream as one binary value beside an index (which
documents, how many ids each), checkpoints and checksums. Spark's committer publishes the files, so
lost executors leave no half-written ones, and any storage that Spark reads will do.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm import rans
from tripflow.llm.text import bounded_batches, table, whole
from tripflow.session import scratch_path, stage

END_ID = 2
BLOCK_IDS = 1 << 20
CACHED_WORDS = 1_000_000
SLICE_BYTES = 4 << 20
RUN = 10_000
CACHED_BYTES = 64 << 20

BLOCKS = (
    "part int, block int, first long, keys array<long>, lengths array<long>, n_ids long, lanes int, "
    "steps array<int>, places array<long>, states binary, payload binary, payload_crc long, ids_crc long"
)


# A plain word of Latin letters, and marks that always start a piece of their own after a letter and
# that no special token ends with. U+0130 is left out: its lower case is a letter and a combining mark.
LETTERS = r"a-zA-Z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}"
PLAIN = rf"^(?P<word>[{LETTERS}]+)(?P<tail>[.,;:!?*&%$#()\[\]{{}}/=+-]*)$"


class Known:
    """Strings with their ids; item 0 is the empty string."""

    def __init__(self, width: str, limit: int = CACHED_WORDS):
        self.limit = limit
        self.items = pa.array([""])
        self.ids = np.zeros(0, dtype=width)
        self.lengths = np.zeros(1, dtype=np.int64)

    def full(self) -> bool:
        return len(self.items) > self.limit or self.items.nbytes > CACHED_BYTES

    def places(self, wanted: pa.Array, encode) -> np.ndarray:
        """Where the strings are in ``items``, which learns those it lacks."""
        at = pc.index_in(wanted, value_set=self.items)
        missing = at.is_null()
        found = at.fill_null(0).to_numpy().astype(np.int64)
        if at.null_count:
            coded = wanted.filter(missing).dictionary_encode()
            new = coded.dictionary
            # In runs: the library's own result takes many times the memory of its ids.
            learned = [encode(new.slice(k, RUN).to_pylist()) for k in range(0, len(new), RUN)]
            found[missing.to_numpy(zero_copy_only=False)] = len(self.items) + coded.indices.to_numpy()
            self.items = pa.concat_arrays([self.items, new])
            self.ids = np.concatenate([self.ids, *(ids for ids, _ in learned)])
            self.lengths = np.concatenate([self.lengths, *(lengths for _, lengths in learned)])
        return found


class Encoder:
    """Ids of texts. A text is cut at spaces and line feeds, which the tokenizer drops and never merges
    over. Of the different cuts of a batch, plain words are told from the marks that close them; words
    seen before come from memory, new ones are encoded in one call, and numpy puts the texts together."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.width = "<u2" if size < 1 << 16 else "<u4"
        pieces = (self.tokenizer.id_to_token(k) or "" for k in range(size))
        self.closes = np.array([piece.endswith("</w>") for piece in pieces])
        self.forget()

    def forget(self) -> None:
        self.words, self.rest = Known(self.width, CACHED_WORDS), Known(self.width, CACHED_WORDS)

    def each(self, items: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [one.ids for one in self.tokenizer.encode_batch_fast(items, add_special_tokens=False)]
        ids = np.fromiter((k for one in found for k in one), dtype=self.width)
        return ids, np.array([len(one) for one in found], dtype=np.int64)

    def plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For words of letters alone: each ends with the piece that closes it."""
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, dtype=self.width)
        ends = np.flatnonzero(self.closes[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(words) else self.each(words)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text ends."""
        if self.words.full() or self.rest.full():
            self.forget()
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        cuts = coded.dictionary
        parts = pc.extract_regex(cuts, PLAIN)
        plain = parts.is_valid()
        word, tail = (pc.struct_field(parts.filter(plain), name) for name in ("word", "tail"))
        word = pc.if_else(pc.string_is_ascii(word), pc.ascii_lower(word), word)
        tails = tail.dictionary_encode()
        is_plain = plain.to_numpy(zero_copy_only=False)
        pair = np.zeros((len(cuts), 2), dtype=np.int64)  # of a word and its tail, counting ``rest`` on
        pair[is_plain, 0] = self.words.places(word, self.plain)
        shared = len(self.words.items)
        pair[is_plain, 1] = shared + self.rest.places(tails.dictionary, self.each)[tails.indices.to_numpy()]
        pair[~is_plain, 0] = shared + self.rest.places(cuts.filter(pc.invert(plain)), self.each)
        both = self.words, self.rest
        own_ids, own_lengths = (np.concatenate([getattr(each, name) for each in both]) for name in ("ids", "lengths"))
        used = pair[coded.indices.to_numpy()].ravel()
        lengths = own_lengths[used]
        ends = np.cumsum(lengths)
        shift = (np.cumsum(own_lengths) - own_lengths)[used] - (ends - lengths)
        ids = own_ids[np.repeat(shift, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[2 * (lists.offsets.to_numpy() - lists.offsets[0].as_py())]
        return ids, bounds[1:]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process, which Spark uses for many tasks."""
    return Encoder(path)


def slices(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Parts of about SLICE_BYTES, so that a batch of long texts takes no more memory than others."""
    number = np.cumsum(sizes) // SLICE_BYTES
    starts = np.flatnonzero(np.diff(number, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(sizes)], strict=True):
        yield batch.slice(start, end - start)


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """``key`` and ``ids``, the ids of the whole text and ``end_id`` as bytes; NULL counts as empty."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        end = np.array([end_id], dtype=coder.width).tobytes()
        for batch in batches:
            for part in slices(batch, pc.binary_length(batch.column(1)).to_numpy()):
                ids, bounds = coder.encode(part.column(1))
                data, bounds = ids.tobytes(), (bounds * ids.itemsize).tolist()
                texts = [data[a:b] + end for a, b in zip([0, *bounds[:-1]], bounds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.binary())], names=["key", "ids"])

    named = docs.select(F.col(key).cast("long").alias("key"), whole(F.col(text)).alias("text"))
    return named.mapInArrow(encoded, "key long, ids binary")


def frequency_table(ids: DataFrame, width: str) -> np.ndarray:
    """Scaled frequencies of all ids; the driver gets one row per id of the vocabulary."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                values = b"".join(batch.column(0).slice(at, 500).to_pylist())
                own = np.bincount(np.frombuffer(values, dtype=width), minlength=len(counts))
                own[: len(counts)] += counts
                counts = own
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["id", "n"])

    rows = ids.select("ids").mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((row["id"] for row in rows), default=-1) + 1, dtype=np.int64)
    for row in rows:
        counts[row["id"]] = row["n"]
    return rans.scaled(counts) if rows else counts


def write_tokens(docs: DataFrame, out: str, path: str, key: str = "doc_id", text: str = "text",
                 end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Encodes all documents into ``out``: folder ``blocks`` and folder ``table``.

    A block closes with the document that fills it, so a document lies in one block. Rows with equal
    or NULL keys (these come first) are separate documents. An empty table writes empty folders.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    ids = stage(encode_documents(docs, path, key, text, end_id), "token-ids")
    width = encoder(path).width
    freq = frequency_table(ids, width)
    spark.createDataFrame(
        pa.table({"id": pa.array(np.arange(len(freq))), "freq": pa.array(freq, pa.int64())})
    ).coalesce(1).write.mode("overwrite").parquet(f"{out}/table")
    names = [field.split()[0] for field in BLOCKS.split(", ")]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = rans.Table.of(freq) if len(freq) else None
        keys, held, waiting, first, number, part = [], [], 0, 0, 0, 0

        def close() -> pa.RecordBatch:
            block = rans.encode(np.frombuffer(b"".join(held), dtype=width), shared)
            lengths = [len(each) // np.dtype(width).itemsize for each in held]
            row = [part, number, first, keys, lengths, block.n_ids, block.lanes, block.steps, block.places,
                   block.states, block.payload, block.payload_crc, block.ids_crc]
            columns = [pa.array([value], kind) for value, kind in zip(row, ARROW, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for own_key, own_ids, part in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                keys.append(own_key)
                held.append(own_ids)
                waiting += len(own_ids) // np.dtype(width).itemsize
                if waiting >= block_ids:
                    yield close()
                    keys, held, first, number, waiting = [], [], first + waiting, number + 1, 0
        if held:
            yield close()

    (
        ids.withColumn("tie", F.xxhash64("ids"))
        .repartitionByRange("key", "tie")  # the driver sees a sample of these, not of the ids
        .sortWithinPartitions("key", "tie", "ids")
        .drop("tie")
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(coded, BLOCKS)
        .write.mode("overwrite").parquet(f"{out}/blocks")
    )


ARROW = [
    pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int32(),
    pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64(), pa.int64(),
]


def span(block: rans.Block, shared: rans.Table, start: int, end: int) -> np.ndarray:
    """Ids ``start`` to ``end`` of a block, decoded from the last checkpoint before them to the first behind."""
    firsts = np.array(block.steps, dtype=np.int64) * block.lanes
    mark = int(np.searchsorted(firsts, start, "right")) - 1
    until = int(np.searchsorted(firsts, end))
    ids = rans.decode(block, shared, mark, until if until < len(firsts) else None)
    return ids[start - int(firsts[mark]) : end - int(firsts[mark])]


def read_tokens(spark: SparkSession, out: str, keys: Sequence[int] | None = None) -> DataFrame:
    """``key``, ``start`` and ``ids`` (32 bits each, little-endian) of every document in the files, or of the
    documents with some keys.

    Blocks are decoded independently; a block that does not match its checksums is an error. For some keys
    only blocks that list one are read, and these from the checkpoints around each document; the payload's
    checksum is held against all of it. A very long document is one block, whose ids one task holds.
    """
    blocks = spark.read.schema(BLOCKS).parquet(f"{out}/blocks")
    all_blocks, wanted = blocks, None if keys is None else set(keys)
    if keys is not None:
        blocks = blocks.filter(F.arrays_overlap("keys", F.array(*map(F.lit, wanted)).cast("array<long>")))
    freq = np.zeros(0, dtype=np.int64)
    rows = spark.read.schema("id long, freq long").parquet(f"{out}/table").collect()  # one per id of the vocabulary
    if rows:
        freq = np.zeros(len(rows), dtype=np.int64)
        for row in rows:
            freq[row["id"]] = row["freq"]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = rans.Table.of(freq) if len(freq) else None
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(k)[at].as_py() for k, name in enumerate(batch.schema.names)}
                block = rans.Block(**{name: row[name] for name in rans.Block.__dataclass_fields__})
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                if wanted is None:
                    data = memoryview(rans.decode_checked(block, shared).astype("<u4").tobytes())
                    cut = [bytes(data[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)]
                else:
                    rans.check_payload(block)
                    held = [k for k, key in enumerate(row["keys"]) if key in wanted]
                    starts, ends, row["keys"] = starts[held], ends[held], [row["keys"][k] for k in held]
                    cut = [span(block, shared, int(a), int(b)).astype("<u4").tobytes() for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(cut), pa.int32()),
                        pa.array(row["keys"], pa.int64()),
                        pa.array(starts + row["first"], pa.int64()),
                        pa.array(cut, pa.binary()),
                    ],
                    names=["part", "key", "local", "ids"],
                )

    # One row per file.
    parts = all_blocks.groupBy("part").agg(F.sum("n_ids").alias("held"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    rows = blocks.mapInArrow(decoded, "part int, key long, local long, ids binary")
    return rows.join(F.broadcast(parts), "part").select(
        "key", (F.col("before") + F.col("local")).alias("start"), "ids"
    )


def op4_token_files(spark, sf_dir: str, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    out = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), out, public_tokenizers.path(tokenizer))
    return read_tokens(spark, out).select(
        F.col("key").alias("doc_id"),
        "start",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
