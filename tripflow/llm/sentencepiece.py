"""SentencePiece encoding and decoding by a max-plus parallel scan.

A text is the sequence of pieces with the highest total score (the unigram criterion). Scores are
whole numbers, so additions are exact and any order of combining gives the same result; of equal
scores the path whose last piece is longest wins, as in the sentencepiece library. The public
vocabulary at hand was made by merging and has merge ranks in place of log probabilities; under
``zipf_scores`` a piece of rank r gets ln(1 / r), scaled, which is what ranks say about frequencies.

Texts up to ``chunk_chars`` are encoded where they are. Longer ones are split into chunks that tasks
work on independently:

1. Each chunk becomes a matrix. Its rows are the nodes a path may have last visited before the chunk
   (a piece may reach over the boundary, so there are as many as the longest piece has characters),
   its columns the same at the chunk's end, its entries the best score from one to the other.
2. Matrices combine associatively in the max-plus algebra: products of blocks of chunks, a scan over the
   blocks, then a scan within each block give the scores at every boundary.
3. With these each chunk tells, for every node at its end, the node before it; composing these maps
   from the end of the text gives the boundaries' nodes, and each chunk backtraces on its own.

Between places that no piece can span (here: before a word) the best path does not depend on what
is around it, so paths of such stretches are kept and reused.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.text import bounded_batches, packed, table, whole
from tripflow.llm.token_files import Known, slices
from tripflow.session import stage

SPACE = "▁"
CHUNK = 1 << 16
BLOCK = 64
CACHED = 200_000
TOGETHER = 64  # chunks whose stretches are solved in one go
CACHED_CHARS = 64
KNOWN = 400_000
SHORT = 24
WHOLE = "(?s:.+)"
NEVER = -(10**15)
SCALE = 64
PENALTY = 10 * SCALE  # fixed value: an unknown character scores this below the worst piece


def zipf_scores(count: int) -> list[int]:
    """Scores of ranks 1 to ``count``."""
    total = math.log(sum(1 / rank for rank in range(1, count + 1)))
    return [-round(SCALE * (math.log(rank) + total)) for rank in range(1, count + 1)]


def spread(codes: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Hashes of strings with one more character."""
    mixed = (codes + points + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


class Index:
    """Pieces by hash: a table of slots, and a second one for those that find theirs taken."""

    def __init__(self, pieces: list[str], ids: list[int], scores: list[int]):
        keys = np.zeros(len(pieces), dtype=np.uint64)
        for k, piece in enumerate(pieces):
            code = np.zeros(1, dtype=np.uint64)
            for point in map(ord, piece):
                code = spread(code, np.array([point], dtype=np.uint64))
            keys[k] = code[0]
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces have the same hash")
        # Number 0 is no piece.
        self.keys = np.concatenate([np.zeros(1, dtype=np.uint64), keys])
        self.ids = np.array([0, *ids], dtype=np.int32)
        self.scores = np.array([NEVER, *scores], dtype=np.int64)
        self.tables = []
        left = np.arange(1, len(self.keys))
        for bits, shift in ((20, 0), (16, 20), (16, 36)):
            slots = self.slots(self.keys[left], bits, shift)
            _, first = np.unique(slots, return_index=True)
            table = np.zeros(1 << bits, dtype=np.int32)
            table[slots[first]] = left[first]
            self.tables.append((table, bits, shift))
            left = np.delete(left, first)
            if not len(left):
                break
        if len(left):
            raise ValueError("the tables are too small for the pieces")

    @staticmethod
    def slots(keys: np.ndarray, bits: int, shift: int) -> np.ndarray:
        return ((keys >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        found = np.zeros(keys.shape, dtype=np.int32)
        for table, bits, shift in self.tables:
            number = table[self.slots(keys, bits, shift)]
            found = np.where(self.keys[number] == keys, number, found)
        return found


class Unigram:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        normal = [k for k in ids if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
        scores = zipf_scores(len(normal))
        self.pieces = {model.id_to_piece(k): (k, score) for k, score in zip(normal, scores, strict=True)}
        # Scores of pieces (not above 0), None for what only starts one.
        self.table: dict[str, int | None] = {piece[:k]: None for piece in self.pieces for k in range(1, len(piece))}
        self.table.update((piece, score) for piece, (_, score) in self.pieces.items())
        self.byte_ids = {int(model.id_to_piece(k)[1:-1], 16): k for k in ids if model.is_byte(k)}
        self.unknown = min(scores) - PENALTY
        self.reach = max(map(len, self.pieces))
        self.raw = [model.id_to_piece(k).encode() for k in ids]
        for value, k in self.byte_ids.items():
            self.raw[k] = bytes([value])
        for k in ids:
            if model.is_control(k) or model.is_unknown(k):
                self.raw[k] = b""
        self.pieces_as = np.array(self.raw, dtype=object)
        self.stretch = re.compile(self.stretches())
        self.parted_at_spaces = self.stretch.pattern != WHOLE
        self.index = Index(list(self.pieces), [k for k, _ in self.pieces.values()], scores)
        self.words = Known("<i4", KNOWN)
        self.known: dict[str, bytes] = {}
        self.scores: dict[str, int] = {}

    def stretches(self) -> str:
        """A pattern that cuts only between characters that no piece has side by side."""
        pairs = {piece[k : k + 2] for piece in self.pieces for k in range(len(piece) - 1)}
        if any(pair[1] == SPACE != pair[0] or "\n" in pair for pair in pairs):
            return WHOLE
        after_letters = {pair[1] for pair in pairs if pair[0].isalpha()}
        closing = "".join(mark for mark in ".,;:!?*&%$#" if mark not in after_letters)
        word = f"{SPACE}*[a-zA-Z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+(?=[{closing}])|" if closing else ""
        return f"\n|{word}{SPACE}*[^{SPACE}\n]+|{SPACE}+"

    def walk(self, text: str, values: list[int], start: int) -> tuple[list[int], list[int]]:
        """Best scores of all nodes, and the node before each. ``values`` holds the nodes up to ``start``."""
        table, end = self.table, len(text)
        best = values + [NEVER] * (end - start)
        back = [-1] * (end + 1)
        for node in range(max(0, start - self.reach + 1), end):
            score = best[node]
            if score == NEVER:
                continue
            single = node < start
            for to in range(node + 1, end + 1):
                found = table.get(text[node:to], 1)
                if found == 1:  # no piece starts like this
                    break
                if found is not None and to > start:
                    single = single or to == node + 1
                    if score + found > best[to]:
                        best[to], back[to] = score + found, node
            if not single and score + self.unknown > best[node + 1]:
                best[node + 1], back[node + 1] = score + self.unknown, node
        return best, back

    def path(self, text: str, back: list[int], node: int, start: int) -> tuple[bytes, int]:
        """Ids of the path into ``node``, and the node up to ``start`` it came from."""
        ids: list[int] = []
        while node > start:
            piece = text[back[node] : node]
            found = self.pieces.get(piece)
            ids.extend([found[0]] if found else [self.byte_ids[value] for value in reversed(piece.encode())])
            node = back[node]
        ids.reverse()
        return array("i", ids).tobytes(), node

    def solve_short(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, numbers of ids and scores of texts of one length, given as rows of code points.

        The lattices of all rows are walked in step. A number of ids is -1 where a character is
        unknown, which ``path`` spells in bytes.
        """
        rows, length = texts.shape
        codes = np.zeros((rows, length), dtype=np.uint64)
        scores, pieces = [], []
        for size in range(1, min(length, self.reach) + 1):
            codes = spread(codes[:, : length - size + 1], texts[:, size - 1 :])
            found = self.index.find(codes)
            pieces.append(self.index.ids[found])
            scores.append(self.index.scores[found])
        unknown = scores[0] == NEVER
        scores[0] = np.where(unknown, self.unknown, scores[0])
        best = np.full((rows, length + 1), NEVER, dtype=np.int64)
        best[:, 0] = 0
        back = np.zeros((rows, length + 1), dtype=np.int8)
        for to in range(1, length + 1):
            for size in range(min(to, self.reach), 0, -1):
                score = best[:, to - size] + scores[size - 1][:, to - size]
                better = score > best[:, to]
                best[better, to] = score[better]
                back[better, to] = size
        ids = np.zeros((rows, length), dtype=np.int32)
        counts = np.zeros(rows, dtype=np.int64)
        spelled = np.zeros(rows, dtype=bool)
        live, place = np.arange(rows), np.full(rows, length)
        while len(live):
            size = back[live, place].astype(np.int64)
            place = place - size
            for one in np.unique(size):
                same = size == one
                ids[live[same], length - 1 - counts[live[same]]] = pieces[one - 1][live[same], place[same]]
            spelled[live] |= (size == 1) & unknown[live, place]
            counts[live] += 1
            live, place = live[place > 0], place[place > 0]
        used = np.arange(length) >= (length - counts)[:, None]
        return ids[used & ~spelled[:, None]], np.where(spelled, -1, counts), best[:, -1]

    def solve_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, numbers of ids, scores."""
        lengths = np.array([len(each) for each in texts])
        points = np.frombuffer("".join(texts).encode("utf-32-le", errors="surrogatepass"), dtype=np.uint32)
        starts = np.cumsum(lengths) - lengths
        parts: list = [np.zeros(0, dtype=np.int32)] * len(texts)
        scores = np.zeros(len(texts), dtype=np.int64)
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            for at in range(0, len(rows), 5_000):
                own = rows[at : at + 5_000]
                if length > SHORT:
                    for k in own:
                        values, back = self.walk(texts[k], [0], 0)
                        parts[k] = np.frombuffer(self.path(texts[k], back, len(texts[k]), 0)[0], dtype=np.int32)
                        scores[k] = values[-1]
                elif length:
                    ids, counts, scores[own] = self.solve_short(points[starts[own, None] + np.arange(length)])
                    ends = np.cumsum(np.maximum(counts, 0))
                    for k, n, end in zip(own.tolist(), counts.tolist(), ends.tolist(), strict=True):
                        if n < 0:
                            _, back = self.walk(texts[k], [0], 0)
                            parts[k] = np.frombuffer(self.path(texts[k], back, length, 0)[0], dtype=np.int32)
                        else:
                            parts[k] = ids[end - n : end]
        ids = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
        return ids, np.array([len(each) for each in parts], dtype=np.int64), scores

    def learn(self, stretches: set[str]) -> None:
        """Ids and scores of stretches, kept for the next time."""
        texts = list(stretches)
        ids, counts, scores = self.solve_all(texts)
        data, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
        starts = [0, *ends][:-1]
        self.known.update((each, data[a:b]) for each, a, b in zip(texts, starts, ends, strict=True))
        self.scores.update(zip(texts, scores.tolist(), strict=True))

    def forget_long(self, stretches: set[str]) -> None:
        for each in stretches:
            if len(each) > CACHED_CHARS:
                del self.known[each], self.scores[each]

    def parted(self, texts: list[str]) -> tuple[list[list[str]], set[str]]:
        """The stretches of texts, and those that were not known; all of them are now."""
        lists = [self.stretch.findall(text) for text in texts]
        wanted = set().union(*lists)
        new = wanted.difference(self.known)
        if len(self.known) + len(new) > CACHED:
            self.known, self.scores, new = {}, {}, wanted
        self.learn(new)
        return lists, new

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, 32 bits each, by their stretches."""
        lists, new = self.parted([SPACE + text.replace(" ", SPACE) if text else "" for text in texts])
        found = [b"".join(map(self.known.__getitem__, each)) for each in lists]
        self.forget_long(new)
        return found

    def encode(self, text: str) -> bytes:
        return self.encode_texts([text])[0]

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text ends.

        Of texts without runs of spaces or marks the different words are looked up once; the others go by stretches.
        """
        if self.words.full():
            self.words = Known("<i4", KNOWN)
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        marked = pc.binary_join_element_wise(pa.scalar(SPACE), coded.dictionary, "")
        places = self.words.places(marked, lambda words: self.solve_all(words)[:2])
        used = places[coded.indices.to_numpy()]
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        odd = np.ones(len(texts), dtype=bool)
        if self.parted_at_spaces:
            odd = pc.match_substring_regex(texts, f"^ |  |{SPACE}").to_numpy(zero_copy_only=False)
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
        used[(odd | empty)[owner]] = 0
        lengths = self.words.lengths[used]
        ends = np.cumsum(lengths)
        shift = (np.cumsum(self.words.lengths) - self.words.lengths)[used] - (ends - lengths)
        ids = self.words.ids[np.repeat(shift, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        ends = np.concatenate([[0], ends])[bounds]
        if not odd.any():
            return ids, ends[1:]
        rows = np.flatnonzero(odd)
        own = self.encode_texts(texts.take(pa.array(rows)).to_pylist())
        parts = [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        for row, data in zip(rows.tolist(), own, strict=True):
            parts[row] = np.frombuffer(data, dtype="<i4")
        return np.concatenate(parts), np.cumsum([len(each) for each in parts])

    def decode(self, ids: np.ndarray) -> str:
        joined = b"".join(self.pieces_as[ids].tolist()).decode(errors="replace")
        return joined.replace(SPACE, " ")[1:]

    def parts(self, text: str, start: int) -> tuple[int, int] | None:
        """A place after ``start`` that no piece spans, the first one, and the last before the end nodes."""
        last = len(text) - self.reach
        places = (found.start() for found in self.stretch.finditer(text, start))
        first = next((place for place in places if place > start), None)
        if first is None or first > last:
            return None
        near = max(first, text.rfind(SPACE, first, last))  # a stretch starts there or has run of marks
        while near > first and text[near - 1] == SPACE:
            near -= 1
        final = first
        for found in self.stretch.finditer(text, near):
            if found.start() > last:
                break
            final = found.start()
        return first, final

    def middle(self, text: str, first: int, last: int) -> tuple[bytes, int]:
        """Ids and score between two places that no piece spans."""
        lists, new = self.parted([text[first:last]])
        ids = b"".join(map(self.known.__getitem__, lists[0]))
        score = sum(map(self.scores.__getitem__, lists[0]))
        self.forget_long(new)
        return ids, score

    def matrix(self, text: str, start: int) -> np.ndarray:
        """Scores from the nodes up to ``start`` to the nodes at the end, by distance from either."""
        size = self.reach
        cut = self.parts(text, start)
        head = text[: cut[0]] if cut else text
        rows = np.full((size, size), NEVER, dtype=np.int64)
        if cut:
            _, between = self.middle(text, *cut)
            tail, _ = self.walk(text[cut[1] :], [0], 0)
        for behind in range(min(size, start + 1)):
            values = [NEVER] * (start + 1)
            values[start - behind] = 0
            scores, _ = self.walk(head, values, start)
            for left in range(size):
                if cut:
                    score = scores[-1] + between + tail[len(text) - cut[1] - left]
                else:
                    node = len(text) - left
                    score = scores[node] if node > start else NEVER
                rows[behind, left] = max(score, NEVER)
        return rows

    def solve(self, text: str, start: int, entry: np.ndarray) -> tuple:
        values = [NEVER] * (start + 1)
        for behind in range(min(len(entry), start + 1)):
            values[start - behind] = int(entry[behind])
        cut = self.parts(text, start)
        head = text[: cut[0]] if cut else text
        return cut, head, *self.walk(head, values, start)

    def exits(self, text: str, start: int, entry: np.ndarray) -> list[int]:
        """For every distance from the end, the distance from ``start`` its best path came from, or -1."""
        cut, head, scores, back = self.solve(text, start, entry)
        if cut:
            return [start - self.path(head, back, cut[0], start)[1]] * self.reach
        nodes = [len(text) - left for left in range(self.reach)]
        reached = [node > start and scores[node] > NEVER for node in nodes]
        return [
            start - self.path(text, back, node, start)[1] if found else -1
            for node, found in zip(nodes, reached, strict=True)
        ]

    def chunk_ids(self, text: str, start: int, entry: np.ndarray, left: int) -> bytes:
        """Ids between the boundaries' nodes; the path leaves ``left`` characters before the end."""
        cut, head, _, back = self.solve(text, start, entry)
        if not cut:
            return self.path(text, back, len(text) - left, start)[0]
        first, last = cut
        tail = text[last:]
        _, tail_back = self.walk(tail, [0], 0)
        ids, _ = self.middle(text, first, last)
        return self.path(head, back, first, start)[0] + ids + self.path(tail, tail_back, len(tail) - left, 0)[0]


@lru_cache(maxsize=2)
def unigram(path: str) -> Unigram:
    """One per worker process."""
    return Unigram(path)


def combined(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Max-plus product of matrices, or of a row and a matrix."""
    return np.maximum((one[..., :, None] + other).max(axis=-2), NEVER)


def as_array(data: bytes, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(data, dtype=np.int64).reshape(shape)


def boundary_scores(matrices: DataFrame, size: int) -> DataFrame:
    """``entry`` of every chunk: the scores of the nodes before it. Blocks first, then within blocks."""

    def product(block: pd.DataFrame) -> pd.DataFrame:
        rows = block.sort_values("chunk")
        total = as_array(rows["matrix"].iloc[0], (size, size))
        for data in rows["matrix"].iloc[1:]:
            total = combined(total, as_array(data, (size, size)))
        return pd.DataFrame({"at": rows["at"].iloc[:1], "block": rows["block"].iloc[:1], "matrix": [total.tobytes()]})

    def scan(rows: pd.DataFrame, by: str, row: np.ndarray) -> pd.DataFrame:
        rows = rows.sort_values(by)
        entries = []
        for data in rows["matrix"]:
            entries.append(row.tobytes())
            row = combined(row, as_array(data, (size, size)))
        return rows[["at", by]].assign(entry=entries)

    origin = np.array([0] + [NEVER] * (size - 1), dtype=np.int64)
    blocked = matrices.withColumn("block", F.floor(F.col("chunk") / BLOCK).cast("int"))
    products = blocked.groupBy("at", "block").applyInPandas(product, "at long, block int, matrix binary")
    starts = products.groupBy("at").applyInPandas(
        lambda rows: scan(rows, "block", origin), "at long, block int, entry binary"
    )
    within = lambda rows: scan(rows, "chunk", as_array(rows["first"].iloc[0], (size,)))
    return (
        blocked.join(starts.withColumnRenamed("entry", "first"), ["at", "block"])
        .groupBy("at", "block")
        .applyInPandas(within, "at long, chunk int, entry binary")
    )


def leaving_nodes(maps: DataFrame) -> DataFrame:
    """``left`` of every chunk: how far before its end the text's best path leaves it."""

    def composed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk", ascending=False)
        left, found = 0, []
        for exits in rows["exits"]:
            found.append(left)
            left = int(exits[left])
        return rows[["at", "chunk"]].assign(left=found)

    return maps.groupBy("at").applyInPandas(composed, "at long, chunk int, left int")


def per_chunk(chunks: DataFrame, path: str, work, kind: str, arrow: pa.DataType) -> DataFrame:
    """Adds what ``work(model, row)`` makes of each chunk, as column ``made``."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unigram(path)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                rows = batch.slice(at, TOGETHER).to_pylist()
                model.parted([row["text"] for row in rows])
                columns = [
                    pa.array([row["at"] for row in rows], pa.int64()),
                    pa.array([row["chunk"] for row in rows], pa.int32()),
                    pa.array([work(model, row) for row in rows], arrow),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["at", "chunk", "made"])

    return chunks.mapInArrow(made, f"at long, chunk int, made {kind}")


def encode_giants(giants: DataFrame, path: str, chunk_chars: int) -> DataFrame:
    """``at`` and ``ids`` of the long texts in ``at``, ``text``."""
    size = unigram(path).reach
    spaced = giants.select("at", F.concat(F.lit(SPACE), F.replace("text", F.lit(" "), F.lit(SPACE))).alias("text"))
    last = F.floor((F.length("text") - 1) / chunk_chars).cast("int")
    begin = F.col("chunk") * chunk_chars
    before = F.greatest(begin - (size - 1), F.lit(0))
    chunks = spaced.select("at", "text", F.explode(F.sequence(F.lit(0), last)).alias("chunk")).select(
        "at",
        "chunk",
        (begin - before).alias("start"),
        F.substring(F.col("text"), before + 1, begin - before + chunk_chars).alias("text"),
    )
    chunks = stage(chunks.repartition("at", "chunk"), "pieces-chunks")
    matrices = per_chunk(
        chunks, path, lambda model, row: model.matrix(row["text"], row["start"]).tobytes(), "binary", pa.binary()
    )
    matrices = stage(matrices.withColumnRenamed("made", "matrix"), "pieces-matrices")
    entries = stage(boundary_scores(matrices, size), "pieces-entries")
    entered = chunks.join(entries, ["at", "chunk"])
    entry = lambda row: np.frombuffer(row["entry"], dtype=np.int64)
    maps = per_chunk(
        entered, path, lambda model, row: model.exits(row["text"], row["start"], entry(row)), "array<int>", pa.list_(pa.int32())
    )
    lefts = leaving_nodes(maps.withColumnRenamed("made", "exits"))
    ids = per_chunk(
        entered.join(lefts, ["at", "chunk"]),
        path,
        lambda model, row: np.frombuffer(model.chunk_ids(row["text"], row["start"], entry(row), row["left"]), dtype="<i4"),
        "array<int>",
        pa.list_(pa.int32()),
    )
    ordered = F.array_sort(F.collect_list(F.struct("chunk", "made")))
    return ids.groupBy("at").agg(F.flatten(F.transform(ordered, lambda part: part["made"])).alias("ids"))


def encode(
    docs: DataFrame, path: str, text: str = "text", chunk_chars: int = CHUNK, decoded: bool = False
) -> DataFrame:
    """All rows as struct ``row`` with ``ids`` (array<int>) of the whole text, on request ``decoded`` again.

    NULL and empty texts have no ids. Characters outside the vocabulary become bytes. Rows are told
    apart by where they were read, so ids may be NULL or repeated; other columns travel in ``row``. An
    empty table gives no rows. ``chunk_chars`` is at least the length of the longest piece.
    """
    bounded_batches(docs.sparkSession)
    held = packed(docs)
    inside = F.col(f"row.`{text}`")
    long = F.length(whole(inside)) > chunk_chars
    added = [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    added += [T.StructField("decoded", T.StringType())] if decoded else []
    schema = T.StructType(held.schema.fields + added)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unigram(path)
        for batch in batches:
            sizes = pc.binary_length(batch.column(0).field(text)).fill_null(0).to_numpy()
            for part in slices(batch, sizes):
                ids, ends = model.encode_batch(pc.fill_null(part.column(0).field(text), ""))
                bounds = np.concatenate([[0], ends])
                columns = [part.column(0), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))]
                if decoded:
                    spans = zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
                    columns.append(pa.array([model.decode(ids[a:b]) for a, b in spans], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    short = held.filter(~long).mapInArrow(encoded, schema)
    giants = stage(held.filter(long).withColumn("at", F.monotonically_increasing_id()), "pieces-giants")
    if giants.isEmpty():
        return short
    ids = encode_giants(giants.select("at", inside.alias("text")), path, chunk_chars)
    long_rows = giants.join(ids, "at").select("row", "ids")
    return short.unionByName(decode(long_rows, path) if decoded else long_rows)


def decode(rows: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``; the space mark of the vocabulary comes back as a space."""
    schema = T.StructType(rows.schema.fields + [T.StructField("decoded", T.StringType())])
    place = rows.columns.index("ids")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unigram(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = part.column(place)
                ids, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
                texts = [model.decode(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(decoded, schema)


def encoded_documents(docs: DataFrame, tokenizer: str = "piece_bpe_32k.model", decoded: bool = False) -> DataFrame:
    return encode(docs, public_tokenizers.path(tokenizer), decoded=decoded)


def op1_sentencepiece(spark, sf_dir: str, tokenizer: str = "piece_bpe_32k.model") -> DataFrame:
    path = public_tokenizers.path(tokenizer)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = encode(docs, path, decoded=True)
    text = whole(F.col("row.text"))
    return rows.select(
        "row.doc_id",
        F.length(text).cast("long").alias("n_chars"),
        F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == text).alias("round_trip"),
    )
