"""Language model scores by a probabilistic suffix tree over words.

1. Counts of all words of the training texts. A context is a run of up to ``DEPTH`` words, and only a run
   that makes up at least ``P_MIN`` of all training tokens may be one, the threshold that the method
   sets. By that no length has more than 1 / ``P_MIN`` of them (a million), so their counts fit a
   broadcast at any size of corpus. Every run is extended by one word at a time: what is counted for
   length k + 1 are all occurrences whose first and last k words are frequent, over all training texts.
2. A context becomes a state of the tree when its next words diverge from those of its longest proper
   suffix: its occurrences times the Kullback-Leibler divergence must pay half a log of the corpus size per
   next word it would store. The suffixes of a state are states too.
3. A state's next-word distribution is its counts less ``DISCOUNT`` each; the mass so freed, with that of
   all words too rare to be stored, goes to the distribution of its suffix, down to the empty state, which
   has the smoothed frequency of every word. So every distribution sums to one.
4. A token is scored at the longest state that ends right before it. Words below ``P_MIN`` are looked
   up in the table of all counts by a join; the rest is found where the text is.

``fit`` and ``score`` do that with a tree that fits a broadcast. ``tree_scores`` is the whole tree, without
``P_MIN``: every run of ``LEAST`` occurrences may be a context, at any size of corpus. It holds no tree. Every token
is sent, with the ``DEPTH`` words before it, to the task of its last context word, where all contexts that end in
that word meet, each with its suffixes: they are counted, tested and used there. Words with more than
``BUCKET`` tokens after them are divided by the word before, and so on; what is then spread over tasks (how often a
word follows) is counted first, in an exchange by the run itself.

Words are told apart by 64-bit hashes (63 bits if not among the ``HEAD`` most frequent, where the whole tree is used),
longer runs by 64-bit hashes among those of one task.
"""

from __future__ import annotations

import gc
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.near_duplicates import LOWER, PIECE, mixed, word_hashes
from tripflow.llm.text import Stages, bounded_batches, table, whole
from tripflow.session import stage

DEPTH = 3
P_MIN = 1e-6
LEAST = 2  # occurrences of a run, in corpora below LEAST / P_MIN tokens
DISCOUNT = 0.75
ADDED = 0.1
END = np.uint64(1)
HELD = 3_000_000  # distinct keys that a task holds before it passes counts on
BUCKET = 500_000  # tokens after one context that a task takes at once, with about two times as many after others
CHUNK = 2_000_000  # tokens of texts that are sent at once, less than 1 << INDEX
PASSES = 3  # in which tokens are scored, a part of the contexts each, so that few lie on disk at once
TRIED = 8  # a part of so many of the buckets is searched first for states that make their suffixes states
HEAD = 500_000  # most frequent words at most, whose counts every task holds
PARTS = 8  # of a bucket, whose contexts are tested one after another
FEWER = 2  # what is counted first is a part of all tokens, and is dealt to so many times fewer tasks
INDEX = 22  # bits for a text's place in its chunk
SPACE = re.compile(rb"[\x20\x09-\x0D]")
LOW = (1 << 32) - 1


def pieces(data: bytes) -> Iterator[bytes]:
    """A long text in parts that end at white space."""
    at = 0
    while at < len(data):
        cut = SPACE.search(data, at + PIECE) if len(data) - at > PIECE else None
        end = cut.end() if cut else len(data)
        yield data[at:end]
        at = end


def tokens(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes of several texts, an end after each, and the number of tokens of each text."""
    def hashed(group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(group) == 1:
            parts = [word_hashes(part)[0] for part in pieces(group[0])]
            return np.concatenate([*parts, np.array([END])]), np.array([sum(map(len, parts)) + 1])
        words, starts = word_hashes(b" ".join(group))
        limits = np.cumsum([len(each) + 1 for each in group])
        cuts = np.searchsorted(starts, limits)
        return np.insert(words, cuts, END), np.diff(cuts, prepend=0) + 1

    held, size = [], 0
    for text in texts:
        data = text.encode(errors="surrogatepass").translate(LOWER)
        if held and size + len(data) > PIECE:
            yield hashed(held)
            held, size = [], 0
        held.append(data)
        size += len(data) + 1
    if held:
        yield hashed(held)


def places(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted key in the sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1, dtype=np.int64)
    found = np.searchsorted(keys, wanted)
    found[found == len(keys)] = 0
    return np.where(keys[found] == wanted, found, -1)


@dataclass(frozen=True)
class Runs:
    """The frequent runs of one length: for words their hashes, else the run without its last word, as a
    number of the shorter runs, and that word, in one key. Sorted; a run's number is its place."""

    keys: np.ndarray
    counts: np.ndarray


def numbers(levels: list[Runs], flat: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """For every length, the number of the frequent run that ends at each token, or -1."""
    words = places(levels[0].keys, flat)
    first = np.cumsum(lengths) - lengths
    found = [words]
    for level in levels[1:]:
        before = np.roll(found[-1], 1)
        before[first] = -1  # nothing reaches back into another text
        ok = np.flatnonzero((before >= 0) & (words >= 0) & (found[-1] >= 0))
        own = np.full(len(flat), -1, dtype=np.int64)
        own[ok] = places(level.keys, (before[ok] << 32) | words[ok])
        found.append(own)
    return found


@dataclass(frozen=True)
class Model:
    """``states`` tells for each run of up to DEPTH words whether it is a state, ``rest`` the mass it hands to
    its suffix, ``shares`` what a run of two words or more gets of the state before its last word."""

    levels: list[Runs]
    states: list[np.ndarray]
    rest: list[np.ndarray]
    shares: list[np.ndarray]
    tokens: int
    vocabulary: int
    threshold: int

    @staticmethod
    def of(levels: list[Runs], tokens: int, vocabulary: int, threshold: int) -> Model:
        states, rest, shares = [], [], []
        suffixes = [None]  # per length, the number of each run without its first word
        for k in range(1, len(levels)):
            longer = levels[k]
            last = longer.keys & LOW
            if k == 1:
                suffixes.append(last)
            else:
                suffixes.append(places(levels[k - 1].keys, (suffixes[k - 1][longer.keys >> 32] << 32) | last))
        for k in range(1, len(levels)):
            context, longer = levels[k - 1], levels[k]
            before = longer.keys >> 32
            n = context.counts.astype(float)
            p = longer.counts / n[before]
            parent_count = float(tokens) if k == 1 else levels[k - 2].counts[suffixes[k - 1][before]].astype(float)
            q = levels[k - 1].counts[suffixes[k]] / parent_count
            total = lambda values, n=len(n), before=before: np.bincount(before, values, n)
            p_rest, q_rest = (np.maximum(1 - total(each), 0) for each in (p, q))
            tiny = 1e-12
            divergence = total(p * np.log(p / q)) + p_rest * np.log((p_rest + tiny) / (q_rest + tiny))
            stored = np.bincount(before, minlength=len(n))
            states.append((stored > 0) & (n * divergence >= 0.5 * np.log(max(tokens, 2)) * stored))
            share = (longer.counts - DISCOUNT) / n[before]
            shares.append(share)
            rest.append(1 - total(share))
        for k in range(len(states) - 1, 0, -1):  # suffixes of states
            states[k - 1][suffixes[k][states[k]]] = True
        return Model(levels, states, rest, shares, tokens, vocabulary, threshold)

    @property
    def unit(self) -> float:
        return self.tokens + ADDED * (self.vocabulary + 1)

    def logs(self, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each token: its log10 in the empty state and at its longest state, and whether it is frequent.

        A word below the threshold counts as never seen here; what its count adds is the same for both.
        """
        found = numbers(self.levels, flat, lengths)
        words = found[0]
        known = words >= 0
        count = np.zeros(len(flat))
        count[known] = self.levels[0].counts[words[known]]
        empty = (count + ADDED) / self.unit
        p = empty.copy()
        first = np.cumsum(lengths) - lengths
        for k, state in enumerate(self.states):
            context = np.roll(found[k], 1)
            context[first] = -1
            at = np.flatnonzero(context >= 0)
            at = at[state[context[at]]]
            p[at] *= self.rest[k][context[at]]
            stored = at[found[k + 1][at] >= 0]
            p[stored] += self.shares[k][found[k + 1][stored]]
        return np.log10(empty), np.log10(p), known


class Counter:
    """Counts of 64-bit keys that pass by, summed up as they come."""

    def __init__(self) -> None:
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, counts = np.unique(keys, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        if self.size > HELD:
            self.merge()
            if self.size > HELD // 2:
                yield from self.rows()

    def merge(self) -> None:
        keys, place = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.bincount(place, np.concatenate(self.counts)).astype(np.int64)
        self.keys, self.counts, self.size = [keys], [counts], len(keys)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            self.merge()
            keys, counts = self.keys[0].astype(np.int64, copy=False), self.counts[0]
            for at in range(0, len(keys), 200_000):
                part = slice(at, at + 200_000)
                yield pa.RecordBatch.from_arrays([pa.array(keys[part]), pa.array(counts[part])], names=["key", "n"])
        self.__init__()


def batches_of(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, 250):
            part = batch.slice(at, 250)
            done = 0
            for flat, lengths in tokens(part.column(column).to_pylist()):
                yield part.slice(done, len(lengths)), flat, lengths
                done += len(lengths)


def counted(texts: DataFrame, levels: list[Runs]) -> DataFrame:
    """``key``, ``n``: all words, or all runs one word longer than ``levels`` whose both ends are frequent."""
    shared = texts.sparkSession.sparkContext.broadcast(levels)  # at most 1 / P_MIN runs of a length

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, known = Counter(), shared.value
        for _, flat, lengths in batches_of(batches, 0):
            if not known:
                yield from counter.add(flat.view(np.int64))
                continue
            found = numbers(known, flat, lengths)
            before = np.roll(found[-1], 1)
            before[np.cumsum(lengths) - lengths] = -1
            ok = (before >= 0) & (found[-1] >= 0)
            yield from counter.add((before[ok] << 32) | found[0][ok])
        yield from counter.rows()

    return texts.mapInArrow(made, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, threshold: int, words: bool) -> Runs:
    """At most 1 / P_MIN rows, or 1 / LEAST of the tokens of a small corpus."""
    rows = counts.filter(F.col("n") >= threshold).toArrow()
    keys, n = rows.column("key").to_numpy(), rows.column("n").to_numpy().astype(np.int64)
    keys = keys.view(np.uint64) if words else keys
    order = np.argsort(keys)
    return Runs(np.ascontiguousarray(keys[order]), n[order])


def fit(docs: DataFrame, text: str = "text", depth: int = DEPTH, p_min: float = P_MIN) -> tuple[Model, DataFrame]:
    """The tree of all texts, and the table of all words' counts (``key``, ``n``).

    NULL texts are empty and hold an end only. No rows give a model that finds every word equally likely.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(whole(F.col(text)).alias("text"))
    words = stage(counted(texts, []), "suffix-words")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("words")).first()
    threshold = max(LEAST, int(np.ceil(p_min * total["tokens"])))
    levels = [frequent(words, threshold, words=True)]
    for _ in range(depth):
        levels.append(frequent(counted(texts, levels), threshold, words=False))
    return Model.of(levels, total["tokens"], total["words"], threshold), words


LOCAL = "at long, id long, n_tokens long, n_known long, base double, score double, rare array<long>, times array<int>"


def local_scores(docs: DataFrame, model: Model, key: str, text: str) -> DataFrame:
    """A row per document: sums over its tokens with rare words as unseen ones, and its rare words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for part, flat, lengths in batches_of(batches, 1):
            empty, longest, known = shared.value.logs(flat, lengths)
            first = np.cumsum(lengths) - lengths
            sums = [np.add.reduceat(each, first) for each in (known.astype(np.int64), empty, longest)]
            rare, owner = flat[~known].view(np.int64), np.repeat(np.arange(len(lengths)), lengths)[~known]
            order = np.lexsort((rare, owner))
            rare, owner = rare[order], owner[order]
            fresh = np.ones(len(rare), dtype=bool)
            fresh[1:] = (rare[1:] != rare[:-1]) | (owner[1:] != owner[:-1])
            starts = np.flatnonzero(fresh)
            times = np.diff(starts, append=len(rare)).astype(np.int32)
            cuts = np.searchsorted(owner[starts], np.arange(len(lengths) + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(cuts, pa.array(each)) for each in (rare[starts], times)]
            ids = pa.array(np.arange(at, at + len(lengths)))
            at += len(lengths)
            columns = [ids, part.column(0), pa.array(lengths), *map(pa.array, sums), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=[field.split()[0] for field in LOCAL.split(", ")])

    rows = docs.select(F.col(key).cast("long").alias("id"), whole(F.col(text)).alias("text"))
    return rows.mapInArrow(made, LOCAL)


def score(docs: DataFrame, model: Model, words: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` (log10 of the text) of every row.

    Rows with one id, or none, are scored each for itself. NULL and empty texts are one end. A text is
    read in parts, so its length only adds to the numbers held, some tens of bytes a token.
    """
    bounded_batches(docs.sparkSession)
    local = stage(local_scores(docs, model, key, text), "suffix-local")
    rare = local.select("at", F.explode(F.arrays_zip("rare", "times")).alias("word"))
    rare = rare.select("at", F.col("word.rare").alias("key"), F.col("word.times").alias("times"))
    seen = words.filter(F.col("n") < model.threshold)
    gain = (F.log10(F.col("n") + F.lit(ADDED)) - F.log10(F.lit(ADDED))) * F.col("times")
    found = rare.join(seen, "key").groupBy("at").agg(F.sum("times").alias("more"), F.sum(gain).alias("gain"))
    both = local.drop("rare", "times").join(found, "at", "left").fillna(0, ["more", "gain"])
    return both.select(
        "id", "n_tokens", (F.col("n_known") + F.col("more")).alias("n_known"),
        (F.col("base") + F.col("gain")).alias("base_score"), (F.col("score") + F.col("gain")).alias("score"),
    )


# Rows between tasks: tokens to be counted after a hot context of ``kind`` words, or (PLACED + k) to be scored at contexts
# of k words and more; sums of texts; what is known of a chunk's texts; parts of the test of a hot context of
# (TESTED + k) words.
ROWS = "kind int, bucket long, chunk long, n long, data binary, stats array<double>"
PLACED, SUMS, RARE_SUMS, TEXTS, TESTED, HAS_STATE = 10, 20, 21, 22, 30, 40
TAIL, FAR, FIRST = np.uint64(1 << 63), np.uint64((1 << 32) - 1), np.uint64(44)


def rows_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.float64())]
    arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[field.split()[0] for field in ROWS.split(", ")])


def pressed(columns: list[np.ndarray], coded: int = 0) -> bytes:
    """Columns of one length as bytes, equal bytes of neighbouring values side by side. The first ``coded`` are codes of
    words, of which those of rare words stand at the end."""
    planes = lambda each: np.ascontiguousarray(each).view(np.uint8).reshape(len(each), -1).T.tobytes()
    raw = [planes(np.minimum(each, FAR).astype(np.uint32)) for each in columns[:coded]]
    raw += [planes(each) for each in columns[coded:]]
    raw += [each[each >= TAIL].tobytes() for each in columns[:coded]]
    raw = b"".join(raw)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def unpressed(data: bytes, n: int, kinds: list[str], coded: int = 0) -> list[np.ndarray]:
    raw = np.frombuffer(pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True), dtype=np.uint8)
    kinds, at, columns = ["u4"] * coded + kinds[coded:], 0, []
    for kind in kinds:
        end = at + n * np.dtype(kind).itemsize
        columns.append(np.array(raw[at:end].reshape(-1, n).T, order="C").view(kind).ravel())
        at = end
    rare = raw[at:].view(np.uint64) if at % 8 == 0 else np.frombuffer(raw[at:].tobytes(), dtype=np.uint64)
    for k in range(coded):
        columns[k] = columns[k].astype(np.uint64)
        far = np.flatnonzero(columns[k] == FAR)
        columns[k][far], rare = rare[: len(far)], rare[len(far) :]
    return columns


def named(*columns: np.ndarray) -> np.ndarray:
    key = np.zeros(len(columns[0]), dtype=np.uint64)
    for each in columns:
        key = mixed((key ^ each.astype(np.uint64)) + np.uint64(0x9E3779B97F4A7C15))
    return key


def grouped(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A member of each group of equal names, in the order of names, and the group of every member."""
    order = np.argsort(names)
    ordered = names[order]
    fresh = np.ones(len(names), dtype=bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    group = np.empty(len(names), dtype=np.int64)
    group[order] = np.cumsum(fresh) - 1
    return order[fresh], group


def head_least(words: DataFrame) -> int:
    """The least count of a word in the head, by numbers of words with about one count: a few hundred rows."""
    near = F.floor(F.log2("n") * 8).alias("near")
    bins = words.filter(F.col("n") >= LEAST).groupBy(near).agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("words"))
    least, held = 0, 0
    for row in sorted(bins.collect(), key=lambda row: -row["near"]):
        held += row["words"]
        if held > HEAD:
            return least or 1 << 62
        least = row["least"]
    return LEAST


@dataclass(frozen=True)
class Head:
    """The most frequent words: their hashes, sorted, and the code of each, its rank by count from 1. Frequent words have
    small codes, which take few bytes."""

    keys: np.ndarray
    codes: np.ndarray
    starts: np.ndarray  # of the keys that begin with the same bits

    @staticmethod
    def ranked(words: Runs) -> tuple[Head, np.ndarray]:
        """The head of these words, and their counts by code."""
        order = np.argsort(-words.counts, kind="stable")
        codes = np.empty(len(order), dtype=np.uint64)
        codes[order] = np.arange(1, len(order) + 1, dtype=np.uint64)
        starts = np.searchsorted(words.keys >> FIRST, np.arange((1 << 20) + 1, dtype=np.uint64))
        return Head(words.keys, codes, starts.astype(np.int32)), words.counts[order]

    def of(self, flat: np.ndarray) -> np.ndarray:
        first = (flat >> FIRST).astype(np.int64)
        place, end, codes = self.starts[first], self.starts[first + 1], flat | TAIL
        at = np.flatnonzero(place < end)
        while len(at):  # a few words at most begin with the same bits
            here = place[at]
            same = self.keys[here] == flat[at]
            codes[at[same]] = self.codes[here[same]]
            at = at[~same]
            place[at] += 1
            at = at[place[at] < end[at]]
        return codes


@dataclass(frozen=True)
class Hot:
    """What every task knows: counts of the most frequent words (``head``, by their codes; the code of another word is
    its hash with the top bit set; 0 is no word), runs of more than ``BUCKET`` tokens (``runs``, by their words' codes)
    and, once tested, whether those that are contexts are states, and what they hand on."""

    head: np.ndarray
    runs: list[Runs]
    tokens: int
    vocabulary: int
    threshold: int
    depth: int
    states: tuple = ()
    rest: tuple = ()

    def kinds(self, counts: int) -> list[str]:
        """Of a token: its word and those before it, its text (the place in its chunk as the last bits), whether it
        teaches, and how often it follows no word, one word and so on."""
        return ["u8"] * (self.depth + 1) + ["u8", "u1"] + ["u8"] * counts

    @property
    def unit(self) -> float:
        return self.tokens + ADDED * (self.vocabulary + 1)

    def learns(self, columns: list[np.ndarray]) -> np.ndarray:
        return columns[self.depth + 2].astype(float)

    def counts(self, columns: list[np.ndarray], k: int) -> np.ndarray:
        """How often the word follows k words, where that is known."""
        return columns[self.depth + 3 + k]

    def number(self, oldest_first: list[np.ndarray]) -> np.ndarray:
        """Numbers of hot runs, or -1."""
        if len(oldest_first) > len(self.runs):
            return np.full(len(oldest_first[0]), -1, dtype=np.int64)
        own = [places(self.runs[0].keys, each) for each in oldest_first]
        found = own[0]
        for level, last in zip(self.runs[1:], own[1:], strict=False):
            ok = (found >= 0) & (last >= 0)
            found = np.where(ok, places(level.keys, np.where(ok, found << 32 | last, -1)), -1)
        return found

    def context(self, columns: list[np.ndarray], k: int) -> np.ndarray:
        return self.number(columns[k:0:-1])

    def often(self, columns: list[np.ndarray], k: int) -> np.ndarray:
        """How often the word follows k words, -1 if no task knows that yet."""
        n = np.full(len(columns[0]), -1, dtype=np.int64)
        if k == 0:
            at = np.flatnonzero(columns[0] < TAIL)
            n[at] = self.head[columns[0][at].astype(np.int64) - 1]
        elif k < len(self.runs) and len(self.runs[k].keys):
            found = self.number(columns[k::-1])
            n = np.where(found >= 0, self.runs[k].counts[found], n)
        return n

    def tested(self, stats: list[np.ndarray]) -> Hot:
        """``stats``: of every hot context, sums over the words that follow it and are no hot run with it."""
        states, rest, suffixes = [], [], []
        for k, (level, sums) in enumerate(zip(self.runs, stats, strict=False), 1):
            last = level.keys & LOW
            suffixes.append(None if k == 1 else last if k == 2 else places(self.runs[k - 2].keys, (suffixes[k - 2][level.keys >> 32] << 32) | last))
            n = level.counts.astype(float)
            parent = float(self.tokens) if k == 1 else self.runs[k - 2].counts[suffixes[k - 1]].astype(float)
            if k < len(self.runs):
                longer = self.runs[k]
                before, end = longer.keys >> 32, longer.keys & LOW
                inner = end if k == 1 else places(level.keys, (suffixes[k - 1][before] << 32) | end)
                own, shorter = longer.counts.astype(float), level.counts[inner].astype(float)
                parts = (own, np.ones(len(own)), own * np.log(own / shorter), shorter)
                sums = sums + np.array([np.bincount(before, each, len(n)) for each in parts]).T
            total, stored, spread, outside = sums.T
            states.append(pays(n, parent, total, stored, spread, outside, self.tokens))
            rest.append(1 - (total - DISCOUNT * stored) / n)
        for k in range(len(states) - 1, 0, -1):  # suffixes of states
            states[k - 1][suffixes[k][states[k]]] = True
        return replace(self, states=tuple(states), rest=tuple(rest))

    def settled(self) -> bool:
        """Whether every hot context that stores a word is known to be a state. One that stores none has none beyond it."""
        return all((state | (rest >= 1)).all() for state, rest in zip(self.states, self.rest, strict=True))


def pays(n, parent, total, stored, spread, outside, tokens: int) -> np.ndarray:
    """The test of contexts: occurrences of each and of its suffix; over the words it stores the sums of their counts,
    of 1, of count * log(count / count after the suffix), and of their counts after the suffix."""
    tiny = 1e-12
    n = np.maximum(n, tiny)
    p_rest, q_rest = np.maximum(1 - total / n, 0), np.maximum(1 - outside / parent, 0)
    divergence = (spread + total * np.log(parent / n)) / n + p_rest * np.log((p_rest + tiny) / (q_rest + tiny))
    return (stored > 0) & (n * divergence >= 0.5 * np.log(max(tokens, 2)) * stored)


CHUNKS = "chunk long, ids array<long>, lengths array<int>, learns array<boolean>, codes binary"


def chunks_of(docs: DataFrame, head: Head) -> DataFrame:
    """Texts (``id``, ``learns``, ``text``) as codes, some million tokens a row."""
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, chunk = shared.value, TaskContext.get().partitionId() << INDEX
        held, size = [], 0
        names = [field.split()[0] for field in CHUNKS.split(", ")]

        def sent() -> pa.RecordBatch:
            ids, learns, lengths, codes = zip(*held, strict=True)
            lists = [sum((each.to_pylist() for each in ids), []), np.concatenate(lengths).tolist(), sum((each.to_pylist() for each in learns), [])]
            kinds = [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_())]
            arrays = [pa.array([chunk]), *[pa.array([each], kind) for each, kind in zip(lists, kinds, strict=True)]]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([pressed([np.concatenate(codes)])], pa.binary())], names=names)

        for part, flat, lengths in batches_of(batches, 2):
            held.append((part.column(0), part.column(1), lengths, known.of(flat)))
            size += len(flat)
            if size >= CHUNK:
                yield sent()
                held, size, chunk = [], 0, chunk + 1
        if held:
            yield sent()

    return docs.select("id", "learns", "text").mapInArrow(made, CHUNKS)


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for chunk, ids, lengths, learns, data in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            lengths = np.array(lengths, dtype=np.int64)
            yield chunk, ids, lengths, np.array(learns, dtype=bool), unpressed(data, int(lengths.sum()), ["u8"])[0]


def hot_runs(chunks: DataFrame, hot: Hot) -> Hot:
    """Runs of more than ``BUCKET`` training tokens, word by word longer: at most tokens / ``BUCKET`` of each length."""
    least = max(BUCKET, hot.threshold, int(np.ceil(P_MIN * hot.tokens)))
    often = np.flatnonzero(hot.head > least)
    runs = [Runs((often + 1).astype(np.uint64), hot.head[often])]
    while len(runs) <= hot.depth and len(runs[-1].keys):
        shared = chunks.sparkSession.sparkContext.broadcast(runs)

        def made(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            counter = Counter()
            for _, _, lengths, learns, codes in opened(batches):
                found = numbers(shared.value, codes, lengths)
                before = np.roll(found[-1], 1)
                before[(np.cumsum(lengths) - lengths)[lengths > 0]] = -1
                ok = (before >= 0) & (found[-1] >= 0) & np.repeat(learns, lengths)
                yield from counter.add((before[ok] << 32) | found[0][ok])
            yield from counter.rows()

        counts = chunks.mapInArrow(made, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        runs.append(frequent(counts, least + 1, words=False))
    return replace(hot, runs=runs)


Take = Callable[[np.ndarray, int], np.ndarray]  # of the tokens at some places, a column as in ``Hot.kinds``


def dealt(take: Take, at: np.ndarray, place: np.ndarray, kind: int, hot: Hot, wanted: Wanted) -> Iterator[pa.RecordBatch]:
    """The tokens ``at`` these places, dealt to buckets."""
    buckets = wanted.buckets if kind >= PLACED else max(1, wanted.buckets // FEWER)
    bucket = place % np.uint64(buckets)
    if kind >= PLACED and wanted.passes > 1:
        own = np.flatnonzero(bucket % np.uint64(wanted.passes) == wanted.part)
        at, bucket = at[own], bucket[own]
    if not len(at):
        return
    bucket = bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    at, bucket = at[order], bucket[order]
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    columns = [take(at, each) for each in range(len(hot.kinds(kind % PLACED)))]
    rows = []
    for start, end in zip(starts, np.append(starts[1:], len(bucket)), strict=True):
        rows.append((kind, int(bucket[start]), -1, int(end - start), pressed([each[start:end] for each in columns], hot.depth + 1), None))
        if len(rows) == 500:
            yield rows_of(rows)
            rows = []
    if rows:
        yield rows_of(rows)


@dataclass(frozen=True)
class Wanted:
    """Which rows a pass over the tokens sends: those to be counted after ``k`` words, or with ``k`` None the placed
    ones, at contexts of ``least`` words and more, of a part of the buckets. What is counted is sent on whole."""

    buckets: int
    k: int | None = None
    part: int = 0
    passes: int = 1
    onward: bool = False
    least: int = 1

    def has(self, kind: int) -> bool:
        return self.onward or (kind >= PLACED + self.least if self.k is None else kind == self.k)


def routed(take: Take, at: np.ndarray, hot: Hot, k: int, wanted: Wanted, counted: bool = False) -> Iterator[pa.RecordBatch]:
    """The tokens ``at`` these places on their way: to the task that counts them after k words (unless ``counted``), or on
    to longer contexts until one is not hot."""
    of = lambda at, *wanted: [take(at, each) for each in wanted]
    while len(at):
        if k:
            open_ = np.zeros(len(at), dtype=bool)
            if k <= hot.depth:
                open_ = hot.number(of(at, *range(k, 0, -1))) >= 0
            if wanted.has(PLACED + k) and not open_.all():
                closed = at[~open_]
                if k > hot.depth:
                    place = named(*of(closed, hot.depth + 1))
                else:
                    before = of(closed, *range(1, k + 1))
                    place = named(*before)
                    none = np.flatnonzero(before[-1] == 0)  # where no context needs its tokens together
                    place[none] = named(*of(closed[none], hot.depth + 1))
                yield from dealt(take, closed, place, PLACED + k, hot, wanted)
            at = at[open_]
        if not counted and len(at):
            away = hot.often(of(at, *range(k + 1)), k) < 0
            if wanted.has(k) and away.any():
                yield from dealt(take, at[away], named(*of(at[away], *range(k + 1))), k, hot, wanted)
            at = at[~away]
        if k == wanted.k and not wanted.onward:
            return
        k, counted = k + 1, False


def tokens_of(chunks: DataFrame, shared: Broadcast, wanted: Wanted) -> DataFrame:
    """The tokens of all texts (``ROWS``), as far as they are wanted and no rare word comes in between."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for chunk, _, lengths, learns, codes in opened(batches):
            texts = np.repeat(np.uint64(chunk << INDEX) + np.arange(len(lengths), dtype=np.uint64), lengths)
            taught = np.repeat(learns, lengths).astype(np.uint8)

            def take(at: np.ndarray, column: int, codes=codes, texts=texts, taught=taught) -> np.ndarray:
                if 0 < column <= known.depth:  # nothing reaches back into another text
                    before = at - column
                    return np.where((before >= 0) & (texts[before] == texts[at]), codes[before], np.uint64(0))
                own = {0: codes, known.depth + 1: texts, known.depth + 2: taught}
                return own[column][at] if column in own else np.zeros(len(at), dtype=np.uint64)

            yield from routed(take, np.flatnonzero((codes >= TAIL) == (wanted.k == 0)), known, 0, wanted)

    return chunks.mapInArrow(made, ROWS)


def texts_of(chunks: DataFrame, shared: Broadcast) -> DataFrame:
    """Of the texts of each chunk: tokens, those that are no rare words and the sum of their base, and the ids."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for chunk, ids, lengths, _, codes in opened(batches):
            n, first = known.often([codes], 0), np.cumsum(lengths) - lengths
            base = np.add.reduceat(np.where(n >= 0, np.log10((np.maximum(n, 0) + ADDED) / known.unit), 0), first)
            seen = np.add.reduceat((n >= 0).astype(np.int64), first)
            keys = np.array([each or 0 for each in ids], dtype=np.int64)
            nulls = np.array([each is None for each in ids], dtype=np.uint8)
            yield rows_of([(TEXTS, -1, chunk, len(ids), pressed([lengths, seen, base, keys, nulls]), None)])

    return chunks.mapInArrow(made, ROWS)


def joined(table: pa.Table, hot: Hot, kind: int) -> list[np.ndarray]:
    """All tokens of a task's rows of a kind by text, an order that reruns share."""
    rows, at, counts = table.select(["n", "data"]), 0, kind % PLACED
    kinds = hot.kinds(counts)
    columns = [np.empty(pc.sum(table.column("n")).as_py(), dtype=each) for each in kinds]
    for batch in rows.to_batches(max_chunksize=100):
        for n, data in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            for column, part in zip(columns, unpressed(data, n, kinds, hot.depth + 1), strict=True):
                column[at : at + n] = part
            at += n
    order = np.argsort(columns[hot.depth + 1], kind="stable")
    for k in range(len(columns)):
        columns[k] = columns[k][order]
    for k in range(counts):  # counts that every task knows are not sent
        n = hot.often(columns, k)
        columns[hot.depth + 3 + k] = np.where(n >= 0, n, columns[hot.depth + 3 + k].astype(np.int64)).astype(np.uint64)
    return columns


def sums_of(texts: np.ndarray, *values: np.ndarray) -> list[pa.RecordBatch]:
    """Sums of every text, a row per chunk."""
    texts, place = np.unique(texts, return_inverse=True)
    sums = [np.bincount(place, each) for each in values]
    chunk = (texts >> np.uint64(INDEX)).astype(np.int64)
    inside = (texts & np.uint64((1 << INDEX) - 1)).astype(np.uint32)
    starts = np.flatnonzero(np.diff(chunk, prepend=-1))
    rows = []
    for start, end in zip(starts, np.append(starts[1:], len(texts)), strict=True):
        data = pressed([each[start:end] for each in (inside, *sums)])
        rows.append((SUMS + len(values) // 3, -1, int(chunk[start]), int(end - start), data, None))
    return [rows_of(rows)]


def counted_after(rows: DataFrame, shared: Broadcast, k: int, wanted: Wanted) -> DataFrame:
    """Tokens with the count of their word after k words, sent on; parts of the test of those k words."""

    def made(table: pa.Table) -> pa.Table:
        known = shared.value
        columns = joined(table, known, k)
        at, run = grouped(named(*columns[: k + 1]))
        n = np.bincount(run, known.learns(columns))
        columns.append(n[run].astype(np.uint64))
        columns += [np.zeros(len(run), dtype=np.uint64) for _ in known.runs[k + 1 :]]
        found = list(routed(lambda at, column: columns[column][at], np.arange(len(run)), known, k, replace(wanted, onward=True), counted=True))
        if k == 0:  # what rare words add to the sums of their texts
            rate = np.log10((n[run] + ADDED) / known.unit)
            found += sums_of(columns[known.depth + 1], n[run] > 0, rate, np.zeros(len(run)))
        else:
            stored = n >= known.threshold
            first = at[stored]
            own, shorter = n[stored], known.counts(columns, k - 1)[first].astype(float)
            context = known.context([each[first] for each in columns], k)
            contexts, place = np.unique(context, return_inverse=True)
            sums = [np.bincount(place, each) for each in (own, np.ones(len(own)), own * np.log(own / shorter), shorter)]
            stats = [(TESTED + k, int(each), -1, 0, None, list(map(float, row))) for each, *row in zip(contexts, *sums, strict=True)]
            found += [rows_of(stats)] if stats else []
        return pa.Table.from_batches(found)

    return rows.filter(F.col("kind") == k).groupBy("bucket").applyInArrow(made, ROWS)


def grown(columns: list[np.ndarray], hot: Hot, k: int) -> tuple[list[tuple], list[np.ndarray]]:
    """Contexts of k words and more, for all of which the columns have all tokens: of every length the tokens they hold,
    the context of each, what a stored word gets there (else 0) and what the context hands on, and which are states."""
    taught, levels, states = hot.learns(columns), [], []
    at = np.flatnonzero(columns[k] != 0) if k <= hot.depth else np.zeros(0, dtype=np.int64)
    shorter = hot.counts(columns, k - 1)[at].astype(float)
    if k == 1:
        parent = np.full(len(at), float(hot.tokens))
    elif k <= hot.depth:
        parent = hot.runs[k - 2].counts[hot.context([each[at] for each in columns], k - 1)].astype(float) if len(at) else np.zeros(0)
    name = named(*[each[at] for each in columns[1:k]]) if k > 1 else np.zeros(len(at), dtype=np.uint64)
    for length in range(k, hot.depth + 1):
        if not len(at):
            break
        name = named(name, columns[length][at])
        first, context = grouped(name)
        sample, run = grouped(named(context, columns[0][at]))
        n, own = np.bincount(context, taught[at]), np.bincount(run, taught[at])
        stored = own >= hot.threshold
        sample, own_stored = sample[stored], own[stored]
        after = shorter[sample]
        sums = [np.bincount(context[sample], each, len(n)) for each in (own_stored, np.ones(len(own_stored)), own_stored * np.log(own_stored / after), after)]
        states.append(pays(n, np.maximum(parent[first], 1e-12), *sums, hot.tokens))
        some = np.maximum(n, 1e-12)
        rest = 1 - (sums[0] - DISCOUNT * sums[1]) / some
        share = np.where(stored[run], own[run] - DISCOUNT, 0) / some[context]
        levels.append((at, context, share, rest))
        longer = (sums[1][context] > 0) & (columns[min(length + 1, hot.depth)][at] != 0)
        shorter, parent, name, at = own[run][longer], n[context][longer], name[longer], at[longer]
        levels[-1] += (longer,)
    for length in range(len(levels) - 1, 0, -1):  # suffixes of states
        shorter_context = levels[length - 1][1][levels[length - 1][4]]
        states[length - 1][shorter_context[states[length][levels[length][1]]]] = True
    return levels, states


def apart(columns: list[np.ndarray], hot: Hot, k: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """A bucket's tokens in parts that share no context of k words and more, and their places."""
    part = (named(*columns[1 : min(k, hot.depth) + 1]) >> np.uint64(32)) % np.uint64(PARTS)  # buckets follow the last bits
    for each in range(PARTS):
        at = np.flatnonzero(part == each)
        if len(at):
            yield at, [column[at] for column in columns]


def hot_with_states(rows: DataFrame, shared: Broadcast) -> Hot:
    """Hot contexts are states too where a longer context is one that is not hot."""
    hot = shared.value

    def made(table: pa.Table) -> pa.Table:
        known, found = shared.value, [rows_of([(HAS_STATE, -1, -1, 0, None, None)]).slice(0, 0)]
        for kind in set(table.column("kind").to_pylist()):
            tokens_, k = joined(table.filter(pc.equal(table.column("kind"), kind)), known, kind), kind - PLACED
            for _, columns in apart(tokens_, known, k):
                levels, states = grown(columns, known, k)
                if states:
                    at = levels[0][0][states[0][levels[0][1]]]
                    numbers_ = np.unique(known.context([each[at] for each in columns], k - 1))
                    found += [rows_of([(HAS_STATE + k - 1, int(each), -1, 0, None, None) for each in numbers_])] if len(numbers_) else []
        return pa.Table.from_batches(found)

    deep = rows.filter(F.col("kind").between(PLACED + 2, PLACED + hot.depth))
    flags = deep.groupBy("bucket").applyInArrow(made, ROWS).select("kind", F.col("bucket").alias("number")).distinct()
    states = [each.copy() for each in hot.states]
    for kind, number in flags.collect():  # at most the hot contexts
        states[kind - HAS_STATE - 1][number] = True
    for k in range(len(states), 1, -1):
        level = hot.runs[k - 1]
        on = np.flatnonzero(states[k - 1])
        for number in on:  # the suffix: the run without its first word
            words = run_words(hot, k, int(number))[1:]
            states[k - 2][hot.number([np.array([each], dtype=np.uint64) for each in words])[0]] = True
    return replace(hot, states=tuple(states))


def run_words(hot: Hot, length: int, number: int) -> list[int]:
    """Their codes, the oldest first."""
    words = []
    for k in range(length, 1, -1):
        key = int(hot.runs[k - 1].keys[number])
        words.insert(0, int(hot.runs[0].keys[key & LOW]))
        number = key >> 32
    return [int(hot.runs[0].keys[number]), *words]


def chances(columns: list[np.ndarray], hot: Hot, k: int) -> np.ndarray:
    """Of tokens whose contexts of fewer than k words are hot: their probability at the longest state."""
    p = (hot.counts(columns, 0) + ADDED) / hot.unit
    for shorter in range(1, k):
        number, n = hot.context(columns, shorter), hot.counts(columns, shorter).astype(float)
        share = np.where(n >= hot.threshold, n - DISCOUNT, 0) / hot.runs[shorter - 1].counts[number]
        p = np.where(hot.states[shorter - 1][number], hot.rest[shorter - 1][number] * p + share, p)
    levels, states = grown(columns, hot, k)
    for (at, context, share, rest, _), state in zip(levels, states, strict=True):
        on = state[context]
        p[at[on]] = rest[context[on]] * p[at[on]] + share[on]
    return p


def scored(rows: DataFrame, shared: Broadcast) -> DataFrame:
    """Sums of the log10 of placed tokens, of every text in a task."""
    hot = shared.value

    def made(table: pa.Table) -> pa.Table:
        known, found = shared.value, [rows_of([(SUMS, -1, -1, 0, None, None)]).slice(0, 0)]
        for kind in sorted(set(table.column("kind").to_pylist())):
            columns = joined(table.filter(pc.equal(table.column("kind"), kind)), known, kind)
            logs = np.empty(len(columns[0]))
            for place, part in apart(columns, known, kind - PLACED):
                logs[place] = np.log10(chances(part, known, kind - PLACED))
            found += sums_of(columns[known.depth + 1], logs)
        return pa.Table.from_batches(found)

    return rows.filter(F.col("kind").between(PLACED, PLACED + hot.depth + 1)).groupBy("bucket").applyInArrow(made, ROWS)


def gathered(rows: DataFrame) -> DataFrame:
    """One row of sums for every chunk, of those from many tasks."""

    def made(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n", "ascending"), ("data", "ascending")])
        parts = [unpressed(data, n, ["u4", "f8"]) for n, data in zip(*[table.column(name).to_pylist() for name in ("n", "data")], strict=True)]
        sums = np.bincount(*map(np.concatenate, zip(*parts, strict=True)))
        data = pressed([np.arange(len(sums), dtype=np.uint32), sums])
        return pa.Table.from_batches([rows_of([(SUMS, -1, table.column("chunk")[0].as_py(), len(sums), data, None)])])

    return rows.groupBy("chunk").applyInArrow(made, ROWS)


def summed(rows: DataFrame) -> DataFrame:
    """A row per text, from the rows of its chunk."""
    names = "id long, n_tokens long, n_known long, base_score double, score double"

    def made(table: pa.Table) -> pa.Table:
        table = table.sort_by([("kind", "descending"), ("n", "ascending"), ("data", "ascending")])
        held = list(zip(*[table.column(name).to_pylist() for name in ("kind", "n", "data")], strict=True))
        lengths, known, base, keys, nulls = unpressed(held[0][2], held[0][1], ["i8", "i8", "f8", "i8", "u1"])
        score = np.zeros(len(keys))
        for kind, n, data in held[1:]:
            if kind == SUMS:
                texts, value = unpressed(data, n, ["u4", "f8"])
                score[texts] += value
            else:
                texts, more, rate, _ = unpressed(data, n, ["u4", "f8", "f8", "f8"])
                known[texts] += more.astype(np.int64)
                base[texts] += rate
        columns = [pa.array(keys, mask=nulls.astype(bool)), *map(pa.array, (lengths, known, base, score))]
        return pa.table(columns, names=[field.split()[0] for field in names.split(", ")])

    return rows.filter(F.col("kind").isin(SUMS, RARE_SUMS, TEXTS)).groupBy("chunk").applyInArrow(made, names)


def tree_scores(docs: DataFrame, learns: Column, key: str = "doc_id", text: str = "text", depth: int = DEPTH) -> tuple[DataFrame, int]:
    """What ``score`` returns, for all rows, from the whole tree of those that ``learns`` is true for; and the tokens of these."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(learns, F.lit(False)).alias("learns"), whole(F.col(text)).alias("text"))
    stages = Stages(spark)
    words = stages(counted(rows.filter("learns").select("text"), []), "suffix-words")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("words")).first()
    head, counts = Head.ranked(frequent(words, head_least(words), words=True))
    hot = Hot(counts, [], total["tokens"], total["words"], LEAST, depth)
    stages.drop()
    chunks = stage(chunks_of(rows, head), "suffix-chunks")
    hot = hot_runs(chunks, hot)
    everything = chunks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))).first()[0]
    wanted = Wanted(max(PASSES, -(-(everything or 0) // (2 * BUCKET))))
    share = spark.sparkContext.broadcast
    shared = share(hot)
    send = lambda k: tokens_of(chunks, shared, replace(wanted, k=k))
    ready = [stage(counted_after(send(0), shared, 0, wanted), "suffix-rare")]
    contexts, stats = [level for level in hot.runs[:depth] if len(level.keys)], []
    for k, level in enumerate(contexts, 1):
        free_shuffles(spark)
        ready.append(stage(counted_after(union([send(k), *ready]), shared, k, wanted), "suffix-counted"))
        sums = np.zeros((len(level.keys), 4))
        parts = [F.sum(F.col("stats")[i]) for i in range(4)]
        for number, *own in ready[-1].filter(F.col("kind") == TESTED + k).groupBy("bucket").agg(*parts).collect():  # hot contexts
            sums[number] = own
        stats.append(sums)
    hot = hot.tested(stats)
    for passes in (TRIED, 1):  # a few of the longer contexts mostly tell it of all
        if hot.settled():
            break
        shared = share(hot)
        own = [each.filter(F.col("bucket") % passes == 0) for each in ready]
        hot = hot_with_states(union([tokens_of(chunks, shared, replace(wanted, least=2, passes=passes)), *own]), shared)
    shared, found = share(hot), []
    for part in range(PASSES):
        free_shuffles(spark)
        own = [each.filter(F.col("bucket") % PASSES == part) for each in ready]
        rows = union([tokens_of(chunks, shared, replace(wanted, part=part, passes=PASSES)), *own])
        found.append(stage(gathered(scored(rows, shared)), "suffix-sums"))
    free_shuffles(spark)
    return summed(union([texts_of(chunks, shared), ready[0], *found])), total["tokens"]


def free_shuffles(spark) -> None:
    """Spark deletes the files of finished exchanges once the driver's garbage is collected. Its listeners hold the last
    one for a moment."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def held_out(key: Column) -> Column:
    """A NULL id is held out: it teaches nothing."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 10 == 0, F.lit(True))


def op12_lm_scores(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scores, learned = tree_scores(docs, ~held_out(F.col("doc_id")))
    return scores.select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(learned).cast("long").alias("train_tokens"), "base_score", "score",
    )
