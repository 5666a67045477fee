"""Jaccard join of documents on word n-grams, by rare-first prefix filtering.

1. Every text becomes the set of its n-gram hashes. Documents with equal sets form a class, and classes
   are what is joined. Counters in ``BUCKETS`` hash buckets say how frequent an n-gram is at most.
2. A set is ordered rarest n-gram first. Two sets that reach the threshold t share an n-gram within their
   first n - ceil(t n) + 1; only these prefixes are dealt out by n-gram, and n-grams that one class alone
   has in its prefix go.
3. Pairs pass filters that never reject a link: sizes within t (length), what is left of both sets from
   the shared n-gram on (positional), and a lower bound of the symmetric difference from parity sketches
   of the sets (suffix). What passes is compared once, on full sets.
4. First each class of an n-gram meets three others only: the one of least name, the one of greatest and its
   neighbour by size. A group of near copies shares them, so it costs a few rows and pairs a member and
   becomes one component. N-grams of up to three classes are done with that, and so are those whose
   classes lie in one component, for links inside it change nothing.
5. In the n-grams left all pairs across components are enumerated, an n-gram of more than ``HOT`` classes
   by pairs of blocks, so no link between components is missed. Only classes that are much alike without being linked
   through others still cost their square there, in filters; nothing is written for a pair that fails them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.components import connected_components
from tripflow.llm.line_dedup import placed_rows
from tripflow.llm.text import Stages, bounded_batches, table, whole
from tripflow.session import stage as stage_of

WORDS, PERCENT = 3, 90  # the contract of op7
BUCKETS = 1 << 18
SKETCH_WORDS = 16  # of 64 bits
HOT = 16_384
BLOOM_BITS = 1 << 26
SEEN = 100_000

# The white space of the contract ends words; A to Z become a to z.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BASE = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(7)
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
PIECE = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, dtype=np.uint64)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of the bytes, and where each word starts: differences of one running sum."""
    codes = np.frombuffer(data, dtype=np.uint8)
    space = SPACES[codes]
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts
    scale = powers(BASE, len(codes))
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(BYTE_CODES[codes] * scale, dtype=np.uint64)])
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    back = powers(inverse, len(codes))[starts]
    return mixed((total[ends] - total[starts]) * back + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's n-grams; a shorter text is one n-gram."""
    found: list[np.ndarray] = []
    at = 0
    encoded = [text.encode(errors="surrogatepass").translate(LOWER) for text in texts]
    while at < len(encoded):
        size, end = 0, at
        while end < len(encoded) and (end == at or size + len(encoded[end]) < PIECE):
            size += len(encoded[end]) + 1
            end += 1
        part = encoded[at:end]
        hashes, starts = word_hashes(b" ".join(part))
        limits = np.cumsum([len(each) + 1 for each in part])
        cuts = np.searchsorted(starts, limits)
        first = 0
        for cut in cuts:
            own = hashes[first:cut]
            n = min(words, len(own))
            if n:
                grams = np.full(len(own) - n + 1, n, dtype=np.uint64)
                for k in range(n):
                    grams = mixed(grams * BASE + own[k : len(own) - n + 1 + k])
                found.append(np.unique(grams))
            else:
                found.append(own)
            first = cut
        at = end
    return found


def class_of(grams: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def buckets_of(grams: np.ndarray) -> np.ndarray:
    return (grams & np.uint64(BUCKETS - 1)).astype(np.int64)


def parity_sketch(grams: np.ndarray) -> bytes:
    """Each hash flips one bit: sketches differ in at most as many bits as the sets do in hashes."""
    place = (grams >> np.uint64(40)) % np.uint64(64 * SKETCH_WORDS)
    flips = np.bincount(place.astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def texts_of(
    batches: Iterator[pa.RecordBatch], column: int, words: int
) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, 250):
            part = batch.slice(at, 250)
            yield part, shingle_sets(part.column(column).to_pylist(), words)


def described(named: DataFrame, words: int, stage: Stages) -> DataFrame:
    """A row per document (``id``, ``n``, ``class``, ``sketch``) and a row per task and bucket with its count."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for part, sets in texts_of(batches, 1, words):
            for grams in sets:
                counts += np.bincount(buckets_of(grams), minlength=BUCKETS) if len(grams) > BUCKETS // 8 else 0
            small = [grams for grams in sets if 0 < len(grams) <= BUCKETS // 8]
            if small:
                counts += np.bincount(buckets_of(np.concatenate(small)), minlength=BUCKETS)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(grams) for grams in sets], pa.int64()),
                    pa.array([class_of(grams) if len(grams) else None for grams in sets], pa.int64()),
                    pa.array([parity_sketch(grams) if len(grams) else None for grams in sets], pa.binary()),
                    pa.nulls(len(sets), pa.int32()),
                ],
                names=["id", "n", "class", "sketch", "bucket"],
            )
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(used), pa.int64()), pa.array(counts[used]), pa.nulls(len(used), pa.int64()),
             pa.nulls(len(used), pa.binary()), pa.array(used, pa.int32())],
            names=["id", "n", "class", "sketch", "bucket"],
        )

    return stage(named.mapInArrow(made, "id long, n long, class long, sketch binary, bucket int"), "near-described")


def prefix_rows(named: DataFrame, counts: np.ndarray, words: int, percent: int) -> DataFrame:
    """``gram``, ``class``, ``n``, ``at``: the prefix of every class. A task tells recent copies by class."""
    shared = named.sparkSession.sparkContext.broadcast(counts)  # BUCKETS numbers

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, seen = shared.value, set()
        for _, sets in texts_of(batches, 1, words):
            grams, owners, sizes, places = [], [], [], []
            for own in sets:
                if not len(own) or (name := class_of(own)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                length = prefix_length(len(own), percent)
                first = own[np.lexsort((own, frequency[buckets_of(own)]))[:length]]
                grams.append(first)
                owners.append(np.full(length, name, dtype=np.int64))
                sizes.append(np.full(length, len(own), dtype=np.int64))
                places.append(np.arange(length, dtype=np.int64))
            if grams:
                columns = [np.concatenate(each) for each in (grams, owners, sizes, places)]
                columns[0] = columns[0].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(each) for each in columns], names=["gram", "class", "n", "at"])

    return named.mapInArrow(made, "gram long, class long, n long, at long")


MET = ("least", "most", "next")


def shared_rows(rows: DataFrame, percent: int) -> DataFrame:
    """Rows of n-grams that several classes share, with the three classes that each meets first."""
    by_size = Window.partitionBy("gram").orderBy("n", "class")
    # No class of the n-gram is near enough in size unless one of the neighbours is.
    near = (F.lag("n").over(by_size) * 100 >= F.col("n") * percent) | (
        F.col("n") * 100 >= F.lead("n").over(by_size) * percent
    )
    of_gram = Window.partitionBy("gram")
    own = F.struct("class", "n", "at")
    return (
        rows.repartition("gram").dropDuplicates(["gram", "class"])
        .withColumns({"near": near, "next": F.lag(own).over(by_size)}).filter("near").drop("near")
        .withColumns({"held": F.count(F.lit(1)).over(of_gram), "least": F.min(own).over(of_gram), "most": F.max(own).over(of_gram)})
    )


def first_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a`` < ``b`` of each class with those it meets first that pass by length and position; and their sizes."""
    met = F.explode(F.array(*MET)).alias("other")
    both = shared.select("class", "n", "at", met).filter("other IS NOT NULL AND other.class <> class")
    larger, smaller = F.greatest("n", "other.n"), F.least("n", "other.n")
    total = F.col("n") + F.col("other.n")
    rest = F.least(F.col("n") - F.col("at"), F.col("other.n") - F.col("other.at"))
    overlap = F.ceil(total * percent / (100 + percent))
    ok = (smaller * 100 >= larger * percent) & (rest * (100 + percent) >= total * percent)
    pair = (F.least("class", "other.class").alias("a"), F.greatest("class", "other.class").alias("b"))
    return both.filter(ok).select(*pair, (total - 2 * overlap).alias("limit")).distinct()


def near_by_sketch(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs whose sketches differ in no more than ``limit`` bits."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint64).reshape(-1, SKETCH_WORDS) for k in (3, 4)
            )
            apart = np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)
            yield batch.select([0, 1]).filter(pa.array(apart <= batch.column(2).to_numpy()))

    for end, name in (("a", "ours"), ("b", "theirs")):
        pairs = pairs.join(sketches.toDF(end, name), end)
    return pairs.select("a", "b", "limit", "ours", "theirs").mapInArrow(made, "a long, b long")


def open_rows(shared: DataFrame, components: DataFrame, sketches: DataFrame) -> DataFrame:
    """Rows of n-grams in which some pairs across components have not met, with sketch and blocks."""
    rows = with_component(shared.filter("held > 3").select("gram", "class", "n", "at", "held"), components)
    of_gram = Window.partitionBy("gram")
    spans = (F.min("component").over(of_gram) != F.max("component").over(of_gram)).alias("spans")
    left = rows.select("*", spans).filter("spans").drop("spans")
    blocked = left.withColumn("blocks", F.ceil(F.col("held") / HOT).cast("int")).withColumn("block", F.pmod("class", "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        blocked.join(sketches, "class").select("*", other.alias("other"))
        .select(
            "gram", "class", "n", "at", "sketch", "block", "component",
            F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        )
    )


def compared(rows: DataFrame, percent: int) -> DataFrame:
    """All pairs ``a`` < ``b`` of classes across components that pass all filters.

    Rows of an n-gram and a pair of blocks, at most 2 * HOT, come together.
    """
    names = ["gram", "low", "high", "class", "n", "at", "component", "block", "sketch"]

    def pairs_of(held: list[np.ndarray], sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gram, low, high, own, n, at, component, block = held
        left, right = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        live = np.arange(len(gram))
        for step in range(1, len(gram)):
            live = live[live + step < len(gram)]
            i, j = live, live + step
            # Rows of a group are in order of size: once the other is too large, all after it are.
            same = (gram[i] == gram[j]) & (low[i] == low[j]) & (high[i] == high[j]) & (100 * n[i] >= percent * n[j])
            live = i = live[same]
            if not len(i):
                break
            j = i + step
            both = n[i] + n[j]
            overlap = -(-percent * both // (100 + percent))
            rest = np.minimum(n[i] - at[i], n[j] - at[j])
            ok = (rest >= overlap) & (own[i] != own[j]) & (component[i] != component[j])
            ok &= (low[i] == high[i]) | (block[i] != block[j])
            i, j, limit = i[ok], j[ok], (both - 2 * overlap)[ok]
            for start in range(0, len(i), 100_000):
                x, y = i[start : start + 100_000], j[start : start + 100_000]
                apart = np.bitwise_count(sketch[x] ^ sketch[y]).sum(axis=1, dtype=np.int64)
                near = apart <= limit[start : start + 100_000]
                left.append(x[near])
                right.append(y[near])
        x, y = np.concatenate(left), np.concatenate(right)
        a, b = np.minimum(own[x], own[y]), np.maximum(own[x], own[y])
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        fresh = np.ones(len(a), dtype=bool)
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return a[fresh], b[fresh]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: pa.Table | None = None

        def emitted(part: pa.Table) -> pa.RecordBatch:
            held = [part.column(name).to_numpy() for name in names[:-1]]
            data = b"".join(part.column("sketch").to_pylist())
            a, b = pairs_of(held, np.frombuffer(data, dtype=np.uint64).reshape(-1, SKETCH_WORDS))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            part = pa.Table.from_batches([batch])
            carry = pa.concat_tables([carry, part]) if carry is not None else part
            last = np.stack([carry.column(name).to_numpy() for name in names[:3]])
            whole_rows = np.flatnonzero((last != last[:, -1:]).any(axis=0))
            if len(whole_rows):  # all but the last group, which may go on in the next batch
                end = int(whole_rows[-1]) + 1
                yield emitted(carry.slice(0, end))
                carry = carry.slice(end).combine_chunks()
        if carry is not None and carry.num_rows:
            yield emitted(carry)

    ordered = rows.select(*names).repartition("gram", "low", "high").sortWithinPartitions("gram", "low", "high", "n", "class")
    return ordered.mapInArrow(made, "a long, b long").distinct()


def needed_sets(named: DataFrame, classes: DataFrame, words: int, stage: Stages) -> DataFrame:
    """``class`` and ``grams`` of the classes, found by another pass over the texts.

    A Bloom filter of fixed size tells which texts may be wanted; the join settles it.
    """
    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BLOOM_BITS // 8, dtype=np.uint8)
        for batch in batches:
            names = batch.column(0).to_numpy().view(np.uint64)
            for place in bloom_places(names):
                np.bitwise_or.at(bits, place >> np.uint64(3), (1 << (place & np.uint64(7))).astype(np.uint8))
        used = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(bits[used].astype(np.int32))], names=["byte", "bits"])

    parts = classes.coalesce(8).mapInArrow(marked, "byte long, bits int").groupBy("byte").agg(F.bit_or("bits").alias("bits"))
    bloom = np.zeros(BLOOM_BITS // 8, dtype=np.uint8)
    for row in parts.toLocalIterator():  # at most a row per byte of the filter
        bloom[row["byte"]] = row["bits"]
    shared = named.sparkSession.sparkContext.broadcast(bloom)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        for _, sets in texts_of(batches, 1, words):
            names = np.array([class_of(own) if len(own) else 0 for own in sets], dtype=np.int64)
            wanted = np.array([len(own) > 0 for own in sets], dtype=bool)
            for place in bloom_places(names.view(np.uint64)):
                wanted &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            kept = []
            for k in np.flatnonzero(wanted):
                if int(names[k]) not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(int(names[k]))
                    kept.append(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[kept]), pa.array([sets[k].tobytes() for k in kept], pa.binary())], names=["class", "grams"]
            )

    found = named.mapInArrow(made, "class long, grams binary").join(classes, "class", "left_semi")
    return stage(found.dropDuplicates(["class"]), "near-sets")


def bloom_places(names: np.ndarray) -> list[np.ndarray]:
    return [mixed(names + np.uint64(k)) % np.uint64(BLOOM_BITS) for k in (1, 2, 3)]


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are links, by their full sets."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k in range(batch.num_rows):
                one, two = (np.frombuffer(batch.column(c)[k].as_buffer(), dtype=np.uint64) for c in (2, 3))
                places = np.searchsorted(two, one)
                both = int((two[np.minimum(places, len(two) - 1)] == one).sum())
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("class").alias("a"), F.col("grams").alias("ours"))
    two = sets.select(F.col("class").alias("b"), F.col("grams").alias("theirs"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "ours", "theirs")
    return joined.mapInArrow(checked, "a long, b long")


def with_component(rows: DataFrame, components: DataFrame) -> DataFrame:
    """Adds the ``component`` of ``class``: its own name where it has no link."""
    found = rows.join(components.withColumnRenamed("node", "class"), "class", "left")
    return found.withColumn("component", F.coalesce("component", "class"))


def joined_components(components: DataFrame, links: DataFrame, stage: Stages) -> DataFrame:
    """Components after further links, each of which counts once for the two components it joins."""
    between = links
    for end in ("a", "b"):
        named = components.select(F.col("node").alias(end), F.col("component").alias(f"{end}_in"))
        between = between.join(named, end, "left")
    between = between.select(
        F.coalesce("a_in", "a").alias("a"), F.coalesce("b_in", "b").alias("b")
    ).distinct()
    between = stage(between, "near-between")
    joined = connected_components(between).toDF("component", "over")
    known = components.union(
        between.select("a", "a").union(between.select("b", "b")).distinct()
    ).distinct()
    return known.join(joined, "component", "left").select("node", F.coalesce("over", "component").alias("component")).distinct()


def classes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()


def link_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``id``, ``n`` (size of the n-gram set) and ``component``, the smallest id linked to it, per row.

    Sets of n-grams of ``words`` words link when 100 * intersection >= percent * union. A text without words (NULL, empty) has an empty
    set and is its own component. Rows of one id are one document as far as ``component`` goes; NULL ids
    are passed over when the smallest is sought. An empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    stage = Stages(spark)
    named = docs.select(F.col(key).cast("long").alias("id"), whole(F.col(text)).alias("text"))
    rows = described(named, words, stage)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    found = rows.filter("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS rows at most
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    members = rows.filter("bucket IS NULL")
    sketches = members.filter("class IS NOT NULL").groupBy("class").agg(F.first("sketch").alias("sketch"))
    shared = stage(shared_rows(prefix_rows(named, counts, words, percent), percent), "near-shared")
    first = stage(near_by_sketch(first_pairs(shared, percent), sketches), "near-first")
    links = stage(verified(first, needed_sets(named, classes_of(first), words, stage), percent), "near-links")
    components = connected_components(links)
    stage.drop("near-described", "near-shared", "near-first")
    others = compared(open_rows(shared, components, sketches), percent).join(first, ["a", "b"], "left_anti")
    others = stage(others, "near-others")
    if not others.isEmpty():
        stage.drop("near-described", "near-others")
        more = verified(others, needed_sets(named, classes_of(others), words, stage), percent)
        components = stage_of(joined_components(components, more, stage), "near-components")
    stage.drop("near-described")
    labelled = with_component(members.select("id", "n", "class"), components)
    smallest = labelled.filter("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("smallest"))
    return labelled.join(smallest, "component", "left").select(
        "id", "n", F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("smallest")).alias("component")
    )


def drop_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row of each component, with the columns of ``docs``: the one with the smallest id, NULL last.

    Rows are told apart by their place in the order of the key, so ids may be NULL or repeated; which one
    of equal ids stays is open. Rows without words all stay.
    """
    rows = placed_rows(docs, key)
    linked = link_components(rows.select("at", F.col(f"row.`{text}`").alias("text")), "at", "text", words, percent)
    found = linked.filter("id = component").select(F.col("id").alias("at"))
    return rows.join(found, "at", "left_semi").select("row.*")


def op7_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )
