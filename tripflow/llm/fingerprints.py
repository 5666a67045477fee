"""Document fingerprints of closed syncmers, with native expressions only.

A text is a sequence of words with K - 1 marks before and after it. Of every K consecutive words the
inner substrings of S words are hashed; the K words are an anchor when the least of these hashes is
the first or the last. Whether K words are an anchor depends on nothing outside them, so an edit moves
no anchor that it does not touch, and anchors of two texts can be matched position by position.

All steps are array expressions within one row: shifted copies of the array of word hashes meet in
``zip_with``, and the least of W neighbours takes log2(W) such meetings. Nothing is exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.text import SPACE, packed, table, whole
from tripflow.session import stage

K, S = 5, 2
W = K - S + 1  # inner substrings of K words
BUCKET_ROWS = 4_000


def word_hashes(text: Column) -> Column:
    """Hashes of the words and of the marks around them; no words, no marks."""
    words = F.filter(F.split(whole(text), f"[{SPACE}]+"), lambda w: w != "")
    marks = F.array_repeat(F.lit(0).cast("long"), K - 1)
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(hashed) > 0, F.concat(marks, hashed, marks)).otherwise(F.array().cast("array<bigint>"))


def shifted(items: Column, by: int) -> Column:
    return F.slice(items, by + 1, F.greatest(F.size(items) - by, F.lit(0)))


def neighbours(items: Column, by: int, combine) -> Column:
    """``combine`` of every item and the one ``by`` places on, where there is one."""
    kept = F.slice(items, 1, F.greatest(F.size(items) - by, F.lit(0)))
    return F.zip_with(kept, shifted(items, by), combine)


def with_fingerprint(rows: DataFrame, text: Column, name: str, size: int | None = None) -> DataFrame:
    """Adds ``name``: all anchors in order of ``position``, with ``hash`` beside it. The hash has 31 bits,
    so that both are arrays of int.

    With ``size`` it is a sketch: only so many different anchors of least hash, each at its first place.
    """
    words, inner, least, closed, hashes = (f"{name}_{part}" for part in "wilch")
    rows = rows.withColumn(words, word_hashes(text))
    rows = rows.withColumn(inner, neighbours(F.col(words), S - 1, lambda a, b: F.xxhash64(a, b)))
    rows = rows.withColumn(least, F.col(inner))
    for by in (1, 2):  # the least of 2, then of 4 = W
        rows = rows.withColumn(least, neighbours(F.col(least), by, lambda a, b: F.least(a, b)))
    at_edge = lambda low, i: (F.get(inner, i) == low) | (F.get(inner, i + W - 1) == low)
    places = F.transform(F.col(least), lambda low, i: F.when(at_edge(low, i), i))
    rows = rows.withColumn(closed, F.filter(places, lambda i: i.isNotNull()))
    anchor = lambda i: F.xxhash64(F.get(inner, i), F.get(inner, i + S), F.get(inner, i + W - 1))
    rows = rows.withColumn(hashes, F.transform(closed, lambda i: anchor(i).bitwiseAND(F.lit(2**31 - 1)).cast("int")))
    found = F.struct(F.col(hashes).alias("hash"), F.col(closed).alias("position"))
    if size is not None:
        place = lambda h: F.get(closed, (F.array_position(hashes, h) - 1).cast("int"))
        rows = rows.withColumn(least, F.slice(F.array_sort(F.array_distinct(hashes)), 1, size))
        found = F.struct(F.col(least).alias("hash"), F.transform(least, place).alias("position"))
    return rows.withColumn(name, found).drop(words, inner, least, closed, hashes)


def as_text(fingerprint: Column) -> Column:
    """``position:hash`` of every anchor, in the order of the fingerprint."""
    shown = lambda at, h: F.concat(at.cast("string"), F.lit(":"), F.lower(F.hex(h)))
    return F.array_join(F.zip_with(fingerprint["position"], fingerprint["hash"], shown), " ")


def links(fingerprint: Column) -> Column:
    """A hash for every anchor, of itself, the next anchor and the distance between them; the last has no next.

    Two texts that share a link have two neighbouring anchors at one offset.
    """
    hashes, places = fingerprint["hash"], fingerprint["position"]
    return F.transform(
        hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(places, i + 1) - F.get(places, i))
    )


def likeness(one: Column, other: Column) -> Column:
    """Jaccard likeness of all different ``links``: anchors count as shared where their offset goes on to the next.

    A passage that is moved as a whole stays shared; an anchor that occurs in other surroundings is not.
    """
    both = F.size(F.array_union(one, other))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(one, other)) / both)


def matches(one: Column, other: Column) -> Column:
    """Shared anchors as (position in one, position in the other): what a passage's offset is read from.

    An anchor that is repeated is matched with all its places. For single pairs of texts: the work is
    the product of both sizes.
    """
    theirs = F.arrays_zip(other["hash"].alias("hash"), other["position"].alias("position"))
    pairs = F.zip_with(
        one["hash"],
        one["position"],
        lambda h, at: F.transform(
            F.filter(theirs, lambda anchor: anchor["hash"] == h),
            lambda anchor: F.struct(at.alias("position"), anchor["position"].alias("other")),
        ),
    )
    return F.flatten(pairs)


def dealt(docs: DataFrame, key: str, text: str, bucket_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows as struct ``row`` with their place in the order (``falling``, ``tie``), their ``bucket``, and for rows that
    lead one the bucket ``before``; and the leading places.

    Only places are put in order, by ranges over all tasks; a bucket is a run of ``bucket_rows`` of them in one
    range, and rows find theirs by a join. The bucket before the first of a range is the last of the range
    before, and before the first of all is the last: one row per task is looked at for that.
    """
    places = {
        "falling": F.bitwise_not(F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))),
        "tie": F.xxhash64(whole(F.col(text))),
    }
    order = docs.select(*[place.alias(name) for name, place in places.items()]).distinct()
    order = order.repartitionByRange(*places).sortWithinPartitions(*places)
    order = stage(order.withColumn("at", F.monotonically_increasing_id()), "fingerprint-order")
    number = F.expr(f"(at & {(1 << 33) - 1}L) div {bucket_rows}")
    order = order.select(*places, "at", F.shiftright("at", 33).alias("range"), number.alias("number"))
    in_order = Window.orderBy("range")
    bucket = lambda name: F.shiftleft("range", 33) + F.col(name)
    ranges = order.groupBy("range").agg(F.max("number").alias("last")).withColumn("final", bucket("last"))
    last_of_all = F.last("final").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ranges = ranges.select("range", F.coalesce(F.lag("final").over(in_order), last_of_all).alias("back"))
    leads = F.expr(f"(at & {(1 << 33) - 1}L) % {bucket_rows} = 0")
    back = F.when(leads, F.when(F.col("number") == 0, F.col("back")).otherwise(bucket("number") - 1))
    numbered = order.join(F.broadcast(ranges), "range").select(*places, bucket("number").alias("bucket"), back.alias("before"))
    return packed(docs, **places).join(numbered, [*places]), numbered.filter("before IS NOT NULL")


def with_next(docs: DataFrame, key: str, text: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows as struct ``row`` with ``text``, and ``next``, the text of the document that follows in
    descending order of key.

    NULL keys come last, equal keys go by a hash of the text, the last row is followed by the first.
    Rows are dealt to buckets of about ``bucket_rows`` neighbours in this order, and a bucket also gets a
    copy of the first row after it; so no order of texts is ever made over all rows, and nothing comes to the
    driver. Only rows equal in key and text cannot be parted.
    """
    held, _ = dealt(docs, key, text, bucket_rows)
    inside = F.col(f"row.`{text}`")
    copies = F.array_compact(F.array("bucket", "before"))
    spread = held.select("row", "falling", "tie", F.posexplode(copies).alias("copy", "bucket"))
    follows = Window.partitionBy("bucket").orderBy("copy", "falling", "tie")
    # Whole columns lead, so that no second copy of a text goes through the exchange.
    followed = spread.select("*", F.lead("row").over(follows).alias("follower"))
    return followed.filter("copy = 0").select(
        "row", whole(inside).alias("text"), whole(F.col(f"follower.`{text}`")).alias("next")
    )


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows as struct ``row`` with the fingerprints of the text, of its edited form, and of the next text.

    The edited form has its last third replaced by the start of the next text. NULL texts are empty;
    a text without words has an empty fingerprint, and two empty ones are alike (1.0). Other columns
    travel in ``row``. An empty table gives no rows.
    """
    rows = with_next(docs, key, text).withColumn("n_chars", F.length("text").cast("long"))
    replaced = F.floor(F.col("n_chars") / 3).cast("int")
    kept = F.col("n_chars").cast("int") - replaced
    edited = F.concat(F.substring(F.col("text"), F.lit(1), kept), F.substring(F.col("next"), F.lit(1), replaced))
    rows = rows.withColumn("edited", edited)
    # Made again for the next text: anchors are not much smaller than the text they would travel with.
    for source, name in (("text", "fingerprint"), ("edited", "edited_fingerprint"), ("next", "next_fingerprint")):
        rows = with_fingerprint(rows, F.col(source), name)
    return rows.select(
        "row", "n_chars", "edited", "fingerprint", "edited_fingerprint", "next_fingerprint"
    )


def op5_fingerprints(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = fingerprints(docs)
    names = ("fingerprint", "edited_fingerprint", "next_fingerprint")
    marked = marked.withColumns({f"{name}_links": links(F.col(name)) for name in names})
    return marked.select(
        "row.doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("fingerprint")).alias("fingerprint"),
        as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint_links"), F.col("edited_fingerprint_links")).alias("near_edited"),
        likeness(F.col("fingerprint_links"), F.col("next_fingerprint_links")).alias("near_next"),
    )
