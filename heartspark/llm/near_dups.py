"""Near-duplicate documents by BagMinHash.

A document is the multiset of its five-word shingles, with counts as weights. Weights are
discretised at the integers; the levels 0-1, 1-2, 2-4, 4-8, ... form blocks, and each shingle has in
each block a Poisson process of points in time, derived from hashes, at the rate of the block's
length. A point falls on a level of its block and on one of the signature's registers; a document
takes the points on levels below its count. A register holds the earliest point that falls on it,
and two documents agree in a register with the probability of their weighted Jaccard similarity.
Points are made in order of time and a process ends once it has passed the latest register, so
that about m log m points and one for each shingle are made, whatever the counts.

Signatures are cut into bands; documents that agree in a band share a bucket. In each bucket a
pivot is compared with all others, by the exact overlap of the multisets, and documents found
similar form classes. The pivot is the document with the most neighbours in all buckets, which is
the original rather than one of its copies. In buckets that then hold several classes, what two
documents share lies in the pivot and in shingles that many have beyond it, bounded by the smaller of
their overlaps with those, or among rare shingles, where a join counts it exactly. Pairs of
different classes that this bound allows are compared in full. So no pair of a bucket that can be
similar is left out, and pairs of a group of copies aren't listed: copies are similar to the
original, and those that aren't share little beyond it.

Documents with the same multiset are copies; one stands for all of them.

Results by definition: null texts, empty texts and texts without words are alone in their classes;
texts of fewer than five words have one shingle of all their words; repeated rows and rows with
one id are one document (of different texts of one id the greatest multiset counts); texts of any
length count whole; an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .decontaminate import tokens
from .rows import col, col_of, cut, pick

WIDTH = 5
#: At a similarity of 0.8 all BANDS miss with a probability of (1 - 0.8 ** ROWS) ** BANDS = 7e-6.
ROWS, BANDS = 5, 30
#: A shingle beyond the pivot that more documents have is reckoned with the pivot (which bounds, so nothing is lost).
RARE = 16
#: Ids of documents in shared buckets are broadcast up to so many (of 16 bytes).
BROADCAST_IDS = 1_000_000
#: Tokens worked on together in a task.
CHUNK = 1 << 18
PAD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, count) of the different shingles of documents given by token hashes, in order of document and hash."""
    n = np.diff(offsets)
    many = np.where(n > 0, np.maximum(1, n - WIDTH + 1), 0)
    doc = np.repeat(np.arange(len(n)), many)
    start = offsets[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    end = offsets[1:][doc]
    h = np.zeros(len(doc), np.uint64)
    for k in range(WIDTH):
        at = start + k
        h = mix(h * np.uint64(31) + np.where(at < end, values[np.minimum(at, len(values) - 1)], PAD) if len(values) else h)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])])) if len(h) else np.zeros(0, int)
    return doc[first], h[first], np.diff(np.append(first, len(h)))


def signatures(doc: np.ndarray, h: np.ndarray, count: np.ndarray, docs: int, m: int = ROWS * BANDS) -> np.ndarray:
    """The earliest time of each register, for ``docs`` documents; infinite where there is no shingle."""
    registers = np.full((docs, m), np.inf)
    flat = registers.reshape(-1)
    # Blocks of levels: [0, 1), [1, 2), [2, 4), ...; each shingle has those that start below its count.
    parts, low, block = [], 0, 0
    while (has := np.flatnonzero(count > low)).size:
        size = max(1, low)
        parts.append((doc[has], mix(h[has] + np.uint64(block)), np.full(len(has), float(size)), np.full(len(has), low), count[has]))
        low += size
        block += 1
    if not parts:
        return registers
    doc, seed, rate, low, count = (np.concatenate(x) for x in zip(*parts))
    time, latest, step = np.zeros(len(doc)), np.full(docs, np.inf), 0
    while len(doc):
        r = mix(seed + np.uint64((step * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / rate
        s = mix(r ^ np.uint64(0xD6E8FEB86659FD93))
        register = ((s >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        level = low + ((s & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0 ** -32 * rate).astype(np.int64)
        taken = (level < count) & (time < latest[doc])
        np.minimum.at(flat, doc[taken] * m + register[taken], time[taken])
        changed = np.unique(doc[taken])
        latest[changed] = registers[changed].max(axis=1)
        on = np.flatnonzero(time < latest[doc])
        if len(on) < len(doc):
            doc, seed, rate, low, count, time = (x[on] for x in (doc, seed, rate, low, count, time))
        step += 1
    return registers


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A hash of each band's registers."""
    bits = np.ascontiguousarray(registers).view(np.uint64).reshape(len(registers), -1, ROWS)
    key = np.arange(bits.shape[1], dtype=np.uint64) + np.uint64(1)
    for k in range(ROWS):
        key = mix(key * np.uint64(31) + bits[:, :, k])
    return key


def _chunks(column: pa.ListArray):
    """(first row, last row, token hashes, offsets) of some CHUNK tokens each; a longer text is alone."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK, "right")) - 1)
        b = min(b, len(column))
        yield a, b, values[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def _prints(doc: np.ndarray, h: np.ndarray, count: np.ndarray, docs: int) -> list[np.ndarray]:
    """Number of shingles and fingerprint of the multiset (two integers), for ``docs`` documents."""
    prints = [np.bincount(doc, count, docs).astype(np.int64)]
    for salt in (0x51ED270B9F652295, 0xC3A5C85C97CB3127):
        total = np.zeros(docs, np.uint64)
        np.add.at(total, doc, mix(h ^ np.uint64(salt)) * count.astype(np.uint64))
        prints.append(total.view(np.int64))
    return prints


def _sign(batches):
    """id, tokens -> id, number of shingles, fingerprint of the multiset (two integers), band keys (null without words)."""
    for batch in batches:
        column = batch.column(1)
        for a, b, values, offsets in _chunks(column):
            doc, h, count = shingles(values, offsets)
            docs = b - a
            prints = _prints(doc, h, count, docs)
            keys = band_keys(signatures(doc, h, count, docs)).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(docs + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1)))
            lists = pa.compute.if_else(pa.array(prints[0] > 0), lists, pa.scalar(None, lists.type))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, docs), *map(pa.array, prints), lists],
                                             names=["id", "n", "p", "q", "bands"])


def _bags(batches):
    """id, tokens -> id, what _prints() gives, hashes of (shingle, how many of it came before): overlaps of such sets are those of the multisets."""
    for batch in batches:
        column = batch.column(1)
        for a, b, values, offsets in _chunks(column):
            doc, h, count = shingles(values, offsets)
            which = np.repeat(np.arange(len(doc)), count)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            tagged = mix(h[which] + nth.astype(np.uint64) * PAD).view(np.int64)
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc, count, b - a))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *map(pa.array, _prints(doc, h, count, b - a)),
                                              pa.ListArray.from_arrays(pa.array(ends), pa.array(tagged))], names=["id", "n", "p", "q", "bag"])


def merged(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, least): the least node that each node of ``links`` (a, b) is connected with.

    Each round takes the least label among neighbours, then that label's own label, until nothing changes.
    """
    both = cut(spark, links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(spark, both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("least")))
    while True:
        near = (both.join(label.select(F.col("node").alias("b"), "least"), "b").groupBy("a").agg(F.min("least").alias("low")))
        step = label.join(near, label["node"] == near["a"]).select("node", F.least("least", "low").alias("next"), "least")
        far = label.select(F.col("node").alias("next"), F.col("least").alias("further"))
        step = cut(spark, step.join(far, "next", "left").select("node", F.least("next", "further").alias("next"), "least"))
        label = step.select("node", F.col("next").alias("least"))
        if not step.where("next < least").limit(1).count():
            return label


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8) -> DataFrame:
    """(id, class_id, copy_of, n_shingles): documents that chains of links connect share the least id
    as class; ``copy_of`` is the least id with the same multiset (the own id without words)."""
    spark, c = docs.sparkSession, F.col
    ship_package(spark)
    rows = pick(docs, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    hashed = rows.select("id", tokens(c("text")).alias("t"))
    signed = hashed.mapInArrow(_sign, f"id {kind}, n bigint, p bigint, q bigint, bands array<bigint>")
    # Of rows with one id, the greatest multiset counts; nearly always there is one row.
    one = signed.where("n > 0 and id is not null").groupBy("id").agg(F.max(F.struct("n", "p", "q", "bands")).alias("x"))
    one = cut(spark, one.select("id", "x.*"))
    lead = cut(spark, one.groupBy("n", "p", "q").agg(F.min("id").alias("lead")))
    copies = cut(spark, one.join(lead, ["n", "p", "q"]).select("id", "lead", "n"))
    bands = one.join(lead.select(c("lead").alias("id")), "id", "left_semi").select("id", F.explode("bands").alias("bucket"))
    sizes = cut(spark, bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"))
    shared = cut(spark, bands.join(sizes, "bucket"))
    central = cut(spark, shared.groupBy("id").agg(F.sum("size").alias("central")))
    shared = cut(spark, shared.join(central.join(one.select("id", "n"), "id"), "id").select("bucket", "id", "central", "n"))
    class_of = _classes(rows, shared, central.select("id"), kind, similarity)
    classed = copies.join(class_of.select(c("id").alias("lead"), "class_id"), "lead", "left").select(
        "id", F.coalesce("class_id", "lead").alias("class_id"), c("lead").alias("copy_of"), "n")
    return (rows.select("id").distinct().alias("r").join(classed.alias("k"), c("r.id") == c("k.id"), "left")
            .select(c("r.id").alias(id_col), F.coalesce("k.class_id", "r.id").alias("class_id"), F.coalesce("k.copy_of", "r.id").alias("copy_of"),
                    F.coalesce("k.n", F.lit(0)).cast("long").alias("n_shingles")))


def _classes(rows: DataFrame, shared: DataFrame, ids: DataFrame, kind: str, similarity: float) -> DataFrame:
    """(id, class_id) of the documents in ``shared`` (bucket, id, central, n), whose texts are in ``rows``."""
    spark, c = rows.sparkSession, F.col
    # Up to so many ids are sent to all executors, so that other texts needn't be shuffled.
    few = ids.count() <= BROADCAST_IDS
    texts = rows.join(F.broadcast(ids) if few else ids, "id").select("id", tokens(c("text")).alias("t"))
    bags = texts.mapInArrow(_bags, f"id {kind}, n bigint, p bigint, q bigint, bag array<bigint>")
    # Of rows with one id, the bag of the text that was signed.
    bags = bags.groupBy("id").agg(F.max(F.struct("n", "p", "q", "bag"))["bag"].alias("bag")).persist()
    class_of = ids.select("id", c("id").alias("class_id"))

    def linked(class_of: DataFrame, links: DataFrame) -> DataFrame:
        if not links.limit(1).count():
            return class_of
        classes = links.join(class_of.select(c("id").alias("a"), c("class_id").alias("ca")), "a").join(
            class_of.select(c("id").alias("b"), c("class_id").alias("cb")), "b")
        joined = merged(spark, classes.select(c("ca").alias("a"), c("cb").alias("b")).where("a != b"))
        return cut(spark, class_of.join(joined, c("class_id") == c("node"), "left").select("id", F.coalesce("least", "class_id").alias("class_id")))

    def with_bags(pairs: DataFrame) -> DataFrame:
        return pairs.join(bags.select(c("id").alias("a"), c("bag").alias("x")), "a").join(bags.select(c("id").alias("b"), c("bag").alias("y")), "b")

    # In each bucket the most central document against all others: overlap, and what the others have beyond the pivot.
    pivots = cut(spark, shared.groupBy("bucket").agg(F.max(F.struct("central", "id"))["id"].alias("pivot")))
    met = cut(spark, shared.join(pivots, "bucket").select("bucket", "id", "n", "pivot"))
    common = F.size(F.array_intersect("x", "y"))
    against = with_bags(met.where("id != pivot").select(c("id").alias("a"), c("pivot").alias("b")).distinct())
    against = cut(spark, against.select(
        c("a").alias("id"), c("b").alias("pivot"), common.alias("over"), F.array_except("x", "y").alias("rest"),
        (common / (F.size("x") + F.size("y") - common) >= similarity).alias("similar")))
    class_of = linked(class_of, against.where("similar").select(c("id").alias("a"), c("pivot").alias("b")))

    # Rows of buckets that hold several classes, once for each pivot.
    here = met.join(class_of, "id")
    mixed = here.groupBy("bucket").agg(F.min("class_id").alias("x"), F.max("class_id").alias("y")).where("x < y").select("bucket")
    here = cut(spark, here.join(mixed, "bucket", "left_semi").select("id", "n", "pivot", "class_id").distinct())
    here = cut(spark, here.join(against.drop("similar"), ["id", "pivot"], "left").select(
        "id", "n", "pivot", "class_id", F.coalesce("over", "n").alias("over"), "rest"))

    def possible(most):
        return most / (c("r.n") + c("q.n") - most) >= similarity

    # What two documents share is in the pivot or in shingles that many have beyond it, at most the smaller of their
    # overlaps with those, or among the rest, where it is counted.
    beyond = here.select("pivot", "id", F.explode("rest").alias("e"))
    held = here.select("pivot", "class_id", F.explode("rest").alias("e")).groupBy("pivot", "e").agg(
        F.count("*").alias("docs"), F.min("class_id").alias("x"), F.max("class_id").alias("y"))
    held = cut(spark, held.where("x < y").select("pivot", "e", "docs"))
    common_held = beyond.join(held.where(c("docs") > RARE), ["pivot", "e"]).groupBy("pivot", "id").agg(F.count("*").alias("more"))
    here = cut(spark, here.join(common_held, ["pivot", "id"], "left").select(
        "id", "n", "pivot", "class_id", (c("over") + F.coalesce("more", F.lit(0))).alias("over")))
    beyond = beyond.join(held.where(c("docs") <= RARE).select("pivot", "e"), ["pivot", "e"])
    beyond = cut(spark, beyond.join(here, ["pivot", "id"]))
    apart = (c("r.id") < c("q.id")) & (c("r.class_id") != c("q.class_id"))
    both = beyond.alias("r").join(beyond.alias("q"), (c("r.pivot") == c("q.pivot")) & (c("r.e") == c("q.e")) & apart)
    counted = both.groupBy("r.pivot", c("r.id").alias("a"), c("q.id").alias("b")).agg(
        (F.count("*") + F.first(F.least("r.over", "q.over"))).alias("most"), F.first(c("r.n") + c("q.n")).alias("sizes"))
    counted = counted.where(c("most") / (c("sizes") - c("most")) >= similarity).select("a", "b")
    inside = here.alias("r").join(here.alias("q"), (c("r.pivot") == c("q.pivot")) & apart & possible(F.least("r.over", "q.over"))).select(
        c("r.id").alias("a"), c("q.id").alias("b"))
    pairs = cut(spark, counted.unionByName(inside).distinct())
    links = cut(spark, with_bags(pairs).where(common / (F.size("x") + F.size("y") - common) >= similarity).select("a", "b"))
    class_of = linked(class_of, links)
    bags.unpersist()
    return class_of


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` whose id is the least of its class, with their own columns."""
    found = near_duplicates(docs, id_col, text_col, similarity)
    least = found.where(F.col("class_id").eqNullSafe(col(id_col))).select(col(id_col).alias("kept_id"))
    return docs.alias("d").join(least.alias("k"), col_of("d", id_col).eqNullSafe(F.col("k.kept_id")), "left_semi")
