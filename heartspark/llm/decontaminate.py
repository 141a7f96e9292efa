"""Benchmark decontamination by spaced-seed hashing.

A mask is a pattern of token positions that count and positions that are ignored. Every window of
a text is hashed once for each mask, from the tokens at the counting positions only, so a window
with substituted tokens still meets its original under a mask that ignores them. Hashes of the
benchmark items are joined to those of the documents; around each hit the tokens of both sides are
aligned, and the hit is verified if some stretch of ``stretch`` aligned tokens (the whole item if
it is shorter) has ``least_share`` of them equal and a seed's window overlaps it.

Tokens are runs of letters and digits in lower case, compared by 64-bit hash.

The benchmark is broadcast if its seeds and tokens are counted to be within stated bounds. Then
windows of documents are hashed, joined and verified in one pass over the texts without a shuffle.
A larger benchmark is joined by shuffling document hashes (without the texts), and the tokens of
documents with hits are joined back for the same verification.

Of a stretch of 13 tokens the masks meet every pattern of substitutions that verification accepts. Items of fewer
tokens than a stretch have masks of their own, as long as the item: cut into one part more, or two more, than it may have substitutions,
some choice of parts that a mask counts is always whole. (Their lengths are read from the benchmark; texts are hashed for these only.)

Results by definition: null and empty texts have no tokens and no hits, items without tokens can't be found; items of up to
four tokens are found word for word, of five to nine with one substitution, of ten to twelve with two; of items with the same tokens
the one with the least id stands for all (``classes`` tells which); repeated document rows are
one document; documents of one id and different texts count together; a null document id is an id,
items without an id are left out; an empty table on either side gives an empty result; further columns are left out.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import col, col_of, cut, let, pick, text_or_empty

#: Fixed masks of weight 6 and span 9: 1 counts, 0 is ignored.
MASKS = ("111110001", "101011011", "111001101")
SPAN = len(MASKS[0])
#: The benchmark is broadcast up to so many seeds and tokens (of 24 and 8 bytes).
MOST_SEEDS, MOST_TOKENS = 2_000_000, 8_000_000


def tokens(text: Column) -> Column:
    """Hashes of the tokens in order."""
    found = F.filter(F.split(F.lower(text_or_empty(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(found, lambda w: F.xxhash64(w))


def seeds(t: Column, masks: tuple[str, ...] = MASKS) -> Column:
    """Hashes of all windows under the first mask, then under the next; none for texts shorter than the span."""
    def under(t: Column, k: int, mask: str) -> Column:
        counting = [i for i, c in enumerate(mask) if c == "1"]
        return F.transform(F.sequence(F.lit(0), F.size(t) - len(mask)), lambda at: F.xxhash64(F.lit(k), *[F.get(t, at + i) for i in counting]))

    return let(t, lambda t: F.when(F.size(t) < len(masks[0]), F.array().cast("array<bigint>")).otherwise(
        F.concat(*[under(t, k, m) for k, m in enumerate(masks)])))


def masks_of(n: int, least_share: float) -> list[list[int]]:
    """Positions that count, for items of ``n`` tokens: whichever tokens are substituted that ``least_share`` allows, some mask misses them."""
    allowed = int(n * (1 - least_share) + 1e-9)
    parts = {0: 1, 1: 3, 2: 4}.get(allowed, allowed + 1)
    parts = min(parts, n)
    part = [i * parts // n for i in range(n)]
    return [[i for i in range(n) if part[i] in kept] for kept in combinations(range(parts), max(1, parts - allowed))]


def short_seeds(t: Column, lengths: list[int], least_share: float) -> Column:
    """(n, seed, pos) of all windows of these lengths under the masks of each."""
    def under(t: Column, n: int, k: int, counting: list[int]) -> Column:
        return F.when(F.size(t) >= n, F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(t) - n)), lambda at: F.struct(
            F.lit(n).alias("n"), F.xxhash64(F.lit(-n), F.lit(k), *[F.get(t, at + i) for i in counting]).alias("seed"), at.alias("pos")))).otherwise(
            F.array().cast("array<struct<n:int,seed:bigint,pos:int>>"))

    return let(t, lambda t: F.concat(*[under(t, n, k, m) for n in lengths for k, m in enumerate(masks_of(n, least_share))]))


def around(t: Column, at: Column, stretch: int, span: int | Column) -> Column:
    """The tokens that stretches over the window at ``at`` can reach: all that verification needs of a text, however long."""
    low = F.greatest(F.lit(0), at - (stretch - 1))
    return F.slice(t, low + 1, at + span + stretch - 1 - low)


def best_overlap(near: Column, item: Column, at: Column, item_at: Column, stretch: int, span: int | Column) -> Column:
    """Most equal tokens in a stretch of the alignment that overlaps the seed's window, as a share of the stretch.

    ``near``: what around() gives; ``at`` and ``item_at``: the window's start in the document and in the item.
    """
    length = F.least(F.lit(stretch), F.size(item))
    first = F.least(at, F.lit(stretch - 1))  # the window's start in ``near``
    shift = first - item_at
    low = F.greatest(first - length + 1, shift, F.lit(0))
    high = F.least(first + span - 1, shift + F.size(item) - length, F.size(near) - length)
    same = F.transform(F.sequence(low, high + length - 1), lambda p: (F.get(near, p) == F.get(item, p - shift)).cast("int"))

    def most(equal: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), high - low), lambda s: F.aggregate(F.slice(equal, s + 1, length), F.lit(0), lambda a, x: a + x))
        return F.array_max(sums)

    return F.when(high < low, F.lit(0.0)).otherwise(let(same, most) / length)


def classes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, class_id): items with the same tokens share the least of their ids."""
    items = pick(benchmark, item_id=id_col, text=text_col).withColumn("item", tokens(F.col("text")))
    key = F.sha2(F.to_json(F.struct("item")), 256)
    items = items.select("item_id", key.alias("key")).distinct()
    return items.join(items.groupBy("key").agg(F.min("item_id").alias("class_id")), "key").select("item_id", "class_id")


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
             item_text_col: str = "text", masks: tuple[str, ...] = MASKS, stretch: int = 13, least_share: float = 0.8,
             most_seeds: int = MOST_SEEDS, most_tokens: int = MOST_TOKENS) -> DataFrame:
    """(id, item_id, n_hits, share) of documents and items with a verified overlap: the number of
    verified seed hits and the largest share of equal tokens of a stretch."""
    spark, span, c = docs.sparkSession, len(masks[0]), F.col
    items = pick(benchmark, item_id=item_id_col, text=item_text_col).select("item_id", tokens(F.col("text")).alias("item"))
    items = cut(spark, items.where((F.size("item") > 0) & c("item_id").isNotNull()).groupBy("item").agg(F.min("item_id").alias("item_id")))
    rows = pick(docs, id=id_col, text=text_col).select("id", tokens(F.col("text")).alias("t"))
    sizes = items.groupBy(F.least(F.size("item"), F.lit(max(stretch, span))).alias("n")).agg(F.sum(F.size("item")).alias("size")).collect()
    size = {r["n"]: r["size"] for r in sizes}  # by length below a stretch, and of all longer items
    least = max(stretch, span)
    lengths = sorted(n for n in size if n < least)

    def long_seeds(rows: DataFrame, *keep: str) -> DataFrame:
        # The array is made in a step of its own: the compiled explode and join then pass over it without copying "t" for each seed.
        found = rows.withColumns({"windows": F.size("t") - (span - 1), "seeds": seeds(c("t"), masks)})
        # (An outer explode, as Spark would compute the array once more for a filter on its size.)
        found = found.select(*keep, "windows", F.posexplode_outer("seeds").alias("k", "seed")).where("seed is not null")
        return found.select(*keep, "seed", F.pmod("k", "windows").alias("pos"))

    def seeds_of_short(rows: DataFrame, *keep: str) -> DataFrame:
        every = short_seeds(c("t"), lengths, least_share)
        # Of an item, the windows that are the whole of it.
        found = rows.withColumn("seeds", F.filter(every, lambda s: s["n"] == F.size("t")) if "item" in rows.columns else every).select(*keep, F.explode_outer("seeds").alias("s")).where("s is not null")
        return found.select(*keep, c("s.seed").alias("seed"), c("s.pos").alias("pos"))

    def verified(exploded, own: DataFrame, span: int | Column, n_seeds: int, n_tokens: int) -> DataFrame:
        item_seeds = exploded(own.withColumn("t", c("item")), "item_id").withColumnRenamed("pos", "item_pos").distinct()
        hit = [c("id"), c("item_id"), c("pos"), c("item_pos")]
        reach = F.lit(least) if isinstance(span, Column) else span
        if n_seeds <= most_seeds and n_tokens <= most_tokens:
            # Compiled into one pass: of a text only the tokens around its hits leave it.
            hits = exploded(rows, "id", "t").join(F.broadcast(item_seeds), "seed").select(*hit, around(c("t"), c("pos"), stretch, reach).alias("near"))
            hits = hits.join(F.broadcast(own), "item_id")
        else:
            met = exploded(rows, "id").join(item_seeds, "seed").select("id", "item_id", "pos", "item_pos").distinct()
            texts = rows.withColumnRenamed("id", "doc").distinct()
            hits = met.join(texts, c("id").eqNullSafe(c("doc"))).select(*hit, around(c("t"), c("pos"), stretch, reach).alias("near")).join(own, "item_id")
        share = best_overlap(c("near"), c("item"), c("pos"), c("item_pos"), stretch, span)
        return hits.select("id", "item_id", "pos", "item_pos", share.alias("share")).where(c("share") >= least_share)

    n_long = size.get(least, 0)
    found = verified(long_seeds, items.where(F.size("item") >= least), span, len(masks) * n_long, n_long)
    if lengths:
        n_masks = sum(len(masks_of(n, least_share)) * size[n] // n for n in lengths)
        found = found.unionByName(verified(seeds_of_short, items.where(F.size("item") < least), F.size("item"), n_masks, sum(size[n] for n in lengths)))
    return found.groupBy("id", "item_id").agg(
        F.countDistinct("pos", "item_pos").alias("n_hits"), F.max("share").alias("share")).withColumnRenamed("id", id_col)


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` without a verified overlap, with their own columns."""
    found = overlaps(docs, benchmark, id_col, **options).select(col(id_col).alias("found")).distinct()
    return docs.alias("d").join(found.alias("k"), col_of("d", id_col).eqNullSafe(F.col("k.found")), "left_anti")
