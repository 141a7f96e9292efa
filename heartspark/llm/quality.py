"""Quality rules: plain counts, and divergence from language references.

Plain counts reject very short and very repetitive texts. For the rest, two histograms of each
text, one over character classes and one over common words, are compared with the references of
each language by the Jensen-Shannon distance (base 2, from 0 to 1). A text is rejected if, for
every language, one of the distances is beyond its limit or both are beyond lower limits.

The references are means over all different texts of a language with enough words, taken again
without those that are far from the first means. The common words of a short text scatter by chance, roughly as one over the square root of its words; so
their limit widens by that much, and neither histogram is judged below a number of words.

Results by definition: null and empty texts have no words and fail the plain rules; texts of any
length are counted whole; texts whose language is given but has no reference are judged by the
plain rules alone, and so are all texts where there is no reference; texts without a language are
compared with all references; copies count once in the references; each row has a result row;
an empty table gives an empty result; further columns of the input are left out.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import col, cut, let, pick, text_or_empty

WORD_GAP = r"[\x20\x09-\x0D]+"

#: Common words of each language that has references.
COMMON = {
    "de": "der die und in den das von zu mit ist auf für im ein eine nicht des dem sich als auch es an",
    "en": "the of and in to a is that for it on with as was by are be this or an at from",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más",
    "fr": "de la le et les des en un une du que est pour qui dans sur par au plus pas avec ce se",
}
WORDS = sorted({w for words in COMMON.values() for w in words.split()})


@dataclass(frozen=True)
class Limits:
    least_words: int = 50  # of a kept text
    repeat_percent: int = 50  # of words in repeated windows, at most
    reference_words: int = 50  # of texts that references are made from
    reference_distance: float = 0.2  # from the first means, of texts that references are made from
    judged_words: int = 50  # below this, distances aren't judged
    char_distance: float = 0.21  # either one beyond these rejects
    word_distance: float = 0.32
    both_char: float = 0.165  # or both beyond these
    both_word: float = 0.10
    word_scatter: float = 1.8  # times 1 / sqrt(words), added to limits of the word distance


def split_at(text: Column, other: str) -> Column:
    """Words between blanks, after what ``other`` matches has become blanks. (Splitting at one character needs no regular expression.)"""
    return F.array_remove(F.split(F.regexp_replace(text, other, " "), " "), "")


def words_of(text: Column) -> Column:
    return split_at(text, r"[\x09-\x0D]+")


def n_repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more.

    Windows are sorted as integers: the upper bits of a window's hash, then its position. Equal
    neighbours are then compared word by word; should two different windows share a hash, or a
    text have more words than positions fit, windows are sorted as strings instead.
    """
    bits = 20
    window = lambda w, i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    def covered(twice: Column) -> Column:
        """A repeated window adds the words up to the next one's start, three at most."""
        return let(F.sort_array(twice), lambda at: F.aggregate(
            F.transform(at, lambda i, k: F.least(F.lit(3).cast("long"), F.coalesce(F.get(at, k + 1) - i, F.lit(3).cast("long")))),
            F.lit(0).cast("long"), lambda a, n: a + n))

    def by_string(w: Column, starts: Column) -> Column:
        ordered = F.array_sort(F.transform(starts, lambda i: F.struct(window(w, i).alias("w"), i.cast("long").alias("i"))))
        near = lambda a, k, x: F.coalesce(F.get(a, k)["w"] == x["w"], F.lit(False))
        return let(ordered, lambda a: covered(F.transform(
            F.filter(a, lambda x, k: near(a, k - 1, x) | near(a, k + 1, x)), lambda x: x["i"])))

    def by_hash(w: Column, starts: Column) -> Column:
        key = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(F.lit(-1 << bits)).bitwiseOR(i.cast("long"))
        position = lambda x: x.bitwiseAND(F.lit((1 << bits) - 1)).cast("int")

        def checked(a: Column, again: Column) -> Column:
            """``again``: where in ``a`` a key has the same hash as the one before."""
            clash = F.exists(again, lambda k: window(w, position(F.get(a, k))) != window(w, position(F.get(a, k - 1))))
            both = F.array_distinct(F.flatten(F.transform(again, lambda k: F.array(
                position(F.get(a, k - 1)).cast("long"), position(F.get(a, k)).cast("long")))))
            return F.when(clash, by_string(w, starts)).otherwise(covered(both))

        return let(F.sort_array(F.transform(starts, key)), lambda a: let(
            F.filter(starts, lambda k: F.shiftright(F.get(a, k).bitwiseXOR(F.get(a, k - 1)), bits) == 0), lambda again: checked(a, again)))

    n = F.size(words)
    starts = F.sequence(F.lit(0), n - 3)
    return F.when(n < 3, F.lit(0).cast("long")).when(n < (1 << bits), by_hash(words, starts)).otherwise(by_string(words, starts))


def _removed(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, pattern, "")


#: Character classes after lower-case a-z, each removed from what the ones before have left.
CLASSES = (r"\p{Lu}+", r"[0-9]+", WORD_GAP, r"[.,;:'\"()-]+", r"[!-/:-@\[-`{-~]+")


def counts_of(found: Column) -> Column:
    """How often each of WORDS is in an array, from the runs of the sorted array."""
    def by_run(ordered: Column) -> Column:
        n = F.size(ordered)
        every = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(every, lambda k: ~F.get(ordered, k).eqNullSafe(F.get(ordered, k - 1)))
        return let(starts, lambda at: let(F.transform(at, lambda k: F.get(ordered, k)), lambda heads: F.transform(
            F.lit(WORDS), lambda w: let(F.array_position(heads, w).cast("int"), lambda p: F.when(p == 0, F.lit(0)).otherwise(
                F.coalesce(F.get(at, p), n) - F.get(at, p - 1))))))

    return let(F.sort_array(found), by_run)


def char_counts(text: Column) -> Column:
    """Counts of a-z, of each of CLASSES and of all other characters."""
    def less(left: Column, counts: list[Column], patterns: tuple[str, ...]) -> Column:
        if not patterns:
            return F.array(*counts, F.length(left))
        return let(_removed(left, patterns[0]), lambda rest: less(rest, [*counts, F.length(left) - F.length(rest)], patterns[1:]))

    return less(text, [], ("[a-z]+", *CLASSES))


def word_counts(text: Column, n_words: Column) -> Column:
    """Counts of each of WORDS and of all other words, of ``n_words`` in all."""
    letters = split_at(F.lower(text), r"[^\p{L} ]+")
    return let(F.filter(letters, lambda w: w.isin(WORDS)), lambda found: F.concat(
        counts_of(found), F.array(F.greatest(F.lit(0), n_words.cast("int") - F.size(found)))))


def shares(counts: Column) -> Column:
    return let(counts, lambda each: let(F.aggregate(each, F.lit(0), lambda a, n: a + n), lambda total: F.transform(
        each, lambda n: n.cast("double") / F.greatest(total, F.lit(1)))))


def _sum(terms: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)


def _x_log_x(x: Column) -> Column:
    """x log2 x, 0 at 0 (where Spark's logarithm is null)."""
    return F.coalesce(x * F.log2(x), F.lit(0.0))


def with_sums(p: Column) -> Column:
    """A histogram of shares with what js_distance() needs of it for every reference: its sum and that of x log x."""
    return let(p, lambda x: F.struct(x.alias("p"), _sum(x).alias("mass"), _sum(F.transform(x, _x_log_x)).alias("x_log_x")))


def js_distance(h: Column, q: list[float]) -> Column:
    """Jensen-Shannon distance of a histogram (as of with_sums) from a reference, from sums of x log x of both and of their sum."""
    known = sum(x * log2(x) for x in q if x > 0)
    both = F.aggregate(F.zip_with(h["p"], F.lit(q), lambda a, b: a + b), F.lit(0.0), lambda s, x: s + _x_log_x(x))
    return F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (h["mass"] + sum(q) + h["x_log_x"] + known - both) / 2)))


def _means(rows: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    means = (rows.select("lang", F.posexplode(F.concat("char_shares", "word_shares")).alias("k", "x"))
             .groupBy("lang", "k").agg(F.avg("x").alias("x"))
             .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("k", "x")))["x"].alias("x")).collect())
    n = len(CLASSES) + 2
    return {r["lang"]: (list(r["x"][:n]), list(r["x"][n:])) for r in sorted(means, key=lambda r: r["lang"])}


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", limits: Limits = Limits()) -> dict[str, tuple[list[float], list[float]]]:
    """By language: mean shares of character classes and of common words.

    Means over all texts first, then over those whose character classes are near the first means,
    so that junk hardly shows in them. Only the languages of ``COMMON`` have references, so what
    comes to the driver is a few hundred numbers.
    """
    rows = pick(docs, lang=lang_col, text=text_col).where(F.col("lang").isin(sorted(COMMON)))
    text = text_or_empty(F.col("text"))
    rows = rows.select("lang", F.xxhash64(text).alias("h1"), F.hash(text).alias("h2"), char_counts(text).alias("chars"), let(
        F.size(words_of(text)), lambda n: F.struct(n.alias("n"), word_counts(text, n).alias("common"))).alias("words"))
    rows = rows.dropDuplicates(["lang", "h1", "h2"])
    rows = cut(docs.sparkSession, rows.select("lang", "chars", "words.n", "words.common"))
    rows = rows.where(F.col("n") >= limits.reference_words)
    rows = rows.select("lang", shares(F.col("chars")).alias("char_shares"), shares(F.col("common")).alias("word_shares"))
    first = _means(rows)
    near = F.lit(False)
    for lang, (chars, _) in first.items():
        near = near | ((F.col("lang") == lang) & (js_distance(with_sums(F.col("char_shares")), chars) <= limits.reference_distance))
    return first | _means(rows.where(near))


def plain_counts(text: Column) -> Column:
    """The base columns as a struct."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(words_of(text), lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_removed(text, "[#*$%&|<>]+"))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        n_repeat_words(words).alias("n_repeat_words")))


def excess_of(text: Column, lang: Column, n_words: Column, refs: dict[str, tuple[list[float], list[float]]], limits: Limits) -> Column:
    """By how much the distances are over their limits, for the language where that is least; null for a
    language without a reference, or if there is none at all."""
    scatter = limits.word_scatter / F.sqrt(F.greatest(n_words, F.lit(1)).cast("double"))

    def over(c: Column, w: Column) -> Column:
        return let(F.struct(c.alias("c"), w.alias("w")), lambda d: F.greatest(
            d["c"] - limits.char_distance, d["w"] - limits.word_distance, F.least(d["c"] - limits.both_char, d["w"] - limits.both_word)))

    def of(c: Column, w: Column) -> Column:
        return F.array_min(F.array(*[over(js_distance(c, rc), js_distance(w, rw) - scatter) for rc, rw in refs.values()]))

    if not refs:
        return F.lit(None).cast("double")
    nearest = let(with_sums(shares(char_counts(text))), lambda c: let(with_sums(shares(word_counts(text, n_words))), lambda w: of(c, w)))
    return F.when(lang.isNull() | lang.isin(sorted(refs)), nearest)


def verdict(text: Column, lang: Column, refs: dict[str, tuple[list[float], list[float]]], limits: Limits = Limits()) -> Column:
    """The base columns, ``base_failed``, ``kept`` and ``excess`` as a struct: one expression, in which nothing is computed twice."""
    text = text_or_empty(text)

    def judged(n: Column) -> Column:
        failed = (n["n_words"] < limits.least_words) | (100 * n["n_repeat_words"] > limits.repeat_percent * n["n_words"])
        return let(F.struct(failed.alias("failed"), excess_of(text, lang, n["n_words"], refs, limits).alias("excess")), lambda v: F.struct(
            *[n[k].alias(k) for k in OUT[:5]], v["failed"].alias("base_failed"),
            (~v["failed"] & ~F.coalesce((v["excess"] > 0) & (n["n_words"] >= limits.judged_words), F.lit(False))).alias("kept"),
            v["excess"].alias("excess")))

    return let(plain_counts(text), judged)


OUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "excess")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """(id, counts, base_failed, kept, excess) of each row: one pass for the references, one for the verdicts; texts aren't shuffled."""
    refs = references(docs, text_col, lang_col, limits)
    rows = pick(docs, id=id_col, lang=lang_col, text=text_col)
    rows = rows.select("id", verdict(F.col("text"), F.col("lang"), refs, limits).alias("v"))
    return rows.select(F.col("id").alias(id_col), *[F.col("v")[k].alias(k) for k in OUT])


def keep(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """The kept rows of ``docs``, with their own columns."""
    refs = references(docs, text_col, lang_col, limits)
    return docs.where(verdict(col(text_col), col(lang_col), refs, limits)["kept"])
