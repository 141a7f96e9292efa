"""Language identification with bitmask filters of n-grams.

A bit-sliced Bloom filter has one slot per hash position and in each slot one bit per language, so
one lookup of an n-gram (the bitwise and of its slots) gives all languages that contain it. A text
is decided by counting, for each language, the n-grams whose lookup has the language's bit, less
those that the language's filter answers by chance: with a share f of the slots set, k hash
functions answer for a share f^k of the n-grams that they haven't been given.

N-grams are four letters, one of which may be a word boundary at either end, and one-letter words
with both boundaries. A language contains an n-gram if its share of the language's n-grams is at
least a part of the largest share that any language has of it.

Learning counts n-grams in each task, adds them up in a shuffle and sets bits in another; only the
slots come to the driver, at most 2^22 of them whatever the corpus.

Results by definition: texts that are null or have no letter get ``und`` and score 0, as does any
text if nothing was learned; a text none of whose n-grams is known gets the language with the most
n-grams in training, score 0; ties go to the language first in alphabetical order; texts of any
length are counted whole; each row has a result row; an empty table gives an empty result; further
columns of the input are left out.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .rows import pick

#: Code points looked at together; longer texts are cut into such pieces, which overlap by an n-gram.
PIECE = 1 << 20
SPACE, BREAK = 32, 0
HASHES = 4
MOST_SLOTS = 1 << 22
BITS = 62  # languages in one integer of a slot

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """By code point, whether it is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def points(text: str) -> np.ndarray:
    """Code points of the lower-case text, with a space for each character that is no letter, and one at each end."""
    p = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    return np.where(letters()[p], p, np.uint32(SPACE))


def grams(p: np.ndarray) -> np.ndarray:
    """Hashes of the n-grams in code points where texts are parted by BREAK, and 0 where none starts."""
    n = len(p)
    if n < 4:
        p = np.concatenate([p, np.zeros(4 - n, np.uint32)])
    word = p > SPACE
    a, b, c, d = (p[i:len(p) - 3 + i].astype(np.uint64) for i in range(4))
    inner = word[1:-2] & word[2:-1] & (a != BREAK) & (d != BREAK)
    single = (a == SPACE) & word[1:-2] & (c == SPACE)
    h = mix(((a << np.uint64(42)) ^ (b << np.uint64(21)) ^ c) + mix(np.where(inner, d, np.uint64(1 << 40))))
    return np.where(inner | single, h | np.uint64(1), np.uint64(0))


def pieces(texts: list[str | None]):
    """(indexes of texts, their starts, code points) of some PIECE code points each."""
    where, starts, parts, size = [], [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        p = points(text)
        for at in range(0, max(1, len(p) - 3), PIECE):
            part = p[at:at + PIECE + 3]
            where.append(i)
            starts.append(size)
            parts += [part, np.zeros(3, np.uint32)]
            size += len(part) + 3
            if size >= PIECE:
                yield where, starts, np.concatenate(parts)
                where, starts, parts, size = [], [], [], 0
    if where:
        yield where, starts, np.concatenate(parts)


@dataclass(frozen=True)
class Filter:
    """``slots``: by position and integer of languages, the bits set. ``rates``: by language, the share answered by chance."""

    languages: list[str]
    totals: list[int]
    slots: np.ndarray
    rates: np.ndarray = field(repr=False)

    def masks(self, h: np.ndarray) -> np.ndarray:
        """Languages that contain each n-gram."""
        most = np.uint64(len(self.slots) - 1)
        out = None
        for k in range(HASHES):
            got = self.slots[positions(h, k, most)]
            out = got if out is None else out & got
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        counts, n = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        lettered = np.zeros(len(texts), bool)
        for where, starts, p in pieces(texts):
            h = grams(p)
            starts = np.minimum(np.array(starts), len(h) - 1)
            some = h != 0
            masks = self.masks(h)
            masks[~some] = 0
            np.add.at(n, where, np.add.reduceat(some, starts, dtype=np.int64))
            np.logical_or.at(lettered, where, np.logical_or.reduceat(p > SPACE, starts))
            for k in range(len(self.languages)):
                has = masks[:, k // BITS] >> masks.dtype.type(k % BITS) & masks.dtype.type(1)
                np.add.at(counts[:, k], where, np.add.reduceat(has, starts, dtype=np.int64))
        real = np.maximum(0.0, counts - n[:, None] * self.rates) / (1.0 - self.rates)
        best = real.argmax(1) if self.languages else np.zeros(len(texts), int)
        total = real.sum(1)
        usual = int(np.argmax(self.totals)) if self.languages else 0
        langs, scores = [], []
        for i in range(len(texts)):
            if not lettered[i] or not self.languages:
                langs.append("und")
                scores.append(0.0)
            elif total[i] <= 0:
                langs.append(self.languages[usual])
                scores.append(0.0)
            else:
                langs.append(self.languages[best[i]])
                scores.append(float(min(1.0, real[i, best[i]] / total[i])))
        return langs, scores


def positions(h: np.ndarray, k: int, most: np.uint64) -> np.ndarray:
    """The k-th slot of each n-gram."""
    return ((h >> np.uint64(11)) + np.uint64(k) * (h >> np.uint64(37) | np.uint64(1)) & most).astype(np.int64)


def count_grams(rows: DataFrame) -> DataFrame:
    """(lang, h, n) of the n-grams in ``rows`` (lang, text), added up per task and language."""
    def run(batches):
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for _, _, p in pieces(texts):
                    h = grams(p)
                    h, n = np.unique(h[h != 0], return_counts=True)
                    if lang in held:
                        both = np.concatenate([held[lang][0], h])
                        h, at = np.unique(both, return_inverse=True)
                        n = np.bincount(at, np.concatenate([held[lang][1], n]), len(h)).astype(np.int64)
                    held[lang] = h, n
                    if len(h) > PIECE:
                        del held[lang]
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(h), pa.string()), pa.array(h.view(np.int64)), pa.array(n)], names=["lang", "h", "n"])
        for lang, (h, n) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(h), pa.string()), pa.array(h.view(np.int64)), pa.array(n)], names=["lang", "h", "n"])

    ship_package(rows.sparkSession)
    return rows.mapInArrow(run, "lang string, h bigint, n bigint").groupBy("lang", "h").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", part: float = 0.1, least: int = 2) -> Filter:
    """The filter of all rows with a language and a text.

    A language contains an n-gram that it has ``least`` times or more, at a share of at least
    ``part`` of the largest share of any language.
    """
    rows = pick(docs, lang=lang_col, text=text_col).where("lang is not null and text is not null")
    counts = count_grams(rows).persist()
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        counts.unpersist()
        return Filter([], [], np.zeros((1, 1), np.int64), np.zeros(0))
    words = -(-len(languages) // BITS)
    index = F.create_map(*[F.lit(x) for k, lang in enumerate(languages) for x in (lang, k)])
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, 1.0 / totals[lang])])
    rated = counts.select("h", "n", index[F.col("lang")].alias("k"), (F.col("n") * share[F.col("lang")]).alias("x"))
    by_gram = rated.groupBy("h").agg(F.collect_list(F.struct("k", "n", "x")).alias("all"), F.max("x").alias("top"))
    member = by_gram.select("h", F.explode(F.filter("all", lambda s: (s["n"] >= least) & (s["x"] >= part * F.col("top")))).alias("s"))
    # As many slots as keep the filter sparse, up to the most; beyond, more is answered by chance, which predict() takes off.
    grams_in = member.select("h").distinct().count()
    size = 1 << min(MOST_SLOTS.bit_length() - 1, max(10, (16 * max(1, grams_in) - 1).bit_length()))
    bit = F.expr(f"shiftleft(1L, s.k % {BITS})")

    def slot(k: int) -> Column:
        step = F.shiftrightunsigned("h", 37).bitwiseOR(F.lit(1))
        return (F.shiftrightunsigned("h", 11) + k * step).bitwiseAND(F.lit(size - 1))

    bits = member.select(F.explode(F.array(*[slot(k) for k in range(HASHES)])).alias("at"), F.floor(F.col("s.k") / BITS).alias("w"), bit.alias("b"))
    table = bits.groupBy("at", "w").agg(F.bit_or("b").alias("b")).toArrow()
    counts.unpersist()
    slots = np.zeros((size, words), np.int64)
    slots[table["at"].to_numpy(), table["w"].to_numpy()] = table["b"].to_numpy()
    filled = np.array([np.mean(slots[:, k // BITS] >> (k % BITS) & 1) for k in range(len(languages))])
    if words == 1:
        slots = slots.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if np.iinfo(t).bits >= len(languages)))
    return Filter(languages, [totals[x] for x in languages], slots, np.minimum(filled ** HASHES, 0.999))


def predict(df: DataFrame, learned: Filter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of each row. The filter, some MB at most, goes to each executor once."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(learned)

    def run(batches):
        for batch in batches:
            langs, scores = shared.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["id", "lang_pred", "score"])

    source = pick(df, id=id_col, text=text_col)
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2
