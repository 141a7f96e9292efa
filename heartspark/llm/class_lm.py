"""Scoring texts with a class-based n-gram model (Brown classes).

Words are put into classes so that the classes of neighbouring words tell as much of each other as
possible; a text's probability is the product over its tokens of P(class | class of the token before)
and P(word | class). Tokens are words between blanks, A-Z in lower case, and an end after the last;
an end also stands before the first.

Counting: each task packs its texts into chunks, that is lists of the chunk's different words and of the tokens as
positions in them, and the chunks are written once. Word counts are sums over chunks. Words with at least a share
of 1 / 2^17 of all training tokens, at most 2^17 of them whatever the corpus, are frequent; they and their
classes are the only word lists that leave a shuffle.

Classes, by exchange: the neighbour counts of frequent words (all others being one word of a class of its
own) are summed in a shuffle. In each round a task takes words of its groups one by one out of their class and puts each
where the class bigrams' log-likelihood is greatest, moving the counts as it goes; other groups' moves of the round are
seen in the next. Half of the words may move in a round, the groups are fixed by word, and the best round's
classes are kept, so classes don't depend on how many tasks there are. Each other word then goes to the class with the greatest gain to first order,
from all its neighbours' classes in all chunks, which meet by word in a shuffle. That shuffle's results (count
and class) go back to the chunks by chunk, so scoring needs no word list of the corpus in one place.

Probabilities: P(class | class before) are counts with the classes' own shares added as SMOOTHING tokens. A word that
training doesn't have has the Good-Turing share of training's single words, whatever is before it; all else is scaled by the rest.

Results by definition: null and empty texts are one end token; texts of any length are counted whole; a word of over 64 bytes
is told by its SHA-256; documents without an id train; without training tokens each score is 0;
ties in the exchange go to the first class; each row has a result row; an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import hashlib
import uuid
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import scratch_path, ship_package
from .rows import col, cut, summed, text_or_empty

END = b"\n"  # no word holds a blank
LONG_WORD = 64
CHUNK_TOKENS = 1 << 21
FREQUENT = 1 << 17
CLASSES = 64  # the last one begins as that of all words that aren't frequent
GROUPS = 16
ROUNDS, GAIN = 16, 1e-4
SMOOTHING = 20.0
ENTRY = np.dtype([("at", "<i4"), ("cls", "<i4"), ("n", "<i8")])


class Numbered(dict):
    """Numbers words in the order of their first look-up."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def key_of(word: bytes) -> bytes:
    return word if len(word) <= LONG_WORD else b" " + hashlib.sha256(word).digest()


def packed(numbers: np.ndarray) -> bytes:
    """32-bit integers, equal bytes of all together, compressed."""
    return pa.compress(np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(pa.decompress(raw, 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, -1).T).view("<i4").ravel()


def binaries(parts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary values of ``sizes`` entries each, one after the other in ``parts``."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]) * parts.dtype.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(parts.tobytes())]).cast(pa.binary())


def _chunks(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tokens, ids, train, lengths, uid = Numbered(), array("i"), [], [], [], None

        def out() -> pa.RecordBatch:
            seq = np.frombuffer(tokens, np.int32)
            counts = np.bincount(seq[np.repeat(train, lengths)], minlength=len(words))
            return pa.RecordBatch.from_arrays([
                pa.array([uid], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([train], pa.list_(pa.bool_())), pa.array([lengths], pa.list_(pa.int32())),
                pa.array([packed(seq)], pa.binary()), pa.array([[key_of(w) for w in words]], pa.list_(pa.binary())), pa.array([counts], pa.list_(pa.int64()))],
                names=["chunk", "ids", "train", "lengths", "tokens", "words", "counts"])

        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for part, i, t, text in zip(batch.column("part").to_pylist(), batch.column("id").to_pylist(), batch.column("train").to_pylist(), texts):
                uid = part << 32 if uid is None else uid
                said = text.lower().split()
                said.append(END)
                tokens.extend(map(words.__getitem__, said))
                ids.append(i)
                train.append(t)
                lengths.append(len(said))
                if len(tokens) >= CHUNK_TOKENS:
                    yield out()
                    uid += 1
                    words, tokens, ids, train, lengths = Numbered(), array("i"), [], [], []
        if ids:
            yield out()

    return run


def chunks_of(docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> DataFrame:
    """Texts as chunks, written to the shared folder."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(col(id_col).alias("id"), (~F.coalesce(held_out, F.lit(False))).alias("train"), text_or_empty(col(text_col)).alias("text"), F.spark_partition_id().cast("long").alias("part"))
    kind = rows.schema["id"].dataType
    path = scratch_path(spark, f"class-lm-{uuid.uuid4().hex}")
    rows.mapInArrow(_chunks(to_arrow_type(kind)), f"chunk bigint, ids array<{kind.simpleString()}>, train array<boolean>, lengths array<int>, "
                    "tokens binary, words array<binary>, counts array<bigint>").write.parquet(path)
    return spark.read.parquet(path)


@dataclass
class Corpus:
    """Sums over the training texts, and the frequent words in order of their counts."""
    n: int  # tokens
    v: int  # different ones
    singles: int
    words: dict[bytes, int]
    counts: np.ndarray


def corpus_of(chunks: DataFrame, frequent: int = FREQUENT) -> Corpus:
    each = F.explode(F.arrays_zip("words", "counts"))
    counts = chunks.select(each.alias("x")).select(F.col("x.words").alias("w"), F.col("x.counts").alias("n")).where("n > 0").groupBy("w").agg(F.sum("n").alias("n"))
    counts = cut(chunks.sparkSession, counts)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.count_if(F.col("n") == 1).alias("singles")).first()
    # At most ``frequent`` words have such a share, and the end.
    often = counts.where((F.col("n") * frequent >= total["n"]) | (F.col("w") == F.lit(END))).collect()
    often = sorted(((bytes(r["w"]), r["n"]) for r in often), key=lambda r: (-r[1], r[0]))
    return Corpus(total["n"], total["v"], total["singles"], {w: k for k, (w, _) in enumerate(often)}, np.array([n for _, n in often], np.int64))


def numbers_of(words: list[bytes], known: dict[bytes, int], other: int) -> np.ndarray:
    return np.fromiter((known.get(w, other) for w in words), np.int64, len(words))


def with_before(tokens: np.ndarray, end: int) -> np.ndarray:
    """The token before each; texts stand one after the other, each with its end."""
    return np.concatenate([[end], tokens[:-1]]) if len(tokens) else tokens


def pair_counts(chunks: DataFrame, corpus: Corpus) -> DataFrame:
    """(a, b, n): how often frequent word b follows a in training texts; the number after the last word stands for all others."""
    shared = chunks.sparkSession.sparkContext.broadcast(corpus.words)
    rare = len(corpus.words)

    def merge(codes: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        found, at = np.unique(np.concatenate(codes), return_inverse=True)
        return found, np.bincount(at, weights=np.concatenate(sums), minlength=len(found)).astype(np.int64)

    def batch_of(codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array((codes // (rare + 1)).astype(np.int32)), pa.array((codes % (rare + 1)).astype(np.int32)), pa.array(n)], names=["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, sums = [], []
        for batch in batches:
            for r in batch.to_pylist():
                now = numbers_of(r["words"], shared.value, rare)[unpacked(r["tokens"], sum(r["lengths"]))]
                code = (with_before(now, shared.value.get(END, rare)) * (rare + 1) + now)[np.repeat(r["train"], r["lengths"])]
                found, n = np.unique(code, return_counts=True)
                codes.append(found)
                sums.append(n)
                if sum(map(len, codes)) > 1 << 22:
                    x, n = merge(codes, sums)
                    codes, sums = [x], [n]
                    if len(x) > 1 << 21:
                        yield batch_of(x, n)
                        codes, sums = [], []
        if codes:
            yield batch_of(*merge(codes, sums))

    return chunks.select("words", "tokens", "lengths", "train").mapInArrow(run, "a int, b int, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


def neighbours(pairs: DataFrame, rare: int) -> DataFrame:
    """(g, w, sides, words, n): each frequent word's followers (side 1) and forerunners (side 0), 2^18 at most."""
    both = F.explode(F.array(F.struct(F.col("a").alias("w"), F.lit(1).alias("side"), F.col("b").alias("v")),
                             F.struct(F.col("b").alias("w"), F.lit(0).alias("side"), F.col("a").alias("v"))))
    rows = pairs.select(both.alias("x"), "n").select("x.*", "n").where(F.col("w") < rare)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            change = np.flatnonzero(np.diff(table["w"].to_numpy()))
            last = int(change[-1]) + 1 if len(change) else 0
            if last:
                yield of(table.slice(0, last))
            rest = table.slice(last).combine_chunks()
        if rest is not None and rest.num_rows:
            yield of(rest)

    def of(table: pa.Table) -> pa.RecordBatch:
        w = table["w"].to_numpy()
        starts = np.flatnonzero(np.diff(w, prepend=-1))
        sizes = np.diff(starts, append=len(w))
        lists = [binaries(table[name].to_numpy().astype(t), sizes) for name, t in (("side", np.int8), ("v", np.int32), ("n", np.int64))]
        return pa.RecordBatch.from_arrays([pa.array((w[starts] % GROUPS).astype(np.int32)), pa.array(w[starts]), *lists], names=["g", "w", "side", "v", "n"])

    rows = rows.withColumn("g", F.col("w") % GROUPS).repartition("g").sortWithinPartitions("g", "w", "side", "v").drop("g")
    return cut(pairs.sparkSession, rows.mapInArrow(run, "g int, w int, side binary, v binary, n binary"))


def lists_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    for g, w, side, v, n in zip(*[c.to_pylist() for c in batch.columns]):
        yield g, w, np.frombuffer(side, np.int8), np.frombuffer(v, np.int32), np.frombuffer(n, np.int64)


def x_log_x(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(m: np.ndarray) -> float:
    """Log-likelihood of class bigram counts, but for what no class changes."""
    return float(x_log_x(m).sum() - x_log_x(m.sum(axis=0)).sum() - x_log_x(m.sum(axis=1)).sum())


class Exchange:
    """Class bigram counts that follow words from class to class."""

    def __init__(self, m: np.ndarray):
        self.m, self.f = m.copy(), x_log_x(m)
        self.rows, self.cols = m.sum(axis=1), m.sum(axis=0)

    def shift(self, k: int, before: np.ndarray, after: np.ndarray, own: float, sign: int) -> None:
        """Puts a word into class ``k``, or takes it out: its counts by class of forerunners and followers, and of itself after itself."""
        self.m[k] += sign * after
        self.m[:, k] += sign * before
        self.m[k, k] += sign * own
        self.f[k], self.f[:, k] = x_log_x(self.m[k]), x_log_x(self.m[:, k])
        self.rows += sign * before
        self.cols += sign * after
        self.rows[k] += sign * (after.sum() + own)
        self.cols[k] += sign * (before.sum() + own)

    def gains(self, before: np.ndarray, after: np.ndarray, own: float) -> np.ndarray:
        """By class, what the likelihood gains by a word that is in none, but for what is the same in all."""
        a, b = np.flatnonzero(after), np.flatnonzero(before)
        gain = (x_log_x(self.m[:, a] + after[a]) - self.f[:, a]).sum(axis=1) + (x_log_x(self.m[b] + before[b][:, None]) - self.f[b]).sum(axis=0)
        at = np.diagonal(self.m)  # counted as two entries above, and is one
        gain += x_log_x(at + after + before + own) - x_log_x(at + after) - x_log_x(at + before) + x_log_x(at)
        rows, cols = self.rows + before, self.cols + after
        r, c = after.sum() + own, before.sum() + own
        return gain - x_log_x(rows + r) + x_log_x(rows) - x_log_x(cols + c) + x_log_x(cols)

    def move(self, now: int, before: np.ndarray, after: np.ndarray, own: float, free: int) -> int:
        """Moves a word from its class to the best of the first ``free`` ones, if that is better."""
        self.shift(now, before, after, own, -1)
        gain = self.gains(before, after, own)
        new = int(np.argmax(gain[:free]))
        new = new if gain[new] > gain[now] else now
        self.shift(new, before, after, own, 1)
        return new


def class_counts(lists: DataFrame, classes: np.ndarray, k: int, n: int) -> np.ndarray:
    """Class bigram counts of ``n`` tokens; ``classes`` by frequent word, and of all others at the end."""
    def part(batch: pa.RecordBatch) -> np.ndarray:
        m = np.zeros(k * k, np.int64)
        for _, w, side, v, n in lists_of(batch):
            # A pair of frequent words is in the list of either; the one of its first is taken.
            use = (side == 1) | (v == len(classes) - 1)
            a, b = np.where(side == 1, classes[w], classes[v]), np.where(side == 1, classes[v], classes[w])
            m += np.bincount((a * k + b)[use], weights=n[use], minlength=k * k).astype(np.int64)
        return m

    m = summed(lists, part, k * k, np.int64).reshape(k, k).astype(float)
    m[-1, -1] += n - m.sum()  # what no frequent word is part of
    return m


def exchanged(lists: DataFrame, classes: np.ndarray, m: np.ndarray, turn: int) -> np.ndarray:
    """Classes after a round, in which every other word of a group may move."""
    k, other = len(m), len(classes) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own, state = None, None, None
        for batch in batches:
            moved: list[tuple[int, int]] = []
            for g, w, side, v, n in lists_of(batch):
                if g != group:
                    group, own, state = g, classes.copy(), Exchange(m)
                if (w // GROUPS + turn) % 2:
                    continue
                alone = v == w
                by_class = np.bincount(own[v[~alone]] + k * side[~alone], weights=n[~alone], minlength=2 * k)
                new = state.move(int(own[w]), by_class[:k], by_class[k:], float(n[alone & (side == 1)].sum()), k - 1)
                if new != own[w]:
                    own[w] = new
                    moved.append((w, new))
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in moved], pa.int32()), pa.array([c for _, c in moved], pa.int32())], names=["w", "c"])

    found = lists.mapInArrow(run, "w int, c int").toArrow()  # FREQUENT rows at most
    new = classes.copy()
    new[found["w"].to_numpy()] = found["c"].to_numpy()
    assert new[other] == k - 1
    return new


def frequent_classes(chunks: DataFrame, corpus: Corpus, k: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the frequent words, and of all others at the end, and their bigram counts."""
    rare = len(corpus.words)
    lists = neighbours(pair_counts(chunks, corpus), rare)
    classes = np.append(np.arange(rare) % (k - 1), k - 1)
    m = class_counts(lists, classes, k, corpus.n)
    best, since = (likelihood(m), classes, m), 0
    for turn in range(ROUNDS):
        classes = exchanged(lists, classes, m, turn)
        m = class_counts(lists, classes, k, corpus.n)
        now = likelihood(m)
        since = 0 if now > best[0] + GAIN * abs(best[0]) / 10 else since + 1
        if now > best[0]:
            best = now, classes, m
        if since == 2:  # neither half of the words gains
            break
    return best[1], best[2]


CONTEXT = np.dtype([("code", "<u2"), ("n", "<u4")])


def _contexts(shared, classes: np.ndarray, k: int):
    """A chunk's words that aren't frequent: count, and neighbours' classes in training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                rare = len(classes) - 1
                number = numbers_of(r["words"], shared.value, rare)
                tokens = unpacked(r["tokens"], sum(r["lengths"]))
                said = classes[number[tokens]]
                at = np.flatnonzero((number[tokens] == rare) & np.repeat(r["train"], r["lengths"]))
                before = with_before(said, classes[shared.value.get(END, rare)])
                code = np.concatenate([tokens[at] * (2 * k) + before[at], tokens[at] * (2 * k) + k + said[at + 1]])
                found, n = np.unique(code.astype(np.int64), return_counts=True)
                entries = np.empty(len(found), CONTEXT)
                entries["code"], entries["n"] = found % (2 * k), n
                own = np.flatnonzero(number == rare)
                sizes = np.bincount(found // (2 * k), minlength=len(number))[own]
                words = batch.column("words")[i].values.take(pa.array(own))
                yield pa.RecordBatch.from_arrays([words, pa.array(np.full(len(own), r["chunk"])), pa.array(own.astype(np.int32)),
                                                  pa.array(np.array(r["counts"], np.int64)[own]), binaries(entries, sizes)], names=["word", "chunk", "at", "n", "contexts"])

    return run


def _placed(m: np.ndarray):
    """Rows sorted by word: each word's count and best class, given back to its chunks."""
    k = len(m)
    smooth = m + 1.0 / k
    by_context = np.log(np.vstack([smooth, smooth.T]))  # a forerunner's class, then a follower's: what each class gains
    rows, cols = np.log(smooth.sum(axis=1)), np.log(smooth.sum(axis=0))

    def of(table: pa.Table) -> pa.RecordBatch:
        words = table["word"].combine_chunks()
        starts = np.flatnonzero(np.concatenate([[True], np.array(pa.compute.not_equal(words[1:], words[:-1]))]))
        group = np.cumsum(np.bincount(starts, minlength=len(words))) - 1
        n = np.add.reduceat(table["n"].to_numpy(), starts)
        blobs = table["contexts"].to_pylist()
        entries = np.frombuffer(b"".join(blobs), CONTEXT)
        of_entry = np.repeat(group, [len(b) // CONTEXT.itemsize for b in blobs])
        seen = np.bincount(of_entry * (2 * k) + entries["code"], weights=entries["n"], minlength=len(starts) * 2 * k).reshape(-1, 2 * k)
        gain = seen @ by_context - np.outer(seen[:, :k].sum(axis=1), cols) - np.outer(seen[:, k:].sum(axis=1), rows)
        best = np.where(n > 0, np.argmax(gain, axis=1), -1)
        chunk = table["chunk"].to_numpy()
        order = np.argsort(chunk, kind="stable")
        back = np.empty(len(order), ENTRY)
        back["at"], back["cls"], back["n"] = table["at"].to_numpy()[order], best[group[order]], n[group[order]]
        firsts = np.flatnonzero(np.concatenate([[True], np.diff(chunk[order]) != 0]))
        return pa.RecordBatch.from_arrays([pa.array(chunk[order][firsts]), binaries(back, np.diff(firsts, append=len(order)))], names=["chunk", "entries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            words = table["word"].combine_chunks()
            change = np.flatnonzero(np.array(pa.compute.not_equal(words[1:], words[:-1])))
            last = int(change[-1]) + 1 if len(change) else 0
            if last:
                yield of(table.slice(0, last))
            rest = table.slice(last).combine_chunks()
        if rest is not None and rest.num_rows:
            yield of(rest)

    return run


DOC = "train boolean, n_tokens bigint, n_known bigint, base_score double, known_log double, classes binary"


def _coded(shared, corpus_counts: np.ndarray, classes: np.ndarray, k: int, n: int, v: int):
    """A chunk's word entries, then the chunk: a row for each text, with sums over its tokens and their classes (``k``: not in training)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: list[bytes] = []
        for batch in batches:
            for i in range(batch.num_rows):
                blob = batch.column("entries")[i].as_py()
                if blob is not None:
                    entries.append(blob)
                    continue
                words, lengths, raw = (batch.column(name)[i].as_py() for name in ("words", "lengths", "tokens"))
                rare = len(classes) - 1
                number = numbers_of(words, shared.value, rare)
                often = number < rare
                count, cls = np.zeros(len(words), np.int64), np.full(len(words), -1)
                count[often], cls[often] = corpus_counts[number[often]], classes[number[often]]
                own = np.frombuffer(b"".join(entries), ENTRY)
                entries = []
                count[own["at"]], cls[own["at"]] = own["n"], own["cls"]
                cls = np.where(cls < 0, k, cls).astype(np.uint8)
                tokens = unpacked(raw, sum(lengths))
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
                base = np.log10((count + 0.5) / (n + 0.5 * (v + 1)))
                known = np.log10(np.maximum(count, 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column("ids")[i].values, batch.column("train")[i].values, pa.array(np.array(lengths, np.int64)),
                    pa.array(np.add.reduceat((count > 0).astype(np.int64)[tokens], starts)), pa.array(np.add.reduceat(base[tokens], starts)),
                    pa.array(np.add.reduceat(known[tokens], starts)), binaries(cls[tokens], np.array(lengths))],
                    names=["id", "train", "n_tokens", "n_known", "base_score", "known_log", "classes"])

    return run


def sequences(batch: pa.RecordBatch, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of coded texts: classes of all tokens, those before them, and where each text starts."""
    blobs = batch.column("classes").to_pylist()
    said = np.frombuffer(b"".join(blobs), np.uint8).astype(np.int64)
    return said, with_before(said, end), np.concatenate([[0], np.cumsum([len(b) for b in blobs])]).astype(np.int64)


def transitions(m: np.ndarray, n: int, singles: int) -> np.ndarray:
    """log10 of P(class | class before) over the class's tokens, by both classes, the last one being words that training hasn't got."""
    k = len(m) - 1
    if not n:
        return np.zeros((k + 1, k + 1))
    unseen = (singles + 0.5) / (n + 1)
    size = m[:, :k].sum(axis=0)
    share = size / n
    p = np.vstack([(m[:k, :k] + SMOOTHING * share) / (m[:k, :k].sum(axis=1, keepdims=True) + SMOOTHING), share])
    with np.errstate(divide="ignore", invalid="ignore"):
        scaled = np.where(size > 0, np.log10((1 - unseen) * p / size), 0.0)
    return np.hstack([scaled, np.full((k + 1, 1), np.log10(unseen))])


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", k: int = CLASSES, frequent: int = FREQUENT) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of each row; texts that aren't ``held_out`` train.
    ``k``: classes, 255 at most; a word is frequent from the ``frequent``th part of training's tokens on."""
    spark: SparkSession = docs.sparkSession
    chunks = chunks_of(docs, held_out, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    corpus = corpus_of(chunks, frequent)
    shared = spark.sparkContext.broadcast(corpus.words)
    classes, m = frequent_classes(chunks, corpus, k) if corpus.n else (np.array([k - 1]), np.zeros((k, k)))

    rare = chunks.select("chunk", "words", "counts", "tokens", "lengths", "train").mapInArrow(
        _contexts(shared, classes, k), "word binary, chunk bigint, at int, n bigint, contexts binary")
    entries = rare.repartition("word").sortWithinPartitions("word").mapInArrow(_placed(m), "chunk bigint, entries binary")
    whole = chunks.select("chunk", "ids", "train", "lengths", "tokens", "words")
    rows = entries.unionByName(whole, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk", F.col("entries").isNull())
    coded = cut(spark, rows.mapInArrow(_coded(shared, corpus.counts, classes, k, corpus.n, corpus.v), f"id {kind}, {DOC}"))

    end = int(classes[corpus.words.get(END, len(classes) - 1)])

    def pairs(batch: pa.RecordBatch) -> np.ndarray:
        said, before, starts = sequences(batch, end)
        use = np.repeat(batch.column("train").to_numpy(zero_copy_only=False), np.diff(starts))
        return np.bincount((before * (k + 1) + said)[use], minlength=(k + 1) ** 2)

    logs = transitions(summed(coded, pairs, (k + 1) ** 2, np.int64).reshape(k + 1, k + 1).astype(float), corpus.n, corpus.singles)
    n = corpus.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            said, before, starts = sequences(batch, end)
            total = np.add.reduceat(logs[before, said], starts[:-1]) + batch.column("known_log").to_numpy()
            size = batch.column("n_tokens").to_numpy()
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.compute.invert(batch.column("train")), batch.column("n_tokens"), batch.column("n_known"), pa.array(np.full(len(size), n, np.int64)),
                batch.column("base_score"), pa.array(total), pa.array(10 ** np.minimum(300, -total / size))],
                names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return coded.mapInArrow(run, f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, perplexity double"
                            ).withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(col(id_col).cast("string").cast("binary")) % 5 == 1
