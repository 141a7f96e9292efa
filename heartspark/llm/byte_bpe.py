"""Byte-level BPE encoding and decoding with a segment tree per pre-token.

The leaves of the tree are the byte positions of a pre-token. A leaf holds the rank of the pair
that starts there (infinite where none does or the position has been merged away); an inner node
holds the leftmost minimum of its two children. The root thus names the next merge; a merge
changes at most three leaves (the merged symbol, the one it swallowed and its left neighbour),
each updated in logarithmic time.

The different pre-tokens of a stretch of texts are encoded together: those of up to 16 bytes, of up to 32 and of up to 64
have trees of one size each, and a step takes the next merge of every tree that has one left. Longer ones are encoded one by one by the same tree.

Ranks are those of a .tiktoken file: the rank of a pair is the rank of its concatenation, and the
rank is the token's id. A pre-token that is itself in the vocabulary is one token.

Results by definition: null and empty texts have no ids and decode to no bytes; texts of any
length are encoded whole; repeated rows stay repeated; an empty table gives an empty result;
further columns of the input are left out.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .rows import map_text_lists, pick
from .token_count import KEPT_PRETOKENS

NONE = 1 << 60


def read_ranks(tiktoken_file: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, tiktoken_file.splitlines())}


def encode_pretoken(symbols: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one pre-token."""
    if (whole := ranks.get(symbols)) is not None:
        return (whole,)
    n, rank_of = len(symbols), ranks.get
    size = 1 << (n - 1).bit_length()
    part = [symbols[i:i + 1] for i in range(n)]
    after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
    # A node is rank * size + position, so the smaller of two nodes is the leftmost minimum.
    free = NONE * size
    tree = [free] * (2 * size)
    for i in range(n - 1):
        if (r := rank_of(symbols[i:i + 2])) is not None:
            tree[size + i] = r * size + i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a <= b else b

    def put(i: int, rank: int | None) -> None:
        k = size + i
        tree[k] = free if rank is None else rank * size + i
        while k > 1:
            a, b = tree[k], tree[k ^ 1]
            low = a if a <= b else b
            k >>= 1
            if tree[k] == low:
                break
            tree[k] = low

    while (top := tree[1]) < free:
        i = top & (size - 1)
        j = after[i]
        part[i] = own = part[i] + part[j]
        after[i] = k = after[j]
        if k < n:
            before[k] = i
        if tree[size + j] < free:
            put(j, None)
        put(i, rank_of(own + part[k]) if k < n else None)
        if (h := before[i]) >= 0:
            put(h, rank_of(part[h] + own))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[part[i]])
        i = after[i]
    return tuple(ids)


class PairRanks:
    """The rank of each pair of symbols, by their ids, and of each pair of bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.own = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys, found = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    found.append(rank)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys, self.ranks = np.array(keys, np.int64)[order], np.array(found, np.int64)[order]
        self.of_bytes = self.of(np.repeat(self.own, 256), np.tile(self.own, 256)).reshape(256, 256)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """NO_RANK where the vocabulary doesn't have the pair."""
        if not len(self.keys):
            return np.full(len(a), NO_RANK)
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)


NO_RANK = 1 << 40
TOGETHER = (16, 32, 64)  # bytes of pre-tokens that are encoded together, by size of tree
TREES = 1 << 13  # trees at once


def encode_together(pretokens: list[bytes], size: int, pairs: PairRanks) -> list[list[int]]:
    """Ids of pre-tokens of at most ``size`` bytes, a power of two: a segment tree each, in step."""
    m, bits = len(pretokens), size.bit_length() - 1
    n = np.array([len(p) for p in pretokens])
    at = np.arange(size)
    raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pretokens), np.uint8).reshape(m, size)
    alive = at[None, :] < n[:, None]
    part = pairs.own[raw]
    after, before = np.tile(at + 1, (m, 1)), np.tile(at - 1, (m, 1))
    free = NO_RANK << bits
    # A node is rank * size + position, so the smaller of two nodes is the leftmost minimum.
    tree = np.full((m, 2 * size), free)
    leaf = pairs.of_bytes[raw[:, :-1], raw[:, 1:]]
    tree[:, size:2 * size - 1] = np.where(alive[:, 1:] & (leaf < NO_RANK), leaf << bits | at[:-1], free)
    for level in range(bits - 1, -1, -1):
        k = 1 << level
        tree[:, k:2 * k] = np.minimum(tree[:, 2 * k:4 * k:2], tree[:, 2 * k + 1:4 * k:2])
    rows = np.flatnonzero(tree[:, 1] < free)
    while len(rows):
        top = tree[rows, 1]
        i = top & (size - 1)
        j = after[rows, i]
        k = after[rows, j]
        part[rows, i], after[rows, i], alive[rows, j] = top >> bits, k, False
        inner = k < n[rows]
        before[rows[inner], k[inner]] = i[inner]
        h = before[rows, i]
        first = h >= 0
        # The three leaves that change, and then their ancestors, level by level.
        tree[rows, size + j] = free
        right = np.full(len(rows), NO_RANK)
        right[inner] = pairs.of(part[rows[inner], i[inner]], part[rows[inner], k[inner]])
        tree[rows, size + i] = np.where(right < NO_RANK, right << bits | i, free)
        left = pairs.of(part[rows[first], h[first]], part[rows[first], i[first]])
        tree[rows[first], size + h[first]] = np.where(left < NO_RANK, left << bits | h[first], free)
        row, node = np.concatenate([rows, rows, rows[first]]), np.concatenate([i, j, h[first]]) + size
        for _ in range(bits):
            node >>= 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
        rows = rows[tree[rows, 1] < free]
    ids, ends = part[alive].tolist(), np.cumsum(alive.sum(axis=1)).tolist()
    return [ids[a:b] for a, b in zip([0, *ends], ends)]


class Kept(dict):
    """What ``make`` gives for each pre-token, computed when first asked for and kept up to a bound."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, pretoken: str):
        out = self.make(pretoken)
        if len(pretoken) <= 64:
            if len(self) >= KEPT_PRETOKENS:
                self.clear()
            self[pretoken] = out
        return out


class Codec:
    """Encodes texts and decodes ids by one rank file.

    Decoding joins the bytes of the ids one after the other, so for digests what the ids of a
    pre-token decode to is kept together with them.
    """

    def __init__(self, tiktoken_file: bytes, pattern: str):
        ranks = read_ranks(tiktoken_file)
        self.token = {rank: token for token, rank in ranks.items()}
        self.ranks, self.pairs = ranks, PairRanks(ranks)
        self.pretokens = regex.compile(pattern).findall
        self.ids = Kept(lambda pretoken: encode_pretoken(pretoken.encode(), ranks))
        self.said = Kept(lambda pretoken: self.as_said(encode_pretoken(pretoken.encode(), ranks)))

    def as_said(self, ids) -> tuple[str, bytes]:
        """The ids as decimals joined by a space, and the bytes that they decode to."""
        return " ".join(map(str, ids)), self.decode(ids)

    def release(self) -> None:
        """Gives the ids kept for a task's texts back, as other work may follow in the same Python worker."""
        self.ids.clear()

    def prepare(self, split: list[list[str]], kept: Kept, make) -> None:
        """Encodes the pre-tokens of some texts that aren't kept yet, together, and keeps what ``make`` makes of their ids."""
        new = set().union(*split).difference(kept)
        if len(kept) + len(new) > KEPT_PRETOKENS:
            kept.clear()
            new = set().union(*split)
        by_size: dict[int, list[tuple[str, bytes]]] = {size: [] for size in TOGETHER}
        for pretoken in new:
            raw = pretoken.encode()
            if (whole := self.ranks.get(raw)) is not None:
                kept[pretoken] = make((whole,))
            elif len(raw) <= TOGETHER[-1]:
                by_size[next(size for size in TOGETHER if len(raw) <= size)].append((pretoken, raw))
        for size, group in by_size.items():
            for a in range(0, len(group), TREES):
                some = group[a:a + TREES]
                for (pretoken, _), ids in zip(some, encode_together([raw for _, raw in some], size, self.pairs)):
                    kept[pretoken] = make(ids)

    def encode(self, text: str) -> list[int]:
        return self.encoded(self.pretokens(text))

    def encoded(self, pretokens: list[str]) -> list[int]:
        return [*chain.from_iterable(map(self.ids.__getitem__, pretokens))]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def digests(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Number of ids, digest of the ids, digest of the bytes that they decode to."""
        split = [*map(self.pretokens, texts)]
        self.prepare(split, self.said, self.as_said)
        return map(self.digest, split)

    def digest(self, pretokens: list[str]) -> tuple[int, str, str]:
        said = [*map(self.said.__getitem__, pretokens)]
        ids = " ".join(map(itemgetter(0), said))
        decoded = b"".join(map(itemgetter(1), said))
        return (ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
                hashlib.sha256(decoded).hexdigest())

    def round_trips(self, texts: list[str]) -> Iterator[tuple[list[int], int, bool]]:
        """Ids, their number, whether they decode to the text."""
        split = [*map(self.pretokens, texts)]
        self.prepare(split, self.ids, tuple)
        for text, pretokens in zip(texts, split):
            ids = self.encoded(pretokens)
            yield ids, len(ids), self.decode(ids) == text.encode()


_CODECS: dict[int, Codec] = {}


def _codec(key: int, tiktoken_file: bytes, pattern: str) -> Codec:
    """Built once per Python worker and rank file."""
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(tiktoken_file, pattern)
    return _CODECS[key]


def _run(df: DataFrame, tiktoken_file: bytes, pattern: str, id_col: str, text_col: str, fields, method: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(tiktoken_file)
    key = hash((tiktoken_file, pattern))
    out = map_text_lists(pick(df, id=id_col, text=text_col), fields, lambda: getattr(_codec(key, shared.value, pattern), method))
    return out.withColumnRenamed("id", id_col)


def encode(df: DataFrame, tiktoken_file: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, n_tokens, exact) of every row; ``exact``: the ids decode to the text.

    ``tiktoken_file`` holds the bytes of the rank file, which the driver sends to each executor once.
    """
    return _run(df, tiktoken_file, pattern, id_col, text_col, [
        ("ids", "array<int>", pa.list_(pa.int32())), ("n_tokens", "long", pa.int64()), ("exact", "boolean", pa.bool_())], "round_trips")


def encode_digests(df: DataFrame, tiktoken_file: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encodes and decodes, returns digests instead of the ids and bytes."""
    return _run(df, tiktoken_file, pattern, id_col, text_col, [
        ("n_tokens", "long", pa.int64()), ("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())], "digests")


def decode(df: DataFrame, tiktoken_file: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded): the bytes of each row's ids; null ids give no bytes, an unknown id is an error."""
    shared = df.sparkSession.sparkContext.broadcast(tiktoken_file)

    def run(batches):
        token = {rank: t for t, rank in read_ranks(shared.value).items()}
        for batch in batches:
            out = [b"".join(map(token.__getitem__, ids or ())) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["id", "decoded"])

    ship_package(df.sparkSession)
    source = pick(df, id=id_col, ids=ids_col)
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, decoded binary").withColumnRenamed("id", id_col)
