"""Token counts by heap-and-linked-list byte-pair merging.

Each pre-token starts as a doubly linked list of its bytes. A heap holds (rank, position) of the
adjacent pairs that a merge rule names; the lowest rank, leftmost first, is popped and merged and
the two new pairs around it are pushed. Entries that an earlier merge has overtaken are
recognised because the pair now at their position has another rank, and are skipped. The count
is initial symbols minus merges; no identifiers are made.

The merge rules come from a byte-level BPE file of the tokenizers library. Added tokens of that
file that stand in a text count as one token each, as is the library's default.

Results by definition: null and empty texts have 0 bytes and 0 tokens; texts of any length are
counted whole; rows repeated in the input are repeated in the result; an empty table gives an
empty result; further columns of the input are left out.
"""

from __future__ import annotations

import heapq
import json
import re

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import pick, map_texts

#: Pre-tokens counted last time are kept for other texts of the same Python worker, up to so many.
KEPT_PRETOKENS = 500_000


def byte_of_symbol() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for bytes: visible Latin-1
    characters stand for themselves, the other bytes for U+0100 onwards."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def merge_ranks(vocabulary: str) -> dict[tuple[bytes, bytes], int]:
    """Rank of each pair of byte strings that a merge rule joins."""
    byte = byte_of_symbol()
    pairs = (m.split(" ") if isinstance(m, str) else m for m in json.loads(vocabulary)["model"]["merges"])
    return {tuple(bytes(map(byte.__getitem__, s)) for s in pair): rank for rank, pair in enumerate(pairs)}


def added_tokens(vocabulary: str) -> list[str]:
    """Contents of added tokens, longest first; options that widen a match aren't supported."""
    added = json.loads(vocabulary).get("added_tokens", [])
    if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens with single_word, lstrip, rstrip or normalized aren't supported")
    return sorted((t["content"] for t in added), key=len, reverse=True)


def merged_count(symbols: bytes, ranks: dict[tuple[bytes, bytes], int]) -> int:
    """Tokens left of ``symbols`` when no more rule applies."""
    n = len(symbols)
    part = [symbols[i:i + 1] for i in range(n)]
    heap = [(rank, i) for i, pair in enumerate(zip(part, part[1:])) if (rank := ranks.get(pair)) is not None]
    if not heap:
        return n
    heapq.heapify(heap)
    after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
    pop, push, rank_of = heapq.heappop, heapq.heappush, ranks.get
    left = n
    while heap:
        rank, i = pop(heap)
        own = part[i]
        if own is None or (j := after[i]) == n or rank_of((own, part[j])) != rank:
            continue
        part[i] = own = own + part[j]
        part[j] = None
        left -= 1
        after[i] = j = after[j]
        if j < n:
            before[j] = i
            if (r := rank_of((own, part[j]))) is not None:
                push(heap, (r, i))
        if (h := before[i]) >= 0 and (r := rank_of((part[h], own))) is not None:
            push(heap, (r, h))
    return left


class Counts(dict):
    """Tokens by pre-token, computed when first asked for."""

    def __init__(self, ranks: dict[tuple[bytes, bytes], int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, pretoken: str) -> int:
        n = merged_count(pretoken.encode(), self.ranks)
        if len(pretoken) <= 64:
            if len(self) >= KEPT_PRETOKENS:
                self.clear()
            self[pretoken] = n
        return n


_COUNTERS: dict[int, tuple] = {}


def _counter(key: int, vocabulary: str, pattern: str):
    """Built once per Python worker and vocabulary."""
    if key not in _COUNTERS:
        _COUNTERS.clear()
        added = added_tokens(vocabulary)
        _COUNTERS[key] = (
            Counts(merge_ranks(vocabulary)),
            regex.compile(pattern).findall,
            re.compile("|".join(map(re.escape, added))).split if added else None)
    counts, pretokens, split = _COUNTERS[key]
    look = counts.__getitem__

    def count(text: str) -> tuple[int]:
        if split is None:
            return (sum(map(look, pretokens(text))),)
        parts = split(text)
        return (sum(sum(map(look, pretokens(p))) for p in parts) + len(parts) - 1,)

    return count


def token_counts(df: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.

    ``vocabulary`` is the text of the .json file, ``pattern`` the pre-tokeniser's pattern. The
    driver sends the vocabulary (a fixed file of some MB) to each executor once.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    key = hash((vocabulary, pattern))
    source = pick(df, id=id_col, text=text_col)
    source = source.select("id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    counted = map_texts(source, [("n_tokens", "long", pa.int64())],
                        lambda: _counter(key, shared.value, pattern))
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
