"""Byte-level BPE encoding and decoding with a rank queue over a hierarchical bitmap.

Each match of the split pattern is merged separately. Its parts are a linked list over byte positions.
For every merge rank there is a bucket of the positions whose pair has that rank; a two-level bitmap
marks the buckets that are not empty, so finding the first set bit gives the next rank whatever the
number of parts. Entries whose pair has changed since are skipped. A pre-token of n bytes takes about n
queue steps, which keeps very long ones cheap. Short ones that were not met before share a queue, their
lists lying side by side, and are remembered.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, types as T

from tidegauge.llm.rows import Carried, own
from tidegauge.llm.tokens import claim_memory, offsets, text_slices

CACHE_WORDS = 200_000  # most words between spaces whose ids a worker remembers
CACHE_PIECES = 800_000  # and most pre-tokens
CACHE_LENGTH = 64  # longest word remembered, in characters
BLOCK_BYTES = 16_000  # pre-tokens that share a queue, unless one alone is longer


class BytePairs:
    """The merges of a rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ranks must be below 65536")
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.pairs = {
            left << 16 | right: rank
            for piece, rank in ranks.items()
            for cut in range(1, len(piece))
            if (left := ranks.get(piece[:cut])) is not None and (right := ranks.get(piece[cut:])) is not None
        }
        self.below = [0] * 256  # second level of the bitmap, empty between calls
        self.pieces = _Remembered(CACHE_PIECES)
        self.words = _Remembered(CACHE_WORDS)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(piece)
        return np.frombuffer(self._merged([piece])[0], "<u4").tolist() if whole is None else [whole]

    def _merged(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens that are not empty, through one queue, four bytes each.

        ``top`` has a bit for each word of ``below`` that is not 0, and those have a bit for each rank
        with a bucket: the lowest bit of each gives the lowest rank. Its positions merge from left to
        right, until one of them makes a pair of a lower rank.
        """
        pair, below, buckets, top = self.pairs.get, self.below, {}, 0
        ids = [self.single[b] for b in b"".join(pieces)]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n))
        current = [pair(a << 16 | b, -1) for a, b in zip(ids, ids[1:])]
        current.append(-1)
        end, starts = 0, []
        for piece in pieces:  # each list ends where its pre-token does
            starts.append(end)
            before[end] = -1
            end += len(piece)
            after[end - 1], current[end - 1] = n, -1
        for i, rank in enumerate(current):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    high = rank >> 8
                    below[high] |= 1 << (rank & 255)
                    top |= 1 << high
        while top:
            high = (top & -top).bit_length() - 1
            word = below[high]
            rank = high << 8 | (word & -word).bit_length() - 1
            bucket = buckets.pop(rank)
            below[high] = word = word & (word - 1)
            if not word:
                top &= top - 1
            bucket.sort()
            least, left_over = rank, iter(bucket)
            for i in left_over:
                if current[i] != rank:
                    continue  # stale: one of the two parts has changed since
                ids[i] = rank
                gone = after[i]
                current[gone] = ids[gone] = -1
                after[i] = right = after[gone]
                if right < n:
                    before[right] = i
                    current[i] = new = pair(rank << 16 | ids[right], -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(i)
                        else:
                            buckets[new] = [i]
                            high = new >> 8
                            below[high] |= 1 << (new & 255)
                            top |= 1 << high
                            if new < least:
                                least = new
                else:
                    current[i] = -1
                left = before[i]
                if left >= 0:
                    current[left] = new = pair(ids[left] << 16 | rank, -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(left)
                        else:
                            buckets[new] = [left]
                            high = new >> 8
                            below[high] |= 1 << (new & 255)
                            top |= 1 << high
                            if new < least:
                                least = new
                if least < rank:  # a lower rank goes first; the rest of this bucket waits
                    rest = list(left_over)
                    if rest:
                        buckets[rank] = rest
                        below[rank >> 8] |= 1 << (rank & 255)
                        top |= 1 << (rank >> 8)
        out = np.array(ids)
        kept = out >= 0
        edges = (4 * offsets(np.add.reduceat(kept, starts, dtype=np.int64))).tolist()
        data = out[kept].astype("<u4").tobytes()
        return [data[a:b] for a, b in zip(edges[:-1], edges[1:])]

    def _learn(self, pieces: set[str]) -> None:
        """Make all pre-tokens known."""
        known, block, size = self.pieces, [], 0
        asked = known.missing(pieces)
        for k, piece in enumerate(asked):
            data = piece.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(data)
            if whole is not None:
                known[piece] = whole.to_bytes(4, "little")
            else:
                block.append((piece, data))
                size += len(data)
            if block and (size >= BLOCK_BYTES or k == len(asked) - 1):
                merged = self._merged([data for _, data in block])
                known.update(zip((piece for piece, _ in block), merged))
                block, size = [], 0

    def _split(self, word: str):
        """The pattern's matches in a word with a space before it."""
        core = word.rstrip(_MARKS)
        if core.isalpha():  # letters, and then at most one run of marks
            return (" " + core, word[len(core) :]) if len(core) < len(word) else (" " + core,)
        return self.split(" " + word)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts, little-endian, four bytes each."""
        parts = [word_parts(t) if t else ("", []) for t in texts]
        asked = self.words.missing({w for _, spaced in parts for w in spaced})
        split = {w: self._split(w) for w in asked}
        firsts = [self.split(first) for first, _ in parts]
        self._learn({p for own in (*split.values(), *firsts) for p in own})
        piece, word = self.pieces.__getitem__, self.words.__getitem__
        self.words.update((w, b"".join(map(piece, own))) for w, own in split.items())
        out = [b"".join(map(piece, own)) + b"".join(map(word, spaced)) for own, (_, spaced) in zip(firsts, parts)]
        self.words.forget_long()
        self.pieces.forget_long()
        return out

    def ids(self, text: str) -> bytes:
        """Ids of a whole text."""
        return self.encode([text])[0]


_MARKS = ".,;:!?"
_ODD = re.compile(r" (?:\s|\Z)")
_LOOSE = re.compile(r" (?=\S)")


def word_parts(text: str) -> tuple[str, list[str]]:
    """The text up to the first word that has a space before it, and those words without the space.

    A space before a character that is not white space always starts a new match of a byte-level split
    pattern, so a text can be taken word by word, each word with its space.
    """
    words = _LOOSE.split(text) if _ODD.search(text) else text.split(" ")
    return words[0], words[1:]


class _Remembered(dict):
    """Results for short words; those not asked for in a long time are forgotten."""

    def __init__(self, most: int):
        self.most, self.old, self.long = most // 2, {}, []

    def missing(self, words: set[str]) -> list[str]:
        """Those of the words that are not known; the others stay known until this is asked again."""
        new = words.difference(self)
        if len(self) + len(new) > self.most:
            self.old = dict(self)
            self.clear()
            new = words
        found = {w: self.old[w] for w in new if w in self.old}
        self.update(found)
        new = new.difference(found)
        self.long = [w for w in new if len(w) > CACHE_LENGTH]
        return list(new)

    def forget_long(self) -> None:
        for word in self.long:
            self.pop(word, None)
        self.long = []


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """The rank file as Spark reads it: its size is bounded by the vocabulary."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def _ranks(content: bytes) -> dict[bytes, int]:
    lines = (line.split() for line in content.splitlines() if line.strip())
    return {base64.b64decode(piece): int(rank) for piece, rank in lines}


@lru_cache(1)
def _loaded(content: bytes, pattern: str) -> BytePairs:
    return BytePairs(_ranks(content), pattern)


@lru_cache(1)
def _tokens(content: bytes) -> dict[int, bytes]:
    return {rank: piece for piece, rank in _ranks(content).items()}


def _encode(batches, shared, pattern: str, restore: bool = False) -> Iterator[pa.RecordBatch]:
    claim_memory("merges", _loaded.cache_clear)
    pairs = _loaded(shared.value, pattern)
    for batch in text_slices(batches, "text"):
        texts = batch.column("text").to_pylist()
        ids = pairs.encode(texts)
        if restore:
            for text, decoded in zip(texts, _decoded(ids, _tokens(shared.value))):
                if decoded != (text or "").encode("utf-8", "surrogatepass"):
                    raise ValueError(f"a text does not come back from its ids: {text[:80]!r}")
        yield pa.record_batch([batch.column("row"), pa.array(ids, pa.binary())], names=["row", "ids"])


def _decoded(encoded: list[bytes | None], token: dict[int, bytes]) -> Iterator[bytes]:
    """The bytes that the ids of each text stand for."""
    for ids in encoded:
        yield b"".join(map(token.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def _decode(batches, shared) -> Iterator[pa.RecordBatch]:
    token = _tokens(shared.value)
    for batch in text_slices(batches, "ids"):
        decoded = list(_decoded(batch.column("ids").to_pylist(), token))
        yield pa.record_batch(
            [*batch.columns, pa.array(decoded, pa.binary())], names=[*batch.schema.names, "decoded"]
        )


def encode(
    docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None, restore: bool = False
) -> DataFrame:
    """The columns ``keep`` (all by default) with ``ids``: the whole text's token ids, as
    little-endian unsigned 32-bit integers in a binary value. A column called ids is replaced; others may
    have any name.

    Special tokens are ordinary text. Null and empty texts give no ids; one very long run of
    characters is merged like any other. Rows are independent: repeated rows give equal ids, and an
    empty table gives an empty result.

    With ``restore`` all ids are decoded again beside their texts, as ``decode`` does it, and a text that does
    not come back from them byte by byte is an error.
    """
    carried = Carried(docs, keep, ("ids",))
    rows = docs.select(carried.packed, own(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(docs.sparkSession, path))
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.BinaryType())])
    return rows.mapInArrow(lambda it: _encode(it, shared, pattern, restore), schema).select(*carried.columns(), "ids")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode`` with ``decoded``, the bytes that their ids stand for; null ids give none."""
    carried = Carried(encoded, None, ("decoded",))
    rows = encoded.select(carried.packed, "ids")
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(encoded.sparkSession, path))
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())])
    return rows.mapInArrow(lambda it: _decode(it, shared), schema).select(*carried.columns(), "decoded")
