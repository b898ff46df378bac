"""BPE encoding and decoding with an index from each pair to all its positions.

The distinct pre-tokens of a part of a partition that the worker has not met before lie side by side in
one list of ids. An index gives for every merge rank the positions of its pair, in all of them. Ranks that
have positions are active; they are applied in ascending order, each to all its positions at once, and
every merge enters the two pairs it makes into their own lists. Entries whose pair has changed since are
skipped. So one pass over the active ranks encodes many pre-tokens together, and a very long one costs
no more per byte than short ones. As positions of a pair are far apart, lists longer than a processor's
cache make every step wait for memory; so pre-tokens are taken in blocks of ``BLOCK_BYTES``.

Files are those of the tokenizers library with a byte-level BPE model.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, types as T

from tidegauge.llm.rows import Carried, own
from tidegauge.llm.tokens import claim_memory, offsets, text_slices

CACHE_WORDS = 230_000  # pre-tokens whose ids a worker remembers, and as many again that it may forget next
CACHE_LENGTH = 64  # longest pre-token remembered, in characters
BLOCK_BYTES = 16_000  # pre-tokens that share one index, unless one alone is longer
SLICE_IDS = 500_000  # ids that are decoded together
_IDS = T.ArrayType(T.IntegerType())

# Fixed value: the split pattern that byte-level files mean unless they say otherwise.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: itself where it can be seen, otherwise
    the next one from 256 on."""
    seen = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _refuse(what: str, *bad) -> None:
    if any(bad):
        raise ValueError(f"tokenizer files with {what} are not supported")


class Vocabulary:
    """Ids, merges and added tokens of a tokenizer file."""

    def __init__(self, content: str):
        file = json.loads(content)
        model, split = file["model"], file.get("pre_tokenizer") or {}
        decoder = file.get("decoder") or {}
        _refuse("another model than BPE", model.get("type", "BPE") != "BPE")
        _refuse("a normalizer", file.get("normalizer"))
        _refuse("another split or decoder than the byte-level one",
                split.get("type") != "ByteLevel", decoder.get("type") != "ByteLevel", not split.get("use_regex", True))
        _refuse("a prefix space", split.get("add_prefix_space"))
        _refuse("marks at word ends, byte fallback, dropout or whole words first",
                *(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "byte_fallback",
                                         "dropout", "ignore_merges")))
        letters, vocab = byte_letters(), model["vocab"]
        _refuse("bytes outside the vocabulary", *(c not in vocab for c in letters))
        self.size = max(vocab.values()) + 1
        self.byte_ids = np.empty(256, np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocab[letter]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        sides = np.array([[vocab[a], vocab[b]] for a, b in merges], np.int64).reshape(-1, 2)
        made = [vocab[a + b] for a, b in merges]
        # A list of merges can be applied in ascending order if each merge follows those that make its parts.
        last = np.full(self.size, -1)
        last[made] = np.arange(len(made))
        _refuse("merges before those that make their parts",
                *(last[sides].max(axis=1) >= np.arange(len(made)) if len(made) else ()))
        codes = sides[:, 0] * self.size + sides[:, 1]
        self.rank_of = dict(zip(reversed(codes.tolist()), range(len(codes) - 1, -1, -1)))
        self.made, self.twins = made, (sides[:, 0] == sides[:, 1]).tolist()
        self.order = np.argsort(codes, kind="stable")
        self.codes = codes[self.order]
        self.pieces = {i: bytes(letters[c] for c in piece) for piece, i in vocab.items()}
        self.added, self.special = {}, set()
        for token in file.get("added_tokens") or []:
            _refuse("added tokens that take their surroundings in",
                    token.get("single_word"), token.get("lstrip"), token.get("rstrip"))
            self.added[token["content"]] = token["id"]
            self.pieces[token["id"]] = token["content"].encode("utf-8")
            if token.get("special"):
                self.special.add(token["id"])

    def ranks(self, codes: np.ndarray) -> np.ndarray:
        """Rank of each pair; -1 for those that do not merge."""
        if not len(self.codes):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.order[at], -1)


def merge_all(vocabulary: Vocabulary, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces in one array, and how many each piece has. No piece may be empty."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    start = vocabulary.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    edges = offsets(sizes)
    cuts = [0, *(np.flatnonzero(np.diff(edges[:-1] // BLOCK_BYTES)) + 1).tolist(), len(pieces)]
    blocks = [_merge(vocabulary, start[edges[a] : edges[b]], sizes[a:b]) for a, b in zip(cuts[:-1], cuts[1:]) if a < b]
    if not blocks:
        return start, sizes
    ids, counts = zip(*blocks)
    return np.concatenate(ids), np.concatenate(counts)


def _merge(vocabulary: Vocabulary, start: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for the pieces of one block, given as the ids of their bytes."""
    n = len(start)
    ends = np.cumsum(sizes)
    right, left = np.arange(1, n + 1), np.arange(-1, n - 1)
    right[ends - 1] = -1
    left[ends - sizes] = -1
    pair = np.full(n, -1)
    inner = np.flatnonzero(right >= 0)
    pair[inner] = vocabulary.ranks(start[inner] * vocabulary.size + start[inner + 1])
    # The index: positions in the order of their pair's rank, and where each rank's begin; pairs made
    # later have their positions in ``later``.
    where = inner[pair[inner] >= 0]
    where = where[np.argsort(pair[where], kind="stable")]
    active, first = np.unique(pair[where], return_index=True)
    index = dict(zip(active.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(where)])))
    later: dict[int, list[int]] = {}
    queue = active.tolist()  # ascending, so a heap
    ids, after, before, rank_at = start.tolist(), right.tolist(), left.tolist(), pair.tolist()
    rank_of, size = vocabulary.rank_of.get, vocabulary.size
    while queue:
        rank = heappop(queue)
        positions = later.pop(rank, [])
        if rank in index:
            a, b = index.pop(rank)
            positions = where[a:b].tolist() + positions
        if vocabulary.twins[rank]:
            positions.sort()  # of two that overlap the one further left merges
        new = vocabulary.made[rank]
        base = new * size
        for i in positions:
            if rank_at[i] != rank:
                continue  # one of the two parts has changed since
            gone = after[i]
            ids[gone] = rank_at[gone] = -1
            ids[i] = new
            after[i] = follows = after[gone]
            if follows >= 0:
                before[follows] = i
                rank_at[i] = found = rank_of(base + ids[follows], -1)
                if found >= 0:
                    if found in later:
                        later[found].append(i)
                    else:
                        later[found] = [i]
                        heappush(queue, found)
            else:
                rank_at[i] = -1
            precedes = before[i]
            if precedes >= 0:
                rank_at[precedes] = found = rank_of(ids[precedes] * size + new, -1)
                if found >= 0:
                    if found in later:
                        later[found].append(precedes)
                    else:
                        later[found] = [precedes]
                        heappush(queue, found)
    out = np.array(ids)
    kept = out >= 0
    return out[kept], np.add.reduceat(kept, ends - sizes, dtype=np.int64)


class Encoder:
    """Encodes texts; the ids of pre-tokens met before are remembered."""

    def __init__(self, vocabulary: Vocabulary, pattern: str = PATTERN):
        self.vocabulary = vocabulary
        self.split = regex.compile(pattern).findall
        contents = sorted(vocabulary.added, key=len, reverse=True)
        self.added = regex.compile("(" + "|".join(map(regex.escape, contents)) + ")") if contents else None
        # Texts are cut at added tokens first, so their strings never come up as pre-tokens.
        self.always = {c: np.array([i], "<i4").tobytes() for c, i in vocabulary.added.items()}
        self.known: dict[str, bytes] = dict(self.always)
        self.old: dict[str, bytes] = {}

    def _parts(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.added is None or not self.added.search(text):
            return self.split(text)
        parts: list[str] = []
        for k, stretch in enumerate(self.added.split(text)):
            parts += [stretch] if k % 2 else self.split(stretch)
        return parts

    def _learn(self, words: set[str]) -> list[str]:
        """Make all words known; returns those too long to be remembered."""
        known = self.known
        new = words.difference(known)
        if len(known) + len(new) > CACHE_WORDS:
            self.old, self.known = known, dict(self.always)
            known, new = self.known, words.difference(self.always)
        for word in [w for w in new if w in self.old]:
            known[word] = self.old[word]
            new.discard(word)
        asked = list(new)
        ids, counts = merge_all(self.vocabulary, [w.encode("utf-8", "surrogatepass") for w in asked])
        data, edges = ids.astype("<i4").tobytes(), (4 * offsets(counts)).tolist()
        known.update(zip(asked, (data[a:b] for a, b in zip(edges[:-1], edges[1:]))))
        return [w for w in asked if len(w) > CACHE_LENGTH]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text, little-endian, four bytes each."""
        parts = [self._parts(t) for t in texts]
        long = self._learn(set(chain.from_iterable(parts)))
        get = self.known.__getitem__
        coded = [b"".join(map(get, p)) for p in parts]
        for word in long:
            del self.known[word]
        return coded


@lru_cache(1)
def _vocabulary(content: str) -> Vocabulary:
    return Vocabulary(content)


@lru_cache(1)
def _encoder(content: str, pattern: str) -> Encoder:
    return Encoder(_vocabulary(content), pattern)


def _forget() -> None:
    _encoder.cache_clear()
    _vocabulary.cache_clear()


def _encode(batches, shared, pattern: str) -> Iterator[pa.RecordBatch]:
    claim_memory("pair index", _forget)
    encoder = _encoder(shared.value, pattern)
    for batch in text_slices(batches, "text"):
        coded = encoder.encode(batch.column("text").to_pylist())
        edges = np.cumsum([0, *map(len, coded)]) // 4
        values = pa.array(np.frombuffer(b"".join(coded), "<i4").astype(np.int32, copy=False))
        ids = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), values)
        yield pa.record_batch([batch.column("row"), ids], names=["row", "ids"])


def _decode(batches, shared, skip_special: bool) -> Iterator[pa.RecordBatch]:
    claim_memory("pair index", _forget)
    vocabulary = _vocabulary(shared.value)
    pieces = [b""] * (max(vocabulary.pieces) + 2)  # the last one stands for ids without a token
    for i, piece in vocabulary.pieces.items():
        pieces[i] = b"" if skip_special and i in vocabulary.special else piece
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    for batch in text_slices(batches, "ids", SLICE_IDS):
        ids = batch.column("ids")
        values = ids.flatten()  # without those of null rows
        numbers = values.fill_null(-1).to_numpy(zero_copy_only=False)
        numbers = np.where((numbers >= 0) & (numbers < len(pieces)), numbers, len(pieces) - 1)
        data = b"".join(map(pieces.__getitem__, numbers.tolist()))
        counts = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        edges = offsets(lengths[numbers])[offsets(counts)].tolist()
        missing = ids.is_null().to_pylist()
        decoded = [
            None if gone else data[a:b].decode("utf-8", "replace") for a, b, gone in zip(edges[:-1], edges[1:], missing)
        ]
        yield pa.record_batch(
            [batch.column("row"), ids, pa.array(decoded, pa.string())], names=["row", "ids", "decoded"]
        )


def _shared(spark: SparkSession, tokenizer: str):
    """The tokenizer file, whose size is bounded by the vocabulary, for every task."""
    content = spark.read.format("binaryFile").load(tokenizer).select("content").first()[0]
    return spark.sparkContext.broadcast(bytes(content).decode("utf-8"))


def encode(
    docs: DataFrame, tokenizer: str, text_col: str = "text", keep: list[str] | None = None, pattern: str = PATTERN
) -> DataFrame:
    """The columns ``keep`` (all by default) with ``ids``, the token ids of the whole text as an array.

    Ids are those of the tokenizers library for the file ``tokenizer`` without its post-processing: the
    string of an added token becomes that token. Null and empty texts have no ids, in an empty array; a
    very long run of characters is merged like any other. Rows are independent, so repeated rows have
    equal ids and an empty table gives an empty one. A column called ids is replaced.
    """
    shared, carried = _shared(docs.sparkSession, tokenizer), Carried(docs, keep, ("ids",))
    rows = docs.select(carried.packed, own(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("ids", _IDS)])
    return rows.mapInArrow(lambda it: _encode(it, shared, pattern), schema).select(*carried.columns(), "ids")


def decode(
    encoded: DataFrame, tokenizer: str, ids_col: str = "ids", keep: list[str] | None = None, skip_special: bool = False
) -> DataFrame:
    """The columns ``keep`` (all by default) with ``decoded``, the text that the ids stand for.

    Bytes that are no UTF-8 become U+FFFD; ids without a token and null ids stand for nothing, and a null
    array for a null text. ``skip_special`` leaves special tokens out. A column called decoded is replaced.
    """
    shared, carried = _shared(encoded.sparkSession, tokenizer), Carried(encoded, keep, ("decoded",))
    rows = encoded.select(carried.packed, own(ids_col).cast("array<int>").alias("ids"))
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])
    out = rows.mapInArrow(lambda it: _decode(it, shared, skip_special), schema)
    return out.select(*carried.columns(), "decoded")
