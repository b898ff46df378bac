"""Words, shingles and 64-bit hashes of texts, over Arrow batches."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CACHE_WORDS = 250_000  # most words whose hashes a worker remembers
BATCH_BYTES = 1_000_000  # text that one vectorised step takes, unless one text alone is longer

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()
_owner: list = []


def claim_memory(owner: str, clear: Callable[[], None]) -> None:
    """Let one kind of step at a time remember things in this worker, which serves many kinds in turn.

    What the step before remembered is forgotten.
    """
    if not _owner or _owner[0] != owner:
        if _owner:
            _owner[1]()
            gc.collect()
        _owner[:] = [owner, clear]


def words(text: str | None) -> list[bytes]:
    """UTF-8 words between the white space of ASCII, A-Z lower-cased; none for null."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, tokens), _U, len(tokens))


def text_slices(batches, column: str, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of about ``size`` bytes of text each, unless one text alone is longer.

    The column may also hold lists, which count by their entries.
    """
    for batch in batches:
        values = batch.column(column)
        length = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
        sizes = pc.fill_null(length(values), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes.astype(np.int64)) // size
        edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)
        pa.default_memory_pool().release_unused()


def text_chunks(batches, *columns: str) -> Iterator[list[list]]:
    """Columns of the batches as Python lists, the first being text, in pieces of bounded size."""
    for piece in text_slices(batches, columns[0]):
        yield [piece.column(c).to_pylist() for c in columns]


def flat_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in one array, and the number of words of each text."""
    claim_memory("word hashes", _hashes.clear)
    tokens: list[bytes] = []
    counts = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = words(text)
        counts[i] = len(own)
        tokens += own
    return word_hashes(tokens), counts


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, text by text, and how many each text has.

    A text of fewer words, but at least one, has a single shingle, the whole sequence.
    """
    n = len(hashes)
    ends = np.cumsum(counts)
    starts = ends - counts
    rolled = np.zeros(n, _U)
    for j in range(size):
        shifted = hashes[j:]
        rolled[: n - j] = mix(rolled[: n - j] + shifted)
    keep = np.zeros(n, bool)
    numbers = np.maximum(counts - size + 1, 0)
    if n:
        inside = np.arange(n) - np.repeat(starts, counts)
        keep = inside < np.repeat(numbers, counts)
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        value = np.zeros(1, _U)
        for h in hashes[starts[i] : ends[i]]:
            value = mix(value + h)
        rolled[starts[i]] = mix(value + _U(int(counts[i])))[0]
        keep[starts[i]] = True
        numbers[i] = 1
    return rolled[keep], numbers


def distinct(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, ascending, and how many each has."""
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[first], np.bincount(owner[first], minlength=len(counts))


def offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


def segment_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each run of values; 0 for empty runs."""
    out = np.zeros(len(counts), values.dtype)
    full = counts > 0
    if full.any():
        out[full] = np.add.reduceat(values, offsets(counts)[:-1][full])
    return out


def signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def runs(batches, key: str) -> Iterator[pa.Table]:
    """Rows of each key as one table, from batches in which equal keys follow each other."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        edges = [0, *cuts.tolist(), len(values)]
        for a, b in zip(edges[:-1], edges[1:]):
            if held and values[a] != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held_key = values[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
    pa.default_memory_pool().release_unused()
