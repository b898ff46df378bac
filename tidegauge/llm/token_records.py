"""Token ids as length-delimited binary records, with an offset index.

A record is: length of the body (8 bytes), masked checksum of those 8 bytes (4), body, masked checksum
of the body (4), all little-endian. The checksum is CRC-32; its mask rotates it right by 15 bits and adds
0xA282EAD8, so that a checksum of data that holds checksums stays meaningful. The body is a flag byte
(1: has an id; 2: ids are four bytes wide instead of two), the document's id (8 bytes) and its token ids.

Documents are dealt by ranges of their id and sorted, and each task writes one file, so the files in
order hold the documents in order. The index tells for each record its file, offset and length, for
reads in any order. Files go through pyarrow's file systems: local and shared folders, and the object
stores and HDFS that pyarrow is built for.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from tidegauge.llm.byte_bpe import _MARKS, _ODD, word_parts
from tidegauge.llm.tokens import claim_memory, offsets, text_slices

CACHE_WORDS = 600_000  # words a worker remembers, and as many again that it may forget next
CACHE_TAILS = 10_000  # and runs of marks after them
TOGETHER = 400  # words that go to the tokenizer as one text
_OLD_LETTERS = "\u0530"  # below it every Unicode version has the same letters
SLICE_BYTES = 6_000_000  # text encoded together; each of its words is looked up once
READ_BYTES = 4 << 20
_MASK = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_BODY = struct.Struct("<Bq")
INDEX = "part int, file string, doc_id long, offset long, length long, n_tokens long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(body: bytes) -> bytes:
    length = struct.pack("<Q", len(body))
    return b"".join((length, struct.pack("<I", masked(length)), body, struct.pack("<I", masked(body))))


def unframe(head: bytes) -> int:
    """Length of the body that follows; an error if the head is damaged."""
    length, check = _HEAD.unpack(head)
    if masked(head[:8]) != check:
        raise ValueError("damaged record length")
    return length


def opened(body: bytes, check: bytes) -> tuple[int | None, np.ndarray]:
    """Document id and token ids of a record."""
    if masked(body) != struct.unpack("<I", check)[0]:
        raise ValueError("damaged record")
    flags, doc = _BODY.unpack_from(body)
    ids = np.frombuffer(body, "<u4" if flags & 2 else "<u2", offset=_BODY.size)
    return (doc if flags & 1 else None), ids


class WordEncoder:
    """Encodes texts with a byte-level tokenizer, asking it for each word only once.

    The tokenizer never merges over the start of a word with its space, so the ids of a text are those
    of its words; and after letters a run of marks is a piece of its own. Words not met before go to the
    tokenizer together, as one text, whose ids are cut where a token begins with a space. Texts that hold
    the string of an added token, which the tokenizer treats as that token, go to it whole.
    """

    def __init__(self, content: str):
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size()
        self.wide = size > 1 << 16
        self.kind = "<u4" if self.wide else "<u2"
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.holds_added = re.compile("|".join(map(re.escape, added))).search if added else lambda text: None
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self.known: dict[str, bytes] = {}  # words, with a space before them
        self.old: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}  # runs of marks after letters

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [self._bytes(a.ids) for a in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for k in range(0, len(words), TOGETHER):
            chosen = words[k : k + TOGETHER]
            answer = self.tokenizer.encode_batch_fast([" " + " ".join(chosen)], add_special_tokens=False)[0]
            ids = np.array(answer.ids)
            edges = [*np.flatnonzero(self.begins[ids]).tolist(), len(ids)]
            if len(edges) != len(chosen) + 1:
                raise ValueError("the tokenizer does not begin a token at every word")
            width = np.dtype(self.kind).itemsize
            data = ids.astype(self.kind).tobytes()
            out += [data[width * a : width * b] for a, b in zip(edges[:-1], edges[1:])]
        return out

    def _coded(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, each with a space before it."""
        if len(self.known) > CACHE_WORDS:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        codes = list(map(known.get, words))
        new, parts, asked, loose, tails = [], [], [], [], set()
        for k, code in enumerate(codes):
            if code is not None:
                continue
            word = words[k]
            code = codes[k] = old.get(word)
            if code is not None:
                known[word] = code
                continue
            new.append(k)
            core = word.rstrip(_MARKS)
            if len(core) < len(word) and core.isalpha() and max(core) < _OLD_LETTERS:
                parts.append((word, core, word[len(core) :]))
            elif " " in word:  # with white space at its end
                loose.append(word)
            else:
                asked.append(word)
        if not new:
            return codes
        asked += {core for _, core, _ in parts}.difference(known, asked)
        known.update(zip(asked, self._together(asked)))
        known.update(zip(loose, self._whole([" " + w for w in loose])))
        if len(self.tails) > CACHE_TAILS:
            self.tails = {}
        tails = list({tail for _, _, tail in parts}.difference(self.tails))
        self.tails.update(zip(tails, self._whole(tails)))
        after = self.tails
        known.update([(word, known[core] + after[tail]) for word, core, tail in parts])
        for k in new:
            codes[k] = known[words[k]]
        return codes

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, in two or four bytes each."""
        out = [b""] * len(texts)
        special = [i for i, t in enumerate(texts) if t and self.holds_added(t)]
        for i, coded in zip(special, self._whole([texts[i] for i in special])):
            out[i] = coded
        rest = sorted({i for i, t in enumerate(texts) if t}.difference(special))
        odd = [i for i in rest if _ODD.search(texts[i])]
        regular = sorted(set(rest).difference(odd))
        # Words of regular texts are split and counted off by Arrow, without a Python string for each.
        split = pc.split_pattern(pa.array([texts[i] for i in regular], pa.large_string()), " ")
        starts = split.offsets.to_numpy()
        head = np.zeros(len(split.values), bool)
        head[starts[:-1]] = True
        loose = [word_parts(texts[i]) for i in odd]
        flat = pa.concat_arrays([
            split.values.filter(pa.array(~head)), pa.array([w for _, own in loose for w in own], split.values.type)
        ]).dictionary_encode()
        codes = self._coded(flat.dictionary.to_pylist())
        counts = np.concatenate([np.diff(starts) - 1, [len(own) for _, own in loose]]).astype(np.int64)
        heads = self._whole([*split.values.filter(pa.array(head)).to_pylist(), *(first for first, _ in loose)])
        # One run of ids for all texts: those of every word in turn.
        sizes = np.fromiter(map(len, codes), np.int64, len(codes)) // np.dtype(self.kind).itemsize
        word = flat.indices.to_numpy()
        at = offsets(sizes[word])
        own = np.frombuffer(b"".join(codes), self.kind)
        ids = own[np.repeat(offsets(sizes)[:-1][word] - at[:-1], sizes[word]) + np.arange(at[-1])]
        edges = at[offsets(counts)].tolist()
        for i, first, a, b in zip([*regular, *odd], heads, edges[:-1], edges[1:]):
            out[i] = first + ids[a:b].tobytes()
        return out


@lru_cache(1)
def _encoder(content: str) -> WordEncoder:
    return WordEncoder(content)


def _write(batches, root: str, shared, end: int):
    claim_memory("token records", _encoder.cache_clear)
    encoder = _encoder(shared.value)
    system, base = fs.FileSystem.from_uri(root)
    last = np.array([end], encoder.kind).tobytes()
    part = TaskContext.get().partitionId()
    name = f"part-{part:06d}-{uuid.uuid4().hex}.rec"
    stream, offset = None, 0
    size = np.dtype(encoder.kind).itemsize
    for batch in text_slices(batches, "text", SLICE_BYTES):
        ids = batch.column("doc_id").to_pylist()
        rows = []
        for doc, coded in zip(ids, encoder.encode(batch.column("text").to_pylist())):
            flags = (doc is not None) | 2 * encoder.wide
            record = frame(_BODY.pack(flags, doc or 0) + coded + last)
            if stream is None:
                stream = system.open_output_stream(f"{base}/{name}")
            stream.write(record)
            rows.append((offset, len(record), len(coded) // size + 1))
            offset += len(record)
        if rows:
            offsets, lengths, counts = map(list, zip(*rows))
            yield pa.record_batch(
                {
                    "part": pa.array([part] * len(rows), pa.int32()),
                    "file": [name] * len(rows),
                    "doc_id": pa.array(ids, pa.int64()),
                    "offset": offsets, "length": lengths, "n_tokens": counts,
                }
            )
    if stream is not None:
        stream.close()


def write_records(
    docs: DataFrame, root: str, tokenizer: str, end: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every whole text, append the id ``end``, and write the records under ``root``.

    ``root`` is a URL of a new folder that all executors share; files go to data/, the offset index,
    which is returned, to index/. A task that is tried again writes a new file, and only files that
    the index names count.

    Documents are in ascending order of id, null ids first, equal ids by text. Null and empty texts
    have the end id only. Other columns are not looked at; an empty table gives an empty index.
    """
    spark = docs.sparkSession
    content = bytes(spark.read.format("binaryFile").load(tokenizer).select("content").first()[0]).decode()
    shared = spark.sparkContext.broadcast(content)
    system, base = fs.FileSystem.from_uri(root)
    system.create_dir(f"{base}/data", recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    written = (
        rows.repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(lambda it: _write(it, f"{root}/data", shared, end), INDEX)
    )
    written.write.parquet(f"{root}/index")
    return read_index(spark, root)


def read_index(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{root}/index")


def _scan(batches, root: str):
    system, base = fs.FileSystem.from_uri(root)
    for batch in batches:
        for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
            held, size = [], 0
            with system.open_input_stream(f"{base}/{name}", buffer_size=READ_BYTES) as stream:
                while head := stream.read(_HEAD.size):
                    length = unframe(head)
                    doc, ids = opened(stream.read(length), stream.read(4))
                    held.append((doc, start, len(ids), ids.astype("<u4").tobytes()))
                    start += len(ids)
                    size += len(ids)
                    if size >= 500_000:
                        yield _records(held)
                        held, size = [], 0
            if held:
                yield _records(held)


def _records(held: list[tuple]) -> pa.RecordBatch:
    docs, starts, counts, ids = zip(*held)
    return pa.record_batch(
        {
            "doc_id": pa.array(docs, pa.int64()), "start": pa.array(starts, pa.int64()),
            "n_tokens": pa.array(counts, pa.int64()), "ids": pa.array(ids, pa.binary()),
        }
    )


RECORDS = "doc_id long, start long, n_tokens long, ids binary"


def read_records(spark: SparkSession, root: str) -> DataFrame:
    """All records, read from the files: doc_id, start (ids of all records before), n_tokens, and ids as
    little-endian unsigned 32-bit integers. Damaged records are an error."""
    files = read_index(spark, root).groupBy("part", "file").agg(F.sum("n_tokens").alias("n"))
    # One row per file; the window runs over files, not records.
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = files.withColumn("start", F.coalesce(before, F.lit(0))).select("file", "start")
    n = max(files.count(), 1)
    return files.repartition(n).mapInArrow(lambda it: _scan(it, f"{root}/data"), RECORDS)


def _fetch(batches, root: str):
    system, base = fs.FileSystem.from_uri(root)
    streams: dict[str, object] = {}
    for batch in batches:
        out = []
        for name, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
            if name not in streams:
                if len(streams) >= 64:
                    streams.popitem()[1].close()
                streams[name] = system.open_input_file(f"{base}/{name}")
            data = streams[name].read_at(length, offset)
            unframe(data[: _HEAD.size])
            doc, ids = opened(data[_HEAD.size : -4], data[-4:])
            out.append((doc, None, len(ids), ids.astype("<u4").tobytes()))
        if out:
            yield _records(out)


def fetch_records(index: DataFrame, root: str) -> DataFrame:
    """The records that rows of the index name, in the order of those rows within each partition."""
    rows = index.select("file", "offset", "length")
    return rows.mapInArrow(lambda it: _fetch(it, f"{root}/data"), RECORDS).drop("start")
