"""Language identification: multinomial naive Bayes over hashed character n-grams.

Text is lower-cased, every run of other characters than letters becomes one space, and each run of
``n`` characters for the given orders is hashed into one of ``2 ** bits`` buckets. Training counts
buckets per language in Spark. The matrix of log-probabilities, whose size the parameters fix, goes to
all tasks; a task holds its texts as sparse rows of bucket numbers and sums the matrix rows of each.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.llm.tokens import claim_memory
from tidegauge.session import Scratch

UNDETERMINED = "und"
ORDERS = (1, 2, 3)
BITS = 16
SAMPLE = 4_000  # expected most training texts of a language; a hash of the id picks them
MAX_LANGUAGES = 256  # with BITS this bounds the matrix to 64 MB
PIECE = 100_000  # characters that one vectorised step takes


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # (buckets + 1) x languages, log-probabilities; the last row is zero
    orders: tuple[int, ...]


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _codes(text: str) -> np.ndarray:
    """Code points of the letters of a text, each run of other characters one space, with a space at
    either end; empty without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.uint32)
    codes = np.where(letter, codes, 32).astype(np.uint32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes = codes[keep]
    edge = np.array([32], np.uint32)
    return np.concatenate([edge[: int(codes[0] != 32)], codes, edge[: int(codes[-1] != 32)]])


def _pieces(texts: list[str | None], longest: int):
    """(text number, code points) in pieces of bounded length that overlap by the longest order."""
    for i, text in enumerate(texts):
        codes = _codes(text) if text else np.empty(0, np.uint32)
        for start in range(0, len(codes), PIECE):
            yield i, codes[max(0, start - longest + 1) : start + PIECE], start > 0


def _grouped(texts, longest):
    held, size = [], 0
    for piece in _pieces(texts, longest):
        held.append(piece)
        size += len(piece[1])
        if size >= PIECE:
            yield held
            held, size = [], 0
    if held:
        yield held


def _features(texts, orders, bits):
    """Yields (text numbers, starts, bucket numbers by order) for bounded parts of the texts.

    Runs that would cross into the next text, or that the piece before has counted, get the number
    after the last bucket.
    """
    for group in _grouped(texts, max(orders)):
        owner = np.array([i for i, _, _ in group])
        codes = np.concatenate([c for _, c, _ in group])
        ends = np.cumsum([len(c) for _, c, _ in group])
        starts = ends - [len(c) for _, c, _ in group]
        again = starts[[x for _, _, x in group]]
        scrambled = (codes + np.uint32(1)) * np.uint32(0x9E3779B1)
        buckets = []
        for order in orders:
            n = len(codes) - order + 1
            rolled = np.full(max(n, 0), order, np.uint32)
            for j in range(order):
                rolled *= np.uint32(0x85EBCA6B)
                rolled += scrambled[j : j + len(rolled)]
            rolled ^= rolled >> np.uint32(15)
            rolled *= np.uint32(0xC2B2AE35)
            bucket = np.full(len(codes), 1 << bits, np.int32)
            bucket[: len(rolled)] = rolled >> np.uint32(32 - bits)
            for j in range(1, order):
                bucket[np.maximum(ends - j, starts)] = 1 << bits
            for j in range(max(orders) - order):
                bucket[again + j] = 1 << bits
            buckets.append(bucket)
        yield owner, starts, buckets


def _count(batches, orders, bits):
    claim_memory("languages", _letters.cache_clear)
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        texts = batch.column("text").to_pylist()
        for lang in np.unique(langs):
            total = sums.setdefault(lang, np.zeros((1 << bits) + 1, np.int64))
            own = [texts[i] for i in np.flatnonzero(langs == lang)]
            for _, _, buckets in _features(own, orders, bits):
                for bucket in buckets:
                    total += np.bincount(bucket, minlength=len(total))
    for lang, total in sums.items():
        hit = np.flatnonzero(total[:-1])
        yield pa.record_batch(
            {"lang": pa.array([lang] * len(hit), pa.string()), "bucket": hit.astype(np.int32), "n": total[hit]}
        )


def train(
    labelled: DataFrame, orders: tuple[int, ...] = ORDERS, bits: int = BITS, sample: int = SAMPLE
) -> Model:
    """Fit on rows (doc_id, text, lang); rows without text or language, or with the tag ``und``, teach
    nothing. Of each language about ``sample`` texts are used, those whose id hashes lowest; all of
    them if there are fewer. Ties in nothing matter: the model depends on sums only."""
    labelled = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").filter(F.col("lang") != UNDETERMINED)
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; the matrix would not be bounded")
    names = tuple(sorted(sizes))
    if not names:
        return Model((), np.zeros(((1 << bits) + 1, 0), np.float32), orders)
    share = F.lit(0.0)
    for lang in names:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / sizes[lang]))).otherwise(share)
    chosen = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * float(1 << 30))
    counts = (
        chosen.select("lang", "text")
        .mapInArrow(lambda it: _count(it, orders, bits), "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()  # at most 2 ** bits rows a language
    )
    matrix = np.zeros((1 << bits, len(names)))
    column = np.searchsorted(np.array(names, object), np.array(counts.column("lang").to_pylist(), object))
    matrix[counts.column("bucket").to_numpy(), column.astype(int)] = counts.column("n").to_numpy()
    matrix = np.log(matrix + 0.5) - np.log((matrix + 0.5).sum(0))
    matrix = np.vstack([matrix, np.zeros(len(names))])  # for runs that do not count
    return Model(names, matrix.astype(np.float32), orders)


def _score(batches, shared):
    claim_memory("languages", _letters.cache_clear)
    model = shared.value
    langs, bits = len(model.languages), (len(model.weights) - 1).bit_length() - 1
    names = np.array([*model.languages, UNDETERMINED], object)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        total = np.zeros((len(texts), langs))
        seen = np.zeros(len(texts), bool)
        for owner, starts, buckets in _features(texts, model.orders, bits) if langs else ():
            rows = model.weights[buckets[0]]
            for bucket in buckets[1:]:
                rows += model.weights[bucket]
            np.add.at(total, owner, np.add.reduceat(rows, starts, axis=0, dtype=np.float64))
            seen[owner] = 1
        best = total.argmax(1) if langs else np.zeros(len(texts), int)
        if langs:
            odds = np.exp(total - total.max(1, keepdims=True))
            score = np.where(seen, odds.max(1) / odds.sum(1), 0.0)
        else:
            score = np.zeros(len(texts))
        yield pa.record_batch(
            [
                *(batch.column(i) for i in range(batch.num_columns - 1)),
                pa.array(names[np.where(seen, best, langs)], pa.string()),
                pa.array(score),
            ],
            names=[*batch.schema.names[:-1], "lang_pred", "score"],
        )


def predict(docs: DataFrame, model: Model, text: str | Column = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` with lang_pred and score, the posterior of the predicted language.

    Equal posteriors go to the language first by name. Null texts and texts without a letter, and all
    texts if the model knows no language, are ``und`` with score 0. Whole texts count, whatever their
    length. Rows that repeat get equal answers; an empty table gives an empty result.
    """
    text = F.col(text) if isinstance(text, str) else text
    rows = docs.select(*keep, text.alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(lambda it: _score(it, shared), f"{fields}, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """The documents that no model may learn from: one in four by a checksum of the id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, learnt from those not held out.

    A document with a null id is not held out and is used for training like any other; null tags
    teach nothing.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
        held_out(id_col).alias("held_out"),
    )
    model = train(rows.filter("NOT held_out"))
    return predict(rows, model, keep=("doc_id", "held_out"))


def reject_unclear(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """All documents but those without a recognisable language: no letter, or a posterior under
    ``least``. Columns and rows are kept as they are; equal texts share their fate."""
    scratch = Scratch(docs.sparkSession, "languages")
    found = identify(docs).filter(F.col("score") < least).select("doc_id").distinct()
    unclear = scratch.table(found.filter("doc_id IS NOT NULL"), "unclear")
    return docs.join(unclear, "doc_id", "left_anti")
