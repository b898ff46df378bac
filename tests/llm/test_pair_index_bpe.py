"""BPE by an index of pairs: against the public library and an exact round trip."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.helpers import DOCS, SF
from tidegauge.llm import pair_index_bpe as bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
with open(PATH, encoding="utf-8") as file:
    CONTENT = file.read()
LIBRARY = Tokenizer.from_str(CONTENT)  # as it comes: strings of special tokens are special tokens
VOCABULARY = bpe.Vocabulary(CONTENT)


def plain(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def odd_texts():
    rng = random.Random(3)
    alphabet = ["a", "a", "e", "t", "h", " ", " ", "\n", "'s", "'LL", "7", "é", "漢", "😀", "́", "\x00", "　", "_", "<|endoftext|>", "<|"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(500)]
    runs = ["a" * 7, "a" * 30_001, "ab" * 9_000, " " * 5000, "the" * 5000, "\t\r\n" * 50]
    return texts + runs + ["", None, "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "same words", "same words"]


def coded(encoder, texts):
    return [np.frombuffer(ids, "<i4").tolist() for ids in encoder.encode(texts)]


def test_equals_the_library_in_one_piece_and_one_by_one():
    texts = odd_texts()
    expected = [plain(t) for t in texts]
    assert coded(bpe.Encoder(VOCABULARY), texts) == expected
    one_by_one = bpe.Encoder(VOCABULARY)
    assert [coded(one_by_one, [t])[0] for t in texts] == expected
    assert all(len(w) <= bpe.CACHE_LENGTH for w in one_by_one.known if w not in VOCABULARY.added)


def test_what_is_forgotten_does_not_change_ids(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 20)
    texts, encoder = odd_texts(), bpe.Encoder(VOCABULARY)
    for k in range(0, len(texts), 3):
        assert coded(encoder, texts[k : k + 3]) == [plain(t) for t in texts[k : k + 3]]
    assert len(encoder.known) < 500


def test_overlapping_pairs_merge_from_the_left():
    """A made-up file: ab before aa, so that runs of equal letters meet every order of positions."""
    letters = bpe.byte_letters()
    merges = [["a", "a"], ["aa", "aa"], ["a", "b"], ["aa", "ab"], ["b", "aa"]]
    vocab = {c: k for k, c in enumerate([*letters, *("".join(m) for m in merges)])}
    model = {"type": "BPE", "vocab": vocab, "merges": merges}
    level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    content = json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
        "pre_tokenizer": level, "post_processor": None, "decoder": level, "model": model,
    })
    library, rng = Tokenizer.from_str(content), random.Random(1)
    texts = ["".join(rng.choice("aaab ") for _ in range(rng.randrange(60))) for _ in range(300)]
    expected = [e.ids for e in library.encode_batch(texts)]
    assert coded(bpe.Encoder(bpe.Vocabulary(content)), texts) == expected
    with pytest.raises(ValueError, match="merges before"):
        bpe.Vocabulary(content.replace('["a", "a"], ["aa", "aa"]', '["aa", "aa"], ["a", "a"]'))
    with pytest.raises(ValueError, match="normalizer"):
        bpe.Vocabulary(content.replace('"normalizer": null', '"normalizer": {"type": "NFC"}'))


def test_operator_on_odd_rows(spark):
    rows = [(i, t, "en", None, 0) for i, t in enumerate(odd_texts())] + [(None, "no id", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumns(
        {"row": F.lit("r"), "c0": F.lit(1), "a.b": F.lit(2.5), "ids": F.lit("gone"), "decoded": F.lit("gone")}
    ).repartition(5)
    out = bpe.decode(bpe.encode(docs, f"file://{PATH}"), f"file://{PATH}")
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "c0", "a.b", "ids", "decoded"]
    found = out.collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.ids, r.decoded) == (plain(r.text), r.text or "")
        assert (r.row, r.c0, r["a.b"]) == ("r", 1, 2.5)
    assert bpe.decode(bpe.encode(docs.limit(0), f"file://{PATH}"), f"file://{PATH}").count() == 0


def test_decoding_of_any_ids(spark):
    rng = random.Random(8)
    rows = [[rng.randrange(50_257) for _ in range(rng.randrange(12))] for _ in range(200)] + [[], [50_256, 5], [99_999, 3]]
    df = spark.createDataFrame([(r,) for r in rows] + [(None,), ([None, 7],)], "ids array<int>").coalesce(1)
    for skip in (False, True):
        got = [r.decoded for r in bpe.decode(df, f"file://{PATH}", skip_special=skip).collect()]
        assert got[:-2] == [LIBRARY.decode(r, skip_special_tokens=skip) for r in rows]
        assert got[-2:] == [None, LIBRARY.decode([7])]


def test_query(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op11_pair_index_bpe"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc in docs:
        ids, r = plain(doc.text), got[doc.doc_id]
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
