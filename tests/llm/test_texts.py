"""Decontamination, language identification and substring dedup."""

import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.helpers import DOCS, SF, by_id, edited, prose, words
from tidegauge.llm import decontaminate as dc, language_id as li, substring_dedup as sd


# -- decontamination ------------------------------------------------------------------------------


def expected_leaks(docs, items, percent=80, size=5):
    def bag(w):
        return collections.Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))

    out = set()
    for item, text in items:
        w = words(text)
        if len(w) < size or item is None:
            continue
        want, where = bag(w), collections.defaultdict(list)
        for i in range(len(w) - size + 1):
            where[tuple(w[i : i + size])].append(i)
        for doc, t in docs:
            d = words(t)
            starts = {max(p - q, 0) for p in range(len(d) - size + 1) for q in where.get(tuple(d[p : p + size]), ())}
            for s in starts:
                have = bag(d[s : s + len(w)])
                if doc is not None and 100 * sum((have & want).values()) >= percent * sum((have | want).values()):
                    out.add((doc, item, s))
    return out


def test_leaks_equal_brute_force(spark):
    rng = random.Random(8)
    items = [(i, prose(rng, n)) for i, n in enumerate((5, 6, 14, 30, 55, 90))]
    items += [(20, "one two"), (21, None), (22, ""), (23, "do re " * 10), (24, items[2][1]), (None, prose(rng, 20))]
    docs = [(100 + i, prose(rng, 60)) for i in range(5)]
    for i, (_, text) in enumerate(items):
        for n in range(3):
            docs.append((200 + 10 * i + n, f"{prose(rng, 9 * n)} {edited(rng, text or 'x', n) } {prose(rng, 7)}"))
    docs += [(1, None), (2, ""), (3, "a b"), (None, items[4][1]), (4, items[4][1].upper()), (4, items[4][1].upper()),
             (5, items[5][1] + " " + prose(rng, 30_000) + " " + items[3][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    found = dc.contaminated(df, bench).collect()
    assert {(r["doc_id"], r["item_id"], r["start"]) for r in found} == expected_leaks(docs, items)
    assert all(0.8 <= r["similarity"] <= 1 and r["distance"] <= dc.RADIUS for r in found)
    kept = dc.remove_contaminated(df, bench)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - {r["doc_id"] for r in found}
    assert dc.contaminated(df.limit(0), bench).collect() == [] == dc.contaminated(df, bench.limit(0)).collect()


def test_items_with_moved_parts_equal_a_search_of_all_windows(spark):
    rng = random.Random(21)
    items = [(1, prose(rng, 59)), (2, prose(rng, 50)), (3, prose(rng, 30))]
    a, b, c = (t.split() for _, t in items)
    texts = [a[10:] + a[:10], b[25:] + b[:25], c[15:] + c[:15], a[30:] + a[:30], edited(rng, " ".join(a), 30).split()]
    docs = [(i, f"{prose(rng, 40)} {' '.join(t)} {prose(rng, 70)}") for i, t in enumerate(texts)]
    docs += [(10, " ".join(texts[0])), (11, f"{docs[0][1]} {' '.join(a)} {docs[1][1]}"), (12, prose(rng, 300))]
    bag = lambda w: collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    every = set()
    for d, t in docs:
        w = words(t)
        for item, text in items:
            want = bag(words(text))
            for s in range(len(w) - 4):
                have = bag(w[s : s + len(words(text))])
                if 100 * sum((have & want).values()) >= 80 * sum((have | want).values()):
                    every.add((d, item, s))
    size = {i: len(t.split()) for i, t in items}
    aligned = expected_leaks(docs, items)
    near = lambda x, y: x[:2] == y[:2] and abs(x[2] - y[2]) < size[x[1]]
    expected = aligned | {x for x in every if not any(near(x, y) for y in aligned)}
    found = dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"], r["start"]) for r in found.collect()} == expected
    assert {0, 1} <= {d for d, _, _ in expected - aligned}


def test_blocks_find_all_prints_within_the_radius(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(200):
        x = rng.getrandbits(63)
        y = x
        for b in rng.sample(range(63), dc.RADIUS):
            y ^= 1 << b
        rows.append((x, y))
    cut = lambda c: F.transform(dc._blocks(F.col(c), dc.RADIUS), lambda b: b)
    df = spark.createDataFrame(rows, "x long, y long").select(F.arrays_overlap(cut("x"), cut("y")).alias("meet"))
    assert df.filter("NOT meet").count() == 0


def test_simhash_is_the_sign_of_the_votes(spark):
    hashes = [3, 3, -5, 1 << 40, 7]
    got = spark.createDataFrame([(hashes,)], "h array<long>").select(dc.simhash(F.col("h"))).first()[0]
    votes = [sum(1 if h >> b & 1 else -1 for h in hashes) for b in range(64)]
    want = 0
    for v in votes:
        want = want << 1 | (v > 0)
    assert got % (1 << 64) == want


def test_leaks_of_the_whole_table(spark):
    from tidegauge.llm.queries import QUERIES

    read = lambda t: [tuple(r)[:2] for r in spark.read.parquet(f"{SF}/{t}.parquet").collect()]
    found = QUERIES["op2_decontamination"](spark, SF).collect()
    assert {(r["doc_id"], r["item_id"], r["start"]) for r in found} == expected_leaks(read("documents"), read("benchmark"))


# -- language identification ----------------------------------------------------------------------


def test_accuracy_on_held_out_documents(spark):
    from tidegauge.llm.queries import QUERIES

    found = by_id(QUERIES["op3_language_id"](spark, "/root/testdata/sf0.01"))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    assert len(found) == len(docs)
    held = [r for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert {r["doc_id"] for r in held} == {d for d, (r,) in found.items() if r["held_out"]}
    assert np.mean([found[r["doc_id"]][0]["lang_pred"] == r["lang"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for (r,) in found.values())


def test_scores_equal_a_plain_sum(spark):
    rows = [(1, "Der Hund, der bellt!", "de"), (2, "the dog barks", "en"), (3, "der dog 123", None), (4, "...", "en"),
            (5, None, "de"), (6, "", None), (7, "the the the", "und"), (2, "the dog barks", "en"), (None, "hund", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("bucket", F.lit(1))
    model = li.train(df, sample=10**9)
    assert model.languages == ("de", "en")
    out = by_id(li.predict(df, model))
    assert [(out[i][0]["lang_pred"], out[i][0]["score"]) for i in (4, 5, 6)] == [("und", 0.0)] * 3
    assert out[1][0]["lang_pred"] == "de" and out[2][0]["lang_pred"] == out[7][0]["lang_pred"] == "en"
    assert len(out[2]) == 2 and out[2][0] == out[2][1]


def test_a_long_text_counts_as_a_whole(spark, monkeypatch):
    rng = random.Random(2)
    text = prose(rng, 3000) + " ünd"
    whole = [b.copy() for _, _, bs in li._features([text, "x"], li.ORDERS, li.BITS) for b in bs]
    monkeypatch.setattr(li, "PIECE", 1000)
    cut = [b.copy() for _, _, bs in li._features([text, "x"], li.ORDERS, li.BITS) for b in bs]
    count = lambda parts: np.bincount(np.concatenate(parts), minlength=(1 << li.BITS) + 1)[:-1]
    assert (count(whole) == count(cut)).all()
    assert sum(count(whole)) == sum(max(len(li._codes(text)) - o + 1, 0) + max(3 - o + 1, 0) for o in li.ORDERS)


def test_without_labels_all_is_undetermined(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in li.identify(df).collect()] == [(1, False, "und", 0.0)]
    assert li.identify(df.limit(0)).collect() == []


def test_only_unclear_documents_are_rejected(spark):
    rows = [(i, f"the dog {i} and the cat", "en", "s", 1) for i in range(20)] + [(50, "!!", "en", "s", 2), (51, None, "de", "s", 0)]
    kept = li.reject_unclear(spark.createDataFrame(rows, DOCS))
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(20))


# -- substring dedup ------------------------------------------------------------------------------


def test_windows_equal_the_definition():
    rng = np.random.default_rng(1)
    for _ in range(200):
        counts = rng.integers(0, 40, 5)
        h = rng.integers(1, 30, counts.sum()).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        width = int(rng.integers(1, 9))
        got = set(zip(*(x.tolist() for x in sd.compact_windows(h, counts, width))))
        want, s = set(), 0
        for c in counts:
            for i in range(s, s + c):
                a = b = i
                while a > s and h[a - 1] > h[i]:
                    a -= 1
                while b < s + c - 1 and h[b + 1] >= h[i]:
                    b += 1
                if b - a + 1 >= width:
                    want.add((a, i, b))
            s += c
        assert got == want


def repeated_fixture(rng):
    passages = [prose(rng, n) for n in (49, 50, 60, 200)]
    docs = []
    for i, p in enumerate(passages):
        for k in range(4):
            docs.append((10 * i + k, f"{prose(rng, rng.randrange(80))} {edited(rng, p, 0 if k < 3 else len(p.split()) // 60)} {prose(rng, rng.randrange(80))}"))
    docs += [(100, passages[3]), (101, prose(rng, 300)), (102, ("same line again " * 60).strip()), (103, None), (104, ""),
             (105, prose(rng, 20_000) + " " + passages[2]), (None, passages[3])]
    return passages, docs


def test_repeats_are_found_and_cut(spark, monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 1 << 12)
    rng = random.Random(6)
    passages, docs = repeated_fixture(rng)
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, start string, n_chars long")
    found = by_id(sd.repeated_passages(df))
    for i, p in enumerate(passages):
        n = len(p.split())
        for k in (1, 2, 3):
            hits = [r for r in found.get(10 * i + k, []) if r["n_words"] >= min(50, n)]
            assert bool(hits) == (n >= 50), (i, k)
    assert set(found) <= {10 * i + k for i in (1, 2, 3) for k in (1, 2, 3)} | {100, 105}
    assert 105 in found and found[105][0]["start"] >= 20_000
    assert all(r["first_doc_id"] < d and r["similarity"] >= 0.8 for d, rs in found.items() for r in rs)
    cut = {r["doc_id"]: r for r in sd.remove_repeats(df).collect()}
    assert len(cut) == len(docs) and cut[100]["text"] == "" and cut[100]["n_chars"] == 0
    for doc, text in docs:
        if doc not in found:
            assert cut[doc]["text"] == text
    for i in (1, 2, 3):
        assert passages[i] in cut[10 * i]["text"] and passages[i] not in cut[10 * i + 1]["text"]
        left = cut[10 * i + 1]["text"].split()
        gone = len(dict(docs)[10 * i + 1].split()) - len(left) - len(passages[i].split())
        assert 0 <= gone <= 2  # words beside the passage may be equal by chance
    assert sd.repeated_passages(df.limit(0)).collect() == [] == sd.remove_repeats(df.limit(0)).collect()


def test_every_exact_repeat_of_the_whole_table_is_in_a_document_found(spark):
    from tidegauge.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    found = by_id(QUERIES["op5_substring_dedup"](spark, sf))
    seen, exact = {}, set()
    for r in sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r["doc_id"]):
        w = words(r["text"])
        for j in range(len(w) - 50):
            if seen.setdefault(tuple(w[j : j + 51]), r["doc_id"]) != r["doc_id"]:
                exact.add(r["doc_id"])
    assert exact and exact <= set(found)


def test_repeats_do_not_depend_on_the_partitions(spark):
    rng = random.Random(12)
    p, q = prose(rng, 70), prose(rng, 70)
    docs = [(1, f"{prose(rng, 30)} {p} {prose(rng, 30)}"), (2, f"{q} {prose(rng, 40)} {p} {prose(rng, 60)} {p}"),
            (3, f"{prose(rng, 20)} {q} {q} {p}")] + [(10 + i, prose(rng, 40)) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    one, many = (sorted(tuple(r) for r in sd.repeated_passages(d).collect()) for d in (df.coalesce(1), df.repartition(23)))
    assert one == many
    for part in (df.coalesce(1), df.repartition(23)):
        cut = {r["doc_id"]: r["text"] for r in sd.remove_repeats(part).collect()}
        assert p in cut[1] and q in cut[2]
        assert p not in cut[2] and p not in cut[3] and q not in cut[3]


def test_an_earlier_holder_of_the_shingles_does_not_hide_a_repeat(spark):
    rng = random.Random(13)
    p = prose(rng, 60)
    w = p.split()
    scattered = " ".join(f"{' '.join(w[j : j + 5])} {prose(rng, 60)}" for j in range(56))
    part = f"{prose(rng, 40)} {' '.join(w[:30])} {prose(rng, 40)} {' '.join(w[30:])} {prose(rng, 40)}"
    docs = [(1, scattered), (2, part), (3, f"{prose(rng, 50)} {p} {prose(rng, 20)}"),
            (4, f"{prose(rng, 10)} {p} {prose(rng, 30)} {p}"), (5, scattered + " x"), (6, prose(rng, 200))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = by_id(sd.repeated_passages(df))
    assert set(found) == {4, 5} and {r["first_doc_id"] for r in found[4]} == {3}
    assert {r["doc_id"]: r["text"] for r in sd.remove_repeats(df).collect()}[4].count(" ".join(w[5:55])) == 0
    assert {(r["doc_id"], r["start"]) for r in sd.repeated_passages(df, agree=1).collect()} >= {(r["doc_id"], r["start"]) for r in found[4]}


@pytest.mark.parametrize("spans,left", [([], "a b  c d"), ([(0, 2)], "  c d"), ([(1, 1), (2, 9)], "a   "), ([(9, 2)], "a b  c d")])
def test_cutting_words(spans, left):
    assert sd._without("a b  c d", spans) == left
