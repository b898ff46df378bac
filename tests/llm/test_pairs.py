"""Jaccard join, near vectors and the steps they share, against brute force."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm.helpers import DOCS, SF, by_id, components, edited, prose, shingles
from tidegauge.llm import graph, jaccard_join as jj, near_vectors as nv, tokens
from tidegauge.session import Scratch


def expected_join(docs, percent=90, size=3):
    sets = [shingles(t, size) for _, t in docs]
    edges, links = [], [0] * len(docs)
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                edges.append((j, i))
                links[i] += 1
                links[j] += 1
    root = components(range(len(docs)), edges)
    least = {}
    for i, (doc, _) in enumerate(docs):
        least[root[i]] = min(doc, least.get(root[i], doc))
    return sorted((doc, len(sets[i]), links[i], least[root[i]]) for i, (doc, _) in enumerate(docs))


def test_join_equals_brute_force(spark):
    rng = random.Random(3)
    base = [prose(rng, n) for n in (1, 2, 3, 9, 12, 40, 200, 700, 3000)]
    texts = []
    for text in base:
        texts += [text, text.upper(), text.replace(" ", "\t ")]
        texts += [edited(rng, text, max(1, len(text.split()) // k)) for k in (15, 30, 60, 90, 120, 300) for _ in range(4)]
    texts += ["", " \n ", "a b c", "a  b  c d", "a b c d"]
    docs = [(1000 + i * 7, t) for i, t in enumerate(texts)]
    rng.shuffle(docs)
    docs.append(docs[0])  # a repeated row
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("class", F.lit("clash"))
    found = sorted(tuple(r) for r in jj.jaccard_join(df).collect())
    assert found == expected_join(docs)


@pytest.mark.parametrize("percent,size", [(80, 5), (50, 2)])
def test_join_at_other_thresholds(spark, percent, size):
    rng = random.Random(percent)
    base = [prose(rng, n) for n in (6, 30, 80)]
    docs = [(i, edited(rng, base[i % 3], rng.randrange(8))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = sorted(tuple(r) for r in jj.jaccard_join(df, percent, size).collect())
    assert found == expected_join(docs, percent, size)


def test_a_large_group_of_near_copies_is_cut_but_whole(spark, monkeypatch):
    monkeypatch.setattr(jj, "GROUP", 8)
    rng = random.Random(5)
    text = prose(rng, 120)
    docs = [(i, edited(rng, text, rng.randrange(5))) for i in range(90)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(tuple(r) for r in jj.jaccard_join(df).collect()) == expected_join(docs)


def test_join_of_nulls_and_of_nothing(spark):
    rows = [(None, "a b c d"), (5, None), (6, "a b c d"), (7, "a b c d"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r) for r in jj.jaccard_join(df).collect()), key=str)
    assert found == sorted([(None, 2, 0, None), (5, 0, 0, 5), (6, 2, 1, 6), (7, 2, 1, 6), (None, 0, 0, None)], key=str)
    assert jj.jaccard_join(df.limit(0)).collect() == []


def test_first_of_each_group_stays(spark):
    rows = [(3, "a b c d", "en", "s", 7), (1, "a b c d", "de", "s", 7), (2, "x y z", None, None, None),
            (2, "x y z", None, None, None), (None, "a b c d", "en", "s", 7), (4, None, "en", "s", 0)]
    kept = jj.keep_first(spark.createDataFrame(rows, DOCS))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, None, 4], key=str)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(1)
    plan = jj._Plan(90)
    for n in [1, 5, 9, 10, 19, 20, 21, 50, 137, 400]:
        for _ in range(20):
            a = rng.integers(1, 1 << 60, n).astype(np.uint64)
            most = int(n * 0.1)
            cut, more = rng.integers(0, most + 1), rng.integers(0, most + 1)
            b = np.concatenate([a[cut:], rng.integers(1, 1 << 60, more).astype(np.uint64)])
            both = n - cut
            if 100 * both < 90 * (n + len(b) - both) or (set(a) == set(b)):
                continue
            values, counts = tokens.distinct(np.concatenate([a, b]), np.array([len(a), len(b)]))
            sigs, owner = jj._signatures(values, counts, plan)
            assert set(sigs[owner == 0]) & set(sigs[owner == 1]), (n, cut, more)


def test_sets_under_the_bound_are_not_opened():
    a, b = np.arange(10, dtype=np.uint64), np.arange(5, 30, dtype=np.uint64)
    assert jj.qualifying([a], b, 90).tolist() == [False]
    assert jj.qualifying([a], np.arange(1, 30, dtype=np.uint64), 90).tolist() == [True]


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(500, 501 + i) for i in range(40)] + [(700, 701), (701, 702), (702, 700)]
    edges += [(rng.randrange(800, 900), rng.randrange(800, 900)) for _ in range(60)]
    df = spark.createDataFrame(edges, "a long, b long")
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    found = {r["node"]: r["root"] for r in graph.components(df, Scratch(spark, "test"), "t").collect()}
    assert set(found) == nodes
    want = components(nodes, edges)
    assert len({(found[n], want[n]) for n in nodes}) == len(set(found.values())) == len({want[n] for n in nodes})


def test_every_row_of_a_key_is_linked_to_an_earlier_one(spark, monkeypatch):
    monkeypatch.setattr(graph, "FLUSH_ROWS", 10)
    rng = random.Random(2)
    rows = [(rng.randrange(15), rng.randrange(40)) for _ in range(300)]
    df = spark.createDataFrame(rows, "key long, doc long").repartition(7)
    links = graph.bucket_links(df, ["doc"]).collect()
    for key in {k for k, _ in rows}:
        docs = {d for k, d in rows if k == key}
        mine = {(r["lead_doc"], r["doc"]) for r in links if r["key"] == key}
        assert all(a < b for a, b in mine) and {b for _, b in mine} | {min(docs)} == docs


def expected_vectors(rows, cosine=0.98):
    def able(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    unit = [np.array(v) / np.linalg.norm(v) if able(v) and lab is not None else None for _, v, lab in rows]
    edges, links = [], [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is None or unit[j] is None or rows[i][2] != rows[j][2] or len(unit[i]) != len(unit[j]):
                continue
            if unit[i] @ unit[j] >= cosine:
                edges.append((j, i))
                links[i] += 1
                links[j] += 1
    root = components(range(len(rows)), edges)
    least = {}
    for i, r in enumerate(rows):
        least[root[i]] = min(r[0], least.get(root[i], r[0]))
    return sorted((r[0], links[i], least[root[i]], r[0] == least[root[i]]) for i, r in enumerate(rows))


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nv, "BLOCK", 16)
    rng = np.random.default_rng(4)
    rows = []
    for g in range(12):
        centre = rng.normal(size=20)
        for _ in range(40 if g == 0 else 8):
            rows.append((centre + rng.normal(size=20) * rng.choice([0.02, 0.1, 0.14])).tolist())
    rows = [(i * 3, v, i % 2) for i, v in enumerate(rows)]
    rows += [(9000 + i, rows[0][1], 0) for i in range(30)]  # copies
    rows += [(9100, [2 * x for x in rows[0][1]], 0), (9101, rows[0][1], None), (9102, None, 0), (9103, [], 0),
             (9104, [0.0] * 20, 0), (9105, [1.0, None], 0), (9106, [float("nan")] * 20, 0), (9107, [float("inf")] * 20, 0),
             (9108, [-0.0, 1.0], 1), (9109, [0.0, 1.0], 1), (9110, [1e-300, 1e300], 1), (9111, [5.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("key", F.lit("clash"))
    found = sorted(tuple(r) for r in nv.near_vectors(df).collect())
    plain = [(i, None if v is None else [None if x is None else min(x, 1e150) if math.isfinite(x) else x for x in v], lab)
             for i, v, lab in rows]
    assert found == expected_vectors(plain)
    assert nv.near_vectors(df.limit(0)).collect() == []


def test_recall_at_the_threshold_itself():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z = rng.normal(size=a.shape)
    z -= (z * a).sum(1, keepdims=True) * a
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * z
    keys = [nv.bucket_keys(x, nv.TABLES, nv.HASHES).view(np.int64) for x in (a, b)]
    assert (nv.first_common(*keys) < np.iinfo(np.int64).max).mean() > 0.999


def test_hadamard_keeps_lengths_and_angles():
    x = np.random.default_rng(1).normal(size=(5, 12))
    y = nv.rotate(x, 3)
    assert y.shape == (5, 16) and np.allclose(x @ x.T, y @ y.T)


def test_registered_queries_on_whole_tables(spark):
    from tidegauge.llm.queries import QUERIES

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op10_ngram_jaccard_join"](spark, SF)
    assert sorted(tuple(r) for r in found.collect()) == expected_join(docs)
    vectors = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = by_id(QUERIES["op1_near_vectors"](spark, SF), "vec_id")
    assert sorted(tuple(r) for rs in rows.values() for r in rs) == expected_vectors(vectors)


def test_small_sets_of_a_band_share_no_signature_for_empty_parts():
    rng = np.random.default_rng(4)
    sizes = rng.integers(200, 900, 300)
    values, counts = tokens.distinct(rng.integers(1, 1 << 60, int(sizes.sum())).astype(np.uint64), sizes)
    sigs, owner = jj._signatures(values, counts, jj._Plan(80))
    shared = np.unique(np.unique(np.stack([sigs, owner.astype(np.uint64)], 1), axis=0)[:, 0], return_counts=True)[1]
    assert (shared > 1).sum() == 0  # no two sets have a member in common


def test_signatures_are_linked_slice_by_slice(spark, monkeypatch):
    rng = random.Random(12)
    base = [prose(rng, n) for n in (30, 150, 400)]
    docs = [(i, edited(rng, base[i % 3], rng.randrange(1, 6))) for i in range(36)]
    rows_of = []

    def counted(rows, order, flatten, names, link=graph.bucket_links):
        keys = rows.mapInArrow(flatten, ", ".join(f"{n} long" for n in names)).select("key")
        rows_of.append([r["key"] for r in keys.collect()])
        return link(rows, order, flatten, names)

    monkeypatch.setattr(jj, "bucket_links", counted)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(tuple(r) for r in jj.jaccard_join(df, 80, 5).collect()) == expected_join(docs, 80, 5)
    assert len(rows_of) == jj.SLICES and max(map(len, rows_of)) < 0.4 * sum(map(len, rows_of))
    assert sum(len(set(keys)) for keys in rows_of) == len({k for keys in rows_of for k in keys})


def test_groups_meet_with_the_classes_that_share_a_signature(spark, monkeypatch):
    members = [(k, c) for k, cs in {1: (1, 2), 2: (2, 11), 3: (11, 12, 13), 4: (3, 12, 21), 5: (1, 3)}.items() for c in cs]
    groups = [(c, c // 10 + 100) for c in (1, 2, 3, 11, 12, 13, 21)]
    members = spark.createDataFrame(members, "key long, class long")
    groups = spark.createDataFrame(groups, "class long, group long")
    want = [(2, 100, 101), (3, 100, 101), (3, 100, 102), (11, 101, 100), (12, 101, 100), (12, 101, 102), (21, 102, 100), (21, 102, 101)]
    stored, table = [], Scratch.table
    monkeypatch.setattr(Scratch, "table", lambda self, df, name: stored.append(name) or table(self, df, name))
    for most, slices in ((2, 1), (0.2, 4)):
        monkeypatch.setattr(jj, "SLICE_ROWS", most)
        found = jj._met(members, groups, members.count(), Scratch(spark, "met")).collect()
        assert sorted(tuple(r) for r in found) == want
        assert len([n for n in stored if n.startswith("met/")]) == slices, stored
        stored.clear()


def test_any_number_of_slices(spark, monkeypatch):
    monkeypatch.setattr(jj, "GROUP", 4)
    monkeypatch.setattr(jj, "SLICE_ROWS", 0.03)
    rng = random.Random(13)
    base = [prose(rng, n) for n in (60, 61, 200)]
    docs = [(i, edited(rng, base[i % 3], rng.randrange(5))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    stored, table = [], Scratch.table
    monkeypatch.setattr(Scratch, "table", lambda self, df, name: stored.append(name) or table(self, df, name))
    assert sorted(tuple(r) for r in jj.jaccard_join(df, 80, 5).collect()) == expected_join(docs, 80, 5)
    assert {"met/1", "cells/1"} <= set(stored)


def test_bit_maps_open_every_pair_that_may_be_similar_and_few_others():
    rng = np.random.default_rng(5)
    for percent, size in ((80, 1), (80, 63), (80, 64), (90, 65), (80, 150), (90, 700), (50, 90)):
        base = rng.integers(1, 1 << 60, size).astype(np.uint64)
        other = rng.integers(1, 1 << 60, size).astype(np.uint64)
        cut = size - -(-size * percent // 100)
        sets = [base, base[cut:], other]
        values, counts = tokens.distinct(np.concatenate(sets), np.array([len(s) for s in sets]))
        maps, words_ = jj._parities(values, counts)
        edges = tokens.offsets(words_)
        bits = [maps[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
        rows = {"cell": [7] * 3 + [8] * 3, "class": [1, 2, 3] * 2, "second": [False] * 3 + [False, True, True],
                "own": [True] * 3 + [False] * 3, "n_shingles": counts.tolist() * 2, "bits": bits * 2}
        table = pa.table({n: pa.array(v, pa.binary() if n == "bits" else None) for n, v in rows.items()})
        found = [r for b in jj._possible(table.to_batches(max_chunksize=2), percent) for r in b.to_pylist()]
        found = [(r["cell"], r["class"], r["second"]) for r in found]
        want = [(7, 1, False), (7, 2, False), (8, 1, False), (8, 2, True)]
        assert set(want) <= set(found) and (found == want or percent == 50)
