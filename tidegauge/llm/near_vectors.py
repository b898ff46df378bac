"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

A rotation is three rounds of random signs and a Hadamard transform, which costs d log d. The hash of a
rotated vector is the signed axis it lies closest to; a table joins the hashes of several rotations.
Besides its own bucket a vector enters the buckets that one hash's second closest axis gives, so near
vectors that an axis border separates still meet. Buckets hold one label and one dimension only.

Vectors that are equal with equal labels form one class, and all work is on classes. The classes of a
bucket are cut to blocks of fixed size, and every pair of blocks is compared by a matrix product in
double precision. A pair that meets in several buckets counts only in the first of them. Tasks give out
sums and the edges of a spanning forest, never pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.llm.graph import bucket_links, class_results, spanning
from tidegauge.llm.tokens import mix, runs, signed
from tidegauge.session import Scratch

TABLES = 8
HASHES = 3  # rotations of a table
COSINE = 0.98
BLOCK = 512  # most classes on a side of a comparison
_U = np.uint64


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast transform of the rows, whose length is a power of two, scaled to keep lengths."""
    n, d = x.shape
    step = 1
    while step < d:
        x = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2)
        step *= 2
    return x.reshape(n, d) / np.sqrt(d)


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    """One pseudo-random rotation of the rows, padded with zeros to a power of two."""
    d = 1 << max(int(x.shape[1]) - 1, 1).bit_length()
    y = np.zeros((len(x), d))
    y[:, : x.shape[1]] = x
    for k in range(3):
        with np.errstate(over="ignore"):
            bits = mix(np.arange(d, dtype=np.uint64) + _U(1) + _U((seed * 3 + k) << 32)) >> _U(63)
        y = hadamard(y * (1.0 - 2.0 * bits))
    return y


def unit(lists: pa.Array, dimension: int) -> np.ndarray:
    """Rows of length one, in double precision."""
    x = np.asarray(lists.flatten()).astype(np.float64).reshape(-1, dimension)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def bucket_keys(x: np.ndarray, tables: int, hashes: int) -> np.ndarray:
    """Keys of the buckets of each row: for every table its own, and one more for each rotation."""
    out = []
    for t in range(tables):
        first, second = [], []
        for k in range(hashes):
            y = rotate(x, t * hashes + k)
            two = np.argpartition(-np.abs(y), 1, axis=1)[:, :2]
            value = np.take_along_axis(y, two, 1)
            order = np.argsort(-np.abs(value), axis=1, kind="stable")
            two, value = np.take_along_axis(two, order, 1), np.take_along_axis(value, order, 1)
            axis = (two * 2 + (value < 0)).astype(np.uint64)
            first.append(axis[:, 0])
            second.append(axis[:, 1])
        for probe in range(hashes + 1):
            key = np.full(len(x), t + 1, np.uint64)
            for k in range(hashes):
                key = mix(key * _U(0x9E3779B97F4A7C15) + (second[k] if probe == k + 1 else first[k]))
            out.append(key)
    return np.stack(out, 1)


def _by_dimension(batch, column: str):
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield int(d), rows, unit(lists.take(pa.array(rows)), int(d))


def _hash(batches, tables: int, hashes: int):
    for batch in batches:
        label = batch.column("label_hash").to_numpy().view(np.uint64)
        classes = batch.column("class").to_numpy()
        for d, rows, x in _by_dimension(batch, "vector"):
            for start in range(0, len(rows), 2048):
                part = rows[start : start + 2048]
                keys = bucket_keys(x[start : start + 2048], tables, hashes)
                keys = mix(keys + mix(label[part] + _U(d))[:, None])
                yield pa.record_batch(
                    {"key": signed(keys.ravel()), "class": np.repeat(classes[part], keys.shape[1])}
                )


def first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest common value of each pair of rows."""
    top = np.iinfo(np.int64).max
    out = np.full(len(a), top)
    for k in range(b.shape[1]):
        hit = (a == b[:, k : k + 1]).any(1)
        out = np.where(hit, np.minimum(out, b[:, k]), out)
    return out


def _compare(batches, cosine: float):
    for cell in runs(batches, "cell"):
        cell = cell.combine_chunks()
        lists = cell.column("vector").combine_chunks()
        key = cell.column("key")[0].as_py()
        own = cell.column("own")[0].as_py()
        second = cell.column("second").to_numpy(zero_copy_only=False)
        classes, copies = cell.column("class").to_numpy(), cell.column("copies").to_numpy()
        keys = cell.column("keys").to_pylist()
        width = max(map(len, keys))
        table = np.array([k + k[:1] * (width - len(k)) for k in keys])
        x = unit(lists, len(lists[0]))
        a = np.flatnonzero(~second)
        b = a if own else np.flatnonzero(second)
        linked = x[a] @ x[b].T >= cosine
        if own:
            linked = np.triu(linked, 1)
        i, j = np.nonzero(linked)
        i, j = a[i], b[j]
        here = np.concatenate(
            [first_common(table[i[s : s + 20000]], table[j[s : s + 20000]]) == key for s in range(0, len(i), 20000)]
            or [np.zeros(0, bool)]
        )
        if not here.any():
            continue
        i, j = i[here], j[here]
        links = np.bincount(i, copies[j], len(x)) + np.bincount(j, copies[i], len(x))
        root = spanning(len(x), i, j)
        hit = np.flatnonzero(links)
        yield pa.record_batch(
            {"class": classes[hit], "root": classes[root[hit]], "links": links[hit].astype(np.int64)}
        )


def comparable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and all components finite."""
    good = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(good & F.exists(vector, lambda v: v != 0), F.lit(False))


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, hashes: int = HASHES,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``.

    Two vectors link when their labels are equal and not null, they have as many components, and their
    cosine in double precision is ``cosine`` or more. n_links counts the others found linked with a
    vector; component_id is the smallest vec_id reachable by links; kept tells the vector with that id.

    Vectors that are null, empty or zero or hold a null or non-finite component, those without a label
    and those without an id link with nothing. Repeated rows are vectors of their own, linked with
    each other. Further columns are not looked at; an empty table gives an empty result.
    """
    scratch = Scratch(vectors.sparkSession, "near-vectors")
    # Adding 0.0 makes the two zeros one.
    doubles = F.transform(F.col(vector_col), lambda v: v.cast("double") + F.lit(0.0))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), doubles.alias("vector"), F.col(label_col).cast("string").alias("label")
    )
    able = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & comparable(F.col("vector"))
    rows = rows.select(
        "vec_id", "vector", F.when(able, F.xxhash64("label", "vector")).alias("class"), F.xxhash64("label").alias("label_hash")
    )
    rows = scratch.table(rows, "rows")
    able_rows = rows.filter("class IS NOT NULL")
    classes = able_rows.groupBy("class").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"),
        F.first("vector").alias("vector"), F.first("label_hash").alias("label_hash"),
    )
    classes = scratch.table(classes, "classes")
    hashed = classes.select("class", "label_hash", "vector").mapInArrow(
        lambda it: _hash(it, tables, hashes), "key long, class long"
    )
    links = scratch.table(bucket_links(hashed, ["class"]), "links")
    members = scratch.table(
        links.select("key", "class").union(links.select("key", "lead_class")).distinct(), "members"
    )
    sizes = scratch.table(members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "sizes")
    keys = members.groupBy("class").agg(F.collect_list("key").alias("keys"))  # at most tables * (hashes + 1)
    known = scratch.table(classes.join(keys, "class").select("class", "copies", "keys", "vector"), "members-known")

    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    cells = (
        members.join(sizes, "key")
        .select("key", "class", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select(
            "key", "class",
            F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("cell"),
            (F.col("block") > F.col("other")).alias("second"),
            (F.col("block") == F.col("other")).alias("own"),
        )
    )
    cells = scratch.table(cells, "cells")
    opened = (
        cells.join(known, "class")
        .repartition("cell")
        .sortWithinPartitions("cell")
        .mapInArrow(lambda it: _compare(it, cosine), "class long, root long, links long")
    )
    opened = scratch.table(opened, "opened")
    result = class_results(classes.select("class", "id", "copies"), opened, scratch)
    scratch.drop("links", "members", "cells", "members-known")
    linked = able_rows.select("vec_id", "class").join(result, "class").select("vec_id", "n_links", "component_id")
    rest = rows.filter("class IS NULL").select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    out = linked.union(rest)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
