"""Steps on shared keys and links between rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidegauge.session import Scratch

FLUSH_ROWS = 250_000  # rows a map task holds while it combines equal keys
BROADCAST_ROWS = 1_000_000  # most rows of a few numbers, about 50 bytes each, sent to every executor


def small_side(side: DataFrame, rows: int) -> DataFrame:
    """``side``, of ``rows`` narrow rows, for a broadcast if they are few; else the join shuffles."""
    return F.broadcast(side) if rows <= BROADCAST_ROWS else side


def _lead_batches(batches, order: list[str], names: list[str]):
    """Sort rows by (key, order), and give each row the first row of its key as its lead."""

    def flush(held):
        table = pa.Table.from_batches(held).combine_chunks()
        cols = {n: table.column(n).to_numpy() for n in names}
        at = np.lexsort([*(cols[n] for n in reversed(order)), cols["key"]])
        cols = {n: c[at] for n, c in cols.items()}
        same = np.zeros(len(at), bool)
        same[1:] = cols["key"][1:] == cols["key"][:-1]
        repeat = same.copy()
        for n in order:
            repeat[1:] &= cols[n][1:] == cols[n][:-1]
        cols = {n: c[~repeat] for n, c in cols.items()}
        starts = np.flatnonzero(~same[~repeat])
        lead = np.repeat(starts, np.diff(np.append(starts, len(cols["key"]))))
        out = dict(cols)
        for n in names:
            if n != "key":
                out[f"lead_{n}"] = cols[n][lead]
        for part in pa.table(out).to_batches(max_chunksize=50_000):
            yield part

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= FLUSH_ROWS:
            yield from flush(held)
            held, rows = [], 0
    if rows:
        yield from flush(held)


def _link_batches(batches, order: list[str], names: list[str]):
    """Rows after the first of their key, with that first row; rows already led stay as they are."""
    payload = [n for n in names if n != "key"]
    last = None  # first row of the latest key
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {n: batch.column(n).to_numpy() for n in batch.schema.names}
        led = np.zeros(len(cols["key"]), bool)
        for n in order:
            led |= cols[n] != cols[f"lead_{n}"]
        leads = np.flatnonzero(~led)
        parent = {n: cols[f"lead_{n}"].copy() for n in payload}
        keep = led
        if len(leads):
            keys = cols["key"][leads]
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            carried = last is not None and keys[0] == last["key"]
            if carried:
                new[0] = False
            first = np.maximum.accumulate(np.where(new, np.arange(len(keys)), -1))
            for n in payload:
                value = cols[n][leads][np.maximum(first, 0)]
                if carried:
                    value = np.where(first < 0, last[n], value)
                parent[n][leads] = value
            keep = led.copy()
            differs = np.zeros(len(leads), bool)
            for n in order:
                differs |= parent[n][leads] != cols[n][leads]
            keep[leads] = differs
            if first[-1] >= 0:
                last = {n: cols[n][leads[first[-1]]] for n in names}
        out = {n: cols[n][keep] for n in names}
        out |= {f"lead_{n}": parent[n][keep] for n in payload}
        yield pa.record_batch(out)


def bucket_links(rows: DataFrame, order: list[str], flatten=None, names: list[str] | None = None) -> DataFrame:
    """Link every row of a key to one earlier row of that key; keys of one row give nothing.

    ``rows`` has long columns only: ``key``, those of ``order``, which tell the rows of a key apart,
    and any payload. Each map task first links its rows to the first of each key, so that only one
    row per key and task goes on to the task that owns the key, however many rows a key has; the
    links of a key form a tree of depth two. Result: the row, and its parent's columns as ``lead_*``.

    ``flatten`` makes such rows, of the columns ``names``, out of the batches of ``rows`` in the same worker.
    """
    names, flatten = names or rows.columns, flatten or iter
    wide = ", ".join(f"{n} long" for n in names)
    leads = ", ".join(f"lead_{n} long" for n in names if n != "key")
    is_lead = reduce(and_, (F.col(n) == F.col(f"lead_{n}") for n in order))
    return (
        rows.mapInArrow(lambda it: _lead_batches(flatten(it), order, names), f"{wide}, {leads}")
        .repartition(F.when(is_lead, F.col("key")).otherwise(F.xxhash64("key", *order)))
        .sortWithinPartitions("key", *order)
        .mapInArrow(lambda it: _link_batches(it, order, names), f"{wide}, {leads}")
    )


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b): nodes joined by edges share a root.

    Each round every node moves to the neighbour that comes first in a scrambled order, edges are
    drawn anew between the places reached and loops go, until no edge is left; the moves are then
    followed from the last round back. A node's neighbours are only ever combined by a minimum, and
    the joins read stored tables, so a node with very many neighbours can be split.
    """
    first = lambda c: F.xxhash64(c)
    a, b = F.col("a"), F.col("b")
    edges = scratch.table(edges.filter(a != b).select("a", "b").distinct(), f"{name}-edges-0")
    moves = []
    while not edges.isEmpty():
        k = len(moves)
        both = edges.union(edges.select(b, a)).toDF("node", "other")
        near = both.groupBy("node").agg(F.min(first("other")).alias("h"), F.min_by("other", first("other")).alias("o"))
        move = near.select("node", F.when(F.col("h") < first("node"), F.col("o")).otherwise(F.col("node")).alias("to"))
        move = scratch.table(move, f"{name}-moves-{k}")
        half = scratch.table(
            edges.join(move, edges["a"] == move["node"]).select(F.col("to").alias("a"), "b"),
            f"{name}-half-{k}",
        )
        edges = scratch.table(
            half.join(move, half["b"] == move["node"])
            .select("a", F.col("to").alias("b"))
            .filter("a != b")
            .distinct(),
            f"{name}-edges-{k + 1}",
        )
        scratch.drop(f"{name}-half-{k}", f"{name}-edges-{k}")
        moves.append(move)
    if not moves:
        return edges.select(a.alias("node"), b.alias("root"))
    root = moves[-1].toDF("node", "root")
    for k in range(len(moves) - 2, -1, -1):
        step = moves[k].join(root.toDF("to", "root"), "to", "left")
        step = step.select("node", F.coalesce("root", "to").alias("root"))
        root = scratch.table(step, f"{name}-roots-{k}")
    return root


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component, for the edges i - j among n nodes."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


def class_results(classes: DataFrame, opened: DataFrame, scratch: Scratch) -> DataFrame:
    """(class, component_id, n_links) of the stored ``classes`` (class, id, copies).

    ``opened`` has a class's links to rows of other classes, as sums to be added up, and an edge to a
    class of the same component. Rows of one class are all linked.
    """
    edges = opened.select(F.col("class").alias("a"), F.col("root").alias("b"))
    roots = components(edges, scratch, "tree").withColumnRenamed("node", "class")
    known = classes.join(roots, "class", "left").select(
        "class", "id", "copies", F.coalesce("root", "class").alias("root")
    )
    known = scratch.table(known, "known")
    least = scratch.table(known.groupBy("root").agg(F.min("id").alias("component_id")), "least")
    sums = scratch.table(opened.groupBy("class").agg(F.sum("links").alias("links")), "sums")
    links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    known = known.join(least, "root").join(sums, "class", "left").select(
        "class", "component_id", links.alias("n_links")
    )
    return scratch.table(known, "class-results")
