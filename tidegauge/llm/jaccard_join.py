"""Similarity join of documents by the Jaccard overlap of their word shingles.

Documents with equal shingle sets form one class, and all work is on classes.

1. Classes that could be similar meet on signatures. Two sets whose similarity reaches the threshold
   differ in at most k shingles, k following from the threshold and the size band. Dealing shingles
   to k + 1 + spare parts by hash leaves at least 1 + spare parts equal, so each part's hash is a
   signature; a set with at most ``spare`` empty parts leaves those out. Nothing similar is missed.
   An empty part is equal in all sets that have it, whatever else they hold, so a band has as many spare
   parts as its smallest sets are likely to have empty ones.
2. Token-group matrix: a class belongs to the group of its most popular shared signature, groups
   being cut to a fixed size. Two groups that hold a common signature are a candidate pair, each with its
   classes that have a signature of the other.
3. Each set has a bit map of the parities of its shingles. Maps of two sets differ in no more bits than
   the sets in shingles, so texts go only to the classes that some other class of the pair of groups
   is near enough to by these maps.
4. A pair's task builds each group's token union. A set whose overlap with the other group's union
   is under the threshold's share of its own size cannot link into that group; a group is opened
   only for the sets that remain, by counting exact intersections.

Every pair of classes lies in one pair of groups, so it is counted once. Tasks give out sums and the
edges of a spanning forest, never pairs.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidegauge.llm.graph import bucket_links, class_results, small_side, spanning
from tidegauge.llm.tokens import (
    distinct, flat_hashes, mix, offsets, runs, segment_sums, shingles, signed, text_chunks,
)
from tidegauge.session import Scratch

GROUP = 1024  # classes of a group, about
GROUP_SHINGLES = 800_000  # and shingles of all its classes, unless one alone has more
SPARE = 2  # least number of parts beyond the need, so that a set with few empty parts can leave them out
DEVIATIONS = 3  # by which the spare parts exceed the mean number of empty ones in the smallest sets of a band
BAND = 1.3  # ratio of the largest to the smallest set of a size band
CELL_ROWS = 50_000  # classes of many pairs of groups whose bit maps are compared together, unless one pair has more
SLICE_ROWS = 2  # times the rows of shared signatures, rows of classes and other groups that are shuffled at once
SLICES = 4  # of the signatures, whose links are made one after the other; a power of two
MAP_WORDS = 1 << 18  # pairs of classes that one step looks at, and 64-bit words of their bit maps
_U = np.uint64


class _Plan:
    """Size bands and parts for a threshold of ``percent`` / 100."""

    def __init__(self, percent: int):
        self.percent = percent

    def parts_of(self, smallest: int, largest: int) -> tuple[int, int]:
        """(parts, spare ones among them) for sets of those sizes; no parts when only equal sets can be similar."""
        # diff <= (1 - t) / (1 + t) * (|x| + |y|)
        k = (100 - self.percent) * 2 * largest // (100 + self.percent)
        if not k:
            return 0, 0
        spare = SPARE
        while True:
            empty = (k + 1 + spare) * math.exp(-smallest / (k + 1 + spare))
            if spare >= empty + DEVIATIONS * math.sqrt(empty):
                break
            if spare > k:  # sets too small for their threshold leave parts empty however many there are
                spare = spare if spare >= empty else SPARE
                break
            spare += 1
        return k + 1 + spare, spare

    def bands(self, sizes: np.ndarray) -> list[tuple[np.ndarray, int, int, int]]:
        """(members, band, parts, spare): sets of the band, or small enough to pair with one of it."""
        out, low, band, largest = [], 1, 0, int(sizes.max(initial=0))
        while low <= largest * 100 // self.percent + 1:
            high = max(low + 1, math.ceil(low * BAND)) - 1
            parts, spare = self.parts_of(-(-low * self.percent // 100), high)
            if parts:
                member = np.flatnonzero((sizes * 100 >= low * self.percent) & (sizes <= high) & (sizes > 0))
                if len(member):
                    out.append((member, band, parts, spare))
            low, band = high + 1, band + 1
        return out


def _signatures(values: np.ndarray, counts: np.ndarray, plan: _Plan) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all sets, and the set of each."""
    starts = offsets(counts)
    keys, owners = [], []
    for member, band, parts, spare in plan.bands(counts):
        own = counts[member]
        at = np.repeat(starts[:-1][member] - offsets(own)[:-1], own) + np.arange(own.sum())
        tokens = values[at]
        salted = mix(tokens ^ _U(band + 1))
        slot = np.repeat(np.arange(len(member)) * parts, own) + (salted % _U(parts)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        fill = np.bincount(slot, minlength=len(member) * parts)
        sums = segment_sums(mix(salted)[order], fill)
        label = np.tile(np.arange(parts, dtype=np.uint64), len(member))
        key = mix(mix(sums + label) ^ _U((band << 32) + 7))
        empty = (fill == 0).reshape(len(member), parts)
        given = ~empty | (empty.sum(1, keepdims=True) > spare)
        given = given.ravel()
        keys.append(key[given])
        owners.append(np.repeat(member, parts)[given])
    if not keys:
        return np.empty(0, _U), np.empty(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def _set_key(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hash of each set; sums of scrambled members, scrambled again with the size."""
    return mix(segment_sums(mix(values ^ _U(0x5E7)), counts) + mix(counts.astype(_U)))


def _parities(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit maps of all sets as 64-bit words, and how many each has: a power of two, a bit for each member at least."""
    words_ = 1 << np.ceil(np.log2(np.maximum(counts, 64) / 64)).astype(np.int64)
    starts = 64 * offsets(words_)
    spot = (mix(values ^ _U(0xB175)) & np.repeat(64 * words_ - 1, counts).astype(_U)).astype(np.int64)
    odd = np.bincount(np.repeat(starts[:-1], counts) + spot, minlength=starts[-1]) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8"), words_


def _sketch(batches, size: int, plan: _Plan):
    for texts, ids in text_chunks(batches, "text", "doc_id"):
        values, counts = distinct(*shingles(*flat_hashes(texts), size))
        sigs, owner = _signatures(values, counts, plan)
        maps, words_ = _parities(values, counts)
        part = (sigs % _U(SLICES)).astype(np.int64)
        order = np.lexsort((owner, part))
        sigs, each = sigs[order], np.bincount(part * len(texts) + owner, minlength=SLICES * len(texts))
        each, ends = each.reshape(SLICES, -1), np.cumsum(np.bincount(part, minlength=SLICES))
        yield pa.record_batch(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_shingles": counts,
                "class": signed(_set_key(values, counts)),
                "bits": _packed(maps, words_),
                **{f"signatures{k}": _packed(sigs[ends[k] - each[k].sum() : ends[k]], each[k]) for k in range(SLICES)},
            }
        )


def _packed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Runs of 64-bit values, one binary value for each run."""
    ends = pa.py_buffer((8 * offsets(counts)).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, ends, pa.py_buffer(np.ascontiguousarray(values))])


def _flat_signatures(batches, column: str):
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            lists = batch.column(column).slice(start, 1000).to_pylist()
            counts = np.array([len(x) // 8 for x in lists])
            owner = np.repeat(batch.column("class").slice(start, 1000).to_numpy(), counts)
            yield pa.record_batch({"key": np.frombuffer(b"".join(lists), "<i8"), "class": owner})


def _whole_cells(batches):
    """Rows in the order of cells, in tables of many rows that never cut a cell."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CELL_ROWS:
            table = pa.Table.from_batches(held)
            cells = table.column("cell").to_numpy()
            cut = int(np.searchsorted(cells, cells[-1]))
            if cut:
                yield table.slice(0, cut)
            held, rows = table.slice(cut).to_batches(), len(cells) - cut
    if rows:
        yield pa.Table.from_batches(held)


def _differing(maps: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many bits the maps x and y differ, the longer one folded to the length of the other."""
    sizes = np.array([len(m) for m in maps])
    length = np.minimum(sizes[x], sizes[y])
    out = np.empty(len(x), np.int64)
    for n in np.unique(length).tolist():
        pairs = np.flatnonzero(length == n)
        used, at = np.unique(np.concatenate([x[pairs], y[pairs]]), return_inverse=True)
        table = np.stack([np.bitwise_xor.reduce(maps[i].reshape(-1, n), axis=0) for i in used.tolist()])
        i, j, step = at[: len(pairs)], at[len(pairs) :], max(1, MAP_WORDS // n)
        for k in range(0, len(pairs), step):
            apart = table[i[k : k + step]] ^ table[j[k : k + step]]
            out[pairs[k : k + step]] = np.bitwise_count(apart).sum(1, dtype=np.int64)
    return out


def _possible(batches, percent: int):
    """The rows of each cell whose set may be similar to one of the other side, by their bit maps.

    Rows come in the order of cells, those of the first group before those of the second.
    """
    for rows in _whole_cells(batches):
        cell, sizes = rows.column("cell").to_numpy(), rows.column("n_shingles").to_numpy()
        second, own = (rows.column(c).to_numpy() for c in ("second", "own"))
        maps = [np.frombuffer(b, "<u8") for b in rows.column("bits").to_pylist()]
        at = np.arange(len(cell))
        edges = np.append(np.flatnonzero(np.diff(cell, prepend=cell[0] ^ 1)), len(cell))
        number = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        first = edges[:-1] + np.bincount(number[~second], minlength=len(edges) - 1)  # of the second group
        low = np.where(own, at + 1, first[number])
        many = np.where(second, 0, edges[1:][number] - low)
        ends = np.cumsum(many)
        cuts = np.searchsorted(ends, np.arange(0, int(ends[-1]), MAP_WORDS), "right")
        cuts = np.unique(np.concatenate([[0], cuts, [len(ends)]]))
        hit = np.zeros(len(cell), bool)
        for a, b in zip(cuts[:-1], cuts[1:]):
            n = many[a:b]
            x = np.repeat(at[a:b], n)
            y = np.arange(len(x)) - np.repeat(offsets(n)[:-1], n) + low[x]
            near = np.minimum(sizes[x], sizes[y]) * 100 >= np.maximum(sizes[x], sizes[y]) * percent
            x, y = x[near], y[near]
            near = _differing(maps, x, y) * (100 + percent) <= (sizes[x] + sizes[y]) * (100 - percent)
            hit[x[near]] = hit[y[near]] = True
        kept = rows.select(["cell", "class", "second", "own"]).filter(pa.array(hit))
        yield from kept.to_batches()


def _intersections(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of a with all of b."""
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    tokens = np.intersect1d(flat_a, flat_b)
    out = np.zeros((len(a), len(b)), np.float32)
    where = []
    for flat, sets in ((flat_a, a), (flat_b, b)):
        code = np.searchsorted(tokens, flat)
        code[code == len(tokens)] = 0
        hit = tokens[code] == flat if len(tokens) else np.zeros(len(flat), bool)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        where.append((code[hit], owner[hit]))
    width = 4096
    for start in range(0, len(tokens), width):
        blocks = []
        for (code, owner), sets in zip(where, (a, b)):
            block = np.zeros((len(sets), min(width, len(tokens) - start)), np.float32)
            mine = (code >= start) & (code < start + width)
            block[owner[mine], code[mine] - start] = 1
            blocks.append(block)
        out += blocks[0] @ blocks[1].T
    return out.astype(np.int64)


def qualifying(sets: list[np.ndarray], union: np.ndarray, percent: int) -> np.ndarray:
    """Which sets overlap a group's token union enough to link with a member of that group."""
    flat, counts = np.concatenate(sets), np.array([len(s) for s in sets])
    at = np.searchsorted(union, flat)
    at[at == len(union)] = 0
    overlap = segment_sums((union[at] == flat).astype(np.int64), counts)
    return overlap * 100 >= counts * percent


def open_pair(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int):
    """Index pairs of sets that link, of one group with itself or of two groups."""
    other = left if right is None else right
    a = np.flatnonzero(qualifying(left, np.unique(np.concatenate(other)), percent))
    if not len(a):
        return a, a
    if right is None:
        b = a
    else:
        b = np.flatnonzero(qualifying(other, np.unique(np.concatenate([left[i] for i in a])), percent))
        if not len(b):
            return b, b
    both = _intersections([left[i] for i in a], [other[i] for i in b])
    size_a = np.array([len(left[i]) for i in a])
    size_b = np.array([len(other[i]) for i in b])
    linked = both * 100 >= (size_a[:, None] + size_b[None, :] - both) * percent
    if right is None:
        linked = np.triu(linked, 1)
    i, j = np.nonzero(linked)
    return a[i], b[j]


def _open_cells(batches, size: int, percent: int):
    for cell in runs(batches, "cell"):
        classes = cell.column("class").to_numpy()
        copies = cell.column("copies").to_numpy()
        second = cell.column("second").to_numpy(zero_copy_only=False)
        texts = cell.column("text").to_pylist()
        values, counts = distinct(*shingles(*flat_hashes(texts), size))
        good = (signed(_set_key(values, counts)) == classes) & (counts > 0)
        at = offsets(counts)
        pick = [np.flatnonzero(good & (second == s)) for s in (False, True)]
        pick = [p[np.unique(classes[p], return_index=True)[1]] for p in pick]
        sets = [[values[at[k] : at[k + 1]] for k in p] for p in pick]
        own = cell.column("own")[0].as_py()
        if not len(pick[0]) or not (own or len(pick[1])):
            continue
        i, j = open_pair(sets[0], None if own else sets[1], percent)
        if not len(i):
            continue
        nodes = pick[0] if own else np.concatenate(pick)
        j = j if own else j + len(pick[0])
        links = np.bincount(i, copies[nodes[j]], len(nodes)) + np.bincount(j, copies[nodes[i]], len(nodes))
        root = spanning(len(nodes), i, j)
        hit = np.flatnonzero(links)
        yield pa.record_batch(
            {
                "class": classes[nodes[hit]],
                "root": classes[nodes[root[hit]]],
                "links": links[hit].astype(np.int64),
            }
        )


def _groups(members: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(class, group): classes under the same popular signature, cut to a bounded size.

    A class's home is the most popular of its signatures. Each home then joins the largest home it has
    a signature in common with, so that the many small homes around a popular one do not each become a
    group.
    """
    popular = scratch.table(members.groupBy("key").agg(F.count("*").alias("n")), "popular")
    home = members.join(popular, "key").groupBy("class").agg(F.max_by("key", F.struct("n", "key")).alias("home"))
    home = scratch.table(home, "home")
    scratch.drop("popular")
    sizes = scratch.table(home.groupBy("home").agg(F.count("*").alias("n")), "sizes")
    sized = home.join(sizes, "home")
    at_key = scratch.table(members.join(sized, "class").select("key", "home", "n").distinct(), "home-keys")
    largest = at_key.groupBy("key").agg(F.max(F.struct("n", "home")).alias("top"))
    largest = scratch.table(largest.select("key", "top.n", "top.home").toDF("key", "top_n", "top"), "largest")
    scratch.drop("sizes")
    leader = (
        at_key.join(largest, "key").groupBy("home").agg(F.max_by("top", F.struct("top_n", "top")).alias("leader"))
    )
    leader = scratch.table(leader, "leader")
    scratch.drop("home-keys", "largest")
    led = home.join(leader, "home").join(classes.select("class", "n_shingles"), "class")
    led = scratch.table(led.select("class", "leader", "n_shingles"), "led")
    scratch.drop("home", "leader")
    slots = F.ceil(F.greatest(F.count("*") / GROUP, F.sum("n_shingles") / GROUP_SHINGLES))
    sizes = scratch.table(led.groupBy("leader").agg(slots.alias("slots")), "led-sizes")
    slot = F.pmod(F.xxhash64("class"), F.col("slots"))
    return scratch.table(
        led.join(sizes, "leader").select("class", F.xxhash64("leader", slot).alias("group")), "groups"
    )


def _met(members: DataFrame, groups: DataFrame, n_members: int, scratch: Scratch) -> DataFrame:
    """(class, group, other): the other groups that hold a signature of a class."""
    placed = scratch.table(members.join(groups, "class").select("key", "class", "group"), "placed")
    keys = placed.groupBy("key").agg(F.min("group").alias("least"), F.max("group").alias("most")).filter("least < most")
    shared = scratch.table(placed.join(keys.select("key"), "key"), "shared")
    scratch.drop("placed")
    others = scratch.table(shared.select("key", F.col("group").alias("other")).distinct(), "group-keys")
    rows = shared.groupBy("key").count().join(others.groupBy("key").agg(F.count("*").alias("n")), "key")
    rows = rows.agg(F.sum(F.col("count") * (F.col("n") - 1))).first()[0] or 0
    slices = max(1, math.ceil(rows / max(1, SLICE_ROWS * n_members)))
    met = []
    for k in range(slices):
        some = shared.filter(F.pmod(F.xxhash64("class"), F.lit(slices)) == k)
        some = some.join(others, "key").filter("group <> other").select("class", "group", "other").distinct()
        met.append(scratch.table(some, f"met/{k}"))
    scratch.drop("shared", "group-keys")
    return reduce(DataFrame.union, met)


def _cells(members: DataFrame, groups: DataFrame, classes: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(cell, class, second, own): the classes that each pair of groups brings together, as far as bit maps allow.

    Two groups that hold a common signature meet, each with its classes that have one of the other's. Where these
    are many for the signatures there are, cells are taken slice by slice, each shuffled on its own.
    """
    n_members = members.count()
    met = _met(members, groups, n_members, scratch)
    ga, gb = F.least("group", "other"), F.greatest("group", "other")
    cross = met.select(F.xxhash64(ga, gb).alias("cell"), "class", (F.col("group") > F.col("other")).alias("second"), F.lit(False).alias("own"))
    alone = groups.join(groups.groupBy("group").count().filter("count > 1").select("group"), "group")
    alone = alone.select(F.xxhash64("group", "group").alias("cell"), "class", F.lit(False).alias("second"), F.lit(True).alias("own"))
    every = cross.union(alone)
    slices = max(1, math.ceil(every.count() / max(1, SLICE_ROWS * n_members)))
    cells = []
    for k in range(slices):
        some = (
            every.filter(F.pmod(F.xxhash64("cell"), F.lit(slices)) == k)
            .join(classes.select("class", "n_shingles", "bits"), "class")
            .repartition("cell")
            .sortWithinPartitions("cell", "second")
            .mapInArrow(lambda it: _possible(it, percent), "cell long, class long, second boolean, own boolean")
        )
        cells.append(scratch.table(some, f"cells/{k}"))
    scratch.drop("met")
    return reduce(DataFrame.union, cells)


def _slice_members(full: DataFrame, column: str, scratch: Scratch) -> DataFrame:
    """(key, class): the signatures of one slice that several classes have, and those classes."""
    rows = full.select("class", column)
    links = bucket_links(rows, ["class"], lambda it: _flat_signatures(it, column), ["key", "class"])
    links = scratch.table(links, f"links-{column}")
    return links.select("key", "class").union(links.select("key", "lead_class")).distinct()


def jaccard_join(
    docs: DataFrame, percent: int = 90, size: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, n_links, component_id.

    Words are the runs between ASCII white space with A-Z lower-cased; a text's set holds its distinct
    shingles of ``size`` words, or its whole word sequence if it has fewer. Two documents link when
    ``100 * intersection >= percent * union``; n_links counts the others linked with a document, and
    component_id is the smallest doc_id reachable by links, itself included. Shingles and sets are
    compared by 64-bit hashes.

    Null and empty texts have no shingles and link with nothing. A null doc_id takes part in nothing:
    its row keeps its n_shingles and has no links and a null component. Rows that repeat are documents
    of their own. Further columns of ``docs`` are not looked at; an empty table gives an empty result.
    """
    plan = _Plan(percent)
    scratch = Scratch(docs.sparkSession, "jaccard-join")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketches = scratch.table(
        rows.mapInArrow(
            lambda it: _sketch(it, size, plan),
            "doc_id long, n_shingles long, class long, bits binary" + "".join(f", signatures{k} binary" for k in range(SLICES)),
        ),
        "sketches",
    )
    full = sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = scratch.table(
        full.groupBy("class").agg(
            F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.max("n_shingles").alias("n_shingles"),
            F.max("bits").alias("bits"),
        ),
        "classes",
    )
    # The shuffle of the links is the largest there is; equal signatures are in one slice, whose files go before the next.
    members = [scratch.table(_slice_members(full, f"signatures{k}", scratch), f"members/{k}") for k in range(SLICES)]
    members = reduce(DataFrame.union, members)
    # What is needed of the sketches from here on; the signatures are the larger part of them.
    sketches = scratch.table(sketches.select("doc_id", "n_shingles", "class"), "documents")
    full = sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    scratch.drop("sketches", *(f"links-signatures{k}" for k in range(SLICES)))
    groups = _groups(members, classes, scratch)
    cells = _cells(members, groups, classes, percent, scratch)
    scratch.drop("members", "groups")

    needed = classes.select("class", "doc_id", "copies").join(cells.select("class").distinct(), "class")
    needed = scratch.table(needed, "needed")
    texts = rows.join(small_side(needed, needed.count()), "doc_id").select("class", "copies", "text")
    texts = scratch.table(texts, "texts")
    opened = (
        cells.join(texts, "class")
        .repartition("cell")
        .sortWithinPartitions("cell")
        .mapInArrow(lambda it: _open_cells(it, size, percent), "class long, root long, links long")
    )
    opened = scratch.table(opened, "opened")
    known = class_results(classes.select("class", F.col("doc_id").alias("id"), "copies"), opened, scratch)
    scratch.drop("texts", "cells")
    linked = full.select("doc_id", "n_shingles", "class").join(known, "class")
    rest = sketches.filter("n_shingles = 0 OR doc_id IS NULL")
    names = ["doc_id", "n_shingles", "n_links", "component_id"]
    return linked.select(names).union(
        rest.select("doc_id", "n_shingles", F.lit(0).cast("long"), F.col("doc_id"))
    ).toDF(*names)


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One document of each component: the one with the smallest doc_id.

    Of rows that repeat a doc_id and its text one row stays; documents without an id or without
    words all stay. All columns are kept.
    """
    scratch = Scratch(docs.sparkSession, "keep-first")
    found = scratch.table(jaccard_join(docs, **options), "found")
    others = scratch.table(found.filter("component_id <> doc_id").select("doc_id").distinct(), "others")
    kept = docs.join(others, "doc_id", "left_anti")
    repeated = scratch.table(
        found.filter("n_shingles > 0").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated"
    )
    if repeated.isEmpty():
        return kept
    return kept.join(repeated, "doc_id", "left_anti").unionByName(
        kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    )
