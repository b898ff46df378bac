"""Benchmark items in documents: SimHash of item-sized windows, Hamming index, exact similarity.

All steps are DataFrame operations. A window has as many words as a benchmark item, and lies where a
shingle of the document equals one of the item at the same offset. Similarity knows no order, so where
no such window is similar, all windows that hold enough of the item's shingles are taken too. Each window's fingerprint is the SimHash
of its shingles, weighted by how often they occur. Fingerprints are cut into ``radius + 1`` blocks: two
within the radius agree in at least one block, so a join on the blocks finds all of them. The pairs
found are then compared exactly by the weighted Jaccard similarity of their shingles.

Documents are first probed at a stride that the threshold and the shortest item allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.llm.graph import small_side
from tidegauge.session import Scratch

SIZE = 5
PERCENT = 80
BITS = 64
RADIUS = 20  # at similarity 0.8 the distance is 9.7 on average with a deviation of 2.9


def word_array(text: Column) -> Column:
    """Lower-cased runs between ASCII white space; empty for null and blank texts."""
    trimmed = F.btrim(F.lower(text), F.lit(" \t\n\x0b\f\r"))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, "[\\x20\\x09-\\x0D]+")
    )


def _with_hashes(rows: DataFrame, text: Column) -> DataFrame:
    """Add ``hashes``, those of the words.

    The generator keeps the array from being computed again wherever it is used.
    """
    hashes = F.transform(word_array(text), lambda w: F.xxhash64(w))
    return rows.select(*rows.columns, F.explode(F.array(hashes)).alias("hashes"))


def with_shingles(rows: DataFrame, text: Column, size: int = SIZE) -> DataFrame:
    """Add n_words, and ``shingles``: the hash of each run of ``size`` words, in order.

    The word hashes are a column of their own, zipped with themselves at each offset, so that no
    function over an element has to reach back into the array.
    """
    hashed = _with_hashes(rows, text)
    count = F.greatest(F.size("hashes") - size + 1, F.lit(0))
    runs = F.arrays_zip(*(F.slice("hashes", j + 1, count).alias(f"h{j}") for j in range(size)))
    return hashed.withColumns({"n_words": F.size("hashes"), "runs": runs}).drop("hashes").withColumn(
        "shingles", F.transform("runs", lambda r: F.xxhash64(*(r[f"h{j}"] for j in range(size))))
    ).drop("runs")


def with_sampled_shingles(rows: DataFrame, text: Column, stride: int, size: int = SIZE) -> DataFrame:
    """Add ``shingles``: the hashes of the runs of ``size`` words that start at every ``stride``-th word."""
    hashed = _with_hashes(rows, text)
    last = F.size("hashes") - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(stride)))
    shingle = lambda i: F.xxhash64(*(F.get("hashes", i + j) for j in range(size)))
    return hashed.select(*rows.columns, F.transform(starts, shingle).alias("shingles"))


def stride_of(shingles: int, percent: int) -> int:
    """How far apart a text may be probed for an item of so many shingles, without missing it.

    A window that reaches the threshold lacks at most u of the item's n shingles, and every break
    between runs of shingles found in a row costs at least one. So the n - u others form at most u + 1
    runs, and one of them is as long as the stride if n - u > (stride - 1) * (u + 1).
    """
    u = shingles * (100 - percent) // 100
    return max((shingles - u - 1) // (u + 1) + 1, 1)


def simhash(shingles: Column) -> Column:
    """Fingerprint of BITS bits; a shingle counts as often as it occurs.

    ``shingles`` must be a stored column: each bit goes over it once.
    """
    votes = F.transform(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        lambda b: F.aggregate(
            shingles, F.lit(0), lambda acc, h: acc + F.lit(1) - F.lit(2) * F.call_function("getbit", h, b)
        ),
    )
    return F.aggregate(
        votes, F.lit(0).cast("long"),
        lambda acc, v: F.shiftleft(acc, 1).bitwiseOR(F.when(v < 0, 1).otherwise(0).cast("long")),
    )


def _blocks(fingerprint: Column, radius: int) -> Column:
    """(number, bits) of the radius + 1 blocks of a fingerprint, as even as they can be."""
    edges = [BITS * k // (radius + 1) for k in range(radius + 2)]
    return F.array(
        *(
            F.struct(
                F.lit(k).alias("block"),
                F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")).alias("bits"),
            )
            for k, (a, b) in enumerate(zip(edges, edges[1:]))
        )
    )


def _starts_by_count(sequences: DataFrame, items: DataFrame, n_known: int, percent: int, size: int) -> DataFrame:
    """doc_id, item_id, n_words, start of the windows that hold enough of an item's shingles, in any order.

    A similar window has at least ``percent`` / 100 as many known shingles as the item has shingles, so
    some run of that many hits in a row lies inside it.
    """
    counts = items.select("item_id", "of_item", "n_words", F.explode("shingles").alias("shingle"))
    wanted = counts.groupBy("item_id", "of_item", "n_words", "shingle").agg(F.count("*").alias("cap"))
    texts = sequences.select(
        "doc_id", F.xxhash64("shingles").alias("of_text"), F.size("shingles").alias("n"),
        F.posexplode("shingles").alias("pos", "shingle"),
    )
    text = ["doc_id", "of_text", "n", "item_id", "of_item", "n_words"]
    hits = texts.join(small_side(wanted, n_known), "shingle").select(*text, F.struct("pos", "shingle", "cap").alias("hit"))
    places = hits.distinct().groupBy(*text).agg(F.sort_array(F.collect_list("hit")).alias("hits"))
    length = F.col("n_words") - size + 1
    least = F.greatest(F.ceil(length * percent / 100).cast("int"), F.lit(1))
    runs = places.filter(F.size("hits") >= least).select(*text, "hits", F.posexplode("hits").alias("i", "hit"))
    first, last = F.col("hit.pos"), F.get("hits", F.col("i") + least - 1)["pos"]
    start = F.greatest(last - length + 1, F.lit(0))
    runs = runs.filter(start <= first).select(*text, F.explode(F.sequence(start, first)).alias("start")).distinct()
    # What a window and the item have in common is at most its hits, and at most the item's own counts.
    inside = F.filter("hits", lambda h: (h["pos"] >= F.col("start")) & (h["pos"] < F.col("start") + length))
    kinds = F.array_distinct(F.transform("inside", lambda h: F.struct(h["shingle"], h["cap"].alias("cap"))))
    capped = F.aggregate(kinds, F.lit(0).cast("long"), lambda acc, h: acc + h["cap"])
    need = (length + F.least(length, F.col("n") - F.col("start"))) * percent
    known = runs.join(places, text).select("doc_id", "item_id", "n_words", "start", "n", F.explode(F.array(inside)).alias("inside"))
    return known.filter(F.least(F.size("inside"), capped) * (100 + percent) >= need).select(
        "doc_id", "item_id", "n_words", "start"
    ).distinct()


def _matches(
    starts: DataFrame, texts: DataFrame, items: DataFrame, n_items: int, n_known: int, percent: int, size: int,
    radius: int, scratch: Scratch, name: str,
) -> DataFrame:
    """The windows (doc_id, n_words, start) that are similar to an item of their size."""
    wanted = starts.groupBy("doc_id").agg(F.collect_set(F.struct("start", "n_words")).alias("windows"))
    found = scratch.table(wanted, f"{name}-wanted")
    found = with_shingles(texts.join(found, "doc_id"), F.col("text"), size).drop("text", "n_words")
    windows = found.select("doc_id", "shingles", F.explode("windows").alias("w")).select(
        "doc_id", "w.start", "w.n_words",
        F.slice("shingles", F.col("w.start") + 1, F.col("w.n_words") - size + 1).alias("shingles"),
    )
    # Rows that repeat give equal windows; rows of one id with different texts keep theirs apart.
    windows = windows.filter(F.size("shingles") > 0).withColumn("of_doc", F.xxhash64("doc_id", "start", "shingles"))
    windows = scratch.table(windows.dropDuplicates(["of_doc"]), f"{name}-window-shingles")
    windows = scratch.table(windows.withColumn("print", simhash(F.col("shingles"))), f"{name}-windows")

    block = F.explode(_blocks(F.col("print"), radius)).alias("b")
    left = windows.select("doc_id", "of_doc", "start", "n_words", "print", block)
    left = left.select("doc_id", "of_doc", "start", "n_words", "print", "b.block", "b.bits")
    right = items.select("item_id", "of_item", "n_words", "print", block)
    right = right.select("item_id", "of_item", "n_words", F.col("print").alias("item_print"), "b.block", "b.bits")
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    near = (
        left.join(small_side(right, n_items * (radius + 1)), ["n_words", "block", "bits"])
        .filter(distance <= radius)
        .select("doc_id", "of_doc", "start", "n_words", "item_id", "of_item", distance.alias("distance"))
        .distinct()
    )
    near = scratch.table(near, f"{name}-near")

    key = near.columns
    one, none = F.lit(1), F.lit(0)
    both = (
        near.join(windows.select("of_doc", "shingles"), "of_doc")
        .select(*key, F.explode("shingles").alias("shingle"), one.alias("mine"), none.alias("theirs"))
        .union(
            near.join(small_side(items.select("of_item", "shingles"), n_known), "of_item")
            .select(*key, F.explode("shingles").alias("shingle"), none, one)
        )
    )
    counted = both.groupBy(*key, "shingle").agg(F.sum("mine").alias("mine"), F.sum("theirs").alias("theirs"))
    sums = counted.groupBy(*key).agg(
        F.sum(F.least("mine", "theirs")).alias("common"), F.sum(F.greatest("mine", "theirs")).alias("either")
    )
    return sums.filter(F.col("common") * 100 >= F.col("either") * percent).select(
        "doc_id", "item_id", F.col("start").cast("long").alias("start"), F.col("n_words").cast("long").alias("n_words"),
        F.col("distance").cast("long").alias("distance"), (F.col("common") / F.col("either")).alias("similarity"),
    ).distinct()


def contaminated(
    docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, size: int = SIZE, radius: int = RADIUS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, start, n_words, distance, similarity of every window that repeats an item.

    ``start`` counts words. Of overlapping windows for one item each that reaches ``percent`` / 100 is
    given, or only those that have a shingle at the item's own offset if there are any. Null, blank and
    short texts and items, of fewer than ``size`` words, have no shingle and match nothing; rows without
    an id are left out. Items or documents that repeat give their pairs once per id. Other columns are not looked at; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    items = with_shingles(benchmark.select(F.col("item_id").cast("long"), F.col("text")), F.col("text"), size)
    items = items.drop("text").filter("item_id IS NOT NULL AND n_words >= %d" % size).distinct()
    items = scratch.table(items, "item-shingles")
    items = items.withColumns({"print": simhash(F.col("shingles")), "of_item": F.xxhash64("item_id", "shingles")})
    items = scratch.table(items, "items")
    known = items.select("n_words", F.posexplode("shingles").alias("at", "shingle")).distinct()
    known = scratch.table(known, "known")
    n_known, n_items = known.count(), items.count()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.filter("doc_id IS NOT NULL")
    # Most documents hold no item: those that do are found by probing a part of their shingles.
    least = items.agg(F.min("n_words")).first()[0] or size
    stride = stride_of(least - size + 1, percent)
    probes = with_sampled_shingles(texts, F.col("text"), stride, size).select("doc_id", F.explode("shingles").alias("shingle"))
    suspects = probes.join(small_side(known.select("shingle").distinct(), n_known), "shingle", "left_semi")
    suspects = scratch.table(suspects.select("doc_id").distinct(), "suspects")
    n_suspects = suspects.count()
    texts = scratch.table(texts.join(small_side(suspects, n_suspects), "doc_id"), "suspect-texts")
    sequences = with_shingles(texts, F.col("text"), size)
    hits = sequences.select("doc_id", F.posexplode("shingles").alias("pos", "shingle")).join(
        small_side(known, n_known), "shingle"
    )
    starts = hits.select("doc_id", "n_words", F.greatest(F.col("pos") - F.col("at"), F.lit(0)).alias("start"))
    starts = scratch.table(starts.distinct(), "starts")

    aligned = scratch.table(_matches(starts, texts, items, n_items, n_known, percent, size, radius, scratch, "aligned"), "aligned")
    # Shingles in another order: windows with enough of an item's, wherever no aligned one was found.
    overlap = F.abs(F.col("start") - F.col("at_start")) < F.col("n_words")
    taken = aligned.select("doc_id", "item_id", F.col("start").alias("at_start")).distinct()
    others = _starts_by_count(sequences, items, n_known, percent, size).join(
        taken.withColumnsRenamed({"doc_id": "d", "item_id": "i"}),
        (F.col("doc_id") == F.col("d")) & (F.col("item_id") == F.col("i")) & overlap, "left_anti",
    )
    others = scratch.table(others.select("doc_id", "n_words", "start").distinct(), "other-starts")
    moved = _matches(others, texts, items, n_items, n_known, percent, size, radius, scratch, "moved")
    moved = moved.join(
        taken.withColumnsRenamed({"doc_id": "d", "item_id": "i"}),
        (F.col("doc_id") == F.col("d")) & (F.col("item_id") == F.col("i")) & overlap, "left_anti",
    )
    return aligned.union(moved)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, in which no benchmark item was found."""
    scratch = Scratch(docs.sparkSession, "clean")
    found = scratch.table(contaminated(docs, benchmark, **options).select("doc_id").distinct(), "found")
    return docs.join(found, "doc_id", "left_anti")
