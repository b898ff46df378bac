"""URL lists that change over time, applied as they stood when a page was fetched.

Dated changes of a list entry become validity intervals: from each change to the next one of the same
entry. A capture's URL gives the keys that entries could match; the keys that some list holds are joined
as of the fetch time with the interval that began last. Both steps cut time into chunks, so an entry with
a long history or a host with very many captures is not sorted in one task: within a chunk intervals and
captures are merged by time, and the interval that reaches into a chunk is handed on from the chunks
before, of which only the last interval of each takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegauge.llm.graph import small_side
from tidegauge.plans.neighbours import where_neighbours
from tidegauge.session import Scratch

CHUNK_MINUTES = 1440  # a key has one row a chunk where chunks are linked, so they are not short
_ENTRY = ["list", "kind", "pattern"]


def url_host(url: Column) -> Column:
    """Lower-cased host; empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def url_path(url: Column) -> Column:
    """Path without query and fragment, from its first slash."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)", 1)


def _match_keys(captures: DataFrame) -> DataFrame:
    """Add kind and pattern: the host, each of its domains, and each path prefix with the host."""
    parts = captures.withColumns(
        {
            "labels": F.split(url_host(F.col("url")), r"\."),
            "steps": F.split(F.rtrim(url_path(F.col("url")), F.lit("/")), "/"),
            "host": url_host(F.col("url")),
        }
    ).filter("host <> ''")
    domains = F.transform(
        F.sequence(F.lit(1), F.size("labels")),
        lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice("labels", i, F.size("labels")), ".").alias("pattern")),
    )
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size("steps")),
        lambda i: F.struct(
            F.lit("prefix").alias("kind"), F.concat("host", F.array_join(F.slice("steps", F.lit(1), i), "/")).alias("pattern")
        ),
    )
    host = F.array(F.struct(F.lit("host").alias("kind"), F.col("host").alias("pattern")))
    keys = F.explode(F.concat(host, domains, prefixes)).alias("k")
    return parts.select(*captures.columns, keys).select(*captures.columns, "k.kind", "k.pattern")


def _chunk(time: str, minutes: int) -> Column:
    """Number of the chunk a time lies in; times are UTC wall-clock times."""
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(time))
    return F.floor(seconds / (60 * minutes))


def intervals(changes: DataFrame, minutes: int = CHUNK_MINUTES) -> DataFrame:
    """list, kind, pattern, action, valid_from, valid_to (null: until further notice).

    ``changes`` has list, kind (host, domain or prefix), pattern, action (block, allow or clear) and at.
    Of changes of one entry at one time the last by name counts, so clear before block before allow.
    Rows with a null are left out; patterns are compared in lower case up to the host's end.
    """
    known = changes.select(*_ENTRY, "action", F.col("at").cast("timestamp_ntz").alias("at")).dropna()
    host = F.lower(F.substring_index("pattern", "/", 1))
    tail = F.rtrim(F.expr("substr(pattern, length(substring_index(pattern, '/', 1)) + 1)"), F.lit("/"))
    known = known.withColumn("pattern", F.concat(host, tail))
    one = known.groupBy(*_ENTRY, "at").agg(F.max("action").alias("action"))
    linked = where_neighbours(one, _ENTRY, _chunk("at", minutes), ["at"], ["at"], F.lit(True))
    return linked.select(*_ENTRY, "action", F.col("at").alias("valid_from"), F.col("next_at").alias("valid_to"))


PART_ROWS = 100_000  # rows of one key and chunk that go to one task


def parted(rows: DataFrame, counts: DataFrame, scratch: Scratch, salt: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` (key, chunk and more) with their ``part``, and how many ``parts`` the hot ones have.

    ``counts`` has n, the rows of each key and chunk. Those with more than ``PART_ROWS`` are dealt by a hash
    of ``salt``; there is at most one of them for that many rows. Without any the second result is None.
    """
    hot = counts.filter(F.col("n") > PART_ROWS).select("key", "chunk", F.ceil(F.col("n") / PART_ROWS).alias("parts"))
    hot = scratch.table(hot, "hot")
    n = hot.count()
    if not n:
        return rows.withColumn("part", F.lit(0).cast("long")), None
    dealt = F.pmod(F.xxhash64(*salt), F.coalesce("parts", F.lit(1)))
    return rows.join(small_side(hot, n), ["key", "chunk"], "left").withColumn("part", dealt).drop("parts"), small_side(hot, n)


def _to_parts(spans: DataFrame, hot: DataFrame | None) -> DataFrame:
    """A copy of each row for every part of its key and chunk."""
    if hot is None:
        return spans.withColumn("part", F.lit(0).cast("long"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1).cast("long")) - 1))
    return spans.join(hot, ["key", "chunk"], "left").withColumn("part", every).drop("parts")


def as_of(rows: DataFrame, spans: DataFrame, minutes: int = CHUNK_MINUTES) -> DataFrame:
    """``rows`` (key, at and more) with ``action`` of the span (key, valid_from, valid_to, action) of the
    same key that holds ``at``; null where none does. Spans of a key do not overlap.

    Rows are sorted with the spans of their key and chunk of time. Where those are very many, several
    tasks each take a part of the rows and all spans of the chunk.
    """
    scratch = Scratch(rows.sparkSession, "as-of")
    state = F.struct("valid_from", "valid_to", "action")
    spans = spans.withColumns({"chunk": _chunk("valid_from", minutes), "state": state})
    rows = rows.withColumn("chunk", _chunk("at", minutes))
    extra = [c for c in rows.columns if c not in ("key", "chunk", "at")]
    counts = scratch.table(rows.groupBy("key", "chunk").agg(F.count("*").alias("n")), "counts")
    rows, hot = parted(rows, counts, scratch, ["at", *extra])

    last = spans.groupBy("key", "chunk").agg(F.max("state").alias("last"))
    seen = counts.select("key", "chunk", F.lit(None).cast(last.schema["last"].dataType).alias("last"))
    chunks = last.union(seen).groupBy("key", "chunk").agg(F.max("last").alias("last"))
    before = Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.withColumn("state", F.last("last", ignorenulls=True).over(before)).filter("state IS NOT NULL")

    none = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in extra]
    place, nothing = ["key", "chunk", "part"], F.lit(None).cast(last.schema["last"].dataType).alias("state")
    merged = (
        rows.select(*place, "at", F.lit(2).alias("turn"), nothing, *extra)
        .union(_to_parts(spans, hot).select(*place, "valid_from", F.lit(1), "state", *none))
        .union(_to_parts(carried, hot).select(*place, F.lit(None).cast("timestamp_ntz"), F.lit(0), "state", *none))
    )
    order = Window.partitionBy(*place).orderBy(F.col("at").asc_nulls_first(), "turn")
    order = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = merged.withColumn("state", F.last("state", ignorenulls=True).over(order)).filter("turn = 2")
    holds = F.col("state.valid_to").isNull() | (F.col("at") < F.col("state.valid_to"))
    return found.select("key", "at", *extra, F.when(holds, F.col("state.action")).alias("action"))


def url_verdicts(captures: DataFrame, changes: DataFrame, minutes: int = CHUNK_MINUTES) -> DataFrame:
    """page_id, url, fetched_at, n_block, n_allow, blocked, copies: one row per distinct capture.

    n_block and n_allow count the entries, of any list, that match the URL and were in force at the fetch
    time, the moment of a change included. A capture is blocked if some entry blocks it and none allows
    it. A host entry matches that host, a domain entry the host and all below it, a prefix entry the URLs
    whose host and path begin with it up to the end of a path segment.

    A null or malformed URL matches nothing, and at a null time nothing is in force. Repeated captures are
    one row, ``copies`` tells how many. Further columns are not looked at; without captures the result
    is empty, without changes nothing is blocked.
    """
    scratch = Scratch(captures.sparkSession, "url-filter")
    names = ["page_id", "url", "fetched_at"]
    once = captures.select("page_id", "url", F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"))
    once = scratch.table(once.groupBy(*names).agg(F.count("*").alias("copies")), "captures")
    spans = scratch.table(intervals(changes, minutes), "intervals")
    entries = scratch.table(spans.select(*_ENTRY).distinct(), "entries")
    keyed = _match_keys(once.filter("url IS NOT NULL AND fetched_at IS NOT NULL").select(*names))
    keyed = scratch.table(keyed, "keys").join(entries, ["kind", "pattern"])
    key = F.xxhash64(*_ENTRY).alias("key")
    state = as_of(
        keyed.select(key, F.col("fetched_at").alias("at"), "page_id", "url"),
        spans.select(key, "valid_from", "valid_to", "action"),
        minutes,
    )
    is_ = lambda a: F.when(F.col("action") == a, 1).otherwise(0).cast("long")
    hits = state.filter("action IN ('block', 'allow')").select(
        "page_id", "url", F.col("at").alias("fetched_at"), F.lit(0).cast("long").alias("copies"), is_("block").alias("b"),
        is_("allow").alias("a"),
    )
    none = F.lit(0).cast("long")
    total = once.select(*names, "copies", none.alias("b"), none.alias("a")).union(hits).groupBy(*names)
    total = total.agg(F.sum("b").alias("n_block"), F.sum("a").alias("n_allow"), F.sum("copies").alias("copies"))
    return total.withColumn("blocked", (F.col("n_block") > 0) & (F.col("n_allow") == 0))
