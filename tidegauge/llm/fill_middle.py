"""Fill-in-the-middle transformation of texts, with both cuts found by one repeated capture.

A text is matched as ``(unit)*`` by the regex library, which keeps every repetition of a group: the ends
of group 1 are the ends of all units, so their number is n and the k-th of them is the offset of a cut
after k units. Nothing is stepped through. A text of more than ``STRETCH`` units is matched in as many
stretches of that many units, which bounds the memory of a match and gives the same ends.

Where to cut, and which form a text takes, follows from a hash of its id, so the result depends neither
on partitions nor on retries. Cut offsets are all that Python returns; texts are put together and taken
apart again by Spark's own expressions.
"""

from __future__ import annotations

from array import array

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.llm.rows import Carried, own

STRETCH = 500_000  # units of one match
MARKS = ("<P>", "<S>", "<M>")  # fixed values: before the prefix, the suffix and the middle
COLUMNS = ("n", "form", "prefix_chars", "middle_chars", "output")


class Units:
    """The ends of all units of a text."""

    def __init__(self, unit: str, stretch: int = STRETCH):
        self.whole = regex.compile(f"({unit})*+", regex.DOTALL)
        self.part = regex.compile(f"({unit}){{1,{stretch}}}+", regex.DOTALL)
        self.stretch = stretch

    def ends(self, text: str) -> list[int] | array:
        if len(text) <= self.stretch:  # no unit is empty, so there are no more units than characters
            match = self.whole.fullmatch(text)
            if match is None:
                raise ValueError("the unit pattern does not cover the text")
            return match.ends(1)
        ends, at = array("q"), 0
        while at < len(text):
            match = self.part.match(text, at)
            if match is None or match.end() == at:
                raise ValueError("the unit pattern does not cover the text")
            ends.extend(match.ends(1))
            at = match.end()
        return ends


def _cuts(unit: str):
    @F.arrow_udf("struct<n:long,first:long,second:long>")
    def cuts(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        units, n, first, second = Units(unit), [], [], []
        for text, a, b in zip(texts, one.to_pylist(), two.to_pylist()):
            ends = units.ends(text.as_py())
            a, b = sorted((a % (len(ends) + 1), b % (len(ends) + 1)))
            n.append(len(ends))
            first.append(ends[a - 1] if a else 0)
            second.append(ends[b - 1] if b else 0)
        columns = [pa.array(c, pa.int64()) for c in (n, first, second)]
        return pa.StructArray.from_arrays(columns, ["n", "first", "second"])

    return cuts


def _numbers(doc: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers that the id and the seed give."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _has(text: Column, marks: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for mark in marks:
        found = found | text.contains(mark)
    return found


def fill_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 1,
    unit: str = ".",
    plain_percent: int = 10,
    spm_percent: int = 20,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (all by default) with the number of units ``n``, ``form``, ``output``, and
    ``prefix_chars`` and ``middle_chars``, the code points of prefix and middle.

    ``unit`` is what a cut never divides, as a pattern for the regex library: one code point by default,
    ``\\X`` for characters as readers see them, ``\\s*\\S+|\\s+`` for words. It must not match nothing and
    must cover every text. Prefix and middle end after a number of units each that the hash gives.

    ``plain_percent`` of the texts stay as they are, and so do empty ones and those that hold a mark;
    their counts of prefix and middle are null. Of the others ``spm_percent`` have the suffix first.
    A null text is taken as empty, a null id as an empty number. Equal ids are cut by equal numbers;
    rows are independent, so repeated rows give equal results and an empty table an empty one. Columns
    of ``docs`` with the names of new columns are replaced, others may have any name.
    """
    carried = Carried(docs, keep, COLUMNS)
    text = F.coalesce(own(text_col).cast("string"), F.lit(""))
    numbers = [x.alias(f"h{k}") for k, x in enumerate(_numbers(own(id_col), seed))]
    rows = docs.select(carried.packed, text.alias("text"), *numbers).withColumn("cut", _cuts(unit)("text", "h0", "h1"))
    text, first, second = F.col("text"), F.col("cut.first").cast("int"), F.col("cut.second").cast("int")
    plain = (text == "") | _has(text, MARKS) | (F.col("h2") % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(F.col("h3") % 100 < spm_percent, "spm").otherwise("psm")
    head, tail = F.substring(text, F.lit(1), first), F.substring(text, second + 1, F.length(text))
    middle = F.substring(text, first + 1, second - first)
    p, s, m = map(F.lit, MARKS)
    output = (
        F.when(F.col("form") == "plain", text)
        .when(F.col("form") == "psm", F.concat(p, head, s, tail, m, middle))
        .otherwise(F.concat(s, tail, p, head, m, middle))
    )
    cut = F.col("form") != "plain"
    return rows.withColumn("form", form).select(
        *carried.columns(),
        F.col("cut.n").alias("n"),
        "form",
        F.when(cut, F.col("cut.first")).alias("prefix_chars"),
        F.when(cut, F.col("cut.second") - F.col("cut.first")).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` in ``form`` was made from.

    No part holds a mark, and no mark begins inside another, so the first of each kind is the one
    that was put there.
    """
    p, s, m = MARKS
    psm = F.regexp_replace(output, rf"(?s)\A{p}(.*?){s}(.*?){m}(.*)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{s}(.*?){p}(.*?){m}(.*)\z", "$2$3$1")
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
