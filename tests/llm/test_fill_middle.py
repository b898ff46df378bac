"""Fill-in-the-middle: against the definition, an exact round trip, and odd rows."""

import hashlib
import random

import pytest
import regex
from llm.helpers import DOCS, SF, by_id
from pyspark.sql import functions as F

from tidegauge.llm import queries
from tidegauge.llm.fill_middle import MARKS, Units, fill_middle, restored


def expected(doc, text, units=None):
    text = text or ""
    units = list(text) if units is None else units
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def odd_texts():
    rng = random.Random(5)
    alphabet = "ab \n<PSM>é漢😀́\r$\\"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    return texts + ["", None, "x", "<P>", "a<S>b", "<M", "P><S", "<<P", "\n", "$1\\$2", "same", "same", "long " * 40_000]


def check(df, rows, units=lambda t: None):
    got = by_id(df)
    for doc, text in rows:
        for r in got[doc]:
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected(doc, text, units(text))
            assert r.restored == (text or "")


def test_against_the_definition(spark):
    rows = list(enumerate(odd_texts()))
    rows += [(None, "an id is missing"), (7, rows[7][1])]
    df = spark.createDataFrame([(i, t, "en", None, 0) for i, t in rows], DOCS)
    out = fill_middle(df).withColumn("restored", restored(F.col("output"), F.col("form")))
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert out.count() == len(rows)
    assert {r.form for r in out.select("form").distinct().collect()} == {"plain", "psm", "spm"}
    check(out, rows)


def test_units_of_words_are_not_divided(spark):
    rows = [(i, t) for i, t in enumerate(odd_texts()) if t]
    df = spark.createDataFrame([(i, t, "en", None, 0) for i, t in rows], DOCS)
    out = fill_middle(df, unit=r"\s*\S+|\s+").withColumn("restored", restored(F.col("output"), F.col("form")))
    check(out, rows, lambda t: regex.findall(r"\s*\S+|\s+", t))


def test_stretches_give_the_ends_of_one_match():
    for text in ("", "a", "abc" * 50, "é漢😀" * 21):
        assert list(Units(".", 7).ends(text)) == list(Units(".").ends(text))
        assert list(Units(r"\X", 2).ends(text)) == list(Units(r"\X").ends(text))
    with pytest.raises(ValueError, match="cover"):
        Units("a").ends("ab")
    with pytest.raises(ValueError, match="cover"):
        Units("a", 1).ends("ab")


def test_clashing_names_empty_tables_and_partitions(spark):
    schema = "n long, text string, form string, row string, cut string, h0 long, `a.b` string, doc_id long"
    one = spark.createDataFrame([(9, "some text here", "f", "r", "c", 1, "dot", 3)], schema)
    out = fill_middle(one)
    assert out.columns == ["text", "row", "cut", "h0", "a.b", "doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    r = out.first()
    assert (r.row, r.cut, r.h0, r["a.b"], r.n) == ("r", "c", 1, "dot", 14)
    assert fill_middle(one.limit(0)).count() == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = lambda df: sorted(fill_middle(df, keep=["doc_id"]).collect())
    assert rows(docs) == rows(docs.repartition(13))


def test_shares(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("words of a text").alias("text"))
    n = {r.form: r["count"] for r in fill_middle(df).groupBy("form").count().collect()}
    assert abs(n["plain"] / 20_000 - 0.1) < 0.01
    assert abs(n["spm"] / 18_000 - 0.2) < 0.01


def test_query_matches_sql(spark):
    from compare import duck, duck_rows, spark_rows

    got = spark_rows(queries.QUERIES["op13_fill_middle"](spark, SF))
    assert got == duck_rows(duck(SF), queries.SQL["op13_fill_middle"])
