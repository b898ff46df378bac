"""Registered queries of the operators in this package, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegauge.llm import byte_bpe, pair_index_bpe, token_records
from tidegauge.llm.class_lm import lm_scores
from tidegauge.llm.decontaminate import contaminated
from tidegauge.llm.fill_middle import fill_middle, restored
from tidegauge.llm.jaccard_join import jaccard_join
from tidegauge.llm.language_id import identify
from tidegauge.llm.near_vectors import near_vectors
from tidegauge.llm.substring_dedup import repeated_passages
from tidegauge.llm.url_filter import url_host, url_path, url_verdicts
from tidegauge.llm.warc import read_warc, write_warc
from tidegauge.llm.whitening import whiten
from tidegauge.session import scratch_path


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label whose cosine is 0.98 or more."""
    return near_vectors(_read(spark, sf_dir, "embeddings"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of documents that repeat a benchmark item."""
    return contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by naive Bayes over hashed character n-grams."""
    return identify(_read(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the bytes decoded from them."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_bpe.encode(_read(spark, sf_dir, "documents"), f"file://{path}", pattern, keep=["doc_id"])
    return byte_bpe.decode(encoded, f"file://{path}").select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of fifty words or more that repeat one of an earlier document."""
    return repeated_passages(_read(spark, sf_dir, "documents"))


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, as read back from the record files."""
    root = scratch_path(spark, "token-records")
    path = f"file://{public_tokenizers.path('byte_bpe_50k.json')}"
    token_records.write_records(_read(spark, sf_dir, "documents"), root, path, end=0)
    return token_records.read_records(spark, root).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, as read back from the archives."""
    path = scratch_path(spark, "warc")
    write_warc(_read(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).select(
        "page_id",
        F.coalesce(F.octet_length("payload").cast("long"), F.col("payload_bytes")).alias("payload_bytes"),
        "payload_digest", "record_type", "refers_to",
    )


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages, each fetched at a minute of the year that its number gives."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    minute = (F.col("page_id") * 7919 % 525600).cast("int")
    return _read(spark, sf_dir, "pages").select(
        "page_id", "url", F.timestamp_add("MINUTE", minute, start).alias("fetched_at")
    )


def _list_changes(captures: DataFrame) -> DataFrame:
    """A dated list change that each capture causes 30 days later, of the list of its first folder."""
    host, folder = url_host(F.col("url")), F.split_part(url_path(F.col("url")), F.lit("/"), F.lit(2))
    kind = F.when(host.startswith("m."), "host").when(host.startswith("blog.") | host.startswith("www."), "domain")
    kind = kind.otherwise("prefix")
    pattern = F.when(kind == "host", host).when(kind == "domain", F.regexp_replace(host, r"^[^.]*\.", ""))
    action = F.when(F.col("url").contains("?"), "allow").when(F.col("url").contains("#"), "clear").otherwise("block")
    return captures.select(
        folder.alias("list"), kind.alias("kind"), pattern.otherwise(F.concat(host, F.lit("/"), folder)).alias("pattern"),
        action.alias("action"), F.timestamp_add("DAY", F.lit(30), F.col("fetched_at")).alias("at"),
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the lists as they stood when it was fetched."""
    captures = _captures(spark, sf_dir)
    return url_verdicts(captures, _list_changes(captures))


def op9_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document by a class-based bigram model and by its unigram base."""
    return lm_scores(_read(spark, sf_dir, "documents"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with nine tenths or more of their three-word shingles in common."""
    return jaccard_join(_read(spark, sf_dir, "documents"))


def op11_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text decoded from them."""
    path = f"file://{public_tokenizers.path('byte_bpe_50k.json')}"
    encoded = pair_index_bpe.encode(_read(spark, sf_dir, "documents"), path, keep=["doc_id"])
    return pair_index_bpe.decode(encoded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the components of the exact scatter, one row for each of them."""
    rows = whiten(_read(spark, sf_dir, "embeddings"), keep=["vec_id"])
    return rows.select("*", F.posexplode("whitened").alias("place", "value")).select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", "deviation",
        F.col("value").alias("whitened"), F.get("explained", "place").alias("explained"), "identity_error",
    )


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut in three and put together for infilling, and the text rebuilt from that."""
    cut = fill_middle(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_near_vectors": op1_near_vectors,
    "op2_decontamination": op2_decontamination,
    "op3_language_id": op3_language_id,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_token_records": op6_token_records,
    "op7_warc": op7_warc,
    "op8_url_filter": op8_url_filter,
    "op9_class_lm": op9_class_lm,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_pair_index_bpe": op11_pair_index_bpe,
    "op12_whitening": op12_whitening,
    "op13_fill_middle": op13_fill_middle,
}

_REACHED = """
      e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
      reached(id, other) AS (
        SELECT id, id FROM n UNION SELECT r.id, e.b FROM reached r JOIN e ON e.a = r.other)"""

SQL = {
    "op1_near_vectors": f"""
      WITH RECURSIVE n AS (SELECT vec_id AS id FROM embeddings),
      v AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
        WHERE label IS NOT NULL AND len(embedding) > 0 AND list_max(list_transform(embedding, lambda c: abs(c))) > 0
          AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
      l AS (
        SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id < q.vec_id
        WHERE len(p.x) = len(q.x) AND list_cosine_similarity(p.x, q.x) >= 0.98),{_REACHED},
      c AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id),
      k AS (SELECT a AS id, count(*) AS links FROM e GROUP BY a)
      SELECT id AS vec_id, coalesce(links, 0) AS n_links, component_id, id = component_id AS kept
      FROM c LEFT JOIN k USING (id)""",
    "op10_ngram_jaccard_join": rf"""
      WITH RECURSIVE w AS (
        SELECT doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x20\x09-\x0D]+') AS w FROM documents),
      g AS (
        SELECT id, CASE WHEN len(w) < 3 THEN [w] ELSE list_distinct([w[i : i + 2] FOR i IN range(1, len(w) - 1)]) END AS g
        FROM w WHERE len(w) > 0),
      n AS (SELECT w.id, coalesce(len(g), 0) AS size FROM w LEFT JOIN g USING (id)),
      s AS (SELECT id, unnest(g) AS s FROM g),
      p AS (
        SELECT x.id AS a, y.id AS b, count(*) AS shared FROM s x JOIN s y ON x.s = y.s AND x.id < y.id GROUP BY 1, 2),
      l AS (
        SELECT a, b FROM p JOIN n na ON na.id = a JOIN n nb ON nb.id = b
        WHERE 100 * shared >= 90 * (na.size + nb.size - shared)),{_REACHED},
      c AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id),
      k AS (SELECT a AS id, count(*) AS links FROM e GROUP BY a)
      SELECT id AS doc_id, size AS n_shingles, coalesce(links, 0) AS n_links, component_id
      FROM n JOIN c USING (id) LEFT JOIN k USING (id)""",
    "op8_url_filter": r"""
      WITH c AS (
        SELECT page_id, url, TIMESTAMP '2024-01-01' + to_minutes(CAST(page_id * 7919 % 525600 AS BIGINT)) AS t,
               lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
               regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1) AS path
        FROM pages),
      d AS (
        SELECT split_part(path, '/', 2) AS list, t + INTERVAL 30 DAY AS since, host,
               CASE WHEN host LIKE 'm.%' THEN 'host' WHEN host LIKE 'blog.%' OR host LIKE 'www.%' THEN 'domain'
                    ELSE 'prefix' END AS kind,
               CASE WHEN contains(url, '?') THEN 'allow' WHEN contains(url, '#') THEN 'clear' ELSE 'block' END AS action
        FROM c),
      e AS (
        SELECT list, kind, since, max(action) AS action,
               CASE kind WHEN 'host' THEN host WHEN 'domain' THEN regexp_replace(host, '^[^.]*\.', '')
                    ELSE host || '/' || list END AS pattern
        FROM d GROUP BY ALL),
      i AS (
        SELECT *, lead(since) OVER (PARTITION BY list, kind, pattern ORDER BY since) AS until FROM e),
      m AS (
        SELECT c.page_id, c.url, c.t, i.action FROM c JOIN i
          ON c.t >= i.since AND (i.until IS NULL OR c.t < i.until)
         AND CASE i.kind WHEN 'host' THEN c.host = i.pattern
                         WHEN 'domain' THEN c.host = i.pattern OR ends_with(c.host, '.' || i.pattern)
                         ELSE starts_with(rtrim(c.host || c.path, '/') || '/', i.pattern || '/') END)
      SELECT c.page_id, c.url, c.t AS fetched_at,
             count(*) FILTER (m.action = 'block') AS n_block, count(*) FILTER (m.action = 'allow') AS n_allow,
             CAST(1 AS BIGINT) AS copies,
             count(*) FILTER (m.action = 'block') > 0 AND count(*) FILTER (m.action = 'allow') = 0 AS blocked
      FROM c LEFT JOIN m USING (page_id, url) GROUP BY ALL""",
    "op13_fill_middle": """
      WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h FROM documents),
      n AS (
        SELECT doc_id, t, length(t) AS n,
               list_transform([1, 9, 17, 25], lambda i: CAST('0x' || h[i : i + 7] AS BIGINT)) AS h FROM d),
      c AS (
        SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
               CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90
                    THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
      p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c)
      SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
             CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
             sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
             sha256(pre || mid || suf) AS restored_sha256
      FROM p""",
}
