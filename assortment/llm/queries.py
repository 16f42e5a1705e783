"""Registered queries of the operators, each over its whole table with production parameters, and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assortment.llm import (
    chat_windows,
    decontaminate,
    hard_negatives,
    log_bilinear,
    packing,
    quality_gam,
    quality_rules,
    secret_scan,
    shards,
    simhash,
    url_rules,
    warc_index,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_gam.fit(docs, table(spark, sf_dir, "labels"))
    held = quality_gam.held_out(F.col("doc_id")).alias("held_out")
    scored = docs.select("doc_id", held, quality_gam.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality_gam.KEEP_FROM).cast("int"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archive = warc_index.archived(pages)
    found = archive.find(pages.select(warc_index.url_key(F.col("url")).alias("url_key")))
    return found.select(
        F.col("page").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"), "refers_to",
    )


ORACLES["op2_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest
"""


@query
def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judged(table(spark, sf_dir, "pages"), url_rules.rule_rows(spark))


ORACLES["op3_url_rules"] = """
WITH u AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(verdict, rh, rp) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (
  SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS verdict
  FROM u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT u.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN m ON u.page_id = m.page_id
"""


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), F.col("component").alias("component_id"))


@query
def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judged(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


ORACLES["op5_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], chr(10)) AS span
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
again AS (SELECT *, count(*) OVER (PARTITION BY doc_id, span) AS n FROM wins),
inside AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT doc_id, t, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals, length(regexp_replace(t, '[^!?]', '', 'g')) AS shouts,
    length(regexp_replace(t, '[^0-9]', '', 'g')) AS digits, len(string_split(t, chr(10))) AS all_lines,
    len(regexp_extract_all(t, '(?m)^[\x20\t]*[-*\x{2022}|]')) AS marks,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN inside USING (doc_id)),
b AS (
  SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (
  base_failed OR 20 * n_symbols > word_chars OR word_chars > 20 * n_words OR word_chars < 2 * n_words
  OR (n_dup_lines > 3 AND 10 * n_dup_lines > 3 * all_lines) OR 2 * capitals > word_chars OR 10 * shouts > word_chars
  OR 2 * digits > word_chars OR (4 * marks > 3 * all_lines AND n_words > 40)) AS kept
FROM b
"""


@query
def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shards.sharded(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", secret_scan.spans(F.col("text")).alias("found"))
    kinds = [rule.kind for rule in secret_scan.BASE]
    of = lambda *names: F.filter("found", lambda s: s["kind"].isin(*names))
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in kinds]
    digest = F.sha2(secret_scan.listed(of(*kinds)), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secret_scan.listed(F.col("found")).alias("spans"))


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def _secret_oracle() -> str:
    """Positions from the texts between matches; letters of keywords are written out in either case."""
    keywords = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
    value = r"""[A-Za-z0-9+/_.=-]+"""
    # kind, expression, group whose length counts, least length
    kinds = [
        ("assign", rf"""({keywords})[\"\x27]?\x20*[:=]\x20*[\"\x27]?({value})""", 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16),
        ("hex", "[0-9a-f]+", 0, 32), ("private_key", "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 0),
        ("github", "gh[opsur]_[A-Za-z0-9]{36,}", 0, 0),
        ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ]
    size = "coalesce(list_sum(list_transform({}, lambda x: length(x))), 0)"
    spans = " UNION ALL ".join(f"""
  SELECT doc_id, '{kind}' AS kind, {number} AS number, {size.format("gaps[1:i]")} + {size.format("hits[1:i - 1]")} AS start, length(hits[i]) AS n
  FROM (SELECT doc_id, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS hits,
      regexp_extract_all(t, '{pattern}', {group}) AS parts, unnest(range(1, len(regexp_extract_all(t, '{pattern}')) + 1)) AS i FROM d)
  WHERE length(parts[i]) >= {least}""" for number, (kind, pattern, group, least) in enumerate(kinds))
    listed = "string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + n AS BIGINT), ',' ORDER BY start, number)"
    counts = ", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind, *_ in kinds[:3])
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), s AS ({spans})
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN (
  SELECT doc_id, {counts}, {listed} FILTER (number < 3) AS base, {listed} AS spans FROM s GROUP BY doc_id) USING (doc_id)
"""


ORACLES["op7_secrets"] = _secret_oracle()


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        decontaminate.item_digest(F.col("item_ids")).alias("items_sha256"), "contaminated",
    )


ORACLES["op9_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(13, len(w)) AS size FROM b WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS span
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM bs)),
ds AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS span
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)),
h AS (SELECT doc_id, i, ds.size AS size, item_id FROM ds JOIN bw ON ds.span = bw.span AND ds.size = bw.size),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""


@query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("\\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text")
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    found = chat_windows.read_back(chat_windows.formatted(turns))
    return found.select(
        "conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, label = F.col("vec_id"), F.col("label").cast("long")
    moved = F.when(key % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = hard_negatives.rows_of_vectors(
        table(spark, sf_dir, "embeddings"), "vec_id", moved, "embedding", anchor=key % 100 == 0, scale=256
    )
    return hard_negatives.mined(rows)


ORACLES["op11_hard_negatives"] = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike,
    CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT alike AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= 5
"""


@query
def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return log_bilinear.scored(table(spark, sf_dir, "documents"), held)


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))
