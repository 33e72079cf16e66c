"""The registered queries of this package, over whole tables, and SQL where it can express them."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import (
    bpe,
    byte_bpe,
    decontaminate,
    language,
    lines,
    merkle,
    minhash,
    negatives,
    phrases,
    quality,
    repeats,
    secrets,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@lru_cache(maxsize=1)
def tokenizers_folder() -> str:
    """Where the public vocabularies lie: ``HEADWAY_TOKENIZERS``, else the installed package."""
    if folder := os.environ.get("HEADWAY_TOKENIZERS"):
        return folder
    import public_tokenizers

    return os.path.dirname(public_tokenizers.path("word_bpe_49k.json"))


def vocabulary(name: str) -> str:
    return os.path.join(tokenizers_folder(), name)


@query
def op2_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf, "documents"), vocabulary(secrets.VOCABULARY))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_random"
    )


@query
def op6_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf, "pages"), url_filter.rules_frame(spark, URL_RULES))


ORACLE["op6_url_filter"] = r"""
WITH split AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)
), rules(r_host, r_path, r_verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
  SELECT page_id, r_host || r_path AS rule, r_verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(r_host || r_path) DESC, length(r_host) DESC) AS n
  FROM split JOIN rules
    ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
)
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.r_verdict, 'allow') AS verdict
FROM split s LEFT JOIN fits f ON f.page_id = s.page_id AND f.n = 1
"""


@query
def op7_bpe(spark: SparkSession, sf: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op1_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op3_phrase_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.fingerprint_neighbours(table(spark, sf, "documents"))


@query
def op4_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf, "documents"))


@query
def op5_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf, "documents")).drop("starts", "ends")


@query
def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    shortened = lines.dedup_lines(docs)
    return shortened.select(
        "doc_id",
        F.greatest(F.coalesce("lines_removed", F.lit(0)), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("partners", F.lit(0)).cast("long").alias("n_partners"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query
def op9_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = language.train(language.training_sample(docs))
    found = language.identify(docs, model)
    return found.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = quality.score_quality(docs, quality.fit(docs, table(spark, sf, "labels")))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int")
    return found.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted")
    )


@query
def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings")
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", relabelled), F.col("vec_id") % 100 == 0)


ORACLE["op11_hard_negatives"] = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x AS double)) AS bigint)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  cast(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS integer) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""


@query
def op12_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    coded = byte_bpe.encode_decode(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.tiktoken"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    manifest = merkle.build_manifest(merkle.leaf_rows(table(spark, sf, "documents")))
    return merkle.prove(manifest, spark)


def _merkle_sql() -> str:
    """Trees level by level as lists; the CRC of the decimal id by its bits; proofs folded from lists of siblings."""
    def field(column: str) -> str:
        return f"coalesce(strlen(cast({column} AS varchar)) || ':' || cast({column} AS varchar), '-')"

    def leaf(n_chars: str) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"

    above = (
        "list_transform(range((len(nodes) + 1) // 2), lambda i: "
        "sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))"
    )
    # What stands beside place k // 2**level of a level: 'L' or 'R' and a digest, 'L' alone without a sibling.
    step = (
        "CASE WHEN (place >> level) & 1 = 1 THEN 'L' || nodes[(place >> level)] "
        "ELSE 'R' || coalesce(nodes[(place >> level) + 2], '') END"
    )
    fold = (
        "list_reduce(list_prepend({start}, steps), lambda a, s: "
        "CASE WHEN s[1] = 'L' THEN sha256(s[2:] || a) ELSE sha256(a || s[2:]) END)"
    )
    return f"""
WITH RECURSIVE bits AS (
  SELECT *, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(cast(doc_id AS varchar), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
      lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS state
  FROM documents
), leaves AS (
  SELECT doc_id, lang, {leaf("n_chars")} AS leaf,
    CASE WHEN xor(state, 4294967295) % 7 = 0 THEN {leaf("(n_chars + 1)")} ELSE {leaf("n_chars")} END AS now
  FROM bits
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
), trees AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, {above} FROM trees WHERE len(nodes) > 1
), subroots AS (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM trees WHERE len(nodes) = 1
), tops AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, {above} FROM tops WHERE len(nodes) > 1
), upper_steps AS (
  SELECT s.lang, coalesce(list({step} ORDER BY level) FILTER (len(nodes) > 1), []) AS upper
  FROM subroots s CROSS JOIN tops GROUP BY s.lang
), steps AS (
  SELECT p.doc_id, p.lang, p.leaf, p.now, p.place,
    coalesce(list({step.replace("place", "p.place")} ORDER BY level) FILTER (len(nodes) > 1), []) AS lower
  FROM placed p JOIN trees t ON t.lang IS NOT DISTINCT FROM p.lang GROUP BY ALL
), paths AS (
  SELECT s.doc_id, s.leaf, s.now, r.subroot, (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root,
    list_concat(s.lower, u.upper) AS steps
  FROM steps s JOIN subroots r ON r.lang IS NOT DISTINCT FROM s.lang JOIN upper_steps u ON u.lang IS NOT DISTINCT FROM s.lang
), folded AS (
  SELECT *, {fold.format(start="now")} AS folded_root FROM paths
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM folded
"""


ORACLE["op13_merkle_manifest"] = _merkle_sql()
