"""URL rules by hashed expressions.

Every URL is expanded into expressions: each suffix of its host's labels with each path prefix whose
length some rule has. Expressions and rules meet in an equi-join on the first eight hex digits of their
SHA-256; the full digest confirms, and the longest rule wins (then the longer host, then ``block``).

* The verdict depends on host and path alone, so each distinct pair is expanded once: repeated URLs and a
  host with a third of all pages cost one row per distinct path.
* Rules are given to every salt, and expressions carry one, so that a prefix shared by many expressions
  is spread over ``SALTS`` keys when the rule list is too long for Spark to broadcast by its size.
* Null or scheme-less URLs have empty host and path; without a fitting rule the verdict is ``default``.
  Repeated rows are judged row by row, an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SALTS = 16
PREFIX_DIGITS = 8
RULE_SCHEMA = "host string, path string, verdict string"


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rules as a frame."""
    return spark.createDataFrame(rules, RULE_SCHEMA)


def split_url(url) -> tuple:
    """Host (A-Z lower-cased) and path columns of a URL column."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s)(.*?)://(.*)$", 2)
    host = F.regexp_extract(rest, r"^(?s)([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^(?s)[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def judge_hosts(pairs: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) for those distinct (host, path) rows that some rule fits."""
    rules = rules.select(
        F.coalesce("host", F.lit("")).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), "verdict"
    ).filter("r_host <> ''")
    lengths = rules.select(F.sort_array(F.collect_set(F.length("r_path"))).alias("lengths")).first()["lengths"]
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    fitting = F.filter(F.array([F.lit(int(n)) for n in lengths] or [F.lit(0)]), lambda n: n <= F.length("path"))
    expanded = (
        pairs.filter("host <> ''")
        .withColumn("n", F.explode(fitting))
        .withColumn("suffix", F.explode(suffixes))
        .withColumn("digest", F.sha2(F.concat_ws("/", "suffix", F.expr("substring(path, 1, n)")), 256))
        .select(
            "host",
            "path",
            "digest",
            F.substring("digest", 1, PREFIX_DIGITS).alias("prefix"),
            F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).alias("salt"),
        )
    )
    keyed = (
        rules.withColumn("digest", F.sha2(F.concat_ws("/", "r_host", "r_path"), 256))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
        .select("r_host", "r_path", "verdict", F.col("digest").alias("full"),
                F.substring("digest", 1, PREFIX_DIGITS).alias("prefix"), "salt")
    )
    met = expanded.join(keyed, ["prefix", "salt"]).filter(F.col("digest") == F.col("full"))
    order = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("n"),
        F.length("r_host").alias("h"),
        (F.col("verdict") == "block").alias("b"),
        F.concat("r_host", "r_path").alias("rule"),
        F.col("verdict"),
    )
    best = met.groupBy("host", "path").agg(F.max(order).alias("best"))
    return best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page."""
    host, path = split_url(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    judged = judge_hosts(split.select("host", "path").distinct(), rules)
    return split.join(judged, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
