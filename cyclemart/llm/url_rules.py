"""URL filtering by host-suffix and path-prefix rules, joined on short hash prefixes.

Each distinct (host, path) is expanded into the host suffixes and path prefixes that a
rule could name.  Expressions meet the rules in an equi-join on the first eight hex digits
of their SHA-256; the full digest then confirms the match, and the longest rule wins.
Everything is built-in functions.

Expansion is exact and bounded by the rules, not by the URL: only suffixes with a label
count that some rule has, and prefixes with a length that some rule has, are made.

Defined cases: a NULL url, or one without ``://``, has an empty host and path and gets the
default verdict (unless a rule names the empty host).  A rule whose host or path is NULL
counts as empty there.  Repeated rules count once; of two rules that differ only in the
verdict, ``block`` wins.  Of equally long rules the one with the longer host wins.
Repeated pages are judged alike; the other columns of the pages are kept.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemart.llm.common import fresh

ALLOW, BLOCK = "allow", "block"
PREFIX_HEX = 8


def _ascii_lower(column):
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def with_host_path(pages: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """Add ``host`` (lower-cased A-Z) and ``path`` (up to ``?`` or ``#``) of ``url``."""
    at = F.instr(F.col(f"`{url}`"), "://")
    rest = F.when(at > 0, F.substring(F.col(f"`{url}`"), at + 3, F.length(F.col(f"`{url}`"))))
    rest = F.coalesce(rest, F.lit(""))
    return pages.withColumn(path, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).withColumn(
        host, _ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    )


def _digest(host, path):
    return F.sha2(F.concat(host, F.lit("\x00"), path), 256)


def prepared_rules(rules: DataFrame) -> DataFrame:
    """One row per (host, path) with its digest; ``rules`` has host, path and verdict."""
    host = _ascii_lower(F.coalesce(F.col("host"), F.lit("")))
    path = F.coalesce(F.col("path"), F.lit(""))
    one = (
        rules.select(host.alias("r_host"), path.alias("r_path"), "verdict")
        .groupBy("r_host", "r_path")
        .agg(F.max(F.when(F.col("verdict") == BLOCK, 1).otherwise(0)).alias("r_block"))
    )
    digest = _digest(F.col("r_host"), F.col("r_path"))
    return one.select(
        "r_host", "r_path", "r_block",
        digest.alias("r_digest"), F.substring(digest, 1, PREFIX_HEX).alias("r_prefix"),
    )


def expressions(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """(k_host, k_path, e_digest, e_prefix): the expressions of each key a rule could name."""
    shapes = rules.agg(
        F.collect_set(F.size(F.split("r_host", r"\."))).alias("labels"),
        F.collect_set(F.length("r_path")).alias("lengths"),
    ).first()  # distinct label counts and path lengths: as many as a URL is long at most
    labels = F.array(*[F.lit(int(x)) for x in sorted(shapes["labels"])]).cast("array<int>")
    lengths = F.array(*[F.lit(int(x)) for x in sorted(shapes["lengths"])]).cast("array<int>")
    n_labels = F.size(F.split("k_host", r"\."))
    suffixes = F.transform(
        F.filter(labels, lambda k: k <= n_labels),
        lambda k: F.call_function("substring_index", F.col("k_host"), F.lit("."), -k),
    )
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.length("k_path")),
        lambda n: F.col("k_path").substr(F.lit(1), n),
    )
    return (
        keys.withColumn("e_host", F.explode(suffixes))
        .withColumn("e_path", F.explode(prefixes))
        .withColumn("e_digest", _digest(F.col("e_host"), F.col("e_path")))
        .select("k_host", "k_path", "e_digest",
                F.substring("e_digest", 1, PREFIX_HEX).alias("e_prefix"))
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW
) -> DataFrame:
    """``pages`` with host, path, rule (``host`` followed by ``path``; else NULL), verdict.

    Pages are reduced to distinct (host, path) before the expansion and joined back, so a
    URL that holds a third of all rows is expanded once; the join back is a plain equi-join
    that Spark splits where it is skewed.
    """
    h, p, rule, verdict = fresh(pages, "host", "path", "rule", "verdict")
    parsed = with_host_path(pages, url, h, p)
    ready = prepared_rules(rules)
    keys = parsed.select(F.col(h).alias("k_host"), F.col(p).alias("k_path")).distinct()
    hits = (
        expressions(keys, ready)
        .join(ready, F.col("e_prefix") == F.col("r_prefix"))
        .filter(F.col("e_digest") == F.col("r_digest"))
    )
    length = F.length("r_host") + F.length("r_path")
    best = (
        hits.groupBy("k_host", "k_path")
        .agg(F.max(F.struct(
            length.alias("n"), F.length("r_host").alias("nh"), F.col("r_block").alias("block"),
            F.concat("r_host", "r_path").alias("rule"))).alias("best"))
    )
    kh, kp, b = fresh(parsed.withColumns({rule: F.lit(0), verdict: F.lit(0)}), "k_host", "k_path", "best")
    found = best.toDF(kh, kp, b)
    return (
        parsed.join(found, (F.col(h) == F.col(kh)) & (F.col(p) == F.col(kp)), "left")
        .withColumn(rule, F.col(b)["rule"])
        .withColumn(verdict, F.when(F.col(b).isNull(), default)
                    .when(F.col(b)["block"] == 1, BLOCK).otherwise(ALLOW))
        .drop(kh, kp, b)
    )
