"""URL filters by host-suffix and path-prefix expressions.

Every distinct (host, path) is expanded into host-suffix x path-directory expressions, no longer than
the longest rule's, as every rule is into its own one. Expressions meet in an equi-join on the first four bytes of
their SHA-256 digest; the full digest then confirms the match, the whole rule path is checked
against the whole path, and of the rules that fit the longest wins.

A rule is (host, path, verdict). It fits its host and all subdomains if the path starts with
the rule's path. A rule's expression is its host and its path up to the last ``/``, so paths
that end inside a name need no expression of their own.

Defined results: a null URL or one without ``://`` has empty host and path and fits no rule
(unless the rule's host is empty too); a rule with a null host, path or verdict is ignored; of
two rules with the same host and path ``block`` goes before ``allow``; rules of equal length
go by host, then path; existing columns with the output names are replaced; repeated rows are
judged alike; an empty table gives an empty table, an empty rule table leaves the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbscope.llm.common import LOWER, UPPER, quoted, without

OUT = ("host", "path", "rule", "verdict")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, directory: Column) -> Column:
    return F.unhex(F.sha2(F.concat_ws("\n", host, directory), 256))


def host_suffixes(host: Column, most: int) -> Column:
    """The host's suffixes of 1 to ``most`` labels."""
    labels = F.size(F.split(host, r"\."))
    return F.transform(F.sequence(F.lit(1), F.least(labels, F.lit(most))), lambda k: F.call_function("substring_index", host, F.lit("."), -k))


def path_directories(path: Column, most: int) -> Column:
    """The empty string and the path's prefixes that end in its first to ``most``-th ``/``."""
    parts = F.split(path, "/", most + 1)  # what lies deeper stays in one piece
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.when(k == 0, "").otherwise(
        F.concat(F.array_join(F.slice(parts, F.lit(1), k), "/"), F.lit("/"))))


def deepest(rules: DataFrame) -> tuple[int, int]:
    """The most labels of a rule's host and the most ``/`` of a rule's path (two numbers to the driver)."""
    found = rules.agg(F.max(F.size(F.split("rule_host", r"\."))), F.max(F.regexp_count("rule_path", F.lit("/")))).first()
    return max(1, found[0] or 1), found[1] or 0


def rule_expressions(rules: DataFrame) -> DataFrame:
    """One row per rule: its short prefix, digest and parts."""
    r = (rules.select(F.translate(F.col("host"), UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"),
                      F.col("verdict").alias("rule_verdict")).na.drop()
         .groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict")))
    digest = _digest(F.col("rule_host"), F.regexp_extract("rule_path", r"(?s)^(.*/)?", 0))
    return r.withColumn("rule_digest", digest).withColumn("rule_prefix", F.substring("rule_digest", 1, 4))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """All rows and columns of ``pages`` plus host, path, rule and verdict.

    ``rules``: host, path, verdict (``block`` or ``allow``). Neither side is forced into a
    broadcast; the planner broadcasts by measured size or splits skewed keys at run time.
    """
    parsed = without(pages, *OUT).withColumns({"host": url_host(quoted(url_col)), "path": url_path(quoted(url_col))})
    r = rule_expressions(rules)
    labels, slashes = deepest(r)
    targets = parsed.select("host", "path").distinct()
    expanded = (targets.withColumn("suffix", F.explode(host_suffixes(F.col("host"), labels)))
                .withColumn("directory", F.explode(path_directories(F.col("path"), slashes)))
                .withColumn("digest", _digest(F.col("suffix"), F.col("directory")))
                .withColumn("prefix", F.substring("digest", 1, 4)))
    hits = (expanded.join(r, F.col("prefix") == F.col("rule_prefix"))
            .where((F.col("digest") == F.col("rule_digest")) & F.startswith("path", "rule_path")))
    rule = F.concat("rule_host", "rule_path")
    best = (hits.groupBy("host", "path").agg(F.max(F.struct(
        F.char_length(rule).alias("length"), F.col("rule_host"), F.col("rule_path"), F.col("rule_verdict"))).alias("best"))
        .select(F.col("host").alias("_h"), F.col("path").alias("_p"),
                F.concat("best.rule_host", "best.rule_path").alias("rule"), F.col("best.rule_verdict").alias("_v")))
    return (parsed.join(best, (parsed["host"] == best["_h"]) & (parsed["path"] == best["_p"]), "left")
            .withColumn("verdict", F.coalesce("_v", F.lit(default))).drop("_h", "_p", "_v"))
