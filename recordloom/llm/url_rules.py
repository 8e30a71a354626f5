"""URL rules: every URL becomes host-suffix and path-prefix expressions that meet the rules by hash.

Expressions and rules are joined on the first 32 bits of a SHA-256 digest; the full digest and the
rest of the rule's path are then confirmed, and the longest fitting rule wins. A rule's path is
hashed up to its last slash, so rules that end inside a path segment work as well. Expressions go as deep
as the deepest rule and no deeper, so a URL of thousands of labels or slashes stays small. Equal
URLs are judged once, whatever their number.

A null URL, or one without ``://``, has an empty host and an empty path. Rules of equal length: block wins,
then the rule that sorts last. Repeated rules count once. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.session import stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of the digest that the join compares.
PREFIX_DIGITS = 8


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", default: str = "allow") -> DataFrame:
    """``key, host, path, rule, verdict`` for each row of ``pages``.

    ``rules`` has ``host, path, verdict`` (block or allow); a rule fits its host and all subdomains if
    the path starts with its path. Where no rule fits, ``rule`` is null and the verdict is ``default``.
    """
    rules = rules.select(
        F.translate("host", _UPPER, _LOWER).alias("rule_host"), F.col("path").alias("rule_path"), "verdict"
    ).dropna()
    anchor_length = F.length("rule_path") - F.length(F.substring_index("rule_path", "/", -1))
    rules = rules.withColumn(
        "rule_digest", _digest(F.concat("rule_host", F.substring("rule_path", F.lit(1), anchor_length)))
    ).withColumn("prefix", F.substring("rule_digest", 1, PREFIX_DIGITS))
    deepest = rules.agg(
        F.max(F.size(F.split("rule_host", r"\."))).alias("labels"), F.max(F.size(F.split("rule_path", "/"))).alias("parts")
    ).first()
    labels, parts = deepest["labels"] or 1, deepest["parts"] or 1

    urls = pages.select(F.col(key), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    wide = urls.select("host", "path").distinct()
    hosts, segments = F.split("host", r"\."), F.split("path", "/")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(hosts), F.lit(labels))),
        lambda k: F.array_join(F.slice(hosts, F.size(hosts) - k + 1, k), "."),
    )
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size(segments), F.lit(parts)) - 1),
        lambda k: F.when(k == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(segments, 1, k), "/"), F.lit("/"))),
    )
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: _digest(F.concat(h, p)))))
    asked = wide.select("host", "path", F.explode(expressions).alias("digest")).withColumn(
        "prefix", F.substring("digest", 1, PREFIX_DIGITS)
    )
    fitting = asked.join(rules, "prefix").filter((F.col("digest") == F.col("rule_digest")) & F.expr("startswith(path, rule_path)"))
    rule = F.concat("rule_host", "rule_path")
    best = fitting.groupBy("host", "path").agg(
        F.max(F.struct(F.length(rule).alias("length"), (F.col("verdict") == "block").alias("block"), rule.alias("rule"), "verdict")).alias("best")
    )
    # written: two plain sides let Spark split a hot URL in this join
    best = stage(best.select("host", "path", "best.rule", "best.verdict"), "url-verdicts")
    # merged, not broadcast: verdicts grow with the pages, and their files are small beside their rows
    return urls.join(best.hint("merge"), ["host", "path"], "left").select(
        key, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
