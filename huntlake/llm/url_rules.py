"""URL filters: host-suffix and path-prefix expressions, looked up by short hash prefixes.

A rule is a host and the beginning of a path. A URL is expanded into all
expressions of a suffix of its host, cut between labels, and a prefix of its
path, cut after slashes. Expressions and rules meet in an equi-join on the
first digits of their digests; the full digest, the rest of the rule's path
and the precedence of rules then decide.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huntlake.llm.common import saved

#: Hexadecimal digits of the digest that are joined on.
PREFIX = 8
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, ascii_uppercase, ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def folder_of(path: Column) -> Column:
    """A path up to its last slash, that included; empty without a slash."""
    return F.regexp_extract(path, r"(?s)\A(.*/)", 1)


def digest(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), folder), 256)


def rule_keys(rules: DataFrame) -> DataFrame:
    """Rules (verdict, host, path) with their digests; a rule with a NULL fits nothing."""
    named = rules.where("verdict is not null and host is not null and path is not null").select(
        "verdict", F.translate("host", ascii_uppercase, ascii_lowercase).alias("rule_host"), F.col("path").alias("rule_path")
    )
    folder = folder_of(F.col("rule_path"))
    return named.select(
        "*",
        digest(F.col("rule_host"), folder).alias("rule_digest"),
        F.size(F.split("rule_host", "\\.")).alias("labels"),
        F.size(F.split(folder, "/")).alias("depth"),
    ).withColumn("prefix", F.substring("rule_digest", 1, PREFIX))


def expressions(urls: DataFrame, labels: int, depth: int) -> DataFrame:
    """(url, path, digest, prefix) for each suffix of the host and each prefix of the path that a rule may have.

    ``labels`` and ``depth`` are the most labels and slashes of any rule: longer
    expressions cannot be a rule's, so a URL of thousands of slashes costs no more.
    """
    parts, steps = F.split("host", "\\."), F.split("path", "/", depth + 1)
    suffixes = F.transform(
        F.sequence(F.greatest(F.size(parts) - labels + 1, F.lit(1)), F.size(parts)),
        lambda at: F.array_join(F.slice(parts, at, F.size(parts) - at + 1), "."),
    )
    prefixes = F.transform(
        F.sequence(F.lit(0), F.size(steps) - 1),
        lambda n: F.when(n == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(steps, 1, n), "/"), F.lit("/"))),
    )
    spread = urls.select("url", "path", F.explode_outer(suffixes).alias("suffix"), prefixes.alias("prefixes"))
    spread = spread.select("url", "path", "suffix", F.explode_outer("prefixes").alias("folder"))
    return spread.select("url", "path", digest(F.col("suffix"), F.col("folder")).alias("digest")).withColumn(
        "short", F.substring("digest", 1, PREFIX)
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url).

    A rule fits its host and all its subdomains, if the path starts with the
    rule's. Of the rules that fit, the longest wins (host and path together,
    then host); of two verdicts for one rule, ``block``. ``rule`` is its host
    and path, or NULL if none fits and the verdict is ``default``. A URL that
    is NULL or has no ``://`` has an empty host and path. Each distinct URL is
    looked up once. Other columns are not read.
    """
    keys = saved(rule_keys(rules), "rules")  # a written table has a known size: Spark broadcasts a small one only
    most = keys.agg(F.max("labels").alias("labels"), F.max("depth").alias("depth")).first()
    urls = pages.where("url is not null").select("url").distinct()
    urls = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    fits = expressions(urls, most["labels"] or 1, most["depth"] or 1).join(
        keys.select("verdict", "rule_host", "rule_path", "rule_digest", "prefix"), F.col("short") == F.col("prefix")
    )
    fits = fits.where("digest = rule_digest").where(F.startswith("path", F.col("rule_path")))
    weight = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("length"),
        F.length("rule_host").alias("host"),
        (F.col("verdict") == "block").alias("blocks"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("verdict").alias("verdict"),
    )
    decided = fits.groupBy("url").agg(F.max(weight).alias("best"))
    return pages.select(F.col("page_id").cast("long"), "url").join(decided, "url", "left").select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )
