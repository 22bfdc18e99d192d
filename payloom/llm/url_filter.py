"""URL filters: rules are found by their rarest literal token, then checked by pattern.

A rule ``(host, path, verdict)`` fits its host and every subdomain of it when the path of
the url starts with the rule's.  Literal tokens of a rule are its host labels and those
path segments that a ``/`` closes, so a url that fits holds all of them.  Each rule is
filed under the one token that is rarest among the urls to judge; a url fetches the rules
filed under its own tokens, and only those run their regular expression.

Null urls, and urls without ``://``, have an empty host and path; an empty url, a missing
rule set or no fitting rule give the default verdict.  Repeated rows are judged once and
every row keeps its own result.  Only ``page_id`` and ``url`` are read, so other columns
can have any name.  All work is DataFrame functions: distinct urls are reduced before
their shuffle, and no side is broadcast unless Spark measures it as small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payloom.llm.common import ascii_lower

RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(after_scheme(url), F.lit("")), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(after_scheme(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def tokens(host: Column, closed_path: Column) -> Column:
    """Distinct literal tokens; the empty token files a rule that has no other."""
    parts = F.concat(F.split(host, r"\."), F.split(closed_path, "/"), F.array(F.lit("")))
    return F.array_distinct(parts)


def indexed(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """``(token, rule, pattern, verdict)``: each rule under its rarest token among ``urls``."""
    closed = F.regexp_extract("path", r"^(.*/)?", 0)
    host = ascii_lower(F.col("host"))
    literal = F.concat(host, F.col("path"))
    quoted = F.regexp_replace(literal, r"([^A-Za-z0-9_/])", r"\\$1")
    spelled = rules.select(
        literal.alias("rule"),
        F.concat(F.when(host == "", F.lit(r"^[^/]*")).otherwise(F.lit(r"^([^/]*\.)?")), quoted).alias("pattern"),
        "verdict",
        F.explode(tokens(host, closed)).alias("token"),
    )
    wanted = spelled.select("token").distinct()
    seen = (
        urls.select(F.explode("tokens").alias("token"))
        .join(wanted, "token", "left_semi")
        .groupBy("token")
        .agg(F.count("*").alias("urls"))
    )
    filed = F.min(F.struct(F.coalesce("urls", F.lit(0)), "token")).alias("best")
    return (
        spelled.join(seen, "token", "left")
        .groupBy("rule", "pattern", "verdict")
        .agg(filed)
        .select("rule", "pattern", "verdict", F.col("best.token").alias("token"))
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row; the longest fitting rule wins."""
    urls = (
        pages.select("url")
        .distinct()
        .select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .select("url", F.concat("host", "path").alias("place"), tokens(F.col("host"), F.col("path")).alias("tokens"))
    )
    candidates = urls.select("url", "place", F.explode("tokens").alias("token")).join(
        indexed(rules, urls), "token"
    )
    fits = candidates.where(F.expr("place RLIKE pattern"))
    best = F.max(F.struct(F.length("rule"), "rule", "verdict")).alias("best")
    decided = fits.groupBy("url").agg(best)
    return (
        pages.select("page_id", "url")
        .join(decided, "url", "left")
        .select(
            "page_id",
            host_of(F.col("url")).alias("host"),
            path_of(F.col("url")).alias("path"),
            F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        )
    )
