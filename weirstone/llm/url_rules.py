"""Judge urls by rules on host suffixes and path prefixes, found by short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keyjoin import join_right

# Hexadecimal digits of the digest that the join is on: 32 bits.
PREFIX = 8


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``.

    The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the
    end, the path what follows that up to ``?``, ``#`` or the end.
    """
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.regexp_replace(F.coalesce(rest, F.lit("")), r"(?s)[?#].*$", "")
    host = F.substring_index(rest, "/", 1)
    path = F.substring(rest, F.length(host) + 1, F.length(rest))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\x00"), path), 256)


def judge_urls(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``urls`` (one column, ``url``) judged: distinct url, host, path, rule, verdict.

    ``rules`` has host, path and verdict (``allow`` or ``block``). A rule fits
    its host and all subdomains if the path starts with the rule's; the longest
    rule wins, then the longer host, then ``block``. Without a rule the verdict
    is ``default`` and the rule null.

    A url is expanded to its host suffixes and, for each, to the path prefixes
    of those lengths that rules of as many labels have: a small table of
    lengths by labels is joined, so the plan is the same for any number of
    rules, and no url gives more expressions than its labels times its path's
    length. Null urls are judged like empty ones; rules with a null are
    ignored; equal urls are judged once; long urls are judged whole.
    """
    clean = rules.select("host", "path", "verdict").dropna()
    lowered = clean.withColumn("host", url_parts(F.concat(F.lit("://"), F.col("host")))[0])
    labels = F.size(F.split("host", r"\."))
    lengths = lowered.groupBy(labels.alias("__labels")).agg(F.collect_set(F.length("path")).alias("__lengths"))
    host, path = url_parts(F.col("url"))
    parts = urls.select("url").distinct().select("url", host.alias("host"), path.alias("path"))

    most = lengths.agg(F.max("__labels")).first()[0] or 0
    names, n = F.split("host", r"\."), F.col("n")
    suffix = F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(most))),
        lambda k: F.struct(k.alias("labels"), F.array_join(F.slice(names, n - k + 1, k), ".").alias("suffix")),
    )
    expanded = parts.where(F.lit(most > 0)).withColumn("n", labels).select("url", "path", F.inline(suffix))
    expanded = join_right(expanded, ["labels"], lengths, ["__labels"], "inner", hot_rows=None)
    fitting = F.filter("__lengths", lambda size: size <= F.length("path"))
    expanded = expanded.select("url", "path", "suffix", F.explode(fitting).alias("size"))
    digest = _digest(F.col("suffix"), F.substring(F.col("path"), F.lit(1), F.col("size")))
    exploded = expanded.select("url", digest.alias("__digest"))
    exploded = exploded.withColumn("__prefix", F.substring("__digest", 1, PREFIX))
    known = lowered.select(
        _digest(F.col("host"), F.col("path")).alias("__full"),
        F.concat("host", "path").alias("__rule"),
        F.length("host").alias("__host_length"),
        F.col("verdict").alias("__verdict"),
    ).withColumn("__rule_prefix", F.substring("__full", 1, PREFIX))
    # The short prefix finds candidates, the full digest confirms them.
    hits = join_right(exploded, ["__prefix"], known, ["__rule_prefix"], "inner").where(F.col("__digest") == F.col("__full"))
    order = F.struct(
        F.length("__rule").alias("a"), F.col("__host_length").alias("b"),
        (F.col("__verdict") == "block").alias("c"), F.col("__rule").alias("rule"), F.col("__verdict").alias("verdict"),
    )
    best = hits.groupBy("url").agg(F.max(order).alias("__best"))
    best = best.select(F.col("url").alias("__url"), F.col("__best.rule").alias("rule"), F.col("__best.verdict").alias("__verdict"))
    judged = parts.join(best, F.col("url").eqNullSafe(F.col("__url")), "left")
    return judged.select("url", "host", "path", "rule", F.coalesce("__verdict", F.lit(default)).alias("verdict"))


def judge_pages(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Per row of ``pages``: page_id, url, host, path, rule, verdict; see :func:`judge_urls`.

    Only page_id and url are read, so other columns may have any names. One
    url may hold any share of the rows: it is judged once and joined back.
    """
    rows = pages.select("page_id", "url")
    verdicts = judge_urls(rows.select("url"), rules, default).where(F.col("rule").isNotNull())
    verdicts = verdicts.select(F.col("url").alias("__url"), "rule", F.col("verdict").alias("__verdict"))
    host, path = url_parts(F.col("url"))
    joined = join_right(rows, ["url"], verdicts, ["__url"], "left")
    return joined.select(
        "page_id", "url", host.alias("host"), path.alias("path"), "rule",
        F.coalesce("__verdict", F.lit(default)).alias("verdict"),
    )
