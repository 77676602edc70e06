"""Removes lines that stand on many distinct sites.

A line is what stands between two ``\\n``, without white space at its ends; lines without a word are left
alone. Each line's distinct sites are counted with a HyperLogLog sketch, which merges by aggregation.
Lines whose estimate lies near the threshold are counted exactly, so the decision is exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewatch.llm.words import SPACE, WORD, free_names
from vanewatch.scratch import settle

MIN_SITES = 10
# In a table of few sites, half of them are many, but never fewer than LEAST_SITES. Lines of fewer words than
# LEAST_WORDS may be alike by chance.
LEAST_SITES, LEAST_WORDS = 3, 3
# 2^10 registers: a standard error of 3.3 %. Estimates within NEAR of the threshold are recounted.
SKETCH_BITS = 10
NEAR = 0.25
# Line hashes that may be broadcast: about 40 MB. With more of them the removal joins by key.
BROADCAST_LINES = 500_000
EDGE = " \t\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _site(site: str) -> Column:
    """Hash of a site; null is a site."""
    return F.xxhash64(F.coalesce(F.concat(F.lit("s"), F.col(site).cast("string")), F.lit("n")))


def many_sites(docs: DataFrame, site: str = "source") -> int:
    """``min_sites`` for a table: half of its sites, from ``LEAST_SITES`` to ``MIN_SITES``."""
    half = math.ceil(docs.select(_site(site)).distinct().count() / 2)
    return min(MIN_SITES, max(LEAST_SITES, half))


def _key(line: Column, min_words: int = 1) -> Column:
    """Hash of a line, null if it has no word, or fewer than ``min_words``."""
    enough = WORD if min_words <= 1 else f"(?:{WORD}{SPACE}){{{min_words - 1}}}{WORD}"
    return F.when(line.rlike(enough), F.xxhash64(F.btrim(line, F.lit(EDGE))))


def site_spread(docs: DataFrame, text: str = "text", site: str = "source", min_words: int = 1) -> DataFrame:
    """``line`` (hash) and ``sites``, a sketch of the distinct sites of every line. A null site is a site."""
    lines = docs.select(
        _site(site).alias("site"),
        F.explode(F.array_distinct(F.transform(_lines(F.col(text)), lambda line: _key(line, min_words)))).alias("line"),
    ).filter("line is not null")
    return lines.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sites"))


def boilerplate(
    docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES, min_words: int = 1
) -> DataFrame:
    """Hashes of the lines on at least ``min_sites`` distinct sites, settled in the shared folder."""
    estimate = F.hll_sketch_estimate("sites")
    low, high = int(min_sites * (1 - NEAR)), min_sites * (1 + NEAR) + 1
    spread = settle(
        site_spread(docs, text, site, min_words)
        .select("line", estimate.alias("estimate"))
        .filter(F.col("estimate") >= low)
    )
    near = spread.filter(F.col("estimate") <= high).select("line")
    exact = (
        docs.select(
            F.coalesce(F.concat(F.lit("s"), F.col(site).cast("string")), F.lit("n")).alias("site"),
            F.explode(F.array_distinct(F.transform(_lines(F.col(text)), lambda line: _key(line, min_words)))).alias("line"),
        )
        .join(_bounded(near), "line", "left_semi")
        .distinct()
        .groupBy("line")
        .count()
        .filter(F.col("count") >= min_sites)
        .select("line")
    )
    return settle(spread.filter(F.col("estimate") > high).select("line").unionByName(exact))


def _bounded(lines: DataFrame) -> DataFrame:
    """``lines`` as a broadcast if there are few enough of them."""
    few = lines.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES
    return F.broadcast(lines) if few else lines


def remove_lines(
    docs: DataFrame,
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
    n_lines: str | None = None,
    n_removed: str | None = None,
    min_words: int = 1,
) -> DataFrame:
    """``docs`` without their boilerplate lines; the named columns get the counts of lines with a word.

    Every row stays, with all its columns; a text of boilerplate alone becomes empty. Null texts stay null.
    Repeated rows are treated alike. What is removed from a text depends on the text only, so texts and
    lines to remove meet by the text's hash: rows need no id.
    """
    key, bad = free_names(docs.columns, "text_key", "bad_lines")
    body = F.col(text)
    # settled, so that the join below has plain exchanges on both sides and may split a text with many copies
    found = settle(
        docs.select(
            F.xxhash64(body).alias(key),
            F.explode(F.array_distinct(F.transform(_lines(body), lambda line: _key(line, min_words)))).alias("line"),
        )
        .filter("line is not null")
        .join(_bounded(boilerplate(docs, text, site, min_sites, min_words)), "line")
        .groupBy(key)
        .agg(F.collect_set("line").alias(bad))
    )
    bad_lines = F.coalesce(F.col(bad), F.array().cast("array<bigint>"))

    def is_bad(line: Column) -> Column:
        return F.coalesce(F.array_contains(bad_lines, _key(line, min_words)), F.lit(False))

    cleaned = F.when(F.col(bad).isNull(), body).otherwise(
        F.array_join(F.filter(_lines(body), lambda line: ~is_bad(line)), "\n")
    )
    counts = {}
    if n_lines:
        counts[n_lines] = F.size(F.filter(_lines(body), lambda line: line.rlike(WORD))).cast("long")
    if n_removed:
        counts[n_removed] = F.when(F.col(bad).isNull(), F.lit(0)).otherwise(
            F.size(F.filter(_lines(body), is_bad))
        ).cast("long")
    kept = [F.col(c) if c != text else cleaned.alias(text) for c in docs.columns if c not in counts]
    return (
        docs.withColumn(key, F.xxhash64(body))
        .join(found, key, "left")
        .select(*kept, *[value.alias(name) for name, value in counts.items()])
    )
