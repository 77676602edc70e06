"""Mixes sources to target weights, document by document.

The sources share a word budget by weight; a source's target stops at ``max_epochs`` times its size and what
it can't take is reshared. A source is taken whole as often as its target allows. The rest is drawn without
replacement by the method of Efraimidis and Spirakis: every document draws an exponential key divided by its
quality weight, and the documents with the smallest keys fill the rest; the last of them gives a part.

The running sums are spread: documents are dealt into key ranges by source, each range is summed on its own,
and the sums of the ranges before it are added. A source with a third of all rows has a third of the ranges.
"""

from __future__ import annotations

import math
import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vanewatch.llm.words import WORD, free_names, let
from vanewatch.scratch import settle

# fixed values: weights of the sources by code point, repeating
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
# Rows of a key range. Above its square a table has as many ranges as there are rows in one.
RANGE_ROWS = 256
# Weights that stand for all of them when keys are dealt into ranges.
TYPICAL_WEIGHTS = 16
# Sources that may be broadcast, with three numbers each.
BROADCAST_SOURCES = 500_000
SEED = "mix"
UNIFORM_BITS = 52


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Between 0.5 and 1, less the more of the text is markup or symbols; 0.5 for an empty text."""
    body = F.coalesce(text, F.lit(""))
    plain = F.length(body) - F.regexp_count(body, F.lit("[#*$%&|<>]"))
    return F.lit(0.5) + F.coalesce(plain / F.nullif(F.length(body), F.lit(0)), F.lit(0.0)) / F.lit(2.0)


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the given values alone."""
    named = F.concat_ws("\x1f", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    digits = UNIFORM_BITS // 4
    drawn = F.conv(F.substring(F.md5(named), 1, digits), 16, 10).cast("long")
    return (drawn + F.lit(0.5)) / F.lit(float(1 << UNIFORM_BITS))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``sizes`` (source, source_size), one row for each source, with the source's ``target``.

    With the sources ordered by how soon their limit is reached, the level that the others get for each unit
    of weight follows from running sums. One row for each source is sorted, whatever the number of documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    rows = (
        sizes.withColumn("weight", F.get(F.array(*map(F.lit, weights)), place))
        .withColumn("most", F.col("source_size") * MAX_EPOCHS)
        .withColumn("ratio", F.col("most") / F.col("weight"))
    )
    level = (
        F.sum("source_size").over(everything) * share - F.coalesce(F.sum("most").over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    rows = rows.withColumn("level", level)
    open_level = F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level"))).over(everything)
    return rows.select(
        "source",
        "source_size",
        F.least(F.col("most").cast("double"), F.col("weight") * F.coalesce(open_level, F.lit(0.0))).alias("target"),
    )


def spread_ranges(rows: DataFrame, source: str, part: str) -> DataFrame:
    """Words of each range of each source."""
    return rows.groupBy(source, part).agg(F.sum("size").alias("words"))


def mix_sources(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    id_column: str = "doc_id",
    weight: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
) -> DataFrame:
    """All columns of ``docs`` with ``size``, ``source_size``, ``target`` and ``taken``; every row stays.

    ``taken`` counts words, repeats included. Null and empty texts have size 0 and give nothing. A null source
    is a source of its own, after all others. Of rows that repeat each other it is left open which one is
    taken, but not how many. Columns of ``docs`` with the names of results are replaced. An empty table
    gives an empty result. The result is the same in every run.
    """
    results = ("size", "source_size", "target", "taken")
    others = [c for c in docs.columns if c.lower() not in results]
    key, part, start, name, own, of_range = free_names(
        [*docs.columns, *results], "mix_key", "mix_range", "mix_start", "mix_source", "mix_own", "mix_of_range"
    )
    doc_weight = F.greatest(quality_weight(F.col(text)) if weight is None else weight, F.lit(1e-6))

    shares = [(i + 0.5) / TYPICAL_WEIGHTS for i in range(TYPICAL_WEIGHTS)]
    sizes = settle(
        docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"), doc_weight.alias("weight"))
        .groupBy("source")
        .agg(
            F.sum("size").alias("source_size"),
            F.count("*").alias("rows"),
            F.percentile_approx("weight", shares, 200).alias("weights"),
        )
    )
    spread = sizes.select("rows", F.explode("weights").alias("weight"))
    typical = F.percentile_approx("weight", shares, 1000).alias("weights")
    totals = sizes.agg(F.sum("rows").alias("rows"), F.count("*").alias("sources")).first()
    n_rows, found_weights = totals["rows"] or 0, spread.agg(typical).first()["weights"] or [1.0]
    n_ranges = max(1, math.ceil(n_rows / max(RANGE_ROWS, math.isqrt(n_rows))))
    targets = source_targets(sizes.select("source", "source_size"), weights, share)

    # u ** (1 / w) grows as the key -ln(u) / w falls. The share of keys up to k is 1 - exp(-w k) for a weight w; its mean
    # over typical weights deals the keys into ranges of about equal numbers of rows, in the order of the keys.
    drawn = -F.log(uniform(F.col(id_column))) / doc_weight
    up_to = let(
        F.col(key), lambda k: reduce(operator.add, [F.lit(1.0) - F.exp(k * F.lit(-float(w))) for w in found_weights])
    )
    rows = (
        docs.select(*others, word_count(F.col(text)).alias("size"), drawn.alias(key))
        .withColumn(part, F.floor(up_to * (n_ranges / len(found_weights))))
        .withColumn(name, F.col(source))
    )
    ranges = spread_ranges(rows, name, part)
    earlier = Window.partitionBy(name).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        F.col(name).alias("source"),
        F.col(part).alias(of_range),
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias(start),
    )
    few = totals["sources"] <= BROADCAST_SOURCES
    targets = F.broadcast(targets) if few else targets
    by_key = Window.partitionBy(name, part).orderBy(key, F.col(id_column))
    running = F.sum("size").over(by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    known = offsets.join(targets, offsets["source"].eqNullSafe(targets["source"])).select(
        offsets["source"].alias(own), of_range, start, "source_size", "target"
    )
    placed = rows.withColumn(key, running - F.col("size")).join(
        known, F.col(name).eqNullSafe(F.col(own)) & (F.col(part) == F.col(of_range))
    )
    epochs = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    rest = F.floor("target") - epochs * F.col("source_size")
    fraction = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col(start) - F.col(key)))
    return placed.select(
        *others, "size", "source_size", "target", (epochs * F.col("size") + fraction).cast("long").alias("taken")
    )
