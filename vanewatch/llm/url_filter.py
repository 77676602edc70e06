"""Judges URLs by listed rules and by a list of canonical URLs.

A rule is a host and the beginning of a path. It fits its host and all subdomains; the longest fitting rule
decides. A URL without a rule is blocked if its canonical form is listed. For each URL all keys that a rule or
the list could have are looked up in a blocked Bloom filter, and only possible hits go to an exact hash join,
which removes the false positives. The filter has a fixed largest size, so it may be broadcast; when more is
listed than it is made for, more false positives reach the join, and the result stays the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.llm.words import free_names, lower_ascii
from vanewatch.scratch import settle

# fixed values: what the rules allow or block
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
# A block is eight words of 64 bits; at most this many blocks, so 8 MB of bits.
MAX_BLOCKS = 1 << 17
KEYS_PER_BLOCK = 32
WORDS, PROBES = 8, 6
BY_RULE, BY_URL = "r", "u"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)
    return F.coalesce(lower_ascii(rest), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without port and leading ``www.``, path without trailing slashes."""
    plain = F.regexp_replace(F.regexp_replace(host, r":[0-9]*$", ""), r"^www\.", "")
    return F.concat(plain, F.regexp_replace(path, r"/+$", ""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    rows = [(verdict, *rule.partition("/")[::2], rule) for verdict, rule in rules]
    table = spark.createDataFrame(rows, "verdict string, host string, path string, rule string")
    return table.withColumn("path", F.concat(F.lit("/"), "path"))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[tuple[Column, Column]]:
    """Word and bit within the block for each probe."""
    drawn = [F.xxhash64(key, F.lit(i)) for i in range(PROBES)]
    return [
        (F.pmod(d, F.lit(WORDS)), F.pmod(F.shiftright(d, 8), F.lit(64)).cast("int")) for d in drawn
    ]


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """``block`` and ``bits`` (eight longs) of the filter that holds the column ``key``."""
    probe = F.explode(F.array(*[F.struct(w.alias("word"), b.alias("bit")) for w, b in _bits(F.col("key"))]))
    set_bits = keys.select(_block(F.col("key"), blocks).alias("block"), probe.alias("p"))

    def word(i: int) -> Column:
        return F.bit_or(F.when(F.col("p.word") == i, F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p.bit"))).otherwise(F.lit(0).cast("long")))

    return set_bits.groupBy("block").agg(F.array(*[word(i) for i in range(WORDS)]).alias("bits"))


def _may_hold(key: Column) -> Column:
    test = F.lit(True)
    for word, bit in _bits(key):
        test = test & (F.getbit(F.get(F.col("bits"), word.cast("int")), bit) == 1)
    return test


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    listed: DataFrame,
    url: str = "url",
    max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """All columns of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; every row stays.

    ``rules``: columns verdict, host, path, rule. ``listed``: canonical URLs in column ``url``. A null URL or
    one without ``://`` has an empty host and path, fits no rule and is allowed, unless the empty URL is
    listed. Of fitting rules the one with the longest text wins, among equal ones the one with the longest
    host. Repeated pages are judged alike. Without rules or list the filter is empty and all URLs are
    allowed. Columns of ``pages`` with the names of results are replaced.
    """
    results = ("host", "path", "rule", "verdict")
    others = [c for c in pages.columns if c.lower() not in results]
    found = free_names([*pages.columns, *results], "found")[0]
    rows = pages.select(*others, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))

    known = settle(
        rules.filter("host is not null and path is not null")
        .select(
            F.concat_ws("\x1f", F.lit(BY_RULE), "host", "path").alias("key"),
            F.struct(
                F.length("rule").alias("length"), F.length("host").alias("host_length"), "rule", "verdict"
            ).alias("hit"),
            F.length("path").alias("path_length"),
        )
        .unionByName(
            listed.filter("url is not null")
            .distinct()
            .select(
                F.concat_ws("\x1f", F.lit(BY_URL), "url").alias("key"),
                F.struct(
                    F.lit(-1).alias("length"),
                    F.lit(-1).alias("host_length"),
                    F.lit(None).cast("string").alias("rule"),
                    F.lit("block").alias("verdict"),
                ).alias("hit"),
                F.lit(None).cast("int").alias("path_length"),
            )
        )
    )
    # two small facts: how much is listed, and which lengths the rules' paths have
    facts = known.agg(F.count("*").alias("n"), F.collect_set("path_length").alias("lengths")).first()
    blocks = min(max_blocks, facts["n"] // KEYS_PER_BLOCK + 1)
    lengths = sorted(facts["lengths"])

    def rule_keys(host: Column, path: Column) -> Column:
        labels = F.split(host, r"\.")
        suffixes = F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
        )
        starts = F.filter(
            F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]).cast("array<string>"),
            lambda p: p.isNotNull(),
        )
        return F.flatten(
            F.transform(
                suffixes,
                lambda s: F.transform(starts, lambda p: F.concat_ws("\x1f", F.lit(BY_RULE), s, p)),
            )
        )

    host, path = F.col("host"), F.col("path")
    own = F.array(F.concat_ws("\x1f", F.lit(BY_URL), canonical(host, path)))
    probes = (
        rows.select("host", "path")
        .distinct()
        .select("host", "path", F.explode(F.concat(own, rule_keys(host, path))).alias("key"))
    )
    possible = (
        probes.withColumn("block", _block(F.col("key"), blocks))
        .join(F.broadcast(bloom_blocks(known, blocks)), "block")
        .filter(_may_hold(F.col("key")))
        .select("host", "path", "key")
    )
    hits = (
        possible.join(known.select("key", "hit"), "key")
        .groupBy("host", "path")
        .agg(F.max("hit").alias(found))
    )
    return rows.join(hits, ["host", "path"], "left").select(
        *others,
        "host",
        "path",
        F.col(found)["rule"].alias("rule"),
        F.coalesce(F.col(found)["verdict"], F.lit("allow")).alias("verdict"),
    )
