"""Keeps documents whose words look like those of trusted documents.

Words and word pairs, hashed into buckets, are the grams of two multinomials: one over the corpus, one over the trusted
documents in it. Both are smoothed, each in proportion to its length, so a bucket that neither holds counts for nothing.
A document scores the mean log ratio of the two over its words and pairs, and is kept if that is at least a
fixed threshold and the document passes the base rules. What a trusted document itself adds to the trusted
counts is left out for it, so that it scores as it would without its label.

The number of buckets grows with the square root of the corpus, and with it both what they can tell apart (a gram
that is more than one in ``buckets`` of all outweighs those that share its bucket) and the occurrences behind each ratio.
Up to BROADCAST_BUCKETS are broadcast with their counts; beyond that the frequent ones are, and documents meet the others
in a join by bucket. Built of DataFrame functions alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewatch.llm.words import WORD, let, pairwise, split_words
from vanewatch.scratch import settle

# Set on the labels of sf0.01 and sf0.1: 567 of 571 bad documents of the latter fail this or the base rules, and one of
# 3330 good ones that pass those.
THRESHOLD = -0.14
# Buckets for each root of the corpus' characters, and the least number.
BUCKETS_PER_ROOT = 13
LEAST_BUCKETS = 4096
# Ids of trusted documents that may be broadcast, 16 bytes each. More of them are joined by key.
BROADCAST_IDS = 1_000_000
SMOOTHING = 1.0
# Buckets that may be broadcast with their counts, some 50 bytes each.
BROADCAST_BUCKETS = 2_000_000
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
REPEAT_WINDOW = 5
# fixed value: what counts as a symbol
SYMBOL = "[#*$%&|<>]"
# A bucket, and in a text the number of its grams, takes so many bits.
LOW_BITS = 31
LOW = (1 << LOW_BITS) - 1
# Grams that a text holds up to so often are counted where they are listed, and those it holds more often before; these
# are told from buckets by a bit of their own.
SHORT_RUN = 3
LONG_RUN = 1 << 62
# Up to 2 ** PLACE_BITS windows are sorted as numbers that end in their place.
PLACE_BITS = 12


def trusted_ids(labels: DataFrame, label: str = "quality", id_column: str = "doc_id") -> DataFrame:
    """All documents that are labelled good."""
    return labels.filter(F.col(label) == 1).filter(F.col(id_column).isNotNull()).select(id_column).distinct()


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _bucket(h: Column, buckets: int) -> Column:
    """One of at most 2**31 buckets for a hash."""
    return F.shiftright(h.bitwiseAND(F.lit(LOW)) * F.lit(buckets).cast("long"), LOW_BITS)


def _pairs(hashes: Column) -> Column:
    """Hashes of pairs of neighbouring words, from the words' hashes.

    No element can be null in Spark's eyes, so that arrays made of them are sorted as plain numbers. The last one lacks its
    neighbour and is cut off.
    """
    joined = F.zip_with(hashes, F.slice(hashes, F.lit(2), F.size(hashes)), lambda x, y: F.xxhash64(x, y))
    return F.slice(joined, F.lit(1), F.greatest(F.size(hashes) - 1, F.lit(0)))


def _tallied(ordered: Column) -> Column:
    """Each distinct gram of a sorted array, with how often it is there in the low bits."""

    def low(packed: Column) -> Column:
        return packed.bitwiseAND(F.lit(LOW))

    def tally(a: Column) -> Column:
        starts = F.transform(
            a, lambda g, i: F.when(F.coalesce(F.get(a, i - 1) != g, F.lit(True)), F.shiftleft(g, LOW_BITS) + i)
        )
        return let(
            F.filter(starts, lambda x: x.isNotNull()),
            lambda found: F.transform(
                found, lambda x, i: x + F.coalesce(low(F.get(found, i + 1)), F.size(a)) - low(x) - low(x)
            ),
        )

    return let(ordered, tally)


def _long_runs(ordered: Column) -> Column:
    """As ``_tallied``, marked as LONG_RUN, of the grams that are there more than SHORT_RUN times."""
    further = F.filter(ordered, lambda g, i: g == F.get(ordered, i + SHORT_RUN))
    return F.transform(_tallied(further), lambda packed: packed + F.lit(LONG_RUN + SHORT_RUN))


def _short_run(ordered: Column, at: Column, gram: Column) -> Column:
    """How often a gram of a sorted array is there if this is its first place and if that is SHORT_RUN times or less, else 0."""
    ends = [~F.get(ordered, at + n).eqNullSafe(gram) for n in range(1, SHORT_RUN + 1)]
    n = F.when(F.get(ordered, at - 1).eqNullSafe(gram), F.lit(0))
    for count, end in enumerate(ends, 1):
        n = n.when(end, F.lit(count))
    return n.otherwise(F.lit(0))


def bucket_number(docs: DataFrame, text: str = "text") -> int:
    """How many buckets a corpus gets."""
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    return max(LEAST_BUCKETS, round(BUCKETS_PER_ROOT * math.sqrt(chars)))


def _texts(docs: DataFrame, trusted: DataFrame, text: str, id_column: str) -> DataFrame:
    """``id``, ``body``, ``is_trusted`` and ``key`` of each row; rows of one key have the same score."""
    ids = trusted.select(F.col(id_column).alias("trusted_id"))
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    return (
        rows.join(ids, F.col("id") == F.col("trusted_id"), "left")
        .select("id", "body", F.col("trusted_id").isNotNull().alias("is_trusted"))
        .withColumn("key", F.xxhash64("body", "is_trusted"))
    )


def gram_counts(texts: DataFrame, buckets: int) -> DataFrame:
    """``gram``, ``corpus`` and ``target``, its counts, of buckets that are met twice or more.

    The row without a gram has the totals, those of the other buckets included.
    """
    split = texts.select("is_trusted", split_words(F.col("body")).alias("words"))
    # words are listed before they are hashed, as compiled code does it then; what stands in a lambda is interpreted.
    # Outer, as a plain explode would have its input computed once more, in a filter of empty arrays.
    each = split.select("is_trusted", "words", F.posexplode_outer("words").alias("at", "word"))
    word, follower = F.xxhash64("word"), F.get("words", F.col("at") + 1)
    pair = F.when(follower.isNotNull(), _bucket(F.xxhash64(word, F.xxhash64(follower)), buckets))
    both = F.array(F.when(F.col("word").isNotNull(), _bucket(word, buckets)), pair)
    listed = each.select("is_trusted", F.size("words").alias("size"), F.explode_outer(both).alias("gram"))
    # the last word has no pair; its null stands for the document's size
    n = F.when(F.col("gram").isNull(), F.greatest(2 * F.col("size") - 1, F.lit(0))).otherwise(F.lit(1)).cast("long")
    return (
        listed.groupBy("gram")
        .agg(F.sum(n).alias("corpus"), F.sum(F.when(F.col("is_trusted"), n).otherwise(F.lit(0).cast("long"))).alias("target"))
        .filter("gram is null or corpus > 1")
    )


def score_keys(texts: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """``key``, the base counts of its rows' text and ``score``, the mean log ratio over its grams; null if there are none."""
    total = counts.filter("gram is null").first()
    corpus, target = (total["corpus"], total["target"]) if total else (0, 0)
    # without trusted words, one stands for them
    share = max(target, 1) / max(corpus, 1)
    # a bucket that is not stored is met once: here, in the corpus, and not in another trusted document
    once = math.log(SMOOTHING) - math.log(1 + SMOOTHING)
    below = F.log(F.col("corpus") + F.lit(SMOOTHING)) + F.lit(once)
    plain = F.log(F.col("target") / F.lit(share) + SMOOTHING) - below
    stored = counts.filter("gram is not null").select("gram", "corpus", "target", below.alias("below"), plain.alias("plain"))
    few = stored.count() <= BROADCAST_BUCKETS
    # less than BROADCAST_BUCKETS can have more than that part of all occurrences
    is_frequent = F.lit(True) if few else F.col("corpus") > corpus / BROADCAST_BUCKETS
    frequent = F.broadcast(stored.filter(is_frequent).drop("corpus"))

    # steps of their own, as what stands within a lambda is interpreted; the arrays are sorted by compiled code
    split = texts.select("key", "is_trusted", "body", split_words(F.col("body")).alias("words"))
    hashed = split.select("*", _hashes(F.col("words")).alias("hashes"))
    paired = hashed.select("*", _pairs(F.col("hashes")).alias("pairs"))
    windows = _window_hashes(F.col("hashes"), REPEAT_WINDOW, F.col("pairs"))
    windowed = paired.select("*", windows.alias("windows"))

    def listed(*more: Column) -> DataFrame:
        """Rows of a gram, the documents' sizes under a null one; the own counts matter for trusted ones alone."""
        grams = windowed.select("key", "is_trusted", *more, F.concat("hashes", "pairs").alias("grams"))
        kept = ["key", "is_trusted", "size", *[c for c in grams.columns[2:] if c != "grams"]]
        placed = F.when(F.col("is_trusted"), F.transform("grams", lambda h: _bucket(h, buckets))).otherwise(F.col("grams"))
        ordered = F.when(F.col("is_trusted"), F.sort_array("grams")).otherwise(F.col("grams"))
        sized = grams.select(*kept[:2], F.size("grams").alias("size"), *kept[3:], placed.alias("grams"))
        sized = sized.select(*kept, ordered.alias("grams"))
        runs = F.when(F.col("is_trusted"), _long_runs(F.col("grams"))).otherwise(F.array().cast("array<bigint>"))
        # one more element, a null, stands for the document's size; a plain explode would have its input computed
        # once more, in a filter of empty arrays
        ended = sized.select(*kept, F.concat("grams", runs, F.array(F.lit(None).cast("long"))).alias("grams"))
        each = ended.select(*kept, "grams", F.posexplode_outer("grams").alias("at", "packed"))
        is_long = F.col("packed") >= F.lit(LONG_RUN)
        n = F.when(~F.col("is_trusted") | F.col("packed").isNull(), F.lit(1)).when(
            is_long, F.col("packed").bitwiseAND(F.lit(LOW))
        )
        counted = each.withColumn("n", n.otherwise(_short_run(F.col("grams"), F.col("at"), F.col("packed")))).filter("n > 0")
        return counted.select(
            *[c for c in kept if c != "size"],
            F.when(F.col("packed").isNull(), F.col("size")).otherwise(F.lit(0)).cast("long").alias("size"),
            F.when(~F.col("is_trusted"), _bucket(F.col("packed"), buckets))
            .when(is_long, F.shiftright(F.col("packed") - F.lit(LONG_RUN), LOW_BITS))
            .otherwise(F.col("packed"))
            .alias("gram"),
            "n",
        )

    own = F.log((F.col("target") - F.col("n")) / F.lit(share) + SMOOTHING) - F.col("below")
    above = F.coalesce(F.col("n") * F.when(F.col("is_trusted"), own).otherwise(F.col("plain")), F.lit(0.0)).alias("above")
    base = base_counts(F.col("body"), F.col("words"), F.col("windows"))

    whole = listed(*[value.alias(name) for name, value in base.items()])
    parts = whole.join(frequent, "gram", "left").select("key", *base, above, "size")
    if not few:
        rare = stored.filter(~is_frequent).hint("shuffle_hash")
        unmet = listed().filter("gram is not null").join(frequent.select("gram"), "gram", "left_anti")
        none = [F.lit(0).cast("long").alias(name) for name in base]
        parts = parts.unionByName(unmet.join(rare, "gram").select("key", *none, above, F.lit(0).cast("long").alias("size")))
    sums = parts.groupBy("key").agg(
        *[F.max(name).alias(name) for name in base], F.sum("above").alias("above"), F.sum("size").alias("size")
    )
    score = F.when(F.col("size") > 0, F.col("above") / F.col("size") + F.lit(once))
    return sums.select("key", *base, score.alias("score"))


def _window_hashes(items: Column, window: int, pairs: Column | None = None) -> Column:
    """A hash of each ``window`` neighbouring items, put together of their pairs; ``pairs`` are those if they are there already."""

    def joined(pairs: Column) -> Column:
        def one(i: Column) -> Column:
            parts = [F.get(pairs, i + k) for k in range(0, window - 1, 2)]
            return F.xxhash64(*parts, *([F.get(items, i + (window - 1))] if window % 2 else []))

        # the last ones lack some and are cut off
        hashes = F.transform(items, lambda _, i: one(i))
        return F.slice(hashes, F.lit(1), F.greatest(F.size(items) - (window - 1), F.lit(0)))

    return let(_pairs(items), joined) if pairs is None else joined(pairs)


def repeated_words(words: Column, window: int = REPEAT_WINDOW) -> Column:
    """Number of words within windows that the array holds twice or more, the first time included."""
    hashes = _hashes(F.coalesce(words, F.array().cast("array<string>")))
    return let(hashes, lambda a: let(_window_hashes(a, window), lambda keys: _covered_words(keys, window)))


def _covered_words(keys: Column, window: int) -> Column:
    """As ``repeated_words``, from the hashes of the windows."""

    def covered(keys: Column) -> Column:
        low = F.lit((1 << PLACE_BITS) - 1).cast("long")
        packed = F.transform(keys, lambda key, i: key.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long")))
        short = F.transform(F.sort_array(packed), lambda x: x.bitwiseAND(low).cast("int"))
        placed = F.transform(keys, lambda key, i: F.struct(key.alias("key"), i.alias("at")))
        long = F.transform(F.sort_array(placed), lambda row: row["at"])
        # places in the order of their windows' hashes; whole hashes are compared
        order = F.when(F.size(keys) <= 1 << PLACE_BITS, short).otherwise(long)

        def starts(order: Column) -> Column:
            def repeated(held: Column) -> Column:
                return F.filter(
                    order,
                    lambda at, i: (F.get(held, i - 1) == F.get(held, i)).eqNullSafe(F.lit(True))
                    | (F.get(held, i + 1) == F.get(held, i)).eqNullSafe(F.lit(True)),
                )

            return F.sort_array(let(F.transform(order, lambda at: F.get(keys, at)), repeated))

        def length(at: Column) -> Column:
            gaps = pairwise(at, lambda a, b: F.least(b - a, F.lit(window)))
            return F.aggregate(gaps, F.lit(window), lambda total, gap: total + gap)

        return let(let(order, starts), length)

    return (
        F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)).otherwise(covered(keys)).cast("long")
    )


def base_counts(text: Column, words: Column, windows: Column) -> dict[str, Column]:
    """The counts that the base rules use, of a text without nulls, its words and the hashes of their windows."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOL)).cast("long"),
        "n_dup_lines": let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long"),
        "n_repeat_words": _covered_words(windows, REPEAT_WINDOW),
    }


def score_documents(
    docs: DataFrame,
    trusted: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    threshold: float = THRESHOLD,
    buckets: int | None = None,
) -> DataFrame:
    """One row for each row of ``docs``: its id, the base counts, ``base_failed``, ``score`` and ``kept``.

    Null and empty texts have no words, fail the base rules and score null. Repeated rows score alike, the
    order of rows does not matter, an empty table gives an empty result. Null ids are never trusted. Other
    columns of ``docs`` are not read. Whole texts are scored, however long. Without ``buckets``,
    ``bucket_number`` sets them.
    """
    buckets = buckets or bucket_number(docs, text)
    texts = _texts(docs, settle(trusted.select(id_column).distinct()), text, id_column)
    scores = score_keys(texts, settle(gram_counts(texts, buckets)), buckets)
    scored = texts.select("id", "key").join(scores, "key", "left").drop("key").withColumnRenamed("id", id_column)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & F.coalesce(F.col("score") >= threshold, F.lit(False))
    )
