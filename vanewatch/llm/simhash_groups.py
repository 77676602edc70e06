"""Groups documents whose 64-bit similarity fingerprints differ in few bits, by the general pigeonhole principle.

The bits of a fingerprint are dealt into parts, bits that go together into the same part. Each part has a threshold
of its own: if the thresholds plus one add up to the allowed number of differences plus one, two fingerprints that
link are within the threshold in one part at least. A dynamic programme chooses the thresholds, and the number of
parts, by the rows and candidate pairs that they are estimated to cost, from the fingerprints' number, the balance
of their bits and a bounded sample of them. A part with threshold -1 is not used at all.

Within a threshold t, two values of a part become equal when each loses some of its set bits, t in all. Fingerprints
therefore meet in buckets by their part's value with up to t set bits cleared. A bucket's fingerprints are first held
against its smallest one, and components named. Where several components are left, small buckets are joined with
themselves; in large ones the bits outside the bucket's part are dealt into parts again, until all buckets are small.
So no group of similar texts is ever expanded into its pairs, and no bucket is capped.

All comparisons are exact. Estimates decide about cost only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import combinations
from math import comb, prod

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewatch.llm import text_arrays as ta
from vanewatch.llm.components import connected
from vanewatch.scratch import settle

SHINGLE_WORDS = 4
DIFFERENT = 4
BITS = 64
# fixed value: the seed of the shingles' hash
SEED = 42

# Fingerprints looked at when thresholds are chosen (by smallest hash), 8 bytes each.
SAMPLE = 4096
# Cost of a row written to a bucket, in candidate pairs compared.
ROW_COST = 30
# Members of a bucket that is joined with itself; larger ones are divided, but for the last level.
SMALL_BUCKET = 128
LEVELS = 6
# Names of components that may be broadcast, 16 bytes each.
BROADCAST_NAMES = 500_000


def _fingerprints(data: np.ndarray, offsets: np.ndarray, shingle_words: int) -> np.ndarray:
    """One fingerprint for each text of a group."""
    data = ta.LOWER[data]
    gap = ta.IS_SPACE[data]
    starts, ends, first = ta.spans(gap, offsets)
    # the words of all texts with one space after each
    size = ends - starts
    at = np.cumsum(size + 1) - (size + 1)
    joined = np.full(int((size + 1).sum()), 0x20, np.uint8)
    word = np.repeat(np.arange(len(starts)), size)
    step = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)
    joined[at[word] + step] = data[starts[word] + step]
    raw = joined.tobytes()
    out = np.zeros(len(offsets) - 1, ta.U64)
    digest = xxhash.xxh64_intdigest
    for row, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if lo == hi:
            continue
        n = min(shingle_words, hi - lo)
        begin = at[lo : hi - n + 1]
        end = at[lo + n - 1 : hi] + size[lo + n - 1 : hi]
        hashes = [digest(raw[a:z], SEED) for a, z in zip(begin.tolist(), end.tolist())]
        ones = np.zeros(BITS, np.int64)
        for part in range(0, len(hashes), 1 << 16):
            octets = np.array(hashes[part : part + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[row] = np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``print``, the fingerprint as a signed number, of every row; texts without words have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_fingerprints(data, offsets, shingle_words) for _, data, offsets in ta.text_groups(batch.column(1))]
            prints = np.concatenate(found) if found else np.zeros(0, ta.U64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ta.signed(prints))], names=["doc_id", "print"])

    return docs.select(F.col(id_column).cast("long"), F.col(text)).mapInArrow(run, "doc_id long, print long")


# --- parts and thresholds ---------------------------------------------------------------------------


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have each pair of bits set (64 x 64), added up on Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = unpacked(np.asarray(batch.column(0)).view(ta.U64)).astype(np.float32)
            both += bits.T @ bits
            n += len(bits)
        place = np.arange(BITS * BITS + 1)
        counts = np.append(both.reshape(-1), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(counts)], names=["place", "n"])

    sums = nodes.select("print").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BITS * BITS + 1)
    out[sums.column("place").to_numpy()] = sums.column("n").to_numpy()
    return int(out[-1]), out[:-1].reshape(BITS, BITS)


def unpacked(prints: np.ndarray) -> np.ndarray:
    """Bits of each fingerprint, the lowest first."""
    return np.unpackbits(np.ascontiguousarray(prints).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlation(n: int, both: np.ndarray) -> np.ndarray:
    share = both / max(n, 1)
    ones = np.diag(share)
    spread = np.sqrt(np.clip(ones * (1 - ones), 1e-12, None))
    found = np.abs((share - np.outer(ones, ones)) / np.outer(spread, spread))
    np.fill_diagonal(found, 0)
    return found


def grouped_bits(bits: list[int], related: np.ndarray, parts: int) -> list[list[int]]:
    """Deals bits into parts of even size. A part starts with the two most related bits left, and takes on those
    most related to what it has."""
    left, out = list(bits), []
    for number in range(parts):
        size = -(-len(left) // (parts - number))
        if size == 0:
            break
        strength = related[np.ix_(left, left)].max(axis=1)
        part = [left[int(np.argmax(strength))]]
        left.remove(part[0])
        while len(part) < size:
            best = left[int(np.argmax(related[np.ix_(left, part)].sum(axis=1)))]
            part.append(best)
            left.remove(best)
        out.append(sorted(part))
    return out


def allocate(costs: np.ndarray, total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 on, one for each row of ``costs`` (column j holds the cost of threshold j - 1), which plus
    one add up to ``total``, of the least cost in all."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for j in range(min(len(row), total - used + 1)):
                new = (cost + float(row[j]), [*chosen, j - 1])
                if used + j not in after or new < after[used + j]:
                    after[used + j] = new
        best = after
    return best[total]


def choose_parts(n: int, both: np.ndarray, sample: np.ndarray, different: int = DIFFERENT) -> list[tuple[list[int], int]]:
    """(bits, threshold) of every part that is used."""
    related, ones = correlation(n, both), np.diag(both) / max(n, 1)
    bits = unpacked(sample).astype(np.float32)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for parts in range(1, different + 2):
        groups = grouped_bits(list(range(BITS)), related, parts)
        costs = np.zeros((parts, different + 2))
        for i, group in enumerate(groups):
            own = bits[:, group]
            counts = np.zeros(BITS + 1, np.int64)
            # a block of the sample against all of it, so that the driver needs little memory
            for at in range(0, len(own), 256):
                some = own[at : at + 256]
                distance = (some @ (1 - own).T + (1 - some) @ own.T).astype(np.uint8)
                counts += np.bincount(distance.reshape(-1), minlength=BITS + 1)
            # without each one's distance to itself
            counts[0] -= len(own)
            seen = np.cumsum(counts[: different + 1]) / max(1, len(own) * (len(own) - 1))
            even = np.cumsum([comb(len(group), t) for t in range(different + 1)]) / 2.0 ** len(group)
            set_bits = float(ones[group].sum())
            # ways to clear t of that many set bits
            rows = np.cumsum([prod(max(0.0, set_bits - b) / (b + 1) for b in range(t)) for t in range(different + 1)])
            # pairs within t: as many as in the sample, and as even bits would have
            costs[i, 1:] = n * rows * ROW_COST + n * n / 2 * np.maximum(seen, even)
        cost, thresholds = allocate(costs, different + 1)
        if best is None or cost < best[0]:
            best = cost, [(g, t) for g, t in zip(groups, thresholds) if t >= 0]
    return best[1]


# --- buckets ------------------------------------------------------------------------------------------


def _number(bits: Iterable[int]) -> int:
    """The signed number that has these bits."""
    return int(ta.signed(np.array([sum(1 << b for b in bits)], ta.U64))[0])


def _key(prefix: list[Column], value: Column) -> Callable[[Column], Column]:
    return lambda cleared: F.xxhash64(*prefix, value.bitwiseXOR(cleared))


def bucket_rows(nodes: DataFrame, parts: list[tuple[list[int], int]], *within: str) -> DataFrame:
    """``bucket``, ``print`` and ``component``: a row for each value of a part with up to its threshold of set bits cleared.

    Buckets are told apart by the columns ``within`` as well.
    """
    keys: list[Column] = []
    for number, (bits, threshold) in enumerate(parts):
        value = F.col("print").bitwiseAND(F.lit(_number(bits)))
        subsets = [_number(s) for n in range(threshold + 1) for s in combinations(bits, n)]
        cleared = F.filter(F.array(*map(F.lit, subsets)), lambda s: F.col("print").bitwiseAND(s) == s)
        keys.append(F.transform(cleared, _key([*map(F.col, within), F.lit(number)], value)))
    return nodes.select(F.explode(F.concat(*keys)).alias("bucket"), "print", "component")


def _links_in(rows: DataFrame, different: int) -> DataFrame:
    """Links (a, b) between components such that all pairs of fingerprints that meet in a bucket are connected."""
    spark = rows.sparkSession
    links = spark.createDataFrame([], "a long, b long")
    for level in range(1, LEVELS + 1):
        # the smallest of a bucket, with those that it is linked to
        head = F.min(F.struct("print", "component")).alias("head")
        buckets = rows.groupBy("bucket").agg(head, F.min("component").alias("low"), F.max("component").alias("high"))
        shared = settle(rows.join(buckets.filter("low < high").select("bucket", "head"), "bucket"))
        near = F.bit_count(F.col("print").bitwiseXOR(F.col("head.print"))) <= different
        star = shared.filter(near & (F.col("component") != F.col("head.component")))
        star = settle(star.select(F.col("component").alias("a"), F.col("head.component").alias("b")).distinct())
        links = links.unionByName(star)

        # what is left to do: buckets that still hold several components
        members = renamed(shared.select("bucket", "print", "component"), connected(star))
        left = members.groupBy("bucket").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")
        )
        members = settle(members.join(left.filter("low < high").select("bucket", "n"), "bucket"))
        joined = members if level == LEVELS else members.filter(F.col("n") <= SMALL_BUCKET)
        a = joined.select("bucket", F.col("print").alias("print_a"), F.col("component").alias("a"))
        b = joined.select("bucket", F.col("print").alias("print_b"), F.col("component").alias("b"))
        near = F.bit_count(F.col("print_a").bitwiseXOR(F.col("print_b"))) <= different
        met = a.join(b, (a["bucket"] == b["bucket"]) & (F.col("a") < F.col("b")) & near)
        links = links.unionByName(settle(met.select("a", "b").distinct()))

        large = members.filter(F.col("n") > SMALL_BUCKET)
        if level == LEVELS or large.isEmpty():
            return links
        # other parts at each level, so that the bits that a bucket's members share are spread over them
        order = np.argsort(ta.seeded(100 + level, BITS)).tolist()
        parts = [(order[i :: different + 1], 0) for i in range(different + 1)]
        rows = bucket_rows(large, parts, "bucket")
    return links


def renamed(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``rows`` with their component as ``names`` (node, component) has it, if it has."""
    names = settle(names.select(F.col("node").alias("component"), F.col("component").alias("name")))
    if names.limit(BROADCAST_NAMES + 1).count() <= BROADCAST_NAMES:
        names = F.broadcast(names)
    name = F.coalesce("name", "component").alias("component")
    return rows.join(names, "component", "left").select(*[name if c == "component" else c for c in rows.columns])


def group_near(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    shingle_words: int = SHINGLE_WORDS,
    different: int = DIFFERENT,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hexadecimal) and ``component_id`` for each row of ``docs``.

    A bit of the fingerprint is set if it is in more than half of the hashes of the text's shingles, repeats
    included. A text with fewer words is one shingle; null texts and those without words have fingerprint zero,
    which is linked like any other. Rows without an id are linked too, but name no component: it is null where no
    row of a group has an id. Rows that repeat an id or a text are all kept. Texts of any length are read whole. An
    empty table gives an empty result. Other columns are not read.
    """
    described = settle(fingerprints(docs, id_column, text, shingle_words))
    nodes = settle(described.groupBy("print").agg(F.min("doc_id").alias("first")))
    n, both = bit_statistics(nodes)
    sample = nodes.select("print").orderBy(F.xxhash64("print"), "print").limit(SAMPLE).toArrow()
    parts = choose_parts(n, both, sample.column("print").to_numpy().view(ta.U64), different)
    start = nodes.select("print", F.col("print").alias("component"))
    components = connected(_links_in(bucket_rows(start, parts), different))

    # only fingerprints that are linked take another one's smallest id
    linked = settle(nodes.join(components.withColumnRenamed("node", "print"), "print"))
    least = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = linked.join(least, "component").select("print", "component_id")
    classes = nodes.join(ids, "print", "left").select(
        "print", F.when(F.col("component_id").isNull(), F.col("first")).otherwise(F.col("component_id")).alias("component_id")
    )
    fingerprint = F.lpad(F.lower(F.hex("print")), BITS // 4, "0").alias("fingerprint")
    return described.join(classes, "print").select("doc_id", fingerprint, "component_id")
