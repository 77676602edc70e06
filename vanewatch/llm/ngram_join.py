"""Groups documents whose sets of word shingles are similar by Jaccard, with PartEnum signatures.

Sets are put into bands of similar size. Two sets of similarity ``SIMILAR`` that meet in a band differ in at
most k shingles, k following from the band's largest size. A hash deals the domain of shingles into groups of
``PARTS`` partitions. With more than k / (LOST + 1) groups, at least one group has no more than LOST
differences, so the two agree in some ``PARTS - LOST`` of its partitions: a signature is the content of such
a subset of partitions. Sets that share a signature are compared exactly.

Partitions with too few shingles would be shared by unrelated sets, say those with a common passage. Their
signatures are left out, and some groups are added to make up for it. A set with more of such groups than were
added draws new partitions with the next seed; two similar sets both reach the seed under which one of them is
served, so no pair is lost.

Before that, a histogram of each set's hashes bounds the similarity from above: what differs between two
histograms differs between the sets. Most chance pairs end there, and no set has to be moved for them.

Sets that are equal are one node. In a bucket of sets with the same signature each set is compared with one
of them, so that a large bucket of similar sets costs as many comparisons as it has members. What is not linked
then, the sets outside a bucket's largest component, are compared with all members of their buckets. Small
buckets are written as pairs. In a larger one histograms, two bits for each place, are compared inside the task,
and only the pairs that these leave are written and counted exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vanewatch.llm import text_arrays as ta
from vanewatch.llm.components import connected
from vanewatch.llm.words import free_names
from vanewatch.scratch import settle

SHINGLE_WORDS = 4
# similarity in hundredths
SIMILAR = 85
PARTS, LOST = 3, 1
# Shingles that a signature stands for at least, where sets are large enough.
CONTENT = 2
SEEDS = 12
STAR_ROUNDS = 1
# Signatures that a task gathers before it hands them over, 16 bytes each.
BUFFER = 1 << 20
# Shingles whose signatures meet in one range; each has one or two, at 16 bytes.
PART_SHINGLES = 1_000_000
# Ids that may be broadcast, 16 bytes each.
BROADCAST_IDS = 1_000_000
# Places of the smallest histogram. In few places much of what differs between small sets hides.
PLACES = 512
# Members of a bucket whose pairs are written; larger buckets are compared as they are.
PAIRED = 16
# Shingles of the sets of such buckets that a task takes, up to a quarter of a byte each.
BLOCK_SHINGLES = 1 << 26
# Pairs of a bucket that are compared at a time.
COUNTED = 1 << 19
# Partners of a set in another component that are counted at first, where more may be similar.
CLOSEST = 64


def _sets(column: pa.Array, shingle_words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    for _, data, offsets in ta.text_groups(column):
        data = ta.LOWER[data]
        starts, ends, first = ta.spans(ta.IS_SPACE[data], offsets)
        words = ta.run_hash(ta.prefix_hash(data), starts, ends)
        for lo, hi in zip(first[:-1], first[1:]):
            yield np.unique(ta.shingles(words[lo:hi], shingle_words))


def _digest(items: np.ndarray) -> tuple[int, int]:
    """Two independent sums over a set; sets that agree in both and in size are taken as equal."""
    return tuple(int(ta.signed(ta.mix(items ^ ta.U64(salt)).sum(dtype=ta.U64).reshape(1))[0]) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F))


def band_ratio(similar: int) -> float:
    """A band's largest size over its smallest, at least 100 / similar.

    Wide bands have fewer sets in two of them. Below 85 they would leave partitions with so few shingles that
    sets draw seed after seed: at 80, about five times the signatures of narrow ones.
    """
    return (100 / similar) ** (2 if similar >= 85 else 1)


def band_of(size: int, similar: int) -> int:
    """Number of the band; band i holds sizes from ``band_start(i)`` to ``band_start(i + 1) - 1``."""
    band = int(math.log(size) / math.log(band_ratio(similar)))
    while size >= band_start(band + 1, similar):
        band += 1
    while size < band_start(band, similar):
        band -= 1
    return band


def band_start(band: int, similar: int) -> int:
    return math.ceil(round(band_ratio(similar) ** band, 9))


@cache
def plan(band: int, similar: int) -> tuple[int, int, int, int, int]:
    """Partitions of a group, groups, differences allowed in one, spare groups, and shingles of a signature."""
    largest = band_start(band + 1, similar) - 1
    # |a - b| + |b - a| is at most (1 - s) / (1 + s) times |a| + |b|
    k = (100 - similar) * 2 * largest // (100 + similar)
    lost = min(LOST, k)
    parts = lost + 1 if k < PARTS else PARTS
    groups, smallest = k // (lost + 1) + 1, max(1, band_start(band, similar) * similar // 100)
    # spare groups thin out all of them, so their number is settled step by step
    for least in range(CONTENT, 0, -1):
        spare = 0
        for _ in range(50):
            mean = smallest * (parts - lost) / ((groups + spare) * parts)
            scarce = math.exp(-mean) * sum(mean**i / math.factorial(i) for i in range(least))
            bare = (groups + spare) * math.comb(parts, lost) * scarce
            wanted = math.ceil(bare + 2 * math.sqrt(bare)) if bare > 0.25 else 0
            if wanted <= spare:
                return parts, groups + spare, lost, spare, least
            spare = wanted
            if spare > groups / 2:
                break
    return parts, groups, lost, 0, 1


@cache
def _draw(band: int, seed: int) -> ta.U64:
    """What a band's shingles are mixed with under a seed."""
    return ta.mix(np.array([band * SEEDS + seed + 1], ta.U64))[0]


@cache
def _subsets(parts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The subsets of that many partitions, and a number that tells their signatures apart."""
    chosen = np.array(list(combinations(range(parts), size)))
    return chosen, ta.seeded(2, len(chosen))


def signatures(items: np.ndarray, similar: int) -> np.ndarray:
    """All signatures of a set; empty sets have none."""
    out: list[np.ndarray] = []
    size = len(items)
    if size == 0:
        return np.zeros(0, ta.U64)
    band = band_of(size, similar)
    # a partner is at most 100 / similar times as large; the pair meets in the band of the larger one
    bands = [band] + ([band + 1] if size * 100 >= similar * band_start(band + 1, similar) else [])
    for number in bands:
        parts, groups, lost, spare, least = plan(number, similar)
        chosen, marks = _subsets(parts, parts - lost)
        for seed in range(SEEDS):
            salt = _draw(number, seed)
            drawn = ta.mix(items ^ salt)
            place = ((drawn >> ta.U64(11)) % ta.U64(groups * parts)).astype(np.int64)
            sums = np.zeros(groups * parts, ta.U64)
            np.add.at(sums, place, ta.mix(drawn))
            filled = np.bincount(place, minlength=groups * parts).reshape(groups, parts)
            content = ta.mix(sums + np.arange(groups * parts, dtype=ta.U64) + salt).reshape(groups, parts)
            scarce = filled[:, chosen].sum(axis=2) < least
            keys = ta.mix(content[:, chosen].sum(axis=2, dtype=ta.U64) ^ marks)
            out.append(keys.reshape(-1) if seed == SEEDS - 1 else keys[~scarce])
            if scarce.any(axis=1).sum() <= spare:
                break
    return np.unique(np.concatenate(out))


def _places(size: int) -> int:
    return max(PLACES, 1 << max(0, (size - 1).bit_length() - 1))


def sketch(items: np.ndarray) -> bytes:
    """Histogram of a set over half as many places as it has items, rounded up to a power of two, but ``PLACES`` at least.

    Nothing if a count does not fit a byte, which chance does not bring about.
    """
    if len(items) == 0:
        return b""
    places = _places(len(items))
    counts = np.bincount((items & ta.U64(places - 1)).astype(np.int64), minlength=places)
    return b"" if counts.max() > 255 else counts.astype(np.uint8).tobytes()


def may_be_similar(n_a: int, sketch_a: bytes, n_b: int, sketch_b: bytes, similar: int) -> bool:
    """False if the histograms differ too much for sets of ``n_a`` and ``n_b`` items to be similar."""
    difference = abs(n_a - n_b)
    if sketch_a and sketch_b:
        a, b = (np.frombuffer(x, np.uint8).astype(np.int64) for x in (sketch_a, sketch_b))
        places = min(len(a), len(b))
        difference = int(np.abs(a.reshape(-1, places).sum(axis=0) - b.reshape(-1, places).sum(axis=0)).sum())
    common = (n_a + n_b - difference) // 2
    return 100 * common >= similar * (n_a + n_b - common)


def describe_sets(docs: DataFrame, id_column: str, text: str, shingle_words: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, the set's digest (``d1``, ``d2``) and its ``sketch``, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(s), *_digest(s), sketch(s)) for s in _sets(batch.column(1), shingle_words)]
            n, d1, d2, sketches = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, d1, d2)), pa.array(sketches, pa.binary())],
                names=["doc_id", "n_shingles", "d1", "d2", "sketch"],
            )

    rows = docs.select(F.col(id_column).cast("long"), F.col(text))
    return rows.mapInArrow(ta.released(run), "doc_id long, n_shingles long, d1 long, d2 long, sketch binary")


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, first all lowest ones: what is alike stands together and takes little room on disk."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(8, -1).T.copy().view("<u8").reshape(-1)


def _signature_rows(docs: DataFrame, shingle_words: int, similar: int, parts: int) -> DataFrame:
    """Signatures and the nodes that have them, packed by range of signatures: ``part``, ``signatures``, ``nodes``."""
    names = ["part", "signatures", "nodes"]

    def packed(keys: list[np.ndarray], nodes: list[np.ndarray]) -> pa.RecordBatch:
        all_keys, all_nodes = np.concatenate(keys), np.concatenate(nodes)
        order = np.argsort(all_keys)
        all_keys, all_nodes = all_keys[order], all_nodes[order]
        part = ((all_keys >> ta.U64(32)) * ta.U64(parts)) >> ta.U64(32)
        edges = np.searchsorted(part, np.arange(parts + 1, dtype=ta.U64)).tolist()
        rows = [
            (p, _planes(all_keys[lo:hi]), _planes(all_nodes[lo:hi]))
            for p, (lo, hi) in enumerate(zip(edges[:-1], edges[1:]))
            if lo < hi
        ]
        columns = list(zip(*rows)) if rows else [()] * 3
        types = (pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        nodes: list[np.ndarray] = []
        size = 0
        for batch in batches:
            own = np.asarray(batch.column(0), np.int64)
            for node, items in zip(own, _sets(batch.column(1), shingle_words)):
                found = signatures(items, similar)
                keys.append(found)
                nodes.append(np.full(len(found), node).view(ta.U64))
                size += len(found)
                if size >= BUFFER:
                    yield packed(keys, nodes)
                    keys, nodes, size = [], [], 0
        if size:
            yield packed(keys, nodes)

    return docs.select("node", "text").mapInArrow(ta.released(run), "part int, signatures binary, nodes binary")


def _shared_signatures(rows: DataFrame, parts: int) -> DataFrame:
    """``signature``, ``node`` and the ``lowest`` node that has it, of signatures that several nodes have."""

    def found(keys: list[np.ndarray], nodes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        all_keys, all_nodes = np.concatenate(keys), np.concatenate(nodes).view(np.int64)
        order = np.argsort(all_keys)
        all_keys, all_nodes = all_keys[order], all_nodes[order]
        first = np.flatnonzero(np.concatenate([[True], all_keys[1:] != all_keys[:-1]]))
        lowest, highest = (ufunc.reduceat(all_nodes, first) for ufunc in (np.minimum, np.maximum))
        size = np.diff(np.append(first, len(all_keys)))
        several = np.repeat(lowest < highest, size)
        columns = (ta.signed(all_keys[several]), all_nodes[several], np.repeat(lowest, size)[several])
        for at in range(0, len(columns[0]), 1 << 18):
            part = [pa.array(c[at : at + (1 << 18)], pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(part, names=["signature", "node", "lowest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a partition holds few ranges; they are kept as they came and unpacked one after the other
        held: dict[int, list[tuple[bytes, bytes]]] = {}
        for batch in batches:
            for part, own_keys, own_nodes in zip(*(batch.column(i).to_pylist() for i in range(3))):
                held.setdefault(part, []).append((own_keys, own_nodes))
        while held:
            _, packed = held.popitem()
            keys, nodes = zip(*packed)
            yield from found([_from_planes(k) for k in keys], [_from_planes(n) for n in nodes])

    return rows.repartition(parts, "part").mapInArrow(ta.released(run), "signature long, node long, lowest long")


def _set_rows(docs: DataFrame, shingle_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [ta.signed(s) for s in _sets(part.column(1), shingle_words)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "items"]
                )

    return docs.mapInArrow(ta.released(run), "node long, items array<long>")


def restrict(docs: DataFrame, id_column: str, ids: DataFrame, keep: bool) -> DataFrame:
    """Rows whose id is, or is not, among ``ids``: broadcast if they are few, else joined by key."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    (other,) = free_names(docs.columns, "of_node")
    ids = ids.select(F.col(ids.columns[0]).alias(other))
    ids = F.broadcast(ids) if few else ids.hint("shuffle_hash")
    return docs.join(ids, F.col(id_column) == F.col(other), "left_semi" if keep else "left_anti")


def possible_pairs(pairs: DataFrame, sketches: DataFrame, similar: int) -> DataFrame:
    """Those pairs (a, b) of nodes that their sketches do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(2, 6)))
            keep = pa.array([may_be_similar(*row, similar) for row in rows], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    a = sketches.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    b = sketches.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "sketch_a", "n_b", "sketch_b")
    return both.mapInArrow(ta.released(run), "a long, b long")


def similar_pairs(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, shingle_words: int, similar: int) -> DataFrame:
    """Those pairs (a, b) of nodes whose sets are similar: ruled out by sketch, else counted exactly."""
    pairs = settle(possible_pairs(pairs, sketches, similar))
    needed = settle(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    sets = _set_rows(restrict(texts, "node", needed, keep=True), shingle_words)
    a = sets.select(F.col("node").alias("a"), F.col("items").alias("items_a"))
    b = sets.select(F.col("node").alias("b"), F.col("items").alias("items_b"))
    common = F.size(F.array_intersect("items_a", "items_b"))
    n = F.size("items_a") + F.size("items_b")
    counted = pairs.join(a, "a").join(b, "b").select("a", "b", common.alias("common"), n.alias("n"))
    return settle(counted.filter(f"100 * common >= {int(similar)} * (n - common)").select("a", "b"))


def _in_buckets(members: DataFrame, parts: int, crowded: bool) -> DataFrame:
    """What is left to compare, by bucket.

    Of buckets of up to ``PAIRED`` sets the pairs (a, b) of different components; else, with ``crowded``, the
    rows ``signature``, ``node``, ``component`` of the larger ones and whether a set is ``outside`` the largest component.
    """

    def pairs(nodes: np.ndarray, components: np.ndarray, first: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        for members_of_one in range(2, PAIRED + 1):
            one, other = np.triu_indices(members_of_one, 1)
            starts, step = first[size == members_of_one], max(1, COUNTED // len(one))
            for at in range(0, len(starts), step):
                x, y = (starts[at : at + step, None] + np.arange(members_of_one))[:, [one, other]].transpose(1, 0, 2)
                apart = components[x] != components[y]
                x, y = nodes[x[apart]], nodes[y[apart]]
                columns = [pa.array(c) for c in (np.minimum(x, y), np.maximum(x, y))]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    def rows(*bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
        signature, nodes, components, first, size = bucket
        start = np.flatnonzero(_changes(signature) | _changes(components))
        length = np.diff(np.append(start, len(signature)))
        # the largest component of each bucket, of equal ones the one with the largest number
        order = np.lexsort((components[start], length, signature[start]))
        largest = order[_changes(signature[start][order][::-1])[::-1]]
        outside = np.ones(len(start), bool)
        outside[largest] = False
        keep = np.repeat(size > PAIRED, size)
        columns = [c[keep] for c in (signature, nodes, components, np.repeat(outside, length))]
        for at in range(0, len(columns[0]), 1 << 18):
            part = [pa.array(c[at : at + (1 << 18)]) for c in columns]
            yield pa.RecordBatch.from_arrays(part, names=["signature", "node", "component", "outside"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[np.asarray(batch.column(i), np.int64) for i in range(3)] for batch in batches]
        if not held:
            return
        signature, nodes, components = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((nodes, components, signature))
        order = order[_changes(signature[order]) | _changes(nodes[order])]
        signature, nodes, components = signature[order], nodes[order], components[order]
        first = np.flatnonzero(_changes(signature))
        size = np.diff(np.append(first, len(signature)))
        yield from rows(signature, nodes, components, first, size) if crowded else pairs(nodes, components, first, size)

    columns = "signature long, node long, component long, outside boolean" if crowded else "a long, b long"
    return members.select("signature", "node", "component").repartition(parts, "signature").mapInArrow(ta.released(run), columns)


def _changes(ordered: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before it; the first one does."""
    return np.concatenate([np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1]])


def _gray(counts: np.ndarray) -> np.ndarray:
    """The last two bits of each count, such that neighbours, 3 and 0 among them, differ in one bit. A row for each set."""
    high, low = counts >> 1 & 1, counts & 1
    return np.packbits(np.concatenate([high, high ^ low], axis=1).astype(np.uint8), axis=1)


def _from_gray(raw: np.ndarray, places: int) -> np.ndarray:
    bits = np.unpackbits(raw, axis=1, count=2 * places)
    high, low = bits[:, :places], bits[:, places:]
    return 2 * high + (high ^ low)


def _short_sketches(sketches: DataFrame) -> DataFrame:
    """``node``, ``n`` and, in a quarter of the room, the sketch's counts modulo four; nothing where there is no sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            full = (np.frombuffer(x or b"", np.uint8)[None] for x in batch.column(2).to_pylist())
            short = pa.array([_gray(x).tobytes() for x in full], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), short], names=["node", "n", "short"])

    columns = sketches.select("node", F.col("n").cast("long"), "sketch")
    return columns.mapInArrow(ta.released(run), "node long, n long, short binary")


def _short_words(n: np.ndarray, short: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Short sketches of a bucket, all folded to as many places as the smallest has, and which sets have one.

    Words of 64 bits, one set in a column.
    """
    places = np.array([_places(x) if s else 0 for x, s in zip(n.tolist(), short)])
    known = places > 0
    least = int(places[known].min()) if known.any() else 1
    rows = np.zeros((len(n), -(-2 * least // 64) * 8), np.uint8)
    for size in np.unique(places[known]).tolist():
        at = np.flatnonzero(places == size)
        raw = np.frombuffer(b"".join(short[i] for i in at.tolist()), np.uint8).reshape(len(at), -1)
        if size > least:
            raw = _gray(_from_gray(raw, size).reshape(len(at), -1, least).sum(axis=1))
        rows[at, : raw.shape[1]] = raw
    return np.ascontiguousarray(rows.view(np.uint64).T), known


def _near_in_bucket(
    components: np.ndarray, outside: np.ndarray, n: np.ndarray, short: list[bytes], similar: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of two sets of different components that their sketches do not rule out, and what these differ by at least.

    All partners of a set come together, in order of its place.
    """
    words, known = _short_words(n, short)
    half = -(-len(words) // 2)
    sets, asking = np.arange(len(n)), np.flatnonzero(outside)
    step = max(1, COUNTED // len(n))

    def possible(x: np.ndarray, y: np.ndarray, difference: np.ndarray) -> np.ndarray:
        common = (n[x] + n[y] - np.maximum(difference, np.abs(n[x] - n[y]))) // 2
        return 100 * common >= similar * (n[x] + n[y] - common)

    for at in range(0, len(asking), step):
        x = asking[at : at + step, None]
        difference = np.zeros((len(x), len(n)), np.int32)
        for word in words[:half]:
            difference += np.bitwise_count(word[x] ^ word)
        difference[~(known[x] & known)] = 0
        # of two that ask, the first one does
        hit = possible(x, sets[None], difference) & (components[x] != components) & (~outside | (sets > x))
        row, y = np.nonzero(hit)
        x, difference = x[row, 0], difference[hit]
        both = known[x] & known[y]
        for word in words[half:]:
            difference += np.bitwise_count(word[x] ^ word[y]) * both
        hit = possible(x, y, difference)
        yield x[hit], y[hit], difference[hit]


def _near(rows: DataFrame, similar: int, closest: int) -> DataFrame:
    """Pairs (a, b) of sets of a bucket that may be similar, for each set the ``closest`` ones of another component.

    Buckets in which more than these may be similar are named as ``left``.
    """
    names = ["a", "b", "left"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, short = [], []
        for batch in batches:
            held.append([np.asarray(batch.column(i).cast(pa.int64()), np.int64) for i in range(5)])
            short += batch.column(5).to_pylist()
        if not held:
            return
        columns = [np.concatenate(c) for c in zip(*held)]
        order = np.argsort(columns[0], kind="stable")
        signature, nodes, components, outside, n = (c[order] for c in columns)
        first = np.flatnonzero(_changes(signature)).tolist()
        for lo, hi in zip(first, [*first[1:], len(order)]):
            own, parts, left = nodes[lo:hi], components[lo:hi], False
            sketches = [short[i] for i in order[lo:hi].tolist()]
            for x, y, difference in _near_in_bucket(parts, outside[lo:hi] > 0, n[lo:hi], sketches, similar):
                best = np.lexsort((difference, parts[y], x))
                x, y = x[best], y[best]
                start = np.flatnonzero(_changes(x) | _changes(parts[y]))
                keep = np.arange(len(x)) - np.repeat(start, np.diff(np.append(start, len(x)))) < closest
                left |= not keep.all()
                x, y = x[keep], y[keep]
                if len(x):
                    found = [pa.array(c) for c in (np.minimum(own[x], own[y]), np.maximum(own[x], own[y]))]
                    yield pa.RecordBatch.from_arrays([*found, pa.nulls(len(x), pa.int64())], names=names)
            if left:
                none = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array(signature[lo : lo + 1])], names=names)

    return rows.mapInArrow(ta.released(run), "a long, b long, left long")


def _outside_links(
    members: DataFrame, sketches: DataFrame, texts: DataFrame, shingle_words: int, similar: int
) -> DataFrame:
    """Links (a, b) of sets outside a bucket's largest component with members of other components.

    All pairs in ``members`` of different components are compared, as one of the two is outside the largest. Where a
    set may be similar to many of one component, the closest are counted first; buckets that had more of them and still
    have several components are compared again.
    """
    if "sketch" not in sketches.columns:
        sketches = sketches.withColumn("sketch", F.lit(bytearray()))
    if members.isEmpty():
        return members.sparkSession.createDataFrame([], "a long, b long")
    conf = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    short = settle(_short_sketches(sketches))
    # larger sets are in more buckets
    usual = short.agg(F.sum(F.col("n") * F.col("n")) / F.sum("n")).first()[0] or 0
    found, closest = None, CLOSEST
    while True:
        parts = max(conf, math.ceil(members.count() / PART_SHINGLES))
        crowded = settle(_in_buckets(members, parts, True))
        blocks = max(conf, math.ceil(crowded.count() * usual / BLOCK_SHINGLES))
        rows = crowded.join(short, "node").select("signature", "node", "component", "outside", "n", "short")
        near = settle(_near(rows.repartition(blocks, "signature"), similar, closest).distinct())
        pairs = near.filter("left is null").select("a", "b")
        if found is None:
            pairs = pairs.unionByName(_in_buckets(members, parts, False)).distinct()
        links = similar_pairs(pairs, sketches, texts, shingle_words, similar)
        found = links if found is None else found.unionByName(links)
        left = settle(near.filter("left is not null").select(F.col("left").alias("signature")))
        if left.isEmpty():
            return found
        so_far = members.select(F.col("node").alias("a"), F.col("component").alias("b")).distinct()
        members = _mixed(members.join(left, "signature", "left_semi"), so_far.unionByName(found))
        closest *= 16


def group_similar(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    shingle_words: int = SHINGLE_WORDS,
    similar: int = SIMILAR,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for each row of ``docs``.

    Null and empty texts have no shingles and are linked with nothing. Rows without an id keep their size,
    have no component and take no part in linking. Rows that repeat an id are the same document. Equal sets
    are linked. Very long texts are read whole. An empty table gives an empty result. Other columns are not read.
    """
    described = settle(describe_sets(docs, id_column, text, shingle_words))
    same = ["n_shingles", "d1", "d2"]
    nodes = settle(
        described.filter("n_shingles > 0 and doc_id is not null")
        .groupBy(*same)
        .agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"))
    )
    # one row of text for each distinct set: the copies, mostly few, are left out
    copies = (
        described.filter("n_shingles > 0 and doc_id is not null")
        .join(nodes.filter("copies > 1"), same)
        .filter("doc_id <> node")
        .select("doc_id")
    )
    texts = docs.select(F.col(id_column).cast("long").alias("node"), F.col(text).alias("text"))
    unique = restrict(texts.filter("node is not null"), "node", settle(copies), keep=False)

    total = described.agg(F.sum("n_shingles")).first()[0] or 0
    conf = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(conf, math.ceil(total / PART_SHINGLES))
    shared = settle(_shared_signatures(_signature_rows(unique, shingle_words, similar, parts), parts))
    members = shared.select(F.col("node").alias("doc_id")).distinct()
    sketches = settle(
        described.join(members, "doc_id", "left_semi")
        .select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "sketch")
        .dropDuplicates(["node"])
    )

    def verified(pairs: DataFrame) -> DataFrame:
        return similar_pairs(pairs, sketches, unique, shingle_words, similar)

    # first, each set against the lowest in any of its buckets
    star = shared.groupBy("node").agg(F.min("lowest").alias("a")).select("a", F.col("node").alias("b")).filter("a <> b")
    links = verified(star)
    members = _mixed(shared, links)
    for _ in range(STAR_ROUNDS):
        # in buckets with several components left, each set against one of another component
        head = members.groupBy("signature").agg(
            F.min_by(F.struct("node", "component"), F.xxhash64("component", "node")).alias("head")
        )
        pairs = (
            members.join(head, "signature")
            .filter("component <> head.component")
            .groupBy("node")
            .agg(F.min("head.node").alias("a"))
            .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
            .distinct()
        )
        more = verified(pairs)
        if more.isEmpty():
            break
        links = links.unionByName(more)
        members = _mixed(members, links)
    links = links.unionByName(_outside_links(members, sketches, unique, shingle_words, similar))

    components = connected(links)
    classes = (
        nodes.join(components, "node", "left")
        .select(*same, F.coalesce("component", "node").alias("component_id"))
    )
    described = described.drop("sketch")
    linked = described.filter("n_shingles > 0 and doc_id is not null").join(classes, same)
    alone = described.filter("not (n_shingles > 0 and doc_id is not null)").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return linked.select(*columns).unionByName(alone.select(*columns))


def _mixed(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of those buckets that still hold several components, with their component so far."""
    bucket = Window.partitionBy("signature")
    named = (
        members.select("signature", "node")
        .join(connected(links), "node", "left")
        .select("signature", "node", F.coalesce("component", "node").alias("component"))
    )
    return settle(
        named.withColumn("low", F.min("component").over(bucket))
        .withColumn("high", F.max("component").over(bucket))
        .filter("low < high")
        .select("signature", "node", "component")
    )
