"""Finds benchmark items in documents, also with some words changed, left out or added.

Texts are word sequences (A-Z lower-cased, ASCII punctuation dropped). An item of n words is found where it can
be turned into a stretch of the document with at most ``n // 5`` word edits: a similarity of 0.8.

Windows as long as the item are embedded by the random walk of Chakraborty, Goldenberg and Koucky: step by step
a symbol is copied to the output, and a random function of step and symbol says whether to move on. Few edits
give outputs with a small Hamming distance, so tables that sample some output places (bit-sampling LSH) bring
window and item together. Every such pair is verified by its exact edit distance.

Only windows that can hold an item are embedded: with d edits allowed, one of d + 1 pieces of the item is left
as it is, so windows around no piece of any item are skipped without loss.

Items come in blocks of bounded size, which are broadcast; documents are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewatch.scratch import settle

from vanewatch.llm import text_arrays as ta

# edits allowed: one for each so many words
WORDS_PER_EDIT = 5
# Walks, tables for each walk, and places that a table samples.
WALKS, TABLES, PLACES = 4, 6, 3
STEPS_PER_WORD = 3
# Items of a block, about 1 kB each when broadcast.
BLOCK_ITEMS = 20_000
# Ids of items that may be broadcast, 16 bytes each.
BROADCAST_ITEMS = 1_000_000
# Words of the windows that are embedded at a time, 8 bytes each.
WINDOW_WORDS = 1 << 20
PAD = ta.U64(0xFFFF_FFFF_FFFF_FFFB)
SCHEMA = "doc_id long, item_id long, distance int, item_words int, first_word long, last_word long"

IS_GAP = np.zeros(256, bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    IS_GAP[_low : _high + 1] = True
BITMAP_BITS = 22


def edits(n_words: int) -> int:
    return n_words // WORDS_PER_EDIT


def _words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, hashes of the words, and the first word of each text, for groups of texts."""
    for row, data, offsets in ta.text_groups(column):
        data = ta.LOWER[data]
        starts, ends, first = ta.spans(IS_GAP[data], offsets)
        yield row, ta.run_hash(ta.prefix_hash(data), starts, ends), first


def embed(windows: np.ndarray) -> np.ndarray:
    """Table keys, one column for each table, of windows of equal length, one in each row."""
    count, length = windows.shape
    steps, rows = STEPS_PER_WORD * length, np.arange(count)
    keys = np.empty((count, WALKS * TABLES), ta.U64)
    padded = np.column_stack([windows, np.full(count, PAD)])
    for walk in range(WALKS):
        sampled = np.random.default_rng((walk, length)).integers(0, steps, (TABLES, PLACES))
        at = np.zeros(count, np.int64)
        sums = np.full((TABLES, count), ta.U64(walk + 1))
        for step in range(steps):
            if step % 64 == 0:
                moves = ta.mix(padded ^ ta.seeded(walk + 3, step // 64 + 1)[-1])
            place = np.minimum(at, length)
            for table in np.flatnonzero((sampled == step).any(axis=1)):
                sums[table] = ta.mix(sums[table] * ta.U64(ta.BASE) ^ padded[rows, place])
            at += ((moves[rows, place] >> ta.U64(step % 64)) & ta.U64(1)).astype(np.int64)
        for table in range(TABLES):
            keys[:, walk * TABLES + table] = ta.mix(sums[table] ^ ta.seeded(50 + walk, TABLES)[table])
    return keys


def fit(item: np.ndarray, words: np.ndarray, most: int) -> list[tuple[int, int, int]]:
    """Places where ``item`` lies in ``words`` with at most ``most`` edits: distance, start, end.

    Of overlapping places the closest, then the first is given.
    """
    n = len(words)
    reach = np.arange(n + 1)
    cost, origin = np.zeros(n + 1, np.int64), reach.copy()
    for i, symbol in enumerate(item, 1):
        swap = cost[:-1] + (words != symbol)
        drop = cost[1:] + 1
        best = np.minimum(swap, drop)
        came = np.where(swap <= drop, origin[:-1], origin[1:])
        best, came = np.concatenate([[i], best]), np.concatenate([[0], came])
        # added words: the running minimum of best[j] - j
        slack = best - reach
        low = np.minimum.accumulate(slack)
        left = np.maximum.accumulate(np.where(slack == low, reach, 0))
        cost, origin = low + reach, came[left]
    found: list[tuple[int, int, int]] = []
    for end in sorted(np.flatnonzero(cost <= most), key=lambda e: (cost[e], e)):
        place = (int(cost[end]), int(origin[end]), int(end))
        if all(place[2] <= f[1] or place[1] >= f[2] for f in found):
            found.append(place)
    return found


@dataclass
class Items:
    """A block of items, laid out for lookup."""

    ids: list[int | None]
    words: list[np.ndarray]
    pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by length: hash, offset, length of the item
    tables: dict[int, tuple[np.ndarray, np.ndarray]]  # by item length: table keys and items
    bitmap: np.ndarray


def prepare(rows: list[tuple[int | None, str | None]]) -> Items:
    words: list[np.ndarray] = []
    for _, hashes, first in _words(pa.array([text for _, text in rows], pa.string())):
        words += [hashes[a:b] for a, b in zip(first[:-1], first[1:])]
    pieces: dict[int, list[tuple[int, int, int]]] = {}
    tables: dict[int, list[tuple[np.ndarray, int]]] = {}
    for number, item in enumerate(words):
        n = len(item)
        if n == 0:
            continue
        parts = edits(n) + 1
        size = n // parts
        for part in range(parts):
            start = part * n // parts
            key = int(ta.shingles(item[start : start + size], size)[0])
            pieces.setdefault(size, []).append((key, start, n))
        tables.setdefault(n, []).append((embed(item[None, :])[0], number))
    bitmap = np.zeros(1 << BITMAP_BITS, bool)
    laid: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for size, rows_of in pieces.items():
        rows_of = sorted(set(rows_of))
        keys = np.array([r[0] for r in rows_of], ta.U64)
        laid[size] = (keys, np.array([r[1] for r in rows_of]), np.array([r[2] for r in rows_of]))
        bitmap[(keys & ta.U64((1 << BITMAP_BITS) - 1)).astype(np.int64)] = True
    placed = {}
    for n, rows_of in tables.items():
        keys = np.concatenate([k for k, _ in rows_of])
        numbers = np.repeat([i for _, i in rows_of], WALKS * TABLES)
        order = np.argsort(keys, kind="stable")
        placed[n] = (keys[order], numbers[order])
    return Items([i for i, _ in rows], words, laid, placed, bitmap)


def _expand(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (index into ``wanted``, index into sorted ``keys``) of equal values."""
    low, high = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
    count = high - low
    which = np.repeat(np.arange(len(wanted)), count)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    return which, np.repeat(low, count) + inside


def _windows(tokens: np.ndarray, items: Items) -> dict[int, np.ndarray]:
    """By item length, the starts of the windows that can hold an item of that length."""
    found: dict[int, list[np.ndarray]] = {}
    mask = ta.U64((1 << BITMAP_BITS) - 1)
    for size, (keys, offsets, lengths) in items.pieces.items():
        if len(tokens) < size:
            continue
        here = ta.shingles(tokens, size)
        at = np.flatnonzero(items.bitmap[(here & mask).astype(np.int64)])
        which, piece = _expand(keys, here[at])
        at, offset, length = at[which], offsets[piece], lengths[piece]
        for n in np.unique(length):
            own = length == n
            found.setdefault(int(n), []).append(at[own] - offset[own])
    windows = {}
    for n, parts in found.items():
        starts = np.unique(np.concatenate(parts))
        moved = starts[:, None] + np.arange(-edits(n), edits(n) + 1)[None, :]
        windows[n] = np.unique(np.clip(moved, 0, None))
    return windows


def find_items(column: pa.Array, items: Items) -> list[tuple[int, int, int, int, int]]:
    """Row, item, distance, first word and end of every place in a batch of texts."""
    texts: dict[int, np.ndarray] = {}  # the words of those texts that have windows
    windows: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    candidates: dict[tuple[int, int], set[int]] = {}
    held = 0

    def look_up() -> None:
        for n, parts in windows.items():
            content, owner, start = (np.concatenate(x) for x in zip(*parts))
            table, numbers = items.tables[n]
            keys = embed(content)
            which, entry = _expand(table, keys.reshape(-1))
            which //= keys.shape[1]
            for own, number, at in set(zip(owner[which].tolist(), numbers[entry].tolist(), start[which].tolist())):
                candidates.setdefault((own, number), set()).add(at)
        windows.clear()

    for row, tokens, first in _words(column):
        padded = None
        for n, starts in _windows(tokens, items).items():
            starts = starts[starts < len(tokens)]
            owners = np.searchsorted(first, starts, side="right") - 1
            if padded is None:
                padded = np.append(tokens, PAD)
            for own in np.unique(owners).tolist():
                texts.setdefault(row + own, tokens[first[own] : first[own + 1]].copy())
            # a long item has many windows, each as long as itself, so they are laid out in parts
            step = max(1, WINDOW_WORDS // n)
            for low in range(0, len(starts), step):
                start, owner = starts[low : low + step], owners[low : low + step]
                # a window reads no words of the next text
                places = start[:, None] + np.arange(n)[None, :]
                places[places >= first[owner + 1][:, None]] = len(tokens)
                windows.setdefault(n, []).append((padded[places], row + owner, start - first[owner]))
                held += places.size
                if held >= WINDOW_WORDS:
                    look_up()
                    held = 0
    look_up()
    out = []
    for (own, number), starts in sorted(candidates.items()):
        item, words = items.words[number], texts[own]
        n, most = len(item), edits(len(item))
        regions: list[list[int]] = []
        for at in sorted(starts):
            low, high = max(0, at - 2 * most), min(len(words), at + n + 2 * most)
            if regions and low <= regions[-1][1]:
                regions[-1][1] = max(regions[-1][1], high)
            else:
                regions.append([low, high])
        for low, high in regions:
            out += [(own, number, d, low + a, low + b) for d, a, b in fit(item, words[low:high], most)]
    return out


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
) -> DataFrame:
    """One row for each place where an item is found: distance in words, first word and end in the document.

    Null and empty texts hold nothing, null and empty items are in nothing. Rows without an id are searched too,
    repeated rows are each reported, repeated items too. Places that tie in distance are all reported unless they
    overlap. Very long texts and items are searched whole. Without documents or items the result is empty. Other
    columns are not read.
    """
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("body"))
    # equal items are searched for once, under a number of their own; blocks of different items are of even size
    bench = bench.filter("body is not null").withColumn("number", F.xxhash64("body"))
    items = settle(bench.groupBy("number").agg(F.min("body").alias("body")))
    blocks = max(1, math.ceil(items.count() / BLOCK_ITEMS))
    texts = docs.select(F.col(id_column).cast("long"), F.col(text))
    result = None
    for block in range(blocks):
        own = items.filter(F.pmod(F.col("number"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast(prepare([tuple(row) for row in own.collect()]))
        found = texts.mapInArrow(ta.released(_search(shared)), SCHEMA)
        if blocks > 1:
            # the places are in the shared folder, so the driver holds one block at a time
            found = settle(found)
            shared.destroy()
        result = found if result is None else result.unionByName(found)
    names = bench.select("item_id", F.col("number"))
    few = names.limit(BROADCAST_ITEMS + 1).count() <= BROADCAST_ITEMS
    columns = result.columns
    result = result.withColumnRenamed("item_id", "number")
    return result.join(F.broadcast(names) if few else names, "number").select(*columns)


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column(0)
            for row, number, distance, a, b in find_items(batch.column(1), items):
                rows.append((ids[row].as_py(), items.ids[number], distance, len(items.words[number]), a, b))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "item_id", "distance", "item_words", "first_word", "last_word"],
            )

    return run
