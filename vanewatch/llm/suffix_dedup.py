"""Removes every byte of a 400-byte string that also starts elsewhere, with difference covers.

Finding the strings takes the steps of the difference-cover suffix sort, as far as 400 bytes of order ask for.
Positions whose remainder modulo COVER lies in a difference cover are sampled: any two positions have a common
shift below COVER that makes samples of both, so two equal strings have equal samples. Samples are named by a
hash of the bytes that follow, the names are sorted in ranges spread over the cluster, and neighbours are
compared. Only suffixes with a sample that is not alone go on: they get the name of their own 400 bytes, and
are sorted and compared with their neighbours in the same way. As only equality of prefixes is asked, names
are 64-bit hashes, and the recursion on names is their composition: a name of any length follows from one
running sum over the text.

Two steps before that spare the sort most of the corpus without losing a string. Equal texts are one text. And
of every 400-byte string the smallest hash of its 32-byte grams is a landmark that equal strings share;
strings whose landmark stands in one place alone cannot repeat.

Names travel as packed arrays, unique within a group of texts, so that a string in a third of all texts is sent
once from each group. A group of texts and a range of names have bounded sizes.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewatch.llm import text_arrays as ta
from vanewatch.scratch import settle, shared_dir

LENGTH = 400
GRAM = 32
# fixed values: every difference modulo 57 is the difference of two of these
COVER, SAMPLED = 57, (1, 6, 7, 9, 19, 38, 42, 49)
# Bytes of text in a group, and names in a range, as far as single texts allow.
GROUP_TEXT, RANGE_NAMES = 2 << 20, 1 << 19
BROADCAST_KEYS = 1_000_000
EMPTY = hashlib.sha256(b"").hexdigest()


def window_names(sums: np.ndarray, length: int) -> np.ndarray:
    """Names of the strings of ``length`` bytes at every position; none if the text is shorter."""
    if len(sums) <= length:
        return np.zeros(0, ta.U64)
    raw = (sums[length:] - sums[:-length]) * ta.powers(ta.INVERSE, len(sums))[: len(sums) - length]
    return ta.mix(raw ^ ta.U64(length))


def _sliding(values: np.ndarray, width: int, smallest: bool) -> np.ndarray:
    """Smallest or largest of each ``width`` neighbouring values."""
    pick, fill = (np.minimum, np.iinfo(np.uint64).max) if smallest else (np.maximum, 0)
    n = len(values)
    padded = np.full(-(-n // width) * width, fill, ta.U64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).reshape(-1)
    behind = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return pick(behind[: n - width + 1], ahead[width - 1 : n])


def landmarks(sums: np.ndarray) -> np.ndarray:
    """For every 400-byte string of a text its smallest gram hash."""
    grams = window_names(sums, GRAM)
    width = LENGTH - GRAM + 1
    return _sliding(grams, width, True) if len(grams) >= width else np.zeros(0, ta.U64)


def _landmark_places(sums: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position and hash of all landmarks of some texts that lie one after another."""
    grams, width = window_names(sums, GRAM), LENGTH - GRAM + 1
    if len(grams) < width:
        return np.zeros(0, np.int64), np.zeros(0, ta.U64)
    best = _sliding(grams, width, True)
    inside = np.zeros(len(best) + 1, np.int64)
    for low, high in zip(offsets[:-1], offsets[1:]):
        if high - low >= LENGTH:
            inside[low] += 1
            inside[high - LENGTH + 1] -= 1
    best[np.cumsum(inside)[:-1] == 0] = 0
    # a gram is a landmark if it is the smallest of some string around it
    around = np.concatenate([np.zeros(width - 1, ta.U64), best, np.zeros(width - 1, ta.U64)])
    at = np.flatnonzero(_sliding(around, width, False)[: len(grams)] == grams)
    return at, grams[at]


def _landmark_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        for row, data, offsets in ta.text_groups(batch.column(1)):
            at, hashes = _landmark_places(ta.prefix_hash(data), offsets)
            owner = np.searchsorted(offsets, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(ta.signed(hashes)), pa.array(keys[row + owner]), pa.array(at - offsets[owner], pa.int64())],
                names=["landmark", "key", "at"],
            )


# --- names, sorted over the cluster ---------------------------------------------------------------

NAMES = "step int, range int, group int, names binary, several binary"
# The answer to a group's names in a range: a bit for each of them, in order.
REPLY = "step int, range int, group int, count int, bits binary"


def _planes(names: np.ndarray) -> bytes:
    """All first bytes, then all second ones and so on: sorted names share their high bytes, which compress."""
    return names.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(ta.U64).reshape(-1)


def _pack(step: int, group: int, names: np.ndarray, ranges: int) -> pa.Table:
    """The distinct names of a group, dealt into ranges by order."""
    names, count = np.unique(names, return_counts=True)
    place = (names >> ta.U64(32)) * ta.U64(ranges) >> ta.U64(32)
    used, start = np.unique(place, return_index=True)
    stop = np.append(start[1:], len(names))
    return pa.table(
        {
            "step": pa.array(np.full(len(used), step, np.int32)),
            "range": pa.array(used.astype(np.int32)),
            "group": pa.array(np.full(len(used), group, np.int32)),
            "names": pa.array([_planes(names[a:b]) for a, b in zip(start, stop)], pa.binary()),
            "several": pa.array([(count[a:b] > 1).tobytes() for a, b in zip(start, stop)], pa.binary()),
        }
    )


def _sort_range(rows: pa.Table) -> pa.Table:
    """Sorts a range of names and answers each group with those of its names that stand elsewhere too."""
    parts = [_from_planes(x) for x in rows.column("names").to_pylist()]
    several = np.concatenate([np.frombuffer(x, bool) for x in rows.column("several").to_pylist()])
    names, sizes = np.concatenate(parts), [len(p) for p in parts]
    order = np.argsort(names, kind="stable")
    held = names[order]
    same = np.zeros(len(held) + 1, bool)
    same[1:-1] = held[1:] == held[:-1]
    repeated = several.copy()
    repeated[order] |= same[1:] | same[:-1]
    bounds = np.cumsum([0, *sizes])
    answers = [np.packbits(repeated[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
    own = {c: rows.column(c).combine_chunks() for c in ("step", "range", "group")}
    return pa.table(own | {"count": pa.array(sizes, pa.int32()), "bits": pa.array(answers, pa.binary())})


def _answered(step: int, sent: np.ndarray, replies: pa.Table) -> np.ndarray:
    """Those of the names sent in a step that stand elsewhere too, in order."""
    rows = sorted((r["range"], r["count"], r["bits"]) for r in replies.to_pylist() if r["step"] == step)
    bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for _, n, b in rows]
    sent = np.unique(sent)
    return sent[np.concatenate(bits)] if bits else sent[:0]


def _among(names: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(names), bool)
    at = np.searchsorted(known, names)
    at[at == len(known)] = 0
    return known[at] == names


def _each(texts: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Key, bytes, running sums, and which 400-byte strings have a landmark that stands elsewhere."""
    for row in range(texts.num_rows):
        data = np.frombuffer(texts.column("text")[row].as_py().encode(), np.uint8)
        sums = ta.prefix_hash(data)
        known = np.sort(np.asarray(texts.column("landmarks")[row].values, np.int64).view(ta.U64))
        yield texts.column("key")[row].as_py(), data, sums, _among(landmarks(sums), known)


def _samples(sums: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sampled positions that some wanted string reaches within COVER bytes, and their names."""
    names = window_names(sums, LENGTH - COVER + 1)
    reached = np.zeros(len(names) + 1, np.int64)
    starts = np.flatnonzero(wanted)
    np.add.at(reached, starts, 1)
    np.add.at(reached, np.minimum(starts + COVER, len(names)), -1)
    at = np.flatnonzero((np.cumsum(reached)[:-1] > 0) & np.isin(np.arange(len(names)) % COVER, SAMPLED))
    return at, names[at]


def _sample_names(texts: pa.Table) -> np.ndarray:
    return np.concatenate([_samples(sums, wanted)[1] for _, _, sums, wanted in _each(texts)] or [np.zeros(0, ta.U64)])


def _suffixes(sums: np.ndarray, wanted: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Wanted strings that reach a sample which stands elsewhere too: their starts and names."""
    at, names = _samples(sums, wanted)
    shared = np.zeros(len(sums), np.int64)
    shared[at[_among(names, known)] + 1] = 1
    shared = np.cumsum(shared)
    starts = np.flatnonzero(wanted)
    starts = starts[shared[np.minimum(starts + COVER, len(shared) - 1)] > shared[starts]]
    return starts, window_names(sums, LENGTH)[starts]


def _emit_samples(ranges: int):
    def run(texts: pa.Table) -> pa.Table:
        return _pack(1, texts.column("group")[0].as_py(), _sample_names(texts), ranges)

    return run


def _emit_suffixes(ranges: int):
    def run(texts: pa.Table, replies: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _pack(2, 0, np.zeros(0, ta.U64), ranges)
        known = _answered(1, _sample_names(texts), replies)
        found = [_suffixes(sums, wanted, known)[1] for _, _, sums, wanted in _each(texts)]
        return _pack(2, texts.column("group")[0].as_py(), np.concatenate(found), ranges)

    return run


def _cut(texts: pa.Table, replies: pa.Table) -> pa.Table:
    known = _answered(1, _sample_names(texts), replies)
    parts = [(key, data, *_suffixes(sums, wanted, known)) for key, data, sums, wanted in _each(texts)]
    repeated = _answered(2, np.concatenate([p[3] for p in parts] or [np.zeros(0, ta.U64)]), replies)
    rows = []
    for key, data, starts, names in parts:
        starts = starts[_among(names, repeated)]
        change = np.zeros(len(data) + 1, np.int64)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + LENGTH, -1)
        gone = np.cumsum(change)[:-1] > 0
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        rows.append((key, int(gone.sum()), spans, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
    columns = list(zip(*rows)) if rows else [()] * 4
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of every row of ``docs``.

    Null texts are empty; texts under 400 bytes lose nothing. Equal texts of 400 bytes and more lose all, repeated
    rows among them. A null id is kept. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_column).alias("doc_id"), body.alias("text"), F.sha2(body, 256).alias("sha256"))
    rows = rows.withColumn("key", F.xxhash64("sha256"))
    narrow = settle(rows.select("doc_id", "sha256", "key", F.octet_length("text").cast("long").alias("n_bytes")))
    copies = settle(
        narrow.groupBy("key").agg(
            F.count("*").alias("copies"), F.min("doc_id").alias("first_id"), F.min("n_bytes").alias("n_bytes")
        )
    )

    places = settle(
        rows.filter(F.octet_length("text") >= LENGTH).select("key", "text")
        .mapInArrow(_landmark_rows, "landmark long, key long, at long")
    )
    # a landmark that stands in two places, copies of a text not counted
    place = F.xxhash64("key", "at")
    shared = settle(
        places.groupBy("landmark").agg(F.min(place).alias("low"), F.max(place).alias("high"))
        .filter("low < high").select("landmark")
    )
    marked = settle(
        places.select("landmark", "key").distinct().join(shared, "landmark")
        .groupBy("key").agg(F.collect_set("landmark").alias("landmarks"))
    )

    # one row of text for each marked text
    wanted = copies.join(marked.select("key"), "key").select(F.col("key").alias("of_key"), "first_id", "n_bytes")
    size = wanted.agg(F.count("*").alias("n"), F.sum("n_bytes").alias("bytes")).first()
    groups = max(1, math.ceil((size["bytes"] or 0) / GROUP_TEXT))
    picked = F.broadcast(wanted) if size["n"] <= BROADCAST_KEYS else wanted
    texts = (
        rows.select("doc_id", "key", "text")
        .join(picked, (F.col("key") == F.col("of_key")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")
        .select("key", "text")
        .dropDuplicates(["key"])
        .join(marked, "key")
        .withColumn("group", F.pmod("key", F.lit(groups)).cast("int"))
    )
    path = f"{shared_dir(spark)}/repeats-{uuid.uuid4().hex}"
    texts.write.parquet(path)
    texts = spark.read.parquet(path)

    ranges = max(1, math.ceil((size["bytes"] or 0) / RANGE_NAMES))
    by_group = texts.groupBy("group")
    samples = by_group.applyInArrow(_emit_samples(max(1, ranges // 4)), NAMES)
    first = settle(samples.groupBy("range").applyInArrow(_sort_range, REPLY))
    suffixes = by_group.cogroup(first.groupBy("group")).applyInArrow(_emit_suffixes(ranges), NAMES)
    second = settle(suffixes.groupBy("range").applyInArrow(_sort_range, REPLY))
    cut = settle(by_group.cogroup(first.unionByName(second).groupBy("group")).applyInArrow(
        _cut, "key long, n_removed long, n_spans long, kept_sha256 string"
    ))

    whole = (F.col("copies") > 1) & (F.col("total") >= LENGTH)
    facts = copies.filter("copies > 1").select("key", "copies")
    return (
        narrow.withColumnRenamed("n_bytes", "total")
        .join(settle(facts), "key", "left")
        .join(cut, "key", "left")
        .select(
            "doc_id",
            F.col("total").alias("n_bytes"),
            F.when(whole, F.col("total")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(whole, F.lit(EMPTY)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        )
    )
