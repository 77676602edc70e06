"""Whole texts as numpy arrays: words, their hashes, and hashes of runs of them, a batch of texts at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
# Texts are handled in groups of about this many bytes, a longer text on its own. A group takes some
# hundred bytes of memory for each of its bytes at most.
GROUP_BYTES = 1 << 19
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)
# Longer words are hashed one by one.
LONG_WORD = 64
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers, one to one."""
    x = x.astype(U64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> U64(shift)
        x *= U64(factor)
    return x ^ (x >> U64(31))


def seeded(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(BASE) + U64(seed * 0x51_7C_C1 + 1))


BYTE_VALUES = seeded(1, 256)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2^64 for i from 0 to n - 1 at least."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, GROUP_BYTES + 1), base, U64)
        have[0] = 1
        have = np.cumprod(have, dtype=U64)
        if len(have) <= 8 * GROUP_BYTES:
            _powers[base] = have
    return have


def text_groups(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes, and offsets of groups of neighbouring texts. Null texts are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = int(np.searchsorted(bounds, bounds[row] + GROUP_BYTES, side="right")) - 1
        last = min(max(last, row + 1), len(column))
        yield row, data[bounds[row] : bounds[last]], bounds[row : last + 1] - bounds[row]
        row = last


def release() -> None:
    """Gives memory that this process has freed, but still holds, back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def released(run: Callable) -> Callable:
    """``run`` over a task's batches, and ``release`` at their end.

    A Python worker stays for the tasks to come, and beside the executor's heap while stages without Python run.
    """

    @wraps(run)
    def until_done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return until_done


def spans(is_gap: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are no gap, and the first run of each text.

    Runs end at the end of a text. The last array has one entry more than there are texts.
    """
    n = len(is_gap)
    word = np.empty(n + 1, bool)
    word[:n], word[n] = ~is_gap, False
    first = word.copy()
    first[1:] &= ~word[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    first[edges] = word[edges]
    starts = np.flatnonzero(first)
    stop = ~word
    stop[offsets] = True
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, starts, side="right")]
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``run_hash`` gets the hash of any stretch of bytes."""
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_VALUES[data] * powers(BASE, len(data))[: len(data)], dtype=U64, out=sums[1:])
    return sums


def run_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches from ``starts`` to ``ends``, dependent on nothing else."""
    raw = (sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts]
    return mix(raw ^ ((ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93)))


def word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches from ``starts`` to ``ends``, of any length and build.

    ``run_hash`` is a polynomial modulo 2^64, which takes some long words for each other (those of Thue and Morse, of
    1024 bytes and more, whatever the base). Here each eight bytes are mixed in turn; longer words than LONG_WORD go
    through XXH64.
    """
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    # the eight bytes from any place on
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    lengths = ends - starts
    out = mix(lengths.astype(U64) * U64(BASE))
    at = np.flatnonzero(lengths <= LONG_WORD)
    place, left = starts[at], lengths[at]
    while len(at):
        kept = np.minimum(left, 8).astype(U64) * U64(8)
        taken = eight[place] & (U64(0xFFFFFFFFFFFFFFFF) >> (U64(64) - kept))
        out[at] = mix(out[at] * U64(BASE) ^ taken)
        more = np.flatnonzero(left > 8)
        at, place, left = at[more], place[more] + 8, left[more] - 8
    long = np.flatnonzero(lengths > LONG_WORD)
    out[long] = [xxhash.xxh64_intdigest(data[a:z].tobytes()) for a, z in zip(starts[long].tolist(), ends[long].tolist())]
    return out


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of ``n`` words in a row; one shorter run for fewer words."""
    if len(words) == 0:
        return words
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, U64(n))
    for i in range(n):
        out = mix(out * U64(BASE) ^ words[i : len(words) - n + 1 + i])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
