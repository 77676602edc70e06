"""Scores texts for toxicity with a small recurrent network, trained here in numpy.

Every word has two inputs: an embedding of the word and the sum of embeddings of its character trigrams, so a
word never seen is known by its parts. A gated recurrent unit reads a window of words in either direction,
attention pools its states, and a logistic unit scores the window. Windows overlap by half and cover the whole
text; a text scores as its highest window. Labels belong to texts, so training first uses windows drawn at
random and then those that the network itself scores highest.

Training takes a bounded sample of labelled texts and runs on the driver; scoring runs in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewatch.llm import text_arrays as ta

WINDOW, STRIDE = 32, 16
WORD_ROWS, TRIGRAM_ROWS, WIDTH, STATES = 1 << 14, 1 << 13, 12, 8
# The sample: at most so many texts of each label, none longer than that.
SAMPLE_TEXTS, SAMPLE_CHARS = 1200, 20_000
BATCH_TEXTS, RANDOM_ROUNDS, ROUNDS = 64, 150, 500
RATE = 0.15
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
CHUNK = 2048


@dataclass
class Words:
    """Words of some texts as indexes into their distinct words, and what the network sees of those."""

    index: np.ndarray
    first: np.ndarray
    rows: np.ndarray  # embedding row of each distinct word
    trigrams: np.ndarray  # embedding rows of their trigrams, word after word
    ends: np.ndarray  # where each word's trigrams end


def read_words(column: pa.Array) -> Iterator[tuple[int, Words]]:
    for row, data, offsets in ta.text_groups(column):
        data = ta.LOWER[data]
        starts, ends, first = ta.spans(ta.IS_SPACE[data], offsets)
        hashes = ta.run_hash(ta.prefix_hash(data), starts, ends)
        distinct, example, index = np.unique(hashes, return_index=True, return_inverse=True)
        starts, length = starts[example], (ends - starts)[example]
        stop = np.cumsum(length)
        at = np.repeat(starts - (stop - length), length) + np.arange(int(stop[-1]) if len(stop) else 0)
        wide = data.astype(np.int64)
        before = np.where(at == np.repeat(starts, length), 256, wide[at - 1])
        after = np.where(at == np.repeat(starts + length - 1, length), 257, wide[np.minimum(at + 1, max(len(wide) - 1, 0))])
        trigram = ta.mix(((before * 258 + wide[at]) * 258 + after).astype(ta.U64)) % ta.U64(TRIGRAM_ROWS)
        yield row, Words(index, first, (distinct % ta.U64(WORD_ROWS)).astype(np.int64), trigram.astype(np.int64), stop)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word indexes of all windows, -1 beyond a text's end, and the text of each window."""
    length = np.diff(first)
    count = np.where(length == 0, 0, 1 + np.maximum(0, -(-(length - WINDOW) // STRIDE)))
    text = np.repeat(np.arange(len(length)), count)
    within = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    at = (first[:-1][text] + within * STRIDE)[:, None] + np.arange(WINDOW)[None, :]
    return np.where(at < first[1:][text][:, None], at, -1), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)

        def drawn(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        self.p = {"word": drawn(WORD_ROWS, WIDTH, scale=0.1), "trigram": drawn(TRIGRAM_ROWS, WIDTH, scale=0.1)}
        for way in "fb":
            self.p |= {
                f"in_{way}": drawn(WIDTH, 3 * STATES, scale=0.4),
                f"state_{way}": drawn(STATES, 3 * STATES, scale=0.3),
                f"bias_{way}": np.zeros(3 * STATES, np.float32),
            }
        self.p |= {
            "attend": drawn(2 * STATES, scale=0.3),
            "out": drawn(2 * STATES, scale=0.5),
            "base": np.full(1, -1, np.float32),
        }
        self.seen = {k: np.full_like(v, 1e-3) for k, v in self.p.items()}

    def inputs(self, words: Words) -> np.ndarray:
        """One vector for each distinct word."""
        p = self.p
        vectors = p["word"][words.rows]
        if len(words.rows):
            sums = np.add.reduceat(p["trigram"][words.trigrams], np.concatenate([[0], words.ends[:-1]]))
            vectors = vectors + sums / np.sqrt(np.diff(words.ends, prepend=0))[:, None].astype(np.float32)
        return vectors

    def _run(self, gates: np.ndarray, mask: np.ndarray, way: str, keep: bool):
        """States of one direction; ``gates`` are the inputs' parts, one step after another."""
        weights, n = self.p[f"state_{way}"], gates.shape[1]
        h, out, kept = np.zeros((n, STATES), np.float32), np.empty((WINDOW, n, STATES), np.float32), []
        for t in range(WINDOW) if way == "f" else range(WINDOW - 1, -1, -1):
            past = h @ weights
            zr = _sigmoid(gates[t, :, : 2 * STATES] + past[:, : 2 * STATES])
            z, r = zr[:, :STATES], zr[:, STATES:]
            g = np.tanh(gates[t, :, 2 * STATES :] + r * past[:, 2 * STATES :])
            new = h + mask[t] * (1 - z) * (g - h)
            if keep:
                kept.append((t, h, z, r, g, past[:, 2 * STATES :]))
            out[t] = h = new
        return out, kept

    def forward(self, index: np.ndarray, projected: dict[str, np.ndarray], keep: bool = False):
        """Scores of windows, given as word indexes (rows of ``projected``), -1 for none."""
        steps = index.T
        mask = (steps >= 0).astype(np.float32)[:, :, None]
        states, kept = {}, {}
        for way in "fb":
            states[way], kept[way] = self._run(projected[way][steps], mask, way, keep)
        h = np.concatenate([states["f"], states["b"]], axis=2)
        u = np.tanh(h)
        weight = np.where(mask[:, :, 0] > 0, u @ self.p["attend"], -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * h).sum(axis=0)
        return pooled @ self.p["out"] + self.p["base"][0], (mask, h, u, weight, pooled, kept)

    def project(self, vectors: np.ndarray) -> dict[str, np.ndarray]:
        return {way: vectors @ self.p[f"in_{way}"] + self.p[f"bias_{way}"] for way in "fb"}

    def backward(self, index, words: Words, vectors, wrong: np.ndarray, memory) -> dict:
        """Gradients; ``wrong`` is the loss's slope by the score of each window."""
        mask, h, u, weight, pooled, kept = memory
        p, grad = self.p, {}
        grad["out"], grad["base"] = pooled.T @ wrong, wrong.sum(keepdims=True)
        d_pooled = wrong[:, None] * p["out"]
        d_weight = (h * d_pooled).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        grad["attend"] = np.einsum("tn,tnk->k", d_score, u)
        d_h = weight[:, :, None] * d_pooled + d_score[:, :, None] * p["attend"] * (1 - u * u)
        d_vectors, steps = np.zeros_like(vectors), index.T
        for way, part in (("f", slice(0, STATES)), ("b", slice(STATES, 2 * STATES))):
            weights = p[f"state_{way}"]
            d_weights, later = np.zeros_like(weights), np.zeros_like(pooled[:, :STATES])
            d_gates = np.zeros((WINDOW, index.shape[0], 3 * STATES), np.float32)
            for t, before, z, r, g, past in reversed(kept[way]):
                d = later + d_h[t, :, part]
                m = mask[t]
                d_g = d * m * (1 - z) * (1 - g * g)
                d_z = d * m * (before - g) * z * (1 - z)
                d_r = d_g * past * r * (1 - r)
                d_past = np.concatenate([d_z, d_r, d_g * r], axis=1)
                d_gates[t] = np.concatenate([d_z, d_r, d_g], axis=1)
                d_weights += before.T @ d_past
                later = d * (1 - m * (1 - z)) + d_past @ weights.T
            flat, place = d_gates.reshape(-1, 3 * STATES), steps.reshape(-1)
            used = place >= 0
            grad[f"state_{way}"], grad[f"bias_{way}"] = d_weights, flat.sum(axis=0)
            grad[f"in_{way}"] = vectors[place[used]].T @ flat[used]
            np.add.at(d_vectors, place[used], flat[used] @ p[f"in_{way}"].T)
        rows = np.flatnonzero(np.abs(d_vectors).sum(axis=1))
        length = np.diff(words.ends, prepend=0)
        owner = np.repeat(np.arange(len(words.rows)), length)
        hit = np.isin(owner, rows)
        scaled = d_vectors / np.sqrt(length)[:, None].astype(np.float32)
        grad["word"] = (words.rows[rows], d_vectors[rows])
        grad["trigram"] = (words.trigrams[hit], scaled[owner[hit]])
        return grad

    def step(self, grad: dict) -> None:
        for name, g in grad.items():
            if isinstance(g, tuple):
                rows, where = np.unique(g[0], return_inverse=True)
                total = np.zeros((len(rows), WIDTH), np.float32)
                np.add.at(total, where, g[1])
                self.seen[name][rows] += total * total
                self.p[name][rows] -= RATE * total / np.sqrt(self.seen[name][rows])
            else:
                self.seen[name] += g * g
                self.p[name] -= RATE * 0.3 * g / np.sqrt(self.seen[name])

    def score(self, words: Words) -> np.ndarray:
        """Score of each text between 0 and 1: its highest window's; the base score without words."""
        index, text = windows(words.first)
        best = np.full(len(words.first) - 1, -np.inf)
        projected = self.project(self.inputs(words))
        for low in range(0, len(index), CHUNK):
            part = index[low : low + CHUNK]
            scores, _ = self.forward(np.where(part >= 0, words.index[part], -1), projected)
            np.maximum.at(best, text[low : low + CHUNK], scores)
        return _sigmoid(np.where(np.isinf(best), min(float(self.p["base"][0]), -1.0), best))


def train(texts: list[str], labels: list[int], seed: int = 7) -> Network:
    """A network fitted to labelled texts. Without texts of either label it keeps to low scores."""
    network, rng = Network(seed), np.random.default_rng(seed)
    toxic = [t for t, y in zip(texts, labels) if y and t]
    clean = [t for t, y in zip(texts, labels) if not y and t]
    if not toxic or not clean:
        network.p["out"][:] = 0
        network.p["base"][:] = -3
        return network
    half = BATCH_TEXTS // 2
    for number in range(ROUNDS):
        chosen = [toxic[i] for i in rng.integers(0, len(toxic), half)]
        chosen += [clean[i] for i in rng.integers(0, len(clean), half)]
        groups = list(read_words(pa.array(chosen, pa.large_string())))
        for row, words in groups:
            index, text = windows(words.first)
            if not len(index):
                continue
            own = np.where(index >= 0, words.index[index], -1)
            vectors = network.inputs(words)
            projected = network.project(vectors)
            ranks = rng.random(len(index))
            if number >= RANDOM_ROUNDS:
                ranks = network.forward(own, projected)[0]
            order = np.lexsort((-ranks, text))
            picked = order[np.unique(text[order], return_index=True)[1]]
            own = own[picked]
            scores, memory = network.forward(own, projected, keep=True)
            truth = (text[picked] + row < half).astype(np.float32)
            wrong = ((_sigmoid(scores) - truth) / BATCH_TEXTS).astype(np.float32)
            network.step(network.backward(own, words, vectors, wrong, memory))
    network.seen = {}
    return network


def held_out(id_column: str):
    """Whether a row's label is kept from training."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))), F.lit(FOLDS)) == HELD_OUT


def fit_network(docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id") -> Network:
    """Trains on a bounded sample of the labelled rows that are not held out.

    Null ids, labels and texts, empty texts and very long ones are left out of it. Without rows of either label the
    network gives one low score to all texts.
    """
    marked = labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    marked = marked.filter("id is not null and label is not null").filter(~held_out("id")).distinct()
    texts = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).filter(
        F.length("text").between(1, SAMPLE_CHARS)
    )
    parts = [
        marked.filter(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_TEXTS)
        for label in (0, 1)
    ]
    sample = F.broadcast(parts[0].unionByName(parts[1]))
    # of several texts or labels of an id the first by hash, so that every run trains on the same rows
    one = F.min_by(F.struct("text", "label"), F.struct(F.xxhash64("text", "label"), "text", "label")).alias("row")
    found = texts.join(sample, "id").groupBy("id").agg(one)
    # at most 2 * SAMPLE_TEXTS rows of SAMPLE_CHARS characters
    rows = found.select("id", "row.*").orderBy("id").limit(2 * SAMPLE_TEXTS).collect()
    return train([r["text"] for r in rows], [r["label"] for r in rows])


def score_texts(docs: DataFrame, network: Network, text: str = "text", score: str = "score") -> DataFrame:
    """All columns and rows of ``docs`` with ``score`` (a column of that name is replaced).

    Null and empty texts get the base score, which is low. Repeated rows score alike; an empty table gives an
    empty one; very long texts are scored whole.
    """
    docs = docs.drop(score)
    shared = docs.sparkSession.sparkContext.broadcast(network)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for row, words in read_words(batch.column(place)):
                found = shared.value.score(words)
                scores[row : row + len(found)] = found
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, score]
            )

    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(ta.released(run), f"{schema}, `{score}` double")
