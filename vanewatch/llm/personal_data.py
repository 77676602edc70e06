"""Finds personal data: fixed patterns, and a skip-chain conditional random field that adds to them.

The patterns find e-mail addresses, IP addresses, card and phone numbers. The field's nodes are the words of a
text that hold a digit or an ``@``; all other words are plain and only serve as context. Each node has a
potential from its characters and the words around it, and neighbouring nodes share one. Nodes that read alike, or alike
but for one character, however far apart, share one with a node of their group, so that each is two steps from
all others. Loopy message passing settles the labels of a whole document together, with the patterns' hits as what is
known. What it labels with confidence and no pattern found is added.

All potentials are fitted together to the patterns' labels on a bounded sample of texts, with part of the nodes hidden.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewatch.llm.text_arrays import BASE, BYTE_VALUES, INVERSE, U64, mix, powers

# fixed values: the kinds in the order in which spans with the same start are listed
KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
HINT = re.compile(r"[0-9@]")

LABELS = len(KINDS) + 1  # the first is: nothing
FEATURE_ROWS = 1 << 12
SAMPLE_TEXTS, SAMPLE_CHARS = 4000, 20_000
# Parts of 64 nodes that the field is fitted to, however many nodes there are.
STEPS, RATE, DECAY = 3000, 0.5, 1e-4
# Share of the nodes whose characters are hidden in a pass of the fitting.
HIDDEN = 0.3
# Least characters of words that are linked as equal, and as equal but for one character.
SAME_CHARS, SIMILAR_CHARS = 5, 6
# Message passing ends when nothing changes by more than this; a text that never settles is left after so many rounds.
TOLERANCE, ROUNDS = 1e-4, 500
# What a pattern's hit adds to its label.
HELD = 8.0
SURE = 0.95
# Pair potentials are held within these bounds, so that no one neighbour decides.
BOUND = 5.0
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each ``@``, so that long texts take linear time."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end(), "email"
            done = match.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[Span]:
    for match in DOTTED.finditer(text):
        parts = match.group().split(".")
        at = match.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                yield at, end, "ip"
            at = end + 1


def cards(text: str) -> Iterator[Span]:
    for match in CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield match.start(), match.end(), "card"


def phones(text: str) -> Iterator[Span]:
    for match in PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in match.group()) <= 15:
            yield match.start(), match.end(), "phone"


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start, then by kind."""
    if not HINT.search(text):
        return []
    found = [*emails(text), *addresses(text), *cards(text), *phones(text)]
    return ordered(found)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# --- the field ------------------------------------------------------------------------------------


def shape(word: str) -> str:
    """Runs of digits as ``9`` and their length (6 for more), runs of letters as ``a``, other characters as they are."""
    word = re.sub(r"[^\W\d_]+", "a", word)
    return re.sub(r"[0-9]+", lambda m: f"9{min(len(m.group()), 6)}", word)


def check(word: str) -> str:
    """What the digits of a word are good for: a sum that fits a card, parts that fit an address."""
    digits = re.sub(r"[^0-9]+", "", word)
    parts = re.findall(r"[0-9]+", word)
    fits = all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in parts)
    return f"{12 <= len(digits) <= 19}{12 <= len(digits) <= 19 and luhn(digits)}{len(parts) == 4}{len(parts) == 4 and fits}"


@dataclass
class Graph:
    """Nodes of some texts, and what connects nodes of one text."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    features: np.ndarray  # one row of feature numbers for each node, the OWN first ones of the node's own characters
    chain: np.ndarray  # pairs of neighbouring nodes
    links: np.ndarray  # node and group of each membership: all nodes of a group read alike
    similar: np.ndarray  # for each group whether its nodes are the same but for one character
    group_text: np.ndarray


def _features(word: str, before: list[str], after: str) -> list[int]:
    named = [
        f"s{shape(word)}", f"f{word[:1]}", f"l{word[-1:]}", f"d{min(sum(c.isdigit() for c in word), 20)}",
        f"p{word.count('.')}@{word.count('@')}", f"c{check(word)}",
        f"b{before[-1]}", f"e{before[-2]}", f"t{before[-2]} {before[-1]}", f"a{after}", "1",
    ]
    return [zlib.crc32(f.encode()) % FEATURE_ROWS for f in named]


OWN = 6


def _plain(word: str) -> str:
    return word.lower().strip(".,;:!?\"'()[]{}<>")


def _less_one(key: str) -> np.ndarray:
    """Hashes of a key and of what is left of it when any one byte is taken out."""
    data = BYTE_VALUES[np.frombuffer(key.encode(errors="replace"), np.uint8)]
    n = len(data)
    placed = data * powers(BASE, n)[:n]
    upto = np.cumsum(placed, dtype=U64)
    whole = upto[-1:]
    less = (upto - placed) + (whole - upto) * U64(INVERSE)
    return np.unique(np.concatenate([mix(whole ^ U64(n)), mix(less ^ U64(n - 1))]))


def _groups(keys: dict[str, list[int]]) -> Iterator[tuple[bool, list[int]]]:
    """Groups of two or more nodes that have a key in common, or keys that are equal but for one character."""
    yield from ((False, nodes) for nodes in keys.values() if len(nodes) > 1)
    long = [k for k in keys if len(k) >= SIMILAR_CHARS]
    if len(long) < 2:
        return
    hashes = [_less_one(k) for k in long]
    of = np.repeat(np.arange(len(long)), [len(h) for h in hashes])
    flat = np.concatenate(hashes)
    order = np.lexsort((of, flat))
    flat, of = flat[order], of[order]
    found = set()
    for part in np.split(of, np.flatnonzero(flat[1:] != flat[:-1]) + 1):
        if len(part) > 1:
            found.add(tuple(part.tolist()))
    for members in sorted(found):
        yield True, sorted({node for m in members for node in keys[long[m]]})


def graph_of(texts: list[str]) -> Graph:
    place, features, chain, links, similar, group_text = [], [], [], [], [], []
    for number, text in enumerate(texts):
        if not HINT.search(text):
            continue
        keys: dict[str, list[int]] = {}
        before, last, waiting = ["", ""], None, None
        for match in WORD.finditer(text):
            word = match.group()
            if waiting is not None:
                features.append(_features(*waiting, _plain(word)))
                waiting = None
            if HINT.search(word):
                node = len(place)
                place.append((number, match.start(), match.end()))
                waiting = (word, before)
                if last is not None and match.start() - last <= 1:
                    chain.append((node - 1, node))
                last = match.end()
                # words that hold the same digits, or read alike but for case and marks, are one group
                for key in {re.sub(r"\W+", "", word.lower()), re.sub(r"[^0-9]+", "", word)}:
                    if len(key) >= SAME_CHARS:
                        keys.setdefault(key, []).append(node)
            before = [before[-1], _plain(word)]
        if waiting is not None:
            features.append(_features(*waiting, ""))
        for is_similar, nodes in _groups(dict(sorted(keys.items()))):
            links += [(node, len(similar)) for node in nodes]
            similar.append(is_similar)
            group_text.append(number)
    text, start, end = np.array(place, np.int64).reshape(-1, 3).T
    width = len(_features("", ["", ""], ""))
    return Graph(
        text, start, end, np.array(features, np.int64).reshape(-1, width), np.array(chain, np.int64).reshape(-1, 2),
        np.array(links, np.int64).reshape(-1, 2), np.array(similar, bool), np.array(group_text, np.int64),
    )


def labels_of(graph: Graph, spans: list[list[Span]]) -> np.ndarray:
    """What the given spans (a list for each text, by start) say about each node."""
    labels = np.zeros(len(graph.text), np.int64)
    now, following, near = -1, 0, []
    for i, (text, start, end) in enumerate(zip(graph.text.tolist(), graph.start.tolist(), graph.end.tolist())):
        if text != now:
            now, following, near = text, 0, []
        while following < len(spans[text]) and spans[text][following][0] < end:
            near.append(spans[text][following])
            following += 1
        near = [s for s in near if s[1] > start]
        if near:
            labels[i] = 1 + KINDS.index(near[0][2])
    return labels


class Field:
    """Potentials of the conditional random field.

    ``pair`` has one table for neighbours (left, right), one for a node and its group of equal ones, and one for a node
    and its group of similar ones.
    """

    def __init__(self) -> None:
        self.own = np.zeros((FEATURE_ROWS + 1, LABELS))
        self.own[zlib.crc32(b"1") % FEATURE_ROWS, 0] = 3.0
        self.pair = np.zeros((3, LABELS, LABELS))

    def fit(self, graph: Graph, labels: np.ndarray, seed: int = 3) -> Field:
        """Fits all potentials together, by the likelihood of each node's label given its neighbours' and groups' labels.

        In every pass the characters of some of the nodes are hidden, so that what stands around them and the nodes
        that they are linked with have to tell their labels.
        """
        rng, n = np.random.default_rng(seed), len(labels)
        # for each node: a table and the row of it that its surroundings choose
        group, member = graph.links[:, 1], graph.links[:, 0]
        counts = np.zeros((len(graph.similar), LABELS), np.int64)
        np.add.at(counts, (group, labels[member]), 1)
        others = counts[group]
        others[np.arange(len(group)), labels[member]] -= 1
        tables = np.stack([self.pair[0], self.pair[0].T, self.pair[1].T, self.pair[2].T])
        left, right = graph.chain.T
        node = np.concatenate([left, right, member])
        table = np.concatenate([np.ones_like(left), np.zeros_like(right), 2 + graph.similar[group].astype(np.int64)])
        row = np.concatenate([labels[right], labels[left], others.argmax(axis=1)])
        order = np.argsort(node, kind="stable")
        node, table, row = node[order], table[order], row[order]
        first = np.searchsorted(node, np.arange(n + 1))
        for _ in range(-(-STEPS // -(-n // 64)) if n else 0):
            features = hidden(graph.features, rng.random(n) < HIDDEN)
            shuffled = rng.permutation(n)
            for low in range(0, n, 64):
                part = shuffled[low : low + 64]
                size = first[part + 1] - first[part]
                near = np.repeat(first[part] - np.cumsum(size) + size, size) + np.arange(size.sum())
                of = np.repeat(np.arange(len(part)), size)
                wrong = self.own[features[part]].sum(axis=1)
                np.add.at(wrong, of, tables[table[near], row[near]])
                wrong = _softmax(wrong)
                wrong[np.arange(len(part)), labels[part]] -= 1
                step, pairs = np.zeros_like(self.own), np.zeros_like(tables)
                np.add.at(step, features[part], wrong[:, None, :])
                np.add.at(pairs, (table[near], row[near]), wrong[of])
                # both sides of the table of neighbours are one
                pairs[0] += pairs[1].T
                pairs[1] = pairs[0].T
                self.own -= RATE * (step / len(part) + DECAY * self.own)
                tables = np.clip(tables - RATE * (pairs / len(part) + DECAY * tables), -BOUND, BOUND)
        self.pair = np.stack([tables[0], tables[2].T, tables[3].T])
        return self

    def marginals(self, graph: Graph, known: np.ndarray | None = None) -> np.ndarray:
        """Probability of each label for each node, by loopy message passing over all edges.

        Labels above 0 in ``known`` are held. A text's messages are passed until none of them changes by TOLERANCE, or
        ROUNDS times, whatever the other texts do.
        """
        n = len(graph.text)
        own = np.zeros((n + len(graph.similar), LABELS))
        own[:n] = self.own[graph.features].sum(axis=1)
        if known is not None:
            at = np.flatnonzero(known)
            own[at, known[at]] += HELD
        ends = np.concatenate([graph.chain, graph.links + [0, n]])
        if not len(ends):
            return _softmax(own)
        kind = np.concatenate([np.zeros(len(graph.chain), np.int64), 1 + graph.similar[graph.links[:, 1]]])
        m = len(ends)
        source, target = np.concatenate([ends, ends[:, ::-1]]).T
        back = np.concatenate([np.arange(m) + m, np.arange(m)])
        pair = np.concatenate([self.pair[kind], self.pair[kind].transpose(0, 2, 1)])
        text = np.concatenate([graph.text, graph.group_text])[source]
        messages = np.zeros((2 * m, LABELS))
        live = np.arange(2 * m)
        for _ in range(ROUNDS):
            belief = own.copy()
            np.add.at(belief, target, messages)
            sent = belief[source[live]] - messages[back[live]]
            new = _log_sum(sent[:, :, None] + pair[live], axis=1)
            new = 0.5 * messages[live] + 0.5 * (new - _log_sum(new, axis=1)[:, None])
            moved = np.zeros(int(text.max()) + 1)
            np.maximum.at(moved, text[live], np.abs(new - messages[live]).max(axis=1))
            messages[live] = new
            live = live[moved[text[live]] >= TOLERANCE]
            if not len(live):
                break
        belief = own.copy()
        np.add.at(belief, target, messages)
        return _softmax(belief[:n])


def hidden(features: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The features without those of the characters of some nodes."""
    features = features.copy()
    features[which, :OWN] = FEATURE_ROWS
    return features


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def added_spans(texts: list[str], base: list[list[Span]], field: Field) -> list[list[Span]]:
    """Spans that the field finds in each text and that no base span touches."""
    graph = graph_of(texts)
    out: list[list[Span]] = [[] for _ in texts]
    if not len(graph.text):
        return out
    known = labels_of(graph, base)
    chances = field.marginals(graph, known)
    best = chances.argmax(axis=1)
    sure = (best > 0) & (chances.max(axis=1) >= SURE)
    for i in np.flatnonzero(sure & (known == 0)):
        text, start, end, kind = int(graph.text[i]), int(graph.start[i]), int(graph.end[i]), KINDS[best[i] - 1]
        word = texts[text][start:end]
        core = word.strip(".,;:!?\"'()[]{}<>")
        if not HINT.search(core):
            continue
        start += word.index(core)
        end = start + len(core)
        found = out[text]
        if found and found[-1][2] == kind and start - found[-1][1] <= 2:
            found[-1] = (found[-1][0], end, kind)
        else:
            found.append((start, end, kind))
    return out


def fit_field(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> Field:
    """Fits the field on a bounded sample of texts, those with the smallest hash."""
    rows = docs.filter(F.col(text).rlike("[0-9@]") & (F.length(text) <= SAMPLE_CHARS)).select(
        F.col(text).alias("text"), F.xxhash64(text).alias("key")
    )
    # chosen by hash alone, so that no task and not the driver gathers texts beyond the sample
    chosen = rows.select("key").distinct().orderBy("key").limit(SAMPLE_TEXTS)
    sample = rows.join(F.broadcast(chosen), "key", "left_semi").dropDuplicates(["key"])
    texts = sorted(row["text"] for row in sample.select("text").collect())
    graph = graph_of(texts)
    return Field().fit(graph, labels_of(graph, [base_spans(t) for t in texts]))


def find_personal_data(docs: DataFrame, field: Field, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """For each row of ``docs`` the number of base spans by kind, a hash of them, and all spans.

    Null and empty texts have no spans. Repeated rows get the same result, an empty table an empty one. Offsets
    count code points, ends are exclusive. Other columns are not read. Texts are searched whole; the patterns
    take time in proportion to a text's length.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            added = added_spans(texts, base, shared.value)
            counts = [
                pa.array([sum(s[2] == kind for s in spans) for spans in base], pa.int64()) for kind in KINDS
            ]
            digest = [hashlib.sha256(listed(spans).encode()).hexdigest() for spans in base]
            spans = [listed(ordered(b + a)) for b, a in zip(base, added)]
            extra = pa.array([len(a) for a in added], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(digest, pa.string()), pa.array(spans, pa.string()), extra],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
            )

    kinds = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text)).mapInArrow(
        run, f"doc_id long, {kinds}, base_sha256 string, spans string, n_added long"
    )
