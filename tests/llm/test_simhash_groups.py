"""Fingerprints, parts and groups against brute force, and awkward rows."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vanewatch.llm import queries
from vanewatch.llm import simhash_groups as sg
from vanewatch.llm import text_arrays as ta

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(11)


def slow_fingerprint(text, n=4):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints, different=4):
    """Smallest id reachable, for (id, fingerprint) pairs without null ids."""
    ids = [i for i, _ in prints]
    names = dict(zip(range(len(ids)), ids))
    values = np.array([p for _, p in prints], np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= different
    changed = True
    while changed:
        changed = False
        for k in range(len(ids)):
            least = min(names[j] for j in np.flatnonzero(near[k]))
            if least < names[k]:
                names[k], changed = least, True
    return [names[k] for k in range(len(ids))]


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r.doc_id, slow_fingerprint(r.text)) for r in rows]
    want = {i: (f"{p:016x}", c) for (i, p), c in zip(prints, slow_groups(prints))}
    got = queries.queries()["op11_simhash_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want and len(got) == len(rows)


def test_awkward_rows(spark):
    long = " ".join("".join(rng.choice("abcdef") for _ in range(4)) for _ in range(40_000))
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, long), (5, "One two"), (5, "one TWO"), (None, "no id"), (None, "one two"), (9, "no id")]
    rows = [(i, t, "en", None, 0) for i, t in texts]
    clash = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("print", "component", "bucket", "first")})
    got = sorted(((r.doc_id or 0, r.fingerprint, r.component_id) for r in sg.group_near(clash).collect()))
    fp = {t: f"{slow_fingerprint(t):016x}" for _, t in texts}
    want = [(1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (5, 5), (0, 9), (0, 5), (9, 9)]
    assert got == sorted((w[0], fp[t[1]], w[1]) for w, t in zip(want, texts))
    assert sg.group_near(clash.limit(0)).collect() == []
    lonely = spark.createDataFrame([(None, "a b", "", "", 0)], SCHEMA)
    assert [tuple(r)[::2] for r in sg.group_near(lonely).collect()] == [(None, None)]


def near_copies(value, how_many, bits):
    return [value ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, bits))) for _ in range(how_many)]


@pytest.mark.parametrize("small", [128, 4])
def test_no_link_is_lost(spark, monkeypatch, small):
    """Chains, dense groups and shared halves, also when buckets have to be divided again and again."""
    monkeypatch.setattr(sg, "SMALL_BUCKET", small)
    values = [rng.getrandbits(64) for _ in range(150)]
    values += near_copies(rng.getrandbits(64), 60, 5) + near_copies(rng.getrandbits(64), 60, 9)
    half = rng.getrandbits(32)
    values += [half | rng.getrandbits(8) << 40 for _ in range(60)]
    chain = [rng.getrandbits(64)]
    for _ in range(30):
        chain.append(chain[-1] ^ sum(1 << b for b in rng.sample(range(64), 4)))
    values = sorted(set(values + chain))
    prints = np.array(values, np.uint64)
    nodes = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "print long")
    nodes = nodes.withColumn("component", F.col("print"))
    n, both = sg.bit_statistics(nodes)
    parts = sg.choose_parts(n, both, prints)
    found = {r.node: r.component for r in sg.connected(sg._links_in(sg.bucket_rows(nodes, parts), 4)).collect()}
    signed = [int(p) for p in prints.view(np.int64)]
    want = slow_groups([(s, int(p)) for s, p in zip(signed, prints)])
    assert [found.get(s, s) for s in signed] == want


def test_statistics_and_parts(spark):
    prints = np.array([rng.getrandbits(60) | (15 << 60) * (i % 2) for i in range(300)], np.uint64)
    nodes = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "print long")
    n, both = sg.bit_statistics(nodes)
    bits = sg.unpacked(prints).astype(int)
    assert n == 300 and (both == bits.T @ bits).all()
    # the four bits that go together share a part
    groups = sg.grouped_bits(list(range(64)), sg.correlation(n, both), 4)
    assert sorted(sum(groups, [])) == list(range(64)) and any({60, 61, 62, 63} <= set(g) for g in groups)
    for different in (0, 1, 4, 7):
        parts = sg.choose_parts(n, both, prints, different)
        assert sum(t + 1 for _, t in parts) == different + 1


def test_thresholds_cost_least():
    costs = np.array([[rng.random() for _ in range(6)] for _ in range(3)])
    every = [(costs[0][a] + costs[1][b] + costs[2][c], [a - 1, b - 1, c - 1]) for a in range(6) for b in range(6) for c in range(6) if a + b + c == 5]
    cost, chosen = sg.allocate(costs, 5)
    assert chosen == min(every)[1] and cost == pytest.approx(min(every)[0])


def test_more_fingerprints_take_fewer_parts():
    sample = np.array([rng.getrandbits(64) for _ in range(1000)], np.uint64)
    bits = sg.unpacked(sample).astype(float)
    share = bits.T @ bits / len(sample)
    used = [len(sg.choose_parts(n, share * n, sample)) for n in (10**4, 10**7, 10**10)]
    assert used == sorted(used, reverse=True) and used[0] > used[-1]


def test_texts_of_a_batch_do_not_meet():
    texts = [b"a b c", b"", b"d E  f\ng h"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    got = sg._fingerprints(data, offsets, 4)
    assert got.dtype == ta.U64 and got.tolist() == [slow_fingerprint(t.decode()) for t in texts]
