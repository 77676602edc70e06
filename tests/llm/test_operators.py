"""Every operator on small awkward tables, and against brute force or SQL."""

import glob
import hashlib
import inspect
import math
import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vanewatch.llm import (
    decontaminate,
    license_scan,
    line_dedup,
    ngram_join,
    personal_data,
    quality_ratio,
    queries,
    source_mix,
    suffix_dedup,
    toxicity,
    url_filter,
)
from vanewatch.llm import text_arrays as ta
from vanewatch.llm.components import connected

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(5)


def words(n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 5))) for _ in range(n))


LONG = words(30_000)
AWKWARD = [
    (1, None, "en", "a", 0),
    (2, "", None, None, None),
    (3, " \n\t ", "en", "b", 4),
    (4, LONG, "en", "a", len(LONG)),
    (5, "one two\nthree", "en", "a", 13),
    (5, "one two\nthree", "en", "a", 13),
    (None, "no id here at all", "en", None, 17),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def frame(spark, texts, source="a"):
    return spark.createDataFrame([(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)], SCHEMA)


def network():
    return toxicity.train(["bad word", "worse word"] * 3, [1, 0] * 3)


# what each operator makes of a table of documents
APPLY = {
    "quality": lambda d: quality_ratio.score_documents(d, d.limit(0).select("doc_id")),
    "license": license_scan.scan_licenses,
    "mix": source_mix.mix_sources,
    "join": ngram_join.group_similar,
    "repeats": suffix_dedup.remove_repeats,
    "lines": line_dedup.remove_lines,
    "personal": lambda d: personal_data.find_personal_data(d, personal_data.Field()),
    "toxicity": lambda d: toxicity.score_texts(d, toxicity.train([], [])),
}
CLASHES = (
    "size", "score", "key", "words", "group", "node", "of_node", "of_source", "range", "toxicity_score", "row_key",
    "number", "body", "item_id", "line", "_of_node", "_mix_own",
)


@pytest.mark.parametrize("name", APPLY)
def test_awkward_rows_each_give_a_row(spark, awkward, empty, name):
    clash = awkward.withColumns({c: F.lit("x") for c in CLASHES})
    got = APPLY[name](clash).collect()
    assert len(got) == len(AWKWARD)
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in AWKWARD)
    assert APPLY[name](empty).count() == 0


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for file in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(file)[:-8]} as from '{file}'")
    return con


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(spark, db, name):
    df = queries.queries()[name](spark, SF)
    names = ", ".join(f'"{c}"' for c in df.columns)
    want = ordered(db.execute(f"select {names} from ({queries.oracle_sql()[name]})").fetchall())
    assert ordered(df.collect()) == want


def test_quality_counts(spark):
    texts = ["a b c d e x a b c d e", "x y\nx y\n\nz | #", "p q r s t u v w x y z", None]
    got = quality_ratio.score_documents(frame(spark, texts), spark.createDataFrame([(2,)], "doc_id long"))
    rows = {r["doc_id"]: r for r in got.collect()}
    assert [rows[i]["n_repeat_words"] for i in range(4)] == [10, 0, 0, 0]
    assert [rows[i]["n_dup_lines"] for i in range(4)] == [0, 1, 0, 0]
    assert rows[1]["n_symbols"] == 2 and rows[1]["word_chars"] == 7 and rows[0]["base_failed"]
    assert rows[3]["n_words"] == 0 and not rows[3]["kept"] and rows[2]["score"] > rows[0]["score"]


@pytest.mark.parametrize("broadcast", [1_000_000, 20])
def test_quality_scores_equal_brute_force(spark, monkeypatch, broadcast):
    """With buckets enough, every word and pair has its own; broadcast or joined by key. The own share of a trusted text is left out."""
    monkeypatch.setattr(quality_ratio, "BROADCAST_BUCKETS", broadcast)
    draw = random.Random(7)
    texts = [" ".join(draw.choice("abcdefgh") * draw.randint(1, 9) for _ in range(draw.randint(0, 40))) for _ in range(60)]
    texts += [texts[0], texts[1], None]
    trusted = set(range(0, 40, 2))
    grams = [Counter(t.split() + list(zip(t.split(), t.split()[1:]))) for t in (t or "" for t in texts)]
    corpus, target = sum(grams, Counter()), sum((grams[i] for i in trusted), Counter())
    share = target.total() / corpus.total()
    ids = spark.createDataFrame([(i,) for i in trusted], "doc_id long")
    got = {r["doc_id"]: r["score"] for r in quality_ratio.score_documents(frame(spark, texts), ids, buckets=1 << 31).collect()}
    assert len(got) == len(texts) and got[62] is None
    for i, own in enumerate(grams):
        if own:
            ratio = {g: math.log(((target[g] - (n if i in trusted else 0)) / share + 1) / (corpus[g] + 1)) for g, n in own.items()}
            assert got[i] == pytest.approx(sum(n * ratio[g] for g, n in own.items()) / own.total())


def test_every_trusted_document_counts(spark, monkeypatch):
    labels = spark.range(30_000).selectExpr("id as doc_id", "cast(id % 10 > 0 as int) as quality")
    ids = quality_ratio.trusted_ids(labels.unionByName(labels))
    assert ids.count() == 27_000
    texts = ["a b c d", "a b x y", "x y z", "c d e"]
    few = spark.createDataFrame([(0,), (1,)], "doc_id long")
    want = quality_ratio.score_documents(frame(spark, texts), few).collect()
    monkeypatch.setattr(quality_ratio, "BROADCAST_IDS", 1)
    got = quality_ratio.score_documents(frame(spark, texts), few).collect()
    assert [r["score"] for r in sorted(got)] == pytest.approx([r["score"] for r in sorted(want)])


def test_quality_separates_labelled_documents(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    scored = queries.op1_quality_rules(spark, sf).join(labels, "doc_id").filter("not base_failed")
    counts = {(r["quality"], r["kept"]): r["count"] for r in scored.groupBy("quality", "kept").count().collect()}
    bad, good = (counts.get((q, True), 0) + counts.get((q, False), 0) for q in (0, 1))
    assert counts[0, False] >= 0.95 * bad > 0
    assert counts[1, True] >= 0.95 * good > 0


def test_repeated_words_equal_brute_force(spark):
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 30))) for _ in range(200)]
    df = frame(spark, texts).select("doc_id", quality_ratio.repeated_words(F.split("text", " ")).alias("n"))
    for r in df.collect():
        w = texts[r["doc_id"]].split(" ")
        runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        covered = {i + k for i, x in enumerate(runs) if runs.count(x) > 1 for k in range(5)}
        assert r["n"] == len(covered)


def brute_licenses(text, templates, threshold):
    """Labels and best share, each template held against each of its blocks."""
    split = [w for w in re.split(r"[\x00-\x2f:-`{-\x7f]+", (text or "").lower()) if w]
    labels, best = set(), 0.0
    for label, notice in templates:
        wanted = [w for w in re.split(r"[\x00-\x2f:-`{-\x7f]+", notice.lower()) if w]
        for start in range(0, max(len(split) - len(wanted), 1), max(len(wanted), 1)):
            share = len(set(wanted) & set(split[start : start + 2 * len(wanted)])) / max(len(set(wanted)), 1)
            if wanted and share >= threshold:
                labels.add(label)
                best = max(best, share)
    return ",".join(sorted(labels)), best


@pytest.mark.parametrize("part, threshold", [(200_000, 0.9), (200, 0.8)])
def test_licenses_equal_brute_force(spark, monkeypatch, part, threshold):
    monkeypatch.setattr(license_scan, "PART_WORDS", part)
    draw = random.Random(8)
    pick = [words(1) for _ in range(40)]
    templates = [(f"l{i % 23}", " ".join(draw.choices(pick, k=draw.choice((1, 3, 5, 9, 20, 41))))) for i in range(40)] + [("none", "--")]
    texts = [None, "", "x", " ".join(pick), templates[3][1].upper()]
    for _ in range(120):
        parts = [" ".join(draw.choices(pick, k=draw.randint(0, 30)))]
        for _, notice in draw.choices(templates, k=2):
            kept = [w for w in notice.split() if draw.random() > 0.1]
            parts += [" ".join(kept), " ".join(draw.choices(pick, k=draw.randint(0, 20)))]
        texts.append(" ".join(parts))
    got = license_scan.scan_licenses(frame(spark, texts), templates=templates, phrases={}, threshold=threshold).collect()
    assert {r["doc_id"]: (r["labels"], r["score"]) for r in got} == {
        i: brute_licenses(t, templates, threshold) for i, t in enumerate(texts)
    }


def test_licenses_want_a_short_notice_in_one_place(spark):
    far = "all the students in this school have rights and " + words(20) + " a table is reserved"
    got = license_scan.scan_licenses(frame(spark, [far, "so: All rights reserved, 2020"])).orderBy("doc_id").collect()
    assert [r["labels"] for r in got] == ["", "all-rights-reserved"]


def test_toxicity_learns_words_and_parts_of_words():
    clean = [words(rng.randint(5, 80)) for _ in range(900)]
    marks = ["zzkua", "zzkuoe", "zzkuand", "wretch"]
    marked = [f"{words(10)} {rng.choice(marks)} {words(15)} {rng.choice(marks)} {words(15)}" for _ in range(900)]
    net = toxicity.train(clean[:800] + marked[:800], [0] * 800 + [1] * 800)

    def score(texts):
        return np.concatenate([net.score(w) for _, w in toxicity.read_words(pa.array(texts))])

    assert (score(marked[800:]) >= 0.7).mean() > 0.9 and (score(clean[800:]) >= 0.7).mean() < 0.1
    assert score([""])[0] < 0.5


def test_toxicity_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        index, text = toxicity.windows(np.array([0, n]))
        assert set(index[index >= 0].tolist()) == set(range(n)) and len(index) == len(text)


def test_base_spans_equal_plain_patterns():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(5000):
        text = "".join(rng.choice("a1.@+ -2%") for _ in range(rng.randint(0, 40)))
        want = [(m.start(), m.end(), "email") for m in email.finditer(text)]
        want += [(m.start(), m.end(), "ip") for m in ip.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
        got = [s for s in personal_data.base_spans(text) if s[2] in ("email", "ip")]
        assert got == personal_data.ordered(want)


def test_base_counts_and_hash_equal_plain_patterns(spark):
    patterns = {
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and personal_data.luhn(re.sub("[^0-9]", "", m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    assert [personal_data.luhn(d) for d in ("4111111111111111", "4111111111111112", "0", "18", "19")] == [True, False, True, True, False]
    draw, texts = random.Random(4), [None, "", "card 4111-1111 1111 1111, tel +49 (30) 123.456-78"]
    texts += ["".join(draw.choices("0123456789+ -().x", weights=[4] * 10 + [3, 4, 3, 1, 1, 1, 2], k=draw.randint(5, 60))) for _ in range(1500)]
    got = personal_data.find_personal_data(frame(spark, texts), personal_data.Field()).collect()
    for r in got:
        want = []
        for kind, (pattern, fits) in patterns.items():
            want += [(m.start(), m.end(), kind) for m in re.finditer(pattern, texts[r["doc_id"]] or "") if fits(m.group())]
            assert r[f"n_{kind}"] == sum(k == kind for *_, k in want)
        base = [s for s in personal_data.base_spans(texts[r["doc_id"]] or "")]
        assert [s for s in base if s[2] in patterns] == sorted(want, key=lambda s: (s[0], s[2]))
        line = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest() and set(filter(None, line.split(","))) <= set(r["spans"].split(","))


def test_field_marginals_equal_enumeration():
    # without a circle, what message passing finds is exact
    draw = np.random.default_rng(2)
    for text in ("a1 b2 c3, then 77777 x 77777 y 77777", "12345678 and later 1234-5678 again 9", "123456 then 123457"):
        graph, field = personal_data.graph_of([text]), personal_data.Field()
        field.own, field.pair = draw.normal(size=field.own.shape), draw.normal(size=field.pair.shape)
        n, groups = len(graph.text), len(graph.similar)
        total = np.zeros((n, personal_data.LABELS))
        own = field.own[graph.features].sum(axis=1)
        for labels in np.ndindex(*[personal_data.LABELS] * (n + groups)):
            score = sum(own[i, labels[i]] for i in range(n))
            score += sum(field.pair[0][labels[a], labels[b]] for a, b in graph.chain)
            score += sum(field.pair[1 + graph.similar[g]][labels[a], labels[n + g]] for a, g in graph.links)
            for i in range(n):
                total[i, labels[i]] += np.exp(score)
        want = total / total.sum(axis=1, keepdims=True)
        assert np.allclose(field.marginals(graph), want, atol=1e-3)


def test_field_links_equal_and_similar_words():
    graph = personal_data.graph_of(["code 12345678, much later 1234-5678; 12345679 or 2345678 and 99999999, " + "8" * 5000])
    assert [(bool(graph.similar[g]), graph.links[graph.links[:, 1] == g, 0].tolist()) for g in range(len(graph.similar))] == [
        (False, [0, 1]), (True, [0, 1, 2]), (True, [0, 1, 3]),
    ]


def personal_texts(draw, n):
    """Texts with a number that comes again, its first time in a form that the patterns know, and other numbers."""
    texts = []
    for _ in range(n):
        tail, other = f"555-{draw.randint(1000, 9999)}", f"{draw.randint(100, 999)}-{draw.randint(1000, 9999)}"
        parts = [f"+1 ({draw.randint(100, 999)}) {tail}", f"order {other}", f"version {draw.randint(1, 9)}.0", f"{words(1)}@{words(1)}.org"]
        draw.shuffle(parts)
        texts.append(" ".join(f"{words(4)} {part}" for part in parts) + f" {words(5)} {tail} {words(2)}")
    return texts


def test_field_finds_again_what_is_hidden():
    draw = random.Random(6)
    seen, held = personal_texts(draw, 400), personal_texts(draw, 200)
    graph = personal_data.graph_of(seen)
    # in the texts that the field is fitted to, the second time is known, too
    marked = [
        personal_data.ordered(base + [(t.rindex("555-"), t.rindex("555-") + 8, "phone")])
        for t, base in ((t, personal_data.base_spans(t)) for t in seen)
    ]
    field = personal_data.Field().fit(graph, personal_data.labels_of(graph, marked))
    base = [personal_data.base_spans(t) for t in held]
    graph = personal_data.graph_of(held)
    known = personal_data.labels_of(graph, base)
    last = np.array([t.rindex("555-") for t in held])
    again = graph.start == last[graph.text]
    graph.features = personal_data.hidden(graph.features, again)
    linked = field.marginals(graph, known)[again].argmax(axis=1)
    assert (linked == 1 + personal_data.KINDS.index("phone")).mean() > 0.95
    apart = personal_data.Graph(**{**vars(graph), "links": graph.links[:0], "similar": graph.similar[:0], "group_text": graph.group_text[:0]})
    assert (field.marginals(apart, known)[again].argmax(axis=1) == linked).mean() < 0.5
    added = personal_data.added_spans(held, base, field)
    assert sum((at, at + 8, "phone") in spans for at, spans in zip(last, added)) > 0.95 * len(held)
    assert sum(map(len, added)) < 1.05 * len(held)


def test_field_of_a_text_does_not_hang_on_others():
    draw = random.Random(7)
    texts = personal_texts(draw, 30) + ["", "no node", " ".join(["12345", "12346", "99999"] * 200)]
    graph = personal_data.graph_of(texts)
    base = [personal_data.base_spans(t) for t in texts]
    field = personal_data.Field().fit(graph, personal_data.labels_of(graph, base))
    alone = [field.marginals(personal_data.graph_of([t])) for t in texts if personal_data.HINT.search(t)]
    assert np.array_equal(field.marginals(graph), np.concatenate(alone))


def brute_components(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0d]+", (t or "").lower())
        sets.append({tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set())
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def near_copies():
    texts = [None, "", "one", "one", "ONE two"]
    for size in (4, 8, 12, 30, 60, 150):
        root = words(size).split()
        for _ in range(14):
            copy = list(root)
            for _ in range(rng.randint(0, max(1, size // 25))):
                copy[rng.randrange(len(copy))] = words(1)
            texts.append(" ".join(copy))
    passage = words(40)
    return texts + [f"{passage} {words(rng.randint(3, 12))}" for _ in range(40)]


def test_ngram_join_equals_brute_force(spark):
    texts = near_copies()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.group_similar(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts)


def test_stage_drops_copies_of_five_words_and_four_fifths(spark):
    draw = random.Random(11)

    def text(n):
        return ["".join(draw.choice("abcdefghij") for _ in range(4)) for _ in range(n)]

    texts = []
    for size in (1, 3, 5, 6, 9, 14, 30, 80, 300):
        root = text(size)
        for more in range(0, max(2, size // 3), max(1, size // 15)):
            texts.append(" ".join(root + text(more)))
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))})
    links = []
    for a in range(len(sets)):
        links += [(a, b) for b in range(a, len(sets)) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    group = {n: n for n in range(len(sets))}
    for _ in sets:
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    docs = frame(spark, texts)
    kept = {r["doc_id"] for r in corpus_pipeline.ngram_join(spark, docs, SF).collect()}
    assert kept == set(group.values())
    four = {r["component_id"] for r in ngram_join.group_similar(docs).collect()}
    assert kept < four


def test_sets_outside_the_largest_component_meet_in_blocks(spark, monkeypatch):
    # links of one signature's sets that no star finds: every one has to come from the blocks
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 1500)
    monkeypatch.setattr(ngram_join, "COUNTED", 50)
    texts = near_copies()
    shingles = ngram_join._set_rows(frame(spark, texts).selectExpr("doc_id as node", "text"), 4)
    sets = {r["node"]: r["items"] for r in shingles.collect() if r["items"]}
    members = spark.createDataFrame([(1, n, n) for n in sets], "signature long, node long, component long")
    sketches = spark.createDataFrame([(n, len(items)) for n, items in sets.items()], "node long, n long")
    docs = frame(spark, texts).selectExpr("doc_id as node", "text")
    links = ngram_join._outside_links(members, sketches, docs, 4, 85)
    got = dict(tuple(r) for r in connected(links).collect())
    want = brute_components(texts)
    assert [got.get(n, n) for n in sets] == [want[n][1] for n in sets]


@pytest.mark.parametrize("paired, closest", [(2, 64), (2, 1), (1000, 64)])
def test_sets_in_small_and_crowded_buckets_equal_brute_force(spark, monkeypatch, paired, closest):
    monkeypatch.setattr(ngram_join, "PAIRED", paired)
    monkeypatch.setattr(ngram_join, "CLOSEST", closest)
    monkeypatch.setattr(ngram_join, "COUNTED", 100)
    texts = near_copies()
    docs = frame(spark, texts)
    described = {r["doc_id"]: r for r in ngram_join.describe_sets(docs, "doc_id", "text", 4).collect()}
    nodes = [n for n, r in described.items() if r["n_shingles"]]
    want = brute_components(texts)
    # of each component the even and the odd nodes are linked so far; every fifth node is in one bucket more
    first = {}
    component = {n: first.setdefault((want[n][1], n % 2), n) for n in nodes}
    rows = [(1, n, component[n]) for n in nodes] + [(2 + n % 3, n, component[n]) for n in nodes if n % 5 == 0]
    members = spark.createDataFrame(rows + rows[:9], "signature long, node long, component long")
    sketches = spark.createDataFrame(
        [(n, described[n]["n_shingles"], described[n]["sketch"]) for n in nodes], "node long, n long, sketch binary"
    )
    links = ngram_join._outside_links(members, sketches, docs.selectExpr("doc_id as node", "text"), 4, 85)
    so_far = spark.createDataFrame([(n, c) for n, c in component.items()], "a long, b long")
    got = dict(tuple(r) for r in connected(links.unionByName(so_far)).collect())
    assert [got.get(n, n) for n in nodes] == [want[n][1] for n in nodes]


@pytest.mark.parametrize("shingle_words, similar", [(4, 85), (corpus_pipeline.COPY_WORDS, corpus_pipeline.COPY_SIMILAR)])
def test_outside_sets_take_no_job_of_their_own(spark, monkeypatch, shingle_words, similar):
    # each block of such sets was a pass over all of them, so that time grew with the square of their number
    texts = near_copies()
    docs = frame(spark, texts)
    described = [r for r in ngram_join.describe_sets(docs, "doc_id", "text", shingle_words).collect() if r["n_shingles"]]
    sketches = spark.createDataFrame(
        [(r["doc_id"], r["n_shingles"], r["sketch"]) for r in described], "node long, n long, sketch binary"
    )
    members = spark.createDataFrame(
        [(1, r["doc_id"], r["doc_id"]) for r in described], "signature long, node long, component long"
    )
    jobs = []
    for shingles in (10**6, 100):
        monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", shingles)
        name = f"blocks of {shingles}"
        spark.sparkContext.setJobGroup(name, name)
        texts_of = docs.selectExpr("doc_id as node", "text")
        ngram_join._outside_links(members, sketches, texts_of, shingle_words, similar).collect()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] < jobs[0] + 20


@pytest.mark.parametrize("places", [1, 512])
def test_short_sketches_rule_out_no_similar_set(monkeypatch, places):
    monkeypatch.setattr(ngram_join, "PLACES", places)
    draw = np.random.default_rng(7)
    for size in (1, 2, 3, 4, 5, 9, 17, 60, 130, 700, 2100):
        sets = []
        for _ in range(12):
            base = draw.integers(0, 2**63, size).astype(np.uint64)
            grown = draw.integers(0, 2**63, draw.integers(0, size // 2 + 1)).astype(np.uint64)
            sets += [np.unique(base), np.unique(np.concatenate([base[draw.integers(0, size // 3 + 1) :], grown]))]
            # many in one place
            sets.append(np.unique(base & ~np.uint64(15)))
        sets = [s for s in sets if len(s)]
        full = [ngram_join.sketch(s) for s in sets]
        short = [ngram_join._gray(np.frombuffer(s, np.uint8)[None]).tobytes() for s in full]
        n, apart = np.array([len(s) for s in sets]), np.arange(len(sets))
        found = [*ngram_join._near_in_bucket(apart, np.ones(len(sets), bool), n, short, 80)]
        near = {(int(a), int(b)) for x, y, _ in found for a, b in zip(x, y)}
        least = {(int(a), int(b)): int(d) for x, y, m in found for a, b, d in zip(x, y, m)}
        for a in range(len(sets)):
            for b in range(a + 1, len(sets)):
                common = len(np.intersect1d(sets[a], sets[b]))
                if 100 * common >= 80 * (n[a] + n[b] - common):
                    assert (a, b) in near
                assert least.get((a, b), 0) <= n[a] + n[b] - 2 * common
        if size == 700:
            assert len(near) < 80


def test_similar_sets_share_a_signature():
    for size in (1, 5, 6, 7, 13, 40, 200, 900):
        for _ in range(20):
            base = np.random.default_rng(rng.randrange(10**9)).integers(0, 2**63, size).astype(np.uint64)
            edits = size * 15 // 185  # so many exchanged on one side keep a similarity of 0.85
            other = np.concatenate([base[edits:], base[:edits] + np.uint64(1)])
            a, b = np.unique(base), np.unique(other)
            common = len(np.intersect1d(a, b))
            if 100 * common >= 85 * (len(a) + len(b) - common):
                assert len(np.intersect1d(ngram_join.signatures(a, 85), ngram_join.signatures(b, 85)))
                assert ngram_join.may_be_similar(len(a), ngram_join.sketch(a), len(b), ngram_join.sketch(b), 85)


def test_four_fifths_share_a_signature_and_take_few():
    draw = np.random.default_rng(3)
    for size in (*range(1, 40), 90, 400, 1000):
        for grown in {size, size * 9 // 8, size * 5 // 4}:
            base = draw.integers(0, 2**63, grown).astype(np.uint64)
            a, b = np.sort(base[:size]), np.sort(base)
            found = ngram_join.signatures(b, 80)
            assert len(np.intersect1d(ngram_join.signatures(a, 80), found))
            assert size < 400 or len(found) < 3 * grown


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (7, 7)]
    got = dict(tuple(r) for r in connected(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {i: 0 for i in range(31)} | {100: 100, 101: 100, 102: 100}


def test_decontamination_finds_changed_items(spark):
    items = [words(n) for n in (15, 24, 40, 59)]
    texts, want = [None, "", words(200)], {}
    for number, item in enumerate(items):
        for changes in range(0, len(item.split()) // 5 - 1):
            w = item.split()
            for _ in range(changes):
                at = rng.randrange(len(w))
                rng.choice([lambda: w.pop(at), lambda: w.insert(at, "new"), lambda: w.__setitem__(at, "other")])()
            want.setdefault(len(texts), number)
            texts.append(f"{words(60)} {' '.join(w).upper()}. {words(60)}")
    bench = spark.createDataFrame(list(enumerate(items)) + [(9, None), (10, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_contamination(frame(spark, texts), bench).collect()}
    assert got <= set(want.items()) and len(got) >= 0.9 * len(want)
    assert decontaminate.find_contamination(frame(spark, texts), bench.limit(0)).count() == 0


def test_windows_in_parts_give_the_same_places(monkeypatch):
    bodies = [words(n) for n in (15, 24, 200)]
    items = decontaminate.prepare([*enumerate(bodies), (9, None)])
    texts = [None, "", words(300)]
    for body in bodies:
        texts += [body, f"{words(50)} {body} {words(50)} {body}"]
    column = pa.array(texts, pa.string())
    whole = decontaminate.find_items(column, items)
    monkeypatch.setattr(decontaminate, "WINDOW_WORDS", 5000)
    assert decontaminate.find_items(column, items) == whole and len(whole) == 9


def test_repeats_equal_brute_force(spark):
    passage, other = words(140), words(110)
    texts = [None, "", "é" * 450, words(500), f"{words(20)} {passage} {words(20)}", f"{passage} {words(9)}", words(90)]
    texts += [f"{other[:401]}", f"x{other[:400]}", f"{words(30)}{other[:399]}", words(200)]
    texts += [texts[-1], passage[50:470] + words(100), "ab" * 300]
    count = Counter(b[k : k + 400] for b in ((t or "").encode() for t in texts) for k in range(len(b) - 399))
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        b = (t or "").encode()
        gone = {k + x for k in range(len(b) - 399) if count[b[k : k + 400]] > 1 for x in range(400)}
        kept = bytes(c for k, c in enumerate(b) if k not in gone)
        spans = sum(k - 1 not in gone for k in gone)
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(b), len(gone), spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_query_removes_planted_passages_of_400_bytes(spark, tmp_path):
    own = random.Random(8)

    def prose(n):
        return " ".join("".join(own.choice("abcdefghij") for _ in range(own.randint(2, 9))) for _ in range(n))

    passages = [prose(n) for n in range(51, 81)]
    rows = [(3 * i + k, f"{prose(60)}\n{p}\n{prose(40)}") for i, p in enumerate(passages) for k in range(2)]
    rows += [(3 * i + 2, prose(160)) for i in range(len(passages))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    count = Counter(t[k : k + 400] for _, t in rows for k in range(len(t) - 399))
    got = {r["doc_id"]: r for r in queries.op8_suffix_dedup(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        gone = {k + x for k in range(len(t) - 399) if count[t[k : k + 400]] > 1 for x in range(400)}
        kept = "".join(c for k, c in enumerate(t) if k not in gone)
        assert (got[i]["n_bytes"], got[i]["n_removed"]) == (len(t), len(gone))
        assert got[i]["n_spans"] == sum(k - 1 not in gone for k in gone)
        assert got[i]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
        # two bytes around a passage are shared as well
        planted = len(passages[i // 3]) + 2 if i % 3 < 2 else 0
        if planted >= 400:
            assert len(gone) >= planted
        elif planted < 390:
            assert not gone
    sizes = [len(p) for p in passages]
    assert min(sizes) < 390 and max(sizes) > 400


def test_sampled_positions_are_a_difference_cover():
    d = suffix_dedup.SAMPLED
    assert {(a - b) % suffix_dedup.COVER for a in d for b in d} == set(range(suffix_dedup.COVER))


def test_lines_on_many_sites_go(spark):
    rows = [(i, f"shared line\nown {i}\n", "en", f"s{i % 12}", 0) for i in range(24)]
    rows += [(99, "shared line\nshared line", "en", None, 0), (98, None, "en", "s1", 0)]
    got = line_dedup.remove_lines(spark.createDataFrame(rows, SCHEMA), n_removed="gone").collect()
    texts = {r["doc_id"]: (r["text"], r["gone"]) for r in got}
    assert texts[3] == ("own 3\n", 1) and texts[99] == ("", 2) and texts[98] == (None, 0)


def test_stage_removes_lines_in_a_table_of_few_sites(spark):
    line = "all rights on this page are reserved"
    rows = [(i, f"{line}\nThe end.\nown {i}", "en", f"s{i % 6}", 0) for i in range(12)]
    got = corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, SCHEMA), SF).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {i: f"The end.\nown {i}" for i in range(12)}
    rows = [(i, f"{line}\nown {i}", "en", f"s{i % 20 if i > 8 else i}", 0) for i in range(20)]
    rows += [(i, "other", "en", f"s{i}", 0) for i in range(9)]
    got = corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, SCHEMA), SF).collect()
    assert {r["text"] for r in got} == {f"own {i}" for i in range(20)} | {"other"}


def test_mix_meets_its_targets(spark):
    rows = [(i, words(rng.randint(0, 40)), "en", rng.choice(["a", "b", "c", None]), 0) for i in range(600)]
    df = source_mix.mix_sources(spark.createDataFrame(rows, SCHEMA))
    by = df.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.sum("size").alias("size"))
    found = by.collect()
    assert all(abs(r["taken"] - r["target"]) <= 1 and r["target"] <= 2 * r["size"] for r in found)
    assert abs(sum(r["target"] for r in found) - 1.5 * sum(r["size"] for r in found)) < 1
    assert df.filter("taken > 2 * size").isEmpty()


def test_urls_without_rules_or_host(spark):
    pages = spark.createDataFrame([(1, None), (2, "x"), (3, "http://a.org/"), (4, "http://B.com/de/x?q")], "page_id long, url string")
    none = spark.createDataFrame([], "url string")
    rules = url_filter.rule_table(spark)
    got = {r["page_id"]: (r["host"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, rules, none).collect()}
    assert got == {1: ("", None, "allow"), 2: ("", None, "allow"), 3: ("a.org", "org/", "allow"), 4: ("b.com", "com/de/", "block")}
    assert url_filter.judge_urls(pages, rules.limit(0), none).filter("verdict = 'block'").isEmpty()
    assert url_filter.judge_urls(pages.limit(0), rules, none).isEmpty()


def test_pipeline_keeps_one_of_each_group_and_no_item(spark):
    final = corpus_pipeline.run(spark, SF)
    rows = final.collect()
    assert 0 < len(rows) < 200 and len({r["doc_id"] for r in rows}) == len(rows)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontaminate.find_contamination(final, bench).isEmpty()
    groups = defaultdict(int)
    for r in ngram_join.group_similar(final).collect():
        groups[r["component_id"]] += 1
    assert max(groups.values()) == 1


# --- stages on awkward tables ---------------------------------------------------------------------

ITEM = "what the seventh question asks of every careful reader is to name the river that runs north"
ODD = [
    (1, None, "en", "a", 0),
    (2, "", None, None, None),
    (3, f"some text before it {ITEM} and after it", "en", "a", 9),
    (None, f"other words here {ITEM} the end", "en", "b", 9),
    (None, "a text that has no id and comes two times over here", "en", "b", 9),
    (None, "a text that has no id and comes two times over here", "en", "c", 9),
    (7, "one of two different texts that share their id as it happens", "en", "b", 9),
    (7, "the second text of that id says quite another thing than it", "en", "b", 9),
    (8, "this row is there twice and so is one document of course", "en", "c", 9),
    (8, "this row is there twice and so is one document of course", "en", "c", 9),
    (9, "a text that has no id and comes two times over here", "en", "c", 9),
    (10, LONG, "en", "a", len(LONG)),
]


@pytest.fixture(scope="module")
def odd_dir(tmp_path_factory, spark):
    """Tables beside the documents: one benchmark item, three times, and labels of one kind only."""
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, ITEM), (2, ITEM), (3, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


STAGE_KEEPS = {
    "toxicity": list(range(12)),
    "line_dedup": list(range(12)),
    # of the copies without an id and with one, the one with an id; one of the repeated rows
    "ngram_join": [0, 1, 2, 3, 6, 7, 8, 10, 11],
    "decontamination": [0, 1, 4, 5, 6, 7, 8, 9, 10, 11],
}


def stage_rows(rows):
    return Counter((r["doc_id"], r["text"]) for r in rows)


@pytest.mark.parametrize("name", STAGE_KEEPS)
def test_stage_on_odd_rows(spark, odd_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit("x") for c in CLASHES})
    got = stage(spark, docs, odd_dir)
    assert got.columns == docs.columns
    want = Counter((ODD[i][0], ODD[i][1]) for i in STAGE_KEEPS[name])
    assert stage_rows(got.collect()) == want
    assert stage(spark, docs.limit(0), odd_dir).collect() == []


def test_mix_stage_on_odd_rows(spark, odd_dir):
    docs = spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit("x") for c in CLASHES})
    got = corpus_pipeline.source_mix(spark, docs, odd_dir)
    rows = got.collect()
    assert set(docs.columns) <= set(got.columns) and all(r["taken"] > 0 and r["size"] == len(r["text"].split()) for r in rows)
    assert not {1, 2} & {r["doc_id"] for r in rows}
    again = corpus_pipeline.source_mix(spark, docs, odd_dir).collect()
    assert Counter((r["doc_id"], r["taken"]) for r in rows) == Counter((r["doc_id"], r["taken"]) for r in again)
    assert corpus_pipeline.source_mix(spark, docs.limit(0), odd_dir).collect() == []


@pytest.mark.parametrize("weight", ["1.0D", "0.5D", "0.01D", "0.001D + pmod(xxhash64(id), 1000) / 1000"])
def test_ranges_of_the_mix_are_even_for_any_weights(spark, monkeypatch, weight):
    """No range holds many more rows than others, be the weights near one or far from it."""
    rows = spark.range(20_000).selectExpr("id as doc_id", "'a b' as text", "'s' as source", f"{weight} as w")
    ranges = []
    monkeypatch.setattr(source_mix, "spread_ranges", lambda df, *by, f=source_mix.spread_ranges: ranges.append(df.groupBy(*by).count()) or f(df, *by))
    df = source_mix.mix_sources(rows, weight=F.col("w"))
    assert abs(df.agg(F.sum("taken")).first()[0] - 60_000) <= 2
    counts = [r["count"] for r in ranges[0].collect()]
    assert sum(counts) == 20_000 and max(counts) < 2 * 20_000 / len(counts) and len(counts) > 60


def test_urls_on_odd_rows(spark):
    long = "http://" + "x" * 50_000 + ".org/" + "y" * 50_000
    rows = [(1, None), (2, ""), (3, "http://a.org/x"), (3, "http://a.org/x"), (None, "http://a.org/x"), (4, long)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("x") for c in ("host", "path", "rule", "canonical", "verdict", "key")})
    got = url_filter.judge_urls(pages, url_filter.rule_table(spark), spark.createDataFrame([("a.org/x",)], "url string")).collect()
    assert Counter(r["page_id"] for r in got) == Counter(r[0] for r in rows)
    assert {r["host"] for r in got if r["page_id"] == 4} == {"x" * 50_000 + ".org"}


def test_contamination_on_odd_rows(spark):
    docs = spark.createDataFrame(ODD + [ODD[2]], SCHEMA).withColumns({c: F.lit("x") for c in CLASHES})
    bench = spark.createDataFrame([(1, ITEM), (2, ITEM), (None, ITEM), (4, ""), (5, None)], "item_id long, text string")
    got = decontaminate.find_contamination(docs, bench).collect()
    # three copies of the item in each of three rows, one of them without an id
    assert Counter((r["doc_id"], r["item_id"]) for r in got) == Counter(
        {(d, i): n for d, n in ((3, 2), (None, 1)) for i in (1, 2, None)}
    )
    assert all(r["distance"] == 0 for r in got)


def test_workers_give_freed_memory_back():
    """What a task has freed below memory that is still in use goes back to the system, or its worker would keep it."""

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") >> 20

    kept = []

    def run(batches):
        for batch in batches:
            used = [np.ones(1 << 16, np.uint8) for _ in range(4000)]
            kept.append(np.ones(1 << 16, np.uint8))
            yield batch
            del used

    before = resident()
    assert list(ta.released(run)(iter([1, 2]))) == [1, 2]
    assert resident() - before < 100
    source = inspect.getsource(ngram_join) + inspect.getsource(decontaminate) + inspect.getsource(toxicity)
    assert source.count("mapInArrow(") == source.count("mapInArrow(ta.released(")


def test_repeated_words_of_few_and_many_windows(spark):
    """Below and above the number of windows that are sorted packed; pairs of words are hashed once for windows and grams."""
    letters = random.Random(8)
    texts = [[letters.choice("abc" if n % 2 else "abcdefgh") for _ in range(n)] for n in (0, 1, 4, 5, 6, 7, 30, 301, 4100, 4101, 5000)]
    texts += [[str(i % (n - 9)) for i in range(n)] for n in (4099, 4100, 4101, 4500)]

    def slow(text):
        windows = [tuple(text[i : i + 5]) for i in range(len(text) - 4)]
        count = Counter(windows)
        return len({i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)})

    rows = spark.createDataFrame(list(enumerate(texts)), "i int, words array<string>")
    got = dict(rows.select("i", quality_ratio.repeated_words(F.col("words"))).collect())
    assert got == {i: slow(text) for i, text in enumerate(texts)}
    hashed = rows.select(quality_ratio._hashes(F.col("words")).alias("h")).select("h", quality_ratio._pairs(F.col("h")).alias("p"))
    own, shared = (quality_ratio._window_hashes(F.col("h"), 5, *more) for more in ((), (F.col("p"),)))
    assert hashed.filter(~own.eqNullSafe(shared)).count() == 0


def test_grams_are_counted_without_lambdas(spark):
    """What stands in a lambda is interpreted for each word, which took op1_quality_rules over its CPU budget."""
    texts = ["a b a b c", "b c", "x", "", None, "a b"]
    ids = spark.createDataFrame([(0,), (2,)], "doc_id long")
    counts = quality_ratio.gram_counts(quality_ratio._texts(frame(spark, texts), ids, "text", "doc_id"), 1 << 31)
    assert "lambda" not in counts._jdf.queryExecution().toString()
    grams = [Counter(t.split() + list(zip(t.split(), t.split()[1:]))) for t in (t or "" for t in texts)]
    corpus, target = sum(grams, Counter()), grams[0] + grams[2]
    got = Counter((r["corpus"], r["target"]) for r in counts.filter("gram is not null").collect())
    assert got == Counter((n, target[g]) for g, n in corpus.items() if n > 1)
    total = counts.filter("gram is null").first()
    assert (total["corpus"], total["target"]) == (corpus.total(), target.total())


@pytest.mark.parametrize("buckets", [1, 5, 1 << 31])
def test_own_grams_of_trusted_texts_are_counted_at_any_number(spark, buckets):
    """Grams that a text holds once, a few times and often; a bucket of all grams and that of number 0 among them."""
    texts = [" ".join(w for i, w in enumerate("abcdefghijkl") for _ in range(i + 1)), "a b c", "l", "x y", "", "l l l l l l l"]
    ids = spark.createDataFrame([(0,), (2,), (4,)], "doc_id long")
    rows = quality_ratio._texts(frame(spark, texts), ids, "text", "doc_id")
    words = {w for t in texts for w in t.split()}
    pairs = {p for t in texts for p in zip(t.split(), t.split()[1:])}
    hashed = spark.createDataFrame([(w, w, None) for w in words] + [(f"{a} {b}", a, b) for a, b in pairs], "gram string, a string, b string")
    h = F.when(F.col("b").isNull(), F.xxhash64("a")).otherwise(F.xxhash64(F.xxhash64("a"), F.xxhash64("b")))
    bucket = dict(hashed.select("gram", quality_ratio._bucket(h, buckets)).collect())
    grams = [Counter(bucket[g] for g in t.split() + [f"{a} {b}" for a, b in zip(t.split(), t.split()[1:])]) for t in texts]
    corpus, target = sum(grams, Counter()), grams[0] + grams[2]
    share = target.total() / corpus.total()
    got = quality_ratio.score_keys(rows, quality_ratio.gram_counts(rows, buckets), buckets).join(rows, "key").collect()
    assert len(got) == len(texts)
    for r in got:
        own = grams[r["id"]]
        ratio = {g: math.log(((target[g] - n * r["is_trusted"]) / share + 1) / (corpus[g] + 1)) for g, n in own.items()}
        assert r["score"] == (pytest.approx(sum(n * ratio[g] for g, n in own.items()) / own.total()) if own else None)
