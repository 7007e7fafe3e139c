import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm_helpers import EDGE_TEXTS, by_id, documents, edge_docs, empty_docs
from strideframe.llm import brown, catalog, chunks, contamination, langid, lzprint, neardup, packed, toxicity
from strideframe.llm.components import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def crc(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


# --- packed texts


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | st.text(st.sampled_from("aB é🙂.,\n\t1日"), max_size=30), max_size=8))
def test_words_of_packed_texts(texts):
    data, offs = packed.text_bytes(pa.array(texts, pa.string()))
    lowered, starts, ends, rows, hashes = packed.words(data, offs)
    got = packed.word_list(lowered, starts, ends)
    want = [WORD.findall(low(t)) for t in texts]
    assert [got[a:b] for a, b in zip(rows[:-1], rows[1:], strict=True)] == want
    flat = [w for ws in want for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat))
    sh, _, sh_rows = packed.shingle_hashes(hashes, rows, 3)
    want_sh = [[tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else [] for w in want]
    assert np.diff(sh_rows).tolist() == [len(x) for x in want_sh]
    names = dict(zip(sh.tolist(), [x for xs in want_sh for x in xs], strict=True))
    assert len(names) == len({x for xs in want_sh for x in xs})


def test_slices_keep_all_rows_and_bound_the_text():
    texts = ["x" * n for n in (5, 0, 3, 50, 1, 1, 7)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = list(packed.slices(batch, "text", 10))
    assert [t for p, _, _ in parts for t in p.column("text").to_pylist()] == texts
    assert all(len(d) <= 10 or p.num_rows == 1 for p, d, _ in parts)


class _Captured:
    """Stands for a table whose ``mapInArrow`` hands out the function of a task."""

    def __init__(self, columns: str):
        self.schema = T._parse_datatype_string(columns)

    def mapInArrow(self, run, schema):
        return run


def test_hashed_words_of_a_task_take_bounded_memory(spark):
    # 6 MB of text in one batch; a slice of 2 MB took over 100 MB
    batch = pa.RecordBatch.from_arrays([pa.array([0] * 3000, pa.int64()), pa.array(["some words of text " * 110] * 3000)], names=["bag_key", "text"])
    wanted = SimpleNamespace(value=np.sort(packed.mix(np.arange(1000, dtype=np.uint64))))
    occurrences = contamination._occurrences(_Captured("bag_key long, text string"), wanted, 10, [5])
    for run, most in ((occurrences, 64), (neardup._bags(_Captured("bag_key long, text string")), 64)):
        packed.held("a task before")
        tracemalloc.start()
        assert sum(b.num_rows for b in run(iter([batch]))) == 3000
        peak = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        assert peak < most


def test_what_words_are_hashed_with_goes_with_another_operator():
    data, offs = np.full(1000, 97, np.uint8), np.array([0, 1000])
    packed.held("one")
    packed.words(data, offs)
    assert 1000 < len(packed._pow) <= 1 << 16
    before = packed.words(data, offs)[4]
    packed.held("other")
    assert len(packed._pow) == len(packed._inv) == 1
    assert (packed.words(data, offs)[4] == before).all()


# --- class bigrams


def brute_counts(docs):
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", low(t)) + [None] for i, t in docs}
    count = Counter()
    for i, w in tokens.items():
        if crc(i, 10):
            count.update(w)
    return tokens, count


@pytest.mark.parametrize("dictionary", [500_000, 300])
def test_op2_base_scores_and_counts(spark, sf_small, monkeypatch, dictionary):
    monkeypatch.setattr(brown, "DICTIONARY", dictionary)
    got = by_id(catalog.op2_brown_lm(spark, sf_small))
    tokens, count = brute_counts([(r["doc_id"], r["text"]) for r in documents(spark, sf_small).collect()])
    n, v = sum(count.values()), len(count)
    assert len(got) == len(tokens)
    for i, w in tokens.items():
        row = got[i]
        base = sum(math.log10((count[t] + 0.1) / (n + 0.1 * (v + 1))) for t in w)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(w), sum(count[t] > 0 for t in w), n)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        assert row["held_out"] == (crc(i, 10) == 0)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_brown_scores_are_the_models_probabilities(spark, sf_small):
    docs = documents(spark, sf_small).select("doc_id", "text")
    model, counts = brown.fit(docs.select("text"))
    assert counts.count() == model.distinct
    # transitions of each class sum to one
    assert np.allclose((10.0**model.log_trans).sum(axis=1), 1, atol=1e-6)
    # score of one text by hand, word by word
    text = docs.filter("doc_id = 7").first()["text"]
    data, offs = packed.text_bytes(pa.array([text]))
    h, u, rows = brown.tokens(data, offs)
    h, u, _ = brown._sequence(h, brown._units(h, u, model.own), rows)
    table = {r["word"]: r["n"] for r in counts.collect()}
    before, total = 0, 0.0
    for word, unit in zip(h.view(np.int64).tolist(), u.tolist(), strict=True):
        c = model.cls[unit]
        total += model.log_trans[before, c] + math.log10(table.get(word, 0) + 0.1) - model.log_size[c]
        before = c
    got = by_id(brown.score(docs, model, counts))[7]
    assert got["score"] == pytest.approx(total, rel=1e-9)


def test_exchange_finds_planted_classes():
    rng = np.random.default_rng(3)
    n, k = 61, 4
    truth = np.concatenate([[0], 1 + np.arange(n - 1) % k])
    chain = np.array([[0, 1, 0, 0, 0], [0, 0, 1, 0, 0], [0, 0, 0, 1, 0], [0, 0, 0, 0, 1], [0.2, 0.8, 0, 0, 0]])
    pairs = np.zeros((n, n))
    at = 0
    for _ in range(20_000):
        c = rng.choice(5, p=chain[truth[at]])
        new = 0 if c == 0 else rng.choice(np.flatnonzero(truth == c))
        pairs[at, new] += 1
        at = new
    found = brown.exchange(pairs, classes=k + 1)
    groups = defaultdict(Counter)
    for f, t in zip(found, truth, strict=True):
        groups[f][t] += 1
    assert sum(c.most_common(1)[0][1] for c in groups.values()) >= 0.9 * n


def test_words_beyond_the_units_are_classed_by_their_contexts(spark, monkeypatch):
    monkeypatch.setattr(brown, "OWN_UNITS", 40)
    rng = np.random.default_rng(5)
    # two kinds of words in turn; all have the same ending, so a spelling tells nothing
    kinds = [[f"{k}{i:03d}zz" for i in range(150)] for k in "ab"]
    docs = [(i, " ".join(str(rng.choice(kinds[j % 2])) for j in range(20))) for i in range(600)]
    model, _ = brown.fit(spark.createDataFrame(docs, "doc_id long, text string"))
    found = []
    for kind in kinds:
        data, offs = packed.text_bytes(pa.array([" ".join(kind)]))
        h, u, _ = brown.tokens(data, offs)
        place = brown._units(h, u, model.own)
        assert (place >= brown.UNITS).all()
        found.append(set(model.cls[place].tolist()))
    assert not found[0] & found[1]


@pytest.mark.parametrize("counts", [[(1 << 20) + i for i in range(600)], [1 << 21] * 600, [1 << 40, 1 << 30, 5, 5, 3], [7] * 3, []])
@pytest.mark.parametrize("most", [2, 4, 511, 1000])
def test_top_words_are_bounded_at_any_count(spark, counts, most):
    df = spark.createDataFrame([(i, 0, n) for i, n in enumerate(counts)], "word long, unit int, n long")
    top, least = brown._top(df, most)
    taken = [r["n"] for r in top.collect()]
    assert len(brown._sorted_pairs(brown._most_frequent(df, most), most)[0]) == min(most, len(counts))
    # all words from the least count that fits on
    want = [n for n in counts if sum(m >= n for m in counts) <= most]
    assert sorted(taken) == sorted(want) and all(n >= least for n in taken)


@pytest.mark.parametrize("dictionary", [40, 100, 900])
def test_scores_do_not_depend_on_the_dictionary(spark, monkeypatch, dictionary):
    """Words beyond the dictionary get their classes by the same contexts, and scores stay the same."""
    monkeypatch.setattr(brown, "OWN_UNITS", 30)
    rng = np.random.default_rng(2)
    names = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("ab", "ec", "id", "of", "ug", "yx", "aq", "ez")]
    weight = 1 / np.arange(1, len(names) + 1)
    texts = [" ".join(rng.choice(names, rng.integers(0, 60), p=weight / weight.sum())) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate([*texts, None, "unseenword", "bab unseen1 unseen2 dab"])), "doc_id long, text string").repartition(4)
    want = by_id(brown.scores(docs))
    monkeypatch.setattr(brown, "DICTIONARY", dictionary)
    got = by_id(brown.scores(docs))
    assert set(got) == set(want) == set(range(len(texts) + 3))
    for i, r in want.items():
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (r["n_tokens"], r["n_known"], r["train_tokens"])
        assert abs(got[i]["base_score"] - r["base_score"]) < 1e-9 * max(1, abs(r["base_score"]))
        assert abs(got[i]["score"] - r["score"]) < 1e-9 * max(1, abs(r["score"]))


def test_brown_edges(spark):
    edge = edge_docs(spark)
    found = brown.scores(edge)
    rows = found.collect()
    assert len(rows) == edge.count()
    empty = [r for r in rows if r["doc_id"] in (0, 1, 2)]
    assert {r["n_tokens"] for r in empty} == {1} and all(math.isfinite(r["score"]) for r in rows)
    assert brown.scores(empty_docs(spark)).count() == 0
    only_held_out = spark.createDataFrame([(i, "a b") for i in range(100) if crc(i, 10) == 0], "doc_id long, text string")
    assert {r["train_tokens"] for r in brown.scores(only_held_out).collect()} == {0}


# --- near-duplicates


def brute_classes(docs):
    bags = {}
    for i, t in docs:
        w = WORD.findall(low(t))
        bags[i] = Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()
    parent = {i: i for i in bags}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(bags)
    for a in ids:
        for b in ids:
            if a < b and bags[a] and bags[b]:
                x, y = bags[a], bags[b]
                if len(x.keys() & y.keys()) < 0.5 * max(len(x), len(y)):
                    continue
                j = sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())
                if j >= 0.8:
                    p, q = sorted((find(a), find(b)))
                    parent[q] = p
    return {i: find(i) for i in ids}


def test_op5_equals_brute_force(spark, sf_small):
    docs = [(r["doc_id"], r["text"]) for r in documents(spark, sf_small).collect()]
    got = catalog.op5_near_duplicates(spark, sf_small).collect()
    assert len(got) == len(docs)
    assert {r["doc_id"]: r["class_id"] for r in got} == brute_classes(docs)
    sizes = Counter(r["class_id"] for r in got)
    assert all(r["class_size"] == sizes[r["class_id"]] for r in got)
    assert sum(r["stays"] for r in got) == len(sizes)


def test_probability_jaccard_and_its_estimate():
    rng = np.random.default_rng(5)
    for share in (0.3, 0.6, 0.8, 0.95):
        x = np.unique(rng.integers(0, 1 << 47, 400).astype(np.uint64))
        y = np.unique(np.concatenate([x[: int(len(x) * share)], rng.integers(0, 1 << 47, 60).astype(np.uint64)]))
        wx, wy = rng.integers(1, 4, len(x)), rng.integers(1, 4, len(y))
        dx, dy = dict(zip(x.tolist(), wx.tolist(), strict=True)), dict(zip(y.tolist(), wy.tolist(), strict=True))
        both = dx.keys() & dy.keys()
        want = sum(1 / sum(max(dx.get(e, 0) / dx[d], dy.get(e, 0) / dy[d]) for e in dx.keys() | dy.keys()) for d in both)
        assert neardup.probability_jaccard(x, wx, y, wy) == pytest.approx(want)
        sig = neardup.signatures(np.concatenate([x, y]), np.concatenate([wx, wy]), np.array([0, len(x), len(x) + len(y)]), 2048)
        assert (sig[0] == sig[1]).mean() == pytest.approx(want, abs=0.05)


def test_near_copies_of_a_base_that_differ_among_themselves(spark, monkeypatch):
    """Each copy is near the base, while two copies are not near each other; blocks are tiny."""
    monkeypatch.setattr(neardup, "BLOCK", 3)
    base = [f"w{i}" for i in range(400)]
    docs = [(0, " ".join(base))]
    for k in range(1, 30):
        w = list(base)
        for j in range(6):
            w[(k * 13 + j * 61) % 400] = f"x{k}_{j}"
        docs.append((k, " ".join(w)))
    docs.append((99, " ".join(f"z{i}" for i in range(300))))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in neardup.report(df).collect()}
    assert got == brute_classes(docs)
    assert len(set(got.values())) == 2


def test_near_duplicate_edges(spark):
    edge = edge_docs(spark)
    rows = neardup.report(edge).collect()
    assert len(rows) == edge.count()
    assert {r["class_id"] for r in rows if r["doc_id"] in (6, 7)} == {6}
    assert all(r["stays"] for r in rows if r["doc_id"] in (0, 1, 2, None))
    kept = neardup.keep_one(edge)
    assert kept.columns == edge.columns and kept.count() == 9
    assert neardup.keep_one(empty_docs(spark)).count() == 0


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2)) if a != b] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        parent[q] = p
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: find(i) for i in parent}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_stars_take_no_round_of_components(spark, monkeypatch):
    import strideframe.llm.components as own

    rounds = []
    monkeypatch.setattr(own, "_large_star", lambda edges, f=own._large_star: rounds.append(1) or f(edges))
    stars = spark.createDataFrame([(1, 5), (6, 1), (2, 7), (1, 5)], "u long, v long")
    assert {tuple(r) for r in own.components(stars).collect()} == {(1, 1), (5, 1), (6, 1), (2, 2), (7, 2)}
    assert not rounds
    chain = spark.createDataFrame([(i, i + 1) for i in range(9)], "u long, v long")
    assert {tuple(r) for r in own.components(chain).collect()} == {(i, 0) for i in range(10)}
    with pytest.raises(RuntimeError):
        own.components(chain, most_rounds=1)


def test_links_inside_a_bucket_by_brute_force(monkeypatch):
    """Equal and uneven weights; a pair that shares several bands is compared in the first of them only."""
    rng = np.random.default_rng(5)
    monkeypatch.setattr(neardup, "LEAST_AGREE", 4)
    monkeypatch.setattr(neardup, "GATHERED", 64)
    core = np.sort(rng.choice(1 << 40, 30, replace=False).astype(np.uint64))
    bags, weights, sigs = [], [], []
    for i in range(24):
        bag = np.sort(np.concatenate([core, rng.choice(1 << 40, int(rng.integers(0, 9)), replace=False).astype(np.uint64)]))
        w = np.ones(len(bag), np.uint32) if i % 3 else rng.integers(1, 4 if i % 2 else 2, len(bag)).astype(np.uint32) + np.uint32(i % 6 == 3)
        sig = rng.integers(0, 1 << 32, neardup.REGISTERS).astype(np.uint32)
        sig[20:24] = 7  # all share band 5
        if i % 4 == 0:
            sig[8:12] = 9  # these share band 2 before
        bags.append(bag), weights.append(w), sigs.append(sig)
    n = len(bags)

    def table(band):
        packed_weights = [w.astype("<u4").tobytes() if (w > 1).any() else None for w in weights]
        ints = {"block": [0] * n, "band": [band] * n, "p": [0] * n, "q": [0] * n}
        cols = {k: pa.array(v, pa.int32()) for k, v in ints.items()} | {k: pa.array(range(n), pa.int64()) for k in ("rep", "component")}
        return pa.table(cols | {"signature": [x.tobytes() for x in sigs], "shingles": [x.tobytes() for x in bags], "weights": pa.array(packed_weights, pa.binary())})

    found = lambda t: {(t["rep"][i].as_py(), t["rep"][j].as_py()) for i, near in neardup._candidates(t) for j in near.tolist()}
    early = {(i, j) for i in range(0, n, 4) for j in range(i + 4, n, 4)}
    pairs = {2: found(table(2).take(pa.array(range(0, n, 4)))), 5: found(table(5))}
    assert pairs[2] == early
    assert pairs[5] == {(i, j) for i in range(n) for j in range(i + 1, n)} - early
    near = {p: neardup.probability_jaccard(bags[p[0]], weights[p[0]], bags[p[1]], weights[p[1]]) for p in pairs[5]}
    links = neardup._links_inside(table(5)).to_pylist()
    assert links and all(abs(r["similarity"] - near[r["u"], r["v"]]) < 1e-12 and r["similarity"] >= neardup.SIMILAR - 1e-12 for r in links)
    assert all({r["u"], r["v"]} == {r["a"], r["b"]} for r in links)
    want, got = ({i: i for i in range(n)} for _ in range(2))
    for label, edges in ((want, [p for p, x in near.items() if x >= neardup.SIMILAR]), (got, [(r["u"], r["v"]) for r in links])):
        for a, b in edges:
            label.update({k: label[a] for k, x in list(label.items()) if x == label[b]})
    same = lambda label: {(i, j) for i in range(n) for j in range(n) if label[i] == label[j]}
    assert same(want) == same(got)
    assert len(links) == n - len(set(want.values()))



# --- repeated passages


def test_op7_catches_long_passages(spark, sf_small):
    docs = {r["doc_id"]: r["text"] or "" for r in documents(spark, sf_small).collect()}
    got = by_id(catalog.op7_repeated_passages(spark, sf_small))
    assert len(got) == len(docs)
    windows = defaultdict(set)
    for i, t in docs.items():
        w = t.split()
        for k in range(len(w) - 59):
            if len(set(w[k : k + 60])) > 20:
                windows[tuple(w[k : k + 60])].add(i)
    shared = set().union(*(ids for ids in windows.values() if len(ids) > 1))
    assert shared and all(got[i]["has_repeats"] for i in shared)
    for i, r in got.items():
        assert r["n_chars"] == len(docs[i])
        for span in r["repeated"]:
            passage = docs[i][span["start"] : span["end"]]
            # each piece of a repeated passage stands in another document
            assert any(passage[k : k + 16] in t for k in (0, len(passage) - 16) for j, t in docs.items() if j != i)


def test_chunks_fall_into_step_after_an_insertion():
    rng = np.random.default_rng(2)
    text = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzé "), 5000))
    other = text[:100] + "INSERTED" + text[100:]

    def pieces(t):
        data, offs = packed.text_bytes(pa.array([t]))
        ends = chunks.cuts(data, offs)
        raw = data.tobytes()
        out = [raw[a:b].decode() for a, b in zip([0, *ends[:-1]], ends, strict=True)]  # no cut inside a character
        assert "".join(out) == t and max(len(x.encode()) for x in out) <= chunks.MOST + 3
        return out

    a, b = pieces(text), pieces(other)
    assert len(set(a) - set(b)) <= 4


def test_cut_repeats_and_edges(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(3000)]
    passage = " ".join(words[:120])
    docs = [(0, " ".join(words[200:300]) + " " + passage), (1, passage + " " + " ".join(words[400:500])), (2, " ".join(words[600:900])), (3, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = by_id(chunks.find_repeats(df))
    assert [bool(rows[i]["repeated"]) for i in range(4)] == [True, True, False, False]
    assert not rows[0]["removed"] and rows[1]["n_repeated"] > 0.8 * len(passage)
    cut = by_id(chunks.cut_repeats(df))
    assert cut[0]["text"] == docs[0][1] and cut[2]["text"] == docs[2][1] and cut[3]["text"] is None
    assert len(cut[1]["text"]) < len(docs[1][1]) - 0.8 * len(passage)
    edge = edge_docs(spark)
    assert chunks.find_repeats(edge).count() == chunks.cut_repeats(edge).count() == edge.count()
    assert chunks.cut_repeats(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("most", [4, 8])
def test_op7_catches_every_passage_of_51_words(spark, most):
    rng = np.random.default_rng(7)

    def text(n):
        return " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, most + 1))) for _ in range(n))

    passages = [text(51) for _ in range(150)]
    docs = [(2 * i + k, f"{text(40)} {p} {text(40)}") for i, p in enumerate(passages) for k in (0, 1)]
    # neighbours that share only 25 words
    docs += [(300 + i, f"{text(40)} {p} {text(40)}") for p, i in zip([x for x in (text(25) for _ in range(20)) for _ in (0, 1)], range(40), strict=True)]
    got = by_id(chunks.find_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)))
    for i, t in docs[:300]:
        start = t.index(passages[i // 2])
        whole = (start, start + len(passages[i // 2]))
        # the passage is reported but for the broken chunks at its ends, and cut from one of both
        assert sum(max(0, min(s["end"], whole[1]) - max(s["start"], whole[0])) for s in got[i]["repeated"]) >= min(len(passages[i // 2]) - 2 * chunks.REACH, 180)
        assert got[i]["repeated"]
    assert all(bool(got[2 * i]["removed"]) != bool(got[2 * i + 1]["removed"]) for i in range(150))
    if most == 4:
        assert not any(got[300 + i]["repeated"] for i in range(40))


# --- Lempel-Ziv fingerprints


def phrases(text):
    symbols = re.findall(r"[0-9A-Za-z]+|[^\x20\x09-\x0D]", text)
    found, i = set(), 0
    while i < len(symbols):
        j = i + 1
        while j <= len(symbols) and tuple(symbols[i:j]) in found:
            j += 1
        if j <= len(symbols):
            found.add(tuple(symbols[i:j]))
        i = j
    return found


@pytest.mark.parametrize("rows", [4000, 13])
def test_op8_edited_texts_and_likeness(spark, sf_small, monkeypatch, rows):
    monkeypatch.setattr(lzprint, "RANGE_ROWS", rows)
    got = by_id(catalog.op8_lz_fingerprints(spark, sf_small))
    docs = sorted(((r["doc_id"], r["text"] or "") for r in documents(spark, sf_small).collect()), reverse=True)
    assert len(got) == len(docs)
    errors = []
    for k, (i, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[1][:half]
        row = got[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for near, other in ((row["near_edited"], edited), (row["near_next"], following[1])):
            a, b = phrases(text), phrases(other)
            errors.append(abs(near - len(a & b) / max(1, len(a | b))))
            if len(a | b) <= lzprint.K:
                assert errors[-1] < 1e-12
    assert np.mean(errors) < 0.05
    by_text = defaultdict(set)
    for i, text in docs:
        by_text[text].add(got[i]["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())


def test_lz_edges(spark):
    rows = lzprint.compare_with_next(edge_docs(spark)).collect()
    assert len(rows) == len(EDGE_TEXTS) + 3
    assert {r["near_edited"] for r in rows if r["doc_id"] in (0, 1)} == {1.0}
    assert all(0 <= r["near_next"] <= 1 for r in rows)
    assert lzprint.compare_with_next(empty_docs(spark)).count() == 0
    one = lzprint.compare_with_next(spark.createDataFrame([(5, "a b c d e f")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert lzprint.fingerprint(edge_docs(spark)).count() == len(rows)


# --- toxicity


def plain_marginals(emit, trans, start):
    """One long chain, word by word."""
    a, b = np.zeros((len(emit), 2)), np.zeros((len(emit), 2))
    a[0] = [0, start + emit[0]]
    for t in range(1, len(emit)):
        a[t] = [np.logaddexp(a[t - 1, 0] + trans[0, y], a[t - 1, 1] + trans[1, y]) + y * emit[t] for y in range(2)]
    for t in range(len(emit) - 2, -1, -1):
        b[t] = [np.logaddexp(trans[y, 0] + b[t + 1, 0], trans[y, 1] + emit[t + 1] + b[t + 1, 1]) for y in range(2)]
    d = (a + b)[:, 1] - (a + b)[:, 0]
    return 1 / (1 + np.exp(-np.clip(d, -60, 60)))


def test_marginals_are_those_of_one_chain_for_each_text():
    rng = np.random.default_rng(1)
    for _ in range(15):
        sizes = rng.choice([0, 1, 5, 63, 64, 65, 127, 128, 129, 130, 400, 1000], size=rng.integers(1, 8))
        rows = np.concatenate([[0], np.cumsum(sizes)])
        emit, trans, start = rng.normal(size=rows[-1]) * 3, rng.normal(size=(2, 2)) * 2, float(rng.normal())
        got = toxicity.whole_text_marginals(emit, rows, trans, start)
        want = [plain_marginals(emit[a:b], trans, start) for a, b in zip(rows[:-1], rows[1:], strict=True) if b > a]
        assert len(got) == rows[-1] and (not want or np.abs(got - np.concatenate(want)).max() < 1e-9)


def test_likeness_of_texts_without_spaces():
    """Two texts of 1,000 Chinese characters that share their first half are alike; two others are not."""
    rng = np.random.default_rng(5)

    def text(n):
        return "".join(chr(c) for c in rng.choice(np.arange(0x4E00, 0x4E00 + 300), n))

    half = text(500)
    texts = [half + text(500), half + text(500), text(1000)]
    a, b, c = lzprint.sketches(*packed.text_bytes(pa.array(texts)))
    assert len(a) == lzprint.K and 0.2 < lzprint.likeness(a, b) < 0.9 and lzprint.likeness(a, c) < lzprint.likeness(a, b) - 0.1


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5):
        emit, trans, start = rng.normal(size=n), rng.normal(size=(2, 2)), float(rng.normal())
        total, want, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(2**n):
            y = [code >> k & 1 for k in range(n)]
            weight = math.exp(start * y[0] + sum(emit[k] * y[k] for k in range(n)) + sum(trans[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += weight
            want += weight * np.array(y)
            for a, b in zip(y, y[1:], strict=False):
                pairs[a, b] += weight
        got, got_pairs = toxicity.forward_backward(emit, np.array([0]), np.array([n]), trans, start)
        assert np.allclose(got, want / total) and np.allclose(got_pairs, pairs / total)


def test_op9_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = by_id(catalog.op9_toxic_spans(spark, sf))
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(r["predicted"], labels[i]) for i, r in got.items() if r["held_out"] and i in labels]
    assert all(r["held_out"] == (crc(i, 3) == 1) for i, r in got.items())
    assert sum(p for p, t in held if not t) <= 0.05 * sum(not t for _, t in held)
    assert np.mean([p == t for p, t in held]) > 0.9
    assert all((r["predicted"] == 1) == (r["score"] >= 0.7) for r in got.values())


def toxic_table(spark):
    rng = np.random.default_rng(9)
    vocabulary = ["".join(rng.choice(list("abcdefg"), 5)) for _ in range(200)]
    docs, labels = [], []
    for i in range(240):
        words = list(rng.choice(vocabulary, 30))
        toxic = i % 4 == 0
        if toxic:
            words[10:12] = [f"vile{rng.choice(['ly', 'st', 'ness'])}", "scum"]
        docs.append((i, " ".join(words)))
        if i % 5:
            labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict(docs)


def test_toxic_spans_are_the_planted_words(spark):
    docs, labels, texts = toxic_table(spark)
    rows = toxicity.predictions(docs, labels).collect()
    assert all(r["predicted"] == (r["doc_id"] % 4 == 0) for r in rows)
    for r in rows:
        cut = [texts[r["doc_id"]][s["start"] : s["end"]] for s in r["spans"]]
        assert all(w.startswith(("vile", "scum")) for c in cut for w in c.split())
        assert bool(cut) == (r["doc_id"] % 4 == 0)


def test_toxicity_edges(spark):
    docs, labels, _ = toxic_table(spark)
    field = toxicity.fit(docs, labels)
    edge = edge_docs(spark)
    rows = toxicity.score(edge, field).collect()
    assert len(rows) == edge.count() and all(0 <= r["tox_score"] < 0.7 for r in rows)
    assert toxicity.score(empty_docs(spark), field).count() == 0
    nothing = labels.limit(0)
    assert {r["score"] for r in toxicity.predictions(docs, nothing).collect()} == {0.0}


# --- language


def test_op10_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = by_id(catalog.op10_language(spark, sf))
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert len(got) == len(truth)
    held = [i for i, r in got.items() if r["held_out"]]
    assert all(r["held_out"] == (crc(i, 4) == 2) for i, r in got.items())
    assert np.mean([got[i]["lang_pred"] == truth[i] for i in held]) > 0.97
    assert np.mean([r["rejected"] for r in got.values()]) < 0.005


def test_language_edges(spark, sf_small):
    model = langid.fit(documents(spark, sf_small))
    texts = ["12345 !!! ...", "日本語", "привет мир как дела", "the of and to in", "É", None, ""]
    rows = by_id(langid.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model))
    assert [rows[i]["lang_pred"] == "und" for i in range(7)] == [True, False, False, False, False, True, True]
    assert rows[2]["lang_rejected"] and not rows[3]["lang_rejected"]
    assert all(0 <= r["lang_score"] <= 1 for r in rows.values())
    edge = edge_docs(spark)
    assert langid.identify(edge, model).count() == edge.count()
    assert langid.identify(empty_docs(spark), model).count() == 0
    assert langid.fit(empty_docs(spark)) is None
    assert {r["lang_pred"] for r in langid.identify(edge, None).collect()} == {"und"}
    assert langid.predictions(edge).count() == edge.count()


def plain_ngrams(text):
    """Counts of the 1 to 3 byte n-grams of lower-cased letters, words kept apart by one blank, by dimension."""
    low = text.encode().replace(b"\x20", b" ")
    raw = bytearray()
    previous = 0
    for b in low:
        c = b + 32 if 65 <= b <= 90 else b
        if previous == 0xC3 and 0x80 <= b <= 0x9E:
            c = b + 32
        previous = b
        raw.append(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20)
    out = Counter()
    for i in range(len(raw)):
        for n in (1, 2, 3):
            gram = bytes(raw[i : i + n])
            if len(gram) < n or b"  " in gram or gram == b" ":
                continue
            code = int.from_bytes(gram, "big")
            out[code if n == 1 else 256 + (((code + n * 0x1000000) * 0x9E3779B1 & 0xFFFFFFFF) >> 8) % (langid.DIMS - 256)] += 1
    return out


def test_language_by_plain_vectors(spark, sf_small):
    """Document frequencies, unit vectors and the nearest centroid, one text at a time."""
    docs = documents(spark, sf_small)
    model = langid.fit(docs)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(-1, "ÄÖÜ äöü straße"), (-2, "x"), (-3, "a  b\n\nc-d")]
    grams = {i: plain_ngrams(t) for i, t in rows}
    seen = Counter(d for i, _ in rows if i >= 0 for d in grams[i])
    n = sum(i >= 0 for i, _ in rows)
    idf = np.array([math.log((1 + n) / (1 + seen[d])) + 1 for d in range(langid.DIMS)])
    assert np.allclose(idf, model.idf)
    got = by_id(langid.identify(spark.createDataFrame(rows, "doc_id long, text string"), model))
    for i, _ in rows:
        v = np.zeros(langid.DIMS)
        for d, c in grams[i].items():
            v[d] = math.log1p(c) * idf[d]
        near = model.centres @ (v / np.linalg.norm(v))
        assert got[i]["lang_pred"] == model.langs[int(near.argmax())] and abs(got[i]["lang_score"] - near.max()) < 1e-4


def test_languages_left_out_and_random_letters_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").cache()
    rng = np.random.default_rng(1)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    salad = [(i, " ".join("".join(rng.choice(letters, rng.integers(2, 10))) for _ in range(int(rng.choice([20, 100, 500]))))) for i in range(100)]
    salad = spark.createDataFrame(salad, "doc_id long, text string")
    share = lambda df: df.agg(F.avg(F.col("lang_rejected").cast("double"))).first()[0]
    for lang in ("de", "en", "es", "fr"):
        model = langid.fit(docs.filter(F.col("lang") != lang))
        assert share(langid.identify(docs.filter(F.col("lang") == lang), model)) > 0.9
        assert share(langid.identify(docs.filter(F.col("lang") != lang), model)) < 0.01
        assert share(langid.identify(salad, model)) > 0.9


@pytest.mark.parametrize("trial", range(4))
def test_a_language_of_copies_keeps_its_centroid(spark, trial):
    french = f"le chat {trial} est sur la table et la lune est belle ce soir"
    rows = [(i, french, "fr") for i in range(400)]
    rows += [(1000 + i, f"the {i} dogs of number {i * 7} were running over these hills {trial}", "en") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, sample=20)
    assert set(model.langs) == {"en", "fr"}
    assert langid._sample(docs.select("text", "lang"), 10).groupBy("lang").count().orderBy("lang").collect() == [("en", 10), ("fr", 1)]
    assert by_id(langid.identify(docs, model))[0]["lang_pred"] == "fr"


def test_language_texts_are_cut_into_ngrams_once(spark):
    """Document frequencies come from the stored counts, with their copies; a slice's matrix stays in the cache."""
    texts = ["the cat", "the cat", "le chat", "12 34", "x" * 700, "Élan É"]
    docs = spark.createDataFrame([(t, "fr" if "l" in t else "en") for t in texts], "text string, lang string")
    rows = langid._packed(docs)
    assert rows.agg(F.sum("copies")).first()[0] == len(texts) - 1  # one has no n-gram
    want = Counter(d for t in texts for d in plain_ngrams(t))
    seen = langid._document_frequency(rows)
    assert {d: int(n) for d, n in enumerate(seen) if n} == want
    assert langid.COUNTED * langid.DIMS * 8 <= 4 << 20


def test_language_centroids_and_radii_come_from_all_texts(spark, monkeypatch):
    """A sample of two texts a language gives no other radii, and centroids as near to the texts, as one of all texts."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id % 3 = 0").cache()
    seen = []
    pieces = langid._pieces
    monkeypatch.setattr(langid, "_pieces", lambda *a: seen.append(pieces(*a).filter("number = 0").count()) or pieces(*a))
    models = [langid.fit(docs, sample=s, k=1) for s in (8, 4000)]
    assert seen[0] == seen[1] > docs.count() / 3
    assert models[0].langs == models[1].langs
    assert np.allclose(models[0].centres, models[1].centres, atol=1e-4)
    assert np.allclose(models[0].radius, models[1].radius, atol=1e-3)


def test_language_sample_reaches_the_driver_as_counts(spark):
    texts = [(" ".join(f"{w}{i}" for w in ("the", "old", "house", "by", "a", "river")) * (300 if i == 3 else 1), "en" if i % 2 else "fr") for i in range(30)]
    docs = spark.createDataFrame([*texts, ("123", "en")], "text string, lang string")
    sample = langid._sample(docs, 40)
    idf = np.linspace(1.0, 3.0, langid.DIMS)
    drawn = langid._drawn(sample)
    assert {name: b.num_rows for name, b in drawn.items()} == {"en": 15, "fr": 15}  # not the one without a letter
    assert all(b.nbytes < 1000 * b.num_rows for b in drawn.values())
    text = {(r["lang"], r["place"]): r["text"] for r in sample.collect()}
    for name, b in drawn.items():
        own = [text[key] for key in sorted(text) if key[0] == name and text[key] != "123"]
        vectors = langid.text_vectors(*packed.text_bytes(pa.array(own)), idf)
        assert (langid._unpacked(b, idf) == vectors).all()
        half = b.column("half").to_numpy() == 0
        (langs, centres), (_, first) = langid._starts({name: b}, idf, 4)
        assert langs == [name] * 4 and (centres == langid.spherical_kmeans(vectors, 4)[0]).all()
        assert (first == langid.spherical_kmeans(vectors[half], 4)[0]).all()


def test_chunks_move_with_one_number_for_their_place(spark, monkeypatch):
    """What moves for each chunk decides the disk; places and words of the densest chunks come back whole."""
    seen = []
    monkeypatch.setattr(chunks, "_spans", lambda df, f=chunks._spans: seen.append(df) or f(df))
    dense = "a b " * 200  # a word in two bytes
    rare = " ".join(f"w{i * 7919 % 100_000}" for i in range(400))
    docs = [(1, dense + rare), (2, rare + " x " + dense), (3, "é" * 700 + " nothing else")]
    got = by_id(chunks.find_repeats(spark.createDataFrame(docs, "doc_id long, text string")))
    assert seen[0].schema["found"].dataType.elementType.names == ["digest", "place", "first"]
    for i, text in docs[:2]:
        at = text.index(rare)
        assert any(s["start"] <= at + 80 and s["end"] >= at + len(rare) - 80 for s in got[i]["repeated"])
        assert all(0 <= s["start"] < s["end"] <= len(text) for s in got[i]["repeated"])
    assert got[3]["repeated"] == []
    data, offs = packed.text_bytes(pa.array([t for _, t in docs]))
    starts, ends, _, _ = chunks._digested(data, offs)
    assert (ends - starts).max() < 128
    base = chunks._chunked(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert max(w >> 12 for r in base for w in r["words_"]) < 64 and max(w >> 6 & 63 for r in base for w in r["words_"]) <= chunks.REACH // 2
