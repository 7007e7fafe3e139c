"""Fill-in-middle, line dedup by runs, and token alignment against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_helpers import by_id, documents, edge_docs, empty_docs
from strideframe.llm import align, catalog, infill, lineruns


def sha(raw):
    return hashlib.sha256(raw if isinstance(raw, bytes) else raw.encode()).hexdigest()


# --- fill-in-middle


def units(text):
    return re.findall("[A-Za-z]+|[^A-Za-z]", text)


def brute_infill(doc_id, text):
    text = text or ""
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    u = units(text)
    a, b = sorted([h[0] % (len(u) + 1), h[1] % (len(u) + 1)])
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(u), "plain", None, None, sha(text), sha(text)
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return len(u), form, len(pre), len(mid), sha(out), sha(text)


ODD = ["<P> in text", "ends with <", "<S", "a<P", "<<>><<S", "é" * 500 + " x", "日本語 text 🙂 more", "\x00\n\r\t", "A" * 9000 + " " + "b c " * 4000]


def test_infill_equals_plain_cutting(spark, sf_small):
    docs = documents(spark, sf_small).select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(10_000 + 100 * i + k, t) for i, t in enumerate(ODD) for k in range(12)], docs.schema))
    got = infill.digests(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:] == brute_infill(r["doc_id"], texts[r["doc_id"]])
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB é🙂.,\n1日"), max_size=40), max_size=6))
def test_boundaries_of_packed_texts(texts):
    from strideframe.llm import packed

    offsets, rows = infill.boundaries(*packed.text_bytes(pa.array(texts, pa.string())))
    want = [np.cumsum([0] + [len(u) for u in units(t)]).tolist() for t in texts]
    assert [offsets[a:b].tolist() for a, b in zip(rows[:-1], rows[1:], strict=True)] == want


def curves():
    rng = random.Random(7)
    yield np.array([0])
    yield np.arange(100_000)
    yield np.cumsum([rng.choice([1, 1, 2, 9]) for _ in range(50_000)])
    yield np.cumsum([rng.choice([1, 5000]) for _ in range(3_000)])
    yield np.cumsum([1] * 4000 + [30] * 4000 + [1] * 4000)


@pytest.mark.parametrize("curve", list(curves()), ids=["one", "line", "words", "jumps", "bends"])
def test_every_segment_keeps_its_error_and_every_rank_is_exact(curve):
    starts, slopes = infill.fit_segments(curve)
    for a, b, k in zip(starts, [*starts[1:], len(curve)], slopes, strict=True):
        line = curve[a] + k * (np.arange(a, b) - a)
        assert np.abs(line - curve[a:b]).max() <= infill.ERROR + 1e-6
    index = infill.RankIndex.fit(curve, np.array([0, len(curve)]))
    assert index.residuals.dtype == np.int8
    assert (index.offset(np.zeros(len(curve), int), np.arange(len(curve))) == curve).all()
    # a segment ends only where no line through its start holds the next boundary too
    for a, b in zip(starts, starts[1:], strict=False):
        run = np.arange(1, b - a + 1)
        rise = curve[a + 1 : b + 1] - curve[a]
        assert ((rise - infill.ERROR) / run).max() > ((rise + infill.ERROR) / run).min()


def test_stored_index_gives_offsets(spark):
    text = "".join(random.Random(3).choice(["word ", "a ", "1", "é", "longerword"]) for _ in range(3000))
    docs = spark.createDataFrame([(1, text), (2, None), (3, "ab c")], "doc_id long, text string")
    n = {1: len(units(text)), 2: 0, 3: 3}
    indexed = infill.rank_index(docs)
    ranks = indexed.withColumn("rank", F.explode(F.lit([0, 1, 3, 500, 1777, n[1]])))
    for r in ranks.select("doc_id", "rank", infill.rank_offset(F.col("rank")).alias("at")).collect():
        whole = {1: text, 2: "", 3: "ab c"}[r["doc_id"]]
        if r["rank"] <= n[r["doc_id"]]:
            assert r["at"] == len("".join(units(whole)[: r["rank"]]))


def test_infill_edges(spark):
    docs = edge_docs(spark).withColumn("fim_n", F.lit("clash"))
    out = infill.transform(docs)
    assert out.count() == docs.count() and set(docs.columns) <= set(out.columns) and len(out.columns) == len(set(out.columns))
    for r in out.collect():
        want = brute_infill(r["doc_id"], r["text"])
        assert (r["fim_n"], r["fim_form"], r["fim_prefix_chars"], r["fim_middle_chars"]) == want[:4] and sha(r["fim_text"]) == want[4]
    assert infill.digests(empty_docs(spark)).count() == 0


# --- line dedup


def brute_lines(texts, min_docs=10):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    split = [(t or "").split("\n") for t in texts]
    found = Counter(k for ls in split for k in {key(x) for x in ls})
    gone = {k for k, n in found.items() if n >= min_docs and k}
    kept = [[x for x in ls if key(x) not in gone] for ls in split]
    return [(len(a), len(a) - len(b), "\n".join(b)) for a, b in zip(split, kept, strict=True)]


LINES = ["Common line", " common LINE\t", "é common", "É common", "", "  ", "rare one", "\x0bcommon line\x0c", "x", " common line", "日本"]


def some_texts(n, seed=1):
    rng = random.Random(seed)
    texts = ["\n".join(rng.choice(LINES + [f"own {i} {k}" for k in range(4)]) for _ in range(rng.randrange(0, 9))) for i in range(n)]
    return [*texts, None, "", "\n", "Common line"]


@pytest.mark.parametrize(("batches", "held"), [(4, 500_000), (1, 500_000), (7, 2), (3, 0)])
def test_lines_equal_plain_counting(spark, batches, held):
    texts = some_texts(60)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    out = by_id(lineruns.drop_repeated_lines(docs, min_docs=9, batches=batches, held=held))
    want = brute_lines(texts, 9)
    assert len(out) == len(texts)
    for i, r in out.items():
        assert (r["line_n"], r["line_dropped"], r["text"]) == want[i]
    assert any(w[1] for w in want)


def test_lines_over_the_whole_table(spark, sf_small):
    rows = documents(spark, sf_small).select("doc_id", "text").collect()
    want = dict(zip([r[0] for r in rows], brute_lines([r[1] for r in rows]), strict=True))
    for i, r in by_id(catalog.op12_line_dedup(spark, sf_small)).items():
        assert (r["n_lines"], r["n_dropped"], r["kept_sha256"]) == (want[i][0], want[i][1], sha(want[i][2]))


def test_runs_are_levelled_and_each_batch_leaves_out_what_is_settled(spark):
    runs = lineruns.LineRuns(spark, min_docs=3)

    def batch(*texts):
        return lineruns.line_counts(spark.createDataFrame([(t,) for t in texts], "text string"))

    def held():
        return [(level, {(r["h"], r["g"]): r["n"] for r in spark.table(name).collect()}) for level, name in runs.runs]

    a, b = (tuple(np.frombuffer(lineruns.digest(k), "<i8").tolist()) for k in (b"a", b"b"))
    runs.add(batch("a", "a\nb", "A\na"))
    assert held() == [(0, {a: 3, b: 1})]
    runs.add(batch("a\nb"))
    assert held() == [(1, {a: 3, b: 2})]  # a is settled: not counted any more
    runs.add(batch("b", "a"))
    assert held() == [(1, {a: 3, b: 2}), (0, {b: 1})]
    runs.add(batch("c"))
    assert [level for level, _ in held()] == [2]
    assert {(r["h"], r["g"]) for r in runs.frequent().collect()} == {a, b}
    plan = spark.table(runs.runs[0][1]).hint("merge").join(spark.table(runs.runs[0][1]), lineruns.HASH, "left_anti")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    runs.drop()


def test_line_edges(spark):
    docs = edge_docs(spark).withColumn("line_n", F.lit("clash")).withColumn("more", F.lit(1)).withColumn("h", F.lit(1))
    for held in (500_000, 0):
        out = lineruns.drop_repeated_lines(docs, min_docs=2, held=held)
        assert out.count() == docs.count() and set(docs.columns) <= set(out.columns)
        assert sorted(r["line_dropped"] for r in out.collect())[-4:] == [1, 1, 1, 1]  # the text that four rows hold
    assert lineruns.digests(empty_docs(spark)).count() == 0
    assert [tuple(r)[1:] for r in lineruns.digests(docs.filter("text is null")).collect()] == [(1, 0, sha(""))]


# --- token alignment


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.no_truncation()
    a.no_padding()
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def ends(sizes):
    return np.cumsum(sizes).tolist()


def brute_align(libraries, texts):
    a, b = libraries
    unit = align.byte_symbols()
    back = {s: k for k, s in unit.items()}
    docs = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        if not text:
            docs.append(([], [], [], ""))
            continue
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        raw_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            docs.append(([], [], [], ""))
            continue
        end_a, end_b = ends([len(x) for x in raw_a]), ends([len(x) for x in raw_b])
        both = sorted(set(end_a) & set(end_b))
        links = [(ids_a[end_a.index(e)], ids_b[end_b.index(e)]) for e in both]
        groups, p, q = [], 0, 0
        for e in both:
            i, j = end_a.index(e) + 1, end_b.index(e) + 1
            groups.append(",".join(map(str, ids_a[p:i])) + "|" + ",".join(map(str, ids_b[q:j])))
            p, q = i, j
        docs.append((ids_a, ids_b, links, ";".join(groups)))
    count = Counter(x for d in docs for x in d[2])
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for ids_a, ids_b, links, groups in docs:
        found = [len(ids_a), len(ids_b), len(links), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links)]
        out.append((*found, sha(groups) if groups else ""))
    return out


ALIGNED = [
    *[None, "", " ", "\n", "a", " a", "a ", "  two  spaces  ", "tab\tand\nline\n\nends\r\n", "a\n b\n\n  c \n", "don't it's we'LL", "1234567 89.01"],
    *["<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", "▁", "x ▁ y", "é à la   nbsp x", "日本語の テキスト　です", "🙂 emoji 🙂🙂", "\x00 \x7f \x85 x  y", "ﬁ ① Ⅷ"],
    *["word " * 300, "x" * 3000, " " * 400 + "y", "é combining ́ x"],
]


def check_alignment(spark, libraries, texts, held=align.HELD):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    paths = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    out = by_id(align.digests(docs, *paths, held=held))
    want = brute_align(libraries, texts)
    assert len(out) == len(texts)
    for i, r in out.items():
        assert tuple(r.values())[1:] == want[i], (texts[i] or "")[:50]


@pytest.mark.parametrize("held", [align.HELD, 5])
def test_alignment_of_odd_texts(spark, libraries, held):
    check_alignment(spark, libraries, ALIGNED + ALIGNED[4:], held)


def test_alignment_of_documents(spark, libraries, sf_small):
    check_alignment(spark, libraries, [(r["text"] or "")[:4000] for r in documents(spark, sf_small).orderBy("doc_id").limit(60).collect()])


def test_alignment_of_random_texts(spark, libraries):
    rng = random.Random(5)
    alphabet = "ab  \n\t.é日▁'s1🙂  "
    check_alignment(spark, libraries, ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(400)])


def test_alignment_edges(spark):
    paths = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    docs = edge_docs(spark).withColumn("align_n_a", F.lit("clash")).withColumn("align_row", F.lit(0))
    out = align.align(docs, *paths)
    assert out.count() == docs.count() and set(docs.columns) <= set(out.columns)
    shown = {r["text"]: r["align_groups"] for r in out.collect()}
    assert shown[None] == "" and shown["a"].count("|") == 1
    counts = align.pair_counts(out)
    for held in (align.HELD, 3):
        scored = align.link_scores(out, counts, held)
        assert scored.count() == docs.count() and "align_row" in scored.columns
    assert align.digests(empty_docs(spark), *paths).count() == 0
