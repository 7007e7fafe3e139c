"""Toxic spans by a linear-chain conditional random field.

Two labels, plain and toxic, over all words of a text.  The emission of a word
is the sum of hashed feature weights: the word and its first 4, 5 and 6 bytes.
Forward-backward over the whole text gives each word's marginal probability of
being toxic: blocks of ``CHAIN`` words are summed up as 2 x 2 matrices first, a
pass over the blocks of each text carries the messages from block to block, and
the words inside all blocks follow in parallel.  A document's score is a
calibrated function of its greatest marginal and of the sum of its marginals;
its offending spans are the runs of words whose marginal is at least
``SPAN_MARGINAL``.

Learning needs labelled words, while ``labels.toxic`` marks documents.  Words
are therefore labelled first: a feature that at least ``MIN_DOCS`` training
documents hold, nearly all of them toxic (lower confidence bound at least
``INDICATOR_SHARE``), marks its words in toxic documents as toxic.  The field
is fitted to those labels in stretches of ``CHAIN`` words (those with a toxic
word, and others), and the calibration to the documents' labels.  All
of this uses a bounded sample of the training rows: at most ``SAMPLE``
documents of each class with at most ``SAMPLE_CHARS`` characters, by the least
hash of their text.

Results: ``tox_score`` (0 to 1; null, empty and word-less texts have the score
of a text without a toxic word) and ``tox_spans``, an array of ``start, end``
(code points, end exclusive) and the greatest marginal inside.  Without labels
of both classes every score is 0.  Scoring is row-wise and reads whole texts:
repeated rows, null ids and further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.llm import packed
from strideframe.llm.langid import remainder
from strideframe.llm.stored import small_batches

CHAIN = 64
#: bounds of the sample that is learned from: documents of a class, characters of one
SAMPLE = 2000
SAMPLE_CHARS = 30_000
MIN_DOCS = 8
INDICATOR_SHARE = 0.6
SPAN_MARGINAL = 0.5
FEATURE_BITS = 20
PREFIXES = (4, 5, 6)
EPOCHS = 6


def features(data: np.ndarray, offs: np.ndarray):
    """``(hashes of shape (features, words), starts, ends, row offsets)`` of the lower-cased words."""
    low, starts, ends, rows, whole = packed.words(data, offs)
    out = np.empty((1 + len(PREFIXES), len(starts)), np.uint64)
    out[0] = whole
    n = len(low)
    if n:
        powers, inverse = packed._powers(n + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(packed._BYTE_CODE[low] * powers[:n], dtype=np.uint64)])
        for k, size in enumerate(PREFIXES, 1):
            cut = np.minimum(starts + size, ends)
            out[k] = packed.mix((sums[cut] - sums[starts]) * inverse[starts] + np.uint64(k))
    return out, starts, ends, rows


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.int32)


def chains(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of each chain (no chain crosses a row)."""
    counts = np.diff(rows)
    per = -(-counts // CHAIN)
    total = int(per.sum())
    owner = np.repeat(np.arange(len(counts)), per)
    k = np.arange(total) - np.repeat(np.cumsum(per) - per, per)
    first = rows[owner] + k * CHAIN
    return first, np.minimum(CHAIN, rows[owner + 1] - first)


def _log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def block_matrices(emit: np.ndarray, first: np.ndarray, size: np.ndarray, trans: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Log-sum over the labels of each block by (label before the block, label of its last word), shape (blocks, 2, 2).

    With ``start``, the scores of the first word's labels, what stands before plays no part.
    """
    order = np.argsort(-size, kind="stable")
    f, s = first[order], size[order]
    out = np.zeros((len(f), 2, 2))
    for a in range(2):
        enter = trans[a] if start is None else start
        x0, x1 = np.full(len(f), enter[0]), enter[1] + emit[f]
        for t in range(1, int(s[0]) if len(s) else 0):
            m = int(np.searchsorted(-s, -t, "left"))
            p0, p1 = x0[:m].copy(), x1[:m].copy()
            x0[:m] = _log_add(p0 + trans[0, 0], p1 + trans[1, 0])
            x1[:m] = _log_add(p0 + trans[0, 1], p1 + trans[1, 1]) + emit[f[:m] + t]
        out[order, a, 0], out[order, a, 1] = x0, x1
    return out


def whole_text_marginals(emit: np.ndarray, rows: np.ndarray, trans: np.ndarray, start: float) -> np.ndarray:
    """Marginals of the toxic label for each word, one chain a row."""
    first, size = chains(rows)
    if not len(first):
        return np.zeros(0)
    blocks = -(-np.diff(rows) // CHAIN)
    lead = np.cumsum(blocks) - blocks
    heads = np.zeros(len(first), bool)
    heads[lead[blocks > 0]] = True
    matrix = block_matrices(emit, first, size, trans)
    # no label stands before a text's first block: it has the start score instead of a transition
    matrix[heads] = block_matrices(emit, first[heads], size[heads], trans, np.array([0.0, start]))
    head, tail = np.zeros((len(first), 2)), np.zeros((len(first), 2))
    head[heads] = np.column_stack([np.zeros(heads.sum()), start + emit[first[heads]]])
    order = np.argsort(-blocks, kind="stable")
    most = int(blocks.max())
    alive = [int(np.searchsorted(-blocks[order], -k, "left")) for k in range(most + 1)]
    message = None
    for k in range(most):
        at = lead[order[: alive[k]]] + k
        if k:
            v = message[: alive[k]]
            for b in range(2):
                head[at, b] = _log_add(v[:, 0] + trans[0, b], v[:, 1] + trans[1, b])
            head[at, 1] += emit[first[at]]
            message = np.column_stack([_log_add(v[:, 0] + matrix[at, 0, b], v[:, 1] + matrix[at, 1, b]) for b in range(2)])
        else:
            message = matrix[at, 0]
        message = message - message.max(axis=1, keepdims=True)
    for k in range(most - 2, -1, -1):
        at = lead[order[: alive[k + 1]]] + k
        nxt = at + 1
        back = np.column_stack([_log_add(matrix[nxt, a, 0] + tail[nxt, 0], matrix[nxt, a, 1] + tail[nxt, 1]) for a in range(2)])
        tail[at] = back - back.max(axis=1, keepdims=True)
    return forward_backward(emit, first, size, trans, start, head, tail)[0]


def forward_backward(
    emit: np.ndarray, first: np.ndarray, size: np.ndarray, trans: np.ndarray, start: float, head: np.ndarray | None = None, tail: np.ndarray | None = None
):
    """Marginals of the toxic label for each word, and the pair marginals summed by transition.

    ``emit`` holds the toxic label's score of each word (the plain label's is 0);
    ``trans[a, b]`` is the score of label ``b`` after ``a``; chains run in parallel.
    Chains that are blocks of a longer one get ``head``, the scores of their first
    word's labels from the left, and ``tail``, those of their last word's from the right.
    """
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    head = None if head is None else head[order]
    tail = np.zeros((len(size), 2)) if tail is None else tail[order]
    out = np.zeros(len(emit))
    pairs = np.zeros((2, 2))
    if not len(size):
        return out, pairs
    steps = int(size[0])
    alive = np.searchsorted(-size, -np.arange(steps), "left")  # chains longer than t
    a0, a1 = [None] * steps, [None] * steps
    for t in range(steps):
        m = alive[t]
        e = emit[first[:m] + t]
        if t == 0:
            a0[t], a1[t] = (np.zeros(m), start + e) if head is None else (head[:m, 0], head[:m, 1])
        else:
            p0, p1 = a0[t - 1][:m], a1[t - 1][:m]
            a0[t] = _log_add(p0 + trans[0, 0], p1 + trans[1, 0])
            a1[t] = _log_add(p0 + trans[0, 1], p1 + trans[1, 1]) + e
    b0, b1 = tail[: alive[-1], 0], tail[: alive[-1], 1]
    for t in range(steps - 1, -1, -1):
        m = alive[t]
        if len(b0) < m:
            ended = tail[len(b0) : m]
            b0, b1 = np.concatenate([b0, ended[:, 0]]), np.concatenate([b1, ended[:, 1]])
        diff = (a1[t] + b1) - (a0[t] + b0)
        out[first[:m] + t] = 1.0 / (1.0 + np.exp(-np.clip(diff, -60, 60)))
        if t:
            e = emit[first[:m] + t]
            p0, p1 = a0[t - 1][:m], a1[t - 1][:m]
            z = _log_add(a0[t] + b0, a1[t] + b1)
            parts = (p0 + trans[0, 0] + b0, p0 + trans[0, 1] + e + b1, p1 + trans[1, 0] + b0, p1 + trans[1, 1] + e + b1)
            for k, part in enumerate(parts):
                pairs[k // 2, k % 2] += np.exp(part - z).sum()
            b0, b1 = _log_add(parts[0] - p0, parts[1] - p0), _log_add(parts[2] - p1, parts[3] - p1)
    return out, pairs


@dataclass
class Field:
    weights: np.ndarray
    trans: np.ndarray
    start: float
    calibration: np.ndarray

    def marginals(self, hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        emit = self.weights[_slots(hashes)].sum(axis=0).astype(float) if hashes.shape[1] else np.zeros(0)
        return whole_text_marginals(emit, rows, self.trans, self.start)


def document_features(marginal: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Per row: 1, the logit of the greatest marginal, the log of one plus the sum of marginals."""
    n = len(rows) - 1
    top, total = np.zeros(n), np.zeros(n)
    full = np.flatnonzero(np.diff(rows))
    if len(full):
        top[full] = np.maximum.reduceat(marginal, rows[full])
        total[full] = np.add.reduceat(marginal, rows[full])
    top = np.clip(top, 1e-4, 1 - 1e-4)
    return np.column_stack([np.ones(n), np.log(top / (1 - top)), np.log1p(total)])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (y - p)) - ridge * np.r_[0, beta[1:]]
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.diag(np.r_[1e-6, np.ones(len(beta) - 1)])
        step = np.linalg.solve(hess, grad)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def word_labels(hashes: np.ndarray, rows: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Toxic words of toxic rows, by features that almost only toxic rows hold."""
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    out = np.zeros(hashes.shape[1], bool)
    n_rows = np.array([(~toxic).sum(), toxic.sum()], float)
    for h in hashes:
        values, code = np.unique(h, return_inverse=True)
        once = np.unique(code.astype(np.int64) * len(rows) + row)
        code_of, row_of = once // len(rows), once % len(rows)
        t = np.bincount(code_of[toxic[row_of]], minlength=len(values)).astype(float)
        n = np.bincount(code_of, minlength=len(values)).astype(float)
        # as if both classes had equally many rows; Wilson's lower bound
        share = (t / n_rows[1]) / np.maximum(t / n_rows[1] + (n - t) / n_rows[0], 1e-12)
        z2 = 1.96**2
        low = (share + z2 / (2 * n) - 1.96 * np.sqrt(share * (1 - share) / n + z2 / (4 * n * n))) / (1 + z2 / n)
        marks = (low >= INDICATOR_SHARE) & (n >= MIN_DOCS) & (share >= 0.95)
        out |= marks[code]
    return out & toxic[row]


def fit_field(data: np.ndarray, offs: np.ndarray, toxic: np.ndarray, positive_share: float) -> Field:
    """Fit to the packed texts of the sample; ``positive_share`` is the share of toxic training rows."""
    hashes, _, _, rows = features(data, offs)
    labels = word_labels(hashes, rows, toxic)
    slots = _slots(hashes)
    first, size = chains(rows)
    has = np.add.reduceat(labels.astype(np.int64), first) > 0 if len(first) else np.zeros(0, bool)
    # chains with a toxic word, and as many again (twice) spread over the others
    others = np.flatnonzero(~has)
    others = others[:: max(1, len(others) // max(2 * int(has.sum()), 500))]
    use = np.concatenate([np.flatnonzero(has), others])
    first, size = first[use], size[use]
    weights = np.zeros(1 << FEATURE_BITS)
    scale = np.full(1 << FEATURE_BITS, 1e-2)
    trans, start = np.array([[1.0, -1.0], [1.0, -1.0]]), -2.0
    t_scale = np.full(5, 1e-2)
    parts = np.array_split(np.arange(len(use)), max(1, len(use) // 256))
    stride = max(1, len(parts))
    groups = [np.arange(k, len(use), stride) for k in range(stride)]
    for _ in range(EPOCHS):
        for g in groups:
            f, s = first[g], size[g]
            at = np.concatenate([[0], np.cumsum(s)])
            word = np.repeat(f - at[:-1], s) + np.arange(at[-1])
            local = slots[:, word]
            emit = weights[local].sum(axis=0)
            marginal, pairs = forward_backward(emit, at[:-1], s, trans, start)
            truth = labels[word]
            want = np.zeros((2, 2))
            inside = np.ones(len(word), bool)
            inside[at[1:] - 1] = False
            j = np.flatnonzero(inside)
            np.add.at(want, (truth[j].astype(int), truth[j + 1].astype(int)), 1)
            # AdaGrad on the log-likelihood with a small ridge
            delta = truth - marginal
            grad = np.bincount(local.ravel(), np.tile(delta, len(local)), minlength=len(weights)) - 1e-3 * weights
            scale += grad * grad
            weights += 0.5 * grad / np.sqrt(scale)
            t_grad = np.r_[(want - pairs).ravel(), delta[at[:-1]].sum()]
            t_scale += t_grad * t_grad
            step = 0.2 * t_grad / np.sqrt(t_scale)
            trans = trans + step[:4].reshape(2, 2)
            start += float(step[4])
    field = Field(weights.astype(np.float32), trans, start, np.zeros(3))
    x = document_features(field.marginals(hashes, rows), rows)
    share = toxic.mean()
    weight = np.where(toxic, positive_share / share, (1 - positive_share) / (1 - share))
    field.calibration = _logistic(x, toxic.astype(float), weight)
    return field


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field | None:
    """Learn from documents and their labels (joined by ``doc_id``); None unless both classes occur.

    A document with several labels counts as toxic if one of them says so.
    """
    marks = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.groupBy("doc_id").agg((F.max(F.col("toxic").cast("int")) == 1).alias("toxic"))
    sizes = {r[0]: r[1] for r in marks.groupBy("toxic").agg(F.count("*")).collect()}
    if len(sizes) < 2:
        return None
    # a uniform draw bounds the labels before the join with the texts
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    share = {c: min(1.0, sample / n) for c, n in sizes.items()}
    drawn = marks.filter(draw < F.when(F.col("toxic"), share[True]).otherwise(share[False]))
    if sum(sizes[c] * share[c] for c in sizes) <= 4 * sample:
        drawn = F.broadcast(drawn)
    texts = docs.select("doc_id", "text").filter(F.length("text") <= SAMPLE_CHARS).join(drawn, "doc_id")
    rows = sorted(texts.select(F.xxhash64("text"), "text", "toxic").toLocalIterator(), key=lambda r: (r[0], r[2]))
    picked, seen = [], {True: 0, False: 0}
    for _, text, toxic in rows:
        if seen[toxic] < sample:
            seen[toxic] += 1
            picked.append((text, toxic))
    if not all(seen.values()):
        return None
    data, offs = packed.text_bytes(pa.array([t for t, _ in picked], pa.large_string()))
    return fit_field(data, offs, np.array([t for _, t in picked]), sizes[True] / sum(sizes.values()))


SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("marginal", T.DoubleType())])
ADDED = ("tox_score", "tox_spans")


def score(docs: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """Add ``tox_score`` and ``tox_spans``; columns of those names are replaced."""
    kept = small_batches(docs).drop(*[c for c in docs.columns if c.lower() in ADDED])
    schema = T.StructType([*kept.schema.fields, T.StructField("tox_score", T.DoubleType()), T.StructField("tox_spans", T.ArrayType(SPAN))])
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed.held("toxicity")
        model = shared.value
        for batch in batches:
            for part, data, offs in packed.slices(batch, text):
                spans: list[list[dict]] = [[] for _ in range(part.num_rows)]
                if model is None:
                    points = np.zeros(part.num_rows)
                else:
                    hashes, starts, ends, rows = features(data, offs)
                    marginal = model.marginals(hashes, rows)
                    points = 1 / (1 + np.exp(-np.clip(document_features(marginal, rows) @ model.calibration, -30, 30)))
                    if len(hits := np.flatnonzero(marginal >= SPAN_MARGINAL)):
                        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                        owner = np.searchsorted(rows, hits, "right") - 1
                        new = np.ones(len(hits), bool)
                        new[1:] = (np.diff(hits) > 1) | (np.diff(owner) > 0)
                        cuts = np.flatnonzero(new)
                        last = np.append(cuts[1:], len(hits)) - 1
                        top = np.maximum.reduceat(marginal[hits], cuts)
                        base = chars[offs[owner[cuts]]]
                        begin, end = chars[starts[hits[cuts]]] - base, chars[ends[hits[last]]] - base
                        for d, a, b, p in zip(owner[cuts].tolist(), begin.tolist(), end.tolist(), top.tolist(), strict=True):
                            spans[d].append({"start": a, "end": b, "marginal": p})
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(points, pa.float64()), pa.array(spans, arrow)], names=schema.names)

    return kept.mapInArrow(run, schema)


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The result of ``op9``: learn where the id's remainder modulo 3 is not 1, score every row."""
    part = remainder("doc_id", 3)
    field = fit(docs.filter(part != 1), labels.filter(part != 1))
    found = score(docs.select("doc_id", "text"), field)
    return found.select(
        "doc_id",
        F.coalesce(part == 1, F.lit(False)).alias("held_out"),
        F.col("tox_score").alias("score"),
        (F.col("tox_score") >= threshold).cast("int").alias("predicted"),
        F.col("tox_spans").alias("spans"),
    )
