"""Lempel-Ziv phrase fingerprints of documents.

A text is parsed into dictionary phrases (LZ78 over its symbols, which
are runs of ASCII letters and digits and all other characters one by one: each
phrase is the longest earlier phrase and one more symbol).  The phrases' hashes
form a set; the fingerprint holds its ``K`` least 32-bit hashes in ascending
order, as hexadecimal text.  Two fingerprints are compared by the share of the
``K`` least hashes of their union that both hold, an estimate of the Jaccard
similarity of the phrase sets (exact for texts of few phrases).  Two texts
without phrases have likeness 1, one without and one with have 0.

``compare_with_next`` also parses each text with its second half replaced by
the start of the next text.  The next text is that of the following row by descending id (null ids last, ties
by the text's hash); after the last row comes the first.  Rows are dealt to ranges of
ids of bounded size, and each range also gets the first row of the range that
follows, so no task needs the whole order.

Null, empty and blank texts have no phrases; repeated rows follow each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strideframe.llm import packed
from strideframe.llm.stored import small_batches

K = 64
#: rows of a range, and the most ranges (range bounds are handed to all tasks)
RANGE_ROWS = 4000
MAX_RANGES = 20_000


#: bytes of ASCII words
_WORD = packed.WORD_BYTES.copy()
_WORD[0x80:] = False


def symbols(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the symbols of all rows, and the rows' offsets: runs of ASCII
    letters and digits, and every other character but ASCII white space."""
    word = _WORD[packed.LOWER[data]]
    starts, ends, _ = packed.spans(word, offs)
    head = (data & 0xC0) != 0x80
    single = np.flatnonzero(~word & head & packed.TOKEN_BYTES[data])
    heads = np.append(np.flatnonzero(head), len(data))
    after = heads[np.searchsorted(heads, single, "right")] if len(single) else single
    starts, ends = np.concatenate([starts, single]), np.concatenate([ends, after])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    return packed.hash_spans(data, starts, ends), np.searchsorted(starts, offs)


def phrase_ends(codes: list[int]) -> list[int]:
    """Ends of the phrases of one text, given the 40-bit codes of its symbols."""
    phrases: dict[int, int] = {}
    put = phrases.setdefault
    ends: list[int] = []
    node, fresh, at = 0, 1, 0
    for code in codes:
        at += 1
        node = put(node << 40 | code, fresh)
        if node == fresh:
            fresh += 1
            node = 0
            ends.append(at)
    return ends


def sketches(data: np.ndarray, offs: np.ndarray, k: int = K) -> list[np.ndarray]:
    """The least ``k`` phrase hashes of each text (uint32, ascending)."""
    hashes, rows = symbols(data, offs)
    n = len(offs) - 1
    codes = (hashes >> np.uint64(24)).tolist()
    bounds = rows.tolist()
    ends = [phrase_ends(codes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    sizes = np.array([len(e) for e in ends], np.int64)
    row = np.repeat(np.arange(n), sizes)
    if not len(row):
        return [np.zeros(0, np.uint32)] * n
    stop = np.concatenate([np.array(e, np.int64) for e in ends]) + rows[row]
    start = np.empty_like(stop)
    start[1:] = stop[:-1]
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    start[first] = rows[row[first]]
    least = packed.hash_runs(hashes, start, stop) >> np.uint64(32)
    keys = np.unique(row.astype(np.uint64) << np.uint64(32) | least)
    cuts = np.searchsorted(keys >> np.uint64(32), np.arange(n + 1, dtype=np.uint64)).tolist()
    least = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return [least[a : min(b, a + k)] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def likeness(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate([a, b])
    both.sort()
    twice = both[1:] == both[:-1]
    # the k least of the union: stop after k different values
    new = np.concatenate([[True], ~twice])
    last = int(np.searchsorted(np.cumsum(new), k, "right"))
    different = min(k, int(new.sum()))
    return float(twice[: max(last - 1, 0)].sum()) / different


def text_of(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of each text."""
    kept = small_batches(docs.drop(out) if out != text else docs)
    schema = kept.withColumn(out, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in packed.slices(batch, text):
                found = sketches(data, offs)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([text_of(s) for s in found], pa.string())], names=schema.names)

    return kept.mapInArrow(run, schema)


def _ranges(docs: DataFrame) -> tuple[list[int], dict[int, tuple[int, int | None]]]:
    """Lower bounds of the ids' ranges, and per non-empty range its successor and that one's greatest id."""
    n = docs.count()
    count = max(1, min(MAX_RANGES, n // RANGE_ROWS))
    cuts: list[int] = []
    if count > 1:
        shares = [i / count for i in range(1, count)]
        cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 20 * count)).first()[0] or []))
    heads = docs.groupBy(_range_of(cuts).alias("r")).agg(F.max("doc_id").alias("head")).collect()
    order = sorted(heads, key=lambda x: -x["r"])
    return cuts, {x["r"]: (order[(i + 1) % len(order)]["r"], order[(i + 1) % len(order)]["head"]) for i, x in enumerate(order)}


def _range_of(cuts: list[int]):
    """Number of the range of an id: 1 and up, 0 for null ids, which come last."""
    bounds = F.lit(cuts).cast("array<bigint>")
    # bounds are sorted: the number of bounds up to the id, found by binary search
    steps = [1 << i for i in range(len(cuts).bit_length(), -1, -1)]

    def narrow(at, step):
        return F.when((at + step <= len(cuts)) & (F.try_element_at(bounds, at + step) <= F.col("doc_id")), at + step).otherwise(at)

    at = F.aggregate(F.lit(steps).cast("array<int>"), F.lit(0), narrow).cast("long")
    return F.when(F.col("doc_id").isNull(), F.lit(0).cast("long")).otherwise(at + 1)


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_next(docs: DataFrame) -> DataFrame:
    """The result of ``op8`` for every row of ``docs`` (``doc_id``, ``text``)."""
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts, after = _ranges(docs.select("doc_id"))
    if not after:
        return docs.sparkSession.createDataFrame([], _OUT)
    dealt = docs.withColumn("range", _range_of(cuts)).withColumn("extra", F.lit(False))
    # the first row of the following range stands as an extra row at the end of each range
    previous = F.create_map(*[F.lit(x) for r, (nxt, _) in after.items() for x in (nxt, r)])
    order = F.xxhash64("text")
    ids = sorted({head for _, head in after.values() if head is not None})
    head_rows = dealt.filter(F.col("doc_id").isin(ids) | F.col("doc_id").isNull()) if len(ids) <= 10_000 else dealt.join(
        F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in ids], "doc_id long")), "doc_id", "left_semi"
    ).unionByName(dealt.filter(F.col("doc_id").isNull()))
    heads = head_rows.groupBy("range").agg(F.min_by(F.struct("doc_id", "text"), F.struct(order, "text")).alias("h"))
    extra = heads.select("h.doc_id", "h.text", previous[F.col("range")].alias("range"), F.lit(True).alias("extra"))
    by = Window.partitionBy("range").orderBy("extra", F.desc_nulls_last("doc_id"), order, "text")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next", F.lit(1), half))
    rows = dealt.unionByName(extra).withColumn("next", F.lead("text").over(by))
    rows = rows.select("doc_id", "extra", n.cast("long").alias("n_chars"), "text", F.when(~F.col("extra"), edited).otherwise("").alias("edited"))
    return rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).mapInArrow(_compare, _OUT)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order; an extra row only serves its predecessor, so one row is held back."""
    packed.held("lzprint")
    held = None  # (doc_id, n_chars, sha, sketch, edited sketch)
    for batch in batches:
        for part, data, offs in packed.slices(batch, "text"):
            own, new = sketches(data, offs), sketches(*packed.text_bytes(part.column("edited")))
            out = []
            ids, chars, digests, extras = (part.column(c).to_pylist() for c in ("doc_id", "n_chars", "edited_sha256", "extra"))
            for i, extra in enumerate(extras):
                if held is not None:
                    doc, n, sha, a, b = held
                    out.append((doc, n, sha, text_of(a), text_of(b), likeness(a, b), likeness(a, own[i])))
                held = None if extra else (ids[i], chars[i], digests[i], own[i], new[i])
            if out:
                kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
                cols = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
