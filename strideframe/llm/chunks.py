"""Substring deduplication by content-defined chunking with a gear rolling hash.

The gear hash of a place sums the random codes of the ``WINDOW`` bytes before
it, each shifted by its distance.  Of every ``SPREAD`` neighbouring places the
one with the least hash is a cut (the last of equal ones), so a cut depends on
the bytes around it only, and any ``REACH`` bytes that two texts share hold a
cut at the same place in both.  Of places with equal hashes that stand less
than ``LEAST`` bytes apart (texts that repeat themselves) the first is taken,
and pieces longer than ``MOST`` bytes are cut on.  Cuts never split a character.

Chunks are compared by a 64-bit digest, with their length, of the chunk and the
``WINDOW`` bytes before it (a chunk can be a single byte).  A chunk that occurs
in more than one document is repeated.  Repeated passages are

* runs of neighbouring repeated chunks of at least ``RUN_CHARS`` characters (a
  chunk is short, so a single one may recur by chance; a run of several does not),
* and all stretches of more than ``RUN_WORDS`` words that stand in two documents.
  A run of repeated chunks that is too short by itself, but could be part of
  such a stretch with the broken chunks at its ends, asks for its chunks: every
  window of ``RUN_WORDS + 1`` words around such a chunk is compared, in all
  texts that hold it.

A shared stretch of more than ``RUN_WORDS`` words is found if it has
``2 * SPREAD + WINDOW`` bytes (128) and does not repeat itself within
``LEAST`` bytes.  The passage stays in the first document that has it, by row
number, and is cut elsewhere.

Results for every row: ``n_chunks``, ``repeated`` (spans ``start, end`` in code
points, end exclusive), ``removed`` (the part of them that an earlier document
has), ``n_repeated`` (characters).  Null and empty texts have no chunks.
Copies of a whole text are passages that repeat.  Rows are told apart by their
number in the scan, so repeated and null ids keep their own rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.llm import packed
from strideframe.llm.stored import Scratch, small_batches, unused

WINDOW = 16
SPREAD = 56
REACH = WINDOW + SPREAD
LEAST = 16
MOST = 96
RUN_CHARS = 180
RUN_WORDS = 50
#: digests that a task holds while it looks for them (8 bytes each); more are looked for in further passes
ASKED = 1_000_000

_GEAR = (packed.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes that end at each byte, by doubling."""
    total = _GEAR[data]
    reach = 1
    while reach < WINDOW:
        moved = np.zeros_like(total)
        moved[reach:] = total[:-reach] << np.uint32(reach)
        total = total + moved
        reach *= 2
    return total


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    total, reach = keys, 1
    while 2 * reach <= width:
        total = np.minimum(total[:-reach], total[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(total[: len(total) - rest], total[rest:]) if rest else total


def cuts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """End positions of all chunks, ascending; every row's end is one (if the row is not empty)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    begins = np.ones(n + 1, bool)
    begins[:n] = (data & 0xC0) != 0x80
    place = np.zeros(0, np.int64)
    row_start = np.repeat(offs[:-1], np.diff(offs))
    if n >= SPREAD:
        # a place can be a cut if its window lies in the row and the next byte begins a character
        hashes = gear_hashes(data)
        keys = hashes.astype(np.uint64) << np.uint64(32) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
        keys[~begins[1:]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        least = _least(keys, SPREAD)
        m = len(least)
        inside = (row_start[:m] == row_start[SPREAD - 1 :]) & (np.arange(m) - row_start[:m] >= WINDOW - 1)
        least = least[inside & (least != np.uint64(0xFFFFFFFFFFFFFFFF))]
        place = (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype(np.int64)
        place = place[np.diff(place, prepend=-1) > 0]  # they ascend from window to window
        again = np.zeros(len(place), bool)
        again[1:] = (np.diff(place) < LEAST) & (hashes[place[1:]] == hashes[place[:-1]]) & (row_start[place[1:]] == row_start[place[:-1]])
        place = place[~again]
    ends = np.unique(np.concatenate([place + 1, offs[1:][np.diff(offs) > 0]]))
    # cut long pieces on
    starts = np.concatenate([[0], ends[:-1]])
    extra = (ends - starts - 1) // MOST
    if extra.any():
        base = np.repeat(starts, extra)
        k = np.arange(len(base)) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        more = base + k * MOST
        for _ in range(3):  # to the next character's begin
            more = np.where(begins[more], more, more + 1)
        ends = np.unique(np.concatenate([ends, more]))
    return ends


def _digested(data: np.ndarray, offs: np.ndarray):
    """``(starts, ends, digests, row offsets)`` of all chunks."""
    ends = cuts(data, offs)
    starts = np.concatenate([[0], ends[:-1]])[: len(ends)]
    rows = np.searchsorted(ends, offs, "right")
    begin = np.maximum(starts - WINDOW, np.repeat(offs[:-1], np.diff(rows)))
    digests = packed.hash_spans(data, begin, ends) + (ends - begin).astype(np.uint64)
    return starts, ends, digests, rows


def _text_digests(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    sizes = np.diff(offs).astype(np.uint64)
    return packed.hash_spans(data, offs[:-1], offs[1:]) + sizes if len(data) else sizes


def _chunked(docs: DataFrame) -> DataFrame:
    """Every row without its text, with ``n_chars``, the ``whole`` text's digest and arrays of chunk ``digests``, ``ends``
    (code points) and ``words`` (begins of words in the chunk, ``REACH`` bytes before it and after it, 6 bits each: at
    most one in two bytes)."""
    kept = docs.drop("text")
    names = kept.columns
    schema = T.StructType([*kept.schema.fields, *T._parse_datatype_string("chars_ long, whole_ long, digests_ array<long>, ends_ array<int>, words_ array<int>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed.held("chunks")
        for batch in batches:
            for part, data, offs in packed.slices(batch, "text"):
                starts, ends, digests, rows = _digested(data, offs)
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                owner = np.repeat(np.arange(part.num_rows), np.diff(rows))
                at = chars[ends] - chars[offs[owner]]
                seen = np.zeros(len(data) + 1, np.int64)
                seen[packed.spans(packed.TOKEN_BYTES[data], offs)[0] + 1] = 1
                seen = np.cumsum(seen)
                before = seen[starts] - seen[np.maximum(starts - REACH, offs[owner])]
                after = seen[np.minimum(ends + REACH, offs[owner + 1])] - seen[ends]
                words = (seen[ends] - seen[starts]) << 12 | before << 6 | after
                cols = [part.column(name) for name in names]
                cols.append(pa.array(chars[offs[1:]] - chars[offs[:-1]]))
                cols.append(pa.array(_text_digests(data, offs).view(np.int64)))
                cols.append(packed.list_column(digests.view(np.int64), rows, pa.int64()))
                cols.append(packed.list_column(at.astype(np.int32), rows, pa.int32()))
                cols.append(packed.list_column(words.astype(np.int32), rows, pa.int32()))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return docs.mapInArrow(run, schema)


def _windows(docs: DataFrame, asked) -> DataFrame:
    """Windows of ``RUN_WORDS + 1`` words around chunks with an asked digest: digests of the ``whole`` text and of
    the ``window``, ``start, end`` in code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed.held("chunks")
        keys = asked.value
        for batch in batches:
            for _, data, offs in packed.slices(batch, "text"):
                starts, ends, digests, _ = _digested(data, offs)
                at = np.minimum(np.searchsorted(keys, digests), len(keys) - 1)
                held = keys[at] == digests
                if not held.any():
                    continue
                first, last, rows = packed.spans(packed.TOKEN_BYTES[data], offs)
                # window i holds the words i to i + RUN_WORDS, if they stand in one row
                of = np.repeat(np.arange(len(offs) - 1), np.diff(rows))
                i = np.flatnonzero(of[: max(len(of) - RUN_WORDS, 0)] == of[RUN_WORDS:])
                a, b = first[i], last[i + RUN_WORDS]
                # the first asked chunk that begins at or after the window's begin ends in it
                c = np.searchsorted(starts[held], a)
                ok = c < held.sum()
                ok[ok] = ends[held][c[ok]] <= b[ok]
                i, a, b = i[ok], a[ok], b[ok]
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                origin = chars[offs[of[i]]]
                cols = [_text_digests(data, offs)[of[i]].view(np.int64), packed.hash_spans(data, a, b).view(np.int64)]
                cols += [(chars[a] - origin).astype(np.int32), (chars[b] - origin).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["whole", "window", "start", "end"])

    return docs.select("text").mapInArrow(run, "whole long, window long, start int, end int")


SPANS = "array<struct<start:int,end:int>>"


def _spans(df: DataFrame) -> DataFrame:
    """Turn each row's repeated chunks into ``repeated`` and ``removed`` spans, and the digests of the chunks in runs
    that are too short, but may be part of a stretch of more than ``RUN_WORDS`` words, as ``open``."""
    schema = T._parse_datatype_string(f"row_ long, repeated {SPANS}, removed {SPANS}, open array<long>")
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            repeated, removed, asked = [], [], []
            for found in batch.column("found").to_pylist():
                for x in found:
                    x["end"] = x["place"] >> 25
                    x["start"] = x["end"] - (x["place"] >> 18 & 127)
                found.sort(key=lambda x: x["start"])
                runs: list[list[dict]] = []
                for x in found:
                    if runs and runs[-1][-1]["end"] == x["start"]:
                        runs[-1].append(x)
                    else:
                        runs.append([x])
                spans, cut, digests = [], [], []
                for chunks in runs:
                    start, end = chunks[0]["start"], chunks[-1]["end"]
                    if end - start >= RUN_CHARS:
                        spans.append((start, end))
                        # of a repeated passage, the chunks that an earlier row has
                        cut += [(x["start"], x["end"]) for x in chunks if not x["first"]]
                    elif (chunks[0]["place"] >> 6 & 63) + sum(x["place"] >> 12 & 63 for x in chunks) + (chunks[-1]["place"] & 63) > RUN_WORDS:
                        digests += [x["digest"] for x in chunks]
                repeated.append(_union(spans))
                removed.append(_union(cut))
                asked.append(digests)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_"), pa.array(repeated, arrow), pa.array(removed, arrow), pa.array(asked, pa.list_(pa.int64()))], names=schema.names
            )

    return df.mapInArrow(run, schema)


def _union(spans: list[tuple[int, int]]) -> list[dict]:
    """Spans that meet or overlap as one."""
    out: list[dict] = []
    for start, end in sorted(spans):
        if out and out[-1]["end"] >= start:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"start": start, "end": end})
    return out


def _joined(df: DataFrame) -> DataFrame:
    """Add each row's repeated ``windows`` to its ``repeated`` and ``removed`` spans."""
    schema = T._parse_datatype_string(f"row_ long, repeated {SPANS}, removed {SPANS}")
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            repeated, removed = [], []
            for row in batch.to_pylist():
                for out, name, new in ((repeated, "repeated", row["windows"]), (removed, "removed", [x for x in row["windows"] or [] if x["first"] < row["row_"]])):
                    out.append(_union([(x["start"], x["end"]) for x in [*(row[name] or []), *(new or [])]]))
            yield pa.RecordBatch.from_arrays([batch.column("row_"), pa.array(repeated, arrow), pa.array(removed, arrow)], names=schema.names)

    return df.mapInArrow(run, schema)


def _repeated_windows(docs: DataFrame, base: DataFrame, spans: DataFrame, store: Scratch) -> DataFrame | None:
    """``whole`` and its ``windows`` (``start, end, first``: the first row that has the window) that stand in two rows."""
    spark = docs.sparkSession
    asked = store.write(spans.select(F.explode("open").alias("digest")).distinct(), "asked")
    passes = -(-asked.count() // ASKED)
    if not passes:
        return None
    part = F.pmod(F.xxhash64("digest"), F.lit(passes))
    found = None
    for k in range(passes):
        keys = np.sort(asked.filter(part == k).toPandas()["digest"].to_numpy(np.int64).view(np.uint64))
        if len(keys):
            new = _windows(docs, spark.sparkContext.broadcast(keys))
            found = new if found is None else found.unionAll(new)
    found = store.write(found.distinct(), "windows")
    texts = base.groupBy(F.col("whole_").alias("whole")).agg(F.min("row_").alias("row"), F.count("*").alias("n"))
    seen = found.select("whole", "window").distinct().join(texts, "whole").groupBy("window").agg(F.min("row").alias("first"), F.sum("n").alias("n"))
    kept = found.join(seen.filter("n > 1").select("window", "first"), "window")
    return store.write(kept.groupBy("whole").agg(F.collect_list(F.struct("start", "end", "first")).alias("windows")), "repeated-windows")


def find_repeats(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` without its text, with ``n_chars, n_chunks, n_repeated, repeated, removed``.

    Columns of those names are replaced.
    """
    store = Scratch(small_batches(docs).sparkSession, "chunks")
    added = ("n_chars", "n_chunks", "n_repeated", "repeated", "removed", "row_", "chars_", "whole_", "digests_", "ends_", "words_", "found")
    kept = docs.drop(*[c for c in docs.columns if c.lower() in added])
    keys = [c for c in kept.columns if c != "text"]
    base = store.write(_chunked(kept.withColumn("row_", F.monotonically_increasing_id())), "chunked")
    chunk = base.select("row_", F.posexplode("digests_").alias("k", "digest"))
    repeated = chunk.groupBy("digest").agg(F.min("row_").alias("first"), F.max("row_").alias("last")).filter("first <> last").select("digest", "first")
    zipped = F.arrays_zip(F.col("digests_").alias("digest"), F.col("ends_").alias("end"), F.array_insert("ends_", 1, F.lit(0)).alias("start"), F.col("words_").alias("words"))
    # end, length (below 128) and words as one number: every chunk moves once, and what it takes in the shuffle is on disk
    end, length = F.col("end").cast("long"), (F.col("end") - F.col("start")).cast("long")
    place = F.shiftleft(end, 25).bitwiseOR(F.shiftleft(length, 18)).bitwiseOR(F.col("words")).alias("place")
    placed = base.select("row_", F.inline(zipped)).filter("digest is not null").select("row_", "digest", place)
    hit = F.struct("digest", "place", (F.col("row_") == F.col("first")).alias("first"))
    hits = placed.join(repeated, "digest").select("row_", hit.alias("x"))
    spans = store.write(_spans(hits.groupBy("row_").agg(F.collect_list("x").alias("found"))), "runs")
    windows = _repeated_windows(kept, base, spans, store)
    if windows is None:
        spans = spans.drop("open")
    else:
        further = base.select("row_", F.col("whole_").alias("whole")).join(windows, "whole").drop("whole")
        spans = _joined(spans.drop("open").join(further, "row_", "full"))
    none = F.array().cast(SPANS)
    length = F.aggregate("repeated", F.lit(0).cast("long"), lambda acc, s: acc + (s["end"] - s["start"]))
    out = (
        base.select(*keys, "row_", F.col("chars_").alias("n_chars"), F.size("digests_").cast("long").alias("n_chunks"))
        .join(spans, "row_", "left")
        .withColumns({"repeated": F.coalesce("repeated", none), "removed": F.coalesce("removed", none)})
        .withColumn("n_repeated", length)
    )
    out = store.write(out.select(*keys, "row_", "n_chars", "n_chunks", "n_repeated", "repeated", "removed"), "repeats")
    store.drop(keep=("repeats",))
    return out


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut from all but the first document that has them."""
    store = Scratch(docs.sparkSession, "cut-repeats")
    number = unused("number", docs)
    numbered = store.write(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = find_repeats(numbered.select(number, "text")).filter("size(removed) > 0").select(number, F.col("removed").alias(number + "_cut"))

    def add(acc: Column, s: Column) -> Column:
        head = F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]))
        return F.struct(head.alias("out"), s["end"].alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    cut = F.aggregate(number + "_cut", start, add, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    joined = numbered.join(found, number, "left")
    return joined.withColumn("text", F.when(F.col(number + "_cut").isNull(), F.col("text")).otherwise(cut)).select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """The result of ``op7``: chunks, repeated characters and passages of every document."""
    found = find_repeats(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_chars", "n_chunks", "n_repeated", (F.size("repeated") > 0).alias("has_repeats"), "repeated", "removed")
