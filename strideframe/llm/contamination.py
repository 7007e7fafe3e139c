"""Benchmark decontamination as a prefix-filtered set join.

A window of a benchmark item is ``window`` consecutive words (an item of fewer
words, but not none, is one window).  As a set a window holds its
``shingle``-word shingles; a document contains the window when all of them
occur one after the other.  Since all must occur, the necessary prefix of a
window, with its shingles ordered by rarity over all documents, is its rarest
shingle.  Steps:

1. One scan of the documents keeps, per document, its number of words and the
   places of benchmark shingles with the words around them (``window`` words
   reach back and ahead).  The shingle hashes are handed out in blocks of
   ``BLOCK`` hashes, so what a task holds is bounded for any benchmark.
2. Counts of these shingles over all documents give the rarity order.
3. The occurrences are joined with the windows' prefix shingles only; the
   position and length bounds drop starts outside the document, and the words
   themselves verify each candidate.
4. Hit words are the distinct positions that verified windows cover.

Results: ``n_words``, ``n_hit``, ``items`` (sorted ids as strings) for every
row.  Null and empty texts have no words; empty benchmark, null items: nothing
is hit.  Rows are told apart by a row number of the scan, so repeated ids and
null ids keep their own rows; repeated items count once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.functions.sizing import broadcast_if_small
from strideframe.llm import packed
from strideframe.llm.stored import SMALL_BATCH_BYTES, small_batches, unused
from strideframe.session import checkpoint_dir

WINDOW = 10
SHINGLE = 5
#: benchmark shingle hashes (8 bytes each) handed to a task at a time
BLOCK = 2_000_000
#: windows beside which occurrences are joined by shuffle, not by broadcast
MAX_BROADCAST_WINDOWS = 20_000
#: text digests of contaminated rows that are handed to all tasks; more are joined by shuffle
MAX_BROADCAST_KEYS = 200_000

_WINDOWS = "item_id string, words array<string>, shingles array<long>"
_HITS = "array<struct<pos:int,shingle:long,before:int,words:array<string>>>"


def _windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """Distinct windows of each item: ``item_id, words, shingles``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in packed.slices(batch, "text", packed.HASHED_BYTES):
                low, starts, ends, rows, hashes = packed.words(data, offs)
                sh, _, sh_rows = packed.shingle_hashes(hashes, rows, shingle)
                names = packed.word_list(low, starts, ends)
                ids, words, shingles = [], [], []
                for k, item in enumerate(part.column("item_id").to_pylist()):
                    w0, w1, s0, s1 = rows[k], rows[k + 1], sh_rows[k], sh_rows[k + 1]
                    per = max(window - shingle + 1, 1)
                    for i in range(max(1, w1 - w0 - window + 1) if w1 > w0 else 0):
                        ids.append(item)
                        words.append(names[w0 + i : min(w0 + i + window, w1)])
                        shingles.append(sh[s0 + i : min(s0 + i + per, s1)].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.string()), pa.array(words, pa.list_(pa.string())), pa.array(shingles, pa.list_(pa.int64()))],
                    names=["item_id", "words", "shingles"],
                )

    items = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return items.mapInArrow(run, _WINDOWS).distinct()


def _occurrences(docs: DataFrame, wanted, reach: int, sizes: list[int]) -> DataFrame:
    """Every row with its number of words and the places of the wanted shingles."""
    schema = T.StructType([*[f for f in docs.schema.fields if f.name != "text"], T.StructField("n_words", T.LongType())])
    schema = T.StructType([*schema.fields, *T._parse_datatype_string(f"hits {_HITS}").fields])
    arrow = pa.list_(pa.struct([("pos", pa.int32()), ("shingle", pa.int64()), ("before", pa.int32()), ("words", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed.held("contamination")
        hashes_wanted = wanted.value
        # a bitmap over 24 bits of the hash answers almost all questions
        coarse = np.zeros(1 << 24, bool)
        coarse[(hashes_wanted >> np.uint64(40)).astype(np.int64)] = True
        for batch in batches:
            for part, data, offs in packed.slices(batch, "text", packed.HASHED_BYTES):
                low, starts, ends, rows, hashes = packed.words(data, offs)
                raw = low.tobytes()
                hits: list[list[dict]] = [[] for _ in range(part.num_rows)]
                counts = np.diff(rows)
                for size in sizes:
                    # short benchmark items have one shingle of fewer words
                    sh, first, sh_rows = _runs(hashes, rows, size)
                    near = np.flatnonzero(coarse[(sh >> np.uint64(40)).astype(np.int64)])
                    at = np.searchsorted(hashes_wanted, sh[near])
                    near = near[hashes_wanted[np.minimum(at, len(hashes_wanted) - 1)] == sh[near]]
                    owner = np.searchsorted(sh_rows, near, "right") - 1
                    for i, d in zip(near.tolist(), owner.tolist(), strict=True):
                        w = int(first[i])
                        lo, hi = max(int(rows[d]), w - reach), min(int(rows[d + 1]), w + reach)
                        around = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[lo:hi].tolist(), ends[lo:hi].tolist(), strict=True)]
                        hits[d].append({"pos": w - int(rows[d]), "shingle": int(sh[i].view(np.int64)), "before": w - lo, "words": around})
                cols = [part.column(f) for f in schema.names[:-2]]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64()), pa.array(hits, arrow)], names=schema.names)

    return docs.mapInArrow(run, schema)


def _runs(hashes: np.ndarray, rows: np.ndarray, size: int):
    """Shingles of exactly ``size`` words (rows with fewer words have none)."""
    sh, first, sh_rows = packed.shingle_hashes(hashes, rows, size)
    enough = np.repeat(np.diff(rows) >= size, np.diff(sh_rows))
    if not enough.all():
        kept = np.concatenate([[0], np.cumsum(enough)])
        sh, first, sh_rows = sh[enough], first[enough], kept[sh_rows]
    return sh, first, sh_rows


def find_contaminated(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE
) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_hit`` and ``items``; its text is dropped."""
    checkpoint_dir(spark)
    small_batches(docs, SMALL_BATCH_BYTES)
    windows = _windows(benchmark, window, shingle).checkpoint()
    unique = windows.select("words", "shingles").distinct().withColumn("win", F.sha2(F.concat_ws(" ", "words"), 256))
    hashes = windows.select(F.explode("shingles").alias("shingle")).distinct()
    n_blocks = max(1, math.ceil(hashes.count() / BLOCK))
    # sizes of shingles in use: the full size, and those of items with fewer words
    sizes = sorted(r[0] for r in windows.select(F.least(F.size("words"), F.lit(shingle))).distinct().collect())

    taken = {c.lower() for c in docs.columns}
    clash = [c for c in docs.columns if c.lower() in ("n_words", "n_hit", "items", "hits", "row_")]
    docs = docs.drop(*clash).withColumn("row_", F.monotonically_increasing_id())
    keys = [c for c in docs.columns if c not in ("text", "row_")]
    assert "text" in taken
    parts = []
    for b in range(n_blocks):
        block = hashes.filter(F.pmod("shingle", F.lit(n_blocks)) == b) if n_blocks > 1 else hashes
        values = np.sort(np.array([r[0] for r in block.toLocalIterator()], np.int64).view(np.uint64))
        if len(values) or not parts:
            handle = spark.sparkContext.broadcast(values if len(values) else np.zeros(1, np.uint64))
            parts.append(_occurrences(docs, handle, max(window, shingle), sizes if len(values) else []))
    base = parts[0].checkpoint()
    rows = base.drop("hits")
    found = base.select("row_", "n_words", F.inline("hits"))
    for more in parts[1:]:
        found = found.unionByName(more.select("row_", "n_words", F.inline("hits")).checkpoint())

    # rarity over all documents; a window's prefix is its rarest shingle, and a window
    # with a shingle that no document holds cannot occur
    rarity = found.groupBy("shingle").agg(F.count("*").alias("n"))
    rarest = F.struct("n", "shingle", "offset")
    prefix = (
        unique.select("win", "words", F.size("shingles").alias("of"), F.posexplode("shingles").alias("offset", "shingle"))
        .join(rarity, "shingle")
        .groupBy("win")
        .agg(F.min(rarest).alias("p"), F.first("words").alias("target"), F.count("*").alias("present"), F.first("of").alias("of"))
        .filter("present = of")
        .select("win", "target", "p.shingle", "p.offset")
    )
    prefix = broadcast_if_small(prefix, MAX_BROADCAST_WINDOWS)
    start = F.col("pos") - F.col("offset")
    length = F.size("target")
    verified = (
        found.join(prefix, "shingle")
        .withColumn("start", start)
        .filter((F.col("start") >= 0) & (F.col("start") + length <= F.col("n_words")))
        .filter(F.slice("words", F.greatest(F.col("before") - F.col("offset") + 1, F.lit(1)), length) == F.col("target"))
        .select("row_", "start", length.alias("length"), "win")
        .checkpoint()
    )
    covered = (
        verified.select("row_", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("pos"))
        .distinct()
        .groupBy("row_")
        .agg(F.count("*").alias("n_hit"))
    )
    owners = windows.select(F.sha2(F.concat_ws(" ", "words"), 256).alias("win"), "item_id").filter("item_id is not null")
    items = (
        verified.select("row_", "win").distinct().join(broadcast_if_small(owners, MAX_BROADCAST_WINDOWS), "win")
        .select("row_", "item_id").distinct()
        .groupBy("row_").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    )
    return (
        rows.join(covered, "row_", "left").join(items, "row_", "left")
        .select(
            *keys,
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def report(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The result of ``op6``."""
    found = find_contaminated(spark, docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def keep_clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no window of a benchmark item, with all their columns.

    Only the texts of contaminated rows are looked up again: the test is carried
    as the digest of the text, so repeated and null ids need no care.
    """
    key = unused("digest", docs)
    digest = F.sha2(F.col("text").cast("binary"), 256).alias(key)
    found = find_contaminated(spark, docs.select("text", digest), benchmark).filter("n_hit > 0").select(key).distinct()
    found = broadcast_if_small(found, MAX_BROADCAST_KEYS)
    return docs.select("*", digest).join(found, key, "left_anti").drop(key)
