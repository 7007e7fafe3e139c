"""Line dedup with levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at both ends, A-Z in lower
case; it is known by a 128-bit hash.  ``LineRuns`` holds how many documents each
key was found in, as runs: tables bucketed and sorted by hash.  A new batch is
counted, merge-anti-joined with the settled keys of every run (those already
found in ``min_docs`` documents need no further count), and written as a run of
level 0.  Two runs of one level are compacted into one of the next by a merge
join of their buckets, so a key is rewritten once a level and no join of runs
shuffles.  A run is written before those it replaces are dropped.

Lines whose key is found in ``min_docs`` documents go from every document.  The
``HELD`` such keys with the highest counts are held by each task; the others
meet their lines in a shuffled join, and each has at most a share of about
``batches / HELD`` of all lines there.  Results do not depend on ``HELD``.

A row is a document: repeated rows and ids count each.  A key counts once a
document.  Null and empty texts are one empty line; empty keys are never
dropped.  A text that loses all its lines is an empty text.  Texts of any length
are handled whole, an empty table gives an empty table, other columns are kept.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.llm import packed
from strideframe.llm.stored import Scratch, small_batches, unused

MIN_DOCS = 10
#: batches that a whole table is dealt to; documents are dealt by hash
BATCHES = 4
#: keys held by each task (16 bytes each)
HELD = 500_000

HASH = ["h", "g"]


def digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def lines_of(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """The lines of a text and the hashes of their keys; an empty key has an empty hash."""
    lines = text.split(b"\n")
    keys = [x.strip().lower() for x in lines]  # of bytes: both handle ASCII only
    return lines, [digest(k) if k else b"" for k in keys]


def _texts(data: np.ndarray, offs: np.ndarray) -> list[bytes]:
    raw, at = data.tobytes(), offs.tolist()
    return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _hash_columns(hashes: list[bytes]) -> list[pa.Array]:
    both = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
    return [pa.array(both[:, k]) for k in range(2)]


def line_counts(docs: DataFrame, text: str = "text", batch: str | None = None) -> DataFrame:
    """Partial counts ``h, g, n`` (and the batch): documents of a slice that hold a key; sum them by hash."""
    cols = [F.col(text).alias("text"), (F.col(batch) if batch else F.lit(0)).cast("int").alias("batch")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed.held("lineruns")
        for rows in batches:
            for part, data, offs in packed.slices(rows, "text"):
                found: dict[int, Counter] = {}
                for number, raw in zip(part.column("batch").to_pylist(), _texts(data, offs), strict=True):
                    found.setdefault(number, Counter()).update(set(lines_of(raw)[1]) - {b""})
                for number, counts in found.items():
                    n = pa.array(list(counts.values()), pa.int64())
                    yield pa.RecordBatch.from_arrays([*_hash_columns(list(counts)), n, pa.array([number] * len(n), pa.int32())], names=[*HASH, "n", "batch"])

    return small_batches(docs).select(*cols).mapInArrow(run, "h long, g long, n long, batch int")


class LineRuns:
    """Counts of line hashes in levelled sorted runs under ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS):
        self.spark = spark
        self.min_docs = min_docs
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = Scratch(spark, "line-runs")
        self.runs: list[tuple[int, str]] = []  # (level, table), the highest level first

    def _write(self, level: int, run: DataFrame) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        path = self.folder.place(name)
        run.select(*HASH, "n").write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", path).saveAsTable(name)
        self.runs.append((level, name))

    def _merge_last_two(self) -> None:
        (level, first), (_, second) = self.runs[-2:]
        a, b = self.spark.table(first).alias("a"), self.spark.table(second).alias("b")
        n = F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))
        both = a.hint("merge").join(b, HASH, "full_outer").select(*HASH, n.alias("n"))
        del self.runs[-2:]
        self._write(level + 1, both)
        self._forget(first, second)

    def _forget(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")
            self.folder.drop_one(name)

    def add(self, counts: DataFrame) -> None:
        """Take in a batch's counts (``h, g, n``, in any number of parts), then compact runs of one level."""
        new = counts.groupBy(*HASH).agg(F.sum("n").alias("n"))
        for _, name in self.runs:
            settled = self.spark.table(name).filter(F.col("n") >= self.min_docs).select(*HASH)
            new = new.join(settled.hint("merge"), HASH, "left_anti")
        self._write(0, new)
        while len(self.runs) > 1 and self.runs[-1][0] == self.runs[-2][0]:
            self._merge_last_two()

    def frequent(self) -> DataFrame:
        """Hashes of all keys found in ``min_docs`` documents, after compaction to one run; ``n`` counts up to the batch they settled in."""
        while len(self.runs) > 1:
            self._merge_last_two()
        return self.spark.table(self.runs[0][1]).filter(F.col("n") >= self.min_docs)

    def drop(self) -> None:
        self._forget(*[name for _, name in self.runs])
        self.runs = []


def _held_and_rest(frequent: DataFrame, held: int) -> tuple[bytes, DataFrame | None]:
    """The ``held`` keys of the highest counts as joined hashes, and a table of the others if there are any."""
    top = frequent.orderBy(F.desc("n"), *HASH).limit(held).select(*HASH).toArrow()
    both = np.column_stack([top.column(c).to_numpy() for c in HASH]).astype("<i8")
    if frequent.count() <= held:
        return both.tobytes(), None
    spark = frequent.sparkSession
    taken = F.broadcast(spark.createDataFrame(top))
    return both.tobytes(), frequent.select(*HASH).join(taken, HASH, "left_anti")


def _hash_set(raw: bytes) -> set[bytes]:
    return {raw[i : i + 16] for i in range(0, len(raw), 16)}


def drop_lines(docs: DataFrame, frequent: DataFrame, text: str = "text", held: int = HELD) -> DataFrame:
    """``docs`` with ``text`` without its lines whose key is in ``frequent`` (``h, g, n``), and ``line_n``, ``line_dropped`` added."""
    kept = small_batches(docs.drop(*[c for c in docs.columns if c.lower() in ("line_n", "line_dropped") and c.lower() != text.lower()]))
    raw, rest = _held_and_rest(frequent, held)
    shared = kept.sparkSession.sparkContext.broadcast(raw)
    more = unused("more", kept)
    if rest is None:
        rows = kept.withColumn(more, F.lit(None).cast("binary"))
    else:
        rows = _with_rest(kept, rest, shared, text, more)
    schema = T.StructType([*kept.schema.fields, T.StructField("line_n", T.LongType()), T.StructField("line_dropped", T.LongType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed.held("lineruns")
        known = _hash_set(shared.value)
        for batch in batches:
            for part, data, offs in packed.slices(batch, text):
                texts, n, dropped = [], [], []
                for whole, own in zip(_texts(data, offs), part.column(more).to_pylist(), strict=True):
                    lines, hashes = lines_of(whole)
                    gone = known if own is None else known | _hash_set(own)
                    stay = [x for x, d in zip(lines, hashes, strict=True) if d not in gone]
                    texts.append(b"\n".join(stay))
                    n.append(len(lines))
                    dropped.append(len(lines) - len(stay))
                cols = {text: pa.array(texts, pa.binary()).cast(pa.string()), "line_n": pa.array(n, pa.int64()), "line_dropped": pa.array(dropped, pa.int64())}
                yield pa.RecordBatch.from_arrays([cols[c] if c in cols else part.column(c) for c in names], names=names)

    return rows.mapInArrow(run, schema)


def _with_rest(docs: DataFrame, rest: DataFrame, shared, text: str, more: str) -> DataFrame:
    """Add the joined hashes of each text's lines that are in ``rest``.

    Texts that have a line beyond the held keys meet their hits by the text's
    hash; a text repeated often has lines repeated as often, so none of those
    is frequent there.  All other rows get a key of their own and meet nothing.
    """
    key = unused("text_key", docs)
    schema = T.StructType([*docs.schema.fields, T.StructField(key, T.BinaryType())])
    names = schema.names

    def beyond(texts: list[bytes], known: set[bytes]) -> Iterator[tuple[bytes, set[bytes]]]:
        for raw in texts:
            yield raw, {d for d in lines_of(raw)[1] if d and d not in known}

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _hash_set(shared.value)
        for batch in batches:
            for _, data, offs in packed.slices(batch, "text"):
                pairs = {(digest(raw), d) for raw, found in beyond(_texts(data, offs), known) for d in found}
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.binary()), *_hash_columns([b for _, b in pairs])], names=["t", *HASH])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _hash_set(shared.value)
        for batch in batches:
            for part, data, offs in packed.slices(batch, text):
                keys = [digest(raw) if found else None for raw, found in beyond(_texts(data, offs), known)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys, pa.binary())], names=names)

    met = docs.select(F.col(text).alias("text")).mapInArrow(lines, "t binary, h long, g long").distinct().join(rest, HASH, "left_semi")
    hits = met.groupBy(F.col("t").alias(key)).agg(F.collect_list(F.struct(*HASH)).alias(more))
    own = F.unhex(F.concat(F.lit("00"), F.hex(F.xxhash64(*[c for c, kind in docs.dtypes if not kind.startswith("map")]))))
    rows = docs.mapInArrow(keyed, schema).withColumn(key, F.coalesce(key, own)).join(hits, key, "left")
    as_bytes = F.when(F.col(more).isNotNull(), F.unhex(F.array_join(F.transform(more, lambda x: F.concat(_hex_le(x["h"]), _hex_le(x["g"]))), "")))
    return rows.withColumn(more, as_bytes).select(*docs.columns, more)


def _hex_le(value):
    """Hexadecimal digits of a long's bytes, the lowest byte first."""
    digits = F.lpad(F.hex(value), 16, "0")
    return F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in range(7, -1, -1)])


def drop_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, text: str = "text", batches: int = BATCHES, held: int = HELD) -> DataFrame:
    """Deal the documents to batches, take these into the runs one after the other, and drop the frequent lines from all documents."""
    spark = docs.sparkSession
    dealt = docs.select(F.col(text).alias("text"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(batches)).alias("batch"))
    folder = Scratch(spark, "line-counts")
    counts = folder.write(line_counts(dealt, "text", "batch"), "counts", partition_by=("batch",))
    runs = LineRuns(spark, min_docs)
    for b in range(batches):
        runs.add(counts.filter(F.col("batch") == b))
    folder.drop()
    found = Scratch(spark, "frequent-lines").write(runs.frequent(), "lines")
    runs.drop()
    return drop_lines(docs, found, text, held)


def digests(docs: DataFrame) -> DataFrame:
    """The result of ``op12`` for every row of ``docs`` (``doc_id``, ``text``)."""
    kept = drop_repeated_lines(docs.select("doc_id", "text"))
    sha = F.sha2(F.col("text").cast("binary"), 256)
    return kept.select("doc_id", F.col("line_n").alias("n_lines"), F.col("line_dropped").alias("n_dropped"), sha.alias("kept_sha256"))


def oracle_sql() -> str:
    """The result of ``op12`` in DuckDB: all lines, their keys' documents, and the lines joined again."""
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
    k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
    f AS (SELECT k FROM k WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= {MIN_DOCS})
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
        sha256(coalesce(string_agg(CASE WHEN f.k IS NULL THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
    FROM k LEFT JOIN f ON k.k = f.k GROUP BY r"""
