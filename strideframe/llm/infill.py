"""Fill-in-middle transformation with a learned index from unit ranks to text offsets.

A text is cut into units: maximal runs of ASCII letters and single other code
points.  Its boundaries (the code-point offset before each unit, and the text's
end) form a rising curve over their ranks.  The curve is covered by straight
segments, each as long as one line through its first boundary stays within
``ERROR`` code points of all its boundaries; one signed byte for each boundary
holds what the rounded line is off.  The offset of a rank is its segment's
prediction plus that residual, so a cut is exact and needs no list of offsets.

The two cuts of a document are ranks drawn by the SHA-256 of its id.  The
transformed text is ``<P>prefix<S>suffix<M>middle`` (psm), ``<S>suffix<P>prefix<M>middle``
(spm) or the text as it is (plain): for a share of the documents, for empty
texts and for texts that hold a mark, which could not be rebuilt.

Null texts are empty texts; a null id is hashed as no digits.  The operator is
row-wise: ties and repeated rows have equal results, texts of any length are
indexed whole, an empty table gives an empty table, other columns are kept and
columns of the added names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.llm import packed
from strideframe.llm.stored import small_batches, unused

#: The marks before prefix, suffix and middle, and the shares of the forms in 1/100.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90
SPM_BELOW = 20

#: a segment's line passes within this many code points of its boundaries (rounding adds a half; a byte holds 127)
ERROR = 126
#: boundaries first looked at for a segment; four times as many each time all of them fit
WINDOW = 256

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True

ADDED = ("fim_n", "fim_form", "fim_prefix_chars", "fim_middle_chars", "fim_text")


def boundaries(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code-point offsets of the unit boundaries of each row, the text's end last, and the rows' offsets among them."""
    n_rows = len(offs) - 1
    head = (data & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(head, dtype=np.int64)])
    letter = LETTER[data]
    joined = np.zeros(len(data), bool)
    joined[1:] = letter[1:] & letter[:-1]
    first = offs[:-1]
    joined[first[first < len(data)]] = False
    at = np.flatnonzero(head & ~joined)
    units = np.diff(np.searchsorted(at, offs))
    rows = np.concatenate([[0], np.cumsum(units + 1)])
    out = np.empty(rows[-1], np.int64)
    last = np.zeros(len(out), bool)
    last[rows[1:] - 1] = True
    out[~last] = chars[at]
    out[last] = chars[offs[1:]]
    return out - np.repeat(chars[first], units + 1), rows if n_rows else np.zeros(1, np.int64)


def fit_segments(offsets: np.ndarray, error: float = ERROR) -> tuple[list[int], list[float]]:
    """First ranks and slopes of the segments of one text: each reaches as far as one slope suits all its boundaries."""
    starts, slopes = [], []
    at, n = 0, len(offsets)
    while at < n:
        width = WINDOW
        while True:
            rise = offsets[at + 1 : at + 1 + width] - offsets[at]
            run = np.arange(1, len(rise) + 1)
            least = np.maximum.accumulate((rise - error) / run)
            most = np.minimum.accumulate((rise + error) / run)
            fits = int(np.searchsorted(least > most, True))
            if fits < len(rise) or len(rise) < width:
                break
            width *= 4
        starts.append(at)
        slopes.append(float(least[fits - 1] + most[fits - 1]) / 2 if fits else 0.0)
        at += fits + 1
    return starts, slopes


@dataclass
class RankIndex:
    """Segments and residuals of the texts of one slice; ``rows`` are the texts' offsets among all boundaries."""

    rows: np.ndarray
    starts: np.ndarray
    bases: np.ndarray
    slopes: np.ndarray
    residuals: np.ndarray

    @classmethod
    def fit(cls, offsets: np.ndarray, rows: np.ndarray) -> RankIndex:
        starts, slopes = [], []
        bounds = rows.tolist()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            s, k = fit_segments(offsets[a:b])
            starts += [a + x for x in s]
            slopes += k
        starts = np.array(starts, np.int64)
        index = cls(rows, starts, offsets[starts], np.array(slopes), np.zeros(0, np.int8))
        off = offsets - index.predict(np.arange(len(offsets)))
        assert not len(off) or np.abs(off).max() < 128
        index.residuals = off.astype(np.int8)
        return index

    def predict(self, at: np.ndarray) -> np.ndarray:
        seg = np.searchsorted(self.starts, at, "right") - 1
        return self.bases[seg] + np.rint(self.slopes[seg] * (at - self.starts[seg])).astype(np.int64)

    def offset(self, row: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Exact offset of each row's boundary of the given rank."""
        at = self.rows[row] + rank
        return self.predict(at) + self.residuals[at]


def _without(docs: DataFrame, names: tuple[str, ...], text: str) -> DataFrame:
    kept = docs.drop(*[c for c in docs.columns if c.lower() in names and c.lower() != text.lower()])
    return small_batches(kept)


def rank_index(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add each text's index: ``fim_segments`` (first rank, its offset, slope) and ``fim_residuals`` (a signed byte for each rank)."""
    kept = _without(docs, ("fim_segments", "fim_residuals"), text)
    segment = T._parse_datatype_string("array<struct<rank:int,offset:long,slope:double>>")
    schema = T.StructType([*kept.schema.fields, T.StructField("fim_segments", segment), T.StructField("fim_residuals", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in packed.slices(batch, text):
                index = RankIndex.fit(*boundaries(data, offs))
                cuts = np.searchsorted(index.starts, index.rows)
                rank = index.starts - np.repeat(index.rows[:-1], np.diff(cuts))
                found = pa.StructArray.from_arrays([pa.array(rank.astype(np.int32)), pa.array(index.bases), pa.array(index.slopes)], ["rank", "offset", "slope"])
                segments = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), found)
                yield pa.RecordBatch.from_arrays([*part.columns, segments, packed.binary_rows(index.residuals, index.rows)], names=schema.names)

    return kept.mapInArrow(run, schema)


def rank_offset(rank: Column, segments: str = "fim_segments", residuals: str = "fim_residuals") -> Column:
    """The offset of a rank by a stored index (columns of ``rank_index``); null beyond its ranks."""
    seg = F.element_at(F.filter(segments, lambda s: s["rank"] <= rank), -1)
    byte = F.conv(F.hex(F.substring(F.col(residuals), rank + 1, F.lit(1))), 16, 10).cast("long")
    near = seg["offset"] + F.rint(seg["slope"] * (rank - seg["rank"])).cast("long")
    return near + byte - F.when(byte > 127, 256).otherwise(0)


def _draw(doc_id: Column, k: int) -> Column:
    """The ``k``-th group (from 0) of 8 hexadecimal digits of the id's digest, as a number."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def transform(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Add ``fim_n`` (units), ``fim_form``, ``fim_prefix_chars``, ``fim_middle_chars`` (null if plain) and ``fim_text``."""
    kept = _without(docs, ADDED, text)
    first, second = unused("cut_one", kept), unused("cut_two", kept)
    drawn = kept.withColumns({first: _draw(F.col(doc_id), 0), second: _draw(F.col(doc_id), 1)})
    schema = T.StructType([*drawn.schema.fields, T.StructField("fim_n", T.LongType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in packed.slices(batch, text):
                index = RankIndex.fit(*boundaries(data, offs))
                n = np.diff(index.rows) - 1
                row = np.arange(part.num_rows)
                ranks = [part.column(c).to_numpy(zero_copy_only=False) % (n + 1) for c in (first, second)]
                cuts = {c: index.offset(row, r) for c, r in zip((first, second), (np.minimum(*ranks), np.maximum(*ranks)), strict=True)}
                cols = [pa.array(cuts[c]) if c in cuts else part.column(c) for c in names[:-1]]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n)], names=names)

    cut = drawn.mapInArrow(run, schema)
    whole = F.coalesce(F.col(text), F.lit(""))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | whole.contains(mark)
    plain = (whole == "") | marked | (_draw(F.col(doc_id), 2) % 100 >= PLAIN_FROM)
    form = F.when(plain, "plain").when(_draw(F.col(doc_id), 3) % 100 < SPM_BELOW, "spm").otherwise("psm")
    a, b = F.col(first), F.col(second)
    formed = cut.withColumn("fim_form", form).withColumns(
        {
            "fim_prefix_chars": F.when(F.col("fim_form") != "plain", a),
            "fim_middle_chars": F.when(F.col("fim_form") != "plain", b - a),
        }
    )
    prefix = F.concat(F.lit(PREFIX), F.substring(whole, F.lit(1), a.cast("int")))
    middle = F.concat(F.lit(MIDDLE), F.substring(whole, (a + 1).cast("int"), (b - a).cast("int")))
    suffix = F.concat(F.lit(SUFFIX), F.substring(whole, (b + 1).cast("int"), F.length(whole)))
    made = F.when(F.col("fim_form") == "plain", whole).when(F.col("fim_form") == "psm", F.concat(prefix, suffix, middle))
    return formed.withColumn("fim_text", made.otherwise(F.concat(suffix, prefix, middle))).drop(first, second)


def restored(made: Column, form: Column) -> Column:
    """The original text of a transformed one: no part holds a mark, so the marks cut it into its parts."""
    part = F.split(made, "<[PSM]>", -1)
    psm = F.concat(part[1], part[3], part[2])
    spm = F.concat(part[2], part[3], part[1])
    return F.when(form == "plain", made).when(form == "psm", psm).otherwise(spm)


def digests(docs: DataFrame) -> DataFrame:
    """The result of ``op11`` for every row of ``docs`` (``doc_id``, ``text``)."""
    made = transform(docs.select("doc_id", "text"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id",
        F.col("fim_n").alias("n"),
        F.col("fim_form").alias("form"),
        F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"),
        sha(F.col("fim_text")).alias("output_sha256"),
        sha(restored(F.col("fim_text"), F.col("fim_form"))).alias("restored_sha256"),
    )


def oracle_sql() -> str:
    """The result of ``op11`` in DuckDB, by lists of units."""
    draw = ", ".join(f"CAST('0x' || substr(digest, {8 * k + 1}, 8) AS UBIGINT)::BIGINT AS h{k + 1}" for k in range(4))
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS whole, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
    u AS (SELECT *, regexp_extract_all(whole, '[A-Za-z]+|[^A-Za-z]') AS units, {draw} FROM d),
    c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
        CASE WHEN whole = '' OR contains(whole, '{PREFIX}') OR contains(whole, '{SUFFIX}') OR contains(whole, '{MIDDLE}') OR h3 % 100 >= {PLAIN_FROM} THEN 'plain'
             WHEN h4 % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM u),
    p AS (SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid, array_to_string(units[b + 1:n], '') AS suf FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN whole WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
               ELSE '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid END) AS output_sha256,
        sha256(whole) AS restored_sha256
    FROM p"""
