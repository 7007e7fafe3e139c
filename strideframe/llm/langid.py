"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed character n-grams (1 to 3 UTF-8 bytes of its
lower-cased letters, words kept apart by one blank), weighted by TF-IDF and
brought to length 1.  For each language spherical k-means finds ``CENTROIDS``
centroids.  A text gets the language of the centroid with the greatest cosine;
it is rejected if that cosine is below the radius for a text of so many letters.

Radii come from texts that the centroids did not see.  One half of the texts, by
hash, gives centroids; pieces of the other half, of 16 letters and twice as many up to
4,096, are compared with the centroids of their own language and, as if that
had been left out, with those of the others.  The radius for a length rejects
``FOREIGN`` of the pieces whose language is left out, but at most ``CLEAN`` of
the pieces whose language is known.

Document frequencies count all training texts.  Centroids and radii are learned
from all different ones, so that copies count once: their n-gram counts are
written in a compact form, with the number of copies for the document
frequencies, and each round of k-means is a job over them that adds up the
vectors nearest to each centroid.  The rounds only start from a bounded
sample's centroids (at most ``SAMPLE`` different texts over all languages, for each
language those with the least hashes), so that they are few and no language with
a text is left without a centroid.

Results: ``lang_pred`` (``und`` for null texts and texts without a letter, or
if nothing could be learned), ``lang_score`` (the cosine, 0 for ``und``),
``lang_rejected`` (true for ``und``).  Ties go to the first language in
alphabetical order.  Scoring is row-wise: repeated rows, null ids and further
columns pass through; whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.functions.quantiles import exact_quantiles
from strideframe.llm import packed
from strideframe.llm.stored import SMALL_BATCH_BYTES, Scratch, small_batches
from strideframe.operators.boosting import number_of_task

DIMS = 4096
CENTROIDS = 4
#: the bound of the sample that k-means starts from, over all languages
SAMPLE = 4000
#: rounds of k-means over all texts at most; they end when each centroid's cosine with its last place is above ``STILL``
ROUNDS = 20
STILL = 0.9999
#: sums of so many tasks are added in one step, then those sums
ADDED_TOGETHER = 64
#: shares of the calibration pieces that a radius rejects: of left-out languages at best, of known ones at most
FOREIGN = 0.995
CLEAN = 0.002
#: letters of the calibration pieces; longer texts have the last radius, shorter ones are not rejected
PIECES = tuple(16 << k for k in range(9))
#: most different values of the language column
MAX_LANGS = 1000
#: rows of a slice: their dense vectors stay below 8 MB
ROWS = 512
#: rows that are counted at a time: their dense counts stay near the processor's cache
COUNTED = 64

_GAP = 0x20
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True
#: for each byte: its lower case, or a blank for no letter; whether it begins a letter; whether it is an ASCII letter
_FOLDED = np.where(_LETTER[packed.LOWER], packed.LOWER, _GAP).astype(np.uint8).tobytes()
_LEAD = (_LETTER[packed.LOWER] & ((np.arange(256) & 0xC0) != 0x80)).tobytes()
_ASCII = (_LETTER[packed.LOWER] & (np.arange(256) < 0x80)).tobytes()
#: logarithms of one plus the usual counts
_LOG = np.log1p(np.arange(1 << 16), dtype=np.float32)


def _mapped(data: np.ndarray, table: bytes) -> np.ndarray:
    return np.frombuffer(bytearray(data).translate(table), np.uint8)


def _letters(data: np.ndarray) -> np.ndarray:
    """Lower-cased letter bytes, all other bytes as blanks."""
    low = _mapped(data, _FOLDED)
    # capital letters of Latin-1 after their lead byte
    second = np.flatnonzero(low[:-1] == 0xC3) + 1
    low[second[(low[second] >= 0x80) & (low[second] <= 0x9E)]] += 0x20
    return low


def counts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """n-gram counts of each row, shape (rows, DIMS)."""
    n = len(offs) - 1
    low = _letters(data)
    begin = np.repeat(np.arange(n) * DIMS, np.diff(offs))
    gap = low == _GAP
    # what is no n-gram counts in dimension 0, which no letter has
    found = [low * ~gap + begin]
    if len(low) > 1:
        whole = ~(gap[:-1] & gap[1:])
        last = offs[1:-1]
        whole[last[(last > 0) & (last < len(low))] - 1] = False
        low = low.astype(np.uint32)
        pair = low[:-1] * np.uint32(256) + low[1:]
        found.append(_slot(pair, 2) * whole + begin[:-1])
        if len(low) > 2:
            found.append(_slot(pair[:-1] * np.uint32(256) + low[2:], 3) * (whole[:-1] & whole[1:]) + begin[:-2])
    total = np.bincount(np.concatenate(found), minlength=n * DIMS).reshape(n, DIMS)
    total[:, 0] = 0
    return total


def _slot(code: np.ndarray, n: int) -> np.ndarray:
    # multiplicative hashing modulo 2^32 into the dimensions above the single bytes
    mixed = (code + np.uint32(n * 0x1000000)) * np.uint32(0x9E3779B1) >> np.uint32(8)
    return np.uint32(256) + mixed - mixed // np.uint32(DIMS - 256) * np.uint32(DIMS - 256)


def _logs(total: np.ndarray) -> np.ndarray:
    """The logarithm of one plus each count."""
    if total.max(initial=0) < len(_LOG):
        return _LOG[total]
    return np.log1p(total, dtype=np.float32)


def _unit(weighted: np.ndarray) -> np.ndarray:
    """Rows brought to length 1, in place."""
    norm = np.sqrt((weighted * weighted).sum(axis=1, keepdims=True))
    weighted /= np.maximum(norm, 1e-12)
    return weighted


def unit_vectors(total: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit(_logs(total) * idf.astype(np.float32))


def has_letter(part: pa.RecordBatch, text: str, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    seen = np.concatenate([[0], np.cumsum(_mapped(data, _ASCII), dtype=np.int64)])
    found = seen[offs[1:]] > seen[offs[:-1]]
    rest = np.flatnonzero(~found & (np.diff(offs) > 0))
    for i in rest.tolist():
        found[i] = any(ch.isalpha() for ch in part.column(text)[i].as_py() or "")
    return found


def spherical_kmeans(vectors: np.ndarray, k: int, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of length 1 and the member of each; starts from far-apart rows, so it has no randomness."""
    k = min(k, len(vectors))
    chosen = [int(np.argmax(vectors @ vectors.mean(axis=0)))]
    nearest = vectors @ vectors[chosen[0]]
    while len(chosen) < k:
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centres = vectors[chosen]
    member = np.zeros(len(vectors), np.int64)
    for step in range(rounds):
        new = np.argmax(vectors @ centres.T, axis=1)
        if step and (new == member).all():
            break
        member = new
        for c in range(k):
            if (member == c).any():
                mean = vectors[member == c].mean(axis=0)
                centres[c] = mean / max(float(np.linalg.norm(mean)), 1e-12)
    return centres, member


@dataclass
class Model:
    idf: np.ndarray
    centres: np.ndarray
    radius: np.ndarray  # for each of PIECES
    langs: list[str]

    def rejects(self, top: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Whether a text of so many letters is too far from its nearest centroid."""
        at = np.searchsorted(PIECES, letters, "right") - 1
        return np.where(at >= 0, top < self.radius[np.maximum(at, 0)], False)


def letter_counts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Characters of each row that are letters (by their lead bytes)."""
    seen = np.concatenate([[0], np.cumsum(_mapped(data, _LEAD), dtype=np.int64)])
    return seen[offs[1:]] - seen[offs[:-1]]


def text_vectors(data: np.ndarray, offs: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The unit vector of each row."""
    out = np.empty((len(offs) - 1, DIMS), np.float32)
    for at in range(0, len(out), COUNTED):
        part = offs[at : at + COUNTED + 1]
        out[at : at + COUNTED] = unit_vectors(counts(data[part[0] : part[-1]], part - part[0]), idf)
    return out


def _sliced(batches: Iterator[pa.RecordBatch], text: str, rows: int = ROWS):
    packed.held("langid")
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield from packed.slices(batch.slice(at, rows), text)


def _document_frequency(texts: DataFrame) -> np.ndarray:
    """How many training texts, copies among them, have each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed.held("langid")
        seen = np.zeros(DIMS, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, COUNTED):
                b = batch.slice(at, COUNTED)
                # exact: numbers of texts are far below 2^53
                seen += (b.column("copies").to_numpy().astype(np.float64) @ _there(b).astype(np.float64)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS, dtype=np.int32)), pa.array(seen)], names=["dim", "n"])

    found = texts.select("dims", "copies").mapInArrow(run, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(DIMS, np.int64)
    for dim, n in found:
        out[dim] = n
    return out


def fit(train: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE, k: int = CENTROIDS) -> Model | None:
    """Learn from rows with a language; None if there is no such row with a letter."""
    train = small_batches(train, SMALL_BATCH_BYTES).filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    train = train.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    found = train.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect()
    if not found:
        return None
    if len(found) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    folder = Scratch(train.sparkSession, "langid")
    texts = folder.write(_packed(train), "texts")
    idf = np.log((1 + sum(r["n"] for r in found)) / (1 + _document_frequency(texts))) + 1.0
    by_lang = _drawn(_sample(train, max(1, sample // len(found))))
    if not by_lang:
        folder.drop()
        return None
    (langs, centres), known = _moved(texts, idf, _starts(by_lang, idf, k))
    pieces = folder.write(_pieces(train.filter(F.pmod(F.xxhash64("text"), F.lit(2)) == 1), idf, *known), "pieces")
    radius = _radii(pieces)
    folder.drop()
    return Model(idf, centres, radius, langs)


def _packed(train: DataFrame) -> DataFrame:
    """``lang, hash, copies, dims, counts``: of each different text the number of copies and the n-gram counts, as a bit
    for each dimension and the counts of those present."""
    rows = _counted(train.withColumn("hash", F.xxhash64("text")), "lang string, hash long")
    return rows.groupBy("lang", "hash").agg(F.count("*").alias("copies"), F.first("dims").alias("dims"), F.first("counts").alias("counts"))


def _counted(rows: DataFrame, keys: str) -> DataFrame:
    """The ``keys`` of each text with an n-gram, with its ``dims`` and ``counts``."""
    names = [x.split()[0] for x in keys.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in _sliced(batches, "text", COUNTED):
            total = counts(data, offs)
            some = np.flatnonzero(total.any(axis=1))
            total = total[some]
            dims = [x.tobytes() for x in np.packbits(total > 0, axis=1)]
            present = [row[row > 0].astype("u1" if row.max() < 256 else "<u4").tobytes() for row in total]
            kept = part.select(names).take(pa.array(some))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(dims, pa.binary()), pa.array(present, pa.binary())], names=[*names, "dims", "counts"])

    return rows.mapInArrow(run, f"{keys}, dims binary, counts binary")


def _there(b: pa.RecordBatch) -> np.ndarray:
    """Which dimensions each text of ``_packed`` has."""
    dims = b"".join(b.column("dims").to_pylist())
    return np.unpackbits(np.frombuffer(dims, np.uint8).reshape(-1, DIMS // 8), axis=1).view(bool)


def _unpacked(b: pa.RecordBatch, idf: np.ndarray) -> np.ndarray:
    """The unit vectors of texts of ``_packed``."""
    there = _there(b)
    many = np.count_nonzero(there, axis=1).tolist()
    present = b.column("counts").to_pylist()
    total = np.concatenate([np.frombuffer(x, "u1" if len(x) == n else "<u4") for x, n in zip(present, many, strict=True)])
    weighted = np.zeros(there.shape, np.float32)
    weighted.ravel()[np.flatnonzero(there)] = _logs(total)
    weighted *= idf.astype(np.float32)
    return _unit(weighted)


def _moved(texts: DataFrame, idf: np.ndarray, models: list[tuple[list[str], np.ndarray]]) -> list[tuple[list[str], np.ndarray]]:
    """Spherical k-means over all texts (first model) and over those of even hash (second), from the given centroids."""
    known = sorted({name for langs, _ in models for name in langs})
    of_centre = [np.array([known.index(name) for name in langs]) for langs, _ in models]
    places = [centres.astype(np.float64) for _, centres in models]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed.held("langid")
        total = [np.zeros(c.shape) for c in places]
        turned = [c.T.astype(np.float32) for c in places]
        for batch in batches:
            for at in range(0, batch.num_rows, COUNTED):
                b = batch.slice(at, COUNTED)
                vectors = _unpacked(b, idf)
                own = pc.index_in(b.column("lang"), value_set=pa.array(known, pa.string())).fill_null(-1).to_numpy()
                even = b.column("hash").to_numpy() % 2 == 0
                for m, langs in enumerate(of_centre):
                    mine = (langs[None, :] == own[:, None]) & (even[:, None] | (m == 0))
                    nearest = np.where(mine, vectors @ turned[m], -2.0).argmax(axis=1)
                    nearest[~mine.any(axis=1)] = -1
                    for c in np.unique(nearest[nearest >= 0]).tolist():
                        total[m][c] += vectors[nearest == c].sum(axis=0, dtype=np.float64)
        for m, found in enumerate(total):
            for c in np.flatnonzero(found.any(axis=1)).tolist():
                key = [pa.array([x], pa.int32()) for x in (m, c, number_of_task())]
                yield pa.RecordBatch.from_arrays([*key, pa.array([found[c].tobytes()], pa.binary())], names=["model", "centre", "part", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<f8") for x in group.column("sums").to_pylist())
        return group.slice(0, 1).set_column(3, "sums", pa.array([total.tobytes()], pa.binary()))

    kind = "model int, centre int, part int, sums binary"
    for _ in range(ROUNDS):
        added, parts = texts.drop("copies").mapInArrow(sums, kind), texts.rdd.getNumPartitions()
        while parts > 1:
            parts = -(-parts // ADDED_TOGETHER)
            added = added.withColumn("part", F.col("part") % parts).groupBy("model", "centre", "part").applyInArrow(add, kind)
        after = [c.copy() for c in places]
        for r in added.collect():
            mean = np.frombuffer(bytes(r["sums"]), "<f8")
            after[r["model"]][r["centre"]] = mean / max(float(np.linalg.norm(mean)), 1e-12)
        still = min(float((a * b).sum(axis=1).min()) for a, b in zip(after, places, strict=True))
        places = after
        if still > STILL:
            break
    return [(langs, c.astype(np.float32)) for (langs, _), c in zip(models, places, strict=True)]


def _sample(train: DataFrame, share: int) -> DataFrame:
    """``lang, text, place``: for each language the ``share`` different texts with the least hashes, in the hashes' order."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed.held("langid")
        held: dict[str, np.ndarray] = {}
        for b in batches:
            names, code = np.unique(np.array(b.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            hashes = b.column("hash").to_numpy()
            for i, name in enumerate(names.tolist()):
                held[name] = np.unique(np.concatenate([held.get(name, hashes[:0]), hashes[code == i]]))[:share]
        for name, hashes in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(hashes), pa.string()), pa.array(hashes)], names=["lang", "hash"])

    rows = train.withColumn("hash", F.xxhash64("text"))
    kept = rows.select(F.col("lang").cast("string").alias("lang"), "hash").mapInArrow(least, "lang string, hash long").distinct()
    order = Window.partitionBy("lang").orderBy("hash")
    kept = kept.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= share)
    # at most SAMPLE rows: broadcast
    texts = rows.join(F.broadcast(kept), ["lang", "hash"])
    # copies of a text are equal but for a collision of hashes
    return texts.groupBy("lang", "place").agg(F.min("text").alias("text"))


def _drawn(drawn: DataFrame) -> dict[str, pa.RecordBatch]:
    """``half, dims, counts`` of the sample's texts with a letter, by language, in the order of their places: n-gram counts
    take the driver some hundred bytes a text, their vectors 16 KB."""
    found: dict[str, list] = {}
    drawn = drawn.withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int"))
    for name, place, half, dims, present in _counted(drawn, "lang string, place int, half int").collect():
        found.setdefault(name, []).append((place, half, bytes(dims), bytes(present)))
    out = {}
    for name, rows in sorted(found.items()):
        rows.sort(key=lambda r: r[0])
        _, half, dims, present = zip(*rows, strict=True)
        out[name] = pa.record_batch({"half": pa.array(half, pa.int32()), "dims": pa.array(dims, pa.binary()), "counts": pa.array(present, pa.binary())})
    return out


def _starts(by_lang: dict[str, pa.RecordBatch], idf: np.ndarray, k: int) -> list[tuple[list[str], np.ndarray]]:
    """Languages and centroids of all texts, and of those of the first half; the driver holds one language's vectors at a time."""
    langs: list[list[str]] = [[], []]
    centres: list[list[np.ndarray]] = [[], []]
    for name, batch in by_lang.items():
        rows = np.empty((batch.num_rows, DIMS), np.float32)
        for at in range(0, len(rows), COUNTED):
            rows[at : at + COUNTED] = _unpacked(batch.slice(at, COUNTED), idf)
        first = batch.column("half").to_numpy() == 0
        # a language without a text in the first half is known by those of the second
        for m, own in enumerate((rows, rows[first] if first.any() else rows)):
            found, _ = spherical_kmeans(own, k)
            langs[m] += [name] * len(found)
            centres[m].append(found)
    return [(names, np.concatenate(own).astype(np.float32)) for names, own in zip(langs, centres, strict=True)]


def _pieces(held_out: DataFrame, idf: np.ndarray, langs: list[str], centres: np.ndarray) -> DataFrame:
    """``number, top, other``: for each different text and each length of ``PIECES`` that it has, the cosine with the
    nearest centroid, and with the nearest of another language."""
    names = np.array(langs, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in _sliced(batches, "text"):
            own = np.array(part.column("lang").to_pylist(), object)
            letter = np.concatenate([[0], np.cumsum(_mapped(data, _LEAD), dtype=np.int64)])
            for number, size in enumerate(PIECES):
                # the bytes up to each text's ``size``-th letter, of texts that have so many
                begin = letter[offs[:-1]]
                rows = np.flatnonzero(letter[offs[1:]] - begin >= size)
                if not len(rows):
                    continue
                end = np.searchsorted(letter, begin[rows] + size)
                spans = [data[a:b] for a, b in zip(offs[rows].tolist(), end.tolist(), strict=True)]
                at = np.concatenate([[0], np.cumsum([len(x) for x in spans])])
                near = text_vectors(np.concatenate(spans), at, idf) @ centres.T
                mine = names[None, :] == own[rows, None]
                best = np.where(mine, near, -1.0).max(axis=1)
                other = np.where(mine, -1.0, near).max(axis=1)
                keys = part.select(["lang", "hash"]).take(pa.array(rows)).columns
                cols = [*keys, pa.array([number] * len(rows), pa.int32()), pa.array(np.maximum(best, other).astype(float)), pa.array(other.astype(float))]
                yield pa.RecordBatch.from_arrays(cols, names=["lang", "hash", "number", "top", "other"])

    kind = "lang string, hash long, number int, top double, other double"
    found = held_out.withColumn("hash", F.xxhash64("text")).mapInArrow(run, kind)
    return found.dropDuplicates(["lang", "hash", "number"]).select("number", "top", "other")


def _radii(pieces: DataFrame) -> np.ndarray:
    """The radius for each length of ``PIECES``, from all pieces."""
    clean = {r["number"]: r["q"] for r in exact_quantiles(pieces, ["number"], "top", [CLEAN]).collect()}
    foreign = {r["number"]: r["q"] for r in exact_quantiles(pieces.filter("other >= 0"), ["number"], "other", [FOREIGN]).collect()}
    radius = np.zeros(len(PIECES))
    for i in range(len(PIECES)):
        if i in clean:
            radius[i] = min(clean[i], foreign.get(i, clean[i]))
        else:  # no text is so long: what holds for shorter ones
            radius[i] = radius[i - 1] if i else 0.0
    return radius


ADDED = ("lang_pred", "lang_score", "lang_rejected")


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``lang_score`` and ``lang_rejected``; columns of those names are replaced."""
    kept = small_batches(docs, SMALL_BATCH_BYTES).drop(*[c for c in docs.columns if c.lower() in ADDED])
    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([*kept.schema.fields, *[T.StructField(c, t) for c, t in zip(ADDED, kinds, strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in _sliced(batches, text):
            known = has_letter(part, text, data, offs) & (model is not None)
            pred = np.full(part.num_rows, "und", object)
            score = np.zeros(part.num_rows)
            rejected = ~known
            if known.any():
                near = text_vectors(data, offs, model.idf) @ model.centres.T
                best = near.argmax(axis=1)
                top = np.clip(near[np.arange(len(best)), best].astype(float), 0.0, 1.0)
                pred[known] = np.array(model.langs, object)[best[known]]
                score[known] = top[known]
                rejected |= model.rejects(top, letter_counts(data, offs))
            cols = [pa.array(pred, pa.string()), pa.array(score), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*part.columns, *cols], names=schema.names)

    return kept.mapInArrow(run, schema)


def remainder(doc_id: str, n: int):
    """crc32 of the id as text modulo ``n`` (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def predictions(docs: DataFrame) -> DataFrame:
    """The result of ``op10``: learn where the id's remainder modulo 4 is not 2, predict every row."""
    part = remainder("doc_id", 4)
    model = fit(docs.filter(part != 2))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))
