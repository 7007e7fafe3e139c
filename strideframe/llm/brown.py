"""Brown class-based bigram model of a corpus, and its score of every text.

A token is a run of characters other than ASCII white space, with A-Z
lower-cased; each text ends with one end token.

Classes.  Words are gathered into ``UNITS`` clustering units: the most frequent
words are units of their own, all others share a unit with the words of the
same ending (last two bytes, hashed), so an unseen word has a unit too.  The
exchange algorithm moves units between ``CLASSES`` classes while the class
bigram likelihood grows; it needs the unit bigram counts only, whose number is
bounded by the square of ``UNITS``, whatever the size of the corpus.  Then each
further word that occurs ``SEEN`` times or more goes to the class of greatest
likelihood by its own counts of (class before, class after), over all training
texts.  Unseen and rarer words keep the class of their ending.

Model.  ``p(w | previous) = p(class(w) | class(previous)) * p(w | class(w))``.
Transitions are smoothed towards the classes' shares with ``TRANSITION`` pseudo
counts; emissions are ``(c + 0.1) / (N_class + 0.1 (V_class + 1))``, where one
place in each class is kept for unseen words.  The score of a text is the log10
of its probability, with the first word following an end token.

Counts cover all training texts and every word.  Words are counted by a 64-bit
hash.  At most ``DICTIONARY`` words, the most frequent, are handed to all tasks
with their counts and classes.  Occurrences of words beyond, with the classes
beside them, meet counts and classes in shuffled joins, so results do not depend
on ``DICTIONARY``.

Results: ``n_tokens``, ``n_known``, ``base_score`` (unigram), ``score``.  A null
or empty text holds the end token only.  Rows are told apart by a row number,
so repeated and null ids keep their own rows.  Without training texts all
counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.llm import packed
from strideframe.llm.langid import remainder
from strideframe.llm.stored import small_batches, written

UNITS = 1024
OWN_UNITS = 511  # unit 0 is the end token, 1..511 frequent words, the rest endings
CLASSES = 64
#: occurrences from which on a word has a class by its own contexts
SEEN = 10
ADD = 0.1
TRANSITION = 20.0
#: bound of the words that every task holds (8 + 8 bytes each, and 8 + 8 more if classed by contexts)
DICTIONARY = 500_000
#: distinct (word, contexts) that a task gathers before it hands them on
GATHERED = 1_000_000
#: no word has this hash: it stands for the end token
END = np.uint64(1)


def tokens(data: np.ndarray, offs: np.ndarray):
    """``(hashes, ending units, row offsets)`` of the tokens; end tokens are not among them."""
    low = packed.LOWER[data]
    starts, ends, rows = packed.spans(packed.TOKEN_BYTES[data], offs)
    hashes = packed.hash_spans(low, starts, ends)
    hashes[hashes == END] = np.uint64(2)
    last = low[ends - 1].astype(np.int64)
    before = np.where(ends - starts > 1, low[np.maximum(ends - 2, 0)], 0).astype(np.int64)
    endings = UNITS - OWN_UNITS - 1
    unit = 1 + OWN_UNITS + ((last * 256 + before) * 0x9E3779B1 >> 7) % endings
    return hashes, unit, rows


def _sequence(hashes: np.ndarray, units: np.ndarray, rows: np.ndarray):
    """Insert an end token after each row's tokens: ``(hashes, units, row offsets)``."""
    n = len(rows) - 1
    out_rows = rows + np.arange(n + 1)
    where = np.arange(len(hashes)) + np.repeat(np.arange(n), np.diff(rows))
    h = np.full(len(hashes) + n, END, np.uint64)
    u = np.zeros(len(hashes) + n, np.int64)
    h[where], u[where] = hashes, units
    return h, u, out_rows


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def word_counts(train: DataFrame) -> DataFrame:
    """``word`` (hash), ``unit`` (of its ending), ``n`` over all training texts, the end token among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in packed.slices(batch, "text"):
                h, u, _ = _sequence(*tokens(data, offs))
                values, first, n = np.unique(h, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([_signed(values), pa.array(u[first].astype(np.int32)), pa.array(n)], names=["word", "unit", "n"])

    found = train.select("text").mapInArrow(run, "word long, unit int, n long")
    return found.groupBy("word").agg(F.first("unit").alias("unit"), F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The ``most`` words with the greatest counts, ties by the word."""
    return counts.orderBy(F.desc("n"), "word").limit(most)


def _top(counts: DataFrame, most: int) -> tuple[DataFrame, int]:
    """The words with the greatest counts, at most ``most``, and the count from which on they are taken.

    Counts are looked at in ranges, 1,024 at a time, first all and then those inside the range that the bound falls in.
    """
    top = int(counts.agg(F.max("n")).first()[0] or 0)
    total, low, high = 0, 1, top + 1  # words from ``high`` on are taken, those below ``low`` are not
    while low < high:
        step = -(-(high - low) // 1024)
        inside = counts.filter((F.col("n") >= low) & (F.col("n") < high))
        sizes = inside.groupBy(F.expr(f"(n - {low}) div {step}").alias("range")).agg(F.count("*").alias("words")).orderBy(F.desc("range")).collect()
        below, split = high, False
        for k, words in sizes:
            if total + words > most:
                low, high, split = low + k * step, min(below, low + (k + 1) * step), True
                break
            total, below = total + words, low + k * step
        if not split:
            high = below if sizes else low
            break
        if step == 1:  # words of one count: all or none
            low = high
    return counts.filter(F.col("n") >= high), high


def _sorted_words(df: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, ascending, with the ending units and counts of a bounded table of words."""
    rows = df.select("word", "unit", "n").limit(most + 1).toArrow()
    assert rows.num_rows <= most
    h = rows.column("word").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], rows.column("unit").to_numpy().astype(np.int64)[order], rows.column("n").to_numpy().astype(np.int64)[order]


def _sorted_pairs(df: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    h, _, n = _sorted_words(df if "unit" in df.columns else df.withColumn("unit", F.lit(0)), most)
    return h, n


def _free() -> None:
    """Give memory of finished collects back to the system."""
    pa.default_memory_pool().release_unused()
    packed.trim()


def _lookup(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
    return at, (keys[at] == h) if len(keys) else np.zeros(len(h), bool)


def unit_bigrams(train: DataFrame, own) -> np.ndarray:
    """Counts of consecutive units over all training texts, shape (UNITS, UNITS); row 0 is the text's start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = own.value
        total = np.zeros(UNITS * UNITS, np.int64)
        for batch in batches:
            for part, data, offs in packed.slices(batch, "text"):
                h, u, rows = tokens(data, offs)
                at, known = _lookup(keys, h)
                _, u, rows = _sequence(h, np.where(known, at + 1, u), rows)
                total += np.bincount(np.concatenate([[0], u[:-1]]) * UNITS + u, minlength=UNITS * UNITS)
        at = np.flatnonzero(total)
        for lo in range(0, len(at), 100_000):
            part_at = at[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part_at.astype(np.int32)), pa.array(total[part_at])], names=["pair", "n"])

    found = train.select("text").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(UNITS * UNITS)
    out[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(UNITS, UNITS)


def _units(h: np.ndarray, ending: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Place in ``Model.cls``: the word's own, or else its ending's."""
    at, known = _lookup(own, h)
    return np.where(known, UNITS + at, ending)


def class_bigrams(train: DataFrame, shared, further: DataFrame | None = None) -> np.ndarray:
    """Counts of consecutive classes over all training texts.

    ``shared`` holds the words with a class, ``Model.cls`` and the dictionary;
    ``further`` (``word, cls``) the classes of words beyond it, if any has one.
    """
    apart = further is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cls, keys = shared.value
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for _, data, offs in packed.slices(batch, "text"):
                h, u, rows = tokens(data, offs)
                h, u, _ = _sequence(h, _units(h, u, own), rows)
                c = cls[u]
                pair = np.concatenate([[0], c[:-1]]) * CLASSES + c
                if apart and len(h):
                    known = _known(keys, h)
                    pair = pair[known & np.concatenate([[True], known[:-1]])]
                total += np.bincount(pair, minlength=CLASSES * CLASSES)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["pair", "n"])

    counted = train.select("text").mapInArrow(run, "pair int, n long")
    if apart:
        found = beyond_dictionary(train, shared).join(further, "word", "left").withColumn("cls", F.coalesce("cls", "unit"))
        pairs = F.array(F.when(F.col("before") >= 0, F.col("before") * CLASSES + F.col("cls")), F.col("cls") * CLASSES + F.col("after"))
        found = _with_neighbours(found).select(F.explode(pairs).alias("pair")).filter("pair is not null")
        counted = counted.unionByName(found.groupBy("pair").agg(F.count("*").alias("n")))
    out = np.zeros(CLASSES * CLASSES)
    for pair, n in counted.groupBy("pair").agg(F.sum("n")).collect():
        out[pair] = n
    return out.reshape(CLASSES, CLASSES)


_GAPS = "row long, at int, word long, unit int, before int, after int"


def _gaps(h: np.ndarray, c: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the words beyond the dictionary in a sequence, and the classes before and after them (-1 beside another such word)."""
    at = np.flatnonzero(~known)  # an end token is known, so each has a token after it
    before = np.where(at > 0, np.where(known[at - 1], c[at - 1], -1), 0)
    after = np.where(known[np.minimum(at + 1, len(h) - 1)], c[np.minimum(at + 1, len(h) - 1)], -1)
    return at, before, after


def _known(keys: np.ndarray, h: np.ndarray) -> np.ndarray:
    return _lookup(keys, h)[1] | (h == END)


def beyond_dictionary(texts: DataFrame, shared) -> DataFrame:
    """``row, at, word, unit (class of the ending), before, after``: all occurrences of words that are not in the dictionary.

    ``shared`` holds the words with a class, ``Model.cls`` and the dictionary.
    """
    number = "row_number_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cls, keys = shared.value
        for batch in batches:
            for part, data, offs in packed.slices(batch, "text"):
                h, u, rows = tokens(data, offs)
                h, u, rows = _sequence(h, _units(h, u, own), rows)
                c = cls[u]
                at, before, after = _gaps(h, c, _known(keys, h))
                of = np.searchsorted(rows, at, "right") - 1
                ids = part.column(number).to_numpy()[of]
                cols = [pa.array(ids), *[pa.array(x.astype(np.int32)) for x in (at - rows[of],)], _signed(h[at]), *[pa.array(x.astype(np.int32)) for x in (c[at], before, after)]]
                yield pa.RecordBatch.from_arrays(cols, names=["row", "at", "word", "unit", "before", "after"])

    return texts.select("text", F.monotonically_increasing_id().alias(number)).mapInArrow(run, _GAPS)


def _with_neighbours(found: DataFrame) -> DataFrame:
    """Occurrences with their ``cls``: a class after that was unknown is the next occurrence's."""
    order = Window.partitionBy("row").orderBy("at")
    return found.withColumn("after", F.when(F.col("after") >= 0, F.col("after")).otherwise(F.lead("cls").over(order)))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, code = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(code, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def word_classes(train: DataFrame, shared, log_trans: np.ndarray, log_size: np.ndarray) -> DataFrame:
    """``word`` (place among the wanted words) and ``cls``: the class of greatest likelihood of the word's occurrences.

    ``shared`` holds the words with a class, ``Model.cls`` and the wanted words (hashes, sorted).
    """

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cls, wanted = shared.value
        parts: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

        def rows(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(keys), 100_000):
                k = keys[lo : lo + 100_000]
                pair = (k & (CLASSES * CLASSES - 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array((k // (CLASSES * CLASSES)).astype(np.int32)), pa.array(pair), pa.array(n[lo : lo + 100_000])], names=["word", "pair", "n"])

        for batch in batches:
            for _, data, offs in packed.slices(batch, "text"):
                h, u, row = tokens(data, offs)
                h, u, _ = _sequence(h, _units(h, u, own), row)
                c = cls[u]
                at, known = _lookup(wanted, h)
                i = np.flatnonzero(known)  # an end token is no wanted word, so each has a token after it
                before = np.where(i > 0, c[i - 1], 0)
                parts.append(np.unique((at[i] * CLASSES + before) * CLASSES + c[i + 1], return_counts=True))
                if sum(len(k) for k, _ in parts) > 2 * GATHERED:
                    parts = [_summed(parts)]
                    if len(parts[0][0]) > GATHERED:
                        yield from rows(*parts[0])
                        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        yield from rows(*_summed(parts))

    return _likeliest(train.select("text").mapInArrow(contexts, "word int, pair int, n long"), "int", log_trans, log_size)


def further_classes(train: DataFrame, shared, tail: DataFrame, log_trans: np.ndarray, log_size: np.ndarray) -> DataFrame:
    """The same for the words of ``tail`` (``word``: hashes), which are beyond the dictionary that ``shared`` holds."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cls, keys = shared.value
        for batch in batches:
            for _, data, offs in packed.slices(batch, "text"):
                h, u, rows = tokens(data, offs)
                h, u, _ = _sequence(h, _units(h, u, own), rows)
                c = cls[u]
                i = np.flatnonzero(~_known(keys, h))
                before = np.where(i > 0, c[i - 1], 0)
                pair = before * CLASSES + c[np.minimum(i + 1, len(c) - 1)]
                yield pa.RecordBatch.from_arrays([_signed(h[i]), pa.array(pair.astype(np.int32)), pa.array(np.ones(len(i), np.int64))], names=["word", "pair", "n"])

    found = train.select("text").mapInArrow(contexts, "word long, pair int, n long").join(tail, "word", "left_semi")
    return _likeliest(found, "long", log_trans, log_size)


def _likeliest(contexts: DataFrame, kind: str, log_trans: np.ndarray, log_size: np.ndarray) -> DataFrame:
    """``word, cls`` from counts ``word, pair, n`` of (class before, class after)."""
    # log of p(class | before) and p(after | class), less the emission's denominator
    gain = np.concatenate([log_trans - log_size[None, :], log_trans.T])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                found = part.column("found")
                of = np.repeat(np.arange(len(found)), np.asarray(found.value_lengths()))
                values = found.flatten()
                pair, n = np.asarray(values.field("pair")).astype(np.int64), np.asarray(values.field("n"))
                width = 2 * CLASSES
                seen = np.bincount(of * width + pair // CLASSES, n, len(found) * width) + np.bincount(of * width + CLASSES + pair % CLASSES, n, len(found) * width)
                score = seen.reshape(-1, width) @ gain
                score[:, 0] = -np.inf  # the end token's class
                yield pa.RecordBatch.from_arrays([part.column("word"), pa.array(score.argmax(axis=1).astype(np.int32))], names=["word", "cls"])

    # counts of one word and pair are added up before a word's rows (CLASSES squared at most) come together
    counted = contexts.groupBy("word", "pair").agg(F.sum("n").alias("n"))
    return counted.groupBy("word").agg(F.collect_list(F.struct("pair", "n")).alias("found")).mapInArrow(best, f"word {kind}, cls int")


def exchange(pairs: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """Class of each unit.  Unit 0 keeps class 0 for itself; others move to the class that
    raises the class bigram likelihood most, until a sweep moves nothing."""
    n = len(pairs)
    size = pairs.sum(axis=0) + pairs.sum(axis=1)
    order = np.argsort(-size[1:], kind="stable") + 1
    cls = np.zeros(n, np.int64)
    cls[order] = 1 + np.arange(n - 1) % (classes - 1)
    member = np.eye(classes)[cls]
    table = member.T @ pairs @ member

    def xlog(x):
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)

    least = 1e-9 + 1e-12 * float(xlog(table).sum())  # gains below are rounding
    moved = 1
    while moved:
        moved = 0
        for w in order.tolist():
            if size[w] == 0:
                continue
            old = int(cls[w])
            out_row = pairs[w] @ member  # w followed by class
            in_col = member.T @ pairs[:, w]
            own = pairs[w, w]
            out_row[old] -= own
            in_col[old] -= own
            base = table.copy()
            base[old, :] -= out_row
            base[:, old] -= in_col
            base[old, old] -= own
            # the margins hold w's neighbours, whatever class w goes to
            left, right = base.sum(axis=1) + in_col, base.sum(axis=0) + out_row
            # gain of adding w to class d: its row, its column, the crossing cell, and the margins
            row_gain = (xlog(base + out_row[None, :]) - xlog(base)).sum(axis=1)
            col_gain = (xlog(base + in_col[:, None]) - xlog(base)).sum(axis=0)
            d = np.arange(classes)
            cell = base[d, d]
            cross = xlog(cell + out_row + in_col + own) - xlog(cell + out_row) - xlog(cell + in_col) + xlog(cell)
            o, i = out_row.sum() + own, in_col.sum() + own
            margin = xlog(left + o) - xlog(left) + xlog(right + i) - xlog(right)
            gain = row_gain + col_gain + cross - margin
            gain[0] = -np.inf
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + least:
                new = old
            base[new, :] += out_row
            base[:, new] += in_col
            base[new, new] += own
            table = base
            if new != old:
                cls[w] = new
                member[w] = 0
                member[w, new] = 1
                moved += 1
    return cls


@dataclass
class Model:
    own: np.ndarray  # hashes of the words with a class of their own, sorted
    cls: np.ndarray  # class of each unit, then of each of these words
    log_trans: np.ndarray
    log_size: np.ndarray  # log10 of each class's emission denominator
    keys: np.ndarray  # dictionary: hashes, sorted
    n: np.ndarray
    total: int
    distinct: int


def fit(train: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and the table of all word counts (``word, unit, n, frequent``, and ``cls`` of words beyond the dictionary that have one)."""
    spark = small_batches(train).sparkSession
    counts = written(word_counts(train), "word-counts")
    whole = counts.agg(F.sum("n"), F.count("*")).first()
    total, distinct = int(whole[0] or 0), int(whole[1])
    end = int(END)
    own, _ = _sorted_pairs(_most_frequent(counts.filter(F.col("word") != end), OWN_UNITS), OWN_UNITS)
    top, least = _top(counts, DICTIONARY)
    keys, key_units, n = _sorted_words(top, DICTIONARY)
    shared = spark.sparkContext.broadcast(own)
    pairs = unit_bigrams(train, shared)
    shared.destroy()
    _free()
    units = exchange(pairs)
    cls = np.concatenate([units, units[1 : 1 + len(own)]])
    # how many distinct words each ending has, those with a class of their own among them
    words = np.zeros(UNITS)
    for unit, k in counts.filter(F.col("word") != end).groupBy("unit").agg(F.count("*")).collect():
        words[unit] += k
    words[0] = 1

    def parameters(table: np.ndarray, cls: np.ndarray, endings: np.ndarray, more: list = []) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
        after = table.sum(axis=0)
        share = (after + 1.0) / (after.sum() + CLASSES)
        log_trans = np.log10((table + TRANSITION * share[None, :]) / (table.sum(axis=1, keepdims=True) + TRANSITION))
        distinct = words.copy()
        np.subtract.at(distinct, endings, 1)
        v = np.bincount(cls[UNITS:], minlength=CLASSES).astype(float)
        for unit, c, k in more:  # words beyond the dictionary with a class of their own
            distinct[unit] -= k
            v[c] += k
        v += np.bincount(cls[:UNITS], distinct, CLASSES)
        return log_trans, np.log10(after + ADD * (v + 1))

    is_word = keys != END
    h, ending, times = keys[is_word], key_units[is_word], n[is_word]
    member = np.eye(CLASSES)[units]
    table = member.T @ pairs @ member
    frequent = counts.filter(F.col("word").isin(own.view(np.int64).tolist())).select("word", "unit").collect()
    by_word = {r[0]: r[1] for r in frequent}
    own_endings = np.array([by_word[w] for w in own.view(np.int64).tolist()], np.int64)
    log_trans, log_size = parameters(table, cls, own_endings)
    counts = counts.withColumn("frequent", F.col("n") >= least)
    wanted_too = counts.filter(~F.col("frequent") & (F.col("n") >= SEEN))
    tail_classes = None
    if least > SEEN:
        shared = spark.sparkContext.broadcast((own, cls, keys))
        tail_classes = written(further_classes(train, shared, wanted_too.select("word"), log_trans, log_size), "word-classes")
        shared.destroy()
        _free()
    further = (times >= SEEN) & ~np.isin(h, own)
    endings = own_endings
    if further.any():
        wanted = h[further]
        shared = spark.sparkContext.broadcast((own, cls, wanted))
        found = word_classes(train, shared, log_trans, log_size).toArrow()
        shared.destroy()
        new = np.zeros(len(wanted), np.int64)
        new[found.column("word").to_numpy()] = found.column("cls").to_numpy()
        del found
        _free()
        own = np.concatenate([own, wanted])
        order = np.argsort(own)
        own, cls = own[order], np.concatenate([units, np.concatenate([cls[UNITS:], new])[order]])
        endings = np.concatenate([own_endings, ending[further]])
    if further.any() or tail_classes is not None:
        more = []
        if tail_classes is not None:
            more = [tuple(r) for r in tail_classes.join(counts, "word").groupBy("unit", "cls").agg(F.count("*")).collect()]
        shared = spark.sparkContext.broadcast((own, cls, keys))
        table = class_bigrams(train, shared, tail_classes)
        shared.destroy()
        _free()
        log_trans, log_size = parameters(table, cls, endings, more)
    model = Model(own, cls, log_trans, log_size, keys, n, total, distinct)
    if tail_classes is None:
        return model, counts.withColumn("cls", F.lit(None).cast("int"))
    return model, counts.join(tail_classes, "word", "left")


_ROW = "brown_row_"


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """Every row of ``docs`` without its text, with ``n_tokens, n_known, base_score, score``."""
    spark = small_batches(docs).sparkSession
    added = ("n_tokens", "n_known", "base_score", "score", "part_", "rare_", _ROW)
    kept = docs.drop(*[c for c in docs.columns if c.lower() in added]).withColumn(_ROW, F.monotonically_increasing_id())
    fields = [f for f in kept.schema.fields if f.name != "text"]
    rare_type = T._parse_datatype_string("array<struct<word:long,at:int,unit:int,before:int,after:int>>")
    schema = T.StructType(
        [*fields, T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("part_", T.DoubleType())]
        + [T.StructField("model_", T.DoubleType()), T.StructField("rare_", rare_type)]
    )
    shared = spark.sparkContext.broadcast(model)
    log_c = np.log10

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed.held("brown")
        m = shared.value
        for batch in batches:
            for part, data, offs in packed.slices(batch, "text"):
                h, u, rows = tokens(data, offs)
                u = _units(h, u, m.own)
                h, u, rows = _sequence(h, u, rows)
                row = np.repeat(np.arange(part.num_rows), np.diff(rows))
                values, code = np.unique(h, return_inverse=True)
                at, known = _lookup(m.keys, values)
                c = np.where(known, m.n[at] if len(m.n) else 0, 0)
                logs = log_c(c + ADD)
                logs[~known] = 0.0
                sure = known[code] | (h == END)
                emitted = np.bincount(row, logs[code], part.num_rows)
                n_known = np.bincount(row, known[code], part.num_rows).astype(np.int64)
                cls = m.cls[u]
                steps = m.log_trans[np.concatenate([[0], cls[:-1]]), cls] * (sure & np.concatenate([[True], sure[:-1]])) - m.log_size[cls] * sure
                inner = np.bincount(row, steps, part.num_rows)
                # words beyond the dictionary, with their place and what is beside them
                at, before, after = _gaps(h, cls, sure)
                rare_rows = np.searchsorted(at, rows)
                kinds = [pa.array(x.astype(np.int32)) for x in (at - rows[row[at]], cls[at], before, after)]
                pairs = pa.StructArray.from_arrays([_signed(h[at]), *kinds], ["word", "at", "unit", "before", "after"])
                cols = [part.column(f.name) for f in fields]
                cols += [pa.array(np.diff(rows)), pa.array(n_known), pa.array(emitted), pa.array(inner)]
                cols.append(pa.ListArray.from_arrays(pa.array(rare_rows.astype(np.int32)), pairs))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    base = written(kept.mapInArrow(run, schema), "brown-scores")
    rare = base.select(F.col(_ROW).alias("row"), F.inline("rare_"))
    tail = counts.filter(~F.col("frequent")).select("word", F.col("n").alias("c"), "cls")
    found = _with_neighbours(rare.join(tail, "word", "left").withColumn("cls", F.coalesce("cls", "unit")))
    c = F.coalesce(F.col("c"), F.lit(0))
    trans, size = F.lit(model.log_trans.ravel().tolist()), F.lit(model.log_size.tolist())
    move = lambda a, b: F.element_at(trans, F.col(a) * CLASSES + F.col(b) + 1)
    steps = F.when(F.col("before") >= 0, move("before", "cls")).otherwise(0.0) + move("cls", "after") - F.element_at(size, F.col("cls") + 1)
    looked_up = found.groupBy(F.col("row").alias(_ROW)).agg(
        F.sum(F.log10(c + ADD)).alias("rare_sum"), F.sum((c > 0).cast("int")).alias("rare_known"), F.sum(steps).alias("rare_steps")
    )
    floor = float(np.log10(model.total + ADD * (model.distinct + 1)))
    emitted = F.col("part_") + F.coalesce("rare_sum", F.lit(0.0))
    return base.drop("rare_").join(looked_up, _ROW, "left").select(
        *[f.name for f in fields if f.name != _ROW],
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (emitted - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        (emitted + F.col("model_") + F.coalesce("rare_steps", F.lit(0.0))).alias("score"),
    )


def scores(docs: DataFrame) -> DataFrame:
    """The result of ``op2``: learn where the id's remainder modulo 10 is not 0, score every row."""
    part = remainder("doc_id", 10)
    model, counts = fit(docs.filter(part != 0).select("text"))
    found = score(docs.select("doc_id", "text"), model, counts)
    return found.select("doc_id", F.coalesce(part == 0, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
