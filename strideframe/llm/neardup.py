"""Near-duplicates by ProbMinHash signatures, banding and verification.

A document is its bag of five-word shingles (lower-cased words), each weighted
by its count.  Two documents are linked if their probability Jaccard similarity

    J_P(a, b) = sum over d of 1 / sum over e of max(a_e / a_d, b_e / b_d)

is at least 0.8 (for documents without repeated shingles that is the plain
Jaccard similarity of the shingle sets).

1. Signatures.  Each shingle starts a Poisson process whose rate is its weight;
   each arrival picks one of ``REGISTERS`` registers, and a register keeps the
   shingle that arrived there first.  A document stops as soon as no process
   can beat the latest register any more.  Two registers of the same number
   agree with probability J_P.
2. Copies.  Documents with equal bags form a class; its least row stands for it.
3. Banding.  Representatives whose signatures agree in a whole band share a
   bucket.  Each is compared with the bucket's least member first; pairs that
   agree in at least ``LEAST_AGREE`` registers are verified, and the links are
   joined to components.  Buckets that then still hold several components are
   searched whole: members are dealt in blocks, and within a pair of blocks the
   members of different components that agree enough are verified where they
   are, and only links that join components leave the block.  A pair that shares
   several bands is verified in the first of them only, and the links found join
   the components themselves, not their members again.  A group of thousands of near copies
   costs one pair for each, and no candidate pair between different components
   goes unchecked.
4. Verification computes J_P from the shingles themselves; only the texts of
   candidates are shingled again, so no bags of the whole corpus are stored.

At similarity 0.8 a pair shares no bucket with probability 2e-4 and agrees in
fewer than ``LEAST_AGREE`` registers with probability 3e-5.

Result: for every row ``class_id`` (the least doc_id of its class),
``class_size`` and ``stays`` (true for one row of each class).  A document of
fewer than five words, but not none, has one shingle of all its words; texts
without words are linked to equal texts only; null and empty texts are alone.
Rows are told apart by a row number, so repeated and null ids keep their rows;
repeated rows are copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.functions.sizing import broadcast_if_small
from strideframe.llm import packed
from strideframe.llm.components import components
from strideframe.llm.stored import SMALL_BATCH_BYTES, Scratch, small_batches, unused

SHINGLE = 5
SIMILAR = 0.8
REGISTERS = 64
BAND = 4
LEAST_AGREE = 38
#: members of a bucket that are compared in one task call
BLOCK = 1024
#: shingles of those members, so that long texts make smaller blocks
BLOCK_SHINGLES = 1_000_000
#: shingles of members that are compared with one member at a time (one member's at least)
GATHERED = 1 << 17
#: rows of a slice while signing
ROWS = 2048
#: 64-bit keys that are handed to all tasks; more are joined by shuffle
MAX_BROADCAST_KEYS = 500_000

_U = np.uint64
_LOW48 = _U((1 << 48) - 1)


def bags(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles (48-bit hashes, ascending within a row), their counts, and row offsets."""
    _, _, _, rows, hashes = packed.words(data, offs)
    sh, _, sh_rows = packed.shingle_hashes(hashes, rows, SHINGLE)
    row = np.repeat(np.arange(len(offs) - 1, dtype=_U), np.diff(sh_rows))
    keys, n = np.unique(row << _U(48) | (sh >> _U(16)), return_counts=True)
    return keys & _LOW48, n, np.searchsorted(keys >> _U(48), np.arange(len(offs), dtype=_U))


def signatures(shingles: np.ndarray, weights: np.ndarray, rows: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """ProbMinHash signatures of all rows (uint32, shape (rows, m)); rows without shingles hold zeros."""
    n = len(rows) - 1
    first = np.full(n * m, np.inf)
    signature = np.zeros(n * m, np.uint32)
    row = np.repeat(np.arange(n), np.diff(rows))
    element, weight = shingles, weights.astype(float)
    time = np.zeros(len(element))
    step = 0
    while len(element):
        step += 1
        draw = packed.mix(element + _U(step * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        # 48 bits give the waiting time, other 16 bits the register
        time = time - np.log(((draw >> _U(16)).astype(float) + 0.5) / 2.0**48) / weight
        place = row * m + ((draw & _U(0xFFFF)) % _U(m)).astype(np.int64)
        np.minimum.at(first, place, time)
        won = np.flatnonzero(first[place] == time)
        signature[place[won]] = (packed.mix(element[won]) >> _U(32)).astype(np.uint32)
        latest = first.reshape(n, m).max(axis=1)
        alive = np.flatnonzero(time < latest[row])
        element, weight, time, row = element[alive], weight[alive], time[alive], row[alive]
    return signature.reshape(n, m)


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Exact J_P of two bags (ascending shingles with weights)."""
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    if (wa == 1).all() and (wb == 1).all():
        return len(ia) / (len(a) + len(b) - len(ia))
    x, y = wa[ia].astype(float), wb[ib].astype(float)
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    left = np.searchsorted(ratio, ratio, "left")  # shared shingles with a smaller ratio
    sum_x = np.concatenate([[0.0], np.cumsum(x)])
    sum_y = np.concatenate([[0.0], np.cumsum(y)])
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    bottom = (only_a + sum_x[-1] - sum_x[left]) / x + (only_b + sum_y[left]) / y
    return float((1.0 / bottom).sum())


_SIGNED = "row long, doc_id long, text_key string, n int, digest binary, signature binary"


def _sign(docs: DataFrame) -> DataFrame:
    """Number of shingles, digest of the bag and signature of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed.held("neardup")
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                for part, data, offs in packed.slices(batch.slice(at, ROWS), "text", packed.HASHED_BYTES):
                    sh, n, rows = bags(data, offs)
                    sig = signatures(sh, n, rows)
                    raw = data.tobytes()
                    digests, sigs = [], []
                    for i in range(part.num_rows):
                        a, b = rows[i], rows[i + 1]
                        if a == b:
                            text = raw[offs[i] : offs[i + 1]]
                            digests.append(hashlib.blake2b(text, digest_size=16, key=b"text").digest() if text else None)
                            sigs.append(None)
                        else:
                            w = n[a:b].astype("<u4").tobytes() if (n[a:b] > 1).any() else b""
                            digests.append(hashlib.blake2b(sh[a:b].tobytes() + w, digest_size=16).digest())
                            sigs.append(sig[i].tobytes())
                    cols = [part.column(c) for c in ("row", "doc_id", "text_key")]
                    cols += [pa.array(np.diff(rows).astype(np.int32)), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, names=[f.partition(" ")[0] for f in _SIGNED.split(", ")])

    return docs.mapInArrow(run, _SIGNED)


def _bags(docs: DataFrame) -> DataFrame:
    """``bag_key`` and the packed bag of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed.held("neardup")
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                for part, data, offs in packed.slices(batch.slice(at, ROWS), "text", packed.HASHED_BYTES):
                    sh, n, rows = bags(data, offs)
                    weights = [n[a:b].astype("<u4").tobytes() if (n[a:b] > 1).any() else None for a, b in zip(rows[:-1], rows[1:], strict=True)]
                    cols = [part.column("bag_key"), packed.binary_rows(sh, rows), pa.array(weights, pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, names=["bag_key", "shingles", "weights"])

    return docs.mapInArrow(run, "bag_key long, shingles binary, weights binary")


def _agreeing(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs whose signatures agree in at least ``LEAST_AGREE`` registers, with the keys of their bags."""
    left = reps.select(F.col("rep").alias("u"), F.col("signature").alias("s"), F.col("bag_key").alias("key_u"))
    right = reps.select(F.col("rep").alias("v"), F.col("signature").alias("t"), F.col("bag_key").alias("key_v"))
    kept = ["u", "v", "key_u", "key_v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed.held("neardup")
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, REGISTERS) for c in ("s", "t"))
            at = pa.array(np.flatnonzero((a == b).sum(axis=1) >= LEAST_AGREE))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in kept], names=kept)

    return pairs.join(right, "v").join(left, "u").mapInArrow(run, "u long, v long, key_u long, key_v long")


def _bags_of(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """The bags of the wanted keys: only these texts are read again and shingled."""
    texts = docs.withColumn("bag_key", F.xxhash64("doc_id", "text_key")).select("bag_key", "text")
    found = _bags(texts.join(broadcast_if_small(wanted.distinct(), MAX_BROADCAST_KEYS), "bag_key", "left_semi"))
    return found.dropDuplicates(["bag_key"])  # repeated rows have equal keys and bags


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs ``u, v, key_u, key_v`` whose similarity is at least ``SIMILAR``, with it.

    Only the texts of candidates are read again and shingled; each bag moves
    once, and once more for each pair.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed.held("neardup")
        for batch in batches:
            keep, values = [], []
            cols = [batch.column(c) for c in ("shingles", "weights", "shingles_v", "weights_v")]
            for i in range(batch.num_rows):
                a, wa, b, wb = (c[i].as_buffer() if c[i].is_valid else None for c in cols)
                x, y = np.frombuffer(a, _U), np.frombuffer(b, _U)
                wx = np.frombuffer(wa, "<u4") if wa is not None else np.ones(len(x), np.uint32)
                wy = np.frombuffer(wb, "<u4") if wb is not None else np.ones(len(y), np.uint32)
                near = probability_jaccard(x, wx, y, wy)
                if near >= SIMILAR - 1e-12:
                    keep.append(i)
                    values.append(near)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("u").take(at), batch.column("v").take(at), pa.array(values, pa.float64())], names=["u", "v", "similarity"])

    bags_of = _bags_of(pairs.select(F.explode(F.array("key_u", "key_v")).alias("bag_key")), docs)
    left = bags_of.withColumnRenamed("bag_key", "key_u")
    right = bags_of.select(F.col("bag_key").alias("key_v"), F.col("shingles").alias("shingles_v"), F.col("weights").alias("weights_v"))
    return pairs.join(right, "key_v").join(left, "key_u").mapInArrow(run, "u long, v long, similarity double")


_PLACED = "bucket long, band int, p int, q int, block int, rep long, component long, signature binary, bag_key long"


def _candidates(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of the left block with the rows of the right block that are in other components, agree enough and agree in no
    whole band before this one (a pair that does shares that band's bucket, and is compared there)."""
    block = table.column("block").to_numpy()
    band = table.column("band").to_numpy()
    comp = table.column("component").to_numpy()
    p, q = table.column("p")[0].as_py(), table.column("q")[0].as_py()
    sig = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, REGISTERS)
    left, right = np.flatnonzero(block == p), np.flatnonzero(block == q)
    for k, i in enumerate(left.tolist()):
        others = right[k + 1 :] if p == q else right
        others = others[comp[others] != comp[i]]
        same = sig[others] == sig[i]
        near = same.sum(axis=1) >= LEAST_AGREE
        near[near] = ~same[near][:, : BAND * band[i]].reshape(near.sum(), band[i], BAND).all(axis=2).any(axis=1)
        if near.any():
            yield i, others[near]


def _suspects(table: pa.Table) -> pa.Table:
    """The rows that are in a candidate pair."""
    seen = np.zeros(table.num_rows, bool)
    for i, near in _candidates(table):
        seen[i] = True
        seen[near] = True
    return table.filter(pa.array(seen))


def _links_inside(table: pa.Table) -> pa.Table:
    """Links that join the components of a group: of the candidate pairs whose similarity is at least
    ``SIMILAR``, those between components that no earlier link has joined (at most one for each member), with both components."""
    rep = table.column("rep").to_numpy()
    comp = table.column("component").to_numpy()
    joined = {int(c): int(c) for c in comp}

    def root(c: int) -> int:
        while joined[c] != c:
            joined[c] = c = joined[joined[c]]
        return c

    bag = [np.frombuffer(x, _U) for x in table.column("shingles").to_pylist()]
    size = np.array([len(x) for x in bag])
    weight = [np.ones(n, np.uint32) if x is None else np.frombuffer(x, "<u4") for n, x in zip(size, table.column("weights").to_pylist(), strict=True)]
    total = np.array([x.sum() for x in weight], np.int64)
    starts = np.cumsum(size) - size
    values, code = np.unique(np.concatenate(bag), return_inverse=True)
    count = np.concatenate(weight).astype(np.int64)
    held = np.zeros(len(values), np.int64)
    found: list[tuple[int, int, float, int, int]] = []
    for i, near in _candidates(table):
        apart = np.array([j for j in near.tolist() if root(int(comp[j])) != root(int(comp[i]))], np.int64)
        if not len(apart):
            continue
        own = code[starts[i] : starts[i] + size[i]]
        held[own] = weight[i]
        for part in np.split(apart, np.flatnonzero(np.diff(np.cumsum(size[apart]) // GATHERED)) + 1):
            begin = np.cumsum(size[part]) - size[part]
            at = np.arange(size[part].sum()) + np.repeat(starts[part] - begin, size[part])
            x, y = held[code[at]], count[at]
            shared = np.add.reduceat(x, begin)
            # with equal weights of the shared shingles J_P is shared / all, else it is at most the common part of both shares
            differ = np.logical_or.reduceat((x > 0) & (x != y), begin)
            most = np.add.reduceat(np.minimum(x / total[i], y / np.repeat(total[part], size[part])), begin)
            plain = shared / (total[i] + total[part] - shared)
            for j, uneven, bound, score in zip(part.tolist(), differ.tolist(), most.tolist(), plain.tolist(), strict=True):
                a, b = root(int(comp[i])), root(int(comp[j]))
                if a == b or uneven and bound < SIMILAR - 1e-9:
                    continue
                if uneven:
                    score = probability_jaccard(bag[i], weight[i], bag[j], weight[j])
                if score >= SIMILAR - 1e-12:
                    joined[a] = b
                    found.append((min(rep[i], rep[j]), max(rep[i], rep[j]), score, comp[i], comp[j]))
        held[own] = 0
    u, v, scores, a, b = zip(*found, strict=True) if found else ((), (), (), (), ())
    kinds = {"u": pa.int64(), "v": pa.int64(), "similarity": pa.float64(), "a": pa.int64(), "b": pa.int64()}
    return pa.table({name: pa.array(x, kind) for (name, kind), x in zip(kinds.items(), (u, v, scores, a, b), strict=True)})


def _placed(members: DataFrame) -> DataFrame:
    """Members of buckets with several components, dealt to pairs of blocks."""
    size = members.groupBy("bucket").agg(
        F.count("*").alias("size"), F.sum("n").alias("volume"), F.min("component").alias("a"), F.max("component").alias("b")
    )
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("volume") / BLOCK_SHINGLES)).cast("int")
    mixed = size.filter("a <> b and size > 2").select("bucket", blocks.alias("blocks"))
    placed = members.join(mixed, "bucket").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    p, q = F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q")
    return dealt.select("bucket", "band", p, q, "block", "rep", "component", "signature", "bag_key")


def _labelled(reps: DataFrame, edges: DataFrame) -> DataFrame:
    """The representatives with their ``component``."""
    comp = components(edges).withColumnRenamed("node", "rep")
    return reps.join(comp, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _merged(labels: DataFrame, joined: DataFrame) -> DataFrame:
    """``labels`` after links between the components ``u, v`` of ``joined``."""
    comp = components(joined).select(F.col("node").alias("component"), F.col("component").alias("least"))
    found = labels.join(broadcast_if_small(comp, MAX_BROADCAST_KEYS), "component", "left")
    return found.withColumn("component", F.coalesce("least", "component")).drop("least")


def find_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``, both written.

    ``members`` has a row for each row of ``docs``: ``row`` (its number in the
    scan), ``doc_id, text_key`` (digest of the text), ``class_id, class_size,
    stays``; ``links`` has verified links ``u, v, similarity`` between the rows
    that stand for groups of copies, enough of them to connect each class.
    """
    store = Scratch(small_batches(docs, SMALL_BATCH_BYTES).sparkSession, "neardup")
    key = F.md5(F.col("text").cast("binary")).alias("text_key")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), key, "text")
    signed = store.write(_sign(rows), "signed")
    # copies: the least row of each digest stands for all
    member = F.struct("row", "signature", "n", F.xxhash64("doc_id", "text_key").alias("bag_key"))
    groups = signed.filter("digest is not null").groupBy("digest").agg(F.min(member).alias("r"))
    reps = store.write(groups.select("digest", F.col("r.row").alias("rep"), "r.n", "r.signature", "r.bag_key"), "reps")
    bands = [F.xxhash64(F.lit(b), F.substring("signature", 4 * BAND * b + 1, 4 * BAND)) for b in range(REGISTERS // BAND)]
    banded = reps.filter("signature is not null").select("rep", F.posexplode(F.array(*bands)).alias("band", "bucket"))
    heads = banded.groupBy("bucket").agg(F.min("rep").alias("head"), F.count("*").alias("size")).filter("size > 1").select("bucket", "head")
    in_buckets = store.write(banded.join(heads, "bucket"), "buckets")
    stars = in_buckets.filter("rep <> head").select(F.col("head").alias("u"), F.col("rep").alias("v")).distinct()
    near = store.write(_agreeing(stars, reps), "near-stars")
    links = store.write(_verified(near, rows), "star-links")
    labels = _labelled(reps, links.select("u", "v"))
    members = in_buckets.select("bucket", "band", "rep").join(labels.drop("digest"), "rep")
    suspects = store.write(_placed(members).groupBy("bucket", "p", "q").applyInArrow(_suspects, _PLACED), "suspects")
    with_bags = suspects.join(_bags_of(suspects.select("bag_key"), rows), "bag_key")
    inside = with_bags.groupBy("bucket", "p", "q").applyInArrow(_links_inside, "u long, v long, similarity double, a long, b long")
    more = store.write(inside.dropDuplicates(["u", "v"]), "bucket-links")
    links = store.write(links.unionByName(more.select("u", "v", "similarity")).dropDuplicates(["u", "v"]), "links")
    if not more.isEmpty():
        labels = _merged(labels, more.select(F.col("a").alias("u"), F.col("b").alias("v")))
    placed = (
        signed.select("row", "doc_id", "text_key", "digest")
        .join(labels.select("digest", "component"), "digest", "left")
        .withColumn("component", F.coalesce("component", "row"))
    )
    classes = placed.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"), F.min("row").alias("first"))
    members = placed.join(classes, "component").select(
        "row", "doc_id", "text_key", "class_id", "class_size", (F.col("row") == F.col("first")).alias("stays")
    )
    members = store.write(members, "members")
    store.drop(keep=("members", "links"))
    return members, links


def report(docs: DataFrame) -> DataFrame:
    """The result of ``op5``: the class of every document."""
    members, _ = find_classes(docs)
    return members.select("doc_id", "class_id", "class_size", "stays")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one of each class, with all columns.

    A row is found again by its id and the digest of its text.  Rows that have
    both in common are copies, of which one stays or none.
    """
    members, _ = find_classes(docs)
    by_key = members.groupBy("doc_id", "text_key").agg(F.max("stays").alias("stays"), F.count("*").alias("n"))
    key = F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text_key", F.lit("null")))
    on = [unused("key_", docs), unused("whole_", docs)]
    named = [F.xxhash64(key).alias(on[0]), key.alias(on[1])]
    leaving = by_key.filter("not stays").select(*named)
    repeated = by_key.filter("stays and n > 1").select(*named)
    own = F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("null")))
    marked = docs.withColumn(on[1], own).withColumn(on[0], F.xxhash64(on[1]))
    stays = marked.join(broadcast_if_small(leaving, MAX_BROADCAST_KEYS), on, "left_anti")
    if not repeated.isEmpty():
        again = broadcast_if_small(repeated, MAX_BROADCAST_KEYS)
        stays = stays.join(again, on, "left_anti").unionByName(stays.join(again, on, "left_semi").dropDuplicates(on))
    return stays.select(*docs.columns)
