"""Alignment of the tokens of two tokenizers, as an Arrow pipeline.

A (byte-level BPE, ``tokenizers``) encodes a space and the text; B (BPE with
byte fallback, ``sentencepiece``) encodes the text, to which it adds the space.
Both turn the same bytes into tokens, so byte offsets tell what corresponds.

For the texts of a slice, tokens are lists: flattened, with the parent index of
each token, their byte lengths are summed by segment, which gives the offset
in its document where each token ends.  An Acero hash join on (document, end)
finds the offsets where tokens of both end.  They cut the document into groups,
and are its links, pairs of tokens whose ranges end together.  ``Table.group_by``
counts the linked pairs of ids of each document, and of many documents together;
Spark adds these partial counts up, and finds for each id of B the highest.

The libraries encode each distinct chunk once.  A chunk begins with a space or
line end that follows a character which is no white space: no token of either
vocabulary holds these after another character, and A's pre-token pattern looks
no further back (``Coder`` checks the first for B's pieces).

The counts of the ``HELD`` most frequent pairs are held by each task, the others
meet their documents in a shuffled join; results do not depend on ``HELD``.

Null and empty texts, and texts whose tokens' bytes are not the space and the
text (B's mark U+2581 reads as a space), have no tokens: zeros and ''.
Repeated rows and ids count each; the counts are sums, so ties and the order of
rows do not matter.  Texts of any length are aligned whole; an empty table gives
an empty table; other columns are kept and columns of the added names replaced.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.llm import packed
from strideframe.llm.bpe import PRE_TOKEN, _gather, byte_symbols
from strideframe.llm.stored import Scratch, small_batches, unused

SLICE_BYTES = 2 << 20
#: distinct chunks are encoded in blocks of about so many bytes
BLOCK_BYTES = 128 << 10
#: encoded chunks that a worker keeps for later slices, until there are more
KNOWN = 300_000
#: counts of pairs held by each task (17 bytes each)
HELD = 500_000
#: linked pairs that are counted together in a task
COUNTED = 2_000_000

ADDED = ("align_n_a", "align_n_b", "align_n_groups", "align_n_links", "align_groups", "align_pairs", "align_times")

_MARK = "▁"


class Coder:
    """One tokenizer: ids of texts that begin with white space, and the bytes of each id."""

    def __init__(self, encode: Callable[[str], np.ndarray], tokens: list[bytes]):
        self.encode = encode
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.raw = np.frombuffer(b"".join(tokens), np.uint8)
        self.start = np.cumsum(self.size) - self.size
        self.names = pa.array([str(i) for i in range(len(tokens))], pa.string())
        self.known = pa.array([], pa.binary())
        self.ids, self.offs, self.same = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, bool)

    @classmethod
    def byte_level(cls, spec: bytes) -> Coder:
        """The byte-level BPE of a tokenizer file; ``tiktoken`` runs it if the ids are the merges' ranks, which is faster."""
        model = json.loads(spec)["model"]
        ids = model["vocab"]
        unit = {s: b for b, s in byte_symbols().items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = [ids[x + y] for x, y in merges]
        plain = [t for t in ids if all(c in unit for c in t)]
        ranks = {bytes(unit[c] for c in t): ids[t] for t in plain if len(t) == 1}
        ranks |= {bytes(unit[c] for c in x + y): i for (x, y), i in zip(merges, made, strict=True)}
        tokens = [b""] * (1 + max(ids.values()))
        for text in plain:
            tokens[ids[text]] = bytes(unit[c] for c in text)
        if made == sorted(made) and len(ranks) == len(set(made)) + 256 and min(made) > max(i for t, i in ranks.items() if len(t) == 1):
            import tiktoken

            coding = tiktoken.Encoding("byte-level", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})
            return cls(lambda text: coding.encode_to_numpy(text, disallowed_special=()).astype(np.int32), tokens)
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(spec.decode())
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.encode_special_tokens = True
        return cls(lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.int32), tokens)

    @classmethod
    def pieces(cls, model: bytes) -> Coder:
        """A piece model with byte fallback."""
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [processor.id_to_piece(i) for i in range(processor.vocab_size())]
        tokens = [bytes([int(p[3:5], 16)]) if processor.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(names)]
        if any(_MARK in p.lstrip(_MARK) or "\n" in p for p in names):
            raise ValueError("a piece holds white space after another character: chunks cannot be encoded apart")
        # a word in front keeps the processor from adding its own space; it is cut off again
        front = len(processor.encode("x"))
        return cls(lambda text: np.array(processor.encode("x" + text)[front:], np.int32), tokens)

    def _encode_new(self, chunks: pa.Array, joinable: np.ndarray) -> None:
        """Learn chunks.  Those that can stand in front of others are encoded in blocks
        and cut apart at the byte offsets of their ends, all others one by one."""
        raw = chunks.to_pylist()
        order: list[int] = []
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        alone = np.flatnonzero(~joinable).tolist()
        rows = np.flatnonzero(joinable)
        length = pc.binary_length(chunks).to_numpy().astype(np.int64)
        block = np.cumsum(length[rows]) // BLOCK_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(rows)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            members = rows[lo:hi]
            text = b"".join([raw[i] for i in members.tolist()])
            found = self.encode(text.decode())
            ends = np.cumsum(self.size[found])
            bounds = np.cumsum(length[members])
            at = np.searchsorted(ends, bounds)
            if self.bytes_of(found) == text and (ends[at] == bounds).all():
                order += members.tolist()
                ids.append(found)
                sizes.append(np.diff(at, prepend=-1))
            else:
                alone += members.tolist()
        same = np.ones(len(raw), bool)
        for i in alone:
            ids.append(self.encode(raw[i].decode()))
            same[i] = self.bytes_of(ids[-1]) == raw[i]
        order += alone
        sizes.append(np.array([len(x) for x in ids[len(ids) - len(alone) :]], np.int64))
        places = np.array(order, np.int64)
        self.known = pa.concat_arrays([self.known, chunks.take(pa.array(places))])
        self.ids = np.concatenate([self.ids, *ids])
        self.offs = np.concatenate([self.offs, self.offs[-1] + np.cumsum(np.concatenate(sizes))])
        self.same = np.concatenate([self.same, same[places]])

    def tokens(self, chunks: pa.DictionaryArray, joinable: np.ndarray, chunk_rows: np.ndarray) -> tuple[pa.ListArray, np.ndarray]:
        """Tokens of each document as a list, and whether the tokens of each of its chunks give its bytes back."""
        if len(self.known) > KNOWN:
            self.known = self.known.slice(0, 0)
            self.ids, self.offs, self.same = self.ids[:0], self.offs[:1], self.same[:0]
        fresh = pc.is_null(pc.index_in(chunks.dictionary, value_set=self.known)).to_numpy(zero_copy_only=False)
        if fresh.any():
            self._encode_new(chunks.dictionary.filter(pa.array(fresh)), joinable[fresh])
        place = pc.index_in(chunks.dictionary, value_set=self.known).take(chunks.indices)
        by_chunk = pa.ListArray.from_arrays(pa.array(self.offs.astype(np.int32)), pa.array(self.ids)).take(place)
        ends = by_chunk.offsets.to_numpy()
        lists = pa.ListArray.from_arrays(pa.array((ends[chunk_rows] - ends[0]).astype(np.int32)), pc.list_flatten(by_chunk))
        return lists, self.same[place.to_numpy()]

    def bytes_of(self, ids: np.ndarray) -> bytes:
        return _gather(self.raw, self.start, self.size, ids.astype(np.int64), np.zeros(1, np.int64))[0].tobytes()


_SPACE_ENDS = np.zeros(256, bool)
_SPACE_ENDS[:33] = _SPACE_ENDS[127] = True


def _solid(data: np.ndarray) -> np.ndarray:
    """Whether the character that ends at each byte is surely no white space and no U+2581 (all of theirs begin with C2, E1, E2 or E3)."""
    out = ~_SPACE_ENDS[data]
    two = np.concatenate([np.zeros(1, np.uint8), data[:-1]])
    three = np.concatenate([np.zeros(2, np.uint8), data[:-2]])[: len(data)]
    wide = data >= 0x80
    out &= ~(wide & ((two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3))))
    return out


def _cut(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Spaced texts (empty ones stay empty) as ``bytes, offsets``, the starts of their chunks, and the texts' offsets among these."""
    some = np.diff(offs) > 0
    spaced = np.insert(data, offs[:-1][some], np.uint8(0x20))
    rows = offs + np.concatenate([[0], np.cumsum(some)])
    solid = _solid(spaced)
    start = np.zeros(len(spaced), bool)
    start[1:] = ((spaced[1:] == 0x20) | (spaced[1:] == 0x0A)) & solid[:-1]
    start[rows[:-1][some]] = True
    starts = np.flatnonzero(start)
    return spaced, rows, starts, np.searchsorted(starts, rows)


def _ends(coder: Coder, tokens: pa.ListArray) -> tuple[pa.Array, pa.Array]:
    """Flat ids, and a key of document and end offset for each token (a segmented running sum of byte lengths)."""
    ids = pc.list_flatten(tokens)
    parent = pc.list_parent_indices(tokens).to_numpy()
    total = np.concatenate([[0], pc.cumulative_sum(pa.array(coder.size).take(ids)).to_numpy()])
    end = total[1:] - total[tokens.offsets.to_numpy()[:-1] - tokens.offsets[0].as_py()][parent]
    return ids, pa.array(parent.astype(np.int64) << 32 | end)


def _joined(names: pa.Array, ids: pa.Array, last: np.ndarray) -> pa.Array:
    """The ids of each group, joined by commas; ``last`` holds the place of each group's last token."""
    offsets = pa.array(np.concatenate([[0], last + 1]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(ids)), ",")


class Aligned:
    """The alignment of the documents of one slice."""

    def __init__(self, a: Coder, b: Coder, data: np.ndarray, offs: np.ndarray):
        n = len(offs) - 1
        spaced, rows, starts, chunk_rows = _cut(data, offs)
        ends = np.concatenate([starts[1:], [len(spaced)]]) if len(starts) else starts
        raw = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(spaced)).astype(np.int32)), pa.py_buffer(spaced)])
        chunks = raw.dictionary_encode()
        first = np.full(len(chunks.dictionary), len(starts))
        np.minimum.at(first, chunks.indices.to_numpy(), np.arange(len(starts)))
        joinable = _solid(spaced)[ends[first] - 1] if len(starts) else np.zeros(0, bool)
        joinable &= ~pc.match_substring(chunks.dictionary, _MARK.encode()).to_numpy(zero_copy_only=False)
        (tokens_a, same_a), (tokens_b, same_b) = (c.tokens(chunks, joinable, chunk_rows) for c in (a, b))
        doubtful = np.add.reduceat(np.append(~(same_a & same_b), False), chunk_rows[:-1]) * (np.diff(chunk_rows) > 0) if n else np.zeros(0, int)
        empty = np.zeros(n, bool)
        for i in np.flatnonzero(doubtful).tolist():
            text = spaced[rows[i] : rows[i + 1]].tobytes()
            empty[i] = any(c.bytes_of(np.array(t[i].as_py(), np.int32)) != text for c, t in ((a, tokens_a), (b, tokens_b)))
        if empty.any():
            tokens_a, tokens_b = (pc.if_else(pa.array(empty), pa.scalar([], t.type), t) for t in (tokens_a, tokens_b))
        ids_a, key_a = _ends(a, tokens_a)
        ids_b, key_b = _ends(b, tokens_b)
        self.n_a, self.n_b = (t.value_lengths().to_numpy().astype(np.int64) for t in (tokens_a, tokens_b))
        left = pa.table({"key": key_a, "at_a": np.arange(len(ids_a))})
        right = pa.table({"key": key_b, "at_b": np.arange(len(ids_b))})
        met = left.join(right, "key", join_type="inner", use_threads=False)
        # offsets rise with places on both sides, so sorted places go together
        at_a, at_b = (np.sort(met.column(c).to_numpy()) for c in ("at_a", "at_b"))
        doc = key_a.to_numpy()[at_a] >> 32
        bounds = np.searchsorted(doc, np.arange(n + 1))
        self.n_links = np.diff(bounds)
        groups = pc.binary_join_element_wise(_joined(a.names, ids_a, at_a), _joined(b.names, ids_b, at_b), "|")
        self.groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), groups), ";")
        pair = ids_a.to_numpy()[at_a].astype(np.int64) << 32 | ids_b.to_numpy()[at_b]
        counted = pa.table({"doc": doc, "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
        of, times = counted.column("doc").to_numpy(), counted.column("count_all").to_numpy()
        order = np.argsort(of, kind="stable")
        self.pairs, self.times = counted.column("pair").to_numpy()[order], times[order].astype(np.int32)
        self.pair_rows = np.searchsorted(of[order], np.arange(n + 1))


class _Files:
    """The two tokenizer files as broadcast bytes, with a key that is stable within a worker."""

    def __init__(self, docs: DataFrame, path_a: str, path_b: str):
        raw = []
        for path in (path_a, path_b):
            with open(path, "rb") as f:
                raw.append(f.read())
        context = docs.sparkSession.sparkContext
        self.handle = context.broadcast(tuple(raw))
        self.key = f"align {context.applicationId}/{self.handle._jbroadcast.id()}"

    def __getstate__(self):
        return {"handle": self.handle, "key": self.key}

    def coders(self) -> tuple[Coder, Coder]:
        return packed.held(self.key, lambda: (Coder.byte_level(self.handle.value[0]), Coder.pieces(self.handle.value[1])))


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", digest: bool = False, keep_text: bool = True) -> DataFrame:
    """Add each document's alignment.

    ``align_n_a, align_n_b, align_n_groups, align_n_links`` (long);
    ``align_groups``: the groups, ``a1,a2|b1;a3|b2,b3``, or with ``digest`` their
    SHA-256; ``align_pairs`` (``a << 32 | b`` as little-endian 64-bit integers)
    and ``align_times`` (32-bit): the different linked pairs and how often the
    document links each.
    """
    files = _Files(docs, path_a, path_b)
    kept = small_batches(docs.drop(*[c for c in docs.columns if c.lower() in ADDED and c.lower() != text.lower()]))
    fields = [f for f in kept.schema.fields if keep_text or f.name != text]
    kinds = [T.LongType()] * 4 + [T.StringType()] + [T.BinaryType()] * 2
    schema = T.StructType([*fields, *[T.StructField(c, k) for c, k in zip(ADDED, kinds, strict=True)]])
    names, own = schema.names, [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = files.coders()
        for batch in batches:
            for part, data, offs in packed.slices(batch, text, SLICE_BYTES):
                found = Aligned(a, b, data, offs)
                groups = found.groups
                if digest:
                    groups = pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups.to_pylist()], pa.string())
                numbers = [pa.array(x) for x in (found.n_a, found.n_b, found.n_links, found.n_links)]
                lists = [packed.binary_rows(x, found.pair_rows) for x in (found.pairs, found.times)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in own], *numbers, groups, *lists], names=names)

    return kept.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, a, b, n, best``: links of each pair of ids in all documents, and whether no other pair of its ``b`` has more."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed.held("align counts")
        parts: list[pa.Table] = []
        held = 0

        def counted() -> Iterator[pa.RecordBatch]:
            summed = pa.concat_tables(parts).group_by("pair", use_threads=False).aggregate([("n", "sum")])
            yield from summed.select(["pair", "n_sum"]).rename_columns(["pair", "n"]).to_batches()

        for batch in batches:
            pairs, times = (np.frombuffer(packed.text_bytes(batch.column(c).cast(pa.large_binary()))[0], kind) for c, kind in (("align_pairs", "<i8"), ("align_times", "<i4")))
            parts.append(pa.table({"pair": pairs, "n": times.astype(np.int64)}))
            held += len(pairs)
            if held > COUNTED:
                yield from counted()
                parts, held = [], 0
        if parts:
            yield from counted()

    summed = aligned.select("align_pairs", "align_times").mapInArrow(partial, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = summed.select("pair", F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b"), "n")
    counts = Scratch(aligned.sparkSession, "align-counts").write(counts, "counts")
    best = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(best, "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def link_scores(aligned: DataFrame, counts: DataFrame, held: int = HELD) -> DataFrame:
    """``aligned`` without its pairs, with ``align_n_best`` (links whose pair is the best of its ``b``) and ``align_count_sum`` (over links).

    ``aligned`` and ``counts`` are read more than once: written tables are meant.
    """
    spark = aligned.sparkSession
    top = counts.orderBy(F.desc("n"), "pair").limit(held).select("pair", "n", "best").toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast(tuple(top.column(c).to_numpy() for c in ("pair", "n", "best")))
    more = top.num_rows == held and counts.count() > held
    row, rest = unused("align_row", aligned), unused("align_rest", aligned)
    base = small_batches(aligned).withColumn(row, F.monotonically_increasing_id())
    fields = [f for f in base.schema.fields if f.name not in ("align_pairs", "align_times")]
    schema = T.StructType([*fields, T.StructField("align_n_best", T.LongType()), T.StructField("align_count_sum", T.LongType())])
    schema.add(rest, T._parse_datatype_string("array<struct<pair:long,times:int>>"))
    names, own = schema.names, [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed.held("align scores")
        keys, n, best = shared.value
        for batch in batches:
            raw, offs = packed.text_bytes(batch.column("align_pairs").cast(pa.large_binary()))
            pairs, rows = np.frombuffer(raw, "<i8"), offs // 8
            times = np.frombuffer(packed.text_bytes(batch.column("align_times").cast(pa.large_binary()))[0], "<i4").astype(np.int64)
            values, code = np.unique(pairs, return_inverse=True)
            at = np.minimum(np.searchsorted(keys, values), max(len(keys) - 1, 0))
            known = keys[at] == values if len(keys) else np.zeros(len(values), bool)
            weight = np.where(known, n[at], 0) if len(keys) else np.zeros(len(values), np.int64)
            is_best = known & best[at] if len(keys) else known
            sums = [np.diff(np.concatenate([[0], np.cumsum(times * x[code])])[rows]) for x in (is_best, weight)]
            beyond = np.flatnonzero(~known[code])
            others = pa.StructArray.from_arrays([pa.array(pairs[beyond]), pa.array(times[beyond].astype(np.int32))], ["pair", "times"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(beyond, rows).astype(np.int32)), others)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in own], *map(pa.array, sums), lists], names=names)

    scored = base.mapInArrow(run, schema)
    kept = [c for c in names if c not in (row, rest)]
    if not more:
        return scored.select(*kept)
    scored = Scratch(spark, "align-scores").write(scored, "scores")
    looked_up = (
        scored.select(row, F.inline(rest))
        .join(counts.select("pair", "n", "best"), "pair")
        .groupBy(row)
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    )
    total = {"align_n_best": "more_best", "align_count_sum": "more_sum"}
    return scored.join(looked_up, row, "left").select(*[(F.col(c) + F.coalesce(total[c], F.lit(0))).alias(c) if c in total else c for c in kept])


def digests(docs: DataFrame, path_a: str, path_b: str, held: int = HELD) -> DataFrame:
    """The result of ``op13`` for every row of ``docs`` (``doc_id``, ``text``)."""
    spark = docs.sparkSession
    found = align(docs.select("doc_id", "text"), path_a, path_b, digest=True, keep_text=False)
    aligned = Scratch(spark, "aligned").write(found, "documents")
    counts = Scratch(spark, "align-pairs").write(pair_counts(aligned), "pairs")
    scored = link_scores(aligned, counts, held)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return scored.select(F.col("doc_id").cast("long"), *[F.col(f"align_{c}").alias(c) for c in names], F.col("align_groups").alias("groups_sha256"))
