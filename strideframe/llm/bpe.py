"""Byte-level BPE encoding and decoding with a pair occurrence index.

The distinct pre-tokens that a task has not met yet are encoded together.  All
their symbols lie in one array; an index maps each adjacent pair to the list of
its positions in that array.  The ranks whose pair occurs (the active ranks)
are applied in ascending order: a rank is applied to all its positions from
left to right, and each merge adds the pairs that it creates to their lists,
which activates further ranks.  Words are independent, so this gives for each
word what merging the lowest rank first gives.

Vocabulary and merges are read from a public tokenizer file by the driver and
broadcast; the file bounds their size.  A task keeps the encodings of up to
``CACHE_WORDS`` pre-tokens.

Texts: null and empty texts have no tokens and decode to an empty text; texts
of any length are encoded whole.  Equal texts have equal results; the operator
is row-wise, so ties, repeated rows, null ids and further columns pass through.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.llm import packed
from strideframe.llm.stored import BATCH_BYTES, small_batches

CACHE_WORDS = 200_000
#: text encoded at a time: the more, the fewer distinct words
SLICE_BYTES = 8 << 20
#: bytes of new pre-tokens that are merged at a time: each takes some 200 bytes meanwhile
MERGED_BYTES = 128 << 10

#: Fixed value: the pre-token pattern of byte-level BPE vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    rest = (b for b in range(256) if b not in table)
    return table | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def load_vocabulary(path: str) -> dict:
    """Ids, merges and special tokens of a tokenizer file, as plain arrays that can be broadcast."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ids = spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    merges = []
    for pair in spec["model"]["merges"]:
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges.append((ids[left], ids[right], ids[left + right]))
    unit = {s: b for b, s in byte_symbols().items()}
    tokens = [b""] * (1 + max([*ids.values(), *special.values()]))
    for text, i in ids.items():
        tokens[i] = bytes(unit[ch] for ch in text)
    for text, i in special.items():
        tokens[i] = text.encode()
    return {
        "merges": np.array(merges, np.int32).reshape(-1, 3),
        "tokens": tokens,
        "bytes": np.array([ids[s] for _, s in sorted(byte_symbols().items())], np.int32),
        "special": special,
    }


class PairIndexEncoder:
    def __init__(self, vocabulary: dict, cache_words: int = CACHE_WORDS):
        self.cache_words = cache_words
        self.tokens = vocabulary["tokens"]
        self.special = {s: int(i).to_bytes(4, "little") for s, i in vocabulary["special"].items()}
        self.byte_ids = vocabulary["bytes"]
        merges = vocabulary["merges"].astype(np.int64)
        self.left, self.right, self.made = (merges[:, k].tolist() for k in range(3))
        pair = (merges[:, 0] << 32) | merges[:, 1]
        self.rank = dict(zip(pair.tolist(), range(len(pair)), strict=True))
        self.split = regex.compile(PRE_TOKEN).findall
        special = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.cut = regex.compile(f"({special})").split if special else None
        self.known: dict[str, bytes] = {}
        self.known_after_space: dict[str, bytes] = {}

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Encode distinct pre-tokens together; each result holds little-endian 32-bit ids."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        bounds = np.concatenate([[0], np.cumsum([len(b) for b in raw], dtype=np.int64)])
        ids = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)].astype(np.int64)
        n = len(ids)
        if not n:
            return [b""] * len(words)
        rank, lefts, rights, made = self.rank, self.left, self.right, self.made
        # the index: positions of each pair that has a rank, by one sort
        inside = np.ones(n, bool)
        inside[bounds[1:][bounds[1:] > 0] - 1] = False
        first = np.flatnonzero(inside)
        pairs = (ids[first] << 32) | ids[np.minimum(first + 1, n - 1)]
        order = np.argsort(pairs, kind="stable")
        pairs, first = pairs[order], first[order]
        cuts = np.flatnonzero(np.diff(pairs, prepend=-1))
        at: dict[int, list[int]] = {}
        for key, lo, hi in zip(pairs[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(pairs)][: len(cuts)], strict=True):
            r = rank.get(key)
            if r is not None:
                at[r] = first[lo:hi].tolist()
        nxt = np.arange(1, n + 1)
        nxt[~inside] = -1
        prev = np.arange(-1, n - 1)
        prev[bounds[:-1][bounds[:-1] < n]] = -1
        sym, nxt, prev = ids.tolist(), nxt.tolist(), prev.tolist()
        active = list(at)
        heapify(active)
        find = rank.get
        while active:
            r = heappop(active)
            left, right, new = lefts[r], rights[r], made[r]
            for i in sorted(at.pop(r)):
                j = nxt[i]
                if sym[i] != left or j < 0 or sym[j] != right:
                    continue
                sym[i], sym[j] = new, -1
                k = nxt[i] = nxt[j]
                if k >= 0:
                    prev[k] = i
                    q = find((new << 32) | sym[k])
                    if q is not None:
                        if q in at:
                            at[q].append(i)
                        else:
                            at[q] = [i]
                            heappush(active, q)
                h = prev[i]
                if h >= 0:
                    q = find((sym[h] << 32) | new)
                    if q is not None:
                        if q in at:
                            at[q].append(h)
                        else:
                            at[q] = [h]
                            heappush(active, q)
        ids = np.array(sym, np.int64)
        keep = ids >= 0
        ends = (4 * np.concatenate([[0], np.cumsum(keep)])[bounds]).tolist()
        packed_ids = ids[keep].astype("<u4").tobytes()
        return [packed_ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text, special tokens among them."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.split(text)
        out: list[str] = []
        for part in self.cut(text):
            if part in self.special:
                out.append(part)
            else:
                out.extend(self.split(part))
        return out

    def _learn(self, split: list[list[str]]) -> None:
        new = list({w for words in split for w in words if w not in self.known})
        ends = np.cumsum([len(w.encode("utf-8", "surrogatepass")) for w in new])
        at = 0
        while at < len(new):
            # a longer pre-token is merged alone
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + MERGED_BYTES, "right")))
            self.known.update(zip(new[at:end], self.encode_words(new[at:end]), strict=True))
            at = end

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        flat, offs = self.encode_column(pa.array(texts, pa.string()))
        raw = flat.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and their offsets.

        A pre-token can only contain a space as its first character, unless
        white space stands before that space.  Texts without white space before
        a space are therefore cut at spaces, and each distinct piece is encoded
        once; other texts are cut into their pre-tokens.
        """
        for cache in (self.known, self.known_after_space):
            if len(cache) > self.cache_words:
                cache.clear()
        self.known.update(self.special)
        odd = pc.match_substring_regex(texts, r"[\s\pZ\x0b\x1c-\x1f\x85] ").to_numpy(zero_copy_only=False)
        for name in self.special:
            odd = odd | pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(texts, " ")
        codes = cut.flatten().dictionary_encode()
        pieces, codes = codes.dictionary, codes.indices.to_numpy().astype(np.int64)
        offs = cut.offsets.to_numpy().astype(np.int64) - cut.offsets[0].as_py()
        # the first piece of a text has no space before it; odd texts are one piece of their own
        heads, odd_rows = offs[:-1], np.flatnonzero(odd)
        plain = np.ones(len(codes), bool)
        plain[heads] = False
        for i in odd_rows.tolist():
            plain[offs[i] : offs[i + 1]] = False
        used = np.zeros(len(pieces), bool)
        used[codes[plain]] = True
        used = np.flatnonzero(used)
        words = pieces.take(pa.array(used)).to_pylist()
        spaced = self.known_after_space
        known = list(map(spaced.get, words))
        fresh = [w for w, ids in zip(words, known, strict=True) if ids is None]
        fresh_split = [self.split(" " + w) for w in fresh]
        first = pieces.take(pa.array(codes[heads])).to_pylist()
        head_split = [self.split(w) for w in first]
        for i in odd_rows.tolist():
            head_split[i] = self.pieces(texts[i].as_py())
        self._learn(fresh_split + head_split)
        get = self.known.__getitem__
        fresh_ids = [b"".join(map(get, parts)) for parts in fresh_split]
        spaced.update(zip(fresh, fresh_ids, strict=True))
        entry = [b""] * len(pieces)
        rest = iter(fresh_ids)
        for k, ids in zip(used.tolist(), known, strict=True):
            entry[k] = next(rest) if ids is None else ids
        entry += [b"".join(map(get, parts)) for parts in head_split]
        entry.append(b"")
        codes[~plain] = len(entry) - 1
        codes[heads] = len(pieces) + np.arange(len(heads))
        size = np.array([len(x) for x in entry], np.int64) // 4
        flat = np.frombuffer(b"".join(entry), "<u4")
        return _gather(flat, np.cumsum(size) - size, size, codes, offs)

    def decode_column(self, ids: np.ndarray, offs: np.ndarray) -> pa.Array:
        """The texts of packed ids."""
        if not hasattr(self, "token_bytes"):
            self.token_size = np.array([len(t) for t in self.tokens], np.int64)
            self.token_bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
            self.token_start = np.cumsum(self.token_size) - self.token_size
        raw, ends = _gather(self.token_bytes, self.token_start, self.token_size, ids.astype(np.int64), offs)
        out = pa.Array.from_buffers(pa.large_binary(), len(offs) - 1, [None, pa.py_buffer(ends), pa.py_buffer(raw)])
        try:
            return out.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:  # ids that no text has may cut characters apart
            return pa.array([x.decode("utf-8", "replace") for x in out.to_pylist()], pa.string())

    def decode(self, ids: bytes) -> str:
        flat = np.frombuffer(ids, "<u4")
        return self.decode_column(flat, np.array([0, len(flat)], np.int64))[0].as_py()


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray, codes: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join the pieces ``flat[start[c]:start[c] + size[c]]`` for each code; offsets of rows of codes become offsets of items."""
    n = size[codes]
    ends = np.concatenate([[0], np.cumsum(n)])
    kind = np.int32 if max(int(ends[-1]), len(flat)) < 1 << 31 else np.int64
    shift = np.repeat((start[codes] - ends[:-1]).astype(kind), n)
    shift += np.arange(len(shift), dtype=kind)
    return flat[shift], ends[offs]


def _encoder(shared, cache_words: int = CACHE_WORDS) -> PairIndexEncoder:
    """One encoder for each worker process and broadcast vocabulary."""
    return packed.held(f"bpe {shared.id}", lambda: PairIndexEncoder(shared.value, cache_words))


class _Shared:
    """A broadcast handle with a key that is stable within the worker process."""

    def __init__(self, spark: SparkSession, value: dict):
        self.handle = spark.sparkContext.broadcast(value)
        self.id = f"{spark.sparkContext.applicationId}/{self.handle._jbroadcast.id()}"

    def __getstate__(self):
        return {"handle": self.handle, "id": self.id}

    @property
    def value(self):
        return self.handle.value


def encode(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    decoded: bool = True,
    as_array: bool = False,
    cache_words: int = CACHE_WORDS,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Add ``bpe_n`` (long), ``bpe_ids`` (binary, little-endian 32-bit ids, or an array of ints) and, if asked, ``bpe_text`` (their decoding).

    Columns of those names in ``docs`` are replaced; all others are kept.
    ``cache_words`` (encodings a worker keeps) and ``slice_bytes`` (text encoded
    at a time) trade memory for time; results do not depend on them.
    """
    small_batches(docs, min(slice_bytes, BATCH_BYTES))
    shared = _Shared(docs.sparkSession, load_vocabulary(tokenizer_path))
    added = ["bpe_n", "bpe_ids", "bpe_text"] if decoded else ["bpe_n", "bpe_ids"]
    kept = docs.drop(*[c for c in docs.columns if c.lower() in added and c.lower() != text.lower()])
    kinds = {"bpe_n": T.LongType(), "bpe_ids": T.ArrayType(T.IntegerType()) if as_array else T.BinaryType(), "bpe_text": T.StringType()}
    schema = T.StructType([*kept.schema.fields, *[T.StructField(c, kinds[c]) for c in added]])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(shared, cache_words)
        for batch in batches:
            for part, _, _ in packed.slices(batch, text, slice_bytes):
                ids, offs = coder.encode_column(part.column(text).fill_null(""))
                found = packed.list_column(ids.astype(np.int32), offs, pa.int32()) if as_array else packed.binary_rows(ids, offs)
                cols = [*part.columns, pa.array(np.diff(offs)), found]
                if decoded:
                    cols.append(coder.decode_column(ids, offs))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer_path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """Add the decoded text of an array of ids; null ids give an empty text."""
    shared = _Shared(df.sparkSession, load_vocabulary(tokenizer_path))
    kept = df.drop(out) if out != ids else df
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(shared)
        for batch in batches:
            texts = [coder.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return kept.mapInArrow(run, schema)


def digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The result that ``op3`` returns: per document the number of ids and digests of ids and decoded text."""
    coded = encode(docs.select("doc_id", "text"), tokenizer_path)
    return coded.select(
        "doc_id",
        F.col("bpe_n").alias("n_tokens"),
        F.sha2("bpe_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("bpe_text").cast("binary"), 256).alias("decoded_sha256"),
    )
