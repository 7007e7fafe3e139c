"""Whole Arrow string columns as one byte buffer, and word / shingle hashes over it.

The operators that look at every word of every document run inside
``mapInArrow``.  A column of texts is handled as its UTF-8 bytes plus row
offsets, so that words, hashes and shingles of thousands of documents come from
a few numpy passes.  Batches are cut into slices of about ``SLICE_BYTES`` of
text (a single longer text is one slice), which bounds the temporaries.

A null text is an empty text everywhere.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
#: slices whose words are hashed: every byte takes some 50 bytes meanwhile
HASHED_BYTES = 512 << 10

_U = np.uint64
#: odd multiplier of the byte polynomial and its inverse modulo 2^64
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_pow = np.ones(1, _U)
_inv = np.ones(1, _U)

_held: dict[str, object] = {}


def trim() -> None:
    """Memory that is free in Arrow's pool and in the C library's heap goes back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def held(owner: str, make: Callable[[], object] = lambda: None) -> object:
    """State that a Python worker keeps between tasks; what other operators kept is let go.

    Called when a task begins.  The tables of powers go with what others kept, and
    the memory that earlier tasks' arrays left in Arrow's pool and the C
    library's heap goes back to the system then.
    """
    global _pow, _inv
    if owner not in _held:
        _held.clear()
        _pow = _inv = np.ones(1, _U)
    trim()
    if owner not in _held:
        _held[owner] = make()
    return _held[owner]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: lower-cased words: digits, a-z and every non-ASCII character
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[0x30:0x3A] = WORD_BYTES[0x61:0x7B] = WORD_BYTES[0x80:] = True

#: tokens between ASCII white space
TOKEN_BYTES = np.ones(256, bool)
TOKEN_BYTES[[0x20, *range(0x09, 0x0E)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (uint64 in, uint64 out)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE_CODE = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93)) | _U(1)
_SLOT = mix(np.arange(1, 65, dtype=_U) * _U(0xA0761D6478BD642F)) | _U(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        size = -(-n >> 16) << 16
        steps = np.full(size, _BASE, _U)
        steps[0] = 1
        _pow = np.cumprod(steps, dtype=_U)
        steps[1:] = _U(_BASE_INV)
        _inv = np.cumprod(steps, dtype=_U)
    return _pow[:n], _inv[:n]


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; row ``i`` is ``bytes[offsets[i]:offsets[i + 1]]``."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_null(col.type):
        col = col.cast(pa.string())
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    if len(col) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch so that each piece holds about ``limit`` bytes of text (one row at least)."""
    data, offs = text_bytes(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        part = offs[at : end + 1]
        yield batch.slice(at, end - at), data[part[0] : part[-1]], part - part[0]
        at = end


def spans(member: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of member bytes that do not cross rows: ``starts, ends`` and the runs' row offsets."""
    n = len(member)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = member[:-1]
    cuts = offs[1:-1]
    cuts = cuts[cuts < n]
    before[cuts] = False
    starts = np.flatnonzero(member & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = member[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(member & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (equal spans, equal hashes wherever they stand)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, _U)
    powers, inverse = _powers(n + 1)
    sums = np.empty(n + 1, _U)
    sums[0] = 0
    np.cumsum(_BYTE_CODE[data] * powers[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def hash_runs(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of items (equal runs of equal hashes, equal results wherever they stand)."""
    powers, inverse = _powers(len(hashes) + 1)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(hashes * powers[: len(hashes)], dtype=_U)])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def words(data: np.ndarray, offs: np.ndarray, members: np.ndarray = WORD_BYTES):
    """Lower-cased words of every row: ``lowered bytes, starts, ends, row offsets, hashes``."""
    low = LOWER[data]
    starts, ends, rows = spans(members[low], offs)
    return low, starts, ends, rows, hash_spans(low, starts, ends)


def shingle_hashes(hashes: np.ndarray, rows: np.ndarray, size: int):
    """Hashes of every ``size`` consecutive words within a row.

    Returns ``(hashes, first word, row offsets)``.  A row with fewer words, but
    not none, has one shingle of all its words.
    """
    counts = np.diff(rows)
    n_out = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out_rows = np.concatenate([[0], np.cumsum(n_out)])
    total = int(out_rows[-1])
    if not total:
        return np.zeros(0, _U), np.zeros(0, np.int64), out_rows
    first = np.arange(total) + np.repeat(rows[:-1] - out_rows[:-1], n_out)
    length = np.repeat(np.minimum(counts, size), n_out)
    padded = np.concatenate([hashes, np.zeros(size, _U)])
    acc = length.astype(_U) * _SLOT[-1]
    short = bool((length < size).any())
    for j in range(size):
        part = padded[first + j] * _SLOT[j]
        if short and j:
            part[length <= j] = 0
        acc += part
    return mix(acc), first, out_rows


def word_list(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    raw = low.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def list_column(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def binary_rows(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of a packed numeric array as binary values (little-endian)."""
    step = values.dtype.itemsize
    ends = pa.py_buffer((offsets * step).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, ends, pa.py_buffer(np.ascontiguousarray(values).tobytes())])
