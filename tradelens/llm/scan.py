"""Vectorised views of a batch of texts: bytes, words, n-gram hashes, anchors.

Everything here works on one Arrow batch inside a task; memory is bounded by
``SLICE_BYTES`` of text (or one document, if it is longer).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SLICE_ROWS = 1000
_U = np.uint64


def _odd(seed: str, n: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    raw = b"".join(hashlib.blake2b(f"{seed}:{i}".encode(), digest_size=8).digest() for i in range(n))
    return np.frombuffer(raw, dtype="<u8").astype(_U) | _U(1)


_BYTE = _odd("byte", 256)
_LEVEL = _odd("level", 64)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Bytes up to which a word is hashed by its eight-byte blocks; longer ones go through a library hash.
LONG_WORD = 128


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _U(32))
    x = x * _LEVEL[62]
    x = x ^ (x >> _U(29))
    x = x * _LEVEL[63]
    return x ^ (x >> _U(32))


def string_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, b"" if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type) else "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    if len(arr) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of text and SLICE_ROWS rows, one row at least."""
    _, off = string_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = min(at + SLICE_ROWS, max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1))
        yield batch.slice(at, to - at)
        at = to


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words (runs without 0x20, 0x09-0x0D), and word offsets by document."""
    n = len(data)
    word = (data != 32) & ((data < 9) | (data > 13))
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.concatenate([[False], word])
    after = np.concatenate([word, [False]])
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each word's bytes (A-Z lower-cased first if ``lower``).

    Every block of eight bytes passes a bijective finaliser before the next is
    added, so words of one length that differ in one block never collide, and
    no pattern of letters cancels out.
    """
    if not len(starts):
        return np.empty(0, _U)
    if lower:
        data = _FOLD[data]
    size = ends - starts
    h = mix(size.astype(_U) * _LEVEL[61])
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.lib.stride_tricks.as_strided(padded[:8].view(_U), (len(data) + 1,), (1,))  # eight bytes from any place on
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    live, done = np.flatnonzero(size <= LONG_WORD), 0
    while len(live):
        left = size[live] - done
        block = blocks[starts[live] + done]
        short = left < 8
        block[short] &= (_U(1) << (left[short].astype(_U) * _U(8))) - _U(1)
        h[live] = mix(h[live] ^ block)
        live, done = live[left > 8], done + 8
    return h


def _inside(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n bytes lie in a word."""
    step = np.zeros(n + 1, np.int8)
    step[starts] += 1
    step[ends] -= 1
    return np.cumsum(step[:-1], dtype=np.int8).astype(bool)


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All words, one space after each, and the place where each begins (one more at the end)."""
    size = ends - starts
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(size + 1, out=at[1:])
    out = np.full(at[-1], 32, np.uint8)
    inside = data[_inside(len(data), starts, ends)]
    out[np.arange(len(inside)) + np.repeat(np.arange(len(starts)), size)] = inside
    return out.tobytes(), at


def word_dictionary(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.DictionaryArray:
    """The words numbered by their bytes."""
    off = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=off[1:])
    packed = np.ascontiguousarray(data[_inside(len(data), starts, ends)])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(off), pa.py_buffer(packed)]).dictionary_encode()


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive values, by doubling (k below 2**30)."""
    n = len(values) - k + 1
    if n <= 0:
        return np.empty(0, _U)
    h, size, level = values, 1, 0
    acc, held = None, 0
    while True:
        if k & size:
            acc, held = (h, size) if acc is None else (
                h[:len(values) - held - size + 1] * _LEVEL[30 + level] + acc[size:], held + size)
        if size * 2 > k:
            break
        h = h[:-size] * _LEVEL[level] + h[size:]
        size, level = size * 2, level + 1
    return mix(acc[:n] + _U(k))


def anchors(values: np.ndarray, off: np.ndarray, window: int, k: int):
    """Content-chosen anchors of all windows.

    Every ``window`` consecutive values of one document choose the k-gram of
    least hash among theirs (the leftmost of equals), so equal windows choose
    the same relative place.  Windows that choose the same place form one run.
    Returns per run: document index, anchor place, first and last window start
    (all places absolute in ``values``) and the anchor's 64-bit hash.
    """
    none = np.empty(0, np.int64)
    fits = np.flatnonzero(np.diff(off) >= window)
    if not len(fits):
        return none, none, none, none, np.empty(0, _U)
    h = gram_hashes(values, k)
    low = (h >> _U(32) << _U(32)) | np.arange(len(h), dtype=_U)
    width, size = window - k + 1, 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[:len(low) - (width - size)], low[width - size:])
    step = np.zeros(len(low) + 1, np.int32)
    step[off[fits]] += 1
    np.add.at(step, off[fits + 1] - window + 1, -1)
    q = np.flatnonzero(np.cumsum(step[:-1]) > 0)
    at = (low[q] & _U(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    last = np.concatenate([first[1:], [len(at)]]) - 1
    place = at[first]
    return np.searchsorted(off, place, side="right") - 1, place, q[first], q[last], h[place]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
