"""Vectorised word scanning over Arrow text columns (runs inside tasks).

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; these bytes
never occur inside a UTF-8 multi-byte character, so words are found on bytes.
Word hashes are 64-bit polynomial hashes of the word's bytes, so equal words
hash equally wherever they stand.  Null texts count as texts without words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLAB_BYTES = 1 << 20  # texts are scanned in slabs of whole texts of about this size

_rng = np.random.RandomState(20240229)
_BYTE = _rng.randint(0, 1 << 62, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WS = np.zeros(256, bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _pow(n: int):
    if len(_powers[0]) < n:
        m = 1 << int(n - 1).bit_length()
        for k, base in enumerate((_MUL, _INV)):
            a = np.full(m, base, np.uint64)
            a[0] = 1
            _powers[k] = np.cumprod(a, dtype=np.uint64)
    return _powers[0][:n], _powers[1]


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows (null: empty)."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    buf = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[off[0]:off[-1]]
    return buf, off - off[0]


def slabs(off: np.ndarray, limit: int = SLAB_BYTES):
    """Row ranges (lo, hi) of about ``limit`` bytes, at least one row each."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    p, inv = _pow(len(buf) + 1)
    s = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * p[:len(buf)], out=s[1:])
    return mix((s[ends] - s[starts]) * inv[starts])


def word_spans(buf: np.ndarray, off: np.ndarray):
    """Starts and ends (byte positions) of all words, and each row's first word index."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    ink = ~_WS[buf]
    first = np.empty(len(buf), bool)
    first[0] = True
    np.logical_not(ink[:-1], out=first[1:])
    edges = off[:-1][off[:-1] < len(buf)]
    first[edges] = True
    last = np.empty(len(buf), bool)
    last[-1] = True
    np.logical_not(ink[1:], out=last[:-1])
    inner = edges[edges > 0]
    last[inner - 1] = True
    starts = np.flatnonzero(first & ink)
    ends = np.flatnonzero(last & ink) + 1
    return starts, ends, np.searchsorted(starts, off)


def scan(buf: np.ndarray, off: np.ndarray, limit: int = SLAB_BYTES):
    """Words of all rows: (starts, ends, hashes, first) over the whole buffer;
    ``first[r]:first[r + 1]`` are the words of row r."""
    parts, base = [], 0
    first = np.zeros(len(off), np.int64)
    for lo, hi in slabs(off, limit):
        o = off[lo:hi + 1] - off[lo]
        b = buf[off[lo]:off[hi]]
        s, e, f = word_spans(b, o)
        parts.append((s + off[lo], e + off[lo], span_hashes(b, s, e)))
        first[lo:hi + 1] = f + base
        base += len(s)
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), first
    return (*(np.concatenate([p[k] for p in parts]) for k in range(3)), first)


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words, starting at every word but the last n - 1."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    acc = h[:len(h) - n + 1].copy()
    for k in range(1, n):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + h[k:len(h) - n + 1 + k]
    return mix(acc)


def join_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two adjacent windows from their hashes (a window of double length)."""
    return mix(a * np.uint64(0xA0761D6478BD642F) + b)


def within(first: np.ndarray, n_words: int, n: int) -> np.ndarray:
    """True for each word that starts a window of n words of its own row."""
    ok = np.zeros(n_words, bool)
    if n_words:
        counts = np.diff(first)
        left = np.repeat(first[1:], counts) - np.arange(n_words)
        ok = left >= n
    return ok


def gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenate flat[start:start + length] for all rows."""
    total = int(length.sum())
    if not total:
        return flat[:0]
    ends = np.cumsum(length)
    idx = np.arange(total) + np.repeat(start - (ends - length), length)
    return flat[idx]


def string_column(buf: np.ndarray, off: np.ndarray, valid=None) -> pa.Array:
    """A string column from bytes and offsets (``valid`` false: null)."""
    off32 = off.astype(np.int64)
    arr = pa.Array.from_buffers(pa.large_string(), len(off) - 1,
                                [None, pa.py_buffer(off32.tobytes()), pa.py_buffer(buf.tobytes())])
    if valid is not None and not valid.all():
        arr = pc.if_else(pa.array(valid), arr, pa.scalar(None, pa.large_string()))
    return arr.cast(pa.string()) if len(buf) < (1 << 31) - 1 else arr


def windows_rows(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key of each band of MinHash values (as signed integers)."""
    x = sig.reshape(len(sig), bands, rows).astype(np.uint64)
    acc = x[:, :, 0] + np.uint64(1)
    for k in range(1, rows):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + x[:, :, k] + np.uint64(1)
    return mix(acc).astype(np.int64)
