"""Vectorised byte-level text helpers that run inside Arrow tasks.

A column of texts is one contiguous byte buffer plus offsets. Word boundaries,
word hashes and window hashes come from a few numpy passes over that buffer, in
blocks of about ``BLOCK`` bytes, so a task's memory does not follow its input
(a single longer text forms a block of its own).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_U = np.uint64


def _class_table(ranges) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        t[lo : hi + 1] = True
    return t


# bytes of words [^\x20\x09-\x0D]+
SPACE_WORDS = ~_class_table([(0x20, 0x20), (0x09, 0x0D)])
# bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z
ALNUM_WORDS = _class_table([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
_BASE = 0xD6E8FEB86659FD93  # odd; base - 1 has a single factor of two
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _POWERS.get("p")
    if have is None or len(have) < n:
        size = max(n, BLOCK + 64)
        up = np.full(size, _BASE, dtype=_U)
        down = np.full(size, _BASE_INV, dtype=_U)
        up[0] = down[0] = 1
        _POWERS["p"], _POWERS["i"] = np.cumprod(up), np.cumprod(down)
    return _POWERS["p"], _POWERS["i"]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=kind)[column.offset : column.offset + len(column) + 1] if buffers[1] else np.zeros(1, kind)
    if len(offsets) == 0:
        offsets = np.zeros(1, kind)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = int(offsets[0])
    return data[first : int(offsets[-1])], offsets.astype(np.int64) - first


def blocks(offsets: np.ndarray, limit: int = BLOCK):
    """Row ranges [i, j) whose texts hold about ``limit`` bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_bounds(buf: np.ndarray, offsets: np.ndarray, words: np.ndarray):
    """Starts and ends of all words of a block; a word never crosses a text."""
    mask = words[buf]
    starts, ends = mask.copy(), mask.copy()
    if len(buf) > 1:
        starts[1:] &= ~mask[:-1]
        ends[:-1] &= ~mask[1:]
    edge = offsets[:-1][np.diff(offsets) > 0]
    starts[edge] = mask[edge]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    ends[last] = mask[last]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hashes of the byte spans, A-Z read as a-z if ``lower``."""
    table = _BYTE_VALUE[LOWER] if lower else _BYTE_VALUE
    up, down = _powers(len(buf) + 1)
    total = np.empty(len(buf) + 1, dtype=_U)
    total[0] = 0
    np.cumsum(table[buf] * up[: len(buf)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix64(h + (ends - starts).astype(_U))


def gram_hashes(buf: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all strings of ``size`` bytes, as :func:`span_hashes` gives them."""
    n = len(buf)
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, dtype=_U)
    np.cumsum(_BYTE_VALUE[buf] * up[:n], out=total[1:])
    h = total[size:] - total[: n + 1 - size]
    h *= down[: n + 1 - size]
    h += _U(size)
    h ^= h >> _U(30)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def words_by_text(buf, offsets, words, lower):
    """(word hashes, index of the first word of each text, with the end)."""
    starts, ends = word_bounds(buf, offsets, words)
    first = np.searchsorted(starts, offsets)
    return span_hashes(buf, starts, ends, lower), first


def combine(parts) -> np.ndarray:
    """One hash from several aligned hash arrays; order matters."""
    out = parts[0]
    for p in parts[1:]:
        out = mix64(out * _U(0x9E3779B97F4A7C15) + p + _U(0x632BE59BD9B4E019))
    return out


def text_blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK):
    """(first row, last row, block bytes, block offsets) over a batch."""
    data, offsets = text_buffer(batch.column(column))
    for i, j in blocks(offsets, limit):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of start, start+1, ... start+count-1, one range after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)


def order_of(values: np.ndarray, bits: int) -> np.ndarray:
    """The stable order of integers below ``2**bits``. Values and places are sorted
    packed in one word where they fit, which is several times as fast as an argsort."""
    n = len(values)
    low = max(1, (n - 1).bit_length()) if n else 1
    if bits + low > 64:
        return np.argsort(values, kind="stable")
    packed = (values.astype(_U) << _U(low)) | np.arange(n, dtype=_U)
    packed.sort()
    return (packed & _U((1 << low) - 1)).astype(np.int64)


def to_planes(values: np.ndarray) -> bytes:
    """32-bit integers byte plane by byte plane: the planes of high bytes are mostly
    zero and vanish when a shuffle compresses them."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def pack_ascending(keys: np.ndarray) -> bytes:
    """Ascending 32-bit integers as the planes of their differences."""
    return to_planes(np.diff(keys.astype(np.uint32), prepend=np.uint32(0)))


def unpack_ascending(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data), dtype=np.uint32)


def pack_ascending_64(keys: np.ndarray) -> bytes:
    """Ascending 64-bit integers: the first, then the byte planes of the differences
    (the planes of high bytes vanish when a shuffle compresses them)."""
    gaps = np.diff(keys.astype("<u8"), prepend=np.uint64(0))
    head, rest = gaps[:1], gaps[1:]
    return head.tobytes() + np.ascontiguousarray(np.ascontiguousarray(rest).view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_ascending_64(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=min(8, len(data))).reshape(8, -1)
    gaps = np.concatenate([np.frombuffer(data[:8], "<u8"), np.ascontiguousarray(planes.T).view("<u8").ravel()])
    return np.cumsum(gaps, dtype=np.uint64)


def pack_counts(values: np.ndarray) -> bytes:
    """Integers from 0 as byte planes, as many as the largest needs; the first byte is that
    number."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T[:width]
    return bytes([width]) + np.ascontiguousarray(planes).tobytes()


def unpack_counts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view("<i8").ravel()
