"""Words of many texts at once: arrays over the UTF-8 bytes of an Arrow batch.

UTF-8 keeps every byte of a non-ASCII character at 0x80 or above, so word classes that
treat all non-ASCII characters alike can be decided byte by byte.
"""

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Runs without blanks: everything but space and the control characters from tab to return.
BLANK_SEPARATED = np.ones(256, dtype=bool)
BLANK_SEPARATED[[0x20, *range(0x09, 0x0E)]] = False
#: Runs of digits, letters and non-ASCII characters, after lower-casing.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n):
    """Powers of the base and of its inverse modulo 2**64, kept between batches."""
    if len(_tables[0]) < n:
        for i, factor in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, CHUNK_BYTES + 1), factor, np.uint64)
            steps[0] = 1
            _tables[i] = np.multiply.accumulate(steps)
    return _tables[0][:n], _tables[1]


def mix(h):
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(32)
    return h


def chunks(texts, size=CHUNK_BYTES):
    """Cut an Arrow string array into runs of whole texts of about `size` bytes.

    Yields (first row, bytes, offsets); a null text is an empty one, and a text longer
    than `size` comes alone.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        stop = min(max(stop, row + 1), len(texts))
        own = offsets[row : stop + 1]
        yield row, data[own[0] : own[-1]], own - own[0]
        row = stop


def lower(data):
    return _LOWER[data]


def bounds(data, offsets, word_bytes):
    """Byte ranges of the words of lower-cased `data`, and the first word of each text.

    Returns (starts, ends, first) with `first[i]` to `first[i + 1]` the words of text i.
    """
    inside = word_bytes[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    full = offsets[1:] > offsets[:-1]
    edge = offsets[:-1][full]
    opens[edge] = inside[edge]
    edge = offsets[1:][full] - 1
    closes[edge] = inside[edge]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def hashes(data, starts, ends):
    """64-bit hash of each byte range."""
    powers, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[1:], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h ^ (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def word_hashes(data, offsets, word_bytes):
    """Hash of each lower-cased word, and the first word of each text."""
    data = lower(data)
    starts, ends, first = bounds(data, offsets, word_bytes)
    return hashes(data, starts, ends), first
