"""Words of many texts as numpy arrays.

A batch of texts is one UTF-8 buffer; words, word hashes and rolling window hashes are
found by array operations over the whole buffer, so no Python code runs per word.
A word is ``[^\\x20\\x09-\\x0D]+`` (only these six ASCII separators split words).
Memory is bounded by ``slices``: callers never hold arrays for more than about
``max_bytes`` of text (or for one text, if that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 4 << 20
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


#: The low bytes of an eight-byte load that belong to a word of 0 to 8 bytes.
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
#: Longer words are hashed one by one.
_LONG_WORD = 512


@dataclass
class Words:
    """The words of some texts: ``first[i]:first[i + 1]`` are the words of text i."""

    data: np.ndarray      # uint8, the joined texts as hashed (lower-cased if asked for)
    start: np.ndarray     # int64 byte offset of each word
    end: np.ndarray
    first: np.ndarray     # int64, one more entry than texts
    hash: np.ndarray      # uint64 per word
    bounds: np.ndarray | None = None   # byte offsets of the texts
    inside: np.ndarray | None = None   # which bytes belong to words

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The index of the text that holds each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch whose texts hold about ``max_bytes`` (one text at least)."""
    if not batch.num_rows:
        return
    _, offsets = buffers(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


#: Parts tokens at every ASCII byte but letters and digits; other UTF-8 bytes belong to tokens.
NOT_ALPHANUMERIC = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def split_words(column: pa.Array, lower: bool = False, separator: np.ndarray = _SEPARATOR) -> Words:
    """The words of every text of a string column, with a 64-bit hash of each word's bytes."""
    data, offsets = buffers(column)
    if lower:
        data = _LOWER[data]
    n = len(data)
    padded = np.zeros(n + 2, dtype=bool)
    inside = np.logical_not(separator[data], out=padded[1:-1])
    change = np.flatnonzero(padded[1:] != padded[:-1])
    start, end = change[::2], change[1::2]
    # a text's end also ends a word: two neighbours never share one
    edges = np.unique(offsets[1:-1])
    edges = edges[(edges > 0) & (edges < n)]
    cut = edges[padded[edges] & padded[edges + 1]]
    if len(cut):
        start = np.sort(np.concatenate([start, cut]), kind="stable")
        end = np.sort(np.concatenate([end, cut]), kind="stable")
    first = np.searchsorted(start, offsets, side="left")
    return Words(data, start, end, first, _word_hashes(data, start, end), offsets, inside)


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes, eight at a time."""
    if not len(start):
        return np.zeros(0, np.uint64)
    raw = np.concatenate([data, np.zeros(8, np.uint8)])
    loads = np.ndarray((len(data) + 1,), dtype="<u8", buffer=raw, strides=(1,))
    length = end - start
    out = mix((loads[start] & _LOW_BYTES[np.minimum(length, 8)]) + length.astype(np.uint64) * np.uint64(0x8EBC6AF09C88C6E3))
    more = np.flatnonzero(length > 8)
    at = 8
    while len(more) and at < _LONG_WORD:
        load = loads[start[more] + at] & _LOW_BYTES[np.minimum(length[more] - at, 8)]
        out[more] = mix(out[more] * _BASE + load)
        at += 8
        more = more[length[more] > at]
    for i in more.tolist():
        out[i] = np.uint64(xxhash.xxh3_64_intdigest(data[start[i]:end[i]].tobytes()))
    return out


def window_hashes(words: Words, size: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash, valid) for each word position: the hash of the ``size`` words from there.

    ``valid`` is false where the text ends before the window does.
    """
    n = len(words.hash)
    code = mix(words.hash + np.uint64(salt * 0x632BE59BD9B4E019 & (1 << 64) - 1))
    # sums of code times base ** place over 1, 2, 4 ... words, put together to the wanted length
    out, done, wide, base = np.zeros(n, np.uint64), 0, 1, int(_BASE)
    while done < size and done < n:
        if size & wide:
            step = np.uint64(pow(int(_BASE), done, 1 << 64))
            out[:n - done] += code[done:] * step
            done += wide
        if done >= size:
            break
        code = code.copy()
        if wide < n:
            code[:n - wide] += code[wide:] * np.uint64(base)
        base = base * base & (1 << 64) - 1
        wide *= 2
    left = words.first[1:][words.text_of()] - np.arange(n)
    return mix(out + np.uint64(size)), left >= size


def sequence_hashes(words: Words, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of each text's word sequence (0 words: a fixed value)."""
    counts = words.counts
    place = np.arange(len(words.hash)) - np.repeat(words.first[:-1], counts)
    code = mix(words.hash ^ mix(place.astype(np.uint64) + np.uint64(1 + salt * 7919)))
    sums = np.zeros(len(words.hash) + 1, np.uint64)
    np.cumsum(code, out=sums[1:])
    return mix(sums[words.first[1:]] - sums[words.first[:-1]] + counts.astype(np.uint64) * np.uint64(salt + 3))
