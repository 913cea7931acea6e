"""Words of Arrow text columns as numpy positions, and hashes of words; the helpers run inside tasks on bounded slices."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task works on at once; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def byte_table(not_word: list[tuple[int, int]]) -> np.ndarray:
    """256 flags, true for bytes outside the given closed ranges."""
    table = np.ones(256, dtype=bool)
    for low, high in not_word:
        table[low:high + 1] = False
    return table


#: Fixed values: [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ as byte classes of UTF-8.
UNSPACED = byte_table([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = byte_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
LETTERS = byte_table([(0x00, 0x60), (0x7B, 0x7F)])
#: Lower-cases A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def slices(batches: Iterable[pa.RecordBatch], text: int, limit: int = SLICE_BYTES,
           lower: bool = False) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut so that column number ``text`` holds about ``limit`` bytes: the slice, its UTF-8 bytes and row offsets. Null: no
    bytes. ``lower``: bytes of the text in lower case."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total, row = np.concatenate([[0], np.cumsum(sizes)]), 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(total, total[row] + limit, side="right")) - 1)
            part = batch.slice(row, end - row)
            texts = part.column(text).cast(pa.large_string()).fill_null("")
            yield part, *_bytes(pc.utf8_lower(texts) if lower else texts)
            row = end
    give_back()


def parts(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows (first, and the one after the last) of a slice with about ``limit`` bytes each."""
    row = 0
    while row < len(offsets) - 1:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, end
        row = end


def returning(run):
    """The function over Arrow batches, after which the memory of its own arrays and tables is returned too: they are gone by then."""
    def whole(batches):
        yield from run(batches)
        give_back()
    return whole


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks, and what they keep counts against the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset:]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and the number of the first word of each row (one more at the end)."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = table[data]
    body, begins, ends = inside[1:-1], ~inside[:-2], ~inside[2:]
    edges = offsets[1:-1]
    begins[edges[edges < len(data)]] = True
    ends[edges[edges > 0] - 1] = True
    starts = np.flatnonzero(body & begins)
    return starts, np.flatnonzero(body & ends) + 1, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers, in place."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9FB21C651E98DF25)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    return h


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte range, eight bytes at a time for all words together."""
    padded = np.zeros((len(data) + 23) // 8 * 8, dtype=np.uint8)
    padded[:len(data)] = data
    lanes, sizes = padded.view("<u8"), ends - starts
    out = mix(sizes.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64)))
    rows, at, left = None, starts, sizes
    while len(at):
        word, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        value = (lanes[word] >> shift) | ((lanes[word + 1] << np.uint64(1)) << (np.uint64(63) - shift))
        short = np.minimum(left, 8).astype(np.uint64) << np.uint64(3)
        value &= ~np.uint64(0) >> (np.uint64(64) - short)
        if rows is None:
            out = mix(out ^ value)
            more = rows = np.flatnonzero(left > 8)
        else:
            out[rows] = mix(out[rows] ^ value)
            more = np.flatnonzero(left > 8)
            rows = rows[more]
        at, left = at[more] + 8, left[more] - 8
    return out


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start .. start + size - 1 of every range, one after the other."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - sizes), sizes)


def utf8(values: list[str | None]) -> pa.Array:
    return pa.array(values, type=pa.string())


def single_spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The unspaced words with one space after each and nothing else between, and where they start and end there."""
    keep = UNSPACED[data]
    after = ends[ends < len(data)]
    keep[after[~UNSPACED[data[after]]]] = True
    place = np.cumsum(keep) - 1
    kept = data[keep]
    kept[~UNSPACED[kept]] = 0x20
    return kept.tobytes(), place[starts], place[ends - 1] + 1


class Spans:
    """Hashes of any ranges of consecutive words, from running sums: a polynomial modulo 2^64 with an odd base, scrambled."""

    def __init__(self, hashes: np.ndarray, seed: int):
        base = (0x9E3779B97F4A7C15 * (2 * seed + 1)) % (1 << 64) | 1
        self.unshift = self._powers(pow(base, -1, 1 << 64), len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * self._powers(base, len(hashes)), out=self.sums[1:])

    @staticmethod
    def _powers(base: int, count: int) -> np.ndarray:
        out = np.full(count, base, dtype=np.uint64)
        out[:1] = 1
        return np.cumprod(out)

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.unshift[begin])
