"""Words of many texts at once, as arrays of digests, for use inside tasks."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that a worker remembers; with more, it starts afresh.
REMEMBERED = 200_000
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and their n + 1 offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    n = len(texts)
    if n == 0 or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


class _Vocabulary(dict):
    """Numbers of the words seen, and their 128-bit digests one behind the other."""

    def __init__(self):
        super().__init__()
        self.digests = bytearray()

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.digests += blake2b(word, digest_size=16).digest()
        return n

    def lanes(self, words: list[bytes]) -> np.ndarray:
        """Two 64-bit lanes of the digest of each word."""
        if len(self) > REMEMBERED:
            forget()
        ids = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.frombuffer(bytes(self.digests), "<u8").reshape(-1, 2)[ids]


_VOCABULARY = _Vocabulary()


def forget() -> None:
    """Clears the words that this worker remembers."""
    _VOCABULARY.clear()
    _VOCABULARY.digests = bytearray()


def spelled(array: pa.Array) -> list[bytes]:
    """The values of a string array without nulls, as bytes."""
    data, offsets = buffers(array)
    raw, ends = data.tobytes(), offsets.tolist()
    return [raw[a:z] for a, z in zip(ends, ends[1:])]


def split_words(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words, dictionary-encoded, and n + 1 offsets of the texts' words among them.

    A word is a run of characters other than the space and U+0009 to U+000D; `lower` makes A-Z small; null counts as
    empty.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    found = lists.flatten()
    full = pc.greater(pc.binary_length(found), 0)
    at = np.zeros(len(found) + 1, np.int64)
    np.cumsum(full.to_numpy(zero_copy_only=False), out=at[1:])
    offsets = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))).astype(np.int64)
    return found.filter(full).dictionary_encode(), at[offsets]


def words(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all words as an array of two 64-bit lanes, and n + 1 offsets of the texts' words among them.

    Words are those of split_words. A digest is the 128-bit BLAKE2 hash of the word's bytes, made once for each
    distinct word.
    """
    coded, at = split_words(texts, lower)
    lanes = _VOCABULARY.lanes(spelled(coded.dictionary))
    return lanes[coded.indices.to_numpy(zero_copy_only=False)], at


def slices(source, text_at: int, rows: int = 1000, size: int = 1 << 24):
    """Batches cut to at most `rows` rows, and to about `size` bytes in the column of texts (one row at least)."""
    for batch in source:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        i = 0
        while i < batch.num_rows:
            before = ends[i - 1] if i else 0
            j = max(i + 1, min(i + rows, int(np.searchsorted(ends, before + size, side="right"))))
            yield batch.slice(i, j - i)
            i = j


def shingles(lanes: np.ndarray, width: int) -> np.ndarray:
    """64-bit digests of each `width` consecutive words, across texts; one for each start."""
    n = len(lanes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = mix(out ^ lanes[k : k + n, 0]) + lanes[k : k + n, 1]
    return mix(out)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


def windows(lanes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digests, in two lanes, of each `width` consecutive words, across texts; one for each start.

    A lane is a polynomial of the words' own digests. Its difference for two sequences is a sum of differences of
    digests by odd factors, of which a width below 64 can cancel some 20 of 64 low bits at most.
    """
    n = len(lanes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    out = []
    for lane, base in enumerate(_BASES):
        sums = np.zeros(len(lanes) + 1, np.uint64)
        np.cumsum(lanes[:, lane] * _powers(base, len(lanes)), out=sums[1:])
        out.append(mix((sums[width:] - sums[:n]) * _powers(pow(base, -1, 1 << 64), n)))
    return out[0], out[1]
