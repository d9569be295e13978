"""Substring dedup by recompression: find and remove passages that occur more than once.

Levels. Words get 64-bit names. A level names each maximal run of one symbol, then each pair of a left and a right
symbol, where the side of a symbol is a bit of its name. A name is a digest of what it stands for, so that all tasks
name alike. Whether symbols join depends on their neighbours only, so equal passages are parsed alike inside; the
words on which a symbol's parse depends are tracked exactly as its reach.

Rounds. Documents are dealt into chunks. After the levels of a round, each chunk sends the distinct names that the
round made; a reducer of a range of names finds those in use at two places or more, in any documents, and answers each
chunk by one bit for each of its names. A name of one place is closed: its symbol joins nothing at further levels.

Reveal. A window of `width` words that occurs twice holds no closed symbol whose reach lies inside it, since equal
windows hold equal symbols there. Windows that do hold one are ruled out by interval sums.

Verify. The windows that are left send a 96-bit digest of their word sequence, made of the 128-bit digests of the words
themselves, in the same way. Those that occur twice or more are repeats; every word that one covers is removed. Windows
are judged on the input. Names of 64 bits only rule out; a digest that two word sequences share by chance has odds of
2^-96 for each pair of windows.

Plan: one exchange of texts into chunks, reused by the four passes, and exchanges of packed names and bits. Memory: a
task holds one chunk (about `CHUNK_BYTES` of text, or one longer text) or one bucket of names (about `BUCKET_KEYS`).

Defined results: null and empty texts have no words; n_words and n_removed are 0 and the kept text is empty. Texts
shorter than a window lose nothing. Repeated rows are repeats of each other. Null doc_ids and further columns are
allowed; the latter are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import tokens
from tessera.llm.common import text_of

WIDTH = 35
#: The levels after which a round of naming is held.
ROUNDS = (2, 4)
CHUNK_BYTES = 6 << 20
BUCKET_KEYS = 1 << 20
#: Reach of a symbol whose parse depends on the edge of its document.
_FAR = 1 << 40
_NAME = np.dtype([("a", "<u8")])
_WINDOW = np.dtype([("a", "<u8"), ("b", "<u4")])


def _salted(name: np.ndarray, salt: int) -> np.ndarray:
    return tokens.mix(name + np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


class Level:
    """The symbols of all texts at one level: names, reach, places in their documents, and which are closed or new."""

    def __init__(self, name, low, high, first, last, closed, new):
        self.name, self.low, self.high, self.first, self.last = name, low, high, first, last
        self.closed, self.new = closed, new

    def _joined(self, heads: np.ndarray, name, low, high, made) -> Level:
        """The next level: symbols from each of `heads` up to the next one; name and reach are given by head."""
        tails = np.append(heads[1:], len(self.name)) - 1
        return Level(name, low, high, self.first[heads], self.last[tails], self.closed[heads], self.new[heads] | made)

    def _beside(self) -> tuple[np.ndarray, ...]:
        """Reach of the left and of the right neighbours; beyond the document's edge, none that any window holds."""
        n = len(self.name)
        left_low, left_high = np.empty(n, np.int64), np.empty(n, np.int64)
        right_low, right_high = np.empty(n, np.int64), np.empty(n, np.int64)
        left_low[1:], left_high[1:] = self.low[:-1], self.high[:-1]
        right_low[:-1], right_high[:-1] = self.low[1:], self.high[1:]
        left_low[self.first], left_high[self.first] = -_FAR, 0
        right_low[self.last], right_high[self.last] = _FAR, _FAR
        return left_low, left_high, right_low, right_high

    def runs(self, salt: int) -> Level:
        """Maximal runs of one symbol get one name, made of the symbol and the length of the run."""
        n = len(self.name)
        head = np.ones(n, bool)
        head[1:] = (self.name[1:] != self.name[:-1]) | self.first[1:] | self.closed[1:]
        heads = np.flatnonzero(head)
        tails = np.append(heads[1:], n) - 1
        length = (tails - heads + 1).astype(np.uint64)
        name = self.name[heads]
        name = np.where(length > 1, _salted(name ^ tokens.mix(length), salt), name)
        left_low, left_high, right_low, right_high = self._beside()
        low = np.minimum(np.minimum(self.low[heads], left_low[heads]), right_low[tails])
        high = np.maximum(np.maximum(self.high[tails], right_high[tails]), left_high[heads])
        return self._joined(heads, name, low, high, length > 1)

    def pairs(self, salt: int) -> Level:
        """Each left symbol joins the right symbol that follows it, unless one of them is closed."""
        n = len(self.name)
        right = (_salted(self.name, salt) >> np.uint64(63)).astype(bool)
        joins = np.zeros(n, bool)
        joins[:-1] = ~right[:-1] & right[1:] & ~self.first[1:] & ~self.closed[:-1] & ~self.closed[1:]
        second = np.zeros(n, bool)
        second[1:] = joins[:-1]
        left_low, left_high, right_low, right_high = self._beside()
        # A left symbol is settled by its right neighbour, a right one by its left neighbour.
        low = np.where(right, np.minimum(self.low, left_low), np.minimum(self.low, right_low))
        high = np.where(right, np.maximum(self.high, left_high), np.maximum(self.high, right_high))
        heads = np.flatnonzero(~second)
        name = self.name[heads]
        both = joins[heads]
        at = heads[both]
        name[both] = _salted(self.name[at] * np.uint64(3) + tokens.mix(self.name[at + 1]), salt + 1000)
        return self._joined(heads, name, low[heads], high[heads], both)

    def inside(self, width: int, n_words: int) -> np.ndarray:
        """Whether some window of `width` words holds the symbol's reach."""
        return (self.low >= 0) & (self.high <= n_words) & (self.high - self.low <= width)


def first_level(lanes: np.ndarray, at: np.ndarray) -> Level:
    """The words themselves."""
    n = len(lanes)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    full = at[1:] > at[:-1]
    first[at[:-1][full]] = True
    last[at[1:][full] - 1] = True
    start = np.arange(n, dtype=np.int64)
    none = np.zeros(n, bool)
    return Level(lanes[:, 0] ^ tokens.mix(lanes[:, 1]), start, start + 1, first, last, none, none)


def valid_windows(at: np.ndarray, width: int) -> np.ndarray:
    """Whether each start of `width` words lies with all of them in one text."""
    n = int(at[-1]) - width + 1
    if n <= 0:
        return np.zeros(0, bool)
    end_of = np.repeat(at[1:], np.diff(at))
    return np.arange(n) + width <= end_of[:n]


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct records in order, whether each occurs twice or more, and each value's place among them."""
    order = np.argsort(values["a"], kind="stable") if len(values.dtype) == 1 else np.lexsort((values["b"], values["a"]))
    ordered = values[order]
    head = np.ones(len(values), bool)
    head[1:] = ordered[1:] != ordered[:-1]
    number = np.cumsum(head) - 1
    place = np.empty(len(values), np.int64)
    place[order] = number
    return ordered[head], np.bincount(number, minlength=int(head.sum())) > 1, place


def _buckets(found: np.ndarray, buckets: int) -> np.ndarray:
    """Bounds of the ranges of names that go to each reducer."""
    bucket = ((found["a"] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    return np.searchsorted(bucket, np.arange(buckets + 1))


def _sent(values: np.ndarray, chunk: int, buckets: int) -> pa.Table:
    """Distinct values by range of values, with a bit for those that the chunk itself holds twice or more."""
    found, twice, _ = _distinct(values)
    at = _buckets(found, buckets)
    full = np.flatnonzero(np.diff(at))
    return pa.table(
        {
            "bucket": pa.array(full, pa.int64()),
            "chunk": pa.array(np.full(len(full), chunk), pa.int64()),
            "found": pa.array([found[at[b] : at[b + 1]].tobytes() for b in full], pa.binary()),
            "twice": pa.array([np.packbits(twice[at[b] : at[b + 1]]).tobytes() for b in full], pa.binary()),
        }
    )


def _shared(kind: np.dtype):
    """Of one bucket: for each chunk, a bit for each of its values that says whether it occurs twice or more."""

    def run(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, kind) for x in table.column("found").to_pylist()]
        sizes = np.array([len(x) for x in parts])
        twice = [
            np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool)
            for x, n in zip(table.column("twice").to_pylist(), sizes)
        ]
        found, several, place = _distinct(np.concatenate(parts))
        several |= np.bincount(place, weights=np.concatenate(twice), minlength=len(found)) > 0
        bits, ends = several[place], np.cumsum(sizes)
        return pa.table(
            {
                "bucket": table.column("bucket"),
                "chunk": table.column("chunk"),
                "shared": pa.array([np.packbits(bits[e - n : e]).tobytes() for e, n in zip(ends, sizes)], pa.binary()),
            }
        )

    return run


def _told(values: np.ndarray, answers: dict[int, bytes], buckets: int) -> np.ndarray:
    """Whether each value is shared, by the answers to what `_sent` sent of the same values."""
    found, _, place = _distinct(values)
    at = _buckets(found, buckets)
    bits = [
        np.unpackbits(np.frombuffer(answers[b], np.uint8), count=int(at[b + 1] - at[b])).astype(bool)
        for b in np.flatnonzero(np.diff(at))
    ]
    return np.concatenate(bits)[place] if bits else np.zeros(0, bool)


class Chunk:
    """One chunk's texts, parsed as far as the rounds have answered."""

    def __init__(self, table: pa.Table, width: int, buckets: int):
        self.lanes, self.at = tokens.words(table.column("text"))
        self.width, self.buckets = width, buckets
        self.level, self.done = first_level(self.lanes, self.at), 0
        self.open = valid_windows(self.at, width)

    def rise(self, to: int) -> np.ndarray:
        """Goes up to a level; returns the names made since the last round that windows can hold, as records."""
        level = self.level
        if len(level.name):
            for k in range(self.done, to):
                level = level.runs(2 * k + 1).pairs(2 * k + 2)
        self.level, self.done = level, to
        self.asked = np.flatnonzero(level.new & level.inside(self.width, len(self.lanes)))
        return level.name[self.asked].view(_NAME)

    def close(self, shared: np.ndarray) -> None:
        """Closes the symbols of one place and rules out the windows that hold their reach."""
        level = self.level
        alone = self.asked[~shared]
        level.closed = level.closed.copy()
        level.closed[alone] = True
        level.new = np.zeros(len(level.name), bool)
        n = len(self.open)
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, np.clip(level.high[alone] - self.width, 0, n), 1)
        np.add.at(edge, np.clip(level.low[alone] + 1, 0, n), -1)
        self.open &= np.cumsum(edge)[:n] <= 0

    def windows(self) -> np.ndarray:
        """Digests of the windows that no closed symbol rules out."""
        a, b = tokens.windows(self.lanes, self.width)
        out = np.empty(int(self.open.sum()), _WINDOW)
        out["a"], out["b"] = a[self.open], b[self.open] >> np.uint64(32)
        return out


def _answered(told: pa.Table) -> dict[int, dict[int, bytes]]:
    """Answers by round and bucket."""
    out: dict[int, dict[int, bytes]] = {}
    for k, b, x in zip(*(told.column(c).to_pylist() for c in ("round", "bucket", "shared"))):
        out.setdefault(k, {})[b] = x
    return out


def _risen(table: pa.Table, told: pa.Table | None, upto: int, width: int, buckets: int) -> Chunk:
    """The chunk after the first `upto` rounds."""
    chunk = Chunk(table, width, buckets)
    answers = _answered(told) if told is not None else {}
    for k in range(upto):
        chunk.close(_told(chunk.rise(ROUNDS[k]), answers.get(k, {}), buckets))
    return chunk


def _names(k: int, width: int, buckets: int):
    """Round k: the distinct names that its levels make."""

    def first(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _sent(_risen(table, None, k, width, buckets).rise(ROUNDS[k]), key[0].as_py(), buckets)

    def further(key: tuple[pa.Scalar, ...], table: pa.Table, told: pa.Table) -> pa.Table:
        return _sent(_risen(table, told, k, width, buckets).rise(ROUNDS[k]), key[0].as_py(), buckets)

    return further if k else first


def _candidates(width: int, buckets: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table, told: pa.Table) -> pa.Table:
        return _sent(_risen(table, told, len(ROUNDS), width, buckets).windows(), key[0].as_py(), buckets)

    return run


def _removal(width: int, buckets: int, with_text: bool):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table, told: pa.Table) -> pa.Table:
        chunk = _risen(table, told, len(ROUNDS), width, buckets)
        at = chunk.at
        hit = np.flatnonzero(chunk.open)[_told(chunk.windows(), _answered(told).get(len(ROUNDS), {}), buckets)]
        edge = np.zeros(len(chunk.lanes) + 1, np.int64)
        edge[hit] += 1
        np.add.at(edge, hit + width, -1)
        gone = np.cumsum(edge)[:-1] > 0
        texts = table.column("text").cast(pa.large_binary()).to_pylist()
        digest, kept_text, removed = [], [], []
        for i, text in enumerate(texts):
            mask = gone[at[i] : at[i + 1]]
            removed.append(int(mask.sum()))
            kept = (text or b"").split()
            if removed[-1]:
                kept = compress(kept, (~mask).tolist())
            kept = b" ".join(kept)
            digest.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                kept_text.append(kept.decode())
        out = {
            "doc_id": table.column("doc_id").cast(pa.int64()),
            "n_words": pa.array(np.diff(at), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array(digest, pa.string()),
        }
        return pa.table(out | ({"kept_text": pa.array(kept_text, pa.string())} if with_text else {}))

    return run


def remove_repeats(docs: DataFrame, width: int = WIDTH, with_text: bool = True) -> DataFrame:
    """Each row's doc_id, n_words, n_removed, kept_sha256 and kept_text (words joined by one space)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // CHUNK_BYTES))
    # A word takes 6 bytes or so; each window sends at most one digest.
    buckets = max(4, min(chunks, size // 6 // BUCKET_KEYS + 1))
    dealt = docs.select(
        # The row's number parts equal rows; it need not be the same in another run.
        F.pmod(F.xxhash64("doc_id", F.length("text"), F.monotonically_increasing_id()), F.lit(chunks)).alias("chunk"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().alias("text"),
    ).groupBy("chunk")
    sent, answer = "bucket long, chunk long, found binary, twice binary", "bucket long, chunk long, shared binary"

    def asked(rows: DataFrame, kind: np.dtype, k: int) -> DataFrame:
        return rows.groupBy("bucket").applyInArrow(_shared(kind), answer).withColumn("round", F.lit(k))

    told = asked(dealt.applyInArrow(_names(0, width, buckets), sent), _NAME, 0)
    for k in range(1, len(ROUNDS)):
        names = dealt.cogroup(told.groupBy("chunk")).applyInArrow(_names(k, width, buckets), sent)
        told = told.unionByName(asked(names, _NAME, k))
    windows = dealt.cogroup(told.groupBy("chunk")).applyInArrow(_candidates(width, buckets), sent)
    told = told.unionByName(asked(windows, _WINDOW, len(ROUNDS)))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return dealt.cogroup(told.groupBy("chunk")).applyInArrow(_removal(width, buckets, with_text), schema)
