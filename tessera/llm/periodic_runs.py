"""Periodic runs of words, by constant-time extension queries on suffix trees.

A run is a stretch of consecutive words with smallest period q, of at least max(least_words, exponent * q) words,
that no neighbouring word extends keeping period q.

Trees. Of a stretch of words and of its reversal a suffix tree is built by Ukkonen's algorithm. The Euler tour of a
tree visits string depths; the least depth between the visits of two leaves is the depth of their lowest common
ancestor, which is the longest common extension (LCE) of their suffixes. A sparse table over the tour answers each
query in constant time, for arrays of queries at once.

Roots. The order of the leaves ranks the suffixes. The longest Lyndon word at a place ends before the next suffix of
lower rank, and in the opposite order of words before the next one of higher rank. Every run has a period that is such
a Lyndon word of one of the two orders, so two candidates (place, period) a word suffice: each is extended to the right
by the tree and to the left by the tree of the reversal, and is a run if the whole is long enough.

Sieve. Within a run of exponent 4 or more, of 6 words or more, every three consecutive words occur three times or
more. Stretches whose triples all do, counted by hash over a whole batch and then again within each stretch, keep every
run whole, with its ends; trees are built of these stretches only. Hash collisions keep too much, never too little.

Documents do not meet, so there is no shuffle. A task holds about 16 MB of texts, and one stretch's trees (some hundred
bytes a word) at a time: a text is one row, and its longest stretch has to fit into a task.

Defined results: null and blank texts have no words and no runs. A null doc_id is kept. Repeated rows give repeated
results. An empty table gives an empty result; further columns are ignored. Of runs of equal length the first is
the one with the smallest start, then the smallest period.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import tokens

LEAST_WORDS = 6
EXPONENT = 4


class ExtensionTree:
    """The suffix tree of a sequence of positive numbers, with rank of suffixes and LCE of any two."""

    def __init__(self, word: list[int]):
        s = [*word, 0]  # the end mark, less than all
        self._grow(s, max(s) + 1)
        self._tour(s, max(s) + 1)

    def _grow(self, s: list[int], base: int) -> None:
        """Ukkonen: for each next number, all suffixes that do not yet continue with it get a leaf or a fork."""
        total = len(s)
        # An edge goes into its node; labels are s[begin:end]. A child is found by (parent, first number).
        begin, end, link, child = [0], [0], [0], {}
        at, edge, deep, open_suffixes = 0, 0, 0, 0
        for i, c in enumerate(s):
            open_suffixes += 1
            forked = 0
            while open_suffixes:
                if not deep:
                    edge = i
                key = at * base + s[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(begin)
                    begin.append(i)
                    end.append(total)
                    link.append(0)
                    if forked:
                        link[forked] = at
                    forked = 0
                else:
                    span = end[below] - begin[below]
                    if deep >= span:
                        edge += span
                        deep -= span
                        at = below
                        continue
                    half = begin[below] + deep
                    if s[half] == c:
                        deep += 1
                        if forked:
                            link[forked] = at
                        break
                    fork = child[key] = len(begin)
                    begin += (begin[below], i)
                    end += (half, total)
                    link += (0, 0)
                    begin[below] = half
                    child[fork * base + s[half]] = below
                    child[fork * base + c] = fork + 1
                    if forked:
                        link[forked] = fork
                    forked = fork
                open_suffixes -= 1
                if at:
                    at = link[at]
                elif deep:
                    deep -= 1
                    edge = i - open_suffixes + 1
        self._begin, self._end, self._child = begin, end, child

    def _tour(self, s: list[int], base: int) -> None:
        """Euler tour of string depths in the order of first numbers, first visits and ranks of leaves."""
        total, nodes = len(s), len(self._begin)
        keys = np.fromiter(self._child.keys(), np.int64, len(self._child))
        kids = np.fromiter(self._child.values(), np.int64, len(self._child))
        order = np.argsort(keys)
        first_kid = np.searchsorted(keys[order] // base, np.arange(nodes + 1)).tolist()
        kids = kids[order].tolist()
        span = (np.array(self._end) - np.array(self._begin)).tolist()
        del self._begin, self._end, self._child
        depth, tour, visit, leaves = [0] * nodes, [], [0] * total, []
        stack = [0]
        while stack:
            v = stack.pop()
            if v < 0:
                tour.append(depth[~v])
                continue
            d = depth[v]
            lo, hi = first_kid[v], first_kid[v + 1]
            if lo == hi:
                visit[total - d] = len(tour)
                leaves.append(total - d)
            tour.append(d)
            for k in range(hi - 1, lo - 1, -1):
                kid = kids[k]
                depth[kid] = d + span[kid]
                stack.append(~v)
                stack.append(kid)
        self.visit = np.array(visit)
        self.rank = np.empty(total, np.int64)
        self.rank[leaves] = np.arange(total)
        row = np.array(tour, np.int32)
        self._least = [row]
        step = 1
        while 2 * step <= len(tour):
            row = np.minimum(row[:-step], row[step:])
            self._least.append(row)
            step *= 2

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the longest common extensions of suffixes i and j (i <> j), pair by pair."""
        a, b = self.visit[i], self.visit[j]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1  # floor of the logarithm
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level).tolist():
            of = np.flatnonzero(level == k)
            row = self._least[k]
            out[of] = np.minimum(row[lo[of]], row[hi[of] + 1 - (1 << k)])
        return out


def _next_lower(values: list[int]) -> np.ndarray:
    """For each place, the first later place of a lower value, or -1."""
    out, waiting = [-1] * len(values), []
    for i, v in enumerate(values):
        while waiting and values[waiting[-1]] > v:
            out[waiting.pop()] = i
        waiting.append(i)
    return np.array(out)


def runs_of(word: np.ndarray, least_words: int = LEAST_WORDS, exponent: int = EXPONENT) -> np.ndarray:
    """All runs of a sequence of numbers as rows (start, length, period), by start, then period. exponent >= 2."""
    n = len(word)
    word = (np.unique(word, return_inverse=True)[1] + 1).tolist()
    ahead, back = ExtensionTree(word), ExtensionTree(word[::-1])
    found = []
    for ranks in (ahead.rank, -ahead.rank):
        stop = _next_lower(ranks.tolist())[:n]
        i = np.flatnonzero((stop > 0) & ((stop - np.arange(n)) * exponent <= n) & (stop < n))
        q = stop[i] - i
        right = ahead.lce(i, i + q)
        left = np.zeros(len(i), np.int64)
        inner = np.flatnonzero(i > 0)
        left[inner] = back.lce(n - i[inner], n - i[inner] - q[inner])
        length = q + left + right
        found.append(np.stack([i - left, length, q], axis=1)[length >= np.maximum(least_words, exponent * q)])
    out = np.unique(np.concatenate(found), axis=0)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def sieve(words: np.ndarray, ends: np.ndarray, times: int = 3, least_words: int = LEAST_WORDS) -> list[tuple[int, int]]:
    """Stretches (start, end) of words of which every triple occurs `times` times or more within the stretch.

    `ends` are the n + 1 offsets of the texts among the words; a stretch has `least_words` words at least.
    """
    stretches = np.stack([ends[:-1], ends[1:]], axis=1)
    mixed = tokens.mix(words.astype(np.uint64) + np.uint64(0x51ED270B))
    before = -1
    while True:
        stretches = stretches[stretches[:, 1] - stretches[:, 0] >= least_words]
        lengths = stretches[:, 1] - stretches[:, 0] - 2
        if not len(stretches) or int(lengths.sum()) == before:
            return [tuple(x) for x in stretches.tolist()]
        before = int(lengths.sum())
        base = np.concatenate(([0], np.cumsum(lengths)))
        at = np.arange(before) + np.repeat(stretches[:, 0] - base[:-1], lengths)
        key = tokens.mix(tokens.mix(mixed[at] * np.uint64(3) + mixed[at + 1]) + mixed[at + 2] + np.repeat(np.arange(len(stretches), dtype=np.uint64), lengths) * np.uint64(0x9E3779B97F4A7C15))
        ordered = np.sort(key)
        frequent = ordered[: -(times - 1)][ordered[: -(times - 1)] == ordered[times - 1 :]] if before >= times else ordered[:0]
        if not len(frequent):
            return []
        frequent = np.unique(frequent)
        hit = frequent[np.minimum(np.searchsorted(frequent, key), len(frequent) - 1)] == key
        # Marked triples that follow each other within one stretch form the next ones.
        starts = hit.copy()
        starts[1:] &= ~hit[:-1]
        starts[base[:-1]] |= hit[base[:-1]]
        last = hit.copy()
        last[:-1] &= ~hit[1:]
        last[base[1:] - 1] |= hit[base[1:] - 1]
        stretches = np.stack([at[starts], at[last] + 3], axis=1)


def repeat_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """Of every tenth document by CRC-32 of its id, the places of the words that make its tail periodic."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return places


_COLUMNS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
_MORE = {"runs": "runs array<struct<start:long,length:long,period:long>>", "text": "text string"}
_ROW = pa.struct({"start": pa.int64(), "length": pa.int64(), "period": pa.int64()})


def _find(places_of, least_words: int, exponent: int, more: tuple[str, ...]):
    kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [{"runs": pa.list_(_ROW), "text": pa.string()}[x] for x in more]
    names = [x.split()[0] for x in _COLUMNS.split(", ")] + list(more)
    schema = pa.schema(list(zip(names, kinds)))

    def found(batch):
        coded, ends = tokens.split_words(batch.column(1))
        codes, spelled = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), tokens.spelled(coded.dictionary)
        ids, bounds = batch.column(0).to_pylist(), ends.tolist()
        for doc, a, z in zip(ids, bounds, bounds[1:]):
            places = places_of(doc, z - a) if places_of else None
            if places is not None:
                codes[a:z] = codes[a:z][places]
        # Runs of lower exponents have triples that occur less often.
        times = 3 if exponent >= 4 and least_words >= 6 else 2
        stretches = iter(sieve(codes, ends, times, least_words) if exponent >= 3 and least_words >= 6 else list(zip(bounds, bounds[1:])))
        nxt = next(stretches, None)
        for doc, a, z in zip(ids, bounds, bounds[1:]):
            rows = []
            while nxt and nxt[0] < z:
                if nxt[1] > nxt[0]:
                    rows.append(runs_of(codes[nxt[0] : nxt[1]], least_words, exponent) + [nxt[0] - a, 0, 0])
                nxt = next(stretches, None)
            runs = np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)
            keep = np.ones(z - a, bool)
            for start, length, period in runs.tolist():
                keep[start + period : start + length] = False
            body = b" ".join([spelled[c] for c in codes[a:z][keep].tolist()])
            top = max(runs.tolist(), key=lambda r: (r[1], -r[0], -r[2]), default=None)
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
            row = [doc, len(runs), *(top or [None] * 3), 1000 * top[1] // top[2] if top else None]
            row += [sha256(listed.encode()).hexdigest(), sha256(body).hexdigest()]
            for x in more:
                row.append(body.decode() if x == "text" else [dict(zip(("start", "length", "period"), r)) for r in runs.tolist()])
            yield row

    def run(source):
        for batch in tokens.slices(source, 1):
            rows = list(found(batch))
            columns = list(zip(*rows)) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], schema=schema)

    return run


def find(
    docs: DataFrame,
    places_of: Callable[[int | None, int], np.ndarray | None] | None = None,
    least_words: int = LEAST_WORDS,
    exponent: int = EXPONENT,
    more: tuple[str, ...] = (),
) -> DataFrame:
    """Each row's runs and what is left when all but the first period of every run goes.

    doc_id, n_runs, start, length, period and exponent_milli of the longest run (null without one), runs_sha256 (of
    lines `start,length,period`), collapsed_sha256 (of the kept words, joined by one space). `more` adds "runs" (the
    runs themselves) and "text" (the kept words). `places_of(doc_id, n)` may name the word that stands at each place
    instead of its own; None leaves the words as they are.
    """
    schema = ", ".join([_COLUMNS, *(_MORE[x] for x in more)])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(_find(places_of, least_words, exponent, more), schema)
