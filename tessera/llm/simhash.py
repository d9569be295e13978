"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints. A document's words (A-Z lower-cased) give shingles of three words, repeats included; a bit of the 64-bit
fingerprint is set if it is set in more than half of the shingles' XXH64 hashes (seed 42). Equal fingerprints form one
class before anything else, so copies cost one row each.

Principle. Cut the 64 bits into m parts with thresholds t_1 .. t_m that sum to 3 - m + 1. Two fingerprints within
distance 3 differ in at most t_i bits in some part i; a threshold of -1 leaves its part out.

Parts. Bits that go together are put into one part: the correlations of all pairs of bits are taken over all
fingerprints, and each part grows by the bit most correlated with it. The number of parts is the one with the least
estimated work for the number of fingerprints; it changes the plan only.

Thresholds. Each fingerprint gets its own, by dynamic programming over parts and sums, for the least estimated number
of candidates plus probes. Candidates are estimated from histograms of part values over all fingerprints (of 16 bits
of a part at most, so at most 2^16 counts a part reach the driver), summed over Hamming balls.

Probes. Every fingerprint is listed under its value in every part, and probes the values within its thresholds. A cell
is a value with what is listed there and what probes it; it is searched by XOR and bit counts. Cells of a value that
more than `CELL` fingerprints have are split again by four parts of the other bits, of which one must be equal; cells
still longer are searched block by block, in tasks of their own. Nothing is dropped. A long cell returns a spanning
forest of its links: a search from node to node looks only at nodes that no search has reached yet, so that groups of
near copies cost few comparisons and no pairs. The links of all cells connect exactly what all pairs within distance
3 connect.

Memory: a task holds one slice of texts (16 MB), one batch of fingerprints with its probes, or one bucket of about
`BUCKET` entries.

Defined results: null and blank texts have fingerprint zero and are linked like any other. A null doc_id counts as
larger than any other; a component of null doc_ids only has a null id. Repeated rows are classified alike. An empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import tokens
from tessera.llm.common import if_few, stage_table
from tessera.llm.components import components

WIDTH = 3
SEED = 42
DISTANCE = 3
#: Bits of a part that its histogram counts.
COUNTED_BITS = 16
#: Cost of one probe, in candidates.
PROBE = 4
#: Listed fingerprints from which a cell is split, at least; more, if there would be over MOST_HOT such cells.
CELL = 4096
MOST_HOT = 1 << 18
#: Cells up to this length are searched as pairs.
SHORT = 24
BUCKET = 1 << 20

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fingerprints(texts: pa.Array, width: int = WIDTH) -> np.ndarray:
    """The fingerprint of each text."""
    from xxhash import xxh64_intdigest

    data, offsets = tokens.buffers(texts)
    n = len(offsets) - 1
    out = np.zeros(n, np.uint64)
    if not len(data):
        return out
    blank = _BLANK[data]
    edge = np.ones(len(data) + 1, bool)  # no word goes on over these places
    edge[1:-1] = blank[:-1]
    edge[offsets] = True
    starts = np.flatnonzero(~blank & edge[:-1])
    after = np.ones(len(data), bool)
    after[:-1] = blank[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    ends = np.flatnonzero(~blank & after) + 1
    # Words joined by one space: a blank stays if a word ends before it.
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    data = np.where(blank, np.uint8(32), _LOWER[data])
    place = np.concatenate(([0], np.cumsum(keep)))
    joined = data[keep].tobytes()
    starts, ends = place[starts], place[ends]
    at = np.searchsorted(starts, place[offsets])
    count = np.diff(at)
    shingles = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    of = np.repeat(np.arange(n), shingles)
    first = np.arange(len(of)) - np.repeat(np.cumsum(shingles) - shingles, shingles) + at[of]
    last = np.minimum(first + width, at[of + 1]) - 1
    hashes = np.fromiter(
        (xxh64_intdigest(joined[a:z], SEED) for a, z in zip(starts[first].tolist(), ends[last].tolist())), np.uint64, len(of)
    )
    for k in range(8):
        lane = ((hashes >> np.uint64(8 * k)) & np.uint64(255)).astype(np.int64)
        counts = np.bincount(of * 256 + lane, minlength=256 * n).reshape(n, 256) @ _BITS
        majority = (2 * counts > shingles[:, None]) @ (1 << np.arange(8))
        out |= majority.astype(np.uint64) << np.uint64(8 * k)
    return out


def _fingerprinted(width: int):
    def run(source):
        for batch in tokens.slices(source, 1):
            fps = fingerprints(batch.column(1), width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64), pa.int64())], names=["doc_id", "fp"])

    return run


# ---- parts and thresholds


def gather(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint, the first one lowest."""
    out = np.zeros(len(fps), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def group_bits(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in `parts` parts, correlated ones together; `together` counts the fingerprints in which two bits are set."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    strength = np.abs(together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(strength, -1.0)
    free, out = set(range(64)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        rest = sorted(free)
        if size > 1:
            best = np.unravel_index(np.argmax(strength[np.ix_(rest, rest)]), (len(rest), len(rest)))
            part = [rest[best[0]], rest[best[1]]]
        else:
            part = rest[:1]
        while len(part) < size:
            rest = sorted(free - set(part))
            part.append(rest[int(np.argmax(strength[np.ix_(rest, part)].sum(1)))])
        free -= set(part)
        out.append(sorted(part))
    return out


def choose_parts(n: int) -> int:
    """The number of parts with the least work for n fingerprints of independent bits."""

    def work(m: int) -> float:
        # The least uneven thresholds; those of zero probe one value.
        extra, width = DISTANCE - m + 1, 64 // m
        tops = [extra // m + (i < extra % m) for i in range(m)]
        probes = sum(comb(width, k) for t in tops for k in range(t + 1))
        return probes * (PROBE + n / 2**width)

    return min(range(2, DISTANCE + 2), key=work)


class Plan:
    """Parts of bits, estimated costs of thresholds, and the cells that are split."""

    def __init__(self, parts: list[list[int]]):
        self.parts = parts
        self.rest = [group_evenly([b for b in range(64) if b not in p], DISTANCE + 1) for p in parts]
        self.costs: list[np.ndarray] = []
        self.hot = np.zeros(0, np.uint64)
        self.hot_cells = np.zeros(0, np.uint64)
        self.blocks = np.zeros(0, np.int64)

    def values(self, fps: np.ndarray) -> list[np.ndarray]:
        return [gather(fps, p) for p in self.parts]

    def estimate(self, histograms: list[np.ndarray]) -> None:
        """Costs by part, threshold (from 0) and counted value: candidates in the Hamming ball, and probes."""
        for part, counts in zip(self.parts, histograms):
            bits = min(len(part), COUNTED_BITS)
            at = [counts.astype(np.float64)] + [np.zeros(len(counts)) for _ in range(DISTANCE)]
            for b in range(bits):
                flipped = np.arange(len(counts)) ^ (1 << b)
                at = [at[0], *[at[k] + at[k - 1][flipped] for k in range(1, DISTANCE + 1)]]
            shares = [comb(len(part), k) / max(comb(bits, k), 1) / 2.0 ** (len(part) - bits) for k in range(DISTANCE + 1)]
            probes = [PROBE * comb(len(part), k) for k in range(DISTANCE + 1)]
            self.costs.append(np.cumsum([a * s + p for a, s, p in zip(at, shares, probes)], axis=0))

    def thresholds(self, values: list[np.ndarray]) -> np.ndarray:
        """For each fingerprint the thresholds (-1 .. 3) of its parts of the least total cost that sum to 3 - m + 1."""
        m, n = len(self.parts), len(values[0])
        whole = DISTANCE + 1  # the sum of thresholds + 1
        best = np.full((n, whole + 1), np.inf)
        best[:, 0] = 0
        ways = []
        for costs, v in zip(self.costs, values):
            v = (v & np.uint64(costs.shape[1] - 1)).astype(np.int64)
            options = np.concatenate([np.zeros((1, n)), costs[:, v]])
            sums = np.full((whole + 1, whole + 1, n), np.inf)
            for s in range(whole + 1):
                for t in range(s + 1):
                    sums[s, t] = best[:, s - t] + options[t]
            way = sums.argmin(1)
            best = np.take_along_axis(sums, way[:, None], 1)[:, 0].T
            ways.append(way)
        out, left = np.empty((n, m), np.int64), np.full(n, whole)
        for i in range(m - 1, -1, -1):
            t = ways[i][left, np.arange(n)]
            out[:, i] = t - 1
            left = left - t
        return out

    def entries(self, fps: np.ndarray, refined_only: bool = False) -> np.ndarray:
        """What is listed and what is probed, as entries (key of a cell, fp, whether it probes)."""
        values = self.values(fps)
        limits = self.thresholds(values)
        out = []
        for i, (part, v) in enumerate(zip(self.parts, values)):
            out.append(self._cells(i, v, fps, limits[:, i] >= 0, refined_only))
            for t in range(1, DISTANCE + 1):
                wide = limits[:, i] >= t
                if wide.any():
                    masks = np.array([sum(1 << b for b in c) for c in combinations(range(len(part)), t)], np.uint64)
                    near = (v[wide][:, None] ^ masks).ravel()
                    some = np.repeat(fps[wide], len(masks))
                    out.append(self._cells(i, near, some, np.ones(len(some), bool), refined_only))
        return np.concatenate(out)

    def _cells(self, i: int, values: np.ndarray, fps: np.ndarray, probes: np.ndarray, refined_only: bool) -> np.ndarray:
        plain = values | np.uint64(i << 33)
        split = np.isin(plain, self.hot)
        key = tokens.mix(plain[~split] + np.uint64(1))
        done = [] if refined_only else [_entries(key, fps[~split], probes[~split])]
        if split.any():
            plain, some, asks = plain[split], fps[split], probes[split]
            for j, bits in enumerate(self.rest[i]):
                key = tokens.mix(tokens.mix(plain + np.uint64(1)) ^ (gather(some, bits) | np.uint64((j + 1) << 40)))
                done += self._blocks(key, some, asks)
        return np.concatenate(done) if done else np.zeros(0, _ENTRY)

    def _blocks(self, key, fps, probes) -> list[np.ndarray]:
        if not len(self.hot_cells):
            return [_entries(key, fps, probes)]
        at = np.minimum(np.searchsorted(self.hot_cells, key), len(self.hot_cells) - 1)
        long = self.hot_cells[at] == key
        out = [_entries(key[~long], fps[~long], probes[~long])]
        if long.any():
            key, fps, probes, blocks = key[long], fps[long], probes[long], self.blocks[at[long]]
            own = (tokens.mix(fps) % blocks.astype(np.uint64)).astype(np.int64)
            row = np.repeat(np.arange(len(key)), blocks)
            other = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            pair = np.minimum(own[row], other) * (1 << 24) + np.maximum(own[row], other) + 1
            out.append(_entries(tokens.mix(key[row] ^ tokens.mix(pair.astype(np.uint64))), fps[row], probes[row]))
        return out


def group_evenly(bits: list[int], parts: int) -> list[list[int]]:
    return [bits[k::parts] for k in range(parts)]


_ENTRY = np.dtype([("key", "<u8"), ("fp", "<u8"), ("asks", "u1")])


def _entries(key, fps, probes) -> np.ndarray:
    out = np.empty(len(key), _ENTRY)
    out["key"], out["fp"], out["asks"] = key, fps, probes
    return out


# ---- cells


def _reach(fps: np.ndarray, asks: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links (within DISTANCE) of one cell that have a probing node."""
    order = np.argsort(~asks, kind="stable")
    fps, probing = fps[order], int(asks.sum())
    # Nodes that no search has reached: probing ones first.
    open_asks, open_rest = np.arange(probing), np.arange(probing, len(fps))
    links = []
    while len(open_asks):
        queue, open_asks = [int(open_asks[0])], open_asks[1:]
        while queue:
            i = queue.pop()
            near = np.bitwise_count(fps[open_asks] ^ fps[i]) <= DISTANCE
            new = open_asks[near]
            open_asks = open_asks[~near]
            if i < probing and len(open_rest):
                near = np.bitwise_count(fps[open_rest] ^ fps[i]) <= DISTANCE
                new = np.concatenate([new, open_rest[near]])
                open_rest = open_rest[~near]
            new = new.tolist()
            queue += new
            links += [(i, j) for j in new]
    return [(int(fps[i]), int(fps[j])) for i, j in links]


def cell_links(entries: np.ndarray) -> np.ndarray:
    """Links of all cells of a bucket that connect what their pairs within DISTANCE connect, as rows (a, b)."""
    entries = entries[np.lexsort((entries["asks"], entries["fp"], entries["key"]))]
    last = np.ones(len(entries), bool)  # of equal key and fp, the one that probes, if any
    last[:-1] = (entries["key"][1:] != entries["key"][:-1]) | (entries["fp"][1:] != entries["fp"][:-1])
    entries = entries[last]
    first = np.flatnonzero(np.concatenate(([True], entries["key"][1:] != entries["key"][:-1]))) if len(entries) else np.zeros(0, np.int64)
    size = np.diff(np.concatenate((first, [len(entries)])))
    asking = np.add.reduceat(entries["asks"].astype(np.int64), first) if len(entries) else size
    found = [np.zeros((0, 2), np.uint64)]
    short = (size > 1) & (size <= SHORT) & (asking > 0)
    for k in range(2, SHORT + 1):
        at = first[short & (size == k)]
        for i, j in combinations(range(k), 2) if len(at) else ():
            x, y = entries[at + i], entries[at + j]
            ok = (np.bitwise_count(x["fp"] ^ y["fp"]) <= DISTANCE) & ((x["asks"] | y["asks"]) > 0)
            found.append(np.stack([x["fp"][ok], y["fp"][ok]], axis=1))
    for a, k in zip(first[(size > SHORT) & (asking > 0)].tolist(), size[(size > SHORT) & (asking > 0)].tolist()):
        cell = entries[a : a + k]
        links = _reach(cell["fp"], cell["asks"] > 0)
        if links:
            found.append(np.array(links, np.uint64))
    return np.unique(np.concatenate(found), axis=0)


def _search(table: pa.Table) -> pa.Table:
    links = cell_links(np.concatenate([np.frombuffer(x, _ENTRY) for x in table.column("entries").to_pylist()]))
    return pa.table({c: pa.array(links[:, k].copy().view(np.int64), pa.int64()) for k, c in enumerate("ab")})


# ---- jobs over all fingerprints


def _each(source, of):
    for batch in source:
        yield of(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))


def _counted_pairs(source):
    """How many fingerprints have bits i and j set, summed over a task: i * 64 + j, n."""
    total = np.zeros((64, 64))
    for bits in _each(source, lambda f: ((f[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)):
        total += bits.T @ bits
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(4096)), pa.array(total.ravel().astype(np.int64))], names=["key", "n"])


def _key_counts(keys_of):
    """Counts of keys, combined within batches: key, n."""

    def run(source):
        for keys in _each(source, keys_of):
            key, n = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64), pa.int64()), pa.array(n, pa.int64())], names=["key", "n"])

    return run


def _packed(plan: Plan, buckets: int):
    def run(source):
        for entries in _each(source, plan.entries):
            bucket = (entries["key"] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            at = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full, data = np.flatnonzero(np.diff(at)), entries[order]
            parts = [data[at[b] : at[b + 1]].tobytes() for b in full.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(parts, pa.binary())], names=["bucket", "entries"])

    return run


def _totals(classes: DataFrame, of) -> DataFrame:
    return classes.select("fp").mapInArrow(of, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def plan_for(classes: DataFrame, parts: int | None = None, cell: int = CELL) -> tuple[Plan, int]:
    """The plan for all distinct fingerprints (column fp), and the number of entries it makes, about."""
    n = classes.count()
    together = np.zeros(4096)
    for r in _totals(classes, _counted_pairs).collect():  # 4,096 numbers
        together[r["key"]] = r["n"]
    plan = Plan(group_bits(together.reshape(64, 64), n, parts or choose_parts(n)))
    m = len(plan.parts)

    def counted(fps):
        return np.concatenate([(v & np.uint64((1 << COUNTED_BITS) - 1)) | np.uint64(i << COUNTED_BITS) for i, v in enumerate(plan.values(fps))])

    counts = _totals(classes, _key_counts(counted)).toPandas()  # at most 2^16 for each part
    histograms = []
    for i, part in enumerate(plan.parts):
        own = counts[counts["key"].to_numpy() >> COUNTED_BITS == i]
        histogram = np.zeros(1 << min(len(part), COUNTED_BITS))
        histogram[own["key"].to_numpy() & ((1 << COUNTED_BITS) - 1)] = own["n"].to_numpy()
        histograms.append(histogram)
    plan.estimate(histograms)
    # No more than MOST_HOT values of either kind: so many entries exceed the bound at most.
    bound = max(cell, m * n // MOST_HOT)
    listed = _totals(classes, _key_counts(lambda fps: np.concatenate([v | np.uint64(i << 33) for i, v in enumerate(plan.values(fps))])))
    hot = listed.filter(F.col("n") > bound).select("key").toPandas()["key"].to_numpy(np.int64)
    plan.hot = np.sort(hot.view(np.uint64))
    if len(hot):
        refined = _totals(classes, _key_counts(lambda fps: plan.entries(fps, refined_only=True)["key"]))
        refined = stage_table(refined)
        bound = max(cell, (refined.agg(F.sum("n")).first()[0] or 0) // MOST_HOT)
        long = refined.filter(F.col("n") > bound).toPandas()
        order = np.argsort(long["key"].to_numpy(np.int64).view(np.uint64))
        plan.hot_cells = long["key"].to_numpy(np.int64).view(np.uint64)[order]
        plan.blocks = -(-long["n"].to_numpy(np.int64)[order] // bound)
    return plan, n * (m + 1)


def links_of(classes: DataFrame, parts: int | None = None, cell: int = CELL) -> DataFrame:
    """Links (a, b) that connect what all pairs of fingerprints (column fp, distinct) within DISTANCE connect."""
    plan, entries = plan_for(classes, parts, cell)
    spread = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = classes.select("fp").mapInArrow(_packed(plan, max(2 * spread, entries // BUCKET + 1)), "bucket long, entries binary")
    return packed.groupBy("bucket").applyInArrow(_search, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Each row's fingerprint (16 hexadecimal digits) and component: doc_id, fingerprint, component_id."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    rows = stage_table(texts.mapInArrow(_fingerprinted(width), "doc_id long, fp long"))
    classes = stage_table(rows.groupBy("fp").agg(F.min("doc_id").alias("cid")))
    links = stage_table(links_of(classes).distinct())
    labels = components(links, classes.select(F.col("fp").alias("node"), F.col("cid").alias("value")))
    joined = classes.join(labels.select(F.col("node").alias("fp"), "component", "value"), "fp", "left")
    ids = stage_table(joined.select("fp", F.when(F.col("component").isNull(), F.col("cid")).otherwise(F.col("value")).alias("component_id")))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return rows.join(if_few(ids), "fp").select("doc_id", digits, "component_id")
