"""SentencePiece encoding and decoding by N-best segmentation.

The pieces of a model file span a lattice over each text (spaces written as U+2581, one put in front). Forward Viterbi
scores F(i) are the best score of any segmentation up to i. A backward A* search from the end uses them as exact
heuristics, so hypotheses come out in order of their whole score and no other node is expanded.

Weights. A segmentation's score is the sum of its pieces' log-probabilities. The scores of a model trained by merges are
minus the ranks of its merges, whose sum prefers many early pieces; such a piece of rank r gets the log-probability of
the Zipf-Mandelbrot law, 1 / (r + `OFFSET`) over their sum. Other scores are taken as log-probabilities. Nothing is
counted in the corpus, since that would train a tokenizer. The best segmentation may differ from the order in which the
model merges; `agreement` in the tests measures by how much.

No piece of the model holds U+2581 behind another character, or a line feed, so a text's lattice is a chain of
independent stretches, one for each word with what stands before it. The N best of a text are combined from those of
the stretches: only the n - 1 stretches whose second-best segmentation costs least can differ from their best. What
the second best costs follows from forward and backward scores (of the edges off the best path, the one on the best
way round); the A* search runs on those n - 1 stretches. The distinct stretches of a slice of a batch are scored
together: a trie walk finds all edges, and the scores of all stretches advance place by place as arrays.

A character that is no piece becomes the pieces of its UTF-8 bytes (or the unknown id where the model has none), with
a score below every piece's. Segmentations of equal scores come in the search's order, the same in every run.

Decoding joins pieces and bytes, writes U+2581 as spaces and drops the one in front.

Defined results: null and empty texts have one empty segmentation of score 0. A literal U+2581 is a space, so such
texts, and those with characters of no piece where the model lacks byte pieces, do not round-trip; the column
round_trip says so. Rows are encoded one by one: null doc_ids and repeated rows are allowed, further columns ignored.
"""

from __future__ import annotations

import heapq
import re
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.cache import TwoGenerations, begin, trim
from tessera.llm.common import text_of

SPACE = "▁"
NBEST = 4
#: Added to ranks in the Zipf-Mandelbrot law.
OFFSET = 100
#: N-best lists of stretches that a task remembers, in each of two generations.
REMEMBERED = 20_000
#: Characters of distinct stretches that are scored together, and of texts that are encoded together.
TOGETHER = 1 << 17
SLICE = 6 << 20
#: Ids of segmentations that one batch of rows holds.
BATCH_IDS = 1 << 19
#: Longer stretches are scored one by one.
LONG = 2000
_STRETCH = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
_ODD = f"{SPACE}|  | \n|^ | $"


class _Children:
    """A hash table from (node, character) numbers to nodes; 0 where there is none."""

    def __init__(self, keys: np.ndarray, nodes: np.ndarray):
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.nodes = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = np.flatnonzero(self.keys[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.keys[slot[placed]], self.nodes[slot[placed]] = keys[left[placed]], nodes[left[placed]]
            rest = np.ones(len(left), bool)
            rest[placed] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        seen = self.keys[slot]
        out = np.where(seen == keys, self.nodes[slot], 0)
        on = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(on):
            slot[on] = (slot[on] + 1) & self.mask
            seen = self.keys[slot[on]]
            hit = seen == keys[on]
            out[on[hit]] = self.nodes[slot[on[hit]]]
            on = on[~hit & (seen >= 0)]
        return out


def _exact(weight: float) -> float:
    """A weight in steps of 2^-20, of which sums have no rounding: segmentations of equal scores tie in any order."""
    return round(weight * (1 << 20)) / (1 << 20)


def log_probabilities(scores: dict[str, float]) -> dict[str, float]:
    """Weights of pieces: the model's scores, or those of the Zipf-Mandelbrot law where they are ranks of merges."""
    if not scores or not all(s == int(s) for s in scores.values()):
        return {p: _exact(s) for p, s in scores.items()}
    # Pieces that the model never merges by rank (scores far below) come last.
    far = len(scores) * 4
    shares = {p: 1.0 / (OFFSET + min(-s, far)) for p, s in scores.items()}
    whole = float(np.log(sum(shares.values())))
    return {p: _exact(float(np.log(x)) - whole) for p, x in shares.items()}


class Lattice:
    """The pieces of a model and the searches over them."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        texts = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        self.bytes = {int(texts[i][1:-1], 16): i for i in range(n) if model.is_byte(i)}
        self.unknown = model.unk_id()
        ids = {texts[i]: i for i in range(n) if not special[i] and not model.is_byte(i) and texts[i]}
        weights = log_probabilities({p: model.get_score(i) for p, i in ids.items()})
        self.pieces = {p: (i, weights[p]) for p, i in ids.items()}
        self.longest = max(map(len, self.pieces), default=1)
        self.floor = min(weights.values(), default=0.0) - 10.0
        assert not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.pieces), "a piece crosses words"
        self.spelled = [b"" if special[i] else t.encode() for i, t in enumerate(texts)]
        for b, i in self.bytes.items():
            self.spelled[i] = bytes([b])
        self.known = TwoGenerations(remembered)
        self._grow()

    def _grow(self) -> None:
        """The trie of the pieces: a number for each beginning of a piece and each character, 0 for none."""
        nodes = {"": 0}
        chars = {c: k for k, c in enumerate(sorted({c for p in self.pieces for c in p}), 1)}
        self.classes = np.zeros(0x110000, np.int32)
        self.classes[[ord(c) for c in chars]] = list(chars.values())
        self.width = len(chars) + 1
        keys, to = [], []
        for p in self.pieces:
            for k in range(1, len(p) + 1):
                if p[:k] not in nodes:
                    nodes[p[:k]] = len(nodes)
                    keys.append(nodes[p[: k - 1]] * self.width + chars[p[k - 1]])
                    to.append(nodes[p[:k]])
        self.children = _Children(np.array(keys, np.int64), np.array(to, np.int32))
        self.piece_of, self.weight_of = np.full(len(nodes), -1, np.int64), np.zeros(len(nodes))
        for p, (i, w) in self.pieces.items():
            self.piece_of[nodes[p]], self.weight_of[nodes[p]] = i, w

    def edges(self, text: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For each end, the pieces that end there: (start, score, ids)."""
        pieces, longest, n = self.pieces, self.longest, len(text)
        out: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(n + 1)]
        for i in range(n):
            for j in range(i + 1, min(n, i + longest) + 1):
                hit = pieces.get(text[i:j])
                if hit is not None:
                    out[j].append((i, hit[1], (hit[0],)))
                elif j == i + 1:
                    out[j].append((i, self.floor, self._spelled_out(text[i])))
        return out

    def search(self, text: str, n_best: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of a text: (score, ids), best first."""
        edges = self.edges(text)
        forward = [0.0]
        for j in range(1, len(text) + 1):
            forward.append(max([forward[i] + score for i, score, _ in edges[j]]))
        found: list[tuple[float, tuple[int, ...]]] = []
        # An entry: minus the whole score, minus its number, node, score from here on, ids from here on as a chain.
        # Of equal scores the latest goes on first, so a tie is followed to its end and not fanned out.
        heap, number = [(-forward[-1], 0, len(text), 0.0, ())], 0
        while heap and len(found) < n_best:
            minus, _, j, behind, chain = heapq.heappop(heap)
            if j == 0:
                ids: list[int] = []
                while chain:
                    ids += chain[0]
                    chain = chain[1]
                found.append((-minus, tuple(ids)))
                continue
            for i, score, ids in edges[j]:
                number += 1
                heapq.heappush(heap, (-(forward[i] + (behind + score)), -number, i, behind + score, (ids, chain)))
        return found

    def _all_edges(self, points: np.ndarray, end_of: np.ndarray):
        """All edges over stretches written one behind the other: start, end, id (-1: spelled out), weight."""
        kind = self.classes[points]
        at, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        found, single = [], np.zeros(len(points), bool)
        for k in range(self.longest):
            inside = at + k < end_of[at]
            at, node = at[inside], node[inside]
            c = kind[at + k]
            node = self.children.find(node * self.width + c)
            on = (node > 0) & (c > 0)
            at, node = at[on], node[on].astype(np.int64)
            hit = self.piece_of[node] >= 0
            found.append((at[hit], at[hit] + k + 1, self.piece_of[node[hit]], self.weight_of[node[hit]]))
            if k == 0:
                single[at[hit]] = True
            if not len(at):
                break
        rest = np.flatnonzero(~single)
        found.append((rest, rest + 1, np.full(len(rest), -1), np.full(len(rest), self.floor)))
        return (np.concatenate(x) for x in zip(*found))

    def segment(self, stretches: list[str]):
        """Best ids of all stretches one behind the other, their n + 1 offsets, scores, and what second bests cost."""
        if len(stretches) > 1 and max(map(len, stretches)) > LONG:
            return self._apart(stretches)
        sizes = np.array([len(x) for x in stretches], np.int64)
        ends = np.cumsum(sizes)
        begin = ends - sizes
        points = np.frombuffer("".join(stretches).encode("utf-32-le", "surrogatepass"), np.uint32)
        word = np.repeat(np.arange(len(sizes)), sizes)
        start, end, piece, weight = self._all_edges(points, np.repeat(ends, sizes))
        order = np.argsort(start * (self.longest + 1) + (end - start))
        start, end, piece, weight = start[order], end[order], piece[order], weight[order]
        of = word[start]
        # A stretch of k characters has k + 1 nodes.
        tail, head = start + of, end + of
        from_left, from_right = start - begin[of], ends[of] - end
        total = len(points) + len(sizes)
        forward, into = np.zeros(total), np.full(total, -1)
        # Of edges into one node, those that start first win ties.
        order = np.argsort((end - begin[of]) * total + head, kind="stable")
        self._relax(order, (end - begin[of])[order], tail, head, weight, forward, into)
        backward = np.zeros(total)
        order = np.argsort((ends[of] - start) * total + tail, kind="stable")
        self._relax(order, (ends[of] - start)[order], head, tail, weight, backward, None)
        score = forward[ends + np.arange(len(sizes))]
        on_path, node = np.zeros(len(start), bool), ends + np.arange(len(sizes))
        while len(node):
            edge = into[node]
            edge = edge[edge >= 0]
            on_path[edge] = True
            node = tail[edge]
        through = np.where(on_path, -np.inf, forward[tail] + weight + backward[head])
        other = np.maximum.reduceat(through, np.searchsorted(of, np.arange(len(sizes)))) if len(of) else np.zeros(0)
        path = np.flatnonzero(on_path)
        spelled = {int(e): self._spelled_out(chr(points[start[e]])) for e in path[piece[path] < 0]}
        length = np.ones(len(path), np.int64)
        if spelled:
            length[piece[path] < 0] = [len(x) for x in spelled.values()]
        place = np.cumsum(length) - length
        ids = np.empty(int(length.sum()), np.uint32)
        plain = piece[path] >= 0
        ids[place[plain]] = piece[path[plain]]
        for at, x in zip(place[~plain].tolist(), spelled.values()):
            ids[at : at + len(x)] = x
        offsets = np.concatenate((place, [len(ids)]))[np.searchsorted(of[path], np.arange(len(sizes) + 1))]
        return ids, offsets, score, score - other

    def _apart(self, stretches: list[str]):
        """`segment` with each long stretch alone and all others together, in the given order."""
        is_long = np.array([len(x) > LONG for x in stretches])
        order = np.concatenate([np.flatnonzero(~is_long), np.flatnonzero(is_long)])
        parts = [self.segment([stretches[k] for k in np.flatnonzero(~is_long)])] if not is_long.all() else []
        parts += [self.segment([stretches[k]]) for k in np.flatnonzero(is_long)]
        lengths = np.empty(len(stretches), np.int64)
        lengths[order] = np.concatenate([np.diff(p[1]) for p in parts])
        ends = np.concatenate([[0], np.cumsum(lengths)])
        # The places that the ids of the parts, one behind the other, take.
        done = lengths[order]
        place = np.arange(int(done.sum())) + np.repeat(ends[order] - (np.cumsum(done) - done), done)
        ids = np.empty(len(place), np.uint32)
        ids[place] = np.concatenate([p[0] for p in parts])
        scores = np.empty((2, len(stretches)))
        for k in range(2):
            scores[k, order] = np.concatenate([p[k + 2] for p in parts])
        return ids, ends, scores[0], scores[1]

    @staticmethod
    def _relax_singly(order, source, target, weight, best, into) -> None:
        """_relax edge by edge, for places with few edges each."""
        sums, last = best.tolist(), -1
        for lo in range(0, len(order), 1 << 16):
            some = order[lo : lo + (1 << 16)]
            for edge, a, z, w in zip(some.tolist(), source[some].tolist(), target[some].tolist(), weight[some].tolist()):
                reach = sums[a] + w
                if z != last or reach > sums[z]:
                    sums[z] = reach
                    if into is not None:
                        into[z] = edge
                last = z
        best[:] = sums

    @staticmethod
    def _relax(order, place, source, target, weight, best, into) -> None:
        """Best sums along edges in the order of their place; edges of one target stand together."""
        cuts = np.flatnonzero(np.diff(place, prepend=-1))
        if len(order) < 32 * len(cuts):
            return Lattice._relax_singly(order, source, target, weight, best, into)
        for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
            edges = order[lo:hi]
            to = target[edges]
            reach = best[source[edges]] + weight[edges]
            heads = np.flatnonzero(np.diff(to, prepend=-1))
            top = np.maximum.reduceat(reach, heads)
            best[to[heads]] = top
            if into is not None:
                group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(to))))
                first = np.where(reach == top[group], np.arange(len(to)), len(to))
                into[to[heads]] = edges[np.minimum.reduceat(first, heads)]

    def _spelled_out(self, char: str) -> tuple[int, ...]:
        """The ids of a character that is no piece."""
        return tuple(self.bytes[b] for b in char.encode("utf-8", "surrogatepass")) if self.bytes else (self.unknown,)

    def _split(self, texts: list[str]) -> tuple[list[str], list[np.ndarray]]:
        """The distinct stretches of all texts, and for each text the numbers of its stretches in order."""
        col = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(col, _ODD)
        # Without odd spaces a text is its words; a line feed is a word's first character and has no space before it.
        easy = col.filter(pc.and_(pc.invert(odd), pc.greater(pc.binary_length(col), 0)))
        lists = pc.split_pattern(pc.replace_substring(easy, "\n", " \n"), " ")
        coded = lists.flatten().dictionary_encode()
        stretches = [w if w[:1] == "\n" else SPACE + w for w in coded.dictionary.to_pylist()]
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).tolist()
        number = {}
        parts = iter(codes[a:z] for a, z in zip([0, *ends], ends))
        out = []
        for text, is_odd in zip(texts, odd.to_pylist()):
            if not text:
                out.append(np.zeros(0, np.int64))
            elif is_odd:
                number = number or {s: k for k, s in enumerate(stretches)}
                own = _STRETCH.findall(SPACE + text.replace(" ", SPACE))
                out.append(np.array([number.setdefault(s, len(number)) for s in own], np.int64))
            else:
                out.append(next(parts))
        return list(number) or stretches, out

    def _segment_all(self, stretches: list[str]):
        """`segment` of any number of stretches, so many together as TOGETHER allows; long ones come alone."""
        parts, lo, held = [], 0, 0
        for k, s in enumerate(stretches):
            if held and (held + len(s) > TOGETHER):
                parts.append(self.segment(stretches[lo:k]))
                lo, held = k, 0
            held += len(s)
        if lo < len(stretches):
            parts.append(self.segment(stretches[lo:]))
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0), np.zeros(0)
        shift = np.cumsum([0, *[len(p[0]) for p in parts]])
        offsets = np.concatenate([[0], *[p[1][1:] + at for p, at in zip(parts, shift)]])
        return np.concatenate([p[0] for p in parts]), offsets, *(np.concatenate([p[k] for p in parts]) for k in (2, 3))

    def _others(self, stretch: str, best: np.ndarray, n_best: int) -> list[tuple[float, np.ndarray]]:
        """The n best of a stretch, the known best one in front also where others equal its score."""
        found = self.known.get((stretch, n_best)) or self.known.recall((stretch, n_best))
        if found is None:
            lead, searched = tuple(best.tolist()), self.search(stretch, n_best)
            found = [(searched[0][0], lead), *[c for c in searched if c[1] != lead]][: len(searched)]
            found = [(score, np.array(ids, np.uint32)) for score, ids in found]
            self.known.keep((stretch, n_best), found)
        return found

    def encode_all(self, texts: list[str], n_best: int, with_ids: bool = True):
        """For each text: whether it decodes to itself, and its n best segmentations (score, ids), best first.

        Without `with_ids`, only the best one has ids.
        """
        stretches, codes = self._split(texts)
        ids, offsets, score, cost = self._segment_all(stretches)
        size = np.diff(offsets)
        spelled = [self.spelled[i] for i in ids.tolist()]
        exact = np.array([b"".join(spelled[a:z]) for a, z in zip(offsets.tolist(), offsets[1:].tolist())], object)
        exact = exact == np.array([s.encode("utf-8", "surrogatepass") for s in stretches], object)
        for text, own in zip(texts, codes):
            n = size[own]
            ends = np.cumsum(n)
            best = ids[np.repeat(offsets[own] - ends + n, n) + np.arange(int(n.sum()))]
            whole = float(score[own].sum())
            out = [(whole, best)]
            if n_best > 1 and len(own):
                costs = cost[own]
                few = np.argpartition(costs, n_best - 2)[: n_best - 1] if len(costs) >= n_best else np.arange(len(costs))
                places = [int(p) for p in few[np.lexsort((few, costs[few]))] if np.isfinite(costs[p])]
                picks = [self._others(stretches[own[p]], ids[offsets[own[p]] : offsets[own[p] + 1]], n_best) for p in places]
                for minus, pick in _cheapest(picks, n_best):
                    other = best
                    if with_ids:
                        for p, choice, k in sorted(zip(places, picks, pick), reverse=True, key=lambda x: x[0]):
                            other = np.concatenate((other[: ends[p] - n[p]], choice[k][1], other[ends[p] :]))
                    out.append((whole - minus, other))
            yield bool(exact[own].all()) and SPACE not in text, out

    def encode(self, text: str, n_best: int) -> list[tuple[float, np.ndarray]]:
        """The n best segmentations of one text: (score, ids)."""
        return next(self.encode_all([text], n_best))[1]

    def decode(self, ids) -> str:
        """The text of a sequence of ids."""
        raw = b"".join(map(self.spelled.__getitem__, ids))
        text = raw.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text[:1] == " " else text


def _cheapest(picks: list[list[tuple[float, np.ndarray]]], n_best: int):
    """The n_best - 1 cheapest ways, but the first, to pick from each list: (cost, places in the lists), in order."""
    start = (0,) * len(picks)
    heap, seen, given = [(0.0, start)], {start}, 0
    while heap and given < n_best - 1:
        cost, pick = heapq.heappop(heap)
        if any(pick):
            given += 1
            yield cost, pick
        for a, c in enumerate(picks):
            if pick[a] + 1 < len(c):
                more = (*pick[:a], pick[a] + 1, *pick[a + 1 :])
                if more not in seen:
                    seen.add(more)
                    heapq.heappush(heap, (sum(ch[0][0] - ch[k][0] for ch, k in zip(picks, more)), more))


@cache
def lattice(path: str) -> Lattice:
    """One lattice for a Python worker, kept between tasks."""
    return Lattice(path)


def _parts(batch, chars: int = SLICE):
    """Slices of a batch with their texts: no further text once there are so many characters."""
    lo, texts, size = 0, [], 0
    for text in batch.column(1):
        texts.append(text.as_py())
        size += len(texts[-1])
        if size >= chars:
            yield batch.slice(lo, len(texts)), texts
            lo, texts, size = lo + len(texts), [], 0
    if texts:
        yield batch.slice(lo), texts


def _offsets(lengths) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum(lengths, dtype=np.int64))).astype(np.int32))


def _encode(path: str, n_best: int, with_ids: bool):
    def rows(part, exact, found) -> pa.RecordBatch:
        """One row for each text of the slice `part`."""
        arrays = [
            part.column(0),
            pa.array([len(f[0][1]) for f in found], pa.int64()),
            pa.array([f[0][0] for f in found], pa.float64()),
            pa.array([[score for score, _ in f] for f in found], pa.list_(pa.float64())),
            pa.array([zlib.crc32(f[0][1].astype("<u4").tobytes()) for f in found], pa.int64()),
            pa.array(exact, pa.bool_()),
        ]
        names = ["doc_id", "n_pieces", "score", "scores", "ids_crc32", "round_trip"]
        if with_ids:
            ids = [x for f in found for _, x in f]
            each = pa.ListArray.from_arrays(_offsets([len(x) for x in ids]), pa.array(np.concatenate(ids).astype(np.int64)))
            arrays.append(pa.ListArray.from_arrays(_offsets([len(f) for f in found]), each))
            names.append("segmentations")
        return pa.RecordBatch.from_arrays(arrays + part.columns[2:], names=names + part.schema.names[2:])

    def run(source):
        begin("pieces", lattice.cache_clear)
        model = lattice(path)
        for batch in source:
            for part, texts in _parts(batch):
                exact, found, held, lo = [], [], 0, 0
                for is_exact, segmentations in model.encode_all(texts, n_best, with_ids):
                    exact.append(is_exact)
                    found.append(segmentations)
                    held += sum(len(x) for _, x in segmentations)
                    if held > BATCH_IDS:
                        yield rows(part.slice(lo, len(found)), exact, found)
                        exact, found, held, lo = [], [], 0, lo + len(found)
                if found:
                    yield rows(part.slice(lo, len(found)), exact, found)
        trim()

    return run


def encode(docs: DataFrame, model: str, n_best: int = NBEST, with_ids: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each row's best segmentation (n_pieces, score, ids_crc32, round_trip), the scores of the n best, and (if
    wanted) the ids of the n best, best first. Fewer than n where a text has fewer. `carry` names columns to keep."""
    schema = "doc_id long, n_pieces long, score double, scores array<double>, ids_crc32 long, round_trip boolean"
    schema += ", segmentations array<array<bigint>>" * with_ids
    schema += "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    kept = [F.col(f"`{c}`") for c in carry]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), *kept).mapInArrow(
        _encode(model, n_best, with_ids), schema
    )


def _decode(path: str):
    def run(source):
        begin("pieces", lattice.cache_clear)
        model = lattice(path)
        for batch in source:
            texts = [None if ids is None else model.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """The texts of rows of ids (an array column): doc_id, text."""
    return encoded.select("doc_id", F.col(ids)).mapInArrow(_decode(model), "doc_id long, text string")
