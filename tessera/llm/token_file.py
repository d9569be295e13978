"""Token-ID files: canonical length-limited Huffman coding of ids from global counts.

1. Texts are encoded once by the tokenizers library; the end id is appended; ids are staged in the shared folder.
2. Counts of all ids give code lengths (package-merge, at most `MAX_BITS` bits) and canonical codes. Counts and
   codes have one entry for each id of the vocabulary, whatever the size of the corpus.
3. Each document becomes a byte-aligned bit string with bit offsets every `STEP` ids. Documents are dealt into
   ranges of doc_id by quantiles and sorted; a task streams them into blocks of about `BLOCK_IDS` ids.
4. Blocks are rows of a Parquet table (the file format): range, place in it, ids before it in the range, doc_ids,
   counts of ids, bit offsets, and the payload. A block is decoded on its own, all its checkpoints side by side,
   by a table of 2^MAX_BITS entries. The codebook (id, bits) is a table beside it.

Defined results: a null text counts as empty and has the end id alone. Null doc_ids come first. Rows of equal
doc_id follow each other in the order of their codes. An empty table gives files without blocks. Further columns
are ignored. Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import re
import zlib
from functools import cache
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import checkpoint_dir, text_of

MAX_BITS = 20
STEP = 256
BLOCK_IDS = 1 << 20
END_ID = 2
#: Word encodings that a worker remembers in each of two generations, besides those of one slice of texts.
REMEMBERED = 600_000
#: Characters of texts that are encoded together.
SLICE = 3 << 20

_ODD_SPACE = re.compile(r"\s(?=\s|\Z)")


class Encoder:
    """Encodes texts as the tokenizers library does, remembering the ids of words seen before.

    A byte-level pre-tokenizer always cuts before a single space or line feed between other characters (a space
    belongs to what follows it, a line feed stands alone). So a text is the sequence of its words, each with the space
    or line feed before it. Texts with two white-space characters in a row, or one at the end, go to the library
    whole. The words that a slice of texts shows for the first time are cut by the pre-tokenizer's pattern and go to the
    library's model in one call; the bytes that ids stand for tell where each word ends.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import regex
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        size = self.library.get_vocab_size()
        self.wide = size > 1 << 16
        self.type = np.dtype("<u4" if self.wide else "<u2")
        self.pattern = regex.compile(PATTERN)
        # The alphabet that byte-level models spell bytes in: printable bytes stand for themselves.
        printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        others = iter(range(256, 512))
        spelling = {b: chr(b) if b in set(printable) else chr(next(others)) for b in range(256)}
        assert set(spelling.values()) == set(pre_tokenizers.ByteLevel.alphabet())
        # A zero byte stands between pieces; words that hold one go to the library whole.
        self.spelling = np.array([ord(c) for _, c in sorted((spelling | {0: " "}).items())], "<u4")
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.length = np.zeros(size, np.int64)
        for token, i in self.library.get_vocab().items():
            self.length[i] = len(token)
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        """Remembers the ids of words, each with the space before it or the line feed that it begins with."""
        plain = [w for w in words if "\0" not in w]
        for w in words.difference(plain) if len(plain) < len(words) else ():
            self.known[w] = self._whole(w if w[0] == "\n" else " " + w)
        if not plain:
            return
        # No word has a space, and a line feed only at its beginning: these two bytes show where each word begins.
        text = (" " + " ".join(plain)).replace(" \n", "\n")
        raw = np.frombuffer(text.encode(), np.uint8)
        begins = np.append(np.flatnonzero((raw == 32) | (raw == 10))[1:], len(raw))
        pieces = self.pattern.findall(text)
        size = self.type.itemsize
        data = b"".join(map(self._pieces(list(set(pieces))).__getitem__, pieces))
        ids = np.frombuffer(data, self.type)
        ends = ((np.searchsorted(np.cumsum(self.length[ids]), begins) + 1) * size).tolist()
        self.known.update(zip(plain, [data[a:z] for a, z in zip([0, *ends], ends)]))

    def _pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of distinct pieces, by the model."""
        raw = np.frombuffer("\0".join([*pieces, ""]).encode(), np.uint8)
        spelt = self.spelling[raw].tobytes().decode("utf-32-le")
        ids = np.array(self.model.encode_batch_fast([spelt], add_special_tokens=False)[0].ids, self.type)
        # Bytes of each piece; the zero bytes between them are no part of any.
        ends = np.flatnonzero(raw == 0) - np.arange(len(pieces))
        at = ((np.searchsorted(np.cumsum(self.length[ids]), ends) + 1) * self.type.itemsize).tolist()
        data = ids.tobytes()
        return dict(zip(pieces, [data[a:z] for a, z in zip([0, *at], at)]))

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.type).tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian integers of self.type."""
        odd = [bool(_ODD_SPACE.search(t)) for t in texts]
        cut = [None if o else t.replace("\n", " \n").split(" ") for t, o in zip(texts, odd)]
        heads = [self._whole(t) if c is None else self._whole(c[0]) if c[0] else b"" for t, c in zip(texts, cut)]
        rest = [[] if c is None else c[1:] for c in cut]
        # Generations change between slices only, so the words of one slice stay known until its texts are put together.
        if len(self.known) >= self.remembered:
            self.known, self.before = {}, self.known
        known = self.known
        missing = set(chain.from_iterable(rest)).difference(known)
        old = missing & self.before.keys()
        known.update((w, self.before[w]) for w in old)
        self._learn(missing - old)
        # itemgetter with one key gives no tuple, so an empty word, of no ids, stands before the others.
        known[""] = b""
        return [h + b"".join(itemgetter("", "", *words)(known)) for h, words in zip(heads, rest)]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


@cache
def encoder(path: str) -> Encoder:
    """One encoder for a Python worker, kept between tasks."""
    return Encoder(path)


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Lengths of the best prefix code of at most `limit` bits (package-merge); 0 where the count is 0."""
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.int64)
    lists, level = [], weights
    for _ in range(limit - 1):
        packages = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, packages])
        order = np.argsort(both, kind="stable")
        lists.append(order < len(weights))
        level = both[order]
    lengths, take = np.zeros(len(used), np.int64), 2 * len(used) - 2
    for single in reversed(lists):
        items = int(single[:take].sum())
        lengths[:items] += 1
        take = 2 * (take - items)
    lengths[:take] += 1
    out[used] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of (length, id), for ids with a length."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    steps = np.uint64(1) << (np.uint64(63) - lengths[used].astype(np.uint64))
    before = np.zeros(len(used), np.uint64)
    before[1:] = np.cumsum(steps)[:-1]
    codes[used] = before >> (np.uint64(63) - lengths[used].astype(np.uint64))
    return codes


def decoding_table(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Id and length of the code at the head of each `limit` bits."""
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    width = 1 << (limit - lengths[used].astype(np.int64))
    ids, bits = np.zeros(1 << limit, np.uint32), np.ones(1 << limit, np.uint8)
    n = int(width.sum())
    ids[:n] = np.repeat(used, width)
    bits[:n] = np.repeat(lengths[used], width)
    return ids, bits


def pack(ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray, codes: np.ndarray, step: int = STEP):
    """Bit strings of consecutive documents of `counts` ids: bytes, byte offsets, bit offsets of every `step`-th id
    within its document, and offsets of the documents among those."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=at[1:])
    total = np.concatenate([[0], ends])[at]
    n_bytes = (np.diff(total) + 7) // 8
    base = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(n_bytes, out=base[1:])
    pos = ends - size + np.repeat(8 * base[:-1] - total[:-1], counts)
    word = pos >> 5
    bits = codes[ids] << (64 - (pos & 31) - size).astype(np.uint64)
    out = np.zeros(int(base[-1] + 3) // 4 + 2, np.uint32)
    if len(ids):
        heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        merged = np.bitwise_or.reduceat(bits, heads)
        out[word[heads]] |= (merged >> np.uint64(32)).astype(np.uint32)
        out[word[heads] + 1] |= (merged & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    place = np.arange(len(ids)) - np.repeat(at[:-1], counts)
    marks = np.flatnonzero(place % step == 0)
    offsets = (pos - np.repeat(8 * base[:-1], counts))[marks]
    return out.astype(">u4").tobytes()[: int(base[-1])], base, offsets, np.searchsorted(marks, at)


def unpack(payload: bytes, starts: np.ndarray, n_ids: np.ndarray, table: tuple[np.ndarray, np.ndarray], limit: int):
    """Ids of stretches that start at bit `starts` and hold `n_ids` ids each, all stretches decoded side by side."""
    raw = np.frombuffer(payload + b"\0\0\0\0", np.uint8).astype(np.uint32)
    heads = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    ids, bits = table
    at = np.zeros(len(n_ids) + 1, np.int64)
    np.cumsum(n_ids, out=at[1:])
    out = np.empty(int(at[-1]), np.uint32)
    order = np.argsort(-n_ids, kind="stable")
    pos, to, left = starts[order].astype(np.int64), at[:-1][order], np.sort(n_ids)
    for k in range(int(n_ids.max(initial=0))):
        live = len(left) - int(np.searchsorted(left, k, side="right"))
        pos, to = pos[:live], to[:live]
        seen = (heads[pos >> 3] >> (32 - limit - (pos & 7)).astype(np.uint32)) & np.uint32((1 << limit) - 1)
        out[to + k] = ids[seen]
        pos = pos + bits[seen]
    return out


def _slices(texts, chars: int = SLICE):
    """The texts in lists of about so many characters."""
    out, held = [], 0
    for text in texts:
        out.append(text.as_py())
        held += len(out[-1])
        if held >= chars:
            yield out
            out, held = [], 0
    if out:
        yield out


def _encode(path: str, end_id: int):
    def run(source):
        enc = encoder(path)
        end = np.array([end_id], enc.type).tobytes()
        for batch in source:
            lo = 0
            for texts in _slices(batch.column(1)):
                ids = [x + end for x in enc.encode_all(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(ids)), pa.array(ids, pa.binary())], names=["doc_id", "ids"]
                )
                lo += len(ids)

    return run


def _count(kind: str):
    def run(source):
        total = np.zeros(0, np.int64)
        for batch in source:
            for i in range(0, batch.num_rows, 500):
                ids = np.frombuffer(b"".join(batch.column(0)[i : i + 500].to_pylist()), kind)
                new = np.bincount(ids, minlength=len(total))
                new[: len(total)] += total
                total = new
        used = np.flatnonzero(total)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    return run


def _code(kind: str, lengths: np.ndarray, codes: np.ndarray):
    def run(source):
        for batch in source:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                raw = part.column(2).to_pylist()
                counts = np.array([len(x) // np.dtype(kind).itemsize for x in raw], np.int64)
                data, base, offsets, at = pack(np.frombuffer(b"".join(raw), kind), counts, lengths, codes)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(counts, pa.int64()),
                        pa.array([data[a:b] for a, b in zip(base, base[1:])], pa.binary()),
                        pa.array([offsets[a:b].astype("<u4").tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                    ],
                    names=["part", "doc_id", "n_ids", "bits", "marks"],
                )

    return run


_BLOCK = "part int, block int, before long, doc_ids array<bigint>, n_ids array<bigint>, sizes array<bigint>, marks binary, payload binary"


def _blocks(block_ids: int):
    def run(source):
        part, block, before, held = None, 0, 0, []

        def flush():
            nonlocal block, before, held
            n = [r[1] for r in held]
            row = {
                "part": pa.array([part], pa.int32()),
                "block": pa.array([block], pa.int32()),
                "before": pa.array([before], pa.int64()),
                "doc_ids": pa.array([[r[0] for r in held]], pa.list_(pa.int64())),
                "n_ids": pa.array([n], pa.list_(pa.int64())),
                "sizes": pa.array([[len(r[2]) for r in held]], pa.list_(pa.int64())),
                "marks": pa.array([b"".join(r[3] for r in held)], pa.binary()),
                "payload": pa.array([b"".join(r[2] for r in held)], pa.binary()),
            }
            block, before, held = block + 1, before + sum(n), []
            return pa.RecordBatch.from_arrays(list(row.values()), names=list(row))

        ids = 0
        for batch in source:
            for p, *row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if p != part or ids >= block_ids:
                    if held:
                        yield flush()
                    if p != part:
                        part, block, before = p, 0, 0
                    ids = 0
                held.append(row)
                ids += row[1]
        if held:
            yield flush()

    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, max_bits: int = MAX_BITS, block_ids: int = BLOCK_IDS) -> None:
    """Encodes all texts and writes the files below `path`: blocks and codebook, both Parquet."""
    spark = docs.sparkSession
    kind = encoder(tokenizer).type.str
    staged = f"{path}/ids"
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        _encode(tokenizer, end_id), "doc_id long, ids binary"
    ).write.option("compression", "zstd").parquet(staged)
    ids = spark.read.parquet(staged)
    counted = ids.select("ids").mapInArrow(_count(kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 1, np.int64)
    counts[counted["id"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    lengths = code_lengths(counts, max_bits)
    codes = canonical(lengths)
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    n_parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = ids.agg(F.percentile_approx("doc_id", [k / n_parts for k in range(1, n_parts)], 100_000)).first()[0] or []
    cuts = sorted(set(cuts))
    # Position of doc_id among the cuts; null first.
    part = F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("doc_id"))), F.lit(0)) if cuts else F.lit(0)
    part = F.when(F.col("doc_id").isNull(), 0).otherwise(part)
    (
        ids.select(part.cast("int").alias("part"), "doc_id", "ids")
        .mapInArrow(_code(kind, lengths, codes), "part int, doc_id long, n_ids long, bits binary, marks binary")
        .repartition("part")
        .sortWithinPartitions("part", "doc_id", "bits")
        .mapInArrow(_blocks(block_ids), _BLOCK)
        .write.option("compression", "none")
        .parquet(f"{path}/blocks")
    )


def _decode(lengths: np.ndarray, offsets: dict[int, int], limit: int, step: int, with_ids: bool):
    def run(source):
        table = decoding_table(lengths, limit)
        for batch in source:
            for row in batch.to_pylist():
                n_ids, sizes = np.array(row["n_ids"], np.int64), np.array(row["sizes"], np.int64)
                marks = np.frombuffer(row["marks"], "<u4").astype(np.int64)
                per_doc = -(-n_ids // step)
                base = np.cumsum(sizes) - sizes
                starts = marks + np.repeat(8 * base, per_doc)
                n = np.full(len(marks), step, np.int64)
                n[np.cumsum(per_doc) - 1] = n_ids - (per_doc - 1) * step
                ids = unpack(row["payload"], starts, n, table, limit).astype("<u4")
                at = np.concatenate([[0], np.cumsum(n_ids)])
                out = {
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": pa.array(at[:-1] + row["before"] + offsets[row["part"]], pa.int64()),
                    "n_tokens": pa.array(n_ids, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(ids[a:b]) for a, b in zip(at, at[1:])], pa.int64()),
                }
                if with_ids:
                    out["ids"] = pa.array([ids[a:b].tolist() for a, b in zip(at, at[1:])], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return run


def read(spark: SparkSession, path: str, with_ids: bool = True, max_bits: int = MAX_BITS, step: int = STEP) -> DataFrame:
    """The documents of the files below `path`: doc_id, start, n_tokens, ids_crc32 and (if wanted) ids."""
    book = spark.read.parquet(f"{path}/codebook").toPandas()
    lengths = np.zeros(int(book["id"].max()) + 1 if len(book) else 1, np.uint8)
    lengths[book["id"].to_numpy(np.int64)] = book["bits"].to_numpy(np.uint8)
    blocks = spark.read.parquet(f"{path}/blocks")
    # One number for each range of doc_ids, of which there are as many as partitions.
    totals = blocks.groupBy("part").agg(F.sum(F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).collect()
    offsets, so_far = {}, 0
    for row in sorted(totals):
        offsets[row["part"]] = so_far
        so_far += row["n"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<bigint>" * with_ids
    return blocks.mapInArrow(_decode(lengths, offsets, max_bits, step, with_ids), schema)


def new_path(spark: SparkSession) -> str:
    """A folder of its own below the shared one."""
    import uuid

    return f"{checkpoint_dir(spark)}/token-file-{uuid.uuid4().hex}"
