"""N-gram Jaccard join of documents, size-aware and heavy-light.

Sets. A document is the set of its distinct word shingles, 64-bit digests made of the 128-bit digests of its words.
Equal sets form a class, named by a 128-bit digest of the whole set; all later work is on classes, so copies cost one
row each and no pairs.

Small sets. Two sets of sizes n and m link when they share at least need(n, m) shingles. A set no larger than
the boundary lists all its subsets of each such fixed size; two sets that list the same subset of a size that is
enough for them are linked, without looking at the sets. Sets just above the boundary list the subset sizes that a
partner below it can need.

Large sets. Shingles are ordered by hash, the most frequent `HEAVY` ones last; a set enters the inverted lists of
its first n - ceil(n * share) + 1 shingles, of which linked sets share one. Any order is exact; the bounded heavy
list only keeps common shingles out of the lists.

Boundary. The size up to which listing subsets costs less than scanning lists, from the histogram of sizes.

Lists. A task sends each class once. In lists longer than `LONG_LIST`, rounds of stars come first: all members are
tested against one, the member that most long lists hold, which is the same one for all lists of a group of near
copies; links contract classes to components, tested members leave their lists, and lists within one component are
done. Every pair of members of the lists that remain, that can link by size and place and is not in one component,
is then a candidate: of short lists by a join, of long ones block by block, where sketches rule pairs out before they
are written. Pairs inside a component are not needed for the components, so no link between different texts is lost.

Verifying. A pair is first tested by sketches: counts of shingles by hash range bound the overlap from above, so no
link is lost. The whole sets of the classes that remain are made from their texts, and decide. Their ids are
broadcast up to a checked number of rows; more are joined by a shuffle of the texts.

Memory: a task holds one Arrow batch of texts, one hash bucket of postings (about `BUCKET_POSTINGS`), or two blocks of
a list.

Defined results: null and blank texts have no shingles, link with nothing and are their own component. A null
doc_id counts as larger than any other; a component of null doc_ids only has a null id. Repeated rows are
classified alike. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from hashlib import blake2b
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import tokens
from tessera.llm.cache import begin, trim
from tessera.llm.common import if_few, stage_table
from tessera.llm.components import components

WIDTH = 4
PERCENT = 85
#: Shingles that go last in the order: at most so many (8 bytes each go to every task).
HEAVY = 1 << 16
#: Documents of one task that must hold a shingle for it to be counted as frequent.
HEAVY_FROM = 5
#: Cost of scanning one posting, in subsets listed.
SCAN_COST = 8
#: No set larger than this lists its subsets, whatever the cost model says.
MOST_SMALL = 24
LONG_LIST = 32
#: Rounds of stars before pairs are taken.
STAR_ROUNDS = 2
#: Members of a long list that one task compares with as many others.
BLOCK = 1024
BUCKET_POSTINGS = 1 << 20
#: Shingles that a task gathers before it counts them; half as many postings before it packs them.
BUFFERED = 800_000
#: Stands for a null doc_id in joins.
NO_ID = -(1 << 63)


def need(n, m, percent: int = PERCENT):
    """The overlap from which sets of sizes n and m link."""
    return -(-percent * (n + m) // (100 + percent))


def shingle_sets(texts, width: int = WIDTH):
    """The sorted distinct shingles of each text, as an iterator of uint64 arrays; words are lower-cased A-Z."""
    lanes, at = tokens.words(texts, lower=True)
    runs = tokens.shingles(lanes, width)
    for a, z in zip(at.tolist(), at[1:].tolist()):
        if z - a >= width:
            yield np.unique(runs[a : z - width + 1])
        else:
            yield tokens.shingles(lanes[a:z], z - a) if z > a else np.zeros(0, np.uint64)


def signature(s: np.ndarray) -> bytes:
    """A 128-bit digest of a set."""
    return blake2b(s.tobytes(), digest_size=16).digest()


def sketch(s: np.ndarray) -> bytes | None:
    """Counts of shingles in about n / 2 equal hash ranges; None where a count exceeds a byte."""
    if len(s) < 16:
        return None
    counts = np.bincount((s >> np.uint64(64 - (len(s).bit_length() - 2))).astype(np.int64), minlength=1 << (len(s).bit_length() - 2))
    return None if counts.max() > 255 else counts.astype(np.uint8).tobytes()


def overlap_bound(x: bytes, y: bytes) -> int:
    """No two sets of these sketches share more shingles than this."""
    a, b = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    return int(np.minimum(short, long.reshape(len(short), -1).sum(1)).sum())


def subset_sizes(n: int, boundary: int, percent: int = PERCENT) -> list[int]:
    """Sizes of the subsets that a set of size n lists: those that partners of which one is small can need."""
    most = n * 100 // percent if n <= boundary else boundary
    return sorted({need(n, m, percent) for m in range(-(-n * percent // 100), most + 1) if min(n, m) <= boundary})


def choose_boundary(histogram: dict[int, int], percent: int = PERCENT) -> int:
    """The boundary of the least total cost; `histogram` has the number of classes by size, up to MOST_SMALL."""
    best, cost, least = 0, 0, 0
    for n in range(1, MOST_SMALL + 1):
        listing = sum(comb(n, n - s) for s in subset_sizes(n, n, percent))
        scanning = (n - (-(-n * percent // 100)) + 1) * SCAN_COST
        cost += histogram.get(n, 0) * (listing - scanning)
        if cost <= least and listing <= 4 * scanning:
            best, least = n, cost
    return best


def _subsets(s: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all subsets of `size` elements: the set's sum less the sums of what is left out."""
    from itertools import combinations

    mixed = tokens.mix(s ^ np.uint64(0x1234567))
    out = np.array(list(combinations(range(len(s)), len(s) - size)), np.int64).reshape(comb(len(s), size), -1)
    return tokens.mix(mixed.sum() - mixed[out].sum(1, dtype=np.uint64) + np.uint64(size))


_POSTING = np.dtype([("key", "<u8"), ("hi", "<u8"), ("lo", "<u8"), ("n", "<i4"), ("pos", "<i4")])


def _made(key, sig: bytes, n: int, pos) -> np.ndarray:
    out = np.empty(len(key), _POSTING)
    out["key"], out["n"], out["pos"] = key, n, pos
    out["hi"], out["lo"] = np.frombuffer(sig, "<u8")
    return out


def _sigs(rows: np.ndarray) -> pa.Array:
    """The signatures of postings."""
    both = np.stack([rows["hi"], rows["lo"]], axis=1)
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(rows), [None, pa.py_buffer(both.tobytes())])
    return fixed.cast(pa.binary())


def _ordered(rows: np.ndarray, *fields: str) -> np.ndarray:
    """Distinct postings in the order of `fields`."""
    rows = rows[np.lexsort([rows[f] for f in reversed(fields)])]
    keep = np.ones(len(rows), bool)
    keep[1:] = rows[1:] != rows[:-1]
    return rows[keep]


_MEASURED = "doc_id long, text_key long, sig binary, n long, sketch binary, shingle long, heavy long"


def _measure(percent: int, width: int):
    """Rows of documents (doc_id, text_key, sig, n, sketch) and of frequent shingles of the task (shingle, heavy)."""
    kinds = pa.schema(
        {"doc_id": pa.int64(), "text_key": pa.int64(), "sig": pa.binary(), "n": pa.int64()}
        | {"sketch": pa.binary(), "shingle": pa.int64(), "heavy": pa.int64()}
    )

    def row_batch(size: int, **columns) -> pa.RecordBatch:
        arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in kinds]
        return pa.RecordBatch.from_arrays(arrays, schema=kinds)

    def run(source):
        begin("words", tokens.forget)
        seen: dict[int, int] = {}
        parts, held = [], 0

        def frequent():
            nonlocal parts, held
            if parts:
                u, c = np.unique(np.concatenate(parts), return_counts=True)
                keep = c >= HEAVY_FROM
                for k, v in zip(u[keep].view(np.int64).tolist(), c[keep].tolist()):
                    seen[k] = seen.get(k, 0) + v
            parts, held = [], 0

        sigs = set()
        for batch in tokens.slices(source, 2, size=1 << 23):
            sig, n, sketches = [], [], []
            for s in shingle_sets(batch.column(2), width):
                sig.append(signature(s))
                n.append(len(s))
                sketches.append(None)
                if len(s) and sig[-1] not in sigs:
                    sigs.add(sig[-1])
                    sketches[-1] = sketch(s)
                    parts.append(s)
                    held += len(s)
            if held > BUFFERED:
                frequent()
            yield row_batch(len(n), doc_id=batch.column(0), text_key=batch.column(1), sig=sig, n=n, sketch=sketches)
        frequent()
        if seen:
            yield row_batch(len(seen), shingle=list(seen.keys()), heavy=list(seen.values()))
        parts = []
        trim()

    return run


def _postings(heavy: np.ndarray, rank: np.ndarray, boundary: int, buckets: int, percent: int, width: int):
    """Postings and subset keys of a task's classes, packed by hash bucket. pos < 0: a subset of -pos elements."""

    def of(s: np.ndarray, sig: bytes) -> list[np.ndarray]:
        n, out = len(s), []
        if n <= boundary * 100 // percent:
            for size in subset_sizes(n, boundary, percent):
                out.append(_made(_subsets(s, size), sig, n, -size))
        if n > boundary:
            p = n - (-(-n * percent // 100)) + 1
            if len(heavy):
                at = np.minimum(np.searchsorted(heavy, s), len(heavy) - 1)
                order = np.lexsort((s, np.where(heavy[at] == s, rank[at], 0)))[:p]
            else:
                order = np.arange(p)
            out.append(_made(s[order], sig, n, np.arange(p)))
        return out

    def packed(rows: list[np.ndarray]):
        all_rows = np.concatenate(rows)
        bucket = (all_rows["key"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        at = np.searchsorted(bucket[order], np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(at))
        data = all_rows[order]
        return pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int64()), pa.array([data[at[b] : at[b + 1]].tobytes() for b in full], pa.binary())],
            names=["bucket", "postings"],
        )

    def run(source):
        begin("words", tokens.forget)
        sigs, rows, held = set(), [], 0
        for batch in tokens.slices(source, 0, size=1 << 23):
            for s in shingle_sets(batch.column(0), width):
                sig = signature(s)
                if len(s) and sig not in sigs:
                    sigs.add(sig)
                    new = of(s, sig)
                    rows += new
                    held += sum(map(len, new))
            if held > BUFFERED // 2:
                yield packed(rows)
                rows, held = [], 0
        if rows:
            yield packed(rows)
        rows = []
        trim()

    return run


_LIVE = "key long, other binary, sig binary, n int, pos int"


def _lists(percent: int):
    """Of one bucket: links from equal subsets (sig and other), and postings that have a partner of a fitting size."""

    def run(table: pa.Table) -> pa.Table:
        # A class that several tasks sent counts once.
        rows = np.concatenate([np.frombuffer(x, _POSTING) for x in table.column("postings").to_pylist()])
        small = _ordered(rows[rows["pos"] < 0], "key", "pos", "n", "hi", "lo")
        first = np.ones(len(small), bool)
        first[1:] = (small["key"][1:] != small["key"][:-1]) | (small["pos"][1:] != small["pos"][:-1])
        head = small[np.maximum.accumulate(np.where(first, np.arange(len(small)), 0))]
        ok = ~first & (need(head["n"].astype(np.int64), small["n"].astype(np.int64), percent) <= -small["pos"])
        large = _ordered(rows[rows["pos"] >= 0], "key", "n", "hi", "lo", "pos")
        fits = (large["key"][1:] == large["key"][:-1]) & (
            100 * large["n"][:-1].astype(np.int64) >= percent * large["n"][1:].astype(np.int64)
        )
        live = np.zeros(len(large), bool)
        live[1:] |= fits
        live[:-1] |= fits
        large = large[live]
        out = np.concatenate([small[ok], large])
        trim()
        none = pa.nulls(len(large), pa.binary())
        return pa.table(
            {
                "key": pa.array(out["key"].view(np.int64), pa.int64()),
                "other": pa.concat_arrays([_sigs(head[ok]), none]),
                "sig": _sigs(out),
                "n": pa.array(out["n"], pa.int32()),
                "pos": pa.array(out["pos"], pa.int32()),
            }
        )

    return run


def _folded(sketches: list[bytes | None], bins: int) -> np.ndarray:
    return np.array([np.frombuffer(x, np.uint8).reshape(bins, -1).sum(1, dtype=np.int32) for x in sketches]).reshape(-1, bins)


def _blocks(percent: int, bins: int = 64):
    """Of two blocks of one list (one, if equal): pairs from different components that can link by size, place and sketch."""

    def run(table: pa.Table) -> pa.Table:
        rows = {c: np.array(table.column(c).to_pylist(), np.int64) for c in ("n", "pos", "side")}
        n, place, side = rows["n"], rows["pos"], rows["side"]
        sig, sketches = (table.column(c).to_pylist() for c in ("sig", "sketch"))
        part = np.unique(np.array(table.column("component").to_pylist(), "V16").view("S16"), return_inverse=True)[1]
        width = np.array([0 if x is None else min(len(x), bins) for x in sketches])
        one = bool((side == 0).all())
        left, right = np.flatnonzero(side == 0), np.arange(len(n)) if one else np.flatnonzero(side == 1)
        a, b = [], []
        for wx in np.unique(width[left]).tolist():
            for wy in np.unique(width[right]).tolist():
                x, y = left[width[left] == wx], right[width[right] == wy]
                at = min(wx, wy)
                if at:
                    sx, sy = (_folded([sketches[i] for i in z.tolist()], at) for z in (x, y))
                for k, i in enumerate(x.tolist()):
                    ok = (part[y] != part[i]) & (100 * np.minimum(n[i], n[y]) >= percent * np.maximum(n[i], n[y]))
                    ok &= (100 + percent) * np.minimum(n[i] - place[i], n[y] - place[y]) >= percent * (n[i] + n[y])
                    if one:
                        ok &= y > i
                    hit = np.flatnonzero(ok)
                    if at and len(hit):
                        bound = np.minimum(sx[k], sy[hit]).sum(1)
                        hit = hit[bound >= need(n[i], n[y[hit]], percent)]
                    a += [sig[i]] * len(hit)
                    b += [sig[j] for j in y[hit].tolist()]
        return pa.table({"a": pa.array(list(map(min, a, b)), pa.binary()), "b": pa.array(list(map(max, a, b)), pa.binary())})

    return run


def _sets(width: int):
    def run(source):
        begin("words", tokens.forget)
        for batch in tokens.slices(source, 0, size=1 << 23):
            sets = list(shingle_sets(batch.column(0), width))
            yield pa.RecordBatch.from_arrays(
                [pa.array([signature(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["sig", "shingles"],
            )

    return run


def _possible(percent: int):
    """Pairs whose sketches (where both have one) leave room for a link."""

    def run(source):
        for batch in source:
            a, b, n, m, x, y = (batch.column(i).to_pylist() for i in range(6))
            kept = [
                i
                for i in range(len(a))
                if x[i] is None or y[i] is None or overlap_bound(x[i], y[i]) >= need(n[i], m[i], percent)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in kept], pa.binary()), pa.array([b[i] for i in kept], pa.binary())], names=["a", "b"]
            )

    return run


def _verify(percent: int):
    def run(source):
        for batch in source:
            a, b, x, y = (batch.column(i).to_pylist() for i in range(4))
            keep = []
            for p, q in zip(x, y):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                common = int((q[at] == p).sum())
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            kept = [i for i, k in enumerate(keep) if k]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in kept], pa.binary()), pa.array([b[i] for i in kept], pa.binary())], names=["a", "b"]
            )

    return run


def _can_link(percent: int, x: str, y: str) -> str:
    """SQL condition on two postings of one list: sizes fit, and the shingles after the common one can suffice."""
    return (
        f"100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n) AND "
        f"{100 + percent} * least({x}.n - {x}.pos, {y}.n - {y}.pos) >= {percent} * ({x}.n + {y}.n)"
    )


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def link_classes(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, text_key, sig, n), classes (sig, n, cid), and links of classes (a, b) that connect each component."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    measured = stage_table(
        docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(_measure(percent, width), _MEASURED)
    )
    of_docs = measured.filter("heavy IS NULL")
    rows = of_docs.select("doc_id", "text_key", "sig", "n")
    # At most HEAVY shingles and MOST_SMALL counts reach the driver.
    top = (
        measured.filter("heavy IS NOT NULL")
        .groupBy("shingle")
        .agg(F.sum("heavy").alias("c"))
        .orderBy(F.desc("c"), "shingle")
        .limit(HEAVY)
        .toPandas()
    )
    shingles = top["shingle"].to_numpy(np.int64).view(np.uint64)
    by_token = np.argsort(shingles)
    heavy = shingles[by_token]
    rank = (len(top) - by_token).astype(np.int64)  # the most frequent one last
    classes = rows.filter("n > 0").groupBy("sig", "n").agg(F.min("doc_id").alias("cid"))
    sizes = {r["n"]: r["c"] for r in classes.filter(f"n <= {MOST_SMALL}").groupBy("n").agg(F.count("*").alias("c")).collect()}
    boundary = choose_boundary(sizes, percent)
    total = rows.agg(F.sum("n")).first()[0] or 0
    buckets = max(8, int(total * (100 - percent) / 100) // BUCKET_POSTINGS + 1)
    spread = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    buckets = max(buckets, 2 * int(spread))
    live = stage_table(
        docs.select("text")
        .mapInArrow(_postings(heavy, rank, boundary, buckets, percent, width), "bucket long, postings binary")
        .groupBy("bucket")
        .applyInArrow(_lists(percent), _LIVE)
    )
    small = live.filter("other IS NOT NULL").select(F.col("other").alias("a"), F.col("sig").alias("b")).distinct()
    postings = live.filter("other IS NULL").drop("other")
    sketches = of_docs.filter("n > 0").groupBy("sig").agg(F.min("n").alias("n"), F.min("sketch").alias("sketch"))

    def side(name: str, value: str) -> DataFrame:
        return sketches.select(F.col("sig").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(value))

    def verified(pairs: DataFrame) -> DataFrame:
        possible = stage_table(
            pairs.join(side("a", "x"), "a")
            .join(side("b", "y"), "b")
            .select("a", "b", "n_a", "n_b", "x", "y")
            .mapInArrow(_possible(percent), "a binary, b binary")
        )
        sigs = possible.select(F.col("a").alias("sig")).unionByName(possible.select(F.col("b").alias("sig"))).distinct()
        uids = stage_table(sigs.join(classes, "sig").select(F.coalesce("cid", F.lit(NO_ID)).alias("uid")).distinct())
        sets = stage_table(
            docs.withColumn("uid", F.coalesce("doc_id", F.lit(NO_ID)))
            .join(if_few(uids), "uid", "left_semi")
            .select("text")
            .mapInArrow(_sets(width), "sig binary, shingles binary")
            .groupBy("sig")
            .agg(F.first("shingles").alias("shingles"))
        )
        x = sets.select(F.col("sig").alias("a"), F.col("shingles").alias("x"))
        y = sets.select(F.col("sig").alias("b"), F.col("shingles").alias("y"))
        pairs = possible.join(x, "a").join(y, "b").select("a", "b", "x", "y")
        return pairs.mapInArrow(_verify(percent), "a binary, b binary")

    def open_lists(links: DataFrame) -> DataFrame:
        """Postings of the lists that hold several components, with component and length of list."""
        labels = if_few(components(links).select(F.col("node").alias("sig"), "component"))
        labelled = postings.join(labels, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
        state = labelled.groupBy("key").agg(
            F.count("*").alias("length"), F.min("component").alias("lo"), F.max("component").alias("hi")
        )
        return stage_table(labelled.join(state.filter("lo <> hi").select("key", "length"), "key"))

    links = stage_table(small)
    for _ in range(STAR_ROUNDS):
        long = open_lists(links).filter(f"length > {LONG_LIST}")
        if long.isEmpty():
            break
        held = long.groupBy("sig").agg(F.count("*").alias("lists"))
        central = F.max(F.struct("lists", "sig", "n", "pos", "component")).alias("y")
        stars = stage_table(long.join(held, "sig").groupBy("key").agg(central))
        pairs = (
            long.alias("x")
            .join(stars, "key")
            .filter(f"x.component <> y.component AND {_can_link(percent, 'x', 'y')}")
            .select(*_pair("x.sig", "y.sig"))
            .distinct()
        )
        links = stage_table(links.unionByName(verified(pairs)))
        postings = stage_table(postings.join(stars.select("key", "y.sig"), ["key", "sig"], "left_anti"))
    rest = open_lists(links)
    short = rest.filter(f"length <= {LONG_LIST}")
    apart = f"x.key = y.key AND x.sig < y.sig AND x.component <> y.component AND {_can_link(percent, 'x', 'y')}"
    pairs = short.alias("x").join(short.alias("y"), F.expr(apart)).select(*_pair("x.sig", "y.sig"))
    blocks = F.ceil(F.col("length") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("sig"), blocks).cast("int")
    dealt = (
        rest.filter(f"length > {LONG_LIST}")
        .join(sketches.select("sig", "sketch"), "sig")
        .select("key", "sig", "n", "pos", "component", "sketch", block.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("with"))
        .select("*", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), (F.col("own") > F.col("with")).cast("int").alias("side"))
        .drop("own", "with")
    )
    pairs = pairs.unionByName(dealt.groupBy("key", "i", "j").applyInArrow(_blocks(percent), "a binary, b binary")).distinct()
    return rows, classes, stage_table(links.unionByName(verified(pairs)))


def join(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """Each row's component: doc_id, n_shingles, component_id."""
    rows, classes, links = link_classes(docs, percent, width)
    labels = components(links, classes.select(F.col("sig").alias("node"), F.col("cid").alias("value")))
    ids = classes.join(labels.select(F.col("node").alias("sig"), "component", "value"), "sig", "left").select(
        "sig", F.when(F.col("component").isNull(), F.col("cid")).otherwise(F.col("value")).alias("component_id")
    )
    n = F.col("n").alias("n_shingles")
    blank = rows.filter("n = 0").select("doc_id", n, F.col("doc_id").alias("component_id"))
    return rows.filter("n > 0").join(ids, "sig").select("doc_id", n, "component_id").unionByName(blank)


def keep_rows(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """One row of each component, with all columns of `docs`: a row with its least doc_id (null last).

    Of several rows with that doc_id, texts decide by hash, and then the whole rows. Rows without words all stay.
    """
    rows, _, links = link_classes(docs, percent, width)
    labels = components(links).select(F.col("node").alias("sig"), "component")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("least")
    stay = stage_table(
        rows.filter("n > 0")
        .join(labels, "sig", "left")
        .groupBy(F.coalesce("component", "sig").alias("component"))
        .agg(least)
        .select(F.coalesce("least.doc_id", F.lit(NO_ID)).alias("uid"), "least.text_key")
        .distinct()
    )
    counts = rows.filter("n > 0").groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("uid"), "text_key").agg(F.count("*").alias("c"))
    several = stage_table(counts.filter("c > 1").drop("c").join(stay, ["uid", "text_key"], "left_semi"))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("uid"),
        F.xxhash64("text").alias("text_key"),
    )
    key = ["uid", "text_key"]
    blank = ~F.coalesce(F.col("row.text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    words = keyed.filter(~blank)
    kept = keyed.filter(blank).select("row")
    if several.isEmpty():
        kept = kept.unionByName(words.join(if_few(stay), key, "left_semi").select("row"))
    else:
        alone = stage_table(stay.join(several, key, "left_anti"))
        one = F.min_by("row", F.sha2(F.to_json("row"), 256)).alias("row")
        kept = kept.unionByName(words.join(if_few(alone), key, "left_semi").select("row"))
        kept = kept.unionByName(words.join(if_few(several), key, "left_semi").groupBy(*key).agg(one).select("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
