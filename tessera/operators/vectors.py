"""Nearest vectors of many queries: the queries go to the vectors, block by block, and only the best ids come back."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.rank import first_of

#: Bytes of query vectors that one broadcast holds.
BLOCK_BYTES = 32 << 20
#: Vectors that a task compares with a block at once.
ROWS = 1024

_SCORED = "query_id long, vec_id long, similarity double"


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, length, out=np.full_like(x, np.nan), where=length > 0)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64).reshape(len(column), -1)


def nearest(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k most similar rows (by cosine, then the least id) of each query: query_id, vec_id, similarity.

    rows: vec_id, grp, vector; queries: query_id, grp, vector. A query meets the rows of its group (null: of none) except
    one of its own id. Queries are read once and broadcast in blocks of at most BLOCK_BYTES; each task keeps the k best of
    each query as it goes over its vectors, so the vectors are never shuffled, and what is shuffled are k ids for each
    query and task. Null vectors and those of length 0 are left out.
    """
    spark = rows.sparkSession
    found = None
    for block in _blocks(queries):
        shared = spark.sparkContext.broadcast(block)
        part = rows.filter("vector IS NOT NULL AND grp IS NOT NULL").select("vec_id", F.col("grp").cast("string").alias("grp"), "vector").mapInArrow(_best(shared, k), _SCORED)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], _SCORED)
    return first_of(found, ["query_id"], [F.col("similarity").desc(), F.col("vec_id")], k)


def _blocks(queries: DataFrame):
    """Queries as (ids, groups, unit vectors), so many at a time as a broadcast may hold; read partition by partition."""
    held, size = [], 0
    rows = queries.filter("vector IS NOT NULL AND grp IS NOT NULL").select("query_id", F.col("grp").cast("string").alias("grp"), "vector")
    for r in rows.toLocalIterator(prefetchPartitions=True):
        held.append(r)
        size += 8 * len(r["vector"])
        if size >= BLOCK_BYTES:
            yield _block(held)
            held, size = [], 0
    if held:
        yield _block(held)


def _block(held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, groups = np.array([r["query_id"] for r in held], np.int64), np.array([r["grp"] for r in held])
    return ids, groups, _unit(np.array([r["vector"] for r in held], np.float64).reshape(len(held), -1))


def _best(shared, k: int):
    def run(source):
        ids, groups, vectors = shared.value
        own = {g: np.flatnonzero(groups == g) for g in np.unique(groups)}
        score = np.full((len(ids), k), -np.inf)
        found = np.zeros((len(ids), k), np.int64)
        for batch in source:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                vec_ids, kind, x = part.column(0).to_numpy(), np.array(part.column(1).to_pylist()), _unit(_matrix(part.column(2)))
                for g in np.unique(kind):
                    of, at = own.get(g), np.flatnonzero(kind == g)
                    if of is None:
                        continue
                    new = np.round(vectors[of] @ x[at].T, 9)
                    new[(ids[of][:, None] == vec_ids[at]) | np.isnan(new)] = -np.inf
                    both = np.concatenate([score[of], new], axis=1)
                    names = np.concatenate([found[of], np.broadcast_to(vec_ids[at], new.shape)], axis=1)
                    order = np.lexsort((names, -both), axis=1)[:, :k]
                    score[of], found[of] = np.take_along_axis(both, order, 1), np.take_along_axis(names, order, 1)
        row, place = np.nonzero(score > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(found[row, place]), pa.array(score[row, place])], names=["query_id", "vec_id", "similarity"])

    return run
