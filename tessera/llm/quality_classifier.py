"""Quality classifier: a support vector machine on n-gram indicators scaled by naive Bayes log-count ratios.

Features: indicators of the distinct `NGRAM`-byte sequences of the text with A-Z, a-z and digits kept apart, hashed
to 2^BITS places. For each place r = log of the ratio of its smoothed shares in the two classes; a text's vector
is its indicators times r, scaled to length 1. A linear hinge-loss model (squared norm penalty, class weights that
balance the classes) is fitted by dual coordinate descent.

The fit takes at most `SAMPLE` labelled rows of each class, drawn by a hash of doc_id (the least hashes first)
among those whose text has at most `SAMPLE_TEXT` bytes, so neither driver nor model grows with the input: each drawn doc_id
gives one text (the shortest, then least, of several), and at most 2 * SAMPLE * SAMPLE_TEXT bytes are collected. A class of
longer texts only is learnt from its `SPARE` shortest ones. The model is one vector of 2^BITS numbers. Every row is scored on
its whole text, one by one: score = 1 / (1 + exp(-SHARPNESS * margin)).

Defined results: a null text counts as empty and is scored by the bias alone, as are texts shorter than NGRAM bytes.
Rows with a null doc_id are scored and not learnt from (held_out is false). Labels that are null or of doc_ids
absent from the documents are ignored; of several labels of a doc_id the least counts. With no labelled rows, or
those of one class only, every score is that class's (0.5 without any). Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import tokens
from tessera.llm.common import stage_table, text_of

NGRAM = 3
BITS = 18
SAMPLE = 3000
#: Bytes of the longest text that is learnt from; every text is scored whole.
SAMPLE_TEXT = 1 << 14
#: Texts that a class without any of that size is learnt from, the shortest first.
SPARE = 16
PENALTY = 1.0
EPOCHS = 30
SHARPNESS = 2.0


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether a row belongs to the fold that is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _features(texts, ngram: int = NGRAM, bits: int = BITS):
    """The sorted distinct feature places of each text."""
    data, offsets = tokens.buffers(texts)
    code = np.zeros(max(0, len(data) - ngram + 1), np.uint32)
    for k in range(ngram):
        code = (code << np.uint32(8)) | data[k : k + len(code)]
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - bits)
    seen = np.zeros(1 << bits, bool)
    for a, z in zip(offsets, offsets[1:]):
        own = code[a : max(a, z - ngram + 1)]
        if len(own) > 1 << 12:
            seen[own] = True
            places = np.flatnonzero(seen)
            seen[places] = False
            yield places
        else:
            yield np.unique(own)


class Model:
    """Weights by feature place (r and the hyperplane in one, and r alone for the length) and a bias."""

    def __init__(self, weights: np.ndarray, ratio: np.ndarray, bias: float):
        self.weights, self.square, self.bias = weights, ratio * ratio, bias

    def margins(self, texts) -> np.ndarray:
        out = []
        for f in _features(texts):
            length = np.sqrt(self.square[f].sum())
            out.append(self.bias + (self.weights[f].sum() / length if length else 0.0))
        return np.array(out, np.float64)


def fit(texts, labels: np.ndarray, penalty: float = PENALTY, epochs: int = EPOCHS, bits: int = BITS, seed: int = 7) -> Model:
    """The model of labelled texts (labels 0 and 1), by dual coordinate descent in a seeded order."""
    flat = np.zeros(1 << bits)
    if len(labels) == 0 or labels.min() == labels.max():
        return Model(flat, flat, 0.0 if len(labels) == 0 else 50.0 * (2 * labels[0] - 1))
    rows = list(_features(texts, bits=bits))
    counts = np.ones((2, 1 << bits))
    for f, y in zip(rows, labels):
        counts[y, f] += 1
    share = counts / counts.sum(1, keepdims=True)
    ratio = np.log(share[1] / share[0])
    x = [ratio[f] for f in rows]
    x = [v / (np.sqrt((v * v).sum()) or 1.0) for v in x]
    y = np.where(labels == 1, 1.0, -1.0)
    # The bias is the weight of a feature that every row has. Each class gets the same total upper bound.
    upper = penalty * len(y) / (2.0 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    norm = np.array([(v * v).sum() + 1.0 for v in x])
    alpha, w, bias = np.zeros(len(y)), np.zeros(1 << bits), 0.0
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(y)):
            f, v = rows[i], x[i]
            slope = y[i] * (w[f] @ v + bias) - 1.0
            new = min(max(alpha[i] - slope / norm[i], 0.0), upper[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[f] += step * v
                bias += step
                alpha[i] = new
                worst = max(worst, abs(step))
        if worst < 1e-3:
            break
    return Model(w * ratio, ratio, bias)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, **options) -> Model:
    """Fits on at most `sample` labelled rows of each class outside the held-out fold, drawn among texts of at most
    SAMPLE_TEXT bytes; of a class without any, on its SPARE shortest ones."""
    known = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
        .withColumn("draw", F.xxhash64("doc_id"))
    )
    size = F.octet_length(text_of()).alias("size")
    sized = stage_table(docs.select("doc_id", size).groupBy("doc_id").agg(F.min("size").alias("size")).join(known, "doc_id"))
    drawn = None
    for y in (0, 1):
        own = sized.filter(F.col("y") == y)
        part = own.filter(F.col("size") <= SAMPLE_TEXT).orderBy("draw", "doc_id").limit(sample)
        if part.isEmpty():
            part = own.orderBy("size", "draw", "doc_id").limit(SPARE)
        drawn = part if drawn is None else drawn.unionByName(part)
    rows = (
        docs.select("doc_id", text_of().alias("text"))
        .withColumn("size", F.octet_length("text"))
        .join(F.broadcast(drawn), ["doc_id", "size"])
        .groupBy("doc_id", "draw", "y")
        .agg(F.min("text").alias("text"))
        .orderBy("draw", "doc_id", "text")
        .select("text", "y")
        .toArrow()
    )
    return fit(rows.column("text"), rows.column("y").to_numpy().astype(np.int64), **options)


def score(docs: DataFrame, model: Model, sharpness: float = SHARPNESS) -> DataFrame:
    """Each row's doc_id, held_out, score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(source):
        m = shared.value
        for batch in source:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                s = 1.0 / (1.0 + np.exp(-np.clip(sharpness * m.margins(part.column(2)), -500, 500)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
