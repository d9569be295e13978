import random
import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import token_file as T

PATH = public_tokenizers.path("byte_bpe_50k.json")

TEXTS = [
    "",
    None,
    " lead and trail ",
    "two  spaces\n\nand\n lines \t tabs",
    "don't I'll they've 's 123 456a b7",
    "Éré çà ñandú ß über; 'quoted', (x) | y | $%&*** token = \"04db\"",
    "日本語 текст ελληνικά 🙂  nbsp  em",
    "<|endoftext|> plain",
    "a" * 3000,
    "x\x1cy \x1fz \x0bq",
]


@cache
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def ids_of(text):
    return library().encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library():
    r = random.Random(5)
    enc = T.Encoder(PATH, remembered=20)
    alphabet = ["the", "of", "Éa", "ñ", "x1", "don't", " ", "  ", "\n", ".", ",", "!!", "***", "'s", "日", "\t", " ", "(", "7"]
    texts = [t or "" for t in TEXTS] + ["".join(r.choices(alphabet + [" "] * 9, k=r.randrange(60))) for _ in range(400)]
    for text in texts:
        assert np.frombuffer(enc.encode(text), enc.type).tolist() == ids_of(text), text


@pytest.mark.parametrize("limit", [9, 20])
def test_code_lengths_are_a_full_and_best_code(limit):
    import heapq

    r = np.random.default_rng(1)
    counts = (r.pareto(0.7, 300) * 3).astype(np.int64)
    lengths = T.code_lengths(counts, limit).astype(int)
    assert ((lengths > 0) == (counts > 0)).all() and lengths.max() <= limit
    assert sum(2.0 ** -x for x in lengths if x) == 1
    if limit == 20:
        heap = [(c, 0) for c in counts.tolist() if c]
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap)[0], heapq.heappop(heap)[0]
            cost += a + b
            heapq.heappush(heap, (a + b, 0))
        assert (lengths * counts).sum() == cost


def test_round_trip_through_files(spark):
    rows = [(i * 13 % 101 if i else None, TEXTS[i % len(TEXTS)], "x") for i in range(101)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)
    path = T.new_path(spark)
    T.write(df, path, PATH, block_ids=500)
    got = T.read(spark, path).collect()
    got.sort(key=lambda r: r.start)
    rows.sort(key=lambda r: (r[0] is not None, r[0]))
    start = 0
    assert [r.doc_id for r in got] == [r[0] for r in rows]
    for r, (_, text, _) in zip(got, rows):
        ids = ids_of(text) + [2]
        assert (r.start, r.n_tokens, r.ids) == (start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_empty_table(spark):
    path = T.new_path(spark)
    T.write(spark.createDataFrame([], "doc_id long, text string"), path, PATH)
    assert T.read(spark, path).count() == 0
