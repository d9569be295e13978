"""The pipeline's last stage holds what its documents can be decoded from."""

import zlib

import numpy as np
import public_tokenizers

import corpus_pipeline as C
from tessera.llm import pieces

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_encoded_rows_decode_to_their_texts(spark):
    texts = ["a plain text of some words", "Ein  kurzer Satz.\nZeile zwei", "", "Мир 🙂"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    out = dict(C.STAGES)["SentencePiece encoding"](spark, docs, "").selectExpr("*", "segmentations[0] AS ids")
    model = public_tokenizers.path("piece_bpe_32k.model")
    for r in out.collect():
        assert len(r.ids) == r.n_pieces and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        assert len(r.segmentations) == len(r.scores) == len({tuple(s) for s in r.segmentations})
    assert {r.doc_id: r.text for r in pieces.decode(out, model).collect()} == dict(enumerate(texts))
