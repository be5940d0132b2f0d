"""The packing query's ids are those of the tokenizer file as loaded, added tokens included."""

from __future__ import annotations

import zlib

import numpy as np

import corpus_pipeline
from harborline.llm import window_packing
from harborline.llm.queries import QUERIES

TEXTS = ["a <|endoftext|> b", "It's <|endoftext|> 's. Ok?\nNo!   z", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n y.",
         "<|endoftext| >", "One. Two.<|endoftext|> Three. Four", None, "", "plain text."]


def test_ids_of_added_tokens(spark, tmp_path):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = [tok.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    assert want[0] == [64, 220, 50256, 275]
    tokens = window_packing.Tokens(P.path("byte_bpe_50k.tiktoken"), P.PATTERN, window_packing.BYTE_BPE_50K_ADDED)
    for t, ids in zip(TEXTS, want):
        assert tokens.ids(t or "") == ids and tokens.lengths[ids].sum() == len((t or "").encode())
    d = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    for got in (QUERIES["op5_window_packing"](spark, str(tmp_path)), corpus_pipeline.packing(spark, d, "")):
        rows = {r.doc_id: r for r in got.collect()}
        for i, ids in enumerate(want):
            assert rows[i].doc_tokens == len(ids) + 1 and rows[i].start == 0
            if rows[i].length == len(ids) + 1:
                assert rows[i].ids_crc32 == zlib.crc32(np.array([*ids, 0], "<u4").tobytes())
