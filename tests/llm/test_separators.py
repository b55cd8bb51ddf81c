"""Texts that spell the separator of flat files."""

from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer

from tickloom.llm import queries
from tickloom.llm.token_queries import END_OF_TEXT, tokenizer_file


def test_separator_spelled_in_texts(spark, tmp_path):
    texts = ["plain words", "a <|endoftext|> b", "<|endoftext|>", "", None, "x<|endoftext|><|endoftext|>\n", "last one"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    library = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    ids = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert not any(END_OF_TEXT in i for i in ids) and [library.decode(i) for i in ids] == [t or "" for t in texts]
    found = queries.QUERIES["op3_token_counts"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.n_tokens for r in found} == {k: len(i) for k, i in enumerate(ids)}
    for file in {r.file for r in found}:
        own = sorted((r.ordinal, r.start, r.n_tokens) for r in found if r.file == file)
        assert [s for _, s, _ in own] == list(np.cumsum([0, *[n + 1 for _, _, n in own[:-1]]]))
