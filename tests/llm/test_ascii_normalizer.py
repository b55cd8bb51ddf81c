import json

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tickloom.llm.chunks import ascii_normalizer, token_encoder

PIECES = [f"{space}{a}{chr(c)}{b}" for space in " \n" for a in ("", "Q", "'", "Don") for c in range(33, 127) for b in ("", "T", "'S", "3.x")]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ascii_pieces_are_normalized_as_by_the_library(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    by_rule = ascii_normalizer(json.loads(tokenizer.to_str())["normalizer"])
    library = tokenizer.normalizer
    assert [by_rule(p) for p in PIECES] == [library.normalize_str(p) if library else p for p in PIECES]


def test_unknown_steps_are_left_to_the_library():
    assert ascii_normalizer({"type": "Replace", "pattern": {"String": "a"}, "content": "b"}) is None
    assert ascii_normalizer({"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "StripAccents"}]}) is None


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_repeated_and_mixed_pieces_give_the_ids_of_whole_texts(name):
    path = public_tokenizers.path(name)
    tokenizer = Tokenizer.from_file(path)
    texts = ["The the THE Ünder under, UNDER, under, don't DON'T\nThe end. The end.", "", "İstanbul ﬁne ﬁne Å Å x́ X́", "a A a A, a! 7 77 \U0001f600 The"]
    lengths, ids = token_encoder(path)(pa.array(texts))
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert lengths.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]


def test_plain_pieces_go_through_the_model_by_word():
    """A word in several cases, with marks and after a line feed, is one word to the model; other letters stay with the library."""
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    encode, asked = token_encoder(path), []
    known = encode.plain.words.encode
    letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
    texts = ["x qwzab Qwzab, QWZAB.\nqwzab! qwzÄb\nQWZäB?", *(f"a {c} {c}, b{c}d. {c}{c}\n{c}́ e{c}̈!" for c in letters)]
    try:
        encode.plain.words.encode = lambda words: asked.extend(words) or known(words)
        lengths, ids = encode(pa.array(texts))
    finally:
        encode.plain.words.encode = known
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert lengths.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]
    assert asked.count("qwzab") == asked.count("qwzäb") == 1 and not {"Qwzab", "QWZAB", "qwzab,"} & set(asked)
