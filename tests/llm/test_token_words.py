"""Token counts of words that any polynomial hash modulo 2**64 takes for equal."""

import json

import numpy as np
import pytest
import tokenizers

from ledgerlake.llm import token_count


def complement_words(letters, length):
    """Two words of two letters by repeated complement (Thue-Morse), the second with the letters swapped."""
    bits = [0]
    while len(bits) < length:
        bits += [1 - b for b in bits]
    return ["".join(letters[b ^ flip] for b in bits[:length]) for flip in (0, 1)]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    return tokenizers.Tokenizer.from_file(str(public_tokenizers.path(token_count.TOKENIZER)))


def test_words_with_equal_hashes(library):
    texts = []
    for letters in ("er", "ab", "th", "on", "st", "in", "le", "nd"):
        one, other = complement_words(letters, 2048)
        texts += [one, other, f"{one} {other} {one}", f"{one} and {other}"]
    counter = token_count.TokenCounter(json.loads(token_count.tokenizer_file()))
    assert counter.counts(texts).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_unlike_compares_every_byte():
    data = np.frombuffer(b"abcabdabcab", np.uint8)
    begin, stop = np.array([0, 3, 6, 9]), np.array([3, 6, 9, 11])
    assert token_count.unlike(data, begin, stop, np.array([0, 0, 0, 0])).tolist() == [False, True, False, True]
    assert token_count.unlike(data, begin, stop, np.arange(4)).tolist() == [False] * 4


def test_comparison_in_slices(library, monkeypatch):
    monkeypatch.setattr(token_count, "SLICE", 64)
    monkeypatch.setattr(token_count, "REMEMBERED", 3)
    texts = ["the quick brown fox " * 30, "été " * 50 + "the fox", ""]
    counter = token_count.TokenCounter(json.loads(token_count.tokenizer_file()))
    assert counter.counts(texts).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_text_of_megabytes(spark, library):
    text = "it's a long text, été 123 \n\n " * 100_000
    got = token_count.count_tokens(spark.createDataFrame([(1, text), (2, None)], "doc_id bigint, text string"), token_count.tokenizer_file()).collect()
    assert sorted(map(tuple, got)) == [(1, len(text.encode()), len(library.encode(text, add_special_tokens=False).ids)), (2, 0, 0)]
