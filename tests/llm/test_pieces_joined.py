"""Words encoded some at a time have the ids they have alone, and the words
that a task forgets are the rare ones."""

import numpy as np
import pytest

from matchday.llm import op03_pieces as P


@pytest.fixture(scope="module")
def codec():
    with open(P.MODEL, "rb") as f:
        return P.Codec(f.read())


WORDS = ["cat", "Straße", "x1", "日本", "\U0001f600", "a\u0301", "\x00", "don't", "--", "1.5", "e\tf", "\u200b", "ж", "ﬁ"]


def test_joined_words_have_the_ids_of_each_alone(codec):
    words = [P.MARK + a + b for a in WORDS for b in WORDS]
    alone = [e.ids for e in codec.tok.encode_batch_fast(words, add_special_tokens=False)]
    assert codec.joins
    flat, size = codec._encode_words(words, True)
    assert flat.tolist() == sum(alone, []) and size.tolist() == [len(x) for x in alone]


def test_frequent_words_are_kept(codec, monkeypatch):
    monkeypatch.setattr(P, "REMEMBER", 40)
    codec._forget()
    codec.encode(["the same words " * 5])
    texts = [f"the same words and n{i}q  two" for i in range(50)]
    first = [x.tolist() for x in codec.encode(texts)[0]]
    codec._learn({P.MARK + "new"})
    assert P.MARK + "same" in codec.place and P.MARK + "n7q" not in codec.place
    again, agreed, whole = codec.encode(texts)
    assert [x.tolist() for x in again] == first and all(agreed) and all(whole)
    assert len(codec.start) == len(codec.place) + 1 == len(codec.agreed) + 1 == len(codec.uses) + 1
    assert np.diff(codec.start).min() > 0
