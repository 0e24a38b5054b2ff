"""Words are found in the bytes of all texts of a group and looked up once
each; what a task remembers is bounded by ids, too."""

import re
from collections import Counter

import numpy as np
import pytest

from matchday.llm import op03_pieces as P


@pytest.fixture
def codec():
    with open(P.MODEL, "rb") as f:
        return P.Codec(f.read())


PARTS = ["", " ", "  ", P.MARK, "a", "bc", "é", "日本", "\U0001f600", "▀", "▂", "\u0081", "\t", "\n", "\x00", "<s>", "1.5"]


def _odd_texts(n):
    pick = np.random.default_rng(3)
    return ["", " ", P.MARK] + ["".join(PARTS[i] for i in pick.integers(0, len(PARTS), pick.integers(0, 12))) for _ in range(n)] + [""]


@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("by_word", [True, False])
def test_words_are_those_of_each_text_alone(codec, by_word, prefix):
    codec.by_word, codec.model.dummy_prefix = by_word, prefix
    texts = _odd_texts(400)
    for group in (texts, texts[:1], [], [""] * 3):
        different, which, counts = codec._words(group)
        marked = [codec.normalise(t) for t in group]
        words = [re.findall(f"{P.MARK}*[^{P.MARK}]+|{P.MARK}+", t) if by_word else [t] * bool(t) for t in marked]
        assert [different[i] for i in which] == sum(words, []) and counts.tolist() == [len(w) for w in words]
        assert len(set(different)) == len(different)


def test_odd_texts_have_the_ids_of_the_library(codec):
    texts = _odd_texts(400)
    for _ in range(2):  # learned, and remembered
        ids, agreed, whole = codec.encode(texts)
        assert [x.tolist() for x in ids] == codec.own.encode(texts) and all(agreed)
        assert whole == [P.MARK not in t for t in texts]


def test_a_word_is_looked_up_once_a_group(codec):
    looked = Counter()

    class Known(dict):
        def get(self, word, *other):
            looked[word] += 1
            return super().get(word, *other)

        def __getitem__(self, word):
            looked[word] += 1
            return super().__getitem__(word)

    codec.place = Known(codec.place)
    ids, _, whole = codec.encode(["some words again " * 200] * 3)
    assert all(whole) and len({x.tobytes() for x in ids}) == 1
    assert looked and max(looked.values()) == 1


def test_long_words_are_not_all_remembered(codec, monkeypatch):
    monkeypatch.setattr(P, "REMEMBER", 100)
    texts = [f"the {'xq7' * 300}{i} the" for i in range(60)]
    right = codec.own.encode(texts)
    for _ in range(2):
        for t, want in zip(texts, right, strict=True):
            ids, agreed, whole = codec.encode([t])
            assert ids[0].tolist() == want and agreed == whole == [True]
    # before the last text at most 8 ids a word, and then those of one text
    assert len(codec.ids) <= 100 * 8 + max(map(len, right)) and P.MARK + "the" in codec.place
