"""Permutation importance: answers per feature without scoring whole copies."""

import numpy as np

from matchday.ml import boost as B
from matchday.ml.explain import right_answers


def _model(rng, width, classes, rounds, depth):
    m = B.Booster([f"f{i}" for i in range(width)], [[float(b) for b in range(8)]] * width, classes, B.BoostParams(depth=depth))
    for _ in range(rounds):
        trees = []
        for _ in range(m.outputs):
            t, at = B.Tree.empty(depth), [0]
            while at:
                n = at.pop()
                if 2 * n + 2 < len(t.feature) and rng.random() < 0.8:
                    t.feature[n], t.cut[n], t.left[n] = rng.integers(width - 1), rng.integers(8), rng.random() < 0.5
                    at += [2 * n + 1, 2 * n + 2]
                else:
                    t.value[n] = rng.normal()
            trees.append(t)
        m.trees.append(trees)
    return m


def _whole_copies(m, x, donor, y):
    x, out = x.copy(), []
    for i in range(len(m.features)):
        own = x[:, i].copy()
        x[:, i] = donor[:, i]
        out.append(int((m.margins(x).argmax(axis=1) == y).sum()))
        x[:, i] = own
    return [*out, int((m.margins(x).argmax(axis=1) == y).sum())]


def test_right_answers_equal_scoring_every_copy(monkeypatch):
    rng = np.random.default_rng(3)
    for classes, rounds in ((5, 4), (2, 1), (3, 0)):
        m = _model(rng, 9, classes, rounds, 3)
        x = rng.integers(0, 9, (700, 9)).astype(np.uint8)
        x[rng.random(x.shape) < 0.1] = B.MISSING
        donor, y = np.roll(x, 311, axis=0), rng.integers(0, classes, 700).astype(float)
        expected = _whole_copies(m, x, donor, y)
        seen = []
        leaf_of = B.Tree.leaf_of
        monkeypatch.setattr(B.Tree, "leaf_of", lambda t, b: (seen.append(len(b)), leaf_of(t, b))[1])
        assert right_answers(m, x, donor, y).tolist() == expected
        monkeypatch.undo()
        # a copy per feature would walk every tree for every row ten times
        assert sum(seen) < 0.75 * 10 * 700 * classes * max(1, rounds)
        assert right_answers(m, x[:0], donor[:0], y[:0]).tolist() == [0] * 10
