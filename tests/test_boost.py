"""Boosting against a plain numpy version, its search and validation."""

import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchday.ml import boost as B


def _data(n=200, classes=3, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    x[:, 3] = rng.integers(0, 3, n)
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(int) + (x[:, 2] > 0.8)
    x[rng.random((n, 4)) < 0.1] = np.nan
    return x, np.minimum(y, classes - 1), rng.choice([1.0, 3.0, 5.0], n)


def _frame(spark, x, y, w, parts=3):
    rows = [
        (i, *[None if math.isnan(v) else float(v) for v in x[i]], float(y[i]), float(w[i]), i % 5) for i in range(len(x))
    ]
    schema = "id long, a double, b double, c double, d double, label double, weight double, fold int"
    return spark.createDataFrame(rows, schema).repartition(parts)


FEATS = ["a", "b", "c", "d"]


def _plain(x, y, w, cuts, classes, p: B.BoostParams):
    """Every split of every node by adding up its rows; no sampling."""
    n, outputs = len(y), max(1, classes)
    z = np.full((n, outputs), 0.5)

    def grow(rows, depth, g, h):
        gs, hs = g[rows].sum() / B.UNIT, h[rows].sum() / B.UNIT
        leaf = -p.rate * gs / (hs + p.l2)
        best = (p.gain, None)
        if depth < p.depth:
            for missing_left in (False, True):
                for f in range(x.shape[1]):
                    for c, cut in enumerate([*cuts[f], math.inf]):
                        v = x[rows, f]
                        left = np.where(np.isnan(v), missing_left, v < cut)
                        gl, hl = g[rows][left].sum() / B.UNIT, h[rows][left].sum() / B.UNIT
                        if hl < p.min_weight or hs - hl < p.min_weight:
                            continue
                        gain = 0.5 * (gl**2 / (hl + p.l2) + (gs - gl) ** 2 / (hs - hl + p.l2) - gs**2 / (hs + p.l2))
                        if gain > best[0] + 1e-12:
                            best = (gain, left)
        if best[1] is None:
            return [(rows, leaf)]
        return grow(rows[best[1]], depth + 1, g, h) + grow(rows[~best[1]], depth + 1, g, h)

    for _ in range(p.rounds):
        if classes:
            e = np.exp(z - z.max(axis=1, keepdims=True))
            prob = e / e.sum(axis=1, keepdims=True)
            g, h = prob - np.eye(classes)[y], 2 * prob * (1 - prob)
        else:
            g, h = z - np.asarray(y, float)[:, None], np.ones_like(z)
        g, h = np.rint(g * w[:, None] * B.UNIT), np.rint(h * w[:, None] * B.UNIT)
        step = np.zeros_like(z)
        for k in range(outputs):
            for rows, value in grow(np.arange(n), 0, g[:, k], h[:, k]):
                step[rows, k] = value
        z = z + step
    return z


PLAIN = B.BoostParams(rounds=4, depth=3, rate=0.3, gain=0.1, l2=0.5, rows=1.0, columns=1.0)


@pytest.mark.parametrize("classes", [3, 0])
def test_equals_plain_version(spark, classes):
    x, y, w = _data()
    y = y if classes else np.round(np.nan_to_num(x[:, 0]) * 2 + y, 3)
    df = _frame(spark, x, y, w)
    cuts = B.quantile_cuts(df, FEATS, 8)
    got = B.fit_booster(df, FEATS, "label", "weight", "id", classes, PLAIN, bins=8)
    out = got.transform(df).orderBy("id").collect()
    z = _plain(x, y, w, cuts, classes, PLAIN)
    if classes:
        want = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
        np.testing.assert_allclose([r["probability"] for r in out], want, atol=1e-9)
        assert [int(r["prediction"]) for r in out] == z.argmax(axis=1).tolist()
    else:
        np.testing.assert_allclose([r["prediction"] for r in out], z[:, 0], atol=1e-9)


def test_partitions_and_snapshots_change_nothing(spark, monkeypatch):
    x, y, w = _data(300, seed=4)
    p = B.BoostParams(rounds=5, depth=3, rate=0.3, rows=0.7, columns=0.5)
    trees = []
    for parts, every, bound in ((1, 8, 64 << 20), (7, 2, 5_000)):
        monkeypatch.setattr(B, "SNAPSHOT", every)
        monkeypatch.setattr(B, "SUMS_BYTES", bound)
        m = B.fit_booster(_frame(spark, x, y, w, parts), FEATS, "label", "weight", "id", 3, p, bins=8)
        trees.append([(t.feature.tolist(), t.cut.tolist(), t.left.tolist(), t.value.tolist()) for r in m.trees for t in r])
    assert trees[0] == trees[1]


def test_save_load_importance(spark, tmpdir_path):
    x, y, w = _data(300, seed=2)
    df = _frame(spark, x, y, w)
    m = B.fit_booster(df, FEATS, "label", "weight", "id", 3, B.BoostParams(rounds=3, depth=2, rate=0.5))
    m.save(spark, f"{tmpdir_path}/model")
    again = B.Booster.load(spark, f"{tmpdir_path}/model")
    assert m.transform(df).orderBy("id").collect() == again.transform(df).orderBy("id").collect()
    shares = m.importance()
    assert abs(sum(v for _, v in shares) - 1) < 1e-9 and {f for f, _ in shares} == set(FEATS)
    assert shares == again.importance()


def test_probabilities(spark):
    z = np.array([[1000.0, -1000.0, 0.0], [0.0, 0.0, 0.0], [800.0, 800.0, -5.0]])
    p = B.softmax(z)
    assert np.isfinite(p).all() and np.allclose(p.sum(axis=1), 1) and p[0, 0] == 1 and np.allclose(p[1], 1 / 3)


def test_odd_tables(spark):
    schema = "id long, a double, b double, c double, d double, label double, weight double, fold int"
    none = spark.createDataFrame([], schema)
    m = B.fit_booster(none, FEATS, "label", "weight", "id", 3, B.BoostParams(rounds=2, depth=2))
    rows = spark.createDataFrame([(1, None, None, None, None, None, None, None)], schema)
    assert [round(v, 9) for v in m.transform(rows).first()["probability"]] == [round(1 / 3, 9)] * 3
    same = spark.createDataFrame([(i, 1.0, None, float("nan"), 2.0, 1.0, 1.0, 0) for i in range(20)], schema)
    m = B.fit_booster(same, FEATS, "label", "weight", "id", 3, B.BoostParams(rounds=3, depth=2, rate=0.5))
    assert {r["prediction"] for r in m.transform(same).collect()} == {1.0}


def test_draws():
    draws = B.random_draws(3_000)
    assert draws == B.random_draws(3_000)
    assert {d.depth for d in draws} == set(range(4, 13)) and {d.rate for d in draws} == {0.01, 0.1, 0.5}
    assert min(d.rounds for d in draws) >= 300 and max(d.rounds for d in draws) <= 999
    logs = [math.log(d.l2) for d in draws]
    assert abs(statistics.mean(logs)) < 0.05 and abs(statistics.stdev(logs) - 0.75) < 0.04
    # the mean of an inverse gamma of shape 1.8 is 1 / 0.8; its median is near 0.675
    assert 0.6 < statistics.median(d.gain for d in draws) < 0.76
    assert {(d.rows, d.columns) for d in draws} == {(0.85, 0.85)}


def test_search(spark):
    x, y, w = _data(250, seed=6)
    df = _frame(spark, x, y, w)
    draws = B.shortened(B.random_draws(4), 0.01, 3)
    full = B.search(df, FEATS, "label", "weight", "id", 3, "fold", 5, draws)
    rows = full.orderBy("draw", "fold").collect()
    assert len(rows) == 20 and rows == B.search(df.repartition(2), FEATS, "label", "weight", "id", 3, "fold", 5, draws).orderBy("draw", "fold").collect()
    assert sum(r["n_rows"] for r in rows if r["draw"] == 0) == 250
    # a row of the result is the model that leaves the fold out
    r = rows[7]
    cuts = B.quantile_cuts(df, FEATS)
    held = B.Training(B.binned(df, FEATS, cuts, "label", "weight", "id", "fold"), FEATS, cuts, 3, [B.Fit(draws[r["draw"]], skip=r["fold"])])
    booster = held.run()[0]
    p = booster.transform(df.where(F.col("fold") == r["fold"])).collect()
    assert abs(np.mean([(q["prediction"] - q["label"]) ** 2 for q in p]) - r["mse"]) < 1e-12
    halved = B.search(df, FEATS, "label", "weight", "id", 3, "fold", 5, draws, rungs=[1]).collect()
    assert sum(r["rank"] == 1 for r in halved) == 5 and len({r["rounds"] for r in halved}) > 1
    assert B.best_of(full, draws) in draws


def test_folds(spark):
    x, y, w = _data(200, seed=8)
    df = _frame(spark, x, y, w)
    models, errors = B.fit_folds(df, FEATS, "label", "weight", "id", 3, "fold", 5, B.BoostParams(rounds=3, depth=3, rate=0.4))
    assert len(models) == 5 and [e["n"] for e in errors] == [40] * 5
    for f, (m, e) in enumerate(zip(models, errors, strict=True)):
        p = m.transform(df.where(F.col("fold") == f)).collect()
        assert sum(r["prediction"] == r["label"] for r in p) == e["right"]


def test_level_sums_hold_no_copy_of_the_rows_per_feature():
    """Sums equal a loop over rows, and a batch's working memory stays below
    three whole numbers a row and feature (an index and two copies of the
    gradients for every feature took more)."""
    import tracemalloc

    import pyarrow as pa

    from matchday.ml import boost as B

    rng = np.random.default_rng(3)
    n, width, classes = 20_000, 40, 3
    x = rng.integers(0, 8, (n, width)).astype(np.uint8)
    x[rng.random((n, width)) < 0.1] = B.MISSING
    p = B.BoostParams(rounds=1, depth=2, rows=1.0, columns=1.0)
    fit = B.Fit(p)
    fit.booster = B.Booster([str(i) for i in range(width)], [list(range(7))] * width, classes, p)
    fit.begin(width)
    for t in fit.growing:
        t.feature[0], t.cut[0] = 5, 3
    fit.active = [[1, 2], [2], [1]]
    jobs = [(0, k, nodes) for k, nodes in enumerate(fit.active)]
    y = rng.integers(0, classes, n).astype(np.float64)
    blob = lambda m: pa.array([r.tobytes() for r in m], pa.binary())
    batch = pa.record_batch(
        [blob(x), blob(np.zeros((n, classes))), pa.array(np.arange(n)), pa.array(np.full(n, -1, np.int32)), pa.array(y), pa.array(np.ones(n))],
        names=["x", "m", "row", "fold", "y", "w"],
    )
    shared = type("Shared", (), {"value": ([fit], [0], width, 8, jobs)})
    tracemalloc.start()
    out = list(B._level_sums(shared)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2.5 * 8 * n * width
    g, h = B._gradients(np.full((n, classes), B.BASE_SCORE), y, np.ones(n), classes)
    goes_left = np.where(x[:, 5] == B.MISSING, False, x[:, 5] <= 3)
    for b in out:
        for i, k, node, sums in zip(*[c.to_pylist() for c in b.columns], strict=True):
            got = np.frombuffer(sums, np.int64).reshape(width, 9, 2)
            here = goes_left if node == 1 else ~goes_left
            for f in (0, 5, width - 1):
                at = np.minimum(x[:, f], 8)
                for v in range(9):
                    some = here & (at == v)
                    assert got[f, v].tolist() == [int(g[some, k].sum()), int(h[some, k].sum())]
    assert sum(b.num_rows for b in out) == 4


def _other_draws():
    """Unlike each other: whole rows and columns, no penalty of a split, weights that forbid splits, more rounds than a snapshot."""
    return [
        B.BoostParams(rounds=5, depth=5, rate=0.3, gain=0.05, l2=0.3, rows=0.85, columns=0.6, seed=5),
        B.BoostParams(rounds=3, depth=3, rate=0.5, gain=0.0, l2=1e-3, rows=1.0, columns=1.0, min_weight=0.1, seed=6),
        B.BoostParams(rounds=2, depth=6, rate=0.1, gain=0.8, l2=2.0, rows=0.5, columns=0.3, min_weight=3.0, seed=7),
    ]


@pytest.mark.parametrize("classes", [3, 0])
def test_model_in_one_task_equals_levels_over_the_rows(spark, monkeypatch, classes):
    from matchday.ml import grow

    monkeypatch.setattr(B, "SNAPSHOT", 2)
    x, y, w = _data(400, seed=11)
    x[:, 3] = np.where(np.isnan(x[:, 3]), np.nan, 1.0)  # one value or none
    y = y if classes else np.round(np.nan_to_num(x[:, 0]) * 2 + y, 3)
    df = _frame(spark, x, y, w)
    cuts = B.quantile_cuts(df, FEATS, 16)
    rows = B.binned(df, FEATS, cuts, "label", "weight", "id", "fold")
    fits = [B.Fit(p, skip=s) for p in _other_draws() for s in (1, None)]
    B.Training(rows, FEATS, cuts, classes, fits).run()
    held = rows.toPandas()
    bins = np.array([list(b) for b in held["x"]], np.uint8)
    table = grow.Rows(*[held[c].to_numpy() for c in ("row", "fold", "y", "w")], bins, cuts)
    for sums in (1 << 16, 100):
        monkeypatch.setattr(grow, "NODE_SUMS", sums)
        monkeypatch.setattr(grow, "HELD_SUMS", 4 * sums)
        monkeypatch.setattr(grow, "ROW_BINS", sums)
        for f in fits:
            got = grow.margins(table, f.params, f.skip, classes, B.SNAPSHOT)
            np.testing.assert_allclose(got, f.booster.margins(bins) + B.BASE_SCORE, rtol=0, atol=1e-12)


def test_search_by_model_equals_search_by_level(spark, monkeypatch):
    x, y, w = _data(250, seed=6)
    df = _frame(spark, x, y, w)
    monkeypatch.setattr(B, "SNAPSHOT", 2)
    run = lambda: B.search(df, FEATS, "label", "weight", "id", 3, "fold", 5, _other_draws()).orderBy("draw", "fold").collect()
    by_model = run()
    monkeypatch.setattr(B, "WHOLE_BYTES", 0)
    monkeypatch.setattr(B, "TREE_BYTES", 100_000)
    assert len(list(B._groups([B.Fit(p, skip=f) for p in _other_draws() for f in range(5)], 3))) == 2
    monkeypatch.setattr(B, "_whole_models", None)
    assert run() == by_model and [r["rounds"] for r in by_model] == [5] * 5 + [3] * 5 + [2] * 5


def test_search_of_no_rows(spark):
    schema = "id long, a double, b double, c double, d double, label double, weight double, fold int"
    rows = B.search(spark.createDataFrame([], schema), FEATS, "label", "weight", "id", 1, "fold", 2, _other_draws()).collect()
    assert len(rows) == 6 and all(r["n_rows"] == 0 and r["mse"] is None for r in rows)


def test_registered_search_has_the_references_draws():
    from matchday.plans import model_jobs as MJ

    assert MJ.N_DRAWS == 80
