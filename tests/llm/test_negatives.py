"""Operator 13 against brute force and SQL."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from matchday.llm import op13_negatives as N
from matchday.llm import queries

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int"


def _brute(rows, anchor_every=100, move_every=7):
    """All pairs, sorted."""
    good = []
    for i, (vec_id, x, label) in enumerate(rows):
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        if vec_id is not None and vec_id % move_every == 0:
            label = (label + 1) % 10
        good.append((i, vec_id, label, [math.floor(256 * c) for c in x]))
    out = []
    for i, a, label, x in good:
        if a is None or a % anchor_every:
            continue
        others = sorted(
            (-sum(p * q for p, q in zip(x, y, strict=True)), b is None, b or 0, j, b, m)
            for j, b, m, y in good if j != i and len(x) == len(y)
        )
        for s, _, _, _, b, m in [o for o in others if o[5] == label][:5]:
            fits = [o for o in others if o[5] != label and 80 * -s <= 100 * -o[0] <= 100 * -s][:5]
            out += [(a, b, k, o[4], -s, -o[0]) for k, o in enumerate(fits, 1)]
    return sorted(out, key=repr)


def _rows(n, seed, dim=6, few=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rng.choice([0.0, 0.25, 0.5, -0.5, 1.0]) if few else rng.gauss(0.2, 0.3) for _ in range(dim)]
        rows.append((rng.choice([i, i, i, i // 2, None]) if few else i, x, rng.randrange(4)))
    return rows


def _run(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    ints = N.integer_vectors(df.select("vec_id", "embedding", moved.alias("label")))
    got = N.hard_negatives(ints, F.col("vec_id") % 10 == 0, **more)
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("seed,few", [(1, False), (2, True), (3, True)])
def test_equals_brute_force(spark, seed, few):
    rows = _rows(150, seed, few=few)
    # small blocks and chunks of anchors: every merge is exercised
    assert _run(spark, rows, block=16, anchor_bytes=400) == _brute(rows, 10)


def test_odd_rows(spark):
    inf = float("inf")
    rows = _rows(60, 5) + [
        (100, None, 1), (110, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1), (120, [inf] + [0.0] * 5, 1), (130, [float("nan")] * 6, 1),
        (140, [0.5] * 6, None), (150, [], 1), (151, [], 1), (152, [], 2), (160, [1e9, -1e9, 3.5], 0), (161, [1e9, 1e9, 1.0], 0),
        (162, [1e9, 1e8, 1.0], 1), (170, [0.3] * 6, 1), (170, [0.3] * 6, 1), (170, [0.2] * 6, 1), (None, [0.3] * 6, 1), (None, [0.3] * 6, 2),
    ]
    assert _run(spark, rows) == _brute(rows, 10)


def test_one_vector_on_most_rows(spark):
    rng = random.Random(9)
    rows = [(i, [0.5] * 4 if i % 3 else [rng.random() for _ in range(4)], rng.randrange(3)) for i in range(200)]
    assert _run(spark, rows, block=32) == _brute(rows, 10)


def test_no_rows(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(1, [1.0], 0)]) == []


def test_extra_columns(spark):
    df = spark.createDataFrame([(100 * i, [1.0, 0.1 * i], i % 2) for i in range(20)], SCHEMA)
    plain = N.mine_embeddings(df).collect()
    more = N.mine_embeddings(df.selectExpr("*", "1 as key", "'x' as v", "2 as row", "true as anchor")).collect()
    assert plain and sorted(map(repr, plain)) == sorted(map(repr, more))


def test_keys_sort_like_pairs():
    rng = np.random.default_rng(3)
    pairs = [tuple(int(v) for v in rng.integers(-3, 4, 6)) for _ in range(300)]
    a, s, k, i, z, r = (np.array(c) for c in zip(*pairs, strict=True))
    k, z = k & 1, z & 1
    keys = N.pack_keys(a, s, k, i, z, r)
    order = sorted(range(300), key=lambda j: keys[j].tobytes())
    want = sorted(range(300), key=lambda j: (a[j], -s[j], k[j], z[j], i[j], r[j]))
    assert [tuple(keys[j]) for j in order] == [tuple(keys[j]) for j in want]
    back = N.unpack_keys(keys)
    for x, y in zip(back, (a, s, k == 1, i, z == 1, r), strict=True):
        assert (x == y).all()


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SMALL}/embeddings.parquet'")
    want = con.execute(queries.ORACLE_SQL["op13_hard_negatives"])
    columns = [d[0] for d in want.description]
    want = sorted(want.fetchall())
    df = queries.QUERIES["op13_hard_negatives"](spark, SMALL).select(*columns)
    assert want and sorted(tuple(r) for r in df.collect()) == want
