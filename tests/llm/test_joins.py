"""Operators 7 and 9, the components helper: against brute force."""

import itertools
import math
import random

import numpy as np
import pytest

from matchday.llm import common, op06_spotsigs, op07_jaccard, op09_embeddings

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _roots(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def _shingles(text, q):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + q]) for i in range(len(words) - q + 1)} if len(words) >= q else {tuple(words)}


def _brute(docs, q, percent):
    sets = {i: _shingles(t, q) for i, t in docs}
    links = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    roots = _roots(sets, links)
    return {i: (len(sets[i]), roots[i]) for i in sets}


def _corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs, i = [], 10
    for base in range(12):
        words = rng.choices(vocabulary, k=rng.choice([9, 25, 60, 150]))
        for _ in range(rng.choice([1, 3, 12])):  # copies with more and more edits, some of them equal
            docs.append((i, " ".join(words)))
            i += 3
            words = list(words)
            for _ in range(rng.choice([0, 1, 1, 2])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        # a star: copies of one base with one edit each, unlike one another
        for _ in range(rng.choice([0, 6])):
            copy = list(words)
            copy[rng.randrange(len(copy))] = f"e{i}"
            docs.append((i, "\t".join(copy).upper() + " \n"))
            i += 1
    passage = " ".join(rng.choices(vocabulary, k=60))  # shared by otherwise different texts
    for _ in range(20):
        docs.append((i, passage + " " + " ".join(rng.choices(vocabulary, k=rng.choice([3, 8, 20, 80])))))
        i += 1
    chain = [f"c{k}" for k in range(200)]  # each links with the next only: the hubs of round 1 don't meet all
    docs += [(i + k, " ".join(chain[k * 2 : k * 2 + 60])) for k in range(40)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize(("q", "percent", "hot"), [(3, 90, op07_jaccard.HOT), (5, 80, 5)])
def test_jaccard_components_equal_brute_force(spark, monkeypatch, q, percent, hot):
    monkeypatch.setattr(op07_jaccard, "HOT", hot)  # 5: common n-grams are dealt out over tasks
    docs = _corpus() + [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "é one")]
    table = spark.createDataFrame([(i, t, None, "s", 0) for i, t in docs], DOCS)
    table = table.selectExpr("*", "1 as node", "2 as token", "'x' as slot", "3 as component").repartition(3)
    got = op07_jaccard.jaccard_components(table, words=q, percent=percent).collect()
    want = _brute(docs, q, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len(got) == len(docs)
    assert any(c < i for i, (_, c) in want.items())


def test_jaccard_odd_rows(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (None, "x y z"), (7, "q r s"), (7, "t u v")]
    got = op07_jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=90)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(5, 4, 5), (5, 4, 5), (None, 4, 5), (None, 1, None), (7, 1, 7), (7, 1, 7)], key=str
    )
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert op07_jaccard.jaccard_components(empty).count() == 0
    assert op07_jaccard.one_of_each(empty).columns == ["doc_id", "text"]


def test_one_of_each(spark):
    docs = [*_corpus(), (None, "w1 w2 w3")]
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], DOCS)
    kept = op07_jaccard.one_of_each(table)
    want = _brute([d for d in docs if d[0] is not None], 5, 80)
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == sorted(i for i, (_, c) in want.items() if i == c)
    assert kept.where("doc_id is null").count() == 1
    assert kept.columns == table.columns


def test_one_of_each_decides_by_row(spark):
    long = " ".join(f"w{i}" for i in range(40))
    docs = [(1, long), (5, long + " x"), (5, "a clean text that is like no other one here"), (None, long), (7, "rep eat ed text of six"),
            (7, "rep eat ed text of six"), (7, "rep eat ed text of six"), (None, "no id but words of its own"), (None, "no id but words of its own"), (9, None)]
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], DOCS)
    got = [(r["doc_id"], r["text"]) for r in op07_jaccard.one_of_each(table).collect()]
    assert sorted(got, key=str) == sorted([docs[0], docs[2], docs[4], docs[7], docs[9]], key=str)


def test_spot_components_find_copies(spark):
    text = "the cat of the house and the dog in the garden was seen by a man with the long hat " * 3
    docs = [(1, text), (2, text + "menu | home"), (3, "quite another text is here and it was on the table for days")]
    got = op06_spotsigs.similar_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 1, 3: 3}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1040)]
    edges += [(2000, i) for i in range(2001, 2050)] + [(7, 7)]
    got = common.connected_components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()
    edges = [e for e in edges if e[0] != e[1]]
    want = _roots({n for e in edges for n in e}, edges)
    assert {r["node"]: r["component"] for r in got} == want
    assert len(got) == len(want)


# ------------------------------------------------------------ embeddings


def _vectors():
    rng = np.random.default_rng(4)
    rows, i = [], 0
    for _ in range(40):
        v = rng.normal(size=16)
        rows.append((i, v))
        i += 1
        for _ in range(int(rng.integers(0, 5))):
            v = v + rng.normal(size=16) * rng.choice([0.0, 0.05, 0.2, 0.33])
            rows.append((i, v * float(rng.choice([1, 3]))))
            i += 1
    out = [(a, [float(x) for x in v]) for a, v in rows]
    odd = [None, [], [0.0] * 16, [1.0] * 15 + [None], [1.0] * 15 + [math.nan], [1.0] * 15 + [math.inf], [1.0] * 8, [2.0] * 8]
    return out + [(1000 + k, v) for k, v in enumerate(odd)] + [(2000, out[0][1]), (2001, out[0][1])]


def _brute_vectors(rows, threshold):
    def cosine(a, b):
        if len(a) != len(b):
            return -2.0
        a, b = np.array(a), np.array(b)
        return float(a @ b) / math.sqrt(float(a @ a) * float(b @ b))

    good = {i: v for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    links = [(a, b) for a, b in itertools.combinations(good, 2) if cosine(good[a], good[b]) >= threshold]
    roots = _roots([i for i, _ in rows], links)
    return {i: (sum(i in e for e in links), roots[i], roots[i] == i) for i, _ in rows}


@pytest.mark.parametrize("block", [8192, 32])
def test_near_duplicate_vectors_equal_brute_force(spark, block, monkeypatch):
    rows = _vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as node", "2 as label")
    got = op09_embeddings.near_duplicates(table.repartition(3), block=block).collect()
    want = _brute_vectors(rows, 0.9)
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == want
    assert len(got) == len(rows)
    assert max(x[0] for x in want.values()) >= 3


def test_tile_bounds_never_lose_a_pair():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 24))
    x[150:] = x[:150] + rng.normal(size=(150, 24)) * rng.uniform(0.3, 0.6, (150, 1))
    x /= np.sqrt((x**2).sum(axis=1))[:, None]
    a, b = op09_embeddings._Tile(np.arange(150), x[:150]), op09_embeddings._Tile(np.arange(150), x[150:])
    for threshold in (0.7, 0.85, 0.9):
        got = set(zip(*map(np.ndarray.tolist, op09_embeddings._linked(a, b, threshold)), strict=True))
        assert got == set(zip(*map(np.ndarray.tolist, np.nonzero(x[:150] @ x[150:].T >= threshold)), strict=True))


def test_vectors_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert op09_embeddings.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [2.0, 0.0]), (None, [0.0, 1.0]), (4, None)]
    got = op09_embeddings.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(None, 2, 3, False), (3, 2, 3, True), (3, 2, 3, True), (None, 0, None, True), (4, 0, 4, True)], key=str
    )
