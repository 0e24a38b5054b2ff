"""Operator 12: windows, pieces, held-out accuracy, odd rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchday.llm import op12_toxicity as T
from matchday.llm import queries
from matchday.llm.op05_language import held_out

BAD = ["blorgh", "snivet", "quackle", "zempf"]


def _documents(n, seed=1):
    """Invented words; a tenth of the documents holds a bad word among every twenty."""
    rng = random.Random(seed)
    parts = ["ta", "ren", "lo", "mis", "ka", "dor", "el", "un", "si", "ver"]
    docs, labels = [], []
    for i in range(n):
        toxic = int(i % 10 == 3)
        words = ["".join(rng.choices(parts, k=rng.randrange(1, 5))) for _ in range(rng.randrange(40, 160))]
        if toxic:
            for j in range(rng.randrange(10), len(words), 20):
                words[j] = rng.choice(BAD)
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = _documents(1_200)
    rng = random.Random(5)
    extra = [
        (5_000, None), (5_001, ""), (5_002, " \n"), (5_003, "ta ren " * 40_000 + "quackle " * 3), (5_004, docs[3][1]), (5_004, docs[3][1]),
        (None, docs[13][1]), (5_005, "Ta REN lo QUACKLE\nzempf ver Blorgh snivet dor"), (5_006, "x" * 100_000),
        (5_007, "".join(rng.choices("abcdefgh0123456789", k=4_000))),
    ]
    d = spark.createDataFrame(docs + extra, "doc_id long, text string").repartition(6)
    lab = spark.createDataFrame(labels + [(None, 1), (7, None), (4_999, 1)], "doc_id long, toxic int")
    rows = T.toxicity_scores(d, lab, held_out(F.col("doc_id"), 5, 0)).collect()
    return rows, dict(labels)


def test_held_out_accuracy(scored):
    rows, labels = scored
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    caught = [r["predicted"] for r in held if labels[r["doc_id"]]]
    clean = [r["predicted"] for r in held if not labels[r["doc_id"]]]
    assert len(caught) > 10 and np.mean(caught) >= 0.9 and np.mean(clean) <= 0.02


def test_odd_rows(scored):
    rows, _ = scored
    of = {r["doc_id"]: r for r in rows}
    assert len(rows) == 1_210
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    for i in (5_000, 5_001, 5_002, 5_006, 5_007):
        assert not of[i]["predicted"] and of[i]["top_gain"] <= 1
    assert of[5_001]["score"] == of[5_000]["score"] == of[5_002]["score"]
    assert of[5_003]["top_gain"] >= 2  # whole texts: the words come after 280,000 bytes
    assert of[5_005]["predicted"] == 1
    assert len({r["score"] for r in rows if r["doc_id"] == 5_004}) == 1
    assert [r["predicted"] for r in rows if r["doc_id"] is None] == [1]


def test_windows_hold_each_word_once():
    texts = ["One two\nthree", None, "", "a " * 100, "b" * 500 + " c", "  x  "]
    raw, row, begin, end = T.windows(pa.array(texts))
    for i, text in enumerate(texts):
        words = [w for r, a, b in zip(row, begin, end, strict=True) if r == i for w in raw[a:b].tobytes().split()]
        assert words == (text or "").lower().encode().split()
    assert all(raw[a] == 32 and raw[b - 1] == 32 for a, b in zip(begin, end, strict=True))


def test_pieces_save_bytes_only_where_they_occur():
    docs, labels = _documents(400, seed=3)
    plain = T._train([t.encode() for (i, t), (_, y) in zip(docs, labels, strict=True) if not y], T.BASE_BYTES, T.BASE_SEGMENT)
    base, both = T._Sizes(plain), T._Sizes(b" quackle " + plain)
    with_, without = [b" ta quackle ren lo "] * 3, [b" ta dorel ren lo "] * 3
    assert (base.of_list(with_) - both.of_list(with_) >= T.GAIN).all()
    assert (base.of_list(without) - both.of_list(without) == 0).all()


def test_without_both_labels(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "doc_id long, toxic int")
    none = F.lit(False)
    assert {r["score"] for r in T.toxicity_scores(docs, labels, none).collect()} == {1 / 6}
    assert {r["score"] for r in T.toxicity_scores(docs, labels.limit(0), none).collect()} == {1 / 3}
    assert T.toxicity_scores(docs.limit(0), labels, none).collect() == []


def test_query_and_extra_columns(spark):
    small = "/root/testdata/sf0.001"
    rows = queries.QUERIES["op12_toxicity_score"](spark, small)
    n = spark.read.parquet(f"{small}/documents.parquet").count()
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and rows.count() == n
    docs, labels = _documents(60)
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = F.col("doc_id") % 5 == 0
    plain = T.toxicity_scores(d, lab, out).collect()
    more = T.toxicity_scores(d.selectExpr("*", "'q' as label", "1 as score", "2 as fold", "3 as top"), lab.selectExpr("*", "9 as text", "1 as label"), out)
    assert sorted(map(tuple, plain)) == sorted(map(tuple, more.collect()))
