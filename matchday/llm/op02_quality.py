"""Operator 2, quality classifier on supervised subword embeddings.

Every word and every character n-gram of a document has a learned vector,
found by hash; their mean goes through a softmax.  Training is plain
stochastic gradient descent in numpy on a bounded sample of labelled rows;
because the output is linear in the mean, scoring needs one number per hash
cell, so all documents are scored in Arrow batches from a 1 MB table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.llm.common import document_columns, hash31, mix64, text_bytes, words_of

CELLS = 1 << 18
DIM = 16
#: bytes of the character n-grams
SIZES = (3, 4)
#: bound of the training sample (labelled rows, chosen by a hash of the id)
MAX_TRAIN = 4_000
EPOCHS = 8
RATE = 0.5
SEED = 7
_BLOCK = 1 << 20
_MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _features(raw: np.ndarray, offsets: np.ndarray):
    """Yields (row, cell) arrays: words, word pairs (a pair of equal words is
    one feature whatever the word, as is a word met before in its document)
    and character n-grams with the white space around a word."""
    words, at = words_of(raw, offsets, lower=False)
    n = len(words)
    if n:
        rows = np.repeat(np.arange(len(at) - 1), np.diff(at))
        yield rows, (words >> np.uint64(46)).astype(np.int64)
        same_row = rows[1:] == rows[:-1]
        pair = mix64(words[:-1] * _MULT[0] + words[1:] * _MULT[1])
        cell = (pair >> np.uint64(46)).astype(np.int64)
        cell[words[1:] == words[:-1]] = 1
        yield rows[1:][same_row], cell[same_row]
        order = np.lexsort((words, rows))
        again = np.zeros(n, bool)
        again[order[1:]] = (words[order[1:]] == words[order[:-1]]) & (rows[order[1:]] == rows[order[:-1]])
        yield rows, np.where(again, 2, 3)
    for start in range(0, len(raw), _BLOCK):
        stop = min(len(raw), start + _BLOCK)
        code = raw[start : min(len(raw), stop + max(SIZES))]
        gap = _SPACE[code]
        code = np.where(gap, np.uint8(32), code).astype(np.uint64)
        row_of = np.searchsorted(offsets, np.arange(start, start + len(code)), "right") - 1
        for size in SIZES:
            m = min(stop - start, len(code) - size + 1)
            if m <= 0:
                continue
            good = row_of[:m] == row_of[size - 1 : m + size - 1]
            for i in range(1, size - 1):
                good &= ~gap[i : m + i]
            where = np.flatnonzero(good)
            h = code[where] * _MULT[0] + np.uint64(size)
            for i in range(1, size):
                h += code[where + i] * _MULT[i]
            yield row_of[where], (mix64(h) >> np.uint64(46)).astype(np.int64)


def _row_pieces(raw: np.ndarray, offsets: np.ndarray):
    """Groups of whole rows of about 4 MB (a longer row alone): (first row, bytes, offsets)."""
    start = 0
    while start < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[start] + 4 * _BLOCK, "right")) - 1
        end = min(max(end, start + 1), len(offsets) - 1)
        yield start, raw[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end


@dataclass
class QualityModel:
    """What each hash cell adds to the log-odds of label 1, and the bias."""

    weight: np.ndarray
    bias: float


def _sgd(cells: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray, epochs: int, rate: float, seed: int) -> QualityModel:
    """Softmax over two classes on the mean vector of a document."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIM, 1 / DIM, (CELLS, DIM)).astype(np.float32)
    out, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    n, steps, step = len(labels), epochs * len(labels), 0
    for _ in range(epochs):
        for i in rng.permutation(n):
            lr = np.float32(rate * (1 - step / steps))
            step += 1
            share = counts[i]
            vectors = table[cells[i]]
            mean = share @ vectors
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1  # gradient of the loss by z
            back = out.T @ p
            out -= lr * np.outer(p, mean)
            bias -= lr * p
            # the mean's gradient goes to every n-gram in full, as rates are per word
            table[cells[i]] = vectors - lr * (share * np.float32(len(share)))[:, None].clip(0, 4) * back[None, :]
    return QualityModel((table @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]))


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> QualityModel:
    """Without rows of both labels: a model that gives the one label, or 0.5."""
    y = np.array([int(x > 0) for x in labels], np.int64)
    if len(set(y.tolist())) < 2:
        return QualityModel(np.zeros(CELLS, np.float32), 0.0 if not len(y) else (4.0 if y[0] else -4.0))
    cells, counts = [], []
    for text in texts:
        raw, offsets = text_bytes(pa.array([text or ""], pa.string()))
        got = [c for _, c in _features(raw, offsets)]
        u, c = np.unique(np.concatenate(got), return_counts=True) if got else (np.zeros(1, np.int64), np.ones(1))
        cells.append(u)
        counts.append((c / c.sum()).astype(np.float32))
    return _sgd(cells, counts, y, epochs, rate, seed)


def _score(model):
    def run(batches):
        m: QualityModel = model.value
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            n = len(offsets) - 1
            total, size = np.zeros(n), np.zeros(n)
            for first, part, at in _row_pieces(raw, offsets):
                k = len(at) - 1
                for rows, cells in _features(part, at):
                    total[first : first + k] += np.bincount(rows, m.weight[cells], minlength=k)
                    size[first : first + k] += np.bincount(rows, minlength=k)
            score = 1 / (1 + np.exp(-(total / np.maximum(size, 1) + m.bias)))
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(score)], names=[*names, "score"])

    return run


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` (any columns with ``text``) without the text, with the
    probability of label 1; texts that are null or empty get the bias's."""
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes if n != "text")
    return docs.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), schema + ", score double")


def quality_scores(
    docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", max_train: int = MAX_TRAIN,
) -> DataFrame:
    """Per row of ``docs`` doc_id, held_out, score and predicted.

    Learns from at most ``max_train`` labelled rows that ``held_out`` (a
    column of doc_id) does not mark: those with the smallest hash of the id.
    Their ids are a bounded list, so the texts are not shuffled.  Null labels
    and ids teach nothing; an id with several labels teaches each.  Without
    labels every score is 0.5.  Repeated rows are scored each; further
    columns are not looked at.
    """
    base = document_columns(docs, id_col, text_col)
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("doc_id is not null and label is not null").where(~held_out)
    chosen = known.orderBy(hash31(F.col("doc_id"), F.lit("train")), "doc_id", "label").limit(max_train)
    sample = base.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text").toArrow()
    sample = sample.sort_by([("doc_id", "ascending"), ("label", "ascending"), ("text", "ascending")])
    model = train(sample.column("text").to_pylist(), sample.column("label").to_pylist())
    rows = score(base.select("doc_id", held_out.alias("held_out"), "text"), model)
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
