"""Operator 12, toxicity by compression distance.

Two zstandard dictionaries are trained apart, one on windows of ordinary
text, one on the words of toxic text that the ordinary dictionary leaves
uncompressed.  A window of a text is compressed with the ordinary dictionary
and with both; the bytes that the toxic one saves are the window's gain.
Matches with ordinary text are the same on both sides, so a gain comes from
toxic pieces only.

Learning takes three folds of a bounded sample of labelled documents: the
first trains the dictionaries, the second measures each piece of the toxic
dictionary alone and keeps those that save bytes in toxic rather than in
ordinary windows, the third, whole documents, calibrates the score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.llm.common import document_columns, hash31, keep, mix64, release, row_groups, text_bytes

#: a window holds the words that begin in this many bytes
WINDOW = 64
LEVEL = 5
#: sizes of the ordinary dictionary, and (segment, size) of the toxic ones whose pieces are measured
BASE_BYTES = 128 << 10
BASE_SEGMENT = 32
TOXIC = ((16, 12 << 10), (28, 12 << 10), (48, 12 << 10))
TOXIC_WHOLE = (28, 16 << 10)
#: tables that hold every position of the dictionaries, so that no piece is overlooked
PARAMETERS = dict(
    window_log=18, chain_log=18, hash_log=18, search_log=5, min_match=4, target_length=16, strategy=zstandard.STRATEGY_LAZY2,
    write_content_size=False, write_checksum=False, write_dict_id=False,
)
#: bytes that a piece and a window must share to be measured
SHARED = 5
#: bounds of what is learned from: documents per label, windows per document, label and fold, bytes of a window
MAX_DOCS = {1: 4_000, 0: 6_000}
WINDOWS_PER_DOC = 64
MAX_WINDOWS = 30_000
LEARN_BYTES = 256
#: a window whose gain is at least this counts; a piece is kept if it saves as much in
#: windows of which at least RATIO times the share is toxic
GAIN = 2
RATIO = 20.0
#: longest gain that tells more than a shorter one
MOST = 12
#: ends every dictionary and begins every window: its match makes sure that a short window is
#: compressed too, as zstandard stores what saves too little
_MARK = mix64(np.arange(1, 5, dtype=np.uint64)).view(np.uint8)
#: ends every window: zstandard starts no match in the last 16 bytes
_TAIL = mix64(np.arange(5, 7, dtype=np.uint64)).view(np.uint8)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


# ------------------------------------------------------------------ windows


def windows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, row, begin, end) of the windows of lower-cased texts.  A window
    is the words that begin in one stretch of WINDOW bytes, with the space
    before and after: no word is cut, each is in one window."""
    padded = pc.binary_join_element_wise(pa.scalar(" "), pc.utf8_lower(pc.fill_null(texts, "")), pa.scalar(" "), "")
    raw, offsets = text_bytes(padded)
    gap = _SPACE[raw]
    raw = np.where(gap, np.uint8(32), raw)
    starts = np.flatnonzero(~gap[1:] & gap[:-1]) + 1 if len(raw) else np.zeros(0, np.int64)
    row = np.searchsorted(offsets, starts, "right") - 1
    cell = (starts - offsets[row]) // WINDOW
    new = np.ones(len(starts), bool)
    new[1:] = (row[1:] != row[:-1]) | (cell[1:] != cell[:-1])
    first = np.flatnonzero(new)
    begin, row = starts[first] - 1, row[first]
    end = np.minimum(np.append(starts[first[1:]], len(raw)), offsets[row + 1])
    return raw, row, begin, end


class _Sizes:
    """Compressed sizes of byte ranges with one dictionary."""

    def __init__(self, content: bytes):
        parameters = zstandard.ZstdCompressionParameters(**PARAMETERS)
        dictionary = zstandard.ZstdCompressionDict(content + _MARK.tobytes(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=parameters)
        self.compressor = zstandard.ZstdCompressor(compression_params=parameters, dict_data=dictionary)

    def of(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray, step: int = 4096) -> np.ndarray:
        out = np.zeros(len(begin), np.int64)
        for a in range(0, len(begin), step):
            data, segments = _marked(raw, begin[a : a + step], end[a : a + step])
            found = self.compressor.multi_compress_to_buffer(zstandard.BufferWithSegments(data, segments))
            out[a : a + len(found)] = [len(found[i]) for i in range(len(found))]
        return out

    def of_list(self, items: list[bytes]) -> np.ndarray:
        ends = np.cumsum([len(x) for x in items]) if items else np.zeros(0, np.int64)
        begin = np.concatenate([[0], ends[:-1]]) if items else ends
        return self.of(np.frombuffer(b"".join(items), np.uint8), begin, ends)


def _marked(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[bytes, bytes]:
    """The ranges one after the other, each between mark and tail, and where they lie."""
    m, inner = len(_MARK), end - begin
    size = inner + m + len(_TAIL)
    start = np.cumsum(size) - size
    data = np.empty(int(size.sum()), np.uint8)
    data[start[:, None] + np.arange(m)] = _MARK
    data[(start + m + inner)[:, None] + np.arange(len(_TAIL))] = _TAIL
    data[np.repeat(start + m, inner) + _within(inner)] = raw[np.repeat(begin, inner) + _within(inner)]
    return data.tobytes(), np.stack([start, size], axis=1).astype(np.uint64).tobytes()


def _within(size: np.ndarray) -> np.ndarray:
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)


# ------------------------------------------------------------------ the model


@dataclass
class ToxicityModel:
    """The dictionaries and the calibration of a document's score."""

    base: bytes
    toxic: bytes
    weight: np.ndarray  # of the columns of _inputs
    constant: float | None = None  # the score where nothing could be learned


def _features(raw, row, begin, end, n, base: _Sizes, both: _Sizes) -> np.ndarray:
    """Per row greatest gain, sum of gains that count, number of windows."""
    gain = base.of(raw, begin, end) - both.of(raw, begin, end)
    top, total = np.zeros(n), np.zeros(n)
    np.maximum.at(top, row, gain)
    np.add.at(total, row, np.where(gain >= GAIN, gain, 0))
    return np.stack([top, total, np.bincount(row, minlength=n)], axis=1)


def _measured(shared):
    """Adds the features to batches whose last column is ``text``."""

    def run(batches):
        m: ToxicityModel = shared.value
        base, both = _Sizes(m.base), _Sizes(m.toxic + m.base)
        for batch in batches:
            texts = batch.column("text")
            parts = [np.zeros((0, 3))]
            for group in row_groups(texts):
                raw, row, begin, end = windows(group)
                parts.append(_features(raw, row, begin, end, len(group), base, both))
            f = np.concatenate(parts)
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], *[pa.array(f[:, i]) for i in range(3)]],
                names=[*names, "top", "total", "windows"],
            )

    return run


def _inputs(top, total, n) -> np.ndarray:
    """1, greatest gain, log of all gains, gains per window and their root, log of the windows."""
    share = np.minimum(total / np.maximum(n, 1), MOST)
    return np.stack(
        [np.ones(len(top)), np.minimum(top, MOST) / MOST, np.log1p(total) / 4, share / 2, np.sqrt(share), np.log1p(n) / 8], axis=1
    )


def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [1e-2] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge @ w
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return w


# ------------------------------------------------------------------ learning


def _train(samples: list[bytes], size: int, k: int, d: int = 6) -> bytes:
    """A trained dictionary; the samples themselves where they are too few to train on."""
    samples = [s for s in samples if len(s) >= 8]
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=d, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def _surprising(toxic: list[bytes], base: bytes) -> list[bytes]:
    """Per window its words that the ordinary dictionary does not shorten."""
    words = sorted({w for t in toxic for w in re.findall(rb"[^ ,.;:!?]{4,64}", t)})
    size = _Sizes(base).of_list([b""] + [b" " + w + b" " for w in words])
    new = {w for w, s in zip(words, size[1:].tolist(), strict=True) if s - size[0] >= len(w) + 2}
    return [b" " + b" ".join(w for w in re.findall(rb"[^ ,.;:!?]{4,64}", t) if w in new) + b" " for t in toxic]


def _by_bytes(items: list[bytes]) -> dict[bytes, list[int]]:
    """Positions of the items by the SHARED bytes they contain."""
    at: dict[bytes, list[int]] = {}
    for i, x in enumerate(items):
        for g in {x[j : j + SHARED] for j in range(len(x) - SHARED + 1)}:
            at.setdefault(g, []).append(i)
    return at


def _hits(shared):
    """Per piece of the toxic dictionary the toxic and the ordinary windows in
    which it alone saves GAIN bytes."""

    def run(batches):
        base, *sides = shared.value
        plain = _Sizes(base)
        sides = [(x, plain.of_list(x), _by_bytes(x)) for x in sides]
        for batch in batches:
            counts = []
            for piece in batch.column("piece").to_pylist():
                alone, row = _Sizes(piece + b" " + base), []
                for items, before, at in sides:
                    some = sorted({i for j in range(len(piece) - SHARED + 1) for i in at.get(piece[j : j + SHARED], ())})
                    row.append(int((before[some] - alone.of_list([items[i] for i in some]) >= GAIN).sum()) if some else 0)
                counts.append(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("piece"), pa.array([c[0] for c in counts], pa.int64()), pa.array([c[1] for c in counts], pa.int64())],
                names=["piece", "toxic", "ordinary"],
            )

    return run


def _learned_windows(per_doc: int):
    """Of each row the ``per_doc`` windows of the smallest hash (label, fold, mark, window)."""

    def run(batches):
        for batch in batches:
            labels, folds = batch.column("label").to_numpy(), batch.column("fold").to_numpy()
            for at, group in _groups(batch.column("text")):
                raw, row, begin, end = windows(group)
                short = end - begin <= LEARN_BYTES
                row, begin, end = row[short], begin[short], end[short]
                pieces = [raw[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
                mark = np.array([_mark(p) for p in pieces], np.int64)
                order = np.lexsort((mark, row))
                place = np.arange(len(order)) - np.searchsorted(row[order], row[order], "left")
                some = order[place < per_doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(labels[at + row[some]], pa.int32()), pa.array(folds[at + row[some]], pa.int32()),
                     pa.array(mark[some], pa.int64()), pa.array([pieces[i] for i in some.tolist()], pa.binary())],
                    names=["label", "fold", "mark", "window"],
                )

    return run


def _groups(column: pa.Array):
    at = 0
    for group in row_groups(column):
        yield at, group
        at += len(group)


def _mark(window: bytes) -> int:
    """A hash of a window, by which the sample is chosen."""
    return xxhash.xxh3_64_intdigest(window) >> 1


def learn(
    labelled: DataFrame, totals: dict[int, int], max_windows: int = MAX_WINDOWS, per_doc: int = WINDOWS_PER_DOC
) -> ToxicityModel:
    """The model of ``labelled`` (doc_id, label 0 or 1, text), a bounded
    number of documents; ``totals`` are the counts of all labelled rows."""
    spark = labelled.sparkSession
    n = sum(totals.values())
    none = ToxicityModel(b"", b"", np.zeros(6), (totals.get(1, 0) + 1) / (n + 3))
    if not totals.get(0) or not totals.get(1):
        return none
    # folds by id: half trains, a quarter chooses the pieces, a quarter calibrates
    fold = F.element_at(F.array(*[F.lit(x) for x in (0, 0, 1, 2)]), (hash31(F.col("doc_id"), F.lit("fold")) % 4 + 1).cast("int"))
    labelled = keep(labelled.select("doc_id", "label", fold.alias("fold"), "text"), "labelled")
    rows = labelled.where("fold < 2").select("label", "fold", "text")
    rows = rows.mapInArrow(_learned_windows(per_doc), "label int, fold int, mark long, window binary").distinct()
    order = Window.partitionBy("label", "fold").orderBy("mark", "window")
    rows = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= max_windows)  # bounded rows and bytes
    found: dict[tuple[int, int], list[bytes]] = {(y, f): [] for y in (0, 1) for f in (0, 1)}
    for r in rows.select("label", "fold", "n", "window").toArrow().sort_by([("n", "ascending")]).to_pylist():
        found[r["label"], r["fold"]].append(r["window"])
    base = _train(found[0, 0], BASE_BYTES, BASE_SEGMENT)
    samples = _surprising(found[1, 0], base)
    samples = [b"".join(samples[i : i + 16]) for i in range(0, len(samples), 16)]
    trained = [_train(samples, size, k) for k, size in TOXIC] + [_train(found[1, 0], TOXIC_WHOLE[1], TOXIC_WHOLE[0])]
    pieces = sorted({x for t in trained for x in re.findall(rb" [^ ]{%d,}" % (SHARED - 1), t)})
    if not pieces:
        release(labelled)
        return none
    # the windows in which any piece saves bytes
    plain, all_ = _Sizes(base), _Sizes(b"".join(pieces) + b" " + base)
    some = []
    for y in (1, 0):
        gain = plain.of_list(found[y, 1]) - all_.of_list(found[y, 1])
        some.append([w for w, g in zip(found[y, 1], gain.tolist(), strict=True) if g >= GAIN])
    shared = spark.sparkContext.broadcast((base, *some))
    parts = min(len(pieces), spark.sparkContext.defaultParallelism)
    table = spark.createDataFrame([(i, p) for i, p in enumerate(pieces)], "i int, piece binary").repartition(parts, "i")
    hits = table.select("piece").mapInArrow(_hits(shared), "piece binary, toxic long, ordinary long").toArrow().to_pylist()
    n1, n0 = max(1, len(found[1, 1])), max(1, len(found[0, 1]))
    least = max(3, n1 // 2000)
    kept = [h for h in hits if h["toxic"] >= least and h["toxic"] / n1 >= RATIO * (h["ordinary"] + 0.5) / (n0 + 1)]
    kept = [bytes(h["piece"]) for h in sorted(kept, key=lambda h: (h["toxic"], h["piece"]))]
    if not kept:
        release(labelled)
        return none
    model = ToxicityModel(base, b"".join(kept) + b" ", np.zeros(6))
    checked = labelled.where("fold = 2").select("doc_id", "label", "text")
    measured = checked.mapInArrow(_measured(spark.sparkContext.broadcast(model)), "doc_id long, label int, top double, total double, windows double")
    # repeated rows of an id teach once: as many rows as documents of the sample
    rows = measured.dropDuplicates(["doc_id", "label"]).toArrow()
    y = rows.column("label").to_numpy()
    if len(set(y.tolist())) == 2:
        share = np.where(y == 1, totals[1] / (y == 1).sum(), totals[0] / (y == 0).sum())
        x = _inputs(*[rows.column(c).to_numpy() for c in ("top", "total", "windows")])
        model.weight = _calibrate(x, y, share * len(y) / share.sum())
    else:
        model.weight = np.array([-3.0, MOST, 0.0, 0.0, 0.0, 0.0])  # a gain of 3 is the limit
    release(labelled)
    return model


# ------------------------------------------------------------------ the operator


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", max_docs: dict[int, int] = MAX_DOCS,
) -> DataFrame:
    """Per row of ``docs`` doc_id, held_out, score, predicted and the gains
    behind them: top_gain (of the best window), n_toxic_bytes (all saved).

    Learns from at most ``max_docs`` documents per label that ``held_out`` (a
    column of doc_id) does not mark, those with the smallest hash of the id,
    and of these from a bounded number of windows.  Null labels and ids teach
    nothing; an id with several labels teaches each; labels above 0 count as
    1.  Without rows of both labels, or where no piece of the toxic
    dictionary holds, every score is (toxic + 1) / (labelled + 3).  Every
    text is scored whole, repeated rows each; null and empty texts have no
    window and get the score of gain 0; further columns are not looked at.
    """
    base = document_columns(docs, id_col, text_col)
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), (F.col(label_col) > 0).cast("int").alias("label"))
    known = known.where("doc_id is not null and label is not null").where(~held_out).distinct()
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    order = Window.partitionBy("label").orderBy("_hash", "doc_id")
    chosen = known.withColumn("_hash", hash31(F.col("doc_id"), F.lit("toxic"))).withColumn("_n", F.row_number().over(order))
    limit = F.when(F.col("label") == 1, max_docs[1]).otherwise(max_docs[0])
    chosen = chosen.where((F.col("_n") <= max(max_docs.values())) & (F.col("_n") <= limit)).select("doc_id", "label")
    model = learn(base.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text"), totals)
    rows = base.select("doc_id", held_out.alias("held_out"), "text")
    if model.constant is not None:
        score = F.lit(float(model.constant))
        out = rows.select("doc_id", "held_out", F.lit(0.0).alias("top"), F.lit(0.0).alias("total"), score.alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)
        out = rows.mapInArrow(_measured(shared), "doc_id long, held_out boolean, top double, total double, windows double")
        share = F.least(F.col("total") / F.greatest("windows", F.lit(1.0)), F.lit(float(MOST)))
        inputs = [
            F.lit(1.0), F.least("top", F.lit(float(MOST))) / MOST, F.log1p("total") / 4, share / 2, F.sqrt(share), F.log1p("windows") / 8,
        ]
        z = sum((F.lit(float(w)) * x for w, x in zip(model.weight, inputs, strict=True)), F.lit(0.0))
        out = out.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0)))))
    return out.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.col("top").cast("long").alias("top_gain"), F.col("total").cast("long").alias("n_toxic_bytes"),
    )
