"""Operator 5, language identification by language-bitmask n-gram filters.

One Bloom filter per language would be asked k times each; here the filters
are bit-sliced: cell p of the table holds the bits p of all languages'
filters, so the AND of k cells is the set of all languages that contain an
n-gram.  A document counts, per language, its n-grams in the filter; the
share that the filter's filling would let through by chance is taken off, and
the language with most left decides.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.llm.common import document_columns, hash31, keep, mix64, signed, small_batches

#: code points of an n-gram; letters in lower case, everything else a space
SIZES = (3, 4)
#: cells of the table and of one n-gram: 8 bytes a cell for each 64 languages
CELLS = 1 << 20
HASHES = 3
#: the filters learn from about so many documents of each language, chosen by
#: a hash of the id: what is learned stays bounded, all documents are scored
TRAIN_PER_LANGUAGE = 5_000
#: a language contains an n-gram that it uses at least half as often, relative
#: to its text, as the language that uses it most, and at least twice
SHARE = 0.5
LEAST = 2
UNKNOWN = "und"
#: a document with a smaller share of known n-grams is in no learned language
MIN_KNOWN = 0.1
_PIECE = 1 << 18
_MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x2545F4914F6CDD1D)]
_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.array([chr(i).isalpha() for i in range(0x110000)])
    return _LETTERS


def _pieces(texts: Sequence[str | None]) -> Iterator[list[tuple[int, str, int]]]:
    """Groups of (row, lower-case text, n-grams that start in it) of about
    256,000 characters; a longer text is cut, each piece with what its last n-grams need."""
    group, size = [], 0
    for row, text in enumerate(texts):
        text = (text or "").lower()
        for at in range(0, len(text), _PIECE):
            part = text[at : at + _PIECE + max(SIZES) - 1]
            group.append((row, part, _PIECE if at + _PIECE < len(text) else len(part) + 1))
            size += len(part)
            if size >= _PIECE:
                yield group
                group, size = [], 0
    if group:
        yield group


def _grams(group: list[tuple[int, str, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of all n-grams of a group, and nothing of rows without letters."""
    joined = " " + " ".join(t for _, t, _ in group) + " "
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    code = np.where(letter, code, np.uint32(32)).astype(np.uint64)
    lengths = np.array([len(t) + 1 for _, t, _ in group])
    ends = np.cumsum(lengths)
    starts = ends - lengths
    limit = np.array([n for _, _, n in group])
    rows = np.array([r for r, _, _ in group])
    owner = np.repeat(np.arange(len(group)), lengths)  # of the windows that start at the space before a text
    offset = np.arange(len(owner)) - starts[owner]
    inside = np.where(offset == 0, True, offset <= limit[owner])
    hashes, of = [], []
    for n in SIZES:
        m = len(code) - n + 1
        if m <= 0:
            continue
        good = inside[:m].copy() if m <= len(inside) else np.append(inside, np.zeros(m - len(inside), bool))
        for i in range(1, n - 1):
            good &= letter[i : m + i]
        at = np.flatnonzero(good)
        h = code[at] * _MULT[0] + np.uint64(n)
        for i in range(1, n):
            h += code[at + i] * _MULT[i]
        hashes.append(mix64(h))
        of.append(rows[owner[at]])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(of)


def _count(languages: list[str]):
    number = {x: i for i, x in enumerate(languages)}

    def run(batches):
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            langs = [number[x] for x in batch.column("lang").to_pylist()]
            for group in _pieces(batch.column("text").to_pylist()):
                h, rows = _grams(group)
                by = np.array(langs, np.int64)[rows]
                for k in np.unique(by):
                    u, c = np.unique(h[by == k], return_counts=True)
                    if k in kept:  # merge with what this task has
                        u = np.concatenate([kept[k][0], u])
                        c = np.concatenate([kept[k][1], c])
                        u, inverse = np.unique(u, return_inverse=True)
                        c = np.bincount(inverse, c).astype(np.int64)
                    kept[k] = (u, c)
        for k, (u, c) in kept.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(u), k, np.int32)), pa.array(signed(u)), pa.array(c.astype(np.int64))],
                names=["lang", "gram", "n"],
            )

    return run


@dataclass
class LanguageModel:
    """Languages (most frequent first), the bit-sliced table (cells x words
    of 64 languages) and each filter's rate of false positives."""

    languages: list[str]
    table: np.ndarray
    false_rate: np.ndarray


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id doesn't."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def train(docs: DataFrame, usable: Column, per_language: int = TRAIN_PER_LANGUAGE) -> LanguageModel:
    """Learns from the rows (doc_id, text, lang) with ``usable`` and a language."""
    small_batches(docs.sparkSession)
    rows = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts, key=lambda x: (-counts[x], x))
    words = max(1, -(-len(languages) // 64))
    if not languages:
        return LanguageModel([], np.zeros((CELLS, 1), np.uint64), np.zeros(0))
    chosen = F.lit(False)
    for lang in languages:
        below = min(1.0, per_language / counts[lang]) * 2.0**31
        chosen = chosen | ((F.col("lang") == lang) & (hash31(F.col("doc_id"), F.lit("lang")) < below))
    grams = rows.where(chosen).select("text", "lang").mapInArrow(_count(languages), "lang int, gram long, n long")
    grams = keep(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = {r["lang"]: r["t"] for r in grams.groupBy("lang").agg(F.sum("n").alias("t")).collect()}
    per = F.element_at(F.array(*[F.lit(1.0 / totals.get(i, 1)) for i in range(len(languages))]), F.col("lang") + 1)
    each = grams.where(F.col("n") >= LEAST).withColumn("f", F.col("n") * per)
    each = each.groupBy("gram").agg(F.collect_list(F.struct("lang", "f")).alias("all"), F.max("f").alias("top"))
    own = each.select("gram", F.explode(F.filter("all", lambda x: x["f"] >= F.col("top") * SHARE)).alias("x"))
    own = own.select("gram", F.col("x.lang").alias("lang"))
    bits = int(np.log2(CELLS))
    places = F.array(*[F.shiftrightunsigned("gram", i * bits).bitwiseAND(F.lit(CELLS - 1)) for i in range(HASHES)])
    cells = own.select(F.explode(places).alias("cell"), "lang")
    cells = cells.groupBy("cell", F.floor(F.col("lang") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, lang % 64)")).alias("mask")
    )
    got = cells.toArrow()  # at most CELLS rows for each 64 languages
    table = np.zeros((CELLS, words), np.uint64)
    table[got.column("cell").to_numpy(), got.column("word").to_numpy()] = got.column("mask").to_numpy().view(np.uint64)
    filled = np.array([((table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
    return LanguageModel(languages, table, filled**HASHES)


def _score(model, keep_text: bool):
    bits = np.uint64(int(np.log2(CELLS)))
    low = np.uint64(CELLS - 1)

    def run(batches):
        m: LanguageModel = model.value
        n_lang = len(m.languages)
        # the narrowest cells that hold all languages: the table stays in cache
        kind = next(k for k, size in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 1 << 30)) if n_lang <= size)
        tables = [m.table[:, w].astype(kind) for w in range(m.table.shape[1])]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            hits, total = np.zeros((len(texts), max(1, n_lang))), np.zeros(len(texts))
            for group in _pieces(texts):
                h, rows = _grams(group)
                if not len(h):
                    continue
                span = int(rows.max()) - int(rows.min()) + 1
                base = int(rows.min())
                total[base : base + span] += np.bincount(rows - base, minlength=span)
                at = [((h >> (np.uint64(i) * bits)) & low).astype(np.int64) for i in range(HASHES)]
                for w, table in enumerate(tables):
                    mask = table[at[0]]
                    for a in at[1:]:
                        mask &= table[a]
                    for k in range(w * 64, min(n_lang, w * 64 + 64)):
                        on = rows[(mask >> kind(k % 64)) & kind(1) == 1]
                        hits[base : base + span, k] += np.bincount(on - base, minlength=span)
            lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in texts], bool)
            real = np.maximum(0.0, (hits[:, :n_lang] - total[:, None] * m.false_rate) / np.maximum(1e-9, 1 - m.false_rate))
            pred, score, known = [], np.zeros(len(texts)), np.zeros(len(texts))
            for i in range(len(texts)):
                if not lettered[i] or not n_lang:
                    pred.append(UNKNOWN)
                    continue
                best = int(real[i].argmax())  # ties: the more frequent language
                pred.append(m.languages[best])
                if real[i, best] > 0:
                    score[i] = real[i, best] / real[i].sum()
                    known[i] = min(1.0, real[i, best] / total[i])
            names = [c for c in batch.schema.names if keep_text or c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(pred, pa.string()), pa.array(score), pa.array(known)],
                names=[*names, "lang_pred", "score", "known"],
            )

    return run


def identify(docs: DataFrame, model: LanguageModel, keep_text: bool = False) -> DataFrame:
    """``docs`` (any columns with ``text``), without the text unless asked, with lang_pred,
    score (share of the winner among all languages' n-grams, 0 to 1) and
    known (its share of the text's n-grams).

    A text that is null or has no letter is ``und`` with score 0, as is every
    text if no language was learned.  A text of which no n-gram is known gets
    the most frequent language with score 0.
    """
    spark = docs.sparkSession
    small_batches(spark)
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes if keep_text or n != "text")
    return docs.mapInArrow(_score(spark.sparkContext.broadcast(model), keep_text), schema + ", lang_pred string, score double, known double")


def predict_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", modulus: int = 4, remainder: int = 2
) -> DataFrame:
    """Per row doc_id, held_out, lang_pred, score and known; the model learns
    from the rows that are not held out and have an id and a language."""
    base = document_columns(docs, id_col, text_col).withColumn("lang", F.lit(None).cast("string")) if lang_col not in docs.columns else docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    out = held_out(F.col("doc_id"), modulus, remainder)
    model = train(base, ~out & F.col("doc_id").isNotNull())
    return identify(base.select("doc_id", out.alias("held_out"), "text"), model)


def in_known_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows that are in no learned language: ``und``, or
    fewer than MIN_KNOWN of the n-grams known to any language.  If no row has
    a language, nothing is learned and nothing but ``und`` for want of letters goes."""
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    model = train(base, F.col("doc_id").isNotNull())
    if not model.languages:
        return docs.where(F.col(text_col).rlike(r"\p{L}"))
    rest = [c for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row"), F.col(text_col).cast("string").alias("text"))
    scored = identify(packed, model, keep_text=True).where((F.col("lang_pred") != UNKNOWN) & (F.col("known") >= MIN_KNOWN))
    return scored.select(*[F.col("text").alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
