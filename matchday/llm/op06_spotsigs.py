"""Operator 6, document fingerprints by SpotSigs (Theobald et al., 2008).

A spot signature is an anchor, one of a language's most common words, with
the chain of content words that follow it; navigation, tables and lists have
few of them.  The fingerprint is the set of a document's signatures, compared
by Jaccard: sets whose lengths differ too much are told apart by length
alone.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.llm.common import document_columns, mix64, text_bytes, words_of
from matchday.llm.op07_jaccard import set_components

#: common words of English, German, French and Spanish
ANCHORS = (
    "a an and are as at be by for from had has have he in is it of on or that the this to was were what which with "
    "aber als am auch auf aus bei das dem den der des die ein eine einen einer er es für ich im in ist mit nach nicht "
    "oder sich sie sind so und von vor war wie wird zu zum zur "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne ou par pas plus pour qui que "
    "sa se ses son sur un une "
    "al como con de del el en es está la las lo los más no o para pero por que se sin su sus un una y"
)
#: content words of a chain
CHAIN = 2
_MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
#: words are runs of ASCII letters and digits and of non-ASCII characters
_GAP = np.ones(256, bool)
_GAP[128:] = False
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _GAP[_a:_b] = False


def _hashes(words: list[str]) -> np.ndarray:
    raw, offsets = text_bytes(pa.array(words, pa.string()))
    return words_of(raw, offsets, separators=_GAP)[0]


_ANCHOR_HASHES = np.unique(_hashes(ANCHORS.split()))


def signature_sets(raw: np.ndarray, offsets: np.ndarray, chain: int = CHAIN) -> list[np.ndarray]:
    """Per row the sorted distinct 64-bit hashes of its spot signatures.

    A row without any has the chains at all of its words instead, with fewer
    words than a chain the words themselves; one without words but with other
    characters has one signature, its bytes; an empty row has none.
    """
    words, at = words_of(raw, offsets, separators=_GAP)
    found = np.searchsorted(_ANCHOR_HASHES, words)
    anchor = _ANCHOR_HASHES[np.minimum(found, len(_ANCHOR_HASHES) - 1)] == words
    content = np.flatnonzero(~anchor)
    spots = np.flatnonzero(anchor)
    row_of = np.repeat(np.arange(len(at) - 1), np.diff(at))
    first = np.searchsorted(content, spots)
    good = first + chain <= len(content)
    spots, first = spots[good], first[good]
    last = content[first + chain - 1] if len(first) else first
    inside = last < at[1:][row_of[spots]]
    spots, first = spots[inside], first[inside]
    value = words[spots] * _MULT[0]
    for i in range(chain):
        value += words[content[first + i]] * _MULT[1 + i]
    value = mix64(value)
    edges = np.searchsorted(spots, at)
    out = []
    for r, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        if b > a:
            out.append(np.unique(value[a:b]))
            continue
        own = words[at[r] : at[r + 1]]
        if len(own) >= chain:
            rest = sum((own[i : len(own) - chain + 1 + i] * _MULT[1 + i] for i in range(chain)), np.zeros(len(own) - chain + 1, np.uint64))
            out.append(np.unique(mix64(rest)))
        elif len(own):
            out.append(np.unique(mix64(own)))
        else:
            text = raw[offsets[r] : offsets[r + 1]].tobytes()
            out.append(np.array([int.from_bytes(hashlib.sha256(text).digest()[:8], "little")] if text else [], np.uint64))
    return out


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    """Per text the sorted distinct upper 32 bits of its signatures."""
    out: list[np.ndarray] = []
    group, size = [], 0
    for i, text in enumerate(texts):
        group.append(text)
        size += len(text)
        if size >= 1 << 21 or i + 1 == len(texts):
            sets = signature_sets(*text_bytes(pa.array(group, pa.string())))
            out += [np.unique((s >> np.uint64(32)).astype(np.uint32)) for s in sets]
            group, size = [], 0
    return out


def as_text(print_: np.ndarray) -> str:
    return base64.b64encode(print_.astype("<u4").tobytes()).decode()


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two fingerprints, 0 if it is below ``least``: told by the
    lengths alone where they differ too much.  Two empty ones are equal."""
    low, high = sorted((len(a), len(b)))
    if not high:
        return 1.0
    if low < least * high or not low:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    value = both / (low + high - both)
    return value if value >= least else 0.0


def edited_text(text: str, following: str) -> str:
    """The last quarter of the code points (rounded down) replaced by the
    first as many of the following document, or all of it."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


_COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [c.split()[0] for c in _COLUMNS.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _compare(ids: list, texts: list[str], own: list[int]) -> pa.RecordBatch:
    """The columns for the rows ``own``; each row's successor is the next."""
    edited = [edited_text(texts[i], texts[i + 1]) for i in own]
    prints, after = fingerprints(texts), fingerprints(edited)
    columns = [
        [ids[i] for i in own],
        [len(texts[i]) for i in own],
        [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        [as_text(prints[i]) for i in own],
        [as_text(p) for p in after],
        [jaccard(prints[i], q) for i, q in zip(own, after, strict=True)],
        [jaccard(prints[i], prints[i + 1]) for i in own],
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)




def _neighbours(batches):
    """Rows sorted by (part, ghost, id, text), each with its successor in the
    part; a ghost, the first row of the next part, is only a successor."""
    ids: list = []
    texts: list[str] = []
    parts: list[int] = []
    ghosts: list[bool] = []
    for batch in batches:
        ids += batch.column("doc_id").to_pylist()
        texts += [t or "" for t in batch.column("text").to_pylist()]
        parts += batch.column("part").to_pylist()
        ghosts += batch.column("ghost").to_pylist()
        while len(texts) > 1:  # groups of a few MB
            size, k = 0, 1
            while k < len(texts) and size < 1 << 22:
                size += len(texts[k - 1])
                k += 1
            own = [i for i in range(k - 1) if not ghosts[i] and parts[i] == parts[i + 1]]
            if own:
                yield _compare(ids[:k], texts[:k], own)
            ids, texts, parts, ghosts = ids[k - 1 :], texts[k - 1 :], parts[k - 1 :], ghosts[k - 1 :]


def _place(cuts: list[int], firsts: list[int]):
    """Twice the number of the part of an id, plus 1 for a part's first id."""

    @F.pandas_udf("long")
    def place(ids: pd.Series) -> pd.Series:
        value = ids.to_numpy()
        part = np.searchsorted(np.array(cuts, np.int64), value, "right")
        return pd.Series(2 * part + (np.array(firsts, np.int64)[part] == value))

    return place


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next.

    The next document is the one with the next larger id, after the last the
    first; rows with equal ids follow one another by text, null ids come
    last.  Null texts are empty; the fingerprint of an empty text is empty
    and like only another empty one.  A single row is its own next; an empty
    table gives no rows.

    The ids are cut into parts of about equal rows by their quantiles, a
    bounded list.  The texts are shuffled once by part; a part's first row
    goes to the part before as well, where it is the successor of the last.
    """
    base = document_columns(docs, id_col, text_col)
    spark = base.sparkSession
    wanted = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit(k / wanted) for k in range(1, wanted)])
    seen = base.agg(
        F.min("doc_id").alias("low"), F.percentile_approx("doc_id", shares, F.lit(20 * wanted)).alias("cuts"),
        F.count(F.when(F.col("doc_id").isNull(), 1)).alias("nulls"),
    ).first()
    cuts = sorted({x for x in seen["cuts"] or [] if x > seen["low"]})
    n_parts = 0 if seen["low"] is None else len(cuts) + 1
    rows = base.where("doc_id is not null")
    if n_parts:
        firsts = [seen["low"], *cuts]
        code = _place(cuts, firsts)(F.col("doc_id"))
        last = n_parts + bool(seen["nulls"])
        rows = rows.withColumn("_code", code)
        part, first = F.floor(F.col("_code") / 2).cast("int"), F.col("_code") % 2 == 1
        before = F.pmod(part + (last - 1), F.lit(last))
        copies = F.array(F.struct(part.alias("part"), F.lit(False).alias("ghost")),
                         F.when(first, F.struct(before.alias("part"), F.lit(True).alias("ghost"))))
        rows = rows.select("doc_id", "text", F.explode(F.filter(copies, lambda x: x.isNotNull())).alias("_c"))
        rows = rows.select("doc_id", "text", "_c.part", "_c.ghost")
    else:
        rows = rows.select("doc_id", "text", F.lit(0).alias("part"), F.lit(False).alias("ghost"))
    if seen["nulls"]:
        null = base.where("doc_id is null").withColumn("text", F.coalesce("text", F.lit("")))
        head = null.agg(F.min("text").alias("text")).select(F.lit(None).cast("long").alias("doc_id"), "text")
        rows = rows.union(null.select("doc_id", "text", F.lit(n_parts), F.lit(False)))
        rows = rows.union(head.select("doc_id", "text", F.lit(max(n_parts - 1, 0)), F.lit(True)))
    order = ["part", "ghost", F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first()]
    return rows.repartition("part").sortWithinPartitions(*order).mapInArrow(_neighbours, _COLUMNS)


def _spot_sets(batch: pa.RecordBatch):
    return iter(signature_sets(*text_bytes(batch.column("text"))))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """Per row doc_id, n_shingles (signatures) and component_id of the
    documents whose signature sets have a Jaccard of ``percent`` or more,
    by the prefix-filtered, length-bounded join of operator 7."""
    return set_components(document_columns(docs, id_col, text_col), _spot_sets, percent)
