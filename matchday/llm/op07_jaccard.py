"""Operator 7, n-gram Jaccard join with vertical partitioning.

All n-grams (word shingles) of the corpus have one global order, rare ones
first, which is cut into fragments.  A document's set falls into one segment
per fragment; the segments are the columns of a table.  Candidates share an
n-gram of their prefixes; the overlap of a candidate pair is counted fragment
by fragment, a pair whose first fragment differs too much is given up there,
and the partial overlaps are summed per pair.

Equal sets are one class from the start.  A group of near copies is never
expanded into all its pairs: round 1 compares every document with one hub per
n-gram, round 2 only documents that are still in different components.  The
components are exact all the same, because two linked documents share the
first common n-gram, where they have met in round 1, are in one component
already, or meet in round 2.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.llm.common import (
    connected_components,
    document_columns,
    keep,
    release,
    row_groups,
    shingle_sets,
    signed,
    text_bytes,
    words_of,
)

#: words of a shingle and least similarity in percent, unless a caller says otherwise
WORDS = 5
PERCENT = 80
#: the order of n-grams comes from counts of all n-grams in 2^20 hashed cells:
#: 8 MB, whatever the corpus; collisions only make the order less sharp
SKETCH_BITS = 20
_LOW = 64 - SKETCH_BITS
_MASK = np.uint64((1 << _LOW) - 1)
#: fragments of the global order
FRAGMENTS = 8
#: an n-gram with more documents than this is dealt out over several tasks
HOT = 50_000
#: bits of the filter for documents that take part in a round (1 MB)
FILTER_BITS = 1 << 23
_CHUNK = 1024


#: maps an Arrow batch with a column text to one sorted array of distinct 64-bit hashes per row
Sets = Callable[[pa.RecordBatch], Iterator[np.ndarray]]


def word_shingles(q: int) -> Sets:
    def sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for column in row_groups(batch.column("text")):
            raw, offsets = text_bytes(column)
            words, rows = words_of(raw, offsets)
            yield from shingle_sets(words, rows, q)

    return sets


def _node(tokens: np.ndarray) -> int:
    """64-bit name of a class of equal sets, signed."""
    x = xxhash.xxh3_64_intdigest(tokens.tobytes())
    return x - (1 << 64) if x >= 1 << 63 else x


_PROFILE = "kind int, doc_id long, n_shingles long, node long, row long, chunk int, counts binary"


def _profile(sets_of: Sets):
    def run(batches):
        cells = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            sets = list(sets_of(batch))
            if sets:
                tokens = np.concatenate(sets)
                cells += np.bincount((tokens >> np.uint64(_LOW)).astype(np.int64), minlength=1 << SKETCH_BITS)
            n = len(sets)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.zeros(n, np.int32)), batch.column("doc_id").cast(pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                batch.column("row") if "row" in batch.schema.names else pa.nulls(n, pa.int64()),
                pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
            ], names=["kind", "doc_id", "n_shingles", "node", "row", "chunk", "counts"])
        parts = np.minimum(cells, 2**31 - 1).astype("<i4").reshape(-1, _CHUNK)
        used = np.flatnonzero(parts.any(axis=1))
        n = len(used)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.ones(n, np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
            pa.array(used.astype(np.int32)), pa.array([zlib.compress(parts[i].tobytes(), 1) for i in used], pa.binary()),
        ], names=["kind", "doc_id", "n_shingles", "node", "row", "chunk", "counts"])

    return run


def _sum_cells(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts"), strict=True):
            part = np.frombuffer(zlib.decompress(counts.as_buffer()), "<i4")
            sums[chunk] = sums[chunk] + part if chunk in sums else part.astype(np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
        names=["chunk", "counts"],
    )


class Order:
    """The global n-gram order: by count of the n-gram's cell, then by cell,
    then by hash.  ``key`` maps hashes to numbers in that order, one to one."""

    def __init__(self, cells: np.ndarray):
        by = np.argsort(cells, kind="stable")
        self.rank = np.empty(len(cells), np.uint32)
        self.rank[by] = np.arange(len(cells), dtype=np.uint32)
        mass = np.cumsum(cells[by])
        total = int(mass[-1])
        #: least rank of fragments 1, 2, ...: equal shares of all n-grams
        self.cuts = np.searchsorted(mass, [total * i // FRAGMENTS for i in range(1, FRAGMENTS)], "left").astype(np.uint64)
        #: ranks from here on are hot: cells of more than HOT n-grams, and far more than most
        limit = max(HOT, 16 * total // len(cells))
        self.hot_from = int(np.searchsorted(cells[by], limit, "right"))
        self.salts = -(-cells[by][self.hot_from :] // limit)

    def key(self, tokens: np.ndarray) -> np.ndarray:
        high = self.rank[(tokens >> np.uint64(_LOW)).astype(np.int64)].astype(np.uint64)
        return np.sort((high << np.uint64(_LOW)) | (tokens & _MASK))

    def salt(self, keys: np.ndarray, node: int) -> np.ndarray:
        rank = (keys >> np.uint64(_LOW)).astype(np.int64)
        out = np.zeros(len(keys), np.int64)
        hot = np.flatnonzero(rank >= self.hot_from)
        if len(hot):
            out[hot] = 1 + node % self.salts[rank[hot] - self.hot_from]
        return out


def _order(profile: DataFrame) -> Order:
    cells = np.zeros((1 << SKETCH_BITS) // _CHUNK * _CHUNK, np.int64).reshape(-1, _CHUNK)
    parts = profile.where("kind = 1").select("chunk", "counts").repartition("chunk")
    for r in parts.mapInArrow(_sum_cells, "chunk int, counts binary").collect():  # 8 MB at most
        cells[r["chunk"]] = np.frombuffer(r["counts"], np.int64)
    return Order(cells.reshape(-1))


def _prefix(sets_of: Sets, percent: int, order):
    def run(batches):
        by = order.value
        seen: set[int] = set()
        for batch in batches:
            keys, nodes, sizes = [], [], []
            for s in sets_of(batch):
                n = len(s)
                if n * 100 < percent * (n + 1):  # links only with an equal set
                    continue
                node = _node(s)
                if node in seen:
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(node)
                keys.append(by.key(s)[: n - (percent * n + 99) // 100 + 1])
                nodes.append(node)
                sizes.append(n)
            if not keys:
                continue
            lengths = [len(k) for k in keys]
            flat = np.concatenate(keys)
            salt = np.concatenate([by.salt(k, node) for k, node in zip(keys, nodes, strict=True)])
            yield pa.RecordBatch.from_arrays([
                pa.array(signed(flat)), pa.array(salt), pa.array(np.repeat(np.array(nodes, np.int64), lengths)),
                pa.array(np.repeat(np.array(sizes, np.int32), lengths)),
                pa.array(np.concatenate([np.arange(x, dtype=np.int32) for x in lengths])),
            ], names=["token", "salt", "node", "n", "pos"])

    return run


def _shared(batches):
    """Of rows sorted by (token, salt, node): one per node, and only n-grams
    of several nodes or so common that they were dealt out."""
    rest = None
    names = ["token", "salt", "node", "n", "pos"]

    def runs(cols, last):
        t, s, d = cols[0], cols[1], cols[2]
        new = np.empty(len(t), bool)
        new[:1] = True
        new[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1])
        fresh = new.copy()
        fresh[1:] |= d[1:] != d[:-1]
        cols = [c[fresh] for c in cols]
        starts = np.flatnonzero(new[fresh])
        ends = np.append(starts[1:], len(cols[0]))
        tail = None
        if not last and len(starts):
            tail = [c[starts[-1] :] for c in cols]
            starts, ends = starts[:-1], ends[:-1]
        good = np.flatnonzero((ends - starts > 1) | (cols[1][starts] > 0))
        pick = np.zeros(len(cols[0]), bool)
        for a, b in zip(starts[good], ends[good], strict=True):
            pick[a:b] = True
        return [c[pick] for c in cols], tail

    def out(cols):
        return pa.RecordBatch.from_arrays([pa.array(cols[i]) for i in (0, 2, 3, 4)], names=["token", "node", "n", "pos"])

    for batch in batches:
        cols = [batch.column(x).to_numpy(zero_copy_only=False) for x in names]
        if rest is not None:
            cols = [np.concatenate([a, b]) for a, b in zip(rest, cols, strict=True)]
        done, rest = runs(cols, False)
        yield out(done)
    if rest is not None:
        yield out(runs(rest, True)[0])


def _segments(sets_of: Sets, order, bits: bytes, parts: list[int]):
    names = ["node", *[f"f{i}" for i in parts]]

    def run(batches):
        by, chosen = order.value, np.frombuffer(bits, np.uint8)
        for batch in batches:
            at = batch.column("slot").to_numpy()
            batch = batch.filter(pa.array((chosen[at >> 3] >> (at & 7)) & 1 == 1))
            nodes, found = [], [[] for _ in parts]
            for s in sets_of(batch):
                if not len(s):
                    continue
                nodes.append(_node(s))
                keys = by.key(s)
                cut = np.searchsorted(keys >> np.uint64(_LOW), by.cuts, "left")
                segments = np.split(signed(keys), cut)
                for i, part in enumerate(parts):
                    found[i].append(segments[part])
            if nodes:
                cols = [
                    pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0, *map(len, p)]), pa.int32()), pa.array(np.concatenate(p))
                    )
                    for p in found
                ]
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), *cols], names=names)

    return run


def _needed(na: Column, nb: Column, percent: int) -> Column:
    """Least overlap of two linked sets: ceil(p (na + nb) / (100 + p))."""
    return F.floor((F.lit(percent) * (na + nb) + F.lit(99 + percent)) / F.lit(100 + percent)).cast("int")


def _may_link(na: Column, pa_: Column, nb: Column, pb: Column, percent: int) -> Column:
    """At the first common n-gram, what comes before it in either set is not
    in the other."""
    least = _needed(na, nb, percent)
    return (pa_ + least <= na) & (pb + least <= nb)


def _pairs(rows: DataFrame) -> DataFrame:
    """Distinct (a, b, na, nb), a < b, of columns x, nx, y, ny."""
    swap = F.col("x") > F.col("y")
    return rows.select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"),
        F.when(swap, F.col("ny")).otherwise(F.col("nx")).alias("na"),
        F.when(swap, F.col("nx")).otherwise(F.col("ny")).alias("nb"),
    ).distinct()


class _Join:
    def __init__(self, docs: DataFrame, sets_of: Sets, percent: int):
        self.docs, self.sets_of, self.percent = docs, sets_of, percent
        self.spark = docs.sparkSession
        self.profile = keep(docs.mapInArrow(_profile(sets_of), _PROFILE), "profile")
        self.order = self.spark.sparkContext.broadcast(_order(self.profile))
        classes = self.profile.where("kind = 0 and node is not null")
        self.classes = keep(classes.groupBy("node").agg(F.min("doc_id").alias("rep")), "classes")

    def _segments(self, pairs: DataFrame, parts: list[int]) -> DataFrame | None:
        """(node, f_i for the fragments i of ``parts``) of the sets of the
        pairs, from one more scan of the texts; None without pairs."""
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        slot = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1))), F.lit(FILTER_BITS))
        marks = ends.join(self.classes, "node").select(F.col("rep").alias("doc_id")).select(slot.alias("slot"))
        # one bit per document that takes part: 1 MB; what else hits a bit is read in vain
        marks = marks.groupBy(F.floor(F.col("slot") / 32768).alias("k")).agg(
            F.bitmap_construct_agg(F.pmod("slot", F.lit(32768))).alias("bits")
        )
        bits = bytearray(FILTER_BITS // 8)
        for r in marks.collect():
            bits[r["k"] * 4096 : (r["k"] + 1) * 4096] = r["bits"]
        if not any(bits):
            return None
        schema = "node long, " + ", ".join(f"f{i} array<long>" for i in parts)
        rows = self.docs.select("text", slot.alias("slot"))
        return keep(rows.mapInArrow(_segments(self.sets_of, self.order, bytes(bits), parts), schema), "segments")

    def links(self, pairs: DataFrame) -> DataFrame | None:
        """The linked pairs (a, b) among the candidates; None if there are none.

        The overlap in the first fragment, the rarest n-grams, tells most
        false candidates; the other fragments are read for the pairs left."""
        na, nb = F.col("na"), F.col("nb")
        spare = na + nb - F.lit(2) * _needed(na, nb, self.percent)
        rest = list(range(1, FRAGMENTS))

        def both(rows: DataFrame, segments: DataFrame, parts: list[int]) -> DataFrame:
            for side in ("a", "b"):
                own = [F.col(f"f{i}").alias(f"{side}_f{i}") for i in parts]
                rows = rows.join(segments.select(F.col("node").alias(side), *own), side)
            return rows

        pairs = keep(pairs, "pairs")
        segments = self._segments(pairs, [0])
        if segments is None:
            release(pairs)
            return None
        first = both(pairs, segments, [0]).withColumn("o0", F.size(F.array_intersect("a_f0", "b_f0")))
        first = first.where(F.size("a_f0") + F.size("b_f0") - F.lit(2) * F.col("o0") <= spare)
        first = keep(first.select("a", "b", "na", "nb", "o0").distinct(), "pairs")
        release(pairs, segments)
        segments = self._segments(first, rest)
        if segments is None:
            release(first)
            return None
        total = F.col("o0")
        for i in rest:
            total = total + F.size(F.array_intersect(f"a_f{i}", f"b_f{i}"))
        found = both(first, segments, rest).where(total >= _needed(na, nb, self.percent)).select("a", "b").distinct()
        found = keep(found, "links")
        release(first, segments)
        return found

    def components(self) -> DataFrame | None:
        """(node, component) of all linked nodes; component is a node."""
        percent = self.percent
        prefix = self.docs.select("text").mapInArrow(
            _prefix(self.sets_of, percent, self.order), "token long, salt long, node long, n int, pos int"
        )
        dealt = prefix.repartition("token", "salt").sortWithinPartitions("token", "salt", "node")
        shared = keep(dealt.mapInArrow(_shared, "token long, node long, n int, pos int"), "shared")

        # round 1: each document with the hub of each n-gram, the one that has least before it
        hubs = shared.groupBy("token").agg(F.min(F.struct("pos", "n", "node")).alias("h"))
        hubs = keep(hubs.select("token", F.col("h.pos").alias("hp"), F.col("h.n").alias("hn"), F.col("h.node").alias("hub")), "hubs")
        near = shared.join(hubs, "token").where(
            (F.col("node") != F.col("hub")) & _may_link(F.col("n"), F.col("pos"), F.col("hn"), F.col("hp"), percent)
        )
        links = self.links(_pairs(near.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("hub").alias("y"), F.col("hn").alias("ny"))))
        found = keep(connected_components(links, "a", "b"), "components") if links is not None else None

        # round 2: documents of one n-gram that are in different components and neither its hub
        rows = shared
        if found is not None:
            rows = shared.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        else:
            rows = shared.withColumn("component", F.col("node"))
        rows = keep(rows, "rows")
        each = rows.groupBy("token", "component").agg(F.count("*").alias("k"))
        mixed = each.groupBy("token").agg(
            F.count("*").alias("parts"), F.max_by("component", F.struct("k", "component")).alias("major")
        ).where("parts > 1").drop("parts")
        rows2 = rows.join(mixed, "token").join(hubs.select("token", "hub"), "token").where("node <> hub").drop("hub")
        rows2 = keep(rows2, "rows")
        # the largest component of an n-gram stands on one side only, so its own rows don't meet
        left = rows2.where("component <> major").select(
            "token", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"), F.col("component").alias("cx")
        )
        right = rows2.select(
            "token", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("pos").alias("py"),
            F.col("component").alias("cy"), "major",
        )
        met = left.join(right, "token").where(
            ((F.col("cy") == F.col("major")) | (F.col("cx") < F.col("cy")))
            & _may_link(F.col("nx"), F.col("px"), F.col("ny"), F.col("py"), percent)
        )
        more = self.links(_pairs(met.select("x", "nx", "y", "ny")))
        release(shared, hubs, rows, rows2)
        if more is None:
            return found
        # links between components, named by their components
        names = found if found is not None else self.spark.createDataFrame([], "node long, component long")
        joined = more.join(names.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
        joined = joined.join(names.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
        over = connected_components(
            joined.select(F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")), "ca", "cb"
        )
        over = keep(over.select(F.col("node").alias("component"), F.col("component").alias("top")), "components")
        old = names.join(over, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
        fresh = over.join(names, F.col("node") == over["component"], "left_anti").select(
            F.col("component").alias("node"), F.col("top").alias("component")
        )
        return old.union(fresh)


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Per row of ``docs`` doc_id, n_shingles and component_id.

    A-Z are lower-cased; words are runs without white space; a document's set
    holds its distinct shingles of ``words`` words (with fewer words the
    whole sequence as one).  Two documents link when 100 x intersection >=
    ``percent`` x union; component_id is the smallest doc_id reachable.
    Shingles and sets are compared by 64-bit hashes.

    Null and empty texts have no shingles and link with nothing.  Rows with a
    null id have the component of the rows that they link with, null if none
    of these has an id.  Repeated rows have equal sets; rows that share an id
    but not the text are compared each for itself.  An empty table gives no
    rows; further columns are not looked at.
    """
    return set_components(document_columns(docs, id_col, text_col), word_shingles(words), percent)


def set_components(docs: DataFrame, sets_of: Sets, percent: int) -> DataFrame:
    """:func:`jaccard_components` of rows (doc_id, text) for any kind of set."""
    join = _Join(docs, sets_of, percent)
    found = join.components()
    names = join.classes
    if found is not None:
        names = names.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        least = names.groupBy("component").agg(F.min("rep").alias("component_id"))
        names = names.join(least, "component").select("node", "component_id")
    else:
        names = names.select("node", F.col("rep").alias("component_id"))
    rows = join.profile.where("kind = 0").select("doc_id", "n_shingles", "node")
    rows = rows.join(keep(names, "names"), "node", "left")
    return rows.select(
        "doc_id", "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id
    (rows without an id come last; then the smallest hash of the text).

    Rows are told apart by id and text, so rows that share an id but not the
    text are decided each for itself; of rows equal in both, any one stays.
    Null texts and texts without words link with nothing: all of them stay.
    """
    text = F.xxhash64(F.col(text_col).cast("string"))
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), text.alias("row"))
    join = _Join(document_columns(named, "doc_id", "text", "row"), word_shingles(words), percent)
    found = join.components()
    rows = join.profile.where("kind = 0 and node is not null").select(F.col("doc_id").isNull().alias("late"), "doc_id", "row", "node")
    rows = rows.groupBy("node", "late", "doc_id", "row").agg(F.count("*").alias("n"))
    rows = keep(rows, "rows")
    names = rows.groupBy("node").agg(F.min(F.struct("late", "doc_id", "row")).alias("first"))
    if found is not None:
        names = keep(names.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "names")
        least = names.groupBy("component").agg(F.min("first").alias("first"))
        names = names.drop("first").join(least, "component").select("node", "first")
    names = keep(names.select("node", F.col("first.doc_id").alias("_id"), F.col("first.row").alias("_row")), "names")
    rows = rows.join(names, "node").withColumn("_stays", F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")))
    rows = keep(rows.select("doc_id", "row", "n", "_stays"), "rows")

    def these(which: str) -> DataFrame:
        return keep(rows.where(which).select(F.col("doc_id").alias("_gone"), F.col("row").alias("_text")), "gone")

    def same():
        return F.col(id_col).cast("long").eqNullSafe(F.col("_gone")) & (text == F.col("_text"))

    gone, repeated = these("not _stays"), these("_stays and n > 1")
    left = docs.join(gone, same(), "left_anti")
    if repeated.isEmpty():
        return left
    # partial aggregates: a row repeated however often is one row per task before it is dealt out
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    once = left.join(repeated, same()).groupBy("_gone", "_text").agg(F.first(own).alias("_kept"))
    once = once.select(*[F.col(f"_kept.`{c}`").alias(c) for c in docs.columns])
    return left.join(repeated, same(), "left_anti").unionByName(once)
