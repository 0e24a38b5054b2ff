"""Operator 8, sharding by k-d tree partitioning.

The documents are split again and again along the metadata dimension that is
widest in the node, at its weighted median, until every leaf has the target
bytes.  A median is found by counting bytes in equal bins of the node's key
range and again in the bin that the median falls into: each step is one
aggregate over all nodes at once, which returns a bounded histogram.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.llm.common import hash31, keep, release, running_sum

SHARDS = 24
#: bytes that every document counts besides its text
OVERHEAD = 8
#: bins of a node's key range in one step of the median search
BINS = 4096
#: a cut this near (share of a leaf's bytes) to the median is exact enough
TOLERANCE = 0.002
#: a cut between groups of equal texts is taken within this share of a leaf
GROUP_TOLERANCE = 0.02


@dataclass
class Node:
    """A part of the tree: a leaf has ``shard``, an inner node a cut: rows
    with (key, tie) up to (``at``, ``tie_at``) go to the left."""

    leaves: int
    shard: int = 0
    dim: int = 0
    at: int = 0
    tie_at: int = -1
    left: "Node | None" = None
    right: "Node | None" = None
    low: int = 0
    high: int = 0
    below: int = 0
    want: float = 0.0
    total: int = 0
    tie: bool = False
    done: bool = False


def _ranks(values: DataFrame, name: str) -> DataFrame:
    """(name, rank): the distinct values of column ``name``, numbered from 0 in
    code-point order by ranges that are counted, then ranked inside."""
    each = keep(values.select(name).distinct(), "values")
    parts = max(1, -(-each.count() // 100_000))
    ranged = keep(each.repartitionByRange(parts, name).withColumn("_part", F.spark_partition_id()), "values")
    release(each)
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_part").orderBy(name)
    rank = (F.row_number().over(inside) - 1 + F.col("_off")).cast("long")
    # written: the planner knows how small it is
    out = keep(ranged.join(counts, "_part").select(name, rank.alias("rank")), "ranks")
    release(ranged)
    return out


def metadata(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    """doc_id, size, text_crc32 and the sort keys of the dimensions.

    A key is the value of the dimension (31 bits; of a source or language its
    dense rank among all), then the upper 31 bits of the text's checksum, so
    that equal texts stay side by side; ``tie`` is a hash of the id, by which a
    group of equal texts is cut if it must be.
    Dimensions: source, language, logarithm of the size, checksum; a group of
    equal texts has the first source and language of its members.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
    )
    base = keep(base, "metadata")  # the texts are read once
    for name, key in (("source", "d0"), ("lang", "d1")):
        base = base.join(_ranks(base, name).withColumnRenamed("rank", key), name).drop(name)
    # equal texts go by one source and language, so that no cut of these dimensions parts them
    same = ["text_crc32", "size"]
    first = base.groupBy(*same).agg(F.min("d0").alias("d0"), F.min("d1").alias("d1"))
    base = base.drop("d0", "d1").join(first, same)
    # rows that share id and text: only they need their place, the others' keys don't depend on the layout
    again = base.groupBy("doc_id", *same).agg(F.count("*").alias("_n")).where("_n > 1")
    again = keep(again.select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", *same)], F.lit(1).alias("_again")), "repeats")
    equal = F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    for c in same:
        equal = equal & (F.col(c) == F.col(f"_{c}"))
    base = base.join(again, equal, "left")
    place = F.when(F.col("_again") == 1, hash31(F.monotonically_increasing_id(), F.lit("place"))).otherwise(0)
    half = F.shiftright("text_crc32", 1)
    return base.select(
        "doc_id", "size", "text_crc32",
        (F.shiftleft("d0", 31) + half).alias("k0"),
        (F.shiftleft("d1", 31) + half).alias("k1"),
        (F.shiftleft(F.floor(F.log2(F.col("size").cast("double")) * (1 << 20)).cast("long"), 31) + half).alias("k2"),
        (F.shiftleft(F.shiftright("text_crc32", 1), 31) + half).alias("k3"),
        (F.shiftleft(hash31(F.coalesce("doc_id", F.lit(-1)), F.lit("shard")), 31) + place).alias("tie"),
    )


DIMS = ("k0", "k1", "k2", "k3")
#: the checksum is no dimension to grow along, only what is left for a node without width
WIDE = 3


def _goes_left(node: Node) -> Column:
    key = F.col(DIMS[node.dim])
    return (key < node.at) | ((key == node.at) & (F.col("tie") <= node.tie_at))


def _number(root: Node, leaf) -> Column:
    """An expression that walks the tree; ``leaf`` maps a node without a cut
    to its value."""
    if root.left is None:
        return F.lit(leaf(root))
    return F.when(_goes_left(root), _number(root.left, leaf)).otherwise(_number(root.right, leaf))


def build_tree(table: DataFrame, shards: int) -> Node:
    """The k-d tree of the rows of :func:`metadata` with ``shards`` leaves of
    near equal bytes."""
    root = Node(leaves=shards)
    whole = table.agg(*[F.min(k).alias(f"a{i}") for i, k in enumerate(DIMS)], *[F.max(k).alias(f"b{i}") for i, k in enumerate(DIMS)], F.sum("size").alias("s")).first()
    if whole["s"] is None:
        return root
    spread = [max(1, (whole[f"b{i}"] >> 31) - (whole[f"a{i}"] >> 31)) for i in range(len(DIMS))]
    leaf_bytes = whole["s"] / shards
    level = [root]
    while open_nodes := [n for n in level if n.leaves > 1]:
        for i, n in enumerate(open_nodes):
            n.shard = i
        mark = _number(root, lambda n: n.shard if n.leaves > 1 else -1)
        rows = table.withColumn("_node", mark).where("_node >= 0")
        sizes = {
            r["_node"]: r
            for r in rows.groupBy("_node").agg(
                F.sum("size").alias("s"),
                *[F.min(k).alias(f"a{i}") for i, k in enumerate(DIMS)],
                *[F.max(k).alias(f"b{i}") for i, k in enumerate(DIMS)],
            ).collect()
        }
        for n in open_nodes:
            r = sizes.get(n.shard)
            if r is None:  # no rows: any cut will do
                n.done = True
                continue
            width = [((r[f"b{i}"] >> 31) - (r[f"a{i}"] >> 31)) / spread[i] for i in range(WIDE)]
            n.dim = max(range(WIDE), key=lambda i: width[i]) if max(width) > 0 else WIDE
            n.low, n.high, n.total, n.below = r[f"a{n.dim}"], r[f"b{n.dim}"], r["s"], 0
            n.want = n.total * (n.leaves // 2) / n.leaves
        _search(rows, [n for n in open_nodes if not n.done], leaf_bytes)
        level = []
        for n in open_nodes:
            n.left, n.right = Node(leaves=n.leaves // 2), Node(leaves=n.leaves - n.leaves // 2)
            level += [n.left, n.right]
    shard = 0
    stack = [root]
    while stack:
        n = stack.pop()
        if n.left is None:
            n.shard = shard
            shard += 1
        else:
            stack += [n.right, n.left]
    return root


def _search(rows: DataFrame, nodes: list[Node], leaf_bytes: float) -> None:
    """Sets the cut of each node.  Every round narrows [low, high] of all
    open nodes to one of ``BINS`` bins; a range of one key goes on over the
    ties of that key."""
    while todo := [n for n in nodes if not n.done]:
        width = {n.shard: -(-(n.high - n.low + 1) // BINS) for n in todo}
        bin_of = at = None
        for n in todo:
            key = "tie" if n.tie else DIMS[n.dim]
            here = f"_node = {n.shard} and {key} between {n.low} and {n.high}"
            here = F.expr(here + (f" and {DIMS[n.dim]} = {n.at}" if n.tie else ""))
            value = F.expr(f"cast(({key} - {n.low}L) div {width[n.shard]}L as int)")
            bin_of = F.when(here, value) if bin_of is None else bin_of.when(here, value)
            at = F.when(here, F.col(key)) if at is None else at.when(here, F.col(key))
        got = rows.withColumn("_bin", bin_of).withColumn("_at", at).where("_bin is not null")
        got = got.groupBy("_node", "_bin").agg(F.sum("size").alias("s"), F.min("_at").alias("a"), F.max("_at").alias("b"))
        bins: dict[int, dict[int, tuple[int, int, int]]] = {}
        for r in got.collect():
            bins.setdefault(r["_node"], {})[r["_bin"]] = (r["s"], r["a"], r["b"])
        for n in todo:
            _narrow(n, bins.get(n.shard, {}), leaf_bytes)


def _narrow(n: Node, hist: dict[int, tuple[int, int, int]], leaf_bytes: float) -> None:
    """Goes on with the bin that the median falls into, less the empty ends
    of its range, or sets the cut at one of its sides."""
    total = n.below
    last = max(hist)
    for b in sorted(hist):
        weight, low, high = hist[b]
        if total + weight >= n.want or b == last:
            break
        total += weight
    before, after = n.want - total, total + weight - n.want  # bytes off the median when cut at either side
    single = low == high
    near = GROUP_TOLERANCE if single and not n.tie else TOLERANCE
    if min(before, after) <= near * leaf_bytes or (n.tie and single):
        cut = low - 1 if before <= after else high
        n.done = True
        if n.tie:
            n.tie_at = cut
        else:
            n.at, n.tie_at = cut, 1 << 62
    elif single:  # a group of equal texts, cut by the hash of the ids, or of the places of rows that share one
        n.tie, n.at, n.below = True, low, total
        n.low, n.high = 0, (1 << 62) - 1
    else:
        n.low, n.high, n.below = low, high, total


def kd_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
) -> DataFrame:
    """Per document doc_id, size, text_crc32, shard and slot.

    Shards have near equal bytes; equal texts go to one shard unless balance
    asks for a cut through their group.  ``slot`` numbers a shard's rows from
    0 without gaps, in the order of a hash of the id (then id, size and
    checksum).  Null texts count as empty, null sources and languages as
    empty strings, null ids like any value; repeated rows are rows; an empty
    table gives no rows, and with fewer documents than shards some shards
    stay empty.
    """
    table = keep(metadata(docs, id_col, text_col, source_col, lang_col), "metadata")
    root = build_tree(table, shards)
    rows = table.withColumn("shard", _number(root, lambda n: n.shard).cast("int"))
    n_rows = table.count()
    rows = running_sum(
        rows.select("doc_id", "size", "text_crc32", "shard", "tie"), ["shard"], hash31("tie"),
        [F.col("tie"), F.col("doc_id"), F.col("size"), F.col("text_crc32")], {"slot": F.lit(1).cast("long")}, n_rows,
    )
    return rows.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
