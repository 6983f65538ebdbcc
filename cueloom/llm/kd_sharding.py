"""K-d tree partitioning of documents into shards of near equal bytes, in built-in DataFrame functions only.

A node of the tree is a set of documents that is to become k shards. It is split along its widest
metadata dimension, at the weighted median (for odd k: at the weight of the smaller half of the
shards), until every leaf is one shard, which then has its target bytes up to about one document.

No node is ever gathered or sorted. All nodes of a level are split together: each pass adds up the
bytes of 1,024 buckets of values a node (combined before the shuffle; that is all the driver sees)
and goes on inside the bucket in which the cut falls, until the cut falls on one document. Equal
values, so a source with a third of all rows too, are told apart by a hash of the document, and
documents that are the same in everything by their place in the written table. The tree is then
applied as one expression of comparisons.

Dimensions: numbers by value; strings by their order (the seven bytes behind what all have in
common). Each is measured as a share of its range over all documents; nulls, and numbers
that are not finite, count as the least value. A document's size is the UTF-8 bytes of its text (null: none) plus 8.

Fewer documents than shards leave shards empty; a document larger than a shard's target makes its
shard larger. Equal or repeated rows are documents of their own. A null doc_id, null texts and texts
of any length need nothing special. An empty table gives an empty one. Further columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import Scratch, small

SCALE = 1 << 52
BUCKETS = 1024
STEPS = 62  # bits of a hash and of a place
PREFIX = 7  # bytes of a string that make its value
FILE_BITS = 33  # of a row's place in the written table; those above are its task


@dataclass
class Node:
    """shards: first shard and how many. A split node has a dimension and a cut: values in order of (dimension, hash, place), of which the last may be left out."""

    first: int
    shards: int
    dim: int = 0
    cut: tuple[int, ...] = ()
    inclusive: bool = True
    children: list[Node] = field(default_factory=list)

    def leaves(self) -> list[Node]:
        return [x for c in self.children for x in c.leaves()] if self.children else [self]


@dataclass
class _Search:
    """Where a node's cut is looked for: values fixed so far, the range of the next one, and the bytes before it."""

    node: Node
    target: float
    lo: int
    hi: int
    fixed: tuple[int, ...] = ()
    below: int = 0


def _text_key(c: Column, common: int) -> Column:
    return F.conv(F.rpad(F.hex(F.substring(c.cast("string").cast("binary"), common + 1, PREFIX)), 2 * PREFIX, "0"), 16, 10).cast("double")


def _dimensions(docs: DataFrame, dims: tuple[str, ...]) -> list[Column]:
    """Each dimension as a long from 0 to SCALE."""
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    number = {d: isinstance(kinds[d], T.NumericType) for d in dims}
    value = lambda d: F.when(F.abs(F.col(d).cast("double")) < float("inf"), F.col(d).cast("double")) if number[d] else F.col(d).cast("string")
    ends = docs.agg(*(f(value(d)).alias(f"{n}{i}") for i, d in enumerate(dims) for n, f in (("lo", F.min), ("hi", F.max)))).first()
    out = []
    for i, d in enumerate(dims):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        if lo is None or lo == hi:
            out.append(F.lit(0).cast("long"))
            continue
        got = value(d)
        if not number[d]:
            a, b = lo.encode(), hi.encode()
            common = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            lo, hi = (int.from_bytes(x[common : common + PREFIX].ljust(PREFIX, b"\0"), "big") for x in (a, b))
            got = _text_key(got, common)
        share = (got - F.lit(float(lo))) / F.lit(float(hi) - float(lo))
        out.append(F.coalesce((F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * SCALE).cast("long"), F.lit(0).cast("long")))
    return out


class KdTree:
    """The written metadata of documents and the tree over it."""

    def __init__(self, docs: DataFrame, dims: tuple[str, ...], shards: int):
        self.scratch = Scratch(docs.sparkSession, "kd-sharding")
        self.dims, self.shards = dims, shards
        text = F.col("text").cast("string")
        crc = F.coalesce(F.crc32(text.cast("binary")), F.lit(0).cast("long"))
        keys = [k.alias(f"k{i}") for i, k in enumerate(_dimensions(docs, dims))]
        made = docs.select(F.col("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"), crc.alias("text_crc32"), *keys)
        made = made.select("*", F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), "text_crc32", "size"), 64 - STEPS).alias("hash"), F.monotonically_increasing_id().alias("place"))
        self.rows = self.scratch.save(made, "metadata", "snappy")
        self.root = Node(0, shards)
        self._grow()

    def _values(self, node: Node) -> list[Column]:
        return [F.col(f"k{node.dim}"), F.col("hash"), F.col("place")]

    def _left(self, node: Node) -> Column:
        """Whether a row of a split node lies before its cut."""
        out = F.lit(node.inclusive)
        for value, at in reversed(list(zip(self._values(node), node.cut, strict=False))):
            out = (value < at) | ((value == at) & out)
        return out

    def _by_leaf(self, node: Node, leaf) -> Column:
        if not node.children:
            return leaf(node)
        return F.when(self._left(node), self._by_leaf(node.children[0], leaf)).otherwise(self._by_leaf(node.children[1], leaf))

    def shard(self) -> Column:
        """The shard of a row of `rows`."""
        return self._by_leaf(self.root, lambda n: F.lit(n.first))

    def _grow(self) -> None:
        while level := [n for n in self.root.leaves() if n.shards > 1]:
            at = self._by_leaf(self.root, lambda n: F.lit(n.first))
            ends = [f(f"k{i}").alias(f"{n}{i}") for i in range(len(self.dims)) for n, f in (("lo", F.min), ("hi", F.max))]
            there = {r["node"]: r for r in self.rows.groupBy(at.alias("node")).agg(F.sum("size").alias("size"), *ends).collect()}
            searches = []
            for n in level:
                less = n.shards // 2
                if r := there.get(n.first):
                    n.dim = max(range(len(self.dims)), key=lambda i, r=r: (r[f"hi{i}"] - r[f"lo{i}"], -i))
                    searches.append(_Search(n, r["size"] * less / n.shards, r[f"lo{n.dim}"], r[f"hi{n.dim}"]))
                else:
                    n.cut, n.inclusive = (0,), False  # no rows
            self._search(at, searches)
            for n in level:
                less = n.shards // 2
                n.children = [Node(n.first, less), Node(n.first + less, n.shards - less)]

    def _search(self, at: Column, searches: list[_Search]) -> None:
        """Find the cuts of a level's nodes together."""
        rows = self.rows.withColumn("node", at)
        while searches:
            bucket, value = F.lit(None).cast("int"), F.lit(None).cast("long")
            for s in searches:
                own = self._values(s.node)
                inside = F.col("node") == s.node.first
                for x, v in zip(own, s.fixed, strict=False):
                    inside &= x == v
                x = own[len(s.fixed)]
                inside &= x.between(s.lo, s.hi)
                shift = max((s.hi - s.lo).bit_length() - BUCKETS.bit_length() + 1, 0)
                bucket = F.when(inside, F.shiftright(x - s.lo, shift).cast("int")).otherwise(bucket)
                value = F.when(inside, x).otherwise(value)
            got = rows.select("node", bucket.alias("bucket"), value.alias("value"), "size").where("bucket IS NOT NULL")
            sums = got.groupBy("node", "bucket").agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
            left = []
            for s in searches:
                before = s.below
                own = sorted((r for r in sums if r["node"] == s.node.first), key=lambda r: r["bucket"])
                for r in own:
                    if before + r["size"] >= s.target or r is own[-1]:
                        break
                    before += r["size"]
                if r["n"] == 1 or (r["lo"] == r["hi"] and len(s.fixed) == 2):
                    # the document on which the cut falls goes where it fits better
                    s.node.cut, s.node.inclusive = (*s.fixed, r["lo"]), s.target - before >= r["size"] / 2
                elif r["lo"] == r["hi"]:
                    left.append(_Search(s.node, s.target, 0, (1 << STEPS) - 1, (*s.fixed, r["lo"]), before))
                else:
                    left.append(_Search(s.node, s.target, r["lo"], r["hi"], s.fixed, before))
            searches = left


def placed(docs: DataFrame, dims: tuple[str, ...] = ("source", "lang", "n_chars"), shards: int = 24) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document.

    Slots are numbered within what one task wrote of the metadata, behind the documents of
    earlier tasks in the shard, so no shard is sorted in one task.
    """
    tree = KdTree(docs, dims, shards)
    rows = tree.rows.select("*", tree.shard().cast("int").alias("shard"), F.shiftright("place", FILE_BITS).alias("task"))
    counts = rows.groupBy("shard", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = tree.scratch.save(counts.select("shard", "task", F.coalesce(before, F.lit(0)).alias("before")), "starts")
    own = F.row_number().over(Window.partitionBy("shard", "task").orderBy("place")) - 1
    out = rows.withColumn("own", own).join(small(starts, 20), ["shard", "task"])
    tree.scratch.leave()
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("own")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, dims: tuple[str, ...] = ("source", "lang", "n_chars"), shards: int = 24, files: int = 8) -> None:
    """Write docs, whole and with all their columns, below path in folders `shard=N` of near equal bytes, each of about so many files.

    The documents are shuffled once, to a shard's files by hash, so a file is written by one task and no task has a whole shard.
    A column named shard is replaced.
    """
    tree = KdTree(docs, dims, shards)
    text = F.col("text").cast("string")
    crc = F.coalesce(F.crc32(text.cast("binary")), F.lit(0).cast("long"))
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
    shard = tree.shard()
    keys = {f"k{i}": k for i, k in enumerate(_dimensions(docs, dims))}
    keys |= {"hash": F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), crc, size), 64 - STEPS), "place": F.monotonically_increasing_id()}
    whole = docs.select(F.struct(*(c for c in docs.columns if c.lower() != "shard")).alias("row"), *(k.alias(n) for n, k in keys.items()))
    whole = whole.select("row", shard.cast("int").alias("at"), F.pmod("hash", F.lit(files)).alias("file"))
    spread = whole.repartition(shards * files, "at", "file").select("row.*", F.col("at").alias("shard"))
    spread.write.partitionBy("shard").mode("overwrite").parquet(path)
    tree.scratch.drop()
