"""The prefix trie of conversations, built level by level, with leaves and saved tokens rolled up from below.

Turns are ordered by turn (null first), then role, then text; null roles and texts are empty. Every
conversation c is rebuilt: the first h turns of conversation c - c % 20, then its own behind its first h, where
h = crc32 of c in decimal, modulo 4. A node is a distinct sequence of first turns.

Conversations of the same turns are put together first: a distinct sequence has its smallest conv_id, the number of
its conversations and the hash of their ids. Then, depth by depth, the sequences that are still live are grouped by
(parent node, next turn); a node is known by its depth and its smallest conv_id. A node with one sequence left is the
top of a chain, whose nodes need no grouping: only sequences that share a prefix with another one stay live, so there are
as many rounds as the deepest shared prefix has turns, however long conversations are and however often one is repeated.
Then each level, from the deepest to the root, adds up what its children have.

Turns are told apart by the SHA-256 of role and text, whole sequences by their length and two 64-bit hashes over all turns
with their places. Turns are numbered in blocks of a conversation, so a very long one is not sorted in one task; ids of
equal conversations are joined in pieces of 1,024 at most, which a task then hashes as a stream.

Rows without conv_id belong to no conversation and are left out. Repeated rows are turns of their own. Texts and
conversations may be of any length. An empty table gives no rows, so not even a root; a conversation that is
rebuilt without turns ends at the root. Further columns are not looked at.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch, small

BLOCK = 4096  # turns, or values of turn, that are numbered together
PIECE = 1024  # ids of one piece
NO_ENDS = hashlib.sha256(b"").hexdigest()
Q = ("len", "x1", "x2")  # what a whole sequence is known by


def _numbered(turns: DataFrame) -> DataFrame:
    """(c, pos, h, taken, role, text): turns in order from 0; how many turns c takes from the head of its twenty, and how many there are."""
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    rows = rows.withColumn("block", F.floor(F.col("turn") / BLOCK))
    rows = rows.withColumn("block", F.coalesce("block", F.lit(-(1 << 62))))
    counts = rows.groupBy("c", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    own = F.row_number().over(Window.partitionBy("c", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")) - 1
    starts = counts.select("c", "block", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.withColumn("own", own).join(starts, ["c", "block"]).select("c", (F.col("before") + F.col("own")).alias("pos"), "role", "text")


def _digest() -> Column:
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def _rebuilt(scratch: Scratch, turns: DataFrame, group: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """(c) of all conversations, and (c, d, g, w): the digest and words of each rebuilt turn, at depths from 1."""
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    own = scratch.save(_numbered(turns).select("c", "pos", _digest().alias("g"), words.alias("w")), "turns")
    lengths = scratch.save(own.groupBy("c").agg(F.count("*").alias("n")), "lengths")
    convs = lengths.select("c", (F.col("c") - F.col("c") % group).alias("b"), (F.crc32(F.col("c").cast("string")) % heads).alias("h"))
    there = lengths.where(F.col("c") % group == 0).select(F.col("c").alias("b"), F.least("n", F.lit(heads)).alias("n"))
    convs = convs.join(there, "b", "left").select("c", "b", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("taken"))
    convs = scratch.save(convs, "convs")
    n = convs.count()
    rest = own.join(small(convs.select("c", "h", "taken"), 24, n), "c").where("pos >= h").select("c", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("d"), "g", "w")
    head = own.where((F.col("c") % group == 0) & (F.col("pos") < heads)).select(F.col("c").alias("b"), "pos", "g", "w")
    first = convs.where("taken > 0").join(head, "b").where("pos < taken").select("c", (F.col("pos") + 1).alias("d"), "g", "w")
    return convs.select("c"), scratch.save(first.union(rest), "rebuilt")


def _sequences(scratch: Scratch, convs: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """(c, m, len, ends): for each distinct sequence the smallest of its conversations, how many they are, its turns, and the hash of their ids."""
    whole = rebuilt.groupBy("c").agg(F.count("*").alias("len"), *(F.bit_xor(F.xxhash64(F.lit(k), "d", "g")).alias(f"x{k}") for k in (1, 2)))
    whole = convs.join(whole, "c", "left").select("c", *(F.coalesce(k, F.lit(0)).alias(k) for k in Q))
    piece = F.floor(F.col("c") / PIECE).alias("piece")
    pieces = whole.groupBy(*Q, piece).agg(F.array_sort(F.collect_list("c")).alias("ids"))
    pieces = pieces.select(*Q, "piece", F.get("ids", F.lit(0)).alias("c"), F.size("ids").cast("long").alias("m"), F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))

    def fold(batches):
        key, state = None, None
        for batch in batches:
            out = []
            for *q, c, m, ids in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if q != key:
                    if state:
                        out.append((*state[:3], state[3].hexdigest()))
                    key, state = q, [c, 0, q[0], hashlib.sha256()]
                else:
                    state[3].update(b",")
                state[1] += m
                state[3].update(ids.encode())
            yield _ended(out)
        if state:
            yield _ended([(*state[:3], state[3].hexdigest())])

    ordered = pieces.repartition(*Q).sortWithinPartitions(*Q, "piece").select(*Q, "c", "m", "ids")
    return scratch.save(ordered.mapInArrow(fold, "c long, m long, len long, ends string"), "sequences")


def _ended(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["c", "m", "len", "ends"])


def _levels(scratch: Scratch, sequences: DataFrame, turns: DataFrame) -> list[DataFrame]:
    """For each depth the groups (conv, parent, n, k, w, ends): k is the number of distinct sequences in a node."""
    top = sequences.agg(F.min("c").alias("conv"), F.sum("m").alias("n"), F.count("*").alias("k"), F.max(F.when(F.col("len") == 0, F.col("ends"))).alias("ends"))
    top = top.where("n IS NOT NULL").select("conv", F.lit(None).cast("long").alias("parent"), "n", "k", F.lit(0).cast("long").alias("w"), "ends")
    levels = [scratch.save(top, "level-0")]
    root = levels[0].first()
    live = sequences.select("c", "m", "len", "ends", F.lit(root["conv"] if root else 0).alias("parent")).where("len > 0")
    while root:
        d = len(levels)
        step = live.join(turns.where(F.col("d") == d).select("c", "g", "w"), "c")
        nodes = step.groupBy("parent", "g").agg(
            F.min("c").alias("conv"), F.sum("m").alias("n"), F.count("*").alias("k"), F.first("w").alias("w"), F.max(F.when(F.col("len") == d, F.col("ends"))).alias("ends")
        )
        nodes = scratch.save(nodes, f"level-{d}")
        levels.append(nodes)
        several = nodes.where("k > 1").select("parent", "g", "conv")
        n = several.count()
        if not n:
            return levels
        live = step.where(F.col("len") > d).join(small(several, 48, n), ["parent", "g"]).select("c", "m", "len", "ends", F.col("conv").alias("parent"))
        live = scratch.save(live, f"live-{d}")
    return levels


def _chains(scratch: Scratch, levels: list[DataFrame], sequences: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes (conv, depth, parent, n_convs, n_children, n_leaves, saved_tokens, ends, top) of nodes with one sequence and of all below them."""
    tops = None
    for d, nodes in enumerate(levels[1:], 1):
        own = nodes.where("k = 1").select(F.col("conv").alias("c"), "parent", F.lit(d).cast("long").alias("top"))
        tops = own if tops is None else tops.union(own)
    tops = scratch.save(tops.join(sequences, "c"), "tops")
    rows = tops.join(turns, "c").where("d >= top")
    # words from each turn on count only where a sequence has copies
    copied = rows.where("m > 1").withColumn("block", F.floor(F.col("d") / BLOCK))
    after = F.sum("n").over(Window.partitionBy("c").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1))
    blocks = copied.groupBy("c", "block").agg(F.sum("w").alias("n")).select("c", "block", F.coalesce(after, F.lit(0)).alias("after"))
    inside = F.sum("w").over(Window.partitionBy("c", "block").orderBy(F.col("d").desc()))
    copied = copied.withColumn("own", inside).join(blocks, ["c", "block"]).withColumn("saved", (F.col("m") - 1) * (F.col("own") + F.col("after")))
    single = rows.where("m = 1").withColumn("saved", F.lit(0).cast("long"))
    names = ("c", "d", "top", "parent", "m", "len", "ends", "saved")
    both = copied.select(*names).union(single.select(*names))
    return scratch.save(
        both.select(
            F.col("c").alias("conv"), F.col("d").alias("depth"), F.when(F.col("d") == F.col("top"), F.col("parent")).otherwise(F.col("c")).alias("parent"), F.col("m").alias("n_convs"),
            F.when(F.col("d") < F.col("len"), 1).otherwise(0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.when(F.col("d") == F.col("len"), F.col("ends")).alias("ends"), (F.col("d") == F.col("top")).alias("top"),
        ),
        "chains",
    )


def prefix_trie(turns: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns: conv_id, turn, role, text. A conversation's head comes from the first of its `group` ids, with fewer than `heads` turns.
    """
    scratch = Scratch(turns.sparkSession, "prefix-trie")
    convs, rebuilt = _rebuilt(scratch, turns, group, heads)
    sequences = _sequences(scratch, convs, rebuilt)
    # in order of depth, so that a level reads its own turns only
    own = rebuilt.join(small(sequences.select("c"), 8), "c", "left_semi")
    own = scratch.save(own.repartitionByRange("d", "c").sortWithinPartitions("d", "c"), "own-turns")
    levels = _levels(scratch, sequences, own)
    if len(levels) == 1:
        chains, below, tops = None, None, None
    else:
        chains = _chains(scratch, levels, sequences, own)
        tops = scratch.save(chains.where("top").groupBy(F.col("depth").alias("d"), F.col("parent").alias("conv")).agg(F.count("*").alias("leaves"), F.sum("saved_tokens").alias("saved")), "chain-tops")
        below = None
    done = []
    for d in range(len(levels) - 1, -1, -1):
        nodes = levels[d] if d == 0 else levels[d].where("k > 1")
        parts = []
        if tops is not None:
            parts.append(tops.where(F.col("d") == d + 1).select("conv", "leaves", "saved", F.col("leaves").alias("children")))
        if below is not None:
            parts.append(below.groupBy(F.col("parent").alias("conv")).agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.count("*").alias("children")))
        if parts:
            each = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
            nodes = nodes.join(each.groupBy("conv").agg(*(F.sum(x).alias(x) for x in ("leaves", "saved", "children"))), "conv", "left")
        else:
            nodes = nodes.select("*", *(F.lit(None).cast("long").alias(x) for x in ("leaves", "saved", "children")))
        of = lambda c, other=0: F.coalesce(c, F.lit(other).cast("long"))
        below = scratch.save(
            nodes.select(
                "conv", F.lit(d).cast("long").alias("depth"), "parent", F.col("n").alias("n_convs"), of("children").alias("n_children"), of("leaves", 1).alias("n_leaves"),
                ((F.col("n") - 1) * F.col("w") + of("saved")).alias("saved_tokens"), "ends",
            ),
            f"rolled-{d}",
        )
        done.append(below)
    if chains is not None:
        done.append(chains.drop("top"))
    out = done[0]
    for x in done[1:]:
        out = out.union(x)
    scratch.leave()
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
