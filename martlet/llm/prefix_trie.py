"""Operator 13: the conversation prefix trie by minimal-perfect-hash node tables.

1. Paths: a conversation's turns in order give one row a prefix, with the 128-bit
   digest of the prefix and of its parent. Turns come as a sorted stream, so a
   conversation of any length is never held; the next digest hashes the last one,
   the role and the text.
2. Nodes: Spark enumerates the distinct digests and adds up their members, with
   partial sums before the shuffle, so a prefix that a third of all conversations
   share is one row. ``rest``, the path rows at and below a node, bounds its subtree.
3. Shards: nodes whose ``rest`` exceeds a limit are the crown (at most
   ``CROWN_WIDTH`` a depth); every other node lies below one cut node, a child of
   the crown, and all nodes below a cut node are of one shard. Cut nodes are dealt
   to shards of about the limit's size.
4. Per shard, a minimal perfect hash gives each digest its own slot, level by level:
   digests alone in their cell of a level take it, the others go on to the next.
   A slot keeps its digest, which verifies every look-up. Counts are scattered
   into flat numpy arrays by slot, and children, leaves and saved bytes are
   accumulated through the parent-slot array, deepest nodes first.
5. The crown takes what its cut children found and is accumulated the same way.

The digest of a node's ending conversations is a SHA-256 of a list that cannot be
split: ids are sorted over all tasks, joined to pieces of ``PIECE`` ids, and the
pieces of a node, a row each, stream through one task.

Defined results: rows without a ``conv_id`` belong to no conversation and are left
out; a null turn comes first; rows of one turn go by role and text, repeated rows
are turns of their own; null roles and texts are empty; a conversation without
turns is a member of the root alone; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import stored

#: Path rows below which a subtree is one shard's, whatever the input.
SHARD_ROWS = 4096
#: Crown nodes a depth, at most: the limit is never under a share of all path rows.
CROWN_WIDTH = 1000
PIECE = 4096
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_ROOT = xxhash.xxh3_128_digest(b"root")


# -- conversations ------------------------------------------------------------
def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, role, text``: turns in order, ``pos`` from 1."""
    rows = conversations.select(
        conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"].alias("turn"),
        F.coalesce(conversations["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(conversations["text"].cast("string"), F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.withColumn("pos", F.row_number().over(order).cast("long")).drop("turn")


def rebuilt(turns: DataFrame, family: int = 5, longest_head: int = 9) -> DataFrame:
    """Conversations that begin like others: ``turns`` with every conversation's
    first h turns taken from the first one of its family (``conv_id`` less its
    remainder by ``family``), h being the CRC-32 of its id modulo ``longest_head``.
    ``conv_id, pos, n, role, text``; a conversation left without turns is one row
    of ``pos`` 0."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(longest_head))
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("own")).select(
        "conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base")
    )
    known = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    heads = stored(
        sizes.join(known, "base", "left").withColumn("head", F.least("h", F.coalesce("base_own", F.lit(0)))),
        "trie-heads",
    )
    total = (F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")
    sized = heads.select("conv_id", "base", "h", "head", total)
    own = turns.join(sized, "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "n", "role", "text"
    )
    first = turns.where(F.col("pos") < longest_head).withColumnRenamed("conv_id", "base")
    taken = first.join(sized, "base").where("pos <= h").select("conv_id", "pos", "n", "role", "text")
    none = sized.where("n = 0").select("conv_id", F.lit(0).cast("long").alias("pos"), "n", F.lit("").alias("role"), F.lit("").alias("text"))
    return own.unionByName(taken).unionByName(none)


# -- paths --------------------------------------------------------------------
_PATH = "conv_id long, depth long, rest long, hi long, lo long, parent_hi long, parent_lo long, bytes long"


def prefix_paths(turns: DataFrame) -> DataFrame:
    """One row a prefix of every conversation, the root included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, at = None, _ROOT
        for batch in batches:
            ids, places, sizes = (batch.column(i).to_pylist() for i in range(3))
            rows: list[tuple] = []
            digests: list[bytes] = []
            for conv_id, pos, n, role, text in zip(ids, places, sizes, batch.column(3), batch.column(4)):
                if conv_id != conv:
                    conv, at = conv_id, _ROOT
                    rows.append((conv_id, 0, n + 1, 0))
                    digests += [at, bytes(16)]
                if pos:
                    said = text.as_py().encode("utf-8", "surrogatepass")
                    who = role.as_py().encode("utf-8", "surrogatepass")
                    above, at = at, xxhash.xxh3_128_digest(at + b"%d:" % len(who) + who + said)
                    rows.append((conv_id, pos, n + 1 - pos, len(said)))
                    digests += [at, above]
            if rows:
                halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 4)
                conv_id, depth, rest, size = (pa.array(c, pa.int64()) for c in zip(*rows))
                names = [f.split()[0] for f in _PATH.split(", ")]
                hashes = [pa.array(np.ascontiguousarray(halves[:, i])) for i in range(4)]
                yield pa.RecordBatch.from_arrays([conv_id, depth, rest, *hashes, size], names)

    rows = turns.select("conv_id", "pos", "n", "role", "text")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(run, _PATH)


def ends_digests(paths: DataFrame) -> DataFrame:
    """``hi, lo, ends_sha256`` of every node where conversations end."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        for batch in batches:
            out = []
            for hi, lo, conv_id in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (hi, lo) != key or len(ids) == PIECE:
                    if ids:
                        out.append((*key, ids[0], ",".join(map(str, ids))))
                    key, ids = (hi, lo), []
                ids.append(conv_id)
            if out:
                yield as_pieces(out)
        if ids:
            yield as_pieces([(*key, ids[0], ",".join(map(str, ids)))])

    def as_pieces(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["hi", "lo", "least", "piece"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def as_rows(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["hi", "lo", "ends_sha256"])

        for batch in batches:
            out = []
            for hi, lo, piece in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (hi, lo) == key:
                    state.update(b",")
                else:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (hi, lo), hashlib.sha256()
                state.update(piece.encode())
            if out:
                yield as_rows(out)
        if key is not None:
            yield as_rows([(*key, state.hexdigest())])

    ends = paths.where("rest = 1").select("hi", "lo", "conv_id")
    dealt = ends.repartitionByRange("hi", "lo", "conv_id").sortWithinPartitions("hi", "lo", "conv_id")
    joined = dealt.mapInArrow(pieces, "hi long, lo long, least long, piece string")
    sorted_pieces = joined.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "least")
    return sorted_pieces.mapInArrow(hashed, "hi long, lo long, ends_sha256 string")


# -- node tables --------------------------------------------------------------
class NodeTable:
    """A minimal perfect hash over the rows of a digest table.

    ``slots`` gives every (verified) digest its place in ``0 .. n - 1`` and -1 to
    any digest that is not of the table.
    """

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        self.hi, self.lo = np.empty_like(hi), np.empty_like(lo)
        self._levels: list[tuple[np.ndarray, int]] = []
        left, taken = np.arange(len(hi)), 0
        while len(left):
            cells = self._cells(len(self._levels), hi[left], lo[left], 2 * len(left))
            count = np.bincount(cells, minlength=2 * len(left))
            alone = count[cells] == 1
            place = np.full(2 * len(left), -1, np.int64)
            slots = taken + np.arange(alone.sum())
            place[cells[alone]] = slots
            self.hi[slots], self.lo[slots] = hi[left[alone]], lo[left[alone]]
            self._levels.append((place, 2 * len(left)))
            taken += len(slots)
            left = left[~alone]
            if len(self._levels) > 64:
                raise ValueError("a digest occurs twice")

    @staticmethod
    def _cells(level: int, hi: np.ndarray, lo: np.ndarray, size: int) -> np.ndarray:
        mixed = hi.view(np.uint64) ^ (lo.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * level))
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        out = np.full(len(hi), -1, np.int64)
        for level, (place, size) in enumerate(self._levels):
            open_ = np.flatnonzero(out < 0)
            if not len(open_):
                break
            found = place[self._cells(level, hi[open_], lo[open_], size)]
            held = found >= 0
            held[held] = (self.hi[found[held]] == hi[open_][held]) & (self.lo[found[held]] == lo[open_][held])
            out[open_[held]] = found[held]
        return out


_SUMS = "n_children long, n_leaves long, saved_tokens long"


def accumulated(nodes: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Subtree sums of a set of nodes that holds all below its topmost ones, or has
    what lies below in ``below_*``. Adds ``parent_conv_id`` (masked at the top)."""
    table = NodeTable(nodes["hi"], nodes["lo"])
    slot = table.slots(nodes["hi"], nodes["lo"])
    n = len(slot)

    def scattered(values: np.ndarray) -> np.ndarray:
        out = np.empty(n, np.int64)
        out[slot] = values
        return out

    depth, conv = scattered(nodes["depth"]), scattered(nodes["conv_id"])
    saved = scattered((nodes["n_convs"] - 1) * nodes["bytes"] + nodes["below_saved"])
    children, leaves = scattered(nodes["below_children"]), scattered(nodes["below_leaves"])
    parent = scattered(table.slots(nodes["parent_hi"], nodes["parent_lo"]))
    inside = parent >= 0
    np.add.at(children, parent[inside], 1)
    leaves[children == 0] = 1
    by_depth = np.argsort(-depth, kind="stable")
    edges = np.flatnonzero(np.diff(depth[by_depth])) + 1
    for level in np.split(by_depth, edges):
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    above = np.where(inside, conv[np.maximum(parent, 0)], 0)
    return {
        "n_children": children[slot], "n_leaves": leaves[slot], "saved_tokens": saved[slot],
        "parent_conv_id": above[slot], "inside": inside[slot],
    }


_NODE = "hi long, lo long, parent_hi long, parent_lo long, conv_id long, depth long, n_convs long, bytes long"
_NODE_COLUMNS = [f.split()[0] for f in _NODE.split(", ")]
_BELOW = ["below_children", "below_leaves", "below_saved"]
_DONE = f"{_NODE}, parent_conv_id long, {_SUMS}"


def _shard(table: pa.Table) -> pa.Table:
    nodes = {c: table.column(c).to_numpy() for c in _NODE_COLUMNS + _BELOW}
    sums = accumulated(nodes)
    columns = [table.column(c) for c in _NODE_COLUMNS]
    columns.append(pa.array(sums["parent_conv_id"], pa.int64(), mask=~sums["inside"]))
    columns += [pa.array(sums[c]) for c in ("n_children", "n_leaves", "saved_tokens")]
    return pa.Table.from_arrays(columns, [f.split()[0] for f in _DONE.split(", ")])


def prefix_trie(turns: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row a node of the trie of ``turns`` (``conv_id, pos, n, role, text``)."""
    paths = stored(prefix_paths(turns), "trie-paths")
    total = paths.count()
    limit = max(shard_rows, total // CROWN_WIDTH)
    nodes = stored(
        paths.groupBy("hi", "lo").agg(
            # A digest fixes its parent and its text; any of its rows will do.
            F.min("parent_hi").alias("parent_hi"), F.min("parent_lo").alias("parent_lo"),
            F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
            F.min("bytes").alias("bytes"), F.sum("rest").alias("rest"),
        ),
        "trie-nodes",
    )
    crown = nodes.where(F.col("rest") > limit)
    # A conversation leaves the crown once: the next node of its path is the cut.
    in_crown = paths.join(crown.select("hi", "lo"), ["hi", "lo"], "left_semi").groupBy("conv_id").agg(F.max("depth").alias("top"))
    cut = paths.join(in_crown, "conv_id", "left").where(F.col("depth") == F.coalesce(F.col("top") + 1, F.lit(0)))
    n_shards = max(1, -(-total // limit))
    shard = cut.select("conv_id", F.pmod(F.xxhash64("hi", "lo"), F.lit(n_shards)).alias("shard"))
    below = nodes.where(F.col("rest") <= limit).join(shard, "conv_id")
    zero = [F.lit(0).cast("long").alias(c) for c in _BELOW]
    done = stored(below.select("shard", *_NODE_COLUMNS, *zero).groupBy("shard").applyInArrow(_shard, _DONE), "trie-shards")
    inflow = done.where("parent_conv_id IS NULL AND depth > 0").groupBy("parent_hi", "parent_lo").agg(
        F.count(F.lit(1)).alias("below_children"), F.sum("n_leaves").alias("below_leaves"), F.sum("saved_tokens").alias("below_saved")
    ).select(F.col("parent_hi").alias("hi"), F.col("parent_lo").alias("lo"), *_BELOW)
    # The crown is one shard: CROWN_WIDTH nodes a depth at most.
    top = crown.join(inflow, ["hi", "lo"], "left").na.fill(0, _BELOW).select(F.lit(0).alias("shard"), *_NODE_COLUMNS, *_BELOW)
    tops = stored(top.groupBy("shard").applyInArrow(_shard, _DONE), "trie-crown")
    parents = tops.select(F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("conv_id").alias("above"))
    every = tops.unionByName(
        done.join(parents, ["parent_hi", "parent_lo"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).drop("above")
    )
    return every.join(ends_digests(paths), ["hi", "lo"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_EMPTY_SHA)).alias("ends_sha256"),
    )
