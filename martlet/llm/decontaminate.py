"""Operator 6: benchmark decontamination by spaced-seed hashing.

Texts become sequences of 64-bit token hashes (words, lower-cased, outer
punctuation stripped, empty ones left out). A seed is the hash of the tokens
under one of a few fixed masks that ignore some positions, so a substituted
word at an ignored position does not hide the passage.

1. Benchmark seeds ``(seed, item, offset)`` are a table. Two bit maps over them
   (fixed size, 2 MB each, whatever the benchmark's size) go to every task.
2. One pass over the whole texts: positions whose seeds pass both bit maps are
   gathered into regions, with their surrounding tokens. Bit maps only save
   work; a false pass is removed by the join that follows.
3. Seeds of the regions join the benchmark seeds; each distinct (region, item,
   diagonal) is one alignment.
4. Every alignment is verified token by token: the best segment around the hit,
   at 80% or more equal tokens, must span ``min_overlap`` tokens (or the whole
   item, where that is shorter). Where the best one is shorter, the longest that
   begins and ends with an equal token decides.

Items of up to ``SPAN`` tokens use masks of their own length; an item
of fewer than ``min_item_tokens`` tokens carries no passage and matches nothing.

Defined results: null and empty texts match nothing; repeated documents or items
give equal rows, each pair once; rows with a null ``doc_id`` or ``item_id`` are
not reported, as nothing could refer to them; empty tables give no rows. Only
the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.bitmaps import bit_maps, passes
from martlet.llm.common import checkpointed, text_bytes

#: 1: the token is hashed; 0: it is ignored. One of them fits into every overlap
#: of 13 to 25 tokens of which a fifth at most is replaced, wherever (enumerated);
#: every longer one holds such an overlap.
MASKS = ("1101111", "1110100011", "1110010101", "1011100101")
#: Items of up to as many tokens have masks of their own.
SPAN = 12
CACHE_WORDS = 200_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Seeding:
    min_overlap: int = 13
    min_match: float = 0.8
    min_item_tokens: int = 5
    context: int = 25


class _TokenHashes(dict):
    """Raw word -> hash of its normal form (0: none), a bounded cache."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        normal = word.decode("utf-8", "surrogatepass").lower()
        while normal and not normal[0].isalnum():
            normal = normal[1:]
        while normal and not normal[-1].isalnum():
            normal = normal[:-1]
        value = xxhash.xxh64_intdigest(normal.encode("utf-8", "surrogatepass")) | 1 if normal else 0
        self[word] = value
        return value


_hashes = _TokenHashes()


def token_hashes(text: str | None) -> np.ndarray:
    found = np.fromiter(map(_hashes.__getitem__, text_bytes(text).split()), np.uint64)
    return found[found != 0]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def short_masks(n: int) -> list[list[int]]:
    """Masks of a whole item of ``n`` tokens: its inner positions are dealt to one
    block more than a fifth of ``n`` may be replaced, and each mask hashes both ends
    and one block, so one mask is left whole."""
    blocks = n // 5 + 1
    return [[0, *range(1 + b, n - 1, blocks), n - 1] for b in range(blocks)]


def mask_positions(short_lengths: list[int]) -> list[tuple[int, list[int]]]:
    """Span and hashed positions of each mask; the masks of short items follow the fixed ones."""
    fixed = [(len(mask), [i for i, bit in enumerate(mask) if bit == "1"]) for mask in MASKS]
    return fixed + [(n, positions) for n in short_lengths for positions in short_masks(n)]


def seed_hashes(tokens: np.ndarray, positions: list[int], span: int) -> np.ndarray:
    """Seed at every start where the whole span fits."""
    n = len(tokens) - span + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, np.uint64(span))
    for p in positions:
        h = (h + tokens[p : p + n]) * FACTOR
    return _mix(h)


def item_table(benchmark: DataFrame, params: Seeding) -> DataFrame:
    """``item_id, tokens`` of every item long enough to carry a passage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [token_hashes(x.as_py()).view(np.int64) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tokens, pa.list_(pa.int64()))], ["item_id", "tokens"]
            )

    rows = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text"))
    items = rows.where("item_id is not null").mapInArrow(run, "item_id long, tokens array<long>")
    return items.where(F.size("tokens") >= params.min_item_tokens).distinct()


def item_seeds(items: DataFrame, masks: list[tuple[int, list[int]]]) -> DataFrame:
    """``seed, mask, item_id, item_pos`` of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, value in zip(batch.column(0), batch.column(1)):
                tokens = value.values.to_numpy(zero_copy_only=False).view(np.uint64)
                for m, (span, positions) in enumerate(masks):
                    if (len(tokens) <= SPAN) != (m >= len(MASKS)) or m >= len(MASKS) and len(tokens) != span:
                        continue
                    seeds = seed_hashes(tokens, positions, span).view(np.int64)
                    n = len(seeds)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(seeds), pa.array(np.full(n, m, np.int32)),
                         pa.array([item.as_py()] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32))],
                        ["seed", "mask", "item_id", "item_pos"],
                    )

    return items.mapInArrow(run, "seed long, mask int, item_id long, item_pos int")


def regions(docs: DataFrame, masks: list[tuple[int, list[int]]], maps, context: int) -> DataFrame:
    """``doc_id, start, tokens, hits``: the parts of texts around possible hits."""
    schema = "doc_id long, start int, tokens array<long>, hits array<struct<seed:long,mask:int,pos:int>>"
    hit_type = pa.list_(pa.struct([("seed", pa.int64()), ("mask", pa.int32()), ("pos", pa.int32())]))

    def of_text(doc_id: int, text: str | None) -> Iterator[tuple]:
        tokens = token_hashes(text)
        hits = []
        for m, (span, positions) in enumerate(masks):
            seeds = seed_hashes(tokens, positions, span)
            hits += [(int(p), m, int(seeds[p].view(np.int64)), span) for p in passes(seeds, maps.value)]
        hits.sort()
        first = 0
        for i, hit in enumerate(hits):
            if i + 1 == len(hits) or hits[i + 1][0] > hit[0] + SPAN + 2 * context:
                some = hits[first : i + 1]
                start = max(0, some[0][0] - context)
                end = min(len(tokens), some[-1][0] + SPAN + context)
                yield (doc_id, start, tokens[start:end].view(np.int64).tolist(),
                       [{"seed": s, "mask": m, "pos": p} for p, m, s, _ in some])
                first = i + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row for d, t in zip(batch.column(0), batch.column(1)) for row in of_text(d.as_py(), t.as_py())]
            if rows:
                columns = list(zip(*rows))
                types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), hit_type]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "start", "tokens", "hits"]
                )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.where("doc_id is not null").mapInArrow(run, schema)


def best_segment(equal: np.ndarray, min_match: float) -> tuple[int, int]:
    """The best run ``[lo, hi)`` in which at least ``min_match`` are equal: most
    in excess of that share, then longest."""
    miss = -min_match / (1 - min_match)
    best, span, total, lo = (0.0, 0), (0, 0), 0.0, 0
    for i, same in enumerate(equal.tolist()):
        if total < -1e-9:
            total, lo = 0.0, i
        total += 1.0 if same else miss
        rank = (round(total, 6), i + 1 - lo)
        if total > 0 and rank > best:
            best, span = rank, (lo, i + 1)
    return span


def longest_segment(equal: np.ndarray, min_match: float) -> tuple[int, int]:
    """The longest run ``[lo, hi)`` that begins and ends with an equal token and in
    which at least ``min_match`` are equal."""
    at = np.flatnonzero(equal)
    if not len(at):
        return 0, 0
    sums = np.concatenate([[0.0], np.cumsum(np.where(equal, 1 - min_match, -min_match))])
    low = np.minimum.accumulate(sums[at])
    starts = at[np.searchsorted(-low, -sums[at + 1] - 1e-9)]
    best = int(np.argmax(at - starts))
    return int(starts[best]), int(at[best]) + 1


def verified(alignments: DataFrame, params: Seeding) -> DataFrame:
    """Alignments whose overlap holds, with its place and size in tokens."""
    names = ["doc_id", "item_id", "doc_start", "item_start", "n_tokens", "n_equal"]

    def of_row(row: dict) -> tuple | None:
        doc, item = np.array(row["tokens"], np.int64), np.array(row["item_tokens"], np.int64)
        shift = row["diagonal"] - row["start"]  # region index = item index + shift
        lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
        if hi <= lo:
            return None
        equal = doc[lo + shift : hi + shift] == item[lo:hi]
        a, b = best_segment(equal, params.min_match)
        least = min(params.min_overlap, len(item))
        if b - a < least:  # replaced words outweigh the runs beside them
            a, b = longest_segment(equal, params.min_match)
        if b - a < least:
            return None
        return row["doc_id"], row["item_id"], lo + a + row["diagonal"], lo + a, b - a, int(equal[a:b].sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [out for row in batch.to_pylist() if (out := of_row(row))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    return alignments.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def contaminated(docs: DataFrame, benchmark: DataFrame, params: Seeding = Seeding()) -> DataFrame:
    """One row per (document, benchmark item) that share a passage.

    ``doc_id, item_id, doc_start, item_start, n_tokens, n_equal``: the largest
    verified overlap, in tokens.
    """
    items = checkpointed(item_table(benchmark, params))
    short = items.where(F.size("tokens") <= SPAN).select(F.size("tokens").alias("n")).distinct().orderBy("n")
    masks = mask_positions([row["n"] for row in short.collect()])  # at most SPAN lengths
    seeds = checkpointed(item_seeds(items, masks))
    maps = docs.sparkSession.sparkContext.broadcast(bit_maps(seeds))
    found = checkpointed(regions(docs, masks, maps, params.context))
    hits = found.select("doc_id", "start", F.explode("hits").alias("hit")).select(
        "doc_id", "start", "hit.seed", "hit.mask", "hit.pos"
    )
    alignments = (
        hits.join(seeds, ["seed", "mask"])
        .select("doc_id", "start", "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal")).distinct()
        .join(found.select("doc_id", "start", "tokens"), ["doc_id", "start"])
        .join(items.select("item_id", F.col("tokens").alias("item_tokens")), "item_id")
    )
    # The longest overlap; of equally long ones the first in the document.
    rank = F.struct("n_tokens", "n_equal", (-F.col("doc_start")).alias("before"), (-F.col("item_start")).alias("item_before"))
    best = verified(alignments, params).groupBy("doc_id", "item_id").agg(F.max(rank).alias("o"))
    return best.select(
        "doc_id", "item_id", (-F.col("o.before")).alias("doc_start"), (-F.col("o.item_before")).alias("item_start"),
        F.col("o.n_tokens").alias("n_tokens"), F.col("o.n_equal").alias("n_equal"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, params: Seeding = Seeding()) -> DataFrame:
    """The documents that share no passage with the benchmark, all columns."""
    leaks = contaminated(docs, benchmark, params).select(F.col("doc_id").alias("__leak")).distinct()
    return docs.join(leaks, docs["doc_id"] == leaks["__leak"], "left_anti")
